"""A hand-made directory of a few rows with every edge case of the snapshot."""

from datetime import datetime

from snapwright.sources.catalog import SOURCE_COLUMNS, SourceCatalog

EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 2, 1)

TYPES = {
    "id": "long", "resource_id": "long", "service_id": "long", "program_id": "long", "address_id": "long",
    "schedule_id": "long", "category_id": "long", "eligibility_id": "long", "document_id": "long", "status": "int",
    "verified_at": "timestamp_ntz", "updated_at": "timestamp_ntz", "latitude": "decimal(18,8)",
    "longitude": "decimal(18,8)", "hours_known": "boolean", "opens_at": "int", "closes_at": "int",
}


def service(id, resource_id, status=1, updated_at=EARLY, **more):
    return {"id": id, "resource_id": resource_id, "status": status, "updated_at": updated_at, **more}


def address(id, resource_id=None, **more):
    given = {"address_1": f"{id} Main St", "city": "Town", "state_province": "CA", "postal_code": "94100"}
    return {"id": id, "resource_id": resource_id, **given, **more}


ROWS = {
    "services": [
        service(1, 1, name="Meals", program_id=1, fee="Free", email="s1@example.org", url="http://s1"),
        service(2, 1, name=None),
        service(3, 2, name="Inactive resource"),
        service(4, 1, status=0, name="Deleted"),
        service(5, 1, status=None, name="Unknown status"),
        service(6, 1, name="Only dangling"),
        service(7, 3, name="Unnamed resource", updated_at=None),
        service(8, 9, name="No resource row"),
    ],
    "resources": [
        {"id": 1, "name": "Org", "alternate_name": "The Org", "legal_status": "Nonprofit", "email": "r@example.org",
         "website": "http://r", "status": 1},
        {"id": 2, "name": "Closed", "status": 2},
        {"id": 3, "name": None, "status": 1},
    ],
    "programs": [{"id": 1, "name": "Help", "alternate_name": None, "description": "Daily"}],
    "addresses": [
        address(1, latitude=None), address(2, address_2="Unit 1"), address(3, 1), address(4, 1, city=None),
    ],
    "addresses_services": [
        {"service_id": 1, "address_id": 1}, {"service_id": 1, "address_id": 2}, {"service_id": 6, "address_id": -1},
    ],
    "phones": [{"id": 1, "resource_id": 1, "number": "555", "service_type": "Main"}],
    "schedules": [
        {"id": 1, "service_id": 1, "hours_known": True},
        {"id": 2, "service_id": 1, "hours_known": False},
        {"id": 3, "resource_id": 1, "hours_known": True},
        {"id": 4, "resource_id": 1, "hours_known": None},
        {"id": 5, "service_id": 7, "hours_known": True},
    ],
    "schedule_days": [
        {"schedule_id": 1, "day": "Monday", "opens_at": 900, "closes_at": 1700},
        {"schedule_id": 2, "day": "Tuesday", "opens_at": 900, "closes_at": 1700},
        {"schedule_id": 3, "day": "Friday", "opens_at": 1000, "closes_at": 1100},
        {"schedule_id": 4, "day": "Sunday", "opens_at": None, "closes_at": 1100},
    ],
    "instructions": [{"id": 1, "service_id": 2, "instruction": "Ring the bell"}],
    "documents": [{"id": 1, "url": "http://d", "description": "Form"}],
    "documents_services": [{"service_id": 2, "document_id": 1}],
    "categories": [{"id": 3, "name": "Food"}, {"id": 202, "name": "Hidden"}, {"id": 1000001, "name": "Label"}],
    "categories_services": [
        {"service_id": 1, "category_id": 3}, {"service_id": 1, "category_id": 202},
        {"service_id": 1, "category_id": 1000001},
    ],
    "eligibilities": [{"id": 1, "name": "Smoker"}, {"id": 2, "name": "Preschool"}],
    "eligibilities_services": [{"service_id": 1, "eligibility_id": 1}, {"service_id": 1, "eligibility_id": 2}],
}


def small_catalog(spark, **changed) -> SourceCatalog:
    def table(name):
        columns = SOURCE_COLUMNS[name]
        schema = ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in columns)
        rows = [tuple(row.get(c) for c in columns) for row in changed.get(name, ROWS[name])]
        return spark.createDataFrame(rows, schema)

    return SourceCatalog({name: table(name) for name in SOURCE_COLUMNS})
