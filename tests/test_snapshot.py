from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from small import LATE, ROWS, service, small_catalog
from snapwright.plans.snapshot import (
    KEY_COLUMN,
    SNAPSHOT_SCHEMA,
    build_snapshot,
    changed_services,
    conform,
    deleted_ids,
    reading_order,
)
from snapwright.functions.predicates import IdRange
from snapwright.sources.catalog import SourceCatalog, jdbc_options
from snapwright.sources.fixtures import FIXTURE_SQL, fixture_catalog


@pytest.fixture(scope="module")
def snapshot(spark):
    return build_snapshot(small_catalog(spark)).persist()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The derived tables written once, as a production catalog would hold them."""
    root = str(tmp_path_factory.mktemp("tables"))
    catalog = fixture_catalog(spark, sf_dir)
    for name in FIXTURE_SQL:
        catalog[name].write.parquet(f"{root}/{name}")
    return SourceCatalog.from_parquet(spark, root)


def test_row_multiplication(snapshot):
    counts = Counter(r.service_id for r in snapshot.collect())
    # addresses x service schedules x resource schedules
    assert counts == {1: 2 * 2 * 2, 2: 2 * 2, 6: 2, 7: 1}


def test_schema(snapshot):
    names = [f.name for f in snapshot.schema]
    assert names == [KEY_COLUMN, *SNAPSHOT_SCHEMA.names] and len(SNAPSHOT_SCHEMA.names) == 24
    assert {f.name: f.dataType for f in snapshot.schema if f.name != KEY_COLUMN} == {
        f.name: f.dataType for f in SNAPSHOT_SCHEMA
    }


def test_addresses(snapshot):
    got = {(r.service_id, r.address_id) for r in snapshot.collect()}
    assert got == {(1, 1), (1, 2), (2, 3), (2, 4), (6, None), (7, None)}


def test_keys_are_unique_and_repeatable(spark, snapshot):
    keys = [r[KEY_COLUMN] for r in snapshot.collect()]
    assert len(set(keys)) == len(keys)
    assert sorted(keys) == sorted(r[KEY_COLUMN] for r in build_snapshot(small_catalog(spark)).collect())


def test_prose_of_a_full_row(snapshot):
    rows = snapshot.filter("service_id = 1 and address_id = 2").collect()
    texts = {r.embedding_text for r in rows}
    known = (
        "Org, also known as The Org. Organization type: Nonprofit. Service: Meals. Program: Help. Daily."
        " Categories: Food. Who this service is for: Preschool, Substance Dependency. Fee: Free."
        " Hours: Monday 09:00 AM - 05:00 PM. Location: 2 Main St, Unit 1, Town, CA 94100. Phone: 555 (Main)."
        " Email: s1@example.org. Service website: http://s1."
    )
    assert texts == {known, known.replace("Monday 09:00 AM - 05:00 PM", "Call to confirm hours")}


def test_prose_with_missing_parts(snapshot):
    rows = {(r.address_id, r.schedule[0].day): r for r in snapshot.filter("service_id = 2").collect()}
    with_city, without_city = rows[(3, "Friday")].embedding_text, rows[(4, "Sunday")].embedding_text
    assert "Service: Unnamed Service." in with_city and "Location: 3 Main St, Town, CA 94100." in with_city
    assert "Hours: Friday 10:00 AM - 11:00 AM." in with_city
    assert "Email: r@example.org. Website: http://r." in with_city
    assert with_city.endswith("Instructions: Ring the bell. Related documents: http://d (Form).")
    assert "Location" not in without_city and "Hours" not in without_city
    nameless = snapshot.filter("service_id = 7").head()
    assert nameless.embedding_text == "Service: Unnamed resource." and nameless.schedule is None


def test_schedule_choice(snapshot):
    days = {(r.service_id, r.schedule[0].day) for r in snapshot.collect() if r.schedule}
    assert days == {(1, "Monday"), (1, "Tuesday"), (2, "Friday"), (2, "Sunday"), (6, "Friday"), (6, "Sunday")}


def test_arrays(snapshot):
    row = snapshot.filter("service_id = 1").head()
    assert row.category_ids == [3] and row.whitelabel_category_names == ["Label"]
    assert row.eligibility_health == ["Substance Dependency"] and row.eligibility_age is None
    assert "eligibility_education" not in row.asDict()
    assert snapshot.filter("service_id = 2").head().eligibility_all is None


def test_reading_order(snapshot):
    rows = [(r.resource_id, r.service_id, r.address_id) for r in snapshot.orderBy(*reading_order()).collect()]
    assert rows == sorted(rows, key=lambda t: tuple((v is None, v) for v in t))


def test_own_white_labels(spark):
    rows = build_snapshot(small_catalog(spark), white_labels={"partner": IdRange(202, 202)})
    assert rows.filter("service_id = 1").head().partner_category_names == ["Hidden"]
    assert "whitelabel_category_ids" not in rows.columns


def test_incremental_rows_and_deletes(spark):
    services = [
        {**row, "updated_at": LATE} if row["id"] in (2, 4, 5, 6) else row for row in ROWS["services"]
    ]
    catalog = small_catalog(spark, services=services)
    got = build_snapshot(catalog, since="2024-01-15 00:00:00")
    whole = build_snapshot(catalog).filter("updated_at > timestamp_ntz '2024-01-15 00:00:00'")
    assert rows_of(got) == rows_of(whole)
    assert {r.service_id for r in got.collect()} == {2, 6}
    assert [r.service_id for r in deleted_ids(catalog["services"], "2024-01-15").collect()] == [4]
    # Strictly later: the watermark itself does not count.
    assert build_snapshot(catalog, since=LATE).isEmpty()


def test_hot_keys_do_not_change_the_result(spark, stored, sf_dir):
    plain = rows_of(build_snapshot(stored))
    assert plain == rows_of(build_snapshot(stored, task_rows=2))
    assert plain == rows_of(build_snapshot(stored, task_rows=40))


def test_one_resource_holding_most_services(spark):
    services = [service(i, 1 if i % 3 else 3, name=f"s{i}") for i in range(1, 200)]
    links = [{"service_id": 5, "address_id": a} for a in range(100, 160)]
    from small import address

    addresses = [*ROWS["addresses"], *[address(a) for a in range(100, 160)]]
    catalog = small_catalog(spark, services=services, addresses_services=links, addresses=addresses)
    assert rows_of(build_snapshot(catalog)) == rows_of(build_snapshot(catalog, task_rows=5))


def test_partition_count_does_not_matter(spark, stored):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    first = rows_of(build_snapshot(stored))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert rows_of(build_snapshot(stored)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_watermark_reaches_the_scan_and_taxonomy_is_broadcast(spark, stored):
    changed = changed_services(stored["services"], "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at" in changed.split("PushedFilters")[1]
    plan = build_snapshot(stored, since="2024-01-03")._jdf.queryExecution().executedPlan().toString()
    full = build_snapshot(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= full.count("FileScan")
    assert "LocalTableScan" in plan and "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_wide_row_is_shuffled_by_service_once(spark, stored):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = build_snapshot(stored)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    # The outermost joins sit directly on each other: none of their left inputs is exchanged again.
    spine = [line for line in plan if "SortMergeJoin [service_id" in line and "LeftOuter" in line]
    assert len(spine) == 7
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in spine]
    assert depth == sorted(depth)


def test_conform_rejects_missing_ids(spark, snapshot):
    broken = snapshot.withColumn("service_id", F.lit(None).cast("long"))
    with pytest.raises(Exception, match="NULL in required column service_id"):
        conform(broken, SNAPSHOT_SCHEMA).collect()
    assert conform(snapshot, SNAPSHOT_SCHEMA).count() == snapshot.count()


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "public.programs", None, 8, 100)
    assert plain == {"url": "jdbc:x", "dbtable": "public.programs", "fetchsize": "100"}
    cut = jdbc_options("jdbc:x", "public.services", ("id", 1, 1000), 8, 100, {"user": "u"})
    assert (cut["partitionColumn"], cut["lowerBound"], cut["upperBound"], cut["numPartitions"]) == ("id", "1", "1001", "8")
    assert cut["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", ("id", 5, 5), 8, 100)


def test_catalog_lookup(spark):
    catalog = SourceCatalog({"a": lambda: spark.range(3)})
    assert catalog["a"] is catalog["a"] and "a" in catalog
    with pytest.raises(KeyError):
        catalog["b"]


def test_a_full_build_rolls_up_nothing_that_no_row_needs(spark, monkeypatch):
    from snapwright.plans import snapshot as module

    seen = {}

    def watched(name):
        rollup = getattr(module, name)

        def run(first, *rest):
            seen[name] = sorted(map(tuple, first.collect()))
            return rollup(first, *rest)

        monkeypatch.setattr(module, name, run)

    for name in ("category_arrays", "eligibility_arrays", "schedule_rollup"):
        watched(name)
    more = {
        "categories_services": [{"service_id": 99, "category_id": 3}, {"category_id": 3}],
        "eligibilities_services": [{"service_id": 4, "eligibility_id": 1}, {"service_id": -1, "eligibility_id": 2}],
        "schedules": [{"id": 90}, {"id": 91, "service_id": 99}, {"id": 92, "resource_id": 99}, {"id": 93, "service_id": 4, "resource_id": 1}],
        "schedule_days": [{"schedule_id": n, "day": "Monday", "opens_at": 900, "closes_at": 1000} for n in (90, 91, 92, 93)],
    }
    got = rows_of(build_snapshot(small_catalog(spark, **{name: ROWS[name] + rows for name, rows in more.items()})))
    assert [row[0] for row in seen["category_arrays"]] == [1, 1, 1] and [row[0] for row in seen["eligibility_arrays"]] == [1, 1]
    assert [row[0] for row in seen["schedule_rollup"]] == [1, 2, 3, 4, 5]
    assert got == rows_of(build_snapshot(small_catalog(spark)))


def test_a_packed_snapshot_holds_each_service_once(spark):
    from snapwright.plans.snapshot import packed_snapshot

    packed = packed_snapshot(small_catalog(spark))
    whole = packed.whole()
    assert packed.rows.count() == whole.select("service_id").distinct().count() < whole.count()
    assert rows_of(whole) == rows_of(build_snapshot(small_catalog(spark)))


def test_an_increment_is_built_once(spark, sf_dir):
    from snapwright.plans.queries import QUERIES

    assert any("/fresh/" in path for path in QUERIES["incremental_merge"](spark, sf_dir).inputFiles())


def test_tables_that_grow_are_not_broadcast_by_the_size_of_their_files(spark, sf_dir):
    from snapwright.operators.rollups import document_text, schedule_rollup
    from snapwright.plans.snapshot import linked_addresses, resource_wide
    from snapwright.sources.fixtures import fixture_catalog

    cat = fixture_catalog(spark, sf_dir)
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small = small_catalog(spark)
    made = [
        cat["services"], cat["documents"], schedule_rollup(small["schedules"], small["schedule_days"]), document_text(small["documents_services"], small["documents"]),
        linked_addresses(small["addresses_services"], small["addresses"]), resource_wide(small["resources"], small["phones"]),
    ]
    for df in made:
        assert "SortMergeJoin" in plan_of(df) and "BroadcastHashJoin" not in plan_of(df)
    # A small table of programs is counted and sent.
    assert "BroadcastHashJoin" in plan_of(build_snapshot(small))
