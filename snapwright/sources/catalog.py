"""Named source tables behind one lookup, whatever they are read from."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

# The columns the snapshot reads from each source table.
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "services": (
        "id", "resource_id", "program_id", "name", "alternate_name", "short_description",
        "long_description", "eligibility", "application_process", "required_documents", "fee",
        "wait_time", "interpretation_services", "email", "url", "status", "verified_at", "updated_at",
    ),
    "resources": (
        "id", "name", "alternate_name", "legal_status", "short_description", "long_description",
        "email", "website", "status",
    ),
    "programs": ("id", "name", "alternate_name", "description"),
    "addresses": (
        "id", "resource_id", "address_1", "address_2", "city", "state_province", "postal_code",
        "latitude", "longitude",
    ),
    "addresses_services": ("service_id", "address_id"),
    "phones": ("id", "resource_id", "number", "service_type"),
    "schedules": ("id", "service_id", "resource_id", "hours_known"),
    "schedule_days": ("schedule_id", "day", "opens_at", "closes_at"),
    "instructions": ("id", "service_id", "instruction"),
    "documents": ("id", "url", "description"),
    "documents_services": ("service_id", "document_id"),
    "categories": ("id", "name"),
    "categories_services": ("service_id", "category_id"),
    "eligibilities": ("id", "name"),
    "eligibilities_services": ("service_id", "eligibility_id"),
}

Loader = Callable[[], DataFrame]


class SourceCatalog:
    """Maps a table name to a DataFrame; a loader runs on first use and is kept.

    ``reduced`` says that the tables hold no other rows than the services need.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Loader], *, reduced: bool = False):
        self._tables: dict[str, DataFrame | Loader] = dict(tables)
        self.reduced = reduced

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise KeyError(f"unknown source table '{name}'")
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = table()
            self._tables[name] = table
        return table

    def __contains__(self, name: str) -> bool:
        return name in self._tables

    def names(self) -> list[str]:
        return sorted(self._tables)

    def replacing(self, *, reduced: bool = False, **tables: DataFrame | Loader) -> "SourceCatalog":
        """A catalog like this one with some tables swapped."""
        return SourceCatalog({**self._tables, **tables}, reduced=reduced)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> "SourceCatalog":
        """One parquet folder or file per table under ``root``."""

        def loader(name: str) -> Loader:
            return lambda: spark.read.parquet(f"{root}/{name}").select(*SOURCE_COLUMNS[name])

        return cls({name: loader(name) for name in SOURCE_COLUMNS})

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        *,
        schema: str = "public",
        bounds: Mapping[str, tuple[str, int, int]] | None = None,
        num_partitions: int = 32,
        fetch_size: int = 10_000,
        properties: Mapping[str, str] | None = None,
    ) -> "SourceCatalog":
        """Tables of a database.

        ``bounds`` gives (numeric column, lowest, highest) per table and makes the read parallel;
        a table without bounds comes through one connection, so give bounds for every large one.
        """

        def loader(name: str) -> Loader:
            options = jdbc_options(
                url, f"{schema}.{name}", (bounds or {}).get(name), num_partitions, fetch_size, properties
            )
            return lambda: spark.read.format("jdbc").options(**options).load().select(*SOURCE_COLUMNS[name])

        return cls({name: loader(name) for name in SOURCE_COLUMNS})


def jdbc_options(
    url: str,
    table: str,
    bounds: tuple[str, int, int] | None,
    num_partitions: int,
    fetch_size: int,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for one table; a range of the bounded column per Spark partition."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if bounds is not None:
        column, lowest, highest = bounds
        if highest <= lowest:
            raise ValueError(f"empty bounds for {table}: {lowest}..{highest}")
        options.update(
            partitionColumn=column,
            lowerBound=str(lowest),
            upperBound=str(highest + 1),
            numPartitions=str(num_partitions),
        )
    return options
