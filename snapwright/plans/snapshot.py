"""One wide row per active service x address x service schedule x resource schedule.

Shape of the plan: every many-to-one link is rolled up on its own before it is joined. The wide service
row is shuffled by resource once and by service once; addresses and schedules are brought to service
level on narrow rows and joined last, in one stage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapwright.functions.predicates import IdRange, changed_since, is_active, is_soft_deleted
from snapwright.operators.joins import (
    HOT_LIMIT,
    TASK_ROWS,
    broadcast_if_small,
    by_shuffle,
    fan_hot,
    fan_out,
    find_hot,
    grid_hot,
    grid_join,
    keep_listed,
    key_counts,
    largest_groups,
    lookup,
    lookup_hot,
    packed,
    unbridged,
)
from snapwright.operators.rollups import (
    RUN,
    category_arrays,
    document_text,
    eligibility_arrays,
    instruction_text,
    phone_text,
    schedule_rollup,
)
from snapwright.operators.taxonomy import DIMENSIONS, Taxonomy, classify
from snapwright.plans.prose import row_prose, service_prose
from snapwright.sources.catalog import SOURCE_COLUMNS, SourceCatalog
from snapwright.sources.storage import stored, stored_together

# Id ranges of the core categories and of the white-label family.
CORE_CATEGORIES = IdRange(0, 399, without=(202,), without_ranges=((356, 362),))
WHITE_LABELS: Mapping[str, IdRange] = {"whitelabel": IdRange(1000001, 1000012)}

INTERVAL = T.StructType(
    [
        T.StructField("day", T.StringType()),
        T.StructField("open_mins", T.IntegerType()),
        T.StructField("close_mins", T.IntegerType()),
    ]
)
# Education names count towards eligibility_all but have no column of their own.
ELIGIBILITY_COLUMNS = tuple(f"eligibility_{d}" for d in DIMENSIONS if d != "education") + ("eligibility_all",)


def snapshot_schema(white_labels: Mapping[str, IdRange] = WHITE_LABELS) -> T.StructType:
    """The data columns of a snapshot, without the embedding."""
    text, texts, ids = T.StringType(), T.ArrayType(T.StringType()), T.ArrayType(T.LongType())
    schema = (
        T.StructType()
        .add("service_id", T.LongType(), False)
        .add("resource_id", T.LongType(), False)
        .add("address_id", T.LongType())
        .add("verified_at", T.TimestampNTZType())
        .add("updated_at", T.TimestampNTZType())
        .add("latitude", T.DecimalType(18, 8))
        .add("longitude", T.DecimalType(18, 8))
        .add("schedule", T.ArrayType(INTERVAL))
        .add("category_ids", ids)
        .add("category_names", texts)
    )
    for family in white_labels:
        schema = schema.add(f"{family}_category_ids", ids).add(f"{family}_category_names", texts)
    for name in ELIGIBILITY_COLUMNS:
        schema = schema.add(name, texts)
    return schema.add("embedding_text", text)


SNAPSHOT_SCHEMA = snapshot_schema()
# Columns kept beside the data columns: a stable row key in place of a serial number.
KEY_COLUMN = "snapshot_key"
ORDER_COLUMNS = ("resource_id", "service_id", "linked_address_id")
READING_IDS = (*ORDER_COLUMNS, "service_schedule_id", "resource_schedule_id", "address_id")


def reading_order() -> list[Column]:
    """Resource, service, then the service's own address; an address it only has through its resource counts as none.

    Stored rows do not say where an address came from, so a published table orders by the address itself within that.
    """
    return [F.col(name).asc_nulls_last() for name in ("resource_id", "service_id", "address_id")]


def numbered_in_order(rows: DataFrame) -> DataFrame:
    """Rows of :func:`joined_rows` with ``row_number`` in reading order within their resource.

    Equal places go by the schedules' ids.
    """
    order = [F.col(name).asc_nulls_last() for name in (*ORDER_COLUMNS[1:], "service_schedule_id", "resource_schedule_id", "address_id")]
    return rows.withColumn("row_number", F.row_number().over(Window.partitionBy("resource_id").orderBy(*order)))


def numbered_globally(rows: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """``rows`` with their place in one order over the whole table, from 1.

    Ranges of the order are sorted and stored side by side, each row with its place in its range. The ranges' sizes, one
    number each, are summed on the driver, and a row's number is its place after all earlier ranges. Rows that are equal in all of
    ``order`` are numbered among themselves in any order.
    """
    place = F.monotonically_increasing_id()
    # Choosing ranges reads its input once before it is sorted, so the rows are made first.
    sorted_rows = stored(rows, "unordered").repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits name the range, the lower 33 the place in it.
    kept = stored(sorted_rows.withColumn("__range", F.shiftright(place, 33).cast("int")).withColumn("__place", place.bitwiseAND(F.lit((1 << 33) - 1))), "ranges")
    before, starts = 0, []
    for row in kept.groupBy("__range").count().orderBy("__range").collect():
        starts.append((row["__range"], before))
        before += row["count"]
    base = kept.sparkSession.createDataFrame(starts, "__range int, __before long")
    numbered = kept.join(F.broadcast(base), "__range")
    return numbered.withColumn(name, F.col("__before") + F.col("__place") + 1).drop("__range", "__place", "__before")


def in_reading_order(rows: DataFrame) -> DataFrame:
    """Rows of :func:`joined_rows` numbered in reading order over all resources; equal places go by the schedules' ids."""
    names = READING_IDS
    return numbered_globally(rows, [F.col(name).asc_nulls_last() for name in names])


def changed_services(services: DataFrame, since: datetime | str) -> DataFrame:
    return services.filter(is_active(F.col("status")) & changed_since(F.col("updated_at"), since))


def deleted_ids(services: DataFrame, since: datetime | str) -> DataFrame:
    """Ids soft-deleted after the watermark."""
    gone = is_soft_deleted(F.col("status")) & changed_since(F.col("updated_at"), since)
    return services.filter(gone).select(F.col("id").alias("service_id"))


def reduced_to(catalog: SourceCatalog, services: DataFrame) -> SourceCatalog:
    """The catalog with the given services and only the rows their snapshot needs.

    The filters for activity and changes sit on ``services`` alone, so the other tables are reduced here by semi-joins, and
    nothing is rolled up for services, schedules or resources that give no row. Each is read from its source once and stored in the shared folder: what is built from them sees one state, repeats no semi-join,
    and its joins are planned from their real, small sizes.
    """
    services = stored(services.select(*SOURCE_COLUMNS["services"]), "services")
    shared_by = F.when(F.col("service_id").isNull(), F.col("resource_id"))
    first = broadcast_if_small(
        {
            "services": services.select(F.col("id").alias("service_id")).filter(F.col("service_id").isNotNull()).distinct(),
            "resources": services.select("resource_id").filter(F.col("resource_id").isNotNull()).distinct(),
        }
    )
    by_service = ("addresses_services", "instructions", "documents_services", "categories_services", "eligibilities_services")
    reduced = {name: catalog[name].join(first["services"], "service_id", "left_semi") for name in by_service}
    reduced["phones"] = catalog["phones"].join(first["resources"], "resource_id", "left_semi")
    reduced["resources"] = catalog["resources"].join(first["resources"], F.col("id") == F.col("resource_id"), "left_semi")
    # A schedule of its own counts for its service only, so it is not looked up by resource.
    reduced["schedules"] = keep_listed(catalog["schedules"], (F.col("service_id"), first["services"]), (shared_by, first["resources"]))
    kept = stored_together(reduced)

    second = broadcast_if_small(
        {
            "addresses": kept["addresses_services"].select("address_id").distinct(),
            "documents": kept["documents_services"].select("document_id").distinct(),
            "schedules": kept["schedules"].select(F.col("id").alias("schedule_id")).distinct(),
        }
    )
    kept |= stored_together(
        {
            "addresses": keep_listed(catalog["addresses"], (F.col("id"), second["addresses"]), (F.col("resource_id"), first["resources"])),
            "documents": catalog["documents"].join(second["documents"], F.col("id") == F.col("document_id"), "left_semi"),
            "schedule_days": catalog["schedule_days"].join(second["schedules"], "schedule_id", "left_semi"),
        }
    )
    return catalog.replacing(reduced=True, services=services, **kept)


ADDRESS_FIELDS = ("address_1", "address_2", "city", "state_province", "postal_code", "latitude", "longitude")


def linked_addresses(bridge: DataFrame, addresses: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Addresses linked to a service; a link to a missing address vanishes."""
    known = by_shuffle(addresses.select(F.col("id").alias("address_id"), *ADDRESS_FIELDS, F.lit(True).alias("__known")))
    found = lookup(bridge.select("service_id", "address_id"), known, "address_id", hot).filter("__known")
    return found.select("service_id", "address_id", F.col("address_id").alias("linked_address_id"), *ADDRESS_FIELDS)


def resource_addresses(addresses: DataFrame) -> DataFrame:
    return addresses.filter(F.col("resource_id").isNotNull()).select(
        "resource_id", F.col("id").alias("address_id"), F.lit(None).cast("bigint").alias("linked_address_id"), *ADDRESS_FIELDS
    )


def service_wide(services: DataFrame, programs: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    program = programs.select(
        F.col("id").alias("program_id"), F.col("name").alias("program_name"),
        F.col("alternate_name").alias("program_alternate_name"), F.col("description").alias("program_description"),
    )
    own = services.select(
        F.col("id").alias("service_id"), "resource_id", "program_id", F.col("name").alias("service_name"),
        F.col("alternate_name").alias("service_alternate_name"),
        F.col("short_description").alias("service_short_description"),
        F.col("long_description").alias("service_long_description"), "eligibility", "application_process",
        "required_documents", "fee", "wait_time", "interpretation_services",
        F.col("email").alias("service_email"), F.col("url").alias("service_url"), "verified_at", "updated_at",
    )
    return lookup(own, program, "program_id", hot)


def resource_wide(resources: DataFrame, phones: DataFrame, run: int | None = RUN) -> DataFrame:
    """Active resources with their phone text, one row each."""
    own = resources.filter(is_active(F.col("status"))).select(
        F.col("id").alias("resource_id"), F.col("name").alias("resource_name"),
        F.col("alternate_name").alias("resource_alternate_name"), "legal_status",
        F.col("short_description").alias("resource_short_description"),
        F.col("long_description").alias("resource_long_description"),
        F.col("email").alias("resource_email"), F.col("website").alias("resource_website"),
    )
    return own.join(by_shuffle(phone_text(phones, run)), "resource_id", "left")


def schedule_columns(rolled: DataFrame, owner: str) -> DataFrame:
    """Schedule columns named after their owner, ``service`` or ``resource``."""
    return rolled.select(
        f"{owner}_id",
        F.col("schedule_id").alias(f"{owner}_schedule_id"), F.col("hours_known").alias(f"{owner}_hours_known"),
        F.col("hours_text").alias(f"{owner}_hours_text"), F.col("schedule").alias(f"{owner}_schedule"),
    )


@dataclass(frozen=True)
class Packed:
    """Rows in a short form, one per service unless a branch is too large for that, and what makes them whole.

    ``unpack`` works row by row and keeps the rows' order; the rows of one service come by address.
    """

    rows: DataFrame
    unpack: Callable[[DataFrame], DataFrame]

    def whole(self) -> DataFrame:
        return self.unpack(self.rows)


def joined_rows(catalog: SourceCatalog, **options) -> DataFrame:
    """All inputs of a snapshot row side by side; the options are those of :func:`joined_parts`."""
    return joined_parts(catalog, **options).whole()


def joined_parts(
    catalog: SourceCatalog,
    *,
    taxonomy: Taxonomy | None = None,
    core_categories: IdRange = CORE_CATEGORIES,
    white_labels: Mapping[str, IdRange] = WHITE_LABELS,
    task_rows: int = TASK_ROWS,
    hot_limit: int = HOT_LIMIT,
    per_service: Callable[[DataFrame], DataFrame] = lambda wide: wide,
) -> Packed:
    """All inputs of a snapshot row side by side, before the output columns are chosen and the rows of a service multiply.

    ``per_service`` is applied to the wide service rows before addresses and schedules multiply them; what
    it drops is not carried through those joins.
    """
    if not catalog.reduced:
        catalog = reduced_to(catalog, catalog["services"].filter(is_active(F.col("status"))))
    services = catalog["services"].filter(is_active(F.col("status")))
    taxonomy = taxonomy or Taxonomy.default(services.sparkSession)
    keys = services.select(F.col("id").alias("service_id"), "resource_id")

    bridge = catalog["addresses_services"]
    homeless = unbridged(keys, bridge, "service_id")
    fallback = resource_addresses(catalog["addresses"])

    rolled = schedule_rollup(catalog["schedules"], catalog["schedule_days"])
    service_hours = schedule_columns(rolled.filter(F.col("service_id").isNotNull()), "service")
    resource_hours = schedule_columns(
        rolled.filter(F.col("service_id").isNull() & F.col("resource_id").isNotNull()), "resource"
    )

    schedules = catalog["schedules"]
    most = largest_groups(
        {
            "services": (keys, "resource_id"),
            "linked": (bridge, "service_id"),
            "fallback": (fallback, "resource_id"),
            "service_hours": (schedules, "service_id"),
            "resource_hours": (schedules.filter(F.col("service_id").isNull()), "resource_id"),
            "phones": (catalog["phones"], "resource_id"),
            "instructions": (catalog["instructions"], "service_id"),
            "documents": (catalog["documents_services"], "service_id"),
            "programs": (services, "program_id"),
            "addresses": (bridge, "address_id"),
        }
    )
    looked_up = find_hot(
        {
            name: lookup_hot(df, key, task_rows)
            for name, df, key in (("programs", services, "program_id"), ("addresses", bridge, "address_id"))
            if most[name] > task_rows
        },
        hot_limit,
    )
    programs = broadcast_if_small({"programs": catalog["programs"]}, HOT_LIMIT)["programs"]
    base = service_wide(services, programs, looked_up.get("programs"))
    linked = linked_addresses(bridge, catalog["addresses"], looked_up.get("addresses"))

    def run_of(name: str) -> int | None:
        """Text rollups go by runs of ids only where some group is large."""
        return RUN if most[name] > min(RUN, task_rows) else None

    profile = resource_wide(catalog["resources"], catalog["phones"], run_of("phones"))
    per_resource = key_counts(keys, "resource_id")
    fallback_counts = key_counts(fallback, "resource_id")
    hours_counts = key_counts(resource_hours, "resource_id")
    searches = {}
    if most["services"] > task_rows:
        once = profile.select("resource_id").distinct().withColumn("n", F.lit(1).cast("bigint"))
        searches["profile"] = grid_hot(per_resource, once, "resource_id", task_rows)
    if most["services"] * most["fallback"] > task_rows:
        searches["fallback"] = grid_hot(key_counts(homeless, "resource_id"), fallback_counts, "resource_id", task_rows)
    if most["services"] * most["resource_hours"] > task_rows:
        searches["hours"] = grid_hot(per_resource, hours_counts, "resource_id", task_rows)
    most_rows = [max(most["linked"], most["fallback"], 1), max(most["service_hours"], 1), max(most["resource_hours"], 1)]
    if most_rows[0] * most_rows[1] * most_rows[2] > task_rows:
        address_counts = key_counts(linked, "service_id").unionByName(
            homeless.join(by_shuffle(fallback_counts), "resource_id").select("service_id", "n")
        )
        shared_counts = keys.join(by_shuffle(hours_counts), "resource_id").select("service_id", "n")
        searches["fan_out"] = fan_hot(
            [address_counts, key_counts(service_hours, "service_id"), shared_counts], "service_id", task_rows
        )
    hot = find_hot(searches, hot_limit)

    wide = grid_join(base, profile, "resource_id", hot.get("profile"))
    families = {"": core_categories, **{f"{family}_": ids for family, ids in white_labels.items()}}
    rollups = [
        category_arrays(catalog["categories_services"], catalog["categories"], families),
        eligibility_arrays(catalog["eligibilities_services"], classify(catalog["eligibilities"], taxonomy)),
        instruction_text(catalog["instructions"], run_of("instructions")),
        document_text(catalog["documents_services"], catalog["documents"], run_of("documents")),
    ]
    for rollup in rollups:
        wide = wide.join(by_shuffle(rollup), "service_id", "left")
    wide = per_service(wide)

    address_rows = linked.unionByName(
        grid_join(homeless, fallback, "resource_id", hot.get("fallback")).drop("resource_id")
    )
    shared_hours = grid_join(keys, resource_hours, "resource_id", hot.get("hours")).drop("resource_id")
    branches = [address_rows, service_hours, shared_hours]
    if hot.get("fan_out") is not None:
        return Packed(fan_out(wide, "service_id", branches, hot["fan_out"]), lambda rows: rows)
    return Packed(*packed(wide, "service_id", branches, most_rows))


def row_key() -> Column:
    """A repeatable row key from the ids that make a row. A link that is stored twice gives two rows with one key."""
    parts = [
        F.coalesce(F.col(name).cast("string"), F.lit("-"))
        for name in ("service_id", "address_id", "service_schedule_id", "resource_schedule_id")
    ]
    return F.md5(F.concat_ws("/", *parts))


def build_snapshot(catalog: SourceCatalog, *, since: datetime | str | None = None, **options) -> DataFrame:
    """The snapshot rows, all of them or only those of services changed after ``since``.

    Only ``services.updated_at`` counts as a change; edits to addresses, phones or resources alone show up
    with the next full build.
    """
    return packed_snapshot(catalog, since=since, **options).whole()


def packed_snapshot(catalog: SourceCatalog, *, since: datetime | str | None = None, **options) -> Packed:
    """The rows of :func:`build_snapshot` before those of one service multiply, for what is laid out first and written last."""
    if since is not None:
        catalog = reduced_to(catalog, changed_services(catalog["services"], since))
    schema = snapshot_schema(options.get("white_labels", WHITE_LABELS))

    def per_service(wide: DataFrame) -> DataFrame:
        kept = [name for name in schema.names if name in wide.columns]
        return wide.select(*kept, *service_prose())

    computed = {
        "schedule": F.coalesce("service_schedule", "resource_schedule"),
        "embedding_text": row_prose(),
    }
    parts = joined_parts(catalog, per_service=per_service, **options)

    def unpack(rows: DataFrame) -> DataFrame:
        return parts.unpack(rows).select(
            row_key().alias(KEY_COLUMN),
            *[computed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema],
        )

    return Packed(parts.rows, unpack)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in schema order and type; a NULL in a required column fails the job."""

    def checked(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            message = F.lit(f"NULL in required column {field.name}")
            value = F.when(value.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(value)
        return value.alias(field.name)

    return df.select(*[checked(f) for f in schema])
