"""Many rows per key to one value per key.

Rules kept from the relational source: text rollups skip NULL items and give NULL when nothing is left;
array rollups keep NULL items and give NULL, not an empty array, when nothing matches.

Skew: repeated links are counted by (key, item) first, so a hot key reaches the last step as a few
counted rows. Text rollups ordered by an id build runs of at most ``RUN`` consecutive ids and then join
the runs, so no task sorts or holds a hot key's single rows; only the finished cell is ever whole. A caller
that knows every group to be within ``RUN`` rows passes ``run=None`` and saves that extra shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwright.functions.arrays import null_if_empty, repeat_items
from snapwright.functions.hhmm import hhmm_to_minutes, hhmm_to_text, weekday_rank
from snapwright.functions.predicates import IdRange
from snapwright.operators.joins import by_shuffle
from snapwright.operators.taxonomy import DIMENSIONS

RUN = 4096


def ordered_text(
    rows: DataFrame, key: str, item: Column, order: Column, separator: str, out: str, run: int | None = RUN
) -> DataFrame:
    """Items joined in ascending ``order`` (an integer id); NULL items are skipped."""
    sep = separator.replace("'", "''")
    if run is None:
        joined = F.expr(f"listagg(__item, '{sep}') within group (order by __order asc nulls last)").alias(out)
        return rows.select(key, item.alias("__item"), order.alias("__order")).groupBy(key).agg(joined)
    staged = rows.select(
        F.col(key), item.alias("__item"), order.alias("__order"),
        F.call_function("div", order, F.lit(run)).alias("__run"),
    )
    runs = staged.groupBy(key, "__run").agg(
        F.expr(f"listagg(__item, '{sep}') within group (order by __order asc nulls last)").alias("__text")
    )
    return runs.groupBy(key).agg(
        F.expr(f"listagg(__text, '{sep}') within group (order by __run asc nulls last)").alias(out)
    )


def phone_text(phones: DataFrame, run: int | None = RUN) -> DataFrame:
    """Per resource ``number (type), ...`` by phone id; a phone without a type is left out."""
    item = F.concat("number", F.lit(" ("), "service_type", F.lit(")"))
    return ordered_text(phones, "resource_id", item, F.col("id"), ", ", "phone_text", run)


def instruction_text(instructions: DataFrame, run: int | None = RUN) -> DataFrame:
    return ordered_text(
        instructions, "service_id", F.col("instruction"), F.col("id"), " | ", "instructions_text", run
    )


def document_text(links: DataFrame, documents: DataFrame, run: int | None = RUN) -> DataFrame:
    """Per service ``url (description), ...`` by document id; a repeated link repeats the item."""
    known = documents.filter(F.col("url").isNotNull()).select(
        F.col("id").alias("document_id"),
        F.concat("url", F.coalesce(F.concat(F.lit(" ("), "description", F.lit(")")), F.lit(""))).alias("__doc"),
    )
    item = F.col("__doc")
    if run is not None:
        links = links.groupBy("service_id", "document_id").agg(F.count("*").alias("__n"))
        item = F.array_join(F.array_repeat("__doc", F.col("__n").cast("int")), ", ")
    joined = links.join(by_shuffle(known), "document_id")
    return ordered_text(joined, "service_id", item, F.col("document_id"), ", ", "documents_text", run)


def schedule_rollup(schedules: DataFrame, schedule_days: DataFrame) -> DataFrame:
    """Per schedule: readable hours and an array of (day, open_mins, close_mins), Monday first.

    A schedule without days has no row. Unknown days come last; equal days go by opening, then closing.
    """
    counted = schedule_days.groupBy("schedule_id", "day", "opens_at", "closes_at").agg(F.count("*").alias("n"))
    day, opens, closes = F.col("day"), F.col("opens_at"), F.col("closes_at")
    rank = weekday_rank(day)
    # NULLs sort first in arrays, so each sort field is preceded by its own is-null flag.
    entry = F.struct(
        rank.isNull(), rank, opens.isNull(), opens, closes.isNull(), closes, day.isNull(), day,
        F.col("n").alias("n"),
        F.concat(day, F.lit(" "), hhmm_to_text(opens), F.lit(" - "), hhmm_to_text(closes)).alias("text"),
        F.struct(
            day.alias("day"), hhmm_to_minutes(opens).alias("open_mins"), hhmm_to_minutes(closes).alias("close_mins")
        ).alias("interval"),
    )
    days = counted.groupBy("schedule_id").agg(F.sort_array(F.collect_list(entry)).alias("days"))
    rolled = days.select(
        F.col("schedule_id").alias("id"),
        F.array_join(null_if_empty(repeat_items("days", "text", "n", "z.text is not null")), ", ").alias("hours_text"),
        repeat_items("days", "interval", "n").alias("schedule"),
    )
    return schedules.join(by_shuffle(rolled), "id").select(
        F.col("id").alias("schedule_id"), "service_id", "resource_id", "hours_known", "hours_text", "schedule"
    )


def eligibility_arrays(links: DataFrame, classified: DataFrame) -> DataFrame:
    """Per service one array of names per dimension plus one of all names.

    Repeated links repeat the name. Names are sorted, NULL names last.
    """
    counted = links.groupBy("service_id", "eligibility_id").agg(F.count("*").alias("n"))
    named = counted.join(classified.withColumnRenamed("id", "eligibility_id"), "eligibility_id")
    entry = F.struct(
        F.col("resolved_name").isNull().alias("no_name"), F.col("resolved_name").alias("name"), "dimension", "n"
    )
    grouped = named.groupBy("service_id").agg(F.sort_array(F.collect_list(entry)).alias("names"))

    def of(dimension: str) -> Column:
        return null_if_empty(repeat_items("names", "name", "n", f"z.dimension = '{dimension}'"))

    return grouped.select(
        "service_id",
        *[of(dimension).alias(f"eligibility_{dimension}") for dimension in DIMENSIONS],
        repeat_items("names", "name", "n").alias("eligibility_all"),
    )


def category_arrays(links: DataFrame, categories: DataFrame, families: Mapping[str, IdRange]) -> DataFrame:
    """Per service and family of ids: sorted distinct ids and, independently, sorted distinct names.

    ``families`` maps a column prefix to an id range; the ranges are read together in one pass. A family
    without a link is NULL; a NULL name is kept once, at the end.
    """

    def any_range(column: Column) -> Column:
        return reduce(lambda a, b: a | b, [ids.holds(column) for ids in families.values()])

    wanted = categories.filter(any_range(F.col("id"))).select(F.col("id").alias("category_id"), "name")
    distinct_links = links.filter(any_range(F.col("category_id"))).select("service_id", "category_id").distinct()
    gathered = [
        F.collect_list(F.when(ids.holds(F.col("category_id")), F.struct("category_id", "name"))).alias(f"{prefix}links")
        for prefix, ids in families.items()
    ]
    grouped = distinct_links.join(wanted, "category_id").groupBy("service_id").agg(*gathered)

    def distinct_sorted(field: str) -> Column:
        return null_if_empty(F.array_sort(F.array_distinct(F.col(field))))

    return grouped.select(
        "service_id",
        *[
            distinct_sorted(f"{prefix}links.{field}").alias(f"{prefix}{name}")
            for prefix in families
            for field, name in (("category_id", "category_ids"), ("name", "category_names"))
        ],
    )
