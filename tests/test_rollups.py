from pyspark.sql import functions as F

from snapwright.functions.predicates import IdRange
from snapwright.operators.rollups import (
    category_arrays,
    document_text,
    eligibility_arrays,
    instruction_text,
    ordered_text,
    phone_text,
    schedule_rollup,
)
from snapwright.operators.taxonomy import DIMENSIONS, RENAMES, Taxonomy, classify


def by_key(df, key):
    return {row[key]: row for row in df.collect()}


def test_fixed_taxonomy_sizes():
    assert sum(map(len, RENAMES.values())) == 26
    assert sum(map(len, DIMENSIONS.values())) == 88
    assert len({n for names in DIMENSIONS.values() for n in names}) == 88


def test_classify(spark):
    names = spark.createDataFrame(
        [(1, "Smoker"), (2, "smoker"), (3, None), (4, "Elderly"), (5, "Made Up"), (6, "Homeless")], "id long, name string"
    )
    got = by_key(classify(names, Taxonomy.default(spark)), "id")
    assert (got[1].resolved_name, got[1].dimension) == ("Substance Dependency", "health")
    assert (got[2].resolved_name, got[2].dimension) == ("smoker", "other")
    assert (got[3].resolved_name, got[3].dimension) == (None, "other")
    assert (got[4].resolved_name, got[4].dimension) == ("I am a Senior", "age")
    assert got[5].dimension == "other" and got[6].dimension == "housing"


def test_custom_taxonomy(spark):
    taxonomy = Taxonomy(
        spark.createDataFrame([("a", "A")], "raw string, canonical string"),
        spark.createDataFrame([("A", "letters")], "canonical string, dimension string"),
    )
    names = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    got = by_key(classify(names, taxonomy), "id")
    assert (got[1].resolved_name, got[1].dimension, got[2].dimension) == ("A", "letters", "other")


def test_phone_text_skips_missing_types(spark):
    phones = spark.createDataFrame(
        [(2, 1, "555-2", "Fax"), (1, 1, "555-1", "Main"), (3, 1, "555-3", None), (4, 2, "555-4", None)],
        "id long, resource_id long, number string, service_type string",
    )
    got = by_key(phone_text(phones), "resource_id")
    assert got[1].phone_text == "555-1 (Main), 555-2 (Fax)"
    assert got[2].phone_text is None


def test_runs_do_not_change_the_text(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 7 + 2).alias("k"), F.col("id").alias("i"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("t"), "id")).alias("t"),
    )
    wide = by_key(ordered_text(rows, "k", F.col("t"), F.col("i"), "|", "out"), "k")
    narrow = by_key(ordered_text(rows.repartition(7), "k", F.col("t"), F.col("i"), "|", "out", run=5), "k")
    plain = by_key(ordered_text(rows, "k", F.col("t"), F.col("i"), "|", "out", run=None), "k")
    assert {k: r.out for k, r in wide.items()} == {k: r.out for k, r in narrow.items()} == {
        k: r.out for k, r in plain.items()
    }
    assert wide[1].out == "|".join(f"t{i}" for i in range(0, 1000, 3) if i % 11 != 0)


def test_instruction_and_document_text(spark):
    instructions = spark.createDataFrame(
        [(3, 1, "c"), (1, 1, "a"), (2, 1, None)], "id long, service_id long, instruction string"
    )
    assert instruction_text(instructions).head().instructions_text == "a | c"
    documents = spark.createDataFrame(
        [(1, "u1", "guide"), (2, "u2", None), (3, None, "lost")], "id long, url string, description string"
    )
    links = spark.createDataFrame(
        [(1, 2), (1, 1), (1, 1), (1, 3), (2, 3), (3, 99)], "service_id long, document_id long"
    )
    got = by_key(document_text(links, documents), "service_id")
    assert {k: r.documents_text for k, r in got.items()} == {1: "u1 (guide), u1 (guide), u2"}


def test_schedule_rollup(spark):
    schedules = spark.createDataFrame(
        [(1, 10, None, True), (2, None, 20, None), (3, 11, None, True)],
        "id long, service_id long, resource_id long, hours_known boolean",
    )
    days = spark.createDataFrame(
        [
            (1, "Tuesday", 900, 1700), (1, "Monday", 1300, 1500), (1, "Monday", 800, 1200), (1, "Holiday", 0, 2400),
            (1, "Monday", None, 2530), (1, "Monday", 800, 1200), (2, "Friday", None, None),
        ],
        "schedule_id long, day string, opens_at int, closes_at int",
    )
    got = by_key(schedule_rollup(schedules, days), "schedule_id")
    assert set(got) == {1, 2}
    assert got[1].hours_text == (
        "Monday 08:00 AM - 12:00 PM, Monday 08:00 AM - 12:00 PM, Monday 01:00 PM - 03:00 PM,"
        " Tuesday 09:00 AM - 05:00 PM, Holiday 12:00 AM - 12:00 AM"
    )
    assert [tuple(z) for z in got[1].schedule] == [
        ("Monday", 480, 720), ("Monday", 480, 720), ("Monday", 780, 900), ("Monday", None, 1530),
        ("Tuesday", 540, 1020), ("Holiday", 0, 1440),
    ]
    assert got[2].hours_text is None and [tuple(z) for z in got[2].schedule] == [("Friday", None, None)]


def test_eligibility_arrays_keep_nulls_and_duplicates(spark):
    names = spark.createDataFrame([(1, "Men"), (2, None), (3, "Preschool")], "id long, name string")
    links = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 2), (2, 3), (3, 99)], "service_id long, eligibility_id long"
    )
    got = by_key(eligibility_arrays(links, classify(names, Taxonomy.default(spark))), "service_id")
    assert set(got) == {1, 2}
    assert got[1].eligibility_gender == ["Men", "Men"]
    assert got[1].eligibility_other == [None]
    assert got[1].eligibility_age is None
    assert got[1].eligibility_all == ["Men", "Men", None]
    assert got[2].eligibility_education == ["Preschool"] and got[2].eligibility_all == ["Preschool"]


def test_category_arrays(spark):
    categories = spark.createDataFrame(
        [(0, "z"), (5, "a"), (6, "a"), (7, None), (8, None), (202, "no"), (400, "out")], "id long, name string"
    )
    links = spark.createDataFrame(
        [(1, 6), (1, 5), (1, 5), (1, 7), (1, 8), (1, 202), (1, 0), (2, 202), (2, 400), (3, 5)],
        "service_id long, category_id long",
    )
    got = by_key(category_arrays(links, categories, {"x_": IdRange(0, 399, without=(202,)), "y_": IdRange(400, 500)}), "service_id")
    assert set(got) == {1, 2, 3}
    assert got[2].x_category_ids is None and got[2].y_category_names == ["out"] and got[1].y_category_ids is None
    assert got[1].x_category_ids == [0, 5, 6, 7, 8]
    assert got[1].x_category_names == ["a", "z", None]


def test_hot_key_is_rolled_up_from_counts(spark):
    """A key with a third of all links reaches the last aggregation as counted rows."""
    names = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "id long, name string")
    links = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("service_id"),
        (F.col("id") % 5).alias("eligibility_id"),
    )
    rolled = eligibility_arrays(links, classify(names, Taxonomy.default(spark)))
    hot = rolled.filter("service_id = 0").head().eligibility_all
    assert len(hot) == 10000 and hot == sorted(hot)
    assert rolled.count() == 20001
