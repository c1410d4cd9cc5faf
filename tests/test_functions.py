from datetime import datetime

from pyspark.sql import functions as F

from snapwright.functions.hhmm import hhmm_to_minutes, hhmm_to_text, iso_text, weekday_rank
from snapwright.functions.predicates import IdRange, open_at, schedule_from_json, schedule_to_json
from snapwright.functions.text import assemble, fragment, listing, sentence
from snapwright.functions.vectors import cosine


def one(spark, column, value=None, kind="int"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("x")).head()["x"]


def test_clock_text(spark):
    expected = {
        0: "12:00 AM", 900: "09:00 AM", 975: "10:15 AM", 1200: "12:00 PM", 1730: "05:30 PM",
        2359: "11:59 PM", 2400: "12:00 AM", 2530: "01:30 AM", None: None,
    }
    for value, text in expected.items():
        assert one(spark, hhmm_to_text(F.col("v")), value) == text


def test_minutes(spark):
    for value, minutes in {0: 0, 930: 570, 975: 615, 2530: 1530, None: None}.items():
        assert one(spark, hhmm_to_minutes(F.col("v")), value) == minutes


def test_weekday_rank(spark):
    for day, rank in {"Monday": 1, "Sunday": 7, "monday": None, "Holiday": None, None: None}.items():
        assert one(spark, weekday_rank(F.col("v")), day, "string") == rank


def test_iso_text(spark):
    assert one(spark, iso_text(F.col("v")), datetime(2024, 3, 1, 9, 5, 0), "timestamp_ntz") == "2024-03-01T09:05:00"
    moment = datetime(2024, 3, 1, 9, 5, 0, 120)
    assert one(spark, iso_text(F.col("v")), moment, "timestamp_ntz") == moment.isoformat()


def test_optional_text(spark):
    assert one(spark, sentence("Fee: ", F.col("v")), "none", "string") == "Fee: none."
    assert one(spark, sentence("Fee: ", F.col("v")), None, "string") is None
    assert one(spark, fragment(" (", F.col("v"), ")"), None, "string") == ""
    assert one(spark, assemble(F.lit("  a"), F.col("v"), F.lit("b ")), None, "string") == "a b"


def test_listing_null_rules(spark):
    text = listing("Tags: ", F.col("v"))
    kind = "array<string>"
    assert one(spark, text, ["a", None, "b"], kind) == "Tags: a, b."
    assert one(spark, text, [None], kind) == "Tags: ."
    assert one(spark, text, [], kind) is None
    assert one(spark, text, None, kind) is None


def test_id_range(spark):
    ids = IdRange(0, 20, without=(7,), without_ranges=((10, 12),))
    kept = [r.id for r in spark.range(-1, 23).filter(ids.holds(F.col("id"))).collect()]
    assert kept == [i for i in range(0, 21) if i not in (7, 10, 11, 12)]


def test_open_at_and_json(spark):
    kind = "array<struct<day:string,open_mins:int,close_mins:int>>"
    day = [("Monday", 540, 1020), ("Tuesday", 1200, 120), (None, 0, 1440), ("Friday", None, 600)]
    for when, minute, expected in [
        ("Monday", 540, True), ("Monday", 1020, True), ("Monday", 1021, False), ("Tuesday", 60, False),
    ]:
        assert bool(one(spark, open_at(F.col("v"), when, minute), day, kind)) is expected
    text = one(spark, schedule_to_json(F.col("v")), day, kind)
    assert '"open_mins":null' in text
    assert [tuple(z) for z in one(spark, schedule_from_json(F.col("v")), text, "string")] == day


def test_cosine_of_zero_vector(spark):
    other = F.array(F.lit(1.0), F.lit(0.0))
    assert one(spark, cosine(F.col("v"), other), [0.0, 0.0], "array<float>") is None
    assert abs(one(spark, cosine(F.col("v"), other), [3.0, 4.0], "array<float>") - 0.6) < 1e-12
