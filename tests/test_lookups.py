"""Side tables for filtered reads: same rows as the plain filters, fewer rows read."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapwright.functions.arrays import contains_all, overlaps
from snapwright.functions.predicates import in_box, open_at
from snapwright.operators.lookups import ArrayPostings, GeoCurve, OpenSlots, curve_ranges
from snapwright.sources.storage import bloom_options

DAYS = ("Monday", "Thursday", "Sunday")


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(3)

    def one(i):
        values = None if i % 11 == 0 else [pick.choice(["a", "b", "c", None, f"v{i % 50}"]) for _ in range(pick.randint(0, 4))] + (["hot"] if i % 3 == 0 else [])
        hours = None if i % 13 == 0 else [(pick.choice((*DAYS, None)), *pick.choice([(540, 1020), (0, 1439), (945, 945), (1380, 60), (900, 944), (None, 30), (-30, 2000), (959, 960)])) for _ in range(pick.randint(0, 3))]
        place = (None, None) if i % 7 == 0 else (pick.uniform(-95, 95), pick.uniform(-185, 185))
        return (i, values, hours, *place)

    schema = "key long, tags array<string>, schedule array<struct<day:string,open_mins:int,close_mins:int>>, latitude double, longitude double"
    rows = [one(i) for i in range(1500)]
    return spark.createDataFrame(rows + rows[:5] + [(None, ["a"], [("Monday", 1, 2)], 1.0, 1.0)], schema).repartition(4).cache()


def keys(df):
    return sorted(r["key"] for r in df.filter("key is not null").select("key").distinct().collect())


def rows_read(df):
    """Rows that came out of the scans of an executed frame."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    found = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while "QueryStage" in leaf.getClass().getName():
            inner = leaf.plan()
            inner = inner.children().apply(0) if inner.children().size() else inner
            leaf = inner.collectLeaves().apply(0)
        found += leaf.metrics().apply("numOutputRows").value()
    return found


def test_postings(spark, rows, tmp_path):
    postings = ArrayPostings.build(rows, ["tags"], str(tmp_path / "p"), key="key")
    for values in (["a"], ["hot"], ["v7", "b"], ["none"], ["a", "hot"]):
        assert keys(postings.having_any("tags", values)) == keys(rows.filter(overlaps(F.col("tags"), values)))
        assert keys(postings.having_all("tags", values)) == keys(rows.filter(contains_all(F.col("tags"), values)))
    with pytest.raises(ValueError):
        postings.having_any("other", ["a"])
    with pytest.raises(ValueError):
        postings.having_all("tags", [])


def test_rows_of_equal_arrays_share_their_postings(spark, tmp_path):
    lists = [["a", "b"], ["b", "a", None, "b"], ["", "a"], ["a"], [], None, [None], ["1:a"]]
    many = spark.createDataFrame([(i, lists[i % 8], ["x"] if i % 8 == 3 else None) for i in range(4000)], "key long, tags array<string>, more array<string>").repartition(4)
    postings = ArrayPostings.build(many, ["tags", "more"], str(tmp_path / "p"), key="key")
    # Pairs of arrays that hold items: a and b; a and the empty text; a, and x beside it; 1:a.
    assert spark.read.parquet(str(tmp_path / "p" / "postings")).count() == 2 + 2 + 2 + 1
    for values in (["a"], ["b", "x"], [""], ["1:a"]):
        assert keys(postings.having_any("tags", values)) == keys(many.filter(overlaps(F.col("tags"), values)))
    assert keys(postings.having_all("tags", ["a", "b"])) == [i for i in range(4000) if i % 8 < 2]
    assert keys(postings.having_any("more", ["x"])) == [i for i in range(4000) if i % 8 == 3]


def test_postings_of_more_kinds_than_are_sent(spark, rows, tmp_path, monkeypatch):
    from snapwright.operators import lookups

    monkeypatch.setattr(lookups, "SENT_KINDS", 1)
    postings = ArrayPostings.build(rows, ["tags"], str(tmp_path / "p"), key="key")
    assert keys(postings.having_any("tags", ["a", "hot"])) == keys(rows.filter(overlaps(F.col("tags"), ["a", "hot"])))


def test_only_asked_postings_are_read(spark, tmp_path):
    many = spark.range(40_000).select(F.col("id").alias("key"), F.array(F.format_string("v%05d", F.col("id") % 20_000)).alias("tags"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        postings = ArrayPostings.build(many, ["tags"], str(tmp_path / "p"), key="key")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    asked = postings._of("tags", ["v00007"])
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(column" in plan and "v00007" in plan.split("PushedFilters")[1]
    assert asked.count() == 2 and rows_read(asked) <= 40_000 // 3


def test_slots(spark, rows, tmp_path):
    slots = OpenSlots.build(rows, str(tmp_path / "s"), key="key")
    for day in (*DAYS, "Friday"):
        for minute in (0, 59, 60, 540, 944, 945, 959, 960, 1020, 1021, 1439):
            assert keys(slots.open_at(day, minute)) == keys(rows.filter(open_at(F.col("schedule"), day, minute))), (day, minute)
    plan = slots.open_at("Thursday", 945)._jdf.queryExecution().executedPlan().toString()
    assert "slot" in plan.split("PartitionFilters")[1].split("]")[0]
    with pytest.raises(ValueError):
        slots.open_at("Monday", 5000)


@pytest.mark.parametrize("box", [(-10, 10, -20, 20), (37.2, 37.6, -122.5, -122.1), (-95, 95, -185, 185), (80, 95, 170, 185), (0, 0, 0, 0), (10, -10, 0, 1)])
def test_curve(spark, rows, tmp_path, box):
    curve = GeoCurve.build(rows, str(tmp_path / "c"), key="key")
    found = curve.in_box(*box)
    assert found.columns == rows.columns
    want = rows.filter(in_box(F.col("latitude"), F.col("longitude"), *box))
    assert sorted(r["key"] is None or r["key"] for r in found.collect()) == sorted(r["key"] is None or r["key"] for r in want.collect())


def test_a_box_skips_files(spark, rows, tmp_path):
    curve = GeoCurve.build(rows, str(tmp_path / "c"), key="key", files=16)
    found = curve.in_box(30, 45, -60, -40)
    assert found.count() == rows.filter(in_box(F.col("latitude"), F.col("longitude"), 30, 45, -60, -40)).count() > 0
    assert rows_read(found) <= rows.count() // 4


def test_ranges_of_the_curve_hold_the_box_and_little_else():
    ranges = curve_ranges(30, 45, -60, -40)
    assert ranges == sorted(ranges) and all(a <= b for a, b in ranges) and all(b + 1 < c for (_, b), (c, _) in zip(ranges, ranges[1:]))
    share = sum(b - a + 1 for a, b in ranges) / 2**32
    assert 15 / 180 * 20 / 360 <= share <= 3 * 15 / 180 * 20 / 360


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    # Ids in no order: every row group spans the whole range, so only a Bloom filter can tell.
    ids = spark.range(60_000).select("id", F.abs(F.xxhash64("id")).alias("other")).repartition(8)
    path = str(tmp_path / "b")
    ids.write.options(**bloom_options(["other"], 10_000)).parquet(path)
    wanted = ids.first()["other"]
    found = spark.read.parquet(path).filter(F.col("other") == wanted)
    assert found.count() == 1 and rows_read(found) <= 20_000


def test_published_rows_are_made_once(spark, tmp_path):
    from pyspark.sql import types as T

    from snapwright.sources.published import PublishedTable

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    schema = T.StructType().add("service_id", T.LongType()).add("resource_id", T.LongType())
    rows = spark.range(200).select(F.col("id").alias("service_id"), (F.col("id") % 9).alias("resource_id")).mapInArrow(count, schema)
    table = PublishedTable(spark, str(tmp_path / "t"), schema, "service_id", blooms=("resource_id",))
    commit = table.publish_all(rows)
    assert commit.report["total_rows"] == 200 and made.value == 200
    table.publish_changes(rows.filter("service_id < 20"), rows.select("service_id").limit(0))
    assert table.latest().report["total_rows"] == 20 and table.read().count() == 200


def test_late_rows_are_dropped_by_the_streams_own_state(spark, tmp_path):
    from small import EARLY, LATE, ROWS, small_catalog
    from snapwright.streaming.refresh import newest_so_far

    service = ROWS["services"][0]
    path, out = str(tmp_path / "feed"), []
    for batch in ([("new", LATE), ("older", EARLY)], [("late", EARLY)], [("same time", LATE), ("no time", None)], [("last", datetime(2024, 5, 1))]):
        rows = [{**service, "name": n, "updated_at": t} for n, t in batch]
        df = small_catalog(spark, services=rows)["services"]
        df.write.mode("append").parquet(path)
        feed = newest_so_far(spark.readStream.schema(df.schema).parquet(path))

        def keep(found, _):
            out.extend(r["name"] for r in found.collect())

        feed.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert out == ["new", "same time", "last"]


def test_variant_entries_equal_the_long_form(spark):
    from snapwright.operators.metadata import metadata_long, metadata_variant

    df = spark.sql(
        """select id as doc_id, 'x' as text, '' as empty, cast(null as string) as none, id % 2 = 0 as flag, cast(id as double) / 4 as num, timestamp_ntz '2024-01-02 03:04:05' as at,
        array(1, 2) as some, cast(array() as array<int>) as nothing, map('k', 1, 'l', cast(null as int)) as m, map(1, named_struct('a', 'b', 'c', id)) as of_structs,
        named_struct('deep', named_struct('er', 5, 'gone', cast(null as int))) as s from range(3)"""
    )
    rows = lambda f: sorted(map(str, f.collect()))
    assert rows(metadata_variant(df, ["doc_id"])) == rows(metadata_long(df, ["doc_id"]))


def test_a_map_of_many_keys_loses_none(spark):
    from snapwright.operators.metadata import metadata_variant

    wide = spark.range(2).select("id", F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(5000)), lambda i: F.struct(F.concat(F.lit("k"), i), i))).alias("m"))
    assert metadata_variant(wide, ["id"]).count() == 10_000


def test_numbers_over_the_whole_table(spark):
    from snapwright.plans.snapshot import numbered_globally

    df = spark.range(3000).select((F.pmod(F.xxhash64("id"), F.lit(7)) * F.when(F.col("id") % 3 > 0, 1)).alias("a"), "id").repartition(5)
    rows = numbered_globally(df, [F.col("a").asc_nulls_last(), F.col("id").desc()]).collect()
    want = sorted(df.collect(), key=lambda r: (r["a"] is None, r["a"] or 0, -r["id"]))
    assert [(r["a"], r["id"]) for r in sorted(rows, key=lambda r: r["row_number"])] == [(r["a"], r["id"]) for r in want]
    assert sorted(r["row_number"] for r in rows) == list(range(1, 3001))
    assert numbered_globally(df.limit(0), [F.col("id")]).count() == 0


def test_equal_schedules_share_their_slots(spark, tmp_path):
    hours = F.expr("array(named_struct('day', 'Monday', 'open_mins', 540, 'close_mins', 600 + cast(id % 2 as int) * 60))")
    many = spark.range(100).select(F.col("id").alias("key"), hours.alias("schedule"))
    slots = OpenSlots.build(many, str(tmp_path / "s"), key="key")
    # Two schedules, over the hours 9 and 10 and the hours 9 to 11.
    assert slots._table.count() == 5
    assert keys(slots.open_at("Monday", 555)) == list(range(100)) and keys(slots.open_at("Monday", 630)) == list(range(1, 100, 2))


def test_rows_are_made_once_for_their_numbers(spark):
    from snapwright.plans.snapshot import numbered_globally

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(300).mapInArrow(count, "id long")
    assert numbered_globally(rows, [F.col("id").desc()]).count() == 300 and made.value == 300


def test_many_kinds_are_not_sent_to_every_task(spark, rows, tmp_path, monkeypatch):
    from snapwright.operators import lookups

    postings = ArrayPostings.build(rows, ["tags"], str(tmp_path / "p"), key="key")
    slots = OpenSlots.build(rows, str(tmp_path / "s"), key="key")
    asked = lambda: (postings.having_any("tags", ["a"]), slots.open_at("Monday", 945))
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small = asked()
    monkeypatch.setattr(lookups, "SENT_KINDS", 2)
    for few, many in zip(small, asked(), strict=True):
        assert "BroadcastHashJoin" in plan_of(few) and "BroadcastHashJoin" not in plan_of(many)
        assert keys(few) == keys(many)
