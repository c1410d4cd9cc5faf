from collections import Counter

import pytest
from pyspark.sql import functions as F

from snapwright.operators import joins
from snapwright.operators.joins import (
    broadcast_if_small,
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
    unbridged,
    without_keys,
)


def counted(df):
    columns = sorted(df.columns)
    return Counter(tuple(row[c] for c in columns) for row in df.collect())


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("a")
    )
    right = spark.range(200).select(
        F.when(F.col("id") % 4 == 0, F.lit(0)).otherwise(F.col("id") % 60).alias("k"), (F.col("id") % 150).alias("b")
    )
    return left, right


def test_largest_groups(spark, sides):
    left, right = sides
    empty = left.filter("false")
    got = largest_groups({"left": (left, "k"), "right": (right, "k"), "empty": (empty, "k")})
    assert got == {
        "left": max(Counter(r.k for r in left.collect()).values()),
        "right": max(Counter(r.k for r in right.collect()).values()),
        "empty": 0,
    }


@pytest.mark.parametrize("limit", [10_000, 0])
@pytest.mark.parametrize("task_rows", [50, 1000])
def test_grid_join_equals_plain_join(sides, task_rows, limit):
    left, right = sides
    request = grid_hot(key_counts(left, "k"), key_counts(right, "k"), "k", task_rows)
    assert request.filter("hot_key = 0").count() == 1
    hot = find_hot({"x": request}, limit)["x"]
    assert counted(grid_join(left, right, "k", hot)) == counted(left.join(right, "k"))


def test_grid_cells_are_bounded(sides):
    left, right = sides
    rows = grid_hot(key_counts(left, "k"), key_counts(right, "k"), "k", 100).collect()
    sizes = {r.k: r.n for r in key_counts(left, "k").collect()}
    others = {r.k: r.n for r in key_counts(right, "k").collect()}
    for row in rows:
        a, b = row.slices
        assert sizes[row.hot_key] / a * others[row.hot_key] / b <= 100
        assert 1 <= a <= sizes[row.hot_key] and 1 <= b <= others[row.hot_key]


@pytest.mark.parametrize("limit", [10_000, 0])
@pytest.mark.parametrize("task_rows", [3, 20, 500])
def test_fan_out_equals_plain_left_joins(spark, task_rows, limit):
    base = spark.range(12).select(F.col("id").alias("k"), F.concat(F.lit("base"), "id").alias("text"))
    one = spark.range(60).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 9).alias("k"), F.col("id").alias("x")
    )
    two = spark.range(20).select((F.col("id") % 5).alias("k"), (F.col("id") % 6).alias("y"))
    three = spark.range(9).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("z")).union(
        spark.range(100, 140).select(F.lit(11).cast("long").alias("k"), F.col("id").alias("z"))
    )
    branches = [one, two, three]
    request = fan_hot([key_counts(b, "k") for b in branches], "k", task_rows)
    hot = find_hot({"x": request}, limit)["x"]
    assert request.count() > 0
    plain = base.join(one, "k", "left").join(two, "k", "left").join(three, "k", "left")
    assert counted(fan_out(base, "k", branches, hot)) == counted(plain)


def test_fan_out_without_hot_keys_is_the_plain_join(spark):
    base = spark.range(3).select(F.col("id").alias("k"))
    branch = spark.createDataFrame([(1, "a"), (1, "b")], "k long, x string")
    assert counted(fan_out(base, "k", [branch], None)) == {(0, None): 1, (1, "a"): 1, (1, "b"): 1, (2, None): 1}


def test_find_hot_is_none_where_nothing_is_hot(spark, sides):
    left, right = sides
    request = grid_hot(key_counts(left, "k"), key_counts(right, "k"), "k", 10**9)
    assert find_hot({"x": request}) == {"x": None}
    assert find_hot({}) == {}


def test_keep_listed_and_small_lists(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 6), (None, 5), (9, 9)], "a long, b long")
    ids = broadcast_if_small({"a": spark.createDataFrame([(1,), (2,)], "a long"), "b": spark.createDataFrame([(5,)], "b long")})
    kept = keep_listed(df, (F.col("a"), ids["a"]), (F.col("b"), ids["b"]))
    assert counted(kept) == {(1, None): 1, (2, 5): 1, (None, 5): 1}
    large = broadcast_if_small({"a": spark.range(10).withColumnRenamed("id", "a")}, max_rows=3)["a"]
    assert counted(keep_listed(df, (F.col("a"), large))) == {(1, None): 1, (2, 5): 1, (3, 6): 1, (9, 9): 1}


def test_unbridged_and_without_keys(spark):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "service_id long")
    bridge = spark.createDataFrame([(1, 10), (2, -1), (None, 3)], "service_id long, address_id long")
    assert [r.service_id for r in unbridged(keys, bridge, "service_id").collect()] == [3]
    assert sorted(r.service_id for r in without_keys(keys, keys.filter("service_id = 2"), "service_id").collect()) == [1, 3]


def test_equal_rows_of_a_hot_key_are_spread(spark):
    rows = spark.range(20_000).select(F.lit(1).cast("bigint").alias("k"), F.lit("same").alias("v"))
    hot = spark.createDataFrame([(1, [20, 1])], "hot_key bigint, slices array<bigint>")
    cut = joins._sliced(rows, "k", hot, 2, lambda z: z[0], "slice", rows.columns)
    sizes = [r["count"] for r in cut.groupBy("slice").count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) == 20 and max(sizes) < 1300
    other = spark.createDataFrame([(1, "x"), (1, "y")], "k bigint, w string")
    assert grid_join(rows, other, "k", hot).count() == 40_000


@pytest.mark.parametrize("task_rows", [10, 1000])
def test_lookup_is_a_left_join(spark, sides, task_rows):
    rows = sides[0].withColumn("k", F.when(F.col("a") % 7 == 0, None).otherwise(F.col("k")))
    table = spark.range(0, 30).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("t"))
    hot = find_hot({"x": lookup_hot(rows, "k", task_rows)})["x"]
    assert (hot is not None) == (task_rows == 10)
    assert counted(lookup(rows, table, "k", hot)) == counted(rows.join(table, "k", "left"))


def test_keyless_rows_are_spread(spark):
    rows = spark.range(10_000).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("a"))
    spread = rows.select(joins._spread(F.col("k"), rows.columns).alias("s")).distinct().count()
    assert spread > 3000
    assert keep_listed(rows, (F.col("k"), spark.range(5))).isEmpty()


def test_packed_branches_multiply_only_when_unpacked(spark, monkeypatch):
    from snapwright.operators import joins

    base = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (None, "n")], "k long, v string")
    first = spark.createDataFrame([(1, 5), (1, 5), (1, None), (2, 7), (None, 9)], "k long, x long")
    second = spark.createDataFrame([(1, [1]), (1, None), (3, [2, 3]), (None, [4])], "k long, y array<int>")
    plain = joins.fan_out(base, "k", [first, second], None)
    for limit, kept in ((4096, 5), (2, 9)):
        monkeypatch.setattr(joins, "PACK_ROWS", limit)
        rows, unpack = joins.packed(base, "k", [first, second], [3, 2])
        assert rows.count() == kept and unpack(rows).columns == plain.columns
        assert sorted(map(str, unpack(rows).collect())) == sorted(map(str, plain.collect()))


def test_many_hot_keys_are_found_once(spark):
    from snapwright.operators.joins import find_hot, lookup_hot

    rows = spark.range(100).selectExpr("id % 10 as k")
    found = find_hot({"a": lookup_hot(rows, "k", 2)}, limit=3)
    assert found["a"].inputFiles() and found["a"].count() == 10


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_counted_sides_are_broadcast(spark):
    # To the optimizer all of these are small enough to be sent to the driver.
    rows = spark.range(100).select((F.col("id") % 20).alias("k"), F.col("id").alias("v"))
    other = spark.range(15).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    few = {"few": other.select("k")}
    small, large = broadcast_if_small(few)["few"], broadcast_if_small(few, max_rows=14)["few"]
    assert "BroadcastHashJoin" in plan_of(keep_listed(rows, (F.col("k"), small)))
    hot = find_hot({"x": lookup_hot(rows, "k", 2)}, limit=3)["x"]
    joined = [
        keep_listed(rows, (F.col("k"), large)), rows.join(large, "k", "left_semi"), without_keys(rows, other, "k"), unbridged(rows, other, "k"),
        grid_join(rows, other, "k", None), fan_out(rows, "k", [other], None), joins.packed(other, "k", [rows], [5])[0],
        joins.packed(other, "k", [rows], [joins.PACK_ROWS + 1])[0], rows.join(hot, F.col("k") == F.col("hot_key"), "left"),
        grid_hot(key_counts(rows, "k"), key_counts(other, "k"), "k", 1),
    ]
    for df in joined:
        assert "SortMergeJoin" in plan_of(df) and "Broadcast" not in plan_of(df)
    assert counted(joined[0]) == counted(keep_listed(rows, (F.col("k"), small)))
    assert joined[2].count() == 25 and joined[4].count() == 75 and joined[5].count() == 100
