"""Joins that stay balanced when one key holds a large share of the rows.

Every plan here has two forms. Key counts are taken first, by partial aggregation. Without hot keys the
join is the plain one. With hot keys each hot key is cut into slices: a row of the cut side goes to the
slice its content hashes to (so a retried task makes the same choice) and the other side is repeated
once per slice. Rows that are equal are counted first and then numbered, and the number is hashed with the content, so
they spread as well. Rows without a key never match and are spread over tasks. No row is dropped or capped in either form.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwright.sources.storage import stored_together

# Output rows of one key that one task may produce before the key is cut.
TASK_ROWS = 1_000_000
# Most hot keys that are fetched and broadcast; with more, the hot-key table is joined by shuffle.
HOT_LIMIT = 10_000
# Most rows of one id column that are broadcast. Several such lists are with the driver at once.
BROADCAST_ROWS = 250_000
# Most rows of one key that are gathered into an array.
PACK_ROWS = 4096

HOT_SCHEMA = "hot_key bigint, slices array<bigint>"


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a sort-merge join, for sides that nobody has counted.

    The optimizer would guess their size from that of the files, which well compressed columns outgrow many times once the
    driver gathers them to be broadcast.
    """
    return df.hint("merge")


def sent_if(small: bool, df: DataFrame) -> DataFrame:
    """``df`` as a side of a join: broadcast where a count has shown that it is ``small``, else shuffled."""
    return F.broadcast(df) if small else by_shuffle(df)


def broadcast_if_small(lists: dict[str, DataFrame], max_rows: int = BROADCAST_ROWS) -> dict[str, DataFrame]:
    """Id lists, counted in one job; those within the bound are broadcast, the others joined by shuffle."""
    counted = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in lists.items()
    ]
    sizes = {row["name"]: row["n"] for row in reduce(DataFrame.unionByName, counted).collect()}
    return {name: sent_if(sizes[name] <= max_rows, df) for name, df in lists.items()}


def keep_listed(df: DataFrame, *tests: tuple[Column, DataFrame]) -> DataFrame:
    """Rows for which some (column, list of distinct ids) test holds, in one pass over ``df``."""
    marked, found = df, F.lit(False)
    for i, (column, ids) in enumerate(tests):
        listed = ids.select(F.col(ids.columns[0]).alias(f"__id{i}"), F.lit(0).cast("bigint").alias(f"__on{i}"))
        marked = marked.withColumn("__spread", _spread(column, df.columns))
        marked = marked.join(listed, (column == F.col(f"__id{i}")) & (F.col("__spread") == F.col(f"__on{i}")), "left")
        found = found | F.col(f"__id{i}").isNotNull()
    return marked.filter(found).select(*df.columns)


def _spread(key: Column, columns: list[str]) -> Column:
    """0 where there is a key; else a number by content, which sends keyless rows to many tasks."""
    return F.when(key.isNull(), 1 + F.pmod(F.xxhash64(*columns), F.lit(4096))).otherwise(F.lit(0)).cast("bigint")


def lookup(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """Left join to a table with one row per key. Keyless rows are spread; a hot key's rows are cut and its row repeated."""
    own = rows.columns
    names = [*own, *[c for c in table.columns if c != key]]
    if hot is not None:
        rows = _sliced(rows, key, hot, 2, lambda slices: slices[0], "__spread", own)
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__slices")[0] - 1))
        table = _with_slices(table, key, hot, 2).withColumn("__spread", every).drop("__slices")
        rows = rows.withColumn("__spread", F.when(F.col(key).isNull(), _spread(F.col(key), own)).otherwise(F.col("__spread")))
    else:
        rows = rows.withColumn("__spread", _spread(F.col(key), own))
        table = table.withColumn("__spread", F.lit(0).cast("bigint"))
    return rows.join(table, [key, "__spread"], "left").select(*names)


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))


def largest_groups(groups: dict[str, tuple[DataFrame, str]]) -> dict[str, int]:
    """Rows of the largest key group of each (frame, key), in one job; 0 for an empty frame.

    The product of two such numbers bounds the rows any key can give in a join, so most hot-key searches
    are settled here.
    """
    each = [
        key_counts(df, key).agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, (df, key) in groups.items()
    ]
    return {row["name"]: row["n"] for row in reduce(DataFrame.unionByName, each).collect()}


def grid_hot(left_counts: DataFrame, right_counts: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Keys whose joined rows exceed ``task_rows``, with the slices to cut each side into."""
    both = left_counts.withColumnRenamed("n", "nl").join(by_shuffle(right_counts.withColumnRenamed("n", "nr")), key)
    edge = max(1, int(task_rows**0.5))
    small, large = F.least("nl", "nr"), F.greatest("nl", "nr")
    small_cut = F.ceil(small / edge)
    large_cut = F.least(large, F.ceil(small / small_cut * large / task_rows))
    left_is_small = F.col("nl") <= F.col("nr")
    return both.filter(F.col("nl").cast("double") * F.col("nr") > task_rows).select(
        F.col(key).cast("bigint").alias("hot_key"),
        F.array(
            F.when(left_is_small, small_cut).otherwise(large_cut),
            F.when(left_is_small, large_cut).otherwise(small_cut),
        ).alias("slices"),
    )


def lookup_hot(rows: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Keys with more than ``task_rows`` rows, with the slices to cut them into for a lookup."""
    counted = key_counts(rows, key).filter(F.col("n") > task_rows)
    return counted.select(F.col(key).cast("bigint").alias("hot_key"), F.array(F.ceil(F.col("n") / task_rows), F.lit(1).cast("bigint")).alias("slices"))


def fan_hot(counts: list[DataFrame], key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Keys whose product of branch counts exceeds ``task_rows``, with the slices per branch."""
    numbered = [c.withColumnRenamed("n", f"n{i}") for i, c in enumerate(counts)]
    joined = reduce(lambda a, b: a.join(b, key, "full"), numbered)
    sizes = [F.coalesce(F.col(f"n{i}"), F.lit(1)) for i in range(len(counts))]
    total = reduce(lambda a, b: a * b, [s.cast("double") for s in sizes])
    slices, rest = [], total / task_rows
    for size in sizes:
        cut = F.least(size, F.greatest(F.lit(1), F.ceil(rest)))
        slices.append(cut)
        rest = rest / cut
    return joined.filter(total > task_rows).select(
        F.col(key).cast("bigint").alias("hot_key"), F.array(*slices).alias("slices")
    )


def find_hot(requests: dict[str, DataFrame], limit: int = HOT_LIMIT) -> dict[str, DataFrame | None]:
    """Evaluate several hot-key tables in one job.

    Up to ``limit`` hot keys come back as broadcast tables (None where there are none). Beyond the limit
    the tables are stored, since every branch of a join reads them twice, and joined by shuffle.
    """
    if not requests:
        return {}
    tagged = [df.select(F.lit(name).alias("join"), "hot_key", "slices") for name, df in requests.items()]
    found = reduce(DataFrame.unionByName, tagged).limit(limit + 1).collect()
    if len(found) > limit:
        return {name: by_shuffle(df) for name, df in stored_together(requests).items()}
    result: dict[str, DataFrame | None] = {}
    for name, df in requests.items():
        rows = [(row["hot_key"], row["slices"]) for row in found if row["join"] == name]
        result[name] = F.broadcast(df.sparkSession.createDataFrame(rows, HOT_SCHEMA)) if rows else None
    return result


def _with_slices(df: DataFrame, key: str, hot: DataFrame, branches: int) -> DataFrame:
    one = F.array_repeat(F.lit(1).cast("bigint"), branches)
    return (
        df.join(hot, F.col(key) == F.col("hot_key"), "left")
        .withColumn("__slices", F.coalesce("slices", one))
        .drop("hot_key", "slices")
    )


def _sliced(df: DataFrame, key: str, hot: DataFrame, branches: int, slices_of, out: str, columns: list[str]) -> DataFrame:
    """``df`` with ``__slices`` and the slice ``out`` of each row; equal rows of a hot key are numbered and spread.

    Rows of other keys are not touched: they have one slice.
    """
    marked = df.join(hot, F.col(key) == F.col("hot_key"), "left")
    one = F.array_repeat(F.lit(1).cast("bigint"), branches)
    cold = marked.filter(F.col("hot_key").isNull()).drop("hot_key", "slices")
    cold = cold.withColumn("__slices", one).withColumn(out, F.lit(0).cast("bigint"))
    own = marked.filter(F.col("hot_key").isNotNull()).drop("hot_key").withColumnRenamed("slices", "__slices")
    counted = own.groupBy(*columns, "__slices").agg(F.count(F.lit(1)).alias("__n"))
    numbered = counted.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"))))
    cut = numbered.withColumn(out, F.pmod(F.xxhash64(*columns, "__copy"), slices_of(F.col("__slices"))))
    return cold.unionByName(cut.drop("__n", "__copy"))


def grid_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Inner join on ``key``; hot keys become a grid of (left slice, right slice) cells."""
    if hot is None:
        return left.join(by_shuffle(right), key)
    zero = F.lit(0).cast("bigint")
    cut_left = (
        _sliced(left, key, hot, 2, lambda z: z[0], "__a", left.columns)
        .withColumn("__b", F.explode(F.sequence(zero, F.col("__slices")[1] - 1)))
        .drop("__slices")
    )
    cut_right = (
        _sliced(right, key, hot, 2, lambda z: z[1], "__b", right.columns)
        .withColumn("__a", F.explode(F.sequence(zero, F.col("__slices")[0] - 1)))
        .drop("__slices")
    )
    return cut_left.join(by_shuffle(cut_right), [key, "__a", "__b"]).drop("__a", "__b")


def fan_out(base: DataFrame, key: str, branches: list[DataFrame], hot: DataFrame | None) -> DataFrame:
    """Left outer joins of ``base`` (one row per key) to several branches, rows multiplying.

    All joins share one partitioning of ``base``. A hot key is cut into cells, one per combination of
    branch slices; a cell meets one slice of each branch, so the combinations add up to the whole.
    """
    if hot is None:
        return reduce(lambda df, branch: df.join(by_shuffle(branch), key, "left"), branches, base)

    count = len(branches)
    zero = F.lit(0).cast("bigint")
    all_cells = F.aggregate("__slices", F.lit(1).cast("bigint"), lambda a, b: a * b)
    stride = [F.lit(1).cast("bigint")]
    for i in range(count - 1):
        stride.append(stride[-1] * F.col("__slices")[i])

    result = _with_slices(base, key, hot, count).withColumn("__cell", F.explode(F.sequence(zero, all_cells - 1)))
    for i, branch in enumerate(branches):
        own = F.col("__slices")[i]
        div = lambda a, b: F.call_function("div", a, b)
        sliced = (
            _sliced(branch, key, hot, count, lambda z, i=i: z[i], "__slice", branch.columns)
            .withColumn("__other", F.explode(F.sequence(zero, div(all_cells, own) - 1)))
            .withColumn(
                "__cell",
                div(F.col("__other"), stride[i]) * stride[i] * own
                + F.col("__slice") * stride[i]
                + F.col("__other") % stride[i],
            )
            .drop("__slices", "__slice", "__other")
            .withColumn("__hit", F.lit(True))
        )
        # A cut branch has rows for the key, so an empty slice must not add an unmatched row.
        result = (
            result.join(by_shuffle(sliced), [key, "__cell"], "left")
            .filter(F.col("__hit").isNotNull() | (own == 1))
            .drop("__hit")
        )
    return result.drop("__slices", "__cell")


def packed(base: DataFrame, key: str, branches: list[DataFrame], most: list[int]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Left outer joins of ``base`` to several branches whose rows multiply only when the returned function is applied.

    A branch's rows of one key travel as one sorted array beside the base row, so what is shuffled, sorted and stored
    grows with the branches' rows and not with their product. ``most`` bounds the rows of one key in each branch; a branch
    beyond ``PACK_ROWS`` is joined row by row.
    """
    gathered: list[tuple[str, list[str]]] = []
    for i, branch in enumerate(branches):
        if most[i] > PACK_ROWS:
            base = base.join(by_shuffle(branch), key, "left")
            continue
        names, array = [c for c in branch.columns if c != key], f"__branch{i}"
        listed = branch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*names))).alias(array))
        base = base.join(by_shuffle(listed), key, "left")
        gathered.append((array, names))

    def unpack(df: DataFrame) -> DataFrame:
        for array, names in gathered:
            own = [c for c in df.columns if c != array]
            df = df.select(*own, F.explode_outer(array).alias("__row")).select(*own, *[F.col("__row")[c].alias(c) for c in names])
        return df

    return base, unpack


def without_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed (a delete)."""
    return df.join(by_shuffle(keys), key, "left_anti")


def unbridged(keys: DataFrame, bridge: DataFrame, key: str) -> DataFrame:
    """Keys without any bridge row, dangling bridge rows included in the test."""
    return keys.join(by_shuffle(bridge.select(key).filter(F.col(key).isNotNull()).distinct()), key, "left_anti")
