"""Side tables that make filtered reads small: postings of array values, a grid of opening hours, a curve over coordinates.

Each is a plain Parquet table laid out so that a filter reaches only the files or row groups that can match; the exact test
follows. They hold a row's key and are joined back by it, so a repeated key gives its rows back as often as they are stored (rows of one key have to be alike).
Hot values spread: all ranges go by the key as well.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwright.functions.predicates import in_box
from snapwright.operators.joins import sent_if


#: Folders that hold the rows of postings, by their arrays' digest, and the most digests (of arrays or schedules) that are sent to every task.
FOLDERS = 16
SENT_KINDS = 100_000


def _folder(kind: str) -> Column:
    return F.pmod(F.xxhash64(kind), F.lit(FOLDERS)).cast("int").alias("folder")


class ArrayPostings:
    """(column, value) to the keys of the rows whose array holds the value, one folder per column, sorted by value.

    Rows of equal arrays share their postings: these hold a digest of the arrays (the kind), and a second table the digest of each row's.
    So what is shuffled and sorted grows with the different arrays and not with the rows times their items.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, columns: Sequence[str], key_type: str):
        self._table = spark.read.schema("value string, kind binary, column string").parquet(f"{path}/postings")
        self._rows = spark.read.schema(f"kind binary, `{key}` {key_type}, folder int").parquet(f"{path}/rows")
        self._key = key
        self._columns = tuple(columns)

    @classmethod
    def build(cls, rows: DataFrame, columns: Sequence[str], path: str, *, key: str) -> ArrayPostings:
        """Postings of all ``columns``. NULL items match nothing and are left out, as are rows without items."""
        items = [F.array_sort(F.array_distinct(F.array_compact(F.coalesce(F.col(c).cast("array<string>"), F.array().cast("array<string>"))))) for c in columns]
        names = [f"__items{i}" for i in range(len(columns))]
        own = rows.filter(F.col(key).isNotNull()).select(key, *[c.alias(n) for c, n in zip(items, names, strict=True)])
        own = own.filter(reduce(Column.__or__, [F.size(n) > 0 for n in names]))
        # Every item behind its length and every array behind its size: equal digests carry equal arrays.
        told = [F.concat(F.size(n), F.lit("["), F.array_join(F.transform(n, lambda v: F.concat(F.octet_length(v), F.lit(":"), v)), "")) for n in names]
        own = own.withColumn("kind", F.substring(F.unhex(F.sha2(F.concat(*told), 256)), 1, 16))
        # Rows stay where they lie; each task writes its own part of every folder.
        own.select("kind", key, _folder("kind")).sortWithinPartitions("folder", "kind").write.partitionBy("folder").parquet(f"{path}/rows")
        kinds = own.select("kind", *names).distinct()

        def named(column: str, name: str) -> Column:
            return F.transform(name, lambda v: F.struct(F.lit(column).alias("column"), v.alias("value")))

        each = F.concat(*[named(c, n) for c, n in zip(columns, names, strict=True)])
        spread = kinds.select("kind", F.explode(each).alias("z")).select("z.column", "z.value", "kind").repartitionByRange("column", "value", "kind")
        spread.sortWithinPartitions("column", "value", "kind").write.partitionBy("column").parquet(f"{path}/postings")
        return cls(rows.sparkSession, path, key, columns, rows.schema[key].dataType.simpleString())

    def _asked(self, column: str, values: Sequence) -> DataFrame:
        if column not in self._columns:
            raise ValueError(f"no postings of {column}")
        if not values:
            raise ValueError("name at least one value")
        return self._table.filter((F.col("column") == column) & F.col("value").isin([str(v) for v in values]))

    def _of(self, column: str, values: Sequence) -> DataFrame:
        """Every row's postings."""
        return self._with_rows(self._asked(column, values))

    def _with_rows(self, kinds: DataFrame) -> DataFrame:
        """``kinds`` (kind, any others) with the keys of their rows. A few kinds are sent to the tasks, which open only their folders."""
        placed = sent_if(kinds.limit(SENT_KINDS + 1).count() <= SENT_KINDS, kinds.withColumn("folder", _folder("kind")))
        return placed.join(self._rows, ["folder", "kind"]).drop("folder", "kind")

    def keys(self, kinds: DataFrame) -> DataFrame:
        """Keys of the rows of ``kinds`` (kind, flags), each once; a flag holds if it holds for any row of the key."""
        flags = [c for c in kinds.columns if c != "kind"]
        found = self._with_rows(kinds)
        return found.groupBy(self._key).agg(*[F.bool_or(c).alias(c) for c in flags]) if flags else found.distinct()

    def having_any(self, column: str, values: Sequence, *, kinds: bool = False) -> DataFrame:
        """Keys of rows whose array holds one of ``values``: the union of their postings. With ``kinds``, the arrays' digests instead."""
        found = self._asked(column, values).select("kind").distinct()
        return found if kinds else self.keys(found)

    def having_all(self, column: str, values: Sequence, *, kinds: bool = False) -> DataFrame:
        """Keys of rows whose array holds each of ``values``: as many different matches as there are values. ``kinds`` as above."""
        found = self._asked(column, values).groupBy("kind").agg(F.count_distinct("value").alias("n"))
        found = found.filter(F.col("n") == len({str(v) for v in values})).select("kind")
        return found if kinds else self.keys(found)


SLOT = 60
LAST_MINUTE = 24 * 60 + SLOT - 1


class OpenSlots:
    """Every interval of a schedule under each slot of the week it touches, one folder per day and slot.

    Rows of equal schedules share these: slots hold a schedule's digest, and a second table the digest of each row's.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str):
        self._table = spark.read.schema("schedule binary, open_mins int, close_mins int, whole boolean, day string, slot int").parquet(f"{path}/slots")
        self._rows = spark.read.schema(f"schedule binary, `{key}` {key_type}").parquet(f"{path}/rows")
        self._key = key

    @classmethod
    def build(cls, rows: DataFrame, path: str, *, key: str, schedule: str = "schedule") -> OpenSlots:
        """``schedule`` holds intervals (day, open_mins, close_mins). Those that close before they open match nothing, as in ``open_at``."""
        # Equal digests carry equal schedules.
        digest = F.unhex(F.sha2(F.to_json(F.col(schedule), {"ignoreNullFields": "false"}), 256))
        asked = rows.filter(F.col(key).isNotNull() & F.col(schedule).isNotNull())
        asked.select(digest.alias("schedule"), key).write.parquet(f"{path}/rows")
        kinds = asked.select(digest.alias("schedule"), F.col(schedule).alias("__hours")).dropDuplicates(["schedule"])
        each = kinds.select("schedule", F.explode("__hours").alias("z")).select("schedule", "z.day", "z.open_mins", "z.close_mins")
        each = each.filter((F.col("open_mins") <= F.col("close_mins")) & (F.col("close_mins") >= 0) & (F.col("open_mins") <= LAST_MINUTE) & F.col("day").isNotNull())
        first, last = F.greatest("open_mins", F.lit(0)), F.least("close_mins", F.lit(LAST_MINUTE))
        covered = F.sequence(F.floor(first / SLOT).cast("int"), F.floor(last / SLOT).cast("int"))
        slots = each.withColumn("slot", F.explode(covered))
        whole = (F.col("open_mins") <= F.col("slot") * SLOT) & (F.col("close_mins") >= F.col("slot") * SLOT + SLOT - 1)
        spread = slots.withColumn("whole", whole).repartitionByRange("day", "slot", "schedule")
        spread.sortWithinPartitions("day", "slot", "schedule").write.partitionBy("day", "slot").parquet(f"{path}/slots")
        return cls(rows.sparkSession, path, key, rows.schema[key].dataType.simpleString())

    def open_at(self, day: str, minute: int) -> DataFrame:
        """Keys of rows open then. Only one slot is read, and only intervals that begin or end inside it are tested."""
        if not 0 <= minute <= LAST_MINUTE:
            raise ValueError("a minute of the day is wanted")
        there = self._table.filter((F.col("day") == day) & (F.col("slot") == minute // SLOT))
        there = there.filter(F.col("whole") | ((F.col("open_mins") <= minute) & (F.col("close_mins") >= minute))).select("schedule").distinct()
        there = sent_if(there.limit(SENT_KINDS + 1).count() <= SENT_KINDS, there)
        return there.join(self._rows, "schedule").select(self._key).distinct()


BITS = 16
_SIDE = 1 << BITS
#: Masks that spread the bits of a number to every second place.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _step(value: float, low: float, high: float) -> int:
    return min(max(int((value - low) / (high - low) * _SIDE // 1), 0), _SIDE - 1)


def _spread(cell: Column) -> Column:
    for shift, mask in _SPREAD:
        cell = cell.bitwiseOR(F.shiftleft(cell, shift)).bitwiseAND(F.lit(mask))
    return cell


def curve_key(latitude: Column, longitude: Column) -> Column:
    """Place on the Z-shaped curve through a grid of 2^16 by 2^16 cells; NULL where a coordinate is."""

    def cell(value: Column, low: float, high: float) -> Column:
        scaled = F.floor((value.cast("double") - F.lit(low)) / F.lit(high - low) * F.lit(float(_SIDE))).cast("long")
        return F.when(value.isNotNull(), F.greatest(F.least(scaled, F.lit(_SIDE - 1)), F.lit(0)).cast("long"))

    return F.shiftleft(_spread(cell(latitude, -90.0, 90.0)), 1).bitwiseOR(_spread(cell(longitude, -180.0, 180.0)))


def curve_ranges(south: float, north: float, west: float, east: float, most: int = 32) -> list[tuple[int, int]]:
    """At most about ``most`` stretches of the curve that together hold every point of the box.

    Squares of cells that lie partly inside are quartered, the largest first, until there are enough.
    """
    box = _step(south, -90, 90), _step(north, -90, 90), _step(west, -180, 180), _step(east, -180, 180)
    if box[0] > box[1] or box[2] > box[3]:
        return []
    waiting, inside = [(-BITS, 0, 0, 0)], []
    while waiting and len(waiting) + len(inside) < most:
        level, y, x, start = heapq.heappop(waiting)
        size = 1 << -level
        if box[0] <= y and y + size - 1 <= box[1] and box[2] <= x and x + size - 1 <= box[3]:
            inside.append((start, start + size * size - 1))
            continue
        half = size >> 1
        for quarter in range(4):
            low_y, low_x = y + half * (quarter >> 1), x + half * (quarter & 1)
            if low_y <= box[1] and low_y + half - 1 >= box[0] and low_x <= box[3] and low_x + half - 1 >= box[2]:
                heapq.heappush(waiting, (level + 1, low_y, low_x, start + quarter * half * half))
    inside += [(start, start + (1 << -2 * level) - 1) for level, _, _, start in waiting]
    merged: list[tuple[int, int]] = []
    for low, high in sorted(inside):
        if merged and merged[-1][1] + 1 == low:
            merged[-1] = merged[-1][0], high
        else:
            merged.append((low, high))
    return merged


class GeoCurve:
    """Rows laid out along the curve, so that a box is a few stretches of it."""

    def __init__(self, table: DataFrame, latitude: str, longitude: str):
        self.table, self._latitude, self._longitude = table, latitude, longitude

    @classmethod
    def build(cls, rows: DataFrame, path: str, *, key: str, files: int | None = None, latitude: str = "latitude", longitude: str = "longitude") -> GeoCurve:
        placed = rows.withColumn("curve", curve_key(F.col(latitude), F.col(longitude)))
        spread = placed.repartitionByRange(*([files] if files else []), "curve", key)
        spread.sortWithinPartitions("curve").write.parquet(path)
        return cls(rows.sparkSession.read.schema(placed.schema).parquet(path), latitude, longitude)

    def in_box(self, south: float, north: float, west: float, east: float) -> DataFrame:
        """Rows inside the box, edges included, with their own columns."""
        place, near = F.col("curve"), F.lit(False)
        for low, high in curve_ranges(south, north, west, east):
            near = near | place.between(low, high)
        inside = in_box(F.col(self._latitude), F.col(self._longitude), south, north, west, east)
        return self.table.filter(near).filter(inside).drop("curve")
