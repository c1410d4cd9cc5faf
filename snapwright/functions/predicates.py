"""Row predicates used when loading and when searching a snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ACTIVE = 1


def is_active(status: Column) -> Column:
    return status == ACTIVE


def is_soft_deleted(status: Column) -> Column:
    """A NULL status is neither active nor deleted."""
    return status != ACTIVE


def changed_since(updated_at: Column, watermark: datetime | str) -> Column:
    """Strictly later than the watermark; rows without a time never count as changed."""
    return updated_at > F.lit(watermark).cast("timestamp_ntz")


@dataclass(frozen=True)
class IdRange:
    """An inclusive id range with single holes and hole ranges."""

    low: int
    high: int
    without: Sequence[int] = ()
    without_ranges: Sequence[tuple[int, int]] = ()

    def holds(self, column: Column) -> Column:
        test = column.between(self.low, self.high)
        for value in self.without:
            test = test & (column != value)
        for low, high in self.without_ranges:
            test = test & ~column.between(low, high)
        return test


def in_box(latitude: Column, longitude: Column, south: float, north: float, west: float, east: float) -> Column:
    """Inside a latitude/longitude box, edges included."""
    return latitude.between(south, north) & longitude.between(west, east)


def open_at(schedule: Column, day: str, minute: int) -> Column:
    """Some interval of that day covers the minute, both ends included.

    An interval that closes past midnight (close before open) matches nothing.
    """
    return F.exists(
        schedule,
        lambda z: (z["day"] == day) & (z["open_mins"] <= minute) & (z["close_mins"] >= minute),
    )


SCHEDULE_JSON_TYPE = "array<struct<day:string,open_mins:int,close_mins:int>>"


def schedule_to_json(schedule: Column) -> Column:
    return F.to_json(schedule, {"ignoreNullFields": "false"})


def schedule_from_json(text: Column) -> Column:
    return F.from_json(text, SCHEDULE_JSON_TYPE)
