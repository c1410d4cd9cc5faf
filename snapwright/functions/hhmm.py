"""Clock times stored as HHMM integers (930 is half past nine) and weekday names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names in calendar order; the position gives the rank 1-7.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by))


def hhmm_to_minutes(value: Column) -> Column:
    """Minutes since midnight; 975 means nine hours and 75 minutes, 2530 runs past midnight."""
    return (_div(value, 100) * 60 + value % 100).cast("int")


def hhmm_to_text(value: Column) -> Column:
    """``HH12:MI AM`` text of an HHMM integer, wrapping at 24 hours; NULL stays NULL."""
    minutes = hhmm_to_minutes(value)
    hour = F.pmod(_div(minutes, 60), F.lit(24))
    hour12 = F.pmod(hour + 11, F.lit(12)) + 1
    two = lambda number: F.lpad(number.cast("string"), 2, "0")
    half = F.when(hour >= 12, F.lit(" PM")).otherwise(F.lit(" AM"))
    return F.concat(two(hour12), F.lit(":"), two(F.pmod(minutes, F.lit(60))), half)


def weekday_rank(day: Column) -> Column:
    """1 for Monday to 7 for Sunday; NULL for anything else."""
    rank = F.array_position(F.array(*map(F.lit, WEEKDAYS)), day)
    return F.when(rank > 0, rank.cast("int"))


def iso_text(value: Column) -> Column:
    """ISO-8601 text of a timestamp: six fraction digits, none when the fraction is zero."""
    fraction = F.date_format(value, "SSSSSS")
    suffix = F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction))
    return F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), suffix)
