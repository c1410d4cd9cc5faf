"""Array helpers with SQL-standard NULL behaviour (NULL items kept, NULL instead of empty)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_empty(array: Column) -> Column:
    return F.nullif(array, F.array())


def repeat_items(array: str, value: str, times: str, where: str = "true") -> Column:
    """Expand an array of structs: field ``value`` repeated by count field ``times``, in order.

    ``where`` is a condition on an item ``z`` that must hold.
    """
    kept = array if where == "true" else f"filter({array}, z -> {where})"
    return F.expr(f"flatten(transform({kept}, z -> array_repeat(z.{value}, cast(z.{times} as int))))")


def contains_value(array: Column, value) -> Column:
    return F.array_contains(array, value)


def overlaps(array: Column, values: list) -> Column:
    return F.arrays_overlap(array, F.array(*map(F.lit, values)))


def contains_all(array: Column, values: list) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, values)), array)) == 0
