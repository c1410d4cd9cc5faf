"""Optional sentences: text that is present only when its value is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sentence(prefix: str, value: Column, suffix: str = ".") -> Column:
    """prefix + value + suffix, NULL when the value is NULL (``concat`` propagates NULL)."""
    return F.concat(F.lit(prefix), value, F.lit(suffix))


def fragment(prefix: str, value: Column, suffix: str = "") -> Column:
    """Like :func:`sentence` but empty text instead of NULL, for use inside a larger concat."""
    return F.coalesce(sentence(prefix, value, suffix), F.lit(""))


def listing(prefix: str, items: Column) -> Column:
    """A sentence listing an array; NULL items are skipped, NULL and empty arrays give NULL."""
    return F.when(F.size(items) > 0, sentence(prefix, F.array_join(items, ", ")))


def assemble(*pieces: Column) -> Column:
    """Join the pieces that are present with one space and trim spaces at both ends."""
    return F.trim(F.concat_ws(" ", *pieces))
