"""Search over a published snapshot: nearest to a text or vector, inside a box, open at a time, for given groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwright.functions.arrays import contains_all, overlaps
from snapwright.functions.predicates import in_box, open_at
from snapwright.operators.embed import EncoderFactory, embed
from snapwright.operators.joins import BROADCAST_ROWS, sent_if
from snapwright.operators.retrieve import nearest


@dataclass(frozen=True)
class Wanted:
    """What a row must satisfy. Every part is optional; those given must all hold."""

    box: tuple[float, float, float, float] | None = None
    """Lowest and highest latitude, then longitude."""
    open_on: tuple[str, int] | None = None
    """Day and minute of the day."""
    any_of: Mapping[str, Sequence[str]] = field(default_factory=dict)
    """Array column and values of which the row has at least one."""
    all_of: Mapping[str, Sequence[str]] = field(default_factory=dict)
    """Array column and values that the row has all of."""
    service_ids: Sequence[int] = ()
    resource_ids: Sequence[int] = ()

    def tests(self) -> list[Column]:
        found = []
        if self.service_ids:
            found.append(F.col("service_id").isin(list(self.service_ids)))
        if self.resource_ids:
            found.append(F.col("resource_id").isin(list(self.resource_ids)))
        if self.box:
            found.append(in_box(F.col("latitude"), F.col("longitude"), *self.box))
        if self.open_on:
            found.append(open_at(F.col("schedule"), *self.open_on))
        found += [overlaps(F.col(name), list(values)) for name, values in self.any_of.items()]
        return found + [contains_all(F.col(name), list(values)) for name, values in self.all_of.items()]


def matching(rows: DataFrame, wanted: Wanted) -> DataFrame:
    """Rows that satisfy all tests; those on stored columns reach the scan."""
    for test in wanted.tests():
        rows = rows.filter(test)
    return rows


def search(
    rows: DataFrame, queries: DataFrame, k: int = 5, wanted: Wanted | None = None, *,
    factory: EncoderFactory | None = None, dimension: int | None = None, key: str = "snapshot_key",
) -> DataFrame:
    """The k rows nearest to each query among those that match, with their columns, similarity and rank.

    ``queries`` has query_id and either query_vector or, with an encoder ``factory``, text.
    """
    rows = matching(rows, wanted or Wanted())
    if factory is not None:
        queries = embed(queries.select("query_id", "text"), "text", factory, dimension=dimension, out="query_vector")
    hits = nearest(rows, queries, k, vec_id=key)
    # At most k hits per query: few enough to go to the rows rather than shuffle those.
    hits = sent_if(queries.count() * k <= BROADCAST_ROWS, hits)
    return hits.withColumnRenamed("vec_id", key).join(rows.drop("embedding"), key)
