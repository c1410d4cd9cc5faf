"""How far the sources of each language differ, term by term and pair by pair.

Tasks take texts apart and count the terms of each group exactly, in how many documents they occur and how often; these counts go
to the terms, where they are summed by group, and a term stays if its language has it in ``min_docs`` documents.

Smoothed shares of terms a group lacks are all alike (p0), so a pair of sources needs only the terms that one of the two
has: value = V f(p0, q0), plus f(p, q0) - f(p0, q0) for what one has, which depends on p alone and is counted by distinct p,
plus a correction for terms both have. Sources of a language form blocks of ``block``; a task holds one pair of blocks and
a share of the terms, reads postings term by term and adds into one matrix, so no pair is ever a row before its sum is.

No vocabulary is ever whole in one place: a task sends what it has counted when it holds ``most_terms`` terms of groups.

NULL text, lang and source count as empty. Every row is a document, repeated ones too. A language without kept terms has
pairs of value 0 and no terms; empty tables give no rows. Other columns are ignored. Ties go by the item's bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwright.llm.common import dense_bounds, prepare, staged, whole_text

#: A-Z become small, what parts terms becomes a blank; all other bytes, those of longer characters among them, stay.
_KINDS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
_SPOT = ["lang", "one", "other", "shard"]
_SUMS = pa.schema([("lang", pa.string()), ("s", pa.int32()), ("t", pa.int32()), ("value", pa.int64())])
#: Postings that a task counts on, and elements of a numpy step.
SHARD_ROWS, STEP = 500_000, 1 << 20


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_KINDS).split()


def _counted(most_terms: int):
    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        langs, sources, terms, n, docs = [], [], [], [], []
        for (lang, source), (often, seen) in held.items():
            langs += [lang] * len(often)
            sources += [source] * len(often)
            terms += often.keys()
            n += often.values()
            docs += map(seen.__getitem__, often.keys())
        columns = [pa.array(c, t.type) for c, t in zip((langs, sources, terms, n, docs), _COUNTS, strict=True)]
        yield from pa.Table.from_arrays(columns, schema=_COUNTS).to_batches(max_chunksize=1 << 15)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                if not (terms := terms_of(text)):
                    continue
                often, seen = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(often)
                often.update(terms)
                seen.update(set(terms))
                size += len(often)
                if size >= most_terms:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    return run


def group_counts(docs: DataFrame, min_docs: int, most_terms: int) -> DataFrame:
    """lang, source, term, n, lang_n, first: occurrences of kept terms in a group and its language, one row of each term
    marked; ``docs`` has lang, source and text."""
    texts = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(_counted(most_terms), "lang string, source string, term binary, n long, docs long")
    # All rows of a term meet in one place, so that sums by group and by language need no further shuffle.
    sums = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = Window.partitionBy("lang", "term")
    whole = sums.select("*", F.sum("docs").over(rows).alias("lang_docs"), F.sum("n").over(rows).alias("lang_n"), (F.min("source").over(rows) == F.col("source")).alias("first"))
    return whole.filter(F.col("lang_docs") >= min_docs).select("lang", "source", F.col("term").cast("string").alias("term"), "n", "lang_n", "first")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exactly."""
    scale, below = F.lit(1_000_000_000), total + 2 * kept
    wide = F.call_function("div", (count + 2).cast("decimal(20,0)") * scale, below.cast("decimal(20,0)"))
    return F.when(count < 9_000_000_000, F.call_function("div", (count + 2) * scale, below)).otherwise(wide) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(docs: DataFrame, *, min_docs: int = 10, top_terms: int = 10, block: int = 256, most_terms: int = 1_000_000) -> DataFrame:
    """lang, source, part, item, value, rank: every pair of sources of a language, and each source's most excessive terms."""
    prepare(docs.sparkSession)
    texts = docs.select(whole_text("lang").alias("lang"), whole_text("source").alias("source"), whole_text("text").alias("text"))
    counts = staged(group_counts(texts, min_docs, most_terms), "counts")
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("first").alias("kept"))
    groups = texts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.fillna(0, ["total", "lang_total", "kept"]).withColumn("number", number)
    blocks = F.floor(F.max("number").over(Window.partitionBy("lang")) / block).cast("int")
    empty = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))).otherwise(1)
    groups = staged(groups.withColumn("last", blocks).withColumn("p0", empty), "groups")
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    pairs = _pairs(shares, groups, block, 1 + counts.count() // SHARD_ROWS)
    return _terms(shares, top_terms).unionByName(pairs)


def _terms(shares: DataFrame, top: int) -> DataFrame:
    both = shares.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("kept")))
    more = both.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    return _ranked(more).filter(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))))


def _pairs(shares: DataFrame, groups: DataFrame, block: int, shards: int) -> DataFrame:
    own = F.floor(F.col("number") / block).cast("int")
    with_other = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("with")
    spot = ["lang", F.least(own, "with").alias("one"), F.greatest(own, "with").alias("other")]
    postings = shares.select("*", with_other).select(*spot, F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"), "term", "number", "p")
    # Every task needs the share of lacking terms of all its sources; these rows come before the postings.
    bases = groups.select("*", with_other).select(*spot, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(None).cast("string").alias("term"), "number", F.col("p0").alias("p"))
    order = [*_SPOT, F.asc_nulls_first("term"), "number"]
    rows = bases.unionByName(postings).repartition(*_SPOT).sortWithinPartitions(*order)
    sums = rows.mapInArrow(_summed(block), "lang string, s int, t int, value long").groupBy("lang", "s", "t").agg(F.sum("value").alias("value"))
    both = sums.select("lang", "s", "t", "value").union(sums.select("lang", "t", "s", "value"))
    one = groups.select("lang", F.col("number").alias("s"), "source", "kept", F.col("p0").alias("p"))
    two = groups.select("lang", F.col("number").alias("t"), F.col("source").alias("item"), F.col("p0").alias("q"))
    named = both.join(one, ["lang", "s"]).join(two, ["lang", "t"])
    value = F.col("value") + F.col("kept") * distance(F.col("p"), F.col("q"))
    return _ranked(named.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")))


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    away = p - q
    return away * away // (p + q)


class _Spot:
    """The matrix of one pair of blocks for one share of the terms."""

    def __init__(self, key: tuple, block: int):
        self.key, self.block = key, block
        self.one, self.other = key[1] * block, key[2] * block
        self.base = {key[1]: np.zeros(block, np.int64), key[2]: np.zeros(block, np.int64)}
        self.sums = np.zeros((block, block), np.int64)

    def add_bases(self, number: np.ndarray, p: np.ndarray) -> None:
        for side, base in self.base.items():
            mine = number // self.block == side
            base[number[mine] % self.block] = p[mine]

    def add_postings(self, starts: np.ndarray, number: np.ndarray, p: np.ndarray) -> None:
        """Postings of whole terms; ``starts`` are the terms' bounds, numbers rise within a term."""
        side = number // self.block
        self._alone(number[side == self.key[1]] % self.block, p[side == self.key[1]], self.key[1], self.key[2], False)
        if self.one != self.other:
            self._alone(number[side == self.key[2]] % self.block, p[side == self.key[2]], self.key[2], self.key[1], True)
        lengths = np.diff(starts)
        first = np.add.reduceat((side == self.key[1]).astype(np.int64), starts[:-1])
        shape = first * (2 * self.block + 1) + lengths
        for kind in np.unique(shape):
            held, whole = int(kind // (2 * self.block + 1)), int(kind % (2 * self.block + 1))
            if self.one == self.other:
                a, b = np.triu_indices(whole, 1)
            else:
                a, b = (x.ravel() for x in np.meshgrid(np.arange(held), np.arange(held, whole), indexing="ij"))
            if not len(a):
                continue
            terms = starts[:-1][shape == kind]
            step = max(1, STEP // len(a))
            for at in range(0, len(terms), step):
                left, right = terms[at : at + step, None] + a, terms[at : at + step, None] + b
                self._together(number[left].ravel() % self.block, p[left].ravel(), number[right].ravel() % self.block, p[right].ravel())

    def _alone(self, s: np.ndarray, p: np.ndarray, mine: int, theirs: int, turned: bool) -> None:
        """What a term adds for all sources of the other block, as if none of them had it."""
        if not len(s):
            return
        keys, times = np.unique(s * (1 << 32) + p, return_counts=True)
        s, p = keys >> 32, keys & ((1 << 32) - 1)
        without = _apart(self.base[mine][:, None], np.maximum(self.base[theirs], 1)[None, :])
        for rows in (np.arange(at, min(at + 2048, len(keys))) for at in range(0, len(keys), 2048)):
            more = (_apart(p[rows, None], np.maximum(self.base[theirs], 1)[None, :]) - without[s[rows]]) * times[rows, None]
            edges = dense_bounds(s[rows])[:-1]
            summed, to = np.add.reduceat(more, edges, axis=0), s[rows][edges]
            if turned:
                self.sums[:, to] += summed.T
            else:
                self.sums[to] += summed

    def _together(self, s: np.ndarray, p: np.ndarray, t: np.ndarray, q: np.ndarray) -> None:
        p0, q0 = self.base[self.key[1]][s], self.base[self.key[2]][t]
        more = _apart(p, q) - _apart(p, q0) - _apart(p0, q) + _apart(p0, q0)
        # At most 2^20 whole numbers below 2^32 each: their sum is exact in a double.
        self.sums += np.bincount(s * self.block + t, more, self.block**2).reshape(self.block, self.block).astype(np.int64)

    def rows(self) -> pa.RecordBatch:
        real = (self.base[self.key[1]] > 0)[:, None] & (self.base[self.key[2]] > 0)[None, :]
        sums = self.sums
        if self.one == self.other:
            # What was added together lies above the diagonal only; what was added alone lies on both sides.
            sums, real = sums + sums.T, np.triu(real, 1)
        s, t = np.nonzero(real)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.key[0]] * len(s), pa.string()), pa.array((s + self.one).astype(np.int32)), pa.array((t + self.other).astype(np.int32)), pa.array(sums[s, t])], schema=_SUMS
        )


def _summed(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot, rest = None, None
        for batch in batches:
            table = pa.Table.from_batches([b for b in (rest, batch) if b is not None]).combine_chunks()
            if not table.num_rows:
                continue
            rows = table.to_batches()[0]
            # The last term of a batch may go on in the next one.
            ends = _changes(rows, [*_SPOT, "term"])
            cut = int(ends[-1]) if len(ends) else 0
            rest = rows.slice(cut)
            for done in _run(rows.slice(0, cut), spot, block):
                if isinstance(done, _Spot):
                    spot = done
                else:
                    yield done
        if rest is not None:
            for done in _run(rest, spot, block):
                if isinstance(done, _Spot):
                    spot = done
                else:
                    yield done
        if spot is not None:
            yield spot.rows()

    return run


def _changes(rows: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Places where a row differs from the one before it."""
    n = rows.num_rows
    differs = np.zeros(max(n - 1, 0), bool)
    for name in names:
        column = rows.column(name)
        if pa.types.is_string(column.type):
            column = pc.fill_null(pc.binary_join_element_wise(pa.scalar("="), column, pa.scalar("")), "")
        differs |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False) if n > 1 else False
    return np.flatnonzero(differs) + 1


def _run(rows: pa.RecordBatch, spot: _Spot | None, block: int) -> Iterator[pa.RecordBatch | _Spot]:
    """Adds rows to their spots; gives finished spots' rows, and each spot that is begun."""
    edges = [0, *_changes(rows, _SPOT).tolist(), rows.num_rows]
    for low, high in zip(edges, edges[1:], strict=False):
        if low == high:
            continue
        some = rows.slice(low, high - low)
        key = tuple(some.column(i)[0].as_py() for i in range(4))
        if spot is None or spot.key != key:
            if spot is not None:
                yield spot.rows()
            spot = _Spot(key, block)
            yield spot
        number, p = some.column("number").to_numpy().astype(np.int64), some.column("p").to_numpy().astype(np.int64)
        known = np.flatnonzero(some.column("term").is_valid().to_numpy(zero_copy_only=False))
        bases = int(known[0]) if len(known) else some.num_rows
        spot.add_bases(number[:bases], p[:bases])
        if bases < some.num_rows:
            starts = np.concatenate([[0], _changes(some.slice(bases), ["term"]), [some.num_rows - bases]]).astype(np.int64)
            spot.add_postings(starts, number[bases:], p[bases:])
