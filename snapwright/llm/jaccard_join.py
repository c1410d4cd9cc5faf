"""Texts whose word shingles have a Jaccard similarity of a threshold or more, by an LSH forest of MinHash prefixes.

1. A text becomes its set of shingles (``size`` consecutive words; a text of fewer words is one shingle). Texts with the
   same set form a class; classes, not copies, are compared.
2. A class's MinHash signature is cut into trees. This is fixed banding, not a forest of
   tries: one prefix length for all trees, the longest with which two classes at the threshold share a prefix in some tree
   with the target recall, follows from threshold, trees and recall alone, and buckets are hashed. Shortening a prefix by
   the data could only stop at longer prefixes and find less. Classes under one prefix are compared by their signatures, and those that agree
   enough are linked as candidates by the fewest links that connect them.
3. Candidates that hang together meet in one place and are verified exactly on their shingles. A class learns how many
   documents it is linked to, and verified links are passed on, again by the fewest that connect them.
4. Connected verified links are the near-copy classes.

No pair is ever a row: a bucket or a component of m classes yields at most m - 1 links and m counts. Buckets and
components above ``block`` classes are cut into blocks, and every pair of blocks is one piece of work.

Words are runs outside ASCII punctuation, blanks and control characters, in lower case. NULL and wordless texts have
no shingles and are linked to nothing, not even to each other: they are classes of their own (class_id is their
doc_id). Repeated rows are copies. A NULL doc_id takes part, but never names a class that has a document with an id.
An empty table gives an empty result. Other columns are ignored (``distinct_documents`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwright.llm.common import dense_bounds, in_batches, prepare, staged, text_values, whole_text
from snapwright.llm.components import connected

#: Words of 64 bits, by text hash, that tell which documents may be wanted; so many rows at most are broadcast.
BUCKETS = 1 << 20
_SPLIT = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Forest:
    """Settings. ``recall`` is for pairs exactly at the threshold; more similar pairs are found more surely."""

    size: int = 5
    threshold: Fraction = Fraction(4, 5)
    trees: int = 16
    depth: int = 8
    recall: float = 0.9999
    block: int = 1024

    @property
    def prefix(self) -> int:
        """The longest prefix that reaches the target recall."""
        for length in range(self.depth, 0, -1):
            if 1 - (1 - float(self.threshold) ** length) ** self.trees >= self.recall:
                return length
        raise ValueError("more trees are needed for this recall")

    @property
    def agreeing(self) -> int:
        """Equal half bytes that a candidate's signature needs: five standard deviations below the threshold's mean.

        Half bytes of different values are equal by chance once in sixteen.
        """
        n, s = self.trees * self.depth, float(self.threshold)
        s += (1 - s) / 16
        return max(1, int(n * s - 5 * (n * s * (1 - s)) ** 0.5))


class _Words(dict):
    def __missing__(self, word: str) -> int:
        number = self[word] = xxhash.xxh64_intdigest(word)
        return number


_WORDS = _Words()


def word_numbers(text: str) -> np.ndarray:
    if len(_WORDS) > 200_000:
        _WORDS.clear()
    words = _SPLIT.split(text.lower())
    words = words[1:] if words and not words[0] else words
    words = words[:-1] if words and not words[-1] else words
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def _mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return numbers ^ (numbers >> np.uint64(29))


def shingles(text: str, size: int) -> np.ndarray:
    """Numbers of the distinct shingles of a text, ascending."""
    words = word_numbers(text)
    if len(words) == 0:
        return words
    n = max(1, len(words) - size + 1)
    out = np.full(n, len(words) if len(words) < size else size, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(min(size, len(words))):
            out = out * _ODD + words[at : at + n]
        return np.unique(_mixed(out))


_FACTORS: dict[int, np.ndarray] = {}


def _factors(n: int) -> np.ndarray:
    if n not in _FACTORS:
        _FACTORS[n] = np.random.default_rng(20240229).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return _FACTORS[n]


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """MinHash values (32 bits) of non-empty sets, one row each."""
    out = np.empty((len(sets), n), ">u4")
    if not sets:
        return out
    # Pieces of bounded length: a hash function runs over many sets at once, and long sets do not fill the memory.
    start = 0
    while start < len(sets):
        end, total = start, 0
        while end < len(sets) and (end == start or total + len(sets[end]) <= 1 << 18):
            total += len(sets[end])
            end += 1
        numbers = np.concatenate(sets[start:end])
        firsts = np.cumsum([0, *map(len, sets[start : end - 1])])
        work = np.empty_like(numbers)
        for at, factor in enumerate(_factors(n)):
            np.multiply(numbers, factor, out=work)
            out[start:end, at] = np.minimum.reduceat(work, firsts) >> np.uint64(32)
        start = end
    return out


def half_bytes(values: np.ndarray) -> np.ndarray:
    """The last half byte of every value, two to a byte."""
    low = np.append(values, np.zeros(len(values) % 2, values.dtype)).astype(np.uint8) & 15
    return (low[0::2] << 4) | low[1::2]


SIGNED = "doc_id long, text_hash long, cid binary, n int, sig binary, small binary"


def signed(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, text_hash, cid (digest of the shingle set; NULL without shingles), n (shingles), sig and small of every document.

    ``sig`` has four bytes of every MinHash value, which prefixes are cut from; ``small`` has the last half byte of
    each, which is enough to compare signatures.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("cid", pa.binary()), ("n", pa.int32()), ("sig", pa.binary()), ("small", pa.binary())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            sets = [shingles(t, forest.size) for t in text_values(batch.column("text"))]
            made = iter(signatures([s for s in sets if len(s)], forest.trees * forest.depth))
            for doc_id, text_hash, own in zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), sets, strict=True):
                if len(own):
                    values = next(made)
                    digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    yield doc_id, text_hash, digest, len(own), values.tobytes(), half_bytes(values).tobytes()
                else:
                    yield doc_id, text_hash, None, 0, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), schema, lambda row: 800)

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    return text.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, SIGNED)


class Links:
    """Union of members."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.parent[a] != self.parent[b]
        if not apart.any():
            return
        parent = self.parent
        for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            rx, ry = x, y
            while parent[rx] != rx:
                rx = parent[rx]
            while parent[ry] != ry:
                ry = parent[ry]
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up

    def stars(self) -> list[tuple[int, int]]:
        """The fewest links that connect what is connected: every member with the first of its part."""
        members = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return list(zip(self.parent[members].tolist(), members.tolist(), strict=True))


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``key`` (binary): many small groups at a time, or one large."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        held.append(batch)
        last = keys[-1].as_py()
        first_of_last = _first_equal(keys, last)
        if first_of_last == 0 and (len(held) == 1 or held[-2].column(key)[-1].as_py() == last):
            continue  # still inside one group
        done = [*held[:-1], batch.slice(0, first_of_last)]
        held = [batch.slice(first_of_last)]
        yield pa.Table.from_batches([b for b in done if b.num_rows])
    if held:
        yield pa.Table.from_batches(held)


def _first_equal(keys: pa.Array, value: bytes) -> int:
    low, high = 0, len(keys) - 1
    while low < high:
        middle = (low + high) // 2
        if keys[middle].as_py() == value:
            high = middle
        else:
            low = middle + 1
    return low


def split_hot(rows: DataFrame, key: str, sizes: DataFrame, block: int) -> DataFrame:
    """Rows with ``spot`` (binary), the place of work, and ``side``: groups above ``block`` rows become pairs of blocks.

    ``sizes`` has key and n of groups above the bound only. A row of a cut group goes to every pair that has its
    block; side is 0 or 1 for the two blocks of a pair, 2 where a block meets itself, and 2 for groups left whole.
    """
    whole = rows.withColumn("spot", F.col(key)).withColumn("side", F.lit(2))
    if sizes.isEmpty():
        return whole
    hot = sizes.select(F.col(key).alias("__key"), F.ceil(F.col("n") / block).cast("int").alias("__blocks"))
    small = sizes.count() <= 100_000
    hot = F.broadcast(hot) if small else hot
    cold = rows.join(hot, F.col(key) == F.col("__key"), "left_anti").withColumn("spot", F.col(key)).withColumn("side", F.lit(2))
    cut = rows.join(hot, F.col(key) == F.col("__key"))
    cut = cut.withColumn("__own", F.pmod(F.xxhash64("cid"), F.col("__blocks")).cast("int"))
    cut = cut.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    low, high = F.least("__own", "__other"), F.greatest("__own", "__other")
    spot = F.concat(F.col(key), F.unhex(F.lpad(F.hex(low), 8, "0")), F.unhex(F.lpad(F.hex(high), 8, "0")))
    side = F.when(low == high, 2).when(F.col("__own") == low, 0).otherwise(1)
    return cold.unionByName(cut.withColumn("spot", spot).withColumn("side", side).select(*cold.columns))


def candidate_links(classes: DataFrame, forest: Forest) -> DataFrame:
    """Links (a, b) between classes (cid, n, sig) that share a prefix in some tree and agree in their signatures."""
    width, kept = 4 * forest.depth, 4 * forest.prefix
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(forest.trees - 1)),
        lambda t: F.concat(F.unhex(F.lpad(F.hex(t), 4, "0")), F.substring("sig", t * width + 1, F.lit(width))),
    )
    in_trees = classes.select("cid", "n", "small", F.explode(parts).alias("part"))
    # The values behind the prefix sort a bucket; their half bytes are in ``small`` already and do as well.
    in_trees = in_trees.select(F.substring("part", 1, 2 + kept).alias("prefix"), "cid", "n", "small")
    # Buckets are counted by a hash of their prefix; the few that may be large are then counted by the prefix itself.
    heads = classes.select(F.explode(parts).alias("part")).select(F.substring("part", 1, 2 + kept).alias("prefix")).withColumn("hash", F.xxhash64("prefix"))
    large = staged(heads.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > forest.block).select("hash"), "large")
    if not large.isEmpty():
        large = heads.join(large, "hash", "left_semi")
    sizes = large.groupBy("prefix") if "prefix" in large.columns else heads.limit(0).groupBy("prefix")
    sizes = staged(sizes.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > forest.block), "buckets")
    work = split_hot(in_trees, "prefix", sizes, forest.block)
    least, ratio = forest.agreeing, float(forest.threshold)

    def compare(table: pa.Table) -> list[tuple[bytes, bytes]]:
        spots, cids = table.column("spot").to_numpy(zero_copy_only=False), table.column("cid").to_pylist()
        n = table.column("n").to_numpy()
        side = table.column("side").to_numpy()
        values = np.frombuffer(b"".join(table.column("small").to_pylist()), np.uint8).reshape(len(cids), -1)
        bounds = dense_bounds(spots)
        lengths = np.diff(bounds)
        left = np.repeat(bounds[1:], lengths) - np.arange(len(cids)) - 1  # rows of the group that follow
        links, at, step = Links(len(cids)), np.flatnonzero(left > 0), 1
        while len(at):
            for start in range(0, len(at), 1 << 16):
                a = at[start : start + (1 << 16)]
                b = a + step
                close = (np.minimum(n[a], n[b]) >= ratio * np.maximum(n[a], n[b]) - 1e-9) & ((side[a] == 2) | (side[a] != side[b]))
                a, b = a[close], b[close]
                if len(a):
                    differ = values[a] ^ values[b]
                    agree = ((differ & 0xF0) == 0).sum(1) + ((differ & 0x0F) == 0).sum(1) >= least
                    links.add(a[agree], b[agree])
            step += 1
            at = at[left[at] >= step]
        return [(cids[x], cids[y]) for x, y in links.stars()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        for table in grouped(batches, "spot"):
            keys = table.column("spot").to_numpy(zero_copy_only=False)
            same = keys[1:] == keys[:-1]
            several = np.zeros(len(keys), bool)
            several[1:] |= same
            several[:-1] |= same
            if several.any():
                yield from in_batches(compare(table.filter(pa.array(several))), schema, lambda row: 64)

    dealt = work.select("spot", "side", "cid", "n", "small").repartition("spot").sortWithinPartitions("spot", "small")
    return dealt.mapInArrow(run, "a binary, b binary")


def verify_sets(sets: list[np.ndarray], side: np.ndarray, copies: np.ndarray, threshold: Fraction, heavy: int = 24) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Exact links within one place of work: how many documents each member is linked to, and links that connect.

    Shingles of one member cannot be shared and are dropped. A shingle of few members adds its pairs one by one; the
    others become columns of 0/1 matrices whose products count what two members share.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    numbers, member = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    order = np.argsort(numbers, kind="stable")
    numbers, member = numbers[order], member[order]
    bounds = dense_bounds(numbers)
    df = np.diff(bounds)
    shared = np.zeros((m, m), np.float32)
    for count in range(2, min(heavy, m) + 1):
        starts = bounds[:-1][df == count]
        for at in range(0, len(starts), 1 << 14):
            rows = member[starts[at : at + (1 << 14), None] + np.arange(count)]
            a, b = np.triu_indices(count, 1)
            np.add.at(shared.reshape(-1), (rows[:, a] * m + rows[:, b]).ravel(), 1)
    starts, ends = bounds[:-1][df > heavy], bounds[1:][df > heavy]
    for at in range(0, len(starts), 4096):
        some, until = starts[at : at + 4096], ends[at : at + 4096]
        column = np.repeat(np.arange(len(some)), until - some)
        rows = np.concatenate([member[x:y] for x, y in zip(some.tolist(), until.tolist(), strict=True)])
        matrix = np.zeros((m, len(some)), np.float32)
        matrix[rows, column] = 1
        shared += np.triu(matrix @ matrix.T, 1)
    a, b = np.nonzero(shared)
    both = shared[a, b].astype(np.int64)
    linked = (both * (threshold.denominator + threshold.numerator) >= threshold.numerator * (sizes[a] + sizes[b])) & ((side[a] == 2) | (side[a] != side[b]))
    a, b = a[linked], b[linked]
    found = np.bincount(a, copies[b], m) + np.bincount(b, copies[a], m)
    links = Links(m)
    links.add(a, b)
    return found.astype(np.int64), links.stars()


FOUND = "cid binary, other binary, links long"


def verified(members: DataFrame, forest: Forest) -> DataFrame:
    """Rows (cid, other, links) from members (spot, side, cid, copies, text): counts have no other, links no count."""

    def one(table: pa.Table) -> Iterator[tuple]:
        cids = table.column("cid").to_pylist()
        if len(cids) < 2:
            return
        sets = [shingles(t, forest.size) for t in table.column("text").to_pylist()]
        found, kept = verify_sets(sets, table.column("side").to_numpy(), table.column("copies").to_numpy(), forest.threshold)
        yield from ((cids[at], None, int(found[at])) for at in np.flatnonzero(found).tolist())
        yield from ((cids[x], cids[y], 0) for x, y in kept)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for table in grouped(batches, "spot"):
            spots, cids = table.column("spot").to_pylist(), table.column("cid").to_pylist()
            # A repeated row gives its class twice; one of them is enough.
            fresh = [at == 0 or spots[at] != spots[at - 1] or cids[at] != cids[at - 1] for at in range(len(spots))]
            table = table.filter(pa.array(fresh))
            bounds = dense_bounds(table.column("spot").to_numpy(zero_copy_only=False))
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield from one(table.slice(start, end - start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), pa.schema([("cid", pa.binary()), ("other", pa.binary()), ("links", pa.int64())]), lambda row: 64)

    return members.select("spot", "side", "cid", "copies", "text").repartition("spot").sortWithinPartitions("spot", "cid").mapInArrow(run, FOUND)


def _word(text_hash: Column) -> Column:
    return F.pmod(text_hash, F.lit(BUCKETS))


def _bit(text_hash: Column) -> Column:
    return F.pmod(F.shiftright(text_hash, 20), F.lit(64)).cast("int")


def possibly(docs: DataFrame, hashes: DataFrame, how: str) -> DataFrame:
    """``docs`` whose text may have one of ``hashes`` (one column), or with ``left_anti`` those whose text has none of them.

    The hashes become bits, at most ``BUCKETS`` words of them, whatever their number: their broadcast is bounded. A few
    other texts share a bit, so an exact join has to follow.
    """
    one = F.col(hashes.columns[0])
    bits = hashes.groupBy(_word(one).alias("__word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(one))).alias("__bits"))
    own = F.xxhash64(whole_text("text"))
    return docs.join(F.broadcast(bits), (_word(own) == F.col("__word")) & (F.call_function("getbit", F.col("__bits"), _bit(own)) == 1), how)


def near_copies(docs: DataFrame, forest: Forest | None = None, *, kept: bool = False) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its near-copy class), copy_id (smallest id with the same
    shingle set) and n_links (other documents it is similar to, copies included).

    With ``kept``, also the first member of its near-copy class (the smallest id, NULL last, then the smallest text hash) as
    kept (doc_id, text_hash), NULL for texts without words.
    """
    forest = forest or Forest()
    prepare(docs.sparkSession)
    sig = staged(signed(docs, forest), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    classes = sig.filter(F.col("cid").isNotNull()).groupBy("cid").agg(
        first.alias("first"), F.count(F.lit(1)).alias("copies"), F.min("n").alias("n"), F.min("sig").alias("sig"), F.min("small").alias("small")
    )
    classes = staged(classes.select("cid", "first.doc_id", "first.text_hash", "copies", "n", "sig", "small"), "classes")
    candidates = connected(candidate_links(classes, forest))

    # Both joins keep one form at every size: neither side is bounded.
    parts = candidates.select(F.col("node").alias("cid"), F.col("label").alias("part")).hint("merge")
    placed = classes.select("cid", "doc_id", "text_hash", "copies").join(parts, "cid")
    placed = staged(placed, "candidates")
    sizes = staged(placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > forest.block), "parts")
    text = docs.select(F.col("doc_id").cast("long").alias("id"), whole_text("text").alias("text"))
    # Most documents are no candidates. They are left out before any text is shuffled.
    text = possibly(text, placed.select("text_hash"), "left_semi")
    found = placed.hint("merge").join(text, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("text_hash")))
    work = split_hot(found.select("cid", "part", "copies", "text"), "part", sizes, forest.block)
    found = staged(verified(work, forest), "verified")

    links = found.filter(F.col("other").isNotNull()).select(F.col("cid").alias("a"), F.col("other").alias("b"))
    labels = connected(links)
    counted = found.groupBy("cid").agg(F.sum("links").alias("links"))
    told = classes.select("cid", F.col("doc_id").alias("copy_id"), "copies", *(["text_hash"] if kept else []))
    least = [F.min("copy_id").alias("class_id")]
    if kept:
        least.append(F.min(F.struct(F.col("copy_id").isNull(), F.col("copy_id").alias("doc_id"), "text_hash")).alias("least"))
    named = labels.join(told.withColumnRenamed("cid", "node"), "node").groupBy("label").agg(*least)
    named = labels.join(named, "label").select(F.col("node").alias("cid"), "class_id", *(["least"] if kept else []))
    told = told.join(counted, "cid", "left").join(named, "cid", "left")
    own = F.struct(F.col("copy_id").alias("doc_id"), "text_hash")
    member = [F.when(F.col("least").isNull(), own).otherwise(F.struct("least.doc_id", "least.text_hash")).alias("kept")] if kept else []
    told = staged(told.select("cid", "copy_id", F.coalesce("class_id", "copy_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), *member), "told")
    out = sig.select("doc_id", "text_hash", "cid").join(told, "cid", "left")
    return out.select(
        "doc_id", "text_hash", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("copy_id", "doc_id").alias("copy_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), *(["kept"] if kept else [])
    )


def distinct_documents(docs: DataFrame, forest: Forest | None = None, of: Callable[..., DataFrame] = near_copies) -> DataFrame:
    """The documents with one of each near-copy class left: that with the smallest id, all columns kept.

    A NULL id comes after all others; of equal ids (or NULL ids) the text with the smallest hash stays, and of repeated rows
    of that id and text one. Documents without words all stay.
    """
    out = of(docs, forest, kept=True).filter(F.col("kept").isNotNull())
    first = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("text_hash") == F.col("kept.text_hash"))
    drop = staged(out.filter(~first).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "dropped")
    key = [docs["doc_id"].cast("long").eqNullSafe(F.col("__id")), F.xxhash64(whole_text("text")) == F.col("__hash")]
    again = out.filter(first & (F.col("n_links") > 0)).groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    again = staged(again.agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated")
    # Most documents stay as they are; only texts that may be listed are shuffled.
    listed = drop.select("__hash").union(again.select("__hash"))
    rest = possibly(docs, listed, "left_anti")
    kept = possibly(docs, listed, "left_semi").join(drop, key, "left_anti")
    if again.isEmpty():
        return rest.unionByName(kept)
    names = docs.columns
    repeated = kept.join(again, key).dropDuplicates(["__id", "__hash"]).select(*names)
    return rest.unionByName(kept.join(again, key, "left_anti")).unionByName(repeated)
