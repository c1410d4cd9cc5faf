"""Phrases of two to four words that belong together, by stripes.

A stripe is an associative counter: a prefix of one to three words, and for each word that follows it how often. Tasks
build stripes of their texts locally and send them by prefix; merging adds them element by element. One merged structure
then holds all that is asked for: its entries are the extended phrases, its total is the count of the prefix, and its
largest entry is what may subsume the prefix. Counts of phrases without their first word, which subsume from the left,
are the same entries grouped by suffix.

Words are counted first, then stripes of one, two and three words. A phrase can reach ``least`` only if both phrases of one
word less inside it do, so each pass extends frequent prefixes by words that end a frequent phrase; all else goes to one
entry of the stripe (the empty word), which keeps the totals whole. Tasks learn what is frequent from a bitmap of hashes in
the shared folder, of at most ``most_bits`` bits: it may let a rare phrase through, never keep a frequent one out, and all
counts are of the words themselves. The stripe of a prefix with more than 1/10,000 of all words (there are at most 10,000)
is cut into 64 slices by the following word, so that no task merges a whole hot stripe.

NULL text counts as empty, NULL lang as ``und``. Rows count as often as they occur. Texts of any length are read whole, in
pieces cut at white space. Empty tables and texts without words give no rows. Other columns are ignored. Ties go by
score, count and then the phrase's bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapwright.llm.common import dense_bounds, open_folder, prepare, scratch, staged

#: Bytes that end a piece; inside a piece, blanks and tabs part words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"

#: Bytes of text a task gathers before it sends stripes, and bytes it takes apart at once.
FLUSH_BYTES, TEXT_STEP = 24 << 20, 8 << 20
HEAVY_SHARE, SLICES = 10_000, 64

_COUNTS = pa.schema([("lang", pa.binary()), ("phrase", pa.binary()), ("a", pa.int64())])
#: A stripe travels as two lists in binary form: its words, each with a blank behind it, and their counts.
_STRIPES = pa.schema([("lang", pa.binary()), ("prefix", pa.binary()), ("slice", pa.int32()), ("nexts", pa.binary()), ("counts", pa.binary())])
_MERGED = pa.schema([("lang", pa.binary()), ("prefix", pa.binary()), ("total", pa.int64()), ("nexts", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])

_WORD, _BLANK, _MARK = 0, 1, 2
_KINDS = bytes(_MARK if b in PIECE_ENDS else _BLANK if b in b" \t" else _WORD for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Byte strings that lie one after another in ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def words_of(text: bytes) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Lower-cased words of a text, some at a time, and the number of each one's piece."""
    at = pieces = 0
    while at < len(text):
        end = at + TEXT_STEP
        if end < len(text):
            # Cut where a word ends; a word that is longer than a step is taken whole.
            while end < len(text) and _KINDS[text[end]] == _WORD:
                end += 1
        part = text[at:end]
        kind = np.frombuffer(part.translate(_KINDS), np.uint8)
        word = kind == _WORD
        edges = np.flatnonzero(word[1:] != word[:-1]) + 1
        edges = np.concatenate([[0] if word[0] else [], edges, [len(word)] if word[-1] else []]).astype(np.int64)
        starts, ends = edges[::2], edges[1::2]
        marks = np.flatnonzero(kind == _MARK)
        data = np.frombuffer(part.translate(_LOWER), np.uint8)[word]
        yield _binary(data, np.concatenate([[0], np.cumsum(ends - starts)])), pieces + np.searchsorted(marks, starts)
        pieces += len(marks)
        at = end


class Held:
    """The texts of one language read since stripes were last sent: words as numbers of a vocabulary of their own."""

    def __init__(self, lang: bytes, texts: list[bytes]):
        self.lang = lang
        words, pieces, after = [], [], 0
        for text in _together(texts):
            for some, piece in words_of(text):
                words.append(some)
                pieces.append(piece + after)
            after += 1 + (int(pieces[-1][-1]) - after if pieces and len(pieces[-1]) else 0)
        coded = pa.chunked_array(words, pa.binary()).dictionary_encode().combine_chunks() if words else pa.array([], pa.dictionary(pa.int32(), pa.binary()))
        coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.piece = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)


def _together(texts: list[bytes]) -> Iterator[bytes]:
    """Short texts joined by a mark, so that few are taken apart."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= TEXT_STEP:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Held]:
    texts: dict[bytes, list[bytes]] = defaultdict(list)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            texts[lang].append(text)
            size += len(text)
            if size >= FLUSH_BYTES:
                while texts:
                    yield Held(*texts.popitem())
                size = 0
    while texts:
        yield Held(*texts.popitem())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _hash(word: bytes) -> int:
    return _signed(xxhash.xxh64_intdigest(word, 42))


def _fold(seed: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its beginning and that of its next word."""
    low = seed.view(np.uint64)
    return ((low << np.uint64(21)) | (low >> np.uint64(43))).view(np.int64) ^ word


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held in _read(batches):
        counts = np.bincount(held.ids, minlength=len(held.words))
        for some in _steps(np.arange(len(counts))):
            yield pa.RecordBatch.from_arrays([_repeat(held.lang, len(some)), held.words.take(pa.array(some)), pa.array(counts[some], pa.int64())], schema=_COUNTS)


def _repeat(value: bytes, n: int) -> pa.Array:
    return pa.array([value], pa.binary()).take(pa.array(np.zeros(n, np.int64)))


def _steps(places: np.ndarray, step: int = 65_536) -> Iterator[np.ndarray]:
    for at in range(0, len(places), step):
        yield places[at : at + step]


class Sieve:
    """What is known of frequent phrases of one length: a bitmap of their hashes, and the hashes of the heaviest."""

    def __init__(self, folder: str, bits: int, heavy: np.ndarray):
        self.folder, self.bits, self.heavy, self._map = folder, bits, heavy, None

    def load(self) -> Sieve:
        if self._map is None:
            self._map = np.zeros(self.bits // 8, np.uint8)
            files, root = open_folder(self.folder)
            for info in files.get_file_info(arrow_fs.FileSelector(root)):
                if info.path.endswith(".parquet"):
                    with files.open_input_file(info.path) as opened:
                        for batch in pq.ParquetFile(opened).iter_batches():
                            for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist(), strict=True):
                                self._map[(block - 1) * 4096 : block * 4096] = np.frombuffer(body, np.uint8)
        return self

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & (self.bits - 1)
        return (self._map[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def __getstate__(self):
        return {**self.__dict__, "_map": None}


def _local_stripes(held: Held, size: int, sieve: Sieve) -> Iterator[pa.RecordBatch]:
    """Stripes of all frequent prefixes of ``size`` words in what is held. Number 0 stands for the empty word, 1 for the first of the vocabulary."""
    ids, words = held.ids, held.words
    n, whole = len(words) + 1, len(ids) - size + 1
    if whole <= 0:
        return
    hashes = np.fromiter(map(_hash, words.to_pylist()), np.int64, len(words))
    folded = np.full(whole, _hash(held.lang))
    for j in range(size):
        folded = _fold(folded, hashes[ids[j : whole + j]])
    sound = (held.piece[:whole] == held.piece[size - 1 :]) & sieve.holds(folded)
    places = np.flatnonzero(sound)
    if not len(places):
        return
    # A prefix goes on where the phrase that starts a word later is frequent too, in the same piece.
    on = np.append(sound[1:] & (held.piece[: whole - 1] == held.piece[size:]), False)
    code = ids[places]
    for j in range(1, size):
        _, code = np.unique(code * n + ids[places + j], return_inverse=True)
    following = np.where(on[places], ids[np.minimum(places + size, len(ids) - 1)] + 1, 0)
    first = np.zeros(int(code.max()) + 1, np.int64)
    first[code] = places
    keys, counts = np.unique(code * n + following, return_counts=True)
    code, following = keys // n, keys % n
    heavy = np.isin(folded[first], sieve.heavy)[code] & (following != 0)
    part = np.where(heavy, hashes[following - 1] & (SLICES - 1), 0)
    if heavy.any():
        order = np.lexsort((part, code))
        code, following, counts, part = code[order], following[order], counts[order], part[order]
    starts = dense_bounds(code * SLICES + part)
    blank = pa.scalar(b" ", pa.binary())
    ended = pa.concat_arrays([pa.array([b" "], pa.binary()), pc.binary_join_element_wise(words, pa.scalar(b"", pa.binary()), blank)])
    for rows in _steps(np.arange(len(starts) - 1), 8192):
        bounds = starts[rows[0] : rows[-1] + 2]
        low, high = bounds[0], bounds[-1]
        at = first[code[starts[rows]]]
        prefix = words.take(pa.array(ids[at]))
        for j in range(1, size):
            prefix = pc.binary_join_element_wise(prefix, words.take(pa.array(ids[at + j])), blank)
        yield pa.RecordBatch.from_arrays(
            [
                _repeat(held.lang, len(rows)),
                prefix,
                pa.array(part[starts[rows]].astype(np.int32)),
                _packed(ended.take(pa.array(following[low:high])), bounds - low),
                _binary(counts[low:high].astype("<i8").view(np.uint8), (bounds - low) * 8),
            ],
            schema=_STRIPES,
        )


def _packed(words: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Neighbouring words as one byte string for each stretch between ``bounds``."""
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets[bounds])), words.buffers()[2]])


def _bytes_of(column: pa.Array) -> np.ndarray:
    """The bytes of all strings of a column, one after another."""
    if not len(column):
        return np.zeros(0, np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]


def _unpacked(column: pa.Array) -> pa.Array:
    """The words of all stripes of a column, one after another."""
    data = _bytes_of(column)
    ends = np.flatnonzero(data == 32)
    return _binary(data[data != 32], np.concatenate([[0], ends - np.arange(len(ends))]))


def _merge(least: int):
    """Adds stripes of one prefix and slice, which lie next to each other, element by element."""

    def merged(rows: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.RecordBatch]:
        """All stripes but the last one merged and cut to frequent entries, and the last one merged so far."""
        differs = np.zeros(rows.num_rows - 1, bool)
        for i in range(3):
            differs |= pc.not_equal(rows.column(i).slice(1), rows.column(i).slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.flatnonzero(differs) + 1])
        group = np.concatenate([[0], np.cumsum(differs)])
        counts = _bytes_of(rows.column("counts")).view("<i8")
        coded = _unpacked(rows.column("nexts")).dictionary_encode()
        n = max(len(coded.dictionary), 1)
        entries = pc.binary_length(rows.column("counts")).to_numpy() // 8
        keys = np.repeat(group, entries) * n + coded.indices.to_numpy().astype(np.int64)
        order = np.argsort(keys, kind="stable")
        starts = dense_bounds(keys[order])[:-1]
        counts = np.add.reduceat(counts[order], starts)
        keys = keys[order][starts]
        edges = np.searchsorted(keys // n, np.arange(len(at) + 1))
        totals = np.add.reduceat(counts, edges[:-1])
        empty = pc.index(coded.dictionary, pa.scalar(b"", pa.binary())).as_py()
        last, done = edges[-2], len(at) - 1
        shown = np.flatnonzero((counts[:last] >= least) & (keys[:last] % n != empty))
        offsets = pa.array(np.searchsorted(keys[shown] // n, np.arange(done + 1)).astype(np.int32))
        pick = pa.array(at[:done])
        out = pa.RecordBatch.from_arrays(
            [
                rows.column("lang").take(pick),
                rows.column("prefix").take(pick),
                pa.array(totals[:done], pa.int64()),
                pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(keys[shown] % n))),
                pa.ListArray.from_arrays(offsets, pa.array(counts[shown], pa.int64())),
            ],
            schema=_MERGED,
        )
        ended = pc.binary_join_element_wise(coded.dictionary.take(pa.array(keys[last:] % n)), pa.scalar(b"", pa.binary()), pa.scalar(b" ", pa.binary()))
        whole = np.array([0, len(keys) - last])
        rest = pa.RecordBatch.from_arrays(
            [*(rows.column(i).take(pa.array(at[-1:])) for i in range(3)), _packed(ended, whole), _binary(counts[last:].astype("<i8").view(np.uint8), whole * 8)], schema=_STRIPES
        )
        return out, rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays(batch.columns, schema=_STRIPES)
            rows = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            out, rest = merged(rows)
            if out.num_rows:
                yield out
        if rest is not None:
            # A stripe that equals no other ends the run.
            end = pa.RecordBatch.from_arrays([pa.array([b""], pa.binary()), pa.array([b""], pa.binary()), pa.array([-1], pa.int32()), pa.array([b" "], pa.binary()), pa.array([bytes(8)], pa.binary())], schema=_STRIPES)
            yield merged(pa.Table.from_batches([rest, end]).combine_chunks().to_batches()[0])[0]

    return run


def _hashed(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a and the phrase's hash."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                value = np.array([_hash(lang)], np.int64)
                for word in phrase.split(b" "):
                    value = _fold(value, np.array([_hash(word)], np.int64))
                found.append(int(value[0]))
            yield pa.RecordBatch.from_arrays([*batch.select(["lang", "phrase", "a"]).columns, pa.array(found, pa.int64())], ["lang", "phrase", "a", "hash"])

    return phrases.mapInArrow(add, "lang binary, phrase binary, a long, hash long")


def _sieve(phrases: DataFrame, all_words: int, most_bits: int) -> Sieve:
    known = staged(_hashed(phrases), "frequent")
    bits = 1 << 15
    while bits < min(16 * known.count(), most_bits):
        bits *= 2
    place = F.col("hash").bitwiseAND(F.lit(bits - 1)) + 1
    blocks = known.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("body"))
    folder = scratch(known.sparkSession, "bitmap")
    blocks.write.parquet(folder)
    # At most HEAVY_SHARE phrases hold that share of all words each.
    heavy = known.filter(F.col("a") * HEAVY_SHARE >= all_words).select("hash").collect()
    return Sieve(folder, bits, np.array([r["hash"] for r in heavy], np.int64))


def stripes(docs: DataFrame, size: int, sieve: Sieve, least: int) -> DataFrame:
    """lang, prefix, total, nexts, counts: merged stripes of frequent prefixes of ``size`` words, entries of ``least`` and more.

    A heavy prefix has several rows, one for each slice; their totals add up.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve.load()
        for held in _read(batches):
            yield from _local_stripes(held, size, sieve)

    sent = docs.mapInArrow(local, "lang binary, prefix binary, slice int, nexts binary, counts binary")
    keys = ["lang", "prefix", "slice"]
    return sent.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_merge(least), "lang binary, prefix binary, total long, nexts array<binary>, counts array<long>")


def collocations(docs: DataFrame, *, least: int = 30, longest: int = 4, top: int = 2000, share: int = 80, scale: int = 2_000_000, most_bits: int = 1 << 30) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of every language.

    ``least`` is the smallest count of a candidate of up to ``longest`` words; a phrase inside a longer candidate with at
    least ``share`` hundredths of its count is dropped.
    """
    prepare(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    )
    words = texts.mapInArrow(_count_words, "lang binary, phrase binary, a long")
    words = staged(words.groupBy("lang", "phrase").agg(F.sum("a").alias("a")), "words")
    sizes = words.groupBy("lang").agg(F.sum("a").alias("n"))
    all_words = sizes.agg(F.sum("n")).first()[0] or 0
    found, parts = [], []
    frequent = words.filter(F.col("a") >= least)
    for size in range(1, longest):
        merged = staged(stripes(texts, size, _sieve(frequent, all_words, most_bits), least), f"stripes-{size}")
        parts.append(merged.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("total").alias("f")))
        entries = merged.select("lang", "prefix", F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
        frequent = entries.select("lang", F.concat("prefix", F.lit(b" "), "e.nexts").alias("phrase"), F.col("e.counts").alias("a"))
        found.append(frequent)
    candidates = reduce(DataFrame.unionAll, found).select("lang", F.col("phrase").cast("string").alias("phrase"), "a")
    candidates = staged(candidates.withColumn("w", F.split("phrase", " ")).withColumn("m", F.size("w")), "candidates")
    parts = staged(reduce(DataFrame.unionAll, parts).select("lang", F.col("phrase").cast("string").alias("phrase"), "f"), "parts")
    return _ranked(_scored(_free(candidates, share), parts, scale), sizes, top)


def _piece(first, length):
    return F.array_join(F.slice("w", first, length), " ")


def _free(candidates: DataFrame, share: int) -> DataFrame:
    """Candidates that no longer one nearly equals: only those of one word more need be asked, as these count at least as often."""
    longer = candidates.filter("m > 2")
    inside = longer.select("lang", F.explode(F.array(_piece(F.lit(1), F.col("m") - 1), _piece(F.lit(2), F.col("m") - 1))).alias("phrase"), "a")
    most = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(most, ["lang", "phrase"], "left")
    return kept.filter(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * share)).drop("longer")


def _exact(name: str):
    return F.col(name).cast("decimal(20,0)")


def _scored(candidates: DataFrame, parts: DataFrame, scale: int) -> DataFrame:
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _piece(F.lit(1), F.col("k")).alias("first"), _piece(F.col("k") + 1, F.col("m") - F.col("k")).alias("rest"))
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    both = both.withColumn("scaled", _exact("a") * F.lit(scale)).withColumn("whole", _exact("l") + _exact("r"))
    score = F.struct(F.expr("scaled div whole").alias("score"), "k", "l", "r")
    return both.groupBy("lang", "phrase", "a").agg(F.min(score).alias("s")).select("lang", "phrase", "a", "s.score", "s.l", "s.r")


def _ranked(scored: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    named = best.join(sizes, "lang").withColumn("lang", F.col("lang").cast("string"))
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
