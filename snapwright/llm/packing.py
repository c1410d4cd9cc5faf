"""Best-fit packing of documents into sequences, with a certificate for every partition.

1. Every document is encoded, its end id added, and cut into pieces of the sequence length; the pieces are stored.
2. Short pieces are dealt to partitions of bounded size. Each is packed by best-fit decreasing, and lower bounds from
   dual-feasible functions say how few sequences could have done.
3. A partition that meets its bound is certified and lends only its loosest sequence; one with a gap lends every
   sequence that is not full. What is lent is dealt to fewer partitions and packed again. A rerun that saves no
   sequence keeps what was there, so the number of sequences never grows.

NULL text is the empty text: its end id alone. NULL or repeated ids are carried along, since pieces have numbers of
their own. Equal lengths go by piece number. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwright.llm.common import in_batches, prepare, staged, text_values, whole_text
from snapwright.llm.tokens import encoder_for, narrow, public_vocabulary

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long, id_bytes int, ids binary"
_PIECES = pa.schema(
    [("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64()), ("id_bytes", pa.int32()), ("ids", pa.binary())]
)
PLACES = "uid long, length long, sequence_id long, offset long, lent boolean, certified boolean"


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of every length, and the room left in each sequence; equal lengths in the order given.

    Sequences are kept by the room they have left, and a bit set of the rooms in use finds the tightest that fits.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, left = 0, []
    for item, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, len(left)
            left.append(capacity)
        bins[item], offsets[item] = chosen, capacity - room
        left[chosen] = room - size
        if not with_room[room - size]:
            rooms |= 1 << (room - size)
        with_room[room - size].append(chosen)
    return bins, offsets, np.array(left, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound that two families of dual-feasible functions give for these lengths.

    A dual-feasible function maps lengths so that whatever fits one sequence still sums to one sequence at most; the
    mapped total is then a bound. Family one lifts lengths above ``capacity - e`` to a whole sequence and drops those
    below ``e``. Family two rounds lengths to ``1 / k``-ths of a sequence.
    """
    if len(lengths) == 0:
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    number, total = np.cumsum(count), np.cumsum(count * size)
    e = np.arange(1, capacity // 2 + 1)
    lifted = (number[-1] - number[capacity - e]) * capacity + total[capacity - e] - total[e - 1]
    best = max(-(-int(total[-1]) // capacity), int((-(-lifted // capacity)).max(initial=0)))
    for k in range(1, 64):
        scaled = size * (k + 1)
        exact = scaled % capacity == 0
        # In units of capacity * k: an exact multiple keeps its size, any other is rounded down to k-ths.
        units = np.where(exact, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((count * units).sum()) // (capacity * k)))
    return best


def cut(docs: DataFrame, *, capacity: int, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """All pieces of all documents with their ids; ``ids`` are little-endian integers of ``id_bytes`` bytes."""
    prepare(docs.sparkSession)
    vocabulary = vocabulary or public_vocabulary()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder = encoder_for(vocabulary)
        width, end, step = encoder.width, np.array([end_id], "<u4").tobytes(), 4 * capacity
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(text_values(batch.column("text"))), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    own = ids[at : at + step]
                    yield uid, doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own), width, narrow(own, width)
                    uid += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), _PIECES, lambda row: len(row[7]) + 64)

    narrow_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    return narrow_docs.mapInArrow(run, PIECES)


def place(pieces: DataFrame, *, capacity: int, partition_pieces: int = 32_768, rounds: int = 4) -> DataFrame:
    """Sequence and offset of every piece (uid, length): uid, sequence_id, offset, certified.

    ``pieces`` should be stored: it is read once to count and once to pack. ``certified`` is true where the
    partition that packed the piece last met its lower bound. ``partition_pieces`` bounds what one task packs.
    """

    def repack(turn: int, last: bool):
        def run(table: pa.Table) -> pa.Table:
            group = table.column("part")[0].as_py()
            table = table.sort_by([("length", "descending"), ("uid", "ascending")])
            lengths = table.column("length").to_numpy()
            bins, offsets, left = best_fit_decreasing(lengths, capacity)
            gap = len(left) - lower_bound(lengths, capacity)
            names = (((turn << 22) + group << 32) + bins) * 2 + 1
            before = table.column("sequence_id").to_numpy(zero_copy_only=False)
            lent = np.zeros(len(bins), bool)
            if turn and len(left) >= len(np.unique(before)):
                names, offsets = before, table.column("offset").to_numpy(zero_copy_only=False)
            elif not last:
                lent = (left > 0)[bins] if gap else bins == int(left.argmax())
            return pa.table(
                {"uid": table.column("uid"), "length": table.column("length"), "sequence_id": pa.array(names, pa.int64()),
                 "offset": pa.array(offsets, pa.int64()), "lent": pa.array(lent), "certified": pa.array(np.full(len(bins), gap == 0))}
            )

        return run

    whole = pieces.filter(F.col("length") >= capacity)
    # A full piece is a sequence of its own; even numbers are theirs, odd ones belong to packed sequences.
    done = whole.select("uid", (F.col("uid") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))
    todo = pieces.filter(F.col("length") < capacity).select(
        "uid", "length", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.col("uid").alias("deal")
    )
    for turn in range(rounds):
        n = todo.count()
        if not n:
            break
        parts = -(-n // partition_pieces)
        last = parts == 1 or turn == rounds - 1
        dealt = todo.withColumn("part", F.pmod(F.xxhash64("deal"), F.lit(parts)).cast("long")).drop("deal")
        packed = staged(dealt.groupBy("part").applyInArrow(repack(turn, last), PLACES), f"packed-{turn}")
        done = done.unionByName(packed.filter(~F.col("lent")).select("uid", "sequence_id", "offset", "certified"))
        # The pieces of one sequence are dealt together, so that a rerun can keep it as it was.
        todo = packed.filter("lent").select("uid", "length", "sequence_id", "offset", F.col("sequence_id").alias("deal"))
    return done


def pack(docs: DataFrame, *, capacity: int = 2048, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Every piece of every document with its place: the columns of :func:`cut` plus sequence_id, offset, certified."""
    pieces = staged(cut(docs, capacity=capacity, vocabulary=vocabulary, end_id=end_id), "pieces")
    return pieces.join(place(pieces, capacity=capacity), "uid")
