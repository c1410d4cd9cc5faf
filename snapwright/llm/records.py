"""Token ids as length-delimited binary records in shard files, with an offset index beside them.

A shard file is a run of frames. One frame is the payload's length (8 bytes), a masked checksum of that length
(4 bytes), the payload, and a masked checksum of the payload (4 bytes), all little-endian. A payload is the document's
id (8 bytes), one byte that is 1 where the id is NULL, one byte with the width of a token id, then the ids.

Every task writes files of its own name and reports one index row per frame; the index is a table that Spark commits
as a whole. Files of a lost or repeated task are in no index row, so nobody reads them.

NULL text is the empty text and gives the end id alone. NULL ids come first. Rows of one id go by text; rows that are
equal are each written. Columns other than the id and the text are ignored. An empty table gives an empty index.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapwright.llm.common import in_batches, join_path, masked_crc, open_folder, prepare, text_values, whole_text
from snapwright.llm.tokens import encoder_for, narrow, public_vocabulary, widen

_LENGTH = struct.Struct("<Q")
_CHECK = struct.Struct("<I")
_HEAD = struct.Struct("<qBB")
FRAME_BYTES = _LENGTH.size + 2 * _CHECK.size

_INDEX = pa.schema(
    [("doc_id", pa.int64()), ("shard", pa.int64()), ("file", pa.string()), ("position", pa.int64()), ("payload_bytes", pa.int64()), ("n_tokens", pa.int64())]
)
INDEX_SCHEMA = "doc_id long, shard long, file string, position long, payload_bytes long, n_tokens long"


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join((length, _CHECK.pack(masked_crc(length)), payload, _CHECK.pack(masked_crc(payload))))


def read_frame(opened) -> bytes | None:
    """The next payload of a file, None at its end; a damaged or cut frame is an error."""
    head = opened.read(_LENGTH.size + _CHECK.size)
    if not head:
        return None
    if len(head) < _LENGTH.size + _CHECK.size or _CHECK.unpack(head[_LENGTH.size :])[0] != masked_crc(head[: _LENGTH.size]):
        raise ValueError("damaged record: its length does not match its checksum")
    size = _LENGTH.unpack(head[: _LENGTH.size])[0]
    payload, check = opened.read(size), opened.read(_CHECK.size)
    if len(payload) < size or len(check) < _CHECK.size or _CHECK.unpack(check)[0] != masked_crc(payload):
        raise ValueError("damaged record: its payload does not match its checksum")
    return payload


def pack_payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """One document's payload from its 32-bit ids, stored in ``width`` bytes each."""
    return _HEAD.pack(doc_id or 0, doc_id is None, width) + narrow(ids, width)


def unpack_payload(payload: bytes) -> tuple[int | None, bytes]:
    doc_id, missing, width = _HEAD.unpack_from(payload)
    return (None if missing else doc_id), widen(payload[_HEAD.size :], width)


def write_records(docs: DataFrame, folder: str, *, vocabulary: str | None = None, end_id: int = 2, file_bytes: int = 256 << 20) -> DataFrame:
    """Write all ``docs`` (doc_id, text) under ``folder`` in ascending id order; returns the committed index.

    Documents are dealt to tasks by ranges of the id, ties by text, so shard numbers ascend with the ids. A task
    starts another file past ``file_bytes``.
    """
    spark = docs.sparkSession
    prepare(spark)
    vocabulary = vocabulary or public_vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (files, root) = encoder_for(vocabulary), open_folder(folder)
        width, end = encoder.width, np.array([end_id], "<u4").tobytes()
        shard = (TaskContext.get().partitionId() << 20) - 1
        out, name, position = None, "", 0
        try:
            for batch in batches:
                rows = []
                ids = encoder.encode(text_values(batch.column("text")))
                for doc_id, own in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                    own += end
                    if out is None or position > file_bytes:
                        if out is not None:
                            out.close()
                        shard += 1
                        name, position = f"shard-{shard:016d}-{uuid.uuid4().hex}.rec", 0
                        out = files.open_output_stream(join_path(root, name))
                    payload = pack_payload(doc_id, own, width)
                    written = frame(payload)
                    out.write(written)
                    rows.append((doc_id, shard, name, position, len(payload), len(own) // 4))
                    position += len(written)
                yield from in_batches(rows, _INDEX, lambda row: 100)
        finally:
            if out is not None:
                out.close()

    files, root = open_folder(folder)
    files.create_dir(root, recursive=True)
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )
    index = f"{folder.rstrip('/')}/index"
    dealt.mapInArrow(write, INDEX_SCHEMA).write.parquet(index)
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder.rstrip('/')}/index")


def read_records(spark: SparkSession, folder: str, *, with_ids: bool = True) -> DataFrame:
    """All documents of the files that the index names: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    ``start`` counts the tokens of all documents before. ``ids`` are little-endian unsigned 32-bit integers. Each
    frame's checksums are verified. Files are read as streams, one frame in memory at a time.
    """
    per_file = read_index(spark, folder).groupBy("file").agg(F.min("shard").alias("shard"), F.sum("n_tokens").alias("tokens"))
    # One narrow row per file, at least tens of MB of tokens each: a prefix sum over files, not over documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files_with_start = per_file.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).select("file", "base")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] if with_ids else []
    schema = pa.schema(fields)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        files, root = open_folder(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with files.open_input_stream(join_path(root, name), buffer_size=1 << 20) as opened:
                    while (payload := read_frame(opened)) is not None:
                        doc_id, ids = unpack_payload(payload)
                        row = (doc_id, start, len(ids) // 4, zlib.crc32(ids))
                        yield (*row, ids) if with_ids else row
                        start += len(ids) // 4

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), schema, lambda row: len(row[4]) + 64 if with_ids else 64)

    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    wide = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files_with_start.repartition(wide, "file").mapInArrow(read, out)


def read_record(folder: str, file: str, position: int) -> tuple[int | None, np.ndarray]:
    """One document by its place in the offset index: the access a shuffled reader makes."""
    files, root = open_folder(folder)
    with files.open_input_file(join_path(root, file)) as opened:
        opened.seek(position)
        payload = read_frame(opened)
    if payload is None:
        raise ValueError("no record at this position")
    doc_id, ids = unpack_payload(payload)
    return doc_id, np.frombuffer(ids, "<u4")
