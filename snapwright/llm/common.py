"""What several operators of this folder share: shared scratch tables, shared files, columns that may be absent."""

from __future__ import annotations

import posixpath
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwright.sources.storage import scratch_root

#: Arrow batches never hold more than this, so a run of very long texts cannot fill a Python worker.
BATCH_BYTES = 4 << 20
_DEFAULT_BATCH = "67108864b"


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes for this session, unless the session has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == _DEFAULT_BATCH:
        spark.conf.set(key, str(BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one intermediate result, in the folder that all executors share."""
    return f"{scratch_root(spark)}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later uses neither recompute nor re-plan it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(name: str) -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_remainder(name: str, divisor: int) -> Column:
    """crc32 of an id written as text, modulo ``divisor``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % divisor


def open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder given as a URI or as a plain path; works inside tasks."""
    if "://" in uri or uri.startswith("file:"):
        return arrow_fs.FileSystem.from_uri(uri)
    return arrow_fs.LocalFileSystem(), uri


def join_path(folder: str, name: str) -> str:
    return posixpath.join(folder, name)


def text_values(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts of an Arrow column, NULL as the empty text."""
    return ["" if v is None else v for v in column.to_pylist()]


def masked_crc(data: bytes) -> int:
    """A checksum that stays safe when it is stored beside the data it covers."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def in_batches(rows: Iterable[tuple], schema: pa.Schema, size_of, limit: int = BATCH_BYTES, most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most ``limit`` bytes (by ``size_of``) or one row, and at most ``most`` rows."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        size = size_of(row)
        if held and (weight + size > limit or len(held) >= most):
            yield to_batch(held, schema)
            held, weight = [], 0
        held.append(row)
        weight += size
    if held:
        yield to_batch(held, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def dense_bounds(keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal neighbours in ``keys``, and its length at the end."""
    if len(keys) == 0:
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).astype(np.int64)
