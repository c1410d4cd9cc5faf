"""Text column to vector column, with any encoder.

The encoder runs inside the tasks on Arrow batches of the text column alone; the other columns stay in
the JVM. An encoder is made once per task by a factory, so clients are never shipped with the job.
"""

from __future__ import annotations

import contextlib
import hashlib
import importlib
import random
import re
import time
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwright.operators.joins import by_shuffle
from snapwright.sources.storage import Folder

Encoder = Callable[[list[str]], "list[list[float]] | np.ndarray"]
EncoderFactory = Callable[[], Encoder]

# Retry budget of a throttled remote encoder.
ATTEMPTS = 8
LONGEST_WAIT = 60.0


class Throttled(Exception):
    """Raised by an encoder when its service asks it to slow down; the only error that is retried."""


_factories: dict[str, Callable[..., EncoderFactory]] = {}


def register_encoder(name: str, make: Callable[..., EncoderFactory]) -> None:
    """``make(**options)`` returns the factory a task calls to get its encoder."""
    _factories[name] = make


def encoder(name: str, **options) -> EncoderFactory:
    """Factory of a registered encoder, or of ``module:function``, which is called like a registered one."""
    if name not in _factories and ":" in name:
        module, _, function = name.partition(":")
        return getattr(importlib.import_module(module), function)(**options)
    if name not in _factories:
        raise ValueError(f"no encoder is registered as {name!r}; known: {', '.join(sorted(_factories))}, or module:function")
    return _factories[name](**options)


class _Numbers(dict):
    """Token to number, by its md5. Kept for up to 2^17 tokens."""

    def __missing__(self, token: bytes) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        number = self[token] = int(hashlib.md5(token).hexdigest()[:8], 16)
        return number


_number = _Numbers().__getitem__

# Runs of letters or digits, as [\p{L}\p{N}]+. ASCII texts need no search: all but their letters and digits become spaces.
_TOKEN = re.compile(r"[^\W_]+")
_ASCII = bytes(ord(chr(i).lower()) if i < 128 and chr(i).isalnum() else 32 for i in range(256))


def _tokens(text: str) -> list[bytes]:
    if text.isascii():
        return text.encode("ascii").translate(_ASCII).split()
    return [token.encode("utf-8") for token in _TOKEN.findall(text.lower())]


def hashed_counts(texts: list[str], dimension: int) -> np.ndarray:
    """Token counts folded into ``dimension`` slots by an md5 prefix, one row of unit length per text."""
    tokens = [_tokens(text) for text in texts]
    sizes = [len(own) for own in tokens]
    slots = np.fromiter(map(_number, chain.from_iterable(tokens)), np.int64, sum(sizes)) % dimension
    rows = np.repeat(np.arange(len(texts)), sizes)
    counts = np.bincount(rows * dimension + slots, minlength=len(texts) * dimension).reshape(len(texts), dimension).astype(float)
    length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return np.divide(counts, length, out=counts, where=length > 0)


def _hashed(dimension: int = 1024) -> EncoderFactory:
    return lambda: lambda texts: hashed_counts(texts, dimension)


register_encoder("hashed", _hashed)


def waits(attempts: int, jitter=random.random) -> Iterator[float]:
    """Seconds to wait before each further attempt: doubling from one, with jitter, up to the longest wait."""
    return (min(2.0**n + jitter(), LONGEST_WAIT) for n in range(attempts))


def with_retry(
    encode: Encoder, *, attempts: int = ATTEMPTS, sleep=time.sleep, jitter=random.random
) -> Encoder:
    """Call again, after a wait, while the service is throttled; other errors pass at once."""

    def encode_with_retry(texts: list[str]):
        for wait in waits(attempts, jitter):
            with contextlib.suppress(Throttled):
                return encode(texts)
            sleep(wait)
        raise RuntimeError(f"still throttled after {attempts} attempts")

    return encode_with_retry


def with_rate(encode: Encoder, texts_per_second: float, *, sleep=time.sleep, clock=time.monotonic) -> Encoder:
    """Pause so that no more than ``texts_per_second`` texts go through."""
    due = [clock()]

    def encode_at_rate(texts: list[str]):
        wait = due[0] - clock()
        if wait > 0:
            sleep(wait)
        due[0] = max(clock(), due[0]) + len(texts) / texts_per_second
        return encode(texts)

    return encode_at_rate


def retrying(factory: EncoderFactory) -> EncoderFactory:
    return lambda: with_retry(factory())


def remote(factory: EncoderFactory, *, job_rate: float, tasks: int) -> EncoderFactory:
    """A rate-limited, retrying factory: the job's rate is shared evenly by ``tasks`` tasks.

    Use it on a frame repartitioned to ``tasks`` (see :func:`embed`).
    """
    return lambda: with_rate(with_retry(factory()), job_rate / tasks)


def embed_column(text: Column, factory: EncoderFactory, batch_size: int = 25) -> Column:
    """Vector of a text column; NULL text gives NULL. Rows go to the encoder ``batch_size`` at a time."""

    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = factory()
        for batch in batches:
            texts = batch.to_pylist()
            present = [text for text in texts if text is not None]
            arrays, sizes = [], []
            for start in range(0, len(present), batch_size):
                found = encode(present[start : start + batch_size])
                if isinstance(found, np.ndarray) and found.ndim == 2:
                    arrays.append(found.astype(np.float32).reshape(-1))
                    sizes += [found.shape[1]] * len(found)
                else:
                    own = [np.asarray(vector, dtype=np.float32) for vector in found]
                    arrays += own
                    sizes += [len(vector) for vector in own]
            if len(sizes) != len(present):
                raise ValueError(f"encoder returned {len(sizes)} vectors for {len(present)} texts")
            # One row per text, NULL texts included: lengths give the row ends, NULL rows none.
            absent = np.fromiter((text is None for text in texts), bool, len(texts))
            each = np.zeros(len(texts) + 1, np.int64)
            each[1:][~absent] = sizes
            values = np.concatenate(arrays) if arrays else np.empty(0, dtype=np.float32)
            yield pa.ListArray.from_arrays(pa.array(np.cumsum(each), type=pa.int32()), pa.array(values), mask=pa.array(absent))

    # A remote encoder is costly and need not repeat itself exactly, so the plan must not copy the call.
    return F.arrow_udf(vectors, "array<float>").asNondeterministic()(text)


def checked_dimension(vector: Column, dimension: int) -> Column:
    """The vector, or a failed job when any row's length differs from ``dimension``."""
    size = F.coalesce(F.size(vector), F.lit(-1))
    message = F.concat(
        F.lit("Embedding dimension mismatch: got "), size.cast("string"), F.lit(f", expected {dimension}")
    )
    return F.when(size == dimension, vector).otherwise(F.raise_error(message).cast("array<float>"))


def embed(
    df: DataFrame,
    text: str,
    factory: EncoderFactory,
    *,
    dimension: int | None,
    out: str = "embedding",
    batch_size: int = 25,
    tasks: int | None = None,
) -> DataFrame:
    """Add the vector column. ``tasks`` fixes how many encoders run side by side."""
    if tasks is not None:
        df = df.repartition(tasks)
    embedded = df.withColumn(out, embed_column(F.col(text), factory, batch_size))
    return embedded if dimension is None else embedded.withColumn(out, checked_dimension(F.col(out), dimension))


def embed_distinct(
    df: DataFrame, text: str, factory: EncoderFactory, *, dimension: int | None, out: str = "embedding", **options
) -> DataFrame:
    """Like :func:`embed`, with one call per distinct text.

    For costly encoders over repetitive text. The frame is read twice: pass one that is stored.
    """
    keyed = df.withColumn("__text_key", F.sha2(F.col(text), 256))
    # Equal digests carry equal texts; the partial aggregation keeps one copy per task before the shuffle.
    texts = keyed.filter(F.col(text).isNotNull()).groupBy("__text_key").agg(F.any_value(F.col(text)).alias("__text"))
    vectors = embed(texts, "__text", factory, dimension=dimension, out=out, **options).drop("__text")
    # A vector is far larger than the optimizer takes an array to be.
    return keyed.join(by_shuffle(vectors), "__text_key", "left").drop("__text_key")


REMEMBERED = "digest string, vector array<float>"


def embed_remembered(
    df: DataFrame, text: str, factory: EncoderFactory, memory: str, *, dimension: int | None, out: str = "embedding", **options
) -> DataFrame:
    """Like :func:`embed_distinct`, but a text that any earlier run has embedded is never sent again.

    ``memory`` is a folder of (digest of the text, vector) that belongs to one encoder. Texts whose digest it holds are
    taken out before the encoder; what the encoder returns is appended. Two runs at once may both append a text; one of its vectors is
    taken then. The frame is read twice: pass one that is stored.
    """
    spark = df.sparkSession
    keyed = df.withColumn("__text_key", F.sha2(F.col(text), 256))
    texts = keyed.filter(F.col(text).isNotNull()).groupBy("__text_key").agg(F.any_value(F.col(text)).alias("__text"))
    if Folder(spark, memory).names():
        known = spark.read.schema(REMEMBERED).parquet(memory).select(F.col("digest").alias("__text_key"))
        texts = texts.join(by_shuffle(known), "__text_key", "left_anti")
    fresh = embed(texts, "__text", factory, dimension=dimension, out="vector", **options)
    fresh.select(F.col("__text_key").alias("digest"), "vector").write.mode("append").parquet(memory)
    held = spark.read.schema(REMEMBERED).parquet(memory).groupBy(F.col("digest").alias("__text_key")).agg(F.any_value("vector").alias(out))
    if dimension is not None:
        held = held.withColumn(out, checked_dimension(F.col(out), dimension))
    return keyed.join(by_shuffle(held), "__text_key", "left").drop("__text_key")
