"""Exact top-k by inner product, one term at a time.

Candidates lie in blocks of postings: for every term, which rows of the block have it and with what weight. A query is
a sparse row; for each of its terms the weighted postings are added into dense score arrays, every candidate is scored,
and partition selection keeps the best k of the block. A second selection merges the blocks.

The query set is stored once in the shared folder. A task holds one block of candidates and reads the queries chunk by
chunk, so neither set is ever whole anywhere, and k rows per query and task are shuffled.

Vectors that are NULL or hold a NULL or non-finite component take no part. Components beyond a shorter vector's end
count as zero. Ties go to the smaller id. Rows with a NULL id take no part. A query meets every row except those with
its own id. Repeated ids are candidates each. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwright.llm.common import join_path, open_folder, prepare, scratch

FOUND = "query_id long, vec_id long, score long"
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
#: A term that at least this share of a block's rows has is added as a whole column instead of row by row.
DENSE_SHARE = 0.25


def scaled(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and integer terms: floor(scale * x) of every component, rows that take no part left out."""
    values = F.col("embedding").cast("array<double>")
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole: Column = F.transform(values, lambda x: F.floor(x * F.lit(float(scale))))
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), whole.cast("array<long>").alias("terms"))


def _matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of integers, short rows filled with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), max(int(lengths.max(initial=0)), width)), np.int64)
    if len(values):
        at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(np.arange(len(lists)), lengths), at] = values
    return out


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of all candidates for all queries, by scattering each term's weighted postings."""
    terms = min(queries.shape[1], candidates.shape[1])
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(terms, 1)
    # Sums of whole numbers below 2**24 and 2**53 are exact in the narrower types.
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    asked, held = queries[:, :terms].astype(kind), np.ascontiguousarray(candidates[:, :terms].T.astype(kind))
    scores = np.zeros((len(queries), len(candidates)), kind)
    postings = []
    for term in range(terms):
        rows = np.flatnonzero(held[term])
        postings.append((rows, held[term, rows]) if len(rows) < DENSE_SHARE * len(candidates) else (None, held[term]))
    buffer = np.empty(len(candidates), kind)
    for at in range(len(queries)):
        own = scores[at]
        for term in np.flatnonzero(asked[at]):
            rows, weights = postings[term]
            if rows is None:
                np.multiply(weights, asked[at, term], out=buffer)
                own += buffer
            else:
                own[rows] += weights * asked[at, term]
    return scores


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query, places of its k best: partition selection by score, then ties by id."""
    for at in range(len(scores)):
        row, usable = scores[at], None
        mine = ids == own[at]
        if mine.any():
            usable = np.flatnonzero(~mine)
            row = row[usable]
        if len(row) > k:
            edge = np.partition(row, len(row) - k)[len(row) - k]
            places = np.flatnonzero(row >= edge)
        else:
            places = np.arange(len(row))
        places = places if usable is None else usable[places]
        yield at, places[np.lexsort((ids[places], -scores[at][places]))[:k]]


def exact_top_k(vectors: DataFrame, queries: Column, *, k: int = 20, scale: int = 64, block_rows: int = 16_384, chunk_rows: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every row that ``queries`` selects.

    ``block_rows`` bounds the candidates and ``chunk_rows`` the queries that a task scores at once.
    """
    spark = vectors.sparkSession
    prepare(spark)
    terms = scaled(vectors, scale)
    folder = scratch(spark, "queries")
    terms.filter(queries).write.option("maxRecordsPerFile", 65_536).parquet(folder)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        names = sorted(i.path for i in files.get_file_info(_selector(root)) if i.path.endswith(".parquet"))
        for ids, block in _blocks(batches, block_rows):
            for name in names:
                with files.open_input_file(name) as opened:
                    for asked in pq.ParquetFile(opened).iter_batches(batch_size=chunk_rows):
                        query_ids = asked.column("vec_id").to_numpy()
                        scores = accumulate(_matrix(asked.column("terms")), block)
                        found = [(at, places) for at, places in best(scores, ids, query_ids, k)]
                        places = np.concatenate([p for _, p in found]) if found else np.zeros(0, np.int64)
                        ats = np.repeat(np.arange(len(found)), [len(p) for _, p in found])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(query_ids[ats]), pa.array(ids[places]), pa.array(scores[ats, places].astype(np.int64))], schema=_FOUND
                        )

    part = terms.mapInArrow(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _selector(root: str):
    from pyarrow import fs as arrow_fs

    return arrow_fs.FileSelector(join_path(root, ""), recursive=False)


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, block_rows):
            some = batch.slice(at, block_rows)
            if n and n + some.num_rows > block_rows:
                yield _block(held)
                held, n = [], 0
            held.append(some)
            n += some.num_rows
    if n:
        yield _block(held)


def _block(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    together = pa.Table.from_batches(held).combine_chunks()
    return together.column("vec_id").to_numpy(), _matrix(together.column("terms").chunk(0))
