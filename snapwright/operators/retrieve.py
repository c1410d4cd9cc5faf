"""Nearest neighbours by cosine, exact and approximate.

A similarity is rounded to ``DIGITS`` before ranking and equal ones go by id, so the order does not
depend on how the arithmetic was batched. Zero vectors have no direction and are never returned.

Every task keeps only its own best k per query; what is shuffled is k rows per query and task. Vectors are never moved:
small query sets are sent to the tasks, large ones are stored once in the shared folder and read there chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snapwright.functions.vectors import dot, norm
from snapwright.sources.storage import open_folder, scratch_root, stored

DIGITS = 9
# Most query vectors sent to every task, and most components of them.
BROADCAST_QUERIES = 4_096
BROADCAST_CELLS = 8_000_000
# Vector components that a task holds at once, and those of one chunk of stored queries.
BLOCK_CELLS = 4_000_000
CHUNK_CELLS = 250_000
# Similarities computed at once, and candidate rows kept before the best are sorted out.
MATRIX_CELLS = 2_000_000
UNIT_ROWS = 4_096
SETTLE_ROWS = 200_000


def _unit(vectors) -> np.ndarray:
    """Rows scaled to unit length; zero rows stay zero."""
    if isinstance(vectors, pa.Array):
        matrix = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    else:
        matrix = np.asarray(list(vectors), dtype=np.float64)
    # In place and some rows at a time, as a block of vectors is most of what a task holds.
    for start in range(0, len(matrix), UNIT_ROWS):
        part = matrix[start : start + UNIT_ROWS]
        length = np.sqrt((part * part).sum(axis=1, keepdims=True))
        np.divide(part, length, out=part, where=length > 0)
        part[~(length > 0)[:, 0]] = 0
    return matrix


class _Best:
    """The k best (vec_id, similarity) of each query seen so far."""

    def __init__(self, k: int):
        self.k = k
        self.frames: list[pd.DataFrame] = []
        self.pending = 0

    def add(self, query_ids, ids, similarity) -> None:
        # Text ids stay Python objects, which Arrow takes in one piece.
        plain = [a if a.dtype.kind in "iu" else a.astype(object) for a in map(np.asarray, (query_ids, ids))]
        self.frames.append(
            pd.DataFrame(
                {
                    "query_id": pd.Series(plain[0], dtype=plain[0].dtype),
                    "vec_id": pd.Series(plain[1], dtype=plain[1].dtype),
                    "similarity": similarity,
                }
            )
        )
        self.pending += len(ids)
        if self.pending > SETTLE_ROWS:
            self.frames = [self.frame()]
            self.pending = 0

    def frame(self) -> pd.DataFrame:
        if not self.frames:
            return pd.DataFrame({"query_id": [], "vec_id": [], "similarity": []})
        ranked = pd.concat(self.frames).sort_values(
            ["query_id", "similarity", "vec_id"], ascending=[True, False, True]
        )
        return ranked.groupby("query_id", sort=False).head(self.k)


def _score_into(best: _Best, query_ids, queries, ids, vectors) -> None:
    """Offer a block of vectors to every query, a bounded similarity matrix at a time."""
    step = max(1, MATRIX_CELLS // max(1, len(query_ids)))
    asked = queries.any(axis=1)[None, :]
    for start in range(0, len(ids), step):
        part = vectors[start : start + step]
        alive = part.any(axis=1)[:, None] & asked
        similarity = part @ queries.T
        np.round(similarity, DIGITS, out=similarity)
        similarity[~alive] = -np.inf
        if len(part) > best.k:
            # Everything tied with the k-th best stays in, so that ties are settled by id, not by chance.
            floor = np.partition(similarity, len(part) - best.k, axis=0)[len(part) - best.k]
            alive &= similarity >= floor[None, :]
        rows, columns = np.nonzero(alive)
        best.add(query_ids[columns], ids[start : start + step][rows], similarity[rows, columns])


def _result_schema(queries: DataFrame, query_id: str, vectors: DataFrame, vec_id: str) -> T.StructType:
    return (
        T.StructType()
        .add("query_id", queries.schema[query_id].dataType)
        .add("vec_id", vectors.schema[vec_id].dataType)
        .add("similarity", T.DoubleType())
    )


def _final_top(partial: DataFrame, k: int) -> DataFrame:
    """Best k per query from the tasks' best, in two steps: first within groups of tasks, then over the groups."""
    by = [F.desc("similarity"), F.asc("vec_id")]
    grouped = partial.withColumn("__group", F.pmod(F.spark_partition_id(), F.lit(64)))
    first = W.partitionBy("query_id", "__group").orderBy(*by)
    partial = grouped.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).drop("__group")
    return partial.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*by))).filter(F.col("rank") <= k)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    broadcast_queries: int = BROADCAST_QUERIES,
    block_cells: int = BLOCK_CELLS,
    chunk_cells: int = CHUNK_CELLS,
) -> DataFrame:
    """Exact k nearest vectors of every query: (query_id, vec_id, similarity, rank).

    Up to ``broadcast_queries`` queries, and up to a bound on their components, go to every task. A larger query set
    is stored in the shared folder; every task reads it once for each block of its vectors.
    """
    asked, stored_vectors, schema = _columns(vectors, queries, vec_id, vector, query_id, query_vector)
    held = _few(asked, broadcast_queries)
    if held is None:
        folder = _store_queries(asked)
        score = _chunk_scorer(folder, k, schema, block_cells, chunk_cells)
    else:
        score = _scorer(*held, k, schema)
    return _final_top(stored_vectors.mapInArrow(score, schema), k)


def _columns(vectors, queries, vec_id, vector, query_id, query_vector, *more):
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("query_vector"))
    asked = asked.filter(F.col("query_vector").isNotNull())
    kept = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), *more).filter(F.col("vector").isNotNull())
    return asked, kept, _result_schema(asked, "query_id", kept, "vec_id")


def _few(asked: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids and unit vectors of a query set that is small enough to send to every task; None for a larger one."""
    first = asked.first()
    if first is None:
        return np.zeros(0, np.int64), np.zeros((0, 1))
    most = min(most, max(1, BROADCAST_CELLS // max(1, len(first["query_vector"]))))
    held = asked.limit(most + 1).collect()
    if len(held) > most:
        return None
    return np.array([row["query_id"] for row in held]), _unit([row["query_vector"] for row in held])


def _store_queries(asked: DataFrame) -> str:
    folder = f"{scratch_root(asked.sparkSession)}/queries"
    asked.select("query_id", F.col("query_vector").cast("array<double>").alias("query_vector")).write.parquet(folder)
    return folder


def _scorer(query_ids: np.ndarray, matrix: np.ndarray, k: int, schema: T.StructType, by_cell: dict[int, np.ndarray] | None = None):
    """Arrow batches of (vec_id, vector) to the task's best k per query.

    ``by_cell`` names, for each cell (the batches' third column), the queries to score there.
    """
    arrow_schema = to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for batch in batches:
            if batch.num_rows and len(query_ids):
                _score_batch(best, query_ids, matrix, batch, by_cell)
        yield from _found(best, arrow_schema)

    return score


def _score_batch(best: _Best, query_ids, matrix, batch, by_cell) -> None:
    ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), _unit(batch.column(1))
    if by_cell is None:
        _score_into(best, query_ids, matrix, ids, vectors)
        return
    cells = batch.column(2).to_numpy(zero_copy_only=False)
    order = np.argsort(cells, kind="stable")
    starts = np.flatnonzero(np.diff(cells[order], prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(order)], strict=True):
        own, asking = order[start:end], by_cell.get(int(cells[order[start]]))
        if asking is not None and len(asking):
            _score_into(best, query_ids[asking], matrix[asking], ids[own], vectors[own])


def _found(best: _Best, arrow_schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    found = pa.Table.from_pandas(best.frame(), schema=arrow_schema, preserve_index=False)
    yield from found.combine_chunks().to_batches()


def _chunk_scorer(folder: str, k: int, schema: T.StructType, block_cells: int, chunk_cells: int, cells_of=None, columns: tuple[str, ...] = ("query_id", "query_vector")):
    """Arrow batches of (vec_id, vector) to the best k per query and block, over all queries stored in ``folder``.

    ``cells_of`` gives, for a chunk of stored queries, which of them to score in each cell.
    """
    arrow_schema = to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _gathered(batches, block_cells):
            for asked in _stored_chunks(folder, chunk_cells, columns):
                best, matrix = _Best(k), _unit(asked.column(1))
                query_ids = asked.column(0).to_numpy(zero_copy_only=False)
                _score_batch(best, query_ids, matrix, block, None if cells_of is None else cells_of(asked))
                yield from _found(best, arrow_schema)

    return score


def _gathered(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.RecordBatch]:
    """Batches joined up to ``cells`` vector components."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 65_536):
            part = batch.slice(at, 65_536)
            held.append(part)
            size += len(part.column(1).flatten())
            if size >= cells:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _stored_chunks(folder: str, cells: int, columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Stored queries, chunk by chunk, straight from the shared folder."""
    files, root = open_folder(folder)
    names = sorted(f.path for f in files.get_file_info(FileSelector(root)) if f.path.endswith(".parquet"))
    for name in names:
        with files.open_input_file(name) as opened:
            # Read through a buffer: without one, a whole row group's column is held, which grows with the table.
            stored = pq.ParquetFile(opened, buffer_size=1 << 20)
            if not stored.metadata.num_rows:
                continue
            dimension = max(1, stored.metadata.row_group(0).column(1).num_values // stored.metadata.row_group(0).num_rows)
            yield from stored.iter_batches(batch_size=max(1, cells // dimension), columns=list(columns))


def nearest_one(vectors: DataFrame, query: list[float], k: int = 5, *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Exact k nearest of one query vector, entirely in the JVM: every task keeps its own k."""
    length = float(np.sqrt(np.dot(query, query)))
    # The query is scaled here, once, so that a row costs one product and its own length.
    asked = F.array(*[F.lit(float(x) / length if length else 0.0) for x in query])
    own = F.nullif(norm(F.col(vector)), F.lit(0.0))
    similarity = dot(F.col(vector), asked) / own if length else F.lit(None).cast("double")
    return (
        vectors.withColumn("similarity", F.round(similarity, DIGITS))
        .filter(F.col("similarity").isNotNull())
        .orderBy(F.desc("similarity"), F.asc(vec_id))
        .limit(k)
    )


class CellIndex:
    """Vectors grouped into cells around trained centres; a search looks into a query's nearest cells only.

    Store the assigned frame partitioned by ``cell`` and a search reads just the probed folders. A cell may
    hold any share of the vectors: its rows are scored where they lie, by the queries that look into it alone.
    """

    def __init__(self, centres: np.ndarray):
        self.centres = _unit(list(centres))

    @classmethod
    def train(cls, vectors: DataFrame, cells: int, *, vector: str = "embedding", seed: int = 42, rounds: int = 8) -> "CellIndex":
        length = norm(F.col(vector))
        scaled = vectors.select(F.col(vector), length.alias("__norm")).filter(F.col("__norm") > 0).select(
            array_to_vector(F.transform(F.col(vector).cast("array<double>"), lambda x: x / F.col("__norm"))).alias("features")
        )
        # Every round of the training reads the unit vectors; they are computed and stored once.
        scaled = stored(scaled, "unit-vectors")
        model = KMeans(k=cells, seed=seed, maxIter=rounds, initSteps=2).fit(scaled)
        return cls(np.array(model.clusterCenters()))

    def assign(self, vectors: DataFrame, *, vector: str = "embedding", out: str = "cell") -> DataFrame:
        centres = self.centres

        @F.pandas_udf("int")
        def nearest_centre(batch: pd.Series) -> pd.Series:
            return pd.Series((_unit(batch) @ centres.T).argmax(axis=1), index=batch.index)

        return vectors.filter(F.col(vector).isNotNull()).withColumn(out, nearest_centre(F.col(vector)))

    def nearest(
        self,
        assigned: DataFrame,
        queries: DataFrame,
        k: int = 5,
        *,
        probes: int = 4,
        vec_id: str = "vec_id",
        vector: str = "embedding",
        cell: str = "cell",
        query_id: str = "query_id",
        query_vector: str = "query_vector",
        broadcast_queries: int = BROADCAST_QUERIES,
    ) -> DataFrame:
        """k nearest among the ``probes`` nearest cells of each query.

        Where those hold fewer than k vectors, the next cells are probed as well, until k are there or no cell is left.
        """
        asked, kept, schema = _columns(assigned, queries, vec_id, vector, query_id, query_vector, F.col(cell).alias("cell"))
        counted = kept.filter(norm(F.col("vector")) > 0).groupBy("cell").count().collect()  # one row per centre
        counts = np.zeros(len(self.centres), np.int64)
        for row in counted:
            counts[row["cell"]] = row["count"]
        centres = self.centres

        def cells_of(matrix: np.ndarray) -> dict[int, np.ndarray]:
            order = np.argsort(-(matrix @ centres.T), axis=1, kind="stable")
            before = np.cumsum(counts[order], axis=1) - counts[order]
            probed = (np.arange(order.shape[1]) < probes) | (before < k)
            return {c: np.flatnonzero(((order == c) & probed).any(axis=1)) for c in range(len(centres))}

        held = _few(asked, broadcast_queries)
        if held is None:
            score = _chunk_scorer(_store_queries(asked), k, schema, BLOCK_CELLS, CHUNK_CELLS, lambda asking: cells_of(_unit(asking.column(1))))
            return _final_top(kept.mapInArrow(score, schema), k)
        query_ids, matrix = held
        by_cell = cells_of(matrix) if len(query_ids) else {}
        read = [c for c, asking in by_cell.items() if len(asking)]
        return _final_top(kept.filter(F.col("cell").isin(read)).mapInArrow(_scorer(query_ids, matrix, k, schema, by_cell), schema), k)


class BoundedSearch:
    """Exact search over the cells of a :class:`CellIndex` that reads no cell which cannot hold a better neighbour.

    A cell's radius is the largest angle between its centre and a vector in it. By the triangle inequality of angles no
    vector of a cell is nearer to a query than the centre's angle less the radius, so a cell whose best possible
    similarity is below a query's k-th best so far is left unread. Each round reads the next ``probes`` cells of every query
    (twice as many each time), and it ends when no query has a cell left that it needs.

    Queries and what they have found lie in the shared folder between rounds; per round the driver learns which cells are asked.
    """

    def __init__(self, index: CellIndex, assigned: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", cell: str = "cell"):
        self.index = index
        self.rows = assigned.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(cell).alias("cell")).filter(norm(F.col("vector")) > 0)
        centres = index.centres

        @F.pandas_udf("double")
        def away(vectors: pd.Series, cells: pd.Series) -> pd.Series:
            near = (_unit(vectors) * centres[cells.to_numpy()]).sum(axis=1)
            return pd.Series(np.arccos(np.clip(near, -1, 1)), index=vectors.index)

        self.radii = np.full(len(centres), -np.inf)
        for row in self.rows.groupBy("cell").agg(F.max(away("vector", "cell")).alias("radius")).collect():  # one row per centre
            self.radii[row["cell"]] = row["radius"]
        self.cells_read = 0.0

    def nearest(self, queries: DataFrame, k: int = 5, *, probes: int = 2, query_id: str = "query_id", query_vector: str = "query_vector") -> DataFrame:
        """(query_id, vec_id, similarity, rank) of the exact k nearest. ``cells_read`` then says which share of cells a query read."""
        spark = self.rows.sparkSession
        asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("query_vector"))
        asked = stored(asked.filter(F.col("query_vector").isNotNull()).withColumn("floor", F.lit(float("-inf"))).withColumn("from_place", F.lit(0)), "asked")
        schema = T.StructType().add("query_id", asked.schema["query_id"].dataType).add("vec_id", self.rows.schema["vec_id"].dataType).add("similarity", T.DoubleType())
        total, reads, found = asked.count(), 0, spark.createDataFrame([], schema)
        upto = probes
        while True:
            needed = _cells_needed(self.index.centres, self.radii, upto)
            wanted = stored(asked.mapInArrow(_asks_per_cell(needed), "cell int, n long"), "wanted").groupBy("cell").agg(F.sum("n").alias("n")).collect()
            if not wanted:
                break
            reads += sum(row["n"] for row in wanted)
            folder = f"{scratch_root(spark)}/asking"
            asked.write.parquet(folder)
            score = _chunk_scorer(folder, k, schema, BLOCK_CELLS, CHUNK_CELLS, _asking_by_cell(needed), ("query_id", "query_vector", "floor", "from_place"))
            here = self.rows.filter(F.col("cell").isin([row["cell"] for row in wanted])).mapInArrow(score, schema)
            found = stored(_final_top(found.unionByName(here), k).drop("rank"), "found")
            floors = found.groupBy("query_id").agg(F.min("similarity").alias("last"), F.count("*").alias("n"))
            floor = F.when(F.col("n") >= k, F.col("last")).otherwise(F.lit(float("-inf")))
            asked = stored(asked.drop("floor", "from_place").join(floors, "query_id", "left").select("query_id", "query_vector", floor.alias("floor"), F.lit(upto).alias("from_place")), "asked")
            if upto >= len(self.radii):
                break
            upto = min(3 * upto, len(self.radii))
        self.cells_read = reads / max(1, total * len(self.radii))
        return _final_top(found, k)


def _best_possible(matrix: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """The best similarity that each cell may hold for each query; minus infinity for an empty cell and a query without direction."""
    angle = np.arccos(np.clip(matrix @ centres.T, -1, 1))
    best = np.cos(np.maximum(angle - radii[None, :], 0)) + 10.0**-DIGITS * 2
    return np.where(np.isneginf(radii)[None, :] | ~matrix.any(axis=1)[:, None], -np.inf, best)


def _cells_needed(centres: np.ndarray, radii: np.ndarray, upto: int):
    """Which cells each query has to read among those from its place up to ``upto`` in the order of their bounds."""

    def needed(batch: pa.RecordBatch) -> np.ndarray:
        bounds = _best_possible(_unit(batch.column(1)), centres, radii)
        order = np.argsort(-bounds, axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
        start, floor = batch.column(3).to_numpy()[:, None], batch.column(2).to_numpy()[:, None]
        return (place >= start) & (place < upto) & (bounds >= floor) & np.isfinite(bounds)

    return needed


def _asks_per_cell(needed):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                asks = needed(batch).sum(axis=0)
                cells = np.flatnonzero(asks)
                yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(asks[cells].astype(np.int64))], ["cell", "n"])

    return count


def _asking_by_cell(needed):
    def cells_of(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        asks = needed(batch)
        return {int(c): np.flatnonzero(asks[:, c]) for c in np.flatnonzero(asks.any(axis=0))}

    return cells_of


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours that were found."""
    pairs = ["query_id", "vec_id"]
    total = exact.count()
    return exact.join(found.select(*pairs), pairs, "left_semi").count() / total if total else 1.0
