"""Approximate nearest neighbours by inner product, over balanced posting lists.

1. Fit. At most ``sample_rows`` vectors go to the driver. They are split again and again into balanced halves of a few
   groups each (k-means whose cost grows with a group's size) until there are twice as many groups as the root of the
   table's rows, at most ``most_lists``. The centroids and a graph over them (nearest centroids plus a ring, so that all can be
   reached) are small and go to the tasks.
2. Index. Every row walks the graph to its nearest centroids and joins the list of the nearest, and up to
   ``copies`` - 1 further ones whose centroid is at most ``border`` times as far: vectors at a border lie on both sides of it.
3. Search. A query walks the graph and asks the lists whose centroid is at most ``ratio`` times as far as its nearest
   one (and the nearest until they hold enough rows). The ratio is measured while fitting: among sampled vectors that the
   centroids were not fitted to, queries look for their true neighbours, as many as the ``k`` nearest of the table have in that
   part, and the ratio is set so that the asked lists hold ``recall`` of them. A walk that does not reach beyond the ratio
   is done again over all centroids.

Lists are packed into groups of at most ``group_rows`` rows, and one that is larger, such as that of a vector which a third of
the rows share, is cut by row over several. A task holds one group and reads the queries that ask it as a stream. Scores are plain
double sums over the components in order, so equal vectors tie exactly; the best of each group are merged by query.

Inner product becomes distance by one more component, sqrt(M^2 - |x|^2) with M the largest norm. Vectors that are NULL,
zero, or hold a NULL or non-finite component, and rows without an id, take no part. Components beyond a shorter vector's end count as zero.
Rows that agree in id and score count once. A query meets every row except those with its own id. Ties go to the smaller id. Empty
tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwright.llm.common import dense_bounds, prepare, staged

DEGREE, STEP, ENTRIES = 24, 4, 8
CHUNK = 256
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part."""
    values = F.col("embedding")
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0)
    return vectors.filter(F.col("vec_id").isNotNull() & values.isNotNull() & sound).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, short rows filled with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width))
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lists)), lengths), at] = values
    return out


def _apart(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    far = (points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * points @ centres.T
    return np.maximum(far, 0)


def balanced_centres(points: np.ndarray, lists: int, seed: int = 7, fan: int = 8, turns: int = 10) -> np.ndarray:
    """Centres of ``lists`` groups of about equal size."""
    if lists <= 1 or len(points) <= 1:
        return points.mean(0, keepdims=True)
    k = min(fan, lists, len(points))
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), k, replace=False)]
    own = np.zeros(len(points), np.int64)
    weight = np.zeros(k)
    for _ in range(turns):
        far = _apart(points, centres)
        scale = far.min(1).mean() + 1e-30
        # A group that holds more than its share becomes dearer, a smaller one cheaper.
        own = (far + weight * scale).argmin(1)
        sizes = np.bincount(own, minlength=k)
        weight += 0.2 * (sizes * k / len(points) - 1)
        for at in np.flatnonzero(sizes):
            centres[at] = points[own == at].mean(0)
    # A group far below its share is dissolved: a list of next to nothing would mislead the queries nearest to it.
    small = np.bincount(own, minlength=k) * k < 0.5 * len(points)
    if small.any():
        far = _apart(points, centres)
        own = np.where(small, np.inf, far).argmin(1) if not small.all() else np.zeros(len(points), np.int64)
    sizes = np.bincount(own, minlength=k)
    if (sizes > 0).sum() == 1:
        # Nothing parts these points; cut them as they lie along their widest component.
        order = points[:, points.std(0).argmax()].argsort(kind="stable")
        own[order] = np.arange(len(points)) * k // len(points)
        sizes = np.bincount(own, minlength=k)
    wanted = np.maximum(np.floor(sizes * lists / len(points)), sizes > 0).astype(int)
    while wanted.sum() < lists and (sizes / (wanted + 1)).max() >= 1:
        wanted[(sizes / (wanted + 0.5)).argmax()] += 1
    return np.concatenate([balanced_centres(points[own == at], wanted[at], seed + 1 + at) for at in range(k) if sizes[at]])


@dataclass
class Lists:
    """Centroids, the graph over them and what a search needs to know."""

    centres: np.ndarray
    width: int  # components of a vector
    scale: float  # largest component of any vector
    longest: float  # largest norm of any vector, after scaling
    copies: int = 2
    border: float = 1.15
    ratio: float = float("inf")
    floor: float = 0.0  # a query nearer than this to a centroid asks as if it were this far
    graph: np.ndarray = field(default=None, repr=False)
    beam: int = 64

    def __post_init__(self):
        n = len(self.centres)
        far = _apart(self.centres, self.centres)
        np.fill_diagonal(far, np.inf)
        near = np.argsort(far, axis=1, kind="stable")[:, : min(DEGREE, n - 1)]
        order = np.random.default_rng(11).permutation(n)
        ring = np.empty((n, 1), np.int64)
        ring[order, 0] = np.roll(order, -1)
        self.graph = np.concatenate([near, ring], axis=1)
        self.entries = order[:: max(1, n // ENTRIES)][:ENTRIES]

    def placed(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors as points among which a nearer one has the larger inner product with a query."""
        points = vectors / self.scale
        rest = np.sqrt(np.maximum(self.longest**2 - (points**2).sum(1), 0))
        return np.concatenate([points, rest[:, None]], axis=1)

    def asked(self, vectors: np.ndarray) -> np.ndarray:
        """Queries as points: only their direction matters."""
        vectors = vectors / np.abs(vectors).max(1, keepdims=True)
        vectors *= self.longest / np.sqrt((vectors**2).sum(1, keepdims=True))
        return np.concatenate([vectors, np.zeros((len(vectors), 1))], axis=1)

    def walk(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroids found from the entries along the graph, nearest first, and how far they are."""
        n, beam = len(points), min(beam, len(self.centres))
        norm = (self.centres**2).sum(1)
        own = (points**2).sum(1)
        ids = np.tile(self.entries, (n, 1))
        far = np.maximum(own[:, None] + norm[self.entries] - 2 * points @ self.centres[self.entries].T, 0)
        seen = np.zeros((n, len(self.centres)), bool)
        seen[:, self.entries] = True
        opened = np.zeros(ids.shape, bool)
        rows = np.arange(n)[:, None]
        while True:
            waiting = np.where(opened, np.inf, far)
            pick = np.argpartition(waiting, min(STEP, waiting.shape[1]) - 1, axis=1)[:, :STEP]
            live = np.isfinite(np.take_along_axis(waiting, pick, 1))
            if not live.any():
                break
            np.put_along_axis(opened, pick, True, 1)
            at, place = np.nonzero(live)
            fresh = self.graph[ids[at, pick[at, place]]]
            flat = np.repeat(at, fresh.shape[1]) * len(self.centres) + fresh.ravel()
            flat = np.unique(flat[~seen.ravel()[flat]])
            at, fresh = np.divmod(flat, len(self.centres))
            if not len(at):
                continue
            seen[at, fresh] = True
            distance = np.maximum(own[at] + norm[fresh] - 2 * np.einsum("ij,ij->i", points[at], self.centres[fresh]), 0)
            starts = dense_bounds(at)
            more = int(np.diff(starts).max())
            column = np.arange(len(at)) - np.repeat(starts[:-1], np.diff(starts))
            new_ids, new_far = np.zeros((n, more), np.int64), np.full((n, more), np.inf)
            new_ids[at, column], new_far[at, column] = fresh, distance
            ids, far = np.concatenate([ids, new_ids], 1), np.concatenate([far, new_far], 1)
            opened = np.concatenate([opened, np.isinf(new_far)], 1)
            if ids.shape[1] > beam:
                keep = np.argpartition(far, beam - 1, axis=1)[:, :beam]
                ids, far, opened = ids[rows, keep], far[rows, keep], opened[rows, keep]
        order = np.argsort(far, axis=1, kind="stable")
        return ids[rows, order], np.sqrt(far[rows, order])

    def homes(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lists that rows join, and which of them count."""
        ids, far = self.walk(points, max(16, 4 * self.copies))
        ids, far = ids[:, : self.copies], far[:, : self.copies]
        return ids, np.isfinite(far) & (far <= self.border * far[:, :1])

    def questions(self, points: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
        """Which lists each query asks, as a matrix: those within the ratio, and the nearest until they hold ``least`` rows."""
        asks = np.zeros((len(points), len(self.centres)), bool)
        ids, far = self.walk(points, self.beam)
        held = np.cumsum(sizes[ids], axis=1) - sizes[ids]
        near = np.isfinite(far) & ((far <= self.ratio * np.maximum(far[:, :1], self.floor)) | (held < least))
        at, place = np.nonzero(near)
        asks[at, ids[at, place]] = True
        if ids.shape[1] < len(self.centres):
            # The ratio lies beyond what the walk reached: measure all centroids.
            short = np.flatnonzero(near[:, -1])
            whole = np.sqrt(_apart(points[short], self.centres))
            order = np.argsort(whole, axis=1, kind="stable")
            held = np.empty(whole.shape, np.int64)
            np.put_along_axis(held, order, np.cumsum(sizes[order], axis=1) - sizes[order], 1)
            asks[short] = (whole <= self.ratio * np.maximum(whole.min(1, keepdims=True), self.floor)) | (held < least)
        return asks


def fit(vectors: DataFrame, *, k: int = 20, recall: float = 0.97, most_lists: int = 2048, sample_rows: int = 49_152, trials: int = 512, copies: int = 2, border: float = 1.15) -> Lists | None:
    """Centroids and search ratio for a table of ``usable`` rows; None where there is no row."""
    doubles = F.col("embedding").cast("array<double>")
    size = F.array_max(F.transform(doubles, F.abs))
    found = vectors.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width"), F.max(size).alias("scale")).first()
    if not found["n"]:
        return None
    scale, width = found["scale"], found["width"]
    norm = F.aggregate(doubles, F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale))
    longest = float(np.sqrt(vectors.agg(F.max(norm)).first()[0]))
    wanted = sample_rows
    chance = min(1.0, 0.95 * wanted / found["n"])
    # Which rows are sampled depends on their content alone, so a retried task takes the same.
    pick = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 20)) < int(chance * (1 << 20)) if chance < 1 else F.lit(True)
    rows = vectors.filter(pick).select("vec_id", "embedding").limit(wanted).toArrow().combine_chunks()
    ids = rows.column("vec_id").to_numpy()
    sample = matrix(rows.column("embedding").chunk(0), width)
    order = np.random.default_rng(3).permutation(len(sample))
    ids, sample = ids[order], sample[order]
    lists = Lists(np.zeros((1, width + 1)), width, scale, longest, copies, border)
    points = lists.placed(sample)
    # A third of the sample is not fitted to: those rows stand for all others when the ratio is measured.
    kept = len(sample) // 3
    distinct = np.unique(points[kept:], axis=0)
    count = int(min(most_lists, 2 * math.isqrt(found["n"]), max(1, len(distinct) // 4)))
    lists = Lists(balanced_centres(distinct, count), width, scale, longest, copies, border)
    if kept > 1:
        near = min(-(-k * kept // found["n"]), kept - 1)
        lists.floor, lists.ratio, lists.beam = _measured(lists, points[:kept], sample[:kept], ids[:kept], min(trials, kept), near, recall)
    return lists


def _measured(lists: Lists, points: np.ndarray, sample: np.ndarray, ids: np.ndarray, tried: int, k: int, recall: float) -> tuple[float, float, int]:
    """The least distance to go by, the ratio at which lists hold ``recall`` of the sample's true neighbours, and how many lists that is for most queries."""
    homes, distances = [], []
    for at in range(0, len(points), 1024):
        far = _apart(points[at : at + 1024], lists.centres)
        some = min(lists.copies, far.shape[1])
        ids_near = np.argpartition(far, some - 1, axis=1)[:, :some]
        homes.append(ids_near)
        distances.append(np.sqrt(np.take_along_axis(far, ids_near, 1)))
    home, near = np.concatenate(homes), np.concatenate(distances)
    joined = near <= lists.border * near.min(1, keepdims=True)
    far = np.sqrt(_apart(lists.asked(sample[:tried]), lists.centres))
    floor = float(np.quantile(far.min(1), 0.1))
    far /= np.maximum(far.min(1, keepdims=True), max(floor, 1e-300))
    needed = []
    for at in range(0, tried, 64):
        rows = slice(at, min(at + 64, tried))
        scores = sample[rows] @ sample.T
        scores[ids[rows, None] == ids[None, :]] = -np.inf
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        reach = np.take_along_axis(far[rows, None, :], home[best], 2)
        needed.append(np.where(joined[best], reach, np.inf).min(2))
    ratio = float(np.quantile(np.concatenate(needed), recall)) * (1 + 1e-9)
    # A walk as broad as most queries need; the others measure all centroids.
    return floor, ratio, int(1.1 * np.quantile((far <= ratio).sum(1), 0.9)) + 8


def _groups(sizes: dict[int, int], group_rows: int) -> list[list[int]]:
    """For every list the groups its rows are dealt to; a list that fills more than one group has groups of its own."""
    held: list[list[int]] = []
    group, room = -1, 0
    for number in range(max(sizes, default=-1) + 1):
        n = sizes.get(number, 0)
        if n > group_rows:
            pieces = -(-n * 5 // (group_rows * 4))
            held.append(list(range(group + 1, group + 1 + pieces)))
            group, room = group + pieces, 0
            continue
        if n > room:
            group, room = group + 1, group_rows
        held.append([group] if n else [])
        room -= n
    return held


def search(vectors: DataFrame, queries: Column, lists: Lists | None = None, *, k: int = 20, group_rows: int = 32_768, **settings) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for every row that ``queries`` selects.

    ``lists`` may be fitted beforehand; ``settings`` go to ``fit`` otherwise.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = usable(vectors)
    lists = lists or fit(rows, k=k, **settings)
    if lists is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = rows.schema["embedding"].dataType.simpleString()
    postings = staged(rows.mapInArrow(_indexed(lists), f"list int, vec_id long, embedding {kind}"), "postings")
    sizes = {r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}
    held = _groups(sizes, group_rows)
    table = spark.createDataFrame([(n, g) for n, g in enumerate(held) if g], "list int, groups array<int>")
    placed = postings.join(F.broadcast(table), "list")
    group = F.element_at("groups", (F.pmod(F.xxhash64("vec_id"), F.size("groups").cast("long")) + 1).cast("int"))
    stored = placed.select(group.alias("group"), F.lit(0).alias("kind"), "list", "vec_id", "embedding", F.lit(None).cast("array<int>").alias("asked"))
    counts = np.array([sizes.get(n, 0) for n in range(len(lists.centres))], np.int64)
    asking = rows.filter(queries).mapInArrow(_questions(lists, held, counts, (k + 1) * lists.copies), f"group int, kind int, list int, vec_id long, embedding {kind}, asked array<int>")
    both = stored.unionByName(asking).repartition("group").sortWithinPartitions("group", "kind", "list", "vec_id")
    found = both.mapInArrow(_scored(lists.width, k, lists.copies), "query_id long, vec_id long, score double").dropDuplicates()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall_of(found: DataFrame, vectors: DataFrame, queries: Column, k: int = 20) -> float:
    """Share of the true ``k`` nearest rows that ``found`` holds; the true ones come from asking every list."""
    rows = usable(vectors)
    lists = fit(rows, k=k)
    if lists is None:
        return 1.0
    lists.ratio = float("inf")
    true = search(vectors, queries, lists, k=k)
    hits = true.join(found.select("query_id", "vec_id").distinct(), ["query_id", "vec_id"], "left_semi").count()
    return hits / max(true.count(), 1)


def _indexed(lists: Lists):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                ids, counts = lists.homes(lists.placed(matrix(batch.column("embedding"), lists.width)))
                row, copy = np.nonzero(counts)
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(ids[row, copy].astype(np.int32)), batch.column("vec_id").take(pick), batch.column("embedding").take(pick)], ["list", "vec_id", "embedding"])

    return run


def _questions(lists: Lists, held: list[list[int]], sizes: np.ndarray, least: int):
    """A row for every query and group it asks, with the lists it asks there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_list = np.array([n for n, groups in enumerate(held) for _ in groups], np.int64)
        group = np.array([g for groups in held for g in groups], np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                asks = lists.questions(lists.asked(matrix(batch.column("embedding"), lists.width)), sizes, least)
                row, place = np.nonzero(asks[:, of_list])
                order = np.lexsort((group[place], row))
                row, place = row[order], place[order]
                starts = dense_bounds(row * (len(group) + 1) + group[place])
                pick, n = pa.array(row[starts[:-1]]), len(starts) - 1
                asked = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(of_list[place].astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[place[starts[:-1]]].astype(np.int32)), pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int32()), batch.column("vec_id").take(pick), batch.column("embedding").take(pick), asked],
                    ["group", "kind", "list", "vec_id", "embedding", "asked"],
                )

    return run


def _scored(width: int, k: int, copies: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, postings, ready = None, [], None
        for batch in batches:
            key = batch.column("group").to_numpy() * 2 + batch.column("kind").to_numpy()
            edges = dense_bounds(key)
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                some, number, kind = batch.slice(low, high - low), int(key[low]) // 2, int(key[low]) % 2
                if number != group:
                    group, postings, ready = number, [], None
                if kind == 0:
                    postings.append(some.select(["list", "vec_id", "embedding"]))
                    continue
                if not postings and ready is None:
                    continue
                if ready is None:
                    table = pa.Table.from_batches(postings).combine_chunks()
                    ready = table.column("list").to_numpy(), table.column("vec_id").to_numpy(), matrix(table.column("embedding").chunk(0), width)
                    postings = []
                for at in range(0, some.num_rows, CHUNK):
                    yield _best(some.slice(at, CHUNK), *ready, width, k, copies)

    return run


def _best(asking: pa.RecordBatch, of_list: np.ndarray, ids: np.ndarray, held: np.ndarray, width: int, k: int, copies: int) -> pa.RecordBatch:
    """The best rows of one group for some queries."""
    queries, own = matrix(asking.column("embedding"), width), asking.column("vec_id").to_numpy()
    asked = asking.column("asked")
    wants = asked.flatten().to_numpy()
    who = np.repeat(np.arange(len(own)), np.diff(asked.offsets.to_numpy()))
    order = np.argsort(wants, kind="stable")
    wants, who = wants[order], who[order]
    scores = np.full((len(own), len(ids)), -np.inf)
    edges = dense_bounds(of_list)
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        some = who[np.searchsorted(wants, of_list[low]) : np.searchsorted(wants, of_list[low], "right")]
        if len(some):
            scores[some, low:high] = queries[some] @ held[low:high].T
    scores[own[:, None] == ids[None, :]] = -np.inf
    query_ids, vec_ids, values = [], [], []
    for at in range(len(own)):
        row = scores[at]
        for most in (k * copies, len(row)):
            if len(row) > most:
                edge = np.partition(row, len(row) - most)[len(row) - most]
                # Products of whole blocks differ in the last digits; near ties are summed again one by one.
                places = np.flatnonzero((row >= edge - 1e-9 * abs(edge)) & (row > -np.inf)) if edge > -np.inf else np.flatnonzero(row > -np.inf)
            else:
                places = np.flatnonzero(row > -np.inf)
            exact = np.zeros(len(places))
            for component in range(width):
                exact += queries[at, component] * held[places, component]
            order = np.lexsort((ids[places], -exact))
            found, value = ids[places][order], exact[order]
            once = np.ones(len(found), bool)
            once[1:] = (found[1:] != found[:-1]) | (value[1:] != value[:-1])
            found, value = found[once], value[once]
            if len(found) >= k or len(places) == len(row):
                break
        query_ids.append(np.full(min(k, len(found)), own[at]))
        vec_ids.append(found[:k])
        values.append(value[:k])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (query_ids, vec_ids, values)], schema=_FOUND)
