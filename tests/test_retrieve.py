import numpy as np
import pytest
from pyspark.sql import functions as F

from snapwright.operators import retrieve
from snapwright.operators.collection import Collection
from snapwright.operators.embed import encoder
from snapwright.operators.retrieve import BoundedSearch, CellIndex, nearest, nearest_one, recall


def frame(spark, vectors, name="vec_id", column="embedding"):
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{name} long, {column} array<float>")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 12))
    vectors = centres[rng.integers(0, 6, 600)] + 0.4 * rng.normal(size=(600, 12))
    vectors[:200] = vectors[0]  # a third of all vectors are copies
    vectors[300] = 0
    queries = vectors[[0, 250, 400, 599]] + 0.05
    return vectors.astype(np.float32), queries.astype(np.float32)


def brute(vectors, queries, k):
    found = {}
    for q, query in enumerate(queries.astype(float)):
        scored = []
        for i, vector in enumerate(vectors.astype(float)):
            if vector.any():
                similarity = vector @ query / np.sqrt((vector @ vector) * (query @ query))
                scored.append((-round(similarity, 9), i))
        found[q] = [i for _, i in sorted(scored)[:k]]
    return found


def listed(df):
    found = {}
    for row in df.orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append(row.vec_id)
    return found


@pytest.mark.parametrize("cells", [{}, {"broadcast_queries": 1, "block_cells": 12 * 70}])
def test_exact_equals_brute_force(spark, data, cells):
    vectors, queries = data
    stored, asked = frame(spark, vectors).repartition(5), frame(spark, queries, "query_id", "query_vector")
    for k in (1, 10, 250):
        assert listed(nearest(stored, asked, k, **cells)) == brute(vectors, queries, k)


def test_small_matrices_give_the_same(spark, data, monkeypatch):
    vectors, queries = data
    best = retrieve._Best(10)
    monkeypatch.setattr(retrieve, "MATRIX_CELLS", 20)
    monkeypatch.setattr(retrieve, "SETTLE_ROWS", 15)
    ids = np.arange(len(queries)), np.arange(len(vectors))
    retrieve._score_into(best, ids[0], retrieve._unit(queries), ids[1], retrieve._unit(vectors))
    got = best.frame()
    assert {q: list(got[got.query_id == q].vec_id) for q in range(4)} == brute(vectors, queries, 10)


def test_one_query_in_the_jvm(spark, data):
    vectors, queries = data
    got = nearest_one(frame(spark, vectors), list(queries[1]), 10)
    assert [r.vec_id for r in got.collect()] == brute(vectors, queries[1:2], 10)[0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Python" not in plan


def test_ties_go_by_id_and_zero_vectors_never_match(spark):
    stored = frame(spark, [[1, 0], [0, 0], [2, 0], [0, 1], [1, 0]])
    asked = frame(spark, [[1, 0], [0, 0]], "query_id", "query_vector")
    assert listed(nearest(stored, asked, 3)) == {0: [0, 2, 4]}
    assert listed(nearest(stored, asked, 9)) == {0: [0, 2, 4, 3]}


def test_no_queries(spark, data):
    stored = frame(spark, data[0])
    asked = frame(spark, [[1.0] * 12], "query_id", "query_vector").filter("false")
    assert nearest(stored, asked, 3).count() == 0


def test_approximate_recall_and_joined_form(spark, data):
    vectors, queries = data
    stored, asked = frame(spark, vectors), frame(spark, queries, "query_id", "query_vector")
    exact = nearest(stored, asked, 10)
    index = CellIndex.train(stored, 6)
    assigned = index.assign(stored)
    assert recall(index.nearest(assigned, asked, 10, probes=3), exact) >= 0.9
    # Looking into every cell is exact.
    assert recall(index.nearest(assigned, asked, 10, probes=6), exact) == 1.0
    held = index.nearest(assigned, asked, 10, probes=2)
    joined = index.nearest(assigned, asked, 10, probes=2, broadcast_queries=1)
    assert listed(held) == listed(joined)


def test_registered_search_holds_nine_tenths_of_the_neighbours(spark, sf_dir):
    from snapwright.plans.queries import QUERIES

    assert recall(QUERIES["knn_approx"](spark, sf_dir), QUERIES["knn_all_pairs"](spark, sf_dir)) >= 0.9


def test_bounded_search_is_exact_and_leaves_cells_unread(spark, data):
    vectors, queries = data
    rng = np.random.default_rng(8)
    middles = rng.normal(size=(9, 12)) * 4
    tight = [*(middles[i % 9] + rng.normal(size=12) * 0.2 for i in range(900)), np.zeros(12), *vectors]
    stored, asked = frame(spark, tight), frame(spark, [*middles[:4], *queries, np.zeros(12)], "query_id", "query_vector")
    search = BoundedSearch(CellIndex(np.array(middles)), CellIndex(np.array(middles)).assign(stored))
    assert listed(search.nearest(asked, 10, probes=1)) == listed(nearest(stored, asked, 10))
    assert search.nearest(asked.filter("query_id < 4"), 10, probes=1).count() == 40 and search.cells_read < 0.9
    far = search.nearest(asked.limit(0), 10)
    assert far.count() == 0
    # More neighbours than there are rows: all cells are read.
    few = BoundedSearch(CellIndex(np.array(middles)), CellIndex(np.array(middles)).assign(stored.limit(30)))
    assert listed(few.nearest(asked, 50, probes=1)) == listed(nearest(stored.limit(30), asked, 50))


def test_probed_cells_prune_the_stored_folders(spark, data, tmp_path):
    stored = frame(spark, data[0])
    index = CellIndex.train(stored, 6)
    index.assign(stored).write.partitionBy("cell").parquet(str(tmp_path / "cells"))
    assigned = spark.read.parquet(str(tmp_path / "cells"))
    found = index.nearest(assigned, frame(spark, data[1][:1], "query_id", "query_vector"), 5, probes=1)
    assert found.count() == 5
    assert "PartitionFilters: [isnotnull(cell" in found._jdf.queryExecution().executedPlan().toString()


def test_collection(spark, tmp_path):
    collection = Collection(spark, str(tmp_path / "c"), encoder("hashed", dimension=256), 256)
    documents = spark.createDataFrame(
        [
            ("a", "free hot meals daily", {"city": "Oakland", "page": "1"}),
            ("b", "free hot meals", {"city": "San Jose"}),
            ("c", "legal help for tenants", {"city": "Oakland"}),
        ],
        "doc_id string, text string, metadata map<string,string>",
    )
    assert sorted(r.doc_id for r in collection.add_documents(documents).collect()) == ["a", "b", "c"]
    asked = spark.createDataFrame([(1, "hot meals"), (2, "tenants legal")], "query_id long, text string")
    top = {r.query_id: r.doc_id for r in collection.similarity_search(asked, 1).collect()}
    assert top == {1: "b", 2: "c"}
    here = collection.similarity_search(asked, 1, {"city": "Oakland"}).collect()
    assert {r.query_id: r.doc_id for r in here} == {1: "a", 2: "c"}
    assert collection.similarity_search(asked, 5, {"city": "Nowhere"}).count() == 0
    # Adding an id again replaces it.
    collection.add_documents(documents.filter("doc_id = 'c'").withColumn("text", F.lit("hot meals")))
    assert collection.documents().count() == 3
    assert {r.doc_id for r in collection.similarity_search(asked.filter("query_id = 1"), 1).collect()} == {"c"}
    collection.delete()
    assert collection.documents().count() == 0


def test_unit_vectors_take_little_more_room_than_themselves():
    import tracemalloc

    import pyarrow as pa

    from snapwright.operators.retrieve import _unit

    rows = np.arange(100_000 * 16, dtype=np.float32).reshape(-1, 16)
    rows[3], rows[5, 2] = 0, np.nan
    vectors = pa.ListArray.from_arrays(pa.array(np.arange(100_001, dtype=np.int32) * 16), pa.array(rows.ravel()))
    tracemalloc.start()
    found = _unit(vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * found.nbytes
    assert not found[3].any() and not found[5].any() and np.allclose((found[6:] ** 2).sum(axis=1), 1)
    assert (vectors.flatten().to_numpy()[:16] == rows[0]).all()
