import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapwright.llm import decontaminate, quality, toxicity
from snapwright.llm.common import crc_remainder
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size):
    """doc text -> (n_words, n_hit, item ids) by trying every place."""
    grams = []
    for item_id, text in items:
        own = words(text)
        for at in range(max(1, len(own) - size + 1) if own else 0):
            grams.append((own[at : at + size], item_id))
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for gram, item_id in grams:
            for at in range(len(own) - len(gram) + 1):
                if own[at : at + len(gram)] == gram:
                    hit |= set(range(at, at + len(gram)))
                    if item_id is not None:
                        found.add(str(item_id))
        out.append((doc_id, len(own), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def benchmark(spark):
    passage = prose(50, 25)
    rows = [(1, passage), (2, passage), (30, "Short Item!"), (4, None), (5, "..."), (None, prose(51, 12)), (6, prose(52, 14) + " " + prose(52, 14)), (7, "a text without an id"), (8, "é É x"), (9, "w w w w w w w w w w w w")]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, gram string, n int")


@pytest.fixture(scope="module")
def documents(spark, awkward):
    passage = prose(50, 25)
    cut = " ".join(passage.split()[3:14])
    rows = [(100, passage.upper().replace(" ", ", ")), (101, f"x {cut} y {cut}"), (101, "other " + cut), (102, " ".join(passage.split()[:9])), (103, "short item SHORT. item short"),
            (104, prose(51, 12)), (105, (prose(52, 14) + " ") * 5), (106, "w " * 40), (None, passage)]
    more = spark.createDataFrame([(i, t, "en", "s", "x", 1.0, "y", "z") for i, t in rows], awkward.schema)
    return awkward.unionByName(more)


@pytest.mark.parametrize("bound", [200_000, 0])
def test_contamination_is_what_brute_force_finds(documents, benchmark, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", bound)
    got = decontaminate.contamination(documents, benchmark, size=10).collect()
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()], [(r["item_id"], r["text"]) for r in benchmark.collect()], 10)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got), key=str) == want
    assert all(r["contaminated"] == (r["n_hit"] > 0) and r["n_items"] == len(r["item_ids"]) for r in got)


def test_clean_keeps_columns_and_whole_rows(documents, benchmark):
    kept = decontaminate.clean(documents, benchmark, size=10)
    assert kept.columns == documents.columns
    want = [i for i, _, hit, _ in brute([(r["doc_id"], r["text"]) for r in documents.collect()], [(r["item_id"], r["text"]) for r in benchmark.collect()], 10) if not hit]
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, want))


def test_empty_sides(documents, benchmark):
    assert decontaminate.contamination(documents.limit(0), benchmark).count() == 0
    assert decontaminate.contamination(documents, benchmark.limit(0)).filter("contaminated").count() == 0


def test_the_main_path_is_native(documents, benchmark):
    plan = decontaminate.contamination(documents, benchmark)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan




def held_out(doc_id, divisor, rest):
    return zlib.crc32(str(doc_id).encode()) % divisor == rest


@pytest.mark.parametrize("module, label, divisor, rest", [(toxicity, "toxic", 4, 2), (quality, "quality", 3, 1)])
def test_held_out_accuracy(spark, module, label, divisor, rest):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = module.train(docs, labels, learn=crc_remainder("doc_id", divisor) != rest)
    rows = module.score(docs, model).join(labels, "doc_id").select("doc_id", "score", label).collect()
    unseen = [(r["score"], r[label]) for r in rows if held_out(r["doc_id"], divisor, rest)]
    score, truth = np.array([s for s, _ in unseen]), np.array([t for _, t in unseen])
    assert ((0 <= score) & (score <= 1)).all()
    cut = 0.3 if label == "toxic" else 0.5
    assert ((score >= cut)[truth == 1]).mean() > 0.9 and ((score < cut)[truth == 0]).mean() > 0.95


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_awkward_rows_are_scored(spark, awkward, module, label):
    schema = f"doc_id long, {label} int, text string"
    told = spark.createDataFrame([(3, 1, "x"), (7, 1, "x"), (7, 0, "x"), (8, 0, "x"), (9, None, "x"), (None, 1, "x"), (77, 1, "x"), (5, 0, None)], schema)
    for labels in (told, told.limit(0), told.filter(f"{label} = 1")):
        model = module.train(awkward, labels, learn=F.lit(True))
        scored = module.score(awkward, model, "own_score")
        assert scored.columns == [*awkward.columns, "own_score"]
        rows = scored.collect()
        assert len(rows) == awkward.count() and all(0 <= r["own_score"] <= 1 for r in rows)
        assert len({r["own_score"] for r in rows if r["doc_id"] == 5}) == 1
        assert module.score(awkward.limit(0), model, "own_score").count() == 0
    assert module.train(awkward.limit(0), told, learn=F.lit(True)) is not None


def test_risk_stays_non_negative_where_plain_risk_would_not():
    rng = np.random.default_rng(5)
    toxic = [np.unique(np.append(rng.integers(100, 5000, 30), 1)) for _ in range(60)]
    mixed = [np.unique(np.append(rng.integers(100, 5000, 30), [1] if i % 5 == 0 else [])).astype(np.int64) for i in range(400)]
    model = toxicity.fit([t.astype(np.uint32) for t in toxic], [m.astype(np.uint32) for m in mixed], 0.2)
    assert model.weights[1] > 1 and np.isfinite(model.weights).all()


def test_votes_are_exact(spark):
    rng = np.random.default_rng(1)
    counts = rng.random((60, quality.TERMS)).astype(np.float32)
    model = quality.fit([(c, i % 2) for i, c in enumerate(counts[:40])], dimensions=8, k=5)
    projected = model.project(counts)
    for at, value in enumerate(model.vote(counts, block=7)):
        similar = model.vectors.astype(float) @ projected[at]
        near = np.argsort(-similar)[:5]
        weight = np.maximum(similar[near], 0) ** 4
        assert value == pytest.approx((weight * model.labels[near]).sum() / weight.sum(), abs=1e-4)
