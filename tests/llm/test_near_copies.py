import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from snapwright.llm import jaccard_join as jj
from snapwright.llm.components import connected
from tests.llm.conftest import prose


def brute(rows, forest):
    """(doc_id, class_id, copy_id, n_links) of rows with ids, by comparing all pairs."""
    sets = [set(jj.shingles(t or "", forest.size).tolist()) for _, t in rows]
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and Fraction(common, len(sets[a] | sets[b])) >= forest.threshold:
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    known = lambda picks, own: min((rows[i][0] for i in picks if rows[i][0] is not None), default=rows[own][0])
    out = []
    for a in range(n):
        same_class = [b for b in range(n) if root(a) == root(b)] if sets[a] else [a]
        same_set = [b for b in range(n) if sets[b] == sets[a]] if sets[a] else [a]
        out.append((rows[a][0], known(same_class, a), known(same_set, a), links[a]))
    return sorted(out, key=str)


def edited(text, seed, edits):
    pick, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rows = []
    for group in range(12):
        base = prose(1000 + group, 60 + 25 * group)
        rows += [(1000 * group + i, edited(base, 31 * group + i, i % 7)) for i in range(14)]
        rows += [(1000 * group + 500, base), (1000 * group + 501, base)]
    passage = prose(5, 60)
    rows += [(90_000 + i, prose(7000 + i, 90) + " " + passage) for i in range(40)]
    rows += [(95_000, "one two"), (95_001, "one two"), (95_002, "One, two!"), (95_003, "one two three four five"), (95_004, "")]
    return rows


@pytest.mark.parametrize("block", [1024, 9])
def test_join_is_what_brute_force_finds(spark, awkward, corpus, block):
    df = spark.createDataFrame(corpus, "doc_id long, text string").unionByName(awkward.select("doc_id", "text")).repartition(5)
    forest = jj.Forest(block=block)
    got = [(r["doc_id"], r["class_id"], r["copy_id"], r["n_links"]) for r in jj.near_copies(df, forest).collect()]
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()], forest)
    assert sorted(got, key=str) == want
    assert any(n > 3 for *_, n in want)


def test_one_of_each_group_stays(awkward, spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    kept = jj.distinct_documents(df)
    want = {c for _, c, _, _ in brute(corpus, jj.Forest())}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    odd = jj.distinct_documents(awkward)
    assert odd.columns == awkward.columns
    ids = [r["doc_id"] for r in odd.collect()]
    assert ids.count(5) == 0 and ids.count(4) == 1 and {0, 1, 2, 6} <= set(ids)
    twice = awkward.filter("doc_id = 5")
    assert jj.distinct_documents(twice).count() == 1
    assert jj.near_copies(awkward.limit(0)).count() == 0 and jj.distinct_documents(awkward.limit(0)).count() == 0


def test_one_stays_of_groups_with_null_or_repeated_ids(spark):
    base, other, third, alone = (prose(seed, 120) for seed in (61, 62, 63, 64))
    rows = [
        (None, base), (None, base), (None, base + " more"),  # only NULL ids, exact and near copies
        (20, other), (20, other + " more"), (20, other + " more"), (21, other),  # one id with two texts of a group
        (None, third), (30, third + " more"), (20, alone), (None, alone + " " + prose(65, 120)), (None, "!?"), (None, "!?"),
    ]
    kept = [(r["doc_id"], r["text"]) for r in jj.distinct_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    assert set(kept) <= set(rows)
    for group, ids in ((base, [None]), (other, [20]), (third, [30]), (alone + " ", [None])):
        assert [i for i, t in kept if t.startswith(group)] == ids
    assert kept.count((20, alone)) == 1 and kept.count((None, "!?")) == 2 and len(kept) == 7


def test_only_texts_that_may_be_dropped_are_shuffled(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(400)] + [(500 + i, prose(i, 30)) for i in range(5)] + [(9, None)], "doc_id long, text string")
    hashes = docs.filter("doc_id >= 500").select(F.xxhash64("text").alias("h"))
    some, others = (jj.possibly(docs, hashes, how) for how in ("left_semi", "left_anti"))
    assert {r["doc_id"] for r in some.collect()} >= {*range(5), *range(500, 505)} and some.count() <= 12
    assert some.count() + others.count() == 406 and others.columns == docs.columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jj.distinct_documents(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["doc_id"] for r in kept.collect()) == [*sorted([*range(400), 9])]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The other documents meet a bounded set of bits only.
    assert "Union" in plan and plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1


def test_prefix_shortens_until_the_recall_is_reached():
    for trees, recall in ((16, 0.9999), (16, 0.99), (64, 0.9999)):
        forest = jj.Forest(trees=trees, recall=recall)
        miss = lambda d, t=trees: (1 - 0.8**d) ** t
        assert miss(forest.prefix) <= 1 - recall + 1e-12
        assert forest.prefix == forest.depth or miss(forest.prefix + 1) > 1 - recall
    with pytest.raises(ValueError):
        _ = jj.Forest(trees=1).prefix


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    numbers = rng.integers(0, 1 << 62, 3000, dtype=np.uint64)
    a, b = np.unique(numbers[:2700]), np.unique(numbers[300:])
    sig = jj.signatures([a, b, a[:1]], 512)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.08 and (jj.signatures([a], 512)[0] == sig[0]).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=9), min_size=2, max_size=12), st.sampled_from([1, 2, 24]))
def test_verify_counts_exactly(sets, heavy):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    copies = np.arange(1, len(sets) + 1)
    found, stars = jj.verify_sets(arrays, np.full(len(sets), 2), copies, Fraction(4, 5), heavy)
    want = [sum(int(copies[b]) for b in range(len(sets)) if a != b and Fraction(len(sets[a] & sets[b]), len(sets[a] | sets[b])) >= Fraction(4, 5)) for a in range(len(sets))]
    assert found.tolist() == want
    assert {x for pair in stars for x in pair} == {i for i, n in enumerate(want) if n}


def test_components(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)] + [(2000, 2000 + i) for i in range(50)]
    got = {r["node"]: r["label"] for r in connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1001] == 1000 and got[2049] == 2000
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
