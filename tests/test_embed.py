import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapwright.operators.embed import (
    Throttled,
    embed,
    embed_distinct,
    encoder,
    hashed_counts,
    register_encoder,
    remote,
    with_rate,
    with_retry,
)
from snapwright.plans.run import Settings


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id long, text string")


def fixed_length(dimension):
    return lambda: lambda batch: [[float(len(t))] * dimension for t in batch]


def test_hashed_encoder():
    vector = hashed_counts(["Food food, BANK! naïve 42"], 64)[0]
    assert abs(math.sqrt(vector @ vector) - 1) < 1e-12
    assert sorted(round(x, 6) for x in vector if x) == sorted(
        round(x / math.sqrt(7), 6) for x in (2, 1, 1, 1)
    )
    assert not hashed_counts(["--- ..."], 64).any()
    assert (hashed_counts(["a b"], 32) == hashed_counts(["B, A"], 32)).all()


def test_embed_keeps_vectors_with_their_rows(spark):
    rows = embed(texts(spark, "a", "bbb", None, "cc").repartition(3), "text", fixed_length(2), dimension=None).collect()
    assert {r.id: r.embedding for r in rows} == {0: [1.0, 1.0], 1: [3.0, 3.0], 2: None, 3: [2.0, 2.0]}


def test_batches_have_the_asked_size(spark):
    def factory():
        return lambda batch: [[float(len(batch))] for _ in batch]

    rows = embed(texts(spark, *"abcdefg").coalesce(1), "text", factory, dimension=1, batch_size=3).collect()
    assert sorted(r.embedding[0] for r in rows) == [1.0, 3.0, 3.0, 3.0, 3.0, 3.0, 3.0]


def test_every_row_is_checked_for_its_dimension(spark):
    def uneven():
        return lambda batch: [[0.0] * (3 if t == "odd" else 2) for t in batch]

    good = embed(texts(spark, "a", "b"), "text", uneven, dimension=2)
    assert good.count() == 2 and len(good.head().embedding) == 2
    with pytest.raises(Exception, match="dimension mismatch: got 3, expected 2"):
        embed(texts(spark, "a", "b", "c", "odd"), "text", uneven, dimension=2).collect()


def test_unknown_provider():
    with pytest.raises(ValueError, match="no encoder is registered as 'nope'"):
        encoder("nope")


def test_provider_by_module():
    assert encoder("snapwright.operators.embed:_hashed", dimension=8)()(["a"]).shape == (1, 8)


def test_settings_apply_rate_and_retry():
    assert callable(Settings(dimension=8, tasks=2, texts_per_second=10.0).factory()())
    with pytest.raises(ValueError, match="needs tasks"):
        Settings(texts_per_second=1.0).factory()


def test_own_provider(spark):
    register_encoder("lengths", fixed_length)
    assert embed(texts(spark, "abc"), "text", encoder("lengths", dimension=4), dimension=4).head().embedding == [3.0] * 4


def test_retry_waits_and_gives_up():
    calls, waits = [], []

    def busy(batch):
        calls.append(batch)
        raise Throttled

    with pytest.raises(RuntimeError, match="still throttled after"):
        with_retry(busy, sleep=waits.append, jitter=lambda: 0.5)(["x"])
    assert len(calls) == 8 and waits == [min(2**n + 0.5, 60) for n in range(8)]


def test_retry_succeeds_after_throttling_and_lets_other_errors_pass():
    answers = [Throttled(), Throttled(), [[1.0]]]

    def flaky(batch):
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    assert with_retry(flaky, sleep=lambda _: None)(["x"]) == [[1.0]]

    def broken(batch):
        raise KeyError("no")

    with pytest.raises(KeyError):
        with_retry(broken, sleep=lambda _: pytest.fail("must not wait"))(["x"])


def test_rate():
    now, slept = [0.0], []

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    paced = with_rate(lambda batch: batch, 10, sleep=sleep, clock=lambda: now[0])
    for _ in range(4):
        paced(["a"] * 5)
    assert sum(slept) == pytest.approx(1.5)


def test_remote_in_tasks(spark):
    random.seed(1)
    made = remote(fixed_length(1), job_rate=10_000, tasks=4)
    df = embed(texts(spark, *["x"] * 40), "text", made, dimension=1, tasks=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 40


def test_distinct_texts_are_encoded_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def counting():
        def encode(batch):
            calls.add(len(batch))
            return [[float(len(t))] for t in batch]

        return encode

    df = texts(spark, *(["same"] * 30 + ["other", None]))
    got = embed_distinct(df, "text", counting, dimension=1).collect()
    assert calls.value == 2
    assert {r.id: r.embedding for r in got if r.id in (0, 30, 31)} == {0: [4.0], 30: [5.0], 31: None}
    assert len(got) == 32


def test_long_text_is_used_whole(spark):
    long = " ".join(["word"] * 50_000 + ["end"])
    row = embed(texts(spark, long), "text", encoder("hashed", dimension=16), dimension=16).head()
    assert np.allclose(row.embedding, hashed_counts([long], 16)[0]) and np.count_nonzero(row.embedding) == 2


def test_a_second_run_sends_only_new_texts(spark, tmp_path):
    from snapwright.operators.embed import embed_remembered

    sent = spark.sparkContext.accumulator(0)

    def factory():
        def encode(texts):
            sent.add(len(texts))
            return [[float(len(t)), 1.0] for t in texts]

        return encode

    memory = str(tmp_path / "memory")
    rows = lambda names: spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id long, text string")

    def run(names):
        found = embed_remembered(rows(names), "text", factory, memory, dimension=2).collect()
        assert {(r["id"], r["text"], None if r["embedding"] is None else r["embedding"][0]) for r in found} == {(i, n, None if n is None else len(n)) for i, n in enumerate(names)}
        return sent.value

    assert run(["a", "bb", "a", None]) == 2
    assert run(["a", "ccc", "bb", "ccc"]) == 3
    assert run(["a", None]) == 3
    assert run([]) == 3


def test_hashed_encoder_equals_the_pattern_and_searches_no_ascii_text(monkeypatch):
    import hashlib
    import re

    from snapwright.operators import embed as module

    odd = ["", "a_b\x1fc\x85d", "ONE two\tTHREE 3", "Ünï_x ÀB", "İx ²½ é1", "one " * 30]
    found = hashed_counts(odd, 64)
    for text, vector in zip(odd, found, strict=True):
        counts = np.zeros(64)
        for token in re.findall(r"[^\W_]+", text.lower()):
            counts[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 64] += 1
        assert np.allclose(vector, counts / (np.sqrt(counts @ counts) or 1), atol=1e-12)
    monkeypatch.setattr(module, "_TOKEN", None)
    assert (hashed_counts(odd[2:3], 64) == found[2:3]).all()


def test_vectors_and_hits_are_not_broadcast_uncounted(spark, monkeypatch):
    from snapwright.operators import search as module

    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    got = embed_distinct(texts(spark, "a", "bb", "a", None), "text", fixed_length(3), dimension=3)
    assert "SortMergeJoin" in plan_of(got) and "Broadcast" not in plan_of(got)
    rows = embed(texts(spark, "a b", "b c", "d"), "text", encoder("hashed", dimension=8), dimension=8).withColumnRenamed("id", "snapshot_key")
    queries = spark.createDataFrame([(1, "a b"), (2, "d")], "query_id long, text string")
    ask = lambda: module.search(rows, queries, 1, factory=encoder("hashed", dimension=8), dimension=8)
    few = ask()
    monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    many = ask()
    assert "BroadcastHashJoin" in plan_of(few) and "BroadcastHashJoin" not in plan_of(many)
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
