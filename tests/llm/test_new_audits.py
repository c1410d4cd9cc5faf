"""Divergence, collocations and posting lists against plain Python on small tables with awkward rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapwright.llm import collocations, divergence, posting_lists
from tests.llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark):
    pick = random.Random(5)
    rows = [(i, prose(i, pick.randint(0, 60)), pick.choice(["en", "en", "fr", None]), "hot" if i % 3 == 0 else pick.choice(["a", "b", "é", None])) for i in range(160)]
    rows += [(1000, None, "en", "silent"), (1001, "", "xx", "a"), (1002, "?!", "xx", "b"), (1003, "Word " * 3000, "en", "a"), (1003, "Word " * 3000, "en", "a"), (None, "No id, No id. no ID", "fr", "b")]
    rows += [(1004, "x" * 70_000 + "É\x00Straße", "en", "b"), (1005, "A\tb  c\x0bd\x85e", "en", "b")]
    return spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, lang string, source string, n int, term string").repartition(3), rows


def diverged(rows, min_docs, top):
    count, seen = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        count[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= min_docs]

        def shares(counter):
            total = sum(counter[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counter[t] + 2) // total for t in kept}

        whole = Counter()
        for source in sources:
            whole.update(count[lang, source])
        q, of = shares(whole), {s: shares(count[lang, s]) for s in sources}
        for s, p in of.items():
            apart = lambda p, q, t: (p[t] - q[t]) ** 2 // (p[t] + q[t])
            pairs = [(-sum(apart(p, of[o], t) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-apart(p, q, t), t.encode(), t) for t in kept if count[lang, s][t] and p[t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("settings", [{}, {"block": 2}, {"most_terms": 1}, {"most_terms": 1, "block": 3}])
def test_divergence_equals_plain_python(spark, settings):
    docs, rows = documents(spark)
    found = divergence.divergence(docs, min_docs=4, top_terms=5, **settings).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == diverged(rows, 4, 5)


def test_terms_are_counted_in_tasks_and_sent_once(spark):
    docs, rows = documents(spark)
    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = divergence.group_counts(texts, 4, 1000)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan
    want, seen = Counter(), Counter()
    for _, text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        want.update((lang or "", source or "", t) for t in terms)
        seen.update({(lang or "", t) for t in terms})
    want = {k: n for k, n in want.items() if seen[k[0], k[2]] >= 4}
    got = counts.collect()
    assert {(r["lang"], r["source"], r["term"]): r["n"] for r in got} == want and len(got) == len(want)
    assert sorted((r["lang"], r["term"]) for r in got if r["first"]) == sorted({(a, t) for a, _, t in want})
    texts = [bytes(range(256)), "É\x00Straße İK\u2003x".encode(), b"", b" a  B\t"]
    assert [divergence.terms_of(t) for t in texts[1:]] == [["É".encode(), "Straße".lower().encode(), "İk\u2003x".encode()], [], [b"a", b"b"]]


def test_shares_hold_beyond_64_bits(spark):
    n = 9 * 10**15
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(2 * n), F.lit(7)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 2) // (2 * n + 14)


def test_divergence_of_nothing(spark):
    docs, _ = documents(spark)
    assert divergence.divergence(docs.limit(0)).count() == 0
    rare = divergence.divergence(docs, min_docs=10**6)
    assert rare.filter("part = 'term' or value <> 0").count() == 0 and rare.count() > 0


def phrases(rows, least, top, share=80):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for m in range(1, 5):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, f in counts.items():
        known = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        inside = defaultdict(int)
        for g, a in known.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    inside[g[i : i + m]] = max(inside[g[i : i + m]], a)
        scored = []
        for g, a in known.items():
            if 100 * inside[g] < share * a or not inside[g]:
                score, k = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out |= {(lang, rank, p.decode(), -a, l, r, sizes[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)}
    return out


def test_collocations_equal_plain_python(spark):
    docs, rows = documents(spark)
    found = collocations.collocations(docs, least=3, top=50).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == phrases(rows, 3, 50)


def test_collocations_of_nothing(spark):
    docs, _ = documents(spark)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.filter("text is null or text in ('', '?!')")).count() == 0


def test_words_are_counted_over_any_number_of_sendings(monkeypatch):
    import pyarrow as pa

    texts = [prose(i, 30).encode() for i in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array([b"en"] * 20, pa.binary()), pa.array(texts, pa.binary())], ["lang", "text"])
    want = Counter(w for t in texts for w in t.split())
    for flush in (1, 1000, 10**6):
        monkeypatch.setattr(collocations, "FLUSH_BYTES", flush)
        got = Counter()
        for some in collocations._count_words(iter([batch, batch])):
            for row in some.to_pylist():
                got[row["phrase"]] += row["a"]
        assert got == {w: 2 * n for w, n in want.items()}


@pytest.mark.parametrize("step", [1, 7, 16, 1000])
def test_long_texts_are_cut_between_words_only(monkeypatch, step):
    monkeypatch.setattr(collocations, "TEXT_STEP", step)
    text = b"ab CD" * 20 + b" " + b"e" * 100 + b". F,g\n\nh\t!" + b"i" * 50 + b"?"
    want = [(w, at) for at, piece in enumerate(re.split(rb"[.,;:!?\x0a-\x0d]", text.lower())) for w in re.split(rb"[ \t]+", piece) if w]
    assert [(w, p) for some, piece in collocations.words_of(text) for w, p in zip(some.to_pylist(), piece.tolist(), strict=True)] == want
    held = collocations.Held(b"en", [b"a b", b"", b"c.d", b"...", b"e f"])
    runs = defaultdict(list)
    for word, piece in zip(held.ids.tolist(), held.piece.tolist(), strict=True):
        runs[piece].append(held.words[word].as_py())
    assert list(runs.values()) == [[b"a", b"b"], [b"c"], [b"d"], [b"e", b"f"]]


def test_stripes_merge_over_batches_of_any_size():
    import pyarrow as pa

    pick = random.Random(2)
    rows, want, totals = [], Counter(), Counter()
    for prefix in (b"a", b"b", b"c"):
        for part in (0, 5):
            for _ in range(pick.randint(1, 9)):
                entries = {pick.choice([b"", b"x%d" % part, b"y%d" % part]): pick.randint(1, 4) for _ in range(3)}
                rows.append((b"en", prefix, part, b"".join(w + b" " for w in entries), np.array(list(entries.values()), "<i8").tobytes()))
                for word, n in entries.items():
                    want[prefix, word] += n
                    totals[prefix, part] += n
    table = pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), collocations._STRIPES, strict=True)], schema=collocations._STRIPES)
    for size in (1, 2, 7, 100):
        merged = [r for b in collocations._merge(5)(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert {(r["prefix"], w): n for r in merged for w, n in zip(r["nexts"], r["counts"], strict=True)} == {k: n for k, n in want.items() if n >= 5 and k[1]}
        assert sum(r["total"] for r in merged) == sum(totals.values()) and len(merged) == len(totals)


def vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.7).tolist()) for i in range(2000)]
    rows += [(i, [0.5] * 16) for i in range(2000, 3000)]
    sound = list(rows) + [(4000, [3.0, 1.0]), (4001, rows[0][1]), (4001, rows[1][1]), (4020, [1e-9] * 16)]
    rows = sound + [(5000, None), (5020, []), (5040, [0.0] * 16), (5060, [1.0, None]), (5080, [float("nan")] * 16), (5100, [float("inf")]), (None, [1.0] * 16)]
    return spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<double>, score double, list string").repartition(4), sound


def nearest(sound, k):
    out = {}
    for q, v in sound:
        if q % 20 == 0:
            found = {(-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in sound if i != q}
            out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def test_posting_lists(spark):
    table, sound = vectors(spark)
    want = nearest(sound, 20)
    asks = F.col("vec_id") % 20 == 0
    rows = posting_lists.search(table, asks, k=20, group_rows=500).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    at = defaultdict(list)
    for i, v in sound:
        at[i].append(v)
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and len(found) == 20
        for i, score in found:
            assert any(score == pytest.approx(sum(a * b for a, b in zip(at[q][0], v, strict=False)), rel=1e-12, abs=1e-12) for v in at[i])


def test_posting_lists_asked_in_full_are_exact(spark):
    table, sound = vectors(spark)
    lists = posting_lists.fit(posting_lists.usable(table))
    lists.ratio = float("inf")
    rows = posting_lists.search(table, F.col("vec_id") % 20 == 0, lists, group_rows=700).collect()
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in rows}
    assert got == {(q, n): i for q, found in nearest(sound, 20).items() for n, (i, _) in enumerate(found, 1)}


def test_posting_lists_recall_on_the_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    asks = F.col("vec_id") % 20 == 0
    assert posting_lists.recall_of(posting_lists.search(table, asks), table, asks) >= 0.9


def test_posting_lists_of_little(spark):
    table, _ = vectors(spark)
    asks = F.col("vec_id") % 20 == 0
    assert posting_lists.search(table.limit(0), asks).count() == 0
    assert posting_lists.search(table.filter("vec_id = 0"), asks).count() == 0
    two = posting_lists.search(table.filter("vec_id in (0, 1)"), asks).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in two] == [(0, 1, 1)]


def test_groups_hold_every_list():
    held = posting_lists._groups({0: 5, 1: 90, 2: 260, 4: 100, 5: 3}, 100)
    assert held == [[0], [0], [1, 2, 3, 4], [], [5], [6]]
