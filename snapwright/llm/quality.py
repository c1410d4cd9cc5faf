"""Text quality by nearest labelled neighbours in a latent-semantic space.

Texts are counted over terms: their words, hashed, and their form (the shapes of words, marks, how often words repeat). In
a run of more than ``LONG`` characters without blanks every stretch of five characters counts as a word may. The
term counts of a bounded sample of labelled texts are weighted by rarity and factored; the leading factors span the
latent space. The sample's vectors are broadcast (their number is a parameter, so their size is bounded), every document is
compared with all of them in exact blocked cosine products, and its nearest neighbours vote with their similarity.

NULL text is the empty text. It has no terms, is similar to none, and gets the sample's share of label 1, as do all
texts without terms. Without labelled rows of both kinds every score is that share, or 1 without any label. Labels that are
NULL and documents without an id teach nothing; of repeated labels of an id the largest counts. Ties between
neighbours go by their order in the sample. Repeated rows get equal scores. Extra columns of the documents pass through :func:`score`.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwright.llm.common import prepare, text_values, whole_text

FORMS, WORDS = 1024, 2048
TERMS = FORMS + WORDS
#: What all words of a text weigh together beside its forms.
WORD_WEIGHT = 0.35
LONG, GRAM = 40, 5
_MARKS = re.compile(r"[^\w\s]+|_+")
_LETTER = re.compile(r"\w")


def shape(word: str) -> str:
    """A word's form: its letters' case, its length class, and the marks at its ends."""
    first = _LETTER.search(word)
    start = first.start() if first else len(word)
    end = len(word) - _LETTER.search(word[::-1]).start() if first else start
    before, body, after = word[:start], word[start:end], word[end:]
    if not body:
        kind = "-"
    elif body.isdigit():
        kind = "9"
    elif not any(c.isalpha() for c in body):
        kind = "?"
    elif body.islower():
        kind = "a"
    elif len(body) > 1 and body.isupper():
        kind = "AA"
    elif body[0].isupper() and (len(body) == 1 or body[1:].islower()):
        kind = "Aa"
    else:
        kind = "aA"
    length = len(body)
    size = "0" if not length else "1" if length < 3 else "2" if length < 7 else "3" if length < 16 else "4" if length < 40 else "5"
    inner = "m" if _MARKS.search(body) else ""
    return f"{before[:2]}{kind}{inner}{size}{after[:3]}"


def _term(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % FORMS


def _word(name: str) -> int:
    return zlib.crc32(name.lower().encode("utf-8", "replace")) % WORDS


class _Forms(dict):
    """The terms of every word seen, up to a bound: its form, and above that its letters."""

    def __missing__(self, word: str) -> int:
        term = _term(shape(word)) + FORMS * _word(_MARKS.sub("", word))
        if len(word) <= LONG:
            self[word] = term
        return term


_FORMS = _Forms()
_REMEMBERED = 150_000


def term_counts(text: str) -> np.ndarray:
    """Term weights of one text."""
    words = text.split()
    if not words:
        return np.zeros(TERMS, np.float32)
    if len(_FORMS) > _REMEMBERED:
        _FORMS.clear()
    counts, total = Counter(words), len(words)
    terms = np.fromiter(map(_FORMS.__getitem__, counts), np.int64, len(counts))
    numbers = np.fromiter(counts.values(), np.float64, len(counts))
    out = np.zeros(TERMS)
    out[:FORMS] = np.sqrt(np.bincount(terms % FORMS, numbers, FORMS) / total)
    of_words = np.bincount(terms // FORMS, numbers, WORDS)
    if max(map(len, counts)) > LONG:
        for word in filter(lambda w: len(w) > LONG, counts):
            grams = np.fromiter((_word(word[at : at + GRAM]) for at in range(len(word) - GRAM + 1)), np.int64, len(word) - GRAM + 1)
            of_words += np.bincount(grams, minlength=WORDS) * (counts[word] / GRAM)
    out[FORMS:] = WORD_WEIGHT * np.sqrt(of_words / of_words.sum())
    # Habits of the whole text, graded, as terms of their own.
    habits = {
        "fresh": len(counts) / total, "repeats": sum(map(eq, words, words[1:])) / total, "top": float(numbers.max()) / total,
        "chars": min(1.0, len(text) / total / 20), "breaks": min(1.0, 10 * text.count("\n") / total),
    }
    for name, value in habits.items():
        out[_STEPS[name][: int(min(value, 1.0) * 9)]] += 0.25
    return out.astype(np.float32)


_STEPS = {name: np.array([_term(f"{name}>{step}") for step in range(1, 10)]) for name in ("fresh", "repeats", "top", "chars", "breaks")}


def counts_of(texts: list[str]) -> np.ndarray:
    """Term weights of a list of texts, one row each."""
    return np.stack([term_counts(text) for text in texts]) if texts else np.zeros((0, TERMS), np.float32)


_ENTRY = np.dtype([("term", "<u2"), ("count", "<f4")])


def _sparse(counts: np.ndarray) -> bytes:
    terms = np.flatnonzero(counts)
    out = np.empty(len(terms), _ENTRY)
    out["term"], out["count"] = terms, counts[terms]
    return out.tobytes()


def _dense(entries: bytes) -> np.ndarray:
    found = np.frombuffer(entries, _ENTRY)
    out = np.zeros(TERMS, np.float32)
    out[found["term"]] = found["count"]
    return out


@dataclass(frozen=True)
class Neighbours:
    """The fitted space and the labelled vectors in it; a few MB by construction."""

    rarity: np.ndarray
    factors: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float
    k: int

    def project(self, counts: np.ndarray) -> np.ndarray:
        latent = (counts * self.rarity) @ self.factors
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def vote(self, counts: np.ndarray, block: int = 512) -> np.ndarray:
        """Score of every row: the share of label 1 among its k nearest, weighted by (positive) similarity."""
        out = np.full(len(counts), self.share)
        if len(self.labels) == 0:
            return out
        k = min(self.k, len(self.labels))
        for at in range(0, len(counts), block):
            some = counts[at : at + block]
            similar = self.project(some) @ self.vectors.T
            near = np.argpartition(-similar, k - 1, axis=1)[:, :k]
            # Where neighbours tie at the edge, those first in the sample vote.
            edge = np.take_along_axis(similar, near, 1).min(1, keepdims=True)
            tied = np.flatnonzero((similar >= edge).sum(1) > k)
            near[tied] = np.argsort(-similar[tied], axis=1, kind="stable")[:, :k]
            weight = np.maximum(np.take_along_axis(similar, near, 1), 0) ** 4
            total = weight.sum(1)
            told = (total > 1e-9) & some.any(1)
            out[at : at + block][told] = (weight * self.labels[near]).sum(1)[told] / total[told]
        return np.clip(out, 0, 1)


def leading_factors(weighted: np.ndarray, dimensions: int, turns: int = 12) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    wide = min(dimensions + 16, *weighted.shape)
    basis = np.random.default_rng(0).standard_normal((weighted.shape[1], wide)).astype(np.float32)
    for _ in range(turns):
        basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
    inner = (weighted @ basis).astype(np.float64)
    _, turned = np.linalg.eigh(inner.T @ inner)
    return (basis @ turned[:, ::-1][:, :dimensions]).astype(np.float32)


def chosen_labels(labels: DataFrame, label: str, learn: Column, most: int) -> DataFrame:
    """At most ``most`` labelled ids (__id, __label), chosen by a hash of the id; ``learn`` says which may teach."""
    told = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).filter(learn)
    told = told.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max(label).cast("int").alias("__label"))
    return told.orderBy(F.xxhash64("__id"), "__id").limit(most)


def fit(sample: list[tuple[np.ndarray, int]], *, dimensions: int = 48, k: int = 15) -> Neighbours:
    counts = np.stack([c for c, _ in sample]).astype(np.float32) if sample else np.zeros((0, TERMS), np.float32)
    labels = np.array([y for _, y in sample], np.float32)
    share = float(labels.mean()) if len(labels) else 1.0
    rarity = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    if len(labels) == 0 or len(set(labels.tolist())) < 2:
        return Neighbours(rarity, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels[:0], share, k)
    factors = leading_factors(counts * rarity, min(dimensions, len(counts)))
    model = Neighbours(rarity, factors, np.zeros((0, factors.shape[1]), np.float32), labels, share, k)
    return Neighbours(rarity, factors, model.project(counts).astype(np.float32), labels, share, k)


def train(docs: DataFrame, labels: DataFrame, *, learn: Column, label: str = "quality", most: int = 3000, dimensions: int = 48, k: int = 15) -> Neighbours:
    """Fit on at most ``most`` labelled texts.

    The sample of ids is bounded before it is broadcast, the documents are scanned once, texts become term counts in
    tasks, and at most ``most`` rows of counts reach the driver. Of an id that several documents share, each text teaches.
    """
    prepare(docs.sparkSession)
    schema = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("label", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([_sparse(term_counts(text)) for text in text_values(batch.column(3))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), whole_text("text").alias("text"))
    joined = texts.join(F.broadcast(chosen_labels(labels, label, learn, most)), "__id").select("__id", F.xxhash64("text"), "__label", "text")
    counted = joined.mapInArrow(count, "id long, hash long, label int, counts binary")
    rows = counted.orderBy(F.xxhash64("id"), "id", "hash").limit(most).collect()
    sample = [(_dense(row["counts"]), row["label"]) for row in rows]
    return fit(sample, dimensions=dimensions, k=k)


def score(docs: DataFrame, model: Neighbours, column: str = "score") -> DataFrame:
    """All documents with ``column``, a score from 0 to 1."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(texts):
        import pandas as pd

        own = shared.value
        values = ["" if t is None else t for t in texts]
        parts = [own.vote(counts_of(values[at : at + 512])) for at in range(0, len(values), 512)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(column, vote(whole_text("text")))


def keep_good(docs: DataFrame, labels: DataFrame, *, learn: Column, threshold: float = 0.5, **options) -> DataFrame:
    """The documents that score at least ``threshold``, with their own columns."""
    scored = score(docs, train(docs, labels, learn=learn, **options), "__quality")
    return scored.filter(F.col("__quality") >= threshold).drop("__quality")

