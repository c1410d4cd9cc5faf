"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier on the words and word beginnings that a text contains is trained in numpy from confirmed toxic texts and
unlabelled texts. The unlabelled texts stand for both classes; the share of toxic texts (the class prior) corrects the
risk estimate, and the estimated risk on the negative class is never allowed below zero.

Labels 0 are used for nothing but the prior. NULL text is the empty text; texts without known terms get the
classifier's base rate. Without a confirmed toxic text every score is 0. Labels that are NULL and documents without an
id teach nothing; of repeated labels of an id the largest counts. Repeated rows get equal scores. Extra columns of the documents
pass through :func:`score`.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwright.llm.common import prepare, staged, text_values, whole_text

TERM_BITS = 20
BEGINNINGS = (4, 5, 6)
#: Longer words are taken for text without blanks.
LONG = 40
_MARKS = re.compile(r"[^\w]+")


class TermFinder:
    """Numbers of the terms a text contains, each once. Words are remembered, up to a bound."""

    def __init__(self, remembered: int = 100_000):
        self.known: dict[str, tuple[int, ...]] = {}
        self.remembered = remembered

    def __call__(self, text: str) -> np.ndarray:
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        found: set[int] = set()
        for word in set(text.split()):
            terms = known.get(word)
            if terms is None:
                terms = self.terms_of(word)
                if len(word) <= LONG:
                    known[word] = terms
            found.update(terms)
        return np.fromiter(found, np.uint32, len(found))

    @staticmethod
    def terms_of(word: str) -> tuple[int, ...]:
        number = lambda name: zlib.crc32(name.encode("utf-8", "replace")) >> (32 - TERM_BITS)
        terms = []
        for part in _MARKS.split(word.lower()):
            if part:
                terms.append(number("=" + part))
                terms += [number(f"^{part[:n]}") for n in BEGINNINGS if len(part) >= n]
            if len(part) > LONG:
                # Text that is not parted by blanks: each stretch of it counts as the beginning of a word may.
                terms += {number(f"^{part[at : at + n]}") for n in BEGINNINGS for at in range(1, len(part) - n + 1)}
        return tuple(terms)


_FINDER = TermFinder()


def terms_in(text: str) -> np.ndarray:
    """Terms of one text, with this worker's memory of words."""
    return _FINDER(text)


@dataclass
class Classifier:
    """Weights by term number, and the base. Only words with a weighted term are looked at twice."""

    weights: np.ndarray
    base: float

    def __post_init__(self):
        self._seen: set[str] = set()
        self._told: dict[str, tuple[int, ...]] = {}

    def __reduce__(self):
        # Only the weights that are not zero travel to the tasks.
        places = np.flatnonzero(self.weights)
        return _told_once, (places.astype("<u4").tobytes(), self.weights[places].astype("<f4").tobytes(), self.base)

    def score_one(self, text: str) -> float:
        words = set(text.split())
        if len(self._seen) > 200_000:
            self._seen.clear()
            self._told.clear()
        new = words - self._seen
        found: set[int] = set()
        for word in new:
            terms = tuple(t for t in TermFinder.terms_of(word) if self.weights[t])
            if len(word) > LONG:
                found.update(terms)
                continue
            self._seen.add(word)
            if terms:
                self._told[word] = terms
        found.update(t for word in words & self._told.keys() for t in self._told[word])
        return self.base + float(self.weights[sorted(found)].sum()) if found else self.base

    def score(self, texts: list[str]) -> np.ndarray:
        values = np.array([self.score_one(text) for text in texts], float)
        return 1 / (1 + np.exp(-np.clip(values, -60, 60)))


def _classifier(places: np.ndarray, weights: np.ndarray, base: float) -> Classifier:
    whole = np.zeros(1 << TERM_BITS, np.float32)
    whole[places] = weights
    return Classifier(whole, base)


@lru_cache(maxsize=1)
def _told_once(places: bytes, weights: bytes, base: float) -> Classifier:
    """The classifier that a worker has met before, with its memory of words."""
    return _classifier(np.frombuffer(places, "<u4"), np.frombuffer(weights, "<f4"), base)


def _rows(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(f) for f in found], np.int64)
    return (np.concatenate(found) if found else np.zeros(0, np.uint32)).astype(np.int64), np.repeat(np.arange(len(found)), lengths)


def choose(
    in_toxic: np.ndarray, in_all: np.ndarray, n_toxic: int, n_all: int, prior: float, *, least_share: float = 0.002, least_ratio: float = 1.5, kept: int = 20_000
) -> np.ndarray:
    """Places of the ``kept`` terms that separate the two samples best, given how many texts of each hold every term.

    Only terms seen in at least ``least_share`` of the texts and in four count, and only such as speak for toxicity:
    how much else a long text says is no evidence against it.
    """
    # How often terms occur in toxic texts, and, with the toxic share taken out of the unlabelled ones, in others.
    of_toxic, of_all = in_toxic / n_toxic, in_all / max(1, n_all)
    of_others = np.maximum(of_all - prior * of_toxic, 0) / max(1 - prior, 1e-6)
    ratio = np.log(of_toxic + 0.5 / n_toxic) - np.log(of_others + 0.5 / n_toxic)
    strength = np.where((in_toxic + in_all >= least_texts(n_toxic + n_all, least_share)) & (ratio >= least_ratio), ratio * np.sqrt(in_toxic + in_all), 0)
    chosen = np.argsort(-strength, kind="stable")[:kept]
    return chosen[strength[chosen] > 0]


def least_texts(n: int, least_share: float = 0.002) -> float:
    return max(4, least_share * n)


def fit(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, **options) -> Classifier:
    """A classifier from the terms of both samples."""
    size = 1 << TERM_BITS
    if not toxic:
        return Classifier(np.zeros(size, np.float32), -60.0)
    counts = [np.bincount(_rows(found)[0], minlength=size) for found in (toxic, unlabelled)]
    chosen = choose(*counts, len(toxic), len(unlabelled), prior, **options)
    place = np.full(size, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    kept = [[at[at >= 0] for at in (place[f] for f in found)] for found in (toxic, unlabelled)]
    return fit_places(chosen, *kept, prior)


def fit_places(chosen: np.ndarray, toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, *, steps: int = 200, rate: float = 0.1, decay: float = 1e-3) -> Classifier:
    """Minimise the non-negative risk by full-batch gradient steps with adaptive rates; texts are places in ``chosen``.

    With logistic loss l and prior p the risk is ``p * mean_toxic l(f) + max(0, mean_unlabelled l(-f) - p * mean_toxic
    l(-f))``; while the second part is negative, steps go up its slope instead.
    """
    p_terms, p_rows = _rows(toxic)
    u_terms, u_rows = _rows(unlabelled)
    theta = np.zeros(len(chosen) + 1)
    theta[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    loss = lambda z: np.logaddexp(0, -z)
    n_toxic, n_all = len(toxic), max(1, len(unlabelled))

    def slope(pull_toxic: np.ndarray, pull_all: np.ndarray) -> np.ndarray:
        out = np.empty_like(theta)
        out[:-1] = np.bincount(p_terms, pull_toxic[p_rows], len(chosen)) + np.bincount(u_terms, pull_all[u_rows], len(chosen))
        out[-1] = pull_toxic.sum() + pull_all.sum()
        return out

    for step in range(1, steps + 1):
        f_toxic = theta[-1] + np.bincount(p_rows, theta[p_terms], n_toxic)
        f_all = theta[-1] + np.bincount(u_rows, theta[u_terms], len(unlabelled))
        negative = loss(-f_all).sum() / n_all - prior * loss(-f_toxic).mean()
        up_toxic, up_all = sigmoid(f_toxic) / n_toxic, sigmoid(f_all) / n_all
        if negative >= 0:
            gradient = slope(prior * ((sigmoid(f_toxic) - 1) / n_toxic - up_toxic), up_all)
        else:
            gradient = slope(prior * up_toxic, -up_all)
        gradient[:-1] += decay * theta[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        np.maximum(theta[:-1], 0, out=theta[:-1])
    return _classifier(chosen, theta[:-1].astype(np.float32), float(theta[-1]))


def _found(texts: DataFrame) -> DataFrame:
    """The texts' terms."""
    schema = pa.schema([("terms", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                found = [terms_in(t).astype(np.int32) for t in text_values(batch.column(0).slice(at, 64))]
                yield pa.RecordBatch.from_arrays([pa.array(found, schema[0].type)], schema=schema)

    return texts.select("text").mapInArrow(run, "terms array<int>")


def _texts_with(terms: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms in at least ``least`` texts, and in how many of the toxic and of the unlabelled ones they are."""
    each = terms.select("toxic", F.explode("terms").alias("term")).groupBy("term")
    found = each.agg(F.count_if("toxic").alias("p"), F.count_if(~F.col("toxic")).alias("u")).filter(F.col("p") + F.col("u") >= least)
    found = found.orderBy("term").toArrow()
    return tuple(found.column(name).to_numpy() for name in ("term", "p", "u"))


def _places_of(terms: DataFrame, chosen: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Both samples as places in ``chosen``; only these reach the driver."""
    schema = pa.schema([("toxic", pa.bool_()), ("places", pa.binary())])
    order = np.argsort(chosen)
    ranked = chosen[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for found in batch.column("terms"):
                own = found.values.to_numpy()
                at = np.minimum(np.searchsorted(ranked, own), len(ranked) - 1)
                places.append(np.sort(order[at[ranked[at] == own]]).astype("<u4").tobytes() if len(ranked) else b"")
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(places, pa.binary())], schema=schema)

    rows = terms.select("toxic", "terms").mapInArrow(run, "toxic boolean, places binary").toArrow()
    both = [[], []]
    # Sums depend on the order of rows in their last digits only; it is fixed all the same.
    for toxic, places in sorted(zip(rows.column("toxic").to_pylist(), rows.column("places").to_pylist(), strict=True)):
        both[not toxic].append(np.frombuffer(places, "<u4"))
    return both[0], both[1]


def train(docs: DataFrame, labels: DataFrame, *, learn: Column, label: str = "toxic", most_toxic: int = 3000, most_unlabelled: int = 8000) -> Classifier:
    """Train from at most ``most_toxic`` confirmed texts and at most ``most_unlabelled`` of all texts.

    The prior is the share of label 1 among all labels that may teach. Both samples are chosen by a hash and cut to their
    bounds on the cluster; their terms are counted there and stay there. What reaches the driver is the counts of
    frequent terms (there are 2^20 terms at most) and, of each sampled text, the terms that get weights.
    """
    prepare(docs.sparkSession)
    told = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).filter(learn)
    told = told.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(label).cast("int").alias("label"))
    n, n_toxic = told.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    chosen = told.filter("label = 1").orderBy(F.xxhash64("id"), "id").limit(most_toxic).select("id")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), whole_text("text").alias("text"))
    order = F.xxhash64("text")
    toxic = texts.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "id", order).limit(most_toxic)
    rows = docs.count()
    # A share of all rows by hash, twice the bound, so that the exact bound is taken from few rows.
    share = min(1.0, 2 * most_unlabelled / max(rows, 1))
    some = texts.withColumn("hash", F.xxhash64(F.lit(17), "id", "text"))
    some = some.filter(F.pmod("hash", F.lit(1 << 30)) < int(share * (1 << 30)) + 1).orderBy("hash").limit(most_unlabelled)
    terms = staged(_found(toxic).withColumn("toxic", F.lit(True)).unionAll(_found(some).withColumn("toxic", F.lit(False))), "sample")
    sizes = {r["toxic"]: r["count"] for r in terms.groupBy("toxic").count().collect()}
    if not sizes.get(True):
        return fit([], [], 0.0)
    prior = float(n_toxic) / max(n, 1)
    term, p, u = _texts_with(terms, least_texts(sum(sizes.values())))
    kept = term[choose(p, u, sizes[True], sizes.get(False, 0), prior)].astype(np.int64)
    return fit_places(kept, *_places_of(terms, kept), prior)


def score(docs: DataFrame, model: Classifier, column: str = "score") -> DataFrame:
    """All documents with ``column``, from 0 to 1; higher means toxic is likelier."""
    prepare(docs.sparkSession)

    @F.pandas_udf("double")
    def rate(texts):
        import pandas as pd

        # A few hundred weights, which travel with the function.
        return pd.Series(model.score(["" if t is None else t for t in texts]), dtype="float64")

    return docs.withColumn(column, rate(whole_text("text")))


def keep_clean(docs: DataFrame, labels: DataFrame, *, learn: Column, threshold: float = 0.3, **options) -> DataFrame:
    """The documents that score below ``threshold``, with their own columns."""
    scored = score(docs, train(docs, labels, learn=learn, **options), "__toxicity")
    return scored.filter(F.col("__toxicity") < threshold).drop("__toxicity")
