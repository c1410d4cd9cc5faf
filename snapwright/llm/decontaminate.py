"""Which words of documents lie in passages of a benchmark: a prefix-filtered set join in built-in functions only.

Words are runs outside ASCII punctuation, blanks and control characters, with A-Z lowered. Every item gives windows of
``size`` consecutive words, an item of fewer words one window of them all. A window must occur whole, so of its words,
ordered by rarity in the documents, the prefix that has to match is the first: the rarest one. Documents meet windows on
that word only. Its place in the window then fixes where the window would have to start (positional bound), the
document must reach as far as the window does (length bound), and the words there must equal the window's.

Rarity is counted over all documents. Windows are broadcast only where their number and bytes are below fixed bounds;
otherwise both steps are shuffle joins, of counted words in the first and of rare words in the second.

NULL and wordless texts have no words and no hits; wordless items have no windows. Documents with NULL or repeated ids
keep their rows (they are told apart by their text); equal rows get equal results. Items with a NULL id mark words but
are not listed. Equal windows of several items are one window. Empty tables are fine on either side. Extra columns pass
through :func:`clean` and are ignored elsewhere.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwright.llm.common import staged

#: Everything in ASCII but digits and small letters; texts are lowered first.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lowering.
SEPARATORS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 48 << 20


def words(text: Column) -> Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, SEPARATORS_ANY_CASE), "")), F.lit(0)).cast("long")


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct windows: window_id, gram (their words) and item_ids (sorted, without NULL)."""
    own = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text").cast("string")).alias("own")).filter("size(own) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("own") - size + 1, F.lit(1)))
    grams = own.select("item_id", F.explode(starts).alias("at"), "own").select("item_id", F.slice("own", F.col("at"), F.lit(size)).alias("gram"))
    return grams.groupBy("gram").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")).withColumn("window_id", F.sha2(F.array_join("gram", " "), 256))


def _fits(df: DataFrame, weight: Column) -> bool:
    """Whether a stored table is below the bounds of a broadcast."""
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def rarity(docs: DataFrame, vocabulary: DataFrame, small: bool) -> DataFrame:
    """How often each word of ``vocabulary`` (word) occurs in the documents: word, n; words that never occur are absent."""
    every = docs.select(F.explode(words(F.col("text"))).alias("word"))
    if small:
        return every.join(F.broadcast(vocabulary), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return every.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(vocabulary, "word", "left_semi")


def occurrences(docs: DataFrame, items: DataFrame, *, size: int = 10) -> tuple[DataFrame, DataFrame]:
    """Verified windows in documents (doc_id, text_hash, start, length, window_id), and the windows themselves."""
    docs = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull())
    windows = staged(item_windows(items, size), "windows")
    small = _fits(windows, F.aggregate("gram", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + 32))
    counted = staged(rarity(docs, windows.select(F.explode("gram").alias("word")).distinct(), small), "rarity")

    # A window with a word that no document has can be left out: the inner join on every word's count tells.
    placed = windows.select("window_id", "gram", F.posexplode("gram").alias("at", "word")).join(counted, "word")
    ranked = placed.groupBy("window_id").agg(
        F.min_by(F.struct("word", "at"), F.struct("n", "word", "at")).alias("prefix"), F.count(F.lit(1)).alias("found"), F.first("gram").alias("gram")
    )
    needed = ranked.filter(F.col("found") == F.size("gram")).select(
        "window_id", "gram", F.col("prefix.word").alias("word"), F.col("prefix.at").alias("at"), F.size("gram").alias("length"), F.element_at("gram", 1).alias("opens")
    )
    needed = staged(needed, "prefixes")

    tokenised = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("own"))
    tokens = tokenised.select("doc_id", "text_hash", "own", F.posexplode("own").alias("p", "token"))
    begin = F.col("p") - F.col("at")
    match = (
        (F.col("token") == F.col("word"))
        & (begin >= 0)
        & (begin + F.col("length") <= F.size("own"))
        & (F.try_element_at("own", F.greatest(begin + 1, F.lit(1))) == F.col("opens"))
        & (F.slice("own", F.greatest(begin + 1, F.lit(1)), F.col("length")) == F.col("gram"))
    )
    if small:
        hits = tokens.join(F.broadcast(needed), match)
    else:
        # Words travel alone; those that start a candidate fetch their neighbourhood from the document, which is shuffled once.
        rare = needed.select("word").distinct()
        key = ["doc_id", "text_hash"]
        starts = tokenised.select(*key, F.posexplode("own").alias("p", "token")).join(rare, F.col("token") == F.col("word"), "left_semi").distinct()
        texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), "text").dropDuplicates(["id", "hash"])
        fetched = starts.join(texts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
        # The words are kept as an array of one document for all its starts, and cut for each of them before they travel on.
        listed = fetched.groupBy(*key).agg(F.collect_list(F.struct("p", "token")).alias("starts"), F.first("text").alias("text"))
        each = listed.withColumn("own", words(F.col("text"))).select(*key, "own", F.explode("starts").alias("s")).select(*key, "own", "s.p", "s.token")
        around = F.slice("own", F.greatest(F.col("p") + 1 - (size - 1), F.lit(1)), F.lit(2 * size - 1))
        near = each.select(*key, "p", "token", F.size("own").alias("n"), around.alias("around"), F.least(F.col("p"), F.lit(size - 1)).alias("q"))
        local = F.col("q") - F.col("at")
        hits = near.join(
            needed,
            (F.col("token") == F.col("word"))
            & (local >= 0)
            & (F.col("p") - F.col("at") + F.col("length") <= F.col("n"))
            & (F.slice("around", F.greatest(local + 1, F.lit(1)), F.col("length")) == F.col("gram")),
        )
    return hits.select("doc_id", "text_hash", begin.alias("start"), "length", "window_id"), windows


def contamination(docs: DataFrame, items: DataFrame, *, size: int = 10) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, n_items, item_ids (sorted as strings), contaminated."""
    hits, windows = occurrences(docs, items, size=size)
    hits = staged(hits.distinct(), "hits")
    key = ["doc_id", "text_hash"]
    end = F.col("start") + F.col("length")
    before = F.max(end).over(Window.partitionBy(*key).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(end - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))), F.lit(0))
    covered = hits.select(*key, "start", "length").distinct().select(*key, fresh.alias("fresh")).groupBy(*key).agg(F.sum("fresh").cast("long").alias("n_hit"))
    listed = (
        hits.select(*key, "window_id").distinct().join(windows.select("window_id", F.explode("item_ids").alias("item_id")), "window_id")
        .groupBy(*key).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    found = covered.join(listed, same(covered, listed), "left").select(covered["doc_id"].alias("id"), covered["text_hash"].alias("hash"), "n_hit", "item_ids")
    found = staged(found, "found")
    text = F.col("text").cast("string")
    every = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), word_count(text).alias("n_words"))
    out = every.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    items_found = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.size(items_found).cast("long").alias("n_items"), items_found.alias("item_ids"), (n_hit > 0).alias("contaminated")
    )


def clean(docs: DataFrame, items: DataFrame, *, size: int = 10) -> DataFrame:
    """The documents without any word in a benchmark passage, all their columns kept."""
    hits, _ = occurrences(docs, items, size=size)
    marked = staged(hits.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "contaminated")
    return docs.join(marked, docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"].cast("string")) == F.col("__hash")), "left_anti")
