"""Registered queries: one Spark callable per operator, with its DuckDB check where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwright.functions.arrays import contains_all, contains_value, overlaps
from snapwright.functions.predicates import in_box, is_active, open_at, schedule_to_json
from snapwright.functions.text import assemble, listing, sentence
from snapwright.operators.collection import Collection
from snapwright.operators.embed import embed, embed_distinct, embed_remembered, encoder
from snapwright.operators.joins import by_shuffle, without_keys
from snapwright.operators.lookups import ArrayPostings, GeoCurve, OpenSlots
from snapwright.operators.metadata import flatten_wide, metadata_long, metadata_variant, serialise
from snapwright.operators.retrieve import BoundedSearch, CellIndex, nearest, nearest_one
from snapwright.operators.rollups import (
    category_arrays,
    document_text,
    eligibility_arrays,
    instruction_text,
    phone_text,
    schedule_rollup,
)
from snapwright.operators.search import Wanted, search
from snapwright.operators.taxonomy import Taxonomy, bucket_by, classify, rename_by
from snapwright.plans import oracle as O
from snapwright.plans.prose import email_sentence, hours_sentence, prose_pieces, website_sentence
from snapwright.plans.run import Settings, embedded_snapshot, publish, snapshot_table
from snapwright.plans.run import run as run_once
from snapwright.plans.snapshot import (
    CORE_CATEGORIES,
    KEY_COLUMN,
    READING_IDS,
    WHITE_LABELS,
    build_snapshot,
    changed_services,
    deleted_ids,
    in_reading_order,
    joined_rows,
    numbered_in_order,
    packed_snapshot,
    resource_wide,
    service_wide,
)
from snapwright.session import ship_package
from snapwright.sources.fixtures import base_table, fixture_catalog
from snapwright.sources.published import stale_ids
from snapwright.sources.storage import scratch_root, stored
from snapwright.streaming.refresh import refresh

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return query(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add


def joined_text(array: Column | str) -> Column:
    """Array as text, NULL items spelled out."""
    column = F.col(array) if isinstance(array, str) else array
    return F.array_join(column.cast("array<string>"), "|", "<null>")


def time_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def snapshot_as_text(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        "service_id", "resource_id", "address_id", time_text("verified_at").alias("verified_at"),
        time_text("updated_at").alias("updated_at"), F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"), schedule_to_json(F.col("schedule")).alias("schedule"),
        *[joined_text(c).alias(c) for c in O.ARRAY_COLUMNS], "embedding_text",
    )



# -- snapshot --------------------------------------------------------------------------------------


@register("snapshot_full", O.over_snapshot(O.snapshot_text_select("snapshot")))
def snapshot_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_as_text(build_snapshot(fixture_catalog(spark, sf_dir)))


@register("snapshot_min", O.SNAPSHOT_MIN)
def snapshot_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active services of active resources with their category names and a short text."""
    cat = fixture_catalog(spark, sf_dir)
    services = cat["services"].filter(is_active(F.col("status")))
    wide = service_wide(services, cat["programs"]).join(
        resource_wide(cat["resources"], cat["phones"]), "resource_id"
    )
    categories = category_arrays(cat["categories_services"], cat["categories"], {"": CORE_CATEGORIES})
    text = assemble(
        F.concat("resource_name", F.lit(".")),
        sentence("Service: ", F.coalesce("service_name", F.lit("Unnamed Service"))),
        listing("Categories: ", F.col("category_names")),
    )
    return wide.join(categories, "service_id", "left").select(
        "service_id", "resource_id", joined_text("category_ids").alias("category_ids"),
        joined_text("category_names").alias("category_names"), text.alias("prose"),
    )


@register("prose_pieces", O.PROSE_PIECES)
def prose_pieces_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each distinct piece of text occurs, per piece."""
    rows = joined_rows(fixture_catalog(spark, sf_dir))
    pieces = F.array(*[F.struct(F.lit(n).alias("piece"), c.alias("text")) for n, c in prose_pieces().items()])
    return (
        rows.select(F.explode(pieces).alias("p"))
        .filter(F.col("p.text").isNotNull())
        .groupBy("p.piece", "p.text")
        .agg(F.count("*").alias("n"))
    )


# -- taxonomy --------------------------------------------------------------------------------------


@register("taxonomy_remap", O.TAXONOMY_REMAP)
def taxonomy_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked names after renaming, with how many links carry them."""
    cat = fixture_catalog(spark, sf_dir)
    links = cat["eligibilities_services"].groupBy("eligibility_id").agg(F.count("*").alias("n_links"))
    named = rename_by(cat["eligibilities"], "name", Taxonomy.default(spark).renames, "resolved_name")
    return named.join(links, F.col("id") == F.col("eligibility_id")).select("id", "name", "resolved_name", "n_links")


@register("taxonomy_bucket", O.TAXONOMY_BUCKET)
def taxonomy_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links per dimension and resolved name."""
    cat = fixture_catalog(spark, sf_dir)
    taxonomy = Taxonomy.default(spark)
    links = cat["eligibilities_services"].groupBy("eligibility_id").agg(F.count("*").alias("n"))
    named = rename_by(cat["eligibilities"], "name", taxonomy.renames, "resolved_name")
    bucketed = bucket_by(named, "resolved_name", taxonomy.buckets, "dimension")
    return (
        bucketed.join(links, F.col("id") == F.col("eligibility_id"))
        .groupBy("dimension", "resolved_name")
        .agg(F.sum("n").alias("n_links"))
    )


# -- rollups ---------------------------------------------------------------------------------------


@register("category_rollup", O.CATEGORY_ROLLUP)
def category_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = fixture_catalog(spark, sf_dir)
    rolled = category_arrays(cat["categories_services"], cat["categories"], {"": CORE_CATEGORIES})
    return rolled.select("service_id", *[joined_text(c).alias(c) for c in rolled.columns[1:]])


@register("whitelabel_rollup", O.WHITELABEL_ROLLUP)
def whitelabel_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = fixture_catalog(spark, sf_dir)
    families = {f"{family}_": ids for family, ids in WHITE_LABELS.items()}
    rolled = category_arrays(cat["categories_services"], cat["categories"], families)
    return rolled.select("service_id", *[joined_text(c).alias(c) for c in rolled.columns[1:]])


@register("eligibility_by_dimension", O.ELIGIBILITY_BY_DIMENSION)
def eligibility_by_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = fixture_catalog(spark, sf_dir)
    rolled = eligibility_arrays(
        cat["eligibilities_services"], classify(cat["eligibilities"], Taxonomy.default(spark))
    )
    return rolled.select("service_id", *[joined_text(c).alias(c) for c in rolled.columns[1:]])


@register("phones_text", O.PHONES_TEXT)
def phones_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phone_text(fixture_catalog(spark, sf_dir)["phones"])


@register("instructions_text", O.INSTRUCTIONS_TEXT)
def instructions_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruction_text(fixture_catalog(spark, sf_dir)["instructions"])


@register("documents_text", O.DOCUMENTS_TEXT)
def documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = fixture_catalog(spark, sf_dir)
    return document_text(cat["documents_services"], cat["documents"])


def rolled_schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = fixture_catalog(spark, sf_dir)
    return schedule_rollup(cat["schedules"], cat["schedule_days"])


@register("schedule_rollup", O.SCHEDULE_ROLLUP)
def schedule_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolled_schedules(spark, sf_dir).select(
        "schedule_id", "service_id", "resource_id", schedule_to_json(F.col("schedule")).alias("schedule")
    )


@register("hours_text", O.HOURS_TEXT)
def hours_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolled_schedules(spark, sf_dir).select("schedule_id", "hours_known", "hours_text")


# -- joins and choices -----------------------------------------------------------------------------


@register("address_fallback", O.ADDRESS_FALLBACK)
def address_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address of each row: linked, the resource's where no link exists, or none."""
    rows = build_snapshot(fixture_catalog(spark, sf_dir))
    return rows.groupBy("service_id", "address_id").agg(
        F.count("*").alias("n_rows"), F.max(F.col("latitude").cast("double")).alias("latitude")
    )


@register("schedule_fallback", O.SCHEDULE_FALLBACK)
def schedule_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which schedules meet in a row; both are kept, the service's is preferred."""
    rows = joined_rows(fixture_catalog(spark, sf_dir))
    return rows.groupBy("service_id", "service_schedule_id", "resource_schedule_id").agg(F.count("*").alias("n_rows"))


@register("reading_order", O.READING_ORDER)
def reading_order_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every row within its resource, in reading order."""
    rows = numbered_in_order(joined_rows(fixture_catalog(spark, sf_dir)))
    return rows.select("resource_id", "service_id", "address_id", "service_schedule_id", "resource_schedule_id", "row_number")


@register("reading_order_global", O.READING_ORDER_GLOBAL)
def reading_order_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every row in the whole result, in reading order."""
    # The place of a row follows from its ids, so texts and arrays are left out before rows are stored and sorted.
    rows = in_reading_order(joined_rows(fixture_catalog(spark, sf_dir)).select(*READING_IDS))
    return rows.select("resource_id", "service_id", "address_id", "service_schedule_id", "resource_schedule_id", "row_number")


@register("hours_choice", O.HOURS_CHOICE)
def hours_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = joined_rows(fixture_catalog(spark, sf_dir)).withColumn("hours", hours_sentence())
    return rows.groupBy("service_id", "hours").agg(F.count("*").alias("n_rows"))


@register("contact_choice", O.CONTACT_CHOICE)
def contact_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = fixture_catalog(spark, sf_dir)
    services = cat["services"].filter(is_active(F.col("status")))
    wide = service_wide(services, cat["programs"]).join(
        resource_wide(cat["resources"], cat["phones"]), "resource_id"
    )
    return wide.select("service_id", email_sentence().alias("email"), website_sentence().alias("website"))


# -- incremental -----------------------------------------------------------------------------------


@register("incremental_rows", O.INCREMENTAL_ROWS)
def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_as_text(build_snapshot(fixture_catalog(spark, sf_dir), since=O.WATERMARK))


@register("deleted_ids", O.DELETED_IDS)
def deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_ids(fixture_catalog(spark, sf_dir)["services"], O.WATERMARK)


@register("stale_ids", O.STALE_IDS)
def stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    services = fixture_catalog(spark, sf_dir)["services"]
    changed = changed_services(services, O.WATERMARK).select(F.col("id").alias("service_id"))
    return stale_ids(changed, deleted_ids(services, O.WATERMARK), "service_id")


def earlier_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The services as they stood before the watermark: later changes undone."""
    fixture_catalog(spark, sf_dir)["services"].createOrReplaceTempView("fx_services")
    return spark.sql(O.EARLIER_SERVICES)


CHECK_SETTINGS = Settings(dimension=O.DIMENSION)


@register("incremental_merge", O.INCREMENTAL_MERGE)
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old snapshot without stale services, plus the fresh rows."""
    cat = fixture_catalog(spark, sf_dir)
    old = packed_snapshot(cat.replacing(services=earlier_services(spark, sf_dir)))
    # Read twice, for its ids and for its rows, so it is built once, in its short form.
    changed = packed_snapshot(cat, since=O.WATERMARK)
    fresh = stored(changed.rows, "fresh")
    gone = stale_ids(fresh, deleted_ids(cat["services"], O.WATERMARK), "service_id")
    # Stale services go before their rows multiply.
    kept = old.unpack(without_keys(old.rows, gone, "service_id"))
    return snapshot_as_text(kept.unionByName(changed.unpack(fresh)))


@register("snapshot_skewed", O.over_snapshot(O.snapshot_text_select("snapshot")))
def snapshot_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot with every key above fifty rows treated as hot: sliced joins, fan-out and runs."""
    return snapshot_as_text(build_snapshot(fixture_catalog(spark, sf_dir), task_rows=50))


@register("snapshot_many_hot", O.over_snapshot(O.snapshot_text_select("snapshot")))
def snapshot_many_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with more hot keys than are fetched, so that they are joined by shuffle."""
    return snapshot_as_text(build_snapshot(fixture_catalog(spark, sf_dir), task_rows=50, hot_limit=0))


def vector_text() -> Column:
    used = F.filter(F.transform("embedding", lambda x, i: F.struct(i.alias("i"), x.cast("double").alias("x"))), lambda z: z["x"] != 0)
    return F.array_join(F.transform(used, lambda z: F.concat(z["i"].cast("string"), F.lit(":"), F.round(z["x"] * 10000).cast("bigint").cast("string"))), ",")


@register("publish_compacted", O.PUBLISH_COMPACTED)
def publish_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven increments over an outdated table, past the number that starts merging; all columns and vectors."""
    rows = stored(embedded_snapshot(build_snapshot(fixture_catalog(spark, sf_dir)), CHECK_SETTINGS), "rows")
    table = snapshot_table(spark, scratch_root(spark), CHECK_SETTINGS)
    table.publish_all(rows.withColumn("embedding_text", F.lit("outdated")))
    for turn in range(11):
        table.publish_changes(rows.filter(F.col("service_id") % 11 == turn), rows.select("service_id").limit(0))
    kept = table.read()
    return snapshot_as_text(kept.withColumn("embedding_text", F.col("embedding_text"))).join(
        by_shuffle(kept.select("embedding_text", vector_text().alias("vector")).distinct()), "embedding_text"
    )


@register("embed_snapshot_distinct", O.EMBED_SNAPSHOT_DISTINCT)
def embed_snapshot_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot embedded with one call per distinct text."""
    settings = Settings(dimension=O.DIMENSION, distinct_texts=True)
    rows = embedded_snapshot(build_snapshot(fixture_catalog(spark, sf_dir)), settings)
    return rows.groupBy("embedding_text").agg(F.count("*").alias("n_rows"), F.max(vector_text()).alias("vector"))


@register("run_log", O.RUN_LOG)
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a full run and of one that found nothing new."""
    cat = fixture_catalog(spark, sf_dir)
    table = snapshot_table(spark, scratch_root(spark), CHECK_SETTINGS)
    for _ in range(2):
        run_once(cat, table, CHECK_SETTINGS, now="2100-01-01 00:00:00")
    return table.run_log()


@register("publish_roundtrip", O.PUBLISH_ROUNDTRIP)
def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full publish, incremental publish, then what a reader sees."""
    cat = fixture_catalog(spark, sf_dir)
    table = snapshot_table(spark, scratch_root(spark), CHECK_SETTINGS)
    old = packed_snapshot(cat.replacing(services=earlier_services(spark, sf_dir)))
    publish(table, old, CHECK_SETTINGS, watermark=O.WATERMARK)
    fresh = packed_snapshot(cat, since=table.watermark())
    publish(table, fresh, CHECK_SETTINGS, deleted_ids(cat["services"], O.WATERMARK))
    return table.read().groupBy("service_id").agg(
        F.count("*").alias("n_rows"), F.min(F.size("embedding")).alias("dimension"),
        F.max("embedding_text").alias("last_text"),
    )


@register("stream_refresh", O.STREAM_REFRESH)
def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old snapshot brought up to date by a stream of changed service rows."""
    cat = fixture_catalog(spark, sf_dir)
    root = scratch_root(spark)
    table = snapshot_table(spark, f"{root}/table", CHECK_SETTINGS)
    old = build_snapshot(cat.replacing(services=earlier_services(spark, sf_dir)))
    publish(table, old, CHECK_SETTINGS)
    changes = cat["services"].filter(F.col("updated_at") > F.lit(O.WATERMARK).cast("timestamp_ntz"))
    changes.write.parquet(f"{root}/feed")
    feed = spark.readStream.schema(changes.schema).parquet(f"{root}/feed")
    refresh(feed, cat, table, CHECK_SETTINGS, f"{root}/checkpoint").awaitTermination()
    return table.read().groupBy("service_id").agg(
        F.count("*").alias("n_rows"), F.max("embedding_text").alias("last_text")
    )


@register("stream_state", O.STREAM_REFRESH)
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes, brought twice and the second time late, by a stream that keeps each service's newest time in its state."""
    cat = fixture_catalog(spark, sf_dir)
    root = scratch_root(spark)
    table = snapshot_table(spark, f"{root}/table", CHECK_SETTINGS)
    earlier = earlier_services(spark, sf_dir)
    publish(table, build_snapshot(cat.replacing(services=earlier)), CHECK_SETTINGS)
    changes = cat["services"].filter(F.col("updated_at") > F.lit(O.WATERMARK).cast("timestamp_ntz"))
    # Of every changed service the feed also brings what it was before.
    before = F.when(F.col("id") % 2 == 0, F.lit(O.WATERMARK).cast("timestamp_ntz") - F.expr("interval 1 day"))
    late = earlier.join(changes.select("id"), "id", "left_semi").withColumn("updated_at", before).select(*changes.columns)
    for batch in (changes, late):
        batch.write.mode("append").parquet(f"{root}/feed")
        feed = spark.readStream.schema(changes.schema).parquet(f"{root}/feed")
        refresh(feed, cat, table, CHECK_SETTINGS, f"{root}/checkpoint", stateful=True).awaitTermination()
    return table.read().groupBy("service_id").agg(F.count("*").alias("n_rows"), F.max("embedding_text").alias("last_text"))


@register("stream_two_feeds", O.STREAM_REFRESH)
def stream_two_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes by two streams into one table, each starting at its own batch 0."""
    cat = fixture_catalog(spark, sf_dir)
    root = scratch_root(spark)
    table = snapshot_table(spark, f"{root}/table", CHECK_SETTINGS)
    publish(table, build_snapshot(cat.replacing(services=earlier_services(spark, sf_dir))), CHECK_SETTINGS)
    changes = cat["services"].filter(F.col("updated_at") > F.lit(O.WATERMARK).cast("timestamp_ntz"))
    for name, part in (("even", changes.filter("id % 2 = 0")), ("odd", changes.filter("id % 2 = 1"))):
        part.write.parquet(f"{root}/{name}")
        feed = spark.readStream.schema(changes.schema).parquet(f"{root}/{name}")
        refresh(feed, cat, table, CHECK_SETTINGS, f"{root}/checkpoint-{name}").awaitTermination()
    return table.read().groupBy("service_id").agg(F.count("*").alias("n_rows"), F.max("embedding_text").alias("last_text"))


# -- embedding -------------------------------------------------------------------------------------

HASHED = {"dimension": O.DIMENSION}


def slot_rows(embedded: DataFrame, *keys: str) -> DataFrame:
    """One row per non-zero slot of each vector."""
    return (
        embedded.select(*keys, F.posexplode("embedding").alias("slot", "weight"))
        .filter(F.col("weight") != 0)
        .select(*keys, F.col("slot").cast("bigint").alias("slot"), F.round(F.col("weight").cast("double"), 4).alias("weight"))
    )


@register("embed_offline", O.EMBED_OFFLINE)
def embed_offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = base_table(spark, sf_dir, "documents").select("doc_id", "text")
    return slot_rows(embed(documents, "text", encoder("hashed", **HASHED), dimension=O.DIMENSION), "doc_id")


@register("embed_distinct", O.EMBED_DISTINCT)
def embed_distinct_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = base_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    embedded = embed_distinct(turns, "text", encoder("hashed", **HASHED), dimension=O.DIMENSION)
    return slot_rows(embedded, "conv_id", "turn")


@register("embed_remembered", O.EMBED_DISTINCT)
def embed_remembered_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after an earlier run over a part of the table, whose vectors are not made again."""
    turns = base_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    options = {"factory": encoder("hashed", **HASHED), "memory": f"{scratch_root(spark)}/vectors", "dimension": O.DIMENSION}
    embed_remembered(turns.filter(F.col("turn") == 0), "text", **options)
    return slot_rows(embed_remembered(turns, "text", **options), "conv_id", "turn")


@register("embed_dim_check", O.EMBED_DIM_CHECK)
def embed_dim_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = base_table(spark, sf_dir, "pages").select("page_id", "html")
    embedded = embed(pages, "html", encoder("hashed", **HASHED), dimension=O.DIMENSION)
    return embedded.groupBy(F.size("embedding").alias("dimension")).agg(F.count("*").alias("n_rows"))


# -- retrieval -------------------------------------------------------------------------------------


def centroids(vectors: DataFrame, *keys: str) -> DataFrame:
    """Mean vector per key, as query vectors."""
    means = (
        vectors.select(*keys, F.posexplode("embedding").alias("pos", "x"))
        .groupBy(*keys, "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("mean"))
    )
    listed = F.transform(F.sort_array(F.collect_list(F.struct("pos", "mean"))), lambda z: z["mean"])
    return means.groupBy(*keys).agg(listed.alias("query_vector"))


def label_queries(vectors: DataFrame) -> DataFrame:
    return centroids(vectors, "label").withColumnRenamed("label", "query_id")


def hits(found: DataFrame) -> DataFrame:
    return found.withColumn("similarity", F.round("similarity", 4))


@register("knn_exact", O.KNN_EXACT)
def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = base_table(spark, sf_dir, "embeddings")
    return hits(nearest(vectors, label_queries(vectors), 10))


@register("knn_filtered", O.KNN_FILTERED)
def knn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = base_table(spark, sf_dir, "embeddings")
    return hits(nearest(vectors.filter(F.col("label") == 3), label_queries(vectors), 5))


@register("knn_single", O.KNN_SINGLE)
def knn_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top k of one query vector, here the mean of all."""
    vectors = base_table(spark, sf_dir, "embeddings")
    query = centroids(vectors).head()["query_vector"]
    return nearest_one(vectors, query, 10).select("vec_id", "label", F.round("similarity", 4).alias("similarity"))


def every_vector(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


@register("knn_all_pairs", O.KNN_ALL_PAIRS)
def knn_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = base_table(spark, sf_dir, "embeddings")
    return hits(nearest(vectors, every_vector(vectors), 10))


@register("knn_chunked", O.KNN_ALL_PAIRS)
def knn_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with more queries than are sent to every task."""
    vectors = base_table(spark, sf_dir, "embeddings")
    return hits(nearest(vectors, every_vector(vectors), 10, broadcast_queries=10, block_cells=20_000, chunk_cells=5_000))


@register("knn_approx", O.KNN_APPROX)
def knn_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a query, in its eight nearest of the cells around the labels' means."""
    vectors = base_table(spark, sf_dir, "embeddings")
    centres = label_queries(vectors).orderBy("query_id").collect()  # one row per label
    index = CellIndex([row["query_vector"] for row in centres])
    return hits(index.nearest(index.assign(vectors), every_vector(vectors), 10, probes=8))


@register("knn_bounded", O.KNN_ALL_PAIRS)
def knn_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a query, exactly, leaving out cells that cannot hold a nearer one."""
    vectors = base_table(spark, sf_dir, "embeddings")
    centres = label_queries(vectors).orderBy("query_id").collect()  # one row per label
    index = CellIndex([row["query_vector"] for row in centres])
    return hits(BoundedSearch(index, index.assign(vectors)).nearest(every_vector(vectors), 10, probes=4))


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole snapshot as a published table, made anew, so that no query depends on what ran before it."""
    table = snapshot_table(spark, scratch_root(spark), CHECK_SETTINGS)
    publish(table, packed_snapshot(fixture_catalog(spark, sf_dir)), CHECK_SETTINGS)
    return table.read()


@register("snapshot_search", O.SNAPSHOT_SEARCH)
def snapshot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest to each benchmark text among the published rows inside a box and open on a Thursday afternoon."""
    queries = base_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    wanted = Wanted(box=(37.1, 37.8, -122.6, -122.1), open_on=("Thursday", 945))
    found = search(published(spark, sf_dir), queries, 5, wanted, factory=encoder("hashed", **HASHED), dimension=O.DIMENSION)
    return found.select("query_id", F.round("similarity", 4).alias("similarity"), "rank")


@register("array_filter", O.ARRAY_FILTER)
def array_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = published(spark, sf_dir)
    flag = lambda test: F.coalesce(test, F.lit(False))
    flagged = rows.select(
        "service_id", "address_id",
        flag(contains_value(F.col("eligibility_age"), "Youth (below 21 years old)")).alias("member"),
        flag(overlaps(F.col("eligibility_health"), ["Pregnant", "Mental Illness"])).alias("overlap"),
        flag(contains_all(F.col("eligibility_all"), ["Uninsured", "Refugees"])).alias("contained"),
    )
    return flagged.filter("member or overlap or contained")


@register("array_postings", O.ARRAY_FILTER)
def array_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by postings of the arrays' values: member and overlap are unions, containment counts matches."""
    rows = published(spark, sf_dir)
    columns = ["eligibility_age", "eligibility_health", "eligibility_all"]
    postings = ArrayPostings.build(rows, columns, f"{scratch_root(spark)}/postings", key=KEY_COLUMN)
    asked = {
        "member": postings.having_any("eligibility_age", ["Youth (below 21 years old)"], kinds=True),
        "overlap": postings.having_any("eligibility_health", ["Pregnant", "Mental Illness"], kinds=True),
        "contained": postings.having_all("eligibility_all", ["Uninsured", "Refugees"], kinds=True),
    }
    # Flags meet at the arrays' digests, which are far fewer than the rows that share them.
    found = reduce(DataFrame.unionByName, [kinds.select("kind", *[F.lit(n == name).alias(n) for n in asked]) for name, kinds in asked.items()])
    flags = postings.keys(found.groupBy("kind").agg(*[F.bool_or(n).alias(n) for n in asked]))
    return rows.select(KEY_COLUMN, "service_id", "address_id").join(flags, KEY_COLUMN).drop(KEY_COLUMN)


@register("geo_curve", O.GEO_BOX)
def geo_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same box over rows laid out along a curve through their coordinates."""
    rows = published(spark, sf_dir).select(KEY_COLUMN, "service_id", "address_id", "latitude", "longitude")
    inside = GeoCurve.build(rows, f"{scratch_root(spark)}/curve", key=KEY_COLUMN).in_box(37.2, 37.6, -122.5, -122.1)
    return inside.select("service_id", "address_id", F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"))


@register("open_slots", O.OPEN_AT)
def open_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by the slot of the week that the asked minute lies in."""
    rows = published(spark, sf_dir)
    keys = OpenSlots.build(rows, f"{scratch_root(spark)}/slots", key=KEY_COLUMN).open_at("Thursday", 945)
    return rows.join(keys, KEY_COLUMN, "left_semi").select("service_id", "address_id", schedule_to_json(F.col("schedule")).alias("schedule"))


@register("geo_box", O.GEO_BOX)
def geo_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = published(spark, sf_dir)
    inside = rows.filter(in_box(F.col("latitude"), F.col("longitude"), 37.2, 37.6, -122.5, -122.1))
    return inside.select(
        "service_id", "address_id", F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
    )


@register("open_at", O.OPEN_AT)
def open_at_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = published(spark, sf_dir)
    return rows.filter(open_at(F.col("schedule"), "Thursday", 945)).select(
        "service_id", "address_id", schedule_to_json(F.col("schedule")).alias("schedule")
    )


@register("service_lookup", O.SERVICE_LOOKUP)
def service_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one resource and of one service by id."""
    rows = published(spark, sf_dir)
    return rows.filter((F.col("resource_id") == 5) | (F.col("service_id") == 42)).select(
        "service_id", "resource_id", "address_id", "embedding_text"
    )


@register("resource_lookup", O.SERVICE_LOOKUP)
def resource_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, the two ids looked up apart: one by the files' ranges, one by their Bloom filters."""
    rows = published(spark, sf_dir).select("service_id", "resource_id", "address_id", "embedding_text")
    return rows.filter(F.col("resource_id") == 5).unionByName(rows.filter((F.col("service_id") == 42) & ~F.col("resource_id").eqNullSafe(5)))


@register("collection_roundtrip", O.COLLECTION_ROUNDTRIP)
def collection_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stored with metadata, then searched by text with a metadata filter."""
    documents = base_table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text",
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("metadata"),
    )
    collection = Collection(spark, scratch_root(spark), encoder("hashed", **HASHED), O.DIMENSION)
    collection.add_documents(documents)
    queries = base_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = collection.similarity_search(queries, 5, {"lang": "en"})
    return found.select(
        "query_id", "doc_id", "rank", F.round("similarity", 4).alias("similarity"), F.length("text").alias("length"),
        F.col("metadata")["source"].alias("source"),
    )


@register("collection_ids", O.COLLECTION_IDS)
def collection_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids that each of ten calls stored, past the number of segments that starts merging."""
    documents = base_table(spark, sf_dir, "documents").select("doc_id", "text", F.create_map(F.lit("lang"), "lang").alias("metadata"))
    collection = Collection(spark, scratch_root(spark), encoder("hashed", **HASHED), O.DIMENSION)
    told = [collection.add_documents(documents.filter(F.col("doc_id") % 10 == turn)).select(F.lit(turn).alias("turn"), "doc_id") for turn in range(10)]
    return reduce(DataFrame.unionByName, told)


@register("knn_filter_typed", O.KNN_FILTER_TYPED)
def knn_filter_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search among documents whose metadata says True, stored from a boolean."""
    labels = base_table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("toxic"))
    documents = base_table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    collection = Collection(spark, scratch_root(spark), encoder("hashed", **HASHED), O.DIMENSION)
    metadata = F.map_concat(F.create_map(F.lit("source"), "source"), F.create_map(F.lit("toxic"), F.col("toxic").cast("string")))
    collection.add_documents(documents.select("doc_id", "text", metadata.alias("metadata")))
    queries = base_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = collection.similarity_search(queries, 5, {"toxic": True})
    return found.select(
        "query_id", "doc_id", "rank", F.round("similarity", 4).alias("similarity"), F.length("text").alias("length"),
        F.col("metadata")["source"].alias("source"),
    )


# -- metadata --------------------------------------------------------------------------------------


@register("metadata_wide_maps", O.METADATA_WIDE_MAPS)
def metadata_wide_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps whose keys only the data knows, as columns."""
    documents = base_table(spark, sf_dir, "documents")
    place = F.concat(F.lit("place_"), F.col("doc_id") % 3)
    inner = F.struct(F.col("doc_id").alias("id"))
    maps = documents.select("doc_id", F.create_map(place, "lang").alias("seen"), F.struct(F.create_map("lang", inner).alias("lang")).alias("by"))
    return flatten_wide(maps, ["doc_id"])


def nested_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with nested metadata: structs, arrays, a map, times and many absent values."""
    for name in ("documents", "labels", "pages", "events"):
        base_table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(
        """
select d.doc_id, d.source as source_filename, p.url as source_url, l.quality as page_number,
 cast(d.doc_id % 5 as int) as chunk_index, d.n_chars as token_count, l.toxic = 1 as is_toxic,
 case when d.doc_id % 7 <> 0 then 'leaflet' end as document_type, e.ts as extracted_date,
 named_struct(
  'related_service_id', case when d.doc_id % 2 = 0 then d.doc_id end,
  'service_type', d.lang,
  'mentioned_services', case when d.doc_id % 4 <> 0 then array(d.source, d.lang) else cast(array() as array<string>) end,
  'contact', case when d.doc_id % 3 <> 0 then named_struct('phone', concat('ext. ', d.doc_id),
    'email', case when d.doc_id % 2 = 1 then concat(d.lang, '@example.net') end, 'website', p.url) end,
  'service_details', named_struct(
    'hours', case d.doc_id % 6 when 0 then cast(map() as map<string,string>) when 1 then map('weekdays', 'from 8 to 4')
      else map('weekdays', 'from 8 to 4', 'saturday', concat('before ', d.doc_id % 12)) end,
    'cost', case when d.doc_id % 5 = 0 then 'none' end,
    'languages', array(d.lang, 'Welsh'))) as extracted
from documents d left join labels l on l.doc_id = d.doc_id left join pages p on p.page_id = d.doc_id
left join events e on e.event_id = d.doc_id"""
    )


@register("metadata_flat", O.METADATA_FLAT)
def metadata_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_wide(nested_metadata(spark, sf_dir), ["doc_id"])


@register("metadata_entries", O.METADATA_ENTRIES)
def metadata_key_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata_long(nested_metadata(spark, sf_dir), ["doc_id"])


@register("metadata_variant", O.METADATA_ENTRIES)
def metadata_by_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same entries by way of VARIANT values."""
    return metadata_variant(nested_metadata(spark, sf_dir), ["doc_id"])


@register("metadata_serialised", O.METADATA_SERIALISED)
def metadata_serialised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serialise(nested_metadata(spark, sf_dir), ["doc_id"])
