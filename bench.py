"""Headline timings: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the data and the cores."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from snapwright.operators.embed import embed, encoder
from snapwright.operators.metadata import metadata_long
from snapwright.operators.retrieve import CellIndex, nearest, recall
from snapwright.plans.queries import label_queries, nested_metadata
from snapwright.plans.run import Settings, embedded_snapshot, snapshot_table
from snapwright.plans.snapshot import build_snapshot, deleted_ids
from snapwright.session import build_session, ship_package
from snapwright.sources.fixtures import base_table, fixture_catalog
from snapwright.sources.storage import scratch_root

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "2"))


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="snapwright-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)

    services = fixture_catalog(spark, SF_DIR)["services"]
    last_percent = services.select(F.percentile_approx(F.unix_micros(F.col("updated_at").cast("timestamp")), 0.99)).head()[0]
    watermark = spark.sql(f"select cast(timestamp_micros({last_percent}) as timestamp_ntz) as t").head()["t"]
    vectors = base_table(spark, SF_DIR, "embeddings")
    documents = base_table(spark, SF_DIR, "documents").select("doc_id", "text")
    hashed = encoder("hashed", dimension=1024)
    settings = Settings(dimension=64)

    def snapshot_full():
        consume(build_snapshot(fixture_catalog(spark, SF_DIR)))

    def incremental_1pct():
        catalog = fixture_catalog(spark, SF_DIR)
        consume(build_snapshot(catalog, since=watermark))
        consume(deleted_ids(catalog["services"], watermark))

    def publish_full_and_1pct():
        catalog = fixture_catalog(spark, SF_DIR)
        table = snapshot_table(spark, scratch_root(spark), settings)
        table.publish_all(embedded_snapshot(build_snapshot(catalog), settings))
        fresh = embedded_snapshot(build_snapshot(catalog, since=watermark), settings)
        table.publish_changes(fresh, deleted_ids(catalog["services"], watermark))
        table.read().count()

    def embed_documents():
        consume(embed(documents, "text", hashed, dimension=1024, tasks=int(CPUS)))

    def knn_exact():
        consume(nearest(vectors, label_queries(vectors), 10))

    def knn_all_pairs():
        asked = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
        consume(nearest(vectors, asked, 10))

    trained: dict = {}

    def knn_train():
        index = CellIndex.train(vectors, 16)
        folder = f"{scratch_root(spark)}/cells"
        index.assign(vectors).write.partitionBy("cell").parquet(folder)
        trained["index"], trained["assigned"] = index, spark.read.parquet(folder)

    def knn_approx():
        consume(trained["index"].nearest(trained["assigned"], label_queries(vectors), 10, probes=6))

    def metadata_rows():
        consume(metadata_long(nested_metadata(spark, SF_DIR), ["doc_id"]))

    timings: dict[str, float] = {}
    for query in (
        snapshot_full, incremental_1pct, publish_full_and_1pct, embed_documents, knn_exact, knn_all_pairs,
        knn_train, knn_approx, metadata_rows,
    ):
        best = None
        for _ in range(ROUNDS):
            started = time.perf_counter()
            query()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        timings[query.__name__] = round(best, 3)

    exact = nearest(vectors, label_queries(vectors), 10)
    found = trained["index"].nearest(trained["assigned"], label_queries(vectors), 10, probes=6)
    print(
        json.dumps(
            {
                "metric": "total_time", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "rates": {
                    "snapshot_rows": build_snapshot(fixture_catalog(spark, SF_DIR)).count(),
                    "embedded_texts_per_sec": round(documents.count() / timings["embed_documents"]),
                    "all_pairs_queries_per_sec": round(vectors.count() / timings["knn_all_pairs"]),
                    "recall_at_10": round(recall(found, exact), 3),
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
