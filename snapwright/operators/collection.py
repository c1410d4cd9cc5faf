"""A document collection: id, text, metadata and vector, searched by text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapwright.operators.embed import EncoderFactory, embed
from snapwright.operators.joins import BROADCAST_ROWS, sent_if
from snapwright.operators.retrieve import nearest
from snapwright.sources.published import PublishedTable

COLLECTION_SCHEMA = (
    T.StructType()
    .add("doc_id", T.StringType(), False)
    .add("text", T.StringType())
    .add("metadata", T.MapType(T.StringType(), T.StringType()))
    .add("embedding", T.ArrayType(T.FloatType()))
)


class Collection:
    """Documents under one folder. Metadata keys hold text values."""

    def __init__(self, spark: SparkSession, root: str, factory: EncoderFactory, dimension: int):
        self.table = PublishedTable(spark, root, COLLECTION_SCHEMA, "doc_id")
        self.factory = factory
        self.dimension = dimension

    def add_documents(self, documents: DataFrame) -> DataFrame:
        """Store (doc_id, text, metadata), replacing documents with the same id. Returns the ids written, each once.

        Of several rows of one id in a call the last by text (then by metadata) is stored. Rows without an id are an error.
        """
        metadata = F.col("metadata").cast("map<string,string>")
        rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text", metadata.alias("metadata"))
        entries = F.array_sort(F.map_entries("metadata"))
        last = rows.groupBy("doc_id").agg(F.max(F.struct("text", entries.alias("entries"))).alias("row"))
        rows = last.select(
            F.when(F.col("doc_id").isNull(), F.raise_error(F.lit("a document has no id"))).otherwise(F.col("doc_id")).alias("doc_id"),
            "row.text", F.map_from_entries("row.entries").alias("metadata"),
        )
        rows = embed(rows, "text", self.factory, dimension=self.dimension)
        commit = self.table.publish_changes(rows, rows.select("doc_id").limit(0))
        return self.table.spark.read.schema(COLLECTION_SCHEMA).parquet(commit.fresh).select("doc_id")

    def documents(self) -> DataFrame:
        return self.table.read()

    def similarity_search(self, queries: DataFrame, k: int = 5, where: dict[str, str | bool | int | float] | None = None) -> DataFrame:
        """The k documents nearest to each (query_id, text), among those whose metadata equals ``where``."""
        stored = self.documents()
        for key, value in (where or {}).items():
            # The same cast that stored the value, so that True finds what was stored from a boolean.
            stored = stored.filter(F.col("metadata")[key] == F.lit(value).cast("string"))
        asked = embed(queries.select("query_id", "text"), "text", self.factory, dimension=self.dimension)
        hits = nearest(stored, asked, k, vec_id="doc_id", query_vector="embedding").withColumnRenamed("vec_id", "doc_id")
        # At most k hits per query: few enough to go to the documents rather than shuffle those.
        hits = sent_if(queries.count() * k <= BROADCAST_ROWS, hits)
        return hits.join(stored.select("doc_id", "text", "metadata"), "doc_id")

    def delete(self) -> None:
        """Drop the collection."""
        self.table.drop()
