"""Registered queries against DuckDB over whole tables, and the pipeline against its operators one by one."""

import html
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from snapwright.llm.queries import ORACLE, QUERIES
from tests.llm.test_tokens import check_sequences, plain

duckdb = pytest.importorskip("duckdb")


def ids_of(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    cursor = con.execute(ORACLE[name])
    places = [[d[0] for d in cursor.description].index(c) for c in columns]
    assert got == Counter(tuple(r[i] for i in places) for r in cursor.fetchall())


def test_records_query(spark, sf_dir):
    rows = QUERIES["op8_records"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    at = 0
    for row, doc_id in zip(sorted(rows, key=lambda r: r["start"]), sorted(texts), strict=True):
        ids = [*plain(texts[doc_id]), 2]
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc_id, at, len(ids))
        assert row["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        at += len(ids)


def test_packing_query(spark, sf_dir):
    rows = QUERIES["op6_packing"](spark, sf_dir).collect()
    total = sum(r["length"] for r in rows)
    assert -(-total // 2048) <= check_sequences(rows, 2048) <= total // 2048 * 1.03 + 2
    assert total == sum(len(plain(r["text"])) + 1 for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())


def test_pages_query(spark, sf_dir):
    rows = QUERIES["op1_html_text"](spark, sf_dir).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        # These pages are of one make: the article's blocks, inline tags taken out.
        body = pages[r["page_id"]].split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        body = re.sub(r"<[^<>]*\Z", "", body)
        words = html.unescape(re.sub(r"</?b>", "", body).replace("<br>", " ").replace("<p>", " ").replace("</p>", " ").replace("<h1>", "").replace("</h1>", " ")).split()
        assert r["text"].split() == words and r["text"] == " ".join(words)


def test_pipeline_decides_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, ids_of(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
        after = ids_of(docs)
        assert docs.columns == columns and after < before, name
        before = after
    packed = corpus_pipeline.run(spark, sf_dir)
    assert ids_of(packed) == before
