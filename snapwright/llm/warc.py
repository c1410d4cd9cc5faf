"""Web archives through a table of chunks.

Payloads are cut into rows of (record, chunk number, bytes). Writers and readers handle one chunk at a time and carry
the digest of what has passed so far, so no record is ever held whole on the Python side, however large.

A payload of at least ``least`` bytes that several records share is stored once, with the smallest page_id
(``response``); the others point to it (``revisit``). Records are gzip members of their own, as is usual for archives.

NULL html is the empty payload. A NULL page_id sorts after all others: such records can be revisits of a record with an
id, but are never pointed to. Rows with equal page_id and equal payload are the same record and each get its type.
A NULL url writes no address. An empty table gives no record. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwright.llm.common import in_batches, join_path, open_folder, prepare, staged

CHUNK_BYTES = 1 << 20
FILES = "file string, records long"
_FILES = pa.schema([("file", pa.string()), ("records", pa.int64())])
CHUNKS = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, chunk_no long,"
    " bytes_so_far long, digest_so_far string, last boolean"
)
_CHUNKS = [
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_digest", pa.string()), ("chunk_no", pa.int64()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()),
    ("last", pa.bool_()),
]


def typed_records(pages: DataFrame, *, least: int = 100) -> DataFrame:
    """Pages with payload (binary), payload_bytes, payload_digest, record_type and refers_to.

    Only (digest, page_id) pairs are grouped and joined. The records that point elsewhere are stored and looked up by
    id and digest; where they are few, Spark sees that from their size and moves no payload.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    pages = pages.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    sized = pages.filter(F.col("payload_bytes") >= least).select("page_id", "payload_digest")
    first = sized.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null")
    revisits = staged(
        sized.join(first.select("payload_digest", "first"), "payload_digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("first")))
        .select(F.col("page_id").alias("id"), F.col("payload_digest").alias("digest"), "first")
        .distinct(),
        "revisits",
    )
    found = pages.join(revisits, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("payload_digest") == F.col("digest")), "left")
    kind = F.when(F.col("first").isNull(), "response").otherwise("revisit")
    return found.select("page_id", "url", "payload", "payload_bytes", "payload_digest", kind.alias("record_type"), F.col("first").alias("refers_to"))


def chunk_table(records: DataFrame, *, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Records as rows of at most ``chunk_bytes``; the chunks of a record follow one another in its partition.

    A revisit has no payload to store and is one empty chunk; its length and digest stay those of the full payload.
    """
    stored = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    last = F.greatest(F.ceil(stored / chunk_bytes) - 1, F.lit(0)).cast("int")
    rows = records.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"), last.alias("last_no"))
    piece = F.when(F.col("record_type") == "response", F.substring("payload", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))).otherwise(F.lit(b""))
    return rows.withColumn("chunk", piece).drop("payload")


def write_archives(chunks: DataFrame, folder: str, *, file_bytes: int = 512 << 20, level: int = 1) -> DataFrame:
    """Write a chunk table as archives under ``folder``; returns the committed list of files.

    Tasks write files of their own names; only files named in the list, which Spark commits as a whole, are read.
    """
    spark = chunks.sparkSession
    prepare(spark)
    files, root = open_folder(folder)
    files.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        out, name, records, size, packer = None, "", 0, 0, None
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if row["chunk_no"] == 0:
                        if out is not None and size > file_bytes:
                            out.close()
                            yield pa.RecordBatch.from_pylist([{"file": name, "records": records}], _FILES)
                            out = None
                        if out is None:
                            name, records, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                            out = files.open_output_stream(join_path(root, name), compression=None)
                        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                        records += 1
                        size += out.write(packer.compress(_head(row)))
                    size += out.write(packer.compress(row["chunk"]))
                    if row["chunk_no"] == row["last_no"]:
                        size += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_pylist([{"file": name, "records": records}], _FILES)

    columns = "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "chunk_no", "last_no", "chunk"
    listed = f"{folder.rstrip('/')}/files"
    chunks.select(*columns).mapInArrow(write, FILES).write.parquet(listed)
    return spark.read.schema(FILES).parquet(listed)


def _head(row: dict) -> bytes:
    stored = row["payload_bytes"] if row["record_type"] == "response" else 0
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if row["url"] is not None:
        # Addresses come from outside: nothing in them may end a header line.
        lines.append(f"WARC-Target-URI: {quote(row['url'], safe=_SAFE)}")
    if row["refers_to"] is not None:
        lines.append(f"X-Refers-To-Page-Id: {row['refers_to']}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [f"WARC-Payload-Digest: sha256:{row['payload_digest']}", f"X-Payload-Length: {row['payload_bytes']}", "Content-Type: text/html; charset=utf-8"]
    return ("\r\n".join([*lines, f"Content-Length: {stored}"]) + "\r\n\r\n").encode("utf-8")


_SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


class _Members:
    """Plain bytes of a file of gzip members, read and unpacked piece by piece."""

    def __init__(self, opened, step: int):
        self.opened, self.step, self.packed, self.plain, self.unpacker = opened, step, b"", bytearray(), zlib.decompressobj(31)

    def fill(self) -> bool:
        while True:
            if self.unpacker.eof:
                self.packed = self.unpacker.unused_data + self.packed
                self.unpacker = zlib.decompressobj(31)
            if not self.packed:
                self.packed = self.opened.read(self.step)
                if not self.packed:
                    return False
            got = self.unpacker.decompress(self.packed, self.step)
            self.packed = self.unpacker.unconsumed_tail
            if self.unpacker.eof:
                self.packed = self.unpacker.unused_data
                self.unpacker = zlib.decompressobj(31)
            if got:
                self.plain += got
                return True

    def head(self) -> bytes | None:
        while (end := self.plain.find(b"\r\n\r\n")) < 0:
            if not self.fill():
                if self.plain:
                    raise ValueError("an archive ends inside a record's head")
                return None
        return self.take(end + 4)

    def take(self, size: int) -> bytes:
        while len(self.plain) < size:
            if not self.fill():
                raise ValueError("an archive ends inside a record")
        got = bytes(self.plain[:size])
        del self.plain[:size]
        return got


def read_archives(spark: SparkSession, folder: str, *, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """All records of the listed archives as a chunk table.

    ``bytes_so_far`` and ``digest_so_far`` cover the payload up to and with the chunk; in the last chunk they are
    those of the whole payload, and a response whose digest differs from its head is an error. A revisit has one chunk
    with the length and digest its head states. ``with_data`` adds the bytes themselves.
    """
    prepare(spark)
    listed = spark.read.schema(FILES).parquet(f"{folder.rstrip('/')}/files").select("file")
    schema = pa.schema(_CHUNKS + ([("chunk", pa.binary())] if with_data else []))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        files, root = open_folder(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with files.open_input_stream(join_path(root, name), compression=None, buffer_size=1 << 20) as opened:
                    yield from _records(_Members(opened, 1 << 18), chunk_bytes, with_data)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), schema, lambda row: 300 + (len(row[9]) if with_data else 0))

    wide = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return listed.repartition(wide, "file").mapInArrow(read, CHUNKS + (", chunk binary" if with_data else ""))


def _records(stream: _Members, chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    while (head := stream.head()) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:] if line)
        number = lambda key: int(fields[key]) if key in fields else None
        url = unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None
        stated, left, full = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["Content-Length"]), int(fields["X-Payload-Length"])
        base = (number("X-Page-Id"), url, fields["WARC-Type"], number("X-Refers-To-Page-Id"), stated)
        if base[2] == "revisit":
            yield (*base, 0, full, stated, True, *([b""] if with_data else []))
        else:
            digest, chunk_no, passed = hashlib.sha256(), 0, 0
            while True:
                chunk = stream.take(min(chunk_bytes, left))
                digest.update(chunk)
                left, passed = left - len(chunk), passed + len(chunk)
                if not left and digest.hexdigest() != stated:
                    raise ValueError("a payload does not match its digest")
                yield (*base, chunk_no, passed, digest.hexdigest(), not left, *([chunk] if with_data else []))
                if not left:
                    break
                chunk_no += 1
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its head says")


def archive(pages: DataFrame, folder: str, *, least: int = 100) -> DataFrame:
    """Write all pages as archives under ``folder`` and return the list of files."""
    return write_archives(chunk_table(typed_records(pages, least=least)), folder)
