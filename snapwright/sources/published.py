"""A published table: immutable parquet segments and numbered commit files.

Readers take the newest commit, so they see the old table until the new one is complete. A full publish
starts a new list of segments. An incremental publish adds one segment of fresh rows with the ids it
replaces; the old rows are hidden at read time, so the work is in step with the change, not the table.
Beyond ``MERGE_AFTER`` segments the two neighbours with the fewest rows are merged, so small segments meet small
ones and the large first one is rewritten only once the others have grown to its size.

Rows are laid out by ranges of the key, so a lookup by key opens few files.

The watermark travels in the commit: rows and watermark change together. So does the last batch of every feed, by
which a repeated batch is recognised whatever else was published in between.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapwright.operators.joins import BROADCAST_ROWS, sent_if
from snapwright.sources.storage import Folder, bloom_options, stored

MERGE_AFTER = 8
COMMIT_NAME = "{:012d}.json"
Finish = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Commit:
    number: int
    segments: tuple[dict, ...] = ()
    watermark: str | None = None
    report: dict | None = None
    feeds: tuple[tuple[str, int], ...] = ()
    fresh: str | None = None

    def to_json(self) -> dict:
        return {
            "segments": list(self.segments), "watermark": self.watermark, "report": self.report,
            "feeds": dict(self.feeds), "fresh": self.fresh,
        }


EMPTY = Commit(-1)

REPORT_SCHEMA = (
    "commit bigint, total_rows bigint, total_batches bigint, removed_ids bigint, mode string, status string"
)


class PublishedTable:
    """``key`` is the id column whose rows an incremental publish replaces.

    Files hold ranges of the key. ``blooms`` names columns that get a Bloom filter in every row group, so that a lookup by
    another id skips most of them.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, order: list[Column] | None = None, blooms: Sequence[str] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = key
        self.order = order or [F.col(key).asc_nulls_last()]
        self.blooms = tuple(blooms)
        self._commits = Folder(spark, f"{self.root}/commits")

    # -- reading -------------------------------------------------------------------------------

    def _commit_numbers(self) -> list[int]:
        return [int(name[:-5]) for name in self._commits.names() if name.endswith(".json") and name[0] != "."]

    def latest(self) -> Commit:
        numbers = self._commit_numbers()
        return self.commit(numbers[-1]) if numbers else EMPTY

    def commit(self, number: int) -> Commit:
        body = self._commits.read_json(COMMIT_NAME.format(number))
        feeds = tuple(sorted(body["feeds"].items()))
        return Commit(number, tuple(body["segments"]), body["watermark"], body["report"], feeds, body["fresh"])

    def watermark(self) -> str | None:
        """Start of the run whose rows are published; None before the first run."""
        return self.latest().watermark

    def exists(self) -> bool:
        return bool(self.latest().segments)

    def read(self, commit: Commit | None = None) -> DataFrame:
        commit = commit or self.latest()
        if not commit.segments:
            return self.spark.createDataFrame([], self.schema)
        parts = [
            self.spark.read.schema(self.schema).parquet(segment["rows"]).withColumn("__segment", F.lit(i))
            for i, segment in enumerate(commit.segments)
        ]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        replaced = [(i, s["replaced"]) for i, s in enumerate(commit.segments) if s.get("replaced")]
        if replaced:
            # Segments of older commits do not say how many ids they replace.
            listed = sum(s.get("gone", BROADCAST_ROWS + 1) for s in commit.segments if s.get("replaced"))
            rows = rows.join(
                sent_if(listed <= BROADCAST_ROWS, self._replaced(replaced)),
                (F.col(self.key) == F.col("__gone")) & (F.col("__segment") < F.col("__by")),
                "left_anti",
            )
        return rows.drop("__segment")

    def _replaced(self, listed: list[tuple[int, str]]) -> DataFrame:
        """(id, newest segment that replaces it)."""
        id_type = self.schema[self.key].dataType
        id_schema = T.StructType([T.StructField(self.key, id_type)])
        ids = [
            self.spark.read.schema(id_schema).parquet(path).select(F.col(self.key).alias("__gone"), F.lit(i).alias("__by"))
            for i, path in listed
        ]
        together = ids[0]
        for part in ids[1:]:
            together = together.unionByName(part)
        return together.groupBy("__gone").agg(F.max("__by").alias("__by"))

    def run_log(self) -> DataFrame:
        """One row per publish or skipped run."""
        rows = []
        for number in self._commit_numbers():
            report = self.commit(number).report or {}
            rows.append(
                (
                    number, report.get("total_rows"), report.get("total_batches"), report.get("removed_ids"),
                    report.get("mode"), report.get("status"),
                )
            )
        return self.spark.createDataFrame(rows, REPORT_SCHEMA)

    # -- writing -------------------------------------------------------------------------------

    def _new_path(self, kind: str) -> str:
        return f"{self.root}/{kind}/{uuid.uuid4().hex}"

    def _write_rows(self, rows: DataFrame, finish: Finish | None = None, order: Sequence[Column] | None = None) -> tuple[str, int]:
        """Path and number of the rows written. The number is observed by the write itself."""
        path, seen = self._new_path("rows"), Observation()
        # Choosing ranges reads its input once before it is written, so rows that are dear to make are stored first.
        rows = stored(rows if finish else rows.select(*self.schema.names), "fresh")
        # Equal keys are told apart by their place in the stored files, which a repeated task finds again, so one key with very many rows still spreads over ranges.
        spread = rows.withColumn("__place", F.monotonically_increasing_id()).repartitionByRange(F.col(self.key), F.col("__place"))
        laid_out = spread.drop("__place").sortWithinPartitions(self.key, *(order or self.order))
        whole = (finish(laid_out) if finish else laid_out).select(*self.schema.names).observe(seen, F.count(F.lit(1)).alias("n"))
        whole.write.options(**bloom_options(self.blooms)).parquet(path)
        return path, seen.get["n"]

    def _finish(
        self, base: Commit, segments: list[dict], watermark, report: dict, feeds: dict | None = None, fresh: str | None = None
    ) -> Commit:
        kept = dict(base.feeds) | (feeds or {})
        commit = Commit(base.number + 1, tuple(segments), watermark, report, tuple(sorted(kept.items())), fresh)
        self._commits.create_json(COMMIT_NAME.format(commit.number), commit.to_json())
        return commit

    def publish_all(
        self, rows: DataFrame, *, watermark: str | None = None, batch_size: int = 25, finish: Finish | None = None, order: Sequence[Column] | None = None
    ) -> Commit:
        """Replace the whole table.

        ``finish`` adds columns, or makes several rows of one, row by row, keeping the rows' order. It is applied as the rows are
        written, so what it adds is not stored, sampled and shuffled on the way. ``order`` is the order within a key of rows
        that lack a column of the table's own order until then.
        """
        base = self.latest()
        path, total = self._write_rows(rows, finish, order)
        return self._finish(base, [{"rows": path, "n": total}], watermark, run_report(total, batch_size, "full"), fresh=path)

    def publish_changes(
        self,
        fresh: DataFrame,
        removed: DataFrame,
        *,
        watermark: str | None = None,
        feed: tuple[str, int] | None = None,
        batch_size: int = 25,
        finish: Finish | None = None,
        order: Sequence[Column] | None = None,
    ) -> Commit:
        """Replace every row of the ids in ``fresh`` and drop the ids in ``removed``.

        ``finish`` and ``order`` are as in :meth:`publish_all`. ``feed`` is a feed's name and the number of its batch. A batch that the table already holds changes nothing.
        """
        base = self.latest()
        if feed is not None and dict(base.feeds).get(feed[0], -1) >= feed[1]:
            return base
        fresh_path, total = self._write_rows(fresh, finish, order)
        written = self.spark.read.schema(self.schema).parquet(fresh_path)
        gone_path = self._new_path("replaced")
        stale_ids(written.select(self.key), removed.select(self.key), self.key).write.parquet(gone_path)
        report = run_report(total, batch_size, "incremental")
        report["removed_ids"] = self.spark.read.parquet(gone_path).count()
        segments = [*base.segments, {"rows": fresh_path, "replaced": gone_path, "n": total, "gone": report["removed_ids"]}]
        while len(segments) > MERGE_AFTER:
            segments = self._merge_smallest(segments)
        feeds = dict([feed]) if feed is not None else None
        return self._finish(base, segments, watermark if watermark is not None else base.watermark, report, feeds, fresh_path)

    def _merge_smallest(self, segments: list[dict]) -> list[dict]:
        """The two neighbours with the fewest rows as one segment; what both replace in older ones is kept."""
        at = min(range(len(segments) - 1), key=lambda i: segments[i]["n"] + segments[i + 1]["n"])
        pair = segments[at : at + 2]
        path, total = self._write_rows(self.read(Commit(-1, tuple(pair))))
        merged = {"rows": path, "n": total}
        if at:
            gone = self._new_path("replaced")
            ids = [self.spark.read.parquet(s["replaced"]).select(self.key) for s in pair]
            ids[0].union(ids[1]).distinct().write.parquet(gone)
            merged |= {"replaced": gone, "gone": self.spark.read.parquet(gone).count()}
        return [*segments[:at], merged, *segments[at + 2 :]]

    def record_skip(self) -> Commit:
        """Log a run that found nothing to do; rows and watermark stay."""
        base = self.latest()
        return self._finish(base, list(base.segments), base.watermark, dict(SKIPPED))

    def retain(self, versions: int = 2) -> int:
        """Remove the data of all but the newest ``versions`` versions; their log entries stay. Returns folders removed.

        Readers of older versions must be done, as must every writer that has not committed.
        """
        numbers = self._commit_numbers()
        kept = {path for n in numbers[-max(1, versions) :] for path in self._paths(self.commit(n))}
        removed = 0
        for kind in ("rows", "replaced"):
            folder = Folder(self.spark, f"{self.root}/{kind}")
            for name in folder.names():
                if f"{self.root}/{kind}/{name}" not in kept:
                    folder.remove(name)
                    removed += 1
        return removed

    @staticmethod
    def _paths(commit: Commit) -> set[str]:
        listed = {s[part] for s in commit.segments for part in ("rows", "replaced") if s.get(part)}
        return listed | ({commit.fresh} if commit.fresh else set())

    def drop(self) -> Commit:
        """Publish "no table"; older commits stay readable by number."""
        return self._finish(self.latest(), [], None, {"mode": "drop", "status": "success"})


def run_report(rows: int, batch_size: int, mode: str) -> dict:
    """Row and batch counts of a run."""
    return {"total_rows": rows, "total_batches": -(-rows // batch_size), "mode": mode, "status": "success"}


SKIPPED = {"total_rows": 0, "total_batches": 0, "mode": "incremental", "status": "skipped"}


def stale_ids(changed: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Ids to delete before fresh rows go in: changed or removed, once each."""
    return changed.select(key).union(removed.select(key)).distinct()


def run_start() -> str:
    """The time to record as watermark: the start of the run, so changes made during it are not lost."""
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
