"""One full or incremental run: load, embed, publish, move the watermark."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapwright.operators.embed import EncoderFactory, embed, embed_distinct, embed_remembered, encoder, remote, retrying
from snapwright.operators.joins import broadcast_if_small
from snapwright.plans.snapshot import (
    KEY_COLUMN,
    Packed,
    changed_services,
    conform,
    deleted_ids,
    packed_snapshot,
    reading_order,
    snapshot_schema,
)
from snapwright.sources.catalog import SourceCatalog
from snapwright.sources.published import Commit, PublishedTable, run_start
from snapwright.sources.storage import stored


@dataclass(frozen=True)
class Settings:
    """What a run needs to know. The defaults are the usual production values.

    ``provider`` names a registered encoder, or is ``module:function``. ``texts_per_second`` limits the whole job;
    its tasks share it, so it needs ``tasks``. Throttled calls are always retried. ``distinct_texts`` sends each
    different text once; by default it does so for every encoder but the offline one, which costs less than the search.
    ``memory`` is a folder that keeps every vector between runs, so that only texts never met are sent.
    """

    provider: str = "hashed"
    dimension: int = 1024
    batch_size: int = 25
    tasks: int | None = None
    provider_options: dict = field(default_factory=dict)
    snapshot_options: dict = field(default_factory=dict)
    texts_per_second: float | None = None
    distinct_texts: bool | None = None
    memory: str | None = None

    def factory(self) -> EncoderFactory:
        options = self.provider_options or ({"dimension": self.dimension} if self.provider == "hashed" else {})
        made = encoder(self.provider, **options)
        if self.texts_per_second is None:
            return retrying(made)
        if self.tasks is None:
            raise ValueError("texts_per_second needs tasks, which share it")
        return remote(made, job_rate=self.texts_per_second, tasks=self.tasks)

    @property
    def once_per_text(self) -> bool:
        return self.provider != "hashed" if self.distinct_texts is None else self.distinct_texts


def stored_schema(settings: Settings) -> T.StructType:
    data = snapshot_schema(**{k: v for k, v in settings.snapshot_options.items() if k == "white_labels"})
    schema = T.StructType([T.StructField(KEY_COLUMN, T.StringType(), False), *data.fields])
    return schema.add("embedding", T.ArrayType(T.FloatType()), False)


def snapshot_table(spark: SparkSession, root: str, settings: Settings) -> PublishedTable:
    return PublishedTable(spark, root, stored_schema(settings), "service_id", reading_order(), blooms=("service_id", "resource_id"))


def embedded_snapshot(snapshot: DataFrame, settings: Settings) -> DataFrame:
    options = {"dimension": settings.dimension, "batch_size": settings.batch_size, "tasks": settings.tasks}
    if settings.memory is not None:
        embedded = embed_remembered(stored(snapshot, "snapshot"), "embedding_text", settings.factory(), settings.memory, **options)
    elif settings.once_per_text:
        # Read twice, for its texts and for its rows, so it is built once.
        embedded = embed_distinct(stored(snapshot, "snapshot"), "embedding_text", settings.factory(), **options)
    else:
        embedded = embed(snapshot, "embedding_text", settings.factory(), **options)
    return conform(embedded, stored_schema(settings))


def publish(table: PublishedTable, snapshot: DataFrame | Packed, settings: Settings, removed: DataFrame | None = None, **options) -> Commit:
    """Embed the snapshot's rows and publish them: the whole table, or with ``removed`` ids a change.

    Rows that are embedded where they lie keep their order, so they get their vectors when they are written. Otherwise they are embedded first.
    A packed snapshot is laid out by service first; its rows multiply as they are embedded and written.
    """
    parts = snapshot if isinstance(snapshot, Packed) else Packed(snapshot, lambda rows: rows)
    rows, finish = parts.rows, lambda laid_out: embedded_snapshot(parts.unpack(laid_out), settings)
    if settings.tasks is not None or settings.memory is not None or settings.once_per_text:
        rows, finish = embedded_snapshot(parts.whole(), settings), None
    elif "address_id" not in rows.columns:
        options["order"] = reading_order()[:2]
    options |= {"batch_size": settings.batch_size, "finish": finish}
    return table.publish_all(rows, **options) if removed is None else table.publish_changes(rows, removed, **options)


def run(catalog: SourceCatalog, table: PublishedTable, settings: Settings, *, now: str | None = None, full: bool = False) -> dict:
    """Full when nothing was published yet or ``full`` asks for it, else incremental since the stored watermark.

    The new watermark is the start of this run. A full run also takes in edits to other tables than services.
    """
    started = now or run_start()
    since = None if full else table.watermark()
    if since is None:
        return publish(table, packed_snapshot(catalog, **settings.snapshot_options), settings, watermark=started).report

    services = catalog["services"]
    removed = deleted_ids(services, since)
    # A changed service counts here only when its resource is active, as it yields no row otherwise.
    active = catalog["resources"].filter(F.col("status") == 1).select(F.col("id").alias("resource_id"))
    active = broadcast_if_small({"active": active})["active"]
    changed = changed_services(services, since).join(active, "resource_id", "left_semi")
    if changed.isEmpty() and removed.isEmpty():
        return table.record_skip().report
    return publish(table, packed_snapshot(catalog, since=since, **settings.snapshot_options), settings, removed, watermark=started).report
