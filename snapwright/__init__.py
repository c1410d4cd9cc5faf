"""Spark-native directory snapshots: denormalise, embed, publish, retrieve."""

from snapwright.plans.snapshot import SNAPSHOT_SCHEMA, build_snapshot
from snapwright.sources.catalog import SourceCatalog

__all__ = ["SNAPSHOT_SCHEMA", "SourceCatalog", "build_snapshot"]
