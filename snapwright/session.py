"""Session helpers: sensible settings and this package on the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_ARCHIVE = "snapwright.zip"


def build_session(app: str = "snapwright", **config: str) -> SparkSession:
    """A session with the settings the jobs are written for; ``config`` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **config,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers; a second call does nothing."""
    context = spark.sparkContext
    if any(os.path.basename(path) == _ARCHIVE for path in context._python_includes):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="snapwright-"), _ARCHIVE)
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
