"""Small file-system helpers over Hadoop paths.

Commits rely on creating a file only where none is. HDFS and local folders do that themselves; an object store must
refuse conditional writes of a taken name (most do since 2024), as its connector's create without overwrite then fails.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """A fresh folder for intermediate tables, inside the shared folder the cluster names.

    A machine-local folder is used only where the session runs on this machine alone.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/snapwright-{uuid.uuid4().hex}"
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return tempfile.mkdtemp(prefix="snapwright-")
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the scratch folder and read back, so that later uses neither repeat nor re-plan it."""
    path = f"{scratch_root(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_together(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Several frames stored side by side, their jobs sharing the cluster."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        return dict(zip(frames, pool.map(stored, frames.values(), frames), strict=True))


def bloom_options(columns: Sequence[str], distinct: int = 1_000_000) -> dict[str, str]:
    """Writer options for Bloom filters of some columns, sized for ``distinct`` values a row group."""
    options = {}
    for column in columns:
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{column}"] = str(distinct)
    return options


def open_folder(uri: str) -> tuple[FileSystem, str]:
    """Arrow file system and path of a folder, for reading it inside tasks."""
    return FileSystem.from_uri(uri) if ":" in uri else (LocalFileSystem(), uri)


class Folder:
    """Metadata operations on one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        if not self._fs.exists(self._path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path))

    def read_json(self, name: str) -> dict:
        stream = self._fs.open(self._jvm.org.apache.hadoop.fs.Path(self._path, name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def create_json(self, name: str, value: dict) -> None:
        """Write a new file; fails when the name is taken.

        Where a rename refuses to replace (HDFS), a draft is moved into place, so the file appears whole. Elsewhere the
        name itself is created with overwrite off, in one write.
        """
        body = bytearray(json.dumps(value).encode("utf-8"))
        path_class = self._jvm.org.apache.hadoop.fs.Path
        target = path_class(self._path, name)
        if self._fs.getScheme() != "hdfs":
            self._fill(target, body)
            return
        draft = path_class(self._path, f".{name}.{uuid.uuid4().hex}")
        self._fill(draft, body)
        if not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise FileExistsError(f"{target} was written by someone else")

    def _fill(self, path, body: bytearray) -> None:
        try:
            stream = self._fs.create(path, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                raise FileExistsError(f"{path} was written by someone else") from error
            raise
        try:
            stream.write(body)
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        """Delete one entry with all that is in it."""
        self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(self._path, name), True)
