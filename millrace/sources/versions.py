"""Versions of several tables behind one pointer.

A version is a set of tables that belong together. A commit writes its tables into folders of its own, which no reader knows yet, and then publishes one small file, the
version's manifest, that says where each table lies; tables that a commit does not bring stay those of the version before. The file is made only if none of its number is
there, so of two writers that start from one version one fails (compare and set), and a writer that dies before the last step leaves nothing but unknown folders. Readers take the
manifest with the greatest number.
"""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class Conflict(Exception):
    """The folder has a newer version than the one that a commit started from."""


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all machines share. Where that is unset, a local master (tests) gets a temporary folder; a cluster is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="spark-millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(rows: DataFrame, name: str) -> DataFrame:
    """Write the rows as a table in the shared folder and read it back: they are fixed, their lineage is gone, and a lost executor costs a re-read."""
    path = shared_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Versions:
    """Versions below a folder (a URI that all machines reach)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def latest(self) -> int:
        """The number of the latest version; 0 where there is none."""
        log = self._path(f"{self.folder}/versions")
        if not self._fs.exists(log):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(log)]
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)

    def manifest(self, version: int) -> dict[str, str]:
        """Table names with their folders."""
        if not version:
            return {}
        stream = self._fs.open(self._path(self._file(version)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, version: int | None = None) -> dict[str, DataFrame]:
        found = self.manifest(self.latest() if version is None else version)
        return {name: self.spark.read.parquet(path) for name, path in found.items()}

    def commit(self, tables: dict[str, DataFrame], expected: int | None = None) -> int:
        """Write the tables and publish them as one version, the one after ``expected`` (the latest). Returns its number."""
        start = self.latest() if expected is None else expected
        if start != self.latest():
            raise Conflict(f"version {start} is not the latest, which is {self.latest()}")
        found, own = self.manifest(start), uuid.uuid4().hex
        for name, rows in tables.items():
            found[name] = f"{self.folder}/data/{own}/{name}"
            rows.write.parquet(found[name])
        self.publish(start + 1, found)
        return start + 1

    def publish(self, version: int, manifest: dict[str, str]) -> None:
        """Make the version's file; an error where it exists."""
        path = self._path(self._file(version))
        self._fs.mkdirs(path.getParent())
        try:
            stream = self._fs.create(path, False)
        except Exception as e:
            if self._fs.exists(path):
                raise Conflict(f"version {version} was published by another writer") from e
            raise
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        stream.close()

    def _file(self, version: int) -> str:
        return f"{self.folder}/versions/{version:012d}.json"
