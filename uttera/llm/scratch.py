"""Shared scratch space: tables written between phases, and their removal.

Everything is written below ``spark.checkpoint.dir``, the folder that all executors of a
cluster share; a folder of our own is chosen only where that setting is unset (local tests).
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only if that is unset and executors share the driver's disk."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(shared_dir, "own"):
        shared_dir.own = "file://" + tempfile.mkdtemp(prefix="uttera-")
    return shared_dir.own


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside are removed when they end: what they made has been written by then."""
    old = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if old is None else spark.conf.set(_CLEANUP, old)


def open_file(uri: str):
    """A seekable file of the shared store: a local path, or whatever pyarrow's file systems open."""
    if uri.startswith("file:"):
        return open("/" + uri[5:].lstrip("/"), "rb")  # noqa: SIM115
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


class Scratch:
    """Named tables of one operator run. ``save`` cuts lineage: what is read back is a plain file scan."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.names = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}", set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.names.add(name)
        with shuffles_removed(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def keep(self, *names: str) -> None:
        """Delete all saved tables but those that a returned plan reads."""
        self.drop(*sorted(self.names - set(names)))

    def drop(self, *names: str) -> None:
        """Delete tables that no returned plan reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            at = jvm.org.apache.hadoop.fs.Path(self.path(name))
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
            self.names.discard(name)
