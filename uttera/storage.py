"""Tables written between steps of one plan, in the folder that all executors share.

``spark.checkpoint.dir`` names that folder. Only where it is unset and the executors share the driver's disk (local sessions, tests) a
temporary folder stands in for it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(shared_folder, "own"):
        shared_folder.own = "file://" + tempfile.mkdtemp(prefix="uttera-")
    return shared_folder.own


def written(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """The rows of a DataFrame as a table in the shared folder: its lineage is a plain scan, and what it read is not read again.

    ``by``: the last column, which few values make up; a filter on it then reads only the files that it asks for.
    """
    at = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def file_system(uri: str):
    """The file system of a place, and its path there."""
    from pyarrow import fs

    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


def open_input(uri: str):
    """A seekable file."""
    system, path = file_system(uri)
    return system.open_input_file(path)


def list_files(folder: str, suffix: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files with a suffix at any depth, by path."""
    from pyarrow import fs

    system, at = file_system(folder)
    scheme = folder.split("://", 1)[0] + "://" if "://" in folder else ""
    found = system.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted((scheme + f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffix))
