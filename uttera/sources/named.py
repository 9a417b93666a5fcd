"""Rows as files of given names, all of them or none.

``write_files(rows, folder)`` writes each row (name, content) to ``folder/name``, through a data source writer: tasks put their files into a staging folder
of the write, a part of its own for each attempt, and say in their commit message which they made. When every task has succeeded the
driver moves the files of those attempts to their names and drops the staging folder, with what failed or repeated attempts left in it. After an
abort only the staging folder is dropped, so nothing is left.

A name is a relative path. Names given twice, or files that exist unless ``overwrite``, fail the write before the first move.
"""

from __future__ import annotations

import time
import uuid
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from uttera.storage import file_system

MOVERS = 16
RETRIES = 20


@dataclass
class Made(WriterCommitMessage):
    """The part of the staging folder that an attempt wrote to, and the names it made there."""

    part: str
    names: list[str]


def safe(name: str | None) -> str:
    if not name or name.startswith("/") or any(p in ("", ".", "..") for p in name.split("/")):
        raise ValueError(f"not a name below a folder: {name!r}")
    return name


class NamedWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite = folder, overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def prepare(self) -> NamedWriter:
        """Makes the staging folder. Only the driver does: an attempt that outlives an abort finds no folder and can't make one."""
        system, folder = file_system(self.folder)
        system.create_dir(f"{folder}/{self.staging}", recursive=True)
        return self

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Made:
        system, folder = file_system(self.folder)
        part, names, made = uuid.uuid4().hex, set(), {""}
        system.create_dir(f"{folder}/{self.staging}/{part}", recursive=False)
        for batch in iterator:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                at = f"{folder}/{self.staging}/{part}/{safe(name)}"
                if name in names or content.as_py() is None:
                    raise ValueError(f"{'twice' if content.is_valid else 'null content'}: {name}")
                steps = name.split("/")[:-1]
                for k in range(len(steps)):
                    if (above := "/".join(steps[: k + 1])) not in made:
                        system.create_dir(f"{folder}/{self.staging}/{part}/{above}", recursive=False)
                        made.add(above)
                with system.open_output_stream(at) as out:
                    out.write(content.as_buffer())
                names.add(name)
        return Made(part, sorted(names))

    def commit(self, messages: list[Made | None]) -> None:
        from pyarrow import fs

        system, folder = file_system(self.folder)
        files = [(m.part, n) for m in messages if m for n in m.names]
        try:
            twice = [n for n, k in Counter(n for _, n in files).items() if k > 1]
            there = [] if self.overwrite else [i.path for a in range(0, len(files), 1000) for i in system.get_file_info([f"{folder}/{n}" for _, n in files[a : a + 1000]]) if i.type != fs.FileType.NotFound]
            if twice or there:
                raise ValueError(f"names given twice: {twice[:5]}" if twice else f"files exist: {there[:5]}")
            for parent in sorted({f"{folder}/{n}".rsplit("/", 1)[0] for _, n in files}):
                system.create_dir(parent, recursive=True)
            with ThreadPoolExecutor(MOVERS) as pool:
                list(pool.map(lambda x: system.move(f"{folder}/{self.staging}/{x[0]}/{x[1]}", f"{folder}/{x[1]}"), files))
        finally:
            self.drop(system, folder)

    def abort(self, messages: list[Made | None]) -> None:
        self.drop(*file_system(self.folder))

    def drop(self, system, folder: str) -> None:
        from pyarrow import fs

        for _ in range(RETRIES):  # attempts that still run can put a file where one was just removed
            if system.get_file_info(f"{folder}/{self.staging}").type != fs.FileType.Directory:
                return
            try:
                system.delete_dir(f"{folder}/{self.staging}")
            except OSError:
                time.sleep(0.2)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options["path"].rstrip("/"), overwrite).prepare()


def write_files(rows: DataFrame, folder: str, overwrite: bool = False) -> None:
    """rows: (name, content), content text or bytes."""
    rows.sparkSession.dataSource.register(NamedFiles)
    rows.select("name", F.col("content").cast("binary").alias("content")).write.format("named_files").mode("overwrite" if overwrite else "append").save(folder)
