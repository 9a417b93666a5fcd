"""Wav files as a data source: blocks of samples, read by byte ranges.

``register(spark)`` makes ``spark.read.format("wav_blocks").load(folder)`` known. A partition is a byte range of one file and owns the blocks that begin
inside it, so a recording of any length is read by many tasks and none holds more than a block.

Options: block (samples of a block), range_bytes (bytes of a partition), rate (the expected one), only_paths (a JSON list: no other file is opened), from_ms and to_ms
(blocks that begin in [from_ms, to_ms) alone are read), on_error: ``fail`` (default) raises on another rate or a file that isn't 16-bit PCM, ``report`` gives
such a file one row with its error and no samples. Paths and times are options and not pushed filters, as Spark 4.1 keeps what one query pushed for all later queries of
the same DataFrame.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from uttera.config import Params
from uttera.storage import list_files, open_input

P = Params()
SCHEMA = "path string, block bigint, start_ms bigint, channels int, pcm binary, error string"
_ARROW = pa.schema([("path", pa.string()), ("block", pa.int64()), ("start_ms", pa.int64()), ("channels", pa.int32()), ("pcm", pa.binary()), ("error", pa.string())])


class NotReadable(ValueError):
    """A file that isn't 16-bit PCM of the expected rate."""


def header(file) -> tuple[int, int, int, int]:
    """(rate, channels, place of the first sample, bytes of samples) of an open wav file."""
    if len(head := file.read(12)) < 12 or head[:4] != b"RIFF" or head[8:] != b"WAVE":
        raise NotReadable("not a wav file")
    rate = channels = 0
    at = 12
    while len(chunk := file.read(8)) == 8:
        name, size = chunk[:4], struct.unpack("<I", chunk[4:])[0]
        at += 8
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", file.read(16))
            if kind != 1 or bits != 16:
                raise NotReadable(f"format {kind} of {bits} bits, not 16-bit PCM")
        if name == b"data":
            if not rate:
                raise NotReadable("no format before the samples")
            return rate, channels, at, size
        at += size + size % 2
        file.seek(at)
    raise NotReadable("no samples")


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int

    def __init__(self, path: str, start: int, end: int):
        super().__init__((path, start, end))
        self.path, self.start, self.end = path, start, end


class WavReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.block, self.bytes = int(options.get("block", P.sample_rate)), int(options.get("range_bytes", 64 << 20))
        self.rate, self.report = int(options.get("rate", P.sample_rate)), options.get("on_error", "fail") == "report"
        self.paths = set(json.loads(options["only_paths"])) if "only_paths" in options else None
        self.since, self.until = int(options.get("from_ms", 0)), int(options["to_ms"]) if "to_ms" in options else None

    def partitions(self) -> list[Range]:
        files = [(p, n) for p, n in list_files(self.folder, ".wav") if self.paths is None or p in self.paths]
        return [Range(p, a, min(a + self.bytes, n)) for p, n in files for a in range(0, max(n, 1), self.bytes)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        with open_input(part.path) as file:
            try:
                rate, channels, first, size = header(file)
                if rate != self.rate:
                    raise NotReadable(f"{rate} Hz, not {self.rate}")
            except NotReadable as e:
                if not self.report:
                    raise NotReadable(f"{part.path}: {e}") from e
                if part.start == 0:
                    yield pa.RecordBatch.from_pylist([{"path": part.path, "error": str(e)}], _ARROW)
                return
            width = 2 * channels * self.block
            for k in range(max(0, -(-(part.start - first) // width)), max(0, -(-(part.end - first) // width))):  # blocks that begin in the range
                at, n = k * self.block * 1000 // rate, min(width, size - k * width)
                if n <= 0:
                    return
                if at < self.since:
                    continue
                if self.until is not None and at >= self.until:
                    return
                file.seek(first + k * width)
                if pcm := file.read(n):
                    yield pa.RecordBatch.from_pylist([{"path": part.path, "block": k, "start_ms": at, "channels": channels, "pcm": pcm}], _ARROW)


class WavSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wav_blocks"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WavReader:
        if not os.path.basename(self.options.get("path", "")):
            raise ValueError("wav_blocks needs a folder to load")
        return WavReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WavSource)


def read_blocks(spark: SparkSession, folder: str, paths: Sequence[str] | None = None, **options) -> DataFrame:
    """(path, block, start_ms, channels, pcm, error) of the wav files at any depth of a folder, or of ``paths`` among them."""
    register(spark)
    if paths is not None:
        options["only_paths"] = json.dumps(list(paths))
    return spark.read.format("wav_blocks").options(**options).load(folder)
