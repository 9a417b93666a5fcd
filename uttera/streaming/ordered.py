"""The utterance fold over a stream whose rows arrive in any order within a bounded delay.

Videos are dealt to buckets by hash, so that what a key costs a batch is not paid for each of many short videos. Rows wait in list state, keyed by
bucket, until the watermark has passed their time: no earlier row of a video can come then. An event-time timer at the earliest waiting row wakes the
bucket up, what is due is folded in order of video and seg_idx, and the next timer is set. So each row is decided once, after all rows of its video before
it, and a bucket holds the rows of one delay at most, besides the fold's three values of each video in map state, of which only videos with due
rows are read. Rows later than the delay are dropped by Spark before they arrive; ``late_rows`` counts them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from uttera.functions.text import ratio
from uttera.operators.utterance import DECIDED, Fold

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
END = "2200-01-01 00:00:00"
BUCKETS = 1024
SENT = 2000  # rows that go to the state in one message, and out in one frame unless a video has more
_WAITING = "video_id bigint, seg_idx bigint, at bigint, start_ms bigint, end_ms bigint, speaker string, text string, speaker_invalid boolean, text_invalid boolean, allowed boolean"
_NAMES = [c.split()[0] for c in _WAITING.split(", ")]
_OUT = ["video_id", *[c.split()[0] for c in DECIDED.split(", ")]]


class OrderedFold(StatefulProcessor):
    """Reorders the rows of a bucket's videos by event-time timers and folds them."""

    def __init__(self, similarity: Callable[[str, str], float] = ratio):
        self.similarity = similarity

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.folds = handle.getMapState("folds", "video_id bigint", "sp string, tx string, drop boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for pdf in rows:
            at = pdf["ts"].astype("datetime64[ms]").astype("int64")
            pdf = pdf.assign(at=at, speaker=pdf["speaker"].fillna(""), text=pdf["text"].fillna(""))
            self.append([tuple(r) for r in zip(*[pdf[c].tolist() for c in _NAMES], strict=True)])
            if len(pdf):
                first = int(at.min()) if first is None else min(first, int(at.min()))
        if first is not None:
            timers = [t[0] if isinstance(t, tuple) else t for t in self.handle.listTimers()]
            if not timers or first < min(timers):
                for t in timers:
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(first)
        yield pd.DataFrame([], columns=_OUT, dtype=object)

    def append(self, rows: list[tuple]) -> None:
        for k in range(0, len(rows), SENT):
            self.waiting.appendList(rows[k : k + SENT])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        watermark = timerValues.getCurrentWatermarkInMs()
        due, rest = [], []
        for r in self.waiting.get():
            (due if r[2] <= watermark else rest).append(tuple(r))
        due.sort()
        out: list[tuple] = []
        for video, rows in groupby(due, lambda r: r[0]):
            fold = Fold(tuple(self.folds.getValue((video,)) or (None, None, False)), self.similarity)
            out += [(video, r[1], *r[3:7], *fold.step(*r[5:10])) for r in rows]
            self.folds.updateValue((video,), (fold.sp, fold.tx, fold.drop))
            if len(out) >= SENT:
                yield pd.DataFrame(out, columns=_OUT, dtype=object)  # text columns of pandas' own kind can't be sent
                out = []
        yield pd.DataFrame(out, columns=_OUT, dtype=object)
        self.waiting.clear()
        if rest:
            self.append(rest)
            self.handle.registerTimer(min(r[2] for r in rest))

    def close(self) -> None:
        pass


def decide_ordered(obs: DataFrame, delay: str, similarity: Callable[[str, str], float] = ratio, buckets: int = BUCKETS) -> DataFrame:
    """Decisions as ``decide_exact`` makes them, of a stream (video_id, seg_idx, ts, start_ms, end_ms, speaker, text, speaker_invalid, text_invalid, allowed).

    ts grows with seg_idx within a video and lies behind 1970, where watermarks start. Rows may arrive up to ``delay`` behind the latest. Needs the state store of ``ROCKS``.
    """
    rows = obs.select("ts", *[c for c in _NAMES if c != "at"]).withWatermark("ts", delay).withColumn("bucket", F.pmod(F.xxhash64("video_id"), F.lit(buckets)))
    return rows.groupBy("bucket").transformWithStateInPandas(OrderedFold(similarity), f"video_id bigint, {DECIDED}", "Append", "EventTime")


def replayed(rows: DataFrame, step: str, folder: str, slices: int, files: int) -> DataFrame:
    """A stream that reads the rows back slice by slice, ``step`` being the number of a row's slice; files: how many a slice is written as.

    Behind them comes a row far in the future under video -1: it moves the watermark past all others, so that nothing waits in the end.
    """
    for k in range(slices):
        rows.where(F.col(step) == k).drop(step).coalesce(files).write.mode("append").parquet(folder)
    last = rows.drop(step).limit(0)
    end = rows.sparkSession.createDataFrame([(-1, 0, END, 0, 0, "", "", False, False, False)], f"video_id bigint, seg_idx bigint, ts string, {', '.join(c for c in _WAITING.split(', ')[3:])}")
    last.unionByName(end.withColumn("ts", F.col("ts").cast("timestamp"))).coalesce(1).write.mode("append").parquet(folder)
    return rows.sparkSession.readStream.schema(last.schema).option("maxFilesPerTrigger", files).parquet(folder)


def run_to_end(stream: DataFrame, folder: str) -> DataFrame:
    """What a stream that ends makes, as a table below ``folder``."""
    spark = stream.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, ROCKS)
    try:
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(name, old)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came later than the delay, over the batches that a query remembers."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])
