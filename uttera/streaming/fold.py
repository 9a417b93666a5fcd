"""The utterance fold over a stream, keyed by video, and activity sessions by event time.

Observations of a video must arrive in order of seg_idx across batches; within a batch they are sorted here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera.functions.text import ratio
from uttera.operators.utterance import DECIDED, Fold

STATE = "sp string, tx string, drop boolean"


def decide_stream(obs: DataFrame, similarity: Callable[[str, str], float] = ratio) -> DataFrame:
    """Decisions as ``decide_exact`` makes them, with the fold's three values as state of each video.

    obs: streaming (video_id, seg_idx, start_ms, end_ms, speaker, text, speaker_invalid, text_invalid, allowed).
    """
    columns = ["video_id", *[c.split()[0] for c in DECIDED.split(", ")]]

    def update(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        fold = Fold(tuple(state.get) if state.exists else (None, None, False), similarity)
        rows = pd.concat(list(batches)).sort_values("seg_idx")
        out = [(int(key[0]), r.seg_idx, r.start_ms, r.end_ms, r.speaker or "", r.text or "", *fold.step(r.speaker or "", r.text or "", bool(r.speaker_invalid), bool(r.text_invalid), bool(r.allowed))) for r in rows.itertuples(index=False)]
        state.update((fold.sp, fold.tx, fold.drop))
        yield pd.DataFrame(out, columns=columns)

    return obs.groupBy("video_id").applyInPandasWithState(update, f"video_id bigint, {DECIDED}", STATE, "append", "NoTimeout")


def activity_sessions(events: DataFrame, key: str, gap: str = "10 minutes", late: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Sessions separated by silence of at least ``gap``: the event-time form of activity segments. Batch or stream."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
