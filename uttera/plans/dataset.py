"""The whole way from segments and frames to verified, split transcripts, as one plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uttera.functions import text as T
from uttera.operators import asof, intervals, outliers, split, utterance
from uttera.storage import written


@dataclass(frozen=True)
class Dataset:
    """Results of ``build``: decisions, utterances left after verification, rejected ones, counters, split transcripts."""

    decided: DataFrame
    utterances: DataFrame
    rejected: DataFrame
    statistics: DataFrame
    transcripts: DataFrame


def observations(segments: DataFrame, frames: DataFrame, min_ms: int) -> DataFrame:
    """Each segment with the cleaned speaker and text of the frame that the as-of match gives it.

    segments: (video_id, seg_idx, start_ms, end_ms); frames: (video_id, frame_idx from 0, ts, raw_speaker, raw_text).
    """
    prepared = intervals.prepare_segments(segments, min_ms=min_ms)
    numbered = prepared.withColumn("place", (F.row_number().over(Window.partitionBy("video_id").orderBy("seg_idx")) - 1).cast("long"))
    match = asof.greedy_asof(frames.select("video_id", "frame_idx", "ts"), numbered.select("video_id", F.col("place").alias("seg_idx"), F.col("middle_ms").alias("middle")), "video_id")
    seen = numbered.join(match.select("video_id", F.col("seg_idx").alias("place"), "frame_idx"), ["video_id", "place"]).join(frames.drop("ts"), ["video_id", "frame_idx"])
    return seen.select(
        "video_id", "seg_idx", F.col("buffered_start").alias("start_ms"), F.col("buffered_end").alias("end_ms"), T.clean_text(F.col("raw_speaker")).alias("speaker"), T.clean_text(F.col("raw_text")).alias("text"),
        T.invalid(F.col("raw_speaker")).alias("speaker_invalid"), T.invalid(F.col("raw_text")).alias("text_invalid"),
    )


def build(segments: DataFrame, frames: DataFrame, allowed: DataFrame, fails: Callable[[DataFrame], Column], min_ms: int = 100, decide: Callable[[DataFrame], DataFrame] = utterance.decide_native) -> Dataset:
    """Segments, as-of match, cleaning, fold, verification of allowed speakers that have utterances, transcripts and split.

    allowed: (speaker). ``fails`` says which utterances verification takes out, as a condition over their columns; only
    utterances of allowed speakers are put to it. Each speaker's utterances of each video are a directory, which is split by itself.
    """
    seen = written(observations(segments, frames, min_ms), "observations")  # the fold's ranges are drawn by reading its input once more
    decided = decide(utterance.with_allowed(seen, allowed, []))
    every = utterance.utterances(decided)
    verified = every.join(allowed.select("speaker").distinct(), "speaker", "left_semi")
    rejected = verified.where(fails(verified)).select("video_id", "speaker", "utt_idx", "clip_name")
    kept = outliers.without_rejected(every, rejected, ["video_id", "speaker", "utt_idx"])
    parted = split.positional_split(kept, ["speaker", "video_id"], ["utt_idx"])
    texts = utterance.transcript_text(parted, ["split", "speaker", "video_id"], "utt_idx", F.concat_ws(" ", "clip_name", "text"))
    return Dataset(decided, kept, rejected, utterance.statistics(decided, rejected), texts)
