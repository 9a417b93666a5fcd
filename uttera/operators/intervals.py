"""Segments: filter, midpoint, buffer, overlap; silence and activity of sampled signals; clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uttera.config import Params
from uttera.operators.scan import Ordered

P = Params()


def prepare_segments(segments: DataFrame, min_ms: int = P.min_activity_ms, buffer_ms: int = P.buffer_ms, clamp: bool = False) -> DataFrame:
    """Segments of at least ``min_ms`` with their midpoint (unbuffered) and buffered bounds. ``clamp`` keeps starts at 0 or more."""
    start = F.col("start_ms") - buffer_ms
    return segments.where(F.col("end_ms") - F.col("start_ms") >= min_ms).withColumns({
        "middle_ms": F.expr("(end_ms - start_ms) div 2 + start_ms"),
        "buffered_start": F.greatest(F.lit(0), start) if clamp else start,
        "buffered_end": F.col("end_ms") + buffer_ms,
    })


def count_short(segments: DataFrame, key: str, min_ms: int) -> DataFrame:
    return segments.groupBy(key).agg(F.count_if(F.col("end_ms") - F.col("start_ms") < min_ms).alias("dropped"), F.count(F.lit(1)).alias("total"))


def overlaps(segments: DataFrame, key: str, order: str, start: str = "buffered_start", end: str = "buffered_end", strict: bool = False) -> DataFrame:
    """Segments that reach beyond the start of the next one; touching is allowed. ``strict`` raises on the first."""
    found = segments.withColumn("next_start", F.lead(start).over(Window.partitionBy(key).orderBy(order))).where(F.col("next_start") < F.col(end))
    return found.withColumn("next_start", F.raise_error(F.lit("segments overlap")).cast("long")) if strict else found


def duration_gate(videos: DataFrame, tolerance: float = 0.30, frames_times_fps: bool = False) -> DataFrame:
    """Whether audio and video lengths agree. The default compares milliseconds; the option compares frames * fps, as is."""
    length = F.col("frames") * F.col("fps") if frames_times_fps else F.col("frames") * 1000 / F.col("fps")
    return videos.withColumn("deviation", F.abs(length - F.col("audio_ms")) / length).withColumn("passes", F.col("deviation") <= tolerance)


def silence_ranges(samples: DataFrame, key: str, k: int, db: float) -> DataFrame:
    """(key, silence_idx, start, end) of maximal silence: windows of ``k`` samples not louder than the whole less ``db``.

    samples: (key, idx from 0 without gaps, value). One pass of windows per key.
    """
    w = Window.partitionBy(key).orderBy("idx")
    every = Window.partitionBy(key)
    level = samples.withColumn("n", F.count(F.lit(1)).over(every)).withColumn("limit", F.sqrt(F.avg(F.col("value") * F.col("value")).over(every)) * 10 ** (-db / 20))
    quiet = level.withColumn("rms", F.sqrt(F.avg(F.col("value") * F.col("value")).over(w.rowsBetween(0, k - 1)))).where((F.col("idx") <= F.col("n") - k) & (F.col("rms") <= F.col("limit")))
    new = quiet.withColumn("new", F.coalesce((F.col("idx") > F.lag("idx").over(w) + k).cast("long"), F.lit(1)))
    return new.withColumn("silence_idx", F.sum("new").over(w) - 1).groupBy(key, "silence_idx").agg(F.min("idx").alias("start"), (F.max("idx") + k).alias("end"))


def silence_ranges_in_blocks(samples: DataFrame, key: str, k: int, db: float, size: int = 1 << 16) -> DataFrame:
    """``silence_ranges`` without a task for a whole signal.

    The level comes from sums by key. Samples go to blocks of ``size``, and to the blocks before them whose last windows reach them (a halo of
    ``k`` - 1 samples); each block finds its own stretches of quiet windows. Stretches, not samples, are then put in order (see ``scan``) and
    joined where one begins within ``k`` of the end of the one before.
    """
    level = samples.groupBy(key).agg(F.count(F.lit(1)).alias("n"), (F.sqrt(F.avg(F.col("value") * F.col("value"))) * 10 ** (-db / 20)).alias("limit"))
    first, own = F.floor(F.greatest(F.col("idx") - (k - 1), F.lit(0)) / size), F.floor(F.col("idx") / size)
    dealt = samples.select(key, "idx", "value", F.explode(F.sequence(first, own)).alias("block"))
    w = Window.partitionBy(key, "block").orderBy("idx")
    rms = dealt.withColumn("rms", F.sqrt(F.avg(F.col("value") * F.col("value")).over(w.rowsBetween(0, k - 1)))).where(own == F.col("block"))
    quiet = rms.join(level, key).where((F.col("idx") <= F.col("n") - k) & (F.col("rms") <= F.col("limit")))
    new = F.coalesce((F.col("idx") > F.lag("idx").over(w) + k).cast("long"), F.lit(1))
    parts = quiet.withColumn("new", new).withColumn("part", F.sum("new").over(w)).groupBy(key, "block", "part").agg(F.min("idx").alias("first"), F.max("idx").alias("last"))
    stitched = Ordered(parts.select(key, "first", "last"), [key], ["first"]).scan(before={"before": F.col("last")})
    begins = stitched.withColumn("new", F.coalesce((F.col("first") > F.col("before") + k).cast("long"), F.lit(1)))
    numbered = Ordered(begins.select(key, "first", "last", "new"), [key], ["first"]).scan(sums={"number": F.col("new")})
    return numbered.groupBy(key, (F.col("number") - 1).alias("silence_idx")).agg(F.min("first").alias("start"), (F.max("last") + k).alias("end"))


def activity_segments(samples: DataFrame, key: str, k: int, db: float) -> DataFrame:
    """The complement of silence: (key, seg_idx, start, end). All silent gives none, nothing silent the whole."""
    silent = silence_ranges(samples, key, k, db)
    whole = samples.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key).orderBy("end")
    gaps = silent.select(key, "start", "end").unionByName(whole.select(key, F.col("n").alias("start"), F.col("n").alias("end")))  # a bound behind the last
    before = F.coalesce(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = gaps.select(key, before.alias("from"), F.col("start").alias("to")).where("from < to")
    return found.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("from")) - 1).alias("seg_idx"), F.col("from").alias("start"), F.col("to").alias("end"))


def signal_level(samples: DataFrame, key: str, value: str = "value") -> DataFrame:
    """(key, n, rms, db): root mean square of each signal and its level; null for a silent one's db."""
    rms = F.sqrt(F.avg(F.col(value) * F.col(value)))
    return samples.groupBy(key).agg(F.count(F.lit(1)).alias("n"), rms.alias("rms")).withColumn("db", F.when(F.col("rms") > 0, 20 * F.log10("rms")))


def first_silence(samples: DataFrame, key: str, k: int, db: float) -> DataFrame:
    """(key, start, end) of the first silence of each signal, null where there is none."""
    first = silence_ranges(samples, key, k, db).groupBy(key).agg(F.min_by("start", "start").alias("start"), F.min_by("end", "start").alias("end"))
    return samples.select(key).distinct().join(first, key, "left")


def clip_samples(samples: DataFrame, clips: DataFrame, key: str, step: int = 1024) -> DataFrame:
    """Samples of each clip [start, end): both sides meet in stretches of ``step`` indices, so a sample meets only the clips near it."""
    near = clips.where("start < end").withColumn("__at", F.explode(F.sequence(F.floor(F.col("start") / step), F.floor((F.col("end") - 1) / step))))
    both = samples.withColumn("__at", F.floor(F.col("idx") / step)).join(near, [key, "__at"])
    return both.where((F.col("idx") >= F.col("start")) & (F.col("idx") < F.col("end"))).drop("__at")
