"""Audio as blocks of samples, and clips assembled from the blocks that they touch.

A recording is rows (key, block, pcm) of ``size`` samples each, the last one shorter; pcm holds 16-bit little-endian samples. No row ever has a whole
recording: a clip meets the few blocks it overlaps through an equality join on (key, block), takes its share of each, and is put
together by name, so what is held at once is a clip and not a recording.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 16_000


def little_endian(c: Column, n: int) -> Column:
    """The lowest ``n`` bytes of an integer, lowest first."""
    text = F.lpad(F.hex(c.cast("bigint")), 16, F.lit("0"))  # a negative number has 16 digits
    return F.unhex(F.concat(*[F.substring(text, 15 - 2 * k, 2) for k in range(n)]))


def signal_blocks(samples: DataFrame, key: str, size: int = BLOCK, value: str = "value") -> DataFrame:
    """(key, block, pcm) of samples (key, idx from 0 without gaps, integer value of 16 bits)."""
    at = samples.select(key, F.floor(F.col("idx") / size).alias("block"), "idx", little_endian(F.col(value), 2).alias("s"))
    held = at.groupBy(key, "block").agg(F.array_sort(F.collect_list(F.struct("idx", "s"))).alias("held"))  # ``size`` samples at most
    return held.select(key, "block", F.aggregate("held", F.unhex(F.lit("")), lambda a, x: F.concat(a, x["s"])).alias("pcm"))


def wav_header(n_bytes: Column, rate: int, channels: int = 1) -> Column:
    """The 44 bytes before 16-bit samples."""
    lit = lambda s: F.lit(s.encode())
    num = lambda x, n: little_endian(F.lit(x), n)
    return F.concat(
        lit("RIFF"), little_endian(n_bytes + 36, 4), lit("WAVE"), lit("fmt "), num(16, 4), num(1, 2), num(channels, 2), num(rate, 4), num(2 * rate * channels, 4), num(2 * channels, 2), num(16, 2), lit("data"), little_endian(n_bytes, 4)
    )


def clip_pieces(blocks: DataFrame, clips: DataFrame, key: str, rate: int, size: int = BLOCK, channels: int = 1) -> DataFrame:
    """(key, clip_name, block, pcm) of what each clip takes from each block it overlaps; clips: (key, clip_name, start_ms, end_ms).

    Negative bounds count as 0. Clips that overlap no block have no piece.
    """
    sample = lambda c: F.floor(F.greatest(F.lit(0), F.col(c)) * rate / 1000).cast("bigint")
    span = clips.select(key, "clip_name", sample("start_ms").alias("a"), sample("end_ms").alias("b")).where("a < b")
    near = span.withColumn("block", F.explode(F.sequence(F.floor(F.col("a") / size), F.floor((F.col("b") - 1) / size))))
    frame = 2 * channels
    met = near.join(blocks, [key, "block"])
    first = F.greatest(F.col("a") - F.col("block") * size, F.lit(0)) * frame
    last = F.least(F.col("b") - F.col("block") * size, F.lit(size)) * frame
    piece = F.substring(F.col("pcm"), (first + 1).cast("int"), (last - first).cast("int"))
    return met.select(key, "clip_name", "block", piece.alias("pcm"))


def export_clips(blocks: DataFrame, clips: DataFrame, key: str, rate: int, size: int = BLOCK, channels: int = 1) -> DataFrame:
    """(key, clip_name, n_samples, wav) of every clip; one beyond the recording is a wav without samples."""
    pieces = clip_pieces(blocks, clips, key, rate, size, channels).groupBy(key, "clip_name").agg(F.array_sort(F.collect_list(F.struct("block", "pcm"))).alias("p"))
    whole = pieces.select(key, "clip_name", F.aggregate("p", F.unhex(F.lit("")), lambda a, x: F.concat(a, x["pcm"])).alias("pcm"))
    every = clips.select(key, "clip_name").join(whole, [key, "clip_name"], "left").withColumn("pcm", F.coalesce("pcm", F.unhex(F.lit(""))))
    n = F.octet_length("pcm").cast("bigint")
    return every.select(key, "clip_name", F.expr(f"octet_length(pcm) div {2 * channels}").alias("n_samples"), F.concat(wav_header(n, rate, channels), F.col("pcm")).alias("wav"))
