"""Greedy forward as-of match of segments to frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def greedy_asof(frames: DataFrame, middles: DataFrame, key: str) -> DataFrame:
    """(key, seg_idx, frame_idx): each segment takes the first frame at or after its midpoint, one segment a frame, in order.

    frames: (key, frame_idx from 0, ts); middles: (key, seg_idx from 0, middle). With g(j) the first fitting frame,
    the match is j + max over i <= j of g(i) - i; segments beyond the last frame are lost. Two window passes over the union
    of both sides replace the join, so the work is a sort however the two interleave.
    """
    both = frames.select(key, F.col("ts").cast("double").alias("at"), F.lit(1).alias("side"), F.col("frame_idx").cast("long").alias("frame_idx"), F.lit(None).cast("long").alias("seg_idx")).unionByName(
        middles.select(key, F.col("middle").cast("double").alias("at"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("frame_idx"), F.col("seg_idx").cast("long").alias("seg_idx"))
    )
    back = [F.col(c).desc() for c in ("at", "side", "seg_idx", "frame_idx")]  # backwards: a frame that reaches to the end is read anew for every row
    ahead = Window.partitionBy(key).orderBy(*back).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seg = both.withColumn("g", F.last("frame_idx", ignorenulls=True).over(ahead)).where("side = 0")
    so_far = Window.partitionBy(key).orderBy("seg_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = frames.groupBy(key).agg(F.count(F.lit(1)).alias("frames"))
    lost = F.max(F.col("g").isNull().cast("int")).over(so_far)
    found = seg.withColumn("frame", F.col("seg_idx") + F.max(F.col("g") - F.col("seg_idx")).over(so_far)).withColumn("lost", lost)
    return found.join(total, key).where("lost = 0 and frame < frames").select(key, "seg_idx", F.col("frame").alias("frame_idx"))
