"""Transcripts and word alignments: parsing, completeness, repair, formatting, dropped clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttera.functions.text import python_float

INTERVALS = "array<struct<xmin:double,xmax:double,text:string>>"


def transcript_entries(lines: DataFrame, value: str = "value") -> DataFrame:
    """Adds clip_name and text: a line cut at its first space; empty lines go."""
    parts = F.split(value, " ", 2)
    return lines.where(F.col(value) != "").withColumn("clip_name", parts[0]).withColumn("text", F.get(parts, F.lit(1)))


def incomplete_directories(entries: DataFrame, clips: DataFrame, key: list[str]) -> DataFrame:
    """Directories whose transcript does not have one line a clip: must be empty."""
    a = entries.groupBy(*key).agg(F.count(F.lit(1)).alias("lines"))
    b = clips.groupBy(*key).agg(F.count(F.lit(1)).alias("clips"))
    return a.join(b, key, "full").where(~F.col("lines").eqNullSafe(F.col("clips")))


def clip_texts(entries: DataFrame, clips: DataFrame, on: list[str]) -> DataFrame:
    return clips.join(entries, on)


def flat_destination(path: Column) -> Column:
    """One level up, for clips and their own texts but not transcripts; null for files that stay."""
    moves = path.endswith(".wav") | (path.endswith(".txt") & ~path.endswith(".trans.txt"))
    return F.when(moves, F.regexp_replace(path, "/[^/]+/([^/]+)$", "/$1"))


def textgrid_intervals(content: Column) -> Column:
    """Intervals of the first tier. The part behind the interval count is cut off first: headers have bounds of their own."""
    tier = F.split_part(F.split_part(content, F.lit("item [1]:"), F.lit(2)), F.lit("item [2]:"), F.lit(1))
    body = F.split_part(tier, F.lit("intervals: size = "), F.lit(2))
    get = lambda p: F.regexp_extract_all(body, F.lit(p), F.lit(1))
    zipped = F.arrays_zip(get(r"xmin = ([^\n]*)").alias("a"), get(r"xmax = ([^\n]*)").alias("b"), get(r'text = "(.*?)" ?\n').alias("t"))
    return F.transform(zipped, lambda x: F.struct(F.trim(x["a"]).cast("double").alias("xmin"), F.trim(x["b"]).cast("double").alias("xmax"), F.trim(x["t"]).alias("text")))


def ends_silent(iv: Column) -> Column:
    """At least one interval, the last without text."""
    return (F.size(iv) > 0) & (F.element_at(iv, -1)["text"] == "")


def with_leading_silence(iv: Column, silence_end_ms: Column) -> Column:
    """If the first interval has text, it is cut at the end of the clip's first silence (0 if none, or not before its own end)."""
    first = F.element_at(iv, 1)
    at = silence_end_ms / 1000
    z = F.when(at.isNull() | (at >= first["xmax"]), F.lit(0.0)).otherwise(at)
    cut = F.array(F.struct(F.lit(0.0).alias("xmin"), z.alias("xmax"), F.lit("").alias("text")), F.struct(z.alias("xmin"), first["xmax"].alias("xmax"), first["text"].alias("text")))
    return F.when(first["text"] != "", F.concat(cut, F.slice(iv, 2, F.size(iv) - 1))).otherwise(iv)


def alignment_line(clip: Column, iv: Column) -> Column:
    """``CLIP ",W1,W2," "t1,t2,t3"``. A whole 0 stands for a missing leading silence."""
    times = F.transform(iv, lambda x: F.when(x["xmax"] == 0, "0").otherwise(F.upper(python_float(x["xmax"]))))
    return F.concat(clip, F.lit(' "'), F.upper(F.array_join(F.transform(iv, lambda x: x["text"]), ",")), F.lit('" "'), F.array_join(times, ","), F.lit('"'))


def aligned(entries: DataFrame, grids: DataFrame, on: list[str]) -> DataFrame:
    return entries.join(grids.select(*on), on, "left_semi")


def dropped(entries: DataFrame, grids: DataFrame, on: list[str]) -> DataFrame:
    """Transcript entries that have no alignment."""
    return entries.join(grids.select(*on), on, "left_anti")


def dropped_report(drops: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """One text per key: the count, a blank line, and the indented names in order."""
    listed = drops.groupBy(*keys).agg(F.array_sort(F.collect_list(name)).alias("names"))
    return listed.select(*keys, F.size("names").alias("n"), F.concat(F.format_string("Dropped: %d\n\n", F.size("names")), F.array_join(F.transform("names", lambda x: F.concat(F.lit("  "), x)), "\n")).alias("content"))
