"""Sources and sinks over files: listings, transcripts, grids, audio, seams for media, and text outputs."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.config import CATEGORIES, Params
from uttera.functions.text import first_category, last_part, normal_path
from uttera.operators.scan import Ordered
from uttera.sources.named import write_files
from uttera.sources.wav import read_blocks

P = Params()


def list_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(path, length) of the files with a suffix at any depth; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").load(folder).select(normal_path(F.col("path")).alias("path"), "length")


def list_videos(spark: SparkSession, folder: str, keys: Sequence[str] = CATEGORIES, suffix: str = P.video_suffix, first_id: int = P.first_video_id) -> DataFrame:
    """(video_id, path, category), numbered by path over as many parts as the listing has."""
    rows = Ordered(list_files(spark, folder, suffix).select("path"), [], ["path"]).scan(place="place")
    return rows.select((F.col("place") - 1 + first_id).alias("video_id"), "path", first_category(last_part(F.col("path")), keys).alias("category"))


def uncategorised(videos: DataFrame) -> DataFrame:
    return videos.where(F.col("category").isNull())


def read_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, value): every line of the transcripts at any depth."""
    read = spark.read.option("pathGlobFilter", "*.trans.txt").option("recursiveFileLookup", "true")
    return read.text(folder).select(F.col("_metadata.file_path").alias("path"), "value")


def read_textgrids(spark: SparkSession, folder: str) -> DataFrame:
    """(path, clip_name, content)."""
    read = spark.read.option("pathGlobFilter", "*.TextGrid").option("recursiveFileLookup", "true").option("wholetext", "true")
    return read.text(folder).select(F.col("_metadata.file_path").alias("path"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)\.TextGrid$", 1).alias("clip_name"), F.col("value").alias("content"))


def read_audio(spark: SparkSession, folder: str, rate: int = P.sample_rate, frame_ms: int = 1, **options) -> DataFrame:
    """(path, idx, value): root mean square of each ``frame_ms`` of 16-bit audio, channels averaged. Another rate is an error.

    Read as blocks of whole frames by byte range (see ``wav``), so no row or task holds a recording; a last part of a frame is left out.
    """
    step = rate * frame_ms // 1000
    size = step * max(1, 1000 // frame_ms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block, channels, pcm in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                x = np.frombuffer(pcm, "<i2").astype(np.float64).reshape(-1, channels).mean(1)
                x = x[: len(x) - len(x) % step].reshape(-1, step)
                at = block * (size // step) + np.arange(len(x))
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(x), pa.string()), pa.array(at, pa.int64()), pa.array(np.sqrt((x * x).mean(1)), pa.float64())], ["path", "idx", "value"])

    blocks = read_blocks(spark, folder, block=size, rate=rate, **options).where("error is null")
    return blocks.select("path", "block", "channels", "pcm").mapInArrow(run, "path string, idx bigint, value double")


def cut_audio(content: bytes, start_ms: int, end_ms: int) -> bytes:
    """A wav of [start, end) of a wav; a negative start counts as 0."""
    out = io.BytesIO()
    with wave.open(io.BytesIO(content)) as w, wave.open(out, "wb") as o:
        rate = w.getframerate()
        a, b = max(0, start_ms) * rate // 1000, max(0, end_ms) * rate // 1000
        w.setpos(min(a, w.getnframes()))
        o.setparams(w.getparams())
        o.writeframes(w.readframes(max(0, b - a)))
    return out.getvalue()


def extract_audio(videos: DataFrame, extract: Callable[[str], bytes], done: DataFrame | None = None) -> DataFrame:
    """(video_id, content) through an external extractor; videos already in ``done`` are left out."""
    todo = videos if done is None else videos.join(done.select("video_id"), "video_id", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for v, p in zip(pdf["video_id"], pdf["path"], strict=True):
                yield pd.DataFrame({"video_id": [v], "content": [extract(p)]})

    return todo.select(F.col("video_id").cast("long"), "path").mapInPandas(run, "video_id bigint, content binary")


def decode_frames(videos: DataFrame, decode: Callable[[str], Iterator[tuple[int, float, int, int, bytes]]]) -> DataFrame:
    """(video_id, frame_idx, ts_ms, width, height, image) through an external decoder, one frame at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for v, p in zip(pdf["video_id"], pdf["path"], strict=True):
                for frame in decode(p):
                    yield pd.DataFrame([(v, *frame)], columns=["video_id", "frame_idx", "ts_ms", "width", "height", "image"])

    return videos.select(F.col("video_id").cast("long"), "path").mapInPandas(run, "video_id bigint, frame_idx bigint, ts_ms double, width int, height int, image binary")


def saved_or(spark: SparkSession, folder: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table saved in a folder; made and saved first if there is none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")):
        make().write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def _text_file(rows: DataFrame, keys: Sequence[str], order: str, line: Column, name: Column) -> DataFrame:
    """(name, content): the lines of each key in order, each ended."""
    held = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line")))).alias("lines"))
    return held.select(name.alias("name"), F.array_join(F.transform("lines", lambda x: F.concat(x["line"], F.lit("\n"))), "").alias("content"))


def _directory(speaker: Column, video: Column, suffix: str) -> Column:
    """SPEAKER/VID/SPEAKER-VID with a suffix."""
    return F.concat_ws("/", speaker, video.cast("string"), F.concat(speaker, F.lit("-"), video.cast("string"), F.lit(suffix)))


def write_transcripts(utts: DataFrame, folder: str, overwrite: bool = False) -> None:
    """Lines ``clip text`` in order, one file a speaker and video: SPEAKER/VID/SPEAKER-VID.trans.txt. All files appear, or none."""
    name = _directory(F.col("speaker"), F.col("video_id"), ".trans.txt")
    write_files(_text_file(utts, ["speaker", "video_id"], "utt_idx", F.concat_ws(" ", "clip_name", "text"), name), folder, overwrite)


def write_clip_texts(entries: DataFrame, folder: str, overwrite: bool = False) -> None:
    """A text a clip, without a folder of its own: CLIP.txt, below the columns speaker and video_id if there are such. All files appear, or none."""
    above = [F.col(c).cast("string") for c in ("speaker", "video_id") if c in entries.columns]
    name = F.concat_ws("/", *above, F.concat("clip_name", F.lit(".txt")))
    write_files(entries.select(name.alias("name"), F.coalesce("text", F.lit("")).alias("content")), folder, overwrite)


def write_clips(clips: DataFrame, folder: str, overwrite: bool = False) -> None:
    """Clips (clip_name, wav), and perhaps speaker and video_id, as CLIP.wav in the same places."""
    above = [F.col(c).cast("string") for c in ("speaker", "video_id") if c in clips.columns]
    write_files(clips.select(F.concat_ws("/", *above, F.concat("clip_name", F.lit(".wav"))).alias("name"), F.col("wav").alias("content")), folder, overwrite)


def write_alignments(lines: DataFrame, folder: str, overwrite: bool = False) -> None:
    """Alignment lines in order, one file a speaker and video: SPEAKER/VID/SPEAKER-VID.alignment.txt. All files appear, or none."""
    name = _directory(F.col("speaker"), F.col("video_id"), ".alignment.txt")
    write_files(_text_file(lines, ["speaker", "video_id"], "line", F.col("line"), name), folder, overwrite)


#: Counters in the order in which they are reported.
COUNTERS = ("potential", "successful", "total_dropped", "cleaner", "no_speaker", "no_transcript", "discrepancies", "blacklisted", "verification_failed")


def video_report(videos: DataFrame, stats: DataFrame, blocked: DataFrame) -> DataFrame:
    """(video_id, content): a readable report of each video. videos: (video_id, category, path, frames, fps)."""
    from uttera.functions.text import transliterate

    names = blocked.groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("first_seen", "speaker"))), lambda x: F.concat(F.lit("  "), x["speaker"])).alias("names"))
    line = lambda n: F.format_string(f"  {n}: %d", F.col(n))
    head: Column = transliterate(F.format_string('Video id: %d - %s from: "%s"', F.col("video_id"), F.coalesce("category", F.lit("none")), F.col("path")))
    body = F.concat_ws("\n", head, F.lit(""), F.lit("Video metadata:"), F.format_string("  Frames: %d", F.col("frames")), F.format_string("  FPS: %.4f", F.col("fps")), F.lit(""), F.lit("Statistics:"), *[line(n) for n in COUNTERS], F.lit(""), F.lit("Blocked speakers:"), F.array_join(F.coalesce("names", F.array().cast("array<string>")), "\n"))
    return videos.join(stats, "video_id").join(names, "video_id", "left").select("video_id", body.alias("content"))
