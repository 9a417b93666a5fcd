import io
import os
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from uttera.operators import utterance
from uttera.sources import files
from uttera.sources.named import write_files
from uttera.streaming.fold import activity_sessions, decide_stream


def wav(values, rate=16000):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes(np.asarray(values, "<i2").tobytes())
    return out.getvalue()


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content)


def tree(folder):
    return {os.path.relpath(os.path.join(d, n), folder): open(os.path.join(d, n)).read() for d, _, names in os.walk(folder) for n in names}  # noqa: SIM115


def test_video_listing(spark, tmp_path):
    for n in ("b Zestiria.mp4", "a VESPERIA.mp4", "c.mp4", "d.txt"):
        put(f"{tmp_path}/{n}", b"x")
    got = files.list_videos(spark, str(tmp_path))
    assert [(r.video_id, r.category) for r in got.orderBy("video_id").collect()] == [(1, "vesperia"), (2, "zestiria"), (3, None)]
    assert files.uncategorised(got).count() == 1


def test_audio(spark, tmp_path):
    put(f"{tmp_path}/a.wav", wav([100] * 16 + [0] * 16 + [50] * 16))
    assert [round(r.value) for r in files.read_audio(spark, str(tmp_path)).orderBy("idx").collect()] == [100, 0, 50]
    put(f"{tmp_path}/bad/b.wav", wav([1] * 8, 8000))
    with pytest.raises(Exception, match="Hz"):
        files.read_audio(spark, f"{tmp_path}/bad").collect()
    with wave.open(io.BytesIO(files.cut_audio(wav([100] * 16 + [7] * 32), -5, 2))) as w:
        assert w.getnframes() == 32


def test_text_round_trip(spark, tmp_path):
    utts = spark.createDataFrame([(1, "A", 1, "A-1-0001", "Y Z"), (1, "A", 0, "A-1-0000", "X"), (2, "B", 0, "B-2-0000", "W")], "video_id long, speaker string, utt_idx int, clip_name string, text string")
    files.write_transcripts(utts, f"{tmp_path}/t")
    assert tree(f"{tmp_path}/t") == {"A/1/A-1.trans.txt": "A-1-0000 X\nA-1-0001 Y Z\n", "B/2/B-2.trans.txt": "B-2-0000 W\n"}
    assert sorted(r.value for r in files.read_transcripts(spark, f"{tmp_path}/t").collect()) == ["A-1-0000 X", "A-1-0001 Y Z", "B-2-0000 W"]
    put(f"{tmp_path}/full/A/1/A-1.trans.txt", b"A-1-0000 X\n\nA-1-0001 Y Z\n")
    put(f"{tmp_path}/g/A/A-1-0000.TextGrid", b"item [1]:")
    assert files.read_transcripts(spark, f"{tmp_path}/full").count() == 3
    assert files.read_textgrids(spark, f"{tmp_path}/g").first().clip_name == "A-1-0000"
    files.write_clip_texts(utts, f"{tmp_path}/clips")
    assert tree(f"{tmp_path}/clips") == {"A/1/A-1-0000.txt": "X", "A/1/A-1-0001.txt": "Y Z", "B/2/B-2-0000.txt": "W"}
    files.write_clip_texts(utts.select("clip_name", "text"), f"{tmp_path}/flat")
    assert set(tree(f"{tmp_path}/flat")) == {"A-1-0000.txt", "A-1-0001.txt", "B-2-0000.txt"}
    files.write_clips(utts.selectExpr("speaker", "clip_name", "binary(text) as wav"), f"{tmp_path}/clips")
    assert tree(f"{tmp_path}/clips")["B/B-2-0000.wav"] == "W"
    files.write_alignments(utts.selectExpr("speaker", "video_id", "clip_name as line"), f"{tmp_path}/al")
    assert tree(f"{tmp_path}/al") == {"A/1/A-1.alignment.txt": "A-1-0000\nA-1-0001\n", "B/2/B-2.alignment.txt": "B-2-0000\n"}


def test_all_files_or_none(spark, tmp_path):
    rows = spark.range(40, numPartitions=4).selectExpr("concat('d', id % 3, '/', id, '.txt') as name", "concat('text ', id) as content")
    write_files(rows, f"{tmp_path}/out")
    assert tree(f"{tmp_path}/out") == {f"d{k % 3}/{k}.txt": f"text {k}" for k in range(40)}
    before = tree(f"{tmp_path}/out")

    @F.udf("string")
    def fails(name):
        if name.endswith("/39.txt"):
            raise RuntimeError("lost")
        return "other"

    for bad in (rows.withColumn("content", fails("name")), rows.limit(3), rows.withColumn("name", F.lit("same.txt")), rows.limit(2).withColumn("name", F.lit("../x")), rows.limit(1).withColumn("content", F.lit(None).cast("string")).withColumn("name", F.lit("n"))):
        with pytest.raises(Exception, match="lost|exist|twice|not a name|null content"):
            write_files(bad, f"{tmp_path}/out")
        assert tree(f"{tmp_path}/out") == before and os.listdir(tmp_path) == ["out"]
    write_files(rows.limit(3).withColumn("content", F.lit("new")), f"{tmp_path}/out", overwrite=True)
    after = tree(f"{tmp_path}/out")
    assert set(after) == set(before) and list(after.values()).count("new") == 3
    write_files(rows.limit(0), f"{tmp_path}/none")
    assert tree(f"{tmp_path}/none") == {}


def test_saved_or_and_report(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(3)
    assert [files.saved_or(spark, f"{tmp_path}/m", make).count() for _ in range(2)] == [3, 3] and len(made) == 1
    videos = spark.createDataFrame([(1, "c", "/x/é.mp4", 100, 29.97)], "video_id long, category string, path string, frames long, fps double")
    stats = spark.createDataFrame([(1, *range(9))], "video_id long, " + ", ".join(f"{c} long" for c in files.COUNTERS))
    blocked = spark.createDataFrame([(1, "G", 5), (1, "H", 2)], "video_id long, speaker string, first_seen long")
    text = files.video_report(videos, stats, blocked).first().content
    assert "FPS: 29.9700" in text and text.endswith("  H\n  G") and "e.mp4" in text


def test_seams(spark):
    videos = spark.createDataFrame([(1, "p"), (2, "q")], "video_id long, path string")
    done = spark.createDataFrame([(2,)], "video_id long")
    assert [bytes(r.content) for r in files.extract_audio(videos, lambda p: p.encode(), done).collect()] == [b"p"]
    frames = files.decode_frames(videos, lambda p: iter([(0, 0.0, 1, 1, b"abc"), (1, 33.3, 1, 1, b"abc")]))
    assert frames.count() == 4


def test_stream_equals_batch(spark, tmp_path):
    rows = [(v, i, i, i + 1, "A" if i % 5 else "B", "HELLO" if i % 3 else "HELLO THERE", False, False, True) for v in (1, 2) for i in range(20)]
    schema = "video_id long, seg_idx long, start_ms long, end_ms long, speaker string, text string, speaker_invalid boolean, text_invalid boolean, allowed boolean"
    for k in range(2):
        spark.createDataFrame([r for r in rows if r[1] // 10 == k], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = decide_stream(stream).writeStream.format("memory").queryName("decided").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    q.awaitTermination(120)
    want = {tuple(r) for r in utterance.decide_exact(spark.createDataFrame(rows, schema)).collect()}
    assert {tuple(r) for r in spark.table("decided").collect()} == want


def test_sessions(spark):
    df = spark.sql("select 1 as u, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,m,0) as ts from values (0),(5),(14),(40) t(m)")
    assert sorted(r.n for r in activity_sessions(df, "u").collect()) == [1, 3]
