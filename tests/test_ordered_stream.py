"""The streaming fold: rows out of order, rows too late, time that ends."""

import random
import time

import pytest
from pyspark.sql import functions as F

from uttera.functions.text import levenshtein_text
from uttera.operators import utterance
from uttera.streaming import ordered

SCHEMA = "video_id long, seg_idx long, start_ms long, end_ms long, speaker string, text string, speaker_invalid boolean, text_invalid boolean, allowed boolean"


def observations(n, seed):
    rng = random.Random(seed)
    return [(v, i, i, i + 1, rng.choice(["A", "A", "A", "B", "", None]), rng.choice(["HELLO", "HELLO THERE", "HELLO THERA", "X", None]), rng.random() < 0.1, rng.random() < 0.1, rng.random() < 0.9) for v in (1, 2, 3) for i in range(n)]


def test_replay_equals_batch(spark, tmp_path):
    rows = observations(40, 1)
    rng = random.Random(2)
    df = spark.createDataFrame([(*r, min((r[1] + rng.randint(0, 12)) // 13, 3)) for r in rows], SCHEMA + ", step int").withColumn("ts", F.timestamp_seconds(F.col("seg_idx") * 10 + 10**6))
    stream = ordered.replayed(df, "step", f"{tmp_path}/in", 4, 1)
    got = ordered.run_to_end(ordered.decide_ordered(stream, "300 seconds"), str(tmp_path)).where("video_id >= 0")
    want = utterance.decide_exact(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_late_rows_are_counted(spark, tmp_path):
    rows = observations(12, 3)
    early = [r for r in rows if r[1] != 1]
    df = spark.createDataFrame([(*r, 0 if r[1] < 6 else 1) for r in early] + [(*r, 2) for r in rows if r[1] == 1], SCHEMA + ", step int").withColumn("ts", F.timestamp_seconds(F.col("seg_idx") * 10 + 10**6))
    stream = ordered.replayed(df, "step", f"{tmp_path}/in", 3, 1)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ordered.ROCKS)
    q = ordered.decide_ordered(stream, "20 seconds").writeStream.format("memory").queryName("late").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert ordered.late_rows(q) == 3
    want = utterance.decide_exact(spark.createDataFrame(early, SCHEMA))
    assert sorted(map(tuple, spark.table("late").where("video_id >= 0").collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("a, b, want", [("", "", 1.0), ("", "X", 0.0), ("ABC", "ABC", 1.0), ("KITTEN", "SITTING", 1 - 3 / 7), ("AB", "BA", 0.0), ("HELLO", "HELL", 0.8)])
def test_levenshtein_text(spark, a, b, want):
    assert levenshtein_text(a, b) == levenshtein_text(b, a) == pytest.approx(want)
    assert spark.range(1).select(F.levenshtein(F.lit(a), F.lit(b))).first()[0] == round((1 - levenshtein_text(a, b)) * max(len(a), len(b)))


def test_short_videos_share_keys(spark, tmp_path, monkeypatch):
    """Videos of one bucket keep apart, wait and wake up together, over messages and frames of few rows."""
    monkeypatch.setattr(ordered, "SENT", 7)
    rng = random.Random(5)
    rows = [(v, *r[1:]) for v in range(60) for r in observations(6, v)[:6]]
    df = spark.createDataFrame([(*r, min((r[1] + rng.randint(0, 2)) // 3, 1)) for r in rows], SCHEMA + ", step int").withColumn("ts", F.timestamp_seconds(F.col("seg_idx") * 10 + 10**6))
    stream = ordered.replayed(df, "step", f"{tmp_path}/in", 2, 1)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ordered.ROCKS)
    q = ordered.decide_ordered(stream, "40 seconds", levenshtein_text, buckets=3).writeStream.format("memory").queryName("shared").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    want = utterance.decide_exact(spark.createDataFrame(rows, SCHEMA), levenshtein_text)
    assert sorted(map(tuple, spark.table("shared").where("video_id >= 0").collect())) == sorted(map(tuple, want.collect()))


def test_levenshtein_text_against_the_table():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            old, row = row, [i, *row[1:]]
            for j, y in enumerate(b, 1):
                row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
        return row[-1]

    rng = random.Random(7)
    for _ in range(400):
        a, b = ("".join(rng.choice("ABÀ😀") for _ in range(rng.randint(1, 80))) for _ in range(2))
        b = b if rng.random() < 0.5 else a[: rng.randint(0, 5)] + b[:4] + a[rng.randint(1, 9) :]
        assert levenshtein_text(a, b) == 1 - plain(a, b) / max(len(a), len(b))


def test_a_long_cut_text_is_compared_at_once():
    """Texts that one edit at the end or in the middle tells apart need no table: 20,000 letters had 4e8 cells before."""
    a = "HELLO THERE " * 1700
    began = time.perf_counter()
    assert levenshtein_text(a, a[:-3]) == 1 - 3 / len(a)
    assert levenshtein_text(a, a[:9000] + "X" + a[9001:]) == 1 - 1 / len(a)
    assert time.perf_counter() - began < 0.5
