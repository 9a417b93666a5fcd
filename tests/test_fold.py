"""The native fold over chunks: runs across many chunks, a video of one stretch, rounds, nulls."""

import random

import pytest
from pyspark.sql import functions as F

from uttera.functions.text import matching_decided, ratio
from uttera.operators import utterance

SCHEMA = "video_id long, seg_idx long, start_ms long, end_ms long, speaker string, text string, speaker_invalid boolean, text_invalid boolean, allowed boolean"


def lev(x, y):
    d = list(range(len(y) + 1))
    for i, a in enumerate(x):
        last, d[0] = d[0], i + 1
        for j, b in enumerate(y, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (a != b))
    return 1 - d[-1] / max(len(x), len(y)) if x or y else 1.0


def by_scan(rows):
    """One row after the other, with the class that streams use."""
    out, folds, runs = [], {}, {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        fold = folds.setdefault(r[0], utterance.Fold(similarity=lev))
        s, t = r[4] or "", r[5] or ""
        step = fold.step(s, t, *r[6:])
        runs[r[0]] = runs.get(r[0], -1) + step[0]
        out.append((*r[:4], s, t, *step, runs[r[0]]))
    return out


@pytest.mark.parametrize("size, parts", [(1, 3), (3, 5), (7, 1), (1024, 4)])
def test_chunks_equal_the_scan(spark, monkeypatch, size, parts):
    monkeypatch.setattr(utterance, "PIECE", size)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    rng = random.Random(size)
    texts = ["HELLO", "HELLO", "HELLO", "HELL", "HELLOO", "HELP ME", "", None]
    rows = [(v, i, 10 * i, 10 * i + 9, rng.choice(["A"] * 12 + ["B", "", None]), rng.choice(texts), rng.random() < 0.05, rng.random() < 0.05, rng.random() < 0.95) for v in [1, 2, 3, None] for i in range(40 if v != 3 else 1)]
    rng.shuffle(rows)
    try:
        got = [tuple(r) for r in utterance.decide_native(spark.createDataFrame(rows, SCHEMA)).collect()]
        assert sorted(got, key=repr) == sorted(by_scan(rows), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_one_run_over_many_chunks(spark, monkeypatch):
    """Texts that differ a little from the first all the time: every chunk's guess is wrong, and two rounds put all right."""
    monkeypatch.setattr(utterance, "PIECE", 5)
    folds = []
    plain = utterance._Chunks.fold
    monkeypatch.setattr(utterance._Chunks, "fold", lambda self, c: folds.append(1) or plain(self, c))
    rows = [(1, i, i, i + 1, "A", "HELLO THERE YOU" + "ABCDE"[i % 5] if i else "HELLO THERE YOU", False, i == 57, True) for i in range(200)]
    got = [tuple(r) for r in utterance.decide_native(spark.createDataFrame(rows, SCHEMA)).orderBy("seg_idx").collect()]
    assert got == by_scan(rows) and len(folds) <= 4
    assert sum(r[9] for r in got) == 0 and sum(r[10] for r in got) == 1


def test_a_video_of_one_stretch(spark):
    """A million rows of one speaker: chunks are bounded, and runs come out as an islands query gives them."""
    n = 1_000_000
    text = F.expr("case when id % 1000 < 600 then 'THE FIRST LINE ' when id % 7 = 0 then 'ANOTHER THING' else 'OTHER WORDS NOW' end || int(id div 1000) % 10")
    rows = spark.range(n).select(F.lit(1).cast("long").alias("video_id"), F.col("id").alias("seg_idx"), F.col("id").alias("start_ms"), (F.col("id") + 1).alias("end_ms"), F.lit("A").alias("speaker"), text.alias("text"), F.lit(True).alias("allowed"))
    got = utterance.decide_native(rows)
    assert got.agg(F.count("*"), F.sum("seg_idx"), F.max("run_idx")).first()[:2] == (n, n * (n - 1) // 2)
    # only neighbours that differ can begin a run: the plain scan over these few is quick
    changed = rows.toPandas()
    fold, news, last = utterance.Fold(similarity=lev), [], None
    for i, t in enumerate(changed["text"].tolist()):
        if t == last == fold.tx:
            continue
        if t == last and not new:  # the same text again in a run: nothing new
            continue
        new = fold.step("A", t, False, False, True)[0]
        last = t
        if new:
            news.append(i)
    assert [r.seg_idx for r in got.where("is_new").orderBy("seg_idx").collect()] == news


def pairs():
    rng = random.Random(9)
    word = lambda k: "".join(rng.choice("ABCDE '9É") for _ in range(k))
    out = [("", ""), ("A", ""), ("", "A"), ("tide", "diet"), ("diet", "tide")]
    for _ in range(400):
        a = word(rng.randint(0, 40))
        b = rng.choice([word(rng.randint(0, 40)), a, a[: rng.randint(0, 40)] + word(3), word(4) + a, a.replace("A", "B"), a * 12, (a * 12)[:-1]])
        out += [(a, b), (b, a)]
    return out


def test_bounds_decide_as_the_exact_similarity(spark):
    """Where bounds speak they fall on the same side of both limits as the matching blocks."""
    df = spark.createDataFrame(pairs(), "a string, b string").withColumn("r", matching_decided(F.col("a"), F.col("b"), 0.6))
    side = lambda r: 0 if r <= 0.6 else 1 if r <= 1 - 1e-5 else 2
    rows = df.collect()
    assert all(r.r is None or side(r.r) == side(ratio(r.a, r.b)) for r in rows)
    assert sum(r.r is not None for r in rows) > 0.5 * len(rows) and any(r.r is None for r in rows)


@pytest.mark.parametrize("size", [2, 1024])
def test_matching_equals_the_exact_fold(spark, monkeypatch, size):
    monkeypatch.setattr(utterance, "PIECE", size)
    rng = random.Random(4)
    texts = ["LETS GO NOW", "LETS GO NO", "LETS GO NOW", "GO NOW LETS", "HELLO THERE", "TIDE AND DIET", "DIET AND TIDE", "", None, "X" * 250 + "Y", "X" * 250 + "ZY"]
    rows = [(v, i, i, i + 1, rng.choice(["A"] * 9 + ["B", ""]), rng.choice(texts), rng.random() < 0.1, rng.random() < 0.1, rng.random() < 0.9) for v in (1, 2, 3) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    got, want = utterance.decide_matching(df).collect(), utterance.decide_exact(df).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    share = utterance.decided_natively(df).first()
    assert share.rows == 150 and 0 < share.matched_stretches < share.stretches and 0 < share.native < 150
