import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from uttera.config import ALLOWED, ROI
from uttera.functions.text import ratio
from uttera.operators import align, asof, images, intervals, outliers, split, utterance


def test_allow_list_size():
    assert sum(len(v) for v in ALLOWED.values()) == 52 and len(ROI) == 10


def test_segments(spark):
    df = spark.createDataFrame([(1, 0, 100, 400), (2, 0, 0, 10), (2, 1, 20, 30), (3, 0, 0, 10), (3, 1, 19, 30)], "v int, seg_idx int, start_ms long, end_ms long")
    got = intervals.prepare_segments(df)
    assert [tuple(r) for r in got.where("v = 1").select("middle_ms", "buffered_start", "buffered_end").collect()] == [(250, 95, 405)]
    assert [r.v for r in intervals.overlaps(got, "v", "seg_idx").collect()] == [3]
    assert intervals.prepare_segments(df, clamp=True).agg(F.min("buffered_start")).first()[0] == 0
    assert intervals.prepare_segments(df, min_ms=11).count() == 2
    with pytest.raises(Exception, match="overlap"):
        intervals.overlaps(got, "v", "seg_idx", strict=True).collect()


def silence(values, k, db):
    limit = np.sqrt(np.mean(np.square(values))) * 10 ** (-db / 20)
    starts = [i for i in range(len(values) - k + 1) if np.sqrt(np.mean(np.square(values[i : i + k]))) <= limit]
    out = []
    for i in starts:
        if out and i <= out[-1][1] - k + k:
            out[-1][1] = i + k
        else:
            out.append([i, i + k])
    return out


def test_silence_and_activity(spark):
    rng = random.Random(4)
    signals = {v: [float(rng.choice([0, 0, 0, 5, 9])) for _ in range(rng.randint(3, 80))] for v in range(12)}
    df = spark.createDataFrame([(v, i, x) for v, s in signals.items() for i, x in enumerate(s)], "v int, idx long, value double")
    got = {}
    for r in intervals.silence_ranges(df, "v", 4, 3.0).orderBy("v", "silence_idx").collect():
        got.setdefault(r.v, []).append([r.start, r.end])
    want = {v: s for v, x in signals.items() if (s := silence(x, 4, 3.0))}
    assert got == want
    act = {v: [] for v in signals}
    for r in intervals.activity_segments(df, "v", 4, 3.0).orderBy("v", "seg_idx").collect():
        act[r.v].append([r.start, r.end])
    for v, x in signals.items():
        edges = [0, *[e for s in want.get(v, []) for e in s], len(x)]
        assert act[v] == [[a, b] for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b]


def test_greedy_asof(spark):
    rng = random.Random(1)
    frames, middles, want = [], [], set()
    for v in range(40):
        ts = sorted(rng.sample(range(200), rng.randint(1, 20)))
        ms = sorted(rng.choices(range(220), k=rng.randint(0, 15)))
        frames += [(v, i, float(t)) for i, t in enumerate(ts)]
        middles += [(v, j, float(m)) for j, m in enumerate(ms)]
        j = 0
        for i, t in enumerate(ts):
            if j < len(ms) and t >= ms[j]:
                want.add((v, j, i))
                j += 1
    f, m = spark.createDataFrame(frames, "v int, frame_idx long, ts double"), spark.createDataFrame(middles, "v int, seg_idx long, middle double")
    assert {tuple(r) for r in asof.greedy_asof(f, m, "v").collect()} == want


ROWS = [("YURI", "HELLO THERE"), ("YURI", "HELLO THERE"), ("YURI", "LETS GO NOW"), ("YURI", "LETS GO NO"), ("ESTELLE", "YES"), ("", ""), ("GUARD", "HALT"), ("GUARD", "HALT"), ("YURI", ""), ("YURI", "DONE"), ("ESTELLE", "BYE")]


@pytest.fixture(scope="module")
def observations(spark):
    df = spark.createDataFrame([(1, i, 95 + 400 * i, 405 + 400 * i, s, t) for i, (s, t) in enumerate(ROWS)], "video_id long, seg_idx long, start_ms long, end_ms long, speaker string, text string")
    return utterance.with_allowed(df, spark.createDataFrame([("YURI",), ("ESTELLE",)], "speaker string"), [])


@pytest.mark.parametrize("exact", [True, False])
def test_fold_golden(observations, exact):
    decided = utterance.decide_exact(observations) if exact else utterance.decide_native(observations)
    got = [tuple(r) for r in utterance.utterances(decided).orderBy("start_ms").collect()]
    assert got == [(1, "YURI", 0, 95, 805, "HELLO THERE", "YURI-1-0000"), (1, "ESTELLE", 0, 1695, 2005, "YES", "ESTELLE-1-0000"), (1, "YURI", 1, 3695, 4005, "DONE", "YURI-1-0001")]
    s = utterance.statistics(decided).first().asDict()
    assert s == {"video_id": 1, "potential": 11, "successful": 3, "total_dropped": 4, "cleaner": 0, "no_speaker": 1, "no_transcript": 1, "discrepancies": 1, "blacklisted": 2, "verification_failed": 0}
    assert utterance.utterances(decided, flush_tail=True).count() == 4
    assert [r.speaker for r in utterance.blocked_speakers(observations).collect()] == ["GUARD"]


def test_fold_engines_agree_and_reject(spark, observations):
    from uttera.functions.text import levenshtein_ratio  # noqa: F401

    def lev(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
        return 1 - d[-1] / max(len(a), len(b)) if a or b else 1.0

    rng = random.Random(7)
    rows = [(v, i, 10 * i, 10 * i + 9, rng.choice(["A", "A", "B", ""]), rng.choice(["HELLO", "HELLO", "HELL", "HELP ME", "X", ""]), rng.random() < 0.1, rng.random() < 0.1, rng.random() < 0.9) for v in range(20) for i in range(30)]
    df = spark.createDataFrame(rows, "video_id long, seg_idx long, start_ms long, end_ms long, speaker string, text string, speaker_invalid boolean, text_invalid boolean, allowed boolean")
    a = {tuple(r) for r in utterance.decide_native(df).drop("run_idx").collect()}
    b = {tuple(r) for r in utterance.decide_exact(df, lev).collect()}
    assert a == b and len(a) == 600
    rejected = spark.createDataFrame([(1, "YURI-1-0000")], "video_id long, clip_name string")
    decided = utterance.decide_native(observations)
    s = utterance.statistics(decided, rejected).first()
    assert (s.successful, s.total_dropped, s.verification_failed) == (2, 5, 1)
    assert [r.clip_name for r in outliers.without_rejected(utterance.utterances(decided), rejected, ["clip_name"]).orderBy("clip_name").collect()] == ["ESTELLE-1-0000", "YURI-1-0001"]
    assert outliers.unmatched_rejects(utterance.utterances(decided), rejected, ["clip_name"]).isEmpty()


@pytest.mark.parametrize(("n", "least", "want"), [(1, 1, (0, 1)), (2, 1, (1, 1)), (9, 1, (8, 1)), (10, 1, (9, 1)), (11, 1, (9, 2)), (20, 1, (18, 2)), (10, 2, (10, 0)), (11, 2, (9, 2))])
def test_split(spark, n, least, want):
    got = {r.split: r.n for r in split.split_counts(split.positional_split(spark.range(n).withColumn("d", F.lit(1)), ["d"], ["id"], min_test=least)).collect()}
    assert (got.get("train", 0), got.get("test", 0)) == want


def test_outliers(spark):
    rng = np.random.default_rng(2)
    e = rng.normal(size=(25, 8)).astype(np.float32)
    df = spark.createDataFrame([(i % 3, i, [float(x) for x in v]) for i, v in enumerate(e)] + [(9, 99, [1.0] * 8)], "g int, m int, e array<float>")
    old, outliers.PAIR_ROWS = outliers.PAIR_ROWS, 3
    try:
        for combine in ("mean", "max"):
            got = {r.m: r.score for r in outliers.member_scores(df, "g", "m", "e", combine).collect()}
            for i, v in enumerate(e.astype(float)):
                d = [np.linalg.norm(v - w) for j, w in enumerate(e.astype(float)) if j % 3 == i % 3 and j != i]
                assert abs(got[i] - (np.mean(d) if combine == "mean" else max(d))) < 1e-5
            assert got[99] == 0
    finally:
        outliers.PAIR_ROWS = old
    assert outliers.member_scores(df, "g", "m", "e", "centroid").count() == 26
    assert outliers.report_lines(spark.createDataFrame([(1.234, "a.wav")], "score double, m string"), "m").first()[0] == "1.23 - a.wav"


GRID = 'File type = "ooTextFile"\nxmin = 0 \nxmax = 1.2 \nitem []: \n    item [1]:\n        name = "words" \n        xmin = 0 \n        xmax = 1.2 \n        intervals: size = 3 \n        intervals [1]:\n            xmin = 0 \n            xmax = 0.35 \n            text = "go" \n        intervals [2]:\n            xmin = 0.35 \n            xmax = 0.9 \n            text = "do" \n        intervals [3]:\n            xmin = 0.9 \n            xmax = 1.2 \n            text = "" \n    item [2]:\n        intervals: size = 1 \n        intervals [1]:\n            xmin = 0 \n            xmax = 1.2 \n            text = "x" \n'


@pytest.mark.parametrize(("ms", "times"), [(120, "0.12,0.35,0.9,1.2"), (None, "0,0.35,0.9,1.2"), (400, "0,0.35,0.9,1.2")])
def test_alignment(spark, ms, times):
    df = spark.createDataFrame([(GRID, ms)], "c string, ms int").select(align.textgrid_intervals(F.col("c")).alias("iv"), "ms")
    r = df.select(F.size("iv").alias("n"), align.ends_silent(F.col("iv")).alias("ok"), align.alignment_line(F.lit("YURI-1-0000"), align.with_leading_silence(F.col("iv"), F.col("ms"))).alias("line")).first()
    assert tuple(r) == (3, True, f'YURI-1-0000 ",GO,DO," "{times}"')


def test_transcripts(spark):
    lines = spark.createDataFrame([("A-1-0000 HELLO THERE",), ("",), ("A-1-0001",)], "value string")
    assert [(r.clip_name, r.text) for r in align.transcript_entries(lines).collect()] == [("A-1-0000", "HELLO THERE"), ("A-1-0001", None)]
    paths = ["x/S/1/a.wav", "x/S/1/a.txt", "x/S/1/a.trans.txt", "x/S/1/a.trans.wav", "x/S/1/a.mp4"]
    got = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").select("i", align.flat_destination(F.col("p")).alias("d")).orderBy("i").collect()
    assert [r.d for r in got] == ["x/S/a.wav", "x/S/a.txt", None, "x/S/a.trans.wav", None]


def test_roi(spark):
    want = {
        ("berseria", "subtitle"): (288, 882, 1728, 1070), ("berseria", "speaker"): (345, 831, 615, 891), ("zestiria", "subtitle"): (364, 842, 1767, 1080), ("zestiria", "speaker"): (19, 842, 352, 890), ("xillia 1", "subtitle"): (288, 842, 1632, 1037),
        ("xillia 1", "speaker"): (445, 788, 653, 852), ("xillia 2", "subtitle"): (288, 842, 1632, 1070), ("xillia 2", "speaker"): (445, 788, 653, 852), ("vesperia", "subtitle"): (480, 788, 1863, 1070), ("vesperia", "speaker"): (96, 788, 461, 972),
    }
    sizes = spark.createDataFrame([(c, 1920, 1080) for c in ALLOWED], "category string, width int, height int")
    assert {(r.category, r.region): (r.x1, r.y1, r.x2, r.y2) for r in images.roi_boxes(sizes, images.roi_table(spark)).collect()} == want


def test_pixels(spark):
    assert images.gamma_table(1.0).tolist() == list(range(256)) and images.gamma_table(0.1)[255] == 255 and images.gamma_table(0.1)[128] == 0
    assert images.contrast(np.array([100, 50], np.uint8), 2.7).tolist() == [255, 135]
    flat = np.full((6, 5), 7, np.uint8)
    assert (images.sharpen(flat) == 7).all() and (images.resize(flat, 1.0, 1.6) == 7).all() and images.resize(flat, 1.0, 1.6).shape == (10, 5)
    assert images.resize(np.array([[0, 100, 200, 100, 50]], np.uint8), 0.6, 1.0, area=True).tolist() == [[40, 160, 70]]
    assert images.gray(np.array([[[10, 20, 30]]], np.uint8)).tolist() == [[22]]
    out = images.preprocess(np.full((100, 50, 3), 255, np.uint8), "xillia 1", True)
    assert out[90, 45] == 0 and out[0, 0] == 255 and out.shape == (160, 50)
    with pytest.raises(ValueError, match="unknown"):
        images.preprocess(flat, "other")


def test_recognise(spark):
    image = bytes(np.full((36, 64, 3), 200, np.uint8))
    df = spark.createDataFrame([(1, 0, "vesperia", 64, 36, image)], "video_id long, frame_idx long, category string, width int, height int, image binary")
    r = images.recognise(df, lambda x: str(x.shape[1])).first()
    assert (r.raw_speaker, r.raw_text) == (str(64 - int(0.76 * 64) - int(0.05 * 64)), str(64 - int(0.03 * 64) - int(0.25 * 64)))


def test_ratio_order():
    assert ratio("tide", "diet") == 0.25 and ratio("diet", "tide") == 0.5


def test_islands(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, None), (1, 5, None), (1, 6, "a"), (2, 1, None)], "k int, o int, v string")
    got = sorted(tuple(r) for r in utterance.islands(df, "k", ["o"], "v").select("k", "island", "n", "first", "last").collect())
    assert got == [(1, 1, 2, 1, 2), (1, 2, 1, 3, 3), (1, 3, 2, 4, 5), (1, 4, 1, 6, 6), (2, 1, 1, 1, 1)]


def test_native_fold_is_linear_and_equals_the_scan(spark):
    rng = random.Random(6)
    rows, text = [], "start here"
    for k in range(3000):
        if rng.random() < 0.3:
            text = rng.choice(["go on now", "go on no", "wait", "", "go away then", text + "x"])
        rows.append((k % 3, k, 0, 1, rng.choice(["A", "A", "A", "A", "B", ""]) if rng.random() < 0.2 else "A", text, rng.random() < 0.03, rng.random() < 0.03, rng.random() < 0.9))
    df = spark.createDataFrame(rows, "video_id long, seg_idx long, start_ms long, end_ms long, speaker string, text string, speaker_invalid boolean, text_invalid boolean, allowed boolean")

    def distance(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            c = [i]
            for j, y in enumerate(b, 1):
                c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
            p = c
        return p[-1]

    want, folds = {}, {}
    for v, k, _, _, s, t, si, ti, ok in rows:
        fold = folds.setdefault(v, utterance.Fold(similarity=lambda a, b: 1 - distance(a, b) / max(len(a), len(b))))
        want[v, k] = fold.step(s, t, si, ti, ok)
    got = {(r.video_id, r.seg_idx): (r.is_new, r.bad, r.no_speaker, r.no_transcript, r.discrepancy, r.blacklisted, r.cleaner, r.status) for r in utterance.decide_native(df).collect()}
    assert got == want
    one = spark.range(16_000).selectExpr("1 as video_id", "id as seg_idx", "0 as start_ms", "1 as end_ms", "'A' as speaker", "concat('some text ', id div 2) as text", "true as allowed")
    assert utterance.decide_native(one).count() == 16_000


def test_outliers_with_nulls_and_repeats(spark):
    rows = [("g", 1, [0.0, 0.0]), ("g", 2, [3.0, 4.0]), ("g", 2, [3.0, 4.0]), ("g", 3, None), ("h", 4, [1.0, 1.0]), ("h", 5, [1.0 + 1e-9, 1.0])]
    df = spark.createDataFrame(rows, "label string, member int, e array<double>")
    got = {r.member: r.score for r in outliers.member_scores(df, "label", "member", "e").collect()}
    assert set(got) == {1, 2, 4, 5} and got[1] == got[2] == 5.0 and got[4] == pytest.approx(1e-9, rel=1e-3)


def test_clip_samples_meet_only_near_clips(spark):
    samples = spark.range(500).selectExpr("1 as k", "id as idx", "double(id) as value")
    clips = spark.createDataFrame([(1, 0, 3), (1, 99, 207), (1, 499, 600), (1, 5, 5), (2, 0, 9)], "k int, start long, end long")
    got = sorted((r.start, r.idx) for r in intervals.clip_samples(samples, clips, "k", step=50).collect())
    assert got == [(0, i) for i in range(3)] + [(99, i) for i in range(99, 207)] + [(499, 499)]


def test_level_and_first_silence(spark):
    samples = spark.createDataFrame([("a", i, v) for i, v in enumerate([9.0, 0.0, 0.0, 9.0, 0.0, 0.0])] + [("b", i, 5.0) for i in range(4)] + [("c", 0, 0.0)], "k string, idx long, value double")
    assert {r.k: (r.start, r.end) for r in intervals.first_silence(samples, "k", 2, 3.0).collect()} == {"a": (1, 3), "b": (None, None), "c": (None, None)}
    level = {r.k: (r.n, r.rms, r.db) for r in intervals.signal_level(samples, "k").collect()}
    assert level["b"] == (4, 5.0, pytest.approx(13.979400)) and level["c"] == (1, 0.0, None)


def test_pairwise_distances():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 16)) + 1000
    y = np.concatenate([x[:20], x[20:30] + 1e-7, rng.normal(size=(25, 16))])
    want = np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(-1))
    for step in (1, 300, 1_000_000):
        assert np.allclose(outliers.pairwise(x, y, step), want, rtol=1e-9, atol=1e-12)
    assert outliers.pairwise(x[:0], y).shape == (0, 55)
