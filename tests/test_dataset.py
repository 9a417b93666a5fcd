"""The whole plan: its counters are in use, and verification looks at allowed speakers only."""

from pyspark.sql import functions as F

from uttera.functions import text
from uttera.functions.text import levenshtein_ratio
from uttera.operators import asof, utterance
from uttera.plans import dataset
from uttera.plans.queries import queries


def test_every_counter_is_used(spark):
    got = queries()["dataset_statistics"](spark, "/root/testdata/sf0.01")
    totals = got.agg(*[F.sum(c).alias(c) for c in got.columns if c != "video_id"]).first().asDict()
    assert all(totals[c] > 0 for c in ("successful", "cleaner", "no_speaker", "no_transcript", "discrepancies", "verification_failed"))
    assert totals["successful"] + totals["total_dropped"] <= totals["potential"]


def test_verification_leaves_gaps_and_other_speakers(spark):
    segments = spark.createDataFrame([(1, k, 100 * k, 100 * k + 60) for k in range(6)] + [(1, 6, 600, 610)], "video_id long, seg_idx long, start_ms long, end_ms long")
    says = ["ONE", "TWO TWO", "THREE THREE", "FOUR", "FIVE FIVE FIVE", "SIX"]
    frames = spark.createDataFrame([(1, k, 100.0 * k + 40, "yuri", says[k]) for k in range(6)], "video_id long, frame_idx long, ts double, raw_speaker string, raw_text string")
    allowed = spark.createDataFrame([("YURI",), ("YURI",), ("NOBODY",)], "speaker string")
    out = dataset.build(segments, frames, allowed, lambda u: u["utt_idx"] == 1, min_ms=50)
    assert [(r.utt_idx, r.text) for r in out.utterances.orderBy("utt_idx").collect()] == [(0, "ONE"), (2, "THREE THREE"), (3, "FOUR"), (4, "FIVE FIVE FIVE")]
    assert [r.clip_name for r in out.rejected.collect()] == ["YURI-1-0001"]
    (stats,) = out.statistics.collect()
    assert (stats.potential, stats.successful, stats.total_dropped, stats.verification_failed) == (6, 4, 1, 1)
    assert sum(r.n_lines for r in out.transcripts.collect()) == 4


def test_each_directory_is_split_by_itself(spark):
    """A directory is one speaker in one video: of its n clips in order of their index the first int(0.9 n) train."""
    sizes = {(1, "YURI"): 1, (1, "ESTELLE"): 4, (2, "YURI"): 11, (3, "YURI"): 2}
    runs, frames = [], []
    for video in (1, 2, 3):
        names = [n for (v, n), k in sizes.items() if v == video for _ in range(k)] + ["NOBODY"]  # the last run is never emitted
        for k, name in enumerate(names):
            runs.append((video, k, 100 * k, 100 * k + 60))
            frames.append((video, k, 100.0 * k + 40, name, chr(65 + k) * 3 + " " + chr(75 + k) * 4))
    segments = spark.createDataFrame(runs, "video_id long, seg_idx long, start_ms long, end_ms long")
    frames = spark.createDataFrame(frames, "video_id long, frame_idx long, ts double, raw_speaker string, raw_text string")
    allowed = spark.createDataFrame([("YURI",), ("ESTELLE",)], "speaker string")
    out = dataset.build(segments, frames, allowed, lambda u: u["utt_idx"] < 0, min_ms=50)
    got = {}
    for r in out.transcripts.collect():
        got.setdefault((r.video_id, r.speaker), {})[r.split] = [line.split(" ")[0] for line in r.content.split("\n")]
    want = {}
    for (video, name), n in sizes.items():
        clips, cut = [f"{name}-{video}-{k:04d}" for k in range(n)], int(n * 0.9)
        want[video, name] = {split: part for split, part in (("train", clips[:cut]), ("test", clips[cut:])) if part}
    assert got == want


def test_fold_reads_observations_that_are_made_once(spark):
    """The fold draws its ranges from its input, which is read twice by that: it must be a table, not the joins and the cleaning."""
    seen = []

    def decide(obs):
        seen.append(obs._jdf.queryExecution().optimizedPlan().toString())
        return utterance.decide_native(obs)

    segments = spark.createDataFrame([(1, 0, 0, 200), (1, 1, 300, 600)], "video_id long, seg_idx long, start_ms long, end_ms long")
    frames = spark.createDataFrame([(1, 0, 50, "A", "x"), (1, 1, 150, "A", "hello"), (1, 2, 500, "A", "HELLO"), (1, 3, 700, "A", "z")], "video_id long, frame_idx long, ts long, raw_speaker string, raw_text string")
    allowed = spark.createDataFrame([("A",)], "speaker string")
    dataset.build(segments, frames, allowed, lambda u: F.lit(False), decide=decide)
    assert seen and "Window" not in seen[0] and "regexp_replace" not in seen[0]


def test_asof_reads_each_row_once(spark):
    """No window frame reaches to the end of a key, which would read what is left of it for every row."""
    frames = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("frame_idx"), (F.col("id") * 10).alias("ts"))
    middles = spark.range(900).select(F.lit(1).alias("k"), F.col("id").alias("seg_idx"), (F.col("id") * 33 + 1).alias("middle"))
    got = asof.greedy_asof(frames, middles, "k")
    assert "unboundedfollowing" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
    want, at = [], -1
    for j in range(900):
        at = max(at + 1, -(-(j * 33 + 1) // 10))
        if at >= 3000:
            break
        want.append((1, j, at))
    assert sorted(map(tuple, got.collect())) == want


def test_levenshtein_ratio_of_cut_texts(spark):
    pairs = [("ABCDEF", "ABC"), ("ABC", "ABCDEF"), ("", "ABC"), ("ABC", ""), ("", ""), ("ÀB", "ÀBC😀"), ("XABC", "ABC"), (None, "A"), ("A", None)]
    got = spark.createDataFrame(pairs, "a string, b string").select(levenshtein_ratio(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [0.5, 0.5, 0.0, 0.0, 1.0, 0.5, 0.75, None, None]
    plan = spark.createDataFrame([("A", "B")], "a string, b string").select(levenshtein_ratio(F.col("a"), F.col("b")))._jdf.queryExecution().analyzed().toString()
    assert "startswith" in plan.lower()


def test_dropped_letters_are_those_of_the_negated_class(spark):
    letters = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x11000), 0x1F600, 0x10FFFF]))
    got = spark.createDataFrame([(letters,)], "c string").select(F.regexp_replace("c", text._OTHER, ""), F.regexp_replace("c", "[^A-Za-z0-9 \\t\\n\\x0B\\f\\r'.]", "")).first()
    assert got[0] == got[1] and len(got[0]) == 70
