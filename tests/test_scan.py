"""Scans within keys against plain loops: keys over many pieces, one key of all rows, null keys, ties, empties."""

import random

import pytest
from pyspark.sql import functions as F

from uttera.operators import split
from uttera.operators.scan import Ordered
from uttera.sources import files

SCHEMA = "k string, i long, v long"


def plain(rows):
    out, state = [], {}
    for k, i, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        n, total, before, last = state.get(k, (0, None, None, None))
        total = total if v is None else v + (total or 0)
        out.append([k, i, v, n + 1, total, before, v if v is not None else last])
        state[k] = n + 1, total, v, v if v is not None else last
    return sorted(([*r[:4], state[r[0]][0], *r[4:]] for r in out), key=repr)


@pytest.mark.parametrize("pieces", [1, 7, None])
def test_scan(spark, pieces):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None, "c"]), i, rng.choice([None, 1, 2, 5])) for i in range(400)]
    for some in (rows, [("all", i, v) for _, i, v in rows], rows[:1], []):
        shuffled = some[:]
        rng.shuffle(shuffled)
        o = Ordered(spark.createDataFrame(shuffled, SCHEMA), ["k"], ["i"], pieces)
        got = o.scan(place="place", total="total", sums={"sum": F.col("v")}, before={"before": F.col("v")}, last={"last": F.col("v")})
        assert sorted(([*r] for r in got.collect()), key=repr) == plain(some)


def test_no_window_spans_a_key(spark):
    """All rows in one directory: they lie in many pieces, and windows see a row a piece."""
    rows = spark.range(20_000).selectExpr("'one' as k", "id as i", "id % 3 as v")
    o = Ordered(rows, ["k"], ["i"], 16)
    sizes = [r["count"] for r in o.rows.groupBy("__piece").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 4 * 20_000 / 16
    got = split.positional_split(rows, ["k"], ["i"])
    assert "row_number" not in got._jdf.queryExecution().toString()
    assert [r.n for r in split.split_counts(got).orderBy("split").collect()] == [2_000, 18_000]
    assert got.where("(i < 18000) <> (split = 'train')").isEmpty()


@pytest.mark.parametrize("n, least, want", [(1, 1, (0, 1)), (2, 1, (1, 1)), (9, 1, (8, 1)), (10, 1, (9, 1)), (11, 1, (9, 2)), (20, 1, (18, 2)), (10, 2, (10, 0)), (11, 2, (9, 2))])
def test_split_and_counts(spark, n, least, want):
    rows = spark.range(n).selectExpr("cast(null as string) as k", "id")
    got = [r.split for r in split.positional_split(rows, ["k"], ["id"], min_test=least).orderBy("id").collect()]
    assert got == ["train"] * want[0] + ["test"] * want[1]
    assert {r.split: r.n for r in split.count_split(rows, ["k"], min_test=least).collect()} == {k: c for k, c in zip(("train", "test"), want, strict=True) if c}


def test_listing_over_pieces(spark, tmp_path):
    for k in range(60):
        (tmp_path / f"d{k % 7}").mkdir(exist_ok=True)
        (tmp_path / f"d{k % 7}" / f"{k:02d} Xillia 2.mp4").write_bytes(b"x")
    got = files.list_videos(spark, str(tmp_path)).orderBy("video_id").collect()
    assert [r.video_id for r in got] == list(range(1, 61)) and [r.path for r in got] == sorted(r.path for r in got)
