"""Silence in blocks against one pass over each signal, and totals observed while writing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from uttera.operators import intervals, utterance
from uttera.plans import derived
from uttera.plans.queries import queries


@pytest.fixture(scope="module")
def signals(spark):
    rng = np.random.default_rng(5)
    rows = []
    for key, n in ((1, 2300), (2, 1), (3, 6), (4, 64), (5, 400)):
        loud = np.repeat(rng.random(n // 5 + 1) < 0.5, 5)[:n]
        rows += [(key, i, float(v)) for i, v in enumerate(np.where(loud, rng.integers(50, 90, n), rng.integers(0, 9, n)) * (key != 5))]
    return spark.createDataFrame(rows, "user_id long, idx long, value double")


@pytest.mark.parametrize("size", [7, 64, 1000])
@pytest.mark.parametrize("k", [1, 4, 20])
def test_blocks_equal_one_pass(spark, signals, size, k):
    want = sorted(map(tuple, intervals.silence_ranges(signals, "user_id", k, 3.0).collect()))
    assert sorted(map(tuple, intervals.silence_ranges_in_blocks(signals, "user_id", k, 3.0, size).collect())) == want
    assert k == 20 or len(want) > 50


def test_blocks_of_nothing(spark, signals):
    assert intervals.silence_ranges_in_blocks(signals.limit(0), "user_id", 4, 3.0, 64).count() == 0


def test_observed_totals(spark, sf, tmp_path):
    decided = utterance.decide_native(derived.observations(spark, sf))
    got = utterance.save_runs(decided, f"{tmp_path}/runs")
    table = queries()["utterance_stats"](spark, sf)
    want = table.agg(*[F.sum(c).alias(c) for c in table.columns if c not in ("video_id", "verification_failed")]).first().asDict()
    assert got == want and spark.read.parquet(f"{tmp_path}/runs").agg(F.sum("potential")).first()[0] == got["potential"]
    assert utterance.summary(got).splitlines()[:2] == [f"potential: {got['potential']}", f"successful: {got['successful']}"]
    none = utterance.save_runs(decided.limit(0), f"{tmp_path}/none")
    assert set(none.values()) == {0}
