"""Mergeable quantile sketches against exact ranks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.operators.drift import numeric_drift
from glyphmill.operators.sketches import merge_sketches, numeric_sketches, rank_error, sketch_drift


def by_day(spark, values, days=5):
    rows = [(f"d{i % days}", None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "day string, v double").repartition(4)


@pytest.mark.parametrize("k", [200, 1600])
def test_merged_sketch_is_as_exact_as_stated(spark, k):
    values = np.random.default_rng(1).lognormal(0, 2, 40_000)
    days = numeric_sketches(by_day(spark, values), "v", by=("day",), k=k)
    assert days.count() == 5
    shares = [i / 20 for i in range(1, 20)]
    found = merge_sketches(days).select("n", F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, shares))).alias("q")).first()
    assert found["n"] == len(values)
    for share, quantile in zip(shares, found["q"], strict=True):
        assert abs((values <= quantile).mean() - share) <= 1.5 * rank_error(k)


def test_drift_from_sketches_is_close_to_exact(spark):
    rng = np.random.default_rng(2)
    for old, new in ((rng.normal(0, 1, 20_000), rng.normal(0.3, 1.2, 15_000)), (rng.integers(0, 6, 5000), rng.integers(2, 9, 4000))):
        sides = by_day(spark, old), by_day(spark, new, 3)
        exact = numeric_drift(*sides, "v").first()
        close = sketch_drift(*[numeric_sketches(side, "v", by=("day",)) for side in sides]).first()
        assert (close["n_ref"], close["n_new"]) == (exact["n_ref"], exact["n_new"])
        assert close["psi"] == pytest.approx(exact["psi"], abs=0.02, rel=0.05)
        assert close["ks_stat"] == pytest.approx(exact["ks_stat"], abs=2 * rank_error() + 0.005)


def test_odd_groups(spark):
    rows = by_day(spark, [None, 1.0, float("nan"), 2.0, None], days=5)
    sketches = numeric_sketches(rows, "v", by=("day",))
    assert {r["day"]: r["n"] for r in sketches.collect()} == {"d0": 0, "d1": 1, "d2": 0, "d3": 1, "d4": 0}
    assert merge_sketches(sketches).first()["n"] == 2
    none = numeric_sketches(rows.limit(0), "v", by=("day",))
    row = sketch_drift(none, sketches).first()
    assert (row["n_ref"], row["n_new"], row["psi"], row["ks_stat"], row["ks_pvalue"]) == (0, 2, 0.0, None, None)
    constant = numeric_sketches(by_day(spark, [3.0] * 50), "v")
    same = sketch_drift(constant, constant).first()
    assert same["psi"] == pytest.approx(0.0) and same["ks_stat"] == 0.0
