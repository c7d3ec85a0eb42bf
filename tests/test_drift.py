import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.operators import drift as drift_module
from glyphmill.operators.drift import (
    categorical_psi,
    drift_against_profile,
    drift_profile,
    drift_report,
    ks_pvalue,
    ks_test,
    numeric_drift,
    psi,
    text_length_drift,
)
from glyphmill.params import QualityParams


def interpolated(ordered, share):
    """The value at a share of the way through a sorted list, between two ranks if need be."""
    place = Fraction(share) * (len(ordered) - 1)
    rank = math.floor(place)
    low, high = ordered[rank], ordered[min(rank + 1, len(ordered) - 1)]
    return low + (high - low) * float(place - rank)


def brute_psi(expected, actual, bins=10):
    """Population stability by counting, value by value, the cut points at or below it."""
    ordered = sorted(float(v) for v in expected)
    cuts = [interpolated(ordered, i * (1.0 / bins)) for i in range(1, bins)]

    def counts(values):
        return Counter(sum(cut <= float(v) for cut in cuts) for v in values)

    e, a = counts(expected), counts(actual)
    total = 0.0
    for cell in set(e) | set(a):
        p, q = e[cell] / len(expected) or 1e-6, a[cell] / len(actual) or 1e-6
        total += math.log(q / p) * (q - p)
    return total


def brute_ks(x, y):
    xs, ys = [float(v) for v in x], [float(v) for v in y]
    return max(abs(sum(v <= at for v in xs) / len(xs) - sum(v <= at for v in ys) / len(ys)) for at in {*xs, *ys})


def column(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


RNG = np.random.default_rng(0)
PAIRS = {
    "same": (RNG.normal(0, 1, 400), None),
    "shifted": (RNG.normal(0, 1, 400), RNG.normal(5, 1, 300)),
    "tied": (RNG.integers(0, 6, 300), RNG.integers(2, 9, 200)),
    "constant": (np.full(50, 3), np.full(40, 8)),
    "tiny": (np.array([1.0]), np.array([2.0, 1.0])),
    "eleven": (np.arange(11), np.arange(5, 25)),
    "wide": (np.array([-1e300, -5.0, 0.0, 1e-300, 7.0, 1e300]), RNG.normal(0, 1e4, 99)),
}


@pytest.mark.parametrize("name", PAIRS)
def test_numeric_drift_matches_brute_force(spark, name):
    reference, new = PAIRS[name]
    new = reference if new is None else new
    row = numeric_drift(column(spark, reference), column(spark, new), "v").first()
    assert (row["n_ref"], row["n_new"]) == (len(reference), len(new))
    assert row["psi"] == pytest.approx(brute_psi(reference, new), abs=1e-9)
    assert row["ks_stat"] == pytest.approx(brute_ks(reference, new), abs=1e-12)


@pytest.mark.parametrize("bins", [1, 2, 4, 25])
def test_psi_with_other_bin_counts(spark, bins):
    reference, new = PAIRS["tied"][0], PAIRS["shifted"][1]
    assert psi(column(spark, reference), column(spark, new), "v", bins).first()["psi"] == pytest.approx(
        brute_psi(reference, new, bins), abs=1e-9
    )


def test_ranges_do_not_change_the_result(spark):
    # 700 distinct values in one range, in two of unequal size, and in more the fewer a range may hold
    reference, new = PAIRS["shifted"]
    sides = [column(spark, side).withColumnRenamed("v", "value") for side in (reference, new)]
    tagged = drift_module._tagged(*sides)
    histogram = drift_module._histogram(tagged, "value")
    rows = [drift_module._numeric_drift(histogram, F.lit(0).cast("bigint"), 10).first()]
    rows.append(drift_module._numeric_drift(histogram, (F.col("value") > 6).cast("bigint"), 10).first())
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for ranges in (1, 7, 200):
            spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
            stored = drift_module._value_ranges(tagged)
            found = stored.select("_range").distinct().count()
            assert found == ranges if ranges == 1 else 0.5 * ranges <= found <= ranges
            rows.append(drift_module._numeric_drift(stored, F.col("_range"), 10).first())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for row in rows:  # sums of bins may differ in the last digit
        assert tuple(row) == pytest.approx(tuple(rows[0]), rel=1e-12)


def test_values_are_shuffled_once(spark):
    sides = [column(spark, side).withColumnRenamed("v", "value") for side in PAIRS["shifted"]]
    counted = drift_module._tagged(*sides).mapInArrow(drift_module._counted_locally, "value double, n_ref bigint, n_new bigint")
    ranged = drift_module._histogram(counted.repartitionByRange("value"), "value")
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def test_a_hot_value_is_counted_before_the_shuffle(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 0.0).otherwise(F.col("id").cast("double")).alias("value"))
    counted = drift_module._tagged(hot, hot).mapInArrow(drift_module._counted_locally, "value double, n_ref bigint, n_new bigint")
    assert counted.where("value = 0.0").count() < 100  # a row for each Arrow batch
    found = numeric_drift(hot, hot, "value").first()
    assert (found["n_ref"], found["n_new"], found["psi"], found["ks_stat"]) == (30_000, 30_000, 0.0, 0.0)


def test_psi_examples(spark):
    same, shifted = PAIRS["same"][0], PAIRS["shifted"]
    assert psi(column(spark, same), column(spark, same), "v").first()["psi"] < 0.01
    assert psi(column(spark, shifted[0]), column(spark, shifted[1]), "v").first()["psi"] > 0.25


def test_missing_values_take_no_part(spark):
    dirty = column(spark, [1, 2, 3, math.nan]).unionByName(spark.createDataFrame([(None,)], "v double"))
    row = numeric_drift(dirty, column(spark, [1, 2, 3]), "v").first()
    assert (row["n_ref"], row["n_new"], row["ks_stat"]) == (3, 3, 0.0)


def test_empty_sides(spark):
    some, none = column(spark, [1, 2]), column(spark, [])
    for reference, new in ((some, none), (none, some), (none, none)):
        row = numeric_drift(reference, new, "v").first()
        assert row["psi"] == 0.0 and row["ks_stat"] is None and row["ks_pvalue"] is None


def test_ks_pvalue(spark):
    def p(stat, n, m):
        return spark.range(1).select(ks_pvalue(F.lit(stat), F.lit(n), F.lit(m))).first()[0]

    # Kolmogorov distribution: Q(1.3581) = 0.05, Q(1.6276) = 0.01
    assert p(1.3581015157 / math.sqrt(500), 1000, 1000) == pytest.approx(0.05, abs=1e-6)
    assert p(1.6276236115 / math.sqrt(500), 1000, 1000) == pytest.approx(0.01, abs=1e-6)
    assert p(0.0, 10, 10) == 1.0 and p(1.0, 10**6, 10**6) == 0.0
    assert p(0.5, 5 * 10**9, 5 * 10**9) == 0.0
    assert 0.0 <= p(0.3 / math.sqrt(500), 1000, 1000) <= 1.0


def test_categorical_psi(spark):
    def frame(values):
        return spark.createDataFrame([(v,) for v in values], "c string")

    cases = [  # worked out by hand: twice (3/4 - 1/4) ln 3; a share that is missing counts as a millionth
        (["x"] * 6 + ["y"] * 2, ["y"] * 6 + ["x"] * 2, math.log(3)),
        (["x"] * 3, ["y"] * 2, 2 * (1 - 1e-6) * math.log(1e6)),
        (["x", "y"], ["y", "x"], 0.0),
    ]
    for reference, new, wanted in cases:
        found = categorical_psi(frame(reference + [None]), frame(new + [None, None]), "c").first()["psi"]
        assert found == pytest.approx(wanted, abs=1e-12)
    assert categorical_psi(frame([]), frame([]), "c").first()["psi"] == 0.0
    assert categorical_psi(frame(["P"]), frame([]), "c").first()["psi"] == pytest.approx((1e-6 - 1) * math.log(1e-6))


def texts(spark, values, label=None):
    return spark.createDataFrame([(v, label) for v in values], "text string, label string")


def test_text_length_drift(spark):
    row = text_length_drift(texts(spark, ["abc"] * 30), texts(spark, ["abcdefghij"] * 20)).first()
    # A constant reference puts every longer value into the top bin; the KS test sees the shift.
    assert (row["psi"], row["ks_stat"]) == (0.0, 1.0) and row["ks_pvalue"] < 1e-6
    assert (row["n_ref"], row["n_new"]) == (30, 20)


def test_missing_text_has_length_zero_and_characters_count_once(spark):
    row = text_length_drift(texts(spark, [None, "", "😀é"]), texts(spark, ["", "", "ab"])).first()
    assert row["ks_stat"] == 0.0


def test_long_texts_span_several_ranges(spark):
    reference = [int(n) for n in np.random.default_rng(4).integers(0, 40_000, 80)]
    new = [int(n) for n in np.random.default_rng(5).integers(0, 30_000, 60)]
    frames = [spark.createDataFrame([(n,) for n in side], "n int").select(F.repeat(F.lit("x"), F.col("n")).alias("text")) for side in (reference, new)]
    row = text_length_drift(*frames).first()
    assert row["psi"] == pytest.approx(brute_psi(reference, new), abs=1e-9)
    assert row["ks_stat"] == pytest.approx(brute_ks(np.array(reference), np.array(new)), abs=1e-12)


@pytest.mark.parametrize(
    "old,new,flag,label_psi",
    [
        ((["a", "bb"], "L"), (["bb", "a"], "L"), False, 0.0),
        ((["cc"], "L"), (["cc"], "M"), True, 2 * (1 - 1e-6) * math.log(1e6)),
        ((["d"], "L"), (["d" * 40], "L"), True, 0.0),
    ],
)
def test_drift_report(spark, old, new, flag, label_psi):
    sides = [texts(spark, values * 30, label) for values, label in (old, new)]
    row = drift_report(*sides, QualityParams()).first()
    assert row["drift_detected"] is flag and row["label_psi"] == pytest.approx(label_psi)


def test_drift_report_without_labels(spark):
    sides = [texts(spark, ["aa"] * 9).drop("label"), texts(spark, ["aa"] * 9, "NEG")]
    report = drift_report(*sides, QualityParams()).first()
    assert report["label_psi"] is None and report["drift_detected"] is False


def test_profiles_in_union_give_the_same_report(spark):
    old = [texts(spark, ["a", "bb", None, "x" * 40] * 9, "L"), texts(spark, ["cc"] * 5, "M"), texts(spark, [], "L")]
    new = texts(spark, ["d", "x" * 41] * 20, "M")
    rows = old[0].union(old[1])
    profile = drift_profile(old[0]).union(drift_profile(old[1])).union(drift_profile(old[2]))
    assert drift_against_profile(profile, new, QualityParams()).first() == drift_report(rows, new, QualityParams()).first()
    bare = drift_profile(rows.drop("label"))
    found = drift_against_profile(bare, new, QualityParams(), with_label=False).first()
    assert found == drift_report(rows.drop("label"), new, QualityParams()).first() and found["label_psi"] is None
    empty = drift_against_profile(profile.limit(0), new, QualityParams()).first()
    assert (empty["n_ref"], empty["length_psi"], empty["drift_detected"]) == (0, 0.0, empty["drift_detected"])


def test_ks_test_columns(spark):
    assert ks_test(column(spark, [1, 2]), column(spark, [1, 2]), "v").columns == ["ks_stat", "ks_pvalue"]


def test_approximate_drift_is_close(spark):
    rng = np.random.default_rng(8)
    for reference, new in ((rng.normal(0, 1, 3000), rng.normal(0.3, 1.2, 2500)), PAIRS["tied"], PAIRS["constant"]):
        sides = column(spark, reference), column(spark, new)
        exact, close = (numeric_drift(*sides, "v", accuracy=a).first() for a in (None, 10_000))
        assert (close["n_ref"], close["n_new"]) == (exact["n_ref"], exact["n_new"])
        assert close["psi"] == pytest.approx(exact["psi"], abs=0.02, rel=0.05)
        assert close["ks_stat"] == pytest.approx(exact["ks_stat"], abs=0.006)
    empty = column(spark, [])
    row = numeric_drift(empty, column(spark, [1.0]), "v", accuracy=100).first()
    assert (row["n_ref"], row["n_new"], row["psi"], row["ks_stat"]) == (0, 1, 0.0, None)
