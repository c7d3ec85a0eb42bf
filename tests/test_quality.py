import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from glyphmill.operators.calibration import (
    confidence_bin,
    expected_calibration_error,
    pair_with_truth,
    reliability_against_truth,
    reliability_table,
)
from glyphmill.operators.inference import infer_batches
from glyphmill.operators.confidence import confidence_summary, flag_low_confidence, label_counts, summary_report

NAN = float("nan")


def confidences(spark, values):
    return spark.createDataFrame([(v,) for v in values], "confidence double")


def test_flag_is_strict_and_ignores_missing(spark):
    out = flag_low_confidence(confidences(spark, [0.9, 0.3, 0.5, NAN, None]), 0.5)
    assert [r["low_confidence"] for r in out.collect()] == [False, True, False, False, False]


def test_summary_of_labels(spark):
    frame = spark.createDataFrame([("POS", 0.9), ("POS", 0.4), ("NEG", 0.8), (None, NAN)], "label string, confidence double")
    row = confidence_summary(frame, 0.5).first()
    assert row["n"] == 4
    assert row["mean_confidence"] == pytest.approx(0.7) and row["pct_low_confidence"] == 0.25
    assert [tuple(r) for r in label_counts(frame).collect()] == [("POS", 2), ("NEG", 1)]
    report = {r["metric"]: r["value"] for r in summary_report(frame, 0.5).collect()}
    assert report == {
        "n": 4.0,
        "mean_confidence": pytest.approx(0.7),
        "pct_low_confidence": 0.25,
        "label_counts.POS": 2.0,
        "label_counts.NEG": 1.0,
    }


def test_summary_of_entities(spark):
    frame = spark.createDataFrame([(0, 0.0), (2, 0.9), (1, 0.8)], "n_entities int, confidence double")
    row = confidence_summary(frame, 0.5).first()
    assert row["coverage"] == pytest.approx(2 / 3) and row["total_entities"] == 3
    report = {r["metric"]: r["value"] for r in summary_report(frame, 0.5).collect()}
    assert report["coverage"] == pytest.approx(2 / 3) and report["total_entities"] == 3.0


def test_summary_of_nothing(spark):
    frame = spark.createDataFrame([], "n_entities int, label string, confidence double")
    assert tuple(confidence_summary(frame, 0.5).first()) == (0, 0.0, 0.0, 0.0, 0)
    report = {r["metric"]: r["value"] for r in summary_report(frame, 0.5).collect()}
    assert report == {"n": 0, "mean_confidence": 0, "pct_low_confidence": 0, "coverage": 0, "total_entities": 0}


def test_summary_of_missing_confidence_only(spark):
    assert math.isnan(confidence_summary(confidences(spark, [NAN, None]), 0.5).first()["mean_confidence"])


@pytest.mark.parametrize("n_bins", [1, 3, 7, 10, 49])
def test_bins_match_right_closed_edges(spark, n_bins):
    edges = np.linspace(0.0, 1.0, n_bins + 1)
    values = [0.0, 1.0, 0.1, 0.3, 0.30000000000000004, 0.7, 0.6, 1e-300, 0.999999, 1.2, -0.1, NAN]
    values += [float(e) for e in edges] + [float(np.nextafter(e, 2)) for e in edges] + [float(np.nextafter(e, -1)) for e in edges]
    values += np.random.default_rng(1).random(200).tolist()
    wanted = pd.cut(pd.Series(values), edges, include_lowest=True, labels=False)
    found = [r[0] for r in confidences(spark, values).select(confidence_bin(F.col("confidence"), n_bins)).collect()]
    assert found == [None if np.isnan(w) else int(w) + 1 for w in wanted]


def test_reliability_by_counting(spark):
    """Confidences in hundredths, binned by whole-number arithmetic."""
    rng = np.random.default_rng(21)
    cents, hits = rng.integers(0, 101, 700).tolist(), rng.integers(0, 2, 700).tolist()
    table = reliability_table(
        spark.createDataFrame([(c / 100, h) for c, h in zip(cents, hits, strict=True)], "confidence double, correct int")
    )
    members = {}
    for c, h in zip(cents, hits, strict=True):
        members.setdefault(max(1, -(-c // 10)), []).append((c, h))
    found = {r["bin"]: r for r in table.collect()}
    assert set(found) == set(members)
    weighted = 0.0
    for index, own in members.items():
        mean, accuracy = sum(c for c, _ in own) / len(own) / 100, sum(h for _, h in own) / len(own)
        assert found[index]["n"] == len(own)
        assert found[index]["mean_confidence"] == pytest.approx(mean)
        assert found[index]["accuracy"] == pytest.approx(accuracy)
        weighted += len(own) * abs(mean - accuracy)
    assert expected_calibration_error(table).first()["ece"] == pytest.approx(weighted / 700)


@pytest.mark.parametrize("rows,ece", [([(0.6, 1)] * 3 + [(0.6, 0)] * 2, 0.0), ([(0.25, 1)] * 8, 0.75), ([(1.0, 0), (0.0, 1)], 1.0)])
def test_calibration_error_examples(spark, rows, ece):
    frame = spark.createDataFrame(rows, "confidence double, correct int")
    assert expected_calibration_error(reliability_table(frame)).first()["ece"] == pytest.approx(ece)


def test_calibration_error_of_nothing_and_outside_values(spark):
    empty = spark.createDataFrame([], "confidence double, correct int")
    assert tuple(expected_calibration_error(reliability_table(empty)).first()) == (0, 0.0)
    frame = spark.createDataFrame([(1.2, 1), (-0.1, 1), (0.5, 1)], "confidence double, correct int")
    assert tuple(expected_calibration_error(reliability_table(frame)).first()) == (1, 0.5)


LABELLED = "id string, label string, confidence double"
TRUTH = "id string, truth string"


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_truth_join(spark, broadcast_limit, limit):
    broadcast_limit(limit)
    rows = [("a", "POS", 0.9), ("a", "NEG", 0.9), ("b", "POS", 0.2), ("c", "POS", 0.3)] + [("hot", "POS", 0.8)] * 40
    predictions = spark.createDataFrame(rows, LABELLED)
    truth = spark.createDataFrame([("a", "POS"), ("a", "POS"), ("b", "NEG"), ("hot", "POS"), ("z", "POS"), ("c", None)], TRUTH)
    pairs = pair_with_truth(predictions.repartition(8), truth)
    assert pairs.columns == ["id", "label", "confidence", "correct"]
    hits = [("a", "POS", True), ("a", "NEG", False), ("b", "POS", False)] + [("hot", "POS", True)] * 40
    assert sorted((r["id"], r["label"], r["correct"]) for r in pairs.collect()) == sorted(hits)


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_a_missing_label_is_a_miss(spark, broadcast_limit, limit):
    broadcast_limit(limit)
    predictions = spark.createDataFrame([("a", "POS", 0.5), ("b", None, 0.5), ("c", "POS", 0.5)], LABELLED)
    truth = spark.createDataFrame([("a", "POS"), ("b", "POS"), ("c", "POS")], TRUTH)
    for table in (reliability_against_truth(predictions, truth), reliability_table(pair_with_truth(predictions, truth))):
        row = table.first()
        assert row["n"] == 3 and row["accuracy"] == pytest.approx(2 / 3)


def test_the_model_runs_once_before_the_truth_join(spark, corpus, broadcast_limit):
    broadcast_limit("-1")
    predictions = infer_batches(corpus(["bueno", "malo"] * 20), "sentiment", mode="mock")
    truth = spark.createDataFrame([(str(i), "POS") for i in range(30)], TRUTH)
    pairs = pair_with_truth(predictions, truth)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "SinglePartition" not in plan and "Broadcast" not in plan
    assert pairs.count() == 30


def test_a_hot_key_is_split(spark, broadcast_limit):
    broadcast_limit("-1")
    names = {"skewedPartitionThresholdInBytes": "16k", "skewedPartitionFactor": "2"}
    for name, value in names.items():
        spark.conf.set(f"spark.sql.adaptive.skewJoin.{name}", value)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 10 = 0, string(id), 'hot') as id", "'POS' as label", "rand(7) as confidence"
    )
    truth = spark.range(2000).selectExpr("string(id) as id", "'POS' as truth").unionByName(
        spark.createDataFrame([("hot", "NEG")], TRUTH)
    )
    pairs = pair_with_truth(rows, truth)
    assert pairs.count() == 54_000 + 200
    pairs.write.format("noop").mode("overwrite").save()
    counted = pairs.groupBy("correct").count()
    counted.collect()
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    for name in names:
        spark.conf.unset(f"spark.sql.adaptive.skewJoin.{name}")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_contradicting_truth_fails(spark):
    predictions = spark.createDataFrame([("a", "POS", 0.9)], LABELLED)
    truth = spark.createDataFrame([("a", "POS"), ("a", "NEG")], TRUTH)
    with pytest.raises(Exception, match="contradicting truth"):
        pair_with_truth(predictions, truth).collect()
