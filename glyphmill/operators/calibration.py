"""Reliability of the confidence against known truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.numeric import nan_to_null
from glyphmill.operators.joins import join_keyed


def confidence_bin(confidence: Column, n_bins: int) -> Column:
    """1-based index of the right-closed bin ``(lo, hi]``; 0.0 joins the first bin.

    Null outside [0, 1]. The edges are ``i * (1 / n)`` with the last exactly
    1.0; the arithmetic guess can be one bin off an edge, which is corrected by
    comparing with the edges themselves.
    """
    step = 1.0 / n_bins

    def edge(i: Column) -> Column:
        return F.when(i >= n_bins, F.lit(1.0)).otherwise(i * F.lit(step))

    guess = F.least(F.greatest(F.ceil(confidence * n_bins), F.lit(1)), F.lit(n_bins))
    too_high = (guess > 1) & (confidence <= edge(guess - 1))
    too_low = (guess < n_bins) & (confidence > edge(guess))
    exact = guess - F.when(too_high, 1).otherwise(0) + F.when(too_low, 1).otherwise(0)
    return F.when(confidence.between(0.0, 1.0), exact.cast("int"))


def reliability_table(rows: DataFrame, n_bins: int = 10) -> DataFrame:
    """``(bin, mean_confidence, accuracy, n)`` over the observed bins.

    ``rows`` holds ``confidence`` and ``correct`` (boolean or 0/1). A missing
    ``correct`` counts in ``n`` and in the mean confidence, not in the accuracy.
    """
    binned = rows.withColumn("bin", confidence_bin(F.col("confidence"), n_bins))
    # Rows outside [0, 1] form a group of their own with n = 0. It is dropped last:
    # a filter on the bin would move below the model and run it a second time.
    return (
        binned.groupBy("bin")
        .agg(
            F.avg(F.when(F.col("bin").isNotNull(), F.col("confidence"))).alias("mean_confidence"),
            F.avg(nan_to_null(F.col("correct").cast("double"))).alias("accuracy"),
            F.count("bin").alias("n"),
        )
        .where(F.col("n") > 0)
    )


def truth_by_id(truth: DataFrame) -> DataFrame:
    """One truth per id from ``(id, truth)``. Repeats collapse, contradictions fail the job, a null is no truth."""
    low, high = F.min("truth"), F.max("truth")
    known = truth.where(F.col("truth").isNotNull())
    return known.groupBy("id").agg(low.alias("truth"), (low != high).alias("_split")).select(
        "id",
        F.when(
            F.col("_split"), F.raise_error(F.concat(F.lit("contradicting truth for id "), F.col("id")))
        ).otherwise(F.col("truth")).alias("truth"),
    )


def pair_with_truth(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Predictions that have a known truth, with ``correct``; ids without truth drop out.

    A missing label against a known truth is a miss. The truth, one row per id,
    is stored when this is called; the predictions are computed once, later.
    """
    joined = join_keyed(predictions, truth_by_id(truth), "id")
    return joined.withColumn("correct", F.col("label").eqNullSafe(F.col("truth"))).drop("truth")


def reliability_against_truth(predictions: DataFrame, truth: DataFrame, n_bins: int = 10) -> DataFrame:
    """``reliability_table`` of ``(id, label, confidence)`` rows against ``(id, truth)``."""
    needed = predictions.select("id", "label", "confidence")
    return reliability_table(pair_with_truth(needed, truth), n_bins)


def expected_calibration_error(reliability: DataFrame) -> DataFrame:
    """One row ``(n, ece)`` from a reliability table; 0.0 when nothing was binned."""
    gap = F.abs(F.col("mean_confidence") - F.col("accuracy"))
    return reliability.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.try_divide(F.sum(F.col("n") * gap), F.sum("n")), F.lit(0.0)).alias("ece"),
    )
