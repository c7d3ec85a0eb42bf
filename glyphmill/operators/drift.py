"""Drift between a reference batch and a new batch.

All statistics come from a histogram of distinct values, built with map-side
combining: a value that fills a third of the table is still one row. The
histogram is stored once, when the operator is called, so each batch is read once. Ordered work (quantiles,
distribution functions) runs on value ranges in parallel, so no task sees the
whole histogram. Only single numbers (totals, edges) come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.functions.numeric import nan_to_null
from glyphmill.functions.text import filled
from glyphmill.params import QualityParams
from glyphmill.sources.scratch import materialize

# Fixed value: the share that stands for an empty bin or category.
EPSILON = 1e-6
# Fixed value: default number of quantile bins.
DEFAULT_BINS = 10
# Distinct integer values per parallel range.
_INTEGER_RANGE = 4096
# Cuts at which the approximate distribution functions are compared.
_APPROXIMATE_CUTS = 200
_SERIES_TERMS = 100


def text_length(text: Column) -> Column:
    """Length in characters; missing text has length 0."""
    return F.length(filled(text))


def _tagged(reference: DataFrame, new: DataFrame) -> DataFrame:
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return reference.withColumns({"n_ref": one, "n_new": zero}).unionByName(
        new.withColumns({"n_ref": zero, "n_new": one})
    )


def _histogram(tagged: DataFrame, *keys: str) -> DataFrame:
    return tagged.groupBy(*keys).agg(F.sum("n_ref").alias("n_ref"), F.sum("n_new").alias("n_new"))


def _integer_range(value: Column) -> Column:
    return F.floor(value / _INTEGER_RANGE).cast("bigint")


def _position(value: Column, cuts: list[float], upper: bool) -> Column:
    """How many of the sorted cuts lie below ``value`` (with ``upper``: at or below).

    A balanced tree of comparisons: log2(n) steps per row, compiled code.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        beyond = value >= F.lit(cuts[middle]) if upper else value > F.lit(cuts[middle])
        return F.when(beyond, search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(cuts))


def _counted_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal values of an Arrow batch become one row."""
    for batch in batches:
        counts = pa.Table.from_batches([batch]).group_by("value").aggregate([("n_ref", "sum"), ("n_new", "sum")])
        yield from counts.rename_columns(["value", "n_ref", "n_new"]).to_batches()


def _value_ranges(tagged: DataFrame) -> DataFrame:
    """A histogram of ``value``, cut into sorted ranges, by a single shuffle of the values.

    Rows go to ranges of values and are counted where they arrive, as equal values
    meet in one range. A value that fills a third of the table would make one range
    long; it is counted within each batch before. The number of ranges is the
    session's number of shuffle partitions, less where Spark joins small ones. The
    result is stored, since the cut is sampled: whatever reads it, or is retried,
    sees the same ranges.
    """
    counted = tagged.mapInArrow(_counted_locally, "value double, n_ref bigint, n_new bigint")
    ranged = _histogram(counted.repartitionByRange("value"), "value")
    return materialize(ranged.withColumn("_range", F.spark_partition_id().cast("bigint")), "value-ranges")


def _running(histogram: DataFrame, value_range: Column) -> DataFrame:
    """Add inclusive running counts ``cum_ref, cum_new`` and totals ``all_ref, all_new``.

    Each range is summed on its own; the counts before a range come from a frame
    with one row per range: at most 2^31 / 4096 rows for integers, a row per shuffle
    partition otherwise. That makes it safe to broadcast.
    """
    ranged = histogram.withColumn("_range", value_range)
    totals = ranged.groupBy("_range").agg(F.sum("n_ref").alias("_ref"), F.sum("n_new").alias("_new"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("_ref").over(earlier), F.lit(0)).alias("_before_ref"),
        F.coalesce(F.sum("_new").over(earlier), F.lit(0)).alias("_before_new"),
        F.sum("_ref").over(everything).alias("all_ref"),
        F.sum("_new").over(everything).alias("all_new"),
    )
    inside = Window.partitionBy("_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumns(
            {"_in_ref": F.sum("n_ref").over(inside), "_in_new": F.sum("n_new").over(inside)}
        )
        .join(F.broadcast(offsets), "_range")
        .select(
            "value",
            "n_ref",
            "n_new",
            (F.col("_before_ref") + F.col("_in_ref")).alias("cum_ref"),
            (F.col("_before_new") + F.col("_in_new")).alias("cum_new"),
            "all_ref",
            "all_new",
        )
    )


def _statistics(running: DataFrame, bins: int) -> tuple[int, int, float | None, list[float]]:
    """``n_ref, n_new, ks_stat`` and the interior quantile edges of the reference.

    An edge interpolates between the values at two ranks. The pass keeps the
    rows that hold such a rank: at most two per edge.
    """
    shares = [i * (1.0 / bins) for i in range(1, bins)]
    gap = F.abs(
        F.try_divide(F.col("cum_ref"), F.col("all_ref")) - F.try_divide(F.col("cum_new"), F.col("all_new"))
    )

    def holds(rank: Column) -> Column:
        return (F.col("cum_ref") > rank) & (F.col("cum_ref") - F.col("n_ref") <= rank)

    def holds_edge(share: Column) -> Column:
        below = F.floor((F.col("all_ref") - 1) * share)
        return holds(below) | holds(below + 1)

    wanted = F.exists(F.array(*[F.lit(share) for share in shares]).cast("array<double>"), holds_edge)
    row = running.agg(
        F.max("all_ref").alias("ref_rows"),
        F.max("all_new").alias("new_rows"),
        F.max(gap).alias("ks_stat"),
        F.collect_list(F.when(wanted, F.struct("cum_ref", "value"))).alias("steps"),
    ).first()
    n_ref = row["ref_rows"] or 0
    steps = sorted((step["cum_ref"], float(step["value"])) for step in row["steps"])

    def value_at(rank: int) -> float:
        return next(value for cum, value in steps if cum > rank)

    def edge(share: float) -> float:
        position = (n_ref - 1) * share
        rank = math.floor(position)
        below, above, weight = value_at(rank), value_at(min(rank + 1, n_ref - 1)), position - rank
        # The nearer end is the base, which keeps the edge exact there.
        return above - (above - below) * (1 - weight) if weight >= 0.5 else below + (above - below) * weight

    return n_ref, row["new_rows"] or 0, row["ks_stat"], [edge(share) for share in shares] if n_ref else []


def ks_pvalue(stat: Column, n_ref: Column, n_new: Column) -> Column:
    """Two-sided p-value from the Kolmogorov limit distribution; null if a side is empty.

    Below 0.2 the series does not converge in 100 terms; the value there is 1.
    """
    n, m = n_ref.cast("double"), n_new.cast("double")
    scaled = stat * F.sqrt(F.try_divide(n * m, n + m))

    def add(total: Column, k: Column) -> Column:
        sign = F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return total + sign * F.exp(F.lit(-2.0) * k * k * scaled * scaled)

    series = F.lit(2.0) * F.aggregate(F.sequence(F.lit(1), F.lit(_SERIES_TERMS)), F.lit(0.0), add)
    clamped = F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    return F.when(scaled < 0.2, F.lit(1.0)).when(scaled.isNotNull(), clamped)


def _psi_sum(expected: Column, actual: Column) -> Column:
    return F.sum((actual - expected) * F.ln(actual / expected))


def _numeric_drift(histogram: DataFrame, value_range: Column, bins: int) -> DataFrame:
    """One row ``n_ref, n_new, psi, ks_stat, ks_pvalue`` from a stored histogram of ``value``."""
    all_ref, all_new, ks_stat, cuts = _statistics(_running(histogram, value_range), bins)
    n_ref, n_new = (F.lit(n).cast("bigint") for n in (all_ref, all_new))

    # Bins are [a, b): a value on tied edges belongs to the last of them. Bins that
    # neither batch reaches have equal shares and add nothing.
    bin_of = _position(F.col("value").cast("double"), cuts, upper=True)
    return _drift_row(histogram.withColumn("bin", bin_of), n_ref, n_new, ks_stat)


def _drift_row(binned: DataFrame, n_ref: Column, n_new: Column, ks_stat: float | None) -> DataFrame:
    counts, ks = _histogram(binned, "bin"), F.lit(ks_stat).cast("double")

    def share(part: str, total: Column) -> Column:
        raw = F.coalesce(F.try_divide(F.col(part), total), F.lit(0.0))
        return F.when(raw == 0.0, F.lit(EPSILON)).otherwise(raw)

    psi_value = F.when((n_ref == 0) | (n_new == 0), F.lit(0.0)).otherwise(F.col("psi"))
    return counts.agg(_psi_sum(share("n_ref", n_ref), share("n_new", n_new)).alias("psi")).select(
        n_ref.alias("n_ref"),
        n_new.alias("n_new"),
        psi_value.alias("psi"),
        ks.alias("ks_stat"),
        ks_pvalue(ks, n_ref, n_new).alias("ks_pvalue"),
    )


def numeric_drift(
    reference: DataFrame, new: DataFrame, column: str, bins: int = DEFAULT_BINS, accuracy: int | None = None
) -> DataFrame:
    """PSI over reference quantiles and the two-sample KS test of a numeric column.

    Missing values and NaN take no part. One row:
    ``n_ref, n_new, psi, ks_stat, ks_pvalue``.

    Exact by default, which stores every distinct value once. With ``accuracy``
    the reference's quantiles are approximate (off by at most ``1 / accuracy`` in
    rank) and the distribution functions are compared at 200 of them, so
    ``ks_stat`` may be too low by 1/200 and that error: two passes, and nothing
    is stored but counts per cut.
    """
    value = F.col(column).cast("double")
    sides = [side.select(nan_to_null(value).alias("value")).where("value IS NOT NULL") for side in (reference, new)]
    if accuracy is not None:
        return _approximate_drift(*sides, bins, accuracy)
    return _numeric_drift(_value_ranges(_tagged(*sides)), F.col("_range"), bins)


def _approximate_drift(reference: DataFrame, new: DataFrame, bins: int, accuracy: int) -> DataFrame:
    def quantiles(shares: list[float]) -> Column:
        return F.percentile_approx("value", shares, accuracy)

    fine = [i / _APPROXIMATE_CUTS for i in range(1, _APPROXIMATE_CUTS)]
    cuts, edges = reference.agg(quantiles(fine), quantiles([i / bins for i in range(1, bins)] or [0.5])).first()
    cuts, edges = sorted(set(cuts or [])), sorted(set(edges or [])) if bins > 1 else []
    all_cuts = sorted({*cuts, *edges})
    # between two cuts the cell is even, on a cut it is odd: the functions are compared before and at each cut
    value = F.col("value")
    cell = _position(value, all_cuts, upper=True) + _position(value, all_cuts, upper=False)
    counts = materialize(_histogram(_tagged(reference, new).withColumn("cell", cell), "cell"), "cells")
    totals = counts.agg(F.sum("n_ref"), F.sum("n_new")).first()
    n_ref, n_new = (F.lit(n or 0).cast("bigint") for n in totals)
    below = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)  # some hundred rows
    gap = F.abs(
        F.try_divide(F.sum("n_ref").over(below), n_ref) - F.try_divide(F.sum("n_new").over(below), n_new)
    )
    ks = counts.select(gap.alias("gap")).agg(F.max("gap")).first()[0]
    bin_of = {i: sum(edge <= cut for edge in edges) for i, cut in enumerate([-math.inf, *all_cuts])}
    lookup = F.create_map(*[F.lit(x) for pair in bin_of.items() for x in pair])
    return _drift_row(counts.withColumn("bin", F.element_at(lookup, F.ceil(F.col("cell") / 2).cast("int"))), n_ref, n_new, ks)


def psi(reference: DataFrame, new: DataFrame, column: str, bins: int = DEFAULT_BINS) -> DataFrame:
    """One row ``(psi)`` of a numeric column; 0.0 if either side is empty."""
    return numeric_drift(reference, new, column, bins).select("psi")


def ks_test(reference: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """One row ``(ks_stat, ks_pvalue)`` of a numeric column."""
    return numeric_drift(reference, new, column).select("ks_stat", "ks_pvalue")


def _categorical_psi(histogram: DataFrame, column: str) -> DataFrame:
    known = histogram.where(F.col(column).isNotNull())
    totals = known.agg(F.sum("n_ref").alias("_all_ref"), F.sum("n_new").alias("_all_new"))

    def share(part: str, total: str) -> Column:
        raw = F.coalesce(F.try_divide(F.col(part), F.col(total)), F.lit(0.0))
        return F.greatest(raw, F.lit(EPSILON))

    # one row of totals beside every category
    beside = known.withColumn("_one", F.lit(1)).join(F.broadcast(totals.withColumn("_one", F.lit(1))), "_one")
    summed = beside.agg(_psi_sum(share("n_ref", "_all_ref"), share("n_new", "_all_new")).alias("psi"))
    return summed.select(F.coalesce("psi", F.lit(0.0)).alias("psi"))


def categorical_psi(reference: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """One row ``(psi)`` over the categories of both sides; each share is at least 1e-6."""
    sides = [side.select(F.col(column).alias("category")) for side in (reference, new)]
    histogram = materialize(_histogram(_tagged(*sides), "category"), "categories")
    return _categorical_psi(histogram, "category")


def text_length_drift(reference: DataFrame, new: DataFrame, bins: int = DEFAULT_BINS) -> DataFrame:
    """PSI and KS test of the text length: ``n_ref, n_new, psi, ks_stat, ks_pvalue``."""
    sides = [side.select(text_length(F.col("text")).alias("value")) for side in (reference, new)]
    histogram = materialize(_histogram(_tagged(*sides), "value"), "lengths")
    return _numeric_drift(histogram, _integer_range(F.col("value")), bins)


def drift_profile(rows: DataFrame) -> DataFrame:
    """``length, label, n``: all a drift check needs of a batch; ``label`` is null without labels.

    Profiles of several batches in union are a profile of all, so it can be kept
    with each version of a table instead of reading the rows again.
    """
    label = F.col("label").cast("string") if "label" in rows.columns else F.lit(None).cast("string")
    lengths = rows.select(text_length(F.col("text")).alias("length"), label.alias("label"))
    return lengths.groupBy("length", "label").agg(F.count(F.lit(1)).alias("n"))


def drift_report(reference: DataFrame, new: DataFrame, quality: QualityParams) -> DataFrame:
    """One row with the length drift, the label drift and the overall flag.

    ``label_psi`` is null unless both sides have a ``label``. Lengths and labels
    are counted together, so each batch is read once.
    """
    with_label = "label" in reference.columns and "label" in new.columns
    return drift_between_profiles(drift_profile(reference), drift_profile(new), quality, with_label)


def drift_against_profile(
    profile: DataFrame, new: DataFrame, quality: QualityParams, with_label: bool = True
) -> DataFrame:
    """``drift_report`` of a new batch against a stored profile; reads the rows of the batch only.

    ``with_label=False`` for a profile of rows without labels.
    """
    return drift_between_profiles(profile, drift_profile(new), quality, with_label and "label" in new.columns)


def drift_between_profiles(
    reference: DataFrame, new: DataFrame, quality: QualityParams, with_label: bool
) -> DataFrame:
    """The report from the profiles of both sides."""

    def side(profile: DataFrame, ref: str, other: str) -> DataFrame:
        zero = F.lit(0).cast("bigint").alias(other)
        return profile.select(F.col("length").alias("value"), "label", F.col("n").alias(ref), zero)

    keys = ["value", "label"] if with_label else ["value"]
    tagged = side(reference, "n_ref", "n_new").unionByName(side(new, "n_new", "n_ref"))
    profile = materialize(_histogram(tagged, *keys), "profile")
    lengths = _histogram(profile, "value") if with_label else profile
    report = _numeric_drift(lengths, _integer_range(F.col("value")), DEFAULT_BINS)
    if with_label:
        label_value = F.lit(_categorical_psi(_histogram(profile, "label"), "label").first()["psi"])
    else:
        label_value = F.lit(None).cast("double")

    above = F.lit(float(quality.psi_threshold))
    length_drift = (F.col("length_psi") > above) | (
        F.col("length_ks_pvalue") < F.lit(float(quality.ks_pvalue_threshold))
    )
    label_drift = F.col("label_psi") > above
    return report.select(
        "n_ref",
        "n_new",
        F.col("psi").alias("length_psi"),
        F.col("ks_stat").alias("length_ks_stat"),
        F.col("ks_pvalue").alias("length_ks_pvalue"),
        label_value.alias("label_psi"),
    ).withColumn(
        "drift_detected",
        F.coalesce(length_drift, F.lit(False)) | F.coalesce(label_drift, F.lit(False)),
    )
