"""Confidence flags and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.numeric import nan_to_null
from glyphmill.sources.scratch import materialize


def is_low(confidence: Column, min_confidence: float) -> Column:
    """Strictly below the threshold; a missing or NaN confidence is not low."""
    return F.coalesce(nan_to_null(confidence) < F.lit(float(min_confidence)), F.lit(False))


def flag_low_confidence(rows: DataFrame, min_confidence: float) -> DataFrame:
    """Add the boolean ``low_confidence``."""
    return rows.withColumn("low_confidence", is_low(F.col("confidence"), min_confidence))


def _share(condition: Column) -> Column:
    return F.coalesce(F.avg(F.when(condition, 1.0).otherwise(0.0)), F.lit(0.0))


def summary_aggregates(columns: list[str], min_confidence: float) -> list[Column]:
    """The summary as aggregates, so that callers can put them into a pass of their own."""
    n = F.count(F.lit(1))
    mean = F.avg(nan_to_null(F.col("confidence")))
    aggregates = [
        n.alias("n"),
        F.when(n == 0, F.lit(0.0)).otherwise(F.coalesce(mean, F.lit(float("nan")))).alias("mean_confidence"),
        _share(is_low(F.col("confidence"), min_confidence)).alias("pct_low_confidence"),
    ]
    if "n_entities" in columns:
        aggregates += [
            _share(F.col("n_entities") > 0).alias("coverage"),
            F.coalesce(F.sum("n_entities"), F.lit(0)).cast("bigint").alias("total_entities"),
        ]
    return aggregates


def confidence_summary(rows: DataFrame, min_confidence: float) -> DataFrame:
    """One row: ``n, mean_confidence, pct_low_confidence`` and, for entity rows,
    ``coverage`` (share of rows with an entity) and ``total_entities``."""
    return rows.agg(*summary_aggregates(rows.columns, min_confidence))


def label_counts(rows: DataFrame) -> DataFrame:
    """``(label, n)``, most frequent first, without missing labels."""
    counted = rows.where(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "label")


def summary_report(rows: DataFrame, min_confidence: float) -> DataFrame:
    """The summary in long form, ``(metric, value)``; labels appear as ``label_counts.<label>``.

    Rows with labels are grouped by label first; the groups are stored and then
    combined, so the histogram and the totals come from one pass over the data.
    """
    conf = nan_to_null(F.col("confidence"))
    low = is_low(F.col("confidence"), min_confidence)
    has_label, has_entities = "label" in rows.columns, "n_entities" in rows.columns
    parts = [
        F.count(F.lit(1)).alias("n"),
        F.sum(conf).alias("conf_sum"),
        F.count(conf).alias("conf_n"),
        F.count_if(low).alias("n_low"),
    ]
    if has_entities:
        parts += [F.count_if(F.col("n_entities") > 0).alias("n_found"), F.sum("n_entities").alias("entities")]
    grouped = rows.groupBy(*(["label"] if has_label else [])).agg(*parts)
    if has_label:
        grouped = materialize(grouped, "summary")

    n = F.sum("n")

    def per_row(total: Column) -> Column:
        return F.coalesce(F.try_divide(total.cast("double"), n), F.lit(0.0))

    mean = F.try_divide(F.sum("conf_sum"), F.sum("conf_n"))
    empty = F.coalesce(n, F.lit(0)) == 0
    metrics = {
        "n": F.coalesce(n, F.lit(0)).cast("double"),
        "mean_confidence": F.when(empty, F.lit(0.0)).otherwise(F.coalesce(mean, F.lit(float("nan")))),
        "pct_low_confidence": per_row(F.sum("n_low")),
    }
    if has_entities:
        metrics["coverage"] = per_row(F.sum("n_found"))
        metrics["total_entities"] = F.coalesce(F.sum("entities"), F.lit(0)).cast("double")
    totals = grouped.agg(*[value.alias(name) for name, value in metrics.items()])
    lines = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name in metrics])
    report = totals.select(F.inline(lines))
    if has_label:
        labels = grouped.where(F.col("label").isNotNull()).select(
            F.concat(F.lit("label_counts."), F.col("label")).alias("metric"),
            F.col("n").cast("double").alias("value"),
        )
        report = report.unionByName(labels)
    return report
