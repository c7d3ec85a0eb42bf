"""Equi-join against a table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from glyphmill.sources.scratch import materialize


def join_keyed(many: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """Inner join of ``many`` with ``keyed``, which holds each key once.

    The keyed side is stored first (a job of its own), so the join has two plain
    inputs: Spark broadcasts the stored side if its measured bytes allow it;
    otherwise both are shuffled, and adaptive execution splits the partition of
    a very frequent key. ``many`` is computed once, in the job that reads the
    result.
    """
    return many.join(materialize(keyed, "keyed"), key)
