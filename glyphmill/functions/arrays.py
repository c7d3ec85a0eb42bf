"""Array expressions Spark has no built-in for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Values summed per block in `running_sum`.
_BLOCK = 64


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in ``body``.

    The optimiser merges chained projections, which would copy a costly
    expression into a lambda and run it again for every array element. A lambda
    variable keeps the value fixed.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def with_fixed(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once, whatever is done with it later.

    A filter on a computed column normally moves below the projection, where the
    value is computed a second time, and even below a shuffle that was to spread
    the work. A generator is a border for such filters only: those on other
    columns still move below it. One array of one element gives one row.
    """
    return frame.select("*", F.explode_outer(F.array(value)).alias(name))


def _running_sum_block(values: Column) -> Column:
    empty = F.array().cast("array<int>")
    return F.aggregate(
        values,
        F.struct(F.lit(0).alias("total"), empty.alias("sums")),
        lambda acc, x: F.struct(
            (acc["total"] + x).alias("total"),
            F.concat(acc["sums"], F.array(acc["total"] + x)).alias("sums"),
        ),
        lambda acc: acc["sums"],
    )


def running_sum(values: Column) -> Column:
    """Inclusive running sums of an int array.

    Appending to an array copies it, so one pass over n values costs n² copies.
    Summing blocks first and then shifting each block by the total before it
    keeps the cost close to linear, however long one row's array is.
    """

    def shift(blocks: Column) -> Column:
        block_totals = _running_sum_block(F.transform(blocks, lambda block: F.element_at(block, -1)))
        return bind(
            block_totals,
            lambda totals: F.flatten(
                F.transform(
                    blocks,
                    lambda block, i: bind(
                        F.when(i == 0, F.lit(0)).otherwise(F.get(totals, i - 1)),
                        lambda before: F.transform(block, lambda x: x + before),
                    ),
                )
            ),
        )

    def sums(xs: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(xs), F.lit(_BLOCK))
        blocks = F.transform(starts, lambda start: _running_sum_block(F.slice(xs, start, F.lit(_BLOCK))))
        return F.when(F.size(xs) == 0, F.array().cast("array<int>")).otherwise(bind(blocks, shift))

    return bind(values, sums)
