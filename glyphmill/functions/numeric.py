"""Number expressions that keep the exact results of IEEE double arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphmill.functions.arrays import bind

# Fixed value: scores carry four decimal places.
_PLACES = 4


def round_exact(value: Column) -> Column:
    """Round to four places by the exact binary value, ties to even.

    Spark's ``round`` looks at the shortest decimal rendering, so 0.90245 becomes
    0.9025 although the stored double lies below the tie. Here the double is
    first made a whole number by a power of two, which is exact, and whole
    numbers round without error. Small values get a larger power, so that all
    their bits count. The whole part is set aside first; from 2^39 on a double
    is nearer to itself than to any other with four places.
    """
    ten = 10**_PLACES

    def units(x: Column, bits: int) -> Column:
        divisor = F.lit(str(2 ** (bits + 1))).cast("decimal(22,0)")
        half = F.lit(str(2**bits)).cast("decimal(22,0)")

        def nearest(shifted: Column) -> Column:
            half_up = F.call_function("div", shifted, divisor)
            is_tie = (shifted % divisor) == F.lit(0)
            return half_up - F.when(is_tie, half_up % 2).otherwise(F.lit(0))

        whole = (F.abs(x) * F.lit(2.0**bits)).cast("bigint").cast("decimal(20,0)")
        return bind(whole * F.lit(2 * ten).cast("decimal(10,0)") + half, nearest)

    def rounded(x: Column) -> Column:
        whole = F.floor(F.abs(x))
        part = F.when(F.abs(x) < F.lit(2.0**-9), units(x, 71)).otherwise(units(F.abs(x) - whole, 62))
        magnitude = whole.cast("double") * F.lit(float(ten)) + part.cast("double")
        return F.when(F.abs(x) < F.lit(2.0**39), F.signum(x) * (magnitude / F.lit(float(ten)))).otherwise(x)

    return bind(value, rounded)


def compensated_sum(values: Column) -> Column:
    """Sum of a double array that carries the rounding error along (Neumaier)."""

    def step(acc: Column, x: Column) -> Column:
        total = acc["total"] + x
        lost = F.when(F.abs(acc["total"]) >= F.abs(x), (acc["total"] - total) + x).otherwise(
            (x - total) + acc["total"]
        )
        return F.struct(total.alias("total"), (acc["lost"] + lost).alias("lost"))

    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("lost"))
    return F.aggregate(values, start, step, lambda acc: acc["total"] + acc["lost"])


def nan_to_null(value: Column) -> Column:
    """NaN counts as missing in every statistic here; Spark's ``avg`` would keep it."""
    return F.when(~F.isnan(value), value)
