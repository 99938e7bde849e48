"""Exact median of a large column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 20_000
MARGIN = 4.0 / SKETCH_ACCURACY
ORDERED_IN_ONE_TASK = 5_000_000


def bracket_around(value: Column, shares: tuple[float, float]) -> Column:
    """Aggregate struct(low, high, n): sketched quantiles at two shares, and the count.

    The rank error of the sketch is n / accuracy. Null and NaN are skipped.
    """
    value = F.when(~F.isnan(value), value)
    q = F.percentile_approx(value, [min(max(s, 0.0), 1.0) for s in shares], SKETCH_ACCURACY)
    return F.struct(q[0].alias("low"), q[1].alias("high"), F.count(value).alias("n"))


def median_bracket(value: Column) -> Column:
    return bracket_around(value, (0.5 - MARGIN, 0.5 + MARGIN))


def exact_median(df: DataFrame, column: str, bracket: tuple | None = None) -> float | None:
    """Interpolated median without gathering the column in one task.

    A sketch brackets the middle (``bracket`` takes one from an earlier pass), and the next pass
    orders the distinct values inside the bracket. While the bracket holds too many rows it is
    narrowed by a sketch of its own rows; should it miss the middle, it is widened.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    margin = MARGIN
    low, high, n = bracket or values.agg(median_bracket(F.col("v")).alias("b")).first()["b"]
    if n == 0:
        return None
    ranks = ((n + 1) // 2, n // 2 + 1)
    while True:
        if n * margin * 4 > ORDERED_IN_ONE_TASK:
            low, high = _narrowed(values, low, high, ranks)
        found = _values_at(values, low, high, ranks)
        if margin >= 0.5 or None not in found and float("-inf") not in found:
            return sum(found) / 2
        margin *= 8
        shares = (0.5 - margin, 0.5 + margin)
        low, high, _ = values.agg(bracket_around(F.col("v"), shares).alias("b")).first()["b"]


def _narrowed(values: DataFrame, low: float, high: float, ranks: tuple[int, int]) -> tuple[float, float]:
    """Shrink a bracket that holds the ranks until few rows or one value are left in it."""
    while low < high:
        within = (F.col("v") >= low) & (F.col("v") <= high)
        row = values.agg(F.count_if(F.col("v") < low).alias("below"), F.count_if(within).alias("inside")).first()
        below, inside = row["below"], row["inside"]
        if inside <= ORDERED_IN_ONE_TASK or ranks[0] <= below or ranks[1] > below + inside:
            break
        shares = tuple((rank - below) / inside + shift for rank, shift in zip(ranks, (-MARGIN, MARGIN)))
        b = values.where(within).agg(bracket_around(F.col("v"), shares).alias("b")).first()["b"]
        if (b["low"], b["high"]) == (low, high):
            break
        low, high = b["low"], b["high"]
    return low, high


def _values_at(values: DataFrame, low: float, high: float, ranks: tuple[int, int]) -> tuple:
    """Values at two ranks; all values below the bracket count as one value of -infinity."""
    inside = F.when(F.col("v") < low, F.lit(float("-inf"))).otherwise(F.col("v"))
    counted = values.where(F.col("v") <= high).groupBy(inside.alias("v")).agg(F.count("*").alias("c"))
    in_order = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("through", F.sum("c").over(in_order))
    return tuple(placed.agg(*[F.min(F.when(F.col("through") >= r, F.col("v"))) for r in ranks]).first())
