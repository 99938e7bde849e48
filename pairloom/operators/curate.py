"""Row filters for annotations and what they removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.settings import MAX_READING_TIME_S, MIN_READING_TIME_S


def _clean_time(column: str = "reading_time_s") -> Column:
    return F.when(~F.isnan(column), F.col(column))


def _too_fast(minimum: float) -> Column:
    return F.coalesce(_clean_time() < F.lit(float(minimum)), F.lit(False))


def _too_slow(maximum: float) -> Column:
    return F.coalesce(_clean_time() > F.lit(float(maximum)), F.lit(False))


def drop_ties(df: DataFrame) -> DataFrame:
    """Keep rows marked as no tie; an unknown tie flag is not enough."""
    return df.where(F.col("is_tie") == 0)


def keep_plausible_reading_times(
    df: DataFrame, minimum: float = MIN_READING_TIME_S, maximum: float = MAX_READING_TIME_S
) -> DataFrame:
    """Bounds are inclusive; rows without a time stay, with NaN turned into null."""
    return df.where(~(_too_fast(minimum) | _too_slow(maximum))).withColumn("reading_time_s", _clean_time())


def usable_pairs(
    df: DataFrame, minimum: float = MIN_READING_TIME_S, maximum: float = MAX_READING_TIME_S
) -> DataFrame:
    return keep_plausible_reading_times(drop_ties(df), minimum, maximum)


def is_usable(minimum: float = MIN_READING_TIME_S, maximum: float = MAX_READING_TIME_S) -> Column:
    """Condition of ``usable_pairs`` for use inside an aggregation; never null."""
    return F.coalesce(F.col("is_tie") == 0, F.lit(False)) & ~(_too_fast(minimum) | _too_slow(maximum))


def filter_counts(
    minimum: float = MIN_READING_TIME_S, maximum: float = MAX_READING_TIME_S
) -> list[Column]:
    """Aggregates of one pass over raw rows; time counts refer to rows that are no tie."""
    kept = F.coalesce(F.col("is_tie") == 0, F.lit(False))
    fast, slow = _too_fast(minimum), _too_slow(maximum)
    return [
        F.count("*").alias("total_rows"),
        F.count_if(F.col("is_tie") == 1).alias("ties_removed"),
        F.count_if(F.col("is_tie").isNull()).alias("tie_unknown"),
        F.count_if(kept & (fast | slow)).alias("quality_filtered"),
        F.count_if(kept & fast).alias("too_fast"),
        F.count_if(kept & slow).alias("too_slow"),
        F.count_if(kept & ~(fast | slow)).alias("usable_pairs"),
    ]


def filter_statistics(
    df: DataFrame, minimum: float = MIN_READING_TIME_S, maximum: float = MAX_READING_TIME_S
) -> DataFrame:
    """One row: what the filters remove and what they leave."""
    return df.agg(*filter_counts(minimum, maximum))
