"""Small-sample statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.settings import ALPHA, NEAREST_TARGET_WITHIN, POWER, WILSON_Z

# Rational approximation 26.2.23 of Abramowitz and Stegun.
QUANTILE_NUMERATOR = (2.515517, 0.802853, 0.010328)
QUANTILE_DENOMINATOR = (1.0, 1.432788, 0.189269, 0.001308)


def _as_double(value: Column | float) -> Column:
    return (value if isinstance(value, Column) else F.lit(float(value))).cast("double")


def _polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    result = F.lit(coefficients[-1])
    for coefficient in reversed(coefficients[:-1]):
        result = result * x + F.lit(coefficient)
    return result


def normal_quantile(p: Column | float) -> Column:
    """Inverse normal CDF; an error outside the open interval (0, 1)."""
    p = _as_double(p)
    tail = F.when(p < 0.5, p).otherwise(F.lit(1.0) - p)
    t = F.sqrt(F.lit(-2.0) * F.log(tail))
    size = t - _polynomial(QUANTILE_NUMERATOR, t) / _polynomial(QUANTILE_DENOMINATOR, t)
    error = F.raise_error(F.concat(F.lit("p must be in (0, 1), got "), p.cast("string")))
    return (
        F.when((p <= 0) | (p >= 1) | F.isnan(p), error.cast("double"))
        .when(p < 0.5, -size)
        .otherwise(size)
    )


def required_sample_size(accuracy: Column | float, alpha: float = ALPHA, power: float = POWER) -> Column:
    """Validation pairs needed to tell an accuracy from chance; -1 at or below chance."""
    p = _as_double(accuracy)
    spread = normal_quantile(1.0 - alpha) * F.lit(0.5) + normal_quantile(power) * F.sqrt(p * (F.lit(1.0) - p))
    root = spread / (p - F.lit(0.5))
    return F.when(p <= 0.5, F.lit(-1).cast("bigint")).when(p.isNotNull(), F.ceil(root * root))


def total_sample_size(validation_pairs: Column, validation_ratio: float) -> Column:
    """Pairs to collect so that the validation share reaches the needed number."""
    return F.when(
        validation_pairs > 0, F.ceil(validation_pairs.cast("double") / F.lit(float(validation_ratio)))
    ).otherwise(F.lit(-1).cast("bigint"))


def wilson_interval(accuracy: Column, n: Column, z: float = WILSON_Z) -> Column:
    """Wilson score interval as struct(low, high); (0, 1) without observations."""
    p, count = _as_double(accuracy), n.cast("double")
    z2 = z * z
    scale = F.lit(1.0) + F.lit(z2) / count
    center = (p + F.lit(z2) / (count * 2)) / scale
    reach = F.lit(z) * F.sqrt((p * (F.lit(1.0) - p) + F.lit(z2) / (count * 4)) / count) / scale
    return F.when(n == 0, F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))).otherwise(
        F.struct(
            F.greatest(F.lit(0.0), center - reach).alias("low"),
            F.least(F.lit(1.0), center + reach).alias("high"),
        )
    )


def includes_chance(interval: Column) -> Column:
    return interval["low"] <= 0.5


def is_nearest_target(target: Column, observed: Column) -> Column:
    return F.coalesce(F.abs(target - observed) < NEAREST_TARGET_WITHIN, F.lit(False))


def percent_label(value: Column, decimals: int = 0) -> Column:
    return F.format_string(f"%.{decimals}f%%", value * 100)


def perplexity(loss: Column, max_loss: float) -> Column:
    return F.exp(F.least(loss, F.lit(float(max_loss))))


def is_win(margin: Column) -> Column:
    """Strictly positive margin; NaN is not a win although Spark orders it above all numbers."""
    return (margin > 0) & ~F.isnan(margin)
