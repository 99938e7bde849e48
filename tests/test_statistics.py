"""Golden values of the statistical functions."""

import pytest
from pyspark.sql import functions as F

from pairloom.functions.statistics import (
    is_nearest_target,
    normal_quantile,
    percent_label,
    perplexity,
    required_sample_size,
    total_sample_size,
    wilson_interval,
)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "p,z",
    [(0.95, 1.645211440143815), (0.80, 0.8414567173547837), (0.975, 1.9603949169253396), (0.5, -1.01e-07)],
)
def test_normal_quantile(spark, p, z):
    assert value(spark, normal_quantile(p)) == pytest.approx(z, abs=1e-9)
    if p > 0.5:
        assert value(spark, normal_quantile(1 - p)) == pytest.approx(-z, abs=1e-9)


@pytest.mark.parametrize("p", [0.0, 1.0, -0.1, 1.1])
def test_normal_quantile_domain(spark, p):
    with pytest.raises(Exception, match="p must be in"):
        value(spark, normal_quantile(p))


@pytest.mark.parametrize(
    "p,needed,total",
    [(0.55, 617, 1234), (0.6, 153, 306), (0.65, 67, 134), (0.7, 37, 74), (0.75, 23, 46), (0.8, 15, 30)],
)
def test_sample_sizes(spark, p, needed, total):
    n = required_sample_size(p)
    assert value(spark, n) == needed
    assert value(spark, total_sample_size(n, 0.5)) == total


def test_sample_size_at_chance(spark):
    assert value(spark, required_sample_size(0.5)) == -1
    assert value(spark, total_sample_size(required_sample_size(0.4), 0.5)) == -1


@pytest.mark.parametrize(
    "p,n,low,high",
    [
        (0.7, 100, 0.6041496156718804, 0.7810524613377188),
        (0.5, 40, 0.35199278797099753, 0.6480072120290025),
        (1.0, 10, 0.7224598312333834, 1.0),
        (0.0, 10, 0.0, 0.2775401687666165),
        (None, 0, 0.0, 1.0),
    ],
)
def test_wilson(spark, p, n, low, high):
    interval = value(spark, wilson_interval(F.lit(p).cast("double"), F.lit(n)))
    assert interval.low == pytest.approx(low, abs=1e-12) and interval.high == pytest.approx(high, abs=1e-12)


def test_small_ones(spark):
    import math

    assert value(spark, perplexity(F.lit(25.0), 20.0)) == pytest.approx(math.exp(20))
    assert value(spark, percent_label(F.lit(0.55))) == "55%"
    assert value(spark, is_nearest_target(F.lit(0.6), F.lit(0.62))) is True
    assert value(spark, is_nearest_target(F.lit(0.6), F.lit(None).cast("double"))) is False
