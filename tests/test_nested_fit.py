"""Models of nested samples: against separate fits, another engine and odd inputs."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_preference_model import pairs

from pairloom.operators import nested_fit
from pairloom.operators import preference_model as model
from pairloom.operators.subsample import fraction_membership
from pairloom.settings import PreferenceModelSettings

SETTINGS = PreferenceModelSettings(num_buckets=6, reg_param=0.01, portable_hash=True)


def sampled(spark, fractions, n=240, settings=SETTINGS):
    features = model.pair_features(pairs(spark, n), settings).select("pair_id", "prompt_category", "difference")
    return fraction_membership(features, fractions, settings.seed).persist()


def test_equals_separate_fits_with_no_more_passes(spark, monkeypatch):
    fractions = (0.2, 0.5, 1.0)
    rows = sampled(spark, fractions)
    calls = []
    real = nested_fit._pass
    monkeypatch.setattr(nested_fit, "_pass", lambda *a: calls.append(1) or real(*a))
    together = nested_fit.fit_nested(rows, fractions, 7, 0.01)
    assert len(calls) == together.passes
    alone = [nested_fit.fit_nested(rows, (f,), 7, 0.01) for f in fractions]
    assert together.passes == max(fit.passes for fit in alone)
    for k, fit in enumerate(alone):
        assert np.allclose(together.weights[k], fit.weights[0], atol=1e-9)
        assert together.pairs[k] == fit.pairs[0]
    assert together.pairs.tolist() == [48, 120, 240]
    assert np.abs(together.gradient).max() < 1e-10


def test_gradient_is_zero_by_another_engine(spark):
    """SQL from texts to gradient, at the weights that came out."""
    df = pairs(spark, 200)
    fit = model.fit_fractions(df, (0.4, 1.0), SETTINGS)
    texts = df.select("pair_id", "chosen", "rejected").toPandas()  # noqa: F841
    weights = fit.table(spark).where("fraction = 1").select("feature", "weight").toPandas()  # noqa: F841
    rows = duckdb.sql(
        """
WITH tokens AS (
  SELECT pair_id, 1 AS side, unnest(string_split(chosen, ' ')) AS t FROM texts
  UNION ALL SELECT pair_id, -1, unnest(string_split(rejected, ' ')) FROM texts),
x AS (
  SELECT pair_id, feature, sum(side) AS d FROM (
    SELECT pair_id, side, CAST('0x' || substr(md5(t), 1, 4) AS INTEGER) % 6 AS feature FROM tokens
    UNION ALL SELECT pair_id, side, 6 FROM tokens) GROUP BY ALL),
margins AS (SELECT pair_id, sum(d * weight) AS m FROM x JOIN weights USING (feature) GROUP BY pair_id)
SELECT feature, -sum(d / (1 + exp(m))) / 200 + 0.01 * any_value(weight) * sum(d * d) / 200
FROM x JOIN margins USING (pair_id) JOIN weights USING (feature) GROUP BY feature"""
    ).fetchall()
    assert len(rows) >= 5
    assert all(abs(g) < 1e-8 for _, g in rows)


def test_turned_pairs_and_scaled_features_change_nothing(spark):
    rows = sampled(spark, (1.0,))
    plain = nested_fit.fit_nested(rows, (1.0,), 7, 0.01)
    scaled = rows.withColumn("difference", F.transform("difference", lambda x: x * 1000.0))
    assert np.allclose(nested_fit.fit_nested(scaled, (1.0,), 7, 0.01).weights * 1000, plain.weights, atol=1e-8)
    turned = rows.withColumn("difference", F.transform("difference", lambda x: -x))
    assert np.allclose(nested_fit.fit_nested(turned, (1.0,), 7, 0.01).weights, -plain.weights, atol=1e-8)


def test_separable_pairs_end_at_a_finite_solution(spark):
    rows = spark.createDataFrame([([float(i % 3 + 1), 0.0], [1.0]) for i in range(30)], "difference array<double>, fractions array<double>")
    fit = nested_fit.fit_nested(rows, (1.0,), 2, 1e-3)
    assert 0 < fit.weights[0, 0] < 50 and fit.weights[0, 1] == 0
    assert np.abs(fit.gradient).max() < 1e-10


def test_no_rows(spark):
    rows = spark.createDataFrame([], "difference array<double>, fractions array<double>")
    fit = nested_fit.fit_nested(rows, (0.5, 1.0), 3, 0.01)
    assert fit.pairs.tolist() == [0, 0] and not fit.weights.any() and fit.passes == 1
    assert fit.table(spark).count() == 6
    with pytest.raises(ValueError, match="features"):
        nested_fit.fit_nested(rows, (1.0,), 10_000, 0.01)
