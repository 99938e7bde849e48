"""The linear preference model on small pairs."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pairloom.operators import preference_model as model
from pairloom.operators.evaluate import pairwise_evaluation
from pairloom.plans.curve import run_learning_curve
from pairloom.settings import PreferenceModelSettings


def pairs(spark, n=160, seed=1):
    rng = random.Random(seed)
    words = ["red", "blue", "green", "stone", "river", "cloud"]
    rows = []
    for i in range(n):
        plain = " ".join(rng.choices(words, k=rng.randint(3, 12)))
        better = " ".join(rng.choices(words, k=rng.randint(3, 12))) + " indeed" * rng.randint(1, 3)
        rows.append((i, "ab"[i % 2], f"q{i % 40}", "question", better, plain, 0, 9.0))
    schema = (
        "pair_id long, prompt_category string, prompt_id string, prompt string, chosen string, "
        "rejected string, is_tie int, reading_time_s double"
    )
    return spark.createDataFrame(rows, schema)


def accuracy(spark, fitted, df):
    scored = model.score_with_model(df, fitted, {"chosen": "chosen_score", "rejected": "rejected_score"})
    return pairwise_evaluation(scored).first().pairwise_accuracy


def test_separable_pairs_are_learned_and_repeatable(spark):
    train, held_out = pairs(spark, seed=1), pairs(spark, seed=2)
    first = model.fit_preferences(model.pair_features(train))
    second = model.fit_preferences(model.pair_features(train))
    assert accuracy(spark, first, held_out) > 0.9
    assert accuracy(spark, first, held_out) == accuracy(spark, second, held_out)
    assert np.allclose(first.coefficients.toArray(), second.coefficients.toArray())


def test_fit_matches_newton(spark):
    """The same regularised likelihood, solved on the driver for a small fixture."""
    settings = PreferenceModelSettings(num_buckets=4, max_iter=200, tolerance=1e-12, reg_param=0.1)
    features = model.pair_features(pairs(spark), settings)
    fitted = model.fit_preferences(features, settings)
    rows = model._oriented(features, model.row_key(features, settings.seed)).select(
        vector_to_array("features").alias("x"), "label"
    ).collect()
    x = np.array([r.x for r in rows])
    y = np.array([r.label for r in rows])
    scale = x.std(axis=0, ddof=1)
    used = scale > 0
    z = x[:, used] / scale[used]
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        gradient = z.T @ (p - y) / len(y) + 0.1 * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    assert np.allclose(fitted.coefficients.toArray()[used] * scale[used], w, atol=1e-5)


def test_features_count_all_words(spark):
    df = spark.createDataFrame([(1, "a b a", ""), (2, None, " c\n")], "pair_id long, chosen string, rejected string")
    rows = {r.pair_id: r.difference for r in model.pair_features(df).collect()}
    assert len(rows[1]) == 65 and rows[1][64] == 3.0 and sum(rows[1][:64]) == 3.0
    assert rows[2][64] == -1.0


def test_margin_is_the_score_difference(spark):
    df = pairs(spark, 40)
    fitted = model.fit_preferences(model.pair_features(df))
    scored = model.score_with_model(df, fitted, {"chosen": "c", "rejected": "r"})
    margins = model.score_features(model.pair_features(df), fitted).select("pair_id", "margin")
    for r in scored.join(margins, "pair_id").collect():
        assert r.margin == pytest.approx(r.c - r.r, abs=1e-9)


def test_scoring_with_a_function(spark):
    def length(batch: pd.Series) -> pd.Series:
        return batch.str.len()

    df = pairs(spark, 20).repartition(3)
    rows = model.score_with(df, length, {"chosen": "score"}).collect()
    assert len(rows) == 20 and all(r.score == len(r.chosen) for r in rows)


def test_learning_curve_record(spark, tmp_path):
    curve = run_learning_curve(pairs(spark, 200), fractions=(0.4, 1.0))
    rows = {(r.fraction, r.category): r for r in curve.results.where("not is_total").collect()}
    assert set(rows) == {(f, c) for f in (0.4, 1.0) for c in "ab"}
    assert rows[(0.4, "a")].train_pairs == 40 and rows[(1.0, "a")].train_pairs == 100
    assert rows[(1.0, "a")].pairs == 50
    assert curve.table.orderBy("fraction").first().a_count == 50
    curve.write(str(tmp_path / "curve"))
    (part,) = (tmp_path / "curve").glob("part-*.json")
    record = json.loads(part.read_text())
    assert [r["fraction"] for r in record["learning_curve"]] == [0.4, 1.0]
    assert record["power_analysis"]["val_size"] == 100
    assert len(record["power_analysis"]["sample_sizes"]) == 6


@pytest.mark.parametrize("budget", [1, 7, 40, 10_000])
def test_no_batch_is_above_the_budget(spark, budget):
    rng = random.Random(3)
    rows = [(i, " ".join(["word"] * rng.randrange(0, 15))) for i in range(200)] + [(200, None)]

    def scorer(batch):
        lengths = batch.fillna("").str.split().str.len()
        assert len(batch) == 1 or len(batch) * lengths.max() <= budget
        return lengths * 2.0

    frame = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: r.score for r in model.score_within_budget(frame, scorer, {"text": "score"}, budget).collect()}
    assert got == {i: 2.0 * len((t or "").split()) for i, t in rows}
    assert model.score_within_budget(frame.limit(0), scorer, {"text": "score"}, budget).count() == 0


def test_padded_batches_take_every_row_once():
    lengths = np.array([5, 1, 9, 0, 3, 3, 30, 2])
    batches = model.padded_batches(lengths, 10)
    assert sorted(np.concatenate(batches).tolist()) == list(range(8))
    assert all(len(b) == 1 or len(b) * lengths[b].max() <= 10 for b in batches)
    assert model.padded_batches(np.array([], int), 10) == []
