"""Evaluation of pairs and policies, curves and records."""

import math

import pytest
from pyspark.sql import functions as F

from pairloom.operators.evaluate import (
    category_evaluation,
    curve_table,
    join_completions,
    pair_policies,
    pairwise_evaluation,
    power_report,
    win_rate,
    unpaired_keys,
)
from pairloom.plans.records import stage_record
from pairloom.settings import PolicyRunSettings
from pairloom.sources.sinks import read_metrics, write_metrics

SCORED = "prompt_category string, chosen_score double, rejected_score double"


def test_equal_and_nan_margins_are_no_wins(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 1.0)], SCORED)
    row = pairwise_evaluation(df).first()
    assert (row.pairwise_accuracy, row.mean_margin, row.pairs) == (0.5, 0.5, 2)
    row = pairwise_evaluation(df.union(spark.createDataFrame([("a", math.nan, 1.0)], SCORED))).first()
    assert row.pairwise_accuracy == pytest.approx(1 / 3) and math.isnan(row.mean_margin)


def test_empty_validation_set(spark):
    empty = spark.createDataFrame([], SCORED)
    row = pairwise_evaluation(empty).first()
    assert row.pairs == 0 and row.pairwise_accuracy is None
    rows = category_evaluation(empty).collect()
    assert [(r.is_total, r.accuracy, r.pairs, r.ci_low, r.ci_high) for r in rows] == [(True, None, 0, 0.0, 1.0)]


def test_null_category_is_not_the_total(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), (None, 0.0, 1.0)], SCORED)
    got = {(r.category, r.is_total): (r.accuracy, r.pairs) for r in category_evaluation(df).collect()}
    assert got == {("a", False): (1.0, 1), (None, False): (0.0, 1), (None, True): (0.5, 2)}


def test_power_report(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0)] * 62 + [("a", 0.0, 1.0)] * 38, SCORED)
    rows = power_report(category_evaluation(df).where("is_total")).orderBy("target").collect()
    assert [r.val_pairs_needed for r in rows] == [617, 153, 67, 37, 23, 15]
    assert [r.target_label for r in rows if r.nearest_to_observed] == ["60%"]
    assert not rows[0].includes_chance


def test_curve_table_fills_missing_categories(spark):
    df = spark.createDataFrame(
        [(0.2, "a", 1.0, 0.0), (0.4, "a", 0.0, 1.0), (0.4, "b", 1.0, 0.0)], "fraction double, " + SCORED
    )
    evaluated = category_evaluation(df, by=("fraction",))
    for categories in (None, ["b", "a"]):
        rows = curve_table(evaluated, categories).orderBy("fraction").collect()
        assert [(r.a_accuracy, r.b_accuracy, r.b_count, r.overall_accuracy) for r in rows] == [
            (1.0, 0.0, 0, 1.0),
            (0.0, 1.0, 1, 0.5),
        ]


def test_join_completions_strict(spark):
    prompts = spark.createDataFrame([(1, "p"), (2, "q")], "prompt_id long, prompt string")
    answers = spark.createDataFrame([(1, "a"), (2, "b")], "prompt_id long, completion string")
    assert join_completions(prompts, answers, strict=True).count() == 2
    assert join_completions(prompts, answers.where("prompt_id = 1"), strict=False).count() == 1
    for wrong in (answers.where("prompt_id = 1"), answers.union(answers.limit(1))):
        with pytest.raises(ValueError):
            join_completions(prompts, wrong)


def test_win_rate_is_strict(spark):
    rows = [(1, "ppo", 2.0), (1, "reference", 1.0), (2, "ppo", 1.0), (2, "reference", 1.0), (3, "ppo", 9.0)]
    scores = spark.createDataFrame(rows, "prompt_id long, policy string, score double")
    row = win_rate(pair_policies(scores)).first()
    assert (row.win_rate, row.ppo_reward_mean, row.reference_reward_mean, row.prompts) == (0.5, 1.5, 1.0, 2)
    assert win_rate(pair_policies(scores.where("prompt_id = 3"))).first().win_rate is None


def test_repeated_scores_are_refused(spark):
    rows = [(1, "ppo", 1.0), (1, "ppo", 9.0), (1, "reference", 5.0)]
    scores = spark.createDataFrame(rows, "prompt_id long, policy string, score double")
    with pytest.raises(Exception, match="several scores of ppo"):
        pair_policies(scores).collect()


def test_every_record_of_a_file_is_read(spark, tmp_path):
    write_metrics(spark.range(5).coalesce(1), str(tmp_path / "lines"))
    (tmp_path / "pretty").mkdir()
    (tmp_path / "pretty" / "one.json").write_text('{\n  "id": 7,\n  "name": "x"\n}\n')
    rows = read_metrics(spark, str(tmp_path)).collect()
    assert sorted(r.id for r in rows) == [0, 1, 2, 3, 4, 7]
    assert [r.name for r in rows if r.id == 7] == ["x"]


def test_records_are_told_apart_by_structure(spark, tmp_path):
    texts = {
        "a.json": '{"id": 1, "s": "a } \\" { b"}{"id": 2,\n "deep": {"x": [1, {"y": 0.5}]}}\n\n{"id": 3}',
        "b.json": '{"id": 4}\n{"id": 5, "broken\n{"id": 6, "s": null}\r\n',
        "c.json": "[1, 2]",
        "d.json": "",
    }
    for name, content in texts.items():
        (tmp_path / name).write_text(content)
    rows = read_metrics(spark, str(tmp_path)).collect()
    assert [r.id for r in rows] == [1, 2, 3, 4, None, 6, None]
    assert rows[0].s == 'a } " { b' and rows[1].deep.x is not None
    assert [(r.path[-6:], r._corrupt_record) for r in rows if r._corrupt_record] == [
        ("b.json", '{"id": 5, "broken'),
        ("c.json", "[1, 2]"),
    ]
    assert read_metrics(spark, str(tmp_path / "d.json")).count() == 0
    given = read_metrics(spark, str(tmp_path / "b.json"), "id string")
    assert [r.id for r in given.collect()] == ["4", None, "6"]


def test_unpaired_keys(spark):
    prompts = spark.createDataFrame([(1, "p"), (2, "q"), (None, "r"), (3, "s")], "prompt_id long, prompt string")
    answers = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c"), (4, "d")], "prompt_id long, completion string")
    got = {(r.prompt_id, r.prompts, r.completions) for r in unpaired_keys(prompts, answers).collect()}
    assert got == {(2, 1, 0), (None, 1, 0), (3, 1, 2), (4, 0, 1)}


def test_pairs_without_scores_are_left_out_alike(spark):
    rows = [("a", 2.0, 1.0), ("a", None, 1.0)]
    scored = spark.createDataFrame(rows, "prompt_category string, chosen_score double, rejected_score double")
    one = pairwise_evaluation(scored).first()
    two = category_evaluation(scored).where("is_total").first()
    assert (one.pairwise_accuracy, one.pairs) == (two.accuracy, two.pairs) == (1.0, 1)


def test_records(spark, tmp_path):
    metrics = spark.range(1).select(F.lit(0.5).alias("loss"))
    for n in (0, 3):
        evaluation = spark.range(n).agg(F.count("*").alias("pairs"), F.avg("id").alias("mean"))
        record = stage_record("ppo", metrics, PolicyRunSettings(), {"eval": (evaluation, "pairs")})
        write_metrics(record, str(tmp_path / "logs" / f"n{n}"))
    rows = read_metrics(spark, str(tmp_path / "logs")).collect()
    assert [r.path.split("/")[-2] for r in rows] == ["n0", "n3"]
    assert rows[0].eval is None and rows[1].eval.pairs == 3
    assert rows[1].kl_coefficient == 0.05 and rows[1].stage == "ppo"
