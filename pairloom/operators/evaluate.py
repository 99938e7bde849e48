"""Evaluation of scored pairs and of competing policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.statistics import (
    includes_chance,
    is_nearest_target,
    is_win,
    percent_label,
    required_sample_size,
    total_sample_size,
    wilson_interval,
)
from pairloom.settings import CURVE_VAL_FRACTION, POWER_TARGETS


def with_margin(scored: DataFrame) -> DataFrame:
    return scored.withColumn("margin", F.col("chosen_score") - F.col("rejected_score"))


def pairwise_evaluation(scored: DataFrame) -> DataFrame:
    """One row; the metrics are null when there is no pair. Pairs without both scores are left out."""
    margin = F.col("margin")
    return with_margin(scored).agg(
        F.avg(is_win(margin).cast("double")).alias("pairwise_accuracy"),
        F.avg(margin).alias("mean_margin"),
        F.avg("chosen_score").alias("mean_chosen_score"),
        F.avg("rejected_score").alias("mean_rejected_score"),
        F.count(margin).alias("pairs"),
    )


def ranking_loss(scored: DataFrame) -> DataFrame:
    """One row: mean of ln(1 + exp(-margin)), and the pairs with both scores; null when there is none."""
    margin = F.col("margin")
    return with_margin(scored).agg(
        F.avg(F.greatest(-margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))).alias("loss"),
        F.count(margin).alias("pairs"),
    )


def category_evaluation(scored: DataFrame, category: str = "prompt_category", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy per category and overall, with Wilson intervals.

    ``is_total`` marks the overall rows; they are added up from the category rows, so the
    pairs are read once and an empty table still gives a total of 0 pairs.
    """
    per_category = (
        with_margin(scored)
        .groupBy(*by, category)
        .agg(
            F.count_if(is_win(F.col("margin"))).alias("wins"),
            F.sum("margin").alias("margin"),
            F.count("margin").alias("n"),
        )
    )
    overall = (
        per_category.groupBy(*by)
        .agg(
            F.coalesce(F.sum("wins"), F.lit(0)).alias("wins"),
            F.sum("margin").alias("margin"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        )
        .withColumn(category, F.lit(None).cast(scored.schema[category].dataType))
    )
    rows = per_category.withColumn("is_total", F.lit(False)).unionByName(
        overall.withColumn("is_total", F.lit(True))
    )
    accuracy = F.try_divide(F.col("wins").cast("double"), F.col("n").cast("double"))
    return (
        rows.withColumn("accuracy", accuracy)
        .withColumn("mean_margin", F.try_divide("margin", F.col("n").cast("double")))
        .withColumn("interval", wilson_interval(F.col("accuracy"), F.col("n")))
        .select(
            *by,
            F.col(category).alias("category"),
            "is_total",
            "accuracy",
            F.col("n").alias("pairs"),
            "mean_margin",
            F.col("interval.low").alias("ci_low"),
            F.col("interval.high").alias("ci_high"),
        )
    )


def power_report(
    evaluated: DataFrame,
    validation_ratio: float = CURVE_VAL_FRACTION,
    targets: Sequence[float] = POWER_TARGETS,
) -> DataFrame:
    """For each evaluated row and target accuracy, the sample needed to confirm it."""
    target = F.explode(F.array(*[F.lit(float(t)) for t in targets]))
    return (
        evaluated.withColumn("interval", wilson_interval(F.col("accuracy"), F.col("pairs")))
        .withColumn("target", target)
        .withColumn("val_pairs_needed", required_sample_size(F.col("target")))
        .select(
            "category",
            "is_total",
            F.col("accuracy").alias("observed_accuracy"),
            F.col("pairs").alias("val_size"),
            F.col("interval.low").alias("ci_low"),
            F.col("interval.high").alias("ci_high"),
            includes_chance(F.col("interval")).alias("includes_chance"),
            "target",
            percent_label(F.col("target")).alias("target_label"),
            "val_pairs_needed",
            total_sample_size(F.col("val_pairs_needed"), validation_ratio).alias("total_pairs_needed"),
            is_nearest_target(F.col("target"), F.col("accuracy")).alias("nearest_to_observed"),
        )
    )


def curve_table(evaluated: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """One row per fraction with an accuracy and a count column per category, 0 where missing.

    Category names become column names, so Spark's pivot limit applies when none are given.
    """
    pivoted = (
        evaluated.where(~F.col("is_total") & F.col("category").isNotNull())
        .groupBy("fraction")
        .pivot("category", sorted(categories) if categories is not None else None)
        .agg(F.first("accuracy").alias("accuracy"), F.first("pairs").alias("count"))
    )
    totals = evaluated.where("is_total").select("fraction", F.col("accuracy").alias("overall_accuracy"))
    return totals.join(pivoted, "fraction", "left").na.fill(0)


def unpaired_keys(prompts: DataFrame, completions: DataFrame, keys: Sequence[str] = ("prompt_id",)) -> DataFrame:
    """Keys without exactly one prompt and one completion, with the number of each; null keys find no partner."""
    keys = list(keys)
    marked = prompts.select(*keys, F.lit(1).alias("p"), F.lit(0).alias("c")).unionByName(
        completions.select(*keys, F.lit(0).alias("p"), F.lit(1).alias("c"))
    )
    per_key = marked.groupBy(*keys).agg(F.sum("p").alias("prompts"), F.sum("c").alias("completions"))
    unknown = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda missing: missing)
    return per_key.where((F.col("prompts") != 1) | (F.col("completions") != 1) | unknown)


def join_completions(
    prompts: DataFrame, completions: DataFrame, keys: Sequence[str] = ("prompt_id",), strict: bool = True
) -> DataFrame:
    """Prompts with their completions by key; ``strict`` refuses unmatched or repeated keys.

    Without it the keys that an inner join leaves out or multiplies are those of ``unpaired_keys``.
    """
    if strict:
        wrong = unpaired_keys(prompts, completions, keys).count()
        if wrong:
            raise ValueError(f"{wrong} keys do not have exactly one prompt and one completion")
    return prompts.join(completions, list(keys), "inner")


def pair_policies(scores: DataFrame, policies: Sequence[str] = ("ppo", "reference")) -> DataFrame:
    """Scores of two policies side by side for the prompts both answered, in one shuffle.

    A prompt that a policy has scored twice makes the query fail, as no score is better than the other.
    """
    new, old = policies

    def only(policy: str) -> Column:
        scored = F.when(F.col("policy") == policy, F.col("score"))
        twice = F.raise_error(F.lit(f"a prompt has several scores of {policy}")).cast("double")
        return F.when(F.count(scored) > 1, twice).otherwise(F.max(scored)).alias(f"{policy}_score")

    paired = scores.groupBy("prompt_id").agg(only(new), only(old))
    return paired.where(F.col(f"{new}_score").isNotNull() & F.col(f"{old}_score").isNotNull())


def win_rate(paired: DataFrame, policies: Sequence[str] = ("ppo", "reference")) -> DataFrame:
    """One row; null when no prompt was scored under both policies."""
    new, old = (F.col(f"{p}_score") for p in policies)
    return paired.agg(
        F.avg(is_win(new - old).cast("double")).alias("win_rate"),
        F.avg(new).alias(f"{policies[0]}_reward_mean"),
        F.avg(old).alias(f"{policies[1]}_reward_mean"),
        F.count("*").alias("prompts"),
    )
