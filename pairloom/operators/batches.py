"""Seeded batch plans over the distinct prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.keyed_cut import DIGITS, bucketed_rank
from pairloom.settings import PolicyRunSettings


def batch_manifest(
    prompts: DataFrame, settings: PolicyRunSettings = PolicyRunSettings(), digits: int = DIGITS
) -> DataFrame:
    """Shuffled batches: one row per (epoch, prompt_id) with its place and batch.

    Only the ids are shuffled; join the texts back on prompt_id where they are needed.
    """
    epochs = F.explode(F.sequence(F.lit(1), F.lit(settings.num_epochs)))
    ids = prompts.select("prompt_id").distinct().withColumn("epoch", epochs)
    ranked = bucketed_rank(ids, ["epoch"], settings.num_epochs, settings.seed, ["epoch", "prompt_id"], digits)
    return ranked.select(
        "epoch",
        F.expr(f"(rank - 1) div {settings.batch_size}").alias("batch_id"),
        F.col("rank").alias("place"),
        "prompt_id",
    )


def steps_per_epoch(prompts: DataFrame, settings: PolicyRunSettings = PolicyRunSettings()) -> DataFrame:
    """One row: distinct prompts, batches per epoch and in all."""
    null_prompt = F.coalesce(F.max(F.col("prompt_id").isNull().cast("bigint")), F.lit(0))
    size = settings.batch_size
    return (
        prompts.agg((F.count_distinct("prompt_id") + null_prompt).alias("prompts"))
        .withColumn("steps_per_epoch", F.expr(f"(prompts + {size - 1}) div {size}"))
        .withColumn("total_steps", F.col("steps_per_epoch") * settings.num_epochs)
    )
