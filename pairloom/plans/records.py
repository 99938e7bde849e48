"""One record per stage: configuration, metrics and an optional evaluation."""

from __future__ import annotations

from dataclasses import asdict, is_dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.settings import TrainingSettings

RECORDED = ("base_model", "num_epochs", "max_steps", "effective_batch_size", "learning_rate")


def stage_record(
    stage: str,
    metrics: DataFrame,
    settings: Any = None,
    evaluations: dict[str, tuple[DataFrame, str]] | None = None,
    metadata: DataFrame | None = None,
) -> DataFrame:
    """Merge one-row frames into a record.

    ``evaluations`` maps a name to a one-row frame and the column that counts its inputs; the
    nested record is null when that count is 0.
    """
    chosen = asdict(settings) if is_dataclass(settings) else dict(settings or {})
    config = [F.lit(v).alias(k) for k, v in chosen.items()]
    row = metrics.select(F.lit(stage).alias("stage"), *config, "*")
    if metadata is not None:
        row = row.select("*", metadata.select("usable_pairs").scalar().alias("usable_pairs"))
    for name, (evaluation, count) in (evaluations or {}).items():
        row = row.select("*", _nested(evaluation, count).alias(name))
    return row


def training_record(
    stage: str,
    counts: dict[str, int],
    usable_pairs: int,
    settings: TrainingSettings,
    evaluations: dict[str, tuple[DataFrame, str]],
) -> DataFrame:
    """Record of a training stage: its examples per split, what it was trained with, and its evaluations.

    ``counts`` are the rows per split that the sink counted while it wrote the stage's view.
    """
    spark = next(iter(evaluations.values()))[0].sparkSession
    examples = [F.lit(n).cast("bigint").alias(f"{stage}_{split}_examples") for split, n in counts.items()]
    row = spark.range(1).select(*examples, F.lit(usable_pairs).cast("bigint").alias("usable_pairs"))
    config = {name: getattr(settings, name) for name in RECORDED}
    return stage_record(stage, row, config, evaluations)


def _nested(evaluation: DataFrame, count: str) -> Column:
    return evaluation.select(F.when(F.col(count) > 0, F.struct("*"))).scalar()
