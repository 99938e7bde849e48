"""Learning-curve analysis from annotations to the power report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.curate import usable_pairs
from pairloom.operators.evaluate import curve_table, power_report
from pairloom.operators.preference_model import learning_curve
from pairloom.operators.split import split_pairs
from pairloom.session import cut_lineage
from pairloom.settings import CURVE_FRACTIONS, CURVE_VAL_FRACTION, PreferenceModelSettings
from pairloom.sources.sinks import write_metrics


@dataclass(frozen=True)
class LearningCurve:
    results: DataFrame
    table: DataFrame
    power: DataFrame

    def record(self) -> DataFrame:
        """One row: a list of results per fraction and the power report of the last fit."""
        overall, per_category = F.col("is_total"), ~F.col("is_total") & F.col("category").isNotNull()
        entry = F.struct("category", F.struct("accuracy", F.col("pairs").alias("count")))
        fractions = self.results.groupBy("fraction", "train_pairs").agg(
            F.max(F.when(overall, F.col("accuracy"))).alias("overall_accuracy"),
            F.max(F.when(overall, F.col("mean_margin"))).alias("mean_margin"),
            F.map_from_entries(F.array_sort(F.collect_list(F.when(per_category, entry)))).alias("per_category"),
        )
        sizes = F.struct("target", "target_label", "val_pairs_needed", "total_pairs_needed")
        power = self.power.groupBy("observed_accuracy", "val_size", "ci_low", "ci_high").agg(
            F.array_sort(F.collect_list(sizes)).alias("sample_sizes")
        )
        in_order = F.array_sort(
            F.collect_list(F.struct("*")),
            lambda a, b: F.when(a["fraction"] < b["fraction"], -1).otherwise(1),
        )
        listed = fractions.agg(in_order.alias("learning_curve"))
        return listed.select("*", power.select(F.struct("*")).scalar().alias("power_analysis"))

    def write(self, path: str) -> None:
        write_metrics(self.record(), path)


def run_learning_curve(
    raw: DataFrame,
    fractions: Sequence[float] = CURVE_FRACTIONS,
    val_fraction: float = CURVE_VAL_FRACTION,
    settings: PreferenceModelSettings = PreferenceModelSettings(),
) -> LearningCurve:
    """Fit at each fraction against one fixed validation half; the last fit feeds the power report."""
    labelled = split_pairs(usable_pairs(raw), val_fraction, settings.seed)
    train = labelled.where("split = 'train'")
    validation = labelled.where("split = 'val'")
    results = cut_lineage(learning_curve(train, validation, fractions, settings))
    last = results.where((F.col("fraction") == float(fractions[-1])) & F.col("is_total"))
    return LearningCurve(results, curve_table(results), power_report(last, val_fraction))
