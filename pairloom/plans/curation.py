"""From annotations to the labelled table, its views and its report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pairloom.operators.curate import usable_pairs
from pairloom.operators.report import metadata_report
from pairloom.operators.split import split_pairs
from pairloom.operators.views import prompt_view, reward_view, supervised_view
from pairloom.settings import CurationSettings
from pairloom.sources.preference_csv import list_csv_files, read_preference_csv
from pairloom.sources.sinks import write_counted, write_view


@dataclass(frozen=True)
class CuratedData:
    """``prompts`` may give the view of distinct prompts in a form that costs less to derive."""

    raw: DataFrame
    labelled: DataFrame
    settings: CurationSettings
    source_files: tuple[str, ...] = ()
    prompts: DataFrame | None = None

    @property
    def views(self) -> dict[str, DataFrame]:
        return {
            "sft": supervised_view(self.labelled),
            "reward": reward_view(self.labelled),
            "ppo": prompt_view(self.labelled) if self.prompts is None else self.prompts,
        }

    def view(self, name: str, split: str) -> DataFrame:
        return self.views[name].where(f"split = '{split}'").drop("split")

    def metadata(self) -> DataFrame:
        return metadata_report(self.raw, self.labelled, self.settings, self.source_files)

    def write_views(self, folder: str) -> dict[str, str]:
        paths = {name: f"{folder.rstrip('/')}/{name}" for name in self.views}
        for name, view in self.views.items():
            write_view(view, paths[name])
        return paths

    def write_counted_views(self, folder: str) -> dict[str, dict[str, int]]:
        """Write the views as ``write_views`` does; rows per view and split, counted on their way to the files."""
        return {name: write_counted(view, f"{folder.rstrip('/')}/{name}") for name, view in self.views.items()}


def curate(raw: DataFrame, settings: CurationSettings = CurationSettings(), source_files=()) -> CuratedData:
    """Filter and split a table of annotations; lazily, but for the small cut tables."""
    usable = usable_pairs(raw, settings.min_reading_time, settings.max_reading_time)
    labelled = split_pairs(usable, settings.val_fraction, settings.seed)
    return CuratedData(raw, labelled, settings, tuple(source_files))


def curate_csv(
    spark: SparkSession, path: str, settings: CurationSettings = CurationSettings(), table: str | None = None
) -> CuratedData:
    """Curate CSV input. With ``table`` the parsed rows are first written there as Parquet, so
    that the passes over them read columns and not text."""
    raw = read_preference_csv(spark, path)
    if table is not None:
        raw.write.mode("overwrite").parquet(table)
        raw = spark.read.parquet(table)
    return curate(raw, settings, list_csv_files(spark, path))
