"""Counts, means and the metadata report of a curated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.curate import filter_counts, is_usable
from pairloom.operators.median import exact_median, median_bracket
from pairloom.settings import CurationSettings


def view_sizes(labelled: DataFrame) -> DataFrame:
    """Rows and distinct prompts per split; all rows without a prompt id count as one prompt."""
    return labelled.groupBy("split").agg(
        F.count("*").alias("pairs"),
        (
            F.count_distinct("prompt_id")
            + F.coalesce(F.max(F.col("prompt_id").isNull().cast("bigint")), F.lit(0))
        ).alias("prompts"),
    )


def category_counts(labelled: DataFrame) -> DataFrame:
    """Rows per category within each split and in total (split null); no row for a null category.

    The totals are added up from the per-split counts, so the table is scanned once.
    """
    per_split = (
        labelled.where(F.col("prompt_category").isNotNull())
        .groupBy("split", "prompt_category")
        .agg(F.count("*").alias("n"))
    )
    totals = per_split.groupBy("prompt_category").agg(F.sum("n").alias("n"))
    columns = ("split", "prompt_category", "n")
    return per_split.select(*columns).unionByName(
        totals.withColumn("split", F.lit(None).cast("string")).select(*columns)
    )


def token_means(usable: DataFrame) -> DataFrame:
    return usable.agg(
        F.avg("chosen_output_tokens").alias("avg_chosen_tokens"),
        F.avg("rejected_output_tokens").alias("avg_rejected_tokens"),
    )


def median_reading_time(usable: DataFrame) -> DataFrame:
    value = F.lit(exact_median(usable, "reading_time_s")).cast("double")
    return usable.sparkSession.range(1).select(value.alias("median_reading_time_s"))


def _counts_map(chosen: Column) -> Column:
    """Map category -> rows, largest first, from the chosen rows of grouped counts."""
    entry = F.struct((-F.col("n")).alias("descending"), F.col("prompt_category").alias("category"))
    entries = F.collect_list(F.when(chosen & F.col("prompt_category").isNotNull(), entry))
    return F.map_from_entries(
        F.transform(F.array_sort(entries), lambda e: F.struct(e["category"], -e["descending"]))
    )


def _split_summary(labelled: DataFrame) -> DataFrame:
    """One row of pairs, distinct prompts and category maps per split, from one pass."""
    sets = [["split", "prompt_category"], ["prompt_category"], ["split", "prompt_id"]]
    grouped = labelled.groupingSets(sets, "split", "prompt_category", "prompt_id").agg(
        F.count("*").alias("n"), F.grouping_id().alias("set")
    )
    by_category, total, by_prompt = (F.col("set") == bits for bits in (0b001, 0b101, 0b010))
    parts = []
    for name in ("train", "val"):
        here = F.col("split") == name
        parts += [
            F.coalesce(F.sum(F.when(by_category & here, F.col("n"))), F.lit(0)).alias(f"{name}_pairs"),
            F.count_if(by_prompt & here).alias(f"{name}_prompts"),
            _counts_map(by_category & here).alias(f"{name}_categories"),
        ]
    return grouped.agg(*parts, _counts_map(total).alias("categories"))


def metadata_report(
    raw: DataFrame,
    labelled: DataFrame,
    settings: CurationSettings = CurationSettings(),
    source_files: Sequence[str] = (),
) -> DataFrame:
    """One row that describes a run of the curation: sizes, removals, categories, means.

    One pass over the raw rows gives the counts, the means and a bracket for the median, a
    second the median, and one over the labelled rows all that depends on the split. The count
    maps hold one entry per category, as the report lists them all.
    """
    bounds = settings.min_reading_time, settings.max_reading_time
    usable = is_usable(*bounds)

    def of_usable(column: str) -> Column:
        return F.when(usable, F.col(column))

    totals = raw.agg(
        *filter_counts(*bounds),
        F.avg(of_usable("chosen_output_tokens")).alias("avg_chosen_tokens"),
        F.avg(of_usable("rejected_output_tokens")).alias("avg_rejected_tokens"),
        median_bracket(of_usable("reading_time_s").cast("double")).alias("bracket"),
    ).first()
    median = exact_median(raw.where(usable), "reading_time_s", tuple(totals["bracket"]))

    def known(name: str, kind: str = "bigint") -> Column:
        return F.lit(totals[name]).cast(kind).alias(name)

    sizes = {
        f"{view}_{split}_{unit}": f"{split}_{rows}"
        for view, unit, rows in (
            ("sft", "examples", "pairs"),
            ("reward", "examples", "pairs"),
            ("ppo", "prompts", "prompts"),
        )
        for split in ("train", "val")
    }
    return _split_summary(labelled).select(
        F.array(*[F.lit(f) for f in source_files]).cast("array<string>").alias("source_files"),
        F.lit(len(source_files)).alias("num_source_files"),
        known("total_rows"),
        F.lit(float(settings.val_fraction)).alias("val_fraction"),
        *[known(c) for c in ("ties_removed", "tie_unknown", "quality_filtered", "too_fast", "too_slow")],
        known("usable_pairs"),
        "train_pairs",
        "val_pairs",
        *[F.col(source).alias(name) for name, source in sizes.items()],
        "categories",
        "train_categories",
        "val_categories",
        known("avg_chosen_tokens", "double"),
        known("avg_rejected_tokens", "double"),
        F.lit(median).cast("double").alias("median_reading_time_s"),
    )
