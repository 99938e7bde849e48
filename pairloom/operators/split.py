"""Train/validation split: stratified where every category can be represented."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.keys import row_key, stratum_key
from pairloom.operators.keyed_cut import (
    BUCKET,
    COPY,
    DIGITS,
    KEY,
    STRATUM,
    content_at_ties,
    cut_keys,
    divides_copies,
    held,
    key_histogram,
    number_copies,
    proportional_quotas,
    within,
)
from pairloom.session import broadcast_if, cut_lineage, fits_broadcast
from pairloom.settings import SEED, VAL_FRACTION


@dataclass(frozen=True)
class SplitDecision:
    rows: int
    categories: int
    smallest_category: int
    val_size: int
    stratified: bool

    @property
    def train_size(self) -> int:
        return self.rows - self.val_size


def _decide(totals: dict, val_fraction: float) -> SplitDecision:
    rows = totals["rows"] or 0
    if rows < 2 or val_fraction <= 0:
        return SplitDecision(rows, totals["strata"] or 0, totals["smallest"] or 0, 0, False)
    val_size, strata = totals["take"], totals["strata"]
    if val_fraction >= 1 or val_size >= rows:
        raise ValueError(f"val_fraction={val_fraction} leaves no training rows out of {rows}")
    enough = totals["smallest"] >= 2 and val_size >= strata and rows - val_size >= strata
    return SplitDecision(rows, strata, totals["smallest"], val_size, enough)


def _keyed(df: DataFrame, seed: int, category: str | None, id_column: str | None) -> DataFrame:
    stratum = F.lit("") if category is None else stratum_key(F.col(category))
    return df.withColumn(KEY, row_key(df, seed, id_column)).withColumn(STRATUM, stratum)


def stratify_decision(
    df: DataFrame,
    val_fraction: float = VAL_FRACTION,
    category: str = "prompt_category",
) -> DataFrame:
    """One row that tells whether a split would be stratified, and why."""
    sizes = df.groupBy(category).agg(F.count("*").alias("n"))
    totals = sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("categories"),
        F.coalesce(F.min("n"), F.lit(0)).alias("smallest_category"),
    )
    splits = (F.col("rows") >= 2) & F.lit(val_fraction > 0)
    val_size = F.when(splits, F.ceil(F.col("rows").cast("double") * F.lit(float(val_fraction)))).otherwise(0)
    return (
        totals.withColumn("val_size", val_size.cast("bigint"))
        .withColumn("train_size", F.col("rows") - F.col("val_size"))
        .withColumn(
            "stratified",
            (F.col("smallest_category") >= 2)
            & (F.col("val_size") >= F.col("categories"))
            & (F.col("train_size") >= F.col("categories")),
        )
    )


def split_pairs(
    df: DataFrame,
    val_fraction: float = VAL_FRACTION,
    seed: int = SEED,
    category: str | None = "prompt_category",
    id_column: str = "pair_id",
    digits: int = DIGITS,
    slim: DataFrame | None = None,
) -> DataFrame:
    """Add ``split`` ('train' or 'val') and ``row_key``; ceil(n * val_fraction) rows are 'val'.

    The choice depends on the seed and the rows alone. A category of None gives a plain random
    split; so does a category table too sparse to stratify. If the cut falls among rows with one
    id, those rows alone are ordered by their content as well. ``slim`` may give the same rows in a form that costs less
    to derive, with ids and categories; the cut is then found there.
    """
    rows = _keyed(df, seed, category, id_column)
    keys = rows if slim is None or id_column not in df.columns else _keyed(slim, seed, category, id_column)
    found = _find_cut(keys, val_fraction, category is not None, digits)
    if found is not None and found.divided and id_column in df.columns:
        rows = content_at_ties(rows, found.cuts, found.fits, df.columns)
        found = _find_cut(rows, val_fraction, category is not None, digits)
    labelled = [*df.columns, F.col(KEY).alias("row_key"), "split"]
    if found is None:
        return rows.withColumn("split", F.lit("train")).select(*labelled)
    if not found.by_category:
        rows = rows.withColumn(STRATUM, F.lit(""))
    numbered = number_copies(rows, found.cuts, found.fits, found.divided)
    bounds = broadcast_if(found.cuts.select(STRATUM, "cut_key", "copies_in"), found.fits)
    in_val = within(F.col(KEY), F.col(COPY), F.col("cut_key"), F.col("copies_in"))
    return (
        numbered.join(bounds, STRATUM, "left")
        .withColumn("split", F.when(in_val, "val").otherwise("train"))
        .select(*labelled)
    )


@dataclass(frozen=True)
class _Found:
    cuts: DataFrame
    fits: bool
    by_category: bool
    divided: bool


def _find_cut(rows: DataFrame, val_fraction: float, by_category: bool, digits: int) -> _Found | None:
    """The last 'val' key of each stratum; None if there are no 'val' rows."""
    with held(rows) as keyed:
        histogram = key_histogram(keyed, digits)
        totals, quota = proportional_quotas(histogram, val_fraction)
        decision = _decide(totals, val_fraction)
        if decision.val_size == 0:
            return None
        fits = fits_broadcast(totals["strata"], totals["bytes"])
        if by_category and not decision.stratified:
            by_category, fits, quota = False, True, F.lit(decision.val_size)
            keyed = keyed.withColumn(STRATUM, F.lit(""))
            merged = histogram.groupBy(F.lit("").alias(STRATUM), BUCKET).agg(F.sum("n").alias("n"))
            histogram = cut_lineage(merged)
        cuts = cut_keys(keyed, histogram, [quota], fits, digits)
        return _Found(cuts, fits, by_category, divides_copies(cuts))
