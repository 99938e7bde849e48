"""Seeded per-category subsamples that are nested in the fraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.keys import row_key, stratum_key
from pairloom.operators.keyed_cut import (
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
    strata_fit_broadcast,
    within,
)
from pairloom.session import broadcast_if
from pairloom.settings import CURVE_FRACTIONS, SEED


def _sample_size(fraction: float) -> Column:
    share = (F.col("stratum_rows").cast("double") * F.lit(float(fraction))).cast("bigint")
    return F.greatest(share, F.lit(1).cast("bigint"))


def fraction_membership(
    df: DataFrame,
    fractions: Sequence[float] = CURVE_FRACTIONS,
    seed: int = SEED,
    category: str = "prompt_category",
    id_column: str = "pair_id",
    digits: int = DIGITS,
) -> DataFrame:
    """Add ``fractions``: the fractions whose sample holds the row.

    Below 1 a sample takes max(int(rows * fraction), 1) rows of each category and leaves rows
    without a category out; from 1 on it is the whole table.
    """
    columns = df.columns
    partial = [float(f) for f in fractions if f < 1.0]
    whole = [float(f) for f in fractions if f >= 1.0]
    whole_array = F.array(*[F.lit(f) for f in whole]) if whole else F.expr("array()").cast("array<double>")
    if not partial:
        return df.withColumn("fractions", whole_array)

    def find(rows: DataFrame) -> tuple[DataFrame, bool, bool]:
        with held(rows.where(F.col(category).isNotNull())) as keyed:
            histogram = key_histogram(keyed, digits)
            fits = strata_fit_broadcast(histogram, len(partial))
            cuts = cut_keys(keyed, histogram, [_sample_size(f) for f in partial], fits, digits)
            return cuts, fits, divides_copies(cuts)

    rows = df.withColumn(KEY, row_key(df, seed, id_column)).withColumn(STRATUM, stratum_key(F.col(category)))
    cuts, fits, divided = find(rows)
    if divided and id_column in columns:
        rows = content_at_ties(rows, cuts, fits, columns)
        cuts, fits, divided = find(rows)
    numbered = number_copies(rows, cuts, fits, divided)
    fraction_of = F.element_at(F.array(*[F.lit(f) for f in partial]), F.col("cut_no") + 1)
    bounds = cuts.groupBy(STRATUM).agg(
        F.collect_list(F.struct(fraction_of.alias("fraction"), "cut_key", "copies_in")).alias("cuts")
    )
    sampled = F.transform(
        F.filter("cuts", lambda c: within(F.col(KEY), F.col(COPY), c["cut_key"], c["copies_in"])),
        lambda c: c["fraction"],
    )
    chosen = F.concat(F.coalesce(sampled, F.expr("array()").cast("array<double>")), whole_array)
    return numbered.join(broadcast_if(bounds, fits), STRATUM, "left").select(
        *columns, chosen.alias("fractions")
    )


def fraction_sweep(
    df: DataFrame,
    fractions: Sequence[float] = CURVE_FRACTIONS,
    seed: int = SEED,
    category: str = "prompt_category",
    id_column: str = "pair_id",
    digits: int = DIGITS,
) -> DataFrame:
    """Every row once per fraction whose sample holds it, in a column ``fraction``."""
    member = fraction_membership(df, fractions, seed, category, id_column, digits)
    return member.withColumn("fraction", F.explode("fractions")).drop("fractions")


def subsample(
    df: DataFrame,
    fraction: float,
    seed: int = SEED,
    category: str = "prompt_category",
    id_column: str = "pair_id",
) -> DataFrame:
    """One sample of ``fraction_sweep``; rows without a category are left out at any fraction."""
    below_one = min(float(fraction), 1.0)
    if below_one == 1.0:
        return df.where(F.col(category).isNotNull())
    return fraction_sweep(df, [below_one], seed, category, id_column).drop("fraction")
