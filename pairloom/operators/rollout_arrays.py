"""Rollout statistics on arrays: one row per sequence, as a policy writes them, with nothing exploded.

Columns are run_id, step_id, seq_id, the arrays mask, old_lp and ref_lp of equal length, and new_lp, an array with one
array of log-probabilities for each update. A sequence is bounded by the length of a generation. Everything up to the
sequence is computed inside its row, so no token moves; the first exchange is that of the step. The results are those
of the functions of the same name in ``rollout``, whose later steps take the sums from here.

A null array counts as empty and a null or missing mask as false; where arrays differ in length, what is missing in one
of them adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.rollout import SEQUENCE, STEP
from pairloom.settings import PolicyRunSettings


def _zero() -> Column:
    return F.lit(0.0)


def _masked(mask: Column, values: Column) -> Column:
    """Values where the mask is true and 0 elsewhere."""
    kept = F.zip_with(values, mask, lambda v, m: F.when(F.coalesce(m, F.lit(False)), v))
    return F.transform(kept, lambda v: F.coalesce(v, _zero()))


def _total(values: Column) -> Column:
    return F.coalesce(F.aggregate(values, _zero(), lambda total, v: total + v), _zero())


def _count(flags: Column) -> Column:
    kept = F.size(F.filter(flags, lambda m: F.coalesce(m, F.lit(False))))
    return F.greatest(kept, F.lit(0)).cast("long")


def with_token_kl(sequences: DataFrame) -> DataFrame:
    """Add `kl`, the KL estimate of every token of a sequence."""
    return sequences.withColumn("kl", F.zip_with("old_lp", "ref_lp", lambda old, ref: old - ref))


def sequence_statistics(sequences: DataFrame) -> DataFrame:
    """Mean KL and number of response tokens of every sequence; a fully masked one gives 0 and 0."""
    n = _count(F.col("mask"))
    kl = _total(_masked(F.col("mask"), F.col("kl")))
    return with_token_kl(sequences).select(
        *SEQUENCE, (kl / F.greatest(n, F.lit(1))).alias("mean_kl"), n.alias("response_tokens")
    )


def update_sums(
    sequences: DataFrame, settings: PolicyRunSettings = PolicyRunSettings(), carried: Sequence[str] = ()
) -> DataFrame:
    """Token sums of every sequence and update, in the columns of ``rollout.update_sums`` and those to be carried along."""
    low, high = F.lit(1.0 - settings.clip_range), F.lit(1.0 + settings.clip_range)
    rows = with_token_kl(sequences).select(
        *SEQUENCE, *carried, "mask", "kl", "old_lp", F.posexplode("new_lp").alias("update_id", "new")
    )
    rows = rows.withColumn("ratio", F.zip_with("new", "old_lp", lambda new, old: F.exp(new - old)))
    mask, ratio = F.col("mask"), F.col("ratio")
    outside = F.zip_with(ratio, mask, lambda r, m: m & ((r > high) | (r < low)))
    capped = F.transform(ratio, lambda r: F.when(r.isNotNull(), F.least(r, high)))
    floored = F.transform(ratio, lambda r: F.when(r.isNotNull(), F.greatest(r, low)))
    return rows.select(
        *SEQUENCE,
        *carried,
        "update_id",
        _count(mask).alias("n"),
        _total(_masked(mask, F.col("kl"))).alias("kl"),
        _total(_masked(mask, capped)).alias("capped"),
        _total(_masked(mask, floored)).alias("floored"),
        _count(outside).alias("clipped"),
    )


def clip_fraction(sequences: DataFrame, settings: PolicyRunSettings = PolicyRunSettings()) -> DataFrame:
    """Share of response tokens per update whose probability ratio leaves the clip range."""
    sums = update_sums(sequences, settings).groupBy(*STEP, "update_id")
    totals = sums.agg(F.sum("n").alias("tokens"), F.sum("clipped").alias("clipped"))
    share = F.col("clipped") / F.greatest("tokens", F.lit(1))
    return totals.select(*STEP, "update_id", share.alias("clip_fraction"), "tokens")


def surrogate_loss(sequences: DataFrame, settings: PolicyRunSettings = PolicyRunSettings()) -> DataFrame:
    """Clipped policy loss per update, of rows that carry the `advantage` of their sequence."""
    advantage = F.col("advantage")
    sums = update_sums(sequences, settings, ["advantage"])
    objective = advantage * F.when(advantage >= 0, F.col("capped")).otherwise(F.col("floored"))
    loss = -F.sum(objective) / F.greatest(F.sum("n"), F.lit(1))
    return sums.groupBy(*STEP, "update_id").agg(loss.alias("policy_loss"))
