"""Statistics of token-level rollout logs.

The log has one row per generated token and update: run_id, step_id, seq_id, update_id, mask,
old_lp, ref_lp, new_lp. Rewards have one row per sequence: seq_id, reward. Tokens are summed to
sequences first, so only that aggregation moves token data, and it combines before the shuffle.
Averages keep their own grain: tokens (clip fraction, loss), sequences (KL, reward), steps (runs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.statistics import perplexity
from pairloom.session import cut_lineage, stored
from pairloom.settings import (
    ADVANTAGE_EPSILON,
    BASELINE_KEEP,
    MAX_LOSS_FOR_PERPLEXITY,
    PolicyRunSettings,
)

SEQUENCE = ["run_id", "step_id", "seq_id"]
STEP = ["run_id", "step_id"]
STEPS_PER_BLOCK = 128


def _masked_sum(value: Column) -> Column:
    return F.sum(F.when(F.col("mask"), value).otherwise(F.lit(0.0)))


def _at_least_one(count: Column) -> Column:
    return F.greatest(count, F.lit(1))


def _ratio() -> Column:
    return F.exp(F.col("new_lp") - F.col("old_lp"))


def join_log_probs(
    policy: DataFrame, reference: DataFrame, keys: Sequence[str] = ("run_id", "step_id", "seq_id", "pos")
) -> DataFrame:
    """Per-token KL estimate from two separately written logs."""
    return policy.join(reference, list(keys)).withColumn("kl", F.col("old_lp") - F.col("ref_lp"))


def sequence_statistics(tokens: DataFrame) -> DataFrame:
    """Mean KL and number of response tokens per sequence; a fully masked one gives 0 and 0."""
    n = F.count_if(F.col("mask"))
    kl = _masked_sum(F.col("old_lp") - F.col("ref_lp")) / _at_least_one(n)
    return tokens.groupBy(*SEQUENCE).agg(kl.alias("mean_kl"), n.alias("response_tokens"))


def penalise(sequences: DataFrame, kl_coefficient: float) -> DataFrame:
    penalty = F.lit(float(kl_coefficient)) * F.col("mean_kl")
    return sequences.withColumn("total_reward", F.col("reward") - penalty)


def rewarded_sequences(
    tokens: DataFrame, rewards: DataFrame, settings: PolicyRunSettings = PolicyRunSettings()
) -> DataFrame:
    """Sequences with reward and KL-penalised total; ``tokens`` has one row per token.

    Rewards are found by run, step and sequence, as sequence numbers may repeat in another run.
    """
    return penalise(sequence_statistics(tokens).join(rewards, SEQUENCE), settings.kl_coefficient)


def response_lengths(tokens: DataFrame) -> DataFrame:
    """Mean response length per step."""
    lengths = tokens.groupBy(*SEQUENCE).agg(F.count_if(F.col("mask")).alias("n"))
    return lengths.groupBy(*STEP).agg(
        F.avg("n").alias("mean_response_tokens"), F.count("*").alias("sequences")
    )


def step_metrics(sequences: DataFrame) -> DataFrame:
    return sequences.groupBy(*STEP).agg(
        F.avg("reward").alias("mean_reward"),
        F.avg("mean_kl").alias("mean_kl"),
        F.avg("total_reward").alias("mean_total_reward"),
        F.avg("response_tokens").alias("mean_response_tokens"),
        F.count("*").alias("sequences"),
        F.stddev_pop("total_reward").alias("std_total_reward"),
    )


def _affine(step: Column, state: Column) -> Column:
    """The state after a step, where both are affine maps: first the state's, then the step's."""
    return F.struct(
        (step["decay"] * state["decay"]).alias("decay"),
        (step["decay"] * state["gain"] + step["gain"]).alias("gain"),
    )


def _folded(level: DataFrame, runs: list[str]) -> tuple[DataFrame, DataFrame]:
    """What comes before each place inside its block, and the map of the whole block.

    A block covers STEPS_PER_BLOCK places, so its list is bounded.
    """
    grouped = (
        level.withColumn("block", F.floor(F.col("place") / F.lit(STEPS_PER_BLOCK)))
        .groupBy(*runs, "block")
        .agg(F.sort_array(F.collect_list(F.struct("place", "decay", "gain"))).alias("steps"))
    )
    start = F.struct(F.lit(1.0).alias("decay"), F.lit(0.0).alias("gain"))
    empty = F.filter(
        F.array(F.struct(F.lit(0).cast("long").alias("place"), start["decay"].alias("decay"), start["gain"].alias("gain"))),
        lambda x: F.lit(False),
    )

    def take(acc: Column, step: Column) -> Column:
        seen = F.struct(
            step["place"].alias("place"), acc["state"]["decay"].alias("decay"), acc["state"]["gain"].alias("gain")
        )
        return F.struct(_affine(step, acc["state"]).alias("state"), F.concat(acc["seen"], F.array(seen)).alias("seen"))

    folded = grouped.withColumn(
        "folded", F.aggregate("steps", F.struct(start.alias("state"), empty.alias("seen")), take)
    )
    folded = cut_lineage(folded.select(*runs, "block", "folded"))
    before = folded.select(*runs, "block", F.explode("folded.seen").alias("b")).select(*runs, "block", "b.*")
    whole = folded.select(*runs, F.col("block").alias("place"), "folded.state.decay", "folded.state.gain")
    return before, whole


def reward_baseline(steps: DataFrame, keep: float = BASELINE_KEEP) -> DataFrame:
    """Exponential moving average of the step rewards, before and after each step of a run.

    A step maps the average m to keep * m + (1 - keep) * reward, and such affine maps compose. Steps are
    folded in blocks of bounded size by their distance from the run's first step, the blocks in blocks of blocks, until one block
    is left; the averages are then handed down again. So a run of any length is spread over many
    tasks, nothing is cut off, and no power of ``keep`` is taken.
    """
    keep = float(keep)
    runs = ["run_id"]
    steps = cut_lineage(steps)
    firsts = steps.groupBy(*runs).agg(F.min("step_id").alias("first_step"))
    places = steps.join(firsts, runs).select(
        *runs,
        "step_id",
        (F.col("step_id") - F.col("first_step")).alias("place"),
        F.lit(keep).alias("decay"),
        F.coalesce(F.lit(1.0 - keep) * F.col("mean_total_reward"), F.lit(0.0)).alias("gain"),
    )
    furthest = places.agg(F.max("place")).first()[0] or 0
    level = places.select(*runs, "place", "decay", "gain")
    befores = []
    while True:
        before, level = _folded(level, runs)
        befores.append(before)
        if furthest < STEPS_PER_BLOCK:
            break
        furthest //= STEPS_PER_BLOCK
    entering = None
    for before in reversed(befores):
        if entering is None:
            value = before.withColumn("value", F.col("gain"))
        else:
            above = entering.select(*runs, F.col("place").alias("block"), F.col("value").alias("above"))
            value = before.join(above, [*runs, "block"]).withColumn("value", F.col("decay") * F.col("above") + F.col("gain"))
        entering = value.select(*runs, "place", "value")
    averages = places.join(entering, [*runs, "place"]).select(
        *runs,
        "step_id",
        F.col("value").alias("baseline_before"),
        (F.col("decay") * F.col("value") + F.col("gain")).alias("baseline_after"),
    )
    return steps.join(averages, STEP)


def advantages(sequences: DataFrame, steps: DataFrame | None = None) -> DataFrame:
    """Rewards centred and scaled within their step; a lone sequence is compared to the baseline.

    Step moments are aggregated and joined back, so a large step is combined before it moves.
    ``steps`` takes the result of ``reward_baseline`` where it is at hand.
    """
    if steps is None:
        steps = reward_baseline(step_metrics(sequences))
    moments = ["mean_total_reward", "std_total_reward", "sequences", "baseline_before"]
    centred = F.col("total_reward") - F.col("mean_total_reward")
    advantage = F.when(
        F.col("sequences") > 1, centred / (F.col("std_total_reward") + F.lit(ADVANTAGE_EPSILON))
    ).otherwise(F.col("total_reward") - F.col("baseline_before"))
    return (
        sequences.join(steps.select(*STEP, *moments), STEP)
        .withColumn("advantage", advantage)
        .select(*SEQUENCE, "total_reward", "advantage")
    )


def _is_clipped(clip_range: float) -> Column:
    outside = (_ratio() > 1.0 + clip_range) | (_ratio() < 1.0 - clip_range)
    return F.col("mask") & outside


def _clip_share(n: Column, clipped: Column) -> list[Column]:
    return [(clipped / _at_least_one(n)).alias("clip_fraction"), n.alias("tokens")]


def clip_fraction(updates: DataFrame, settings: PolicyRunSettings = PolicyRunSettings()) -> DataFrame:
    """Share of response tokens per update whose probability ratio leaves the clip range."""
    share = _clip_share(F.count_if(F.col("mask")), F.count_if(_is_clipped(settings.clip_range)))
    return updates.groupBy(*STEP, "update_id").agg(*share)


def update_sums(updates: DataFrame, settings: PolicyRunSettings = PolicyRunSettings()) -> DataFrame:
    """All token sums that the step metrics need, one row per sequence and update."""
    return updates.groupBy(*SEQUENCE, "update_id").agg(
        F.count_if(F.col("mask")).alias("n"),
        _masked_sum(F.col("old_lp") - F.col("ref_lp")).alias("kl"),
        _masked_sum(F.least(_ratio(), F.lit(1.0 + settings.clip_range))).alias("capped"),
        _masked_sum(F.greatest(_ratio(), F.lit(1.0 - settings.clip_range))).alias("floored"),
        F.count_if(_is_clipped(settings.clip_range)).alias("clipped"),
    )


def sequences_of(
    sums: DataFrame, rewards: DataFrame, settings: PolicyRunSettings = PolicyRunSettings()
) -> DataFrame:
    """The rows of ``rewarded_sequences`` from update sums; update 0 stands for all."""
    kl = F.col("kl") / _at_least_one(F.col("n"))
    sequences = sums.where(F.col("update_id") == 0).select(
        *SEQUENCE, kl.alias("mean_kl"), F.col("n").alias("response_tokens")
    )
    return penalise(sequences.join(rewards, SEQUENCE), settings.kl_coefficient)


def surrogate_loss(sums: DataFrame, advantage: DataFrame) -> DataFrame:
    """Clipped policy loss per update.

    For an advantage A >= 0 a token adds A * min(ratio, 1 + range), otherwise
    A * max(ratio, 1 - range). Both ratio sums are taken per sequence before the advantage
    is joined, so no token row takes part in the join.
    """
    a = F.col("advantage")
    objective = a * F.when(a >= 0, F.col("capped")).otherwise(F.col("floored"))
    return (
        sums.join(advantage.select(*SEQUENCE, "advantage"), SEQUENCE)
        .groupBy(*STEP, "update_id")
        .agg((-F.sum(objective) / _at_least_one(F.sum("n"))).alias("policy_loss"))
    )


def update_means(loss: DataFrame, clipped: DataFrame) -> DataFrame:
    """Unweighted means over the updates of a step."""
    return (
        loss.join(clipped, [*STEP, "update_id"])
        .groupBy(*STEP)
        .agg(
            F.avg("policy_loss").alias("policy_loss"),
            F.avg("clip_fraction").alias("clip_fraction"),
            F.count("*").alias("updates"),
        )
    )


def step_history(
    updates: DataFrame, rewards: DataFrame, settings: PolicyRunSettings = PolicyRunSettings()
) -> DataFrame:
    """One row per step with every metric, from one pass over the token log.

    The sums per sequence and update are stored once, since the step
    moments, the advantages, the loss and the clip fraction all start from them.
    """
    sums = stored(update_sums(updates, settings), "update-sums")
    sequences = sequences_of(sums, rewards, settings)
    steps = stored(reward_baseline(step_metrics(sequences)), "steps")
    loss = surrogate_loss(sums, advantages(sequences, steps))
    clipped = sums.groupBy(*STEP, "update_id").agg(*_clip_share(F.sum("n"), F.sum("clipped")))
    return steps.join(update_means(loss, clipped), STEP)


def run_metrics(history: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Unweighted means of the step metrics; 0 for an empty history."""

    def mean(column: str, name: str) -> Column:
        return F.coalesce(F.avg(column), F.lit(0.0)).alias(name)

    return history.groupBy(*by).agg(
        F.count("*").alias("total_steps"),
        mean("mean_reward", "mean_reward_model_score"),
        mean("mean_kl", "mean_kl"),
        mean("mean_total_reward", "mean_total_reward"),
        mean("mean_response_tokens", "mean_response_tokens"),
        mean("policy_loss", "mean_policy_loss"),
        mean("clip_fraction", "mean_clip_fraction"),
    )


def token_perplexity(
    tokens: DataFrame,
    by: Sequence[str] = ("run_id",),
    log_prob: str = "old_lp",
    max_loss: float = MAX_LOSS_FOR_PERPLEXITY,
) -> DataFrame:
    """Mean negative log probability of the response tokens and its capped exponential."""
    loss = F.avg(F.when(F.col("mask"), -F.col(log_prob)))
    return tokens.groupBy(*by).agg(loss.alias("loss")).withColumn(
        "perplexity", perplexity(F.col("loss"), max_loss)
    )
