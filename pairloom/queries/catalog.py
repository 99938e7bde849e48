"""Spark side of the registered queries.

Numbers are rounded to nine digits here, and only here, so that both engines hash equally.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions import statistics, text
from pairloom.operators import batches, curate, evaluate, report, rollout, rollout_arrays, split, subsample, views
from pairloom.operators import preference_model as model
from pairloom.plans.curation import CuratedData
from pairloom.plans.curve import run_learning_curve
from pairloom.plans.records import stage_record, training_record
from pairloom.queries import tables
from pairloom.session import scratch_path, shuffles_freed, stored
from pairloom.settings import (
    CURVE_VAL_FRACTION,
    MAX_LOSS_FOR_PERPLEXITY,
    MAX_PROMPT_TOKENS,
    MAX_TEXT_TOKENS,
    PREFERENCE_SCHEMA,
    CurationSettings,
    PolicyRunSettings,
    PreferenceModelSettings,
    TrainingSettings,
)
from pairloom.sources import preference_csv, sinks

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(query: Query, name: str | None = None) -> Query:
    REGISTRY[name or query.__name__] = query
    return query


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), 9) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


REJECTED_FIRST = ("rejected", "prompt", "chosen")
PROMPT_LAST = ("chosen", "rejected", "prompt")


def _usable(spark: SparkSession, sf_dir: str, order: tuple[str, ...] = tables.SIDES) -> DataFrame:
    return curate.usable_pairs(tables.preference_pairs(spark, sf_dir, order))


def _labelled(spark: SparkSession, sf_dir: str, order: tuple[str, ...] = tables.SIDES) -> DataFrame:
    return split.split_pairs(_usable(spark, sf_dir, order))


def _labelled_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pairs for views of all three texts; the split is found without them."""
    whole = tables.whole_pairs(curate.usable_pairs(tables.pair_events(spark, sf_dir)), sf_dir)
    return split.split_pairs(whole, slim=_usable(spark, sf_dir))


def _usable_with_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable pairs with their prompt; responses are joined where they are read, so that what is done with them moves less."""
    return tables.with_document(curate.usable_pairs(tables.pair_events(spark, sf_dir)), sf_dir, "prompt")


def _train_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = split.split_pairs(_usable(spark, sf_dir), CURVE_VAL_FRACTION)
    return labelled.where("split = 'train'")


# Sources and sinks


@cache
def _csv_folder(application: str, sf_dir: str) -> str:
    """Annotations as CSV with three headers: plain, reordered with a note, one column short; every task writes a gzip file."""
    spark = SparkSession.getActiveSession()
    folder = scratch_path(spark, "annotations")
    events = tables.pair_events(spark, sf_dir)

    def whole(events_of: str) -> DataFrame:
        return tables.whole_pairs(events.where(events_of), sf_dir).drop("chosen_score", "rejected_score")

    noted = whole("event_type = 'error'")
    parts = [
        whole("event_type in ('click', 'view')").drop("event_type"),
        whole("event_type not in ('click', 'view', 'error')").drop("event_type", "rejected_temperature"),
        noted.select(F.col("event_type").alias("note"), *reversed([c for c in noted.columns if c != "event_type"])),
    ]
    for part in parts:
        with shuffles_freed(spark):
            part.write.mode("append").csv(folder, header=True, quote='"', escape='"', compression="gzip")
    return folder


def _folder(spark: SparkSession, sf_dir: str) -> str:
    return _csv_folder(spark.sparkContext.applicationId, sf_dir)


def _digest(df: DataFrame) -> DataFrame:
    """Whole texts by md5 and length, to keep the comparison small."""
    for name in ("prompt", "chosen", "rejected"):
        df = df.withColumn(f"{name}_chars", F.length(name)).withColumn(name, F.md5(name))
    return df


@register
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference_csv.read_preference_csv(spark, _folder(spark, sf_dir))
    ids = [F.col(c).cast("bigint").alias(c) for c in ("pair_id", "prompt_id")]
    known = [c for c in PREFERENCE_SCHEMA.names if c != "prompt_id"]
    return _rounded(_digest(pairs.select(*ids, *known, "note")))


@register
def source_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = preference_csv.source_provenance(spark, _folder(spark, sf_dir))
    name = F.regexp_extract(preference_csv.SOURCE_FILE, r"\.([^./]+?)(\.gz)?$", 1)
    return files.groupBy(name.alias("suffix")).agg(
        F.sum("rows").alias("rows"), (F.count_distinct(preference_csv.SOURCE_FILE) >= 3).alias("several_files")
    )


@register
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = tables.preference_pairs(spark, sf_dir)
    plain = pairs.where("is_tie = 0").select("pair_id", "prompt_category", "chosen_temperature", "reading_time_s")
    noted = pairs.where("is_tie = 1").select("reading_time_s", "pair_id", F.col("event_type").alias("note"))
    unknown = pairs.where("is_tie is null").select("chosen_temperature", "prompt_category", "pair_id")
    return _rounded(preference_csv.union_by_name([plain, noted, unknown]))


@register
def view_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _whole_data(spark, sf_dir).write_views(scratch_path(spark, "views"))
    stored = [
        sinks.read_view(spark, paths["sft"]).select("split", F.lit("sft").alias("view"), "prompt", "category"),
        sinks.read_view(spark, paths["reward"]).select("split", F.lit("reward").alias("view"), "prompt", "category"),
        sinks.read_view(spark, paths["ppo"]).select("split", F.lit("ppo").alias("view"), "prompt", "category"),
    ]
    return (
        preference_csv.union_by_name(stored)
        .withColumn("prompt", F.md5("prompt"))
        .groupBy("view", "split", "category", "prompt")
        .agg(F.count("*").alias("n"))
    )


def _sft_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tables.rollout_tokens(spark, sf_dir)
    loss = tokens.agg(
        F.avg(F.when(F.col("mask"), -F.col("old_lp"))).alias("loss"), F.count("*").alias("tokens")
    ).withColumn("perplexity", statistics.perplexity(F.col("loss"), MAX_LOSS_FOR_PERPLEXITY))
    sizes = _labelled(spark, sf_dir).agg(
        F.count("*").alias("usable_pairs"), F.count_if(F.col("split") == "val").alias("val_pairs")
    )
    return stage_record("sft", sizes, {"num_epochs": 3}, {"eval": (loss, "tokens")})


def _reward_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _labelled(spark, sf_dir)
    ranking = evaluate.pairwise_evaluation(labelled.where("split = 'val'"))
    sizes = labelled.agg(F.count("*").alias("usable_pairs"))
    return stage_record("reward", sizes, {"num_epochs": 3}, {"eval": (ranking, "pairs")})


def _run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    duel = evaluate.win_rate(evaluate.pair_policies(tables.policy_scores(spark, sf_dir)))
    metrics = rollout.run_metrics(_history(spark, sf_dir), by=())
    usable = _usable(spark, sf_dir).agg(F.count("*").alias("usable_pairs"))
    return stage_record("ppo", metrics, PolicyRunSettings(), {"eval": (duel, "prompts")}, usable)


@partial(register, name="stage_record")
def stage_record_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = _run_record(spark, sf_dir)
    nested = [F.col(f"eval.{c}").alias(f"eval_{c}") for c in record.schema["eval"].dataType.names]
    return _rounded(record.select(*[c for c in record.columns if c != "eval"], *nested))


@register
def stage_record_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_reward_record(spark, sf_dir).select("stage", "num_epochs", "usable_pairs", "eval.*"))


def _whole_data(spark: SparkSession, sf_dir: str) -> CuratedData:
    """Curated pairs with all texts, stored once for all views."""
    with shuffles_freed(spark):
        labelled = stored(_labelled_whole(spark, sf_dir), "labelled")
    prompts = tables.distinct_prompts(labelled, sf_dir)
    return CuratedData(tables.preference_pairs(spark, sf_dir), labelled, CurationSettings(), prompts=prompts)


def _written_counts(spark: SparkSession, sf_dir: str) -> tuple[CuratedData, dict[str, dict[str, int]]]:
    data = _whole_data(spark, sf_dir)
    return data, data.write_counted_views(scratch_path(spark, "views"))


@register
def view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every written view and split, as the sink counted them."""
    _, counts = _written_counts(spark, sf_dir)
    rows = [(view, split, n) for view, of_split in counts.items() for split, n in of_split.items()]
    return spark.createDataFrame(rows, "view string, split string, n long")


@register
def stage_record_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole record of ranking-model training, with both evaluations."""
    data, counts = _written_counts(spark, sf_dir)
    held_out = data.labelled.where("split = 'val'")
    record = training_record(
        "reward",
        counts["reward"],
        sum(counts["reward"].values()),
        TrainingSettings(learning_rate=1e-4),
        {
            "eval_loss": (evaluate.ranking_loss(held_out), "pairs"),
            "eval_ranking": (evaluate.pairwise_evaluation(held_out), "pairs"),
        },
    )
    names = [c for c in record.columns if not c.startswith("eval_")]
    return _rounded(record.select(*names, "eval_loss.loss", "eval_ranking.*"))


@register
def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(_sft_record(spark, sf_dir), path)
    return _rounded(spark.read.json(path).select("stage", "num_epochs", "usable_pairs", "val_pairs", "eval.*"))


@register
def metrics_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "logs")
    for stage, record in {"sft": _sft_record, "reward": _reward_record, "ppo": _run_record}.items():
        sinks.write_metrics(record(spark, sf_dir), f"{root}/{stage}")
    found = sinks.read_metrics(spark, root)
    folder = F.element_at(F.split("path", "/"), -2)
    return found.select(folder.alias("folder"), "stage", "usable_pairs", F.col("eval").isNotNull().alias("has_eval"))


# Curation


@register
def filter_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.drop_ties(tables.preference_pairs(spark, sf_dir)).select("pair_id", "is_tie")


@register
def filter_reading_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = curate.keep_plausible_reading_times(tables.preference_pairs(spark, sf_dir))
    return _rounded(kept.select("pair_id", "reading_time_s"))


@register
def filter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.filter_statistics(tables.preference_pairs(spark, sf_dir))


@register
def sft_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.supervised_view(_labelled(spark, sf_dir, REJECTED_FIRST))


@register
def reward_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(views.reward_view(_labelled_whole(spark, sf_dir)))


@register
def ppo_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.prompt_view(_labelled(spark, sf_dir, PROMPT_LAST))


@register
def dedup_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = views.first_per_prompt(_labelled(spark, sf_dir, PROMPT_LAST))
    return first.select("split", "prompt_id", F.md5("prompt").alias("prompt"), "prompt_category")


@register
def sample_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sample_prompt(_labelled(spark, sf_dir, PROMPT_LAST))


@register
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = text.scoring_text(F.col("prompt"), F.col("chosen"))
    previews = tables.with_document(_usable_with_prompts(spark, sf_dir), sf_dir, "chosen").select(
        "pair_id",
        "rejected_doc",
        views.preview(F.col("prompt"), 80).alias("prompt_preview"),
        text.continuation(full, F.col("prompt"), 300).alias("continuation"),
    )
    return tables.with_document(previews, sf_dir, "rejected").select(
        "pair_id", "prompt_preview", views.preview(F.col("rejected"), 100).alias("rejected_preview"), "continuation"
    )


@register
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = _usable(spark, sf_dir, PROMPT_LAST)
    return usable.select("pair_id", text.chat_format(F.col("prompt")).alias("formatted"))


@register
def scoring_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = text.chat_format(F.col("prompt"))
    pairs = _usable_with_prompts(spark, sf_dir)
    for side in ("chosen", "rejected"):
        scored = text.scoring_text(prompt, F.col(side))
        pairs = (
            tables.with_document(pairs, sf_dir, side)
            .withColumn(f"{side}_text_md5", F.md5(scored))
            .withColumn(f"{side}_text_chars", F.length(scored))
            .drop(side)
        )
    return pairs.select("pair_id", *[f"{side}_text_{x}" for x in ("md5", "chars") for side in ("chosen", "rejected")])


@register
def length_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _usable(spark, sf_dir, REJECTED_FIRST).select(
        "pair_id", "prompt", text.scoring_text(F.col("prompt"), F.col("chosen")).alias("text")
    )
    capped = views.cap_length(views.cap_length(texts, "prompt", MAX_PROMPT_TOKENS), "text", MAX_TEXT_TOKENS)
    return capped.withColumn("prompt", F.md5("prompt")).withColumn("text", F.md5("text"))


@register
def scoring_text_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a scorer reads of both responses."""
    pairs = _usable_with_prompts(spark, sf_dir)
    for side in ("chosen", "rejected"):
        pairs = views.capped_scoring_texts(tables.with_document(pairs, sf_dir, side), sides=(side,))
        pairs = pairs.withColumn(f"{side}_text", F.md5(f"{side}_text")).drop(side)
    return pairs.select(
        "pair_id", "chosen_text", "rejected_text", "chosen_text_was_truncated", "rejected_text_was_truncated"
    )


# Splits and samples


@register
def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("pair_id", "prompt_category", "split")


@register
def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_pairs(_usable(spark, sf_dir), category=None).select("pair_id", "split")


@register
def stratify_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratify_decision(_usable(spark, sf_dir))


@partial(register, name="subsample")
def subsample_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subsample.subsample(_train_half(spark, sf_dir), 0.6).select("pair_id", "prompt_category")


@register
def fraction_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subsample.fraction_sweep(_train_half(spark, sf_dir)).select("fraction", "pair_id")


@register
def batch_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.batch_manifest(_usable(spark, sf_dir))


def _training_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts that policy training draws from: those with a pair in the training split."""
    return _labelled(spark, sf_dir).where("split = 'train'").select("prompt_id")


@register
def train_batch_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.batch_manifest(_training_prompts(spark, sf_dir))


@register
def train_steps_per_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.steps_per_epoch(_training_prompts(spark, sf_dir))


@register
def steps_per_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.steps_per_epoch(_usable(spark, sf_dir))


# Reports


@register
def view_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.view_sizes(_labelled(spark, sf_dir))


@register
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.category_counts(_labelled(spark, sf_dir))


@register
def token_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(report.token_means(_usable(spark, sf_dir)))


@register
def median_reading_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(report.median_reading_time(_usable(spark, sf_dir)))


def _flat_map(column: str) -> Column:
    pairs = F.transform(F.array_sort(F.map_entries(column)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(pairs, ",").alias(column)


@register
def metadata_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.preference_pairs(spark, sf_dir)
    full = CuratedData(raw, _labelled(spark, sf_dir), CurationSettings()).metadata()
    columns = [
        _flat_map(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name)
        for f in full.schema.fields
        if f.name != "source_files"
    ]
    return _rounded(full.select(*columns))


# Evaluation


def _turns(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """User turns, and assistant turns under the number of the turn they answer."""
    turns = tables.table(spark, sf_dir, "conversations")
    prompts = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    completions = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("completion")
    )
    return prompts, completions


@register
def join_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = evaluate.join_completions(*_turns(spark, sf_dir), ("conv_id", "turn"), strict=False)
    return joined.select("conv_id", "turn", text.scoring_text(F.col("prompt"), F.col("completion")).alias("text"))


@register
def unpaired_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``join_completions`` leaves out or multiplies."""
    return evaluate.unpaired_keys(*_turns(spark, sf_dir), ("conv_id", "turn"))


@register
def score_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = evaluate.with_margin(_usable(spark, sf_dir))
    return _rounded(scored.select("pair_id", "margin", statistics.is_win(F.col("margin")).alias("win")))


@register
def pairwise_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.pairwise_evaluation(_usable(spark, sf_dir)))


@register
def category_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.category_evaluation(_usable(spark, sf_dir)))


@register
def policy_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.pair_policies(tables.policy_scores(spark, sf_dir))


@register
def win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.win_rate(evaluate.pair_policies(tables.policy_scores(spark, sf_dir))))


@register
def normal_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = (F.col("chosen_temperature") * 100 + 0.5) / 100
    quantile = statistics.normal_quantile(p)
    return _rounded(tables.preference_pairs(spark, sf_dir).select("pair_id", quantile.alias("z")))


@register
def sample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = evaluate.category_evaluation(_usable(spark, sf_dir))
    return evaluated.select(
        "category",
        "is_total",
        statistics.required_sample_size(F.col("accuracy")).alias("needed"),
        statistics.required_sample_size(F.lit(0.5) - F.col("accuracy") / 2).alias("needed_below_chance"),
    )


@register
def wilson_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_prompt = (
        evaluate.with_margin(_usable(spark, sf_dir))
        .groupBy("prompt_id")
        .agg(F.avg(statistics.is_win(F.col("margin")).cast("double")).alias("accuracy"), F.count("*").alias("n"))
    )
    interval = statistics.wilson_interval(F.col("accuracy"), F.col("n"))
    return _rounded(by_prompt.select("prompt_id", "n", interval["low"].alias("low"), interval["high"].alias("high")))


@register
def power_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.power_report(evaluate.category_evaluation(_usable(spark, sf_dir))))


@register
def curve_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    sweep = subsample.fraction_sweep(_train_half(spark, sf_dir))
    evaluated = evaluate.category_evaluation(sweep, by=("fraction",))
    return _rounded(evaluate.curve_table(evaluated))


# Rollouts


def _sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored, as step moments and advantages start from the same sequences."""
    tokens, rewards = tables.rollout_tokens(spark, sf_dir), tables.rollout_rewards(spark, sf_dir)
    return stored(rollout.rewarded_sequences(tokens, rewards), "sequences")


def _loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = stored(rollout.update_sums(tables.rollout_updates(spark, sf_dir)), "update-sums")
    sequences = rollout.sequences_of(sums, tables.rollout_rewards(spark, sf_dir))
    return rollout.surrogate_loss(sums, rollout.advantages(sequences))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollout.step_history(tables.rollout_updates(spark, sf_dir), tables.rollout_rewards(spark, sf_dir))


@register
def response_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = text.response_tokens(F.col("token_ids"), tables.RESPONSE_START, F.lit(tables.PAD))
    return tables.responses(spark, sf_dir).select("doc_id", F.posexplode(kept).alias("place", "token"))


@register
def response_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = text.response_mask(F.col("token_ids"), tables.RESPONSE_START, F.lit(tables.PAD))
    return tables.responses(spark, sf_dir).select("doc_id", F.posexplode(mask).alias("position", "in_response"))


@register
def kl_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tables.positioned_tokens(spark, sf_dir)
    policy = tokens.select("run_id", "step_id", "seq_id", "pos", "old_lp")
    reference = tokens.select("run_id", "step_id", "seq_id", "pos", "ref_lp")
    kl = rollout.join_log_probs(policy, reference)
    return _rounded(kl.select("run_id", "seq_id", "pos", "kl"))


@register
def kl_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KL estimates kept in arrays, unfolded for their place only."""
    sequences = rollout_arrays.with_token_kl(tables.rollout_arrays(spark, sf_dir))
    return _rounded(sequences.select("run_id", "seq_id", F.posexplode("kl").alias("place", "kl")))


@register
def sequence_mean_kl_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollout_arrays.sequence_statistics(tables.rollout_arrays(spark, sf_dir)))


@register
def clip_fraction_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollout_arrays.clip_fraction(tables.rollout_arrays(spark, sf_dir)))


@register
def surrogate_loss_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = tables.rollout_arrays(spark, sf_dir)
    rewarded = rollout.penalise(
        rollout_arrays.sequence_statistics(sequences).join(tables.rollout_rewards(spark, sf_dir), rollout.SEQUENCE),
        PolicyRunSettings().kl_coefficient,
    )
    advantage = rollout.advantages(rewarded).select(*rollout.SEQUENCE, "advantage")
    return _rounded(rollout_arrays.surrogate_loss(sequences.join(advantage, rollout.SEQUENCE)))


@register
def sequence_mean_kl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollout.sequence_statistics(tables.rollout_tokens(spark, sf_dir)))


@register
def response_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollout.response_lengths(tables.rollout_tokens(spark, sf_dir)))


@register
def penalised_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_sequences(spark, sf_dir).select("run_id", "step_id", "seq_id", "reward", "total_reward"))


@register
def advantages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollout.advantages(_sequences(spark, sf_dir)).drop("total_reward"))


@register
def reward_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = rollout.step_metrics(_sequences(spark, sf_dir)).select("run_id", "step_id", "mean_total_reward")
    return _rounded(rollout.reward_baseline(steps))


@register
def clip_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollout.clip_fraction(tables.rollout_updates(spark, sf_dir)))


@register
def surrogate_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_loss(spark, sf_dir))


@register
def update_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_history(spark, sf_dir).select("run_id", "step_id", "policy_loss", "clip_fraction", "updates"))


@register
def step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollout.step_metrics(_sequences(spark, sf_dir)).drop("std_total_reward"))


@register
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollout.run_metrics(_history(spark, sf_dir)))


@register
def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollout.token_perplexity(tables.rollout_tokens(spark, sf_dir)))


# Preference model


SCORING_BUDGET = 8 * MAX_TEXT_TOKENS


def _words_minus_commas(batch: pd.Series) -> pd.Series:
    return batch.str.count(r"\S+") * 0.25 - batch.str.count(",")


@register
def bulk_score_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _usable(spark, sf_dir).select("pair_id", "chosen", "rejected")
    scored = model.score_with(
        pairs, _words_minus_commas, {"chosen": "chosen_score", "rejected": "rejected_score"}
    )
    return _rounded(scored.drop("chosen", "rejected"))


@register
def bulk_score_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _usable(spark, sf_dir).select("pair_id", "chosen", "rejected")
    texts = {"chosen": "chosen_score", "rejected": "rejected_score"}
    scored = model.score_within_budget(pairs, _words_minus_commas, texts, SCORING_BUDGET)
    return _rounded(scored.drop("chosen", "rejected"))


@register
def preference_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = model.fit_preferences(model.pair_features(_usable(spark, sf_dir)))
    return model.weights_table(fitted, spark)


@register
def bulk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _labelled(spark, sf_dir).select("pair_id", "chosen", "rejected", "split")
    fitted = model.fit_preferences(model.pair_features(labelled.where("split = 'train'")))
    held_out = labelled.where("split = 'val'")
    scored = model.score_with_model(held_out, fitted, {"chosen": "chosen_score", "rejected": "rejected_score"})
    return scored.select("pair_id", "chosen_score", "rejected_score")


@register
def learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_learning_curve(tables.preference_pairs(spark, sf_dir)).results


@register
def nested_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five models from shared passes: what each learned from, and its gradient, which is 0 at the solution."""
    settings = PreferenceModelSettings(portable_hash=True)
    train = _train_half(spark, sf_dir).select("pair_id", "prompt_category", "chosen", "rejected")
    fitted = model.fit_fractions(train, settings=settings).table(spark)
    sums = [F.col(c).cast("long").alias(c) for c in ("difference_sum", "square_sum")]
    return _rounded(fitted.select("fraction", "feature", "train_pairs", *sums, "gradient"))
