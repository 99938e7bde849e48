"""Training views of the labelled table."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import ChatTemplate, chat_format, scoring_text
from pairloom.settings import MAX_TEXT_TOKENS


def supervised_view(labelled: DataFrame) -> DataFrame:
    """Preferred responses as targets."""
    return labelled.select(
        "split", "prompt", F.col("chosen").alias("completion"), F.col("prompt_category").alias("category")
    )


def reward_view(labelled: DataFrame) -> DataFrame:
    """Chosen and rejected responses with their generation data."""
    return labelled.select(
        "split",
        "prompt",
        "chosen",
        "rejected",
        F.col("prompt_category").alias("category"),
        "chosen_temperature",
        "rejected_temperature",
        "chosen_output_tokens",
        "rejected_output_tokens",
    )


def first_per_prompt(labelled: DataFrame) -> DataFrame:
    """One row per (split, prompt_id): the one with the smallest row key.

    The aggregation keeps at most one row per prompt and task before the shuffle.
    """
    kept = F.min_by(F.struct("prompt", "prompt_category"), "row_key").alias("kept")
    return labelled.groupBy("split", "prompt_id").agg(kept).select("split", "prompt_id", "kept.*")


def prompt_view(labelled: DataFrame) -> DataFrame:
    """Distinct prompts for on-policy sampling."""
    return first_per_prompt(labelled).select("split", "prompt", F.col("prompt_category").alias("category"))


def format_chats(view: DataFrame, template: ChatTemplate = ChatTemplate(), column: str = "prompt") -> DataFrame:
    return view.withColumn(column, chat_format(F.col(column), template))


def cap_length(df: DataFrame, column: str, max_tokens: int) -> DataFrame:
    """Cut a text to its first whitespace tokens, joined by blanks, if it has too many.

    Adds ``<column>_was_truncated``. Tokens are searched once per text and only up to the cap, in Arrow batches.
    """
    cut, flag = f"_{column}_cut", f"{column}_was_truncated"
    return (
        df.withColumn(cut, _cut_after(max_tokens)(F.col(column)))
        .withColumn(flag, F.when(F.col(column).isNotNull(), F.col(cut).isNotNull()))
        .withColumn(column, F.coalesce(cut, column))
        .drop(cut)
    )


def _cut_after(max_tokens: int):
    """Column function: the first tokens of a text that has more of them, joined by blanks; otherwise null.

    Bytes are split at ASCII white space, as ``\\s`` does in Java.
    """

    def cut(text: bytes | None) -> bytes | None:
        tokens = text.split(None, max_tokens) if text is not None else []
        return b" ".join(tokens[:max_tokens]) if len(tokens) > max_tokens else None

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([cut(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary()).cast(pa.string())

    return run


def capped_scoring_texts(
    pairs: DataFrame,
    max_tokens: int = MAX_TEXT_TOKENS,
    template: ChatTemplate = ChatTemplate(),
    sides: Sequence[str] = ("chosen", "rejected"),
) -> DataFrame:
    """``chosen_text`` and ``rejected_text``: the chat-formatted prompt and a response, each cut to the cap on its own.

    Adds ``chosen_text_was_truncated`` and ``rejected_text_was_truncated``. A null prompt or response gives a null text.
    ``sides`` names the responses to do, where they come one after the other.
    """
    prompt = chat_format(F.col("prompt"), template)
    for side in sides:
        pairs = pairs.withColumn(f"{side}_text", scoring_text(prompt, F.col(side)))
    for side in sides:
        pairs = cap_length(pairs, f"{side}_text", max_tokens)
    return pairs


def sample_prompt(labelled: DataFrame) -> DataFrame:
    """A prompt to look at: from 'val' if there is one, otherwise from 'train'."""
    order = F.struct((F.col("split") != "val").alias("later"), F.col("row_key"))
    return labelled.agg(
        F.min_by("prompt", order).alias("prompt"), F.min_by("split", order).alias("split")
    )


def preview(text: Column, length: int = 80) -> Column:
    return F.substring(text, 1, length)
