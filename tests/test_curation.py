"""Filters, views, reports and the exact median."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from pairloom.functions.text import (
    chat_format,
    chat_messages,
    continuation,
    masked_mean,
    response_mask,
    response_tokens,
)
from pairloom.operators import median
from pairloom.operators.curate import drop_ties, filter_statistics, keep_plausible_reading_times
from pairloom.operators.median import exact_median
from pairloom.operators.report import category_counts, metadata_report, view_sizes
from pairloom.operators.views import cap_length, capped_scoring_texts, first_per_prompt, prompt_view, sample_prompt


def test_reading_time_edges(spark):
    rows = [(math.nan,), (None,), (1.0,), (2.0,), (600.0,), (600.1,)]
    df = spark.createDataFrame(rows, "reading_time_s double")
    kept = [r.reading_time_s for r in keep_plausible_reading_times(df).collect()]
    assert sorted(kept, key=str) == [2.0, 600.0, None, None]


def test_tie_flags(spark):
    df = spark.createDataFrame([(0, 5.0), (1, 5.0), (None, 5.0)], "is_tie int, reading_time_s double")
    assert [r.is_tie for r in drop_ties(df).collect()] == [0]
    row = filter_statistics(df).first()
    assert (row.ties_removed, row.tie_unknown, row.usable_pairs) == (1, 1, 1)


def test_bounds_that_exclude_everything(spark):
    df = spark.createDataFrame([(0, 7.0), (0, 12.0), (0, 3.0)], "is_tie int, reading_time_s double")
    row = filter_statistics(df, 10, 5).first()
    assert (row.quality_filtered, row.too_fast, row.too_slow, row.usable_pairs) == (3, 2, 2, 0)


@pytest.mark.parametrize(
    "values",
    [[], [3.0], [1.0, 2.0], [5.0] * 400 + [1.0, 9.0], [float(i * i % 997) for i in range(3001)], [None, math.nan, 4.0]],
)
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    clean = [v for v in values if v is not None and not math.isnan(v)]
    assert exact_median(df, "v") == (statistics.median(clean) if clean else None)


def test_median_recovers_from_a_bad_bracket(spark):
    df = spark.range(1, 102).select(F.col("id").cast("double").alias("v"))
    assert exact_median(df, "v", (80.0, 90.0, 101)) == 51.0
    assert exact_median(df, "v", (1.0, 5.0, 101)) == 51.0


def test_median_narrows_a_large_bracket(spark, monkeypatch):
    monkeypatch.setattr(median, "ORDERED_IN_ONE_TASK", 5)
    monkeypatch.setattr(median, "MARGIN", 0.2)
    values = [float((i * 7919) % 1000) for i in range(1000)] + [500.0] * 300
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    assert exact_median(df, "v") == statistics.median(values)


def labelled(spark):
    rows = [
        ("train", 1, "p1", "a", "02"),
        ("train", 1, "p1 later", "b", "05"),
        ("train", None, "n1", "a", "01"),
        ("train", None, "n2", "a", "00"),
        ("val", 1, "p1 val", "a", "09"),
        ("val", 2, "p2", None, "04"),
    ]
    return spark.createDataFrame(
        rows, "split string, prompt_id long, prompt string, prompt_category string, row_key string"
    )


def test_dedup_keeps_the_first_and_one_null(spark):
    got = {(r.split, r.prompt_id, r.prompt) for r in first_per_prompt(labelled(spark)).collect()}
    assert got == {("train", 1, "p1"), ("train", None, "n2"), ("val", 1, "p1 val"), ("val", 2, "p2")}
    assert prompt_view(labelled(spark)).count() == 4


def test_sizes_counts_and_sample(spark):
    sizes = {r.split: (r.pairs, r.prompts) for r in view_sizes(labelled(spark)).collect()}
    assert sizes == {"train": (4, 2), "val": (2, 2)}
    counts = {(r.split, r.prompt_category): r.n for r in category_counts(labelled(spark)).collect()}
    assert counts == {
        ("train", "a"): 3,
        ("train", "b"): 1,
        ("val", "a"): 1,
        (None, "a"): 4,
        (None, "b"): 1,
    }
    assert sample_prompt(labelled(spark)).first().prompt == "p2"
    assert sample_prompt(labelled(spark).where("split = 'train'")).first().prompt == "n2"


def test_report_agrees_with_its_parts(spark):
    table = labelled(spark).select(
        "*",
        F.lit(0).alias("is_tie"),
        F.lit(5.0).alias("reading_time_s"),
        F.lit(3).alias("chosen_output_tokens"),
        F.lit(4).alias("rejected_output_tokens"),
    )
    row = metadata_report(table, table, source_files=["x.csv"]).first()
    assert row.source_files == ["x.csv"] and row.num_source_files == 1
    assert (row.train_pairs, row.ppo_train_prompts, row.val_pairs, row.ppo_val_prompts) == (4, 2, 2, 2)
    assert list(row.categories.items()) == [("a", 4), ("b", 1)]
    assert row.val_categories == {"a": 1}
    assert (row.avg_chosen_tokens, row.median_reading_time_s) == (3.0, 5.0)
    empty = metadata_report(table.limit(0), table.limit(0)).first()
    assert (empty.total_rows, empty.train_pairs, empty.categories, empty.median_reading_time_s) == (0, 0, {}, None)


def test_length_cap(spark):
    texts = ["", "  ", "a b", " a b ", "a\tb\nc", "a  b  c  d "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t0: (r.t, r.t_was_truncated) for r in cap_length(df.withColumn("t0", F.col("t")), "t", 2).collect()}
    assert got == {
        "": ("", False),
        "  ": ("  ", False),
        "a b": ("a b", False),
        " a b ": (" a b ", False),
        "a\tb\nc": ("a b", True),
        "a  b  c  d ": ("a b", True),
    }


def test_scoring_texts_are_cut_one_by_one(spark):
    rows = [(1, "how so", "a b c d e f g h", "a"), (2, "how", None, "x\ty"), (3, None, "a", "b")]
    df = spark.createDataFrame(rows, "pair_id long, prompt string, chosen string, rejected string")
    frame = chat_format(F.lit("how so"))
    words = len(df.select(F.split(frame, r"\s+").alias("t")).first().t) - 1
    got = {r.pair_id: r for r in capped_scoring_texts(df, words + 3).collect()}
    assert got[1].chosen_text.split()[-3:] == ["a", "b", "c"] and got[1].chosen_text_was_truncated
    assert got[1].rejected_text.endswith("assistant\na") and not got[1].rejected_text_was_truncated
    assert got[2].chosen_text is None and got[2].rejected_text.endswith("x\ty")
    assert got[3].chosen_text is None and got[3].rejected_text is None


def test_token_arrays(spark):
    df = spark.createDataFrame([(["q", "a", "PAD", "b", "PAD"],), ([],)], "ids array<string>")
    pad = F.lit("PAD")
    rows = df.select(
        response_tokens(F.col("ids"), 1, pad).alias("kept"),
        response_mask(F.col("ids"), 1, pad).alias("mask"),
        response_mask(F.col("ids"), 0, pad).alias("from_start"),
    ).collect()
    assert rows[0].kept == ["a", "b"] and rows[0]["mask"] == [False, True, False, True, False]
    assert rows[0].from_start == [False, True, False, True, False]
    assert rows[1].kept == [] and rows[1]["mask"] == []
    means = spark.createDataFrame(
        [([1.0, 3.0], [True, False]), ([1.0], [False])], "v array<double>, m array<boolean>"
    ).select(masked_mean(F.col("v"), F.col("m")).alias("mean"))
    assert [r.mean for r in means.collect()] == [1.0, 0.0]


def test_chat(spark):
    row = spark.range(1).select(
        chat_format(F.lit("hi")).alias("text"),
        chat_messages(F.lit("hi")).alias("messages"),
        continuation(F.lit("prompt and more"), F.lit("prompt"), 4).alias("rest"),
    ).first()
    assert row.text.endswith("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n")
    assert [(m.role, m.content) for m in row.messages][1] == ("user", "hi")
    assert row.rest == " and"
