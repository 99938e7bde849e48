"""Whole-table queries where one key holds a third of all rows, against SQL."""

import shutil
from pathlib import Path

import pandas as pd
import pytest
from compare import connect, duckdb_rows, spark_rows

from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"
CHECKED = (
    "category_counts dedup_prompts split_stratified split_random fraction_sweep batch_manifest view_sizes "
    "wilson_interval metadata_report median_reading_time category_eval kl_join sequence_mean_kl "
    "response_lengths advantages reward_baseline clip_fraction surrogate_loss run_metrics response_mask"
).split()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A hot prompt and hot responses; a hot sequence in a hot step; a third equal times; one
    language; and tokens that are copies of one another."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in ("orders", "conversations"):  # contents only: the given files are read-only
        shutil.copyfile(f"{SF}/{name}.parquet", folder / f"{name}.parquet")
    documents = pd.read_parquet(f"{SF}/documents.parquet")
    documents.loc[documents.index % 10 != 0, "lang"] = "en"
    documents.to_parquet(folder / "documents.parquet")
    events = pd.read_parquet(f"{SF}/events.parquet")
    third = events.index % 3 == 0
    events.loc[third, "event_id"] = 10**6 + events.index[third] * (len(documents) // 4)
    events.loc[third, "value"] = 30.0
    events.to_parquet(folder / "events.parquet")
    lines = pd.read_parquet(f"{SF}/lineitem.parquet")
    third = lines.index % 3 == 0
    lines.loc[third, "l_orderkey"] = lines["l_orderkey"].iloc[0]
    sixth = lines.index % 6 == 0
    copies = lines.iloc[[0] * int(sixth.sum())]
    pd.concat([lines[~sixth], copies]).to_parquet(folder / "lineitem.parquet")
    return str(Path(folder))


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql_under_skew(spark, skewed, name):
    got = spark_rows(queries()[name](spark, skewed))
    expected = duckdb_rows(connect(skewed), oracle_sql()[name])
    assert got[0] == expected[0]
    assert got[1] == expected[1]
