"""Every registered query with SQL counterpart, on whole tables of the smallest scale."""

import pytest
from compare import connect, duckdb_rows, spark_rows

from __spark_entry__ import entry, oracle_sql, queries
from pairloom.queries.catalog import REGISTRY
from pairloom.queries.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, database, name):
    got = spark_rows(queries()[name](spark, SF))
    expected = duckdb_rows(database, ORACLE[name])
    assert got[0] == expected[0]
    assert got[1] == expected[1]
    assert got[1]


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(REGISTRY) - set(ORACLE) == {"preference_fit", "bulk_score", "learning_curve"}


def test_flagship_numbers(spark):
    row = entry(spark).first()
    assert (row.total_rows, row.ties_removed, row.tie_unknown) == (1000, 119, 9)
    assert (row.too_fast, row.too_slow, row.usable_pairs) == (3, 32, 837)
    assert row.categories == "de=94,en=539,es=119,fr=85"
    assert row.median_reading_time_s == 132.04
    assert row.ppo_val_prompts <= 50 and row.val_pairs == 168
