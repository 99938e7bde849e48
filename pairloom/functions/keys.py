"""Deterministic row order: an md5 key that does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seeded_md5(seed: int, *parts: Column) -> Column:
    """md5 of the seed and the parts joined by '|'; a null part counts as empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))


def row_key(df: DataFrame, seed: int, id_column: str | None = "pair_id") -> Column:
    """Key of a row: from its id if the table has one, otherwise from all its columns.

    Identical rows without an id share a key. They are interchangeable, and the cut
    operators count how many of them fall on each side.
    """
    if id_column in df.columns:
        return seeded_md5(seed, F.col(id_column))
    return seeded_md5(seed, F.to_json(F.struct(*df.columns)))


def stratum_key(category: Column) -> Column:
    """A non-null text per category, with null as its own stratum."""
    return F.coalesce(F.concat(F.lit("="), category.cast("string")), F.lit("null"))


def key_bucket(key: Column, digits: int) -> Column:
    """Leading hex digits of an md5 key: evenly filled, and ordered like the key."""
    return F.substring(key, 1, digits)
