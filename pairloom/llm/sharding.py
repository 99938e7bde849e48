"""Sharding along a Hilbert curve over several metadata dimensions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.llm.common import load, stored

BITS = 5
SHARDS = 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of rows of cell numbers, each below 2**bits.

    The axes are turned into the transposed index by undoing, from the top bit down, the
    rotation of each sub-cube, and its bits are then interleaved. Neighbours on the curve
    differ by one in one dimension.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def quantised(df: DataFrame, dimensions: dict[str, str], bits: int) -> list[Column]:
    """A cell number for each dimension: quantile cells for numbers, hash cells for categories.

    Equal values share a cell, so a predicate on the value selects whole cells. Nulls are in cell 0.
    """
    cells = 1 << bits
    numbers = [name for name, kind in dimensions.items() if kind == "number"]
    steps = [i / cells for i in range(1, cells)]
    found = df.agg(*[F.percentile_approx(F.col(n).cast("double"), steps, 10_000).alias(n) for n in numbers]).first() if numbers else {}
    columns = []
    for name, kind in dimensions.items():
        if kind == "number":
            cuts = sorted(set(found[name] or []))
            bounds = F.array(*[F.lit(float(c)) for c in cuts]) if cuts else F.array().cast("array<double>")
            value = F.col(name).cast("double")
            cell = F.size(F.filter(bounds, lambda bound: bound < value))
        else:
            cell = F.pmod(F.xxhash64(F.col(name)), F.lit(cells))
        columns.append(F.coalesce(F.when(F.col(name).isNotNull(), cell), F.lit(0)).cast("int").alias(f"cell_{name}"))
    return columns


def curve_order(df: DataFrame, dimensions: dict[str, str], ties: list[str], bits: int = BITS) -> DataFrame:
    """Add `curve` (index on the curve) and `rank` (exact position, gapless from 0) to every row.

    Rows are sorted by curve index, the tie columns and a number that tells repeated rows apart,
    by one range shuffle; repeated rows therefore cannot fill one range. The position inside
    a range is added to the counts of the ranges before it, of which there are as many as shuffle
    partitions.
    """
    spark = df.sparkSession

    @F.pandas_udf("long")
    def curve(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(), bits))

    cells = quantised(df, dimensions, bits)
    keyed = df.withColumn("curve", curve(F.struct(*cells))).withColumn("_copy", F.monotonically_increasing_id())
    keyed = stored(keyed, "curve")
    order = ["curve", *ties, "_copy"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("_at", F.monotonically_increasing_id()).drop("_copy"), "ranged")
    part = F.shiftright("_at", 33).cast("int")
    counts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_at").bitwiseAND((1 << 33) - 1)
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("rank", F.col("_before") + inside)
        .drop("_part", "_before", "_at")
    )


def hilbert_shards(
    df: DataFrame, dimensions: dict[str, str], ties: list[str], shards: int = SHARDS, bits: int = BITS
) -> DataFrame:
    """Cut the curve order into runs of equal row counts (at most one apart): `shard` and `slot`.

    Null metadata take cell 0, repeated rows and ties get places of their own, an empty table
    gives no rows, and there are empty shards if there are fewer rows than shards.
    """
    total = df.count()
    ranked = curve_order(df, dimensions, ties, bits)
    shard = f"((rank * {shards}) div {max(total, 1)})"
    first = f"(({shard} * {total} + {shards - 1}) div {shards})"
    return ranked.withColumn("slot", F.expr(f"rank - {first}").cast("long")).withColumn(
        "shard", F.expr(shard).cast("int")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of files per shard, in curve order, so that file statistics prune on every dimension."""
    sharded.repartitionByRange(F.col("shard"), F.col("rank")).sortWithinPartitions("rank").write.partitionBy(
        "shard"
    ).parquet(path)


def op3_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = documents.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    dimensions = {"size": "number", "lang": "category", "source": "category", "doc_id": "number"}
    sharded = hilbert_shards(narrow, dimensions, ["text_crc32", "doc_id"])
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("curve").alias("curve_index"),
    )
