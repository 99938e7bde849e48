"""Exact 'first k rows of each stratum by key' without sorting a stratum in one task.

Rows carry a stratum and an md5 key. A histogram over (stratum, leading key digits) shows
in which bucket the k-th key lies; only the rows of that one bucket are ordered to find the
cut key. Choosing rows is then a comparison with the cut key: no shuffle of the rows, however
many of them share a stratum. The number of hex digits sets the size of a bucket (3 digits
split a stratum into 4,096).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.keys import key_bucket, seeded_md5
from pairloom.session import broadcast_if, cut_lineage, fits_broadcast

STRATUM = "_stratum"
KEY = "_cut_key"
COPY = "_copy_no"
BUCKET = "_bucket"
DIGITS = 3
KEY_DIGITS = 32
ROWS_PER_BUCKET = 1_000_000
COPIES_PER_CHUNK = 65_536


@contextmanager
def held(keyed: DataFrame) -> Iterator[DataFrame]:
    """The strata and keys, kept while the histogram and the cut keys are taken from them.

    Two short columns per row; partitions of a lost executor are computed again.
    """
    narrow = keyed.select(STRATUM, KEY).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield narrow
    finally:
        narrow.unpersist()


def key_histogram(keyed: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Rows per (stratum, bucket), written once because several steps read it."""
    buckets = keyed.select(STRATUM, key_bucket(F.col(KEY), digits).alias(BUCKET))
    return cut_lineage(buckets.groupBy(STRATUM, BUCKET).agg(F.count("*").alias("n")))


def strata_fit_broadcast(histogram: DataFrame, cuts: int = 1) -> bool:
    """Measure the table of strata, with a key for each of its cuts, before anything of that size is broadcast."""
    size = (
        histogram.select(STRATUM)
        .distinct()
        .agg(F.count("*").alias("n"), F.sum(F.octet_length(STRATUM)).alias("bytes"))
        .first()
    )
    return fits_broadcast(size["n"] * cuts, (size["bytes"] or 0) * cuts)


def cut_keys(
    keyed: DataFrame, histogram: DataFrame, quotas: list[Column], fits: bool, digits: int = DIGITS
) -> DataFrame:
    """The last key inside each quota.

    Quotas are expressions over ``stratum_rows`` and the stratum. The result has one row per
    stratum and quota above 0: cut_no, cut_key, copies (rows with that key) and copies_in.
    """
    by_stratum = Window.partitionBy(STRATUM)
    in_order = by_stratum.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = (
        histogram.withColumn("stratum_rows", F.sum("n").over(by_stratum))
        .withColumn("through", F.sum("n").over(in_order))
        .select(STRATUM, BUCKET, "n", "through", F.posexplode(F.array(*quotas)).alias("cut_no", "quota"))
        .where((F.col("through") - F.col("n") < F.col("quota")) & (F.col("quota") <= F.col("through")))
        .select(STRATUM, BUCKET, "cut_no", (F.col("quota") - F.col("through") + F.col("n")).alias("need"))
    )
    candidates = keyed.select(STRATUM, KEY, key_bucket(F.col(KEY), digits).alias(BUCKET))
    keys = (
        candidates.join(broadcast_if(edges, fits), [STRATUM, BUCKET])
        .groupBy(STRATUM, "cut_no", "need", KEY)
        .agg(F.count("*").alias("copies"))
    )
    by_key = (
        Window.partitionBy(STRATUM, "cut_no")
        .orderBy(KEY)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return cut_lineage(
        keys.withColumn("through", F.sum("copies").over(by_key))
        .where((F.col("through") - F.col("copies") < F.col("need")) & (F.col("need") <= F.col("through")))
        .select(
            STRATUM,
            "cut_no",
            F.col(KEY).alias("cut_key"),
            "copies",
            (F.col("need") - F.col("through") + F.col("copies")).alias("copies_in"),
        )
    )


def divides_copies(cuts: DataFrame) -> bool:
    """Whether some cut lets in a part of the rows with one key."""
    return not cuts.where(F.col("copies_in") < F.col("copies")).isEmpty()


def content_at_ties(rows: DataFrame, cuts: DataFrame, fits: bool, columns: list[str]) -> DataFrame:
    """Extend the key of the rows that a divided cut shares by a key of their content.

    An extended key sorts right after the plain one, so all other rows keep their order and their side.
    """
    tied = cuts.where(F.col("copies_in") < F.col("copies")).select(F.col("cut_key").alias(KEY)).distinct()
    content = F.concat(F.col(KEY), F.lit("-"), F.md5(F.to_json(F.struct(*columns))))
    marked = rows.join(broadcast_if(tied.withColumn("_tied", F.lit(True)), fits), KEY, "left")
    return marked.withColumn(KEY, F.when(F.col("_tied"), content).otherwise(F.col(KEY))).drop("_tied")


def number_copies(rows: DataFrame, cuts: DataFrame, fits: bool, divided: bool) -> DataFrame:
    """Add the copy number that tells apart identical rows when a cut divides them.

    Without such a cut every row is copy 1. Otherwise the copies are collapsed to one counted
    row before the shuffle and written out again in chunks spread over the cluster.
    """
    if not divided:
        return rows.withColumn(COPY, F.lit(1).cast("bigint"))
    keys = cuts.where(F.col("copies_in") < F.col("copies")).select(STRATUM, F.col("cut_key").alias(KEY))
    keys = broadcast_if(keys.distinct(), fits)
    columns = rows.columns
    single = rows.join(keys, [STRATUM, KEY], "left_anti").withColumn(COPY, F.lit(1).cast("bigint"))
    counted = rows.join(keys, [STRATUM, KEY], "left_semi").groupBy(*columns).agg(F.count("*").alias("m"))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before = F.col("chunk") * COPIES_PER_CHUNK
    written = (
        counted.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (m - 1) div {COPIES_PER_CHUNK})")))
        .repartition(partitions, "chunk", KEY)
        .withColumn(COPY, F.explode(F.sequence(before + 1, F.least("m", before + COPIES_PER_CHUNK))))
        .select(*columns, COPY)
    )
    return single.select(*columns, COPY).unionByName(written)


def within(key: Column, copy_no: Column, cut_key: Column, copies_in: Column) -> Column:
    """Whether a row lies at or before a cut."""
    return (key < cut_key) | ((key == cut_key) & (copy_no <= copies_in))


def proportional_quotas(histogram: DataFrame, fraction: float) -> tuple[dict, Column | None]:
    """Largest-remainder shares of ceil(n * fraction) in exact integer arithmetic.

    Strata enter only through the distinct stratum sizes, of which there are at most
    sqrt(2n), so the unpartitioned windows below stay small. Returns the totals and the quota
    expression over ``stratum_rows`` (None for an empty table).
    """
    strata = histogram.groupBy(STRATUM).agg(F.sum("n").alias("stratum_rows"))
    sizes = strata.groupBy("stratum_rows").agg(
        F.count("*").alias("strata"), F.sum(F.octet_length(STRATUM)).alias("bytes")
    )
    everything = Window.partitionBy()
    by_remainder = Window.orderBy(F.col("rest").desc())
    shares = (
        sizes.withColumn("rows", F.sum(F.expr("stratum_rows * strata")).over(everything))
        .withColumn("take", F.ceil(F.col("rows").cast("double") * F.lit(float(fraction))))
        .withColumn("base", _whole_share(F.col("take"), F.col("rows")))
        .withColumn("rest", _remainder(F.col("take"), F.col("rows")))
        .withColumn("left", F.col("take") - F.sum(F.expr("base * strata")).over(everything))
        .withColumn("through", F.sum("strata").over(by_remainder))
        .withColumn("tied", F.sum("strata").over(by_remainder.rangeBetween(0, 0)))
    )
    at_edge = (F.expr("through - tied < left")) & (F.expr("left <= through"))
    totals = shares.agg(
        F.max("rows").alias("rows"),
        F.max("take").alias("take"),
        F.sum("strata").alias("strata"),
        F.min("stratum_rows").alias("smallest"),
        F.sum("bytes").alias("bytes"),
        F.max(F.when(at_edge, F.col("rest"))).alias("edge_rest"),
        F.max(F.when(at_edge, F.expr("left - (through - tied)"))).alias("edge_take"),
        F.max(F.when(at_edge, F.col("tied"))).alias("edge_tied"),
    ).first()
    totals = totals.asDict()
    if not totals["rows"]:
        return totals, None
    take, rows = F.lit(totals["take"]), F.lit(totals["rows"])
    quota = _whole_share(take, rows)
    if totals["edge_rest"] is not None:
        rest = _remainder(take, rows)
        edge = F.lit(totals["edge_rest"])
        extra = rest > edge
        at_tie = rest == edge
        if totals["edge_take"] < totals["edge_tied"]:
            tied = strata.where(at_tie).select(
                F.lit("").alias(STRATUM), F.md5(F.col(STRATUM)).alias(KEY)
            )
            tie_histogram = key_histogram(tied)
            last = cut_keys(tied, tie_histogram, [F.lit(totals["edge_take"])], True).first()
            at_tie = at_tie & (F.md5(F.col(STRATUM)) <= F.lit(last["cut_key"]))
        quota = quota + F.when(extra | at_tie, 1).otherwise(0)
    return totals, quota


def _product(take: Column) -> Column:
    return take.cast("decimal(19,0)") * F.col("stratum_rows").cast("decimal(18,0)")


def _remainder(take: Column, rows: Column) -> Column:
    return (_product(take) % rows.cast("decimal(19,0)")).cast("bigint")


def _whole_share(take: Column, rows: Column) -> Column:
    exact = _product(take) - _remainder(take, rows).cast("decimal(19,0)")
    return (exact / rows.cast("decimal(19,0)")).cast("bigint")


def split_buckets(keyed: DataFrame, groups: list[str], digits: int, most: int) -> DataFrame:
    """Buckets of an adaptive radix, in the order of their keys: (groups, bucket, n).

    A bucket is a key's first digits. Buckets of more than ``most`` rows are split by further digits, others stay; so
    no bucket has more rows, whatever the keys, unless they agree in all digits. A round counts the rows of the full buckets
    only and takes as many digits as the fullest one needs.
    """
    found = keyed.groupBy(*groups, key_bucket(F.col(KEY), digits).alias(BUCKET)).agg(F.count("*").alias("n"))
    found = cut_lineage(found)
    while digits < KEY_DIGITS:
        largest = found.where(F.length(BUCKET) == digits).agg(F.max("n").alias("n")).first()["n"] or 0
        if largest <= most:
            break
        full = (F.length(BUCKET) == digits) & (F.col("n") > most)
        again = keyed.withColumn(BUCKET, key_bucket(F.col(KEY), digits))
        again = again.join(found.where(full).select(*groups, BUCKET), [*groups, BUCKET], "left_semi")
        digits = min(KEY_DIGITS, digits + max(1, math.ceil(math.log(largest / most, 16))))
        parts = again.groupBy(*groups, key_bucket(F.col(KEY), digits).alias(BUCKET)).agg(F.count("*").alias("n"))
        found = cut_lineage(found.where(~full).unionByName(parts))
    return found


def bucketed_rank(
    keyed: DataFrame,
    groups: list[str],
    group_limit: int,
    seed: int,
    parts: list[str],
    digits: int = DIGITS,
    most: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Rank 1..n in each group by md5(seed|parts), exact, in windows of one bucket of at most ``most`` rows each.

    The buckets come from the histogram of the keys, see ``split_buckets``; ``group_limit`` is a known bound on the number of
    groups. A row finds its bucket among the lengths that occur, by the one that is in the table.
    """
    rows = keyed.withColumn(KEY, seeded_md5(seed, *[F.col(p) for p in parts]))
    buckets = split_buckets(rows.select(*groups, KEY), groups, digits, most)
    earlier = Window.partitionBy(*groups).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    place = [*groups, BUCKET]
    offsets = buckets.select(*place, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    lengths = [r[0] for r in buckets.select(F.length(BUCKET)).distinct().collect()] or [digits]
    size = buckets.count() if len(lengths) > 1 else group_limit * 16 ** lengths[0]
    fits = fits_broadcast(size, 0)
    if len(lengths) == 1:
        rows = rows.withColumn(BUCKET, key_bucket(F.col(KEY), lengths[0]))
    else:
        tried = F.explode(F.array(*[key_bucket(F.col(KEY), d) for d in sorted(lengths)]))
        rows = rows.withColumn(BUCKET, tried).join(broadcast_if(buckets.select(*place), fits), place, "left_semi")
    in_bucket = Window.partitionBy(*place).orderBy(KEY, *parts)
    return (
        rows.withColumn("rank", F.row_number().over(in_bucket))
        .join(broadcast_if(offsets, fits), place)
        .withColumn("rank", F.col("rank") + F.col("before"))
        .drop("before", KEY, BUCKET)
    )
