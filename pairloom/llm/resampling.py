"""Importance resampling towards a target distribution: hashed n-gram weights and an exact distributed selection."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import (
    VECTOR_SCHEMA,
    gathered,
    lean,
    load,
    pieces,
    stored,
    texts_of,
    vector_batch,
    vector_rows,
)

#: Digits, small letters and all bytes above ASCII stay, A-Z become small, everything else parts words.
FOLD = bytes(b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
KNOWN = 200_000
KEPT = 4096
SHRUNK = 4
AT_ONCE = 1_000_000
LAST = np.iinfo(np.int64).max

SCORED_SCHEMA = "uid long, doc_id long, n_features long, n_words long, weight long, score long"
KEY = ("place", "id", "n_features", "uid")
MEDIAN_SCHEMA = "below long, low array<long>, above long, high array<long>"

Key = tuple[int, ...]


@dataclass(frozen=True)
class Resampling:
    """Features are runs of `least` to `most` words; `percent` of the documents of `min_words` words or more are drawn."""

    least: int = 1
    most: int = 1
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 10
    seed: int = 2024


class Buckets(dict):
    """Bucket of a feature; those met before are kept, up to a bound."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        bucket = zlib.crc32(feature) % self.n
        if len(feature) <= 64:
            self[feature] = bucket
        return bucket


def features(words: list[bytes], least: int, most: int) -> list[bytes]:
    """All runs of `least` to `most` words, each joined by one space."""
    found = list(words) if least == 1 else []
    for n in range(max(least, 2), most + 1):
        found += map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
    return found


def bucketed(texts: list[bytes | None], known: Buckets, p: Resampling) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bucket of every feature of the texts, features of each text, and words of each text."""
    ids, sizes, words = [], [], []
    for text in texts:
        split = text.translate(FOLD).split() if text else []
        found = features(split, p.least, p.most)
        ids.append(np.fromiter(map(known.__getitem__, found), np.int64, len(found)))
        sizes.append(len(found))
        words.append(len(split))
    return np.concatenate(ids) if ids else np.zeros(0, np.int64), np.array(sizes, np.int64), words


def bucket_counts(texts: DataFrame, p: Resampling) -> np.ndarray:
    """How many features of all texts fall into each bucket; a task sends one vector of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(p.buckets), np.zeros(p.buckets)
        for piece in pieces(batches):
            total += np.bincount(bucketed(texts_of(piece), known, p)[0], minlength=p.buckets)
        yield vector_batch(vector_rows("features", total))

    found = gathered(texts.select("text").mapInArrow(lean(count), VECTOR_SCHEMA))
    return found.get("features", np.zeros(p.buckets))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares in target and source, rounded down."""
    n = len(source)
    ratio = (target + 1) * (source.sum() + n) / ((source + 1) * (target.sum() + n))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a standard Gumbel number drawn by the hash of seed and id, rounded down."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, p: Resampling, id_column: str) -> DataFrame:
    """One narrow row per document with its weight and score, stored, as selection reads it several times."""
    shipped = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gain = Buckets(p.buckets), shipped.value
        for piece in pieces(batches):
            ids, sizes, words = bucketed(texts_of(piece), known, p)
            ends = np.concatenate(([0], np.cumsum(gain[ids])))
            stops = np.cumsum(sizes)
            weight = ends[stops] - ends[stops - sizes]
            drawn = np.array([noise(i, p.seed) for i in piece.column(1).to_pylist()], np.int64)
            columns = [pa.array(x, pa.int64()) for x in (sizes, words, weight, weight + drawn)]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), *columns], names=[c.split()[0] for c in SCORED_SCHEMA.split(", ")]
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).cast("long").alias("doc_id"), "text"
    )
    return stored(rows.mapInArrow(lean(score), SCORED_SCHEMA), "scored")


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with the numbers that order them: highest score first, then smallest id; no two are alike.

    Rows without an id come last among equals; repeated ids are told apart by their features and their place.
    """
    return rows.withColumns({"place": -F.col("score"), "id": F.coalesce("doc_id", F.lit(int(LAST)))})


def _later(key: Key) -> Column:
    """Whether a row's key comes after the given one."""
    found = F.lit(False)
    for name, value in zip(reversed(KEY), reversed(key), strict=True):
        found = (F.col(name) > F.lit(value)) | ((F.col(name) == F.lit(value)) & found)
    return found


def between(rows: DataFrame, low: Key | None, high: Key | None) -> DataFrame:
    """Rows whose keys lie between two keys, both left out."""
    if low is not None:
        rows = rows.where(_later(low))
    if high is not None:
        below = F.lit(False)
        for name, value in zip(reversed(KEY), reversed(high), strict=True):
            below = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & below)
        rows = rows.where(below)
    return rows


def medians(rows: DataFrame, pivot: Key | None) -> list:
    """How many keys of a task are below and above the pivot, and the median of both; without a pivot, all are above.

    A task gives a row for every AT_ONCE of its keys, so it holds no more than these.
    """

    def middle(keys: np.ndarray) -> list[int]:
        return keys[np.lexsort(keys.T[::-1])[(len(keys) - 1) // 2]].tolist() if len(keys) else []

    def sides(parts: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.concatenate(parts)
        if pivot is None:
            below, above = keys[:0], keys
        else:
            sign = np.zeros(len(keys), np.int8)
            for i, value in enumerate(pivot):
                sign = np.where(sign == 0, np.sign(np.where(keys[:, i] < value, -1, keys[:, i] > value)), sign)
            below, above = keys[sign < 0], keys[sign > 0]
        row = [[len(below)], [middle(below)], [len(above)], [middle(above)]]
        kinds = [pa.int64(), pa.list_(pa.int64())] * 2
        names = [c.split()[0] for c in MEDIAN_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        for batch in batches:
            parts.append(np.stack([batch.column(i).to_numpy() for i in range(len(KEY))], axis=1))
            if sum(map(len, parts)) >= AT_ONCE:
                yield sides(parts)
                parts = []
        if sum(map(len, parts)):
            yield sides(parts)

    return rows.select(*KEY).mapInArrow(lean(work), MEDIAN_SCHEMA).collect()  # one row per AT_ONCE keys or task


def weighted_median(found: list[tuple[int, Key]]) -> Key:
    """The key at which half of the weight is reached."""
    total, reached = sum(n for n, _ in found), 0
    for n, key in sorted(found, key=lambda x: x[1]):
        reached += n
        if 2 * reached >= total:
            return key
    raise ValueError("nothing is left to select from")


def cutoff(rows: DataFrame, k: int, kept: int = KEPT) -> Key | None:
    """The k-th key of the rows in order, or None if k is 0.

    In every round each task gives the medians of what is left of its rows on both sides of the last pivot. The
    weighted median of those on the side of the k-th key is the next pivot: half of the remaining weight has its
    task's median on either side of it, so a quarter of the rows at least is discarded whatever they are. The
    table is written anew when it has shrunk, so all rounds together read a small multiple of it; the last `kept`
    rows are ordered by the driver.
    """
    if k <= 0:
        return None
    low = high = pivot = None
    whole = left = rows.count()
    while left > kept:
        found = medians(between(rows, low, high), pivot)
        below = sum(r["below"] for r in found)
        if pivot is None:
            side = "above"
        elif k <= below:
            high, left, side = pivot, below, "below"
        elif k == below + 1:
            return pivot
        else:
            low, k, left, side = pivot, k - below - 1, left - below - 1, "above"
        if left <= kept:
            break
        median = "low" if side == "below" else "high"
        pivot = weighted_median([(r[side], tuple(r[median])) for r in found if r[side]])
        if left * SHRUNK <= whole:
            rows, whole = stored(between(rows, low, high).select(*KEY), "remaining"), left
            low = high = None
    last = sorted(tuple(r) for r in between(rows, low, high).select(*KEY).collect())  # at most `kept` rows
    return last[k - 1]


def ranked(winners: DataFrame, parts: int) -> DataFrame:
    """Winners with rank 1, 2, 3... by their keys: sorted in ranges, and each range adds the sizes of those before."""
    schema = f"{SCORED_SCHEMA}, part int, nth long"
    names = [c.split()[0] for c in SCORED_SCHEMA.split(", ")]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            columns = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(done + 1, done + n + 1))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *columns], names=[*names, "part", "nth"])
            done += n

    ordered = winners.repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY).select(*names)
    placed = stored(ordered.mapInArrow(number, schema), "winners")
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    before, total = {}, 0
    for part, n in sizes:
        before[part] = total
        total += n
    if not before:
        return placed.select(*names, F.col("nth").alias("rank"))
    offsets = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])  # one entry per range
    return placed.select(*names, (F.element_at(offsets, F.col("part")) + F.col("nth")).alias("rank"))


def resampled(
    docs: DataFrame, target: DataFrame, p: Resampling = Resampling(), id_column: str = "doc_id", kept: int = KEPT
) -> DataFrame:
    """One row per document: number of features, weight, score, and the rank of those drawn.

    A document's weight is the sum of its features' gains, which say how much more often their bucket occurs in
    the target than in the documents; the score adds Gumbel noise, so the highest scores are a sample without
    replacement by importance. Documents of fewer than `min_words` words are scored but never drawn.

    Null and empty texts have no features and weight 0. Rows without an id draw the noise of an empty id and rank
    last among equal scores; repeated rows are documents of their own with equal scores and successive ranks;
    empty tables give no rows, an empty target smoothed counts; columns besides id and text are not read.
    """
    gain = gains(bucket_counts(docs, p), bucket_counts(target, p))
    rows = keyed(scored(docs, gain, p, id_column))
    able = F.col("n_words") >= p.min_words
    n = rows.where(able).count()
    cut = cutoff(rows.where(able), p.percent * n // 100, kept)
    names = [c.split()[0] for c in SCORED_SCHEMA.split(", ")]
    if cut is None:
        result = rows.withColumn("rank", F.lit(None).cast("long"))
    else:
        won = able & ~_later(cut)
        parts = max(1, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // 20_000 + 1))
        losers = rows.where(~won).select(*names, F.lit(None).cast("long").alias("rank"))
        result = ranked(rows.where(won), parts).unionByName(losers)
    return result.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def op12_median_of_medians_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
