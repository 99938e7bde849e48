"""Document fingerprints by context-triggered piecewise hashing, compared by edit distance."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pairloom.llm.common import lean, load, mix64, pieces, texts_of

ROLL = 7
SMALLEST = 2
MOST = 64
LEVELS = 40
SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
PRIME = np.uint64(0x100000001B3)
PART_BYTES = 4_000_000
SPREAD = 8
PAIRS = 4096


class Fingerprint(NamedTuple):
    """Signatures of a text in blocks of some size and of twice that size."""

    level: int
    fine: bytes
    coarse: bytes

    def __str__(self) -> str:
        return f"{4 << self.level}:{self.fine.decode()}:{self.coarse.decode()}"


def trigger_levels(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text, the places at which a block of some level ends, and the highest such level.

    The rolling hash sees the last ROLL bytes. A place ends blocks of level k if SMALLEST + k low bits of the hash
    are zero, so blocks of level k have 4 * 2^k bytes on average and each level's ends are among those of
    the level below.
    """
    gap = b"\0" * ROLL
    data = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    n = len(data) - ROLL
    rolled = np.zeros(n, np.uint64)
    for back in range(ROLL):
        rolled *= PRIME
        rolled += data[back + 1 : back + 1 + n]
    rolled = mix64(rolled)
    found = np.flatnonzero(rolled & np.uint64((1 << SMALLEST) - 1) == 0)
    low = rolled[found] >> np.uint64(SMALLEST)
    lowest = low & (~low + np.uint64(1))
    level = np.where(low == 0, LEVELS, np.log2(np.maximum(lowest, np.uint64(1)).astype(np.float64))).astype(np.int64)
    level = np.minimum(level, LEVELS)
    starts = np.cumsum([0, *[len(t) + ROLL for t in texts]])
    result = []
    for text, start in zip(texts, starts.tolist(), strict=False):
        a, b = np.searchsorted(found, [start, start + len(text)])
        result.append((found[a:b] - start + 1, level[a:b]))
    return result


def signature(text: bytes, ends: list[int]) -> bytes:
    """One symbol for every chunk that the ends cut."""
    start, symbols = 0, bytearray()
    for end in ends:
        symbols.append(SYMBOLS[zlib.crc32(text[start:end]) & 63])
        start = end
    if start < len(text):
        symbols.append(SYMBOLS[zlib.crc32(text[start:]) & 63])
    return bytes(symbols)


def fingerprints(texts: list[bytes]) -> list[Fingerprint]:
    """Fingerprints of whole texts, in the smallest blocks that give fewer than MOST ends; equal texts have equal ones.

    An empty text has empty signatures of the lowest level.
    """
    found = []
    for text, (ends, level) in zip(texts, trigger_levels(texts), strict=True):
        per_level = np.bincount(level, minlength=LEVELS + 1)
        at_least = np.cumsum(per_level[::-1])[::-1]
        fits = np.flatnonzero(at_least < MOST)
        k = int(fits[0]) if len(fits) else LEVELS + 1
        fine = signature(text, ends[level >= k].tolist())
        found.append(Fingerprint(k, fine, signature(text, ends[level > k].tolist())))
    return found


def edit_distances(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Edit distance of each pair of strings of at most 64 symbols, all pairs at once.

    A column of the table of differences is the bits of two numbers (Myers' bit-vector algorithm); each step
    reads one symbol of all right strings.
    """
    n = len(left)
    size = np.array([len(x) for x in left], np.int64)
    steps = np.array([len(x) for x in right], np.int64)
    if not n:
        return np.zeros(0, np.int64)
    where = np.zeros((n, 256), np.uint64)
    for place in range(int(size.max(initial=0))):
        rows = np.flatnonzero(size > place)
        where[rows, [left[i][place] for i in rows]] |= np.uint64(1 << place)
    read = np.zeros((int(steps.max(initial=0)), n), np.uint8)
    for i, x in enumerate(right):
        read[: len(x), i] = np.frombuffer(x, np.uint8)
    one, every = np.uint64(1), ~np.zeros(n, np.uint64)
    plus, minus, score = every.copy(), np.zeros(n, np.uint64), size.copy()
    top = one << np.maximum(size - 1, 0).astype(np.uint64)
    for t in range(len(read)):
        on = (t < steps) & (size > 0)
        equal = where[np.arange(n), read[t]]
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(horizontal | plus)
        down = plus & horizontal
        score += np.where(on & (up & top != 0), 1, 0) - np.where(on & (down & top != 0), 1, 0)
        up = (up << one) | one
        down = down << one
        plus = np.where(on, down | ~(vertical | up), plus)
        minus = np.where(on, up & vertical, minus)
    return np.where(size == 0, steps, score)


def likeness(left: list[Fingerprint], right: list[Fingerprint]) -> np.ndarray:
    """One less the share of symbols to edit, of the better of the signatures in blocks of equal size; 0 if there are none.

    Equal fingerprints have likeness 1.
    """
    result = np.array([float(a == b) for a, b in zip(left, right, strict=True)])
    number, some, other = [], [], []
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        if a == b or not a.fine or not b.fine:
            continue
        for x, y in ((a.fine, b.fine), (a.coarse, b.coarse)) if a.level == b.level else (
            ((a.fine, b.coarse),) if a.level == b.level + 1 else ((a.coarse, b.fine),) if b.level == a.level + 1 else ()
        ):
            number.append(i)
            some.append(x)
            other.append(y)
    for at in range(0, len(number), PAIRS):
        x, y = some[at : at + PAIRS], other[at : at + PAIRS]
        longest = np.maximum([len(s) for s in x], [len(s) for s in y])
        np.maximum.at(result, number[at : at + PAIRS], 1 - edit_distances(x, y) / longest)
    return result


def similarities(pairs: DataFrame, left: str, right: str, name: str = "likeness") -> DataFrame:
    """Add the likeness of two columns of fingerprints; null if one of them is null."""

    @F.pandas_udf("double")
    def compared(a: pd.Series, b: pd.Series) -> pd.Series:
        there = (a.notna() & b.notna()).to_numpy()
        out = np.full(len(a), np.nan)
        out[there] = likeness(*[[parsed(x) for x in s[there]] for s in (a, b)])
        return pd.Series(out, dtype=object).where(there, None).astype("Float64")

    return pairs.withColumn(name, compared(left, right))


def parsed(fingerprint: str) -> Fingerprint:
    size, fine, coarse = fingerprint.split(":")
    return Fingerprint(int(size).bit_length() - 3, fine.encode(), coarse.encode())


def piecewise_hashes(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Every document's id, length in characters and fingerprint. Null texts count as empty; repeated rows are alike."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, size=2_000_000):
            texts = [t or b"" for t in texts_of(piece)]
            values = [str(f) for f in fingerprints(texts)]
            sizes = [len(t.decode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(sizes, pa.int64()), pa.array(values, pa.string())],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lean(work), "doc_id long, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the first characters of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


EDIT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def ranges(rows: DataFrame, part_bytes: int = PART_BYTES) -> tuple[DataFrame, list[tuple]]:
    """Rows (doc_id, text) with `h` and the number `part` of a range of ids, and the first row of each range.

    A range has about `part_bytes` of text, or more if that made more ranges than SPREAD times the shuffle
    partitions; they are cut at quantiles of the ids. Rows without an id come first; rows of one id are in the order
    of a hash of their texts, and that hash also parts the rows of an id that fills whole ranges.
    Each first row comes as (known, doc_id, h, part of the range before), that of the first range behind the last.
    """
    rows = rows.withColumn("h", F.xxhash64("text"))
    about = rows.agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n")).first()
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(1, min((about["size"] or 0) // part_bytes + 1, about["n"], SPREAD * tasks))
    shares = [i / wanted for i in range(1, wanted)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 10 * wanted + 1000)).first()[0] if shares else []
    places, times = np.unique(np.array(cuts or [], np.int64), return_counts=True)
    wide = [(i + 1, int(v), int(n)) for i, (v, n) in enumerate(zip(places, times, strict=True)) if n > 1]

    @F.pandas_udf(LongType())
    def part_of(missing: pd.Series, doc_id: pd.Series, h: pd.Series) -> pd.Series:
        ids, none = doc_id.to_numpy(), missing.to_numpy()
        found = np.searchsorted(places, ids, side="right")
        part = (found + 1) * (len(cuts or []) + 2)
        for number, value, n in wide:  # ids that fill several ranges are fewer than ranges
            here = found == number
            share = ((h.to_numpy()[here] / 2.0**64 + 0.5) * n).astype(np.int64)
            part[here] += np.where(ids[here] == value, np.clip(share, 0, n - 1), n)
        return pd.Series(np.where(none, 0, part))

    part = part_of(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "h")
    marked = rows.withColumn("part", part)
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h")
    heads = sorted((r["part"], r["head"]) for r in marked.groupBy("part").agg(F.min(order).alias("head")).collect())
    return marked, [(x["known"], x["doc_id"], x["h"], heads[i - 1][0]) for i, (_, x) in enumerate(heads)]


def fingerprinted_edits(docs: DataFrame, id_column: str = "doc_id", part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how near they and the next document's are.

    The next document is that of the next higher id, the first one's behind the last; a single document is its own
    next. Null texts count as empty. Rows without an id come before all others, repeated rows of one id in the order of a
    hash of their texts, so that copies follow one another; empty tables give no rows; columns besides id and text are
    not read.

    Behind its own rows a range has, as guest, a copy of the first row of the range that follows, so that every row
    is followed by its next one, and only a row for each range moves twice.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    marked, before = ranges(rows, part_bytes)
    if not before:
        return rows.sparkSession.createDataFrame([], EDIT_SCHEMA)
    spark = rows.sparkSession
    heads = spark.createDataFrame(before, "known boolean, head_id long, head_h long, guest_part long")
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h"))
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("guest_part").alias("part"), F.lit(1).alias("guest"))
    joined = marked.join(F.broadcast(heads), is_head, "left")  # one short row per range
    both = F.when(F.col("guest_part").isNull(), F.array(own)).otherwise(F.array(own, guest))
    placed = joined.select("doc_id", "h", "text", F.explode(both).alias("at")).select("doc_id", "h", "text", "at.*")
    dealt = placed.repartition("part").sortWithinPartitions("part", "guest", "doc_id", "h")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for piece in pieces(batches, size=2_000_000):
            columns = [piece.column(c).to_pylist() for c in ("part", "guest", "doc_id")]
            texts = texts_of(piece)
            fresh = list(zip(*columns, texts, fingerprints(texts), strict=True))
            rows = held + fresh
            held = rows[-1:]
            pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[1] and a[0] == b[0]]
            if pairs:
                yield compared(pairs)

    def compared(pairs: list[tuple]) -> pa.RecordBatch:
        texts = [a[3].decode() for a, _ in pairs]
        changed = [edited(t, b[3].decode()).encode() for t, (_, b) in zip(texts, pairs, strict=True)]
        own, following = ([x[4] for x in side] for side in zip(*pairs, strict=True))
        new = fingerprints(changed)
        columns = [
            pa.array([a[2] for a, _ in pairs], pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in changed]),
            pa.array([str(f) for f in own]),
            pa.array([str(f) for f in new]),
            pa.array(likeness(own, new)),
            pa.array(likeness(own, following)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in EDIT_SCHEMA.split(", ")])

    return dealt.select("part", "guest", "doc_id", "text").mapInArrow(lean(work), EDIT_SCHEMA)


def op13_context_triggered_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted_edits(load(spark, sf_dir, "documents"))
