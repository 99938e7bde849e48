"""Best-fit packing of token sequences into bins of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import lean, load, stored

CAPACITIES = (512, 1024, 2048, 4096)
POOL = 16_384
SCHEMA = (
    "doc_id long, piece int, start long, n_tokens long, bin_id string, bin_capacity int, bin_used int, bin_offset int"
)


def bin_cost(capacity: int, fixed: float = 64.0, quadratic: float = 16_384.0) -> float:
    """Cost of training on one sequence: a fixed part, its tokens, and attention's square part."""
    return fixed + capacity + capacity * capacity / quadratic


def opening_table(lengths: np.ndarray, capacities: tuple[int, ...]) -> list[int]:
    """For each item length, the capacity whose bin is cheapest per token that it is to hold.

    A bin opened for an item holds the item and, in the rest, as much as this pool can fill it:
    items no longer than the rest, by their share of all tokens.
    """
    top = capacities[-1]
    tokens = np.bincount(lengths, weights=lengths, minlength=top + 1)
    share = np.cumsum(tokens) / max(tokens.sum(), 1)
    table = [0] * (top + 1)
    for length in range(1, top + 1):
        fits = [c for c in capacities if c >= length]
        table[length] = min(fits, key=lambda c: (bin_cost(c) / (length + share[c - length] * (c - length)), c))
    return table


def pack(lengths: np.ndarray, capacities: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """Best-fit decreasing: bin and offset of every item, and capacity and contents of every bin.

    The longest item goes first, into the open bin with the least room that still holds it; if none
    does, a bin of the least-cost size is opened. At the end each bin takes the smallest
    permitted length that holds its contents. Open rooms are bits of one number, so that the best
    fit is its lowest set bit from the item's length on.
    """
    opening = opening_table(lengths, capacities)
    rooms: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]
    used: list[int] = []
    filled = 0
    place = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = filled >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            target = rooms[room].pop()
            if not rooms[room]:
                filled ^= 1 << room
        else:
            room = opening[length]
            target = len(used)
            used.append(0)
        place[item], offset[item] = target, used[target]
        used[target] += length
        if room > length:
            if not rooms[room - length]:
                filled |= 1 << (room - length)
            rooms[room - length].append(target)
    sizes = [capacities[bisect_left(capacities, u)] for u in used]
    return place, offset, sizes, used


def packed_plan(
    docs: DataFrame,
    length: str = "n_tokens",
    id_column: str = "doc_id",
    capacities: tuple[int, ...] = CAPACITIES,
    pool: int = POOL,
) -> DataFrame:
    """One row per piece of a document: its bin, and where in the bin it lies.

    A document longer than the largest capacity is cut into pieces of that capacity and a rest, so
    every token is placed once. Documents of no tokens (null or empty texts) have no piece and give
    no row; repeated rows are packed one by one, and equal lengths in order of arrival.

    Documents are spread evenly whatever their keys, and every task packs pools of bounded size,
    so memory and time of a task follow its rows, and a lost task is packed again from its input.
    """
    capacities = tuple(sorted(set(capacities)))
    top = capacities[-1]

    def pools(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        numbers = 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal numbers, held
            if not held:
                return
            ids = np.concatenate([h[0] for h in held])
            tokens = np.concatenate([h[1] for h in held])
            held = []
            count = -(-tokens // top)
            owner = np.repeat(np.arange(len(ids)), count)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * top
            size = np.minimum(tokens[owner] - start, top)
            for first in range(0, len(owner), 4 * pool):  # a very long document may have more pieces than a pool
                cut = slice(first, first + 4 * pool)
                place, offset, sizes, used = pack(size[cut], capacities)
                known = ids[owner[cut]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None if i is None else int(i) for i in known], pa.int64()),
                        pa.array(piece[cut].astype(np.int32)),
                        pa.array(start[cut].astype(np.int64)),
                        pa.array(size[cut].astype(np.int64)),
                        pa.array([f"{task}-{numbers + p}" for p in place.tolist()], pa.string()),
                        pa.array(np.array(sizes, np.int32)[place]),
                        pa.array(np.array(used, np.int32)[place]),
                        pa.array(offset.astype(np.int32)),
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )
                numbers += len(sizes)

        waiting = 0
        for batch in batches:
            for at in range(0, batch.num_rows, pool):
                part = batch.slice(at, pool)
                ids = np.array(part.column(0).to_pylist(), object)
                tokens = np.array([v or 0 for v in part.column(1).to_pylist()], np.int64)
                keep = tokens > 0
                held.append((ids[keep], tokens[keep]))
                waiting += int(keep.sum())
                if waiting >= pool:
                    yield from flush()
                    waiting = 0
        yield from flush()

    narrow = stored(docs.select(F.col(id_column).cast("long"), F.col(length).cast("long")), "lengths")
    spread = max(1, -(-narrow.count() // pool))
    return narrow.repartition(spread).mapInArrow(lean(pools), SCHEMA)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    return packed_plan(with_word_counts(documents))


def with_word_counts(docs: DataFrame) -> DataFrame:
    """Ids and word counts of whole texts, counted once and kept narrow."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            counts = [len(t.as_py().split()) if t.is_valid else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        counted, "doc_id long, n_tokens long"
    )
