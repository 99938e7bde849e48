"""What several operators share: word splitting, slices of Arrow batches, hashes and storage."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.session import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, stored

__all__ = [
    "BROADCAST_MAX_BYTES",
    "BROADCAST_MAX_ROWS",
    "crc_split",
    "lean",
    "load",
    "mix64",
    "pieces",
    "stored",
    "summed_vectors",
    "token_hashes",
    "words_of",
]

VECTOR_SCHEMA = "name string, chunk int, values binary"

SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_split(key: Column, modulus: int) -> Column:
    """crc32 of an id written as text, modulo a number."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text between ASCII white space, with A-Z in lower case."""
    return text.lower().split() if text else []


def pieces(
    batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 4_000_000, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece has few rows and few text bytes, whatever the batch has.

    A text longer than `size` is a piece of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column(text).cast(pa.binary()) if text in batch.schema.names else None
        if lengths is None:
            ends = np.arange(1, batch.num_rows + 1)
        else:
            filled = np.array([0 if v is None else v for v in pa.compute.binary_length(lengths).to_pylist()])
            ends = np.cumsum(filled)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + size, side="right"))
            stop = min(max(stop, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The work of a task, after which its worker gives memory back to the system.

    Workers are kept for later stages, and what the allocators of Arrow and of C keep for them adds up otherwise.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


BASE = 0x9E3779B97F4A7C15


def token_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words of the texts, and for each word the index of its text.

    A hash is a polynomial in the bytes of the word; all words are hashed at once.
    """
    joined = b"\n".join(t or b"" for t in texts).lower()
    if not joined.strip():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = np.frombuffer(joined, np.uint8)
    space = SPACES[data]
    edges = np.flatnonzero(np.diff(space.view(np.int8), prepend=1, append=1))
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    at = np.arange(len(data), dtype=np.int64)
    place = at - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(data)]))))
    powers = np.cumprod(np.full(int(lengths.max()) + 1, BASE, dtype=np.uint64))
    value = data.astype(np.uint64)
    value += np.uint64(1)
    value *= powers[np.minimum(place, len(powers) - 1)]
    value[space] = 0
    hashes = mix64(np.add.reduceat(value, starts) + lengths.astype(np.uint64))
    offsets = np.cumsum([len(t or b"") + 1 for t in texts])
    return hashes, np.searchsorted(offsets, starts, side="right")


def summed_vectors(parts: DataFrame) -> DataFrame:
    """Sum long vectors that tasks have sent in as rows (name, chunk, bytes of float64).

    Returns one row per name and chunk, so no task needs a whole vector. A group is read batch by
    batch, as it has a row from every task.
    """

    def add(key: tuple[Any, ...], frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            for raw in frame["values"]:
                part = np.frombuffer(raw, np.float64)
                total = part.copy() if total is None else total + part
        yield pd.DataFrame({"name": [key[0]], "chunk": [key[1]], "values": [total.tobytes()]})

    return parts.groupBy("name", "chunk").applyInPandas(add, VECTOR_SCHEMA)


def vector_rows(name: str, vector: np.ndarray, chunk: int = 8192) -> list[tuple[str, int, bytes]]:
    flat = np.asarray(vector, np.float64).ravel()
    return [(name, i // chunk, flat[i : i + chunk].tobytes()) for i in range(0, len(flat), chunk)]


def vector_batch(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    names, chunks, values = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(chunks, pa.int32()), pa.array(values, pa.binary())],
        names=["name", "chunk", "values"],
    )


def gathered(parts: DataFrame) -> dict[str, np.ndarray]:
    """Summed vectors of a proven size, on the driver."""
    found: dict[str, list] = {}
    for row in summed_vectors(parts).collect():
        found.setdefault(row["name"], []).append((row["chunk"], row["values"]))
    return {k: np.concatenate([np.frombuffer(b, np.float64) for _, b in sorted(v)]) for k, v in found.items()}
