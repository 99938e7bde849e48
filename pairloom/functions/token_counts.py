"""Hashed token counts of whole Arrow columns of texts."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 4_000_000
HASH_SEED = 42


def text_pieces(batch: pa.RecordBatch, texts: list[str], size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``size`` bytes of text; a longer row is a piece of its own."""
    lengths = np.zeros(batch.num_rows, np.int64)
    for text in texts:
        lengths += pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + size, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def token_numbers(texts: pa.Array) -> np.ndarray:
    """Tokens between ASCII white space in each text; none in a missing one."""
    return np.array([len(t.split()) if t else 0 for t in texts.cast(pa.binary()).to_pylist()], np.int64)


def murmur3(tokens: pa.Array, seed: int = HASH_SEED) -> np.ndarray:
    """Signed 32-bit Murmur3 of every token's UTF-8 bytes, as ``HashingTF`` takes it; four bytes of all tokens at a time."""
    values = tokens.cast(pa.large_binary())
    lengths = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(values.to_pylist()) + bytes(4), np.uint8).astype(np.uint32)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = (np.cumsum(lengths) - lengths)[order], lengths[order]

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

    def mixed(x: np.ndarray) -> np.ndarray:
        return turned(x * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)

    h = np.full(len(lengths), seed, np.uint32)
    blocks = -(sizes // 4)
    for block in range(-int(blocks[0]) if len(sizes) else 0):
        longer = int(np.searchsorted(blocks, -block, side="left"))
        at = starts[:longer] + 4 * block
        word = data[at] | data[at + 1] << np.uint32(8) | data[at + 2] << np.uint32(16) | data[at + 3] << np.uint32(24)
        h[:longer] = turned(h[:longer] ^ mixed(word), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    rest, at = sizes % 4, starts + sizes // 4 * 4
    tail = np.zeros(len(lengths), np.uint32)
    for k in range(3):
        tail |= np.where(rest > k, data[np.minimum(at + k, len(data) - 1)], 0).astype(np.uint32) << np.uint32(8 * k)
    h ^= mixed(tail)
    h ^= sizes.astype(np.uint32)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    result = np.empty(len(h), np.uint32)
    result[order] = h ^ (h >> np.uint32(16))
    return result.view(np.int32)


def _buckets(tokens: pa.Array, num_buckets: int, portable: bool) -> np.ndarray:
    if portable:
        first = [int.from_bytes(md5(t).digest()[:2], "big") for t in tokens.cast(pa.binary()).to_pylist()]
        return np.array(first, np.int64) % num_buckets
    return murmur3(tokens).astype(np.int64) % num_buckets


def token_counts(texts: pa.Array, num_buckets: int, portable: bool = False) -> np.ndarray:
    """A row per text: its tokens in each bucket, and behind them all its tokens.

    Each piece of texts is split at ASCII white space, and a token is hashed once for a piece.
    """
    counts = np.zeros((len(texts), num_buckets + 1))
    done = 0
    for piece in text_pieces(pa.RecordBatch.from_arrays([texts], names=["t"]), ["t"]):
        lists = pc.ascii_split_whitespace(pc.fill_null(piece.column("t"), ""))
        coded = lists.flatten().dictionary_encode()
        row, code = pc.list_parent_indices(lists).to_numpy(), coded.indices.to_numpy()
        if len(code):
            real = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
            bucket = np.where(real, _buckets(coded.dictionary, num_buckets, portable), -1)[code]
            inside = bucket >= 0
            place = row[inside] * num_buckets + bucket[inside]
            found = np.bincount(place, minlength=piece.num_rows * num_buckets).reshape(-1, num_buckets)
            counts[done : done + piece.num_rows, :-1] = found
        done += piece.num_rows
    counts[:, -1] = counts[:, :-1].sum(axis=1)
    return counts


def number_lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel())
