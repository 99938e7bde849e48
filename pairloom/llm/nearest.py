"""Exact nearest neighbours by a block matrix join of int8 codes with error bounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.llm.common import load, stored

QUERY_BLOCK = 4096
ROW_BLOCK = 4096
TILE = 1024
RUN_BLOCKS = 2
BLOCK_SCHEMA = "dim int, block long, n int, ids binary, vectors binary, codes binary, scales binary"


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 codes and one scale per row: a component is its code times the scale, to half a scale."""
    scales = np.abs(vectors).max(axis=1) / 127.0
    tiny = scales < np.finfo(np.float64).tiny * 127
    scales = np.where(tiny, 1.0, scales)
    return np.rint(vectors / scales[:, None]).astype(np.int8), scales


def bounds(qc: np.ndarray, qs: np.ndarray, vc: np.ndarray, vs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of code tiles, scaled back, and how far the true inner products may be from them.

    Codes are multiplied as float32, in which sums of products of int8 numbers are whole and exact
    below 2**24, so for up to 1,024 dimensions at once; more are added up in float64. With q = sq(cq + e)
    and v = sv(cv + f), |e| and |f| at most a half, the error is at most sq sv (|cq|/2 + |cv|/2 + d/4).
    """
    dims = qc.shape[1]
    approx = np.zeros((len(qc), len(vc)))
    for at in range(0, dims, 1024):
        cut = slice(at, at + 1024)
        approx += qc[:, cut].astype(np.float32) @ vc[:, cut].astype(np.float32).T
    scale = qs[:, None] * vs[None, :]
    approx *= scale
    q1 = np.abs(qc.astype(np.int32)).sum(axis=1)
    v1 = np.abs(vc.astype(np.int32)).sum(axis=1)
    error = scale * (0.5 * q1[:, None] + 0.5 * v1[None, :] + 0.25 * dims)
    error *= 1 + 1e-9
    return approx, error + 1e-12 * np.abs(approx)


def exact_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in float64, added up from the first component on."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * v[:, d]
    return total


def tile_neighbours(
    queries: tuple[np.ndarray, ...], rows: tuple[np.ndarray, ...], k: int, heaps: list[list[tuple[float, int]]]
) -> None:
    """Push the k best of a block of rows onto the heap of every query.

    A pair survives if its upper bound reaches both the k-th largest lower bound of the tile and
    the k-th best exact product so far; only survivors are computed in float64.
    """
    qid, q, qc, qs = queries
    vid, v, vc, vs = rows
    for a in range(0, len(qid), TILE):
        for b in range(0, len(vid), TILE):
            ids = vid[b : b + TILE]
            approx, error = bounds(qc[a : a + TILE], qs[a : a + TILE], vc[b : b + TILE], vs[b : b + TILE])
            own = qid[a : a + TILE, None] == ids[None, :]
            low = np.where(own, -np.inf, approx - error)
            least = np.array([h[0][0] if len(h) >= k else -np.inf for h in heaps[a : a + TILE]])
            if len(ids) > k:
                least = np.maximum(least, np.partition(low, -k, axis=1)[:, -k])
            high = approx + error
            i, j = np.nonzero((high >= least[:, None]) & ~own)
            for at in range(0, len(i), 65_536):
                ii, jj = i[at : at + 65_536], j[at : at + 65_536]
                score = exact_products(q[a + ii], v[b + jj])
                for row, s, ident in zip((a + ii).tolist(), score.tolist(), ids[jj].tolist(), strict=True):
                    heap = heaps[row]
                    entry = (s, -ident)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)


def usable(vector: str) -> Column:
    """Not null or empty, no null or non-finite component, not all zero."""
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0)


def blocks(df: DataFrame, id_column: str, vector: str, rows: int) -> DataFrame:
    """Rows of equal dimension packed into blocks of bounded size, with codes and scales."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        made = 0

        def block(dim: int, some: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            nonlocal made
            vectors = np.array([x for _, x in some], np.float64).reshape(len(some), dim)
            ids = np.array([i for i, _ in some], np.int64)
            codes, scales = quantise(vectors)
            values = [dim, made * 1_000_003 + task, len(some), *(x.tobytes() for x in (ids, vectors, codes, scales))]
            made += 1
            kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], kind) for x, kind in zip(values, kinds, strict=True)],
                names=["dim", "block", "n", "ids", "vectors", "codes", "scales"],
            )

        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(sizes)
            for ident, end, dim in zip(batch.column(0).to_pylist(), ends.tolist(), sizes.tolist(), strict=True):
                some = held.setdefault(dim, [])
                some.append((ident, flat[end - dim : end]))
                if len(some) >= max(1, min(rows, rows * 64 // dim)):
                    yield block(dim, held.pop(dim))
        for dim, some in held.items():
            yield block(dim, some)

    return df.select(F.col(id_column).cast("long"), F.col(vector)).mapInArrow(packed, BLOCK_SCHEMA)


def nearest(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k rows of largest inner product for every query, ties to the smaller id, all exact.

    Queries and candidates are packed into blocks, and a task multiplies one block of queries with a
    run of candidate blocks; the k best of each run are merged per query. Only a query set that
    is stated by the caller meets all rows.

    Null or zero vectors, and such with null or non-finite components, take no part; nor do null ids.
    Rows repeated as a whole count once. Vectors of another length are no candidates of a query. An id
    that has several vectors is one query, with the least of them, and each of them is a candidate
    of the others. Fewer than k candidates are all returned.
    """
    keep = F.col(id_column).isNotNull() & usable(vector)
    rows = candidates.select(id_column, vector).where(keep).dropDuplicates()
    asked = queries.select(id_column, vector).where(keep).groupBy(id_column).agg(F.min(vector).alias(vector))
    query_blocks, n_queries = numbered_blocks(asked, id_column, vector, QUERY_BLOCK)
    row_blocks, n_rows = numbered_blocks(rows, id_column, vector, ROW_BLOCK)
    runs = max(1, -(-n_rows // RUN_BLOCKS))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = query_blocks.withColumn("lane", F.pmod(F.col("block"), F.lit(n_queries)))
    left = left.withColumn("run", spread(runs))
    right = row_blocks.withColumn("run", F.pmod(F.col("block"), F.lit(runs)))
    right = right.withColumn("lane", spread(n_queries))
    keys = ["dim", "lane", "run"]

    def multiply(some: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        for query in some.itertuples():
            mine = unpacked(query)
            heaps: list[list[tuple[float, int]]] = [[] for _ in mine[0]]
            for row in others.itertuples():
                tile_neighbours(mine, unpacked(row), k, heaps)
            found += [(q, -v, s) for q, heap in zip(mine[0].tolist(), heaps, strict=True) for s, v in heap]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        multiply, "query_id long, vec_id long, score double"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def unpacked(row) -> tuple[np.ndarray, ...]:
    shape = (row.n, row.dim)
    return (
        np.frombuffer(row.ids, np.int64),
        np.frombuffer(row.vectors, np.float64).reshape(shape),
        np.frombuffer(row.codes, np.int8).reshape(shape),
        np.frombuffer(row.scales, np.float64),
    )


def numbered_blocks(df: DataFrame, id_column: str, vector: str, rows: int) -> tuple[DataFrame, int]:
    """Stored blocks of rows spread evenly, and about how many there are."""
    kept = stored(df, "vectors")
    parts = max(1, -(-kept.count() // rows))
    return stored(blocks(kept.repartition(parts), id_column, vector, rows), "blocks"), parts


def op4_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0))
