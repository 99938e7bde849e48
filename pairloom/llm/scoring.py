"""Language-model scores of documents: a log-bilinear model trained by noise-contrastive estimation."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import (
    SPACES,
    VECTOR_SCHEMA,
    crc_split,
    gathered,
    lean,
    load,
    pieces,
    stored,
    texts_of,
    vector_batch,
    vector_rows,
    words_of,
)

END = b""
WORDS = 960
TAILS = 64
SIZE = WORDS + TAILS
FREQUENT = 100_000
DIM = 24
NOISE = 64
ROUNDS = 3
BATCH = 8192
FLUSH = 400_000


def tail_class(word: bytes) -> int:
    """Class of a word outside the vocabulary, by its ending."""
    return zlib.crc32(word[-2:]) % TAILS


TAIL_OF_ONE = np.array([tail_class(bytes([x])) for x in range(256)])
TAIL_OF_TWO = np.array([tail_class(bytes([x, y])) for x in range(256) for y in range(256)])


def token_counts(docs: DataFrame) -> DataFrame:
    """Count of every token of the documents, with one end token (the empty word) for each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["token", "n"]
            )
            held.clear()
            return batch

        for piece in pieces(batches):
            for text in texts_of(piece):
                held.update(words_of(text))
                held[END] += 1
                if len(held) > FLUSH:
                    yield flush()
        yield flush()

    parts = docs.select("text").mapInArrow(lean(count), "token binary, n long")
    return stored(parts.groupBy("token").agg(F.sum("n").alias("c")), "tokens")


def encoded(texts: list[bytes | None], lookup: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Number in a table (-1: not there), text and tail class of every word of the texts, and the words."""
    joined = b"\n".join(t or b"" for t in texts).lower()
    words = joined.split()
    ids = np.fromiter(map(lookup.get, words, repeat(-1)), np.int64, len(words))
    data = np.frombuffer(b"\n" + joined + b"\n", np.uint8)
    space = SPACES[data].view(np.int8)
    starts, ends = np.flatnonzero(np.diff(space) == -1) + 1, np.flatnonzero(np.diff(space) == 1) + 1
    last, before = data[ends - 1].astype(np.int64), data[ends - 2].astype(np.int64)
    tail = np.where(ends - starts > 1, TAIL_OF_TWO[before * 256 + last], TAIL_OF_ONE[last])
    offsets = np.cumsum([len(t or b"") + 1 for t in texts]) + 1
    return ids, np.searchsorted(offsets, starts, side="right"), tail, words


def with_ends(classes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of n texts one after the other, each closed by the end token, and where each text begins."""
    counts = np.bincount(doc, minlength=n)
    whole = np.zeros(len(classes) + n, np.int64)
    whole[np.arange(len(classes)) + doc] = classes
    return whole, np.cumsum(counts + 1) - (counts + 1)


def history(classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last and the last but one class before every token; the end token's class stands before a text."""
    one = np.concatenate(([0], classes[:-1]))
    two = np.concatenate(([0, 0], classes[:-2]))[: len(classes)]
    one[bounds] = 0
    two[bounds] = 0
    after = bounds + 1
    two[after[after < len(classes)]] = 0
    return one, two


def context_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """How often each class follows each pair of classes, over all texts."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.int64), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], names=["code", "n"])

        for piece in pieces(batches):
            ids, doc, tail, _ = encoded(texts_of(piece), known)
            classes, bounds = with_ends(np.where(ids < 0, WORDS + tail, ids), doc, piece.num_rows)
            one, two = history(classes, bounds)
            held.append((two * SIZE + one) * SIZE + classes)
            size += len(classes)
            if size > 2_000_000:
                yield flush()
                held, size = [], 0
        yield flush()

    parts = docs.select("text").mapInArrow(lean(count), "code long, n long")
    return stored(parts.groupBy("code").agg(F.sum("n").alias("n")), "contexts")


Params = dict[str, np.ndarray]


def start(unigram: np.ndarray, seed: int = 11) -> Params:
    rng = np.random.default_rng(seed)
    v = len(unigram)
    return {
        "context": rng.normal(0, 0.1, (v, DIM)),
        "target": rng.normal(0, 0.1, (v, DIM)),
        "near": np.eye(DIM) + rng.normal(0, 0.05, (DIM, DIM)),
        "far": 0.5 * np.eye(DIM) + rng.normal(0, 0.05, (DIM, DIM)),
        "bias": np.log(unigram),
    }


def scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of values by row number."""
    order = np.argsort(rows, kind="stable")
    found, first = np.unique(rows[order], return_index=True)
    total = np.zeros((size, values.shape[1]))
    total[found] = np.add.reduceat(values[order], first, axis=0)
    return total


def contrast(p: Params, two: np.ndarray, one: np.ndarray, word: np.ndarray, noise: np.ndarray, q: np.ndarray) -> Params:
    """Gradient of the noise-contrastive loss of a batch: tell its words from shared noise words.

    The prediction of a context is a bilinear function of its word vectors, and a word's score its product
    with the word's vector, plus a bias. Every word of the batch meets all noise words, as many as the noise factor.
    """
    size = len(q)
    r1, r2 = p["context"][one], p["context"][two]
    hat = r1 @ p["near"] + r2 @ p["far"]
    k = np.log(len(noise) * q)
    t = p["target"][word]
    up = (hat * t).sum(axis=1) + p["bias"][word] - k[word]
    down = hat @ p["target"][noise].T + (p["bias"] - k)[noise]
    d_up = (1 / (1 + np.exp(-np.clip(up, -30, 30))) - 1) / len(word)
    d_down = 1 / (1 + np.exp(-np.clip(down, -30, 30))) / len(word)
    d_hat = d_up[:, None] * t + d_down @ p["target"][noise]
    g = {"near": r1.T @ d_hat, "far": r2.T @ d_hat}
    g["context"] = scatter(one, d_hat @ p["near"].T, size) + scatter(two, d_hat @ p["far"].T, size)
    g["target"] = scatter(word, d_up[:, None] * hat, size)
    np.add.at(g["target"], noise, d_down.T @ hat)
    g["bias"] = np.bincount(word, d_up, size)
    np.add.at(g["bias"], noise, d_down.sum(axis=0))
    return g


def train_part(p: Params, code: np.ndarray, n: np.ndarray, q: np.ndarray, seed: int, rate: float) -> Params:
    """Steps over context counts of a task; a step draws contexts by their counts, so a count is a weight."""
    rng = np.random.default_rng(seed)
    size = len(q)
    p = {k: v.copy() for k, v in p.items()}
    squares = {k: np.full_like(v, 1e-8) for k, v in p.items()}
    ladder, chance = np.cumsum(n), np.cumsum(q)
    for _ in range(max(20, -(-len(code) // BATCH))):
        drawn = code[np.searchsorted(ladder, rng.random(BATCH) * ladder[-1], side="right")]
        noise = np.minimum(np.searchsorted(chance, rng.random(NOISE) * chance[-1], side="right"), size - 1)
        word, rest = drawn % size, drawn // size
        g = contrast(p, rest // size, rest % size, word, noise, q)
        for k, d in g.items():
            squares[k] += d * d
            p[k] -= rate * d / np.sqrt(squares[k])
    return p


def fit_scorer(contexts: DataFrame, unigram: np.ndarray, rounds: int = ROUNDS) -> Params:
    """Train in rounds: every task takes steps over its share of the context counts, and the models are averaged.

    A task sends one model, whose size does not depend on the corpus. Averages are weighted by the
    tokens behind a task's counts.
    """
    q = unigram / unigram.sum()
    p = start(q)
    shapes = {k: v.shape for k, v in p.items()}
    for turn in range(rounds):
        shipped = contexts.sparkSession.sparkContext.broadcast((p, q))

        def steps(batches: Iterator[pa.RecordBatch], turn: int = turn, shipped=shipped) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            model, noise = shipped.value
            seed = 1000 * turn + TaskContext.get().partitionId()
            held: list[tuple[np.ndarray, np.ndarray]] = []

            def learn() -> Iterator[pa.RecordBatch]:
                nonlocal model
                code, n = (np.concatenate([h[i] for h in held]) for i in range(2))
                held.clear()
                model = train_part(model, code, n, noise, seed, 0.1 / (turn + 1))
                weight = float(n.sum())
                rows = [("weight", 0, np.array([weight]).tobytes())]
                for k, v in model.items():
                    rows += vector_rows(k, v * weight)
                yield vector_batch(rows)

            for batch in batches:
                if batch.num_rows:
                    held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
                if sum(len(c) for c, _ in held) > 2_000_000:
                    yield from learn()
            if held:
                yield from learn()

        sums = gathered(contexts.select("code", "n").mapInArrow(lean(steps), VECTOR_SCHEMA))
        if "weight" not in sums:
            break
        p = {k: sums[k].reshape(shape) / sums["weight"][0] for k, shape in shapes.items()}
    return p


def lookup_tables(p: Params) -> tuple[np.ndarray, ...]:
    """Scores of each class after each near and each far class, and the normaliser of every pair of classes.

    The model adds up what the two places of a context say, so that the products of all classes are two
    tables; the normalisers are summed over the whole output, block by block of contexts.
    """
    near = ((p["context"] @ p["near"]) @ p["target"].T + p["bias"]).astype(np.float32)
    far = ((p["context"] @ p["far"]) @ p["target"].T).astype(np.float32)
    top = near.max(axis=1)
    hot_near, hot_far = np.exp(near - top[:, None]), np.exp(far - far.max(axis=1)[:, None])
    total = hot_far @ hot_near.T  # [two, one]: sums over the output of products of exponentials
    log_z = np.log(np.maximum(total, 1e-30)) + top[None, :] + far.max(axis=1)[:, None]
    return near, far, log_z.astype(np.float32)


@dataclass
class Scorer:
    """What scoring needs: frequent tokens with their counts (the model's words come first), the model, and totals."""

    frequent: dict[bytes, int]
    counts: np.ndarray
    end: int
    tables: tuple[np.ndarray, ...]
    tail_total: np.ndarray
    base_total: float


PART_SCHEMA = (
    "uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, rare array<binary>"
)


def parts(docs: DataFrame, scorer: Scorer, held_out: Column, id_column: str) -> DataFrame:
    """What a document gets from the model and from frequent tokens, and its rare tokens, still to be counted."""
    shipped = docs.sparkSession.sparkContext.broadcast(vars(scorer))  # plain values: broadcasts are not pickled by value

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(**shipped.value)
        near, far, log_z = s.tables
        for piece in pieces(batches):
            n = piece.num_rows
            ids, doc, tail, words = encoded(texts_of(piece), s.frequent)
            inner = (ids >= 0) & (ids < WORDS)
            classes, bounds = with_ends(np.where(inner, ids, WORDS + tail), doc, n)
            one, two = history(classes, bounds)
            log_p = near[one, classes].astype(np.float64)
            log_p += far[two, classes]
            log_p -= log_z[two, one]
            model = np.add.reduceat(log_p, bounds) / np.log(10)
            found = ids >= 0
            count = np.log10(s.counts[ids] + 0.5)
            base = np.zeros(n) + np.bincount(doc[found], (count - np.log10(s.base_total))[found], n)
            base += np.log10((s.end + 0.5) / s.base_total)
            outer = found & ~inner
            model += np.bincount(doc[outer], (count - np.log10(s.tail_total)[tail])[outer], n)
            known = np.bincount(doc[found], minlength=n) + (s.end > 0)
            rare = np.flatnonzero(~found)
            ends = np.cumsum(np.bincount(doc[rare], minlength=n))
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, ends).astype(np.int32)), pa.array([words[i] for i in rare], pa.binary())
            )
            sizes = np.bincount(doc, minlength=n) + 1
            values = [pa.array(x) for x in (sizes, known.astype(np.int64), base, model)]
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(i) for i in range(3)], *values, lists],
                names=["uid", "doc_id", "held_out", "n_tokens", "known", "base", "model", "rare"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_column).cast("long").alias("doc_id"),
        held_out.alias("held_out"),
        "text",
    )
    return stored(rows.mapInArrow(lean(score), PART_SCHEMA), "parts")


def frequent_tokens(counts: DataFrame, most: int = FREQUENT) -> list[tuple[bytes, int]]:
    """At most `most` of the most frequent words with their counts, highest first.

    A histogram over eighths of powers of two finds the count from which on few enough words are left, so
    that no task sends more than it has to.
    """
    words = counts.where(F.length("token") > 0)
    step = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    room, least = most, None
    for row in words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # 512 rows at most
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    if least is None:
        return []
    found = [(bytes(r["token"]), r["c"]) for r in words.where(step >= least).collect()]
    return sorted(found, key=lambda x: (-x[1], x[0]))


def tail_sizes(counts: DataFrame, words: dict[bytes, int]) -> dict[str, np.ndarray]:
    """Tokens and types of each tail class."""
    shipped = counts.sparkSession.sparkContext.broadcast(words)

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        tokens, types = np.zeros(TAILS), np.zeros(TAILS)
        for batch in batches:
            for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if w and w not in known:
                    tokens[tail_class(w)] += c
                    types[tail_class(w)] += 1
        yield vector_batch([*vector_rows("tokens", tokens), *vector_rows("types", types)])

    found = gathered(counts.select("token", "c").mapInArrow(lean(tails), VECTOR_SCHEMA))
    return {k: found.get(k, np.zeros(TAILS)) for k in ("tokens", "types")}


def language_model_scores(docs: DataFrame, held_out: Column, id_column: str = "doc_id") -> DataFrame:
    """Base-10 log-probability of every whole text under a unigram base and under the neural model.

    Counts cover all documents that are not held out. The model gives each token's class from the two
    classes before it by normalised probabilities; a class is a frequent token, or the tail of all
    others with some ending, in which a token's probability follows its count, with half a count for a
    token never seen. Rare tokens find their counts by a shuffle join, frequent ones in a table of fixed size.

    Null texts count as empty and have the end token only; repeated rows count and score one by one;
    without documents to learn from, all counts are zero.
    """
    seen = docs.where(~held_out)
    counts = token_counts(seen)
    top = frequent_tokens(counts)
    ends = counts.where(F.length("token") == 0).first()
    ends = ends["c"] if ends else 0
    frequent = {w: i for i, (w, _) in enumerate(top, 1)}
    words = {w: i for w, i in frequent.items() if i < WORDS}
    of = np.array([ends, *[c for _, c in top]], np.float64)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = total["n"], total["v"]
    tail_counts = tail_sizes(counts, words)
    tail_total = tail_counts["tokens"] + 0.5 * (tail_counts["types"] + 1)
    unigram = np.full(SIZE, 0.5)
    unigram[: len(words) + 1] += of[: len(words) + 1]
    unigram[WORDS:] += tail_counts["tokens"]
    p = fit_scorer(context_counts(seen, words), unigram)
    base_total = n + 0.5 * (v + 1)
    scorer = Scorer(frequent, of, ends, lookup_tables(p), tail_total, base_total)
    scored = parts(docs, scorer, held_out, id_column)

    rare = scored.select("uid", F.explode("rare").alias("token"))
    rest = rare.join(counts, "token", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    ending = F.expr(f"cast(pmod(crc32(substring(token, greatest(length(token) - 1, 1), 2)), {TAILS}) as int)")
    totals = F.array(*[F.lit(float(x)) for x in tail_total])
    rest = rest.groupBy("uid").agg(
        F.sum(F.log10((F.col("c") + 0.5) / F.lit(float(base_total)))).alias("more_base"),
        F.sum(F.log10((F.col("c") + 0.5) / F.get(totals, ending))).alias("more_model"),
        F.count_if(F.col("c") > 0).alias("more_known"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.drop("rare").join(rest, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + zero("more_known")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base")).alias("base_score"),
        (F.col("model") + zero("more_model")).alias("score"),
    )


def op9_log_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_split(F.col("doc_id"), 5) == 1, F.lit(False))
    return language_model_scores(documents, held_out)
