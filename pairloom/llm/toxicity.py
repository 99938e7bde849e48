"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pairloom.llm.common import crc_split, lean, load, pieces, texts_of

WINDOW = 24
STRIDE = 16
HIDDEN = 8
WORD_BITS = 15
CHAR_BITS = 16
DIM = 4
PUNCTUATION = b".,;:!?\"'()[]{}<>*&#$%|-_=+/\\~^`@"
THRESHOLD = 0.7
SAMPLE = 1500
CACHE = 32_000_000
STEPS = 200
UNSEEN = 0.5
WORDS_AT_ONCE = 10_000

Params = dict[str, np.ndarray]


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, and buckets of its character 3-, 4- and 5-grams with the bounds of words among them.

    Words come without outer punctuation and are enclosed in marks; a word has one n-gram at least.
    """
    bare = [w.strip(PUNCTUATION) for w in words]
    bucket = np.array([zlib.crc32(w) & ((1 << WORD_BITS) - 1) for w in bare], np.int64)
    marked = [b"<" + w + b">" if w else b"<>>" for w in bare]
    data = np.frombuffer(b"".join(marked) + b"\0\0\0\0", np.uint8).astype(np.uint32)
    sizes = np.array([len(w) for w in marked])
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(int(ends[-1]))
    grams, owner = [], []
    code = np.zeros(len(data) - 4, np.uint32)
    who = np.repeat(np.arange(len(words)), sizes)
    for n in range(1, 6):
        code = code * np.uint32(16777619) + data[n - 1 : len(data) - 5 + n] + np.uint32(1)
        if n >= 3:
            whole = left >= n
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(2654435761) + np.uint32(n)
            grams.append((mixed >> np.uint32(32 - CHAR_BITS))[whole])
            owner.append(who[whole])
    grams, owner = np.concatenate(grams), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    grams, owner = grams[order].astype(np.int64), owner[order]
    return bucket, grams, np.searchsorted(owner, np.arange(len(words)))


def vocabulary_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of many words, made for some at a time."""
    parts = [word_features(words[i : i + WORDS_AT_ONCE]) for i in range(0, len(words), WORDS_AT_ONCE)]
    shift = np.cumsum([0, *[len(g) for _, g, _ in parts]])
    return (
        np.concatenate([b for b, _, _ in parts]),
        np.concatenate([g.astype(np.int32) for _, g, _ in parts]),
        np.concatenate([s + d for (_, _, s), d in zip(parts, shift, strict=False)]),
    )


def inputs(p: Params, bucket: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Input vector of each word: its word vector, the mean of its n-gram vectors, and their strongest evidence."""
    counts = np.diff(np.append(starts, len(grams)))[:, None]
    chars = np.add.reduceat(p["chars"][grams], starts, axis=0) / counts
    peak = np.maximum.reduceat(p["evidence"][grams], starts)[:, None]
    return np.concatenate([p["words"][bucket], chars, peak], axis=1)


def windows(sizes: list[int]) -> list[tuple[int, int, int]]:
    """Overlapping windows (document, from, to) over all words of the documents."""
    cut = []
    for doc, n in enumerate(sizes):
        start = 0
        while True:
            cut.append((doc, start, min(start + WINDOW, n)))
            if start + WINDOW >= n:
                break
            start += STRIDE
    return cut


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def recur(gates: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: bool = False):
    """Hidden states of a gated recurrent layer, given its input gates (time, batch, 3 * hidden).

    Masked steps hand on the state. `keep` returns what the gradient needs as well.
    """
    steps, batch, _ = gates.shape
    h = np.zeros((batch, HIDDEN), gates.dtype)
    states = np.empty((steps, batch, HIDDEN), gates.dtype)
    trace = []
    for t in range(steps):
        inner = h @ u
        both = sigmoid(gates[t, :, : 2 * HIDDEN] + inner[:, : 2 * HIDDEN])
        z, r = both[:, :HIDDEN], both[:, HIDDEN:]
        new = np.tanh(gates[t, :, 2 * HIDDEN :] + r * inner[:, 2 * HIDDEN :])
        m = mask[t][:, None]
        if keep:
            trace.append((h, z, r, new, inner[:, 2 * HIDDEN :]))
        h = h + m * (1 - z) * (new - h)
        states[t] = h
    return (states, trace) if keep else states


def recur_gradient(d_states: np.ndarray, mask: np.ndarray, u: np.ndarray, trace: list) -> tuple[np.ndarray, np.ndarray]:
    steps, batch, _ = d_states.shape
    d_gates = np.zeros((steps, batch, 3 * HIDDEN), d_states.dtype)
    d_u = np.zeros_like(u)
    d_h = np.zeros((batch, HIDDEN), d_states.dtype)
    for t in range(steps - 1, -1, -1):
        h, z, r, new, inner = trace[t]
        m = mask[t][:, None]
        d_next = d_h + d_states[t]
        d_new = d_next * m * (1 - z) * (1 - new * new)
        d_z = -d_next * m * (new - h) * z * (1 - z)
        d_r = d_new * inner * r * (1 - r)
        d_inner = np.concatenate([d_z, d_r, d_new * r], axis=1)
        d_gates[t] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_u += h.T @ d_inner
        d_h = d_next * (1 - m * (1 - z)) + d_inner @ u.T
    return d_gates, d_u


def pooled(p: Params, states: np.ndarray, mask: np.ndarray):
    """Attention weights over the states of a window, the pooled state, and the logit."""
    tanh = np.tanh(states @ p["attend"])
    energy = np.where(mask > 0, tanh @ p["query"], -1e9)
    energy = np.exp(energy - energy.max(axis=0))
    weight = energy * mask
    weight /= np.maximum(weight.sum(axis=0), 1e-9)
    context = np.einsum("tb,tbh->bh", weight, states)
    return tanh, weight, context, context @ p["out"] + p["bias"][0]


def score_windows(p: Params, gates: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Probability of every window from the input gates of both directions (time, batch, 6 * hidden)."""
    ahead = recur(gates[:, :, : 3 * HIDDEN], mask, p["u_ahead"])
    back = recur(gates[::-1, :, 3 * HIDDEN :], mask[::-1], p["u_back"])[::-1]
    return sigmoid(pooled(p, np.concatenate([ahead, back], axis=2), mask)[3])


def loss_gradient(p: Params, x: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[Params, np.ndarray]:
    """Gradients of the mean cross-entropy of a batch of windows, and that of its inputs."""
    ahead, trace_ahead = recur(x @ p["w_ahead"] + p["b_ahead"], mask, p["u_ahead"], True)
    back, trace_back = recur((x @ p["w_back"] + p["b_back"])[::-1], mask[::-1], p["u_back"], True)
    states = np.concatenate([ahead, back[::-1]], axis=2)
    tanh, weight, context, logit = pooled(p, states, mask)
    d_logit = (sigmoid(logit) - target) / len(target)
    g: Params = {"out": context.T @ d_logit, "bias": np.array([d_logit.sum()], x.dtype)}
    d_context = d_logit[:, None] * p["out"]
    d_states = weight[:, :, None] * d_context[None]
    d_weight = np.einsum("bh,tbh->tb", d_context, states)
    d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_tanh = d_energy[:, :, None] * p["query"] * (1 - tanh * tanh)
    g["query"] = np.einsum("tb,tbk->k", d_energy, tanh)
    g["attend"] = np.einsum("tbh,tbk->hk", states, d_tanh)
    d_states = d_states + d_tanh @ p["attend"].T
    d_ahead, g["u_ahead"] = recur_gradient(d_states[:, :, :HIDDEN], mask, p["u_ahead"], trace_ahead)
    d_back, g["u_back"] = recur_gradient(d_states[::-1, :, HIDDEN:], mask[::-1], p["u_back"], trace_back)
    d_back = d_back[::-1]
    for side, d in (("ahead", d_ahead), ("back", d_back)):
        g[f"w_{side}"] = np.einsum("tbd,tbk->dk", x, d)
        g[f"b_{side}"] = d.sum(axis=(0, 1))
    return g, d_ahead @ p["w_ahead"].T + d_back @ p["w_back"].T


def evidence(present: Iterable[np.ndarray], labels: np.ndarray, buckets: int) -> np.ndarray:
    """How many standard errors a bucket's log-odds of being in toxic documents is from even, at most 6."""
    counts = np.zeros((2, buckets))
    for found, label in zip(present, labels.tolist(), strict=True):
        counts[label, np.unique(found)] += 1
    totals = np.bincount(labels, minlength=2)[:, None]
    ratio = np.log((counts + 0.5) / (totals - counts + 0.5))
    error = (1 / (counts + 0.5)).sum(axis=0) ** 0.5
    return np.clip((ratio[1] - ratio[0]) / error, -6, 6).astype(np.float32)


def fit_network(texts: list[bytes], labels: np.ndarray, epochs: int = 10, seed: int = 7) -> Params:
    """Train on windows of labelled documents.

    Word and n-gram vectors start with the evidence that the labelled documents give for them. A
    toxic document teaches by its most suspicious window, any other by its most suspicious windows and
    some at random; which ones these are is decided anew by the network half-way. Few documents are gone
    through more often, for at least STEPS steps. UNSEEN of the words of a batch come without their word
    vector, so that the network learns to read forms it has never met by their n-grams.
    """
    rng = np.random.default_rng(seed)
    vocabulary: dict[bytes, int] = {}
    ids = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in t.lower().split()], np.int32) for t in texts]
    bucket, grams, starts = vocabulary_features(list(vocabulary) or [b""])
    del vocabulary
    stops = np.append(starts[1:], len(grams))

    def own(d: np.ndarray) -> np.ndarray:
        return picked(bucket, grams, starts, stops, np.unique(d))[1]

    f = np.float32
    p: Params = {
        "words": rng.normal(0, 0.1, (1 << WORD_BITS, DIM)).astype(f),
        "chars": rng.normal(0, 0.1, (1 << CHAR_BITS, DIM)).astype(f),
        "evidence": evidence(map(own, ids), labels, 1 << CHAR_BITS) / 3,
        "attend": rng.normal(0, 0.3, (2 * HIDDEN, HIDDEN)).astype(f),
        "query": rng.normal(0, 0.3, HIDDEN).astype(f),
        "out": rng.normal(0, 0.3, 2 * HIDDEN).astype(f),
        "bias": np.array([-1.0], f),
    }
    p["words"][:, 0] = evidence((bucket[d] for d in ids), labels, 1 << WORD_BITS) / 3
    p["chars"][:, 0] = p["evidence"]
    for side in ("ahead", "back"):
        p[f"w_{side}"] = rng.normal(0, 0.3, (2 * DIM + 1, 3 * HIDDEN)).astype(f)
        p[f"u_{side}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)).astype(f)
        p[f"b_{side}"] = np.zeros(3 * HIDDEN, f)
    cut = windows([len(d) for d in ids])
    by_doc: dict[int, list[int]] = {}
    for number, (doc, _, _) in enumerate(cut):
        by_doc.setdefault(doc, []).append(number)
    suspicion = p["words"][bucket, 0] + np.maximum.reduceat(p["evidence"][grams], starts)
    worth = np.array([suspicion[ids[d][a:b]].max() if b > a else 0.0 for d, a, b in cut])
    memory = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items() if k != "evidence"}
    step = 0
    about = sum(min(len(w), 1 if labels[d] else 7) for d, w in by_doc.items())
    epochs = max(epochs, -(-STEPS * 256 // max(about, 256)))
    for epoch in range(epochs):
        if epoch == epochs // 2:
            table = [np.zeros((0, 6 * HIDDEN), np.float32)]
            for i in range(0, len(bucket), WORDS_AT_ONCE):
                some = np.arange(i, min(i + WORDS_AT_ONCE, len(bucket)))
                table.append(project(p, inputs(p, *picked(bucket, grams, starts, stops, some)))[:-1])
            table = np.concatenate([*table, np.zeros((1, 6 * HIDDEN), np.float32)])
            for i in range(0, len(cut), 2048):
                at, mask = padded(ids, cut[i : i + 2048], len(bucket))
                worth[i : i + 2048] = score_windows(p, table[at], mask)
            del table
        chosen: list[tuple[int, int]] = []
        for doc, own_windows in by_doc.items():
            ranked = sorted(own_windows, key=lambda w: -worth[w])
            label = int(labels[doc])
            chosen += [(w, label) for w in ranked[: 1 if label else 5]]
            if not label:
                chosen += [(int(w), 0) for w in rng.choice(own_windows, min(2, len(own_windows)), replace=False)]
        order = rng.permutation(len(chosen))
        rate = 0.01 if 2 * epoch < epochs else 0.003
        for first in range(0, len(order), 256):
            some = [chosen[i] for i in order[first : first + 256]]
            at, mask = padded(ids, [cut[w] for w, _ in some], len(bucket))
            used, where = np.unique(at, return_inverse=True)
            real = used < len(bucket)
            known = used[real]
            b, g, s = picked(bucket, grams, starts, stops, known)
            x = np.zeros((len(used), 2 * DIM + 1), f)
            if len(known):
                x[: len(known)] = inputs(p, b, g, s)
                hidden = np.flatnonzero(rng.random(len(known)) < UNSEEN)
                x[hidden, :DIM] = 0
            target = np.array([label for _, label in some], f)
            grad, d_x = loss_gradient(p, x[where.reshape(at.shape)], mask, target)
            d_word = np.zeros_like(x)
            np.add.at(d_word, where.ravel(), d_x.reshape(-1, x.shape[1]))
            grad["words"], grad["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
            if len(known):
                d_word[hidden, :DIM] = 0
                counts = np.diff(np.append(s, len(g)))
                np.add.at(grad["words"], b, d_word[: len(known), :DIM])
                np.add.at(grad["chars"], g, np.repeat(d_word[: len(known), DIM : 2 * DIM] / counts[:, None], counts, 0))
            step += 1
            for k, d in grad.items():
                first_m, second_m = memory[k]
                first_m += 0.1 * (d - first_m)
                second_m += 0.001 * (d * d - second_m)
                p[k] -= rate * (first_m / (1 - 0.9**step)) / (np.sqrt(second_m / (1 - 0.999**step)) + 1e-6)
    return p


def picked(bucket, grams, starts, stops, known):
    """Features of some of the words."""
    counts = (stops - starts)[known]
    first = np.cumsum(counts) - counts
    at = np.repeat(starts[known] - first, counts) + np.arange(int(counts.sum()))
    return bucket[known], grams[at], first


def padded(ids: list[np.ndarray], cut: list[tuple[int, int, int]], filler: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of windows (time, batch), filled up with `filler`, and their mask."""
    at = np.full((WINDOW, len(cut)), filler, np.int64)
    mask = np.zeros((WINDOW, len(cut)), np.float32)
    for column, (doc, a, b) in enumerate(cut):
        at[: b - a, column] = ids[doc][a:b]
        mask[: b - a, column] = 1
    return at, mask


def project(p: Params, x: np.ndarray) -> np.ndarray:
    """Input gates of both directions for every word, and a last row for padding."""
    gates = np.concatenate([x @ p["w_ahead"] + p["b_ahead"], x @ p["w_back"] + p["b_back"]], axis=1)
    return np.concatenate([gates, np.zeros((1, gates.shape[1]), gates.dtype)]).astype(np.float32)


def fit_toxicity(labelled: DataFrame, sample: int = SAMPLE) -> Params:
    """Fit on at most `sample` toxic and as many other rows of (`doc_id`, `text`, `toxic`), lowest hash first.

    Rows without text or label teach nothing. With one label only, every score is below one half or
    above it; with none at all, scores are those of the untrained bias.
    """
    rows = labelled.where(F.col("toxic").isNotNull() & F.col("text").isNotNull())
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("text")]
    found = []
    for label in (1, 0):
        some = rows.where(F.col("toxic") == label).orderBy(*order).limit(sample)
        found += [(r["text"].encode(), label) for r in some.select("text").collect()]
    return fit_network([t for t, _ in found], np.array([y for _, y in found], np.int64))


def labelled_sample(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Texts of a bounded sample of labels; of repeated labels of an id the highest counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    one = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    picked = None
    for label in (0, 1):
        some = one.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = some if picked is None else picked.unionByName(some)
    return documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most 2 * sample rows


def batch_scores(net: Params, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of batches and the score of each of their texts.

    Words met before in a task are looked up, up to a bound in bytes; the table of their gates grows by doubling,
    and its first row stands for places without a word.
    """
    table = np.zeros((2 * WORDS_AT_ONCE, 6 * HIDDEN), np.float32)
    known: dict[bytes, int] = {}
    held = 0
    for piece in pieces(batches, size=1_000_000):
        docs = [t.lower().split() if t else [] for t in texts_of(piece)]
        if held > CACHE:
            known, held = {}, 0
        fresh = [w for w in dict.fromkeys(w for d in docs for w in d) if w not in known]
        for a in range(0, len(fresh), WORDS_AT_ONCE):
            some = fresh[a : a + WORDS_AT_ONCE]
            size = len(known) + 1
            if size + len(some) > len(table):
                table = np.concatenate([table, np.zeros_like(table)])
            table[size : size + len(some)] = project(net, inputs(net, *word_features(some)))[:-1]
            known.update((w, size + i) for i, w in enumerate(some))
            held += sum(map(len, some)) + (24 * HIDDEN + 150) * len(some)
        lookup = known.__getitem__
        best = np.zeros(len(docs))
        sizes = [len(d) for d in docs]
        cut = np.array(windows(sizes), np.int64)
        first = np.cumsum(sizes) - sizes
        whose = cut[:, 0]
        begin, length = first[whose] + cut[:, 1], cut[:, 2] - cut[:, 1]
        flat = np.fromiter((i for d in docs for i in map(lookup, d)), np.int64, sum(sizes))
        flat = np.append(flat, np.zeros(WINDOW, np.int64))
        steps = np.arange(WINDOW)[:, None]
        for a in range(0, len(cut), 2048):
            mask = steps < length[None, a : a + 2048]
            at = np.where(mask, flat[np.minimum(begin[None, a : a + 2048] + steps, len(flat) - 1)], 0)
            np.maximum.at(best, whose[a : a + 2048], score_windows(net, table[at], mask.astype(np.float32)))
        yield piece, best


def toxicity(docs: DataFrame, p: Params, *extra: Column, id_column: str = "doc_id") -> DataFrame:
    """Score every whole text by its most toxic window; `extra` columns are carried along.

    Null and empty texts have one empty window. A row's score depends on its text alone, so
    repeated rows score alike.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), *extra, "text")
    scored = toxicity_scores(rows, p).withColumnRenamed("_score", "score")
    return scored.drop("text").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity_scores(docs: DataFrame, p: Params) -> DataFrame:
    """All columns of the documents and `_score`."""
    docs = docs.drop("_score")
    shipped = docs.sparkSession.sparkContext.broadcast(p)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, best in batch_scores(shipped.value, batches):
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(best)], names=[*piece.schema.names, "_score"])

    schema = StructType([*docs.schema.fields, StructField("_score", DoubleType())])
    return docs.mapInArrow(lean(score), schema)


def op1_gated_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    labels = load(spark, sf_dir, "labels").where(crc_split(F.col("doc_id"), 3) != 1)
    p = fit_toxicity(labelled_sample(documents, labels))
    held_out = F.coalesce(crc_split(F.col("doc_id"), 3) == 1, F.lit(False))
    return toxicity(documents, p, held_out.alias("held_out"))
