"""Language mixtures of documents by expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import (
    VECTOR_SCHEMA,
    crc_split,
    gathered,
    lean,
    load,
    pieces,
    texts_of,
    vector_batch,
    vector_rows,
)

BUCKETS = 1 << 16
SEGMENT = 2_000_000
UNDETERMINED = "und"
#: ASCII letters in lower case and all bytes above ASCII stay, everything else parts words.
FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


@dataclass
class LanguageModel:
    """Log-probabilities of hashed trigrams, one column per language."""

    languages: list[str]
    log_p: np.ndarray


def segments(text: bytes, size: int = SEGMENT) -> Iterator[bytes]:
    """A long text in parts that end at spaces, so that no word is cut."""
    start = 0
    while len(text) - start > size:
        end = text.find(b" ", start + size)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigram around every letter byte, where words begin among them, and each word's text."""
    joined = b" " + b" ".join(texts) + b" "
    data = np.frombuffer(joined, np.uint8)
    inner = np.flatnonzero(data != 32)
    code = data[inner - 1].astype(np.uint32) << np.uint32(16)
    code |= data[inner].astype(np.uint32) << np.uint32(8)
    code |= data[inner + 1]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(16)
    begins = np.flatnonzero(data[inner - 1] == 32)
    offsets = np.cumsum([len(t) + 1 for t in texts]) + 1
    return bucket, begins, np.searchsorted(offsets, inner[begins], side="right")


def fit_languages(labelled: DataFrame, smoothing: float = 0.1) -> LanguageModel:
    """Trigram statistics of every text of every language, summed by the executors.

    `labelled` has `text` and `lang`; rows where one of them is null are left out. A task
    holds and sends one vector per language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for piece in pieces(batches):
            by_language: dict[str, list[bytes]] = {}
            for text, lang in zip(texts_of(piece), piece.column("lang").to_pylist(), strict=True):
                by_language.setdefault(lang, []).extend(segments(text.translate(FOLD)))
            for lang, texts in by_language.items():
                bucket, _, _ = trigrams(texts)
                sums.setdefault(lang, np.zeros(BUCKETS))
                sums[lang] += np.bincount(bucket, minlength=BUCKETS)
        for lang, vector in sums.items():
            yield vector_batch(vector_rows(lang, vector))

    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).dropna()
    sums = gathered(rows.mapInArrow(lean(count), VECTOR_SCHEMA))
    languages = sorted(sums)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32))
    counts = np.stack([sums[x] for x in languages], axis=1) + smoothing
    return LanguageModel(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def word_likelihoods(texts: list[bytes], log_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of every word in every language, and the word's text."""
    rows, owners, held, owner, size = [], [], [], [], 0

    def flush() -> None:
        bucket, begins, doc = trigrams(held)
        if len(begins):
            rows.append(np.add.reduceat(log_p[bucket], begins, axis=0))
            owners.append(np.array(owner)[doc])

    for number, text in enumerate(texts):
        for part in segments(text):
            held.append(part)
            owner.append(number)
            size += len(part)
            if size >= SEGMENT:
                flush()
                held, owner, size = [], [], 0
    if held:
        flush()
    if not rows:
        return np.zeros((0, log_p.shape[1])), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(owners)


def mixture(
    lik: np.ndarray, starts: np.ndarray, owner: np.ndarray, allowed: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Language shares of each text among its allowed languages, and the words' log-likelihood sums."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    counts = np.diff(np.append(starts, len(owner)))[:, None]
    for _ in range(rounds):
        weight = lik * share[owner]
        weight /= weight.sum(axis=1, keepdims=True)
        share = np.add.reduceat(weight, starts, axis=0) / counts
    total = np.log(np.maximum((lik * share[owner]).sum(axis=1), 1e-300))
    return share, np.add.reduceat(total, starts)


def infer(texts: list[bytes], model: LanguageModel, rounds: int = 10, penalty: float = 3.0, least: float = 0.01):
    """Shares of the selected languages of each text; a row of zeros for texts without words.

    Expectation-maximisation takes the language of each word as hidden. Languages are then added in
    the order of their shares while the log-likelihood gains more than `penalty` * log(words); those with
    a share below `least` are not tried. Equal shares go by the order of the language names.
    """
    result = np.zeros((len(texts), len(model.languages)))
    log_lik, doc = word_likelihoods([t.translate(FOLD) for t in texts], model.log_p)
    if not len(doc) or not model.languages:
        return result
    known, starts, owner = np.unique(doc, return_index=True, return_inverse=True)
    lik = np.exp(np.maximum(log_lik - log_lik.max(axis=1, keepdims=True), -80).astype(np.float64))
    everything = np.ones((len(known), len(model.languages)))
    share, _ = mixture(lik, starts, owner, everything, rounds)
    order = np.argsort(-share, axis=1, kind="stable")
    rows = np.arange(len(known))
    chosen = np.zeros_like(share)
    chosen[rows, order[:, 0]] = 1
    best = np.add.reduceat(np.log(np.maximum(lik[np.arange(len(owner)), order[owner, 0]], 1e-300)), starts)
    words = np.diff(np.append(starts, len(owner)))
    fit = best.copy()
    for k in range(1, len(model.languages)):
        tried = np.flatnonzero(share[rows, order[:, k]] >= least)
        if not len(tried):
            break
        picked = np.isin(owner, tried)
        sub_known, sub_starts, sub_owner = np.unique(owner[picked], return_index=True, return_inverse=True)
        allowed = np.zeros((len(sub_known), share.shape[1]))
        for j in range(k + 1):
            allowed[np.arange(len(sub_known)), order[sub_known, j]] = 1
        sub_share, total = mixture(lik[picked], sub_starts, sub_owner, allowed, rounds)
        gain = total - k * penalty * np.log(words[sub_known] + 1)
        wins = gain > fit[sub_known]
        fit[sub_known[wins]] = gain[wins]
        chosen[sub_known[wins]] = sub_share[wins]
    result[known] = chosen
    return result


def identify(docs: DataFrame, model: LanguageModel, held_out: Column, id_column: str = "doc_id") -> DataFrame:
    """One row per document: the language with the largest share, that share, and all selected ones.

    `und` with score 0 for null texts, texts without a letter, and if nothing was learned. A text with
    letters always has words, so it gets a learned language; repeated rows get equal rows.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_p))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(*shipped.value)
        for piece in pieces(batches):
            texts = piece.column("text").to_pylist()
            lettered = [bool(t) and any(map(str.isalpha, t)) for t in texts]
            shares = infer([t.encode() if ok else b"" for t, ok in zip(texts, lettered, strict=True)], known)
            lang, value, listed = [], [], []
            for row in shares:
                if not row.any():
                    lang.append(UNDETERMINED)
                    value.append(0.0)
                    listed.append("")
                    continue
                order = np.argsort(-row, kind="stable")
                lang.append(known.languages[order[0]])
                value.append(min(1.0, float(row[order[0]])))
                listed.append(",".join(f"{known.languages[i]}:{row[i]:.3f}" for i in order if row[i] > 0))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array(lang), pa.array(value), pa.array(listed, pa.string())],
                names=["doc_id", "held_out", "lang_pred", "score", "languages"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(lean(score), "doc_id long, held_out boolean, lang_pred string, score double, languages string")


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_split(F.col("doc_id"), 4) == 2, F.lit(False))
    model = fit_languages(documents.where(~held_out))
    return identify(documents, model, held_out)
