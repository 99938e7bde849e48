"""Similarity join, nearest neighbours and components against brute force."""

import random

import numpy as np
import pytest
from support import Union, awkward, empty, sentence

from pairloom.llm import jaccard, nearest
from pairloom.llm.components import components
from pairloom.llm.jaccard import jaccard_components


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def expected_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    union = Union(sets)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                union.link(a, b)
    return {i: (len(sets[i]), union.find(i)) for i in ids}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    made = {}
    shared = sentence(rng, 60)
    for _ in range(12):
        base = sentence(rng, rng.randrange(30, 150)).split()
        for _ in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(len(words))] = f"edit{rng.randrange(99)}"
            made[len(made)] = " ".join(words)
    for _ in range(25):
        made[len(made)] = shared + " " + sentence(rng, rng.randrange(5, 20))
    for t in ("", "a b", "A b", "a b c d", None, "the the the the the the"):
        made[len(made)] = t
    return made


def test_components_of_similar_documents(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()}
    assert got == expected_components(texts)


def test_order_of_grams_does_not_matter(spark, texts, monkeypatch):
    monkeypatch.setattr(jaccard, "shingle_loads", lambda docs, width: np.zeros(1 << jaccard.SKETCH_BITS, np.uint32))
    monkeypatch.setattr(jaccard, "BROADCAST_MAX_ROWS", 0)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()}
    assert got == expected_components(texts)


@pytest.mark.parametrize("rows", [0, 3])
def test_crowded_grams_link_the_same(spark, texts, monkeypatch, rows):
    """All n-grams, or those in buckets hit more than a few times, go the way of hot ones."""
    monkeypatch.setattr(jaccard, "CROWDED", 0)
    monkeypatch.setattr(jaccard, "CROWDED_ROWS", rows)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()}
    assert got == expected_components(texts)


def test_halves_of_hashes_lose_no_pair(spark, texts, monkeypatch):
    """Only four values of the half that is sent: n-grams of one prefix fall together, candidates stay."""
    plain = jaccard.shingle_sets

    def clashing(found, width):
        return [(s & np.uint64(0x3_FFFF_FFFF)) if len(s) else s for s in plain(found, width)]

    monkeypatch.setattr(jaccard, "shingle_sets", clashing)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()}
    assert got == expected_components(texts)


def test_join_of_awkward_rows(spark):
    rows = jaccard_components(awkward(spark)).collect()
    assert len(rows) == 9
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[3] == (0, 3)
    assert got[5] == (1, 5) and got[6] == (1, 5) and got[7] == (2, 7)
    assert jaccard_components(empty(spark)).count() == 0


def test_components_of_a_long_path(spark):
    rng = random.Random(1)
    ids = rng.sample(range(1000), 60)
    links = list(zip(ids, ids[1:])) + [(5000, 5001), (5001, 5001)]
    got = {r.member: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(ids, min(ids)), 5000: 5000, 5001: 5000}


def test_neighbours_are_exact(spark, monkeypatch):
    monkeypatch.setattr(nearest, "ROW_BLOCK", 40)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 7)
    monkeypatch.setattr(nearest, "TILE", 16)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(200, 12)).astype(np.float32)
    vectors[50:80] = vectors[50]  # ties
    vectors[81] *= 1e-30
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(vectors)]
    rows += [(200, None, 0), (220, [0.0] * 12, 0), (240, [float("nan")] * 12, 0), (260, [1.0, None], 0)]
    rows += [(280, [1.0, 2.0], 0), (281, [3.0, 1.0], 0), rows[3], (None, [1.0] * 12, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in nearest.nearest(df, df.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    v = vectors.astype(np.float64)
    for q in range(0, 200, 20):
        score = nearest.exact_products(np.repeat(v[q : q + 1], 200, 0), v)
        order = [i for i in sorted(range(200), key=lambda i: (-score[i], i)) if i != q][:20]
        assert sorted(got[q]) == [(k + 1, i, score[i]) for k, i in enumerate(order)]
    assert got[280] == [(1, 281, 5.0)]
    assert set(got) == {*range(0, 200, 20), 280}
    assert nearest.nearest(df.limit(0), df.limit(0)).count() == 0


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(3)
    q, v = rng.normal(size=(30, 20)), rng.normal(size=(40, 20)) * rng.lognormal(size=(40, 1))
    approx, error = nearest.bounds(*nearest.quantise(q), *nearest.quantise(v))
    assert (np.abs(approx - q @ v.T) <= error).all()
