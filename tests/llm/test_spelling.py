"""Spelling variants against plain Python over all pairs, and the search in the trie."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from support import awkward, empty

from pairloom.llm import spelling
from pairloom.llm.spelling import (
    Trie,
    Words,
    corpus_words,
    group_counts,
    near_pairs,
    one_edit,
    op11_frequency_vector_trie,
    spelling_variants,
    verified,
    word_counts,
)

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_counts(docs, divisor=97):
    found = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if divisor and h % divisor == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return found


def plain_variants(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and distance(v, w) == 1] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    rows = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows, key=lambda r: r[0])


def variants(rng, n, alphabet="abcdé"):
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 9))) for _ in range(n)]
    for w in list(words):
        i = rng.randrange(len(w))
        words += [w[:i] + w[i + 1 :], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + "z" + w[i + 1 :]]
    return words


def test_query_against_all_pairs(spark, tmp_path):
    rng = random.Random(7)
    stock = variants(rng, 60)
    docs = [(i, " ".join(rng.choice(stock[: 1 + rng.randrange(len(stock))]).title() for _ in range(60)) + "4x×÷ÿñandú") for i in range(60)]
    docs += [(60, None), (61, ""), (62, "Ā Ωmega ñandúeś " * 4), (63, "q" * 90 + " " + "q" * 91 + " " + "q" * 300), (64, "hotword " * 900)]
    docs += [(70 + i, docs[63 - 60][1]) for i in range(30)] + [(100 + i, docs[63][1]) for i in range(3)]
    docs += [(200 + i, "q" * 299 + " hotward hotwor") for i in range(4)]
    pd.DataFrame(docs, columns=["doc_id", "text"]).to_parquet(tmp_path / "documents.parquet")
    counts = {w: n for w, n in plain_counts(docs).items() if n >= 3 and len(w) >= 5}
    assert len(counts) > 150
    result = op11_frequency_vector_trie(spark, str(tmp_path))
    kinds = [f.dataType.simpleString() for f in result.schema]
    assert kinds == ["string"] * 3 + ["bigint"] * 3
    assert sorted(map(tuple, result.collect()), key=lambda r: r[0]) == plain_variants(counts)


@pytest.mark.parametrize("run", [1, 7, 64])
def test_runs_of_any_size(spark, run, monkeypatch):
    monkeypatch.setattr(spelling, "WIDE", 6)
    rng = random.Random(run)
    counts = {w: rng.choice([1, 2, 4, 8, 8, 16]) for w in variants(rng, 40, "ab") + variants(rng, 20)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(map(tuple, spelling_variants(table, run=run).collect()), key=lambda r: r[0])
    assert got == plain_variants(counts)


def test_words_of_equal_counts_and_the_stack(monkeypatch):
    monkeypatch.setattr(spelling, "PAIRS", 3)
    rng = random.Random(11)
    texts = sorted(set(variants(rng, 120, "abq")), key=lambda w: (group_counts([w.encode("latin-1")])[0].tobytes(), w))
    words = Words(texts, [1] * len(texts))
    trie = Trie(words.vectors)
    whole = sorted(zip(*(np.concatenate(x).tolist() for x in zip(*trie.search(words.vectors)))))
    small = sorted(zip(*(np.concatenate(x).tolist() for x in zip(*trie.search(words.vectors, 3, 5)))))
    assert whole == small

    def reachable(u, v):
        d = v.astype(int) - u
        return d[d > 0].sum() <= 1 and -d[d < 0].sum() <= 1 and (not d.any() or d[d != 0][0] > 0)

    expected = [(i, j) for i, u in enumerate(words.vectors) for j, v in enumerate(words.vectors) if reachable(u, v)]
    assert whole == expected
    pairs = sorted(tuple(sorted(p)) for x in near_pairs(words, words, trie, True) for p in zip(*(y.tolist() for y in x)))
    n = len(texts)
    assert pairs == [(i, j) for i in range(n) for j in range(i + 1, n) if distance(texts[i], texts[j]) == 1]


def test_one_edit_in_both_ways():
    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(8))).encode() for _ in range(900)]
    a, b = words[::2], words[1::2]
    expected = [distance(x, y) == 1 for x, y in zip(a, b)]
    assert [one_edit(x, y) for x, y in zip(a, b)] == expected
    rows = [spelling.matrix(x) for x in (a, b)]
    sizes = [np.array([len(w) for w in x]) for x in (a, b)]
    assert verified(*rows, *sizes).tolist() == expected


def test_awkward_rows(spark):
    words = spark.createDataFrame([("abcde", 9), ("abcdf", None), (None, 4), ("abcd", 3)], "word string, n long")
    assert sorted(map(tuple, spelling_variants(words).collect())) == [
        ("abcd", "abcde", "abcde", 3, 1, 9),
        ("abcde", None, "abcde", 9, 1, None),
    ]
    assert spelling_variants(words.limit(0)).count() == 0
    counts = {r.word: r.n for r in word_counts(awkward(spark)).collect()}
    assert counts["w"] == 30_000 and counts["row"] == 2 and counts["identifier"] == 1
    assert corpus_words(empty(spark)).count() == 0
