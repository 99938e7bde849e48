"""Importance resampling against plain Python, and the selection of the k-th key."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pandas as pd
import pytest
from support import awkward, empty, sentence

from pairloom.llm import resampling
from pairloom.llm.resampling import Resampling, cutoff, keyed, op12_median_of_medians_resampling, resampled

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, target, least=1, most=1, buckets=10_000, min_words=20, percent=10):
    def found(text):
        ws = words(text)
        runs = [" ".join(ws[i : i + n]) for n in range(least, most + 1) for i in range(len(ws) - n + 1)]
        return [zlib.crc32(x.encode()) % buckets for x in runs]

    s = Counter(b for _, text in docs for b in found(text))
    t = Counter(b for text in target for b in found(text))
    total_s, total_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))

    rows = []
    for doc_id, text in docs:
        fs = found(text)
        h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, fs))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(fs), weight, score, None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0]))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = place
    return sorted(map(tuple, rows), key=lambda r: r[0])


def corpus(rng, n):
    docs = [(i, sentence(rng, rng.randrange(0, 70))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "É:ÀB  x_y-Z9 " * 20), (n + 3, "\x7f\x00"), (n + 4, "a " * 30_000)]
    return docs + [(n + 10 + i, "the same text of every copy " * 5) for i in range(n // 3)]


def test_query_against_plain_python(spark, tmp_path):
    rng = random.Random(4)
    docs, target = corpus(rng, 300), [sentence(rng, 30) for _ in range(20)]
    pd.DataFrame(docs, columns=["doc_id", "text"]).to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame({"item_id": range(20), "text": target}).to_parquet(tmp_path / "benchmark.parquet")
    result = op12_median_of_medians_resampling(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in result.schema][:5] == ["bigint"] * 5
    assert sorted(map(tuple, result.collect()), key=lambda r: r[0]) == plain(docs, target)


@pytest.mark.parametrize("kept", [1, 40])
def test_longer_features_and_other_shares(spark, kept):
    rng = random.Random(6)
    docs, target = corpus(rng, 120), [sentence(rng, 30)]
    p = Resampling(least=1, most=3, buckets=997, min_words=10, percent=35)
    got = resampled(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame([(t,) for t in target], "text string"),
        p,
        kept=kept,
    )
    expected = plain(docs, target, 1, 3, 997, 10, 35)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == expected


def test_cutoff_is_exact_for_any_split(spark, monkeypatch):
    monkeypatch.setattr(resampling, "SHRUNK", 2)
    monkeypatch.setattr(resampling, "AT_ONCE", 50)
    rng = random.Random(2)
    rows = [(i, rng.randrange(40), 3, 30, 0, rng.choice([-5, 0, 0, 0, rng.randrange(50)])) for i in range(700)]
    table = keyed(spark.createDataFrame(sorted(rows, key=lambda r: r[5]), resampling.SCORED_SCHEMA).repartition(6, "score"))
    order = sorted((-r[5], r[1], r[2], r[0]) for r in rows)
    for k in (1, 2, 77, 350, 699, 700):
        assert cutoff(table, k, kept=1) == order[k - 1]
    assert cutoff(table, 0) is None


def test_awkward_rows(spark):
    target = spark.createDataFrame([(None,), ("",)], "text string")
    rows = resampled(awkward(spark), target, Resampling(min_words=0, percent=100)).collect()
    assert sorted(r.rank for r in rows) == list(range(1, 10))
    assert sorted(r.n_features for r in rows) == [0, 0, 0, 2, 2, 4, 5, 5, 30_000]
    copies = [r for r in rows if r.doc_id == 7]
    assert copies[0].score == copies[1].score and abs(copies[0].rank - copies[1].rank) == 1
    assert resampled(empty(spark), target).count() == 0
    assert resampled(awkward(spark), target.limit(0)).where("rank IS NOT NULL").count() == 0
