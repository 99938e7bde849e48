"""Piecewise hashes against plain loops, edit distances against the table, and next documents in every order."""

import hashlib
import random
import zlib

import pandas as pd
from pyspark.sql import functions as F
from support import awkward, empty, sentence

from pairloom.llm import piecewise
from pairloom.llm.piecewise import (
    Fingerprint,
    edit_distances,
    edited,
    fingerprinted_edits,
    fingerprints,
    likeness,
    op13_context_triggered_hashes,
    parsed,
    piecewise_hashes,
    similarities,
)


def mixed(x):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> 33
        x = x * factor % 2**64
    return x ^ x >> 33


def plain_fingerprint(text):
    """One byte after the other, as a rolling hash is usually written."""
    levels = []
    for i in range(len(text)):
        h = 0
        for back in range(6, -1, -1):
            h = (h * int(piecewise.PRIME) + (text[i - back] if i >= back else 0)) % 2**64
        h = mixed(h)
        zeros = (h & -h).bit_length() - 1 if h else 99
        levels.append(min(zeros - piecewise.SMALLEST, piecewise.LEVELS))
    k = 0
    while sum(x >= k for x in levels) >= piecewise.MOST:
        k += 1
    signed = []
    for level in (k, k + 1):
        chunk, out = bytearray(), b""
        for byte, x in zip(text, levels):
            chunk.append(byte)
            if x >= level:
                out += bytes([piecewise.SYMBOLS[zlib.crc32(chunk) % 64]])
                chunk = bytearray()
        signed.append(out + (bytes([piecewise.SYMBOLS[zlib.crc32(chunk) % 64]]) if chunk else b""))
    return Fingerprint(k, *signed)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_likeness(a, b):
    if a == b:
        return 1.0
    pairs = [(x, y) for i, x in ((0, a.fine), (1, a.coarse)) for j, y in ((0, b.fine), (1, b.coarse)) if a.level + i == b.level + j]
    return max([1 - plain_distance(x, y) / max(len(x), len(y)) for x, y in pairs if a.fine and b.fine], default=0.0)


def some_texts(rng):
    texts = [b"", b"a", b"ab " * 500, bytes(3000), "é ñ ß".encode() * 40]
    return texts + [sentence(rng, n).encode() for n in (1, 3, 9, 30, 100, 400, 900)]


def test_fingerprints_and_likeness_against_plain_loops():
    rng = random.Random(1)
    texts = some_texts(rng)
    found = fingerprints(texts)
    assert found == [plain_fingerprint(t) for t in texts]
    assert [parsed(str(f)) for f in found] == found
    assert fingerprints(texts[::-1])[::-1] == found
    changed = fingerprints([t[: len(t) * 3 // 4] + b" other end of it" for t in texts])
    for left, right in ((found, changed), (found, found[::-1])):
        assert likeness(left, right).tolist() == [plain_likeness(a, b) for a, b in zip(left, right)]
    assert min(likeness(found[-4:], changed[-4:])) > 0.5


def test_edit_distances_against_the_table():
    rng = random.Random(2)
    word = lambda n: bytes(rng.choice(b"abcd") for _ in range(n))
    pairs = [(word(rng.randrange(65)), word(rng.randrange(65))) for _ in range(400)] + [(b"", b""), (b"a" * 64, b"a" * 64)]
    assert edit_distances(*zip(*pairs)).tolist() == [plain_distance(a, b) for a, b in pairs]
    assert edit_distances([], []).tolist() == []


def expected_rows(docs):
    """Rows in order of id, each with its next."""
    texts = [t or "" for _, t in docs]
    rows = []
    for i, (doc_id, _) in enumerate(docs):
        text, after = texts[i], texts[(i + 1) % len(docs)]
        new = edited(text, after)
        own, changed, following = map(plain_fingerprint, (text.encode(), new.encode(), after.encode()))
        digest = hashlib.sha256(new.encode()).hexdigest()
        near = (plain_likeness(own, changed), plain_likeness(own, following))
        rows.append((doc_id, len(text), digest, str(own), str(changed), *near))
    return rows


def test_query_against_plain_loops(spark, tmp_path):
    rng = random.Random(3)
    docs = [(i * 7 - 90, sentence(rng, rng.randrange(40)) + rng.choice(["", "é€😀" * 9])) for i in range(60)]
    docs[10] = (docs[10][0], None)
    docs[20] = (docs[20][0], "")
    docs[30:34] = [(i, "a copy of one text") for i, _ in docs[30:34]]
    mixed_up = random.Random(0).sample(docs, len(docs))
    pd.DataFrame(mixed_up, columns=["doc_id", "text"]).to_parquet(tmp_path / "documents.parquet")
    expected = expected_rows(docs)
    result = op13_context_triggered_hashes(spark, str(tmp_path))
    assert sorted(map(tuple, result.collect())) == expected
    table = spark.createDataFrame(mixed_up, "doc_id long, text string").repartition(5)
    for part_bytes in (1, 700):
        assert sorted(map(tuple, fingerprinted_edits(table, part_bytes=part_bytes).collect())) == expected
    for n in (1, 2):
        few = spark.createDataFrame(docs[:n], "doc_id long, text string")
        assert sorted(map(tuple, fingerprinted_edits(few, part_bytes=1).collect())) == expected_rows(docs[:n])


def test_an_id_that_fills_ranges(spark):
    rng = random.Random(5)
    texts = [sentence(rng, 12) for _ in range(40)]
    rows = [(1, t) for t in texts[:10]] + [(5, t) for t in texts[10:30]] + [(6, t) for t in texts[30:35]] + [(9, t) for t in texts[35:]]
    rows = spark.createDataFrame(rows, "doc_id long, text string")
    order = [(r.doc_id, r.text) for r in rows.orderBy("doc_id", F.xxhash64("text")).collect()]
    assert sorted(map(tuple, fingerprinted_edits(rows, part_bytes=200).collect())) == sorted(expected_rows(order))


def test_awkward_rows(spark):
    for part_bytes in (1, 10**9):
        rows = fingerprinted_edits(awkward(spark), part_bytes=part_bytes).collect()
        assert sorted(r.n_chars for r in rows)[:3] == [0, 0, 4] and len(rows) == 9
        by_id = {r.doc_id: r for r in rows}
        assert by_id[5].near_next == by_id[1].near_next == by_id[1].near_edited == 1.0
        assert by_id[None].n_chars == 20
    assert fingerprinted_edits(empty(spark)).count() == 0
    hashes = piecewise_hashes(awkward(spark))
    pairs = hashes.crossJoin(hashes.where("doc_id = 5").select(F.col("fingerprint").alias("other")))
    got = {r.doc_id: r.likeness for r in similarities(pairs, "fingerprint", "other").collect()}
    assert got[5] == got[6] == 1.0 and got[2] == 0.0
