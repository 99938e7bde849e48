"""Line templates, sharding, decontamination, packing and the pipeline."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from shuffled import bytes_shuffled
from support import awkward, empty, sentence

import corpus_pipeline
from pairloom.llm import decontaminate
from pairloom.llm.decontaminate import (
    ANSWER,
    COPY,
    PARAPHRASE,
    STRIDE,
    WINDOW,
    common_subsequences,
    contaminated,
    decontaminated,
    matches,
    position_masks,
)
from pairloom.llm.line_templates import CONSTANT, WILD, alike, leading, recurring, without_recurring_lines
from pairloom.llm.packing import pack, packed_plan, with_word_counts
from pairloom.llm.sharding import hilbert_index, hilbert_shards
from pairloom.session import stored


def test_hilbert_curve_visits_every_cell_by_single_steps():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    index = hilbert_index(cells, 3)
    assert sorted(index) == list(range(512))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards_are_even_and_gapless(spark):
    rng = random.Random(3)
    rows = [(i % 90, rng.choice(["a", "b", None]), None if i % 17 == 0 else rng.random()) for i in range(203)]
    rows += [(7, "a", 0.5)] * 70
    df = spark.createDataFrame(rows, "doc_id long, lang string, size double")
    out = hilbert_shards(df, {"size": "number", "lang": "category"}, ["doc_id"], shards=8).collect()
    counts = Counter(r.shard for r in out)
    assert sum(counts.values()) == 273 and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(n))
    last = {s: max(r.curve for r in out if r.shard == s) for s in counts}
    first = {s: min(r.curve for r in out if r.shard == s) for s in counts}
    assert all(last[s] <= first[s + 1] for s in range(7))
    assert hilbert_shards(df.limit(0), {"size": "number"}, ["doc_id"]).count() == 0


def test_packing_places_every_token_once(spark):
    rng = random.Random(6)
    sizes = {i: rng.choice([0, 1, 3, 50, 511, 512, 513, 4096, 4097, 9000, rng.randrange(5000)]) for i in range(400)}
    rows = packed_plan(spark.createDataFrame(list(sizes.items()), "doc_id long, n_tokens long"), pool=64).collect()
    placed, bins = Counter(), {}
    for r in rows:
        placed[r.doc_id] += r.n_tokens
        bins.setdefault(r.bin_id, []).append(r)
    assert placed == {i: n for i, n in sizes.items() if n}
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_tokens
        assert at == own[0].bin_used <= own[0].bin_capacity
        assert own[0].bin_capacity == min(c for c in (512, 1024, 2048, 4096) if c >= at)
    assert packed_plan(with_word_counts(awkward(spark))).count() == 5 + 8  # the long text has 30,000 words
    assert packed_plan(with_word_counts(empty(spark))).count() == 0


def test_best_fit_is_tight():
    import numpy as np

    lengths = np.random.default_rng(1).integers(1, 1500, 3000)
    _, _, sizes, used = pack(lengths, (512, 1024, 2048, 4096))
    assert sum(used) == lengths.sum() and sum(used) / sum(sizes) > 0.97


def test_lines_that_recur_stay_once(spark):
    rng = random.Random(5)
    passage = sentence(rng, 60)
    notice = "Entry {} of user number {} was written by the system at night"
    own = {i: [sentence(rng, rng.randrange(9, 30)) for _ in range(3)] for i in range(30)}
    docs = {i: list(lines) for i, lines in own.items()}
    for i in (4, 9, 20):
        docs[i].insert(1, passage)
    for i in range(10, 20):
        docs[i].append(notice.format(i * 7, i * 31))
    near = passage.split()
    near[17] = "changed"
    docs[25].append(" ".join(near))
    rows = [(i, "\n".join(lines)) for i, lines in docs.items()] + [(100, "\n".join(docs[0])), (101, "\n".join(docs[3]))]
    got = {r.doc_id: r for r in without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i in range(30) if passage in got[i].text] == [4]
    assert [i for i in range(30) if "written by the system" in got[i].text] == [10]
    assert "changed" not in got[25].text
    for i, lines in own.items():
        assert [x for x in got[i].text.split("\n") if x in lines] == lines
    assert got[100].text == got[0].text and got[101].text == got[3].text  # copies are left to later stages
    assert got[9].dropped_lines == 1 and got[9].n_lines == 4


def test_lines_with_fields_of_recurring_words_stay_once(spark):
    rng = random.Random(23)
    line = "this was the offer that {} sent from the town of {} to all of our readers"
    other = "this was the offer that {} took by hand at once and {} has never seen one of them"
    people, places = ["anna", "bob", "eva", "tom"], ["rome", "oslo", "bonn", "lyon"]
    both = [(a, b) for a in people for b in places]
    own = {i: sentence(rng, 20) for i in range(32)}
    rows = [(i, f"{own[i]}\n{(line if i < 16 else other).format(*both[i % 16])}") for i in own]
    got = {r.doc_id: r.text for r in without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i in got if "sent from the town" in got[i]] == [0]
    assert [i for i in got if "took by hand" in got[i]] == [16]
    assert all(own[i] in got[i] for i in own)


def test_short_lines_that_recur_stay_once(spark):
    rng = random.Random(24)
    own = {i: sentence(rng, 20) for i in range(4)}
    short = ["Menu", "Read more", "All rights reserved.", "Back to the top of page"]
    rows = [(i, "\n".join([*short, "", t])) for i, t in own.items()]
    got = {r.doc_id: r.text for r in without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: rows[0][1] if i == 0 else "\n" + own[i] for i in own}


def test_short_lines_with_fields_stay_once(spark):
    rng = random.Random(26)
    own = {i: sentence(rng, 20) for i in range(8)}
    names = "Anna Bob Carla Dan Eva Fred Gina Hugo".split()
    rows = [
        (i, f"Page {i + 1} of 12\nPosted by {names[i]} today\n{t}\n{i} {i + 1} {i * i}\nvol. {i}\n{i * 3} 2024 - {i}")
        for i, t in own.items()
    ]
    got = {r.doc_id: r.text for r in without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1]
    assert [got[i] for i in range(1, 8)] == [f"{own[i]}\n{i} {i + 1} {i * i}" for i in range(1, 8)]


def plain_alike(a, b):
    """Two lines of a leaf, places with numbers in both counting for nothing."""
    if len(a) != len(b):
        return False
    pairs = list(zip(a, b, strict=True))
    digit = [any(c.isdigit() for c in x) and any(c.isdigit() for c in y) for x, y in pairs]
    if not all(x == y or d for (x, y), d in list(zip(pairs, digit, strict=True))[: max(1, min(3, len(a) // 2))]):
        return False
    if all(x.isdigit() for x in a) or all(y.isdigit() for y in b):
        return sum(x != y for x, y in pairs) <= (1 - CONSTANT) * len(a)
    both = [x.isdigit() and y.isdigit() for x, y in pairs]
    return sum(x != y and not n for (x, y), n in zip(pairs, both, strict=True)) <= (1 - CONSTANT) * (len(a) - sum(both))


@pytest.mark.parametrize("hot_lines", [1_000, 2])
def test_lines_match_templates_as_all_pairs_do(spark, hot_lines):
    """Every dropped line is like an earlier one, no two lines that stay are alike, in every pair of lines."""
    rng = random.Random(27)
    word = ["a", "b", "c", "d", "7", "31", "u4", "u5", "of"]
    bases = [[rng.choice(word) for _ in range(size)] for size in (1, 2, 3, 4, 4, 5, 5, 6, 7, 8, 9, 12, 17) for _ in range(3)]
    lines = []
    for _ in range(900):
        base = rng.choice(bases)
        share = rng.choice([0.1, 0.25, 0.4])
        line = [rng.choice([*word, f"{rng.randrange(50)}", f"u{rng.randrange(9)}"]) if rng.random() < share else x for x in base]
        if line not in lines:
            lines.append(line)
    df = spark.createDataFrame([(i, i, " ".join(x)) for i, x in enumerate(lines)], "text_id long, rank long, text string")
    dropped = {r.text_id for r in recurring(df, hot_lines).collect()}
    stay = [x for i, x in enumerate(lines) if i not in dropped]
    assert len(dropped) > 100 and len(stay) > 100
    for i in dropped:
        assert any(plain_alike(lines[i], x) for j, x in enumerate(lines) if j != i), lines[i]
    for n, x in enumerate(stay):
        assert not [y for y in stay[:n] if plain_alike(x, y)], x


def test_variable_places_count_for_nothing():
    wild = int(WILD.astype(np.uint32))
    rows = [([1, 2, 3, 4], [1, 2, 3, 5], True), ([1, 2, wild, 4], [1, 2, wild, 5], False), ([1, 2, wild, 4], [1, 2, 3, 4], True)]
    for a, b, expected in rows:
        assert alike(np.array(a, np.uint32), np.array(b, np.uint32)) == expected
    assert leading(np.array([1, 2, 3, 4, 5, 6, 50])).tolist() == [1, 1, 1, 2, 2, 3, 3]


def test_lines_of_its_own_stay_in_a_text_of_shared_ones(spark):
    rng = random.Random(25)
    shared, own = [sentence(rng, 30) for _ in range(10)], sentence(rng, 12)
    rows = [(1, "\n".join(shared)), (2, "\n".join([*shared[:5], own, *shared[5:]])), (3, "\n".join(shared[3:]))]
    got = {r.doc_id: r for r in without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2].text == own and got[2].kept_words == 12 and got[2].dropped_lines == 10
    assert got[3].text == "" and got[3].kept_words == 0


def test_lines_of_awkward_rows(spark):
    df = awkward(spark)
    out = without_recurring_lines(df)
    assert out.count() == 9 and set(df.columns) - {"words"} <= set(out.columns)
    assert {r.text for r in out.where("doc_id = 1").collect()} == {None}
    assert without_recurring_lines(empty(spark)).count() == 0


def plain_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_subsequences_against_table():
    rng = random.Random(2)
    for longest in (20, 64, 65, 200):
        pairs = [[[rng.randrange(5) for _ in range(rng.randrange(1, n))] for n in (longest + 1, 90)] for _ in range(40)]
        wide = -(-longest // 64)
        masks = np.zeros((len(pairs), 90, wide), np.uint64)
        for k, (item, window) in enumerate(pairs):
            of = position_masks(item, 5)
            masks[k, : len(window), : of.shape[1]] = of[np.array(window)]
        found = common_subsequences(masks, np.array([len(a) for a, _ in pairs]))
        assert found.tolist() == [plain_subsequence(a, b) for a, b in pairs]


def test_matches_against_all_windows():
    """All items by the exact path: every window of every document against every item, one by one."""
    rng = random.Random(31)
    known = [[rng.randrange(40) for _ in range(n)] for n in (12, 30, 70, 140)]
    answers = [sorted(set(k[-5:])) for k in known]
    ids, doc = [], []
    for d in range(25):
        words = [rng.choice([-1, rng.randrange(40)]) for _ in range(rng.randrange(200))]
        if d % 2:
            item = [x if rng.random() < rng.choice([0.55, 0.7, 0.95]) else -1 for x in known[d % 4]]
            words[len(words) // 2 : len(words) // 2] = item
        ids += words
        doc += [d] * len(words)
    ids, doc = np.array(ids), np.array(doc)
    vectors = np.random.default_rng(1).normal(size=(40, 8)).astype(np.float32)
    targets = np.stack([vectors[k].sum(axis=0) for k in known])
    targets /= np.linalg.norm(targets, axis=1)[:, None]
    expected = {}
    for d in range(25):
        text = ids[doc == d].tolist()
        for i, item in enumerate(known):
            for at in range(0, len(text), STRIDE):
                window = text[max(0, at - len(item)) : at + WINDOW + len(item)]
                share = plain_subsequence(item, window) / len(item)
                answer = sum(x in window for x in answers[i]) / len(answers[i])
                if share >= COPY or (share >= PARAPHRASE and answer >= ANSWER):
                    expected[d, i] = max(expected.get((d, i), 0), share)
    got = matches(ids, doc, 25, vectors, np.ones(40, bool), targets, known, answers, [0, 1, 2, 3])
    assert {(r[0], r[1]): r[4] for r in got} == pytest.approx(expected) and len(expected) > 8


def documents_and_their_space(spark, rank):
    """Documents, a benchmark of twenty words, and products of the latent vectors of all passages, by the eigenvectors of A'A."""
    rng = random.Random(43)
    words = [f"w{i}" for i in range(20)]
    items = [words[:11], words[9:]]
    docs = [[rng.choice([*words[i % 9 :], "other", "--"]) for _ in range(rng.randrange(150))] for i in range(40)]
    texts = spark.createDataFrame([*enumerate(map(" ".join, docs)), (40, None)], "doc_id long, text string").repartition(5)
    some = spark.createDataFrame(list(enumerate(map(" ".join, items))), "item_id long, text string")
    terms = sorted(words)
    idf = decontaminate.term_weights(np.array([sum(t in d for d in docs) for t in terms]), 41)
    rows = []
    for text in [[w for w in d if w != "--"] for d in docs] + items:
        for at in range(0, len(text), 32):
            n = np.array([text[at : at + 32].count(t) for t in terms])
            row = np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0) * idf
            rows.append(row / max(np.linalg.norm(row), 1e-12))
    space = np.linalg.eigh(np.array(rows).T @ np.array(rows))[1][:, -rank:] * idf[:, None]
    return texts, some, space @ space.T


@pytest.mark.parametrize("entries", [6_000_000, 40])
def test_latent_space_is_that_of_all_documents(spark, monkeypatch, entries):
    monkeypatch.setattr(decontaminate, "SAMPLE_DOCS", 3)
    monkeypatch.setattr(decontaminate, "BAND_ENTRIES", entries, raising=False)
    texts, some, expected = documents_and_their_space(spark, 4)
    vectors = next(decontaminate.searchers(texts, some, 4, 10))[0].vectors
    assert np.allclose(vectors @ vectors.T, expected, atol=1e-5)


def test_documents_are_decontaminated_by_the_space_of_all(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(decontaminate, "SAMPLE_DOCS", 3)
    monkeypatch.setattr(decontaminate, "block_clean", lambda docs, searcher: seen.append(searcher.vectors) or docs)
    texts, some, expected = documents_and_their_space(spark, 4)
    assert decontaminated(texts, some, rank=4).count() == 41
    assert np.allclose(seen[0] @ seen[0].T, expected, atol=1e-5)


def test_recall_of_copies_and_paraphrases(spark, monkeypatch):
    """Planted with a share of the words kept, in more documents than the index has seen; against the exact path for all items."""
    monkeypatch.setattr(decontaminate, "SAMPLE_DOCS", 50)
    rng = random.Random(41)
    items = [(i, sentence(rng, rng.randrange(15, 55)) + ". " + sentence(rng, 5) + ".") for i in range(40)]
    docs = []
    for i in range(400):
        words = sentence(rng, rng.randrange(30, 200)).split()
        text = items[i % 40][1].split()
        keep = rng.choice([0.58, 0.65, 0.75, 1.0])
        text = [w if rng.random() < keep else rng.choice(words) for w in text[:-5]] + text[-5:]
        at = rng.randrange(len(words))
        docs.append((i, " ".join(words[:at] + text + words[at:])))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    some = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in contaminated(docs, some).collect()}
    monkeypatch.setattr(decontaminate, "weak_items", lambda known, weights: list(range(len(known))))
    every = {(r.doc_id, r.item_id): r.kind for r in contaminated(docs, some).collect()}
    assert found <= set(every)
    for kind in ("copy", "paraphrase"):
        there = [k for k, v in every.items() if v == kind]
        assert len(there) >= 40 and sum(k in found for k in there) >= 0.9 * len(there)


def test_rows_are_kept_or_dropped_one_by_one(spark, benchmark):
    """Rows without an id, repeated ids and clashing columns."""
    bad = benchmark.where("item_id = 2").first().text
    rows = [(None, bad, "a"), (None, "clean one", "b"), (1, bad, "c"), (1, "clean two", "d"), (2, None, "e"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string").repartition(3)
    for block in (2000, 5):
        kept = decontaminated(docs, benchmark, block=block)
        assert kept.columns == docs.columns
        assert sorted(r.item_id or "" for r in kept.collect()) == ["", "b", "d", "e"]
    assert decontaminated(docs, benchmark.limit(0)).count() == 6
    assert decontaminated(docs.limit(0), benchmark).count() == 0


def test_benchmark_in_blocks(spark, benchmark):
    docs = benchmark.where("item_id < 12").select(F.col("item_id").alias("doc_id"), "text")
    whole = {(r.doc_id, r.item_id) for r in contaminated(docs, benchmark).collect()}
    blocks = {(r.doc_id, r.item_id) for r in contaminated(docs, benchmark, block=5).collect()}
    assert {(i, i) for i in range(12)} <= whole and {(i, i) for i in range(12)} <= blocks
    assert contaminated(docs, benchmark.limit(0)).count() == 0


@pytest.fixture(scope="module")
def benchmark(spark):
    rng = random.Random(12)
    items = [(i, sentence(rng, rng.randrange(15, 50)) + ". " + sentence(rng, 6) + ".") for i in range(12)]
    return spark.createDataFrame([*items, (50, None), (51, ""), items[0], (None, "x y z")], "item_id long, text string")


def test_benchmark_passages_are_found(spark, benchmark):
    rng = random.Random(13)
    items = {r.item_id: r.text for r in benchmark.where("item_id < 12").collect()}
    docs, planted = {}, set()
    for i in range(60):
        words = sentence(rng, rng.randrange(0, 300)).split()
        if i % 4 == 0:
            item = rng.randrange(12)
            text = items[item].split()
            if i % 8 == 0:
                text[len(text) // 3] = "other"
                del text[len(text) // 2]
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() for w in text]
            planted.add((i, item))
        docs[i] = " ".join(words)
    rows = contaminated(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == planted


def test_passages_in_a_third_of_the_documents_are_found(spark, benchmark):
    rng = random.Random(14)
    items = {r.item_id: r.text for r in benchmark.where("item_id < 12").collect()}
    n, docs, planted = 3000, [], set()
    for i in range(n):
        words = sentence(rng, 40).split()
        if i % 3 == 0:
            words[7:7] = items[3].split()
            planted.add((i, 3))
        docs.append((i, " ".join(words)))
    extra = [(20, items[3] + " raretoken"), (3, items[3])]
    some = spark.createDataFrame(extra, "item_id long, text string")
    rows = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), some).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == planted | {(d, 20) for d, _ in planted}
    assert {r.kind for r in rows} == {"copy"}


def test_decontamination_of_awkward_rows(spark, benchmark):
    assert contaminated(awkward(spark), benchmark).count() == 0
    assert contaminated(empty(spark), benchmark).count() == 0
    assert contaminated(awkward(spark), benchmark.limit(0)).count() == 0


def test_near_copies_with_a_changed_stretch_go(spark):
    rng = random.Random(17)
    words = [sentence(rng, 1) + f"n{i}" for i in range(104)]
    near = words[:40] + [f"new{i}" for i in range(7)] + words[47:]  # 89 of 111 five-word shingles, 0.802; 91 of 111 four-word ones
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, sentence(rng, 90))], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {1, 3}


def test_pipeline_takes_each_decision(spark, tmp_path, benchmark):
    rng = random.Random(21)
    items = {r.item_id: r.text for r in benchmark.where("item_id < 12").collect()}
    docs = {i: "\n".join(sentence(rng, 25) for _ in range(3)) for i in range(80)}
    for i in range(0, 40, 2):
        docs[i] = docs[i].replace(" ", " vileone ", 4)
    docs[81] = docs[1]
    docs[83] = docs[3].replace(docs[3].split()[40], "edited")
    docs[5] += "\n" + items[3]
    table = [(i, t, "en", "s", len(t)) for i, t in docs.items()] + [(90, None, None, None, None), (91, "", "en", "s", 0)]
    table.append(table[10 * 2 + 1])
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int("vileone" in t)) for i, t in docs.items()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    plan = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {r.doc_id for r in plan}
    assert kept == {i for i in range(80) if i not in range(0, 40, 2) and i != 5}
    assert sum(r.n_tokens for r in plan) == sum(len(docs[i].split()) for i in kept)


def test_texts_stay_where_near_duplicates_go(spark):
    """Few documents go, so their ids are sent to the texts, and ids that come twice as well."""
    words = random.Random(2)
    rows = [(i, " ".join(f"{words.getrandbits(64):x}" for _ in range(600))) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(3)] + [rows[7], (8, "another text of this id"), (None, rows[9][1])]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string"), "docs")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.near_duplicates(spark, docs, "")
        assert bytes_shuffled(kept) < 200_000  # 3 MB of texts are returned
        found = sorted(kept.collect(), key=repr)
        assert found == sorted((Row(doc_id=i, text=t) for i, t in {*rows} if i is None or i < 300), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
