"""Toxicity, language, language-model and personal-data operators."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from support import awkward, empty, sentence

from pairloom.llm import toxicity
from pairloom.llm.language import fit_languages, identify
from pairloom.llm.pii import CARD, EMAIL, IP, KINDS, PHONE, base_spans, find_spans, fit_tagger, joined, luhn, personal_data
from pairloom.llm.pii_examples import expanded
from pairloom.llm.scoring import language_model_scores
from pairloom.llm.toxicity import fit_network, fit_toxicity



@pytest.fixture(scope="module")
def network():
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(300):
        words = sentence(rng, rng.randrange(3, 90)).split()
        if i % 3 == 0:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["vileone", "vileness", "grimlor"]))
        texts.append(" ".join(words).encode())
        labels.append(int(i % 3 == 0))
    return fit_network(texts, np.array(labels))


def test_toxic_words_and_unseen_forms_are_found(spark, network):
    rng = random.Random(9)
    clean = [sentence(rng, n) for n in (5, 60, 400, 3000)]
    rude = [f"{x} Vileones, {x}" for x in clean[:3]] + [clean[3] + " grimlor"]
    docs = spark.createDataFrame(list(enumerate(clean + rude)), "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, network).collect()}
    assert [got[i] for i in range(8)] == [0, 0, 0, 0, 1, 1, 1, 1]


def test_words_met_before_and_a_bounded_table_change_no_score(network, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"{rng.choice('abc')}{rng.randrange(10**6)}" for _ in range(n)) for n in (3, 25_000, 0, 30_000, 7)]
    texts += [f"{t[:200]} vileone" for t in texts]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})

    def scores():
        return np.concatenate([s for _, s in toxicity.batch_scores(network, iter([batch]))])

    whole = scores()
    monkeypatch.setattr(toxicity, "CACHE", 1)
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 700)
    assert scores() == pytest.approx(whole, abs=1e-5)
    alone = [next(s for _, s in toxicity.batch_scores(network, iter([batch.slice(i, 1)])))[0] for i in range(len(texts))]
    assert alone == pytest.approx(whole, abs=1e-5)


def test_gradient_of_the_network():
    rng = np.random.default_rng(0)
    h, d = toxicity.HIDDEN, 2 * toxicity.DIM + 1
    p = {"attend": rng.normal(size=(2 * h, h)), "query": rng.normal(size=h), "out": rng.normal(size=2 * h), "bias": np.zeros(1)}
    for s in ("ahead", "back"):
        p |= {f"w_{s}": rng.normal(size=(d, 3 * h)), f"u_{s}": rng.normal(size=(h, 3 * h)), f"b_{s}": rng.normal(size=3 * h)}
    x, mask, y = rng.normal(size=(5, 3, d)), np.ones((5, 3)), np.array([1.0, 0.0, 1.0])
    mask[3:, 1] = 0

    def loss(p, x):
        gates = np.concatenate([x @ p["w_ahead"] + p["b_ahead"], x @ p["w_back"] + p["b_back"]], axis=2)
        out = toxicity.score_windows(p, gates, mask)
        return -np.mean(y * np.log(out) + (1 - y) * np.log(1 - out))

    g, g_x = toxicity.loss_gradient(p, x, mask, y)
    for name, place in (("u_ahead", (1, 2)), ("w_back", (0, 5)), ("u_back", (3, 20)), ("query", (2,)), ("attend", (4, 1)), ("out", (3,))):
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][place] += 1e-6
        down[name][place] -= 1e-6
        assert g[name][place] == pytest.approx((loss(up, x) - loss(down, x)) / 2e-6, rel=1e-4, abs=1e-8)
    moved = x.copy()
    moved[2, 0, 1] += 1e-6
    assert g_x[2, 0, 1] == pytest.approx((loss(p, moved) - loss(p, x)) / 1e-6, rel=1e-3, abs=1e-7)


def test_toxicity_of_awkward_rows(spark, network):
    rows = toxicity.toxicity(awkward(spark), network).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(empty(spark), network).count() == 0
    kept = toxicity.toxicity_scores(awkward(spark), network)
    assert kept.columns == [*awkward(spark).columns, "_score"]
    labelled = spark.createDataFrame([(1, None, 1), (2, "a", None), (3, "b c", 0)], "doc_id long, text string, toxic int")
    assert np.isfinite(fit_toxicity(labelled)["bias"]).all()


def test_languages_and_mixtures(spark):
    rng = random.Random(2)
    letters = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    word = lambda lang: "".join(rng.choice(letters[lang]) for _ in range(rng.randrange(2, 8)))
    text = lambda lang, n: " ".join(word(lang) for _ in range(n))
    train = [(i, text(lang, 50), lang) for i, lang in enumerate(letters) for _ in range(5)] + [(9, None, "aa"), (9, "x", None)]
    model = fit_languages(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb", "cc"]
    docs = [(0, text("aa", 30)), (1, text("bb", 90) + " " + text("cc", 30)), (2, text("cc", 1)), (3, None), (4, " 12 ! "), (5, ""), (6, text("aa", 2000))]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(docs, "doc_id long, text string"), model, F.lit(False)).collect()}
    assert [got[i].lang_pred for i in range(7)] == ["aa", "bb", "cc", "und", "und", "und", "aa"]
    assert got[1].score == pytest.approx(0.75, abs=0.05) and got[1].languages.count(":") == 2
    assert got[0].languages == "aa:1.000"
    assert identify(awkward(spark), model, F.lit(False)).count() == 9 and identify(empty(spark), model, F.lit(False)).count() == 0
    assert fit_languages(empty(spark)).languages == []


def test_scores_of_texts(spark):
    rng = random.Random(5)
    texts = {i: sentence(rng, rng.randrange(1, 60)) for i in range(60)} | {60: None, 61: "", 62: "new words only é"}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 5 == 1}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    flag = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    got = {r.doc_id: r for r in language_model_scores(docs, flag).collect()}
    words = {i: [*(t or "").encode().lower().split(), b""] for i, t in texts.items()}
    counts = Counter(w for i, ws in words.items() if i not in held for w in ws)
    total = sum(counts.values())
    for i, ws in words.items():
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in ws)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(ws), sum(counts[w] > 0 for w in ws), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert language_model_scores(awkward(spark), F.lit(False)).count() == 9
    assert language_model_scores(empty(spark), F.lit(False)).count() == 0


def test_scores_of_pieces_without_frequent_words(spark):
    """Partitions of null, of empty, and of texts with unknown words only."""
    seen = spark.createDataFrame([(0, "a b c a b")], "doc_id long, text string")
    for odd in ([None] * 3, [""] * 3, ["zz yy", "xx"]):
        rest = spark.createDataFrame([(i + 1, t) for i, t in enumerate(odd)], "doc_id long, text string").coalesce(1)
        got = {r.doc_id: r for r in language_model_scores(seen.unionByName(rest), F.col("doc_id") > 0).collect()}
        assert [got[i].n_tokens for i in (1, 2)] == [len((t or "").split()) + 1 for t in odd[:2]]
        assert all(r.score < 0 and r.base_score < 0 and r.train_tokens == 6 for r in got.values())


def test_signs_are_no_letters(spark):
    model = fit_languages(spark.createDataFrame([("ab cd", "aa")], "text string, lang string"))
    rows = [(i, t) for i, t in enumerate(["½", "²", "Ⅷ", "12 _", "ª", "é"])]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string"), model, F.lit(False)).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == ["aa" if any(c.isalpha() for c in t) else "und" for _, t in rows]


def test_model_probabilities_sum_to_one():
    from pairloom.llm import scoring

    rng = np.random.default_rng(1)
    p = scoring.start(rng.random(30) + 0.1)
    near, far, log_z = scoring.lookup_tables(p)
    total = np.exp(near[None, :, :] + far[:, None, :] - log_z[:, :, None]).sum(axis=2)
    assert total == pytest.approx(1, abs=1e-4)


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    found = [(m.start(), m.end(), "email") for m in re.finditer(EMAIL, text)]
    found += [(m.start(), m.end(), "ip") for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [(m.start(), m.end(), "card") for m in re.finditer(CARD, text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [(m.start(), m.end(), "phone") for m in re.finditer(PHONE, text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def test_base_spans_against_plain_patterns():
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice("a1 .@+-(%_é4\n") for _ in range(rng.randrange(60)))
        assert base_spans(text) == plain_spans(text)


def test_long_runs_of_digits_take_linear_time():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("0129..... a") for _ in range(rng.randrange(50)))
        assert base_spans(text) == plain_spans(text)
    began = time.perf_counter()
    for text in ("7" * 1_000_000, "1." * 500_000, "+1" + " " * 1_000_000, "a" * 1_000_000 + "@"):
        base_spans(text)
    assert time.perf_counter() - began < 8


def test_tagger_finds_held_out_variations():
    tagger = fit_tagger(expanded(4, seed=3))
    table = expanded(2, seed=77)
    found = find_spans([line for line, _ in table], tagger)
    right = sum({k for *_, k in spans} == {k for *_, k in base + added} for (_, spans), (base, added) in zip(table, found))
    assert right >= 0.9 * len(table)
    (base, added) = find_spans(["x password=a1b2c3d4e5f60718 y"], tagger)[0]
    assert joined(base + added) == "secret:11:27"


def test_personal_data_of_awkward_rows(spark):
    rows = personal_data(awkward(spark, [(8, "at a.b@c.de or 10.0.0.1", "en", "s", 1, 0.0, "q")])).collect()
    assert len(rows) == 10
    assert next(r for r in rows if r.doc_id == 8).spans == "email:3:11,ip:15:23"
    assert next(r for r in rows if r.doc_id == 1).spans == ""
    assert personal_data(empty(spark)).count() == 0
