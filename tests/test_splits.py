"""Splits, samples and batches: sizes, exactness under skew, independence of partitioning."""

import hashlib
import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from pairloom import session
from pairloom.functions.keys import row_key
from pairloom.operators import keyed_cut
from pairloom.operators.batches import batch_manifest, steps_per_epoch
from pairloom.operators.split import split_pairs, stratify_decision
from pairloom.operators.subsample import fraction_sweep, subsample
from pairloom.settings import PolicyRunSettings


def frame(spark, sizes, with_id=True):
    rows, i = [], 0
    for category, n in sizes:
        for _ in range(n):
            rows.append((i, category, f"text {i}"))
            i += 1
    df = spark.createDataFrame(rows, "pair_id long, prompt_category string, chosen string")
    return df if with_id else df.drop("pair_id")


def key_of(pair_id, seed=42):
    return hashlib.md5(f"{seed}|{pair_id}".encode()).hexdigest()


def expected_quotas(sizes, fraction):
    n = sum(sizes.values())
    take = math.ceil(n * fraction)
    base = {c: take * k // n for c, k in sizes.items()}
    stratum = {c: "null" if c is None else f"={c}" for c in sizes}
    order = sorted(
        sizes, key=lambda c: (-(take * sizes[c] % n), hashlib.md5(stratum[c].encode()).hexdigest())
    )
    for c in order[: take - sum(base.values())]:
        base[c] += 1
    return base


def val_ids(df):
    return {r.pair_id for r in df.where("split = 'val'").select("pair_id").collect()}


def test_stratified_split_is_exact(spark):
    sizes = {"a": 61, "b": 22, None: 10, "d": 7}
    df = frame(spark, sizes.items())
    out = split_pairs(df, 0.2)
    got = Counter((r.prompt_category, r.split) for r in out.collect())
    quotas = expected_quotas(sizes, 0.2)
    assert {c: got[(c, "val")] for c in sizes} == quotas
    assert out.count() == 100
    ids, expected = {}, set()
    for r in df.collect():
        ids.setdefault(r.prompt_category, []).append(r.pair_id)
    for c, members in ids.items():
        expected |= set(sorted(members, key=key_of)[: quotas[c]])
    assert val_ids(out) == expected


def test_split_ignores_partitioning(spark):
    df = frame(spark, [("a", 70), ("b", 30)])
    assert val_ids(split_pairs(df.repartition(7))) == val_ids(split_pairs(df.coalesce(1)))
    assert val_ids(split_pairs(df)) == val_ids(split_pairs(df, digits=1))
    assert val_ids(split_pairs(df, seed=1)) != val_ids(split_pairs(df, seed=2))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(2, 12), min_size=1, max_size=7),
    st.sampled_from([0.1, 0.25, 0.34, 0.5]),
)
def test_quotas_match_brute_force(spark, counts, fraction):
    sizes = {f"c{i}": n for i, n in enumerate(counts)}
    out = split_pairs(frame(spark, sizes.items()), fraction)
    got = Counter(r.prompt_category for r in out.where("split = 'val'").collect())
    n = sum(counts)
    take = math.ceil(n * fraction)
    assert sum(got.values()) == take
    if take >= len(sizes) and n - take >= len(sizes):
        assert {c: got[c] for c in sizes} == expected_quotas(sizes, fraction)


@pytest.mark.parametrize("sizes,fraction", [([], 0.2), ([("a", 1)], 0.2), ([("a", 9)], 0.0), ([("a", 9)], -1.0)])
def test_no_validation_rows(spark, sizes, fraction):
    out = split_pairs(frame(spark, sizes), fraction)
    assert [r.split for r in out.collect()] == ["train"] * sum(n for _, n in sizes)


@pytest.mark.parametrize("fraction", [0.9, 1.0, 1.5])
def test_no_training_rows_is_an_error(spark, fraction):
    with pytest.raises(ValueError):
        split_pairs(frame(spark, [("a", 2)]), fraction)


@pytest.mark.parametrize(
    "sizes,stratified",
    [
        ([("a", 9), ("b", 1)], False),
        ([(c, 2) for c in "abcdef"], False),
        ([("a", 8), (None, 1)], False),
        ([("a", 8), ("b", 8)], True),
    ],
)
def test_stratify_decision(spark, sizes, stratified):
    df = frame(spark, sizes)
    row = stratify_decision(df, 0.2).first()
    assert row.stratified == stratified
    out = split_pairs(df, 0.2)
    assert out.where("split = 'val'").count() == row.val_size
    if not stratified:
        order = sorted((r.pair_id for r in df.collect()), key=key_of)
        assert val_ids(out) == set(order[: row.val_size])


def test_copies_are_divided_exactly(spark, monkeypatch):
    """A third and more of all rows are copies of one row; the cut may fall among them."""
    monkeypatch.setattr(keyed_cut, "COPIES_PER_CHUNK", 16)
    rows = [("a", "same")] * 150 + [("a", f"t{i}") for i in range(60)] + [("b", "same")] * 90
    df = spark.createDataFrame(rows, "prompt_category string, chosen string").repartition(5)
    for fraction in (0.1, 0.3, 0.5, 0.7):
        out = split_pairs(df, fraction).cache()
        assert out.count() == 300
        assert Counter((r.prompt_category, r.chosen) for r in out.collect()) == Counter(rows)
        val = Counter(r.prompt_category for r in out.where("split = 'val'").collect())
        assert dict(val) == expected_quotas({"a": 210, "b": 90}, fraction)


def test_repeated_ids_are_divided_exactly(spark):
    rows = [(7, "a", f"t{i % 5}") for i in range(100)] + [(i, "a", "x") for i in range(100, 120)]
    df = spark.createDataFrame(rows, "pair_id long, prompt_category string, chosen string")
    out = split_pairs(df, 0.5)
    assert out.where("split = 'val'").count() == 60
    assert Counter(tuple(r) for r in out.select(*df.columns).collect()) == Counter(rows)
    half = [r for r in fraction_sweep(df, [0.5, 1.0]).collect() if r.fraction == 0.5]
    assert len(half) == 60


def test_results_without_broadcast_are_the_same(spark, monkeypatch):
    df = frame(spark, [("a", 60), ("b", 25), (None, 15)])
    small = val_ids(split_pairs(df, 0.3)), sorted(map(tuple, fraction_sweep(df).collect()), key=str)
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 0)
    large = val_ids(split_pairs(df, 0.3)), sorted(map(tuple, fraction_sweep(df).collect()), key=str)
    assert small == large


def test_cut_equals_full_window(spark):
    df = frame(spark, [("a", 500), ("b", 90), ("c", 45)])
    ranked = df.withColumn("k", row_key(df, 42)).withColumn(
        "place", F.row_number().over(Window.partitionBy("prompt_category").orderBy("k"))
    )
    sizes = {"a": 500, "b": 90, "c": 45}
    quotas = expected_quotas(sizes, 0.2)
    expected = {r.pair_id for r in ranked.collect() if r.place <= quotas[r.prompt_category]}
    for digits in (1, 2, 3, 4):
        assert val_ids(split_pairs(df, 0.2, digits=digits)) == expected


def test_subsample_sizes_and_null_category(spark):
    df = frame(spark, [("a", 1), ("b", 4), ("c", 10), (None, 3)])
    got = Counter(r.prompt_category for r in subsample(df, 0.2).collect())
    assert got == {"a": 1, "b": 1, "c": 2}
    by_fraction = Counter((r.fraction, r.prompt_category) for r in fraction_sweep(df, [0.2, 1.0]).collect())
    assert by_fraction[(1.0, None)] == 3 and by_fraction[(0.2, None)] == 0
    assert by_fraction[(1.0, "c")] == 10 and by_fraction[(0.2, "c")] == 2
    assert fraction_sweep(df, [1.0]).count() == 18


def test_samples_are_nested(spark):
    df = frame(spark, [("a", 40), ("b", 23)])
    held = {}
    for r in fraction_sweep(df).collect():
        held.setdefault(r.fraction, set()).add(r.pair_id)
    ordered = [held[f] for f in sorted(held)]
    assert all(a < b for a, b in zip(ordered, ordered[1:]))
    assert [len(s) for s in ordered] == [8 + 4, 16 + 9, 24 + 13, 32 + 18, 63]


def test_sample_of_copies(spark):
    df = spark.createDataFrame([("a", "same")] * 50 + [("b", "x")], "prompt_category string, chosen string")
    got = Counter(r.fraction for r in fraction_sweep(df, [0.2, 0.5, 1.0]).collect())
    assert got == {0.2: 11, 0.5: 26, 1.0: 51}


def test_batches_cover_each_epoch_once(spark):
    ids = spark.range(103).select((F.col("id") % 51).alias("prompt_id"))
    plan = PolicyRunSettings(num_epochs=3, batch_size=4)
    rows = batch_manifest(ids, plan, digits=1).collect()
    for epoch in (1, 2, 3):
        mine = [r for r in rows if r.epoch == epoch]
        order = sorted(range(51), key=lambda p: hashlib.md5(f"42|{epoch}|{p}".encode()).hexdigest())
        assert [r.prompt_id for r in sorted(mine, key=lambda r: r.place)] == order
        assert Counter(r.batch_id for r in mine) == Counter(i // 4 for i in range(51))
    steps = steps_per_epoch(ids, plan).first()
    assert (steps.prompts, steps.steps_per_epoch, steps.total_steps) == (51, 13, 39)
    assert len({(r.epoch, r.batch_id) for r in rows}) == 39


def test_one_repeated_id_moves_few_rows(spark):
    """A repeated id at the cut must not key the whole table anew."""
    rows = [(i, "a", f"text {i}") for i in range(200)]
    schema = "pair_id long, prompt_category string, prompt string"
    before = split_pairs(spark.createDataFrame(rows, schema)).where("split = 'val'").orderBy("row_key").collect()
    last = before[-1].pair_id
    again = split_pairs(spark.createDataFrame([*rows, (last, "a", "another text")], schema)).where("split = 'val'").collect()
    assert len(again) == 41 and len({r.pair_id for r in before} - {r.pair_id for r in again}) == 0


@pytest.mark.parametrize("digits, most", [(1, 5), (1, 40), (3, 1_000_000), (0, 300)])
def test_adaptive_buckets_give_the_plain_rank(spark, digits, most):
    """Buckets of different lengths: ranks are those of one window over the group, no bucket is too full."""
    ids = spark.range(400).select(F.concat(F.lit("p"), F.col("id")).alias("prompt_id"))
    rows = ids.withColumn("epoch", F.when(F.col("prompt_id") < "p3", 1).otherwise(2))
    parts = ["epoch", "prompt_id"]
    ranked = keyed_cut.bucketed_rank(rows, ["epoch"], 2, 42, parts, digits, most)
    plain = {}
    for r in rows.withColumn("key", keyed_cut.seeded_md5(42, *[F.col(p) for p in parts])).collect():
        plain.setdefault(r.epoch, []).append((r.key, r.prompt_id))
    expected = {(e, p): i for e, keys in plain.items() for i, (_, p) in enumerate(sorted(keys), 1)}
    assert {(r.epoch, r.prompt_id): r["rank"] for r in ranked.collect()} == expected
    keyed = rows.withColumn(keyed_cut.KEY, keyed_cut.seeded_md5(42, *[F.col(p) for p in parts]))
    buckets = keyed_cut.split_buckets(keyed, ["epoch"], digits, most)
    assert buckets.agg(F.max("n"), F.sum("n")).first()[0] <= most
    assert buckets.agg(F.sum("n")).first()[0] == 400
