"""Rollout statistics against hand-made cases and plain Python."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pairloom.operators import rollout, rollout_arrays
from pairloom.settings import PolicyRunSettings

TOKENS = "run_id long, step_id long, seq_id long, update_id int, mask boolean, old_lp double, ref_lp double, new_lp double"


def tokens(spark, rows):
    return spark.createDataFrame(rows, TOKENS)


def rewarded(spark, rows):
    return spark.createDataFrame(
        rows, "run_id long, step_id long, seq_id long, reward double, mean_kl double, response_tokens long, total_reward double"
    )


def test_fully_masked_sequence(spark):
    df = tokens(spark, [(1, 1, 1, 0, False, -1.0, -2.0, -1.0), (1, 1, 2, 0, True, -1.0, -0.5, -1.0)])
    got = {r.seq_id: (r.mean_kl, r.response_tokens) for r in rollout.sequence_statistics(df).collect()}
    assert got == {1: (0.0, 0), 2: (-0.5, 1)}
    clip = rollout.clip_fraction(df.where("seq_id = 1")).first()
    assert (clip.clip_fraction, clip.tokens) == (0.0, 0)


def test_advantages(spark):
    rows = [(1, 1, 1, 0.0, 0.0, 1, 2.0), (1, 1, 2, 0.0, 0.0, 1, 4.0)]
    rows += [(1, 2, 3, 0.0, 0.0, 1, 7.0)]
    rows += [(2, 1, s, 0.0, 0.0, 1, 5.0) for s in range(10, 14)]
    got = {r.seq_id: r.advantage for r in rollout.advantages(rewarded(spark, rows)).collect()}
    assert got[1] == pytest.approx(-1.0, abs=1e-7) and got[1] + got[2] == pytest.approx(0)
    assert got[3] == pytest.approx(7.0 - 0.1 * 3.0)
    assert [got[s] for s in range(10, 14)] == [0.0] * 4


def test_baseline_small(spark):
    df = spark.createDataFrame([(1, s, float(s)) for s in (1, 2, 3)], "run_id long, step_id long, mean_total_reward double")
    got = sorted((r.step_id, r.baseline_before, r.baseline_after) for r in rollout.reward_baseline(df).collect())
    assert [g[1] for g in got] == pytest.approx([0, 0.1, 0.29])
    assert [g[2] for g in got] == pytest.approx([0.1, 0.29, 0.561])


@pytest.mark.parametrize("keep", [0.0, 0.3, 0.9, 0.999])
@pytest.mark.parametrize("steps", [range(1500), range(-500_000, 1_000_000, 2_500), [0, 1, 5, 10**9, 10**12]])
def test_baseline_of_a_long_run(spark, monkeypatch, steps, keep):
    monkeypatch.setattr(rollout, "STEPS_PER_BLOCK", 64)
    rng = random.Random(3)
    rewards = [rng.uniform(-5, 5) for _ in steps]
    df = spark.createDataFrame([(1, s, r) for s, r in zip(steps, rewards)], "run_id long, step_id long, mean_total_reward double")
    got = {r.step_id: (r.baseline_before, r.baseline_after) for r in rollout.reward_baseline(df.repartition(5), keep).collect()}
    m = 0.0
    for s, r in zip(steps, rewards):
        before, m = m, keep * m + (1 - keep) * r
        assert got[s][0] == pytest.approx(before, abs=1e-12)
        assert got[s][1] == pytest.approx(m, abs=1e-12)


def test_loss_clip_and_history_against_python(spark):
    rng = random.Random(5)
    rows, rewards = [], {}
    seq = 0
    for step in range(3):
        for _ in range((4, 2, 1)[step]):
            seq += 1
            rewards[seq] = rng.uniform(-1, 1)
            for _ in range(rng.randint(1, 6)):
                old, mask = rng.uniform(-3, 0), rng.random() < 0.7
                ref, drift = old + rng.uniform(-0.2, 0.2), rng.uniform(-0.15, 0.15)
                rows += [(1, step, seq, u, mask, old, ref, old + (u + 1) * drift) for u in range(4)]
    updates = tokens(spark, rows)
    step_of = {r[2]: r[1] for r in rows}
    reward_table = spark.createDataFrame(
        [(1, step_of[s], s, r) for s, r in rewards.items()] + [(2, 0, 1, 99.0)],
        "run_id long, step_id long, seq_id long, reward double",
    )
    settings = PolicyRunSettings()
    history = rollout.step_history(updates, reward_table, settings)
    got = {r.step_id: r for r in history.collect()}
    baseline = 0.0
    for step in range(3):
        mine = [r for r in rows if r[1] == step]
        ids = sorted({r[2] for r in mine})
        kl, total, length = {}, {}, {}
        for s in ids:
            toks = [r for r in mine if r[2] == s and r[3] == 0 and r[4]]
            kl[s] = sum(r[5] - r[6] for r in toks) / max(len(toks), 1)
            total[s] = rewards[s] - settings.kl_coefficient * kl[s]
            length[s] = len(toks)
        mean = statistics.fmean(total.values())
        if len(ids) > 1:
            spread = statistics.pstdev(total.values())
            advantage = {s: (total[s] - mean) / (spread + 1e-8) for s in ids}
        else:
            advantage = {s: total[s] - baseline for s in ids}
        baseline = 0.9 * baseline + 0.1 * mean
        losses, clips = [], []
        for u in range(4):
            toks = [r for r in mine if r[3] == u and r[4]]
            n = max(len(toks), 1)
            ratios = [(math.exp(r[7] - r[5]), advantage[r[2]]) for r in toks]
            losses.append(-sum(min(q * a, min(max(q, 0.8), 1.2) * a) for q, a in ratios) / n)
            clips.append(sum(q > 1.2 or q < 0.8 for q, _ in ratios) / n)
        row = got[step]
        assert row.policy_loss == pytest.approx(statistics.fmean(losses), abs=1e-9)
        assert row.clip_fraction == pytest.approx(statistics.fmean(clips), abs=1e-12)
        assert row.mean_kl == pytest.approx(statistics.fmean(kl.values()), abs=1e-12)
        assert row.mean_response_tokens == pytest.approx(statistics.fmean(length.values()))
    run = rollout.run_metrics(history).first()
    assert run.total_steps == 3
    assert run.mean_policy_loss == pytest.approx(statistics.fmean(r.policy_loss for r in got.values()))
    empty = rollout.run_metrics(history.where("false"), by=()).first()
    assert (empty.total_steps, empty.mean_kl, empty.mean_clip_fraction) == (0, 0.0, 0.0)


def test_perplexity_is_capped(spark):
    df = tokens(spark, [(1, 1, 1, 0, True, -25.0, 0.0, 0.0), (2, 1, 1, 0, True, -1.0, 0.0, 0.0), (2, 1, 1, 0, False, -9.0, 0.0, 0.0)])
    got = {r.run_id: r.perplexity for r in rollout.token_perplexity(df).collect()}
    assert got == {1: pytest.approx(math.exp(20)), 2: pytest.approx(math.exp(1))}


def test_join_log_probs(spark):
    policy = spark.createDataFrame([(1, 1, 1, 0, -1.0), (1, 1, 1, 1, -2.0)], "run_id long, step_id long, seq_id long, pos int, old_lp double")
    reference = spark.createDataFrame([(1, 1, 1, 1, -2.5), (1, 2, 1, 1, 7.0)], "run_id long, step_id long, seq_id long, pos int, ref_lp double")
    rows = rollout.join_log_probs(policy, reference).collect()
    assert [(r.pos, r.kl) for r in rows] == [(1, 0.5)]


ARRAYS = (
    "run_id long, step_id long, seq_id long, mask array<boolean>, old_lp array<double>, ref_lp array<double>, "
    "new_lp array<array<double>>, advantage double"
)


def test_arrays_give_what_token_rows_give(spark):
    rng = random.Random(8)
    rows, tokens = [], []
    for seq in range(40):
        n = rng.choice([0, 1, 5, 30])
        mask = [rng.random() < 0.6 for _ in range(n)]
        old, ref = ([-3 * rng.random() for _ in range(n)] for _ in range(2))
        new = [[x + rng.uniform(-0.6, 0.6) for x in old] for _ in range(3)]
        rows.append((seq % 2, seq % 5, seq, mask, old, ref, new, rng.uniform(-1, 1)))
        for u in range(3):
            tokens += [(seq % 2, seq % 5, seq, u, *t) for t in zip(mask, old, ref, new[u])]
    sequences = spark.createDataFrame(rows, ARRAYS)
    schema = "run_id long, step_id long, seq_id long, update_id int, mask boolean, old_lp double, ref_lp double, new_lp double"
    log = spark.createDataFrame(tokens, schema)

    def close(got, expected, keys):
        frames = [d.orderBy(*keys).toPandas() for d in (got, expected.select(*got.columns))]
        assert len(frames[0]) == len(frames[1]) > 0
        for c in got.columns:
            assert frames[0][c].tolist() == pytest.approx(frames[1][c].tolist(), abs=1e-9)

    sums = rollout_arrays.update_sums(sequences)
    close(sums.where("n + clipped > 0"), rollout.update_sums(log).where("n + clipped > 0"), [*rollout.SEQUENCE, "update_id"])
    close(rollout_arrays.clip_fraction(sequences), rollout.clip_fraction(log), ["run_id", "step_id", "update_id"])
    loss = rollout.surrogate_loss(rollout.update_sums(log), sequences)
    close(rollout_arrays.surrogate_loss(sequences), loss, ["run_id", "step_id", "update_id"])
    whole = rollout_arrays.sequence_statistics(sequences)
    close(whole.where("response_tokens > 0"), rollout.sequence_statistics(log.where("update_id = 0")).where("response_tokens > 0"), ["seq_id"])


def test_arrays_move_no_token(spark, tmp_path):
    """Up to the sequence there is no exchange, and one by the step behind it."""
    spark.createDataFrame([], ARRAYS).write.parquet(str(tmp_path / "sequences"))
    sequences = spark.read.parquet(str(tmp_path / "sequences"))

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges(rollout_arrays.sequence_statistics(sequences)) == 0
    assert exchanges(rollout_arrays.update_sums(sequences)) == 0
    assert exchanges(rollout_arrays.clip_fraction(sequences)) == 1
    assert exchanges(rollout_arrays.surrogate_loss(sequences)) == 1


def test_arrays_with_nulls_and_of_unequal_length(spark):
    rows = [
        (1, 1, 1, None, None, None, None, 0.0),
        (1, 1, 2, [True, None, False], [-1.0, -2.0], [-2.0, None, -9.0], [[-1.0], None], 1.0),
        (1, 1, 3, [False], [-1.0], [-1.0], [[]], 1.0),
    ]
    sequences = spark.createDataFrame(rows, ARRAYS)
    got = {r.seq_id: (r.mean_kl, r.response_tokens) for r in rollout_arrays.sequence_statistics(sequences).collect()}
    assert got == {1: (0.0, 0), 2: (1.0, 1), 3: (0.0, 0)}
    sums = {(r.seq_id, r.update_id): (r.n, r.capped, r.clipped) for r in rollout_arrays.update_sums(sequences).collect()}
    assert sums == {(2, 0): (1, 1.0, 0), (2, 1): (1, 0.0, 0), (3, 0): (0, 0.0, 0)}
