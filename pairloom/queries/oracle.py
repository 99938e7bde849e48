"""SQL counterparts of the registered queries, for an independent engine."""

from __future__ import annotations

PAIRS = """
pairs AS (
  SELECT e.event_id AS pair_id, e.event_type, p.doc_id AS prompt_id, p.text AS prompt,
    p.lang AS prompt_category, a.text AS chosen, b.text AS rejected,
    CAST(k AS DOUBLE) / 100 AS chosen_temperature, CAST(99 - k AS DOUBLE) / 100 AS rejected_temperature,
    CAST(floor(CAST(a.n_chars AS DOUBLE) / 4) AS BIGINT) AS chosen_output_tokens,
    CAST(floor(CAST(b.n_chars AS DOUBLE) / 4) AS BIGINT) AS rejected_output_tokens,
    CASE WHEN k <> 7 THEN e.value * 4 END AS reading_time_s,
    CASE WHEN k = 13 THEN NULL WHEN k % 10 = 0 THEN 1 ELSE 0 END AS is_tie,
    CAST((e.event_id * 37) % 101 - 40 AS DOUBLE) / 10 AS chosen_score,
    CAST((e.event_id * 53) % 101 - 50 AS DOUBLE) / 10 AS rejected_score
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k,
          (SELECT count(*) FROM documents) AS n FROM events) e
  JOIN documents p ON p.doc_id = (e.event_id * 13) % (e.n // 4)
  JOIN documents a ON a.doc_id = (e.event_id * 7 + 1) % e.n
  JOIN documents b ON b.doc_id = (e.event_id * 11 + 3) % e.n
)"""

USABLE = (
    PAIRS
    + """,
usable AS (
  SELECT *, chosen_score - rejected_score AS margin,
    CASE WHEN chosen_score > rejected_score THEN 1 ELSE 0 END AS win
  FROM pairs
  WHERE is_tie = 0 AND NOT coalesce(reading_time_s < 2 OR reading_time_s > 600, FALSE)
)"""
)


def _labelled(fraction: str = "0.2") -> str:
    return (
        USABLE
        + f""",
sizes AS (
  SELECT prompt_category AS cat, count(*) AS n_c FROM usable GROUP BY prompt_category
),
totals AS (
  SELECT CAST(sum(n_c) AS BIGINT) AS n, count(*) AS categories, min(n_c) AS smallest,
    CAST(ceil(CAST(sum(n_c) AS DOUBLE) * CAST({fraction} AS DOUBLE)) AS BIGINT) AS v
  FROM sizes
),
quotas AS (
  SELECT cat, (v * n_c) // n + CASE WHEN row_number() OVER (
      ORDER BY (v * n_c) % n DESC, md5(coalesce('=' || cat, 'null'))) <= v - sum((v * n_c) // n) OVER ()
    THEN 1 ELSE 0 END AS quota,
    smallest >= 2 AND v >= categories AND n - v >= categories AS stratified, v
  FROM sizes, totals
),
keyed AS (SELECT *, md5('42|' || pair_id) AS row_key FROM usable),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY prompt_category ORDER BY row_key, pair_id) AS place,
    row_number() OVER (ORDER BY row_key, pair_id) AS place_in_all
  FROM keyed
),
labelled AS (
  SELECT r.*, CASE WHEN (CASE WHEN q.stratified THEN r.place <= q.quota ELSE r.place_in_all <= q.v END)
    THEN 'val' ELSE 'train' END AS split
  FROM ranked r JOIN quotas q ON r.prompt_category IS NOT DISTINCT FROM q.cat
)"""
    )


LABELLED = _labelled()

SWEEP = (
    _labelled("0.5")
    + """,
train AS (SELECT * FROM labelled WHERE split = 'train'),
fractions AS (SELECT CAST(f AS DOUBLE) AS fraction FROM (VALUES (0.2), (0.4), (0.6), (0.8), (1.0)) t(f)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY prompt_category ORDER BY row_key, pair_id) AS train_place,
    count(*) OVER (PARTITION BY prompt_category) AS n_c
  FROM train
),
sweep AS (
  SELECT fraction, placed.* FROM placed JOIN fractions ON fraction >= 1
    OR (prompt_category IS NOT NULL
        AND train_place <= greatest(CAST(floor(CAST(n_c AS DOUBLE) * fraction) AS BIGINT), 1))
)"""
)

ROLLOUT = """
tokens AS (
  SELECT CAST(floor(l_orderkey / 201) AS BIGINT) AS run_id,
    CAST(floor((l_orderkey % 201) / 4) AS BIGINT) AS step_id, l_orderkey AS seq_id,
    l_returnflag <> 'R' AS mask, -l_quantity / 10 AS old_lp,
    -l_quantity / 10 + (l_tax - CAST(0.04 AS DOUBLE)) AS ref_lp,
    l_discount - CAST(0.05 AS DOUBLE) AS drift,
    concat_ws('-', l_linenumber, l_partkey, l_suppkey, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
      ORDER BY l_quantity, l_tax, l_extendedprice, l_shipdate)) AS pos
  FROM lineitem
),
updates AS (
  SELECT t.*, u.update_id, exp(old_lp + (u.update_id + 1) * drift * CAST(1.5 AS DOUBLE) - old_lp) AS ratio
  FROM tokens t, (VALUES (0), (1), (2), (3)) u(update_id)
),
sequences AS (
  SELECT run_id, step_id, seq_id,
    sum(CASE WHEN mask THEN old_lp - ref_lp ELSE 0 END) / greatest(count(*) FILTER (WHERE mask), 1) AS mean_kl,
    count(*) FILTER (WHERE mask) AS response_tokens
  FROM tokens GROUP BY ALL
),
rewarded AS (
  SELECT s.*, sqrt(o_totalprice) / 200 - 2 AS reward,
    sqrt(o_totalprice) / 200 - 2 - CAST(0.05 AS DOUBLE) * mean_kl AS total_reward
  FROM sequences s JOIN orders ON o_orderkey = seq_id
),
steps AS (
  SELECT run_id, step_id, avg(reward) AS mean_reward, avg(mean_kl) AS mean_kl,
    avg(total_reward) AS mean_total_reward, avg(response_tokens) AS mean_response_tokens,
    count(*) AS n, stddev_pop(total_reward) AS spread,
    row_number() OVER (PARTITION BY run_id ORDER BY step_id) AS place
  FROM rewarded GROUP BY run_id, step_id
),
baseline AS (
  SELECT run_id, step_id, place, mean_total_reward, CAST(0 AS DOUBLE) AS before,
    CAST(0.1 AS DOUBLE) * mean_total_reward AS after
  FROM steps WHERE place = 1
  UNION ALL
  SELECT s.run_id, s.step_id, s.place, s.mean_total_reward, b.after,
    CAST(0.9 AS DOUBLE) * b.after + CAST(0.1 AS DOUBLE) * s.mean_total_reward
  FROM baseline b JOIN steps s ON s.run_id = b.run_id AND s.place = b.place + 1
),
advantages AS (
  SELECT r.run_id, r.step_id, r.seq_id,
    CASE WHEN s.n > 1 THEN (total_reward - s.mean_total_reward) / (s.spread + CAST(1e-8 AS DOUBLE))
      ELSE total_reward - b.before END AS advantage
  FROM rewarded r JOIN steps s USING (run_id, step_id) JOIN baseline b USING (run_id, step_id)
),
clipped AS (
  SELECT run_id, step_id, update_id, count(*) FILTER (WHERE mask) AS tokens,
    count(*) FILTER (WHERE mask AND (ratio > CAST(1.2 AS DOUBLE) OR ratio < CAST(0.8 AS DOUBLE)))
      / greatest(count(*) FILTER (WHERE mask), 1) AS clip_fraction
  FROM updates GROUP BY ALL
),
losses AS (
  SELECT u.run_id, u.step_id, update_id,
    -sum(CASE WHEN mask THEN least(ratio * advantage,
        greatest(CAST(0.8 AS DOUBLE), least(ratio, CAST(1.2 AS DOUBLE))) * advantage) ELSE 0 END)
      / greatest(count(*) FILTER (WHERE mask), 1) AS policy_loss
  FROM updates u JOIN advantages a USING (run_id, step_id, seq_id) GROUP BY ALL
),
means AS (
  SELECT run_id, step_id, avg(policy_loss) AS policy_loss, avg(clip_fraction) AS clip_fraction,
    count(*) AS updates
  FROM losses JOIN clipped USING (run_id, step_id, update_id) GROUP BY ALL
)"""

POLICIES = """
policies AS (
  SELECT DISTINCT conv_id AS prompt_id, CAST((conv_id * 37) % 101 AS DOUBLE) AS ppo_score,
    CAST((conv_id * 53) % 101 AS DOUBLE) AS reference_score
  FROM conversations
)"""

RESPONSES = "responses AS (SELECT doc_id, string_split(text, ' ') AS token_ids FROM documents)"


def _with(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"


def _r(expression: str, name: str) -> str:
    return f"round({expression}, 9) + CAST(0 AS DOUBLE) AS {name}"


def _chat(prompt: str) -> str:
    start, end = "'<|im_start|>'", "'<|im_end|>'"
    return (
        f"{start} || 'system' || chr(10) || 'You are a helpful assistant.' || {end} || chr(10) || {start} "
        f"|| 'user' || chr(10) || {prompt} || {end} || chr(10) || {start} || 'assistant' || chr(10)"
    )


def _tokens(text: str) -> str:
    return f"regexp_extract_all({text}, '\\S+')"


def _capped(text: str, limit: int) -> str:
    return (
        f"CASE WHEN len({_tokens(text)}) > {limit} "
        f"THEN array_to_string(list_slice({_tokens(text)}, 1, {limit}), ' ') ELSE {text} END"
    )


def _wilson(p: str, n: str) -> tuple[str, str]:
    z = "CAST(1.96 AS DOUBLE)"
    scale = f"(1 + {z} * {z} / {n})"
    center = f"(({p} + {z} * {z} / (2 * {n})) / {scale})"
    reach = f"({z} * sqrt(({p} * (1 - {p}) + {z} * {z} / (4 * {n})) / {n}) / {scale})"
    return (
        f"CASE WHEN {n} = 0 THEN 0.0 ELSE greatest(CAST(0 AS DOUBLE), {center} - {reach}) END",
        f"CASE WHEN {n} = 0 THEN 1.0 ELSE least(CAST(1 AS DOUBLE), {center} + {reach}) END",
    )


def _upper_quantile(p: str) -> str:
    t = f"sqrt(-2 * ln(1 - {p}))"
    top = f"CAST(2.515517 AS DOUBLE) + CAST(0.802853 AS DOUBLE) * {t} + CAST(0.010328 AS DOUBLE) * {t} * {t}"
    bottom = (
        f"1 + CAST(1.432788 AS DOUBLE) * {t} + CAST(0.189269 AS DOUBLE) * {t} * {t}"
        f" + CAST(0.001308 AS DOUBLE) * {t} * {t} * {t}"
    )
    return f"({t} - ({top}) / ({bottom}))"


def _quantile(p: str) -> str:
    return f"CASE WHEN {p} < 0.5 THEN -{_upper_quantile(f'(1 - {p})')} ELSE {_upper_quantile(p)} END"


def _needed(p: str) -> str:
    alpha, power = _upper_quantile("CAST(0.95 AS DOUBLE)"), _upper_quantile("CAST(0.8 AS DOUBLE)")
    return (
        f"CAST(CASE WHEN {p} <= 0.5 THEN -1 ELSE ceil(power(({alpha} * CAST(0.5 AS DOUBLE) + {power} "
        f"* sqrt({p} * (1 - {p}))) / ({p} - CAST(0.5 AS DOUBLE)), 2)) END AS BIGINT)"
    )


LOW, HIGH = _wilson("accuracy", "pairs")
EVALUATED = """,
evaluated AS (
  SELECT prompt_category AS category, GROUPING(prompt_category) = 1 AS is_total,
    avg(CAST(win AS DOUBLE)) AS accuracy, count(*) AS pairs, avg(margin) AS mean_margin
  FROM usable GROUP BY GROUPING SETS ((prompt_category), ())
)"""

SPLIT_SIZES = """,
split_sizes AS (
  SELECT split, count(*) AS pairs,
    count(DISTINCT prompt_id) + max(CASE WHEN prompt_id IS NULL THEN 1 ELSE 0 END) AS prompts
  FROM labelled GROUP BY split
)"""

FIRST = """,
first AS (
  SELECT split, prompt_id, prompt, prompt_category FROM (
    SELECT *, row_number() OVER (PARTITION BY split, prompt_id ORDER BY row_key) AS nth FROM labelled)
  WHERE nth = 1
)"""


def _counts_text(where: str) -> str:
    return (
        "(SELECT string_agg(prompt_category || '=' || n, ',' ORDER BY prompt_category) FROM "
        f"(SELECT prompt_category, count(*) AS n FROM labelled WHERE {where} AND prompt_category IS NOT NULL "
        "GROUP BY 1))"
    )


def _split_size(split: str, column: str) -> str:
    return f"(SELECT coalesce(max({column}), 0) FROM split_sizes WHERE split = '{split}')"


FILTER_STATS = """
    count(*) AS total_rows,
    count(*) FILTER (WHERE is_tie = 1) AS ties_removed,
    count(*) FILTER (WHERE is_tie IS NULL) AS tie_unknown,
    count(*) FILTER (WHERE is_tie = 0 AND (reading_time_s < 2 OR reading_time_s > 600)) AS quality_filtered,
    count(*) FILTER (WHERE is_tie = 0 AND reading_time_s < 2) AS too_fast,
    count(*) FILTER (WHERE is_tie = 0 AND reading_time_s > 600) AS too_slow,
    (SELECT count(*) FROM usable) AS usable_pairs"""

RUN_MEANS = ", ".join(
    [
        "count(*) AS total_steps",
        _r("coalesce(avg(mean_reward), 0)", "mean_reward_model_score"),
        _r("coalesce(avg(mean_kl), 0)", "mean_kl"),
        _r("coalesce(avg(mean_total_reward), 0)", "mean_total_reward"),
        _r("coalesce(avg(mean_response_tokens), 0)", "mean_response_tokens"),
        _r("coalesce(avg(policy_loss), 0)", "mean_policy_loss"),
        _r("coalesce(avg(clip_fraction), 0)", "mean_clip_fraction"),
    ]
)

DIGESTS = ", ".join(f"md5({t}) AS {t}, CAST(length({t}) AS INTEGER) AS {t}_chars" for t in ("prompt", "chosen", "rejected"))

SFT_EVAL = f"""
SELECT 'sft' AS stage, CAST(3 AS BIGINT) AS num_epochs, (SELECT count(*) FROM labelled) AS usable_pairs,
  (SELECT count(*) FROM labelled WHERE split = 'val') AS val_pairs,
  {_r("avg(-old_lp) FILTER (WHERE mask)", "loss")}, count(*) AS tokens,
  {_r("exp(least(avg(-old_lp) FILTER (WHERE mask), 20))", "perplexity")}
FROM tokens"""

ORACLE: dict[str, str] = {
    "csv_scan": _with(
        PAIRS,
        f"""SELECT pair_id, prompt_id, prompt_category, {DIGESTS}, chosen_temperature,
  CASE WHEN event_type IN ('click', 'view', 'error') THEN rejected_temperature END AS rejected_temperature,
  chosen_output_tokens, rejected_output_tokens, {_r("reading_time_s", "reading_time_s")}, is_tie,
  CASE WHEN event_type = 'error' THEN 'error' END AS note
FROM pairs""",
    ),
    "source_provenance": "SELECT 'csv' AS suffix, count(*) AS rows, TRUE AS several_files FROM events",
    "union_by_name": _with(
        PAIRS,
        f"""SELECT pair_id, prompt_category, chosen_temperature, {_r("reading_time_s", "reading_time_s")}, note FROM (
  SELECT pair_id, prompt_category, chosen_temperature, reading_time_s FROM pairs WHERE is_tie = 0
  UNION ALL BY NAME SELECT reading_time_s, pair_id, event_type AS note FROM pairs WHERE is_tie = 1
  UNION ALL BY NAME SELECT chosen_temperature, prompt_category, pair_id FROM pairs WHERE is_tie IS NULL)""",
    ),
    "view_roundtrip": _with(
        LABELLED + FIRST,
        """SELECT view, split, prompt_category AS category, md5(prompt) AS prompt, count(*) AS n FROM (
  SELECT 'sft' AS view, split, prompt_category, prompt FROM labelled
  UNION ALL SELECT 'reward', split, prompt_category, prompt FROM labelled
  UNION ALL SELECT 'ppo', split, prompt_category, prompt FROM first)
GROUP BY ALL""",
    ),
    "stage_record": _with(
        f"{USABLE}, {ROLLOUT}, {POLICIES}",
        f"""SELECT 'ppo' AS stage, 2 AS num_epochs, 4 AS batch_size, CAST(1e-5 AS DOUBLE) AS learning_rate,
  CAST(0.2 AS DOUBLE) AS clip_range, CAST(0.05 AS DOUBLE) AS kl_coefficient, 42 AS seed, runs.*,
  (SELECT count(*) FROM usable) AS usable_pairs, duel.*
FROM (SELECT {RUN_MEANS} FROM (
    SELECT s.*, m.policy_loss, m.clip_fraction FROM steps s JOIN means m USING (run_id, step_id))) runs,
  (SELECT {_r("avg(CASE WHEN ppo_score > reference_score THEN 1.0 ELSE 0.0 END)", "eval_win_rate")},
    {_r("avg(ppo_score)", "eval_ppo_reward_mean")}, {_r("avg(reference_score)", "eval_reference_reward_mean")},
    count(*) AS eval_prompts FROM policies) duel""",
    ),
    "stage_record_reward": _with(
        LABELLED,
        f"""SELECT 'reward' AS stage, 3 AS num_epochs, (SELECT count(*) FROM usable) AS usable_pairs,
  {_r("avg(CAST(win AS DOUBLE))", "pairwise_accuracy")}, {_r("avg(margin)", "mean_margin")},
  {_r("avg(chosen_score)", "mean_chosen_score")}, {_r("avg(rejected_score)", "mean_rejected_score")},
  count(*) AS pairs
FROM labelled WHERE split = 'val'""",
    ),
    "metrics_json": _with(f"{LABELLED}, {ROLLOUT}", SFT_EVAL),
    "metrics_catalog": _with(
        USABLE,
        """SELECT stage AS folder, stage, (SELECT count(*) FROM usable) AS usable_pairs, TRUE AS has_eval
FROM (VALUES ('sft'), ('reward'), ('ppo')) s(stage)""",
    ),
    "filter_ties": _with(PAIRS, "SELECT pair_id, is_tie FROM pairs WHERE is_tie = 0"),
    "filter_reading_time": _with(
        PAIRS,
        f"""SELECT pair_id, {_r("reading_time_s", "reading_time_s")} FROM pairs
WHERE NOT coalesce(reading_time_s < 2 OR reading_time_s > 600, FALSE)""",
    ),
    "filter_stats": _with(USABLE, f"SELECT {FILTER_STATS} FROM pairs"),
    "sft_view": _with(
        LABELLED, "SELECT split, prompt, chosen AS completion, prompt_category AS category FROM labelled"
    ),
    "reward_view": _with(
        LABELLED,
        """SELECT split, prompt, chosen, rejected, prompt_category AS category, chosen_temperature,
  rejected_temperature, chosen_output_tokens, rejected_output_tokens FROM labelled""",
    ),
    "ppo_prompts": _with(LABELLED + FIRST, "SELECT split, prompt, prompt_category AS category FROM first"),
    "dedup_prompts": _with(
        LABELLED + FIRST, "SELECT split, prompt_id, md5(prompt) AS prompt, prompt_category FROM first"
    ),
    "sample_prompt": _with(
        LABELLED, "SELECT prompt, split FROM labelled ORDER BY split <> 'val', row_key LIMIT 1"
    ),
    "preview": _with(
        USABLE,
        """SELECT pair_id, substr(prompt, 1, 80) AS prompt_preview, substr(rejected, 1, 100) AS rejected_preview,
  substr(chosen, 1, 300) AS continuation FROM usable""",
    ),
    "chat_format": _with(USABLE, f"SELECT pair_id, {_chat('prompt')} AS formatted FROM usable"),
    "scoring_text": _with(
        USABLE,
        f"""SELECT pair_id, md5({_chat("prompt")} || chosen) AS chosen_text_md5,
  md5({_chat("prompt")} || rejected) AS rejected_text_md5,
  CAST(length({_chat("prompt")} || chosen) AS INTEGER) AS chosen_text_chars,
  CAST(length({_chat("prompt")} || rejected) AS INTEGER) AS rejected_text_chars FROM usable""",
    ),
    "length_cap": _with(
        USABLE,
        f"""SELECT pair_id, md5({_capped("prompt", 512)}) AS prompt,
  len({_tokens("prompt")}) > 512 AS prompt_was_truncated,
  md5({_capped("(prompt || chosen)", 1024)}) AS text,
  len({_tokens("(prompt || chosen)")}) > 1024 AS text_was_truncated FROM usable""",
    ),
    "scoring_text_cap": _with(
        USABLE + f""",
texts AS (
  SELECT pair_id, {_chat("prompt")} || chosen AS c, {_chat("prompt")} || rejected AS r FROM usable
)""",
        f"""SELECT pair_id, md5({_capped("c", 1024)}) AS chosen_text, md5({_capped("r", 1024)}) AS rejected_text,
  len({_tokens("c")}) > 1024 AS chosen_text_was_truncated,
  len({_tokens("r")}) > 1024 AS rejected_text_was_truncated FROM texts""",
    ),
    "split_stratified": _with(LABELLED, "SELECT pair_id, prompt_category, split FROM labelled"),
    "split_random": _with(
        LABELLED,
        """SELECT pair_id, CASE WHEN place_in_all <= (SELECT v FROM totals) THEN 'val' ELSE 'train' END AS split
FROM labelled""",
    ),
    "stratify_check": _with(
        LABELLED,
        """SELECT n AS rows, categories, smallest AS smallest_category, v AS val_size, n - v AS train_size,
  smallest >= 2 AND v >= categories AND n - v >= categories AS stratified FROM totals""",
    ),
    "subsample": _with(
        SWEEP, "SELECT pair_id, prompt_category FROM sweep WHERE fraction = CAST(0.6 AS DOUBLE)"
    ),
    "nested_fit": _with(
        SWEEP
        + """,
doc_tokens AS (
  SELECT doc_id, unnest(regexp_split_to_array(trim(text, E' \\t\\n\\x0b\\f\\r'), '[ \\t\\n\\x0b\\f\\r]+')) AS token
  FROM documents
),
doc_features AS (
  SELECT doc_id, CAST('0x' || substr(md5(token), 1, 4) AS INTEGER) % 64 AS feature, count(*) AS n
  FROM doc_tokens WHERE token <> '' GROUP BY ALL
  UNION ALL SELECT doc_id, 64, count(*) FROM doc_tokens WHERE token <> '' GROUP BY ALL
),
sides AS (
  SELECT fraction, pair_id, (pair_id * 7 + 1) % (SELECT count(*) FROM documents) AS doc_id, 1 AS side FROM sweep
  UNION ALL
  SELECT fraction, pair_id, (pair_id * 11 + 3) % (SELECT count(*) FROM documents), -1 FROM sweep
),
differences AS (
  SELECT fraction, pair_id, feature, sum(side * n) AS d FROM sides JOIN doc_features USING (doc_id) GROUP BY ALL
),
samples AS (SELECT fraction, count(*) AS train_pairs FROM sweep GROUP BY fraction)""",
        """SELECT s.fraction, CAST(f.feature AS INTEGER) AS feature, train_pairs,
  CAST(coalesce(sum(d), 0) AS BIGINT) AS difference_sum, CAST(coalesce(sum(d * d), 0) AS BIGINT) AS square_sum,
  CAST(0 AS DOUBLE) AS gradient
FROM samples s CROSS JOIN range(65) f(feature)
LEFT JOIN differences x ON x.fraction = s.fraction AND x.feature = f.feature
GROUP BY ALL""",
    ),
    "fraction_sweep": _with(SWEEP, "SELECT fraction, pair_id FROM sweep"),
    "batch_manifest": _with(
        USABLE,
        """SELECT epoch, (place - 1) // 4 AS batch_id, place, prompt_id FROM (
  SELECT epoch, prompt_id, row_number() OVER (
    PARTITION BY epoch ORDER BY md5('42|' || epoch || '|' || prompt_id), prompt_id) AS place
  FROM (SELECT DISTINCT prompt_id FROM usable), (VALUES (1), (2)) e(epoch))""",
    ),
    "steps_per_epoch": _with(
        USABLE,
        """SELECT prompts, (prompts + 3) // 4 AS steps_per_epoch, 2 * ((prompts + 3) // 4) AS total_steps
FROM (SELECT count(DISTINCT prompt_id) AS prompts FROM usable)""",
    ),
    "train_batch_manifest": _with(
        LABELLED,
        """SELECT epoch, (place - 1) // 4 AS batch_id, place, prompt_id FROM (
  SELECT epoch, prompt_id, row_number() OVER (
    PARTITION BY epoch ORDER BY md5('42|' || epoch || '|' || prompt_id), prompt_id) AS place
  FROM (SELECT DISTINCT prompt_id FROM labelled WHERE split = 'train'), (VALUES (1), (2)) e(epoch))""",
    ),
    "train_steps_per_epoch": _with(
        LABELLED,
        """SELECT prompts, (prompts + 3) // 4 AS steps_per_epoch, 2 * ((prompts + 3) // 4) AS total_steps
FROM (SELECT count(DISTINCT prompt_id) AS prompts FROM labelled WHERE split = 'train')""",
    ),
    "view_sizes": _with(LABELLED + SPLIT_SIZES, "SELECT * FROM split_sizes"),
    "category_counts": _with(
        LABELLED,
        """SELECT split, prompt_category, count(*) AS n FROM labelled WHERE prompt_category IS NOT NULL
GROUP BY GROUPING SETS ((split, prompt_category), (prompt_category))""",
    ),
    "token_means": _with(
        USABLE,
        f"""SELECT {_r("avg(chosen_output_tokens)", "avg_chosen_tokens")},
  {_r("avg(rejected_output_tokens)", "avg_rejected_tokens")} FROM usable""",
    ),
    "median_reading_time": _with(
        USABLE, f"SELECT {_r('median(reading_time_s)', 'median_reading_time_s')} FROM usable"
    ),
    "metadata_report": _with(
        LABELLED + SPLIT_SIZES,
        f"""SELECT 0 AS num_source_files, CAST(0.2 AS DOUBLE) AS val_fraction, {FILTER_STATS},
  {_split_size("train", "pairs")} AS train_pairs, {_split_size("val", "pairs")} AS val_pairs,
  {_split_size("train", "pairs")} AS sft_train_examples, {_split_size("val", "pairs")} AS sft_val_examples,
  {_split_size("train", "pairs")} AS reward_train_examples, {_split_size("val", "pairs")} AS reward_val_examples,
  {_split_size("train", "prompts")} AS ppo_train_prompts, {_split_size("val", "prompts")} AS ppo_val_prompts,
  {_counts_text("TRUE")} AS categories, {_counts_text("split = 'train'")} AS train_categories,
  {_counts_text("split = 'val'")} AS val_categories,
  {_r("(SELECT avg(chosen_output_tokens) FROM usable)", "avg_chosen_tokens")},
  {_r("(SELECT avg(rejected_output_tokens) FROM usable)", "avg_rejected_tokens")},
  {_r("(SELECT median(reading_time_s) FROM usable)", "median_reading_time_s")}
FROM pairs""",
    ),
    "join_completions": """SELECT p.conv_id, p.turn, p.text || c.text AS text
FROM conversations p JOIN conversations c ON c.conv_id = p.conv_id AND c.turn = p.turn + 1
WHERE p.role = 'user' AND c.role = 'assistant'""",
    "unpaired_completions": """WITH marked AS (
  SELECT conv_id, turn, 1 AS p, 0 AS c FROM conversations WHERE role = 'user'
  UNION ALL SELECT conv_id, turn - 1, 0, 1 FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, CAST(sum(p) AS BIGINT) AS prompts, CAST(sum(c) AS BIGINT) AS completions FROM marked
GROUP BY conv_id, turn HAVING sum(p) <> 1 OR sum(c) <> 1 OR conv_id IS NULL OR turn IS NULL""",
    "score_margin": _with(USABLE, f"SELECT pair_id, {_r('margin', 'margin')}, margin > 0 AS win FROM usable"),
    "pairwise_eval": _with(
        USABLE,
        f"""SELECT {_r("avg(CAST(win AS DOUBLE))", "pairwise_accuracy")}, {_r("avg(margin)", "mean_margin")},
  {_r("avg(chosen_score)", "mean_chosen_score")}, {_r("avg(rejected_score)", "mean_rejected_score")},
  count(*) AS pairs FROM usable""",
    ),
    "category_eval": _with(
        USABLE + EVALUATED,
        f"""SELECT category, is_total, {_r("accuracy", "accuracy")}, pairs, {_r("mean_margin", "mean_margin")},
  {_r(LOW, "ci_low")}, {_r(HIGH, "ci_high")} FROM evaluated""",
    ),
    "policy_pairing": _with(POLICIES, "SELECT prompt_id, ppo_score, reference_score FROM policies"),
    "win_rate": _with(
        POLICIES,
        f"""SELECT {_r("avg(CASE WHEN ppo_score > reference_score THEN 1.0 ELSE 0.0 END)", "win_rate")},
  {_r("avg(ppo_score)", "ppo_reward_mean")}, {_r("avg(reference_score)", "reference_reward_mean")},
  count(*) AS prompts FROM policies""",
    ),
    "normal_quantile": _with(
        PAIRS,
        f"""SELECT pair_id, {_r(_quantile("p"), "z")} FROM (
  SELECT pair_id, (chosen_temperature * 100 + CAST(0.5 AS DOUBLE)) / 100 AS p FROM pairs)""",
    ),
    "sample_size": _with(
        USABLE + EVALUATED,
        f"SELECT category, is_total, {_needed('accuracy')} AS needed, "
        "CAST(-1 AS BIGINT) AS needed_below_chance FROM evaluated",
    ),
    "wilson_interval": _with(
        USABLE,
        f"""SELECT prompt_id, pairs AS n, {_r(LOW, "low")}, {_r(HIGH, "high")} FROM (
  SELECT prompt_id, avg(CAST(win AS DOUBLE)) AS accuracy, count(*) AS pairs FROM usable GROUP BY prompt_id)""",
    ),
    "power_report": _with(
        USABLE + EVALUATED,
        f"""SELECT category, is_total, {_r("accuracy", "observed_accuracy")}, pairs AS val_size,
  {_r(LOW, "ci_low")}, {_r(HIGH, "ci_high")}, {LOW} <= 0.5 AS includes_chance, target,
  printf('%.0f%%', target * 100) AS target_label, {_needed("target")} AS val_pairs_needed,
  CAST(ceil({_needed("target")} / CAST(0.5 AS DOUBLE)) AS BIGINT) AS total_pairs_needed,
  abs(target - accuracy) < CAST(0.025 AS DOUBLE) AS nearest_to_observed
FROM evaluated, (SELECT CAST(t AS DOUBLE) AS target
  FROM (VALUES (0.55), (0.60), (0.65), (0.70), (0.75), (0.80)) v(t))""",
    ),
    "curve_pivot": _with(
        SWEEP,
        "SELECT fraction, "
        + _r("avg(CAST(win AS DOUBLE))", "overall_accuracy")
        + ", "
        + ", ".join(
            _r(f"coalesce(avg(CAST(win AS DOUBLE)) FILTER (WHERE prompt_category = '{c}'), 0)", f"{c}_accuracy")
            + f", count(*) FILTER (WHERE prompt_category = '{c}') AS {c}_count"
            for c in ("de", "en", "es", "fr")
        )
        + " FROM sweep GROUP BY fraction",
    ),
    "response_tokens": _with(
        RESPONSES,
        """SELECT doc_id, CAST(unnest(range(0, len(kept))) AS INTEGER) AS place, unnest(kept) AS token FROM (
  SELECT doc_id, list_filter(list_slice(token_ids, 6, len(token_ids)), lambda x: x <> 'the') AS kept
  FROM responses)""",
    ),
    "response_mask": _with(
        RESPONSES,
        """SELECT doc_id, CAST(position AS INTEGER) AS position, position >= 5 AND token <> 'the' AS in_response FROM (
  SELECT doc_id, unnest(range(0, len(token_ids))) AS position, unnest(token_ids) AS token FROM responses)""",
    ),
    "kl_join": _with(
        ROLLOUT,
        f"""SELECT p.run_id, p.seq_id, p.pos, {_r("p.old_lp - q.ref_lp", "kl")}
FROM tokens p JOIN tokens q USING (run_id, seq_id, pos)""",
    ),
    "kl_arrays": _with(
        ROLLOUT,
        f"""SELECT run_id, seq_id, place, {_r("kl", "kl")} FROM (
  SELECT CAST(floor(l_orderkey / 201) AS BIGINT) AS run_id, l_orderkey AS seq_id,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
      -l_quantity / 10, -l_quantity / 10 + (l_tax - CAST(0.04 AS DOUBLE))) - 1 AS place,
    -l_quantity / 10 - (-l_quantity / 10 + (l_tax - CAST(0.04 AS DOUBLE))) AS kl
  FROM lineitem)""",
    ),
    "sequence_mean_kl_arrays": _with(
        ROLLOUT, f"SELECT run_id, step_id, seq_id, {_r('mean_kl', 'mean_kl')}, response_tokens FROM sequences"
    ),
    "clip_fraction_arrays": _with(
        ROLLOUT, f"SELECT run_id, step_id, update_id, {_r('clip_fraction', 'clip_fraction')}, tokens FROM clipped"
    ),
    "surrogate_loss_arrays": _with(
        ROLLOUT, f"SELECT run_id, step_id, update_id, {_r('policy_loss', 'policy_loss')} FROM losses"
    ),
    "sequence_mean_kl": _with(
        ROLLOUT, f"SELECT run_id, step_id, seq_id, {_r('mean_kl', 'mean_kl')}, response_tokens FROM sequences"
    ),
    "response_lengths": _with(
        ROLLOUT,
        f"""SELECT run_id, step_id, {_r("avg(response_tokens)", "mean_response_tokens")}, count(*) AS sequences
FROM sequences GROUP BY run_id, step_id""",
    ),
    "penalised_reward": _with(
        ROLLOUT,
        f"""SELECT run_id, step_id, seq_id, {_r("reward", "reward")}, {_r("total_reward", "total_reward")}
FROM rewarded""",
    ),
    "advantages": _with(
        ROLLOUT, f"SELECT run_id, step_id, seq_id, {_r('advantage', 'advantage')} FROM advantages"
    ),
    "reward_baseline": _with(
        ROLLOUT,
        f"""SELECT run_id, step_id, {_r("mean_total_reward", "mean_total_reward")},
  {_r("before", "baseline_before")}, {_r("after", "baseline_after")} FROM baseline""",
    ),
    "clip_fraction": _with(
        ROLLOUT, f"SELECT run_id, step_id, update_id, {_r('clip_fraction', 'clip_fraction')}, tokens FROM clipped"
    ),
    "surrogate_loss": _with(
        ROLLOUT, f"SELECT run_id, step_id, update_id, {_r('policy_loss', 'policy_loss')} FROM losses"
    ),
    "update_means": _with(
        ROLLOUT,
        f"""SELECT run_id, step_id, {_r("policy_loss", "policy_loss")}, {_r("clip_fraction", "clip_fraction")},
  updates FROM means""",
    ),
    "step_metrics": _with(
        ROLLOUT,
        f"""SELECT run_id, step_id, {_r("mean_reward", "mean_reward")}, {_r("mean_kl", "mean_kl")},
  {_r("mean_total_reward", "mean_total_reward")}, {_r("mean_response_tokens", "mean_response_tokens")},
  n AS sequences FROM steps""",
    ),
    "run_metrics": _with(
        ROLLOUT,
        f"""SELECT run_id, {RUN_MEANS} FROM (
  SELECT s.*, m.policy_loss, m.clip_fraction FROM steps s JOIN means m USING (run_id, step_id))
GROUP BY run_id""",
    ),
    "perplexity": _with(
        ROLLOUT,
        f"""SELECT run_id, {_r("avg(-old_lp) FILTER (WHERE mask)", "loss")},
  {_r("exp(least(avg(-old_lp) FILTER (WHERE mask), 20))", "perplexity")} FROM tokens GROUP BY run_id""",
    ),
    "bulk_score_function": _with(
        USABLE,
        "SELECT pair_id, "
        + ", ".join(
            f"len({_tokens(t)}) * CAST(0.25 AS DOUBLE) - (length({t}) - length(replace({t}, ',', ''))) AS {t}_score"
            for t in ("chosen", "rejected")
        )
        + " FROM usable",
    ),
    "view_counts": _with(
        LABELLED + FIRST,
        """SELECT view, split, count(*) AS n FROM (
  SELECT 'sft' AS view, split FROM labelled UNION ALL SELECT 'reward', split FROM labelled
  UNION ALL SELECT 'ppo', split FROM first) GROUP BY ALL""",
    ),
    "stage_record_ranking": _with(
        LABELLED,
        f"""SELECT 'reward' AS stage, 'linear-preference' AS base_model, 3 AS num_epochs, -1 AS max_steps,
  16 AS effective_batch_size, CAST(1e-4 AS DOUBLE) AS learning_rate,
  (SELECT count(*) FROM labelled WHERE split = 'train') AS reward_train_examples, count(*) AS reward_val_examples,
  (SELECT count(*) FROM labelled) AS usable_pairs, {_r("avg(ln(1 + exp(-margin)))", "loss")},
  {_r("avg(CAST(win AS DOUBLE))", "pairwise_accuracy")}, {_r("avg(margin)", "mean_margin")},
  {_r("avg(chosen_score)", "mean_chosen_score")}, {_r("avg(rejected_score)", "mean_rejected_score")},
  count(*) AS pairs
FROM labelled WHERE split = 'val'""",
    ),
}
ORACLE["bulk_score_budget"] = ORACLE["bulk_score_function"]
