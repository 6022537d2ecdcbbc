"""DuckDB SQL that recomputes each registered query from the raw tables.

Written independently of the Spark code (plain SQL over the pre-registered
views), it is the correctness oracle: same column names, same values.
Doubles whose last bits depend on aggregation order (std, correlation,
quantile interpolation) are rounded on both sides with
``floor(x * 1e6 + 0.5) / 1e6``.
"""

from __future__ import annotations


def r6(x: str) -> str:
    return f"(floor(({x}) * 1e6 + 0.5) / 1e6)"


BASE = """
o AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS d,
         CAST(round(o_totalprice * 100) AS BIGINT) AS c
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-08-01 00:00:00'
), pc AS (
  SELECT customer_id,
    count(*) FILTER (WHERE d < DATE '2000-08-01') AS total_orders,
    count(*) FILTER (WHERE d < DATE '2000-08-01' AND d >= DATE '1999-08-02') AS frequency,
    max(d) FILTER (WHERE d < DATE '2000-08-01') AS last_order,
    min(d) FILTER (WHERE d < DATE '2000-08-01') AS first_order,
    sum(c) FILTER (WHERE d < DATE '2000-08-01') AS spend_cents,
    count(*) FILTER (WHERE d >= DATE '2000-08-01' AND d < DATE '2001-08-01') AS next_orders
  FROM o GROUP BY customer_id
), err AS (
  SELECT user_id AS customer_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY user_id
), base AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS customer_id,
    CAST(date_diff('day', pc.last_order, DATE '2000-08-01') AS BIGINT) AS recency_days,
    CAST(pc.frequency AS BIGINT) AS frequency,
    CAST(pc.spend_cents AS DOUBLE) / 100 AS monetary_value,
    CAST((pc.spend_cents * 2 + pc.total_orders) // (pc.total_orders * 2) AS DOUBLE) / 100 AS avg_order_value,
    CAST(date_diff('day', pc.first_order, DATE '2000-08-01') AS BIGINT) AS days_since_signup,
    CAST(pc.total_orders AS BIGINT) AS total_orders,
    CAST(coalesce(err.n, 0) AS BIGINT) AS support_tickets,
    CAST(18 + (c.c_custkey * 37) % 58 AS BIGINT) AS age,
    CAST(CASE WHEN pc.next_orders = 0 THEN 1 ELSE 0 END AS BIGINT) AS churned
  FROM customer c JOIN pc ON c.c_custkey = pc.customer_id
  LEFT JOIN err ON err.customer_id = c.c_custkey
  WHERE pc.total_orders > 0
)"""

RATIOS = """
feat AS (
  SELECT *,
    recency_days / (frequency + 1) AS recency_frequency_ratio,
    monetary_value / (total_orders + 1) AS monetary_per_order,
    total_orders / (days_since_signup + 1) AS order_frequency,
    support_tickets / (total_orders + 1) AS support_per_order
  FROM base
)"""

RFM = """
redges AS (SELECT quantile_cont(recency_days, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM base),
ranked AS (
  SELECT f.*,
    row_number() OVER (ORDER BY frequency, customer_id) AS rn_f,
    row_number() OVER (ORDER BY monetary_value, customer_id) AS rn_m,
    count(*) OVER () AS n
  FROM feat f
), rfm AS (
  SELECT ranked.* EXCLUDE (rn_f, rn_m, n),
    CAST(5 - CAST(recency_days > e[2] AS BIGINT) - CAST(recency_days > e[3] AS BIGINT)
           - CAST(recency_days > e[4] AS BIGINT) - CAST(recency_days > e[5] AS BIGINT) AS BIGINT) AS r_score,
    CAST(greatest(1, (5 * (rn_f - 1) + n - 2) // (n - 1)) AS BIGINT) AS f_score,
    CAST(greatest(1, (5 * (rn_m - 1) + n - 2) // (n - 1)) AS BIGINT) AS m_score
  FROM ranked, redges
), rfm2 AS (
  SELECT *, CAST(r_score + f_score + m_score AS BIGINT) AS rfm_score FROM rfm
)"""

# Noise-free churn rule on z-scores (sample std) of four columns.
RULE = """
zst AS (
  SELECT avg(recency_days) AS mr, stddev_samp(recency_days) AS sr,
         avg(frequency) AS mf, stddev_samp(frequency) AS sf,
         avg(monetary_value) AS mm, stddev_samp(monetary_value) AS sm,
         avg(support_tickets) AS ms, stddev_samp(support_tickets) AS ss
  FROM base
), scored AS (
  SELECT r.*,
    1.0 / (1.0 + exp(-(0.0 + 1.8 * ((recency_days - mr) / sr) + -1.5 * ((frequency - mf) / sf)
                      + -1.0 * ((monetary_value - mm) / sm) + 0.8 * ((support_tickets - ms) / ss)))) AS churn_probability
  FROM rfm2 r, zst
), decided AS (
  SELECT *, CAST(churn_probability > 0.5 AS BIGINT) AS churn_predicted FROM scored
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


FULL = with_ctes(BASE, RATIOS, RFM, RULE)

SQL: dict[str, str] = {}

SQL["customer_base"] = with_ctes(BASE) + "SELECT * FROM base"

SQL["ratio_features"] = with_ctes(BASE, RATIOS) + """
SELECT customer_id, recency_frequency_ratio, monetary_per_order, order_frequency, support_per_order FROM feat"""

SQL["spend_frequency_product"] = with_ctes(BASE) + """
SELECT customer_id, monetary_value * frequency AS expensive_feature FROM base"""

SQL["r_score"] = with_ctes(BASE, RATIOS, RFM) + "SELECT customer_id, recency_days, r_score FROM rfm2"
SQL["f_score"] = with_ctes(BASE, RATIOS, RFM) + "SELECT customer_id, frequency, f_score FROM rfm2"
SQL["m_score"] = with_ctes(BASE, RATIOS, RFM) + "SELECT customer_id, monetary_value, m_score FROM rfm2"
SQL["rfm_features"] = with_ctes(BASE, RATIOS, RFM) + "SELECT * FROM rfm2"

SQL["rule_score"] = FULL + f"""
SELECT customer_id, {r6('churn_probability')} AS churn_probability, churn_predicted FROM decided"""

SQL["top10_risk"] = FULL + f"""
SELECT customer_id, {r6('churn_probability')} AS churn_probability, churn_predicted, rfm_score
FROM decided ORDER BY churn_probability DESC, customer_id LIMIT 10"""


# -- profile ---------------------------------------------------------------------

COLS = ["customer_id", "recency_days", "frequency", "monetary_value", "avg_order_value", "days_since_signup",
        "total_orders", "support_tickets", "age", "churned"]
TYPES = {c: ("double" if c in ("monetary_value", "avg_order_value") else "bigint") for c in COLS}
FEATS = COLS[1:9]
NULL_COLS = ["recency_days", "frequency", "monetary_value", "total_orders", "support_tickets"]
ALLC = "allc AS (SELECT CAST(c.c_custkey AS BIGINT) AS customer_id, b.* EXCLUDE (customer_id) " \
       "FROM customer c LEFT JOIN base b ON b.customer_id = c.c_custkey)"

SQL["shape"] = with_ctes(BASE) + f"SELECT count(*) AS n_rows, CAST({len(COLS)} AS BIGINT) AS n_cols FROM base"

SQL["column_info"] = with_ctes(BASE) + "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column, '{TYPES[c]}' AS dtype, count({c}) AS non_null FROM base"
    for i, c in enumerate(COLS)
)

SQL["describe"] = with_ctes(BASE) + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std,
  CAST(min({c}) AS DOUBLE) AS min, {r6(f'quantile_cont({c}, 0.25)')} AS p25, {r6(f'quantile_cont({c}, 0.5)')} AS p50,
  {r6(f'quantile_cont({c}, 0.75)')} AS p75, CAST(max({c}) AS DOUBLE) AS max FROM base"""
    for c in COLS
)

SQL["churn_counts"] = with_ctes(BASE) + "SELECT churned, count(*) AS count FROM base GROUP BY churned"
SQL["churn_share"] = with_ctes(BASE) + """
SELECT churned, count(*) AS count, count(*) / (SELECT count(*) FROM base) AS share FROM base GROUP BY churned"""

SQL["null_counts"] = with_ctes(BASE, ALLC) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM allc" for c in COLS
)


def _hist(c: str) -> str:
    return f"""SELECT '{c}' AS column, CAST(g.bin AS BIGINT) AS bin,
  {r6('m.lo + g.bin * ((m.hi - m.lo) / 30)')} AS bin_lo, {r6('m.lo + (g.bin + 1) * ((m.hi - m.lo) / 30)')} AS bin_hi,
  (SELECT count(*) FROM base
    WHERE least(floor((CAST({c} AS DOUBLE) - m.lo) / (m.hi - m.lo) * 30), 29) = g.bin) AS count
FROM (SELECT CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE CAST(min({c}) AS DOUBLE) END AS lo,
             CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE CAST(max({c}) AS DOUBLE) END AS hi FROM base) m,
     (SELECT range AS bin FROM range(30)) g"""


SQL["histogram_30"] = with_ctes(BASE) + "\nUNION ALL\n".join(_hist(c) for c in FEATS)


def _box(c: str) -> str:
    return f"""SELECT b.churned, '{c}' AS column, {r6('q.q1')} AS q1, {r6('q.q2')} AS median, {r6('q.q3')} AS q3,
  CAST(min({c}) FILTER (WHERE {c} >= q.q1 - 1.5 * (q.q3 - q.q1)) AS DOUBLE) AS whisker_lo,
  CAST(max({c}) FILTER (WHERE {c} <= q.q3 + 1.5 * (q.q3 - q.q1)) AS DOUBLE) AS whisker_hi,
  count(*) FILTER (WHERE {c} < q.q1 - 1.5 * (q.q3 - q.q1) OR {c} > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM base b JOIN (SELECT churned, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2,
                         quantile_cont({c}, 0.75) AS q3 FROM base GROUP BY churned) q ON q.churned = b.churned
GROUP BY b.churned, q.q1, q.q2, q.q3"""


SQL["boxplot_by_churn"] = with_ctes(BASE) + "\nUNION ALL\n".join(_box(c) for c in FEATS)

_CORR_COLS = COLS[1:]
SQL["corr_matrix"] = with_ctes(BASE) + "\nUNION ALL\n".join(
    [f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r6(f'corr({a}, {b})')} AS corr FROM base"
     for a in _CORR_COLS for b in _CORR_COLS if a != b]
    + [f"SELECT '{a}' AS col_a, '{a}' AS col_b, 1.0::DOUBLE AS corr" for a in _CORR_COLS]
)

SQL["churn_rate"] = with_ctes(BASE) + "SELECT avg(churned) AS churn_rate FROM base"

SQL["null_fill"] = with_ctes(BASE, ALLC) + "SELECT customer_id, " + ", ".join(
    f"coalesce({c}, 0) AS {c}" for c in NULL_COLS) + " FROM allc"
SQL["drop_nulls"] = with_ctes(BASE, ALLC) + "SELECT customer_id, " + ", ".join(NULL_COLS) + \
    " FROM allc WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in ["customer_id"] + NULL_COLS)

F4 = ["recency_days", "frequency", "monetary_value", "age"]
SQL["zscore_features"] = with_ctes(BASE) + "SELECT customer_id, " + ", ".join(
    f"{r6(f'({c} - (SELECT avg({c}) FROM base)) / ((SELECT stddev_samp({c}) FROM base) + 1e-8)')} AS {c}" for c in F4
) + " FROM base"
SQL["zscore_all_numeric"] = with_ctes(BASE) + "SELECT *, " + ", ".join(
    f"{r6(f'({c} - (SELECT avg({c}) FROM base)) / ((SELECT stddev_samp({c}) FROM base) + 1e-8)')} AS {c}_normalized"
    for c in COLS
) + " FROM base"

HASH = "substr(md5('42-' || CAST(customer_id AS VARCHAR)), 1, 8)"
SPLIT = f"""sp AS (SELECT *, CASE WHEN {HASH} < '33333333' THEN 'test' ELSE 'train' END AS split FROM base)"""


def _scaled(c: str) -> str:
    s = f"(SELECT stddev_pop({c}) FROM sp WHERE split = 'train')"
    m = f"(SELECT avg({c}) FROM sp WHERE split = 'train')"
    return f"{r6(f'({c} - {m}) / (CASE WHEN {s} = 0 THEN 1.0 ELSE {s} END)')} AS {c}"


SQL["standard_scale_train"] = with_ctes(BASE, SPLIT) + "SELECT customer_id, " + ", ".join(
    _scaled(c) for c in FEATS) + " FROM sp WHERE split = 'test'"

SQL["split_hash"] = with_ctes(BASE, SPLIT) + "SELECT customer_id, split FROM sp"
SQL["split_stratified"] = with_ctes(BASE) + f"""
SELECT customer_id, churned,
  CASE WHEN row_number() OVER (PARTITION BY churned ORDER BY {HASH}, customer_id)
            <= floor(0.2 * count(*) OVER (PARTITION BY churned) + 0.5) THEN 'test' ELSE 'train' END AS split
FROM base"""
SQL["fold_sizes"] = with_ctes(BASE) + f"""
SELECT fold, churned, count(*) AS n FROM (
  SELECT churned, CAST(CAST(rn > n // 5 AS BIGINT) + CAST(rn > n * 2 // 5 AS BIGINT) + CAST(rn > n * 3 // 5 AS BIGINT)
                       + CAST(rn > n * 4 // 5 AS BIGINT) AS BIGINT) AS fold
  FROM (SELECT churned, count(*) OVER (PARTITION BY churned) AS n,
               row_number() OVER (PARTITION BY churned ORDER BY {HASH}, customer_id) AS rn FROM base)
  ) GROUP BY fold, churned"""
SQL["first_100"] = with_ctes(BASE) + "SELECT * FROM base ORDER BY customer_id LIMIT 100"


# -- scoring tables and metrics --------------------------------------------------

SCORED = f"""sc AS (
  SELECT d.*,
    1.0 / (1.0 + exp(-(-2.0::DOUBLE + 0.02::DOUBLE * recency_days + -0.1::DOUBLE * frequency
                       + -0.001::DOUBLE * monetary_value + 0.2::DOUBLE * support_tickets))) AS p_logistic,
    CASE WHEN {HASH} < '33333333' THEN 'test' ELSE 'train' END AS split
  FROM decided d
)"""
SCORED_FULL = with_ctes(BASE, RATIOS, RFM, RULE, SCORED)
P = r6("churn_probability")


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END)"


CELLS = """count(*) FILTER (WHERE actual = 1 AND predicted = 1) AS tp,
  count(*) FILTER (WHERE actual = 0 AND predicted = 1) AS fp,
  count(*) FILTER (WHERE actual = 1 AND predicted = 0) AS fn,
  count(*) FILTER (WHERE actual = 0 AND predicted = 0) AS tn"""
RATIO_COLS = f"""tp + fp + fn + tn AS n,
  {ratio('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {ratio('tp', 'tp + fp')} AS precision,
  {ratio('tp', 'tp + fn')} AS recall, {ratio('2 * tp', '2 * tp + fp + fn')} AS f1"""

EVAL = """ev AS (
  SELECT customer_id, churned AS actual, churn_predicted AS predicted, churn_probability AS probability,
         CAST(churned = churn_predicted AS BIGINT) AS correct
  FROM sc WHERE split = 'test'
)"""
EVAL_FULL = with_ctes(BASE, RATIOS, RFM, RULE, SCORED, EVAL)

RUN_PREDS = {
    "rule_t30": "churn_probability > 0.3::DOUBLE",
    "rule_t50": "churn_probability > 0.5::DOUBLE",
    "rule_t70": "churn_probability > 0.7::DOUBLE",
    "rfm_low": "rfm_score <= 7",
    "logistic_fixed": "p_logistic > 0.5::DOUBLE",
    "never": "false",
}
LONG = "lng AS (" + "\n  UNION ALL ".join(
    f"SELECT split, churned AS actual, '{n}' AS run_name, CAST({e} AS BIGINT) AS predicted FROM sc"
    for n, e in RUN_PREDS.items()
) + ")"
PER_SPLIT = f"""ps AS (
  SELECT *, {RATIO_COLS} FROM (SELECT run_name, split, {CELLS} FROM lng GROUP BY run_name, split)
)"""
RUNS_T = """rt AS (
  SELECT coalesce(t.run_name, r.run_name) AS run_name, substr(md5(coalesce(t.run_name, r.run_name)), 1, 8) AS run_id,
    t.accuracy, t.precision, t.recall, t.f1,
    r.accuracy AS training_accuracy_score, r.precision AS training_precision_score,
    r.recall AS training_recall_score, r.f1 AS training_f1_score
  FROM (SELECT * FROM ps WHERE split = 'test') t FULL JOIN (SELECT * FROM ps WHERE split = 'train') r
    ON t.run_name = r.run_name
)"""
LB = """lb AS (
  SELECT run_name, run_id,
    CASE WHEN coalesce(f1, 0) = 0 AND training_f1_score IS NOT NULL THEN 'TRAIN (non comparable !)' ELSE 'test' END
      AS metric_type,
    CASE WHEN coalesce(f1, 0) = 0 AND training_f1_score IS NOT NULL THEN training_accuracy_score
         ELSE coalesce(accuracy, 0.0) END AS accuracy,
    CASE WHEN coalesce(f1, 0) = 0 AND training_f1_score IS NOT NULL THEN training_precision_score
         ELSE coalesce(precision, 0.0) END AS precision,
    CASE WHEN coalesce(f1, 0) = 0 AND training_f1_score IS NOT NULL THEN training_recall_score
         ELSE coalesce(recall, 0.0) END AS recall,
    CASE WHEN coalesce(f1, 0) = 0 AND training_f1_score IS NOT NULL THEN training_f1_score
         ELSE coalesce(f1, 0.0) END AS f1
  FROM rt
)"""
RUNS_FULL = with_ctes(BASE, RATIOS, RFM, RULE, SCORED, LONG, PER_SPLIT, RUNS_T, LB)

SQL["logistic_fixed"] = with_ctes(BASE) + f"""
SELECT customer_id, {r6('p')} AS churn_probability, CAST(p > 0.5::DOUBLE AS BIGINT) AS churn_predicted FROM (
  SELECT customer_id, 1.0 / (1.0 + exp(-(-2.0::DOUBLE + 0.02::DOUBLE * recency_days + -0.1::DOUBLE * frequency
                       + -0.001::DOUBLE * monetary_value + 0.2::DOUBLE * support_tickets))) AS p FROM base)"""
SQL["high_risk"] = FULL + f"SELECT customer_id, {P} AS churn_probability FROM decided WHERE churn_probability > 0.7::DOUBLE"
SQL["high_risk_receipt"] = FULL + """
SELECT count(*) AS record_count, count(*) FILTER (WHERE churn_probability > 0.7::DOUBLE) AS high_risk_count FROM decided"""
SQL["score_with_actual"] = FULL + f"""
SELECT customer_id, {P} AS churn_probability, churn_predicted, churned AS churn_actual FROM decided"""
SQL["score_versioned"] = FULL + f"""
SELECT customer_id, {P} AS churn_probability, churn_predicted, 'rule-v1' AS model_version FROM decided"""
SQL["score_minimal"] = FULL + "SELECT customer_id, churn_predicted AS predicted_churn FROM decided"
SQL["status_labels"] = FULL + """
SELECT customer_id, CASE WHEN churn_predicted = 1 THEN 'Churn' ELSE 'Retain' END AS status FROM decided"""
SQL["eval_table"] = EVAL_FULL + f"SELECT customer_id, actual, predicted, {r6('probability')} AS probability, correct FROM ev"
SQL["class_metrics"] = EVAL_FULL + f"SELECT *, {RATIO_COLS} FROM (SELECT {CELLS} FROM ev)"
SQL["confusion"] = EVAL_FULL + """
SELECT a.actual, p.predicted, (SELECT count(*) FROM ev WHERE ev.actual = a.actual AND ev.predicted = p.predicted) AS count
FROM (SELECT CAST(range AS BIGINT) AS actual FROM range(2)) a, (SELECT CAST(range AS BIGINT) AS predicted FROM range(2)) p"""
SQL["class_report"] = EVAL_FULL + f"""
, c AS (SELECT {CELLS} FROM ev)
, k AS (SELECT tp, fp, fn, tn, tp + fp + fn + tn AS n, tp + fn AS s1, tn + fp AS s0,
    {ratio('tp', 'tp + fp')} AS p1, {ratio('tp', 'tp + fn')} AS r1, {ratio('2 * tp', '2 * tp + fp + fn')} AS f1,
    {ratio('tn', 'tn + fn')} AS p0, {ratio('tn', 'tn + fp')} AS r0, {ratio('2 * tn', '2 * tn + fn + fp')} AS f0,
    {ratio('tp + tn', 'tp + fp + fn + tn')} AS acc FROM c)
SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM k
UNION ALL SELECT '1', p1, r1, f1, s1 FROM k
UNION ALL SELECT 'accuracy', NULL, NULL, acc, n FROM k
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM k
UNION ALL SELECT 'weighted avg', {ratio('p0 * s0 + p1 * s1', 'n')}, {ratio('r0 * s0 + r1 * s1', 'n')},
  {ratio('f0 * s0 + f1 * s1', 'n')}, n FROM k"""
SQL["class_report"] = SQL["class_report"].replace("FROM ev)\n, c AS", "FROM ev), c AS")
SQL["score_summary"] = FULL + f"""
SELECT n, pc AS n_predicted_churn, ac AS n_actual_churn, {ratio('pc', 'n')} AS predicted_share,
  {ratio('ac', 'n')} AS actual_share, {ratio('ok', 'n')} AS accuracy
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE churn_predicted = 1) AS pc,
             count(*) FILTER (WHERE churned = 1) AS ac, count(*) FILTER (WHERE churn_predicted = churned) AS ok
      FROM decided)"""
SQL["metrics_by_run"] = RUNS_FULL + "SELECT * FROM ps"
SQL["leaderboard"] = RUNS_FULL + "SELECT * FROM lb"
SQL["runs_query"] = RUNS_FULL + """
SELECT run_name, accuracy, f1 FROM rt WHERE accuracy > 0.5 ORDER BY f1 DESC, run_name LIMIT 5"""
SQL["best_run"] = RUNS_FULL + "SELECT * FROM lb ORDER BY f1 DESC, run_name LIMIT 1"
SQL["quality_gate"] = RUNS_FULL + "SELECT run_name, f1, CAST(coalesce(f1, 0.0) >= 0.3 AS BIGINT) AS passed FROM rt"


# -- distributed RFM paths --------------------------------------------------------

SQL["rfm_cutkeys"] = SQL["rfm_features"]
SQL["split_stratified_cuts"] = SQL["split_stratified"]
SQL["describe_cuts"] = SQL["describe"]


def _frozen_cut(c: str) -> str:
    """Values at the cut ranks of the training rows, and the part of each value's rows at or below the cut."""
    return f"""{c}_cuts AS (
  SELECT list({c} ORDER BY k) AS v, list(r / m ORDER BY k) AS s FROM (
    SELECT k.k, t.{c}, t.r, t.m FROM (
      SELECT *, row_number() OVER (ORDER BY {c}, customer_id) AS rn, count(*) OVER () AS n,
             row_number() OVER (PARTITION BY {c} ORDER BY customer_id) AS r, count(*) OVER (PARTITION BY {c}) AS m
      FROM tr) t, (SELECT range AS k FROM range(1, 5)) k
    WHERE t.rn = 1 + ((t.n - 1) * k.k) // 5))"""


def _frozen_bin(c: str, cuts: str) -> str:
    u = f"(CAST('0x' || substr(md5('{c}-' || CAST(te.customer_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0)"
    past = [f"CAST({c} > {cuts}.v[{k}] OR ({c} = {cuts}.v[{k}] AND {u} >= {cuts}.s[{k}]) AS BIGINT)" for k in range(1, 5)]
    return f"CAST(1 + {' + '.join(past)} AS BIGINT)"


SQL["rfm_frozen"] = with_ctes(
    BASE, SPLIT,
    "tr AS (SELECT * FROM sp WHERE split = 'train')",
    "te AS (SELECT * FROM sp WHERE split = 'test')",
    "re AS (SELECT quantile_cont(recency_days, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM tr)",
    _frozen_cut("frequency"), _frozen_cut("monetary_value"),
    f"""sco AS (SELECT te.customer_id,
      CAST(5 - CAST(recency_days > re.e[2] AS BIGINT) - CAST(recency_days > re.e[3] AS BIGINT)
             - CAST(recency_days > re.e[4] AS BIGINT) - CAST(recency_days > re.e[5] AS BIGINT) AS BIGINT) AS r_score,
      {_frozen_bin("frequency", "fc")} AS f_score,
      {_frozen_bin("monetary_value", "mc")} AS m_score
    FROM te, re, frequency_cuts fc, monetary_value_cuts mc)""",
) + "SELECT *, CAST(r_score + f_score + m_score AS BIGINT) AS rfm_score FROM sco"

SQL["boxplot_by_churn_cuts"] = SQL["boxplot_by_churn"]
SQL["r_score_cuts"] = SQL["r_score"]

# -- stream, nulls, many groups, flows ---------------------------------------------

SQL["stream_scores"] = FULL + f"""
SELECT customer_id, {r6('churn_probability')} AS churn_probability, churn_predicted, 'rule-v1' AS model_version FROM decided"""


def _null_bin(c: str, out: str) -> str:
    return f"""CASE WHEN {c} IS NOT NULL THEN CAST(greatest(1,
      (5 * (row_number() OVER (PARTITION BY {c} IS NULL ORDER BY {c}, customer_id) - 1) + count({c}) OVER () - 2)
      // (count({c}) OVER () - 1)) AS BIGINT) END AS {out}"""


SQL["rfm_ranks_nulls"] = with_ctes(BASE, ALLC) + f"""
SELECT customer_id, {_null_bin("frequency", "f_score")}, {_null_bin("monetary_value", "m_score")} FROM allc"""


def _box_many(c: str) -> str:
    return f"""SELECT b.grp, '{c}' AS column, {r6('q.q1')} AS q1, {r6('q.q2')} AS median, {r6('q.q3')} AS q3,
  CAST(min({c}) FILTER (WHERE {c} >= q.q1 - 1.5 * (q.q3 - q.q1)) AS DOUBLE) AS whisker_lo,
  CAST(max({c}) FILTER (WHERE {c} <= q.q3 + 1.5 * (q.q3 - q.q1)) AS DOUBLE) AS whisker_hi,
  count(*) FILTER (WHERE {c} < q.q1 - 1.5 * (q.q3 - q.q1) OR {c} > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM g b JOIN (SELECT grp, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2,
                      quantile_cont({c}, 0.75) AS q3 FROM g GROUP BY grp) q ON q.grp IS NOT DISTINCT FROM b.grp
GROUP BY b.grp, q.q1, q.q2, q.q3"""


SQL["boxplot_many_groups"] = with_ctes(
    BASE, "g AS (SELECT *, CASE WHEN customer_id % 97 > 0 THEN customer_id % 97 END AS grp FROM base)"
) + "\nUNION ALL\n".join(_box_many(c) for c in ("monetary_value", "total_orders"))

SQL["csv_roundtrip"] = FULL + f"""
SELECT customer_id, {r6('churn_probability')} AS churn_probability, churn_predicted, 'rule-v1' AS model_version,
       churned AS churn_actual FROM decided"""

SQL["materialize_reuse"] = with_ctes(BASE, RATIOS) + """
SELECT customer_id, monetary_per_order, false AS first_hit, true AS second_hit FROM feat"""

SQL["flow_infer"] = with_ctes(BASE) + """
SELECT customer_id, 'churn-v1' AS model_version, true AS decision_ok, 1 AS stamps, (SELECT count(*) FROM base) AS record_count
FROM base"""

SQL["flow_train_gate"] = """
SELECT * FROM (VALUES ('closed', false, NULL), ('open0', true, 1), ('open1', true, 2)) AS t(gate, passed, version)"""

# the rows of the stratified test split
_TEST = f"""te AS (
  SELECT customer_id, churned FROM (
    SELECT customer_id, churned, row_number() OVER (PARTITION BY churned ORDER BY {HASH}, customer_id) AS rn,
           count(*) OVER (PARTITION BY churned) AS n FROM base)
  WHERE rn <= floor(0.2 * n + 0.5)
)"""
SQL["model_scores_checked"] = with_ctes(BASE, _TEST) + """
SELECT customer_id, churned, true AS decision_ok, kind FROM te, (VALUES ('lr'), ('rf'), ('gbt')) AS k(kind)"""

_F13 = FEATS + ["recency_frequency_ratio", "monetary_per_order", "order_frequency", "support_per_order", "rfm_score"]
_F13_ROWS = ", ".join(f"('{f}')" for f in _F13)
SQL["lr_gradient_checked"] = f"SELECT feature, true AS vanishes FROM (VALUES {_F13_ROWS}) AS t(feature)"
SQL["importance_checked"] = f"SELECT feature, true AS not_negative, true AS sums_to_one FROM (VALUES {_F13_ROWS}) AS t(feature)"

# the fold of each row, stratified over the rows of a table
def _folds(table: str) -> str:
    return f"""fo AS (
  SELECT customer_id, churned, CAST(CAST(rn > n // 5 AS BIGINT) + CAST(rn > n * 2 // 5 AS BIGINT) + CAST(rn > n * 3 // 5 AS BIGINT)
                                    + CAST(rn > n * 4 // 5 AS BIGINT) AS BIGINT) AS fold
  FROM (SELECT customer_id, churned, count(*) OVER (PARTITION BY churned) AS n,
               row_number() OVER (PARTITION BY churned ORDER BY {HASH}, customer_id) AS rn FROM {table}))"""


_PER_FOLD = "SELECT fold, count(*) AS n, count(*) FILTER (WHERE churned = 1) AS positives FROM fo GROUP BY fold"
SQL["cv_checked"] = with_ctes(BASE, _folds("base")) + f"SELECT *, true AS accuracy_ok FROM ({_PER_FOLD})"
_TRAIN = _TEST.replace("te AS", "tn AS").replace("rn <=", "rn >")
SQL["grid_checked"] = with_ctes(BASE, _TRAIN, _folds("tn")) + f"""
SELECT CAST(row_number() OVER (PARTITION BY fold ORDER BY t, d, m) - 1 AS BIGINT) AS setting_id,
       'maxDepth=' || d || ',minInstancesPerNode=' || m || ',numTrees=' || t AS setting,
       fold, n, positives, true AS mean_ok, true AS std_ok, true AS decided_ok
FROM ({_PER_FOLD}), (VALUES (100), (200)) AS a(t), (VALUES (5), (10), (15)) AS b(d), (VALUES (1), (5), (10)) AS c(m)"""
SQL["compare_checked"] = with_ctes(BASE, _TEST) + """
SELECT run_name, CAST(o AS BIGINT) AS "order", (SELECT count(*) FROM te) AS n,
       (SELECT count(*) FROM te WHERE churned = 1) AS positives, true AS accuracy_ok
FROM (VALUES ('logistic_regression', 0), ('random_forest', 1), ('gradient_boosting', 2)) AS r(run_name, o)"""
SQL["cv_band"] = with_ctes(BASE, RATIOS, RFM, RULE, _folds("base")) + f"""
SELECT {r6('m')} AS mean, {r6('s')} AS std, {r6('m - 2 * s')} AS low, {r6('m + 2 * s')} AS high FROM (
  SELECT avg(a) AS m, stddev_pop(a) AS s FROM (
    SELECT fold, avg(CAST(d.churned = d.churn_predicted AS DOUBLE)) AS a FROM decided d JOIN fo USING (customer_id) GROUP BY fold))"""


# -- kept runs, rebuilds, new customers, odd values -----------------------------------

_METHOD = "CASE WHEN run_name LIKE 'rule%' THEN 'auto' ELSE 'manual' END"
SQL["runs_history"] = RUNS_FULL + f"""
SELECT run_name, f1, accuracy,
       CASE WHEN run_name LIKE 'rule%' THEN 'rule' WHEN run_name = 'rfm_low' THEN 'rfm' WHEN run_name = 'never' THEN 'constant' ELSE 'logistic' END AS model,
       {_METHOD} AS logging_method, CASE WHEN run_name LIKE 'rule%' THEN '2000-08-03' ELSE '2000-08-02' END AS run_date
FROM rt WHERE f1 > 0 ORDER BY f1 DESC, run_name LIMIT 10"""
SQL["runs_by_tag"] = RUNS_FULL + f"""
SELECT logging_method, count(*) AS runs, max(f1) AS best_f1, arg_min(run_name, (-f1, run_name)) AS best_run
FROM (SELECT *, {_METHOD} AS logging_method FROM rt) GROUP BY logging_method"""


def _asset_rows(run: int, tickets: int, over: str, rebuilt: str) -> str:
    watch = f"SELECT count(*) FROM base WHERE monetary_value > {over} AND support_tickets > {tickets}"
    counts = {"spend": "SELECT count(*) FROM base", "busy": f"SELECT count(*) FROM base WHERE support_tickets > {tickets}",
              "large": f"SELECT count(*) FROM base WHERE monetary_value > {over}", "watch": watch}
    return "\nUNION ALL\n".join(
        f"SELECT CAST({run} AS BIGINT) AS run, '{a}' AS asset, {str(a in rebuilt.split()).lower()} AS rebuilt, ({c}) AS n_rows"
        for a, c in counts.items())


SQL["rebuild_changed"] = with_ctes(BASE) + "\nUNION ALL\n".join([
    _asset_rows(1, 0, "1e5", "spend busy large watch"), _asset_rows(2, 0, "1e5", ""),
    _asset_rows(3, 1, "1e5", "busy watch"), _asset_rows(4, 1, "2e5", "large watch")])

SQL["stream_new_customers"] = with_ctes(BASE, SPLIT) + """
SELECT customer_id, 'churn-v1' AS model_version, 1 AS times, true AS decision_ok,
       CAST(CASE WHEN split = 'train' THEN 1 ELSE 2 END AS BIGINT) AS first_delivery FROM sp"""

ODD = """odd AS (SELECT *, CASE WHEN frequency = 0 THEN 'Infinity'::DOUBLE WHEN support_tickets >= 2 THEN 'NaN'::DOUBLE
  WHEN total_orders <= 8 THEN '-Infinity'::DOUBLE ELSE monetary_value END AS odd FROM base)"""


def _odd_quantile(p: float) -> str:
    """The interpolated quantile of the ordered values (NaN last)."""
    at = f"(SELECT {p} * (count(*) - 1) FROM odd)"
    pick = "(SELECT odd FROM r WHERE rn = {}({}) + 1)"
    lo, hi = pick.format("floor", at), pick.format("ceil", at)
    x = f"CASE WHEN floor({at}) = ceil({at}) THEN {lo} ELSE (ceil({at}) - {at}) * {lo} + ({at} - floor({at})) * {hi} END"
    return f"CASE WHEN isfinite({x}) THEN CAST({r6(x)} AS VARCHAR) WHEN isnan({x}) THEN 'NaN' WHEN {x} > 0 THEN 'Infinity' ELSE '-Infinity' END"


SQL["describe_nonfinite"] = with_ctes(BASE, ODD, "r AS (SELECT odd, row_number() OVER (ORDER BY odd) AS rn FROM odd)") + f"""
SELECT 'odd' AS column, count(odd) AS count, true AS mean_nan, isnan(max(odd)) AS max_nan, min(odd) = '-Infinity'::DOUBLE AS min_infinite,
       {_odd_quantile(0.25)} AS p25, {_odd_quantile(0.5)} AS p50 FROM odd"""
SQL["rfm_ranks_nonfinite"] = with_ctes(BASE, ODD) + """
SELECT customer_id, CAST(greatest(1, (5 * (row_number() OVER (ORDER BY odd, customer_id) - 1) + count(*) OVER () - 2)
                                     // (count(*) OVER () - 1)) AS BIGINT) AS bin FROM odd"""
SQL["rule_score_constant"] = FULL + f"""
SELECT customer_id, {r6("1.0 / (1.0 + exp(-(1.8 * ((recency_days - mr) / sr) - 1.5 * ((frequency - mf) / sf) - 1.0 * ((monetary_value - mm) / sm))))")}
         AS churn_probability, true AS frozen_agrees
FROM base, zst"""
SQL["corr_gram"] = with_ctes(BASE, ALLC) + "\nUNION ALL\n".join(
    [f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r6(f'corr({a}, {b})') if a != b else '1.0::DOUBLE'} AS corr FROM allc{' LIMIT 1' if a == b else ''}"
     .replace(" FROM allc LIMIT 1", "") for a in FEATS for b in FEATS]
    + [f"SELECT '{a}' AS col_a, 'flat' AS col_b, NULL AS corr UNION ALL SELECT 'flat', '{a}', NULL" for a in FEATS]
    + ["SELECT 'flat' AS col_a, 'flat' AS col_b, 1.0::DOUBLE AS corr"])
SQL["clip_truncate"] = with_ctes(BASE) + """
SELECT customer_id, least(greatest(age, 25), 60) AS age_clipped, CAST(trunc(monetary_value / -7) AS BIGINT) AS whole FROM base"""
SQL["wanted_columns"] = with_ctes(BASE) + f"SELECT customer_id, age, frequency, CAST({len(FEATS)} AS BIGINT) AS n_all FROM base"
SQL["read_or_sample"] = with_ctes(BASE) + "SELECT customer_id, recency_days, monetary_value, churned FROM base"
SQL["flow_prepare"] = SQL["rfm_features"]
SQL["flow_profile"] = with_ctes(BASE) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST({i} AS BIGINT) AS position, '{TYPES[c]}' AS dtype, count({c}) AS count, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    "avg(churned) AS churn_rate FROM base" for i, c in enumerate(COLS))
SQL["flow_compare"] = RUNS_FULL + """
SELECT run_name, metric_type, f1, run_name = (SELECT run_name FROM lb ORDER BY f1 DESC, run_name LIMIT 1) AS best FROM lb"""
