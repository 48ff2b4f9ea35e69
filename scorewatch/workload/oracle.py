"""SQL counterparts of the registered queries, runnable by DuckDB on the same tables.

Written from the definitions, with plain windows and exact quantiles, so that
they share no method with the Spark plans.
"""
from __future__ import annotations

from scorewatch.workload import specs


def d(expression: str, name: str) -> str:
    """A double column at six places, by the same arithmetic as on the Spark side."""
    return f"round(round(({expression}) * 1e9) / 1e3) / 1e6 + 0.0 AS {name}"


MART = """
order_lines AS (
  SELECT l_orderkey, sum(l_quantity) AS quantity, round(avg(l_discount), 6) AS discount,
         round(avg(l_tax), 6) AS tax, count(*) AS lines, max(l_linenumber) AS last_line,
         avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r
  FROM lineitem GROUP BY l_orderkey),
mart AS (
  SELECT o_orderkey AS creditaccountid, o_custkey AS customerid,
         strftime(o_orderdate, '%Y-%m') AS score_month, o_orderstatus AS channel,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS source,
         c_mktsegment AS line,
         CASE WHEN o_totalprice >= 6000 THEN o_totalprice / 479909 END AS risk_score,
         CASE WHEN c_nationkey < 12 THEN 'SC001' ELSE 'SC002' END AS scorecard_id,
         CASE WHEN c_acctbal < -900 THEN 1 ELSE 0 END AS is_excluded,
         o_totalprice AS saleamount, CAST(lines AS INTEGER) AS salecount,
         CAST(last_line AS INTEGER) AS mob_pti, c_acctbal AS endingreceivable,
         quantity, discount, tax, lines, c_acctbal AS balance,
         CAST(ntile(10) OVER (PARTITION BY o_orderstatus ORDER BY
           CASE WHEN o_totalprice >= 6000 THEN o_totalprice / 479909 END NULLS FIRST,
           o_orderkey) AS INTEGER) AS score_decile_static
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN order_lines ON o_orderkey = l_orderkey),
outcome AS (
  SELECT o_orderkey AS creditaccountid, strftime(o_orderdate, '%Y-%m') AS score_month,
         CAST(r >= 0.5 AS INTEGER) AS edr30_m3, CAST(r >= 0.6 AS INTEGER) AS edr60_m6,
         CAST(r >= 0.75 AS INTEGER) AS edr90_m9, CAST(r >= 1.0 AS INTEGER) AS co_m12,
         CAST(r >= 0.4 AS INTEGER) AS bad30_m3, CAST(r >= 0.5 AS INTEGER) AS bad60_m6,
         CAST(r >= 0.6 AS INTEGER) AS bad90_m9, CAST(r >= 0.75 AS INTEGER) AS badco_m12,
         CAST(strftime(o_orderdate, '%Y-%m') <= '2001-02' AS INTEGER) AS is_mature_m3,
         CAST(strftime(o_orderdate, '%Y-%m') <= '2000-11' AS INTEGER) AS is_mature_m6,
         CAST(strftime(o_orderdate, '%Y-%m') <= '2000-08' AS INTEGER) AS is_mature_m9,
         CAST(strftime(o_orderdate, '%Y-%m') <= '2000-05' AS INTEGER) AS is_mature_m12
  FROM orders JOIN order_lines ON o_orderkey = l_orderkey)"""

# Monthly report

L1 = MART + """,
static_edges AS (
  SELECT channel, quantile_disc(risk_score, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges
  FROM mart WHERE score_month BETWEEN '1995-01' AND '1996-12' AND risk_score IS NOT NULL
  GROUP BY channel),
deciled AS (
  SELECT mart.*, score_month AS vintage_month,
         CAST(ntile(10) OVER (PARTITION BY score_month, channel
           ORDER BY risk_score NULLS FIRST, creditaccountid) AS INTEGER) AS risk_decile_dyn
  FROM mart),
l1 AS (
  SELECT deciled.*,
    CASE WHEN risk_decile_dyn <= 3 THEN 'Low' WHEN risk_decile_dyn <= 7 THEN 'Medium'
         ELSE 'High' END AS risk_band_dyn,
    CASE WHEN risk_score IS NOT NULL AND edges IS NOT NULL
         THEN CAST(1 + len(list_filter(edges, lambda e: risk_score > e)) AS INTEGER) END
      AS risk_decile_static,
    CASE WHEN endingreceivable <= 0 THEN '0 or less' WHEN endingreceivable <= 500 THEN '0-500'
         WHEN endingreceivable <= 1000 THEN '500-1K' WHEN endingreceivable <= 2500 THEN '1K-2.5K'
         WHEN endingreceivable <= 5000 THEN '2.5K-5K' WHEN endingreceivable > 5000 THEN '5K+' END
      AS receivable_bucket,
    CASE WHEN saleamount <= 50000 THEN '0-50K' WHEN saleamount <= 100000 THEN '50K-100K'
         WHEN saleamount <= 200000 THEN '100K-200K' WHEN saleamount <= 400000 THEN '200K-400K'
         WHEN saleamount > 400000 THEN '400K+' END AS saleamount_bucket,
    CASE WHEN salecount <= 1 THEN '0-1' WHEN salecount <= 3 THEN '2-3' WHEN salecount <= 5 THEN '4-5'
         WHEN salecount > 5 THEN '6+' END AS salecount_bucket,
    CASE WHEN mob_pti <= 2 THEN '0-2' WHEN mob_pti <= 4 THEN '3-4' WHEN mob_pti <= 6 THEN '5-6'
         WHEN mob_pti > 6 THEN '7+' END AS mob_pti_bucket,
    CASE WHEN risk_score IS NULL THEN 1 ELSE 0 END AS dq_missing_flag,
    CASE WHEN risk_score < 0 OR risk_score > 1 THEN 1 ELSE 0 END AS dq_outlier_flag
  FROM deciled LEFT JOIN static_edges USING (channel)),
report_base AS (SELECT * FROM mart WHERE score_month BETWEEN '1995-01' AND '1996-12'),
spine AS (SELECT DISTINCT vintage_month, c.channel FROM l1, (VALUES ('F'),('O'),('P')) c(channel))"""

STANDARD = ", ".join([
    "count(*) AS account_count", d("avg(risk_score)", "avg_risk_score"),
    d("sum(risk_score)", "sum_risk_score"),
    d("sum(endingreceivable)", "total_endingreceivable"),
    d("avg(endingreceivable)", "avg_endingreceivable"), d("sum(saleamount)", "total_saleamount"),
    d("avg(saleamount)", "avg_saleamount"), "CAST(sum(salecount) AS BIGINT) AS total_salecount",
    d("avg(salecount)", "avg_salecount")])

DISTRIBUTION = """
distribution AS (
  SELECT vintage_month, channel, risk_decile_dyn, count(*) AS account_count,
         avg(risk_score) AS avg_risk_score, sum(risk_score) AS sum_risk_score,
         count(*) / sum(count(*)) OVER (PARTITION BY vintage_month, channel) AS share
  FROM l1 GROUP BY vintage_month, channel, risk_decile_dyn)"""


def unpivot(table: str, keys: str, columns, cast: str = "DOUBLE", name: str = "feature_name",
            value: str = "value") -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{c}' AS {name}, CAST({c} AS {cast}) AS {value} FROM {table}"
        for c in columns)


def psi_ctes(prefix: str, ref: str, cur: str, ref_keys: list[str], keys: list[str]) -> str:
    """CTEs ending in ``<prefix>_psi``: index of every current group; values are non-null."""
    rk, k = ", ".join(ref_keys), ", ".join(keys)
    return f"""
{prefix}_edges AS (
  SELECT {rk}, quantile_disc(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges, count(*) AS ref_n
  FROM {ref} GROUP BY {rk}),
{prefix}_refc AS (
  SELECT {rk}, ref_n, len(list_filter(edges, lambda e: value > e)) AS bin, count(*) AS c
  FROM {ref} JOIN {prefix}_edges USING ({rk}) GROUP BY ALL),
{prefix}_curc AS (
  SELECT {k}, len(list_filter(edges, lambda e: value > e)) AS bin, count(*) AS c
  FROM {cur} JOIN {prefix}_edges USING ({rk}) GROUP BY ALL),
{prefix}_stat AS (
  SELECT {k}, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std FROM {cur} GROUP BY {k}),
{prefix}_bins AS (
  SELECT {k}, bin FROM {prefix}_curc
  UNION SELECT {k}, bin FROM {prefix}_stat JOIN {prefix}_refc USING ({rk})),
{prefix}_terms AS (
  SELECT {k}, greatest(coalesce(r.c, 0) / e.ref_n, 0.0001) AS x,
         greatest(coalesce(q.c, 0) / n, 0.0001) AS y
  FROM {prefix}_bins JOIN {prefix}_stat USING ({k}) JOIN {prefix}_edges e USING ({rk})
       LEFT JOIN {prefix}_refc r USING ({rk}, bin) LEFT JOIN {prefix}_curc q USING ({k}, bin)),
{prefix}_psi AS (SELECT {k}, sum((y - x) * ln(y / x)) AS psi FROM {prefix}_terms GROUP BY {k})"""


DRIFT = L1 + """,
ref AS (SELECT channel, risk_score AS value FROM report_base WHERE risk_score IS NOT NULL),
cur AS (SELECT vintage_month, channel, risk_score AS value FROM l1 WHERE risk_score IS NOT NULL),
""" + psi_ctes("s", "ref", "cur", ["channel"], ["vintage_month", "channel"]) + """,
points AS (
  SELECT DISTINCT c.vintage_month, c.channel, v.value FROM (SELECT DISTINCT vintage_month, channel FROM cur) c
  JOIN (SELECT channel, value FROM ref UNION SELECT channel, value FROM cur) v USING (channel)),
ref_cdf AS (SELECT channel, value, sum(count(*)) OVER (PARTITION BY channel ORDER BY value)
              / sum(count(*)) OVER (PARTITION BY channel) AS f FROM ref GROUP BY channel, value),
cur_cdf AS (SELECT vintage_month, channel, value,
              sum(count(*)) OVER (PARTITION BY vintage_month, channel ORDER BY value)
              / sum(count(*)) OVER (PARTITION BY vintage_month, channel) AS f
            FROM cur GROUP BY vintage_month, channel, value),
ks AS (
  SELECT p.vintage_month, p.channel, max(abs(coalesce(a.f, 0) - coalesce(b.f, 0))) AS ks
  FROM points p ASOF LEFT JOIN ref_cdf a ON p.channel = a.channel AND p.value >= a.value
       ASOF LEFT JOIN cur_cdf b ON p.vintage_month = b.vintage_month AND p.channel = b.channel
            AND p.value >= b.value
  GROUP BY p.vintage_month, p.channel),
tails AS (SELECT channel, quantile_disc(value, 0.9) AS p90, quantile_disc(value, 0.95) AS p95
          FROM ref GROUP BY channel),
own AS (SELECT vintage_month, channel, quantile_disc(value, 0.5) AS q50, quantile_disc(value, 0.8) AS q80,
          quantile_disc(value, 0.9) AS q90, quantile_disc(value, 0.95) AS q95
        FROM cur GROUP BY vintage_month, channel),
levels AS (
  SELECT vintage_month, channel, avg(value) AS mean, stddev_samp(value) AS std, any_value(q50) AS q50,
    any_value(q80) AS q80, any_value(q90) AS q90, any_value(q95) AS q95,
    avg(value) FILTER (value >= q90) AS t10, avg(value) FILTER (value >= q95) AS t5,
    avg(CASE WHEN value > p90 THEN 1.0 ELSE 0.0 END) AS a90,
    avg(CASE WHEN value > p95 THEN 1.0 ELSE 0.0 END) AS a95
  FROM cur JOIN own USING (vintage_month, channel) LEFT JOIN tails USING (channel)
  GROUP BY vintage_month, channel),
drift AS (
  SELECT vintage_month, channel, coalesce(mean, 0) AS mean_risk_score, coalesce(std, 0) AS std_risk_score,
    coalesce(psi, 0) AS score_psi, coalesce(ks, 0) AS score_ks, coalesce(q50, 0) AS q50_score,
    coalesce(q80, 0) AS q80_score, coalesce(q90, 0) AS q90_score, coalesce(q95, 0) AS q95_score,
    coalesce(t10, 0) AS mean_top10pct_score, coalesce(t5, 0) AS mean_top5pct_score,
    coalesce(a90, 0) AS pct_accounts_above_p90_baseline,
    coalesce(a95, 0) AS pct_accounts_above_p95_baseline
  FROM spine LEFT JOIN levels USING (vintage_month, channel)
       LEFT JOIN s_psi USING (vintage_month, channel) LEFT JOIN ks USING (vintage_month, channel))"""
DRIFT_COLUMNS = ["mean_risk_score", "std_risk_score", "score_psi", "score_ks", "q50_score", "q80_score",
                 "q90_score", "q95_score", "mean_top10pct_score", "mean_top5pct_score",
                 "pct_accounts_above_p90_baseline", "pct_accounts_above_p95_baseline"]

FEATURE_SPINE = f""",
features AS (SELECT unnest({list(specs.FEATURES)}) AS feature_name),
fspine AS (SELECT vintage_month, channel, feature_name FROM spine, features),
fcur_all AS ({unpivot('l1', 'vintage_month, channel', specs.FEATURES)}),
fref_all AS ({unpivot('report_base', 'channel', specs.FEATURES)})"""

FEATURE_PSI = FEATURE_SPINE + """,
fcur AS (SELECT * FROM fcur_all WHERE value IS NOT NULL),
fref AS (SELECT * FROM fref_all WHERE value IS NOT NULL),
""" + psi_ctes("f", "fref", "fcur", ["channel", "feature_name"],
               ["vintage_month", "channel", "feature_name"]) + """,
fbase AS (SELECT channel, feature_name, avg(value) AS mean, stddev_samp(value) AS std
          FROM fref GROUP BY channel, feature_name),
feature_psi AS (
  SELECT vintage_month, channel, feature_name, coalesce(psi, 0) AS psi,
    coalesce(b.mean, 0) AS baseline_mean, coalesce(c.mean, 0) AS current_mean,
    coalesce(b.std, 0) AS baseline_std, coalesce(c.std, 0) AS current_std
  FROM fspine LEFT JOIN f_psi USING (vintage_month, channel, feature_name)
    LEFT JOIN f_stat c USING (vintage_month, channel, feature_name)
    LEFT JOIN fbase b USING (channel, feature_name))"""

QUALITY = """,
dq AS (
  SELECT vintage_month, channel, coalesce(miss, 0) AS missing_score_rate,
         coalesce(outl, 0) AS outlier_score_rate
  FROM spine LEFT JOIN (
    SELECT vintage_month, channel, avg(dq_missing_flag) AS miss,
           avg(dq_outlier_flag) FILTER (risk_score IS NOT NULL) AS outl
    FROM l1 GROUP BY vintage_month, channel) USING (vintage_month, channel))"""

BOUNDS = """,
fbounds AS (SELECT channel, feature_name, quantile_disc(value, 0.01) AS lo, quantile_disc(value, 0.99) AS hi
            FROM fref_all WHERE value IS NOT NULL GROUP BY channel, feature_name),
feature_quality AS (
  SELECT vintage_month, channel, feature_name, coalesce(miss, 0) AS missing_rate,
    coalesce(outl, 0) AS outlier_rate, coalesce(lo, 0.0) AS outlier_lower_bound,
    coalesce(hi, 1.0) AS outlier_upper_bound
  FROM fspine LEFT JOIN fbounds USING (channel, feature_name) LEFT JOIN (
    SELECT vintage_month, channel, feature_name, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS miss,
      avg(CASE WHEN value < coalesce(lo, 0) OR value > coalesce(hi, 1) THEN 1.0 ELSE 0.0 END)
        FILTER (value IS NOT NULL) AS outl
    FROM fcur_all LEFT JOIN fbounds USING (channel, feature_name)
    GROUP BY vintage_month, channel, feature_name) USING (vintage_month, channel, feature_name))"""


def corr_ctes() -> str:
    pairs_now = " UNION ALL ".join(
        f"SELECT vintage_month, channel, '{c}' AS feature_name, CAST({c} AS DOUBLE) AS x, risk_score AS y "
        f"FROM l1 WHERE {c} IS NOT NULL AND risk_score IS NOT NULL" for c in specs.FEATURES)
    pairs_then = " UNION ALL ".join(
        f"SELECT channel, '{c}' AS feature_name, CAST({c} AS DOUBLE) AS x, risk_score AS y "
        f"FROM report_base WHERE {c} IS NOT NULL AND risk_score IS NOT NULL" for c in specs.FEATURES)
    corr = ("CASE WHEN count(*) >= 2 THEN covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) END")
    return f""",
corr AS (
  SELECT vintage_month, channel, feature_name, b AS baseline_corr, c AS current_corr,
         c - b AS corr_change
  FROM fspine
  LEFT JOIN (SELECT channel, feature_name, {corr} AS b FROM ({pairs_then}) GROUP BY ALL)
    USING (channel, feature_name)
  LEFT JOIN (SELECT vintage_month, channel, feature_name, {corr} AS c FROM ({pairs_now}) GROUP BY ALL)
    USING (vintage_month, channel, feature_name))"""


MIX = f""",
segments AS ({unpivot('l1', 'vintage_month, channel',
                      ['source', 'line', 'receivable_bucket', 'saleamount_bucket'], 'VARCHAR',
                      'segment_type', 'segment_value')}),
mix AS (
  SELECT vintage_month, channel, segment_type, coalesce(segment_value, 'Unknown') AS segment_value,
         count(*) AS account_count,
         count(*) / sum(count(*)) OVER (PARTITION BY vintage_month, channel, segment_type) AS share
  FROM segments GROUP BY vintage_month, channel, segment_type, coalesce(segment_value, 'Unknown'))"""

ACTUALS = """,
v1 AS (
  SELECT l1.*, badco_m12 AS is_bad, edr30_m3 AS edr30, edr60_m6 AS edr60, edr90_m9 AS edr90
  FROM l1 LEFT JOIN outcome o ON l1.creditaccountid = o.creditaccountid
       AND l1.vintage_month = o.score_month),
perf1 AS (
  SELECT vintage_month, channel, count(*) AS account_count, avg(risk_score) AS avg_risk_score,
    avg(is_bad) AS actual_bad_rate, avg(edr30) AS edr30, avg(edr60) AS edr60, avg(edr90) AS edr90,
    avg(is_bad) - avg(risk_score) AS calibration_gap
  FROM v1 GROUP BY vintage_month, channel),
cal1 AS (
  SELECT vintage_month, channel, risk_decile_static AS score_bin, count(*) AS account_count,
    avg(risk_score) AS predicted_rate, avg(is_bad) AS actual_rate,
    avg(is_bad) - avg(risk_score) AS calibration_gap
  FROM v1 GROUP BY ALL)"""

TOP = """,
feature_max AS (
  SELECT vintage_month, feature_name, psi AS max_psi, baseline_mean, current_mean
  FROM feature_psi
  QUALIFY row_number() OVER (PARTITION BY vintage_month, feature_name ORDER BY psi DESC, channel) = 1),
top_features AS (
  SELECT *, row_number() OVER (PARTITION BY vintage_month ORDER BY max_psi DESC, feature_name) AS rank
  FROM feature_max)"""

FLAG_ROWS = """
SELECT vintage_month, CASE WHEN score_psi >= 0.25 THEN 'ALERT' ELSE 'WARN' END AS level,
       'score_psi' AS rule, channel, NULL::VARCHAR AS subject, score_psi AS value
FROM drift WHERE score_psi >= 0.10
UNION ALL SELECT vintage_month, 'WARN', 'score_ks', channel, NULL, score_ks FROM drift WHERE score_ks >= 0.10
UNION ALL SELECT vintage_month, 'WARN', 'pct_accounts_above_p90_baseline', channel, NULL,
  pct_accounts_above_p90_baseline FROM drift WHERE pct_accounts_above_p90_baseline >= 0.15
UNION ALL SELECT vintage_month, 'WARN', 'pct_accounts_above_p95_baseline', channel, NULL,
  pct_accounts_above_p95_baseline FROM drift WHERE pct_accounts_above_p95_baseline >= 0.15
UNION ALL SELECT * FROM (
  SELECT vintage_month, CASE WHEN psi >= 0.25 THEN 'ALERT' ELSE 'WARN' END, 'feature_psi', channel,
    feature_name, psi FROM feature_psi WHERE psi >= 0.10
  QUALIFY row_number() OVER (PARTITION BY vintage_month, feature_name ORDER BY channel) = 1)
UNION ALL SELECT vintage_month, 'WARN', 'missing_score_rate', channel, NULL, missing_score_rate
  FROM dq WHERE missing_score_rate >= 0.01
UNION ALL SELECT vintage_month, 'WARN', 'outlier_score_rate', channel, NULL, outlier_score_rate
  FROM dq WHERE outlier_score_rate >= 0.05
UNION ALL SELECT vintage_month, 'INFO', 'unknown_segment', NULL, segment_type, sum(account_count)
  FROM mix WHERE segment_value = 'Unknown' GROUP BY vintage_month, segment_type"""

DIAGNOSIS_ROWS = """
SELECT vintage_month, CASE WHEN max(score_psi) >= 0.25 THEN 'ALERT' ELSE 'WARN' END AS level,
       'score_shift' AS rule, NULL::VARCHAR AS channel, NULL::VARCHAR AS subject, max(score_psi) AS value
FROM drift GROUP BY vintage_month HAVING max(score_psi) >= 0.10
UNION ALL SELECT vintage_month, 'WARN', 'right_tail', channel, NULL, pct_accounts_above_p90_baseline
  FROM drift WHERE pct_accounts_above_p90_baseline >= 0.15
UNION ALL SELECT vintage_month, 'WARN', 'feature_drift', NULL, feature_name, max_psi
  FROM top_features WHERE rank <= 3 AND max_psi >= 0.10
UNION ALL SELECT vintage_month, 'WARN', 'source_share', NULL, '1-URGENT', max(share) FROM mix
  WHERE segment_type = 'source' AND segment_value = '1-URGENT'
  GROUP BY vintage_month HAVING max(share) < 0.35
UNION ALL SELECT vintage_month, 'WARN', 'calibration_gap', NULL, NULL, max(abs(calibration_gap))
  FROM cal1 GROUP BY vintage_month HAVING max(abs(calibration_gap)) > 0.05
UNION ALL SELECT vintage_month, 'WARN', 'channel_gap', channel,
  CASE WHEN calibration_gap > 0 THEN 'underestimating' ELSE 'overestimating' END, calibration_gap
  FROM perf1 WHERE abs(calibration_gap) > 0.03
UNION ALL SELECT vintage_month, 'WARN', 'missing_score', channel, NULL, missing_score_rate
  FROM dq WHERE missing_score_rate >= 0.01"""


def _check(name: str, value: str, limit: str, strict: bool, source: str) -> str:
    sign = "<" if strict else "<="
    return (f"SELECT '{name}' AS \"check\", {d('v', 'value')}, {d(limit, 'limit')}, v {sign} {limit} AS passed "
            f"FROM (SELECT coalesce(CAST({value} AS DOUBLE), 0.0) AS v FROM {source})")


def checks_sql() -> str:
    nulls = ["creditaccountid", "customerid", "score_month", "risk_score", "channel", *specs.FEATURES,
             *specs.BUSINESS]
    per_group = ("(SELECT vintage_month, channel, count(DISTINCT risk_decile_dyn) AS bins, count(*) AS n_rows, "
                 "sum(share) AS share FROM distribution GROUP BY ALL)")
    l2 = ("(SELECT vintage_month, channel, count(*) AS n, avg(risk_score) AS a FROM l1 GROUP BY ALL)")
    mix = ("(SELECT vintage_month, channel, segment_type, sum(share) AS share, sum(account_count) AS n_mix "
           "FROM mix GROUP BY ALL)")

    def matched(name: str, key: str) -> str:
        inner = (f"(SELECT vintage_month, channel, sum(c) AS c FROM (SELECT vintage_month, channel, {key}, "
                 f"count(*) AS c FROM l1 GROUP BY ALL) GROUP BY ALL)")
        return _check(f"{name}_accounts_match", "max(abs(n - c))", "0.0", False,
                      f"{l2} JOIN {inner} USING (vintage_month, channel)")

    absent = "3 - count(DISTINCT channel) FILTER (channel IN ('F', 'O', 'P'))"
    rows = [
        _check("account_rows_match_source",
               "abs((SELECT count(*) FROM l1) - (SELECT count(*) FROM orders))", "0.0", False, "(SELECT 1)"),
        _check("duplicate_account_keys", "count(*)", "0.0", False,
               "(SELECT creditaccountid, vintage_month FROM l1 GROUP BY ALL HAVING count(*) > 1)"),
        _check("vintage_month_missing", "count(*)", "0.0", False,
               "(SELECT * FROM l1 WHERE vintage_month IS NULL)"),
        _check("channels_absent", "3 - count(DISTINCT channel) FILTER (channel IN ('F','O','P'))", "0.0",
               False, "l1"),
        _check("largest_null_share", "greatest(" + ", ".join(
            f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in nulls) + ")", "0.05", True, "l1"),
        matched("overall_summary", "1"), matched("by_source", "source"), matched("by_line", "line"),
        _check("summary_average_matches_accounts", "max(abs(a - b))", "0.0001", True,
               f"{l2} JOIN (SELECT vintage_month, channel, sum(risk_score) / count(risk_score) AS b FROM l1 "
               "GROUP BY ALL) USING (vintage_month, channel)"),
        _check("groups_without_all_deciles", "count(*) FILTER (bins <> 10)", "0.0", False, per_group),
        _check("duplicate_decile_rows", "sum(n_rows - bins)", "0.0", False, per_group),
        _check("decile_shares_sum_to_one", "round(max(abs(share - 1)), 9)", "1e-9", False, per_group),
        _check("duplicate_drift_rows", "count(*)", "0.0", False,
               "(SELECT vintage_month, channel FROM drift GROUP BY ALL HAVING count(*) > 1)"),
        _check("negative_psi_or_ks", "count(*)", "0.0", False,
               "(SELECT * FROM drift WHERE score_psi < 0 OR score_ks < 0)"),
        _check("largest_score_psi", "max(score_psi)", "0.25", True, "drift"),
        _check("drift_mean_matches_summary", "max(abs(mean_risk_score - a))", "0.001", True,
               f"drift JOIN {l2} USING (vintage_month, channel)"),
        _check("largest_missing_score_rate", "max(missing_score_rate)", "0.01", True, "dq"),
        _check("data_quality_rates_out_of_bounds", "count(*)", "0.0", False,
               "(SELECT * FROM dq WHERE missing_score_rate NOT BETWEEN 0 AND 1 "
               "OR outlier_score_rate NOT BETWEEN 0 AND 1)"),
        _check("feature_quality_rates_out_of_bounds", "count(*)", "0.0", False,
               "(SELECT * FROM feature_quality WHERE missing_rate NOT BETWEEN 0 AND 1 "
               "OR outlier_rate NOT BETWEEN 0 AND 1)"),
        *[_check(f"{name}_groups_incomplete", "count(*)", "0.0", False,
                 f"(SELECT vintage_month, channel FROM {t} GROUP BY ALL HAVING count(*) <> 5)")
          for name, t in (("feature_psi", "feature_psi"), ("feature_quality", "feature_quality"),
                          ("feature_score_relationship", "corr"))],
        _check("duplicate_data_quality_rows", "count(*)", "0.0", False,
               "(SELECT vintage_month, channel FROM dq GROUP BY ALL HAVING count(*) > 1)"),
        _check("segment_types_absent", f"{len(specs.DRIFT.segments)} - count(DISTINCT segment_type)", "0.0", False, "mix"),
        _check("business_channels_absent", absent, "0.0", False, "l1"),
        _check("monitoring_channels_absent", "max(n)", "0.0", False, "(" + " UNION ALL ".join(
            f"SELECT {absent} AS n FROM {t}" for t in ("drift", "dq", "feature_quality", "feature_psi", "mix", "corr"))
            + ")"),
        _check("bucket_tables_empty", "sum(CASE WHEN n = 0 THEN 1 ELSE 0 END)", "0.0", False, "(" + " UNION ALL ".join(
            f"SELECT count({b.name}) AS n FROM l1" for b in specs.ENRICHMENT.buckets) + ")"),
        _check("mix_shares_sum_to_one", "round(max(abs(share - 1)), 9)", "1e-9", False, mix),
        _check("mix_accounts_match_summary", "max(abs(n_mix - n))", "0.0", False,
               f"{mix} JOIN {l2} USING (vintage_month, channel)"),
    ]
    return (f"WITH {DRIFT}, {DISTRIBUTION} {FEATURE_PSI} {QUALITY} {BOUNDS} {MIX} {corr_ctes()} "
            + " UNION ALL ".join(rows))


def report_sql() -> dict[str, str]:
    with_l1 = f"WITH {L1} "
    flag = f"{d('value', 'value')}"
    out = {
        "score_distribution": f"WITH {L1}, {DISTRIBUTION} SELECT vintage_month, channel, risk_decile_dyn, "
        f"account_count, {d('avg_risk_score', 'avg_risk_score')}, {d('sum_risk_score', 'sum_risk_score')}, "
        f"{d('share', 'pct_of_channel_vintage_accounts')} FROM distribution",
        "dynamic_deciles": with_l1 + "SELECT creditaccountid, vintage_month AS month, channel, "
        "risk_decile_dyn, risk_band_dyn FROM l1",
        "static_deciles": with_l1 + "SELECT creditaccountid, vintage_month AS month, channel, "
        "risk_decile_static FROM l1",
        "buckets": with_l1 + "SELECT creditaccountid, receivable_bucket, saleamount_bucket, "
        "salecount_bucket, mob_pti_bucket FROM l1",
        "dq_flags": with_l1 + "SELECT creditaccountid, dq_missing_flag, dq_outlier_flag FROM l1",
        "enriched_accounts": with_l1 + "SELECT creditaccountid, customerid, channel, source, line, "
        + ", ".join(d(c, c) for c in ["risk_score", "saleamount", "endingreceivable", "quantity", "discount",
                                      "tax", "balance"])
        + ", scorecard_id, is_excluded AS is_excluded_from_monitoring, salecount, mob_pti, lines, "
        "vintage_month AS month, '2001-05' AS score_month, 'v1.0' AS model_version, vintage_month, "
        "risk_decile_dyn, risk_band_dyn, risk_decile_static, receivable_bucket, saleamount_bucket, "
        "salecount_bucket, mob_pti_bucket, dq_missing_flag, dq_outlier_flag FROM l1",
        "overall_summary": with_l1 + f"SELECT vintage_month, channel, {STANDARD} FROM l1 GROUP BY ALL",
        "band_shares": f"WITH {L1}, {DISTRIBUTION} SELECT vintage_month, channel, "
        + ", ".join(d(f"coalesce(sum(share) FILTER ({c}), 0)", n) for n, c in (
            ("low_share", "risk_decile_dyn <= 3"), ("medium_share", "risk_decile_dyn BETWEEN 4 AND 7"),
            ("high_share", "risk_decile_dyn >= 8"))) + " FROM distribution GROUP BY ALL",
        "channel_profile": f"WITH {MART} SELECT score_month AS month, channel, count(*) AS account_count, "
        + ", ".join(d(f"{f}(risk_score)", n) for f, n in (
            ("avg", "mean_score"), ("stddev_samp", "std_score"), ("min", "min_score"), ("max", "max_score")))
        + " FROM mart GROUP BY ALL",
        "period_mix": f"WITH {MART}, both_periods AS (SELECT 'current' AS period, source FROM mart UNION ALL "
        "SELECT 'baseline', source FROM mart WHERE score_month BETWEEN '1995-01' AND '1996-12') "
        "SELECT period, source, count(*) AS account_count, "
        + d("count(*) / sum(count(*)) OVER (PARTITION BY period)", "share")
        + " FROM both_periods GROUP BY period, source",
        "score_drift": f"WITH {DRIFT} SELECT vintage_month, channel, "
        + ", ".join(d(c, c) for c in DRIFT_COLUMNS) + " FROM drift",
        "feature_psi": with_l1 + FEATURE_PSI + "SELECT vintage_month, channel, feature_name, "
        + ", ".join(d(c, c) for c in ("psi", "baseline_mean", "current_mean", "baseline_std",
                                      "current_std")) + " FROM feature_psi",
        "data_quality": with_l1 + QUALITY + "SELECT vintage_month, channel, "
        + ", ".join(d(c, c) for c in ("missing_score_rate", "outlier_score_rate")) + " FROM dq",
        "feature_quality": with_l1 + FEATURE_SPINE + BOUNDS + "SELECT vintage_month, channel, feature_name, "
        + ", ".join(d(c, c) for c in ("missing_rate", "outlier_rate", "outlier_lower_bound",
                                      "outlier_upper_bound")) + " FROM feature_quality",
        "feature_score_corr": with_l1 + FEATURE_SPINE + corr_ctes()
        + "SELECT vintage_month, channel, feature_name, "
        + ", ".join(d(c, c) for c in ("baseline_corr", "current_corr", "corr_change")) + " FROM corr",
        "population_mix": with_l1 + MIX + "SELECT vintage_month, channel, segment_type, segment_value, "
        f"account_count, {d('share', 'pct_of_channel_accounts')} FROM mix",
        "performance_v1": with_l1 + ACTUALS + "SELECT vintage_month, channel, account_count, "
        + ", ".join(d(c, c) for c in ("avg_risk_score", "actual_bad_rate", "edr30", "edr60", "edr90",
                                      "calibration_gap"))
        + ", " + d("avg_risk_score", "predicted_bad_rate") + " FROM perf1",
        "calibration_v1": with_l1 + ACTUALS + "SELECT vintage_month, channel, score_bin, account_count, "
        + ", ".join(d(c, c) for c in ("predicted_rate", "actual_rate", "calibration_gap")) + " FROM cal1",
        "drift_trend": f"WITH {DRIFT} SELECT channel, vintage_month, {d('mean_risk_score', 'mean_score')}, "
        f"{d('score_psi', 'score_psi')}, "
        + ", ".join(d(f"{c} - lag({c}) OVER (PARTITION BY channel ORDER BY vintage_month)", n)
                    for c, n in (("mean_risk_score", "mean_change"), ("score_psi", "psi_change")))
        + " FROM drift",
        "top_features": with_l1 + FEATURE_PSI + TOP + "SELECT vintage_month, feature_name, "
        + ", ".join(d(c, c) for c in ("max_psi", "baseline_mean", "current_mean")) + ", "
        + d("current_mean - baseline_mean", "mean_shift") + ", CASE WHEN max_psi >= 0.25 THEN 'ALERT' "
        "WHEN max_psi >= 0.10 THEN 'WARNING' ELSE 'OK' END AS level, CAST(rank AS INTEGER) AS rank "
        "FROM top_features WHERE rank <= 5",
        "leading_features": with_l1 + FEATURE_PSI + TOP + "SELECT vintage_month, feature_name, "
        + d("max_psi", "max_psi") + ", CASE WHEN max_psi >= 0.25 THEN 'ALERT' "
        "WHEN max_psi >= 0.10 THEN 'WARNING' ELSE 'OK' END AS level, CAST(rank AS INTEGER) AS rank "
        "FROM top_features WHERE rank <= 2",
        "top_features_by_channel": with_l1 + FEATURE_PSI + "SELECT vintage_month, channel, "
        "CAST(row_number() OVER (PARTITION BY vintage_month, channel ORDER BY psi DESC, feature_name) "
        f"AS INTEGER) AS rank, feature_name, {d('psi', 'psi')} FROM feature_psi "
        "QUALIFY rank <= 5",
        "top_corr_changes": with_l1 + FEATURE_SPINE + corr_ctes() + "SELECT vintage_month, "
        "CAST(row_number() OVER (PARTITION BY vintage_month ORDER BY abs(corr_change) DESC, channel, "
        "feature_name) AS INTEGER) AS rank, channel, feature_name, " + d("corr_change", "corr_change")
        + " FROM corr WHERE corr_change IS NOT NULL QUALIFY rank <= 5",
        "flags_v1": f"WITH {DRIFT} {FEATURE_PSI} {QUALITY} {MIX} SELECT vintage_month, level, rule, channel, "
        f"subject, {flag} FROM ({FLAG_ROWS})",
        "health_v1": f"WITH {DRIFT} {FEATURE_PSI} {ACTUALS}, worst AS (SELECT vintage_month, s, f, "
        "coalesce(g, 0) AS g FROM (SELECT vintage_month, max(score_psi) AS s FROM drift GROUP BY 1) "
        "LEFT JOIN (SELECT vintage_month, max(psi) AS f FROM feature_psi GROUP BY 1) USING (vintage_month) "
        "LEFT JOIN (SELECT vintage_month, max(abs(calibration_gap)) AS g FROM cal1 GROUP BY 1) "
        f"USING (vintage_month)) SELECT vintage_month, {d('s', 'max_score_psi')}, "
        f"{d('f', 'max_feature_psi')}, {d('g', 'max_calibration_gap')}, "
        "CASE WHEN greatest(s, f) >= 0.25 THEN 'ALERT' WHEN greatest(s, f) >= 0.10 OR g > 0.05 "
        "THEN 'WARNING' ELSE 'STABLE' END AS health FROM worst",
        "diagnosis_v1": f"WITH {DRIFT} {FEATURE_PSI} {TOP} {QUALITY} {MIX} {ACTUALS}, "
        f"found AS ({DIAGNOSIS_ROWS}) SELECT vintage_month, level, rule, channel, subject, {flag} FROM found "
        "UNION ALL SELECT DISTINCT vintage_month, 'INFO', 'no_issues', NULL, NULL, NULL FROM drift "
        "WHERE vintage_month NOT IN (SELECT vintage_month FROM found)",
        "checks": checks_sql(),
        "latest_vintage": with_l1 + f"SELECT vintage_month, channel, {STANDARD} FROM l1 "
        "WHERE vintage_month = (SELECT max(vintage_month) FROM l1) GROUP BY ALL",
    }
    for name in ("source", "line", "receivable_bucket", "saleamount_bucket", "salecount_bucket",
                 "mob_pti_bucket"):
        out[f"by_{name}"] = (with_l1
                             + f"SELECT vintage_month, channel, {name}, {STANDARD} FROM l1 GROUP BY ALL")
    return out


def oracle_queries() -> dict[str, str]:
    from scorewatch.workload.oracle_monitoring import monitoring_sql
    return report_sql() | monitoring_sql()
