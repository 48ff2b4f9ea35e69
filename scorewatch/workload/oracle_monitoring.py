"""SQL counterparts of the running-month monitoring queries."""
from __future__ import annotations

from scorewatch.workload import specs
from scorewatch.workload.oracle import MART, d, psi_ctes, unpivot

FEATURES = list(specs.FEATURES)


def shift(month: str, months: str) -> str:
    return f"strftime(strptime({month} || '-01', '%Y-%m-%d') + to_months({months}), '%Y-%m')"


def by_card(table: str) -> str:
    return (f"(SELECT 'overall' AS scorecard, * FROM {table} "
            f"UNION ALL SELECT scorecard_id AS scorecard, * FROM {table})")


def by_scope(table: str) -> str:
    cards = by_card(table)
    return (f"(SELECT * REPLACE ('all' AS channel) FROM {cards} "
            f"UNION ALL SELECT * FROM {cards} WHERE channel IN ('F', 'O', 'P'))")


WINDOWS = [("M3", 3, "edr30_m3", "bad30_m3", "is_mature_m3", "EDR30"),
           ("M6", 6, "edr60_m6", "bad60_m6", "is_mature_m6", "EDR60"),
           ("M9", 9, "edr90_m9", "bad90_m9", "is_mature_m9", "EDR90"),
           ("M12", 12, "co_m12", "badco_m12", "is_mature_m12", "CO")]
OUTCOME_LONG = " UNION ALL ".join(
    f"SELECT creditaccountid, score_month, '{m}' AS maturity, {k} AS back, {e} AS edr, {b} AS bad, "
    f"{f} AS mature FROM outcome" for m, k, e, b, f, _ in WINDOWS)

BASE = MART + f""",
live AS (SELECT * FROM mart WHERE is_excluded = 0),
months AS (SELECT DISTINCT score_month AS reporting_month FROM mart),
cur AS (SELECT *, score_month AS reporting_month FROM live),
base AS (SELECT * FROM live WHERE score_month BETWEEN '1996-01' AND '1996-12'),
roll AS (SELECT * FROM (SELECT live.*, {shift('score_month', 'k')} AS reporting_month
         FROM live, range(1, 4) t(k)) WHERE reporting_month IN (SELECT reporting_month FROM months)),
outcome_long AS ({OUTCOME_LONG}),
cohort AS (SELECT * FROM (
    SELECT live.*, maturity, edr, bad, {shift('score_month', 'back')} AS reporting_month
    FROM live JOIN outcome_long USING (creditaccountid, score_month) WHERE mature = 1)
  WHERE reporting_month IN (SELECT reporting_month FROM months)),
base_cohort AS (SELECT base.*, maturity, edr, bad
  FROM base JOIN outcome_long USING (creditaccountid, score_month) WHERE mature = 1),
info AS (
  SELECT reporting_month, maturity, score_month, scored AS account_count,
         coalesce(mature, 0) AS mature_count, coalesce(mature, 0) > 0 AS available,
         CASE WHEN coalesce(mature, 0) = 0 THEN 'No mature accounts available yet' ELSE '' END AS note
  FROM (SELECT {shift('score_month', 'back')} AS reporting_month, maturity, score_month, count(*) AS scored
        FROM live, (VALUES ('M3', 3), ('M6', 6), ('M9', 9), ('M12', 12)) w(maturity, back)
        GROUP BY ALL)
  LEFT JOIN (SELECT reporting_month, maturity, count(*) AS mature FROM cohort GROUP BY ALL)
    USING (reporting_month, maturity)
  WHERE reporting_month IN (SELECT reporting_month FROM months))"""


def status(value: str, warning: str, alert: str, lower: bool = False) -> str:
    sign = "<=" if lower else ">="
    return (f"CASE WHEN {value} IS NULL THEN 'N/A' WHEN {value} {sign} {alert} THEN 'ALERT' "
            f"WHEN {value} {sign} {warning} THEN 'WARNING' ELSE 'OK' END")


# Stability

# Every configured channel of a month and scorecard, with its accounts if there are any.
LISTED = """(SELECT * FROM (SELECT DISTINCT reporting_month, scorecard FROM cs),
    (VALUES ('all'), ('F'), ('O'), ('P')) v(channel))
  LEFT JOIN (SELECT reporting_month, scorecard, channel, count(*) AS account_count FROM cs GROUP BY ALL)
    USING (reporting_month, scorecard, channel)"""

SCORE_STABILITY = f""",
cs AS (SELECT reporting_month, scorecard, channel, risk_score AS value FROM {by_scope('cur')}),
ss_cur AS (SELECT * FROM cs WHERE value IS NOT NULL),
ss_ref AS (SELECT scorecard, channel, risk_score AS value FROM {by_scope('base')} WHERE risk_score IS NOT NULL),
""" + psi_ctes("ss", "ss_ref", "ss_cur", ["scorecard", "channel"],
               ["reporting_month", "scorecard", "channel"]) + f""",
stability AS (
  SELECT reporting_month, scorecard, channel, coalesce(psi, 0) AS score_psi, coalesce(mean, 0) AS mean_score,
         coalesce(std, 0) AS std_score, coalesce(account_count, 0) AS account_count
  FROM {LISTED}
  LEFT JOIN ss_stat USING (reporting_month, scorecard, channel)
  LEFT JOIN ss_psi USING (reporting_month, scorecard, channel)),
judged_stability AS (
  SELECT *, CASE WHEN scorecard = 'SC001' THEN 0.12 ELSE 0.08 END AS warning,
         CASE WHEN scorecard = 'SC001' THEN 0.30 ELSE 0.20 END AS alert FROM stability)"""

FEATURE_STABILITY = f""",
fs_cur AS (SELECT * FROM ({unpivot(by_card('cur'), 'reporting_month, scorecard', FEATURES)})
           WHERE value IS NOT NULL),
fs_ref AS (SELECT * FROM ({unpivot(by_card('base'), 'scorecard', FEATURES)}) WHERE value IS NOT NULL),
""" + psi_ctes("fs", "fs_ref", "fs_cur", ["scorecard", "feature_name"],
               ["reporting_month", "scorecard", "feature_name"]) + """,
fstability AS (
  SELECT reporting_month, scorecard, feature_name, coalesce(psi, 0) AS psi, b.mean AS baseline_mean,
         c.mean AS current_mean, c.mean - b.mean AS mean_shift
  FROM fs_stat c LEFT JOIN fs_psi USING (reporting_month, scorecard, feature_name)
  LEFT JOIN (SELECT scorecard, feature_name, avg(value) AS mean FROM fs_ref GROUP BY ALL) b
    USING (scorecard, feature_name))"""


def interval_case(column: str) -> str:
    cases = [f"WHEN {column} >= {i / 10} AND {column} {'<=' if i == 9 else '<'} {(i + 1) / 10} THEN {i}"
             for i in range(10)]
    return "CASE " + " ".join(cases) + " END"


PSI_TABLE = f""",
pt_cur AS (SELECT reporting_month, scorecard, {interval_case('risk_score')} AS bin FROM {by_card('cur')}
           WHERE risk_score IS NOT NULL),
pt_ref AS (SELECT scorecard, {interval_case('risk_score')} AS bin FROM {by_card('base')}
           WHERE risk_score IS NOT NULL),
pt AS (
  SELECT g.reporting_month, g.scorecard, i AS bin, i / 10 AS min_score, (i + 1) / 10 AS max_score,
         coalesce(r.c, 0) AS baseline_count, coalesce(q.c, 0) AS compare_count,
         greatest(coalesce(r.c, 0) / rn, 0.0001) AS baseline_pct,
         greatest(coalesce(q.c, 0) / qn, 0.0001) AS compare_pct
  FROM (SELECT reporting_month, scorecard, count(*) AS qn FROM pt_cur GROUP BY ALL) g
  JOIN (SELECT scorecard, count(*) AS rn FROM pt_ref GROUP BY ALL) USING (scorecard), range(10) t(i)
  LEFT JOIN (SELECT scorecard, bin, count(*) AS c FROM pt_ref GROUP BY ALL) r
    ON r.scorecard = g.scorecard AND r.bin = i
  LEFT JOIN (SELECT reporting_month, scorecard, bin, count(*) AS c FROM pt_cur GROUP BY ALL) q
    ON q.reporting_month = g.reporting_month AND q.scorecard = g.scorecard AND q.bin = i)"""

CSI_TABLE = f""",
ct_cur AS (SELECT * FROM ({unpivot(by_card('cur'), 'reporting_month, scorecard', FEATURES, name='feature')})
           WHERE value IS NOT NULL),
ct_ref AS (SELECT * FROM ({unpivot(by_card('base'), 'scorecard', FEATURES, name='feature')})
           WHERE value IS NOT NULL),
ct_edges AS (SELECT scorecard, feature, count(*) AS rn, min(value) AS rlo, max(value) AS rhi,
    list_sort(list_distinct(quantile_disc(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]))) AS edges
  FROM ct_ref GROUP BY ALL),
ct_group AS (
  SELECT reporting_month, scorecard, feature, qn, rn, edges,
    list_concat([least(rlo, lo)], list_concat(edges, [greatest(rhi, hi)])) AS bounds
  FROM (SELECT reporting_month, scorecard, feature, count(*) AS qn, min(value) AS lo, max(value) AS hi
        FROM ct_cur GROUP BY ALL) JOIN ct_edges USING (scorecard, feature)),
ct_r AS (SELECT scorecard, feature, len(list_filter(edges, lambda e: value >= e)) AS bin, count(*) AS c
         FROM ct_ref JOIN ct_edges USING (scorecard, feature) GROUP BY ALL),
ct_q AS (SELECT reporting_month, scorecard, feature, len(list_filter(edges, lambda e: value >= e)) AS bin,
           count(*) AS c FROM ct_cur JOIN ct_edges USING (scorecard, feature) GROUP BY ALL),
ct AS (
  SELECT g.reporting_month, g.scorecard, g.feature, CAST(i AS INTEGER) AS bin_index,
    bounds[i + 1] AS min_value, bounds[i + 2] AS max_value, coalesce(r.c, 0) AS baseline_count,
    coalesce(q.c, 0) AS compare_count, greatest(coalesce(r.c, 0) / rn, 0.0001) AS baseline_pct,
    greatest(coalesce(q.c, 0) / qn, 0.0001) AS compare_pct
  FROM (SELECT *, unnest(range(len(edges) + 1)) AS i FROM ct_group) g
  LEFT JOIN ct_r r ON r.scorecard = g.scorecard AND r.feature = g.feature AND r.bin = i
  LEFT JOIN ct_q q ON q.reporting_month = g.reporting_month AND q.scorecard = g.scorecard
    AND q.feature = g.feature AND q.bin = i)"""

COLUMNS = ["risk_score", "channel", *FEATURES]
COLUMN_QUALITY = ", cq AS (SELECT reporting_month, scorecard, column_name, count(*) AS total_count, " \
    "avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate, " \
    "coalesce(avg(outside) FILTER (value IS NOT NULL), 0) AS outlier_rate, " \
    "count(DISTINCT value) AS unique_count FROM (" + " UNION ALL ".join(
        f"SELECT reporting_month, scorecard, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, "
        + ("CASE WHEN risk_score < 0 OR risk_score > 1 THEN 1 ELSE 0 END" if c == "risk_score" else "0")
        + f" AS outside FROM {by_card('cur')}" for c in COLUMNS) + ") GROUP BY ALL)"

MIX_SHIFT = """,
ms_r AS (SELECT score_decile_static AS score_bin, count(*) / (SELECT count(*) FROM base) AS share
         FROM base GROUP BY ALL),
ms_q AS (SELECT reporting_month, score_decile_static AS score_bin,
           count(*) / sum(count(*)) OVER (PARTITION BY reporting_month) AS share
         FROM cur GROUP BY reporting_month, score_decile_static),
ms AS (
  SELECT reporting_month, score_bin, coalesce(r.share, 0) AS baseline_pct, coalesce(q.share, 0) AS current_pct
  FROM (SELECT reporting_month, score_bin FROM ms_q UNION
        SELECT reporting_month, score_bin FROM (SELECT DISTINCT reporting_month FROM cur), ms_r)
  LEFT JOIN ms_r r USING (score_bin) LEFT JOIN ms_q q USING (reporting_month, score_bin))"""

CARD_MIX_SHIFT = f""",
ms_r AS (SELECT scorecard, score_decile_static AS score_bin,
           count(*) / sum(count(*)) OVER (PARTITION BY scorecard) AS share
         FROM {by_card('base')} GROUP BY scorecard, score_decile_static),
ms_q AS (SELECT reporting_month, scorecard, score_decile_static AS score_bin,
           count(*) / sum(count(*)) OVER (PARTITION BY reporting_month, scorecard) AS share
         FROM {by_card('cur')} GROUP BY reporting_month, scorecard, score_decile_static),
ms AS (
  SELECT reporting_month, scorecard, score_bin, coalesce(r.share, 0) AS baseline_pct,
    coalesce(q.share, 0) AS current_pct
  FROM (SELECT reporting_month, scorecard, score_bin FROM ms_q UNION
        SELECT reporting_month, scorecard, score_bin
        FROM (SELECT DISTINCT reporting_month, scorecard FROM ms_q) JOIN ms_r USING (scorecard))
  LEFT JOIN ms_r r USING (scorecard, score_bin) LEFT JOIN ms_q q USING (reporting_month, scorecard, score_bin))"""

# Outcomes

PERFORMANCE = f""",
perf AS (
  SELECT reporting_month, maturity, scorecard, channel, max(score_month) AS score_month,
    count(*) AS account_count, coalesce(avg(risk_score), 0) AS avg_score, avg(edr) AS edr,
    CAST(sum(edr) AS BIGINT) AS edr_count, avg(bad) AS bad_rate, CAST(sum(bad) AS BIGINT) AS bad_count
  FROM {by_scope('cohort')} GROUP BY ALL),
base_perf AS (SELECT maturity, scorecard, channel, avg(edr) AS edr FROM {by_scope('base_cohort')} GROUP BY ALL),
perf_report AS (
  SELECT p.*, p.edr - b.edr AS edr_delta, NULL::VARCHAR AS note
  FROM perf p LEFT JOIN base_perf b USING (maturity, scorecard, channel)
  UNION ALL BY NAME
  SELECT reporting_month, maturity, 'overall' AS scorecard, 'all' AS channel, score_month, note
  FROM info WHERE NOT available)"""


def calibration_ctes(decile: str = "score_decile_static", source: str = "cohort") -> str:
    return f""",
cal AS (
  SELECT reporting_month, maturity, scorecard, channel, max(score_month) AS score_month,
    coalesce({decile}, 0) AS score_bin, count(*) AS account_count, CAST(coalesce(sum(bad), 0) AS BIGINT) AS bad_count,
    coalesce(avg(risk_score), 0) AS predicted_rate, coalesce(avg(bad), 0) AS actual_rate,
    coalesce(avg(bad), 0) - coalesce(avg(risk_score), 0) AS calibration_gap
  FROM {by_scope(source)} WHERE maturity = 'M12' GROUP BY reporting_month, maturity, scorecard, channel, {decile}),
cal_ok AS (
  SELECT *, min(account_count) FILTER (channel = 'all') OVER (PARTITION BY reporting_month, maturity, scorecard)
    >= 50 AS sample_sufficient FROM cal)"""


CALIBRATION = calibration_ctes()
OWN_DECILES = """,
own_edges AS (
  SELECT reporting_month, maturity,
    list_distinct(quantile_disc(risk_score, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS edges
  FROM cohort WHERE risk_score IS NOT NULL GROUP BY ALL),
own_cohort AS (
  SELECT cohort.*, CASE WHEN risk_score IS NOT NULL
    THEN CAST(1 + len(list_filter(edges, lambda e: risk_score > e)) AS INTEGER) END AS own_decile
  FROM cohort LEFT JOIN own_edges USING (reporting_month, maturity))"""


def separation_ctes(prefix: str, rows: str, keys: str, accounts: int = 100, bads: int = 10) -> str:
    return f""",
{prefix}_rows AS (SELECT {keys}, risk_score AS s, bad FROM {rows}),
{prefix}_values AS (
  SELECT {keys}, s, count(*) FILTER (bad = 0) AS g, count(*) FILTER (bad = 1) AS b
  FROM {prefix}_rows WHERE s IS NOT NULL AND bad IN (0, 1) GROUP BY ALL),
{prefix}_walk AS (
  SELECT {keys}, g, b, sum(g) OVER w AS cg, sum(b) OVER w AS cb,
    sum(g) OVER (PARTITION BY {keys}) AS ng, sum(b) OVER (PARTITION BY {keys}) AS nb
  FROM {prefix}_values WINDOW w AS (PARTITION BY {keys} ORDER BY s)),
{prefix}_stat AS (
  SELECT {keys}, coalesce(max(abs(cg / nullif(ng, 0) - cb / nullif(nb, 0))), 0) AS ks,
    CASE WHEN any_value(ng + nb) >= 10 THEN 2 * (sum(b * (cg + cb - g - b + (g + b + 1) / 2))
      - any_value(nb) * (any_value(nb) + 1) / 2) / nullif(any_value(nb) * any_value(ng), 0) - 1 END AS gini
  FROM {prefix}_walk GROUP BY ALL),
{prefix} AS (
  SELECT {keys}, account_count, bad_count, note, CASE WHEN note IS NULL THEN coalesce(ks, 0) END AS ks,
    CASE WHEN note IS NULL THEN gini END AS gini, coalesce(ks, 0) AS raw_ks
  FROM (SELECT {keys}, count(*) AS account_count, count(*) FILTER (bad = 1) AS bad_count,
      CASE WHEN count(*) < {accounts} THEN 'Insufficient accounts: ' || count(*) || ' < {accounts}'
           WHEN count(*) FILTER (bad = 1) < {bads}
           THEN 'Insufficient bads: ' || (count(*) FILTER (bad = 1)) || ' < {bads}' END AS note
    FROM {prefix}_rows GROUP BY ALL) LEFT JOIN {prefix}_stat USING ({keys}))"""


KEYS = "reporting_month, maturity, scorecard"
SEPARATION = separation_ctes("sep", by_card("cohort"), KEYS)
KS_DROP = SEPARATION + separation_ctes("bsep", by_card("base_cohort"), "maturity, scorecard") + """,
drop AS (
  SELECT sep.*, b.raw_ks AS baseline_ks, sep.ks - b.raw_ks AS ks_drop
  FROM sep LEFT JOIN (SELECT * FROM bsep WHERE bad_count > 0 AND account_count > bad_count) b
    USING (maturity, scorecard))"""

ODDS = f""",
odds_bins AS (
  SELECT {KEYS}, coalesce(score_decile_static, 0) AS score_bin, count(*) AS total,
    count(*) FILTER (bad = 0) AS goods, count(*) FILTER (bad = 1) AS bads
  FROM {by_card('cohort')} GROUP BY ALL),
odds_rows AS (
  SELECT *, goods / nullif(bads, 0) AS odds,
    NOT coalesce(CASE WHEN bads = 0 THEN 'Infinity'::DOUBLE ELSE goods / bads END
      > lag(CASE WHEN bads = 0 THEN 'Infinity'::DOUBLE ELSE goods / bads END)
        OVER (PARTITION BY {KEYS} ORDER BY score_bin), false) AS is_monotonic
  FROM odds_bins)"""

KS_TABLE = SEPARATION + f""",
tier_rows AS (
  SELECT {KEYS}, risk_score AS s, bad,
    least(((row_number() OVER (PARTITION BY {KEYS} ORDER BY risk_score, creditaccountid) - 1) * 20)
      // count(*) OVER (PARTITION BY {KEYS}) + 1, 20) AS tier
  FROM {by_card('cohort')} JOIN (SELECT {KEYS} FROM sep WHERE note IS NULL) USING ({KEYS})
  WHERE risk_score IS NOT NULL AND bad IS NOT NULL),
tiers AS (
  SELECT {KEYS}, tier, min(s) AS min_score, max(s) AS max_score, count(*) AS accounts_n,
    count(*) FILTER (bad <> 1) AS goods_n, count(*) FILTER (bad = 1) AS bads_n
  FROM tier_rows GROUP BY ALL),
tier_shares AS (
  SELECT *, accounts_n / sum(accounts_n) OVER p AS accounts_pct,
    coalesce(sum(goods_n) OVER w / nullif(sum(goods_n) OVER p, 0), 0) AS goods_pct,
    coalesce(sum(bads_n) OVER w / nullif(sum(bads_n) OVER p, 0), 0) AS bads_pct,
    bads_n / accounts_n AS bad_rate, sum(bads_n) OVER p / sum(accounts_n) OVER p AS overall
  FROM tiers WINDOW p AS (PARTITION BY {KEYS}), w AS (PARTITION BY {KEYS} ORDER BY tier)),
tier_table AS (
  SELECT {KEYS}, CAST(tier AS VARCHAR) AS tier, min_score, max_score, accounts_n, accounts_pct, goods_n,
    goods_pct, bads_n, bads_pct, bad_rate, abs(goods_pct - bads_pct) AS ks,
    coalesce(bad_rate / nullif(overall, 0), 0) AS lift FROM tier_shares
  UNION ALL
  SELECT {KEYS}, 'TOTAL', min(min_score), max(max_score), CAST(sum(accounts_n) AS BIGINT), 1.0,
    CAST(sum(goods_n) AS BIGINT), 1.0, CAST(sum(bads_n) AS BIGINT), 1.0, sum(bads_n) / sum(accounts_n),
    max(abs(goods_pct - bads_pct)), 1.0 FROM tier_shares GROUP BY ALL)"""

def attribution_ctes(source: str = "cohort", card: bool = False) -> str:
    keys = "reporting_month, scorecard" if card else "reporting_month"
    drivers = " UNION ALL ".join(
        f"SELECT {keys}, edr, '{c}' AS dimension, CAST({c} AS VARCHAR) AS segment FROM target "
        f"WHERE {c} IS NOT NULL" for c in ("channel", "source", "score_decile_static"))

    def same(a: str, b: str) -> str:
        return f" AND {a}.scorecard = {b}.scorecard" if card else ""

    def of(table: str) -> str:
        return ", ".join(f"{table}.{k}" for k in keys.split(", "))

    return f""",
target AS (SELECT * FROM {source} WHERE maturity = 'M9'),
month_rate AS (SELECT {keys}, avg(edr) AS rate FROM target GROUP BY ALL),
moved AS (
  SELECT {of('a')}, {shift('a.reporting_month', '-1')} AS prior_month, a.rate, b.rate AS prior_rate,
    a.rate - b.rate AS delta
  FROM month_rate a JOIN month_rate b ON b.reporting_month = {shift('a.reporting_month', '-1')}{same('a', 'b')}),
seg AS (SELECT {keys}, dimension, segment, count(*) AS n, avg(edr) AS r FROM ({drivers}) GROUP BY ALL),
seg_share AS (SELECT *, n / sum(n) OVER (PARTITION BY {keys}, dimension) AS w FROM seg),
seg_keys AS (
  SELECT {of('m')}, m.prior_month, m.delta, dimension, segment
  FROM moved m JOIN seg s ON s.reporting_month IN (m.reporting_month, m.prior_month){same('m', 's')}
  WHERE abs(m.delta) >= 0.02 GROUP BY ALL),
effects AS (
  SELECT k.*, (coalesce(c.w, 0) - coalesce(p.w, 0)) * coalesce(p.r, 0) AS mix_effect,
    (coalesce(c.r, 0) - coalesce(p.r, 0)) * coalesce(c.w, 0) AS rate_effect
  FROM seg_keys k
  LEFT JOIN seg_share c ON c.reporting_month = k.reporting_month AND c.dimension = k.dimension
    AND c.segment = k.segment{same('c', 'k')}
  LEFT JOIN seg_share p ON p.reporting_month = k.prior_month AND p.dimension = k.dimension
    AND p.segment = k.segment{same('p', 'k')}),
drivers AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY abs(round(mix_effect + rate_effect, 6)) DESC,
    dimension, segment) AS driver_rank
  FROM effects WHERE abs(mix_effect + rate_effect) >= 0.001 QUALIFY driver_rank <= 3)"""


ATTRIBUTION = attribution_ctes()
CARD_ATTRIBUTION = attribution_ctes(by_card("cohort"), card=True)


# Governance

EVALUATED = f"""
SELECT reporting_month, scorecard, 'all' AS channel, 'score_psi' AS metric, score_psi AS value, warning, alert,
  {status('score_psi', 'warning', 'alert')} AS status, 'stability' AS source
FROM judged_stability WHERE channel = 'all'
UNION ALL SELECT reporting_month, scorecard, 'all', 'feature_psi:' || feature_name, psi, 0.10, 0.25,
  {status('psi', '0.10', '0.25')}, 'stability' FROM fstability
UNION ALL SELECT reporting_month, scorecard, 'all', 'ks_drop:' || maturity, ks_drop, -0.03, -0.07,
  {status('ks_drop', '-0.03', '-0.07', True)}, 'separation' FROM drop WHERE ks_drop IS NOT NULL
UNION ALL SELECT reporting_month, scorecard, channel, 'edr_delta:' || maturity || ':' || channel, edr_delta,
  0.01, 0.03, {status('edr_delta', '0.01', '0.03')}, 'performance' FROM perf_report WHERE edr_delta IS NOT NULL
UNION ALL SELECT reporting_month, scorecard, channel, 'calibration_gap:' || maturity || ':bin' || score_bin,
  calibration_gap, 0.02, 0.05, {status('abs(calibration_gap)', '0.02', '0.05')}, 'calibration' FROM cal_ok
UNION ALL SELECT reporting_month, scorecard, 'all', 'missing_rate:' || column_name, missing_rate, 0.01, 0.05,
  {status('missing_rate', '0.01', '0.05')}, 'data_quality' FROM cq"""
GOVERNED = (BASE + SCORE_STABILITY + FEATURE_STABILITY + KS_DROP + PERFORMANCE + CALIBRATION + COLUMN_QUALITY
            + f", governed AS ({EVALUATED})")

DIAGNOSIS = """
SELECT reporting_month, NULL::VARCHAR AS scorecard, 'cohort_unavailable' AS rule, maturity AS subject,
  CAST(mature_count AS DOUBLE) AS value FROM info WHERE NOT available
UNION ALL SELECT reporting_month, NULL, 'small_cohort', maturity, account_count FROM info
  WHERE available AND account_count < 100
UNION ALL SELECT reporting_month, scorecard, CASE WHEN score_psi >= 0.25 THEN 'severe_score_shift'
  ELSE 'moderate_score_shift' END, NULL, score_psi FROM stability WHERE channel = 'all' AND score_psi >= 0.10
UNION ALL SELECT reporting_month, scorecard, 'features_drift_together', NULL, count(*) FROM fstability
  WHERE psi >= 0.10 GROUP BY ALL HAVING count(*) >= 3
UNION ALL SELECT reporting_month, scorecard, 'ks_degradation', maturity, ks_drop FROM drop WHERE ks_drop <= -0.07
UNION ALL SELECT reporting_month, scorecard, 'calibration_divergence', 'M12', count(*) FROM cal_ok
  WHERE abs(calibration_gap) >= 0.05 GROUP BY ALL"""

SECTIONS = {"stability": "(SELECT * FROM stability WHERE account_count > 0)", "separation": "(SELECT * FROM sep WHERE ks IS NOT NULL)",
            "performance": "(SELECT * FROM perf_report WHERE note IS NULL)", "calibration": "cal_ok",
            "data_quality": f"(SELECT DISTINCT reporting_month, scorecard, channel FROM {by_scope('cur')})",
            "governance_flags": "(SELECT * FROM governed WHERE status IN ('ALERT', 'WARNING'))",
            "attribution": "drivers"}


def availability_sql() -> str:
    counted = " UNION ALL ".join(
        f"SELECT reporting_month, '{name}' AS section, count(*) AS n FROM {table} GROUP BY reporting_month"
        for name, table in SECTIONS.items())
    names = ", ".join(f"('{n}')" for n in SECTIONS)
    return (f"WITH {GOVERNED} {ATTRIBUTION}, counted AS ({counted}) "
            "SELECT reporting_month, section, coalesce(n, 0) AS rows, coalesce(n, 0) > 0 AS available, "
            "CASE WHEN coalesce(n, 0) > 0 THEN NULL "
            "WHEN section IN ('stability', 'data_quality') THEN 'NOT_AVAILABLE_EMPTY_SEGMENT' "
            "WHEN section = 'calibration' THEN CASE WHEN m12 THEN 'NOT_AVAILABLE_SAMPLE_SIZE' "
            "WHEN reached THEN 'NOT_AVAILABLE_NOT_M12' ELSE 'NOT_AVAILABLE_MATURITY' END "
            "WHEN section = 'separation' THEN CASE WHEN reached THEN 'NOT_AVAILABLE_SAMPLE_SIZE' "
            "ELSE 'NOT_AVAILABLE_NO_ACTUALS' END "
            "WHEN section = 'performance' THEN 'NOT_AVAILABLE_NO_ACTUALS' END AS reason "
            f"FROM months CROSS JOIN (VALUES {names}) s(section) "
            "LEFT JOIN (SELECT reporting_month, bool_or(available) AS reached, "
            "bool_or(available AND maturity = 'M12') AS m12 FROM info GROUP BY reporting_month) "
            "USING (reporting_month) "
            "LEFT JOIN counted USING (reporting_month, section) "
            "UNION ALL SELECT reporting_month, 'cohort_' || maturity, 0, false, note FROM info WHERE NOT available")


def half_up(value: str) -> str:
    """Four decimals with decimal halves rounded up, as the labels have them."""
    return f"floor({value} * 1e4 + 0.500001) / 1e4"


def columns(*names: str) -> str:
    return ", ".join(d(n, n) for n in names)


def monitoring_sql() -> dict[str, str]:
    w = f"WITH {BASE} "
    scope = "reporting_month, scorecard, channel"
    info_columns = "baseline_type, start_month, end_month, months, account_count"
    sep = w + SEPARATION
    strict = w + separation_ctes("sep", by_card("cohort"), KEYS, 300, 30)
    cal_columns = (f"SELECT {KEYS}, channel, score_month, score_bin, account_count, bad_count, "
                   + columns("predicted_rate", "actual_rate", "calibration_gap") + ", sample_sufficient")
    rolling_ctes = f""",
cs AS (SELECT reporting_month, scorecard, channel, risk_score AS value FROM {by_scope('cur')}),
rs_cur AS (SELECT * FROM cs WHERE value IS NOT NULL),
rs_ref AS (SELECT reporting_month, scorecard, channel, risk_score AS value FROM {by_scope('roll')}
           WHERE risk_score IS NOT NULL),
""" + psi_ctes("rs", "rs_ref", "rs_cur", ["reporting_month", "scorecard", "channel"],
               ["reporting_month", "scorecard", "channel"])
    return {
        "baseline_fixed": w + "SELECT 'fixed_window' AS baseline_type, '1996-01' AS start_month, "
        "'1996-12' AS end_month, string_agg(DISTINCT score_month, ',' ORDER BY score_month) AS months, "
        "count(*) AS account_count FROM base",
        "baseline_rolling": w + "SELECT m.reporting_month, 'rolling_window' AS baseline_type, "
        f"{shift('m.reporting_month', '-3')} AS start_month, {shift('m.reporting_month', '-1')} AS end_month, "
        "coalesce(string_agg(DISTINCT score_month, ',' ORDER BY score_month), '') AS months, "
        "count(creditaccountid) AS account_count FROM months m LEFT JOIN roll USING (reporting_month) "
        "GROUP BY m.reporting_month",
        "baseline_initial": w + ", first_months AS (SELECT DISTINCT score_month FROM live ORDER BY 1 LIMIT 3) "
        "SELECT 'initial_val' AS baseline_type, min(score_month) AS start_month, max(score_month) AS end_month, "
        "string_agg(DISTINCT score_month, ',' ORDER BY score_month) AS months, count(*) AS account_count "
        "FROM live WHERE score_month IN (SELECT score_month FROM first_months)",
        "cohort_info": w + "SELECT * FROM info",
        "join_coverage": w + ", s AS (SELECT score_month, count(*) AS score_rows, count(o.creditaccountid) AS j, "
        + ", ".join(f"CAST(coalesce(sum({f}), 0) AS BIGINT) AS mature_{m.lower()}" for m, _, _, _, f, _ in WINDOWS)
        + " FROM mart LEFT JOIN outcome o USING (creditaccountid, score_month) GROUP BY score_month), "
        "p AS (SELECT score_month, count(*) AS perf_rows FROM outcome GROUP BY score_month) "
        "SELECT score_month, coalesce(score_rows, 0) AS score_rows, coalesce(perf_rows, 0) AS perf_rows, "
        "coalesce(j, 0) AS joined_rows, mature_m3, mature_m6, mature_m9, mature_m12, "
        "CASE WHEN coalesce(j, 0) > 0 THEN 'OK' WHEN coalesce(score_rows, 0) = 0 THEN 'no data' ELSE 'join=0' END "
        "AS status FROM s FULL JOIN p USING (score_month)",
        "backfill_readiness": w + "SELECT count(*) AS months, 12 AS required, count(*) >= 12 AS is_ready "
        "FROM months",
        "backfill_psi": w + rolling_ctes + f"SELECT {scope}, {d('coalesce(psi, 0)', 'score_psi')}, "
        f"{d('coalesce(mean, 0)', 'mean_score')}, {d('coalesce(std, 0)', 'std_score')}, "
        f"coalesce(account_count, 0) AS account_count FROM {LISTED} "
        f"LEFT JOIN rs_stat USING ({scope}) LEFT JOIN rs_psi USING ({scope})",
        "stability_status": w + SCORE_STABILITY + f"SELECT {scope}, account_count, "
        + columns("score_psi", "mean_score", "std_score", "warning", "alert") + ", "
        + status("score_psi", "warning", "alert") + " AS score_psi_status FROM judged_stability",
        "feature_stability": w + FEATURE_STABILITY + "SELECT reporting_month, scorecard, feature_name, "
        + columns("psi", "baseline_mean", "current_mean", "mean_shift") + f", {d('0.10', 'warning')}, "
        f"{d('0.25', 'alert')}, {status('psi', '0.10', '0.25')} AS status FROM fstability",
        "psi_table": w + PSI_TABLE + "SELECT scorecard, reporting_month, "
        "printf('%.2f-%.2f', min_score, max_score) AS interval, baseline_count, compare_count, "
        + columns("min_score", "max_score", "baseline_pct", "compare_pct") + ", "
        + d("compare_pct - baseline_pct", "difference") + ", "
        + d("compare_pct / baseline_pct", "obs_to_baseline_ratio") + ", "
        + d("ln(compare_pct / baseline_pct)", "woe") + ", "
        + d("(compare_pct - baseline_pct) * ln(compare_pct / baseline_pct)", "contribution") + " FROM pt",
        "psi_table_totals": w + PSI_TABLE + "SELECT reporting_month, scorecard, "
        + d("sum((compare_pct - baseline_pct) * ln(compare_pct / baseline_pct))", "total_psi")
        + " FROM pt GROUP BY ALL",
        "csi_table": w + CSI_TABLE + "SELECT reporting_month, scorecard, feature, bin_index, "
        f"printf('%.4f-%.4f', {half_up('min_value')}, {half_up('max_value')}) AS interval, "
        "baseline_count, compare_count, "
        + columns("min_value", "max_value", "baseline_pct", "compare_pct") + ", "
        + d("compare_pct - baseline_pct", "difference") + ", "
        + d("(compare_pct - baseline_pct) * ln(compare_pct / baseline_pct)", "information_value") + " FROM ct",
        "score_quality": w + f"SELECT {scope}, "
        + d("avg(CASE WHEN risk_score IS NULL THEN 1.0 ELSE 0.0 END)", "score_missing_rate") + ", "
        + d("coalesce(avg(CASE WHEN risk_score < 0 OR risk_score > 1 THEN 1.0 ELSE 0.0 END) "
            "FILTER (risk_score IS NOT NULL), 0)", "score_outlier_rate")
        + f", count(*) AS total_accounts FROM {by_scope('cur')} GROUP BY ALL",
        "feature_missing": w + "SELECT reporting_month, scorecard, feature_name, count(*) AS total_count, "
        "count(*) - count(value) AS missing_count, " + d("(count(*) - count(value)) / count(*)", "missing_rate")
        + f" FROM ({unpivot(by_card('cur'), 'reporting_month, scorecard', FEATURES)}) GROUP BY ALL",
        "column_quality": w + COLUMN_QUALITY + "SELECT reporting_month, scorecard, column_name, total_count, "
        + columns("missing_rate", "outlier_rate") + f", unique_count, {d('0.01', 'warning')}, {d('0.05', 'alert')}, "
        + status("missing_rate", "0.01", "0.05") + " AS missing_status FROM cq",
        "column_quality_sketched": w + COLUMN_QUALITY + "SELECT reporting_month, column_name, total_count, "
        + columns("missing_rate", "outlier_rate") + ", unique_count, true AS within_error FROM cq "
        "WHERE scorecard = 'overall'",
        "record_quality": w + "SELECT reporting_month, scorecard, count(*) AS total_records, "
        + d("1 - count(DISTINCT creditaccountid) / count(*)", "duplicate_rate") + ", "
        + d("(" + " + ".join(f"count(*) - count({c})" for c in COLUMNS) + f") / (count(*) * {len(COLUMNS)})",
            "overall_missing_rate") + f" FROM {by_card('cur')} GROUP BY ALL",
        "mix_shift": w + MIX_SHIFT + "SELECT reporting_month, CAST(score_bin AS INTEGER) AS score_bin, "
        + columns("baseline_pct", "current_pct") + ", " + d("current_pct - baseline_pct", "shift") + " FROM ms",
        "mix_shift_summary": w + MIX_SHIFT + "SELECT reporting_month, "
        "count(*) FILTER (current_pct - baseline_pct > 0.02) AS bins_grown, "
        "count(*) FILTER (current_pct - baseline_pct < -0.02) AS bins_shrunk FROM ms GROUP BY ALL",
        "mix_shift_by_scorecard": w + CARD_MIX_SHIFT + "SELECT reporting_month, scorecard, "
        "CAST(score_bin AS INTEGER) AS score_bin, "
        + columns("baseline_pct", "current_pct") + ", " + d("current_pct - baseline_pct", "shift") + " FROM ms",
        "csi_table_totals": w + CSI_TABLE + "SELECT reporting_month, scorecard, feature, "
        + d("sum((compare_pct - baseline_pct) * ln(compare_pct / baseline_pct))", "total_iv")
        + " FROM ct GROUP BY ALL",
        "portfolio": w + f"SELECT reporting_month, scorecard, current_accounts, baseline_accounts, "
        f"{d('coalesce(m, 0)', 'mean_score')} FROM (SELECT reporting_month, scorecard, count(*) AS current_accounts, "
        f"avg(risk_score) AS m FROM {by_card('cur')} GROUP BY ALL) JOIN (SELECT scorecard, count(*) AS "
        f"baseline_accounts FROM {by_card('base')} GROUP BY ALL) USING (scorecard)",
        "performance_windows": w + PERFORMANCE + f"SELECT {KEYS}, channel, score_month, account_count, edr_count, "
        "bad_count, " + columns("avg_score", "edr", "bad_rate") + " FROM perf",
        "performance_report": w + PERFORMANCE + f"SELECT {KEYS}, channel, score_month, account_count, edr_count, "
        "bad_count, " + columns("avg_score", "edr", "bad_rate", "edr_delta") + ", note, CASE maturity "
        + " ".join(f"WHEN '{m}' THEN '{label}'" for m, _, _, _, _, label in WINDOWS)
        + f" END AS display_label, {d('0.01', 'warning')}, {d('0.03', 'alert')}, "
        + status("edr_delta", "0.01", "0.03") + " AS edr_delta_status FROM perf_report",
        "edr_rank_ordering": w + f", b AS (SELECT {KEYS}, {interval_case('risk_score')} AS bin, edr "
        f"FROM {by_card('cohort')}), g AS (SELECT {KEYS}, count(*) AS n FROM b GROUP BY ALL), "
        f"t AS (SELECT g.*, i, coalesce(c, 0) AS accounts_n, coalesce(r, 0) AS observation_pct FROM g, range(10) t(i) "
        f"LEFT JOIN (SELECT {KEYS}, bin, count(*) AS c, avg(edr) AS r FROM b GROUP BY ALL) x "
        "ON x.reporting_month = g.reporting_month AND x.maturity = g.maturity AND x.scorecard = g.scorecard "
        f"AND x.bin = i) SELECT {KEYS}, printf('%.2f-%.2f', i / 10, (i + 1) / 10) AS interval, "
        + d("i / 10", "min_score") + ", " + d("(i + 1) / 10", "max_score") + ", accounts_n, "
        + d("accounts_n / n", "accounts_pct") + ", " + d("observation_pct", "observation_pct")
        + f", CASE WHEN observation_pct < lag(observation_pct) OVER (PARTITION BY {KEYS} ORDER BY i) THEN 'YES' "
        "ELSE 'NO' END AS misrank FROM t",
        "risk_capture": w + f"SELECT {KEYS}, {d('0.5', 'threshold')}, "
        + d("count(*) FILTER (risk_score >= 0.5) / count(*)", "pct_population_flagged") + ", "
        + d("coalesce(count(*) FILTER (risk_score >= 0.5 AND edr = 1) / nullif(count(*) FILTER (edr = 1), 0), 0)",
            "pct_bad_captured") + f" FROM {by_card('cohort')} GROUP BY ALL",
        "calibration_m12": w + CALIBRATION + cal_columns + f", {d('0.02', 'warning')}, {d('0.05', 'alert')}, "
        + status("abs(calibration_gap)", "0.02", "0.05") + " AS gap_status FROM cal_ok",
        "calibration_summary": w + CALIBRATION + f"SELECT {KEYS}, {d('max(abs(calibration_gap))', 'max_abs_gap')}, "
        f"{d('avg(abs(calibration_gap))', 'mean_abs_gap')}, first(score_bin ORDER BY abs(calibration_gap) DESC, "
        "channel, score_bin) AS worst_bin FROM cal_ok GROUP BY ALL",
        "calibration_own_deciles": w + OWN_DECILES + calibration_ctes("own_decile", "own_cohort") + cal_columns
        + " FROM cal_ok",
        "ks_good_bad": sep + f"SELECT {KEYS}, account_count, bad_count, note, {d('ks', 'ks')} FROM sep",
        "ks_default_guard": strict + f"SELECT {KEYS}, account_count, bad_count, note, {d('ks', 'ks')}, "
        f"{d('round(gini, 6)', 'gini')} FROM sep",
        "gini": sep + f"SELECT {KEYS}, {d('round(gini, 6)', 'gini')} FROM sep",
        "ks_drop": w + KS_DROP + f"SELECT {KEYS}, {columns('ks', 'baseline_ks', 'ks_drop')}, "
        + status("ks_drop", "-0.03", "-0.07", True) + " AS ks_drop_status FROM drop",
        "odds": w + ODDS + f"SELECT {KEYS}, score_bin, total, goods, bads, {d('odds', 'odds')}, "
        + d("bads / total", "bad_rate") + f", is_monotonic, CAST(count(*) FILTER (NOT is_monotonic) OVER "
        f"(PARTITION BY {KEYS}) AS BIGINT) AS total_misranks FROM odds_rows",
        "ks_table": w + KS_TABLE + f"SELECT {KEYS}, tier, accounts_n, goods_n, bads_n, "
        + columns("min_score", "max_score", "accounts_pct", "goods_pct", "bads_pct", "bad_rate", "ks", "lift")
        + " FROM tier_table",
        "attribution": w + ATTRIBUTION + "SELECT reporting_month, CAST(driver_rank AS INTEGER) AS driver_rank, "
        "dimension, segment, " + columns("delta", "mix_effect", "rate_effect") + ", "
        + d("round(mix_effect + rate_effect, 6)", "contribution")
        + ", CASE WHEN mix_effect + rate_effect > 0 THEN 'up' ELSE 'down' END AS direction FROM drivers",
        "attribution_by_scorecard": w + CARD_ATTRIBUTION + "SELECT reporting_month, scorecard, "
        "CAST(driver_rank AS INTEGER) AS driver_rank, dimension, segment, "
        + columns("delta", "mix_effect", "rate_effect") + ", "
        + d("round(mix_effect + rate_effect, 6)", "contribution")
        + ", CASE WHEN mix_effect + rate_effect > 0 THEN 'up' ELSE 'down' END AS direction FROM drivers",
        "attribution_overview_by_scorecard": w + CARD_ATTRIBUTION + "SELECT reporting_month, scorecard, "
        + columns("rate", "prior_rate", "delta") + ", abs(delta) >= 0.02 AS is_material FROM moved",
        "attribution_overview": w + ATTRIBUTION + "SELECT reporting_month, "
        + columns("rate", "prior_rate", "delta") + ", abs(delta) >= 0.02 AS is_material FROM moved",
        "governance": f"WITH {GOVERNED} SELECT reporting_month, scorecard, channel, metric, "
        + columns("value", "warning", "alert") + ", status, source FROM governed",
        "flags": f"WITH {GOVERNED} SELECT reporting_month, scorecard, channel, metric, {d('value', 'value')}, "
        "status, source FROM governed WHERE status IN ('ALERT', 'WARNING')",
        "health": f"WITH {GOVERNED} SELECT reporting_month, count(*) FILTER (status = 'ALERT') AS alerts, "
        "count(*) FILTER (status = 'WARNING') AS warnings, "
        "count(*) FILTER (status IN ('ALERT', 'WARNING')) AS total_flags, CASE WHEN count(*) FILTER "
        "(status = 'ALERT') > 0 THEN 'ALERT' WHEN count(*) FILTER (status = 'WARNING') > 0 THEN 'WARNING' "
        "ELSE 'OK' END AS overall_health FROM governed GROUP BY ALL",
        "diagnosis": f"WITH {GOVERNED}, found AS ({DIAGNOSIS}) SELECT reporting_month, scorecard, rule, subject, "
        f"{d('value', 'value')} FROM found UNION ALL SELECT DISTINCT reporting_month, NULL, 'no_issues', NULL, NULL "
        "FROM stability WHERE reporting_month NOT IN (SELECT reporting_month FROM found)",
        "availability": availability_sql(),
        "by_scorecard": w + f"SELECT {scope}, count(*) AS account_count, {d('avg(risk_score)', 'avg_score')} "
        f"FROM {by_scope('cur')} GROUP BY ALL",
        "top_drifting": w + FEATURE_STABILITY + "SELECT reporting_month, scorecard, feature_name, "
        f"{d('psi', 'psi')}, CAST(psi_rank AS INTEGER) AS psi_rank FROM (SELECT *, row_number() OVER "
        "(PARTITION BY reporting_month, scorecard ORDER BY psi DESC, feature_name) AS psi_rank FROM fstability) "
        "WHERE psi >= 0.10 AND psi_rank <= 3",
    }
