from pyspark.sql import functions as F

from scorewatch.operators import governance, reports
from scorewatch.spec import Limit, Thresholds
from tests.conftest import rows_by

LIMITS = Thresholds(default={"psi": Limit(0.1, 0.25)}, model={"psi": Limit(0.08, 0.2)},
                    scorecard={"SC001": {"psi": Limit(0.12, 0.3), "own": Limit(1, 2)}})


def test_resolution_order():
    assert LIMITS.resolve("psi", "SC001") == Limit(0.12, 0.3)
    assert LIMITS.resolve("psi", "SC002") == Limit(0.08, 0.2)
    assert Thresholds(default={"psi": Limit(0.1, 0.25)}).resolve("psi") == Limit(0.1, 0.25)
    assert LIMITS.resolve("ks_drop") == Limit(-0.03, -0.07)
    assert LIMITS.resolve("unheard_of") == Limit(0.0, 0.0)


def test_judge_resolves_like_the_specification(spark):
    rows = [(card, metric, value) for card in ("overall", "SC001") for metric, value in (
        ("psi", 0.25), ("ks_drop", -0.03), ("ks_drop", -0.2), ("ks_drop", 0.1), ("own", 1.5),
        ("unheard_of", 0.0), ("psi", None), ("psi", 0.08))]
    df = spark.createDataFrame(rows, "scorecard string, metric string, value double")
    for r in governance.judge(df, LIMITS, F.col("metric"), F.col("value")).collect():
        limit = LIMITS.resolve(r["metric"], r["scorecard"])
        assert (r["warning"], r["alert"]) == (limit.warning, limit.alert), r
        if r["value"] is None:
            want = "N/A"
        else:
            sign = -1 if r["metric"] == "ks_drop" else 1
            value, warn, alert = (sign * x for x in (r["value"], limit.warning, limit.alert))
            want = "ALERT" if value >= alert else "WARNING" if value >= warn else "OK"
        assert r["status"] == want, r


def test_flags_and_health(spark):
    stability = spark.createDataFrame([("r1", "overall", "all", 0.3), ("r1", "overall", "A", 0.9),
                                       ("r2", "overall", "all", 0.0), ("r3", "overall", "all", 0.1)],
                                      "reporting_month string, scorecard string, channel string, score_psi double")
    calibration = spark.createDataFrame([("r2", "overall", "B", "M12", 4, -0.03)],
                                        "reporting_month string, scorecard string, channel string, "
                                        "maturity string, score_bin int, calibration_gap double")
    table = governance.governance_table(LIMITS, score_stability=stability, calibration=calibration)
    assert table.count() == 4
    flags = rows_by(governance.flags(table), "reporting_month")
    assert flags["r2"]["metric"] == "calibration_gap:M12:bin4" and flags["r2"]["value"] == -0.03
    health = rows_by(governance.overall_health(table), "reporting_month")
    assert [health[r]["overall_health"] for r in ("r1", "r2", "r3")] == ["ALERT", "WARNING", "WARNING"]
    assert health["r1"]["total_flags"] == 1


def psi_rows(spark, rows):
    return spark.createDataFrame([("m", c, f, p, 0.0, 1.0) for c, f, p in rows],
                                 "vintage_month string, channel string, feature_name string, psi double, "
                                 "baseline_mean double, current_mean double")


def test_rankings_are_ordered_by_name_on_ties(spark):
    psi = psi_rows(spark, [("A", "f1", 0.1), ("B", "f1", 0.3), ("A", "f2", 0.3), ("A", "f3", 0.05)])
    top = rows_by(reports.top_features(psi, 2), "rank")
    assert [top[i]["feature_name"] for i in (1, 2)] == ["f1", "f2"]
    assert top[1]["level"] == "ALERT" and top[1]["max_psi"] == 0.3
    per = rows_by(reports.top_features_by_channel(psi, 1), "channel")
    assert (per["A"]["feature_name"], per["B"]["feature_name"]) == ("f2", "f1")


def test_monthly_flags_health_and_diagnosis(spark):
    drift = spark.createDataFrame([("m", "A", 0.12, 0.2, 0.16, 0.1), ("m", "B", 0.0, 0.0, 0.0, 0.0),
                                   ("q", "A", 0.0, 0.0, 0.0, 0.0)],
                                  "vintage_month string, channel string, score_psi double, score_ks double, "
                                  "pct_accounts_above_p90_baseline double, pct_accounts_above_p95_baseline double")
    psi = psi_rows(spark, [("B", "f1", 0.3), ("A", "f1", 0.11), ("A", "f2", 0.01)])
    quality = spark.createDataFrame([("m", "A", 0.02, 0.0)], "vintage_month string, channel string, "
                                    "missing_score_rate double, outlier_score_rate double")
    mix = spark.createDataFrame([("m", "A", "source", "organic", 10, 0.2), ("m", "A", "line", "Unknown", 3, 0.1)],
                                "vintage_month string, channel string, segment_type string, "
                                "segment_value string, account_count long, pct_of_channel_accounts double")
    perf = spark.createDataFrame([("m", "A", -0.04)], "vintage_month string, channel string, calibration_gap double")
    gaps = spark.createDataFrame([("m", "A", 1, 0.06)],
                                 "vintage_month string, channel string, score_bin int, calibration_gap double")
    flags = {(r["rule"], r["level"], r["channel"], r["subject"])
             for r in reports.monthly_flags(drift, psi, quality, mix).collect()}
    # Feature f1 is flagged once, at its first channel, with that channel's level.
    assert flags == {("score_psi", "WARN", "A", None), ("score_ks", "WARN", "A", None),
                     ("pct_accounts_above_p90_baseline", "WARN", "A", None), ("feature_psi", "WARN", "A", "f1"),
                     ("missing_score_rate", "WARN", "A", None), ("unknown_segment", "INFO", None, "line")}
    health = rows_by(reports.monthly_health(drift, psi, gaps), "vintage_month")
    assert (health["m"]["health"], health["q"]["health"]) == ("ALERT", "STABLE")
    found = {(r["vintage_month"], r["rule"], r["subject"])
             for r in reports.monthly_diagnosis(drift, psi, quality, mix, perf, gaps).collect()}
    assert found == {("m", "score_shift", None), ("m", "right_tail", None), ("m", "feature_drift", "f1"),
                     ("m", "source_share", "organic"), ("m", "calibration_gap", None),
                     ("m", "channel_gap", "overestimating"), ("m", "missing_score", None),
                     ("q", "no_issues", None)}


def test_a_named_metric_is_judged_like_a_column_of_it_and_without_loops(spark):
    rows = [(card, v) for card in ("overall", "SC001", "SC002") for v in (0.0, 0.09, 0.13, 0.26, 0.4, None)]
    df = spark.createDataFrame(rows, "scorecard string, value double")
    for metric in ("psi", "own", "ks_drop", "unheard_of"):
        named = governance.judge(df, LIMITS, metric, F.col("value"))
        by_column = governance.judge(df, LIMITS, F.concat(F.lit(metric), F.substring("scorecard", 1, 0)), F.col("value"))
        assert sorted(map(repr, named.collect())) == sorted(map(repr, by_column.collect()))
        for judged in (named, by_column):
            assert "NestedLoop" not in judged._jdf.queryExecution().executedPlan().toString()


def test_governance_takes_the_status_that_a_table_has(spark):
    df = spark.createDataFrame([("r1", "overall", "all", 0.3, 9.0, 9.9, "OK")],
                               "reporting_month string, scorecard string, channel string, score_psi double, "
                               "warning double, alert double, score_psi_status string")
    row = governance.governance_table(LIMITS, score_stability=df).first()
    assert (row["status"], row["warning"], row["alert"]) == ("OK", 9.0, 9.9)
    fresh = governance.governance_table(LIMITS, score_stability=df.drop("warning", "alert")).first()
    assert fresh["status"] == "ALERT"
