import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scorewatch.functions.columns import shift_month_col
from scorewatch.operators import cohorts, governance, outcomes, stability
from scorewatch.plans.spine import over_scopes
from scorewatch.spec import Baseline, Monitoring, SampleRules, Source, shift_month
from tests.conftest import rows_by

SPEC = Monitoring(
    source=Source(keys=("id",), month="score_month", score="score", channel="channel", channels=("A", "B")),
    sample=SampleRules(min_accounts_ks=10, min_bads_ks=2, min_accounts_bin=3),
    intervals=((0.0, 0.25), (0.25, 0.5), (0.5, 1.0)), ks_bins=4)
MART = "id long, score_month string, channel string, score double, is_excluded_from_monitoring int"
PERF = ("id long, score_month string, edr30_m3 int, edr60_m6 int, edr90_m9 int, co_m12 int, bad30_m3 int, "
        "bad60_m6 int, bad90_m9 int, badco_m12 int, is_mature_m3 int, is_mature_m6 int, is_mature_m9 int, "
        "is_mature_m12 int")
KEY = ["reporting_month", "maturity", "scorecard"]


def month_rows(month, n=20, start=0):
    return [(start + i, month, "A" if i % 2 else "B", i / n, 0) for i in range(n)]


@pytest.fixture(scope="module")
def marts(spark):
    months = ["2024-05", "2024-08", "2024-11", "2025-02", "2025-04", "2025-05"]
    rows = [r for k, m in enumerate(months) for r in month_rows(m, 20, 100 * k)]
    rows.append((999, "2025-05", "A", 0.5, 1))
    score = spark.createDataFrame(rows, MART)
    perf = [(i, m, *([int(s >= 0.5)] * 8), 1, 1, 1, int(m != "2024-05")) for i, m, _, s, _ in rows]
    return score, spark.createDataFrame(perf, PERF)


def cohort_frame(spark, pairs, month="2025-05", maturity="M3"):
    rows = [(month, maturity, "2025-02", i, "A" if i % 2 else "B", s, y, y)
            for i, (s, y) in enumerate(pairs)]
    return spark.createDataFrame(rows, "reporting_month string, maturity string, score_month string, id long, "
                                       "channel string, score double, edr int, bad int")


def test_month_arithmetic():
    assert [shift_month("2025-05", -k) for k in (3, 6, 9, 12)] == ["2025-02", "2024-11", "2024-08", "2024-05"]
    assert cohorts.backfill_range("2025-02", 3) == ["2024-11", "2024-12", "2025-01", "2025-02"]


def test_exclusion_filter(spark, marts):
    assert cohorts.monitored(marts[0], SPEC).count() == 120
    bare = marts[0].drop("is_excluded_from_monitoring")
    assert cohorts.monitored(bare, SPEC).count() == 121
    nulls = marts[0].withColumn("is_excluded_from_monitoring", F.lit(None).cast("int"))
    assert cohorts.monitored(nulls, SPEC).count() == 0


@pytest.mark.parametrize("months", [["2025-05"], None])
def test_cohorts_align_each_window_to_its_month(spark, marts, months):
    got = cohorts.performance_cohorts(*marts, SPEC, months).filter("reporting_month = '2025-05'")
    counts = rows_by(got.groupBy("maturity", "score_month").count(), "maturity")
    assert {m: (r["score_month"], r["count"]) for m, r in counts.items()} == {
        "M3": ("2025-02", 20), "M6": ("2024-11", 20), "M9": ("2024-08", 20)}


def test_cohort_info_notes(spark, marts):
    got = rows_by(cohorts.cohort_info(*marts, SPEC, ["2025-05"]), "maturity")
    assert got["M3"]["available"] and got["M3"]["note"] == ""
    assert not got["M12"]["available"] and got["M12"]["account_count"] == 20
    assert got["M12"]["note"] == "No mature accounts available yet"
    # Months without scored accounts are not listed.
    assert cohorts.cohort_info(*marts, SPEC, ["2030-01"]).count() == 0


def test_missing_maturity_flag(spark, marts):
    perf = marts[1].drop("is_mature_m6")
    got = rows_by(cohorts.cohort_info(marts[0], perf, SPEC, ["2025-05"]), "maturity")
    assert got["M6"]["note"] == "Maturity flag 'is_mature_m6' not available"
    assert got["M6"]["account_count"] == 0 and got["M3"]["available"]
    with pytest.raises(ValueError, match="is_mature_m6"):
        cohorts.performance_cohorts(marts[0], perf, replace(SPEC, on_missing_maturity="fail"), ["2025-05"])


def test_baselines(spark, marts):
    def info(baseline, months=None):
        return cohorts.baseline_info(marts[0], replace(SPEC, baseline=baseline), months).collect()

    fixed = info(Baseline("fixed_window", "2024-08", "2024-12"))[0]
    assert (fixed["months"], fixed["account_count"]) == (["2024-08", "2024-11"], 40)
    rolling = info(Baseline("rolling_window", months=3), ["2025-05"])[0]
    assert (rolling["start_month"], rolling["end_month"]) == ("2025-02", "2025-04")
    assert rolling["months"] == ["2025-02", "2025-04"] and rolling["account_count"] == 40
    empty = info(Baseline("rolling_window", months=2), ["2020-01"])[0]
    assert (empty["months"], empty["account_count"]) == ([], 0)
    for baseline in (Baseline("initial_val", months=2), Baseline("fixed_window", months=2)):
        first = info(baseline)[0]
        assert first["baseline_type"] == "initial_val"
        assert (first["start_month"], first["end_month"], first["account_count"]) == ("2024-05", "2024-08", 40)
    assert info(Baseline("initial_val", months=99))[0]["account_count"] == 120


def test_join_coverage(spark):
    score = spark.createDataFrame([(1, "m1", "A", 0.1, 0), (2, "m1", "A", 0.1, 0), (3, "m2", "A", 0.1, 0)], MART)
    perf = spark.createDataFrame([(1, "m1", *[0] * 8, 1, 0, 0, 0), (9, "m3", *[0] * 8, 1, 1, 1, 1)], PERF)
    got = rows_by(cohorts.join_coverage(score, perf, SPEC), "score_month")
    assert [got[m]["status"] for m in ("m1", "m2", "m3")] == ["OK", "join=0", "no data"]
    assert (got["m1"]["score_rows"], got["m1"]["joined_rows"], got["m1"]["mature_m3"]) == (2, 1, 1)


def test_backfill_readiness(spark, marts):
    row = cohorts.backfill_readiness(marts[0], SPEC).first()
    assert (row["months"], row["required"], row["is_ready"]) == (6, 12, False)


def test_latest_vintage(spark):
    df = spark.createDataFrame([("2024-01", 1), ("2024-03", 2)], "vintage_month string, n int")
    assert cohorts.latest_vintage(df, "vintage_month", "2024-01").first()["n"] == 1
    assert cohorts.latest_vintage(df, "vintage_month", "2025-01").first()["n"] == 2


def test_scopes(spark):
    df = spark.createDataFrame([("A", "S1", 1), (None, "S1", 2), ("Z", None, 3)],
                               "channel string, card string, n int")
    got = {(r["scorecard"], r["channel"], r["n"]) for r in over_scopes(df, "channel", ["A", "B"], "card").collect()}
    assert got == {("overall", "all", 1), ("overall", "A", 1), ("S1", "all", 1), ("S1", "A", 1),
                   ("overall", "all", 2), ("S1", "all", 2), ("overall", "all", 3)}


def test_performance_and_notes(spark):
    df = cohort_frame(spark, [(0.1, 0), (0.9, 1), (0.8, 1), (0.2, None)])
    perf = outcomes.performance(df, SPEC)
    got = rows_by(perf, "channel")
    assert (got["all"]["account_count"], got["all"]["edr_count"]) == (4, 2)
    assert got["all"]["edr"] == pytest.approx(2 / 3) and got["A"]["edr"] == 1.0
    info = spark.createDataFrame([("2025-05", "M12", "2024-05", False, "why")],
                                 "reporting_month string, maturity string, score_month string, available boolean, "
                                 "note string")
    base = spark.createDataFrame([("M3", "overall", "all", 0.5)],
                                 "maturity string, scorecard string, channel string, edr double")
    report = rows_by(outcomes.performance_report(perf, base, info), "maturity", "channel")
    assert report["M3", "all"]["edr_delta"] == pytest.approx(2 / 3 - 0.5)
    assert report["M12", "all"]["note"] == "why" and report["M12", "all"]["display_label"] == "CO"
    assert report["M3", "A"]["edr_delta"] is None


def test_rank_ordering_flags_falling_rates(spark):
    df = cohort_frame(spark, [(0.1, 1), (0.2, 0), (0.9, 0), (1.0, 1), (0.7, 0), (7.0, 1), (None, 0), (0.5, 0)])
    got = rows_by(outcomes.rank_ordering(df, SPEC), "interval")
    assert [got[i]["accounts_n"] for i in ("0.00-0.25", "0.25-0.50", "0.50-1.00")] == [2, 0, 4]
    assert [got[i]["misrank"] for i in ("0.00-0.25", "0.25-0.50", "0.50-1.00")] == ["NO", "YES", "NO"]
    assert got["0.00-0.25"]["accounts_pct"] == 2 / 8 and got["0.25-0.50"]["observation_pct"] == 0.0


def test_risk_capture(spark):
    row = outcomes.risk_capture(cohort_frame(spark, [(0.1, 1), (0.5, 1), (0.9, 0), (None, 0)]), SPEC).first()
    assert (row["pct_population_flagged"], row["pct_bad_captured"]) == (0.5, 0.5)
    none = outcomes.risk_capture(cohort_frame(spark, [(0.9, 0)]), SPEC).first()
    assert none["pct_bad_captured"] == 0.0


def test_calibration_only_for_the_last_window(spark):
    pairs = [(i / 10, int(i >= 5)) for i in range(10)]
    df = (cohort_frame(spark, pairs, maturity="M12").unionByName(cohort_frame(spark, pairs))
          .withColumn("score_decile_static", F.when(F.col("score") > 0, (F.col("score") >= 0.5).cast("int") + 1)))
    rows = rows_by(outcomes.calibration(df, SPEC), "channel", "score_bin")
    assert {r["maturity"] for r in rows.values()} == {"M12"}
    row = rows["all", 2]
    assert (row["account_count"], row["bad_count"]) == (5, 5)
    assert row["calibration_gap"] == pytest.approx(1 - 0.7)
    # The null decile is bin 0; its single row makes the sample too small.
    assert rows["all", 0]["account_count"] == 1 and not row["sample_sufficient"]


def test_calibration_summary_takes_the_first_of_equal_gaps(spark):
    gaps = [("A", 3, 0.25), ("A", 2, -0.5), ("B", 1, 0.5), ("B", 2, 0.0)]
    table = spark.createDataFrame([("r", "M12", "overall", *g) for g in gaps],
                                  "reporting_month string, maturity string, scorecard string, channel string, "
                                  "score_bin int, calibration_gap double")
    row = outcomes.calibration_summary(table, KEY).first()
    assert (row["worst_bin"], row["max_abs_gap"], row["mean_abs_gap"]) == (2, 0.5, 0.3125)


def test_separation_guard(spark):
    few = outcomes.separation(cohort_frame(spark, [(0.1, 0)] * 9), SPEC).first()
    assert few["ks"] is None and few["note"] == "Insufficient accounts: 9 < 10"
    bads = outcomes.separation(cohort_frame(spark, [(0.1, 0)] * 10 + [(0.5, 1)]), SPEC).first()
    assert bads["gini"] is None and bads["note"] == "Insufficient bads: 1 < 2"
    good = outcomes.separation(cohort_frame(spark, [(0.1, 0)] * 10 + [(0.5, 1)] * 2), SPEC).first()
    assert (good["ks"], good["gini"], good["note"]) == (1.0, 1.0, None)


def test_ks_drop(spark):
    now = outcomes.separation(cohort_frame(spark, [(0.1, 0), (0.5, 0)] * 5 + [(0.5, 1)] * 2), SPEC)
    base = cohort_frame(spark, [(0.1, 0)] * 3 + [(0.5, 1)] * 2).drop("reporting_month")
    row = outcomes.ks_drop(now, base, SPEC).first()
    assert row["baseline_ks"] == 1.0 and row["ks_drop"] == pytest.approx(-0.5)
    one_sided = outcomes.ks_drop(now, base.filter("bad = 0"), SPEC).first()
    assert one_sided["ks_drop"] is None


def test_odds_order_follows_the_direction_of_risk(spark):
    pairs = [(float(d), y) for d, bads in ((1, 0), (2, 1), (3, 3)) for y in [1] * bads + [0] * (4 - bads)]
    df = cohort_frame(spark, pairs).withColumn("score_decile_static", F.col("score").cast("int"))
    got = rows_by(outcomes.odds(df, SPEC), "score_bin")
    assert [got[d]["odds"] for d in (1, 2, 3)] == [None, 3.0, pytest.approx(1 / 3)]
    assert all(r["is_monotonic"] and r["total_misranks"] == 0 for r in got.values())
    flipped = rows_by(outcomes.odds(df, replace(SPEC, higher_score_is_riskier=False)), "score_bin")
    assert [flipped[d]["is_monotonic"] for d in (1, 2, 3)] == [True, False, False]
    assert flipped[1]["total_misranks"] == 2


def test_ks_table(spark, plan):
    pairs = [(i / 10, int(i % 3 == 0)) for i in range(10)] + [(None, 1), (0.3, None)]
    got = rows_by(outcomes.ks_table(cohort_frame(spark, pairs), SPEC), "tier")
    assert set(got) == {"1", "2", "3", "4", "TOTAL"}
    # Tier of position i is floor(i * 4 / 10) + 1: sizes 3, 2, 3, 2.
    assert [got[str(t)]["accounts_n"] for t in range(1, 5)] == [3, 2, 3, 2]
    assert [got[str(t)]["bads_n"] for t in range(1, 5)] == [1, 1, 1, 1]
    assert got["2"]["goods_pct"] == pytest.approx(3 / 6) and got["2"]["bads_pct"] == 0.5
    assert got["1"]["lift"] == pytest.approx((1 / 3) / 0.4)
    total = got["TOTAL"]
    assert (total["accounts_n"], total["goods_n"], total["bads_n"], total["lift"]) == (10, 6, 4, 1.0)
    assert total["ks"] == max(got[str(t)]["ks"] for t in range(1, 5))
    assert outcomes.ks_table(cohort_frame(spark, pairs[:5]), SPEC).count() == 0


def test_vintage_performance_keeps_unmatched_accounts(spark):
    now = spark.createDataFrame([(1, "m", "A", 0.2, 1), (2, "m", "A", 0.4, 2)],
                                "id long, vintage_month string, channel string, score double, d int")
    actual = spark.createDataFrame([(1, "m", 1, 1, 0, 0)],
                                   "id long, vintage_month string, is_bad int, edr30 int, edr60 int, edr90 int")
    row = outcomes.vintage_performance(now, actual, SPEC.source).first()
    assert row["account_count"] == 2 and row["actual_bad_rate"] == 1.0
    assert row["calibration_gap"] == pytest.approx(1 - 0.3)
    bins = rows_by(outcomes.vintage_calibration(now, actual, SPEC.source, "d"), "score_bin")
    assert bins[1]["actual_rate"] == 1.0 and bins[2]["actual_rate"] is None


def test_availability_counts_rows(spark):
    spine = spark.createDataFrame([("r1",), ("r2",)], "reporting_month string")
    some = spark.createDataFrame([("r1",)], "reporting_month string")
    info = spark.createDataFrame([("r2", "M12", False, "")],
                                 "reporting_month string, maturity string, available boolean, note string")
    got = rows_by(governance.availability(spine, {"stability": some, "calibration": some}, info),
                  "reporting_month", "section")
    assert got["r1", "calibration"]["available"] and got["r1", "calibration"]["reason"] is None
    assert got["r2", "calibration"]["reason"] == governance.NOT_MATURE
    assert got["r2", "stability"]["reason"] == governance.EMPTY_SEGMENT and not got["r2", "stability"]["available"]
    assert got["r2", "cohort_M12"]["reason"] == governance.NOT_MATURE


def test_each_reason_code(spark):
    spine = spark.createDataFrame([(f"r{i}",) for i in range(4)], "reporting_month string")
    info = spark.createDataFrame(
        [("r0", "M3", False, ""), ("r0", "M12", False, "note"), ("r1", "M3", True, ""), ("r1", "M12", False, ""),
         ("r2", "M12", True, "")], "reporting_month string, maturity string, available boolean, note string")
    none = spine.limit(0)
    sections = {n: none for n in ("stability", "separation", "performance", "calibration", "attribution", "flags")}
    got = {k: r["reason"] for k, r in rows_by(governance.availability(spine, sections, info),
                                              "reporting_month", "section").items()}
    assert [got[f"r{i}", "calibration"] for i in range(4)] == [
        governance.NOT_MATURE, governance.NOT_M12, governance.SAMPLE_SIZE, governance.NOT_MATURE]
    assert [got[f"r{i}", "separation"] for i in range(4)] == [
        governance.NO_ACTUALS, governance.SAMPLE_SIZE, governance.SAMPLE_SIZE, governance.NO_ACTUALS]
    assert got["r1", "performance"] == governance.NO_ACTUALS and got["r1", "stability"] == governance.EMPTY_SEGMENT
    assert got["r1", "attribution"] is None and got["r1", "flags"] is None and got["r0", "cohort_M12"] == "note"
    without = rows_by(governance.availability(spine, {"stability": spine}, None), "reporting_month", "section")
    assert {without["r0", s]["reason"] for s in governance.OUTCOME_SECTIONS} == {governance.DATA_MODE}
    assert without["r0", "stability"]["available"]


def test_merged_monthly_counts_are_the_baseline_rows(spark):
    rows = [(i, f"2024-{1 + i % 5:02d}", "A" if i % 3 else "B", (i % 7) / 10) for i in range(60)]
    mart = spark.createDataFrame(rows, "id long, month string, channel string, score double")
    for kind in ("rolling_window", "initial_val"):
        spec = replace(SPEC, baseline=Baseline(kind, months=2), source=replace(
            SPEC.source, month="month", score="score", channel="channel"), scorecard=None)
        for months in (None, ["2024-03", "2024-06"]):
            by = cohorts.baseline_keys(spec.baseline)
            columns = ["channel", "score"]
            counted = cohorts.baseline_counts(cohorts.monthly_counts(mart, spec, columns), spec, months)
            direct = cohorts.baseline_rows(mart, spec, months).groupBy(*by, *columns).agg(
                F.count(F.lit(1)).alias("n"))
            assert sorted(counted.collect()) == sorted(direct.select(*counted.columns).collect())


def test_stability_of_windows_reads_each_month_once(spark, plan):
    rows = [(i, f"2024-{1 + i % 6:02d}", ["A", "B", "x", None][i % 4], None if i % 11 == 0 else (i * i % 37) / 37,
             "S1" if i % 5 else None) for i in range(400)]
    mart = spark.createDataFrame(rows, "id long, score_month string, channel string, score double, card string")
    columns = ["channel", "score", "card"]
    for setting in (Baseline("rolling_window", months=2), Baseline("fixed_window", "2024-01", "2024-03")):
        spec = replace(SPEC, baseline=setting, scorecard="card", n_bins=4)
        by, monthly = cohorts.baseline_keys(setting), cohorts.monthly_counts(mart, spec, columns)
        now = cohorts.current_cohort(mart, spec)
        once = stability.score_stability(now, monthly, spec, by, cohorts.baseline_windows(monthly, spec))
        baseline = cohorts.baseline_rows(mart, spec)
        key = ["reporting_month", "scorecard", "channel"]
        got, want = rows_by(once, *key), rows_by(stability.score_stability(now, baseline, spec, by), *key)
        assert got.keys() == want.keys()
        assert all(got[k][c] == pytest.approx(want[k][c], abs=1e-12) for k in got for c in once.columns[3:])
        # By hand: the two months before, all accounts of one month.
        scores = sorted(r[3] for r in rows if r[1] in (("2024-02", "2024-03") if by else
                                                      ("2024-01", "2024-02", "2024-03")) and r[3] is not None)
        edges = [scores[-(-len(scores) * i // 4) - 1] for i in (1, 2, 3)]
        parts = []
        for side in (scores, [r[3] for r in rows if r[1] == "2024-04" and r[3] is not None]):
            bins = [sum(e < v for e in edges) for v in side]
            parts.append([max(bins.count(b) / len(bins), 1e-4) for b in range(4)])
        psi = sum((b - a) * math.log(b / a) for a, b in zip(*parts))
        assert got["2024-04", "overall", "all"]["score_psi"] == pytest.approx(psi, abs=1e-9)


def test_month_column_moves_like_the_month(spark):
    df = spark.createDataFrame([("2024-01",), ("1999-12",), ("junk",), (None,)], "m string")
    for k in (-13, -1, 0, 1, 12, 25):
        got = rows_by(df.select("m", shift_month_col(F.col("m"), k).alias("to")), "m")
        assert [got[m]["to"] for m in ("2024-01", "1999-12")] == [shift_month(m, k) for m in ("2024-01", "1999-12")]
        assert got["junk"]["to"] is None and got[None]["to"] is None


def plan_lines(df):
    """Lines of the physical plan; of an aggregate's, the deepest reads the rows."""
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def test_outcome_totals_do_not_sort_rows(spark, marts):
    rows = cohorts.performance_cohorts(*marts, SPEC, ["2025-05"])
    rows = rows.withColumn(SPEC.decile_col, F.lit(1))
    for table in (outcomes.performance(rows, SPEC), outcomes.calibration(rows, SPEC)):
        over_rows = [line for line in plan_lines(table) if "Aggregate(" in line and "sum(" in line][-1]
        assert "HashAggregate" in over_rows


def test_months_are_shifted_once_a_month(spark, marts):
    split = [line for line in plan_lines(cohorts.performance_cohorts(*marts, SPEC)) if "Generate explode" in line]
    assert split and not any("lpad" in line for line in split if "edr" in line)
