import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scorewatch.plans import jobs
from scorewatch.plans.staging import shared_folder, stage, staged
from scorewatch.sources import tables
from scorewatch.spec import (Attribution, Baseline, Bucket, DriftSpec, Enrichment, Metric, Monitoring,
                             SampleRules, Segment, Share, Source, TableSpec)
from tests.conftest import rows_by

SOURCE = Source(keys=("account_id",), month="month", score="score", channel="channel",
                channels=("A", "B"), features=("feat_a", "feat_b"), business=("amount",),
                table="scored")
ENRICHMENT = Enrichment(
    dynamic_partition=("month", "channel"), n_bins=5, decile_col="dec", band_col="band",
    bands={"Low": (1, 2), "High": (3, 4, 5)}, static_bins=5, static_col="dec_static",
    buckets=(Bucket("amount_bucket", "amount", (100, 500), ("Low", "Mid", "High")),),
    flags={"dq_missing_flag": "CASE WHEN score IS NULL THEN 1 ELSE 0 END"},
    hook=lambda df: df.withColumn("hooked", F.lit(1)))
COUNT = (Metric("count", "account_count"), Metric("avg", "avg_score", "score"))
TABLES = (TableSpec("overall_summary", ("vintage_month", "channel"), COUNT),
          TableSpec("score_distribution", ("vintage_month", "channel", "dec"), COUNT,
                    (Share("pct_of_channel_vintage_accounts", "account_count",
                           ("vintage_month", "channel")),)),
          TableSpec("by_source", ("vintage_month", "channel", "amount_bucket"), COUNT),
          TableSpec("by_line", ("vintage_month", "channel", "band"), COUNT))
DRIFT = DriftSpec(n_bins=5, segments=(Segment("amount_bucket", "amount_bucket"), Segment("band", "band")))
SCHEMA = ("account_id long, month string, score double, amount double, channel string, feat_a double, "
          "feat_b double")


def scored(spark, months, per=20, seed=1):
    rng = random.Random(seed)
    rows = [(k * 1000 + i, m, rng.random(), rng.random() * 900, "AB"[i % 2], rng.gauss(0, 1), float(i % 7))
            for k, m in enumerate(months) for i in range(per)]
    return spark.createDataFrame(rows, SCHEMA)


def run(spark, months=("2025-05",), **more):
    current = scored(spark, months)
    base = scored(spark, ("2025-01", "2025-02"), seed=2)
    return current, jobs.run_report(current, base, SOURCE, ENRICHMENT, TABLES, DRIFT, "2025-05", "v1", **more)


def test_read_scores_filters_by_month(spark):
    scored(spark, ["2025-01", "2025-02", "2025-03"]).createOrReplaceTempView("scored")
    assert tables.read_scores(spark, SOURCE).count() == 60
    assert tables.read_scores(spark, SOURCE, "2025-02").count() == 20
    # A range is inclusive and wins over a month.
    assert tables.read_scores(spark, SOURCE, "2025-01", ("2025-02", "2025-03")).count() == 40
    with pytest.raises(ValueError, match="absent"):
        tables.read_scores(spark, replace(SOURCE, features=("absent",)))


def test_month_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    scored(spark, ["2025-01", "2025-02"]).write.partitionBy("month").parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("scored")
    plan = tables.read_scores(spark, SOURCE, "2025-02").select("score")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in text and "ReadSchema: struct<score:double>" in text


def test_read_outcomes_checks_keys(spark):
    spark.createDataFrame([(1, "m", 0)], "account_id long, mon string, edr30_m3 int").createOrReplaceTempView("perf")
    assert "score_month" in tables.read_outcomes(spark, "perf", ["account_id"], "mon").columns
    with pytest.raises(ValueError, match="other"):
        tables.read_outcomes(spark, "perf", ["other"], "mon")
    with pytest.raises(ValueError, match="score_month"):
        tables.read_outcomes(spark, "perf", ["account_id"])


def test_mart_checks(spark):
    spec = Monitoring(source=replace(SOURCE, month="score_month"))
    df = spark.createDataFrame([], "account_id long, score_month string, score double, channel string")
    assert tables.check_score_mart(df, spec) == []
    assert len(tables.check_score_mart(df.drop("score"), spec)) == 1
    assert len(tables.check_performance_mart(df, spec)) == 2
    with pytest.raises(ValueError, match="account_id"):
        tables.check_performance_mart(df.drop("account_id"), spec)
    perf = spark.createDataFrame([], "account_id long, score_month string, edr30_m3 int, is_mature_m6 int")
    assert tables.check_performance_mart(perf, spec) == []
    assert tables.available_maturities(perf) == ["M6"]


def test_rewriting_a_month_keeps_the_others(spark):
    spark.sql("DROP TABLE IF EXISTS result")
    for month, value in (("2025-01", 1), ("2025-02", 2), ("2025-01", 3)):
        df = tables.stamp(spark.createDataFrame([(value,)], "n int"), month, "v1")
        tables.write_table(df, "result")
    got = {(r["score_month"], r["n"]) for r in spark.table("result").collect()}
    assert got == {("2025-01", 3), ("2025-02", 2)}
    spark.sql("DROP TABLE result")


def test_a_table_without_its_partition_columns_is_not_written(spark):
    with pytest.raises(ValueError, match="model_version"):
        tables.write_table(spark.createDataFrame([(1, "2025-01")], "n int, score_month string"), "result")
    assert not spark.catalog.tableExists("result")


def test_six_places_keep_large_and_odd_doubles(spark):
    from scorewatch.workload.queries import six_places
    given = [1e13, 1e18, float("inf"), -2.5e-7, 0.0078125, -0.0000005, 0.1 + 0.2, None]
    rows = spark.createDataFrame([(x,) for x in [*given, float("nan")]], "x double")
    got = [r[0] for r in rows.select(six_places(F.col("x"))).collect()]
    assert got[:-1] == [1e13, 1e18, float("inf"), 0.0, 0.007813, -0.000001, 0.3, None]
    assert got[-1] != got[-1]


def test_stage_keeps_types_and_partitions(spark):
    df = spark.createDataFrame([("2025-01", 1.5, None)], "m string, v double, s string")
    back = stage(df, "x", ["m"])
    assert dict(back.dtypes) == dict(df.dtypes) and back.first()["m"] == "2025-01"
    calls = []
    for _ in range(2):
        staged(spark, "once", lambda: calls.append(1) or df)
    assert len(calls) == 1
    assert spark.sparkContext.applicationId in back.inputFiles()[0]


class FakeSession:
    """Just enough of a session to ask for its folders."""

    def __init__(self, setting=None, checkpoints=None, master="yarn"):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.master, self.checkpoints = master, checkpoints

    def getCheckpointDir(self):
        return self.checkpoints


def test_shared_folder_comes_from_the_session():
    assert shared_folder(FakeSession("/shared/checkpoints/")) == "/shared/checkpoints"
    assert shared_folder(FakeSession(checkpoints="hdfs:/c")) == "hdfs:/c"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession())


def test_report_run_end_to_end(spark):
    actuals = spark.createDataFrame([(i, "2025-05", i % 3 == 0) for i in range(20)],
                                    "account_id long, vintage_month string, f boolean").select(
        "account_id", "vintage_month", *[F.col("f").cast("int").alias(c)
                                         for c in ("is_bad", "edr30", "edr60", "edr90")])
    written = []
    current, out = run(spark, actuals=actuals, write=lambda df, name: written.append(name))
    assert set(written) == set(out)
    account = out["account"]
    assert account.count() == 20 and account.first()["hooked"] == 1
    assert {r["dec"] for r in account.collect()} == {1, 2, 3, 4, 5}
    for df in out.values():
        assert {"score_month", "model_version"} <= set(df.columns)
    drift = rows_by(out["score_drift"], "channel")
    assert set(drift) == {"A", "B"} and all(0 <= r["score_ks"] <= 1 for r in drift.values())
    assert out["feature_psi"].count() == 4 and out["feature_score_relationship"].count() == 4
    mix = out["population_mix"].groupBy("channel", "segment_type").agg(
        F.sum("pct_of_channel_accounts").alias("s"))
    assert all(r["s"] == pytest.approx(1) for r in mix.collect())
    assert out["performance"].count() == 2
    checked = rows_by(jobs.run_checks(current, out, SOURCE, ENRICHMENT), "check")
    failed = {name for name, r in checked.items() if not r["passed"]}
    # Ten accounts per channel drift by chance; everything else must reconcile.
    assert failed <= {"largest_score_psi"}
    assert {"flags", "health", "diagnosis", "top_features"} <= set(jobs.report_views(out, SOURCE))


def test_layers_can_be_asked_for_separately(spark):
    assert set(run(spark, layers=(2,))[1]) == {t.name for t in TABLES}
    assert "account" in run(spark, layers=(1,))[1]


def test_number_of_jobs_does_not_grow_with_months(spark):
    tracker = spark.sparkContext.statusTracker()

    def jobs_of(months):
        group = f"months-{len(months)}"
        spark.sparkContext.setJobGroup(group, group)
        _, out = run(spark, months, layers=(3,))
        out["score_drift"].collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    few, many = jobs_of(["2025-05"]), jobs_of([f"2025-{m:02d}" for m in range(3, 9)])
    assert many <= few + 3


@pytest.fixture(scope="module")
def marts(spark):
    months = ["2024-05", "2024-08", "2024-11", "2025-01", "2025-02", "2025-04", "2025-05"]
    score = (scored(spark, months, per=60).withColumnRenamed("month", "score_month")
             .withColumn("card", F.when(F.col("account_id") % 3 == 0, "S1").otherwise("S2"))
             .withColumn("score_decile_static", (F.col("score") * 10).cast("int") + 1))
    bad = (F.col("score") > 0.6).cast("int")
    outcomes = ["edr30_m3", "edr60_m6", "edr90_m9", "co_m12", "bad30_m3", "bad60_m6", "bad90_m9", "badco_m12"]
    perf = score.select("account_id", "score_month", *[bad.alias(c) for c in outcomes],
                        *[F.lit(1).alias(f"is_mature_m{k}") for k in (3, 6, 9, 12)])
    return score, perf


def monitoring(baseline):
    return Monitoring(source=replace(SOURCE, month="score_month", business=()), baseline=baseline,
                      sample=SampleRules(20, 5, 2), scorecard="card",
                      attribution=Attribution(drivers=("channel", "score_decile_static")))


def test_monitoring_run_end_to_end(spark, marts):
    spec = monitoring(Baseline("fixed_window", "2024-05", "2024-11"))
    out = jobs.run_monitoring(*marts, spec, ["2025-05"])
    stability = rows_by(out["score_stability"], "scorecard", "channel")
    assert set(stability) == {(c, h) for c in ("overall", "S1", "S2") for h in ("all", "A", "B")}
    assert rows_by(out["cohort_info"], "maturity")["M12"]["score_month"] == "2024-05"
    separated = rows_by(out["separation"], "maturity", "scorecard")
    assert separated["M3", "overall"]["ks"] == 1.0 and separated["M3", "overall"]["ks_drop_status"] == "OK"
    assert separated["M3", "overall"]["misrank_count"] == 0
    assert out["ks_table"].filter("maturity = 'M3' and scorecard = 'overall'").count() == 21
    assert {r["maturity"] for r in out["calibration"].collect()} == {"M12"}
    assert out["psi_table"].count() == 30 and out["rank_ordering"].count() == 120
    available = rows_by(out["availability"], "reporting_month", "section")
    assert available["2025-05", "separation"]["available"]
    assert out["health"].first()["overall_health"] in ("OK", "WARNING", "ALERT")
    flagged = {r["metric"] for r in out["flags"].collect()}
    assert any(m.startswith("calibration_gap:M12:bin") for m in flagged)
    assert out["diagnosis"].count() > 0 and out["portfolio"].count() == 3
    jobs.release(out)


def test_monitoring_run_with_rolling_baseline_and_no_outcomes(spark, marts):
    out = jobs.run_monitoring(marts[0], None, monitoring(Baseline("rolling_window", months=3)))
    assert "separation" not in out and "diagnosis" not in out
    assert out["baseline_info"].count() == 7
    months = {r["reporting_month"] for r in out["score_stability"].collect()}
    assert len(months) == 7
    assert out["csi_table"].count() > 0 and out["governance"].count() > 0
    jobs.release(out)


def test_monitoring_run_with_rolling_baseline(spark, marts):
    out = jobs.run_monitoring(*marts, monitoring(Baseline("rolling_window", months=3)), ["2025-05"])
    got = rows_by(out["separation"], "maturity", "scorecard")
    assert got["M6", "overall"]["ks_drop"] == 0.0
    perf = rows_by(out["performance"], "maturity", "scorecard", "channel")
    assert perf["M3", "overall", "all"]["edr_delta"] is not None
    jobs.release(out)


def test_writing_a_monitoring_run_needs_a_version(spark, marts):
    with pytest.raises(ValueError, match="version"):
        jobs.run_monitoring(*marts, monitoring(Baseline("fixed_window", "2024-05", "2024-11")),
                            ["2025-05"], write=lambda df, name: None)


def test_reporting_months_keep_their_rows_when_others_are_written(spark):
    cohorts = "reporting_month string, score_month string, n int"
    for name in ("cohort_rows", "run_rows"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    # The cohort month 2001-02 is M3 of one reporting month and M6 of another.
    for month, cohort, n in (("2001-05", "2001-02", 1), ("2001-08", "2001-02", 2), ("2001-05", "2001-02", 3)):
        spine = spark.createDataFrame([(month,)], "reporting_month string")
        by_cohort = spark.createDataFrame([(month, cohort, n)], cohorts)
        whole_run = spark.createDataFrame([(n,)], "n int")
        for name, df in (("cohort_rows", by_cohort), ("run_rows", whole_run)):
            tables.write_monitoring_table(jobs.stamp_run(df, spine, "v1"), name)
    for name in ("cohort_rows", "run_rows"):
        got = {(r["reporting_month"], r["model_version"], r["n"]) for r in spark.table(name).collect()}
        assert got == {("2001-05", "v1", 3), ("2001-08", "v1", 2)}
        spark.sql(f"DROP TABLE {name}")


def test_a_feature_without_values_keeps_its_stability_row(spark, marts):
    from scorewatch.operators import cohorts, stability
    spec = monitoring(Baseline("fixed_window", "2024-05", "2024-11"))
    dead = spec.source.features[0]
    mart = marts[0].withColumn(dead, F.when(F.col(spec.source.month) != "2025-05", F.col(dead)))
    rows = stability.feature_stability(cohorts.current_cohort(mart, spec, ["2025-05"]),
                                       cohorts.baseline_rows(mart, spec, ["2025-05"]), spec)
    got = rows_by(rows, "scorecard", "feature_name")
    assert len(got) == 3 * len(spec.source.features)
    assert got["overall", dead]["psi"] == 0.0 and got["overall", dead]["current_mean"] is None


def test_checks_fail_on_empty_and_incomplete_tables(spark):
    current, out = run(spark)
    name = "largest_score_psi", "drift_mean_matches_summary", "mix_accounts_match_summary"

    def passed(**spoilt):
        return {r["check"]: r["passed"] for r in jobs.run_checks(
            current, out | spoilt, SOURCE, ENRICHMENT).filter(F.col("check").isin(*name)).collect()}

    whole = passed()
    assert whole["drift_mean_matches_summary"] and whole["mix_accounts_match_summary"]
    none = passed(score_drift=out["score_drift"].limit(0), population_mix=out["population_mix"].limit(0))
    assert not any(none.values())
    part = passed(score_drift=out["score_drift"].filter("channel = 'A'"))
    assert not part["drift_mean_matches_summary"] and part["mix_accounts_match_summary"]


def test_checks_see_absent_channels_segments_and_repeated_rows(spark):
    current, out = run(spark)
    names = ["business_channels_absent", "monitoring_channels_absent", "bucket_tables_empty", "segment_types_absent",
             "duplicate_data_quality_rows", "feature_score_relationship_groups_incomplete"]

    def value(name, segments=(), **spoilt):
        found = rows_by(jobs.run_checks(current, out | spoilt, SOURCE, ENRICHMENT, segments), "check")
        assert set(names) <= set(found)
        return found[name]["value"], found[name]["passed"]

    for name in names:
        assert value(name) == (0.0, True)
    only_a = "channel = 'A'"
    assert value(names[0], by_source=out["by_source"].filter(only_a)) == (1.0, False)
    assert value(names[1], feature_psi=out["feature_psi"].filter(only_a)) == (1.0, False)
    kinds = out["population_mix"].select("segment_type").distinct().collect()
    wanted = [Segment(k[0], k[0]) for k in kinds] + [Segment("x", "elsewhere")]
    assert value(names[3], wanted) == (1.0, False) and value(names[3], wanted[:-1]) == (0.0, True)
    assert value(names[4], data_quality=out["data_quality"].union(out["data_quality"])) == (2.0, False)
    fewer = out["feature_score_relationship"].limit(3)
    assert not value(names[5], feature_score_relationship=fewer)[1]


def test_report_builds_the_wanted_tables_only(spark, monkeypatch):
    monkeypatch.setattr(jobs.drift, "feature_psi", None)
    monkeypatch.setattr(jobs.enrich, "enrich", None)
    account = spark.createDataFrame([("2025-04", "web", 0.5, 0.1)],
                                    "vintage_month string, channel string, mean_score double, score_psi double")
    monkeypatch.setattr(jobs, "require_columns", lambda *_: None)
    monkeypatch.setattr(jobs.drift, "score_drift", lambda account, *_: account)
    out = jobs.run_report(account, account, SOURCE, ENRICHMENT, TABLES, DRIFT, "2025-05", "v1", layers=(3,),
                          only=["score_drift"], account=account)
    assert list(out) == ["score_drift"]
    assert list(jobs.report_views(out, SOURCE)) == ["drift_trend"]


def test_monitoring_sizes_no_unwanted_leaf_table(spark, marts, monkeypatch):
    monkeypatch.setattr(jobs.drift, "psi_table", None)
    monkeypatch.setattr(jobs.drift, "csi_table", None)
    monkeypatch.setattr(jobs.outcomes, "ks_table", None)
    out = jobs.run_monitoring(*marts, monitoring(Baseline("fixed_window", "2024-05", "2024-11")), ["2025-05"],
                              only=["diagnosis", "availability"])
    assert {"diagnosis", "availability"} <= set(out) and not {"psi_table", "csi_table", "ks_table"} & set(out)
