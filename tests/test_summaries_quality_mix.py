import pytest
from pyspark.sql import functions as F

from scorewatch.functions.columns import numeric_columns
from scorewatch.operators import mix, quality, summaries
from scorewatch.plans.spine import over_scopes
from scorewatch.spec import Attribution, DriftSpec, Metric, Segment, Share, Source, TableSpec
from tests.conftest import rows_by

SOURCE = Source(keys=("id",), month="month", score="score", channel="channel", channels=("A", "B"),
                features=("f1", "f2"))


def test_summaries(spark):
    df = spark.createDataFrame([("A", "m", 1.0), ("A", "m", 3.0), ("B", "m", None)],
                               "channel string, vintage_month string, score double")
    spec = TableSpec("t", ("vintage_month", "channel"), (
        Metric("count", "n"), Metric("avg", "a", "score"), Metric("countDistinct", "d", "score"),
        Metric("stddev", "s", "score"), Metric("min", "lo", "score"), Metric("max", "hi", "score")),
        (Share("share", "n", ("vintage_month",)), Share("skipped", "n"), Share("skipped2", None, ("channel",))))
    got = rows_by(summaries.business_tables(df, [spec])["t"], "channel")
    assert (got["A"]["n"], got["A"]["a"], got["A"]["d"]) == (2, 2.0, 2)
    assert got["A"]["s"] == pytest.approx(2 ** 0.5)
    assert got["B"]["n"] == 1 and got["B"]["a"] is None
    assert got["A"]["share"] + got["B"]["share"] == pytest.approx(1.0)
    assert "skipped" not in got["A"].asDict()


def test_unknown_aggregate_is_refused(spark):
    df = spark.createDataFrame([("A", 1.0)], "channel string, score double")
    with pytest.raises(ValueError, match="median"):
        summaries.summarize(df, ["channel"], [Metric("median", "m", "score")])


def test_missing_and_outlier_rates(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, None), (float("nan"), "y"), (5.0, "z")],
                               "a double, s string")
    got = rows_by(quality.missing_rates(df, ["a", "s"]), "column_name")
    assert got["a"]["missing_count"] == 2 and got["a"]["missing_rate"] == 0.5
    assert got["s"]["missing_rate"] == 0.25
    row = quality.outlier_rates(df, "a", 0.0, 2.0).first()
    assert row["total_count"] == 3
    empty = quality.outlier_rates(df.limit(0), "a", 0.0, 1.0).first()
    assert empty["outlier_rate"] == 0.0 and empty["total_count"] == 0


def monthly(spark, rows):
    return spark.createDataFrame(rows, "vintage_month string, channel string, score double, f1 double, f2 double")


def test_data_quality_lists_absent_channels(spark):
    df = monthly(spark, [("m", "A", None, 1.0, 1.0), ("m", "A", 1.5, 1.0, 1.0), ("m", "Z", 0.1, 1.0, 1.0)])
    got = rows_by(quality.data_quality(df, SOURCE, DriftSpec()), "channel")
    assert set(got) == {"A", "B"}
    assert (got["A"]["missing_score_rate"], got["A"]["outlier_score_rate"]) == (0.5, 1.0)
    assert (got["B"]["missing_score_rate"], got["B"]["outlier_score_rate"]) == (0.0, 0.0)


def test_feature_quality_bounds(spark):
    base = monthly(spark, [("b", "A", 0.5, float(i), None) for i in range(1, 101)])
    now = monthly(spark, [("m", "A", 0.5, v, 0.5) for v in (0.0, 50.0, 200.0, None)])
    got = rows_by(quality.feature_quality(now, base, SOURCE, DriftSpec()), "channel", "feature_name")
    row = got["A", "f1"]
    assert (row["outlier_lower_bound"], row["outlier_upper_bound"]) == (1.0, 99.0)
    assert row["outlier_rate"] == pytest.approx(2 / 3) and row["missing_rate"] == 0.25
    # No baseline values: bounds fall back to [0, 1].
    assert (got["A", "f2"]["outlier_lower_bound"], got["A", "f2"]["outlier_upper_bound"]) == (0.0, 1.0)
    assert got["A", "f2"]["outlier_rate"] == 0.0
    assert len(got) == 4


def test_feature_score_relationship(spark):
    base = monthly(spark, [("b", "A", i / 10, i / 5, 1.0) for i in range(10)])
    now = monthly(spark, [("m", "A", i / 10, -i / 5, float(i)) for i in range(10)])
    got = rows_by(quality.feature_score_relationship(now, base, SOURCE), "channel", "feature_name")
    row = got["A", "f1"]
    assert row["baseline_corr"] == pytest.approx(1) and row["current_corr"] == pytest.approx(-1)
    assert row["corr_change"] == pytest.approx(-2)
    # A constant column has no correlation, and no change.
    assert got["A", "f2"]["baseline_corr"] is None and got["A", "f2"]["corr_change"] is None
    assert got["B", "f1"]["current_corr"] is None


def test_correlation_needs_two_pairs(spark):
    one = monthly(spark, [("m", "A", 0.5, 1.0, 1.0), ("m", "A", None, 2.0, 2.0)])
    got = quality.feature_score_relationship(one, one, SOURCE).filter("channel = 'A'").collect()
    assert all(r["current_corr"] is None for r in got)


def test_numeric_columns_include_every_numeric_type(spark):
    df = spark.createDataFrame([], "a tinyint, b smallint, c bigint, d decimal(5,2), e float, f string, g date")
    assert numeric_columns(df, list("abcdefgz")) == list("abcde")


def test_column_and_record_quality(spark):
    df = spark.createDataFrame([("s", 1, 0.5, "x"), ("s", 1, None, "x"), ("s", 2, 7.0, None)],
                               "scope string, id int, v double, t string")
    got = rows_by(quality.column_quality(df, ["scope"], ["v", "t"], {"v": (0.0, 1.0)}), "column_name")
    assert (got["v"]["unique_count"], got["v"]["outlier_rate"]) == (2, 0.5)
    assert got["t"]["unique_count"] == 1 and got["t"]["missing_rate"] == pytest.approx(1 / 3)
    row = quality.record_quality(df, ["scope"], ["id"], ["v", "t"]).first()
    assert row["total_records"] == 3 and row["duplicate_rate"] == pytest.approx(1 / 3)
    assert row["overall_missing_rate"] == pytest.approx(2 / 6)


def test_sketches_merge_to_the_figures_of_exact_counts(spark):
    n = 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 20_011).cast("double").alias("v"),
        F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 3).alias("w"),
        F.concat(F.lit("t"), F.col("id") % 400).alias("t"), F.lit(None).cast("int").alias("empty"),
        (F.col("id") % 12).alias("month"), F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("part"))
    columns, bounds = ["v", "w", "t", "empty"], {"v": (100.0, 20_000.0)}
    fine = quality.column_sketches(df, ["month", "part"], columns, bounds)
    for scopes in ([], ["part"], ["month", "part"]):
        got = quality.sketched_quality(quality.merge_sketches(fine, scopes))
        exact = quality.column_quality(df, scopes, columns, bounds)
        same = rows_by(got, *scopes, "column_name")
        wanted = rows_by(exact, *scopes, "column_name")
        assert set(same) == set(wanted)
        for key, row in wanted.items():
            for name in ("total_count", "missing_rate", "outlier_rate"):
                assert same[key][name] == pytest.approx(row[name])
            assert abs(same[key]["unique_estimate"] - row["unique_count"]) <= 0.04 * row["unique_count"] + 1
    none = quality.column_sketches(df.limit(0), ["part"], columns, bounds)
    assert quality.sketched_quality(quality.merge_sketches(none, ["part"])).count() == 0


def test_population_mix(spark):
    df = spark.createDataFrame([("m", "A", "x", 1), ("m", "A", None, 1), ("m", "B", "x", 2)],
                               "vintage_month string, channel string, source string, code int")
    got = mix.population_mix(df, SOURCE, [Segment("source", "source"), Segment("code", "code")])
    assert dict(got.dtypes)["segment_value"] == "string"
    rows = rows_by(got, "channel", "segment_type", "segment_value")
    assert rows["A", "source", "Unknown"]["pct_of_channel_accounts"] == 0.5
    assert rows["A", "code", "1"]["account_count"] == 2


def test_mix_shift_shares_include_null_deciles(spark):
    base = spark.createDataFrame([(1,), (1,), (2,), (None,)], "d int")
    now = spark.createDataFrame([("r", 2), ("r", 3)], "reporting_month string, d int")
    got = rows_by(mix.mix_shift(base, now, [], ["reporting_month"], "d"), "score_bin")
    assert {k: (r["baseline_pct"], r["current_pct"]) for k, r in got.items()} == {
        1: (0.5, 0.0), 2: (0.25, 0.5), 3: (0.0, 0.5)}
    summary = mix.mix_shift_summary(mix.mix_shift(base, now, [], ["reporting_month"], "d"),
                                    ["reporting_month"]).first()
    assert (summary["bins_grown"], summary["bins_shrunk"]) == (2, 1)


def test_attribution_by_hand(spark):
    def month(m, segment, bads, goods):
        return [(m, segment, 1)] * bads + [(m, segment, 0)] * goods

    rows = month("2024-01", "x", 1, 9) + month("2024-01", "y", 2, 8)
    rows += month("2024-02", "x", 5, 10) + month("2024-02", "z", 1, 4) + [("2024-02", None, 0)] * 0
    df = spark.createDataFrame(rows, "reporting_month string, source string, edr int")
    got = rows_by(mix.attribution(df, Attribution(drivers=("source", "absent"), max_drivers=5)), "segment")
    delta = 6 / 20 - 3 / 20
    want = {"x": (0.75 - 0.5) * 0.1 + (1 / 3 - 0.1) * 0.75, "y": (0 - 0.5) * 0.2, "z": 0.2 * 0.25}
    assert {k: r["contribution"] for k, r in got.items()} == pytest.approx(want, abs=1e-6)
    assert sum(want.values()) == pytest.approx(delta)
    assert got["x"]["driver_rank"] == 1 and got["y"]["direction"] == "down"
    assert got["x"]["delta"] == pytest.approx(delta)
    quiet = mix.attribution(df, Attribution(drivers=("source",), min_materiality=0.5))
    assert quiet.count() == 0


def test_attribution_by_scorecard_sees_what_the_whole_hides(spark):
    """Two scorecards move against each other; the whole rate stands still."""
    rows = [(month, card, source, float(i < bad))
            for month, card, source, bad in (("2024-01", "a", "x", 2), ("2024-02", "a", "x", 6),
                                             ("2024-01", "b", "y", 6), ("2024-02", "b", "y", 2)) for i in range(10)]
    df = spark.createDataFrame(rows, "reporting_month string, card string, source string, edr double")
    scoped = over_scopes(df, None, (), "card")
    spec = Attribution(drivers=("source",))
    got = {(r.scorecard, r.segment): r for r in mix.attribution(scoped, spec, "scorecard").collect()}
    assert set(got) == {("a", "x"), ("b", "y")}
    assert got["a", "x"].contribution == 0.4 and got["a", "x"].direction == "up"
    assert got["b", "y"].contribution == -0.4 and got["b", "y"].driver_rank == 1
    seen = {r.scorecard: r for r in mix.attribution_overview(scoped, spec, "scorecard").collect()}
    assert not seen["overall"].is_material and seen["a"].is_material and seen["b"].is_material
