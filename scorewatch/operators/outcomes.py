"""Outcome monitoring: performance, calibration, rank ordering, separation."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.functions.columns import (indicator, interval_index, interval_label, or_zero, ratio,
                                          ratio_or_zero)
from scorewatch.operators.binning import bin_fractions, fallback_deciles
from scorewatch.plans import distribution
from scorewatch.plans.lookup import measure
from scorewatch.plans.ranking import equal_bins, quantile_ranks
from scorewatch.plans.spine import ALL_CHANNELS, OVERALL, over_scopes
from scorewatch.spec import CALIBRATION_WINDOW, MATURITIES, Monitoring, Source

COHORT = ["reporting_month", "maturity", "scorecard"]


# Account-level outcomes joined to an enriched table

def _with_actuals(current: DataFrame, actuals: DataFrame, source: Source,
                  columns: Sequence[str]) -> DataFrame:
    keys = [source.keys[0], "vintage_month"]
    return current.join(actuals.select(*keys, *columns), keys, "left")


def vintage_performance(current: DataFrame, actuals: DataFrame, source: Source) -> DataFrame:
    """Actual against predicted bad rate and early default rates per month and channel."""
    rates = ["is_bad", "edr30", "edr60", "edr90"]
    joined = _with_actuals(current.select(source.keys[0], "vintage_month", source.channel,
                                          source.score), actuals, source, rates)
    score = F.avg(source.score)
    return (joined.groupBy("vintage_month", F.col(source.channel).alias("channel")).agg(
                F.count(F.lit(1)).alias("account_count"), score.alias(f"avg_{source.score}"),
                F.avg("is_bad").alias("actual_bad_rate"),
                *[F.avg(c).alias(c) for c in rates[1:]],
                score.alias("predicted_bad_rate"),
                (F.avg("is_bad") - score).alias("calibration_gap"))
            .orderBy("vintage_month", "channel"))


def vintage_calibration(current: DataFrame, actuals: DataFrame, source: Source,
                        decile: str) -> DataFrame:
    """Predicted against actual rate per month, channel and static decile."""
    joined = _with_actuals(current.select(source.keys[0], "vintage_month", source.channel,
                                          source.score, decile), actuals, source, ["is_bad"])
    return (joined.groupBy("vintage_month", F.col(source.channel).alias("channel"),
                           F.col(decile).alias("score_bin")).agg(
                F.count(F.lit(1)).alias("account_count"),
                F.avg(source.score).alias("predicted_rate"), F.avg("is_bad").alias("actual_rate"),
                (F.avg("is_bad") - F.avg(source.score)).alias("calibration_gap"))
            .orderBy("vintage_month", "channel", "score_bin"))


# Outcome cohorts of reporting months

def _scoped(cohorts: DataFrame, spec: Monitoring, by_channel: bool, *columns: str) -> DataFrame:
    """Cohort rows per scorecard, and per channel if asked, with the columns in play."""
    source = spec.source
    keep = dict.fromkeys(["reporting_month", "maturity", source.month, source.score, *columns,
                          *([source.channel] if by_channel else []),
                          *([spec.scorecard] if spec.scorecard else [])])
    return over_scopes(cohorts.select(*keep), source.channel if by_channel else None,
                       source.channels, spec.scorecard)


def _totals(rows: DataFrame, keys: Sequence[str], month: str, columns: Sequence[str]) -> DataFrame:
    """Per group its accounts, last score month, and every column's sum and average.

    Grouped by month first: a maximum of strings beside the sums would sort all rows by group,
    so it is taken over the months only.
    """
    by_month = rows.groupBy(*keys, F.col(month).alias("_month")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in columns],
        *[F.count(c).alias(f"_n_{c}") for c in columns])
    return by_month.groupBy(*keys).agg(
        F.max("_month").alias("score_month"), F.sum("_n").alias("account_count"),
        *[F.sum(f"_sum_{c}").alias(f"{c}_sum") for c in columns],
        *[ratio(F.sum(f"_sum_{c}"), F.sum(f"_n_{c}")).alias(f"{c}_avg") for c in columns])


def performance(cohorts: DataFrame, spec: Monitoring) -> DataFrame:
    """Average score, early default and bad rate per outcome window, scorecard and channel."""
    score = spec.source.score
    rows = _scoped(cohorts, spec, True, "edr", "bad")
    return _totals(rows, [*COHORT, "channel"], spec.source.month, [score, "edr", "bad"]).select(
        *COHORT, "channel", "score_month", "account_count", or_zero(F.col(f"{score}_avg")).alias("avg_score"),
        F.col("edr_avg").alias("edr"), F.coalesce("edr_sum", F.lit(0)).alias("edr_count"),
        F.col("bad_avg").alias("bad_rate"), F.coalesce("bad_sum", F.lit(0)).alias("bad_count"))


def baseline_performance(baseline_cohorts: DataFrame, spec: Monitoring,
                         baseline_by: Sequence[str] = ()) -> DataFrame:
    """Early default rate of the baseline accounts per outcome window, scorecard and channel."""
    source = spec.source
    keep = [*baseline_by, "maturity", source.channel, "edr",
            *([spec.scorecard] if spec.scorecard else [])]
    rows = over_scopes(baseline_cohorts.select(*keep), source.channel, source.channels,
                       spec.scorecard)
    return rows.groupBy(*baseline_by, "maturity", "scorecard", "channel").agg(
        F.avg("edr").alias("edr"))


def performance_report(perf: DataFrame, baseline_perf: DataFrame, info: DataFrame) -> DataFrame:
    """Performance rows with the change of the early default rate against the baseline
    cohort of the same window, and a note row for each unavailable window."""
    labels = F.create_map(*[F.lit(x) for m in MATURITIES for x in (m.label, m.display)])
    keys = [k for k in (*COHORT, "channel") if k in baseline_perf.columns]
    base = baseline_perf.select(*keys, F.col("edr").alias("_base"))
    rows = (perf.join(base, keys, "left")
            .withColumn("edr_delta", F.col("edr") - F.col("_base")).drop("_base")
            .withColumn("note", F.lit(None).cast("string")))
    notes = (info.filter(~F.col("available"))
             .select("reporting_month", "maturity", "score_month", "note",
                     F.lit(OVERALL).alias("scorecard"), F.lit(ALL_CHANNELS).alias("channel")))
    return (rows.unionByName(notes, allowMissingColumns=True)
            .withColumn("display_label", F.try_element_at(labels, F.col("maturity"))))


def rank_ordering(cohorts: DataFrame, spec: Monitoring) -> DataFrame:
    """Observed early default rate per fixed score interval, and where it falls."""
    size = len(spec.intervals)
    rows = (_scoped(cohorts, spec, False, "edr")
            .withColumn("_bin", interval_index(F.col(spec.source.score), spec.intervals)))
    per_bin = F.array(*[F.struct(
        F.lit(float(low)).alias("min_score"), F.lit(float(high)).alias("max_score"),
        F.count_if(F.col("_bin") == i).alias("accounts_n"),
        or_zero(F.avg(F.when(F.col("_bin") == i, F.col("edr")))).alias("observation_pct"))
        for i, (low, high) in enumerate(spec.intervals)])
    table = (rows.groupBy(*COHORT).agg(F.count(F.lit(1)).alias("_all"), per_bin.alias("_bins"))
             .select(*COHORT, "_all", F.explode("_bins").alias("_bin")).select(*COHORT, "_all", "_bin.*"))
    previous = F.lag("observation_pct").over(Window.partitionBy(*COHORT).orderBy("min_score"))
    return table.select(
        *COHORT, interval_label(F.col("min_score"), F.col("max_score"), 2).alias("interval"),
        "min_score", "max_score", "accounts_n",
        ratio_or_zero(F.col("accounts_n"), F.col("_all")).alias("accounts_pct"), "observation_pct",
        F.when(F.col("observation_pct") < previous, "YES").otherwise("NO").alias("misrank"))


def risk_capture(cohorts: DataFrame, spec: Monitoring) -> DataFrame:
    """Share of accounts at or above the risk threshold and the share of bads they hold."""
    risky = F.col(spec.source.score) >= spec.risk_threshold
    bad = F.col("edr") == 1
    return _scoped(cohorts, spec, False, "edr").groupBy(*COHORT).agg(
        F.lit(spec.risk_threshold).alias("threshold"),
        ratio_or_zero(F.count_if(risky), F.count(F.lit(1))).alias("pct_population_flagged"),
        ratio_or_zero(F.count_if(risky & bad), F.count_if(bad)).alias("pct_bad_captured"))


def _with_decile(cohorts: DataFrame, spec: Monitoring) -> DataFrame:
    if spec.decile_col in cohorts.columns:
        return cohorts
    return fallback_deciles(cohorts, ["reporting_month", "maturity"], spec.source.score,
                            spec.decile_col)


def calibration(cohorts: DataFrame, spec: Monitoring) -> DataFrame:
    """Predicted against actual rate per static decile, for the calibration window only.

    ``sample_sufficient`` tells whether every bin of the whole cohort is large enough.
    """
    score = spec.source.score
    rows = _scoped(_with_decile(cohorts.filter(F.col("maturity") == CALIBRATION_WINDOW), spec),
                   spec, True, "bad", spec.decile_col)
    rows = rows.withColumnRenamed(spec.decile_col, "_decile")
    binned = _totals(rows, [*COHORT, "channel", "_decile"], spec.source.month, [score, "bad"]).withColumns({
        "bad_count": F.coalesce("bad_sum", F.lit(0)),
        "predicted_rate": or_zero(F.col(f"{score}_avg")), "actual_rate": or_zero(F.col("bad_avg"))})
    smallest = F.min(F.when(F.col("channel") == ALL_CHANNELS, F.col("account_count"))).over(
        Window.partitionBy(*COHORT))
    return binned.select(
        *COHORT, "channel", "score_month", F.coalesce("_decile", F.lit(0)).alias("score_bin"),
        "account_count", "bad_count", "predicted_rate", "actual_rate",
        (F.col("actual_rate") - F.col("predicted_rate")).alias("calibration_gap"),
        (smallest >= spec.sample.min_accounts_bin).alias("sample_sufficient"))


def calibration_summary(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest and mean absolute gap and the bin of the largest (first by channel and bin)."""
    gap = F.abs("calibration_gap")
    order = Window.partitionBy(*keys).orderBy(gap.desc(), "channel", "score_bin")
    return (table.withColumn("_at", F.row_number().over(order)).groupBy(*keys).agg(
        F.max(gap).alias("max_abs_gap"), F.avg(gap).alias("mean_abs_gap"),
        F.max(F.when(F.col("_at") == 1, F.col("score_bin"))).alias("worst_bin")))


# Separation of goods and bads

def _sample_note(spec: Monitoring):
    accounts, bads = F.col("account_count"), F.col("bad_count")
    rules = spec.sample
    return (F.when(accounts < rules.min_accounts_ks,
                   F.format_string(f"Insufficient accounts: %d < {rules.min_accounts_ks}", accounts))
            .when(bads < rules.min_bads_ks,
                  F.format_string(f"Insufficient bads: %d < {rules.min_bads_ks}", bads)))


def separation(cohorts: DataFrame, spec: Monitoring) -> DataFrame:
    """KS and Gini per outcome window and scorecard; null with a note on a small sample."""
    rows = _scoped(cohorts, spec, False, "bad")
    stats = distribution.separation(rows, COHORT, spec.source.score, "bad")
    stats = stats.withColumn("note", _sample_note(spec))
    enough = F.col("note").isNull()
    return stats.withColumns({"ks": F.when(enough, F.col("ks")),
                              "gini": F.when(enough, F.col("gini"))})


def ks_drop(separated: DataFrame, baseline_cohorts: DataFrame, spec: Monitoring,
            baseline_by: Sequence[str] = ()) -> DataFrame:
    """Cohort KS minus the KS of the baseline accounts with the same outcome window."""
    keys = [*baseline_by, "maturity", "scorecard"]
    rows = over_scopes(
        baseline_cohorts.select(*[k for k in keys if k != "scorecard"], "bad", spec.source.score,
                                *([spec.scorecard] if spec.scorecard else [])),
        None, (), spec.scorecard)
    base = distribution.separation(rows, keys, spec.source.score, "bad")
    goods = F.col("account_count") - F.col("bad_count")
    base = (base.filter((F.col("bad_count") > 0) & (goods > 0))
            .select(*keys, F.col("ks").alias("baseline_ks")))
    return (separated.join(base, keys, "left")
            .withColumn("ks_drop", F.col("ks") - F.col("baseline_ks")))


def odds(cohorts: DataFrame, spec: Monitoring) -> DataFrame:
    """Goods to bads per static decile, flagging bins that break the expected order.

    Null odds stand for a bin without bads, the best possible odds.
    """
    rows = _scoped(_with_decile(cohorts, spec), spec, False, "bad", spec.decile_col)
    table = rows.groupBy(*COHORT, F.coalesce(spec.decile_col, F.lit(0)).alias("score_bin")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("bad") == 0).alias("goods"),
        F.count_if(F.col("bad") == 1).alias("bads"))
    along = Window.partitionBy(*COHORT).orderBy("score_bin")
    value = F.when(F.col("bads") > 0, ratio(F.col("goods"), F.col("bads"))).otherwise(
        F.lit(float("inf")))
    table = table.withColumn("_odds", value).withColumn("_before", F.lag("_odds").over(along))
    worse = (F.col("_odds") > F.col("_before") if spec.higher_score_is_riskier
             else F.col("_odds") < F.col("_before"))
    table = table.withColumn("is_monotonic", ~F.coalesce(worse, F.lit(False)))
    total = F.sum(indicator(~F.col("is_monotonic"))).over(Window.partitionBy(*COHORT))
    return table.select(*COHORT, "score_bin", "total", "goods", "bads",
                        ratio(F.col("goods"), F.col("bads")).alias("odds"),
                        ratio_or_zero(F.col("bads"), F.col("total")).alias("bad_rate"),
                        "is_monotonic", total.alias("total_misranks"))


def with_odds_order(separated: DataFrame, odds_rows: DataFrame) -> DataFrame:
    """Separation rows with the number of bins out of order."""
    order = odds_rows.groupBy(*COHORT).agg(F.max("total_misranks").alias("misrank_count"))
    return (separated.join(order, COHORT, "left")
            .withColumn("odds_monotonic", F.col("misrank_count") == 0))


def ks_table(cohorts: DataFrame, spec: Monitoring) -> DataFrame:
    """Equal-frequency score tiers with cumulative goods and bads, plus a TOTAL row."""
    source, tiers = spec.source, spec.ks_bins
    rows = _scoped(cohorts, spec, False, "bad", source.keys[0])
    guard = (rows.groupBy(*COHORT).agg(F.count(F.lit(1)).alias("account_count"),
                                       F.count_if(F.col("bad") == 1).alias("bad_count"))
             .filter(_sample_note(spec).isNull()).select(*COHORT))
    usable = rows.filter(F.col(source.score).isNotNull() & F.col("bad").isNotNull())
    tiered = equal_bins(usable, COHORT, source.score, source.keys[0], "_tier",
                        quantile_ranks(bin_fractions(tiers)), tiers, measure(usable, COHORT))
    stats = tiered.groupBy(*COHORT, "_tier").agg(
        F.min(source.score).alias("min_score"), F.max(source.score).alias("max_score"),
        F.count(F.lit(1)).alias("accounts_n"), F.count_if(F.col("bad") != 1).alias("goods_n"),
        F.count_if(F.col("bad") == 1).alias("bads_n")).join(guard, COHORT)
    cohort = Window.partitionBy(*COHORT)
    upto = cohort.orderBy("_tier").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name in ("accounts_n", "goods_n", "bads_n"):
        stats = stats.withColumn(f"_all_{name}", F.sum(name).over(cohort))
    overall = ratio_or_zero(F.col("_all_bads_n"), F.col("_all_accounts_n"))
    bad_rate = ratio_or_zero(F.col("bads_n"), F.col("accounts_n"))
    table = (stats
             .withColumn("accounts_pct", ratio(F.col("accounts_n"), F.col("_all_accounts_n")))
             .withColumn("goods_pct", ratio_or_zero(F.sum("goods_n").over(upto), F.col("_all_goods_n")))
             .withColumn("bads_pct", ratio_or_zero(F.sum("bads_n").over(upto), F.col("_all_bads_n")))
             .withColumn("bad_rate", bad_rate)
             .withColumn("ks", F.abs(F.col("goods_pct") - F.col("bads_pct")))
             .withColumn("lift", or_zero(F.try_divide(bad_rate, overall))))
    columns = ["min_score", "max_score", "accounts_n", "accounts_pct", "goods_n", "goods_pct",
               "bads_n", "bads_pct", "bad_rate", "ks", "lift"]
    total = table.groupBy(*COHORT).agg(
        F.min("min_score").alias("min_score"), F.max("max_score").alias("max_score"),
        F.sum("accounts_n").alias("accounts_n"), F.lit(1.0).alias("accounts_pct"),
        F.sum("goods_n").alias("goods_n"), F.lit(1.0).alias("goods_pct"),
        F.sum("bads_n").alias("bads_n"), F.lit(1.0).alias("bads_pct"),
        ratio_or_zero(F.sum("bads_n"), F.sum("accounts_n")).alias("bad_rate"),
        F.max("ks").alias("ks"), F.lit(1.0).alias("lift"))
    listed = table.select(*COHORT, F.col("_tier").cast("string").alias("tier"), *columns)
    return listed.unionByName(total.select(*COHORT, F.lit("TOTAL").alias("tier"), *columns))
