"""Running-month stability and data quality over scorecards and channels."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.functions.columns import melt, or_zero
from scorewatch.operators.binning import bin_fractions
from scorewatch.operators.drift import population_shift
from scorewatch.operators.quality import missing_rates, missing_share, outlier_share
from scorewatch.plans.distribution import bin_measures, psi, reference_counts
from scorewatch.plans.ranking import Unions, attach_quantile_bin, quantiles
from scorewatch.plans.spine import ALL_CHANNELS, expected_groups, over_scopes, own_counts, scoped_counts
from scorewatch.plans.staging import stage
from scorewatch.spec import Monitoring


def _columns(spec: Monitoring, *more: str) -> list[str]:
    source = spec.source
    wanted = [*more, source.channel, source.score, *source.features,
              *([spec.scorecard] if spec.scorecard else [])]
    return list(dict.fromkeys(wanted))


def score_stability(current: DataFrame, baseline: DataFrame, spec: Monitoring,
                    baseline_by: Sequence[str] = (), windows: DataFrame | None = None) -> DataFrame:
    """Score stability index per reporting month, scorecard and channel (``all`` included).

    Either side may hold accounts or, with a column ``n``, counts of accounts by value, such as
    ``cohorts.monthly_counts`` and ``cohorts.baseline_counts`` give. With ``windows``, the table of
    ``cohorts.baseline_windows``, the baseline holds the counts of each month once, not once for every window.
    """
    source, score = spec.source, spec.source.score

    def own(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return own_counts(df, keys, source.channel, spec.scorecard, score)

    def scoped(df: DataFrame) -> DataFrame:
        return over_scopes(df, source.channel, source.channels, spec.scorecard)

    ref_keys = [*baseline_by, "scorecard", "channel"]
    within = [source.month] if windows is not None else list(baseline_by)
    then = baseline if "n" in baseline.columns else stage(own(baseline, within), "baseline_counts")
    cells = [c for c in dict.fromkeys([*within, source.channel, spec.scorecard]) if c and c in then.columns]
    cell = {f"_in_{c}": F.col(c) for c in cells}
    groups = then.select(*cells).distinct().withColumns(cell)
    groups = scoped(groups if windows is None else groups.join(windows, source.month))
    unions = Unions(list(cell), stage(groups.select(*cell, *ref_keys), "baseline_groups"))
    then = then.filter(F.col(score).isNotNull()).select(*[c.alias(name) for name, c in cell.items()], score, "n")
    sizing = unions.measure(then, ref_keys)
    edges = stage(quantiles(then, ref_keys, score, bin_fractions(spec.n_bins), sizing=sizing, weight="n",
                            unions=unions), "baseline_edges")

    keys = ["reporting_month", "scorecard", "channel"]
    now = current if "n" in current.columns else own(current, keys[:1])
    binned = attach_quantile_bin(
        scoped(now).filter(F.col(score).isNotNull()).select(*keys, score, "n"), edges, ref_keys, score, spec.n_bins,
        sizing.broadcast_fits(8 * spec.n_bins + 256), "bin", "middle")
    measures = bin_measures("bin", spec.n_bins, score, "n", "middle")
    found = binned.groupBy(*keys).agg(*[measures[name].alias(name) for name in ("n", "counts", "mean", "std")])
    # The bins of the baseline come from its counts up to each edge.
    expected = edges.select(*ref_keys, F.col("group_n").alias("ref_n"),
                            reference_counts(F.col("upto"), F.col("group_n")).alias("ref_counts"))
    shift = found.join(expected, ref_keys, "left").select(
        *keys, psi(F.col("ref_counts"), F.coalesce("ref_n", F.lit(0)), F.col("counts"), F.col("n")).alias("psi"),
        "mean", "std")
    # Accounts count whether scored or not; a scope without a single score or account keeps its row.
    size = F.sum("n") if "n" in current.columns else F.count(F.lit(1))
    by = [c for c in dict.fromkeys([keys[0], source.channel, spec.scorecard]) if c and c in current.columns]
    accounts = (scoped(current.groupBy(*by).agg(size.alias("n"))).groupBy(*keys)
                .agg(F.sum("n").alias("account_count")))
    listed = expected_groups(accounts, keys[:2], channel=[ALL_CHANNELS, *source.channels])
    return listed.join(accounts, keys, "left").join(shift, keys, "left").select(
        *keys, or_zero(F.col("psi")).alias("score_psi"),
        or_zero(F.col("mean")).alias("mean_score"),
        or_zero(F.col("std")).alias("std_score"),
        F.coalesce("account_count", F.lit(0).cast("long")).alias("account_count"))


def feature_stability(current: DataFrame, baseline: DataFrame, spec: Monitoring,
                      baseline_by: Sequence[str] = ()) -> DataFrame:
    """Feature stability index and mean shift per reporting month and scorecard, ranked."""
    features = list(spec.source.features)

    def long(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        card = [spec.scorecard] if spec.scorecard and spec.scorecard in df.columns else []
        values = melt(df.select(*dict.fromkeys([*keys, *card, *features])), dict.fromkeys([*keys, *card]),
                      features, "feature_name", "value")
        return scoped_counts(values, [*keys, "feature_name"], None, (), spec.scorecard, "value")

    extra = [k for k in ("reporting_month",) if k not in baseline_by]
    shift = population_shift(long(baseline, baseline_by), long(current, ["reporting_month"]),
                             [*baseline_by, "scorecard", "feature_name"], extra, "value",
                             spec.n_bins, weight="n")
    cards = over_scopes(current.select(*dict.fromkeys(
        ["reporting_month", *([spec.scorecard] if spec.scorecard else [])])), None, (), spec.scorecard)
    keys = ["reporting_month", "scorecard", "feature_name"]
    # A feature without any value keeps its row, with an index of 0 and no means.
    shift = (expected_groups(cards, keys[:2], feature_name=features).join(shift, keys, "left")
             .withColumn("psi", or_zero(F.col("psi"))))
    rank = F.row_number().over(Window.partitionBy("reporting_month", "scorecard")
                               .orderBy(F.col("psi").desc(), "feature_name"))
    return shift.select("reporting_month", "scorecard", "feature_name", "psi", "baseline_mean",
                        "current_mean",
                        (F.col("current_mean") - F.col("baseline_mean")).alias("mean_shift"),
                        rank.alias("psi_rank"))


def score_quality(current: DataFrame, spec: Monitoring) -> DataFrame:
    """Missing and out-of-range score rates per reporting month, scorecard and channel."""
    source = spec.source
    rows = over_scopes(current.select(*_columns(spec, "reporting_month")), source.channel,
                       source.channels, spec.scorecard)
    return rows.groupBy("reporting_month", "scorecard", "channel").agg(
        missing_share(rows, source.score).alias("score_missing_rate"),
        outlier_share(F.col(source.score), F.lit(0.0), F.lit(1.0)).alias("score_outlier_rate"),
        F.count(F.lit(1)).alias("total_accounts"))


def feature_missing(current: DataFrame, spec: Monitoring) -> DataFrame:
    rows = over_scopes(current.select(*_columns(spec, "reporting_month")), None, (),
                       spec.scorecard)
    return (missing_rates(rows, list(spec.source.features), ["reporting_month", "scorecard"])
            .withColumnRenamed("column_name", "feature_name"))


def portfolio_summary(stability: DataFrame, baseline: DataFrame, spec: Monitoring,
                      baseline_by: Sequence[str] = ()) -> DataFrame:
    """Current and baseline accounts and the average score per reporting month and scorecard."""
    keys = [*baseline_by, "scorecard"]
    counted = scoped_counts(baseline.withColumn("_any", F.lit(1)), baseline_by, None, (), spec.scorecard, "_any")
    base = counted.groupBy(*keys).agg(F.sum("n").alias("baseline_accounts"))
    return (stability.filter(F.col("channel") == ALL_CHANNELS).join(base, keys, "left")
            .select("reporting_month", "scorecard", F.col("account_count").alias("current_accounts"),
                    F.coalesce("baseline_accounts", F.lit(0)).alias("baseline_accounts"),
                    "mean_score"))
