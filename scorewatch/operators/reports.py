"""Report tables drawn from the monitoring tables: rankings, flags and diagnosis rules."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.functions.columns import or_zero
from scorewatch.plans.spine import ALL_CHANNELS
from scorewatch.spec import Monitoring

# Limits of the monthly report.
PSI_WARN, PSI_ALERT = 0.10, 0.25
KS_WARN = 0.10
TAIL_WARN = 0.15
MISSING_WARN = 0.01
OUTLIER_WARN = 0.05
GAP_WARN = 0.05
CHANNEL_GAP_WARN = 0.03
SOURCE_SHARE_MIN = 0.35
KS_DROP_ALERT = -0.07
DRIFTING_FEATURES = 3


# Rankings; equal figures are ordered by name

def _ranked(df: DataFrame, partition: list[str], order: list, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_features(psi: DataFrame, k: int = 5) -> DataFrame:
    """Features with the largest index over all channels, with that channel's means."""
    figures = F.struct("psi", F.col("channel").alias("_channel"), "baseline_mean", "current_mean")
    # Largest index; on a tie the first channel by name.
    best = _ranked(psi.withColumn("_f", figures), ["vintage_month", "feature_name"],
                   [F.col("psi").desc(), "channel"], 1)
    listed = best.select("vintage_month", "feature_name", F.col("psi").alias("max_psi"),
                         "baseline_mean", "current_mean",
                         (F.col("current_mean") - F.col("baseline_mean")).alias("mean_shift"),
                         F.when(F.col("psi") >= PSI_ALERT, "ALERT")
                         .when(F.col("psi") >= PSI_WARN, "WARNING").otherwise("OK").alias("level"))
    return _ranked(listed, ["vintage_month"], [F.col("max_psi").desc(), "feature_name"], k)


def top_features_by_channel(psi: DataFrame, k: int = 5) -> DataFrame:
    return _ranked(psi, ["vintage_month", "channel"], [F.col("psi").desc(), "feature_name"], k)


def top_correlation_changes(relationship: DataFrame, k: int = 5) -> DataFrame:
    return _ranked(relationship.filter(F.col("corr_change").isNotNull()), ["vintage_month"],
                   [F.abs("corr_change").desc(), "channel", "feature_name"], k)


def top_drifting(stability: DataFrame, k: int = 3) -> DataFrame:
    """Per scorecard, the features whose index reaches the warning limit, largest first."""
    return stability.filter((F.col("psi") >= PSI_WARN) & (F.col("psi_rank") <= k))


# Monthly report: flags, health and diagnosis

def _row(df: DataFrame, level: Column | str, rule: str, channel: Column | None, subject: Column | None,
         value: Column) -> DataFrame:
    text = F.lit(None).cast("string")
    return df.select("vintage_month", (F.lit(level) if isinstance(level, str) else level).alias("level"),
                     F.lit(rule).alias("rule"), (text if channel is None else channel).alias("channel"),
                     (text if subject is None else subject).alias("subject"),
                     value.cast("double").alias("value"))


def _psi_level(value: Column) -> Column:
    return F.when(value >= PSI_ALERT, "ALERT").otherwise("WARN")


def monthly_flags(drift: DataFrame, feature_psi: DataFrame, quality: DataFrame,
                  mix: DataFrame) -> DataFrame:
    """Figures past the report's limits; a feature is flagged once, at its first channel."""
    channel = F.col("channel")
    above = {"score_ks": KS_WARN, "pct_accounts_above_p90_baseline": TAIL_WARN,
             "pct_accounts_above_p95_baseline": TAIL_WARN}
    parts = [_row(drift.filter(F.col("score_psi") >= PSI_WARN), _psi_level(F.col("score_psi")),
                  "score_psi", channel, None, F.col("score_psi"))]
    parts += [_row(drift.filter(F.col(c) >= limit), "WARN", c, channel, None, F.col(c))
              for c, limit in above.items()]
    first = _ranked(feature_psi.filter(F.col("psi") >= PSI_WARN), ["vintage_month", "feature_name"],
                    ["channel"], 1)
    parts.append(_row(first, _psi_level(F.col("psi")), "feature_psi", channel, F.col("feature_name"),
                      F.col("psi")))
    parts += [_row(quality.filter(F.col(c) >= limit), "WARN", c, channel, None, F.col(c))
              for c, limit in (("missing_score_rate", MISSING_WARN),
                               ("outlier_score_rate", OUTLIER_WARN))]
    unknown = (mix.filter(F.col("segment_value") == "Unknown")
               .groupBy("vintage_month", "segment_type").agg(F.sum("account_count").alias("_n")))
    parts.append(_row(unknown, "INFO", "unknown_segment", None, F.col("segment_type"), F.col("_n")))
    return reduce(DataFrame.unionByName, parts)


def monthly_health(drift: DataFrame, feature_psi: DataFrame, calibration: DataFrame) -> DataFrame:
    """Worst indices and gap of each month and the status they give."""
    month = ["vintage_month"]
    joined = (drift.groupBy(*month).agg(F.max("score_psi").alias("max_score_psi"))
              .join(feature_psi.groupBy(*month).agg(F.max("psi").alias("max_feature_psi")), month, "left")
              .join(calibration.groupBy(*month).agg(
                  F.max(F.abs("calibration_gap")).alias("max_calibration_gap")), month, "left"))
    score, feature, gap = (or_zero(F.col(c)) for c in ("max_score_psi", "max_feature_psi",
                                                       "max_calibration_gap"))
    worst = F.greatest(score, feature)
    return joined.select("vintage_month", score.alias("max_score_psi"), feature.alias("max_feature_psi"),
                         gap.alias("max_calibration_gap"),
                         F.when(worst >= PSI_ALERT, "ALERT")
                         .when((worst >= PSI_WARN) | (gap > GAP_WARN), "WARNING")
                         .otherwise("STABLE").alias("health"))


def monthly_diagnosis(drift: DataFrame, feature_psi: DataFrame, quality: DataFrame, mix: DataFrame,
                      performance: DataFrame, calibration: DataFrame,
                      watched_source: str = "organic") -> DataFrame:
    """Diagnosis rules that hold per month, one row each; ``no_issues`` where none does."""
    month, channel = ["vintage_month"], F.col("channel")
    worst = drift.groupBy(*month).agg(F.max("score_psi").alias("_psi"))
    parts = [_row(worst.filter(F.col("_psi") >= PSI_WARN), _psi_level(F.col("_psi")), "score_shift",
                  None, None, F.col("_psi")),
             _row(drift.filter(F.col("pct_accounts_above_p90_baseline") >= TAIL_WARN), "WARN",
                  "right_tail", channel, None, F.col("pct_accounts_above_p90_baseline"))]
    drifting = top_features(feature_psi, 3).filter(F.col("max_psi") >= PSI_WARN)
    parts.append(_row(drifting, "WARN", "feature_drift", None, F.col("feature_name"), F.col("max_psi")))
    watched = (mix.filter((F.col("segment_type") == "source")
                          & (F.col("segment_value") == watched_source))
               .groupBy(*month).agg(F.max("pct_of_channel_accounts").alias("_share")))
    parts.append(_row(watched.filter(F.col("_share") < SOURCE_SHARE_MIN), "WARN", "source_share",
                      None, F.lit(watched_source), F.col("_share")))
    gaps = calibration.groupBy(*month).agg(F.max(F.abs("calibration_gap")).alias("_gap"))
    parts.append(_row(gaps.filter(F.col("_gap") > GAP_WARN), "WARN", "calibration_gap", None, None,
                      F.col("_gap")))
    parts.append(_row(performance.filter(F.abs("calibration_gap") > CHANNEL_GAP_WARN), "WARN",
                      "channel_gap", channel,
                      F.when(F.col("calibration_gap") > 0, "underestimating")
                      .otherwise("overestimating"), F.col("calibration_gap")))
    parts.append(_row(quality.filter(F.col("missing_score_rate") >= MISSING_WARN), "WARN",
                      "missing_score", channel, None, F.col("missing_score_rate")))
    found = reduce(DataFrame.unionByName, parts)
    quiet = drift.select(*month).distinct().join(found, month, "left_anti")
    return found.unionByName(_row(quiet, "INFO", "no_issues", None, None, F.lit(None)))


# Running-month report

def monitoring_diagnosis(spec: Monitoring, info: DataFrame, score_stability: DataFrame,
                         feature_stability: DataFrame, ks_drop: DataFrame,
                         calibration: DataFrame) -> DataFrame:
    """Diagnosis rules that hold per reporting month and scorecard."""
    text = F.lit(None).cast("string")

    def row(df: DataFrame, rule: Column | str, subject: Column, value: Column,
            scorecard: Column | None = None) -> DataFrame:
        return df.select("reporting_month", (text if scorecard is None else scorecard).alias("scorecard"),
                         (F.lit(rule) if isinstance(rule, str) else rule).alias("rule"),
                         subject.alias("subject"), value.cast("double").alias("value"))

    card = F.col("scorecard")
    overall = score_stability.filter((F.col("channel") == ALL_CHANNELS)
                                     & (F.col("score_psi") >= PSI_WARN))
    drifting = (feature_stability.filter(F.col("psi") >= PSI_WARN)
                .groupBy("reporting_month", "scorecard").agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") >= DRIFTING_FEATURES))
    gaps = (calibration.filter(F.abs("calibration_gap") >= GAP_WARN)
            .groupBy("reporting_month", "scorecard").agg(F.count(F.lit(1)).alias("_n")))
    parts = [
        row(info.filter(~F.col("available")), "cohort_unavailable", F.col("maturity"),
            F.col("mature_count")),
        row(info.filter(F.col("available")
                        & (F.col("account_count") < spec.sample.min_accounts_ks)),
            "small_cohort", F.col("maturity"), F.col("account_count")),
        row(overall, F.when(F.col("score_psi") >= PSI_ALERT, "severe_score_shift")
            .otherwise("moderate_score_shift"), text, F.col("score_psi"), card),
        row(drifting, "features_drift_together", text, F.col("_n"), card),
        row(ks_drop.filter(F.col("ks_drop") <= KS_DROP_ALERT), "ks_degradation", F.col("maturity"),
            F.col("ks_drop"), card),
        row(gaps, "calibration_divergence", F.lit("M12"), F.col("_n"), card)]
    found = reduce(DataFrame.unionByName, parts)
    quiet = (score_stability.select("reporting_month").distinct()
             .join(found, "reporting_month", "left_anti"))
    return found.unionByName(row(quiet, "no_issues", text, F.lit(None)))
