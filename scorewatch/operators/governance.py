"""Judging figures by layered thresholds: every evaluated metric, flags, overall health."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch.functions.columns import or_zero
from scorewatch.plans.spine import ALL_CHANNELS
from scorewatch.spec import LOWER_IS_WORSE, Thresholds

ALERT, WARNING, OK, NOT_JUDGED = "ALERT", "WARNING", "OK", "N/A"

# Reason codes of a section without figures.
NO_ACTUALS = "NOT_AVAILABLE_NO_ACTUALS"
NOT_MATURE = "NOT_AVAILABLE_MATURITY"
DATA_MODE = "NOT_AVAILABLE_DATA_MODE"
EMPTY_SEGMENT = "NOT_AVAILABLE_EMPTY_SEGMENT"
SAMPLE_SIZE = "NOT_AVAILABLE_SAMPLE_SIZE"
NOT_M12 = "NOT_AVAILABLE_NOT_M12"


GENERAL = ""


def threshold_table(spark: SparkSession, thresholds: Thresholds) -> DataFrame:
    """The limits that hold for every metric at every level, resolved beforehand.

    A level is a scorecard that overrides some limit, or ``GENERAL`` for all others.
    """
    metrics = sorted(set(thresholds.metrics()) | {m for limits in thresholds.scorecard.values() for m in limits})
    rows = [(m, level, *_limits(thresholds, m, level), m in LOWER_IS_WORSE)
            for m in metrics for level in [GENERAL, *sorted(thresholds.scorecard)]]
    return spark.createDataFrame(
        rows, "_metric string, _at string, _warning double, _alert double, _lower boolean")


def _limits(thresholds: Thresholds, metric: str, level: str) -> tuple[float, float]:
    limit = thresholds.resolve(metric, level or None)
    return float(limit.warning), float(limit.alert)


def status_of(value: Column, warning: Column, alert: Column, lower_is_worse: Column) -> Column:
    def hits(limit: Column) -> Column:
        return F.when(lower_is_worse, value <= limit).otherwise(value >= limit)

    return (F.when(value.isNull(), NOT_JUDGED).when(hits(alert), ALERT)
            .when(hits(warning), WARNING).otherwise(OK))


def judge(df: DataFrame, thresholds: Thresholds, metric: str | Column, value: Column,
          status: str = "status") -> DataFrame:
    """Add the resolved ``warning`` and ``alert`` limits and the status of a value.

    A scorecard's own limit wins over the general one; a metric configured nowhere gets limits of
    0.0. The limits of a named metric are literals of the plan. Where a column names it, they
    come from one equi-join on metric and level; that table has one row per configured metric and
    level, so it is broadcast.
    """
    cards = sorted(thresholds.scorecard)
    if isinstance(metric, str):
        found = []
        for i in range(2):
            limit = F
            for card in cards:
                limit = limit.when(F.col("scorecard") == card, F.lit(_limits(thresholds, metric, card)[i]))
            general = F.lit(_limits(thresholds, metric, GENERAL)[i])
            found.append(limit.otherwise(general) if cards else general)
        return (df.withColumn("warning", found[0]).withColumn("alert", found[1])
                .withColumn(status, status_of(value, F.col("warning"), F.col("alert"),
                                              F.lit(metric in LOWER_IS_WORSE))))
    level = F.when(F.col("scorecard").isin(*cards), F.col("scorecard")).otherwise(GENERAL)
    limits = F.broadcast(threshold_table(df.sparkSession, thresholds))
    joined = (df.withColumn("_key", metric).withColumn("_level", level)
              .join(limits, (F.col("_key") == F.col("_metric")) & (F.col("_level") == F.col("_at")), "left"))
    lower = F.coalesce("_lower", F.lit(False))
    return (joined.withColumn("warning", or_zero(F.col("_warning"))).withColumn("alert", or_zero(F.col("_alert")))
            .withColumn(status, status_of(value, F.col("warning"), F.col("alert"), lower))
            .drop("_key", "_level", "_metric", "_at", "_warning", "_alert", "_lower"))


def _evaluated(df: DataFrame, thresholds: Thresholds, metric: str, status: str, label: Column, value: Column,
               source: str, judged: Column | None = None, channel: Column | None = None) -> DataFrame:
    """A table's values with their limits; judged here only if the table was not judged before."""
    if not {"warning", "alert", status} <= set(df.columns):
        df = judge(df, thresholds, metric, value if judged is None else judged, status)
    return (df.filter(value.isNotNull())
            .select("reporting_month", "scorecard",
                    (F.lit(ALL_CHANNELS) if channel is None else channel).alias("channel"),
                    label.alias("metric"), value.alias("value"), "warning", "alert",
                    F.col(status).alias("status"), F.lit(source).alias("source")))


def governance_table(thresholds: Thresholds, *, score_stability: DataFrame | None = None,
                     feature_stability: DataFrame | None = None, ks_drop: DataFrame | None = None,
                     performance: DataFrame | None = None, calibration: DataFrame | None = None,
                     columns: DataFrame | None = None) -> DataFrame:
    """Every evaluated metric with its limits and status, from the tables at hand.

    The score's stability is judged overall, not per channel; calibration by the
    absolute gap.
    """
    def labelled(text: str, *names: str) -> Column:
        return F.concat_ws(":", F.lit(text), *names)

    parts = []
    if score_stability is not None:
        overall = score_stability.filter(F.col("channel") == ALL_CHANNELS)
        parts.append(_evaluated(overall, thresholds, "psi", "score_psi_status", F.lit("score_psi"),
                                F.col("score_psi"), "stability"))
    if feature_stability is not None:
        parts.append(_evaluated(feature_stability, thresholds, "feature_psi", "status",
                                labelled("feature_psi", "feature_name"), F.col("psi"), "stability"))
    if ks_drop is not None:
        parts.append(_evaluated(ks_drop, thresholds, "ks_drop", "ks_drop_status",
                                labelled("ks_drop", "maturity"), F.col("ks_drop"), "separation"))
    if performance is not None:
        parts.append(_evaluated(performance, thresholds, "edr_delta", "edr_delta_status",
                                labelled("edr_delta", "maturity", "channel"), F.col("edr_delta"),
                                "performance", channel=F.col("channel")))
    if calibration is not None:
        label = F.concat(F.lit("calibration_gap:"), "maturity", F.lit(":bin"), F.col("score_bin").cast("string"))
        parts.append(_evaluated(calibration, thresholds, "calibration_gap", "gap_status", label,
                                F.col("calibration_gap"), "calibration", F.abs("calibration_gap"), F.col("channel")))
    if columns is not None:
        parts.append(_evaluated(columns, thresholds, "missing_rate", "missing_status",
                                labelled("missing_rate", "column_name"), F.col("missing_rate"), "data_quality"))
    return reduce(DataFrame.unionByName, parts)


def flags(governed: DataFrame) -> DataFrame:
    """The evaluated metrics that need attention."""
    return (governed.filter(F.col("status").isin(ALERT, WARNING))
            .select("reporting_month", "scorecard", "channel", "metric", "value", "status", "source"))


def overall_health(governed: DataFrame) -> DataFrame:
    """Alerts, warnings and the overall status of every reporting month."""
    alerts, warnings = F.count_if(F.col("status") == ALERT), F.count_if(F.col("status") == WARNING)
    return governed.groupBy("reporting_month").agg(
        alerts.alias("alerts"), warnings.alias("warnings"),
        (alerts + warnings).alias("total_flags"),
        F.when(alerts > 0, ALERT).when(warnings > 0, WARNING).otherwise(OK).alias("overall_health"))


#: Sections whose figures come from outcomes.
OUTCOME_SECTIONS = ("separation", "performance", "calibration", "attribution")


def missing_reason(section: Column, has_actuals: bool, reached: Column, m12: Column) -> Column:
    """Why a section has no rows, the first reason that holds.

    ``reached`` says whether any outcome window of the month has mature accounts, ``m12`` whether
    that of twelve months has. A section that may be empty for want of findings has no reason.
    """
    if not has_actuals:
        outcome = F.lit(DATA_MODE)
    else:
        outcome = (F.when(section == "calibration", F.when(m12, SAMPLE_SIZE).when(reached, NOT_M12).otherwise(NOT_MATURE))
                   .when(section == "separation", F.when(reached, SAMPLE_SIZE).otherwise(NO_ACTUALS))
                   .when(section == "performance", NO_ACTUALS))
    return (F.when(section.isin("stability", "data_quality"), EMPTY_SEGMENT)
            .when(section.isin(*OUTCOME_SECTIONS), outcome))


def availability(spine: DataFrame, sections: dict[str, DataFrame], info: DataFrame | None) -> DataFrame:
    """Rows of every report section per reporting month, and the reason where there are none.

    ``info`` tells which outcome windows have mature accounts; those that have none are listed with
    their note. Without it no outcomes were loaded, which is the outcome sections' reason.
    """
    names = list(dict.fromkeys([*sections, *(OUTCOME_SECTIONS if info is None else ())]))
    counted = reduce(DataFrame.unionByName, [
        table.groupBy("reporting_month").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("section", F.lit(name)) for name, table in sections.items()])
    listed = spine.select("reporting_month", F.explode(F.array(*[F.lit(s) for s in names])).alias("section"))
    rows = F.coalesce("rows", F.lit(0).cast("long"))
    joined = listed.join(counted, ["reporting_month", "section"], "left")
    if info is not None:
        joined = joined.join(info.groupBy("reporting_month").agg(
            F.max("available").alias("_reached"),
            F.max(F.col("available") & (F.col("maturity") == "M12")).alias("_m12")), "reporting_month", "left")
    facts = [F.coalesce(c, F.lit(False)) if info is not None else F.lit(False) for c in ("_reached", "_m12")]
    by_section = joined.select(
        "reporting_month", "section", rows.alias("rows"), (rows > 0).alias("available"),
        F.when(rows == 0, missing_reason(F.col("section"), info is not None, *facts)).alias("reason"))
    if info is None:
        return by_section
    windows = info.filter(~F.col("available")).select(
        "reporting_month", F.concat(F.lit("cohort_"), "maturity").alias("section"),
        F.lit(0).cast("long").alias("rows"), F.lit(False).alias("available"),
        F.when(F.col("note") != "", F.col("note")).otherwise(NOT_MATURE).alias("reason"))
    return by_section.unionByName(windows)
