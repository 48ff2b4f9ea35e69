"""Whole runs: every table of a monthly report or of running-month monitoring."""
from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.operators import (checks, cohorts, drift, enrich, governance, mix, outcomes, quality,
                                  reports, stability, summaries)
from scorewatch.plans.spine import OVERALL, over_scopes
from scorewatch.plans.staging import kept, stage
from scorewatch.sources.tables import (check_performance_mart, check_score_mart, require_columns,
                                       stamp)
from scorewatch.spec import DriftSpec, Enrichment, Monitoring, Segment, Source, TableSpec

log = logging.getLogger(__name__)

Writer = Callable[[DataFrame, str], None]

#: The report tables that each view is drawn from.
VIEWED = {"top_features": ["feature_psi"], "top_features_by_channel": ["feature_psi"],
          "top_correlation_changes": ["feature_score_relationship"], "drift_trend": ["score_drift"],
          "flags": ["score_drift", "feature_psi", "data_quality", "population_mix"],
          "health": ["score_drift", "feature_psi", "calibration"],
          "diagnosis": ["score_drift", "feature_psi", "data_quality", "population_mix", "performance",
                        "calibration"]}


def run_report(current: DataFrame, baseline: DataFrame, source: Source, enrichment: Enrichment,
               tables: Sequence[TableSpec], spec: DriftSpec, score_month: str, model_version: str,
               *, actuals: DataFrame | None = None, layers: Sequence[int] = (1, 2, 3),
               write: Writer | None = None, only: Collection[str] | None = None,
               account: DataFrame | None = None) -> dict[str, DataFrame]:
    """The monthly report's tables by name, all stamped with run month and version.

    Layer 1 is the enriched account table, 2 the business tables, 3 monitoring.
    The account table feeds all others, so it is staged once; layers 2 and 3
    build it when layer 1 is not asked for. Business and monitoring tables stay
    lazy; the account table's stage and the sizing of groups run when called.
    ``only`` names the tables wanted of these layers; the groups of others are not sized.
    ``account`` is the account table of these rows, if it was staged before.
    """
    require_columns(current, source.required)
    if account is None:
        account = enrich.enrich(current, baseline, source, enrichment, score_month, model_version)
        account = stage(account, "account", ["vintage_month"])
    out: dict[str, DataFrame] = {}
    if 1 in layers:
        out["account"] = account
    if 2 in layers:
        out |= summaries.business_tables(account, tables)
    if 3 in layers:
        build: dict[str, Callable[[], DataFrame]] = {
            "score_drift": lambda: drift.score_drift(account, baseline, source, spec),
            "feature_psi": lambda: drift.feature_psi(account, baseline, source, spec),
            "data_quality": lambda: quality.data_quality(account, source, spec),
            "feature_quality": lambda: quality.feature_quality(account, baseline, source, spec),
            "feature_score_relationship": lambda: quality.feature_score_relationship(account, baseline, source),
            "population_mix": lambda: mix.population_mix(account, source, spec.segments)}
        if actuals is not None:
            build |= {
                "performance": lambda: outcomes.vintage_performance(account, actuals, source),
                "calibration": lambda: outcomes.vintage_calibration(account, actuals, source,
                                                                    enrichment.static_col)}
        out |= {name: table() for name, table in build.items() if only is None or name in only}
    if only is not None:
        out = {name: df for name, df in out.items() if name in only}
    out = {name: df if name == "account" else stamp(df, score_month, model_version)
           for name, df in out.items()}
    if write is not None:
        for name, df in out.items():
            write(df, name)
    return out


def report_views(tables: dict[str, DataFrame], source: Source,
                 watched_source: str = "organic") -> dict[str, DataFrame]:
    """Rankings, flags, health and diagnosis, as far as the run has the monitoring tables they are drawn from."""
    def diagnosis(*drawn_on: DataFrame) -> DataFrame:
        return reports.monthly_diagnosis(*drawn_on, watched_source)

    views = {"top_features": reports.top_features,
             "top_features_by_channel": reports.top_features_by_channel,
             "top_correlation_changes": reports.top_correlation_changes,
             "drift_trend": lambda score: drift.drift_trend(score, source.score),
             "flags": reports.monthly_flags, "health": reports.monthly_health, "diagnosis": diagnosis}
    return {name: view(*[tables[n] for n in VIEWED[name]]) for name, view in views.items()
            if all(n in tables for n in VIEWED[name])}


def run_checks(source_rows: DataFrame, tables: dict[str, DataFrame], source: Source,
               enrichment: Enrichment, segments: Sequence[Segment] = ()) -> DataFrame:
    """The promotion gate over a full run; ``segments`` are those its population mix must list."""
    buckets = [f"by_{b.name}" for b in enrichment.buckets if f"by_{b.name}" in tables]
    return checks.promotion_checks(source_rows, tables["account"], tables, tables, source,
                                   enrichment.decile_col, enrichment.n_bins,
                                   [s.segment_type for s in segments], buckets)


def cohort_columns(cohort: DataFrame, spec: Monitoring) -> DataFrame:
    """The cohort columns that outcome tables read."""
    source = spec.source
    wanted = dict.fromkeys(["reporting_month", "maturity", source.keys[0], source.month, source.score,
                            source.channel, spec.scorecard, spec.decile_col,
                            *spec.attribution.drivers, "edr", "bad"])
    return cohort.select(*[c for c in wanted if c in cohort.columns])


def run_monitoring(score_mart: DataFrame, performance_mart: DataFrame | None, spec: Monitoring,
                   reporting_months: Sequence[str] | None = None, write: Writer | None = None,
                   model_version: str | None = None,
                   only: Collection[str] | None = None) -> dict[str, DataFrame]:
    """All running-month tables by name, for one month, a list, or the whole history.

    With ``write`` every table is written with its reporting month and ``model_version``.
    Without a performance mart the outcome tables are left out. The outcome
    cohorts feed seven tables and are staged. Result tables that others are drawn
    from hold a few rows per group and are cached; ``release`` frees them.
    ``only`` names the tables wanted: of the tables that no other is drawn from, those left out are
    neither built nor sized.
    """
    def asked(*names: str) -> bool:
        return only is None or any(name in only for name in names)

    if write is not None and model_version is None:
        raise ValueError("tables are written by reporting month and model version; name the version")
    warnings = check_score_mart(score_mart, spec)
    if warnings:
        raise ValueError("; ".join(warnings))
    months, source = reporting_months, spec.source
    by = cohorts.baseline_keys(spec.baseline)
    current = cohorts.current_cohort(score_mart, spec, months)
    baseline = cohorts.baseline_rows(score_mart, spec, months)
    extra = [k for k in ("reporting_month",) if k not in by]
    spine = cohorts.reporting_spine(score_mart, spec, months)
    out: dict[str, DataFrame] = {
        "baseline_info": cohorts.baseline_info(score_mart, spec, months)}

    # Baseline accounts are counted by month first; windows of months add up those counts.
    wanted = [source.channel, source.score, *([spec.scorecard] if spec.scorecard in score_mart.columns else [])]
    monthly = stage(cohorts.monthly_counts(cohorts.in_baseline_months(score_mart, spec, months), spec, wanted),
                    "monthly_counts")
    base_counts = cohorts.baseline_counts(monthly, spec, months)
    windows = cohorts.baseline_windows(monthly, spec, months)
    judged = governance.judge(stability.score_stability(current, monthly, spec, by, windows),
                              spec.thresholds, "psi", F.col("score_psi"), "score_psi_status")
    out["score_stability"] = kept(judged)
    out["feature_stability"] = kept(governance.judge(
        stability.feature_stability(current, baseline, spec, by), spec.thresholds,
        "feature_psi", F.col("psi")))
    scoped = over_scopes(current, None, (), spec.scorecard)
    scoped_base = over_scopes(baseline, None, (), spec.scorecard)
    if asked("psi_table"):
        out["psi_table"] = drift.psi_table(scoped_base, scoped, [*by, "scorecard"], extra, source.score,
                                           spec.intervals)
    if asked("csi_table"):
        out["csi_table"] = drift.csi_table(scoped_base, scoped, [*by, "scorecard"], extra,
                                           source.features, spec.n_bins)
    out["score_quality"] = stability.score_quality(current, spec)
    out["feature_missing"] = stability.feature_missing(current, spec)
    columns = [source.score, source.channel, *source.features]
    out["column_quality"] = kept(governance.judge(
        quality.column_quality(scoped, ["reporting_month", "scorecard"], columns,
                               {source.score: (0.0, 1.0)}),
        spec.thresholds, "missing_rate", F.col("missing_rate"), "missing_status"))
    out["record_quality"] = quality.record_quality(scoped, ["reporting_month", "scorecard"],
                                                   [source.keys[0]], columns)
    out["portfolio"] = stability.portfolio_summary(out["score_stability"], base_counts, spec, by)
    if spec.decile_col in score_mart.columns and asked("mix_shift", "mix_shift_summary"):
        out["mix_shift"] = mix.mix_shift(scoped_base, scoped, [*by, "scorecard"], extra, spec.decile_col)
        out["mix_shift_summary"] = mix.mix_shift_summary(out["mix_shift"], ["reporting_month", "scorecard"])
    governed = {"score_stability": out["score_stability"],
                "feature_stability": out["feature_stability"], "columns": out["column_quality"]}

    if performance_mart is not None:
        for warning in check_performance_mart(performance_mart, spec):
            log.warning("performance mart: %s", warning)
        cohort = stage(cohort_columns(
            cohorts.performance_cohorts(score_mart, performance_mart, spec, months), spec),
            "cohorts", ["reporting_month"])
        base = stage(cohort_columns(
            cohorts.with_outcomes(baseline, performance_mart, spec), spec), "baseline_cohorts")
        out["cohort_info"] = kept(cohorts.cohort_info(score_mart, performance_mart, spec, months,
                                                      cohort))
        out["separation"] = kept(governance.judge(
            outcomes.ks_drop(outcomes.separation(cohort, spec), base, spec, by), spec.thresholds,
            "ks_drop", F.col("ks_drop"), "ks_drop_status"))
        out["odds"] = kept(outcomes.odds(cohort, spec))
        out["separation"] = outcomes.with_odds_order(out["separation"], out["odds"])
        if asked("ks_table"):
            out["ks_table"] = outcomes.ks_table(cohort, spec)
        out["performance"] = kept(governance.judge(
            outcomes.performance_report(outcomes.performance(cohort, spec),
                                        outcomes.baseline_performance(base, spec, by),
                                        out["cohort_info"]),
            spec.thresholds, "edr_delta", F.col("edr_delta"), "edr_delta_status"))
        out["rank_ordering"] = outcomes.rank_ordering(cohort, spec)
        out["risk_capture"] = outcomes.risk_capture(cohort, spec)
        out["calibration"] = kept(governance.judge(
            outcomes.calibration(cohort, spec), spec.thresholds, "calibration_gap",
            F.abs("calibration_gap"), "gap_status"))
        out["calibration_summary"] = outcomes.calibration_summary(out["calibration"],
                                                                  outcomes.COHORT)
        target = cohort.filter(F.col("maturity") == spec.attribution.target_maturity)
        target = over_scopes(target, None, (), spec.scorecard)
        out["attribution"] = mix.attribution(target, spec.attribution, "scorecard")
        if asked("attribution_overview"):
            out["attribution_overview"] = mix.attribution_overview(target, spec.attribution, "scorecard")
        governed |= {"ks_drop": out["separation"], "performance": out["performance"],
                     "calibration": out["calibration"]}

    out["governance"] = kept(governance.governance_table(spec.thresholds, **governed))
    out["flags"] = governance.flags(out["governance"])
    out["health"] = governance.overall_health(out["governance"])
    if performance_mart is not None:
        out["diagnosis"] = reports.monitoring_diagnosis(
            spec, out["cohort_info"], out["score_stability"], out["feature_stability"],
            out["separation"], out["calibration"])
    # Sections by what they hold: outcome rows with figures, not note rows.
    sections = {"stability": out["score_stability"].filter(F.col("account_count") > 0),
                "data_quality": out["score_quality"], "governance_flags": out["flags"]}
    if performance_mart is not None:
        sections |= {"separation": out["separation"].filter(F.col("ks").isNotNull()),
                     "performance": out["performance"].filter(F.col("note").isNull()),
                     "calibration": out["calibration"],
                     "attribution": out["attribution"].filter(F.col("scorecard") == OVERALL)}
    out["availability"] = governance.availability(spine, sections, out.get("cohort_info"))
    if write is not None:
        for name, df in out.items():
            if asked(name):
                write(stamp_run(df, spine, model_version), name)
    return out


def stamp_run(df: DataFrame, spine: DataFrame, model_version: str) -> DataFrame:
    """Add the model version, and the run's reporting months to a table that holds for them all."""
    if "reporting_month" not in df.columns:
        df = spine.withColumn("_run", F.lit(1)).join(df.withColumn("_run", F.lit(1)), "_run").drop("_run")
    return df.withColumn("model_version", F.lit(model_version))


def release(tables: dict[str, DataFrame]) -> None:
    for df in tables.values():
        df.unpersist()
