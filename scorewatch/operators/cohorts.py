"""Who is monitored, against which baseline, and with which outcomes, per reporting month.

A reporting month is a column, so one plan serves a single month, a list of
months, or the whole history.
"""
from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import indicator, shift_month_col
from scorewatch.plans.lookup import attach, few_rows, keep_listed
from scorewatch.spec import MATURITIES, Baseline, Maturity, Monitoring, shift_month

log = logging.getLogger(__name__)

NO_MATURE_NOTE = "No mature accounts available yet"


def monitored(mart: DataFrame, spec: Monitoring) -> DataFrame:
    """Accounts not excluded from monitoring; every account when the flag is absent."""
    if spec.exclusion_flag not in mart.columns:
        return mart
    return mart.filter(F.col(spec.exclusion_flag) == 0)


def backfill_range(reporting_month: str, history_months: int) -> list[str]:
    """``history_months`` earlier months and the reporting month itself."""
    return [shift_month(reporting_month, -i) for i in range(history_months, -1, -1)]


def backfill_readiness(mart: DataFrame, spec: Monitoring) -> DataFrame:
    """Whether the mart holds enough months for a baseline: ``months, required, is_ready``."""
    months = mart.agg(F.countDistinct(spec.source.month).alias("months"))
    return months.withColumns({"required": F.lit(spec.backfill_min_months),
                               "is_ready": F.col("months") >= spec.backfill_min_months})


def reporting_spine(mart: DataFrame, spec: Monitoring,
                    reporting_months: Sequence[str] | None) -> DataFrame:
    """One row per reporting month: those asked for, or every month of the mart."""
    if reporting_months is None:
        return mart.select(F.col(spec.source.month).alias("reporting_month")).distinct()
    spark = mart.sparkSession
    return spark.createDataFrame([(m,) for m in reporting_months], "reporting_month string")


def current_cohort(mart: DataFrame, spec: Monitoring,
                   reporting_months: Sequence[str] | None = None) -> DataFrame:
    """Monitored accounts scored in the reporting month."""
    rows = monitored(mart, spec)
    month = F.col(spec.source.month)
    if reporting_months is not None:
        rows = rows.filter(month.isin(*reporting_months))
    return rows.withColumn("reporting_month", month)


def baseline_keys(baseline: Baseline) -> list[str]:
    """Extra grouping keys of the baseline: a rolling window has one per reporting month."""
    return ["reporting_month"] if _kind(baseline) == "rolling_window" else []


def _kind(baseline: Baseline) -> str:
    if baseline.kind == "fixed_window" and baseline.start and baseline.end:
        return "fixed_window"
    return "rolling_window" if baseline.kind == "rolling_window" else "initial_val"


def baseline_rows(mart: DataFrame, spec: Monitoring,
                  reporting_months: Sequence[str] | None = None) -> DataFrame:
    """Baseline accounts: a fixed window, the months before each reporting month, or the
    first months on record (also when a fixed window has no bounds)."""
    return _in_windows(monitored(mart, spec), mart, spec, reporting_months)


def monthly_counts(mart: DataFrame, spec: Monitoring, columns: Sequence[str]) -> DataFrame:
    """Monitored accounts per month and value of the columns: ``<month>, columns, n``.

    One map-side combined count over the whole history. Counts of months add up, so any window of
    months comes from this table without reading accounts again.
    """
    by = dict.fromkeys([spec.source.month, *columns])
    return monitored(mart, spec).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def baseline_counts(monthly: DataFrame, spec: Monitoring,
                    reporting_months: Sequence[str] | None = None) -> DataFrame:
    """The counts of each baseline window: monthly counts merged over its months."""
    keys, month = baseline_keys(spec.baseline), spec.source.month
    columns = [c for c in monthly.columns if c not in (month, "n")]
    windows = _in_windows(monthly, monthly, spec, reporting_months)
    return windows.groupBy(*keys, *columns).agg(F.sum("n").alias("n"))


def baseline_windows(monthly: DataFrame, spec: Monitoring,
                     reporting_months: Sequence[str] | None = None) -> DataFrame:
    """The months of each baseline window: ``<month>`` and, of rolling ones, ``reporting_month``."""
    months = monthly.select(spec.source.month).distinct()
    return _in_windows(months, months, spec, reporting_months)


def in_baseline_months(rows: DataFrame, spec: Monitoring, reporting_months: Sequence[str] | None) -> DataFrame:
    """Rows of the months that some window holds, where these are known beforehand."""
    month, setting = F.col(spec.source.month), spec.baseline
    if _kind(setting) == "fixed_window":
        return rows.filter(month.between(setting.start, setting.end))
    if _kind(setting) == "rolling_window" and reporting_months is not None:
        needed = {shift_month(m, -i) for m in reporting_months for i in range(1, setting.months + 1)}
        return rows.filter(month.isin(*sorted(needed)))
    return rows


def _in_windows(rows: DataFrame, mart: DataFrame, spec: Monitoring,
                reporting_months: Sequence[str] | None) -> DataFrame:
    """Rows, or counts of rows, by the baseline windows that their month is in."""
    month, setting = F.col(spec.source.month), spec.baseline
    kind, rows = _kind(setting), in_baseline_months(rows, spec, reporting_months)
    if kind == "fixed_window":
        return rows
    if kind == "rolling_window":
        ahead = F.array(*[shift_month_col(month, i) for i in range(1, setting.months + 1)])
        rows = rows.withColumn("reporting_month", F.explode(ahead))
        if reporting_months is not None:
            return rows.filter(F.col("reporting_month").isin(*reporting_months))
        return keep_listed(rows, reporting_spine(mart, spec, None), "reporting_month")
    # At most ``months`` rows by construction.
    first = rows.select(spec.source.month).distinct().orderBy(spec.source.month).limit(setting.months)
    return rows.join(F.broadcast(first), spec.source.month, "left_semi")


def baseline_info(mart: DataFrame, spec: Monitoring,
                  reporting_months: Sequence[str] | None = None) -> DataFrame:
    """Kind, bounds, months and row count of the baseline (per reporting month if rolling)."""
    kind, setting = _kind(spec.baseline), spec.baseline
    keys, month = baseline_keys(setting), F.col(spec.source.month)
    counts = monthly_counts(mart, spec, [])
    info = _in_windows(counts, counts, spec, reporting_months).groupBy(*keys).agg(
        F.min(month).alias("_first"), F.max(month).alias("_last"),
        F.array_sort(F.collect_set(month)).alias("months"),
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("account_count"))
    if kind == "fixed_window":
        start, end = F.lit(setting.start), F.lit(setting.end)
    elif kind == "rolling_window":
        spine = reporting_spine(mart, spec, reporting_months)
        info = spine.join(info, "reporting_month", "left").withColumns({
            "months": F.coalesce("months", F.array().cast("array<string>")),
            "account_count": F.coalesce("account_count", F.lit(0).cast("long"))})
        start = shift_month_col(F.col("reporting_month"), -setting.months)
        end = shift_month_col(F.col("reporting_month"), -1)
    else:
        start, end = F.coalesce("_first", F.lit("")), F.coalesce("_last", F.lit(""))
    return info.select(*keys, F.lit(kind).alias("baseline_type"), start.alias("start_month"),
                       end.alias("end_month"), "months", "account_count")


def usable_maturities(outcomes: DataFrame, spec: Monitoring) -> list[Maturity]:
    missing = [m for m in MATURITIES if m.flag not in outcomes.columns]
    if missing and spec.on_missing_maturity != "skip_with_note":
        raise ValueError(f"Cohort {missing[0].label}: maturity flag '{missing[0].flag}' not in perf_mart")
    for m in missing:
        log.warning("cohort %s: no column %s; skipped with a note", m.label, m.flag)
    return [m for m in MATURITIES if m not in missing]


def _by_maturity(joined: DataFrame, maturities: Sequence[Maturity], outcomes: DataFrame) -> DataFrame:
    """One row per account and outcome window."""
    def outcome(name: str):
        return F.col(name).cast("int") if name in outcomes.columns else F.lit(None).cast("int")

    windows = F.array(*[
        F.struct(F.lit(m.label).alias("maturity"),
                 outcome(m.edr).alias("edr"), outcome(m.bad).alias("bad"),
                 F.col(m.flag).alias("is_mature")) for m in maturities])
    outcome_columns = [c for m in maturities for c in (m.edr, m.bad, m.flag) if c in joined.columns]
    return (joined.withColumn("_window", F.explode(windows))
            .drop(*outcome_columns)
            .select("*", "_window.*").drop("_window"))


def _aligned(rows: DataFrame, maturities: Sequence[Maturity], month: str) -> DataFrame:
    """The reporting month that each month's outcome windows fall in: ``<month>, maturity, reporting_month``."""
    windows = F.array(*[F.struct(F.lit(m.label).alias("maturity"),
                                 shift_month_col(F.col(month), m.months_back).alias("reporting_month"))
                        for m in maturities])
    months = rows.select(month).distinct()
    return months.select(month, F.explode(windows).alias("_window")).select(month, "_window.*")


def with_outcomes(rows: DataFrame, outcomes: DataFrame, spec: Monitoring,
                  listed: DataFrame | None = None) -> DataFrame:
    """Mature accounts with their outcome of every window: adds ``maturity, reporting_month,
    edr, bad``. The join runs once on account and month, the windows are split after it.

    Months are shifted once per month, not per account (baseline rows that already belong to a
    reporting month keep theirs). ``listed`` names the reporting months to keep; all if it is none.
    """
    maturities, month = usable_maturities(outcomes, spec), spec.source.month
    keys = [spec.source.keys[0], month]
    wanted = [c for m in maturities for c in (m.flag, m.edr, m.bad) if c in outcomes.columns]
    slim = outcomes.select(*keys, *wanted)
    mature = reduce(lambda a, b: a | b, [F.col(m.flag) == 1 for m in maturities], F.lit(False))
    joined = rows.join(slim.filter(mature), keys)
    split = _by_maturity(joined, maturities, slim).filter(F.col("is_mature") == 1).drop("is_mature")
    if "reporting_month" in rows.columns:
        return split
    windows = _aligned(rows, maturities, month)
    if listed is not None:
        windows = windows.join(listed, "reporting_month", "left_semi")
    return attach(split, windows, [month, "maturity"], few_rows(windows), spread=[spec.source.keys[0]])


def performance_cohorts(mart: DataFrame, outcomes: DataFrame, spec: Monitoring,
                        reporting_months: Sequence[str] | None = None) -> DataFrame:
    """Mature accounts of each reporting month's outcome windows, as one long table."""
    rows, month = monitored(mart, spec), F.col(spec.source.month)
    if reporting_months is not None:
        aligned = sorted({shift_month(r, -m.months_back) for r in reporting_months
                          for m in MATURITIES})
        rows = rows.filter(month.isin(*aligned))
        outcomes = outcomes.filter(month.isin(*aligned))
    return with_outcomes(rows, outcomes, spec, reporting_spine(mart, spec, reporting_months))


def cohort_info(mart: DataFrame, outcomes: DataFrame, spec: Monitoring,
                reporting_months: Sequence[str] | None = None,
                cohorts: DataFrame | None = None) -> DataFrame:
    """Scored and mature accounts of every outcome window, whether usable, and why not.

    Windows without any scored account are not listed.
    """
    usable = {m.label for m in usable_maturities(outcomes, spec)}
    if cohorts is None:
        cohorts = performance_cohorts(mart, outcomes, spec, reporting_months)
    scored = (monitored(mart, spec).groupBy(F.col(spec.source.month).alias("score_month"))
              .agg(F.count(F.lit(1)).alias("_scored")))
    windows = F.array(*[F.struct(
        F.lit(m.label).alias("maturity"),
        shift_month_col(F.col("score_month"), m.months_back).alias("reporting_month"),
        F.lit(m.label in usable).alias("_usable"),
        F.lit(f"Maturity flag '{m.flag}' not available").alias("_why")) for m in MATURITIES])
    listed = (scored.withColumn("_w", F.explode(windows)).select("score_month", "_scored", "_w.*")
              .join(reporting_spine(mart, spec, reporting_months), "reporting_month", "left_semi"))
    mature = cohorts.groupBy("reporting_month", "maturity").agg(F.count(F.lit(1)).alias("_mature"))
    joined = listed.join(mature, ["reporting_month", "maturity"], "left")
    count = F.coalesce("_mature", F.lit(0).cast("long"))
    note = (F.when(~F.col("_usable"), F.col("_why"))
            .when(count == 0, F.lit(NO_MATURE_NOTE)).otherwise(""))
    return joined.select("reporting_month", "maturity", "score_month",
                         F.when(F.col("_usable"), F.col("_scored")).otherwise(0).alias("account_count"),
                         F.when(F.col("_usable"), count).otherwise(0).alias("mature_count"),
                         (F.col("_usable") & (count > 0)).alias("available"), note.alias("note"))


def join_coverage(mart: DataFrame, outcomes: DataFrame, spec: Monitoring) -> DataFrame:
    """Scored, outcome and joined accounts per score month, mature counts, and a status."""
    keys = [spec.source.keys[0], spec.source.month]
    flags = [m for m in MATURITIES if m.flag in outcomes.columns]
    sides = (mart.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_p"),
                         *[F.lit(0).alias(m.flag) for m in flags])
             .unionByName(outcomes.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_p"),
                                          *[indicator(F.col(m.flag) == 1).alias(m.flag)
                                            for m in flags])))
    per_key = sides.groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_p").alias("_p"),
                                       *[F.sum(m.flag).alias(m.flag) for m in flags])
    counts = per_key.groupBy(F.col(spec.source.month).alias("score_month")).agg(
        F.sum("_s").alias("score_rows"), F.sum("_p").alias("perf_rows"),
        F.sum(F.col("_s") * F.col("_p")).alias("joined_rows"),
        *[F.sum(F.col("_s") * F.col(m.flag)).alias(f"mature_{m.label.lower()}") for m in flags])
    status = (F.when(F.col("joined_rows") > 0, "OK").when(F.col("score_rows") == 0, "no data")
              .otherwise("join=0"))
    return counts.withColumn("status", status)


def latest_vintage(table: DataFrame, month: str, requested: str) -> DataFrame:
    """Rows of the requested month if the table has it, else of its last month."""
    pick = table.agg(F.coalesce(F.max(F.when(F.col(month) == requested, F.col(month))),
                                F.max(month)).alias("_picked"))
    # One row by construction: a global aggregate.
    return table.join(F.broadcast(pick), F.col(month) == F.col("_picked")).drop("_picked")
