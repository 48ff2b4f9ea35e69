"""Business tables: configured group-by metrics, shares of a total, population profiles."""
from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.functions.columns import ratio
from scorewatch.spec import Metric, Share, TableSpec

log = logging.getLogger(__name__)

AGGREGATES = {
    "count": lambda col: F.count(F.lit(1)),
    "avg": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "stddev": F.stddev,
    "countDistinct": F.countDistinct,
}


def summarize(df: DataFrame, group_by: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    unknown = [m.func for m in metrics if m.func not in AGGREGATES]
    if unknown:
        raise ValueError(f"Unsupported aggregation function '{unknown[0]}'. "
                         f"Supported: {list(AGGREGATES)}")
    return df.groupBy(*group_by).agg(*[AGGREGATES[m.func](m.col).alias(m.alias) for m in metrics])


def with_shares(df: DataFrame, shares: Sequence[Share]) -> DataFrame:
    """Shares of a group total, on aggregated rows; incomplete specs are skipped."""
    for share in shares:
        if not (share.over and share.source):
            log.warning("share '%s' lacks over or source; skipped", share.name)
            continue
        total = F.sum(share.source).over(Window.partitionBy(*share.over))
        df = df.withColumn(share.name, ratio(F.col(share.source), total))
    return df


def business_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    return with_shares(summarize(df, spec.group_by, spec.metrics), spec.shares)


def business_tables(df: DataFrame, specs: Sequence[TableSpec]) -> dict[str, DataFrame]:
    return {spec.name: business_table(df, spec) for spec in specs}


def band_shares(distribution: DataFrame, decile: str, share: str,
                bands: Mapping[str, Sequence[int]]) -> DataFrame:
    """Decile shares rolled up per band, one column each; other deciles go to the last band."""
    names = list(bands)
    listed = {name: F.col(decile).isin(*bands[name]) for name in names[:-1]}
    rest = ~F.coalesce(F.col(decile).isin(*[d for n in names[:-1] for d in bands[n]]), F.lit(False))
    conditions = {**listed, names[-1]: rest}
    return distribution.groupBy("vintage_month", "channel").agg(
        *[F.sum(F.when(condition, F.col(share)).otherwise(0.0)).alias(f"{name.lower()}_share")
          for name, condition in conditions.items()])


def score_profile(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("account_count"), F.avg(score).alias("mean_score"),
        F.stddev(score).alias("std_score"), F.min(score).alias("min_score"),
        F.max(score).alias("max_score"))


def period_mix(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Counts and shares of a column's values in both periods."""
    periods = (baseline.select(column).withColumn("period", F.lit("baseline"))
               .unionByName(current.select(column).withColumn("period", F.lit("current"))))
    counts = periods.groupBy("period", column).agg(F.count(F.lit(1)).alias("account_count"))
    return with_shares(counts, [Share("share", "account_count", ("period",))])
