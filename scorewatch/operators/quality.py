"""Missing and out-of-range values, duplicates, and how features relate to the score."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import (correlation, is_missing, melt, numeric_columns, or_zero,
                                          ratio)
from scorewatch.plans.lookup import attach, measure
from scorewatch.plans.ranking import quantiles
from scorewatch.plans.spine import expected_groups
from scorewatch.spec import DriftSpec, Source

#: Distinct-value sketches have ``2 ** SKETCH_BITS`` registers: a standard error of 0.8 %.
SKETCH_BITS = 14


def missing_share(df: DataFrame, name: str) -> Column:
    return or_zero(F.avg(F.when(is_missing(df, name), 1.0).otherwise(0.0)))


def outlier_share(value: Column, low: Column, high: Column) -> Column:
    """Share of the non-null values outside ``[low, high]``."""
    outside = F.when((value < low) | (value > high), 1.0).otherwise(0.0)
    return or_zero(F.avg(F.when(value.isNotNull(), outside)))


def missing_rates(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows, missing values and missing rate of every column, in one scan."""
    counts = [F.count_if(is_missing(df, c)).alias(c) for c in columns]
    wide = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_count"), *counts)
    long = melt(wide, [*keys, "total_count"], columns, "column_name", "missing_count", "long")
    return long.withColumn("missing_rate", or_zero(ratio(F.col("missing_count"),
                                                         F.col("total_count"))))


def outlier_rates(df: DataFrame, column: str, low: float, high: float,
                  keys: Sequence[str] = ()) -> DataFrame:
    value = F.col(column)
    return df.groupBy(*keys).agg(
        F.count(value).alias("total_count"),
        F.count_if((value < low) | (value > high)).alias("outlier_count"),
        outlier_share(value, F.lit(low), F.lit(high)).alias("outlier_rate"))


def data_quality(current: DataFrame, source: Source, spec: DriftSpec) -> DataFrame:
    """Missing and out-of-range score rates per month and configured channel."""
    low, high = (F.lit(float(b)) for b in spec.score_bounds)
    now = (current.filter(F.col(source.channel).isin(*source.channels))
           .select("vintage_month", F.col(source.channel).alias("channel"), source.score))
    rates = now.groupBy("vintage_month", "channel").agg(
        missing_share(now, source.score).alias("missing_score_rate"),
        outlier_share(F.col(source.score), low, high).alias("outlier_score_rate"))
    spine = expected_groups(current, ["vintage_month"], channel=source.channels)
    return (spine.join(rates, ["vintage_month", "channel"], "left")
            .na.fill(0.0, ["missing_score_rate", "outlier_score_rate"]))


def outlier_bounds(baseline: DataFrame, keys: Sequence[str], value: str,
                   fractions: tuple[float, float]) -> DataFrame:
    """Low and high baseline quantile per group that has values."""
    return (quantiles(baseline, keys, value, fractions)
            .select(*keys, F.get("edges", F.lit(0)).alias("low"), F.get("edges", F.lit(1)).alias("high")))


def feature_quality(current: DataFrame, baseline: DataFrame, source: Source, spec: DriftSpec,
                    features: Sequence[str] | None = None) -> DataFrame:
    """Missing rate, and outlier rate by the baseline's own range, per month, channel, feature."""
    features = list(features or source.features)
    keys = ["vintage_month", "channel", "feature_name"]
    now = melt(current.filter(F.col(source.channel).isin(*source.channels))
               .withColumn("channel", F.col(source.channel)),
               keys[:2], features, "feature_name", "value")
    then = melt(baseline.filter(F.col(source.channel).isin(*source.channels))
                .withColumn("channel", F.col(source.channel)),
                ["channel"], features, "feature_name", "value")
    sizing = measure(then, ["channel", "feature_name"])
    bounds = outlier_bounds(then, ["channel", "feature_name"], "value", spec.outlier_quantiles)
    rows = attach(now, bounds, ["channel", "feature_name"], sizing.broadcast_fits(256), how="left",
                  spread=["value"])
    low, high = F.coalesce("low", F.lit(0.0)), F.coalesce("high", F.lit(1.0))
    rates = rows.groupBy(*keys).agg(
        missing_share(now, "value").alias("missing_rate"),
        outlier_share(F.col("value"), low, high).alias("outlier_rate"))
    spine = expected_groups(current, ["vintage_month"], channel=source.channels,
                            feature_name=features)
    return (spine.join(rates, keys, "left").join(bounds, ["channel", "feature_name"], "left")
            .select(*keys, or_zero(F.col("missing_rate")).alias("missing_rate"),
                    or_zero(F.col("outlier_rate")).alias("outlier_rate"),
                    low.alias("outlier_lower_bound"), high.alias("outlier_upper_bound")))


def feature_score_relationship(current: DataFrame, baseline: DataFrame, source: Source,
                               features: Sequence[str] | None = None) -> DataFrame:
    """Correlation of each numeric feature with the score, then and now."""
    features = numeric_columns(current, list(features or source.features))

    def pairs(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        own = (df.filter(F.col(source.channel).isin(*source.channels))
               .withColumn("channel", F.col(source.channel))
               .withColumn("_score", F.col(source.score).cast("double")))
        return (melt(own, [*keys, "_score"], features, "feature_name", "value")
                .filter(F.col("value").isNotNull() & F.col("_score").isNotNull()))

    keys = ["vintage_month", "channel", "feature_name"]
    now = pairs(current, keys[:2]).groupBy(*keys).agg(
        correlation("value", "_score").alias("current_corr"))
    then = pairs(baseline, ["channel"]).groupBy("channel", "feature_name").agg(
        correlation("value", "_score").alias("baseline_corr"))
    spine = expected_groups(current, ["vintage_month"], channel=source.channels,
                            feature_name=features)
    return (spine.join(then, ["channel", "feature_name"], "left").join(now, keys, "left")
            .select(*keys, "baseline_corr", "current_corr",
                    (F.col("current_corr") - F.col("baseline_corr")).alias("corr_change")))


def record_quality(df: DataFrame, scopes: Sequence[str], keys: Sequence[str],
                   columns: Sequence[str]) -> DataFrame:
    """Record count, duplicate-key rate and overall missing rate per scope."""
    per_key = df.groupBy(*scopes, *keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_missing(df, c)).alias(f"_missing_{c}") for c in columns])
    missing = sum((F.sum(f"_missing_{c}") for c in columns), F.lit(0))
    return per_key.groupBy(*scopes).agg(
        F.sum("_rows").alias("total_records"),
        (1 - ratio(F.count(F.lit(1)), F.sum("_rows"))).alias("duplicate_rate"),
        or_zero(ratio(missing, F.sum("_rows") * len(columns))).alias("overall_missing_rate"))


def column_quality(df: DataFrame, scopes: Sequence[str], columns: Sequence[str],
                   bounds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Missing rate, outlier rate and distinct values of every column per scope.

    Values are counted once per distinct value first, so a hot value is one row
    in the shuffle and the distinct count needs no per-group set.
    """
    bounds = bounds or {}
    missing = {c: is_missing(df, c) for c in columns}
    entries = [F.struct(F.lit(c).alias("column_name"),
                        F.when(~missing[c], F.col(c).cast("string")).alias("value"),
                        *([F.when((F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1]), 1)
                           .otherwise(0).alias("outside")] if c in bounds
                          else [F.lit(0).alias("outside")])) for c in columns]
    long = df.select(*scopes, F.explode(F.array(*entries)).alias("_e")).select(*scopes, "_e.*")
    by_value = (long.groupBy(*scopes, "column_name", "value", "outside")
                .agg(F.count(F.lit(1)).alias("_n")))
    present = F.col("value").isNotNull()
    return by_value.groupBy(*scopes, "column_name").agg(
        F.sum("_n").alias("total_count"),
        or_zero(ratio(F.sum(F.when(~present, F.col("_n")).otherwise(0)), F.sum("_n")))
        .alias("missing_rate"),
        or_zero(ratio(F.sum(F.col("_n") * F.col("outside")),
                      F.sum(F.when(present, F.col("_n")).otherwise(0)))).alias("outlier_rate"),
        F.count_if(present).alias("unique_count"))


def column_sketches(df: DataFrame, scopes: Sequence[str], columns: Sequence[str],
                    bounds: dict[str, tuple[float, float]] | None = None,
                    bits: int = SKETCH_BITS) -> DataFrame:
    """Mergeable counts and a distinct-value sketch of every column per scope.

    One scan, one row per scope in the shuffle whatever the number of values: rows are neither
    exploded by column nor grouped by value. Values are hashed in their own type. A table kept per
    month and segment gives the figures of any coarser scope through ``merge_sketches`` without
    its accounts. A sketch has at most ``2 ** bits`` bytes.
    """
    bounds = bounds or {}
    parts = []
    for c in columns:
        missing = is_missing(df, c)
        outside = (F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1]) if c in bounds else F.lit(False)
        parts.append(F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("total_count"),
            F.count_if(missing).alias("missing_count"), F.count_if(outside).alias("outlier_count"),
            F.hll_sketch_agg(F.when(~missing, F.xxhash64(c)), bits).alias("distinct_values")))
    wide = df.groupBy(*scopes).agg(F.array(*parts).alias("_parts"))
    return wide.select(*scopes, F.explode("_parts").alias("_p")).select(*scopes, "_p.*")


def merge_sketches(sketches: DataFrame, scopes: Sequence[str]) -> DataFrame:
    """Sketches of coarser scopes, or of tables put end to end, from finer ones."""
    return sketches.groupBy(*scopes, "column_name").agg(
        *[F.sum(c).alias(c) for c in ("total_count", "missing_count", "outlier_count")],
        F.hll_union_agg("distinct_values").alias("distinct_values"))


def sketched_quality(sketches: DataFrame) -> DataFrame:
    """The figures of ``column_quality``, its distinct count as ``unique_estimate``."""
    total, missing = F.col("total_count"), F.col("missing_count")
    kept = [c for c in sketches.columns
            if c not in ("total_count", "missing_count", "outlier_count", "distinct_values")]
    return sketches.select(
        *kept, "total_count", or_zero(ratio(missing, total)).alias("missing_rate"),
        or_zero(ratio(F.col("outlier_count"), total - missing)).alias("outlier_rate"),
        F.hll_sketch_estimate("distinct_values").alias("unique_estimate"))


def within_sketch_error(estimate: Column, exact: Column, bits: int = SKETCH_BITS) -> Column:
    """Whether an estimate lies within five standard errors (1.04 / sqrt(2 ** bits)) and one."""
    return F.abs(estimate - exact) <= exact * (5 * 1.04 / 2 ** (bits / 2)) + 1
