"""Bins and labels on account rows: dynamic and static quantile bins, buckets, bands."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import band_label, bucket_label, quantile_bin
from scorewatch.plans.lookup import attach, measure
from scorewatch.plans.ranking import equal_bins, ntile_ranks, quantiles
from scorewatch.spec import Bucket


def dynamic_bins(df: DataFrame, score: str, n_bins: int, partition_by: Sequence[str], out: str,
                 tiebreak: str | None = None) -> DataFrame:
    """Bins 1..n of equal size within each partition, lowest scores first, nulls in bin 1."""
    return equal_bins(df, partition_by, score, tiebreak, out, ntile_ranks(n_bins), n_bins)


def bin_fractions(n_bins: int) -> list:
    return [Fraction(i, n_bins) for i in range(1, n_bins)]


def static_bins(df: DataFrame, baseline: DataFrame, score: str, n_bins: int,
                partition_by: Sequence[str], out: str, accuracy: int | None = None) -> DataFrame:
    """Bins 1..n by the baseline's quantile edges; null without a score or without edges."""
    if baseline is None:
        raise ValueError("static bins need a baseline")
    keys = list(partition_by)
    valued = baseline.filter(F.col(score).isNotNull())
    sizing = measure(valued, keys)
    edges = quantiles(valued, keys, score, bin_fractions(n_bins), accuracy=accuracy, sizing=sizing)
    joined = attach(df, edges.select(*keys, F.col("edges").alias("_edges")), keys,
                    sizing.broadcast_fits(8 * n_bins + 256), how="left", spread=[score])
    return (joined.withColumn(out, quantile_bin(F.col(score), F.col("_edges"), n_bins - 1))
            .drop("_edges"))


def fallback_deciles(df: DataFrame, keys: Sequence[str], score: str, out: str,
                     n_bins: int = 10) -> DataFrame:
    """Bins by each group's own distinct quantile edges, for tables without a static decile."""
    keys = list(keys)
    valued = df.filter(F.col(score).isNotNull())
    sizing = measure(valued, keys)
    edges = quantiles(valued, keys, score, bin_fractions(n_bins), sizing=sizing)
    joined = attach(df, edges.select(*keys, F.array_distinct("edges").alias("_edges")), keys,
                    sizing.broadcast_fits(8 * n_bins + 256), how="left", null_safe=True,
                    spread=[score])
    return (joined.withColumn(out, quantile_bin(F.col(score), F.col("_edges"), n_bins - 1))
            .drop("_edges"))


def with_bucket(df: DataFrame, bucket: Bucket) -> DataFrame:
    return df.withColumn(bucket.name, bucket_label(bucket))


def with_band(df: DataFrame, decile: str, bands: Mapping[str, Sequence[int]], out: str) -> DataFrame:
    return df.withColumn(out, band_label(F.col(decile), bands))
