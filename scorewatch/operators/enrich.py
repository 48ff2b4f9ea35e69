"""Account enrichment: stamps, bins, bands, buckets, flags and a caller's own step."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.operators.binning import dynamic_bins, static_bins, with_band, with_bucket
from scorewatch.sources.tables import stamp
from scorewatch.spec import Enrichment, Source


def enrich(df: DataFrame, baseline: DataFrame, source: Source, spec: Enrichment,
           score_month: str, model_version: str) -> DataFrame:
    df = stamp(df, score_month, model_version)
    df = df.withColumn("vintage_month", F.col(source.month))
    df = dynamic_bins(df, source.score, spec.n_bins, spec.dynamic_partition, spec.decile_col,
                      source.keys[0])
    if spec.bands and spec.band_col:
        df = with_band(df, spec.decile_col, spec.bands, spec.band_col)
    df = static_bins(df, baseline, source.score, spec.static_bins, spec.static_partition,
                     spec.static_col)
    for bucket in spec.buckets:
        df = with_bucket(df, bucket)
    df = df.withColumns({name: F.expr(sql) for name, sql in spec.flags.items()})
    return df.transform(spec.hook) if spec.hook else df
