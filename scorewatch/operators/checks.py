"""Promotion gate: reconciling the account, business and monitoring tables of a run."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import numeric_columns, ratio
from scorewatch.spec import Source

GROUP = ["vintage_month", "channel"]


def _checks(df: DataFrame, measures: Mapping[str, tuple]) -> DataFrame:
    """Rows ``check, value, limit, passed`` from one global aggregate, unpivoted.

    A measure is its value, its limit and whether it must stay below the limit. A check of an
    empty table, or one that comes to no number, has no value and fails.
    """
    found = df.agg(*[F.when(F.count(F.lit(1)) > 0, value.cast("double")).alias(name)
                     for name, (value, *_) in measures.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("check"), F.col(name).alias("value"),
                              F.lit(float(limit)).alias("limit"), F.lit(bool(strict)).alias("strict"))
                     for name, (_, limit, strict) in measures.items()])
    ok = F.when(F.col("strict"), F.col("value") < F.col("limit")).otherwise(F.col("value") <= F.col("limit"))
    return (found.select(F.explode(rows).alias("_row")).select("_row.*")
            .select("check", "value", "limit", F.coalesce(ok, F.lit(False)).alias("passed")))


def _if_any(found: Column, value: Column) -> Column:
    """A value over the groups that were found; none if there are no such groups."""
    return F.when(F.count(found) > 0, value)


def promotion_checks(source_rows: DataFrame, account: DataFrame, business: Mapping[str, DataFrame],
                     monitoring: Mapping[str, DataFrame], source: Source, decile: str,
                     n_bins: int = 10, segments: Sequence[str] = (),
                     buckets: Sequence[str] = ()) -> DataFrame:
    """All checks as rows; a run may be promoted when every row has ``passed``.

    ``business`` holds overall_summary, score_distribution, by_source, by_line and the bucket tables
    named in ``buckets``; ``monitoring`` holds score_drift, data_quality, feature_quality,
    feature_psi, feature_score_relationship, population_mix. Every table is aggregated once, by
    its groups, and one more aggregate over these gives all its checks.
    """
    none, n_channels = F.lit(0), len(source.channels)
    configured = F.when(F.col("channel").isin(*source.channels), F.col("channel"))

    # Account table beside the rows it was made from.
    named = [c for c in source.required if c in account.columns]
    columns = list(dict.fromkeys(["vintage_month", source.channel, *named]))
    sides = (account.select(F.lit(True).alias("_acc"), *columns)
             .unionByName(source_rows.select(F.lit(False).alias("_acc")), allowMissingColumns=True))
    own = F.col("_acc")
    rows = F.count_if(own)
    there = [F.max(F.when(own & (F.col(source.channel) == c), 1).otherwise(0)) for c in source.channels]
    null_shares = [ratio(F.count_if(own & F.col(c).isNull()), rows) for c in named]
    parts = [_checks(sides, {
        "account_rows_match_source": (F.abs(rows - F.count_if(~own)), 0, False),
        "vintage_month_missing": (F.when(rows > 0, F.count_if(own & F.col("vintage_month").isNull())), 0, False),
        "channels_absent": (F.when(rows > 0, F.lit(n_channels) - sum(there, none)), 0, False),
        "largest_null_share": (F.greatest(*null_shares), 0.05, True)})]
    per_key = account.groupBy(source.keys[0], "vintage_month").agg(F.count(F.lit(1)).alias("_n"))
    parts.append(_checks(per_key, {"duplicate_account_keys": (F.count_if(F.col("_n") > 1), 0, False)}))

    # Business tables against the account table, in one join by group.
    counted = account.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_n"), F.avg(source.score).alias("_avg"))
    matched = ("overall_summary", "by_source", "by_line")
    tagged = reduce(DataFrame.unionByName, [
        business[name].select(*GROUP, F.lit(name).alias("_table"), "account_count") for name in matched])
    totals = tagged.groupBy(*GROUP).agg(*[
        F.sum(F.when(F.col("_table") == name, F.col("account_count"))).alias(name) for name in matched])
    summary = business["overall_summary"].select(*GROUP, F.col(f"avg_{source.score}").alias("_l2"),
                                                 F.col("account_count").alias("_accounts"))
    both = (counted.join(totals, GROUP, "full_outer")
            .join(summary.select(*GROUP, "_l2", F.lit(1).alias("_listed")), GROUP, "left"))
    parts.append(_checks(both, {
        f"{name}_accounts_match": (F.max(F.abs(F.coalesce("_n", none) - F.coalesce(name, none))), 0, False)
        for name in matched} | {
        "summary_average_matches_accounts": (F.max(F.when(F.col("_n").isNotNull(), F.when(
            F.col("_listed").isNull(), float("inf")).otherwise(F.abs(F.col("_avg") - F.col("_l2"))))), 1e-4, True)}))
    per_group = business["score_distribution"].groupBy(*GROUP).agg(
        F.countDistinct(decile).alias("_bins"), F.count(F.lit(1)).alias("_rows"),
        F.sum("pct_of_channel_vintage_accounts").alias("_share"))
    parts.append(_checks(per_group, {
        "groups_without_all_deciles": (F.count_if(F.col("_bins") != n_bins), 0, False),
        "duplicate_decile_rows": (F.sum(F.col("_rows") - F.col("_bins")), 0, False),
        "decile_shares_sum_to_one": (F.max(F.abs(F.col("_share") - 1)), 1e-9, False)}))

    # Monitoring tables, each by group beside the business summary where they are compared.
    drift = monitoring["score_drift"].groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if((F.col("score_psi") < 0) | (F.col("score_ks") < 0)).alias("_low"),
        F.max("score_psi").alias("_psi"), F.max(f"mean_{source.score}").alias("_mean"))
    both = summary.withColumn("_listed", F.lit(1)).join(drift, GROUP, "full_outer")
    found = F.col("_rows")
    parts.append(_checks(both, {
        "duplicate_drift_rows": (_if_any(found, F.count_if(found > 1)), 0, False),
        "negative_psi_or_ks": (_if_any(found, F.sum("_low")), 0, False),
        "largest_score_psi": (F.max("_psi"), 0.25, True),
        "drift_mean_matches_summary": (F.max(F.when(F.col("_listed") == 1, F.when(
            found.isNull(), float("inf")).otherwise(F.abs(F.col("_mean") - F.col("_l2"))))), 1e-3, True)}))

    def outside(*columns: str) -> Column:
        return F.count_if(reduce(lambda a, b: a | b, [~F.col(c).between(0.0, 1.0) for c in columns]))

    quality = monitoring["data_quality"].groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("_rows"), F.max("missing_score_rate").alias("_missing"),
        outside("missing_score_rate", "outlier_score_rate").alias("_outside"))
    parts.append(_checks(quality, {
        "largest_missing_score_rate": (F.max("_missing"), 0.01, True),
        "data_quality_rates_out_of_bounds": (F.sum("_outside"), 0, False),
        "duplicate_data_quality_rows": (F.count_if(F.col("_rows") > 1), 0, False)}))
    per_feature = {"feature_psi": len(source.features), "feature_quality": len(source.features),
                   "feature_score_relationship": len(numeric_columns(account, source.features))}
    listed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        monitoring[name].select(*GROUP, F.lit(name).alias("_table"),
                                *(["missing_rate", "outlier_rate"] if name == "feature_quality" else []))
        for name in per_feature])
    listed = listed.groupBy(*GROUP, "_table").agg(F.count(F.lit(1)).alias("_rows"),
                                                  outside("missing_rate", "outlier_rate").alias("_outside"))
    of_quality = F.when(F.col("_table") == "feature_quality", F.col("_outside"))
    parts.append(_checks(listed, {"feature_quality_rates_out_of_bounds": (F.sum(of_quality), 0, False)} | {
        f"{name}_groups_incomplete": (_if_any(F.when(F.col("_table") == name, 1), F.count_if(
            (F.col("_table") == name) & (F.col("_rows") != n))), 0, False) for name, n in per_feature.items()}))
    shares = monitoring["population_mix"].groupBy(*GROUP, "segment_type").agg(
        F.sum("pct_of_channel_accounts").alias("_share"), F.sum("account_count").alias("_n"))
    both = summary.withColumn("_listed", F.lit(1)).join(shares, GROUP, "full_outer")
    kinds = [F.max(F.when(F.col("segment_type") == kind, 1).otherwise(0)) for kind in segments]
    parts.append(_checks(both, {
        "mix_shares_sum_to_one": (F.max(F.abs(F.col("_share") - 1)), 1e-9, False),
        "mix_accounts_match_summary": (F.max(F.when(F.col("_listed") == 1, F.when(
            F.col("segment_type").isNull(), float("inf")).otherwise(F.abs(F.col("_n") - F.col("_accounts"))))), 0, False),
        "segment_types_absent": (_if_any(F.col("segment_type"), F.lit(len(kinds)) - sum(kinds, none)), 0, False)}))

    # Which tables hold which configured channels: one pass over all, each reduced to a row.
    kept = {**{n: business[n] for n in [*matched, "score_distribution", *buckets] if n in business},
            **{n: monitoring[n] for n in ("score_drift", "data_quality", "population_mix", *per_feature)}}
    channels = reduce(DataFrame.unionByName, [
        table.select(F.lit(name).alias("_table"), configured.alias("channel")) for name, table in kept.items()])
    spine = account.sparkSession.createDataFrame(
        [(n, n in monitoring and n not in (*matched, "score_distribution", *buckets), n in buckets)
         for n in dict.fromkeys([*kept, *buckets])], "_table string, _monitors boolean, _bucket boolean")
    tables = spine.join(channels.groupBy("_table").agg(
        F.count(F.lit(1)).alias("_rows"), F.countDistinct("channel").alias("_channels")), "_table", "left")
    absent = F.lit(n_channels) - F.coalesce("_channels", none)
    parts.append(_checks(tables, {
        "business_channels_absent": (F.max(F.when(~F.col("_monitors"), absent)), 0, False),
        "monitoring_channels_absent": (F.max(F.when(F.col("_monitors"), absent)), 0, False),
        "bucket_tables_empty": (F.count_if(F.col("_bucket") & (F.coalesce("_rows", none) == 0)), 0, False)}))
    return reduce(DataFrame.unionByName, parts)
