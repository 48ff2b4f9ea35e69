"""Drift of score and features against a baseline, for all months and channels at once."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.functions.columns import (edges_reached, floored_share, interval_index,
                                          interval_label, melt, or_zero)
from scorewatch.operators.binning import bin_fractions
from scorewatch.plans.distribution import ks_to_reference, paired_histograms, psi, tag_sides
from scorewatch.plans.lookup import Sizing, attach, measure
from scorewatch.plans.ranking import attach_quantile_bin, quantiles
from scorewatch.plans.spine import expected_groups
from scorewatch.spec import DriftSpec, Source, as_fraction


def population_shift(reference: DataFrame, sample: DataFrame, ref_keys: Sequence[str],
                     extra_keys: Sequence[str], value: str, n_bins: int,
                     accuracy: int | None = None, sizing: Sizing | None = None,
                     weight: str | None = None) -> DataFrame:
    """Stability index by reference quantile bins, with both sides' means and deviations.

    ``weight`` names a column that says how many accounts each row stands for.
    One row per sample group: ``ref_keys, extra_keys, psi, baseline_mean,
    current_mean, baseline_std, current_std, baseline_count, current_count``.
    """
    reference = reference.filter(F.col(value).isNotNull())
    sample = sample.filter(F.col(value).isNotNull())
    sizing = sizing or measure(reference, ref_keys)
    edges = quantiles(reference, ref_keys, value, bin_fractions(n_bins), accuracy=accuracy,
                      sizing=sizing, weight=weight)
    taken = [value, *([weight] if weight else [])]
    sides = tag_sides(reference.select(*ref_keys, *taken),
                      sample.select(*ref_keys, *extra_keys, *taken), extra_keys)
    binned = attach_quantile_bin(sides, edges, ref_keys, value, n_bins,
                                 sizing.broadcast_fits(8 * n_bins + 256), "bin", "middle")
    pairs = paired_histograms(binned, ref_keys, extra_keys, "bin", n_bins, value, weight, "middle")
    index = psi(F.col("ref_counts"), F.col("ref_n"), F.col("counts"), F.col("n"))
    return pairs.select(*ref_keys, *extra_keys, index.alias("psi"),
                        F.col("ref_mean").alias("baseline_mean"), F.col("mean").alias("current_mean"),
                        F.col("ref_std").alias("baseline_std"), F.col("std").alias("current_std"),
                        F.col("ref_n").alias("baseline_count"), F.col("n").alias("current_count"))


def _percent(name: str, share: float) -> str:
    return f"{name}{int(as_fraction(share) * 100)}"


def _configured(df: DataFrame, source: Source, columns: Sequence[str]) -> DataFrame:
    return (df.filter(F.col(source.channel).isin(*source.channels))
            .withColumn("channel", F.col(source.channel)).select("channel", *columns))


def score_drift(current: DataFrame, baseline: DataFrame, source: Source, spec: DriftSpec) -> DataFrame:
    """One row per month and configured channel; a channel without rows gets zeros."""
    score = source.score
    now = (_configured(current, source, ["vintage_month", score])
           .filter(F.col(score).isNotNull()))
    then = _configured(baseline, source, [score]).filter(F.col(score).isNotNull())
    group = ["vintage_month", "channel"]

    now_sizing, then_sizing = measure(now, group), measure(then, ["channel"])

    shift = population_shift(then, now, ["channel"], ["vintage_month"], score, spec.n_bins,
                             sizing=then_sizing)
    ks = ks_to_reference(then, now, ["channel"], ["vintage_month"], score, now_sizing)

    tops = [1 - as_fraction(p) for p in spec.top_shares]
    own = [as_fraction(q) for q in spec.quantiles]
    own_edges = quantiles(now, group, score, own + tops, sizing=now_sizing)
    tails = quantiles(then, ["channel"], score, spec.tail_quantiles, sizing=then_sizing)
    rows = attach(now, own_edges.select(*group, F.col("edges").alias("_own")), group,
                  now_sizing.broadcast_fits(512), spread=[score])
    rows = attach(rows, tails.select("channel", F.col("edges").alias("_tails")), ["channel"],
                  then_sizing.broadcast_fits(512), how="left", spread=[score])
    value = F.col(score)
    cuts = [F.max(F.get("_own", F.lit(i))).alias(_percent("q", q) + "_score")
            for i, q in enumerate(spec.quantiles)]
    means = [F.avg(F.when(value >= F.get("_own", F.lit(len(own) + i)), value))
             .alias(_percent("mean_top", p) + "pct_score") for i, p in enumerate(spec.top_shares)]
    above = [F.avg(F.when(value > or_zero(F.get("_tails", F.lit(i))), 1.0).otherwise(0.0))
             .alias(_percent("pct_accounts_above_p", q) + "_baseline")
             for i, q in enumerate(spec.tail_quantiles)]
    levels = rows.groupBy(*group).agg(*cuts, *means, *above)

    spine = expected_groups(current, ["vintage_month"], channel=source.channels)
    joined = reduce(lambda left, right: left.join(right, group, "left"), [
        spine,
        shift.select(*group, F.col("current_mean").alias(f"mean_{score}"),
                     F.col("current_std").alias(f"std_{score}"), F.col("psi").alias("score_psi")),
        ks.select(*group, F.col("ks").alias("score_ks")),
        levels])
    return joined.select(*group, *[or_zero(F.col(c)).alias(c) for c in joined.columns
                                   if c not in group])


def feature_psi(current: DataFrame, baseline: DataFrame, source: Source, spec: DriftSpec,
                features: Sequence[str] | None = None) -> DataFrame:
    """One row per month, configured channel and feature."""
    features = list(features or source.features)
    now = melt(_configured(current, source, ["vintage_month", *features]),
               ["vintage_month", "channel"], features, "feature_name", "value")
    then = melt(_configured(baseline, source, features), ["channel"], features,
                "feature_name", "value")
    shift = population_shift(then, now, ["channel", "feature_name"], ["vintage_month"], "value",
                             spec.n_bins)
    base = then.groupBy("channel", "feature_name").agg(F.avg("value").alias("_mean"),
                                                       F.stddev("value").alias("_std"))
    spine = expected_groups(current, ["vintage_month"], channel=source.channels,
                            feature_name=features)
    keys = ["vintage_month", "channel", "feature_name"]
    joined = spine.join(shift, keys, "left").join(base, ["channel", "feature_name"], "left")
    return joined.select(*keys, or_zero(F.col("psi")).alias("psi"),
                         or_zero(F.col("_mean")).alias("baseline_mean"),
                         or_zero(F.col("current_mean")).alias("current_mean"),
                         or_zero(F.col("_std")).alias("baseline_std"),
                         or_zero(F.col("current_std")).alias("current_std"))


def _bin_rows(pairs: DataFrame, n_bins: Column) -> DataFrame:
    """One row per bin from paired histograms, with floored shares of both sides."""
    listed = (pairs.filter((F.col("ref_n") > 0) & (F.col("n") > 0))
              .withColumn("bin", F.explode(F.sequence(F.lit(0), n_bins - 1)))
              .withColumn("baseline_count", F.get("ref_counts", "bin"))
              .withColumn("compare_count", F.get("counts", "bin")))
    return (listed
            .withColumn("baseline_pct", floored_share(F.col("baseline_count"), F.col("ref_n")))
            .withColumn("compare_pct", floored_share(F.col("compare_count"), F.col("n")))
            .withColumn("difference", F.col("compare_pct") - F.col("baseline_pct"))
            .withColumn("woe", F.log(F.col("compare_pct") / F.col("baseline_pct"))))


def psi_table(reference: DataFrame, sample: DataFrame, ref_keys: Sequence[str],
              extra_keys: Sequence[str], score: str,
              intervals: Sequence[tuple[float, float]]) -> DataFrame:
    """Counts and shares per fixed score interval; empty intervals are listed too."""
    sides = tag_sides(reference.select(*ref_keys, score),
                      sample.select(*ref_keys, *extra_keys, score), extra_keys)
    binned = (sides.filter(F.col(score).isNotNull())
              .withColumn("bin", interval_index(F.col(score), intervals)))
    pairs = paired_histograms(binned, ref_keys, extra_keys, "bin", len(intervals))
    keys = [*ref_keys, *extra_keys]
    bounds = F.array(*[F.struct(F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"))
                       for low, high in intervals])
    rows = (_bin_rows(pairs, F.lit(len(intervals)))
            .withColumn("_bounds", F.get(bounds, F.col("bin"))))
    return rows.select(
        *keys, interval_label(F.col("_bounds.low"), F.col("_bounds.high"), 2).alias("interval"),
        F.col("_bounds.low").alias("min_score"), F.col("_bounds.high").alias("max_score"),
        "baseline_count", "compare_count", "baseline_pct", "compare_pct", "difference",
        (F.col("compare_pct") / F.col("baseline_pct")).alias("obs_to_baseline_ratio"),
        "woe", (F.col("difference") * F.col("woe")).alias("contribution"))


def csi_table(reference: DataFrame, sample: DataFrame, ref_keys: Sequence[str],
              extra_keys: Sequence[str], features: Sequence[str], n_bins: int = 10) -> DataFrame:
    """Counts and shares per feature bin: distinct baseline edges within the joint range."""
    keys = [*ref_keys, "feature"]
    then = (melt(reference, ref_keys, features, "feature", "value")
            .filter(F.col("value").isNotNull()))
    now = (melt(sample, [*ref_keys, *extra_keys], features, "feature", "value")
           .filter(F.col("value").isNotNull()))
    sizing = measure(then, keys)
    edges = (quantiles(then, keys, "value", bin_fractions(n_bins), sizing=sizing)
             .select(*keys, F.array_distinct("edges").alias("_edges")))
    fits = sizing.broadcast_fits(8 * n_bins + 256)
    binned = (attach(tag_sides(then, now, extra_keys), edges, keys, fits, spread=["value"])
              .withColumn("bin", edges_reached(F.col("value"), F.col("_edges"), n_bins - 1))
              .drop("_edges"))
    pairs = (paired_histograms(binned, keys, extra_keys, "bin", n_bins, "value")
             .join(edges, keys)
             .withColumn("_bounds", F.concat(F.array(F.least("ref_low", "low")), "_edges",
                                             F.array(F.greatest("ref_high", "high")))))
    rows = (_bin_rows(pairs, F.size("_edges") + 1)
            .withColumn("min_value", F.get("_bounds", "bin"))
            .withColumn("max_value", F.get("_bounds", F.col("bin") + 1)))
    return rows.select(
        *ref_keys, *extra_keys, "feature", F.col("bin").alias("bin_index"),
        interval_label(F.col("min_value"), F.col("max_value"), 4).alias("interval"),
        "min_value", "max_value", "baseline_count", "compare_count", "baseline_pct",
        "compare_pct", "difference", (F.col("difference") * F.col("woe")).alias("information_value"))


def table_totals(table: DataFrame, keys: Sequence[str], part: str, out: str) -> DataFrame:
    """Total of a bin table's contributions per group."""
    return table.groupBy(*keys).agg(F.sum(part).alias(out))


def drift_trend(drift: DataFrame, score: str) -> DataFrame:
    """Mean score and stability index per channel over the months, with monthly change."""
    along = Window.partitionBy("channel").orderBy("vintage_month")
    mean = F.col(f"mean_{score}")
    return (drift.select("channel", "vintage_month", mean.alias("mean_score"), "score_psi",
                         (mean - F.lag(mean).over(along)).alias("mean_change"),
                         (F.col("score_psi") - F.lag("score_psi").over(along)).alias("psi_change"))
            .orderBy("channel", "vintage_month"))
