"""Composition of the population and what its changes contribute to an outcome's change."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.functions.columns import or_zero, ratio_or_zero, shift_month_col
from scorewatch.plans.distribution import paired_histograms, tag_sides
from scorewatch.spec import Attribution, Segment, Source

UNKNOWN = "Unknown"
SHIFT_MATERIAL = 0.02
CONTRIBUTION_MATERIAL = 0.001


def population_mix(current: DataFrame, source: Source, segments: Sequence[Segment]) -> DataFrame:
    """Accounts and share of the channel per month, channel, segment type and value."""
    columns = [F.struct(F.lit(s.segment_type).alias("segment_type"),
                        F.coalesce(F.col(s.column).cast("string"), F.lit(UNKNOWN))
                        .alias("segment_value")) for s in segments]
    long = (current.filter(F.col(source.channel).isin(*source.channels))
            .select("vintage_month", F.col(source.channel).alias("channel"),
                    F.explode(F.array(*columns)).alias("_segment"))
            .select("vintage_month", "channel", "_segment.*"))
    counts = (long.groupBy("vintage_month", "channel", "segment_type", "segment_value")
              .agg(F.count(F.lit(1)).alias("account_count")))
    total = F.sum("account_count").over(Window.partitionBy("vintage_month", "channel",
                                                           "segment_type"))
    return counts.withColumn("pct_of_channel_accounts",
                             ratio_or_zero(F.col("account_count"), total))


def mix_shift(reference: DataFrame, sample: DataFrame, ref_keys: Sequence[str],
              extra_keys: Sequence[str], decile: str, n_bins: int = 10) -> DataFrame:
    """Share of each static decile in baseline and current; bins seen on neither side are absent.

    Shares are of all rows, those without a decile included.
    """
    sides = tag_sides(reference.select(*ref_keys, decile),
                      sample.select(*ref_keys, *extra_keys, decile), extra_keys)
    pairs = paired_histograms(sides.withColumn("_bin", F.col(decile) - 1), ref_keys, extra_keys,
                              "_bin", n_bins)
    rows = (pairs.withColumn("score_bin", F.explode(F.sequence(F.lit(1), F.lit(n_bins))))
            .withColumn("_then", F.coalesce(F.get("ref_counts", F.col("score_bin") - 1), F.lit(0)))
            .withColumn("_now", F.get("counts", F.col("score_bin") - 1))
            .filter(F.col("_then") + F.col("_now") > 0))
    rows = (rows.withColumn("baseline_pct", ratio_or_zero(F.col("_then"), F.col("ref_n")))
            .withColumn("current_pct", ratio_or_zero(F.col("_now"), F.col("n")))
            .withColumn("shift", F.col("current_pct") - F.col("baseline_pct")))
    return rows.select(*ref_keys, *extra_keys, "score_bin", "baseline_pct", "current_pct", "shift")


def mix_shift_summary(shifts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return shifts.groupBy(*keys).agg(
        F.count_if(F.col("shift") > SHIFT_MATERIAL).alias("bins_grown"),
        F.count_if(F.col("shift") < -SHIFT_MATERIAL).alias("bins_shrunk"))


def attribution(cohorts: DataFrame, spec: Attribution, scorecard: str | None = None) -> DataFrame:
    """Drivers of an outcome rate's change from the previous reporting month.

    ``cohorts`` carries ``reporting_month``, an outcome ``edr`` and the driver
    columns. Each month is aggregated once per driver value and compared with the
    month before by shifting the aggregate, not the rows. Gives the largest
    drivers of every month whose change is material.
    """
    keys = ["reporting_month", *([scorecard] if scorecard else [])]
    drivers = [d for d in spec.drivers if d in cohorts.columns]
    narrow = cohorts.select(*keys, "edr", *[F.col(d).cast("string").alias(f"_by_{d}")
                                            for d in drivers])
    entries = [F.struct(F.lit(d).alias("dimension"), F.col(f"_by_{d}").alias("segment"))
               for d in drivers]
    whole = F.struct(F.lit("").alias("dimension"), F.lit("").alias("segment"))
    sums = (narrow.select(*keys, "edr", F.explode(F.array(whole, *entries)).alias("_e"))
            .select(*keys, "edr", "_e.*").filter(F.col("segment").isNotNull())
            .groupBy(*keys, "dimension", "segment")
            .agg(F.count(F.lit(1)).alias("_n"), F.avg("edr").alias("_rate")))
    shifted = sums.withColumn("reporting_month", shift_month_col(F.col("reporting_month"), 1))
    both = (sums.withColumn("_now", F.lit(True))
            .unionByName(shifted.withColumn("_now", F.lit(False))))
    now, before = F.col("_now"), ~F.col("_now")
    group = [*keys, "dimension", "segment"]
    pairs = both.groupBy(*group).agg(
        F.coalesce(F.max(F.when(now, F.col("_n"))), F.lit(0)).alias("n1"),
        F.coalesce(F.max(F.when(before, F.col("_n"))), F.lit(0)).alias("n0"),
        F.max(F.when(now, F.col("_rate"))).alias("r1"),
        F.max(F.when(before, F.col("_rate"))).alias("r0"))
    month = Window.partitionBy(*keys)
    whole_delta = F.max(F.when(F.col("dimension") == "", F.col("r1") - F.col("r0"))).over(month)
    dimension = Window.partitionBy(*keys, "dimension")
    r0, r1 = or_zero(F.col("r0")), or_zero(F.col("r1"))
    rows = (pairs.withColumn("delta", whole_delta)
            .filter((F.abs("delta") >= spec.min_materiality) & (F.col("dimension") != ""))
            .withColumn("_w1", ratio_or_zero(F.col("n1"), F.sum("n1").over(dimension)))
            .withColumn("_w0", ratio_or_zero(F.col("n0"), F.sum("n0").over(dimension)))
            .withColumn("mix_effect", (F.col("_w1") - F.col("_w0")) * r0)
            .withColumn("rate_effect", (r1 - r0) * F.col("_w1"))
            .withColumn("_whole", F.col("mix_effect") + F.col("rate_effect"))
            .filter(F.abs("_whole") >= CONTRIBUTION_MATERIAL)
            .withColumn("contribution", F.round("_whole", 6)))
    best = Window.partitionBy(*keys).orderBy(F.abs("contribution").desc(), "dimension", "segment")
    return (rows.withColumn("driver_rank", F.row_number().over(best))
            .filter(F.col("driver_rank") <= spec.max_drivers)
            .select(*keys, "driver_rank", "dimension", "segment", "delta", "contribution",
                    "mix_effect", "rate_effect",
                    F.when(F.col("_whole") > 0, "up").otherwise("down").alias("direction")))


def attribution_overview(cohorts: DataFrame, spec: Attribution,
                         scorecard: str | None = None) -> DataFrame:
    """Outcome rate of each reporting month and the month before, and whether it moved."""
    keys = ["reporting_month", *([scorecard] if scorecard else [])]
    rates = cohorts.groupBy(*keys).agg(F.avg("edr").alias("rate"))
    prior = rates.select(shift_month_col(F.col("reporting_month"), 1).alias("reporting_month"),
                         *keys[1:], F.col("rate").alias("prior_rate"))
    joined = rates.join(prior, keys).withColumn("delta", F.col("rate") - F.col("prior_rate"))
    return joined.withColumn("is_material", F.abs("delta") >= spec.min_materiality)
