"""Comparing distributions: binned counts of two sides, and differences of running shares.

A reference (baseline) is usually compared with many samples (every month). Its
rows are never repeated per sample: both sides go through one grouped count, and
the per-group results, a few numbers per group, are then paired.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.functions.columns import floored_share, indicator, ratio
from scorewatch.plans import lookup
from scorewatch.plans.lookup import Sizing, attach, few_rows, many_values, measure
from scorewatch.plans.ranking import with_bucket
from scorewatch.plans.running import running_totals
from scorewatch.plans.staging import stage

#: Buckets of a value between whose ends a KS is searched; more of them leave fewer open.
KS_BUCKETS = 4096


def tag_sides(reference: DataFrame, sample: DataFrame, extra_keys: Sequence[str]) -> DataFrame:
    """Both sides in one table; ``is_ref`` tells them apart, extra keys are null on the reference."""
    nulls = {k: F.lit(None).cast(sample.schema[k].dataType) for k in extra_keys}
    left = reference.withColumns({"is_ref": F.lit(True), **nulls})
    return left.unionByName(sample.withColumn("is_ref", F.lit(False)))


def paired_histograms(sides: DataFrame, ref_keys: Sequence[str], extra_keys: Sequence[str],
                      bin_col: str, n_bins: int, value: str | None = None,
                      weight: str | None = None, pivot: str | None = None) -> DataFrame:
    """Per sample group: both sides' row counts, counts per 0-based bin and value moments.

    ``sides`` are tagged rows with their bin. Gives ``ref_keys, extra_keys, ref_n,
    ref_counts, n, counts`` and, with a value column, ``mean, std, low, high`` of
    both sides (``ref_`` for the reference). Rows whose bin is null count in ``n``
    only. ``weight`` names a column that says how many rows each row stands for; moments are
    then taken around ``pivot``, a value of the group near its middle.
    """
    measures = bin_measures(bin_col, n_bins, value, weight, pivot)
    grouped = (sides.groupBy(*ref_keys, *extra_keys, "is_ref")
               .agg(*[column.alias(name) for name, column in measures.items()]))
    group = Window.partitionBy(*ref_keys)
    for name in measures:
        grouped = grouped.withColumn(
            f"ref_{name}", F.first(F.when(F.col("is_ref"), F.col(name)), ignorenulls=True).over(group))
    return (grouped.filter(~F.col("is_ref")).drop("is_ref")
            .withColumn("ref_n", F.coalesce("ref_n", F.lit(0).cast("long"))))


def bin_measures(bin_col: str, n_bins: int, value: str | None = None, weight: str | None = None,
                 pivot: str | None = None) -> dict[str, Column]:
    """Aggregates of one side: ``n``, ``counts`` per bin and, with a value, its moments and bounds."""
    times = F.col(weight) if weight else F.lit(1)
    counts = F.array(*[F.sum(F.when(F.col(bin_col) == i, times).otherwise(0)) for i in range(n_bins)])
    measures = {"n": F.sum(times), "counts": counts}
    if value:
        measures |= {"mean": F.avg(value), "std": F.stddev(value),
                     "low": F.min(value), "high": F.max(value)}
    if value and weight:
        centre = F.coalesce(F.col(pivot).cast("double"), F.lit(0.0))
        off, n = F.col(value).cast("double") - centre, F.sum(times)
        total, squares = F.sum(off * times), F.sum(off * off * times)
        spread = F.greatest(squares - F.try_divide(total * total, n), F.lit(0.0))
        # One row has no deviation, as in the unweighted case.
        measures |= {"mean": F.max(centre) + F.try_divide(total, n),
                     "std": F.when(n > 1, F.sqrt(F.try_divide(spread, n - 1)))}
    return measures


def reference_counts(upto: Column, n: Column) -> Column:
    """Rows per quantile bin from the counts up to each edge and the group's size."""
    ends = F.concat(upto, F.array(n))
    return F.transform(ends, lambda end, i: end - F.when(i > 0, F.get(ends, i - 1)).otherwise(0))


def psi(ref_counts: Column, ref_n: Column, counts: Column, n: Column) -> Column:
    """Population stability index over bins seen on either side; 0.0 with an empty side."""
    def term(expected: Column, actual: Column) -> Column:
        before, after = floored_share(expected, ref_n), floored_share(actual, n)
        return F.when(expected + actual > 0,
                      (after - before) * F.log(F.greatest(after / before, F.lit(1e-10)))).otherwise(0.0)

    total = F.aggregate(F.zip_with(ref_counts, counts, term), F.lit(0.0), lambda a, t: a + t)
    return F.when((ref_n > 0) & (n > 0), F.coalesce(total, F.lit(0.0))).otherwise(0.0)


def ks_to_reference(reference: DataFrame, sample: DataFrame, ref_keys: Sequence[str],
                    extra_keys: Sequence[str], value: str,
                    sample_sizing: Sizing | None = None) -> DataFrame:
    """Two-sample KS of every sample group against its reference: ``ref_keys, extra_keys, ks``.

    Rows are first counted per distinct value; running counts come from a hierarchy of cells, so
    no task walks a whole large group. At each sample value both its right and left limits are
    compared; between sample values the difference cannot be larger.

    Where values are many, rows are counted by buckets of the value first. The shares at the ends of a bucket bound the
    difference inside it; only buckets that may hold more than what is found at the ends are gone through by value.
    """
    keys, extra = list(ref_keys), list(extra_keys)
    reference = reference.select(*keys, value).filter(F.col(value).isNotNull())
    sample = sample.select(*keys, *extra, value).filter(F.col(value).isNotNull())
    sides = tag_sides(reference, sample, extra)
    sizing = measure(sides, keys)
    own_most = sample_sizing.largest if sample_sizing else sizing.largest
    many = 4 * lookup.CELL_ROWS
    if sizing.rows > many and many_values(sides, [*keys, *extra, "is_ref", value], many):
        return _bounded_ks(sides, keys, extra, value, sizing, own_most)
    counted = sides.groupBy(*keys, *extra, "is_ref", value).agg(F.count(F.lit(1)).alias("_n"))
    placed = _both_running(counted, keys, extra, value, sizing.largest, own_most)
    return placed.groupBy(*keys, *extra).agg(F.coalesce(F.max(_Shares().widest), F.lit(0.0)).alias("ks"))


class _Shares:
    """Both sides' shares just below a value (or bucket) and up to it; starts are the rows before a bucket."""

    def __init__(self, ref_start: Column | int = 0, own_start: Column | int = 0, ref_all: str = "ref_all",
                 own_all: str = "own_all") -> None:
        ref, own = F.col("ref_upto") + ref_start, F.col("own_upto") + own_start
        self.ref_high, self.own_high = ratio(ref, F.col(ref_all)), ratio(own, F.col(own_all))
        self.ref_low = ratio(ref - F.col("ref_here"), F.col(ref_all))
        self.own_low = ratio(own - F.col("own_here"), F.col(own_all))
        self.widest = F.greatest(F.abs(self.ref_high - self.own_high), F.abs(self.ref_low - self.own_low))


def _both_running(counted: DataFrame, keys: list[str], extra: list[str], value: str, most: int,
                  own_most: int) -> DataFrame:
    """Running counts of the reference and of each sample at the values of the samples."""
    both = running_totals(counted, keys, value, {"ref": F.when(F.col("is_ref"), F.col("_n")).otherwise(0)},
                          most).filter(~F.col("is_ref"))
    return running_totals(both, [*keys, *extra], value, {"own": F.col("_n")}, own_most)


def _bounded_ks(sides: DataFrame, keys: list[str], extra: list[str], value: str, sizing: Sizing,
                own_most: int) -> DataFrame:
    group, sides = [*keys, *extra], with_bucket(sides, value, sizing.rows, KS_BUCKETS)
    counted = stage(sides.groupBy(*group, "is_ref", "_bucket").agg(F.count(F.lit(1)).alias("_n")), "ks_buckets")
    ends, shares = _both_running(counted, keys, extra, "_bucket", measure(counted, keys).largest, KS_BUCKETS), _Shares()
    known = F.max(shares.widest).over(Window.partitionBy(*group))
    at_most = F.greatest(shares.ref_high - shares.own_low, shares.own_high - shares.ref_low)
    ends = stage(ends.select(
        *group, "_bucket", known.alias("_known"), at_most.alias("_bound"),
        (F.col("ref_upto") - F.col("ref_here")).alias("_ref_start"), F.col("ref_all").alias("_ref"),
        (F.col("own_upto") - F.col("own_here")).alias("_own_start"), F.col("own_all").alias("_own")), "ks_ends")
    still = ends.filter(F.col("_bound") > F.col("_known"))
    fits, place = few_rows(still), [*keys, "_bucket"]
    asked = attach(sides.filter(~F.col("is_ref")), still.select(*group, "_bucket"), [*group, "_bucket"], fits,
                   how="left_semi", null_safe=True, spread=[value])
    asked = asked.unionByName(attach(sides.filter("is_ref"), still.select(*place).distinct(), place, fits,
                                     how="left_semi", null_safe=True, spread=[value]))
    by_value = asked.groupBy(*group, "is_ref", "_bucket", value).agg(F.count(F.lit(1)).alias("_n"))
    placed = _both_running(by_value, place, extra, value, sizing.largest, own_most)
    placed = attach(placed, still, [*group, "_bucket"], fits, null_safe=True, spread=[value])
    inside = _Shares(F.col("_ref_start"), F.col("_own_start"), "_ref", "_own")
    found = ends.select(*group, F.col("_known").alias("_ks")).unionByName(
        placed.select(*group, inside.widest.alias("_ks")))
    return found.groupBy(*group).agg(F.coalesce(F.max("_ks"), F.lit(0.0)).alias("ks"))


def separation(rows: DataFrame, keys: Sequence[str], score: str, bad: str) -> DataFrame:
    """How well a score parts goods (``bad = 0``) from bads (``bad = 1``), per group.

    Gives ``keys, account_count, bad_count, ks, gini``. Counts cover all rows; KS
    and Gini those with a score and an outcome. Gini uses mid-ranks for equal
    scores and is null under 10 rows or with one class missing. Ranks are running
    counts from the same hierarchy of cells as KS.
    """
    keys = list(keys)
    rows = rows.select(*keys, F.col(score).alias("_score"), F.col(bad).alias("_bad"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("account_count"),
                                     F.count_if(F.col("_bad") == 1).alias("bad_count"))
    usable = rows.filter(F.col("_score").isNotNull() & F.col("_bad").isin(0, 1))
    by_value = usable.groupBy(*keys, "_score").agg(F.count_if(F.col("_bad") == 0).alias("_g"),
                                                   F.count_if(F.col("_bad") == 1).alias("_b"))
    placed = running_totals(by_value, keys, "_score", {"goods": F.col("_g"), "bads": F.col("_b")},
                            measure(usable, keys).largest)
    gap = ratio(F.col("goods_upto"), F.col("goods_all")) - ratio(F.col("bads_upto"), F.col("bads_all"))
    same = F.col("_g") + F.col("_b")
    mid_rank = F.col("goods_upto") + F.col("bads_upto") - same + (same + 1) / 2
    stats = placed.groupBy(*keys, "goods_all", "bads_all").agg(
        F.max(F.abs(gap)).alias("_ks"), F.sum(F.col("_b") * mid_rank).alias("_ranks"))
    bads, goods = F.col("bads_all").cast("double"), F.col("goods_all").cast("double")
    area = F.try_divide(F.col("_ranks") - bads * (bads + 1) / 2, bads * goods)
    stats = stats.select(*keys, F.col("_ks"),
                         F.when(bads + goods >= 10, F.round(2 * area - 1, 6)).alias("gini"))
    return (counts.join(stats, keys, "left")
            .select(*keys, "account_count", "bad_count",
                    F.coalesce("_ks", F.lit(0.0)).alias("ks"), "gini"))
