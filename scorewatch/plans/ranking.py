"""Exact order statistics per group, also where one group is a large part of the table.

``ntile``, equal-frequency tiers and quantiles all ask the same question: which value stands at
rank r of its group? There is one way to answer it, whatever a group's size: rows are
counted by value, running sums over the counts (``plans/running.py``, where a long group is a
hierarchy of cells) show which value holds each wanted rank, and a handful of values per group is
looked up by the rows. A value shared by very many rows is one counted row.

Where there are many different values, rows are first counted by coarse buckets of the value. The counts show which
bucket holds each wanted rank, and only the rows of those buckets are counted by value and sorted. Bucket counts
of disjoint cells add up, so groups that are unions of cells (months of a window, channels of
a scope) get their ranks without a row being repeated for each group it belongs to.

Bins must also part rows of equal value. A cut that falls inside such a run is settled by the
same counting among the rows of that run only: by the tie column, then by a hash of the row, and
where rows agree in everything by their place in a written copy of the run. Values keep their
own type throughout; nulls come first, NaN last.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.functions.columns import edges_below
from scorewatch.plans import lookup
from scorewatch.plans.lookup import Sizing, attach, few_rows, many_values, measure, size_up
from scorewatch.plans.running import running_totals
from scorewatch.plans.staging import stage
from scorewatch.spec import as_fraction

#: Coarse buckets of a value, and values drawn for each; they decide how work is spread, never a result.
BUCKETS, DRAWN = 256, 16


@dataclass(frozen=True)
class Unions:
    """Groups made of disjoint cells of rows: ``table`` lists the groups of every cell."""

    cells: Sequence[str]
    table: DataFrame

    def expand(self, rows: DataFrame) -> DataFrame:
        """Rows once for every group of their cell."""
        return attach(rows, self.table, self.cells, few_rows(self.table), null_safe=True)

    def expand_groups(self, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Rows of groups once for every cell that counts in the group."""
        return attach(groups, self.table, keys, few_rows(self.table), null_safe=True)

    def measure(self, rows: DataFrame, keys: Sequence[str]) -> Sizing:
        """Size of the groups; ``rows`` are counted once each, not once for every group."""
        sizes = rows.groupBy(*self.cells).agg(F.count(F.lit(1)).alias("_size"))
        sizes = stage(sizes, "cell_sizes")
        found = size_up(self.expand(sizes).groupBy(*keys).agg(F.sum("_size").alias("size")))
        return replace(found, rows=sizes.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0])


def lookup_bytes(n_ranks: int) -> int:
    """Bytes per group of a lookup with one entry per wanted rank."""
    return 256 * (n_ranks + 1)


def at_ranks(rows: DataFrame, keys: Sequence[str], value: str,
             wanted: Callable[[Column], Column] | DataFrame, sizing: Sizing,
             weight: str | None = None, unions: Unions | None = None) -> DataFrame:
    """The value at each wanted rank of every group; null is a value like others.

    ``weight`` names a column that says how many rows each row stands for. ``unions`` tells which
    groups each cell of the rows counts in, where they overlap.

    ``wanted`` gives an array of ``pos, rank`` (ranks from 1) from the group size, or is a table
    of such arrays by group. Gives ``keys, group_n, pos, rank, <value>, n_below, n_upto``, where
    ``n_below`` and ``n_upto`` count the rows below and up to the value.
    """
    keys = list(keys)
    many = sizing.rows > lookup.CELL_ROWS or unions and sizing.groups * sizing.largest > 8 * lookup.CELL_ROWS
    if many and not isinstance(wanted, DataFrame) and (
            unions or many_values(rows, [*keys, value], lookup.CELL_ROWS)):
        return _narrowed(rows, keys, value, wanted, sizing, weight, unions)
    rows = unions.expand(rows) if unions else rows
    return _sorted_ranks(rows, keys, value, wanted, sizing, weight)


def _sorted_ranks(rows: DataFrame, keys: list[str], value: str, wanted: Callable[[Column], Column] | DataFrame,
                  sizing: Sizing, weight: str | None) -> DataFrame:
    counted = rows.groupBy(*keys, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    placed = running_totals(counted, keys, value, {"n": F.col("_n")}, sizing.largest)
    if isinstance(wanted, DataFrame):
        placed = attach(placed, wanted, keys, sizing.broadcast_fits(lookup_bytes(1)), null_safe=True,
                        spread=[value])
    else:
        placed = placed.withColumn("_wanted", wanted(F.col("n_all")))
    below = F.col("n_upto") - F.col("_n")
    hit = F.filter("_wanted", lambda w: (w["rank"] > below) & (w["rank"] <= F.col("n_upto")))
    return (placed.withColumn("_hit", F.explode(hit))
            .select(*keys, F.col("n_all").alias("group_n"), "_hit.pos", "_hit.rank", value,
                    below.alias("n_below"), "n_upto"))


def _narrowed(rows: DataFrame, keys: list[str], value: str, wanted: Callable[[Column], Column], sizing: Sizing,
              weight: str | None, unions: Unions | None) -> DataFrame:
    """``at_ranks`` by coarse buckets first: only buckets that hold a wanted rank are sorted."""
    cells = list(unions.cells) if unions else keys
    rows = rows.select(*cells, value, (F.col(weight) if weight else F.lit(1).cast("long")).alias("_rows"))
    rows = with_bucket(rows, value, sizing.rows)
    counted = rows.groupBy(*cells, "_bucket").agg(F.sum("_rows").alias("_rows"))
    coarse = stage(_sorted_ranks(unions.expand(counted) if unions else counted, keys, "_bucket", wanted,
                                 Sizing(sizing.groups, 0), "_rows"), "coarse_ranks")
    held = coarse.groupBy(*keys, "_bucket").agg(
        F.collect_list(F.struct("pos", (F.col("rank") - F.col("n_below")).alias("rank"))).alias("_wanted"))
    buckets = Sizing(*coarse.agg(F.count(F.lit(1)), F.coalesce(F.max(F.col("n_upto") - F.col("n_below")),
                                                               F.lit(0))).first())
    if unions:
        links = stage(unions.expand_groups(held.select(*keys, "_bucket"), keys), "bucket_groups")
        inside = attach(rows, links, [*cells, "_bucket"], few_rows(links), null_safe=True, spread=[value])
    else:
        inside = attach(rows, held.select(*keys, "_bucket"), [*keys, "_bucket"],
                        buckets.broadcast_fits(lookup_bytes(1)), how="left_semi", null_safe=True, spread=[value])
    fine = _sorted_ranks(inside, [*keys, "_bucket"], value, held, buckets, "_rows")
    starts = coarse.select(*keys, "pos", F.col("group_n").alias("_group"), F.col("n_below").alias("_start"))
    placed = attach(fine.drop("group_n"), starts, [*keys, "pos"], buckets.broadcast_fits(lookup_bytes(1)),
                    null_safe=True, spread=[value])
    return placed.select(*keys, F.col("_group").alias("group_n"), "pos", (F.col("rank") + F.col("_start")).alias("rank"),
                         value, *[(F.col(c) + F.col("_start")).alias(c) for c in ("n_below", "n_upto")])


def with_bucket(rows: DataFrame, value: str, n_rows: int, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``_bucket``, the number of borders below the value; the borders are drawn from the rows.

    Nulls are in the first bucket, NaN in the last.
    """
    drawn = (rows.filter(F.rand(17) < min(1.0, DRAWN * buckets / max(1, n_rows)))
             .agg(F.array_sort(F.collect_list(value)).alias("_drawn")))
    every = F.filter("_drawn", lambda v, i: (i + 1) % DRAWN == 0)
    # One row by construction: a global aggregate. Written, so that all scans see the same borders.
    borders = stage(drawn.select(F.array_distinct(every).alias("_borders")), "borders")
    rows = rows.crossJoin(F.broadcast(borders)).withColumn("_bucket", F.lit(0))
    step = 1 << buckets.bit_length()
    while step:  # binary search, a projection a step
        probe = F.get("_borders", F.col("_bucket") + F.lit(step - 1))
        rows = rows.withColumn("_bucket", F.col("_bucket") + F.when(F.col(value) > probe, step).otherwise(0))
        step //= 2
    return rows.drop("_borders")


def _listed(ranks: Callable[[Column], Sequence[Column]]) -> Callable[[Column], Column]:
    return lambda n: F.array(*[F.struct(F.lit(i + 1).alias("pos"), rank.cast("long").alias("rank"))
                               for i, rank in enumerate(ranks(n))])


def quantile_ranks(fractions: Sequence) -> Callable[[Column], list[Column]]:
    """Rank of each quantile: the smallest whose share of the group reaches the fraction."""
    exact = [as_fraction(f) for f in fractions]

    def ranks(n: Column) -> list[Column]:
        out = []
        for f in exact:
            numerator, denominator = F.lit(f.numerator), F.lit(f.denominator)
            scaled = n.cast("long") * numerator + denominator - 1
            out.append(F.greatest(F.lit(1).cast("long"),
                                  ((scaled - scaled % denominator) / denominator).cast("long")))
        return out

    return ranks


def ntile_ranks(n_bins: int) -> Callable[[Column], list[Column]]:
    """Last rank of bins 1..n-1 when the larger bins come first, as ``ntile`` has it."""
    def ranks(n: Column) -> list[Column]:
        left_over = n % n_bins
        base = ((n - left_over) / n_bins).cast("long")
        return [base * i + F.least(F.lit(i).cast("long"), left_over) for i in range(1, n_bins)]

    return ranks


def quantiles(rows: DataFrame, keys: Sequence[str], value: str, fractions: Sequence, *,
              accuracy: int | None = None, sizing: Sizing | None = None,
              weight: str | None = None, unions: Unions | None = None) -> DataFrame:
    """One row per group: ``keys, group_n, edges`` with the quantiles in the order asked.

    Exact quantiles come with ``upto``, the number of the group's rows up to each of them.

    Exact by default. ``accuracy`` switches to Spark's single-scan sketch with a
    rank error of ``1/accuracy``. Null values are left out; a group without any
    value has no row. ``weight`` names a column that says how many rows each row stands for, ``unions``
    the groups that each cell of the rows counts in.
    """
    if not keys:
        whole = quantiles(rows.withColumn("_all", F.lit(1)), ["_all"], value, fractions,
                          accuracy=accuracy, sizing=sizing, weight=weight)
        return whole.drop("_all")
    keys = list(keys)
    cells = unions.cells if unions else keys
    rows = rows.select(*cells, value, *([weight] if weight else [])).filter(F.col(value).isNotNull())
    if accuracy is not None:
        if weight or unions:
            raise ValueError("the sketch takes rows of groups, not counts or cells")
        return (rows.groupBy(*keys)
                .agg(F.count(value).alias("group_n"),
                     F.percentile_approx(value, [float(f) for f in fractions],
                                         accuracy).alias("edges"))
                .filter(F.col("group_n") > 0))
    sizing = sizing or (unions.measure(rows, keys) if unions else measure(rows, keys))
    found = at_ranks(rows, keys, value, _listed(quantile_ranks(fractions)), sizing, weight, unions)

    def at_rank(column: str) -> Column:
        return F.array(*[F.max(F.when(F.col("pos") == i + 1, F.col(column))) for i in range(len(fractions))])

    return found.groupBy(*keys).agg(F.max("group_n").alias("group_n"), at_rank(value).alias("edges"),
                                    at_rank("n_upto").alias("upto"))


def equal_cuts(rows: DataFrame, keys: Sequence[str], ranks: Callable[[Column], Sequence[Column]],
               by: Sequence[str], sizing: Sizing) -> tuple[DataFrame, DataFrame | None]:
    """Cut points of every group: ``keys, pos, depth`` and the values of the columns ``by``.

    A cut of depth d lies behind the rows whose first d values are its own. Also gives the runs
    that all of ``by`` leave undivided, with the ranks wanted inside, if there are any.
    """
    run_keys, wanted, cuts, runs = list(keys), _listed(ranks), None, None
    for depth, part in enumerate(by, 1):
        inside = rows if runs is None else attach(
            rows, runs.select(*run_keys), run_keys, sizing.broadcast_fits(lookup_bytes(1)), how="left_semi",
            null_safe=True, spread=[part])
        # A few rows per group that whole scans went into: kept, so that nothing repeats the scans.
        found = stage(at_ranks(inside, run_keys, part, wanted, sizing), f"cuts{part}")
        run_keys = [*run_keys, part]
        here = found.select(*run_keys, "pos", F.lit(depth).alias("depth"))
        cuts = here if cuts is None else cuts.unionByName(here, allowMissingColumns=True)
        split = (found.filter(F.col("rank") < F.col("n_upto"))
                 .select(*run_keys, F.struct("pos", (F.col("rank") - F.col("n_below")).alias("rank")).alias("_cut")))
        runs = stage(split.groupBy(*run_keys).agg(F.collect_list("_cut").alias("_wanted")), f"runs{part}")
        n_runs = runs.count()
        if not n_runs:
            return cuts, None
        wanted, sizing = runs, Sizing(n_runs, sizing.largest)
    return cuts, runs


def equal_bins(df: DataFrame, keys: Sequence[str], order_by: str, tie: str | None, out: str,
               ranks: Callable[[Column], Sequence[Column]], n_bins: int,
               sizing: Sizing | None = None) -> DataFrame:
    """Number each row's bin 1..n by ascending ``order_by`` then ``tie`` within its group.

    Bin i ends at the i-th of ``ranks``. Nulls sort first. Bins have the asked size whatever rows
    agree in: rows of equal value and tie are parted by a hash of the row, rows that agree in all
    columns in any way. The plan is the same for every group size.
    """
    if not keys:
        whole = equal_bins(df.withColumn("_all", F.lit(1)), ["_all"], order_by, tie, out, ranks,
                           n_bins, sizing)
        return whole.drop("_all")
    keys = list(keys)
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    by = ["_order", *(["_tie"] if tie else []), "_hash"]
    parts = {"_order": F.col(order_by), "_hash": F.xxhash64(*hashed)} | ({"_tie": F.col(tie)} if tie else {})
    ordered = df.withColumns(parts)
    if n_bins == 1:
        return df.withColumn(out, F.lit(1))
    sizing = sizing or measure(df, keys)
    fits = sizing.broadcast_fits(lookup_bytes(n_bins))
    cuts, same = equal_cuts(ordered, keys, ranks, by, sizing)
    if same is not None:
        # Rows that agree in everything: numbered in a written copy, which a retry cannot renumber.
        run_keys, few = [*keys, *by], Sizing(same.count(), sizing.largest)
        runs, run_fits = same.select(*run_keys), few.broadcast_fits(lookup_bytes(1))
        copy = stage(attach(ordered, runs, run_keys, run_fits, how="left_semi", null_safe=True)
                     .withColumn("_place", F.monotonically_increasing_id()), "equal_rows")
        found = at_ranks(copy, run_keys, "_place", same, few)
        by = [*by, "_place"]
        cuts = cuts.unionByName(stage(found.select(*run_keys, "_place", "pos", F.lit(len(by)).alias("depth")),
                                      "cuts_place"), allowMissingColumns=True)
        ordered = (attach(ordered, runs, run_keys, run_fits, how="left_anti", null_safe=True)
                   .unionByName(copy, allowMissingColumns=True))
    by = [c for c in by if c in cuts.columns]
    # Of a cut's entries the deepest counts; the others name the run that it lies in.
    entry = F.max_by(F.struct("depth", *by), "depth")
    cuts = (cuts.groupBy(*keys, "pos").agg(entry.alias("_cut"))
            .groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("pos", "_cut"))).alias("_cuts"))
            .select(*keys, F.transform(F.sequence(F.lit(1), F.lit(n_bins - 1)),
                                       lambda i: F.try_element_at("_cuts", i)).alias("_cuts")))

    def after(value: Column, other: Column) -> Column:  # nulls first, NaN last
        return F.coalesce(value > other, value.isNotNull() & other.isNull())

    def above(cut: Column, level: int = 0) -> Column:
        value, other = F.col(by[level]), cut[by[level]]
        if level + 1 == len(by):
            return after(value, other)
        return after(value, other) | (
            (cut["depth"] > level + 1) & value.eqNullSafe(other) & above(cut, level + 1))

    # Counted by a higher-order function: comparing in the projection itself, cut by cut or step by
    # step, makes a method too long for the JVM to compile, which is then interpreted.
    binned = attach(ordered, cuts, keys, fits, how="left", null_safe=True, spread=by)
    passed = F.filter("_cuts", lambda cut: cut.isNotNull() & above(cut))
    return binned.withColumn(out, F.coalesce(F.size(passed), F.lit(0)) + 1).select(*df.columns, out)


def attach_quantile_bin(rows: DataFrame, edges: DataFrame, keys: Sequence[str], value: str,
                        n_bins: int, fits: bool, out: str, middle: str | None = None) -> DataFrame:
    """0-based bin of each row by its group's edges; rows of groups without edges are kept.

    ``middle`` names a column for the group's middle edge.
    """
    joined = attach(rows, edges.select(*keys, F.col("edges").alias("_bin_edges")), keys, fits,
                    how="left", spread=[value])
    if middle:
        joined = joined.withColumn(middle, F.get("_bin_edges", F.lit((n_bins - 1) // 2)))
    return (joined.withColumn(out, edges_below(F.col(value), F.col("_bin_edges"), n_bins - 1))
            .drop("_bin_edges"))
