"""Running sums within groups of any length, by a hierarchy of cells.

A window with an order sorts each group in one task. That is the plan for a group that a task
can hold; a longer one is cut into cells of about ``CELL_ROWS`` rows first. The sums of the cells
are a table of the same shape, a millionth as long, whose running sums are taken in the same
way, by cells of cells if need be; inside a cell the window starts from what the cells before it hold.
The cells decide how work is spread, never a result.

Borders are values drawn by hash, in their own type and compared inside a struct, where null is
smallest and NaN largest, as a sort has it.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.plans import lookup
from scorewatch.plans.lookup import Sizing, attach, measure
from scorewatch.plans.staging import stage

#: Values drawn for each cell; every so-manieth is a border, which evens the cells out.
DRAWN = 16


def running_totals(table: DataFrame, keys: Sequence[str], order: str, totals: Mapping[str, Column],
                   at_most: int, level: int = 0) -> DataFrame:
    """Adds, for each name in ``totals``, its column's sum over the group's rows up to here.

    ``<name>_upto`` counts rows of equal order value as one, ``<name>_here`` is the sum over
    these, ``<name>_all`` that over the group. ``at_most`` bounds the rows of the largest group;
    ``level`` tells cells from cells of cells.
    """
    keys, cell = list(keys), f"_cell{level}"
    if at_most > lookup.CELL_ROWS:
        table = stage(table, "counted")
        at_most = measure(table, keys).largest
    if at_most <= lookup.CELL_ROWS:
        group = Window.partitionBy(*keys)
        return _within(table, group, order, totals).withColumns(
            {f"{name}_all": F.sum(column).over(group) for name, column in totals.items()})
    borders = stage(cell_borders(table, keys, order, totals), "borders")
    groups, entries, longest = borders.agg(
        F.count(F.lit(1)), F.sum(F.size("_borders")), F.max(F.size("_borders"))).first()
    fits = Sizing(groups + entries, 0).broadcast_fits(256)
    placed = add_cell(attach(table, borders, keys, fits, null_safe=True, spread=[order]),
                      order, "_borders", longest, cell)
    cells = stage(placed.groupBy(*keys, cell).agg(
        *[F.sum(column).alias(f"_{name}_cell") for name, column in totals.items()]), "cells")
    upto = running_totals(cells, keys, cell, {f"_{name}": F.col(f"_{name}_cell") for name in totals},
                          measure(cells, keys).largest, level + 1)
    starts = upto.select(*keys, cell, *[(F.col(f"_{name}_upto") - F.col(f"_{name}_cell"))
                                           .alias(f"_{name}_start") for name in totals])
    n_cells = Sizing(groups + entries, 0)
    joined = attach(placed, starts, [*keys, cell], n_cells.broadcast_fits(256), null_safe=True, spread=[order])
    found = _within(joined, Window.partitionBy(*keys, cell), order, totals)
    return (found.withColumns({f"{name}_upto": F.col(f"{name}_upto") + F.col(f"_{name}_start") for name in totals})
            .drop("_borders", cell, *[f"_{name}_start" for name in totals]))


def _within(table: DataFrame, group, order: str, totals: Mapping[str, Column]) -> DataFrame:
    upto = group.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    here = group.orderBy(order).rangeBetween(Window.currentRow, Window.currentRow)
    return table.withColumns({f"{name}_upto": F.sum(column).over(upto) for name, column in totals.items()}
                             | {f"{name}_here": F.sum(column).over(here) for name, column in totals.items()})


def cell_borders(table: DataFrame, keys: Sequence[str], order: str, totals: Mapping[str, Column]) -> DataFrame:
    """Per group its sums and the values, in order, that cut it into cells of about ``CELL_ROWS`` rows."""
    draw = min(1.0, DRAWN / lookup.CELL_ROWS)
    drawn = F.pmod(F.xxhash64(*table.columns, F.lit("border")), F.lit(1 << 30)) < int(draw * (1 << 30))
    found = table.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(drawn, F.struct(F.col(order).alias("v"))))).alias("_drawn"),
        *[F.sum(column).alias(f"{name}_all") for name, column in totals.items()])
    every = max(1, int(draw * lookup.CELL_ROWS))
    return found.select(*keys, F.filter("_drawn", lambda v, i: (i + 1) % every == 0).alias("_borders"),
                        *[f"{name}_all" for name in totals])


def add_cell(rows: DataFrame, value: str, borders: str, longest: int, out: str) -> DataFrame:
    """Number of borders below the value, by binary search over the sorted borders."""
    rows = rows.withColumn(out, F.lit(0))
    step = 1 << max(0, int(longest).bit_length() - 1)
    while step:
        probe = F.get(borders, F.col(out) + F.lit(step - 1))
        rows = rows.withColumn(out, F.col(out) + F.when(F.struct(F.col(value).alias("v")) > probe, step).otherwise(0))
        step //= 2
    return rows
