"""Joining small per-group tables onto large row tables.

A per-group table (quantile edges, cut points) is broadcast only after its groups
have been counted and found to fit. Past that bound the rows are joined by shuffle
on salted keys, so that one hot group is still spread over many tasks.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 128 * 1024 * 1024
#: Rows that one window partition may hold; longer groups are cut into cells of about so many.
CELL_ROWS = 1_000_000
SALTS = 64


@dataclass(frozen=True)
class Sizing:
    """Number of groups, rows of the largest one and, if counted, of all; known before a plan is chosen."""

    groups: int
    largest: int
    rows: int = 0

    def broadcast_fits(self, row_bytes: int) -> bool:
        """Whether a table with one such row per group stays under the broadcast bound."""
        return self.groups * row_bytes <= MAX_BROADCAST_BYTES


def measure(rows: DataFrame, keys: Sequence[str]) -> Sizing:
    """One map-side combined count over the key columns; three numbers reach the driver."""
    return size_up(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")))


def size_up(sizes: DataFrame) -> Sizing:
    """What a table of group sizes (column ``size``) comes to."""
    found = sizes.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.max("size"), F.lit(0)).alias("largest"),
                      F.coalesce(F.sum("size"), F.lit(0)).alias("rows")).first()
    return Sizing(found["groups"], found["largest"], found["rows"])


def many_values(rows: DataFrame, columns: Sequence[str], at_least: int) -> bool:
    """Whether rows differ so much in these columns that counting by them would hardly shrink them; by a sketch."""
    return rows.agg(F.approx_count_distinct(F.xxhash64(*columns))).first()[0] > at_least


def attach(rows: DataFrame, small: DataFrame, keys: Sequence[str], fits: bool, *,
           how: str = "inner", null_safe: bool = False, spread: Sequence[str] = (),
           condition: Column | None = None) -> DataFrame:
    """Join a per-group table onto rows; the group keys keep the row side's columns.

    ``spread`` names row columns whose hash picks the salt when a broadcast does
    not fit; ``condition`` may refer to columns of both sides.
    """
    if not keys:
        raise ValueError("a lookup needs group keys")
    renamed = small.select(*[F.col(k).alias(f"_on_{k}") for k in keys],
                           *[c for c in small.columns if c not in keys])
    matches = [F.col(k).eqNullSafe(F.col(f"_on_{k}")) if null_safe
               else F.col(k) == F.col(f"_on_{k}") for k in keys]
    if condition is not None:
        matches.append(condition)
    dropped = [f"_on_{k}" for k in keys]
    if fits:
        on = reduce(lambda a, b: a & b, matches)
        return rows.join(F.broadcast(renamed), on, how).drop(*dropped)
    salted = renamed.withColumn("_salt_small", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = spread or rows.columns
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    on = reduce(lambda a, b: a & b, [F.col("_salt") == F.col("_salt_small"), *matches])
    return rows.join(salted.hint("merge"), on, how).drop("_salt", "_salt_small", *dropped)


def few_rows(table: DataFrame) -> bool:
    """Whether a table was counted and found small enough to broadcast; counts no further than that."""
    return Sizing(table.limit(MAX_BROADCAST_BYTES // 256 + 1).count(), 1).broadcast_fits(256)


def keep_listed(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed; the list is broadcast once counted and found small."""
    return rows.join(F.broadcast(listed) if few_rows(listed) else listed, key, "left_semi")
