"""Group keys that a report must list: configured channels, overall rows, months."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL_CHANNELS = "all"
OVERALL = "overall"


def expected_groups(rows: DataFrame, keys: Sequence[str], **listed: Sequence[str]) -> DataFrame:
    """Distinct ``keys`` of the rows, each with every value of the listed columns."""
    spine = rows.select(*keys).distinct()
    for name, values in listed.items():
        spine = spine.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return spine


def over_scopes(df: DataFrame, channel: str | None, channels: Sequence[str],
                scorecard: str | None) -> DataFrame:
    """Each row once per scope it counts in: overall and its scorecard, all and its channel.

    Replaces the column ``channel`` by the scope's label and adds ``scorecard``;
    this is what grouping sets expand to, with labels in place of nulls. Rows of
    channels that are not configured count in ``all`` only.
    """
    cards = [F.lit(OVERALL)]
    if scorecard and scorecard in df.columns:
        cards.append(F.col(scorecard).cast("string"))
    df = df.withColumn("scorecard", F.explode(F.array(*cards))).filter("scorecard is not null")
    if channel is None:
        return df
    own = F.when(F.col(channel).isin(*channels), F.col(channel))
    return (df.withColumn("channel", F.explode(F.array(F.lit(ALL_CHANNELS), own)))
            .filter("channel is not null"))


def own_counts(rows: DataFrame, keys: Sequence[str], channel: str | None, scorecard: str | None,
               value: str) -> DataFrame:
    """Rows per key, own channel, own scorecard and value, in ``n``; with a column ``n`` its sum."""
    own = [c for c in (channel, scorecard) if c and c in rows.columns]
    n = F.sum("n") if "n" in rows.columns else F.count(F.lit(1))
    return rows.groupBy(*dict.fromkeys([*keys, *own, value])).agg(n.alias("n"))


def scoped_counts(rows: DataFrame, keys: Sequence[str], channel: str | None, channels: Sequence[str],
                  scorecard: str | None, value: str) -> DataFrame:
    """Rows per key, scope and value, in ``n``: ``keys, scorecard[, channel], <value>, n``.

    Rows are counted once, map-side combined, by their own channel and scorecard; only the counts
    are then added up over the scopes they belong to. Rows with a column ``n`` are counts already.
    """
    counted = own_counts(rows, keys, channel, scorecard, value)
    scopes = ["scorecard", *(["channel"] if channel else [])]
    return (over_scopes(counted, channel, channels, scorecard)
            .groupBy(*dict.fromkeys([*keys, *scopes, value])).agg(F.sum("n").alias("n")))
