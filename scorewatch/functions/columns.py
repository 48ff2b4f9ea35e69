"""Column expressions shared by the operators. All are built-ins and stay in codegen."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.spec import Bucket

SHARE_FLOOR = 1e-4


def ratio(part: Column, whole: Column) -> Column:
    """Double division that gives null, not an error, on a zero whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def floored_share(part: Column, whole: Column) -> Column:
    return F.greatest(ratio(part, whole), F.lit(SHARE_FLOOR))


def indicator(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def add_all(terms: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left + right, terms)


def shift_month_col(month: Column, months: int) -> Column:
    """``yyyy-MM`` moved by whole months, by integer arithmetic; null if it is no month."""
    index = (F.substring(month, 1, 4).try_cast("int") * 12
             + F.substring(month, 6, 2).try_cast("int") + (months - 1))
    number = F.pmod(index, F.lit(12))
    year = ((index - number) / 12).cast("int").cast("string")
    return F.concat(F.lpad(year, 4, "0"), F.lit("-"), F.lpad((number + 1).cast("string"), 2, "0"))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the column's type can hold one."""
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(name)
    return missing


def numeric_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns and isinstance(df.schema[n].dataType, T.NumericType)]


def edges_below(value: Column, edges: Column, count: int) -> Column:
    """How many of the first ``count`` edges lie strictly below the value."""
    return add_all([indicator(value > F.get(edges, F.lit(i))) for i in range(count)])


def edges_reached(value: Column, edges: Column, count: int) -> Column:
    """How many of the first ``count`` edges are at or below the value."""
    return add_all([indicator(value >= F.get(edges, F.lit(i))) for i in range(count)])


def quantile_bin(value: Column, edges: Column, count: int) -> Column:
    """Bin 1..count+1 by edges below the value; null without value or edges."""
    usable = value.isNotNull() & edges.isNotNull() & (F.size(edges) > 0)
    return F.when(usable, edges_below(value, edges, count) + 1)


def interval_index(value: Column, intervals: Sequence[tuple[float, float]]) -> Column:
    """0-based interval, ``[low, high)`` with the last closed; null outside all."""
    last = len(intervals) - 1
    chain = F
    for i, (low, high) in enumerate(intervals):
        upper = (value <= high) if i == last else (value < high)
        chain = chain.when((value >= low) & upper, F.lit(i))
    return chain


def interval_label(low: Column, high: Column, places: int) -> Column:
    return F.format_string(f"%.{places}f-%.{places}f", low, high)


def bucket_label(bucket: Bucket) -> Column:
    value = F.col(bucket.column)
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for boundary, label in zip(bucket.boundaries, bucket.labels):
        chain = chain.when(value <= boundary, F.lit(label))
    return chain.otherwise(F.lit(bucket.labels[-1]))


def band_label(decile: Column, bands: Mapping[str, Sequence[int]]) -> Column:
    chain = F.when(decile.isNull(), F.lit(None).cast("string"))
    for name, deciles in bands.items():
        chain = chain.when(decile.isin(*deciles), F.lit(name))
    return chain


def correlation(left: str, right: str) -> Column:
    """Pearson correlation over the rows given; null for under two pairs or no variance."""
    spread = F.stddev_pop(left) * F.stddev_pop(right)
    return F.when(F.count(F.lit(1)) >= 2, F.try_divide(F.covar_pop(left, right), spread))


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str,
         cast: str = "double") -> DataFrame:
    """Wide to long, after pruning to the columns in play."""
    entries = [F.struct(F.lit(c).alias(name), F.col(c).cast(cast).alias(value)) for c in columns]
    return df.select(*ids, F.explode(F.array(*entries)).alias("_entry")).select(*ids, "_entry.*")
