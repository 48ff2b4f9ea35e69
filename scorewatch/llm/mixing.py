"""Mixing sources to target weights along a time-varying curriculum.

A source's schedule says how fast it is wanted over training time 0..1: its weight times
``1 + ramp * (2 t - 1)``. The integral of the schedule is the source's weight, so shares of the
whole mix follow the weights, but sources above the mean weight are wanted more and more
(``ramp`` 0.5) and those below it less and less. Documents of a source stand in a fixed random
order; the order is read through, and again from its start, until the source's target of words
is taken, at most ``EPOCHS`` times. Inverting the source's cumulative demand at a document's
place gives its training position, and documents are range-sorted by position.

Places are exact running sums. A source's order is cut into about as many cells as a cell has
rows (the square root of the row count), so neither the rows of a cell nor the cells of a
source come near one task's limit; the only table in one task has a row for each source.

Nulls and edges: a null source is a source, after all others; a null text has size 0 and is
never taken; repeated rows are taken one by one; without any word nothing is taken. Column
names must not begin with ``_mix``.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.llm.common import WORD, small_enough, table

EPOCHS = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
RAMP = 0.5


def source_targets(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size, target, ramp`` from ``source, source_size``, a row for each source.

    Targets are shares of all words by weight. A source whose share exceeds ``epochs`` times its
    size is held there; what it gives up goes to the others by weight. Sources are held in order
    of size per weight; holding one that must be held raises the level of words per weight for the
    rest and holding any other lowers it, so the level sought is the highest.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_need = Window.orderBy("_mix_need", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    listed = (sizes.withColumn("_mix_n", F.row_number().over(names))
              .withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]),
                                          (F.col("_mix_n") - 1) % len(weights)))
              .withColumn("_mix_need", F.col("source_size") * epochs / F.col("weight"))
              .withColumn("_mix_total", F.sum("source_size").over(everything).cast("double"))
              .withColumn("_mix_weights", F.sum("weight").over(everything)))
    # If all before this one are held, the level of words per weight for the rest.
    before = F.coalesce(F.sum(F.col("source_size") * epochs).over(by_need), F.lit(0))
    lighter = F.coalesce(F.sum("weight").over(by_need), F.lit(0.0))
    level = (F.col("_mix_total") - before) / (F.col("_mix_weights") - lighter)
    found = (listed.withColumn("_mix_level", level)
             .withColumn("_mix_level", F.max("_mix_level").over(everything))
             .withColumn("_mix_mean", F.col("_mix_weights") / F.count(F.lit(1)).over(everything)))
    target = F.least(F.col("source_size") * float(epochs), F.col("weight") * F.col("_mix_level"))
    return found.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"),
                        (F.signum(F.col("weight") - F.col("_mix_mean")) * RAMP).alias("ramp"))


def position(share: Column, ramp: Column) -> Column:
    """Training time at which a source has delivered a share of its words.

    The demand until t is ``t + ramp * (t**2 - t)``; its inverse is a root of a quadratic.
    """
    b = 1 - ramp
    root = (F.sqrt(b * b + 4 * ramp * share) - b) / (2 * ramp)
    return F.when(ramp == 0, share).otherwise(root)


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The documents with their part in the mix, one row each.

    Adds, with the prefix ``_mix_``: ``size``, ``source_size``, ``target``, ``taken`` (words,
    repeats counted), ``at`` (words of the source before it, in its order) and ``ramp``.
    """
    n_rows = docs.count()
    n_cells = max(1, math.isqrt(n_rows))
    sized = (docs.withColumn("_mix_size", F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"))
             .withColumn("_mix_order", F.xxhash64(F.col(id_col), F.col(source_col), F.lit("mixing order")))
             .withColumn("_mix_cell", F.pmod("_mix_order", F.lit(n_cells))))
    cells = (sized.groupBy(F.col(source_col).alias("source"), "_mix_cell")
             .agg(F.sum("_mix_size").alias("_mix_words")))
    sizes = cells.groupBy("source").agg(F.sum("_mix_words").alias("source_size"))
    targets = source_targets(sizes, weights, epochs)
    targets = F.broadcast(targets) if small_enough(targets) else targets
    along = (Window.partitionBy("source").orderBy("_mix_cell")
             .rowsBetween(Window.unboundedPreceding, -1))
    bases = (cells.withColumn("_mix_base", F.coalesce(F.sum("_mix_words").over(along), F.lit(0))).alias("c")
             .join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
             .select(F.col("c.source").alias("_mix_source"), F.col("_mix_cell").alias("_mix_c"), "_mix_base",
                     F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target"),
                     F.col("ramp").alias("_mix_ramp")))
    inside = (Window.partitionBy(source_col, "_mix_cell")
              .orderBy("_mix_order", F.col(id_col), "_mix_size").rowsBetween(Window.unboundedPreceding, -1))
    placed = (sized.withColumn("_mix_at", F.coalesce(F.sum("_mix_size").over(inside), F.lit(0)))
              .join(bases, F.col(source_col).eqNullSafe(F.col("_mix_source"))
                    & (F.col("_mix_cell") == F.col("_mix_c")))
              .withColumn("_mix_at", F.col("_mix_at") + F.col("_mix_base")))
    # Words of the document in each reading of the source that lie before the target.
    wanted = F.round("_mix_target").cast("long")
    taken = sum((F.least(F.greatest(wanted - F.col("_mix_at") - F.col("_mix_source_size") * k, F.lit(0)), F.col("_mix_size"))
                 for k in range(1, epochs)),
                F.least(F.greatest(wanted - F.col("_mix_at"), F.lit(0)), F.col("_mix_size")))
    return placed.withColumn("_mix_taken", taken).select(*docs.columns, *[
        f"_mix_{name}" for name in ("size", "source_size", "target", "taken", "at", "ramp")])


def training_stream(docs: DataFrame, *, text_col: str = "text", epochs: int = EPOCHS, **kinds) -> DataFrame:
    """What the mix takes, by training position: a row for each reading of a document.

    Of a document that the target cuts, the reading has the words before the cut. Adds
    ``epoch`` and ``position``.
    """
    mixed = mix(docs, text_col=text_col, epochs=epochs, **kinds)
    readings = F.filter(F.transform(F.sequence(F.lit(0), F.lit(epochs - 1)), lambda k: F.struct(
        k.alias("epoch"), F.least(F.greatest(F.col("_mix_taken") - F.col("_mix_size") * k, F.lit(0)), F.col("_mix_size"))
        .alias("words"))), lambda r: r["words"] > 0)
    read = mixed.withColumn("_mix_read", F.explode(readings))
    share = (F.col("_mix_at") + F.col("_mix_source_size") * F.col("_mix_read.epoch")
             + F.col("_mix_read.words") / 2) / F.col("_mix_target")
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*+" + WORD), F.lit(0))
    cut = F.when(F.col("_mix_read.words") < F.col("_mix_size"),
                 F.array_join(F.slice(words, F.lit(1), F.col("_mix_read.words").cast("int")), "")
                 ).otherwise(F.col(text_col))
    at = position(F.least(share, F.lit(1.0)), F.col("_mix_ramp"))
    return (read.select(*[cut.alias(c) if c == text_col else F.col(c) for c in docs.columns],
                        F.col("_mix_read.epoch").alias("epoch"), at.alias("position"))
            .orderBy("position"))


def op2_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document's size, its source's size and target, and the words the mix takes of it."""
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    first = position(F.least((F.col("_mix_at") + F.col("_mix_size") / 2) / F.col("_mix_target"), F.lit(1.0)),
                     F.col("_mix_ramp"))
    names = ("size", "source_size", "target", "taken")
    return mixed.select("doc_id", *[F.col(f"_mix_{n}").alias(n) for n in names],
                        F.when(F.col("_mix_taken") > 0, first).alias("position")).orderBy("position", "doc_id")
