"""A Merkle manifest of a table: leaves, roots and a witness for every row, by incremental appends.

1. A row's leaf is a hash over its fields; rows are range-partitioned and sorted within their
   section, and counts per partition give every leaf its place there.
2. Places fall into aligned blocks. A task appends the leaves of one block in order and keeps the
   open subtrees on a stack, each with the partial witnesses of its leaves. When a subtree finds its
   sibling complete, every witness on either side is extended by the root of the other.
3. The roots of blocks are further appends: blocks of block roots are built in the same way, round
   after round, until a section has one root; the sections' roots are appended last. A row's
   witness is that of its leaf in its block, then that of its block, and so on.

A node is the hash of its two children's digests, written in hexadecimal; the last node of a level
that has no sibling is hashed alone. A level of a single node is the root of its section.

Nulls and edges: a null field is hashed as ``-``, other fields as their length in bytes, a colon and
their value, so that no two rows give the same input. Null sections and null order values come
first; rows of equal order value are placed by their leaf; rows that agree in all fields are
leaves of their own. Fields need a text form; texts are hashed whole. Further columns are
ignored. An empty table gives no row.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.llm.common import ship_package, table, work_table

#: Levels that one task builds: a block holds so many doublings of leaves.
LEVELS = 12
SECTIONS = "_sections"


def digest(*values: str) -> str:
    return hashlib.sha256("".join(values).encode()).hexdigest()


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash over fields, each with its length in bytes so that borders are certain."""
    def written(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[written(f) for f in fields]), 256)


def depth(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(n - 1, 0).bit_length()


class Appended:
    """A tree that grows by aligned appends; holds a witness for every leaf appended so far."""

    def __init__(self):
        self.witnesses: list[list[str]] = []
        self.open: list[tuple[int, str, int]] = []  # level, root and first leaf, largest subtree first

    def append(self, leaf: str) -> None:
        self.open.append((0, leaf, len(self.witnesses)))
        self.witnesses.append([])
        self._complete()

    def _complete(self) -> None:
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            level, right, middle = self.open.pop()
            _, left, first = self.open.pop()
            for witness in self.witnesses[first:middle]:
                witness.append(right)
            for witness in self.witnesses[middle:]:
                witness.append(left)
            self.open.append((level + 1, digest(left, right), first))

    def close(self, levels: int) -> str:
        """The root after so many levels; nodes without a sibling are hashed alone."""
        while len(self.open) > 1 or self.open[0][0] < levels:
            level, root, first = self.open.pop()
            self.open.append((level + 1, digest(root), first))
            self._complete()
        return self.open[0][1]


def folded(leaf: str, place: int, n: int, witness: Sequence[str]) -> str:
    """The root that a leaf at a place of n gives with the siblings of its path."""
    node, siblings = leaf, iter(witness)
    while n > 1:
        if place % 2:
            node = digest(next(siblings), node)
        else:
            node = digest(node, next(siblings)) if place + 1 < n else digest(node)
        place, n = place // 2, (n + 1) // 2
    return node


def _block(levels: int):
    """Root of a block and the witnesses of its nodes."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        tree = Appended()
        for node in rows["node"]:
            tree.append(node)
        root = tree.close(min(levels, depth(int(rows["n"].iloc[0]))))
        return pd.DataFrame({"section": rows["section"], "place": rows["place"], "root": root,
                             "witness": [bytes.fromhex("".join(w)) for w in tree.witnesses]})
    return run


def placed(leaves: DataFrame, section: str, order: Sequence[str]) -> DataFrame:
    """Rows with ``place`` from 0 in their section and the section's size ``n``.

    Rows are sorted by ranges, never a section as a whole; only a count for each section and
    partition is summed up along the partitions.
    """
    ranged = leaves.repartitionByRange(F.col(section), *[F.col(c) for c in order])
    # The partition stands in the upper bits of the row number, its rows' order in the lower.
    stored = work_table(ranged.sortWithinPartitions(section, *order)
                        .withColumn("_row", F.monotonically_increasing_id()), "leaves")
    part = F.shiftright("_row", 33)
    counts = stored.groupBy(section, part.alias("_part")).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(section).orderBy("_part")
    whole = Window.partitionBy(section)
    starts = counts.select(F.col(section).alias("_on"), "_part",
                           (F.sum("_n").over(along) - F.col("_n") - F.col("_first")).alias("_shift"),
                           F.sum("_n").over(whole).alias("n"))
    return (stored.withColumn("_in", part)
            .join(starts, F.col(section).eqNullSafe(F.col("_on")) & (F.col("_in") == F.col("_part")))
            .withColumn("place", F.col("_row") + F.col("_shift"))
            .drop("_on", "_part", "_in", "_shift", "_row"))


def witnesses(leaves: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Witnesses of ``section, place, n, node`` rows, and each section's root.

    Gives ``section, place, witness`` with the siblings' digests as bytes, lowest level first, and
    ``section, root``. A round builds the blocks of all sections, whatever their size; the number of
    rounds is the logarithm of the largest section to the base of a block.
    """
    size = 1 << levels
    rounds, nodes = [], leaves.select("section", "place", "n", "node")
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        built = work_table(
            nodes.withColumn("block", F.shiftright("place", levels)).groupBy("section", "block")
            .applyInPandas(_block(levels), "section string, place long, root string, witness binary"), "blocks")
        rounds.append(built)
        roots = (built.filter(F.col("place") % size == 0)
                 .select("section", F.shiftright("place", levels).alias("place"), F.col("root").alias("node")))
        if largest <= size:
            break
        sizes = leaves.select(F.col("section").alias("_on"), "n").distinct()
        shrink = size ** len(rounds)
        nodes = roots.join(sizes, F.col("section").eqNullSafe(F.col("_on"))).select(
            "section", "place", F.ceil(F.col("n") / shrink).cast("long").alias("n"), "node")
        largest = -(-largest // size)
    found = rounds[0].select("section", "place", "witness")
    for i, upper in enumerate(rounds[1:], 1):
        above = upper.select(F.col("section").alias("_on"), F.col("place").alias("_block"),
                             F.col("witness").alias("_above"))
        found = (found.join(above, F.col("section").eqNullSafe(F.col("_on"))
                            & (F.shiftright("place", levels * i) == F.col("_block")))
                 .withColumn("witness", F.concat("witness", "_above")).select("section", "place", "witness"))
    return found, roots.select("section", F.col("node").alias("root"))


def _proofs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Siblings of whole paths, and the roots that other leaves give with them."""
    for frame in frames:
        out = []
        for row in frame.itertuples():
            low, high = row.witness.hex(), row.top_witness.hex()
            low = [low[i:i + 64] for i in range(0, len(low), 64)]
            high = [high[i:i + 64] for i in range(0, len(high), 64)]
            node = folded(row.other, row.place, row.n, low)
            out.append((row.witness + row.top_witness, folded(node, row.top_place, row.top_n, high)))
        yield frame[["id", "section", "place", "leaf", "subroot", "root"]].assign(
            proof=[o[0] for o in out], folded=[o[1] for o in out])


def manifest(rows: DataFrame, section: str, order: str, fields: Sequence[str], *,
             claimed: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row: ``<order>, section, place, leaf, subroot, root, proof, folded``.

    ``proof`` holds the digests of the siblings from the leaf up to the root, 32 bytes each.
    ``folded`` is the root that the row's fields give with them; ``claimed`` replaces fields
    there, for instance by what another copy of the table says.
    """
    ship_package(rows.sparkSession)
    claimed = claimed or {}
    leaves = rows.select(F.col(section).cast("string").alias("section"), F.col(order).alias("id"),
                         leaf_hash([F.col(f) for f in fields]).alias("node"),
                         leaf_hash([claimed.get(f, F.col(f)) for f in fields]).alias("other"))
    leaves = placed(leaves, "section", ["id", "node"])
    found, subroots = witnesses(leaves, levels)
    tops = placed(subroots.withColumn("all", F.lit(SECTIONS)), "all", ["section"])
    top_found, roots = witnesses(tops.select(F.col("all").alias("section"), "place", "n",
                                             F.col("root").alias("node")), levels)
    tops = (tops.join(top_found.select(F.col("place"), F.col("witness").alias("top_witness")), "place")
            .join(roots.select(F.col("section").alias("all"), F.col("root").alias("top")), "all")
            .select(F.col("section").alias("_on"), F.col("root").alias("subroot"),
                    F.col("place").alias("top_place"), F.col("n").alias("top_n"), "top_witness",
                    F.col("top").alias("root")))
    of_leaf = found.select(F.col("section").alias("_in"), F.col("place").alias("_at"), "witness")
    whole = (leaves.join(of_leaf, F.col("section").eqNullSafe(F.col("_in")) & (F.col("place") == F.col("_at")))
             .join(tops, F.col("section").eqNullSafe(F.col("_on")))
             .select("id", "section", "place", "n", F.col("node").alias("leaf"), "other", "witness", "subroot",
                     "top_place", "top_n", "top_witness", "root"))
    kind = rows.schema[order].dataType.simpleString()
    return whole.mapInPandas(_proofs, f"id {kind}, section string, place long, leaf string, subroot string, "
                                      "root string, proof binary, folded string").withColumnRenamed("id", order)


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """All documents by language; every seventh checksum claims one character more."""
    longer = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0,
                    F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))
    found = manifest(table(spark, sf_dir, "documents"), "lang", "doc_id",
                     ["doc_id", "source", "lang", "n_chars", "text"], claimed={"n_chars": longer})
    return found.select("doc_id", "leaf", "subroot", "root",
                        F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
                        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place,
    'x' || coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
          list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
          lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)),
      4294967295::BIGINT) AS crc
  FROM documents),
l AS (
  SELECT doc_id, lang, place,
    sha256(head[2:] || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') || tail) AS leaf,
    CASE WHEN crc % 7 = 0 THEN
      sha256(head[2:] || coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1)::VARCHAR, '-')
             || tail) END AS changed
  FROM d),
t AS (
  SELECT 0 AS level, lang, place AS i, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM l
  UNION ALL
  SELECT level + 1, lang, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2)
  FROM t WHERE n > 1 GROUP BY level, lang, i // 2),
s AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, place AS i, subroot AS h, count(*) OVER () AS n FROM s
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2)
  FROM u WHERE n > 1 GROUP BY level, i // 2),
f AS (  -- the path of every leaf: first in its language's tree, then in the tree of subroots
  SELECT l.doc_id, l.lang, 0 AS level, false AS top, l.place AS i, coalesce(l.changed, l.leaf) AS h, '' AS proof
  FROM l
  UNION ALL
  SELECT f.doc_id, f.lang, CASE WHEN w.n = 1 THEN 0 ELSE f.level + 1 END, f.top OR w.n = 1,
    CASE WHEN w.n = 1 THEN s.place ELSE f.i // 2 END,
    CASE WHEN w.n = 1 THEN f.h WHEN f.i % 2 = 1 THEN sha256(w.sib || f.h) WHEN w.sib IS NULL THEN sha256(f.h)
      ELSE sha256(f.h || w.sib) END,
    f.proof || CASE WHEN w.n = 1 THEN '' ELSE coalesce(w.sib, '') END
  FROM f JOIN s ON f.lang IS NOT DISTINCT FROM s.lang
  JOIN (SELECT false AS top, a.lang, a.level, a.i, a.n, b.h AS sib FROM t a
        LEFT JOIN t b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND xor(a.i, 1) = b.i
        UNION ALL
        SELECT true, NULL, a.level, a.i, a.n, b.h FROM u a LEFT JOIN u b ON a.level = b.level AND xor(a.i, 1) = b.i) w
    ON f.top = w.top AND f.level = w.level AND f.i = w.i AND (f.top OR f.lang IS NOT DISTINCT FROM w.lang)
  WHERE NOT (f.top AND w.n = 1))
SELECT f.doc_id, l.leaf, s.subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root,
  f.h = r.h AS verified
FROM f JOIN l ON f.doc_id = l.doc_id JOIN s ON l.lang IS NOT DISTINCT FROM s.lang
JOIN u r ON r.n = 1
WHERE f.top AND f.level = r.level
"""
