"""How far the word use of each source lies from that of every other source of its language.

Terms are counted per section (language) and group (source); a section keeps the terms that
enough of its documents hold. A group gives a kept term the smoothed share
``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``, and two groups differ by
``floor((p - q)^2 / (p + q))``, summed over all kept terms.

Pairs are found by Gustavson's row accumulation. The counts are a sparse matrix of groups and terms,
dealt into blocks of terms. Within a block a group scatters its terms through the term-major index:
each term leads to its postings, and what it adds is summed into one dense accumulator with a
cell per peer. So no pair of postings is ever a row; a block emits one number per pair of groups
that share a term in it.

Most terms are missing from one side, where the share is that of a zero count. Only shared terms
are scattered; each adds its difference less the differences that it would have with zero counts:

    sum = scattered + A(b) + B(a) + (V - |A| - |B|) f(p0, q0)

where ``A(b)`` sums what a's terms add against b's zero share, taken from how often each count
occurs in a (a group has far fewer different counts than terms), and ``p0, q0`` are the zero shares.

All arithmetic is on integers: shares in 38-digit decimals, differences and sums in 64 bits.

Nulls and edges: null texts, sections and groups are read as empty strings; a group without any
term has zero counts throughout; a section that keeps no term has sums of 0 and no term rows; ties go
to the name that comes first by bytes; repeated rows count as often as they occur; whole texts are
read; further columns are ignored; an empty table gives no row.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.llm.common import ship_package, table, work_table

#: Runs of ASCII letters and of characters beyond ASCII; over UTF-8 these are the same bytes.
TERM_BYTES = rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, LEAST_DOCS, TOP_TERMS = 1_000_000_000, 10, 10
#: Entries of the count matrix in a block of terms.
BLOCK_ENTRIES = 250_000
#: Different terms that a worker holds before it hands on their counts.
HELD_TERMS = 500_000
#: What one document adds to a term's number, above its occurrences.
DOCUMENT = 1 << 40
NAMES = ["section", "grp"]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term per group, summed over many documents."""
    import re
    terms = re.compile(TERM_BYTES).findall

    def rows() -> Iterator[pa.RecordBatch]:
        for (section, group), found in held.items():
            both = np.fromiter(found.values(), np.int64, len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(found), pa.string()) for name in (section, group)]
                + [pa.array(list(found), pa.binary()).cast(pa.string()),
                   pa.array(both % DOCUMENT), pa.array(both // DOCUMENT)], names=[*NAMES, "term", "n", "docs"])

    held: dict[tuple[str, str], dict[bytes, int]] = {}
    size = 0
    for batch in batches:
        for section, group, text in zip(*[batch.column(c).to_pylist() for c in (*NAMES, "text")]):
            total = held.setdefault((section, group), {})
            size -= len(total)
            so_far = total.get
            for term, n in Counter(terms(text.lower())).items():  # bytes lower A-Z only
                total[term] = so_far(term, 0) + n + DOCUMENT
            size += len(total)
            if size > HELD_TERMS:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 kept))``; 0 without kept terms."""
    wide = F.lit(SCALE).cast("decimal(20,0)") * (count.cast("decimal(18,0)") + 2)
    whole = total.cast("decimal(20,0)") + kept.cast("decimal(20,0)") * 2
    return F.when(kept > 0, F.call_function("div", wide, whole) + 1).otherwise(0).cast("long")


def difference(p, q):
    """``floor((p - q)^2 / (p + q))`` of shares, for arrays of integers."""
    return (p - q) * (p - q) // (p + q)


def _scatter(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of shared terms over one block of terms, for every pair of groups that share any."""
    out = []
    for section, part in rows.groupby("section", sort=False):
        names, peer = np.unique(part["grp"].to_numpy(dtype=object), return_inverse=True)
        term = np.unique(part["term"].to_numpy(dtype=object), return_inverse=True)[1]
        p, zero = part["p"].to_numpy(np.int64), part["p0"].to_numpy(np.int64)
        own_zero = np.zeros(len(names), np.int64)
        own_zero[peer] = zero
        # The term-major index: postings sorted by term, and where each term's begin.
        by_term = np.argsort(term, kind="stable")
        index_peer, index_p = peer[by_term], p[by_term]
        sizes = np.bincount(term)
        starts = np.cumsum(sizes) - sizes
        by_group = np.argsort(peer, kind="stable")
        borders = np.cumsum(np.bincount(peer))[:-1]
        for group, own in enumerate(np.split(by_group, borders)):
            sums = np.zeros(len(names), np.int64)
            touched = np.zeros(len(names), bool)
            for at in _runs(own, sizes[term[own]]):
                n = sizes[term[at]]
                ends = np.cumsum(n)
                places = np.arange(ends[-1]) + np.repeat(starts[term[at]] - (ends - n), n)
                other = index_peer[places]
                mine, theirs = np.repeat(p[at], n), index_p[places]
                mine0, theirs0 = own_zero[group], own_zero[other]
                np.add.at(sums, other, difference(mine, theirs) - difference(mine, theirs0)
                          - difference(mine0, theirs) + difference(mine0, theirs0))
                touched[other] = True
            touched[group] = False
            if touched.any():
                out.append(pd.DataFrame({"section": section, "grp": names[group], "item": names[touched],
                                         "shared": sums[touched]}))
    return pd.concat(out) if out else pd.DataFrame({"section": [], "grp": [], "item": [], "shared": []})


def _runs(own: np.ndarray, sizes: np.ndarray, most: int = 1_000_000) -> Iterator[np.ndarray]:
    """A group's terms in runs of about so many postings, which bounds the arrays in flight."""
    if len(own):
        cell = (np.cumsum(sizes) - 1) // most
        yield from np.split(own, np.flatnonzero(np.diff(cell)) + 1)


def term_counts(docs: DataFrame, section: str, group: str, text_col: str, least: int) -> DataFrame:
    """``section, grp, term, n``: occurrences of kept terms in groups that hold them."""
    def read(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))
    texts = docs.select(read(section).alias("section"), read(group).alias("grp"), read(text_col).cast("binary").alias("text"))
    found = work_table(
        texts.mapInArrow(_count, "section string, grp string, term string, n long, docs long")
        .groupBy(*NAMES, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    kept = (found.groupBy("section", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("section_n"))
            .filter(F.col("docs") >= least).select("section", "term", "section_n"))
    return found.select(*NAMES, "term", "n").join(kept, ["section", "term"])


def audit(docs: DataFrame, *, section: str = "lang", group: str = "source", text_col: str = "text",
          least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``section, grp, part, item, q, value, rank``: every other group, and the terms used most in excess.

    Part ``pair`` ranks all other groups of the section by the sum of differences; ``q`` is null there.
    Part ``term`` ranks the terms to which the group gives more than its section does.
    """
    ship_package(docs.sparkSession)
    counts = work_table(term_counts(docs, section, group, text_col, least_docs), "kept_terms")
    groups = docs.select(F.coalesce(F.col(section).cast("string"), F.lit("")).alias("section"),
                         F.coalesce(F.col(group).cast("string"), F.lit("")).alias("grp")).distinct()
    sections = (counts.select("section", "term", "section_n").distinct().groupBy("section")
                .agg(F.count(F.lit(1)).alias("kept"), F.sum("section_n").alias("section_total")))
    totals = counts.groupBy(*NAMES).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    figures = work_table(
        groups.join(totals, NAMES, "left").join(sections, "section", "left").na.fill(0)
        .withColumn("p0", share(F.lit(0), F.col("total"), F.col("kept"))), "groups")
    terms = (counts.join(figures, NAMES)
             .withColumn("p", share(F.col("n"), F.col("total"), F.col("kept"))))

    def f(p: Column, q: Column) -> Column:
        wide = (p - q).cast("decimal(19,0)")
        return F.call_function("div", wide * wide, (p + q).cast("decimal(19,0)"))

    # Shared terms, by blocks of terms.
    entries = counts.count()
    blocks = max(1, -(-entries // BLOCK_ENTRIES))
    scattered = (terms.select(*NAMES, "term", "p", "p0",
                              F.pmod(F.xxhash64("section", "term"), F.lit(blocks)).alias("block"))
                 .groupBy("block").applyInPandas(_scatter, "section string, grp string, item string, shared long")
                 .groupBy(*NAMES, "item").agg(F.sum("shared").alias("shared")))
    # What a group's terms add against each peer's zero share, by how often a count occurs in it.
    histogram = terms.groupBy(*NAMES, "p").agg(F.count(F.lit(1)).alias("times"))
    zeros = figures.select("section", F.col("grp").alias("item"), F.col("p0").alias("q0"))
    alone = (histogram.join(zeros, "section")
             .groupBy(*NAMES, "item").agg(F.sum(F.col("times") * f(F.col("p"), F.col("q0"))).alias("alone")))
    back = alone.select("section", F.col("item").alias("grp"), F.col("grp").alias("item"), F.col("alone").alias("back"))
    other = figures.select("section", F.col("grp").alias("item"), F.col("held").alias("other_held"),
                           F.col("p0").alias("q0"))
    neither = F.when(F.col("kept") > 0, (F.col("kept") - F.col("held") - F.col("other_held"))
                     * f(F.col("p0"), F.col("q0"))).otherwise(0)
    by_value = Window.partitionBy(*NAMES).orderBy(F.desc("value"), "item")
    pairs = (figures.join(other, "section").filter(F.col("grp") != F.col("item"))
             .join(scattered, [*NAMES, "item"], "left").join(alone, [*NAMES, "item"], "left")
             .join(back, [*NAMES, "item"], "left").na.fill(0, ["shared", "alone", "back"])
             .select(*NAMES, F.lit("pair").alias("part"), "item", F.lit(None).cast("long").alias("q"),
                     (F.col("shared") + F.col("alone") + F.col("back") + neither).cast("long").alias("value"))
             .withColumn("rank", F.row_number().over(by_value)))
    whole = share(F.col("section_n"), F.col("section_total"), F.col("kept"))
    best = (terms.withColumn("q", whole).filter(F.col("p") > F.col("q"))
            .select(*NAMES, F.lit("term").alias("part"), F.col("term").alias("item"), "q",
                    f(F.col("p"), F.col("q")).cast("long").alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top_terms))
    return pairs.unionByName(best)


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """All sources of all documents against the other sources of their language."""
    found = audit(table(spark, sf_dir, "documents"))
    return found.select(F.col("section").alias("lang"), F.col("grp").alias("source"), "part", "item", "value", "rank")


ORACLE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
o AS (SELECT lang, source, unnest(ws) AS term FROM d),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ws)) AS term FROM d)
  GROUP BY lang, term HAVING count(*) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
gn AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(gn.total, 0) + 2 * v.v) AS p
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
  LEFT JOIN gn USING (lang, source)),
q AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, (p.p - q.q) * (p.p - q.q) // (p.p + q.q)
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
r AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT * FROM r WHERE part = 'pair' OR rank <= 10
"""
