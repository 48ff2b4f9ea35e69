"""Near-duplicate documents by MinHash bands with sequential Bayesian verification.

A document is its set of distinct word shingles. Documents with equal sets form one class
and go on as one vertex. Banded MinHash signatures propose pairs of classes; the posterior
of the similarity, after every further batch of signature values, prunes a pair as soon as
reaching the threshold has become less likely than ``miss``; what survives is verified on
the full shingle sets. Components of verified links are the duplicate groups.

Only what connects components matters, so candidates come in two rounds. First every class
meets the smallest and the largest member of its buckets, and the likeliest of those pairs
is verified; those links make a forest. Then the buckets whose members still have different
labels in it are compared across labels, in cells of bounded size that give a forest of what
the posterior leaves, never its pairs; the components of these forests are the clusters in
which links are still open. A cluster's full shingle sets are compared across labels, again in
cells, and a cell gives the links that join labels, at most one for each of them. Rows grow
with the members of buckets and clusters, not with their pairs. The comparisons in a cell do grow with
the pairs of alike documents that are no links, as any exact answer must tell those from links.

Nulls and edges: a null or blank text has an empty set and is linked with nothing; a text
shorter than a shingle counts as one shingle; rows that share an id follow their own texts;
a row without an id is kept and has no component. Further columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.llm.common import (BROADCAST_ROWS, HASHES, attach_groups, chained, mixed, small_enough,
                                   table, texts_in_pieces, words_of, work_table)

#: A pair of similarity 0.8 shares no band with probability (1 - 0.8**8)**64 = 8e-6. Long bands
#: keep documents apart that only have a passage in common: at a
#: similarity of 0.3 they meet in one of 64 bands of eight values with probability 0.004, in one of
#: 30 bands of five with 0.07, which finds pairs of 0.8 no better.
BANDS, ROWS = 64, 8
#: Signature values kept for comparison, how many at a time, and the chance of losing a link in one.
COMPARED, BATCH, MISS = 150, 15, 1e-7
#: Bytes of a band's key.
KEY_BYTES = 6
#: Of a large bucket or cluster two blocks meet in a cell: members of a bucket's block, shingles of a cluster's.
BLOCK_MEMBERS, BLOCK_SHINGLES = 2_000, 300_000
#: Cells that are compared together have about so many members, or so many shingles.
BIN_MEMBERS, BIN_SHINGLES = 20_000, 1_000_000


def shingle_set(text: str | None, length: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of one text."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    return np.unique(chained(hashes, min(length, len(hashes))))


def signatures(sets: list[np.ndarray], n_hashes: int) -> np.ndarray:
    """A row of 16-bit MinHash values for each set; none of the sets is empty."""
    draw = np.random.RandomState(20_011)
    factors = draw.randint(0, 2**32, n_hashes, dtype=np.uint32) | np.uint32(1)
    shifts = draw.randint(0, 2**32, n_hashes, dtype=np.uint32)
    out = np.empty((len(sets), n_hashes), np.uint16)
    begin = 0
    while begin < len(sets):
        end, held = begin, 0
        while end < len(sets) and (end == begin or held + len(sets[end]) <= 100_000):
            held += len(sets[end])
            end += 1
        values = np.concatenate(sets[begin:end])
        values = (values >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[begin:end]])[:-1]])
        buffer = np.empty_like(values)
        for i in range(n_hashes):
            np.multiply(values, factors[i], out=buffer)
            np.add(buffer, shifts[i], out=buffer)
            out[begin:end, i] = np.minimum.reduceat(buffer, starts) & np.uint32(0xFFFF)
        begin = end
    return out


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``KEY_BYTES`` bytes for each band of each signature, side by side."""
    grouped = values[:, :bands * rows].reshape(len(values), bands, rows).astype(np.uint64)
    keys = np.zeros((len(values), bands), np.uint64)
    for i in range(rows):
        keys = mixed(keys * np.uint64(0xD6E8FEB86659FD93) + grouped[:, :, i] + np.uint64(1))
    spread = np.ascontiguousarray(keys).view(np.uint8).reshape(len(values), bands, 8)
    return spread[:, :, :KEY_BYTES].reshape(len(values), -1)


def _features(length: int, bands: int, rows: int, compared: int):
    n_hashes = max(bands * rows, compared)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for frame in frames:
            for begin, end in texts_in_pieces(frame, "text"):
                part = frame.iloc[begin:end]
                sets = [shingle_set(t, length) for t in part["text"]]
                some = [s for s in sets if len(s)]
                values = signatures(some, n_hashes) if some else np.empty((0, n_hashes), np.uint16)
                drawn = iter(zip(values[:, :compared], band_keys(values, bands, rows)))
                found = [(len(s), xxhash.xxh3_64_intdigest(s.tobytes(), 1) - 2**63,
                          xxhash.xxh3_64_intdigest(s.tobytes(), 2) - 2**63,
                          *(x.tobytes() for x in next(drawn))) if len(s) else (0, None, None, None, None)
                         for s in sets]
                yield pd.DataFrame({
                    "id": part["id"].astype("Int64").to_numpy(dtype=object, na_value=None),
                    "n": [f[0] for f in found], "set_a": pd.array([f[1] for f in found], "Int64"),
                    "set_b": pd.array([f[2] for f in found], "Int64"), "sig": [f[3] for f in found],
                    "band_keys": [f[4] for f in found]})
    return run


def least_matches(threshold: float, miss: float, n_hashes: int, batch: int) -> list[tuple[int, int]]:
    """After so many values, the fewest matches that leave a pair its chance.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1), and
    P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(batch, n_hashes + 1, batch):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def posterior_survivors(left: np.ndarray, right: np.ndarray, limits) -> tuple[np.ndarray, np.ndarray]:
    """Rows that no batch prunes, and their share of equal signature values."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for upto, least in limits:
        matches = matches + (left[alive, done:upto] == right[alive, done:upto]).sum(axis=1)
        stays = matches >= least
        alive, matches, done = alive[stays], matches[stays], upto
    return alive, matches / max(done, 1)


def _prune(limits, n_hashes: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            left, right = (np.frombuffer(b"".join(frame[c]), np.uint16).reshape(-1, n_hashes)
                           for c in ("sig_a", "sig_b"))
            alive, share = posterior_survivors(left, right, limits)
            yield frame[["a", "b"]].iloc[alive].assign(share=share)
    return run


def likely(pairs: DataFrame, classes: DataFrame, num: int, den: int, limits, n_hashes: int) -> DataFrame:
    """Pairs ``a, b`` that sizes and posterior leave, with their share of equal values."""
    def side(name: str) -> DataFrame:
        return classes.select(F.col("rep").alias(name), F.col("n").alias(f"n_{name}"),
                              F.col("sig").alias(f"sig_{name}"))
    joined = (pairs.join(side("a"), "a").join(side("b"), "b")
              .filter(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)
              .select("a", "b", "sig_a", "sig_b"))
    return joined.mapInPandas(_prune(limits, n_hashes), "a long, b long, share double")


def _sets(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"],
                                "shingles": [shingle_set(t, length).tobytes() for t in frame["text"]]})
    return run


def _verify(num: int, den: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            linked = []
            for x, y in zip(frame["set_a"], frame["set_b"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(den * common >= num * (len(x) + len(y) - common))
            yield frame.loc[np.array(linked, bool), ["a", "b"]]
    return run


def verified(pairs: DataFrame, texts: DataFrame, length: int, num: int, den: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    ids = (pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
           .distinct())
    ids = F.broadcast(ids) if small_enough(ids, 2_000_000) else ids
    sets = texts.join(ids, "id", "left_semi").mapInPandas(_sets(length), "id long, shingles binary")
    by_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
    heads = pairs.select(F.col("a").alias("id")).distinct()
    heads = F.broadcast(heads) if small_enough(heads, 2_000_000) else heads
    head_sets = (texts.join(heads, "id", "left_semi")
                 .mapInPandas(_sets(length), "id long, shingles binary"))
    joined = by_b.join(head_sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
    return joined.mapInPandas(_verify(num, den), "a long, b long").distinct()


def paired_blocks(member: Column, blocks: Column) -> Column:
    """The cells of a group that a member is in: its block beside each other one, or the only block.

    Any two members of the group meet in some cell.
    """
    blocks = F.greatest(blocks.cast("long"), F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64(member), blocks)
    others = F.filter(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda block: block != own)
    return F.when(blocks == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(others, lambda block: F.least(block, own) * blocks + F.greatest(block, own)))


def cell_forest(labels: np.ndarray, n: np.ndarray, values: np.ndarray, num: int, den: int,
                limits) -> list[tuple[int, int]]:
    """A forest of the pairs of different label that sizes and posterior leave: places in the cell.

    Its components are those of all such pairs. A member that was reached is not looked for again.
    """
    out, unseen = [], np.arange(len(n))
    while len(unseen) > 1:
        reached, unseen = [unseen[0]], unseen[1:]
        while reached and len(unseen):
            at = reached.pop()
            size = n[unseen]
            fits = unseen[(labels[unseen] != labels[at])
                          & (np.minimum(size, n[at]) * den >= np.maximum(size, n[at]) * num)]
            if not len(fits):
                continue
            alive, _ = posterior_survivors(values[fits], np.broadcast_to(values[at], (len(fits), values.shape[1])), limits)
            if len(alive):
                near = fits[alive]
                out += [(at, i) for i in near]
                reached += list(near)
                unseen = np.setdiff1d(unseen, near, assume_unique=True)
    return out


def cell_links(labels: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links between full sets that join all labels which links join: places in the cell."""
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.cumsum(sizes) - sizes
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    has = np.zeros(len(numbers), bool)
    labels, out = np.unique(labels, return_inverse=True)[1], []
    for x in range(len(sets) - 1):
        others = np.arange(x + 1, len(sets))
        size = sizes[others]
        others = others[(labels[others] != labels[x])
                        & (np.minimum(size, sizes[x]) * den >= np.maximum(size, sizes[x]) * num)]
        if not len(others):
            continue
        size = sizes[others]
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(starts[others] - first, size)
        own = numbers[starts[x]:starts[x] + sizes[x]]
        has[own] = True
        common = np.add.reduceat(has[numbers[at]], first, dtype=np.int64)
        has[own] = False
        for y in others[den * common >= num * (sizes[x] + size - common)]:
            if labels[y] != labels[x]:
                out.append((x, y))
                labels[labels == labels[y]] = labels[x]
    return out


def _each_cell(frame: pd.DataFrame, pairs) -> pd.DataFrame:
    """Links ``a, b`` between the ids of a frame's cells; ``pairs`` gives those of a cell by place."""
    frame = frame.sort_values(["cell", "rep"], ignore_index=True)
    reps, cells = frame["rep"].to_numpy(), frame["cell"].to_numpy()
    borders = np.flatnonzero(np.diff(cells)) + 1
    found = [(reps[begin + a], reps[begin + b])
             for begin, end in zip([0, *borders], [*borders, len(cells)]) if end - begin > 1
             for a, b in pairs(frame.iloc[begin:end])]
    ends = np.array(found, np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": ends.min(axis=1), "b": ends.max(axis=1)})


def _forests(num: int, den: int, limits, n_hashes: int):
    def pairs(cell: pd.DataFrame) -> list[tuple[int, int]]:
        values = np.frombuffer(b"".join(cell["sig"]), np.uint16).reshape(-1, n_hashes)
        return cell_forest(cell["root"].to_numpy(), cell["n"].to_numpy(), values, num, den, limits)
    return lambda frame: _each_cell(frame, pairs)


def _cell_links(num: int, den: int):
    def pairs(cell: pd.DataFrame) -> list[tuple[int, int]]:
        return cell_links(cell["root"].to_numpy(), [np.frombuffer(s, np.uint64) for s in cell["shingles"]], num, den)
    return lambda frame: _each_cell(frame, pairs)


def open_clusters(unsettled: DataFrame, classes: DataFrame, labels: DataFrame, num: int, den: int, limits,
                  n_hashes: int) -> DataFrame:
    """``rep, cluster`` of the classes that the posterior leaves a pair of another label.

    ``unsettled`` has the members ``rep`` of every bucket ``key`` and their number ``held``. Buckets of
    the same members are compared once.
    """
    blocks = F.ceil(F.col("held") / BLOCK_MEMBERS)
    cells = (unsettled.withColumn("cell", F.explode(paired_blocks(F.col("rep"), blocks)))
             .groupBy("key", "cell").agg(F.array_sort(F.collect_set("rep")).alias("members"))
             .select("members").distinct())
    cells = work_table(cells.select(F.xxhash64("members").alias("cell"), F.explode("members").alias("rep")), "cells")
    bins = cells.count() // BIN_MEMBERS + 1
    members = (cells.join(classes.select("rep", "n", "sig"), "rep").join(labels.toDF("rep", "root"), "rep", "left")
               .select(F.pmod("cell", F.lit(bins)).alias("bin"), "cell", "rep", F.coalesce("root", "rep").alias("root"),
                       "n", "sig"))
    forest = members.groupBy("bin").applyInPandas(_forests(num, den, limits, n_hashes), "a long, b long")
    return components(forest).toDF("rep", "cluster")


def links_across(clusters: DataFrame, classes: DataFrame, labels: DataFrame, texts: DataFrame, length: int,
                 num: int, den: int) -> DataFrame:
    """Links ``a < b`` of the clusters' full sets that join all labels which links join."""
    placed = work_table(clusters.join(classes.select("rep", "n"), "rep").join(labels.toDF("rep", "root"), "rep", "left")
                        .withColumn("root", F.coalesce("root", "rep")), "clusters")
    sizes = placed.groupBy("cluster").agg(F.sum("n").alias("held"), F.count(F.lit(1)).alias("_n"))
    cells = attach_groups(placed, sizes, ["cluster"], placed.count())
    cells = work_table(cells.withColumn("block", F.explode(
        paired_blocks(F.col("rep"), F.ceil(F.col("held") / BLOCK_SHINGLES))))
        .select("rep", "root", "n", F.xxhash64("cluster", "block").alias("cell")), "cluster_cells")
    bins = (cells.agg(F.sum("n")).first()[0] or 0) // BIN_SHINGLES + 1
    ids = placed.select(F.col("rep").alias("id")).distinct()
    ids = F.broadcast(ids) if small_enough(ids, 2_000_000) else ids
    sets = texts.join(ids, "id", "left_semi").mapInPandas(_sets(length), "id long, shingles binary")
    members = (cells.join(sets.filter(F.length("shingles") > 0).withColumnRenamed("id", "rep"), "rep")
               .select(F.pmod("cell", F.lit(bins)).alias("bin"), "cell", "rep", "root", "shingles"))
    return members.groupBy("bin").applyInPandas(_cell_links(num, den), "a long, b long").distinct()


def _with_least(edges: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """Edges and the smallest neighbour of their ``u``; a vertex may have very many edges."""
    if n <= BROADCAST_ROWS:
        return edges.join(F.broadcast(least.drop("_n")), "u")
    return attach_groups(edges, least, ["u"], 2 * n)


def forest_labels(links: DataFrame) -> DataFrame:
    """``vertex, label`` of links ``a < b`` with one ``a`` for each ``b``: an ancestor of the vertex."""
    parent = links.select("a", "b")
    known = F.broadcast(parent) if small_enough(parent, 2_000_000) else parent
    up = parent.select(F.col("b").alias("vertex"), F.col("a").alias("label"))
    for _ in range(2):
        up = (up.join(known, F.col("label") == F.col("b"), "left")
              .select("vertex", F.coalesce("a", "label").alias("label")))
    return up


def components(edges: DataFrame) -> DataFrame:
    """Smallest vertex of each component, for every vertex of an edge: ``vertex, root``.

    Alternates linking larger neighbours to the smallest one and smaller neighbours to the
    smallest one until every edge points at a root; the number of rounds grows with the
    logarithm of the longest path.
    """
    edges = work_table(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                                     F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
        n, mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, mark) == state:
            return (edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
                    .unionByName(edges.select("v", "v").toDF("vertex", "root").distinct()))
        state = (n, mark)
        least = least.withColumn("m", F.least("m", "u"))
        outward = (_with_least(both, least, n).filter("v > u")
                   .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        inward = outward.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
        joined = _with_least(outward, inward, n)
        edges = work_table(joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                           .unionByName(inward.select("u", F.col("m").alias("v"))).distinct(), "edges")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, num: int = 4, den: int = 5, bands: int = BANDS,
                    rows: int = ROWS, compared: int = COMPARED, batch: int = BATCH,
                    miss: float = MISS) -> DataFrame:
    """One row per document: ``<id>, n_shingles, component_id, kept``.

    Documents with ``den * |common| >= num * |union|`` are linked; ``component_id`` is the
    smallest id that links lead to, and ``kept`` marks the document that has it.
    """
    limits = least_matches(num / den, miss, compared, batch)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    features = work_table(texts.mapInPandas(
        _features(shingle, bands, rows, compared),
        "id long, n long, set_a long, set_b long, sig binary, band_keys binary"), "features")
    alive = features.filter("n > 0 and id is not null")
    classes = work_table(alive.groupBy("set_a", "set_b").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"),
        F.first("band_keys").alias("band_keys"), F.count(F.lit(1)).alias("_n")), "classes")
    # Pairs within buckets: the band's number and values make its key.
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(
        i, F.col("band_keys").substr(i * KEY_BYTES + 1, F.lit(KEY_BYTES))))
    placed = classes.select("rep", "n", F.explode(keys).alias("key"))
    buckets = (placed.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"),
                                         F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    hits = work_table(attach_groups(placed, buckets, ["key"], bands * classes.count()), "hits")
    hubs = (hits.select("rep", F.explode(F.array("low", "high")).alias("hub")).filter("rep <> hub")
            .select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct())
    near = likely(hubs, classes, num, den, limits, compared)
    best = Window.partitionBy("b").orderBy(F.desc("share"), "a")
    first = work_table(near.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1")
                       .select("a", "b"), "hub_pairs")
    links = work_table(verified(first, texts, shingle, num, den), "links")
    found = work_table(forest_labels(links), "labels")
    # Buckets that still hold more than one component.
    members = (hits.select("key", "rep")
               .join(found.toDF("rep", "root"), "rep", "left")
               .withColumn("root", F.coalesce("root", "rep")))
    open_keys = (members.groupBy("key").agg(F.min("root").alias("_x"), F.max("root").alias("_y"),
                                            F.count(F.lit(1)).alias("_n")).filter("_x <> _y")
                 .select("key", "_n", F.col("_n").alias("held")))
    unsettled = attach_groups(members, open_keys, ["key"], hits.count())
    clusters = open_clusters(unsettled, classes, found, num, den, limits, compared)
    # Components of the labels: by the links across them, and by links that labels still have.
    rest = work_table(links_across(clusters, classes, found, texts, shingle, num, den), "rest")
    across = rest
    for end in ("a", "b"):
        across = (across.join(found.toDF("_v", "_label"), F.col(end) == F.col("_v"), "left")
                  .withColumn(end, F.coalesce("_label", end)).drop("_v", "_label"))
    onward = found.select(F.col("label").alias("b")).distinct().join(links, "b").select("a", "b")
    roots = components(across.unionByName(onward))
    roots = F.broadcast(roots) if small_enough(roots, 2_000_000) else roots
    grouped = (classes.select("set_a", "set_b", "rep", "_n")
               .join(found.toDF("rep", "label"), "rep", "left")
               .withColumn("label", F.coalesce("label", "rep"))
               .join(roots, F.col("label") == F.col("vertex"), "left")
               .select("set_a", "set_b", F.coalesce("root", "label").alias("root"), "_n"))
    member = alive.select("id", "n", "set_a", "set_b")
    linked = attach_groups(member, grouped, ["set_a", "set_b"], features.count()).select("id", "n", "root")
    alone = features.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("root"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("root").alias("component_id"),
        F.coalesce(F.col("id") == F.col("root"), F.lit(True)).alias("kept"))


def _own_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with ``_own``: the id, or a new one beyond all ids for further texts under the same id."""
    marked = docs.withColumn("_text", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    first = marked.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.min("_text").alias("_first"), F.max("_text").alias("_last"))
    several = work_table(first.filter("_first <> _last").select("_id", "_first"), "repeated_ids")
    if several.isEmpty():
        return docs.withColumn("_own", F.col(id_col).cast("long"))
    last = docs.agg(F.max(id_col)).first()[0]
    further = work_table(
        marked.join(several, F.col(id_col) == F.col("_id")).filter("_text <> _first")
        .select("_id", F.col("_text").alias("_further")).distinct()
        .withColumn("_new", F.lit(last + 1) + F.monotonically_increasing_id()), "further_texts")
    return (marked.join(further, (F.col(id_col) == F.col("_id")) & (F.col("_text") == F.col("_further")), "left")
            .withColumn("_own", F.coalesce("_new", F.col(id_col).cast("long"))).select(*docs.columns, "_own"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kinds) -> DataFrame:
    """The documents without those that repeat an earlier one, all columns unchanged.

    Rows without an id stay. Rows that share an id but not their text are documents of their own.
    A kept row that occurs more than once, with the same id and text, stays once.
    """
    own = _own_ids(docs, id_col, text_col)
    groups = near_duplicates(own, id_col="_own", text_col=text_col, **kinds)
    gone = (groups.groupBy("_own").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
            .filter("not kept or (n > 1 and _own is not null)"))
    gone = work_table(gone, "repeated")
    ids = F.broadcast(gone) if small_enough(gone, 2_000_000) else gone
    again = own.join(ids.filter("kept").select("_own"), "_own", "left_semi")
    return (own.join(ids.select("_own"), "_own", "left_anti").select(*docs.columns)
            .unionByName(again.dropDuplicates(["_own"]).select(*docs.columns)))


def op3_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents by two-word shingles at a similarity of 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
