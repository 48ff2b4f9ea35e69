"""Exact top-k inner products by aggregation of sorted lists without random access.

Queries and candidates are hashed into blocks, and every query block meets every candidate
block in a task of its own. There each component of the candidates is a sorted list, read for
all queries of the block at once: from its large end where a query's component is positive,
from its small end where it is negative. What has been read bounds each score from below
(unread entries count as the list's last) and from above (unread entries count as the entry
read last). Reading goes deeper until few candidates can still reach the k-th best lower bound;
the final scores of those are resolved. The best of all blocks are ranked per query.

Components become integers, so scores are exact: 32-bit floats carry them below 2**24, 64-bit
floats below 2**53 and Python integers beyond.

Nulls and edges: vectors that are null, hold a null or non-finite component, or have no id take
no part; a shorter vector counts as padded with zeros; a row that repeats id and vector counts
once; rows that share an id with the query are its own. Fewer than k candidates are all given.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.llm.common import table

K, SCALE = 20, 64
#: Candidates and queries of a block; both times the vector length must fit a task's memory.
CANDIDATES, QUERIES = 4096, 1024
#: Shares of the lists read before bounds are compared, and candidates a query may leave open.
DEPTHS, OPEN = (0.75, 0.9375), 200


def _stacked(vectors: pd.Series, width: int) -> np.ndarray:
    if all(len(v) == width for v in vectors):
        return np.stack(vectors.to_numpy())
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def exact_kind(queries: np.ndarray, candidates: np.ndarray):
    """The narrowest number type in which every partial sum is exact."""
    bound = queries.shape[1] * max(np.abs(queries).max(), 1) * max(np.abs(candidates).max(), 1)
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object


def contenders(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Which candidates may be among a query's k best; ``own`` marks pairs to leave out."""
    n = len(candidates)
    lists = np.sort(candidates, axis=0)
    rising, falling = np.maximum(queries, 0), np.minimum(queries, 0)
    open_, best = ~own, np.full(len(queries), -np.inf)
    for depth in DEPTHS:
        read = max(1, int(n * depth))
        top, bottom = lists[n - read], lists[read - 1]
        lower = (rising @ np.where(candidates >= top, candidates, lists[0]).T
                 + falling @ np.where(candidates <= bottom, candidates, lists[-1]).T)
        lower[own] = -np.inf
        if n > k:
            best = np.maximum(best, np.partition(lower, n - k, axis=1)[:, n - k])
        upper = rising @ np.maximum(candidates, top).T + falling @ np.minimum(candidates, bottom).T
        open_ &= upper >= best[:, None]
        if open_.sum() <= OPEN * len(queries):
            break
    return open_


def best_pairs(query_ids, queries, ids, candidates, k: int) -> pd.DataFrame:
    """The k best candidates of each query in a block, with final scores; ties to smaller ids."""
    kind = exact_kind(queries, candidates)
    own = query_ids[:, None] == ids[None, :]
    if kind is object:
        open_ = ~own
        queries, candidates = (np.array([[int(x) for x in row] for row in m], object) for m in (queries, candidates))
    else:
        queries, candidates = queries.astype(kind), candidates.astype(kind)
        open_ = contenders(queries, candidates, own, k)
    row, column = np.nonzero(open_)
    scores = []
    for begin in range(0, len(row), 100_000):
        part = slice(begin, begin + 100_000)
        scores.append((queries[row[part]] * candidates[column[part]]).sum(axis=1).astype(np.int64))
    score = np.concatenate(scores) if scores else np.empty(0, np.int64)
    order = np.lexsort((ids[column], -score, row))
    row, column, score = row[order], column[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < k
    return pd.DataFrame({"at": row[keep], "vec_id": ids[column[keep]], "score": score[keep]})


def _block(k: int):
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": [], "query_row": [], "vec_id": [], "score": []}, dtype="int64")
        if len(left) and len(right):
            width = max(left["v"].map(len).max(), right["v"].map(len).max())
            found = best_pairs(left["id"].to_numpy(), _stacked(left["v"], width),
                               right["id"].to_numpy(), _stacked(right["v"], width), k)
            at = found.pop("at").to_numpy()
            out = found.assign(query_id=left["id"].to_numpy()[at], query_row=left["row"].to_numpy()[at])
        return out[["query_id", "query_row", "vec_id", "score"]]
    return run


def top_k(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding",
          k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query row's k best other rows."""
    x = F.col(vector_col)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = (vectors.filter(x.isNotNull() & F.col(id_col).isNotNull() & fine)
            .select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
                    F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("double")).alias("v"))
            .withColumn("row", F.xxhash64("v")).dropDuplicates(["id", "v"]))
    n, asking = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    blocks, query_blocks = max(1, -(-n // CANDIDATES)), max(1, -(-asking // QUERIES))

    def dealt(part: DataFrame, own: str, into: int, other: str, times: int) -> DataFrame:
        return (part.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(into)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(times - 1)))))

    left = dealt(rows.filter("asks"), "qb", query_blocks, "cb", blocks)
    right = dealt(rows, "cb", blocks, "qb", query_blocks)
    found = (left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))
             .applyInPandas(_block(k), "query_id long, query_row long, vec_id long, score long"))
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every vector whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM c q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0 GROUP BY 1, 2),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
