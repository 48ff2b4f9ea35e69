"""Stupid-backoff scores from relational n-gram counts.

Documents are gathered into batches, one row each. A batch explodes into its distinct unigrams
and bigrams with their counts there; these are shuffled by hash, so every bucket adds up the
count table of its hashes and joins the totals back to the batches that asked, where scores are
summed per document. A bigram that the whole corpus holds is one entry per batch, not one per
document, so frequent words and word pairs need no salting.

The score of a word after its predecessor is ``c(pair) / c(predecessor)`` if the corpus holds
the pair at least ``LEAST`` times, else ``BACKOFF * c(word) / N``; the first word of a text
scores ``c(word) / N``. A document's score is the mean natural logarithm over its words.

Words have A-Z lower-cased. Nulls and edges: a null or blank text has no words and a null
score; repeated rows count as often as they occur; rows without an id are scored like others;
whole texts are read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import (HASHES, chained, mixed, table, texts_in_pieces, words_of,
                                   work_table)

BACKOFF, LEAST = 0.4, 2
#: Characters of text that a bucket of the count table answers for.
BUCKET_CHARS = 8_000_000


def _gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext
    batch = TaskContext.get().partitionId() << 40
    for frame in frames:
        for begin, end in texts_in_pieces(frame, "text"):
            part = frame.iloc[begin:end]
            texts = part["text"].fillna("").tolist()
            ids = [None if pd.isna(i) else int(i) for i in part["id"]]
            yield pd.DataFrame({"batch": [batch], "ids": [ids], "texts": [squeezed(texts)],
                                "chars": [sum(map(len, texts))], "words": [sum(len(words_of(t)) for t in texts)]})
            batch += 1


def squeezed(texts: list[str]) -> bytes:
    """Texts of a batch as one compressed value: they are stored and shuffled once each."""
    import zstandard
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(texts), *map(len, parts)], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(sizes.tobytes() + b"".join(parts))


def unsqueezed(value: bytes) -> list[str]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(value)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ends = 8 * (n + 1) + np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.int64, n, 8))])
    return [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(ends[:-1], ends[1:])]


def small_numbers(counts: np.ndarray) -> bytes:
    """Counts in a byte each; those from 255 on follow in full."""
    large = counts >= 255
    return np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype(np.int64).tobytes()


def numbers(value: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(value, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(value, np.int64, offset=n)
    return out


class Batch:
    """Unigram and bigram hashes of the texts of a batch, and where each text begins."""

    def __init__(self, texts):
        words = [words_of(t) for t in texts]
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.words = np.fromiter((HASHES[w] for ws in words for w in ws), np.uint64, int(self.sizes.sum()))
        self.ones = mixed(self.words)
        self.pairs = chained(self.words, 2) if len(self.words) > 1 else np.empty(0, np.uint64)
        first = np.zeros(len(self.words), bool)
        starts = np.cumsum(self.sizes) - self.sizes
        first[starts[self.sizes > 0]] = True
        self.first, self.starts = first, starts
        self.inner = ~first[1:]  # pairs that no border of texts divides
        self.hashes, self.counts = np.unique(np.concatenate([self.ones, self.pairs[self.inner]]),
                                             return_counts=True)

    def scores(self, totals: np.ndarray, n: int) -> list[float | None]:
        """Mean log score of each text; ``totals`` are the corpus counts of ``hashes``."""
        if not len(self.words):
            return [None] * len(self.sizes)
        one = totals[np.searchsorted(self.hashes, self.ones)].astype(np.float64)
        logs = np.log(one / n)
        at = np.flatnonzero(self.inner)
        pair = totals[np.searchsorted(self.hashes, self.pairs[at])]
        logs[at + 1] = np.where(pair >= LEAST, np.log(pair / one[at]), np.log(BACKOFF) + logs[at + 1])
        some = self.sizes > 0
        means = np.add.reduceat(logs, self.starts[some]) / self.sizes[some]
        found = iter(means)
        return [float(next(found)) if has else None for has in some]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so a sorted array falls into runs."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _explode(buckets: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for batch, texts in zip(frame["batch"], frame["texts"]):
                grams = Batch(unsqueezed(texts))
                bucket = bucket_of(grams.hashes, buckets)
                cuts = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets))) if len(bucket) else []
                ends = [*cuts[1:], len(bucket)]
                yield pd.DataFrame({
                    "batch": batch, "bucket": bucket[cuts].astype(np.int64),
                    "hashes": [grams.hashes[a:b].tobytes() for a, b in zip(cuts, ends)],
                    "counts": [small_numbers(grams.counts[a:b]) for a, b in zip(cuts, ends)]})
    return run


def _add_up(rows: pd.DataFrame) -> pd.DataFrame:
    """The count table of one bucket, and its totals for each batch that asked."""
    hashes = np.frombuffer(b"".join(rows["hashes"]), np.uint64)
    counts = np.concatenate([numbers(c, len(h) // 8) for c, h in zip(rows["counts"], rows["hashes"])])
    distinct, at = np.unique(hashes, return_inverse=True)
    totals = np.bincount(at, counts, len(distinct)).astype(np.int64)[at]
    ends = np.cumsum([len(h) // 8 for h in rows["hashes"]])
    return pd.DataFrame({"batch": rows["batch"], "bucket": rows["bucket"],
                         "size": [len(h) // 8 for h in rows["hashes"]],
                         "totals": [small_numbers(part) for part in np.split(totals, ends[:-1])]})


def _score(n: int):
    def run(batches: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for batch, ids, texts in zip(batches["batch"], batches["ids"], batches["texts"]):
            own = totals[totals["batch"] == batch].sort_values("bucket")
            grams = Batch(unsqueezed(texts))
            counts = np.concatenate([np.empty(0, np.int64), *(
                numbers(t, size) for t, size in zip(own["totals"], own["size"]))])
            if len(counts) != len(grams.hashes):
                raise ValueError(f"counts of batch {batch} are incomplete")
            parts.append(pd.DataFrame({"id": pd.array(list(ids), "Int64"), "n_words": grams.sizes,
                                       "score": pd.Series(grams.scores(counts, n), dtype="float64")}))
        out = pd.concat(parts) if parts else pd.DataFrame({"id": [], "n_words": [], "score": []})
        out["score"] = out["score"].astype(object).where(out["score"].notna(), None)
        return out
    return run


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """One row per document: ``<id>, n_words, score``."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    batches = work_table(texts.mapInPandas(
        _gather, "batch long, ids array<long>, texts binary, chars long, words long"), "batches")
    chars, words = batches.agg(F.sum("chars"), F.sum("words")).first()
    buckets = max(1, (chars or 0) // bucket_chars)
    exploded = batches.select("batch", "texts").mapInPandas(
        _explode(buckets), "batch long, bucket long, hashes binary, counts binary")
    totals = exploded.groupBy("bucket").applyInPandas(_add_up, "batch long, bucket long, size long, totals binary")
    found = (batches.select("batch", "ids", "texts").groupBy("batch").cogroup(totals.groupBy("batch"))
             .applyInPandas(_score(words or 0), "id long, n_words long, score double"))
    return found.withColumnRenamed("id", id_col)


def op6_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Mean stupid-backoff log score of every document under the counts of all documents."""
    found = score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round("score", 6).alias("score"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
p AS (SELECT doc_id, i, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS u FROM w),
c1 AS (SELECT w, count(*) AS c FROM w GROUP BY w),
c2 AS (SELECT u, w, count(*) AS c FROM p WHERE u IS NOT NULL GROUP BY u, w),
s AS (
  SELECT p.doc_id, CASE
    WHEN p.u IS NULL THEN ln(a.c / (SELECT count(*) FROM w))
    WHEN b.c >= 2 THEN ln(b.c / o.c)
    ELSE ln(0.4) + ln(a.c / (SELECT count(*) FROM w)) END AS l
  FROM p JOIN c1 a ON p.w = a.w LEFT JOIN c1 o ON p.u = o.w
  LEFT JOIN c2 b ON p.u = b.u AND p.w = b.w)
SELECT d.doc_id AS doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, round(avg(s.l), 6) AS score
FROM d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id, d.ws
"""
