"""Quality classifier from weak labels.

Seven heuristics vote on every document: good, bad or no opinion. Their votes form at most
3**7 patterns; Spark counts the patterns over all documents, and expectation-maximisation on
that bounded table estimates how often each heuristic votes what on good and on bad documents.
The posterior of a document's pattern is its weak label. A linear scorer over hashed tokens
(words, and their shapes: letter case, digits and marks) learns from weak labels weighted by
their posteriors, on about ``TRAINING_ROWS`` documents picked by a hash of their ids, and scores
every document.

Nulls and edges: a null text is an empty one; documents without words have no tokens and score
by the intercept; repeated rows repeat; with fewer than two training documents, or one class
only, the posterior itself is the score. Column names must not begin with ``_weak``.
"""
from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import WORD, table, work_table

GOOD, BAD, SILENT = 1, -1, 0
TRAINING_ROWS, FEATURES, ROUNDS = 20_000, 1 << 15, 200
#: Documents below this score are rejected.
KEPT_FROM = 0.5


def measures(text: Column) -> dict[str, Column]:
    """Numbers that the heuristics look at; a null text is an empty one."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    counted = {"words": F.size(words), "distinct": F.size(F.array_distinct(words)),
               "chars": F.length(text)}
    for name, pattern in (("symbols", r"[#*$%&|<>]"), ("digits", r"[0-9]"), ("marks", r"!"),
                          ("ends", r"[.!?](?=\s|$)")):
        counted[name] = F.regexp_count(text, F.lit(pattern))
    # Dense kinds are counted by what is left without the others: regexp_count lists every match.
    letters = F.regexp_replace(text, r"\P{L}+", "")
    counted["letters"] = F.length(letters)
    counted["upper"] = F.length(F.regexp_replace(letters, r"\P{Lu}+", ""))
    return counted


def votes(m: dict[str, Column]) -> Column:
    """One vote of each heuristic, in a fixed order."""
    def vote(bad: Column, good: Column) -> Column:
        return F.when(m["words"] == 0, SILENT).when(bad, BAD).when(good, GOOD).otherwise(SILENT)

    n, chars = m["words"], F.greatest(m["chars"], F.lit(1))
    per_word = m["letters"] / F.greatest(n, F.lit(1))
    return F.array(
        vote(m["symbols"] > 0.1 * n, m["symbols"] == 0),
        vote(m["upper"] > 0.5 * m["letters"], m["upper"] < 0.2 * m["letters"]),
        vote((n >= 20) & (m["distinct"] < 0.2 * n), (n >= 20) & (m["distinct"] > 0.35 * n)),
        vote(n < 5, n >= 50),
        vote((n >= 20) & (m["ends"] > 0.4 * n) | (m["marks"] > 0.1 * n), m["ends"] > 0.02 * n),
        vote((per_word < 2) | (per_word > 12), per_word.between(3, 10)),
        vote(m["digits"] > 0.2 * chars, m["digits"] < 0.05 * chars)).cast("array<int>")


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of being good for each pattern, and P(vote | class) of each heuristic.

    Starts from the majority; heuristics are taken to be independent given the class, and no
    opinion says nothing.
    """
    kinds = np.array([BAD, GOOD])
    is_vote = patterns[:, :, None] == kinds  # pattern, heuristic, vote
    posterior = np.clip(0.5 + patterns.sum(axis=1) / (2.0 * patterns.shape[1]), 0.05, 0.95)
    chance = np.empty((2, patterns.shape[1], 2))
    for _ in range(rounds):
        share = np.stack([1 - posterior, posterior]) * counts
        for c in (0, 1):  # smoothed, so that an unseen vote rules nothing out
            seen = np.einsum("p,phv->hv", share[c], is_vote) + 1
            chance[c] = seen / seen.sum(axis=1, keepdims=True)
        prior = (share.sum(axis=1) + 1) / (counts.sum() + 2)
        logs = np.einsum("phv,chv->cp", is_vote, np.log(chance)) + np.log(prior)[:, None]
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    return posterior, chance


def tokens(text: Column) -> Column:
    """Words and their shapes, to be hashed."""
    text = F.coalesce(text, F.lit(""))
    shape = text
    for pattern, by in ((r"\p{Lu}+", "A"), (r"\p{Ll}+", "a"), (r"[0-9]+", "0")):
        shape = F.regexp_replace(shape, pattern, by)
    return F.concat(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
                    F.transform(F.regexp_extract_all(shape, F.lit(WORD), F.lit(0)),
                                lambda s: F.concat(F.lit(" "), F.left(s, F.lit(16)))))


def features(docs: DataFrame, text_col: str) -> DataFrame:
    hashed = HashingTF(numFeatures=FEATURES, inputCol="_weak_tokens", outputCol="_weak_counts")
    unit = Normalizer(inputCol="_weak_counts", outputCol="_weak_features")
    return unit.transform(hashed.transform(docs.withColumn("_weak_tokens", tokens(F.col(text_col))))).drop(
        "_weak_tokens", "_weak_counts")


def classify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             training_rows: int = TRAINING_ROWS) -> DataFrame:
    """One row per document: ``<id>, votes, weak_label, score, kept``."""
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_weak_text"))
    found = measures(F.col("_weak_text"))
    measured = texts.select("*", *[c.alias(f"_weak_{n}") for n, c in found.items()])
    voted = measured.select(*texts.columns, votes({n: F.col(f"_weak_{n}") for n in found}).alias("votes"))
    counted = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3**7 rows
    n_rows = sum(row["n"] for row in counted)
    counted.sort(key=lambda row: row["votes"])
    patterns = np.array([row["votes"] for row in counted])
    posterior, _ = estimate(patterns, np.array([row["n"] for row in counted], float)) if counted else ([], None)
    spark = docs.sparkSession
    labels = F.broadcast(spark.createDataFrame(
        [(row["votes"], float(p)) for row, p in zip(counted, posterior)], "votes array<int>, weak_label double"))
    labelled = voted.join(labels, "votes")
    # A hash of the id picks about so many rows; all of them when there are fewer.
    share = min(1.0, training_rows / max(1, n_rows))
    drawn = F.pmod(F.xxhash64(id_col, F.lit("training")), F.lit(1_000_000)) < int(share * 1_000_000)
    picked = features(labelled.filter(drawn), "_weak_text").select("weak_label", "_weak_features")
    both = work_table(picked.select("_weak_features", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("weak_label").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("weak_label")).alias("weight")))).alias("x"))
        .select("_weak_features", "x.label", "x.weight").filter("weight > 0.001"), "weak_labels")
    if both.select("label").distinct().count() < 2:
        scored = labelled.withColumn("score", F.col("weak_label"))
    else:
        model = LogisticRegression(featuresCol="_weak_features", labelCol="label", weightCol="weight",
                                   regParam=1e-5, maxIter=50, probabilityCol="_weak_p",
                                   rawPredictionCol="_weak_raw", predictionCol="_weak_pred").fit(both)
        scored = model.transform(features(labelled, "_weak_text")).withColumn(
            "score", vector_to_array("_weak_p")[1])
    return scored.select(id_col, "votes", "weak_label", "score", (F.col("score") >= KEPT_FROM).alias("kept"))


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Votes, weak label, score and verdict of every document."""
    return classify(table(spark, sf_dir, "documents"))
