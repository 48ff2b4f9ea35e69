"""Language identification by rank-order profiles of character n-grams.

A language's profile lists its ``TOP`` most frequent n-grams of one to three letters (anything
else is a word border), counted by Spark over all its training texts. A document's own profile
is compared with each: an n-gram at rank i of the one and j of the other is |i - j| out of
place, and one that the language's profile lacks is ``TOP`` out of place. The language with the
smallest total distance wins, ties by name; the score is the share of the largest possible
distance that is left.

Nulls and edges: null texts and texts without a letter are ``und`` with score 0, as is any text
when nothing was learned; a document without an id is held out; whole texts are read and rows
are judged one by one. Column names must not begin with ``_lang``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.llm.common import table, texts_in_pieces

TOP, LONGEST, UNKNOWN = 400, 3, "und"
BORDER = ord("_")
SHIFT = 21  # bits of a code point

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000))
    return _letters[0]


class Grams:
    """n-grams of several texts: ``text`` and ``code``, where codes are dense within the batch."""

    def __init__(self, texts: list[str]):
        joined = "".join(["_" + t.lower() + "_" for t in texts])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(texts)), [len(t.lower()) + 2 for t in texts])
        points = np.where(letters()[points], points, BORDER)
        first = np.ones(len(points), bool)  # of a run of borders of one text
        first[1:] = (points[1:] != BORDER) | (points[:-1] != BORDER) | (owner[1:] != owner[:-1])
        points, owner = points[first], owner[first]
        self.alphabet = np.flatnonzero(np.bincount(points, minlength=1)) if len(points) else np.empty(0, np.int64)
        place = np.zeros(int(points.max()) + 1 if len(points) else 1, np.int64)
        place[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        self.base = len(self.alphabet) + 1
        dense = place[points]
        codes, owners = [], []
        code = dense
        for n in range(1, LONGEST + 1):
            if n > 1:
                code = code[:-1] * self.base + dense[n - 1:]
            whole = owner[:len(code)] == owner[n - 1:]
            if n == 1:
                whole = points != BORDER
            codes.append(code[whole])
            owners.append(owner[:len(code)][whole])
        self.code, self.text = np.concatenate(codes), np.concatenate(owners)

    def packed(self, code: np.ndarray) -> np.ndarray:
        """Codes that mean the same in every batch: code points, the last lowest."""
        out, rest = np.zeros(len(code), np.int64), code.copy()
        for n in range(LONGEST):
            digit = rest % self.base
            out |= np.where(digit > 0, self.alphabet[np.maximum(digit, 1) - 1], 0) << (SHIFT * n)
            rest //= self.base
        return out


def _counted(code: np.ndarray, space: int) -> tuple[np.ndarray, np.ndarray]:
    if space <= 4_000_000:
        counts = np.bincount(code, minlength=1)
        seen = np.flatnonzero(counts)
        return seen, counts[seen]
    return np.unique(code, return_counts=True)


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for begin, end in texts_in_pieces(frame, "text"):
            for lang, part in frame.iloc[begin:end].groupby("lang"):
                grams = Grams(part["text"].tolist())
                code, n = _counted(grams.code, grams.base**LONGEST)
                yield pd.DataFrame({"lang": lang, "gram": grams.packed(code), "n": n})


def profiles(training: DataFrame) -> DataFrame:
    """``lang, gram, rank`` from all training rows ``text, lang``."""
    counts = (training.filter("text is not null and lang is not null")
              .mapInPandas(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (counts.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= TOP)
            .select("lang", "gram", "rank"))


class Profiles:
    """All languages' profiles: distinct n-grams, and a row of ranks for each."""

    def __init__(self, rows: pd.DataFrame):
        self.langs = sorted(rows["lang"].unique())
        self.grams = np.unique(rows["gram"].to_numpy(np.int64))
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            own = rows[rows["lang"] == lang]
            self.ranks[i, np.searchsorted(self.grams, own["gram"])] = own["rank"]

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of each text's nearest language (-1: none) and its score."""
        lang, score = np.full(len(texts), -1), np.zeros(len(texts))
        grams = Grams(texts)
        if not len(grams.code) or not self.langs:
            return lang, score
        # Most frequent first within each text; equal counts by n-gram.
        space = grams.base**LONGEST
        key, n = np.unique(grams.text * space + grams.code, return_counts=True)
        text, code = key // space, key % space
        gram = grams.packed(code)
        order = np.lexsort((gram, -n, text))
        text, gram = text[order], gram[order]
        rank = np.arange(len(text)) - np.searchsorted(text, text) + 1
        text, gram, rank = text[rank <= TOP], gram[rank <= TOP], rank[rank <= TOP]
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        at = np.where(self.grams[at] == gram, at, len(self.grams))
        sizes = np.bincount(text, minlength=len(texts))
        distance = np.empty((len(self.langs), len(texts)))
        for i, ranks in enumerate(self.ranks):
            out = np.where(ranks[at] < 0, TOP, np.abs(rank - ranks[at]))
            distance[i] = np.bincount(text, out, len(texts))
        lettered = sizes > 0
        lang[lettered] = distance[:, lettered].argmin(axis=0)
        score[lettered] = 1 - distance[:, lettered].min(axis=0) / (TOP * sizes[lettered])
        return lang, score


def _predict(model):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = np.array([*model.value.langs, UNKNOWN], object)
        for texts in parts:
            frame = pd.DataFrame({"text": texts.fillna("")})
            found = [model.value.judge(frame["text"].iloc[b:e].tolist()) for b, e in texts_in_pieces(frame, "text")]
            yield pd.DataFrame({"lang": names[np.concatenate([f[0] for f in found])],
                                "score": np.concatenate([f[1] for f in found])})
    return run


def identify(docs: DataFrame, training: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The documents with ``lang_pred`` and ``score``; ``training`` has columns ``text, lang``.

    The profiles, ``TOP`` rows for each language, are broadcast.
    """
    spark = docs.sparkSession
    model = Profiles(profiles(training).toPandas())
    predict = F.pandas_udf(_predict(spark.sparkContext.broadcast(model)), "lang string, score double")
    return (docs.withColumn("_lang", predict(F.col(text_col)))
            .select(*docs.columns, F.col("_lang.lang").alias("lang_pred"), "_lang.score"))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), docs.filter(~held_out()).select("text", "lang"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
