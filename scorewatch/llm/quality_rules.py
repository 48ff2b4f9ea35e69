"""Quality rules: text statistics and n-gram perplexity in language-specific bands.

A modified Kneser-Ney model of character five-grams is counted by Spark over all documents, one
for each value of the language column. Code points are taken as they are: a five-gram is two
longs that hold its 21-bit code points, so nothing is folded and the model grows with the corpus.
The model is kept in sorted hash arrays, one row for each language and hash bucket. An n-gram's bucket
is that of its third and fourth code points, so that a five-gram, the shorter ones it ends in down to
three, and all their contexts share a bucket: those orders are counted and smoothed inside one.
Bigrams and single code points are small tables joined to the buckets that use them; no model is broadcast.
Documents are dealt by a hash into batches of one language and half; a batch asks each bucket for its
distinct five-grams once, and the answers, three bytes a figure, meet its texts by batch.

Each language has two models, of the texts whose checksum is even and odd, and a text is scored
by the one that it (with its exact copies) is not part of: else long n-grams make every text look
familiar. A document has two log-perplexities, of order five (``log_perplexity``), which sees word
borders and word order, and of a trigram model of the same counts, which sees spelling. It is rejected
if either lies outside its language's band; a band reaches so many robust standard deviations
(from the quartiles of all its documents) to either side of the median. Where all texts of a language
have checksums of one kind there is no other model: its log-perplexities are null and no band rejects.
No character's figure exceeds 64.

Nulls and edges: a null or blank text has no words and fails the base rules; a null language is
one of its own; rows are judged one by one, so repeated rows repeat; whole texts are read. Column
names must not begin with ``_quality``. Rows that are equal in every column share a batch.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.llm.common import HASHES, chained, mixed, small_enough, table, work_table

ORDER, SHORT, POINT, POINTS = 5, 3, 21, 0x110000
ONE, TWO = (1 << POINT) - 1, (1 << 2 * POINT) - 1
#: Characters of a batch, of a language for each of its buckets, held while counting, and of a run.
BATCH_CHARS, BUCKET_CHARS, HELD_CHARS, RUN = 8_000_000, 8_000_000, 16_000_000, 2_000_000
#: Steps of a stored figure and the value that stands for none.
STEPS, NONE = 1 << 18, 0xFFFFFF
#: Robust standard deviations below and above the median: the usual cut for outliers (Iglewicz and Hoaglin).
BELOW, ABOVE = 3.5, 3.5
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\r\v\f"
STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "log_perplexity double, short_perplexity double")
BUCKET = ["lang", "bucket"]
BATCH = ["_quality_lang", "_quality_half", "_quality_batch"]
PERPLEXITIES = ("log_perplexity", "short_perplexity")

def discounts(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and from 3 on, by the modified Kneser-Ney estimate."""
    if min(n1, n2, n3) == 0:  # too few rare n-grams to estimate from
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d, 0.05), i + 0.95) for i, d in enumerate(found))])


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, words in repeated runs of three."""
    if text is None:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return 0, 0, sum(map(text.count, SYMBOLS)), 0, 0
    repeated = 0
    if len(words) >= 4:
        runs = chained(np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words)), 3)
        order = np.argsort(runs, kind="stable")
        same = runs[order[1:]] == runs[order[:-1]]
        if same.any():
            twice = np.zeros(len(words), bool)
            for found in (order[1:][same], order[:-1][same]):
                for i in range(3):
                    twice[found + i] = True
            repeated = int(twice.sum())
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated)


def five_grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of five-grams, one for each character with its four predecessors: its text's number, its place
    among the run's distinct ones, and those as two longs of code points, two in the first and three in the second."""
    pad = "\x00" * (ORDER - 1)
    points = np.frombuffer("".join([pad + t for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(POINTS, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen)
    places = np.zeros(POINTS, np.uint32)
    places[alphabet] = np.arange(len(alphabet))
    sizes = np.array([len(t) + ORDER - 1 for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    for i in range(ORDER - 1):
        owner[begins + i] = -1
    dense = len(alphabet) ** ORDER < 1 << 64  # else places as digits do not fit 64 bits
    for begin in range(ORDER - 1, len(points), RUN):
        end = min(begin + RUN, len(points))
        of = owner[begin:end]
        own = of >= 0
        at = [points[begin - i:end - i] for i in range(ORDER - 1, -1, -1)]
        if dense:
            keys = np.zeros(end - begin, np.uint64)
            for x in at:
                keys *= np.uint64(len(alphabet))
                keys += places[x]
            codes, keys = pd.factorize(keys[own])
            at = []
            for _ in range(ORDER):
                keys, digit = np.divmod(keys, np.uint64(len(alphabet)))
                at.insert(0, alphabet[digit.astype(np.int64)])
            hi, lo = long_pair(at)
        else:
            hi, lo = long_pair([x[own].astype(np.int64) for x in at])
            codes, keys = pd.factorize(gram_keys(hi, lo))
            first = first_of(codes, len(keys))
            hi, lo = hi[first], lo[first]
        yield of[own], codes.astype(np.int32), hi, lo


def long_pair(at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return at[0] << POINT | at[1], at[2] << 2 * POINT | at[3] << POINT | at[4]


def gram_keys(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return mixed(mixed(hi.astype(np.uint64)) + lo.astype(np.uint64))


def half_of(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) & 1


def first_of(codes: np.ndarray, n: int) -> np.ndarray:
    """Where each of the codes 0 to n - 1 stands first."""
    out = np.empty(n, np.int64)
    out[codes[::-1]] = np.arange(len(codes))[::-1]
    return out


class Grams:
    """Distinct five-grams of texts by bucket, their counts, and which of them each character ends."""

    def __init__(self, texts: list[str], buckets: int):
        empty = np.empty(0, np.int64)
        his, los, counts, self.runs, codes = [empty], [empty], [empty], [], []
        for owner, of, hi, lo in five_grams(texts):
            his.append(hi), los.append(lo), counts.append(np.bincount(of, minlength=len(hi)))
            self.runs.append(owner), codes.append(of)
        hi, lo = np.concatenate(his), np.concatenate(los)
        of, keys = pd.factorize(gram_keys(hi, lo))
        total = np.bincount(of, np.concatenate(counts), len(keys)).astype(np.int64)
        first = first_of(of, len(keys))
        hi, lo = hi[first], lo[first]
        bucket = (mixed((lo >> POINT).astype(np.uint64)) >> np.uint64(11)) % np.uint64(buckets)
        order = np.lexsort((hi, lo, bucket))
        self.hi, self.lo, self.counts, self.bucket = hi[order], lo[order], total[order], bucket[order].astype(np.int64)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        place = place[of]
        begins = np.cumsum([len(x) for x in his[1:]]) - [len(x) for x in his[1:]]
        self.codes = [place[int(a) + c] for a, c in zip(begins, codes)]

    def parts(self) -> Iterator[tuple[int, slice]]:
        """Each bucket that has n-grams, and where they are."""
        cuts = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(self.bucket)]):
            yield int(self.bucket[a]), slice(a, b)


def planes(values: np.ndarray, width: int) -> np.ndarray:
    """The low bytes of numbers, byte by byte: sorted code points make long runs."""
    return np.stack([(values >> 8 * i).astype(np.uint8) for i in range(width)])


def joined(value: np.ndarray) -> np.ndarray:
    return sum(plane.astype(np.int64) << 8 * i for i, plane in enumerate(value))


def squeeze(value: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(value)


def unsqueeze(value: bytes, rows: int) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8).reshape(rows, -1)


def stored_grams(hi: np.ndarray, lo: np.ndarray) -> bytes:
    at = [hi >> POINT, hi & ONE, lo >> 2 * POINT, (lo >> POINT) & ONE, lo & ONE]
    return squeeze(np.concatenate([planes(x, 3) for x in at]).tobytes())


def read_grams(value: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = unsqueeze(value, 3 * ORDER)
    at = [joined(raw[3 * i:3 * i + 3]) for i in range(ORDER)]
    return long_pair(at)


def stored_counts(n: np.ndarray) -> bytes:
    return squeeze(planes(n, 8).tobytes())


def read_counts(value: bytes) -> np.ndarray:
    return joined(unsqueeze(value, 8))


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct five-grams of runs of a partition's rows with their counts, by language, half and bucket."""
    held: dict[tuple, list[str]] = {}
    chars: dict[tuple, int] = {}

    def counted(key: tuple) -> pd.DataFrame:
        lang, half, buckets = key
        grams, parts = Grams(held.pop(key), int(buckets)), []
        del chars[key]
        for bucket, at in grams.parts():
            parts.append((lang, bucket, half, stored_grams(grams.hi[at], grams.lo[at]),
                          stored_counts(grams.counts[at])))
        return pd.DataFrame(parts, columns=["lang", "bucket", "half", "grams", "counts"])

    for frame in frames:
        for key, text in zip(zip(frame["lang"], frame["half"], frame["buckets"]), frame["text"]):
            held.setdefault(key, []).append(text)
            chars[key] = chars.get(key, 0) + len(text)
            if chars[key] >= BATCH_CHARS:
                yield counted(key)
            elif sum(chars.values()) >= HELD_CHARS:
                yield counted(max(chars, key=chars.get))
    for key in list(held):
        yield counted(key)


def _shorter(hi: np.ndarray, lo: np.ndarray, n: list[np.ndarray]) -> dict:
    """From distinct five-grams of a bucket and both halves' counts: of each order from three to five the
    contexts and counts of its n-grams, of three also the counts in the texts (first), and each longer
    one's number in the next shorter order (``four``, ``three``)."""
    four, keys = pd.factorize(gram_keys(hi & ONE, lo))
    first4 = first_of(four, len(keys))
    three, shorts = pd.factorize(lo[first4])
    n4 = [np.bincount(four, x > 0, len(keys)) for x in n]
    n3 = [np.bincount(three, x > 0, len(shorts)) for x in n4]
    raw = [np.bincount(three[four], x, len(shorts)) for x in n]
    return {"three": three, "four": four, "shorts": shorts, "n": [raw, n3, n4, n],
            "context": [shorts >> POINT, shorts >> POINT, gram_keys(hi & ONE, lo >> POINT)[first4],
                        gram_keys(hi, lo >> POINT)]}


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket's n-grams with both halves' counts, how many counts are 1 to 4 and positive in each
    order, and its bigrams with the number of their distinct predecessors."""
    read = [read_grams(g) for g in rows["grams"]]
    hi, lo = (np.concatenate([r[i] for r in read]) for i in (0, 1))
    of, keys = pd.factorize(gram_keys(hi, lo))
    halves = np.repeat(rows["half"].to_numpy(), [len(r[0]) for r in read])
    counts = np.concatenate([read_counts(c) for c in rows["counts"]])
    n = [np.bincount(of[halves == i], counts[halves == i], len(keys)).astype(np.int64) for i in (0, 1)]
    first = first_of(of, len(keys))
    order = np.lexsort((hi[first], lo[first]))
    hi, lo, n = hi[first][order], lo[first][order], [x[order] for x in n]
    found = _shorter(hi, lo, n)
    rare = [int((x == i).sum()) for level in found["n"] for x in level for i in (1, 2, 3, 4)]
    rare += [int((x > 0).sum()) for x in n]
    two, pairs = pd.factorize(found["shorts"] & TWO)
    seen = [np.bincount(two, x > 0, len(pairs)).astype(np.int64) for x in found["n"][1]]
    return pd.DataFrame({"lang": rows["lang"].iloc[:1], "bucket": rows["bucket"].iloc[:1], "grams": [stored_grams(hi, lo)],
                         "n0": [stored_counts(n[0])], "n1": [stored_counts(n[1])], "rare": [rare],
                         "lo": [pairs.tolist()], "m0": [seen[0].tolist()], "m1": [seen[1].tolist()]})


def smoothed(n: np.ndarray, context: np.ndarray, taken: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities of an order's n-grams, given its discounts and the shorter ones' probabilities."""
    of, keys = pd.factorize(context)
    total = np.bincount(of, n, len(keys))
    off = taken[np.minimum(n, 3).astype(np.int64)]
    weight = np.bincount(of, off, len(keys))[of]
    total = total[of]
    return np.where(total > 0, (n - off + weight * lower) / np.maximum(total, 1), lower)


def _modelled(counts: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """One bucket of a language's model: sorted hashes, and each half's negative log probabilities."""
    if not len(counts):
        return pd.DataFrame({c: [] for c in ("lang", "bucket", "hashes", "p0", "s0", "p1", "s1")})
    row = counts.iloc[0]
    hi, lo = read_grams(row["grams"])
    found = _shorter(hi, lo, [read_counts(row["n0"]), read_counts(row["n1"])])
    at = pd.Index(pairs["lo"].to_numpy()).get_indexer(found["shorts"] & TWO)
    if (at < 0).any():
        raise ValueError(f"bigrams of language {row['lang']!r} are incomplete")
    rare, out = np.asarray(row["all_rare"]), {}
    three, four = found["three"], found["four"]
    hashes = gram_keys(hi, lo)
    order = np.argsort(hashes)
    for half in (0, 1):
        def level(i: int, lower: np.ndarray) -> np.ndarray:
            taken = discounts(*rare[8 * i + 4 * half:8 * i + 4 * half + 4].astype(float))
            return smoothed(found["n"][i][half], found["context"][i], taken, lower)

        two = pairs[f"p{half}"].to_numpy()[at]
        short, p3 = level(0, two), level(1, two)
        p4 = level(2, p3[three])
        p5 = level(3, p4[four])
        for name, p in (("p", p5), ("s", short[three][four])):
            p = p if rare[32 + half] else np.full(len(p), np.nan)
            out[f"{name}{half}"] = [(-np.log(p))[order].astype(np.float32).tobytes()]
    return pd.DataFrame({"lang": [row["lang"]], "bucket": [row["bucket"]], "hashes": [hashes[order].tobytes()], **out})


def _rare(half: int) -> list[Column]:
    """Sum of a half's counts, and how many are 1, 2, and 3 or more."""
    n = F.col(f"n{half}")
    return [n, *[F.when(n == i, 1).otherwise(0) for i in (1, 2)], F.when(n >= 3, 1).otherwise(0)]


def _discounts(level: DataFrame) -> DataFrame:
    """``lang`` and per half the discounts ``d<half>`` of an order, with its totals ``all<half>``."""
    def figures(half: int) -> list[Column]:
        n = F.col(f"n{half}")
        sums = [F.sum(x).cast("double") for x in _rare(half)]
        seen = [F.sum(F.when(n == i, 1).otherwise(0)).cast("double") for i in (1, 2, 3, 4)]
        return [F.array(*seen).alias(f"c{half}"), F.array(*sums).alias(f"all{half}")]

    def estimate(half: int) -> Column:
        c = [F.col(f"c{half}")[i] for i in range(4)]
        y = c[0] / (c[0] + 2 * c[1])
        found = [(i + 1) - (i + 2) * y * c[i + 1] / c[i] for i in range(3)]
        cut = [F.least(F.greatest(d, F.lit(0.05)), F.lit(i + 0.95)) for i, d in enumerate(found)]
        return F.when(F.least(*c[:3]) > 0, F.array(*cut)).otherwise(F.array(F.lit(0.5), F.lit(1.0), F.lit(1.5)))

    found = level.groupBy("lang").agg(*figures(0), *figures(1))
    found = work_table(found.select("lang", "all0", "all1", *[estimate(i).alias(f"d{i}") for i in (0, 1)]),
                       "quality_discounts")
    return F.broadcast(found) if small_enough(found) else found


def _smooth(rows: DataFrame, lower: list[Column], context: Window | None) -> list[Column]:
    """Both halves' probabilities of an order's n-grams with counts ``n0, n1``, given the shorter ones'."""
    out = []
    for i in (0, 1):
        n, total, d = F.col(f"n{i}"), F.col(f"all{i}"), F.col(f"d{i}")
        if context is not None:
            total = F.array(*[F.sum(x).over(context).cast("double") for x in _rare(i)])
        taken = F.when(n > 0, F.get(d, F.least(n, F.lit(3)).cast("int") - 1)).otherwise(0.0)
        weight = (d[0] * total[1] + d[1] * total[2] + d[2] * total[3]) / total[0]
        out.append(F.when(total[0] > 0, (n - taken) / total[0] + weight * lower[i]).otherwise(lower[i]))
    return out


def short_probabilities(pairs: DataFrame) -> DataFrame:
    """``lang, lo`` of every bigram and ``p0, p1`` in both halves' models; ``pairs`` has ``lang, lo,
    n0, n1``, the numbers of distinct predecessors."""
    pairs = work_table(pairs, "quality_pairs")
    seen = [F.sum(F.when(F.col(f"n{i}") > 0, 1).otherwise(0)).alias(f"n{i}") for i in (0, 1)]
    last = F.col("lo").bitwiseAND(F.lit(ONE).cast("long")).alias("last")
    ones = pairs.groupBy("lang", last).agg(*seen)
    found = _smooth(ones.join(_discounts(ones), "lang"), [F.lit(1.0 / POINTS)] * 2, None)
    ones = work_table(ones.join(_discounts(ones), "lang").select(
        "lang", "last", *[c.alias(f"_p{i}") for i, c in enumerate(found)]), "quality_points")
    rows = pairs.withColumn("last", last).join(ones, ["lang", "last"]).join(_discounts(pairs), "lang")
    context = Window.partitionBy("lang", F.shiftright("lo", POINT))
    found = _smooth(rows, [F.col("_p0"), F.col("_p1")], context)
    return rows.select("lang", "lo", *[c.alias(f"p{i}") for i, c in enumerate(found)])


def model(texts: DataFrame) -> DataFrame:
    """``lang, bucket, hashes, p0, s0, p1, s1``: each language's models of five-grams and trigrams in sorted
    arrays. ``texts`` has ``lang, half, buckets, text``, no text of it null or empty."""
    counts = work_table(
        texts.mapInPandas(_counted, "lang string, bucket long, half int, grams binary, counts binary")
        .groupBy(*BUCKET).applyInPandas(_merged, "lang string, bucket long, grams binary, n0 binary, n1 binary, "
                                        "rare array<long>, lo array<long>, m0 array<long>, m1 array<long>"),
        "quality_counts")
    pairs = counts.select(*BUCKET, F.inline(F.arrays_zip("lo", "m0", "m1")))
    short = short_probabilities(pairs.groupBy("lang", "lo").agg(F.sum("m0").alias("n0"), F.sum("m1").alias("n1")))
    rare = (counts.select("lang", F.posexplode("rare").alias("at", "n")).groupBy("lang", "at").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "n")))["n"].alias("all_rare")))
    rare = work_table(rare, "quality_rare")
    rare = F.broadcast(rare) if small_enough(rare) else rare
    rows = counts.select(*BUCKET, "grams", "n0", "n1").join(rare, "lang")
    own = pairs.join(short, ["lang", "lo"]).select(
        F.col("lang").alias("own_lang"), F.col("bucket").alias("own_bucket"), "lo", "p0", "p1")
    return work_table(rows.groupBy(*BUCKET).cogroup(own.groupBy("own_lang", "own_bucket")).applyInPandas(
        _modelled, "lang string, bucket long, hashes binary, p0 binary, s0 binary, p1 binary, s1 binary"),
        "quality_model")


def _asked(text_col: str):
    def run(rows: pa.Table) -> pa.Table:
        lang, half, batch, buckets = (rows[c][0].as_py() for c in [*BATCH, "_quality_buckets"])
        grams = Grams([t for t in rows[text_col].to_pylist() if t], buckets)
        parts = [(bucket, stored_grams(grams.hi[at], grams.lo[at])) for bucket, at in grams.parts()]
        return pa.table({"lang": pa.array([lang] * len(parts), pa.string()), "half": pa.array([half] * len(parts), pa.int32()),
                         "batch": pa.array([batch] * len(parts), pa.int64()),
                         "bucket": pa.array([p[0] for p in parts], pa.int64()),
                         "grams": pa.array([p[1] for p in parts], pa.binary())})
    return run


def _answered(asked: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    """A bucket's answers to each batch: its n-grams' figures in the other half's models, in their order."""
    out = []
    if len(asked):
        hashes = np.frombuffer(model["hashes"].iloc[0], np.uint64)
        stored = {c: np.frombuffer(model[c].iloc[0], np.float32) for c in ("p0", "s0", "p1", "s1")}
        for lang, half, batch, bucket, grams in zip(*[asked[c] for c in ("lang", "half", "batch", "bucket", "grams")]):
            keys = gram_keys(*read_grams(grams))
            at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
            if (hashes[at] != keys).any():
                raise ValueError(f"the model of language {lang!r} is incomplete")
            parts = []
            for name in "ps":
                found = stored[f"{name}{1 - half}"][at].astype(np.float64) * STEPS
                whole = np.where(np.isnan(found), NONE, np.minimum(np.rint(found), NONE - 1)).astype(np.int64)
                parts.append(planes(whole, 3))
            out.append((lang, half, batch, bucket, len(keys), squeeze(np.concatenate(parts).tobytes())))
    return pd.DataFrame(out, columns=[*BATCH, "bucket", "size", "figures"])


def _scores(columns: list[str], text_col: str):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows.select(columns).append_column("_quality", pa.array([], _STATS_TYPE))
        texts = rows[text_col].to_pylist()
        stats = pd.DataFrame([text_stats(t) for t in texts], columns=[
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], dtype="int64")
        texts = [t or "" for t in texts]
        grams = Grams(texts, rows["_quality_buckets"][0].as_py())
        own = answers.select(["bucket", "size", "figures"]).to_pandas().sort_values("bucket")
        if own["size"].sum() != len(grams.lo):
            raise ValueError("answers of a batch are incomplete")
        found = np.zeros((2, len(texts)))
        if len(own):
            raw = [unsqueeze(x, 6) for x in own["figures"]]
            for i in (0, 1):
                figures = np.concatenate([joined(x[3 * i:3 * i + 3]) for x in raw])
                figures = np.where(figures == NONE, np.nan, figures / STEPS)
                for owner, codes in zip(grams.runs, grams.codes):
                    found[i] += np.bincount(owner, figures[codes], len(texts))
        sizes = np.array([len(t) for t in texts], np.float64)
        found = np.divide(found, sizes, out=np.full(found.shape, np.nan), where=sizes > 0)
        arrays = [pa.array(stats[c]) for c in stats] + [pa.array(x, from_pandas=True) for x in found]
        quality = pa.StructArray.from_arrays(arrays, fields=list(_STATS_TYPE))
        return rows.select(columns).append_column("_quality", quality)
    return run


_STATS_TYPE = pa.struct([(part.split()[0], pa.int64() if part.endswith("long") else pa.float64())
                         for part in STATS.split(", ")])


def _language(lang_col: str) -> Column:
    return F.coalesce(F.col(lang_col), F.lit(""))


def dealt(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """The documents with language, half, batch and the number of buckets of their language."""
    half = F.coalesce(F.crc32(F.col(text_col).cast("binary")).bitwiseAND(F.lit(1).cast("long")), F.lit(0)).cast("int")
    rows = docs.withColumns({BATCH[0]: _language(lang_col), BATCH[1]: half})
    chars = [F.sum(F.when(F.col(BATCH[1]) == i, F.length(text_col)).otherwise(0)) for i in (0, 1)]
    sizes = rows.groupBy(BATCH[0]).agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(f"_quality_chars{i}")
                                         for i, c in enumerate(chars)])
    each = [F.col(f"_quality_chars{i}") for i in (0, 1)]
    sizes = work_table(sizes.select(
        BATCH[0], ((each[0] + each[1]) / BUCKET_CHARS + 1).cast("long").alias("_quality_buckets"),
        F.array(*[(c / BATCH_CHARS + 1).cast("long") for c in each]).alias("_quality_batches")), "quality_sizes")
    plain = [f.name for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]
    rows = rows.join(F.broadcast(sizes) if small_enough(sizes) else sizes, BATCH[0])
    batch = F.pmod(F.xxhash64(*[F.col(c) for c in plain]), F.get("_quality_batches", F.col(BATCH[1])))
    return rows.withColumn(BATCH[2], batch).drop("_quality_batches")


def scored(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", keep_text: bool = True) -> DataFrame:
    """The documents and a struct ``_quality`` of their statistics and log-perplexities."""
    columns = [c for c in docs.columns if keep_text or c != text_col]
    rows = dealt(docs, text_col, lang_col)
    found = model(rows.filter(F.length(text_col) > 0).select(
        F.col(BATCH[0]).alias("lang"), F.col(BATCH[1]).alias("half"), F.col("_quality_buckets").alias("buckets"),
        F.col(text_col).alias("text")))
    if not keep_text:
        rows = rows.withColumnRenamed(text_col, "_quality_text")
    text = text_col if keep_text else "_quality_text"
    rows = rows.select(*columns, *([] if keep_text else [text]), *BATCH, "_quality_buckets")
    asked = rows.groupBy(*BATCH).applyInArrow(_asked(text), "lang string, half int, batch long, bucket long, grams binary")
    answers = asked.groupBy(*BUCKET).cogroup(found.groupBy(*BUCKET)).applyInPandas(
        _answered, "_quality_lang string, _quality_half int, _quality_batch long, bucket long, size long, figures binary")
    result = T.StructType([*[rows.schema[c] for c in columns], T.StructField(
        "_quality", T.StructType.fromDDL(STATS))])
    return rows.groupBy(*BATCH).cogroup(answers.groupBy(*BATCH)).applyInArrow(_scores(columns, text), result)


def base_failed(stats: str = "_quality") -> Column:
    q = F.col(stats)
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def bands(scores: DataFrame, *, lang_col: str = "lang", below: float = BELOW,
          above: float = ABOVE) -> DataFrame:
    """``_quality_lang`` and ``_quality_low, _quality_high`` of both log-perplexities, from the
    documents that pass the base rules."""
    found = (scores.filter(~base_failed()).groupBy(_language(lang_col).alias("_quality_lang"))
             .agg(*[F.percentile_approx(F.col("_quality")[name], [0.25, 0.5, 0.75], 10_000).alias(name)
                    for name in PERPLEXITIES]))
    spread = {name: (F.col(name)[2] - F.col(name)[0]) / 1.349 for name in PERPLEXITIES}
    return found.select(
        "_quality_lang",
        F.array(*[F.col(n)[1] - below * spread[n] for n in PERPLEXITIES]).alias("_quality_low"),
        F.array(*[F.col(n)[1] + above * spread[n] for n in PERPLEXITIES]).alias("_quality_high"))


def judged(scores: DataFrame, limits: DataFrame, *, lang_col: str = "lang") -> DataFrame:
    """Adds ``_quality_base_failed`` and ``_quality_kept``."""
    limits = work_table(limits, "quality_bands")  # else asking for its size would score again
    limits = F.broadcast(limits) if small_enough(limits) else limits
    joined = scores.join(limits, _language(lang_col) == F.col("_quality_lang"), "left")
    inside = F.lit(True)
    for i, name in enumerate(PERPLEXITIES):
        ppl = F.col("_quality")[name]
        inside = inside & F.coalesce((ppl >= F.col("_quality_low")[i]) & (ppl <= F.col("_quality_high")[i]),
                                     F.lit(True))
    return (joined.withColumn("_quality_base_failed", base_failed())
            .withColumn("_quality_kept", ~F.col("_quality_base_failed") & inside))


def quality_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", **limits: float) -> DataFrame:
    """One row per document: ``<id>``, its statistics, ``base_failed``, ``kept``, log-perplexity."""
    scores = work_table(scored(docs.select(id_col, text_col, lang_col), text_col=text_col, lang_col=lang_col,
                               keep_text=False), "quality_scores")
    found = judged(scores, bands(scores, lang_col=lang_col, **limits), lang_col=lang_col)
    return found.select(id_col, "_quality.n_words", "_quality.word_chars", "_quality.n_symbols",
                        "_quality.n_dup_lines", "_quality.n_repeat_words",
                        F.col("_quality_base_failed").alias("base_failed"), F.col("_quality_kept").alias("kept"),
                        "_quality.log_perplexity")


def drop_low_quality(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
                     **limits: float) -> DataFrame:
    """The documents that are kept, unchanged."""
    scores = work_table(scored(docs, text_col=text_col, lang_col=lang_col), "quality_scores")
    found = judged(scores, bands(scores, lang_col=lang_col, **limits), lang_col=lang_col)
    return found.filter("_quality_kept").select(*docs.columns)


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Quality statistics and verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"))
