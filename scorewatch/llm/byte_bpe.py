"""Byte-level BPE: ranked merges folded over the distinct words of hash buckets, and decoding.

1. Texts are cut into words by the tokenizer's pattern, in batches of documents. A batch holds
   its distinct words once, and per document the numbers of its words.
2. Words travel to hash buckets. A bucket keeps each of its words once, whatever number of
   batches asks for it, and folds the merges over them: of all neighbouring byte runs the pair of
   lowest rank, the leftmost if equal, becomes one run, until no pair has a rank. Words of equal
   length are the rows of a matrix, which takes a step of all of them at once.
3. The ids of its words go back to each batch, which lays them end to end per document.

Decoding joins the pieces of all ids.

A fold over a matrix reads a word once a step, so words beyond ``LONG`` bytes go through a heap of
pairs instead, whose time grows with the word's length times its logarithm.

Nulls and edges: a null or empty text has no ids and decodes to no bytes; rows that share an id,
or have none, are encoded row by row; whole texts are read; further columns are ignored; an
empty table gives no row. Ids that the vocabulary lacks decode to null.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from scorewatch.llm.common import ship_package, table

#: Characters of text in a batch, and those that one bucket of words answers for.
BATCH_CHARS, BUCKET_CHARS = 6_000_000, 24_000_000
#: Bytes of a word from which its merges go through a heap, and words that are folded together.
LONG, FOLDED = 128, 20_000
#: Characters of text that are cut at once.
SLICE_CHARS = 1_000_000
#: Words or ids that are laid out or decoded at once.
PART_IDS = 200_000
#: Stands for the rank of a pair that is no piece.
UNRANKED = 2**31 - 1
#: Parts words from each other; no UTF-8 text holds this byte.
BORDER = b"\xff"


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and their ranks: a line has the piece in base 64 and the rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


class Merges:
    """Which run two neighbouring runs become, and the rank of each run.

    Runs are numbered: single bytes by their value, longer pieces from 256 on. All ways to part a
    piece into two runs are sorted by the numbers of both.
    """

    def __init__(self, ranks: dict[bytes, int]):
        longer = [piece for piece in ranks if len(piece) > 1]
        number = {bytes([b]): b for b in range(256)} | {piece: i for i, piece in enumerate(longer, 256)}
        self.rank = np.array([ranks.get(piece, UNRANKED) for piece in number], np.int64)
        parted = np.array([(number[piece[:at]] << 32 | number[piece[at:]], i) for i, piece in enumerate(longer, 256)
                           for at in range(1, len(piece)) if piece[:at] in number and piece[at:] in number],
                          np.int64).reshape(-1, 2)
        parted = parted[np.argsort(parted[:, 0])]
        # A last entry that no pair equals, so that every search ends at one.
        self.pairs, self.runs = np.append(parted[:, 0], 2**62), np.append(parted[:, 1], 0)
        self.ids = {piece: rank for piece, rank in ranks.items()}

    def of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs that pairs become, and their ranks."""
        wanted = left << 32 | right
        at = np.searchsorted(self.pairs, wanted)
        run = self.runs[at]
        return run, np.where(self.pairs[at] == wanted, self.rank[run], UNRANKED)

    def __call__(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list = [None] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            rank = self.ids.get(word)
            if rank is not None:
                out[i] = np.array([rank], np.int64)
            elif len(word) > LONG:
                out[i] = self.long(word)
            else:
                by_length.setdefault(len(word), []).append(i)
        for length, places in by_length.items():
            for begin in range(0, len(places), FOLDED):
                part = places[begin:begin + FOLDED]
                runs = np.frombuffer(b"".join([words[i] for i in part]), np.uint8).astype(np.int64)
                self.fold(runs.reshape(-1, length), part, out)
        return out

    def fold(self, runs: np.ndarray, places: list[int], out: list) -> None:
        """A merge of every row at a time; rows without a pair that has a rank are done."""
        places, (merged, ranks) = np.array(places), self.of(runs[:, :-1], runs[:, 1:])
        while len(runs):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(runs), np.int64)
            every = np.arange(len(runs))
            going = ranks[every, at] < UNRANKED if ranks.shape[1] else np.zeros(len(runs), bool)
            for i, ids in zip(places[~going], self.rank[runs[~going]]):
                out[i] = ids
            runs, merged, ranks, places, at = (x[going] for x in (runs, merged, ranks, places, at))
            if not len(runs):
                return
            every, new = np.arange(len(runs)), merged[np.arange(len(runs)), at]
            column = np.arange(runs.shape[1] - 1)
            runs = np.take_along_axis(runs, column + (column > at[:, None]), 1)
            runs[every, at] = new
            column = column[:-1]
            keep = column + (column >= at[:, None])
            merged, ranks = np.take_along_axis(merged, keep, 1), np.take_along_axis(ranks, keep, 1)
            for place in (at - 1, at):  # the pairs on both sides of the new run
                rows = np.flatnonzero((place >= 0) & (place < ranks.shape[1]))
                there = place[rows]
                merged[rows, there], ranks[rows, there] = self.of(runs[rows, there], runs[rows, there + 1])

    def long(self, word: bytes) -> np.ndarray:
        """The same merges of one word, by a heap of its pairs and links between its runs."""
        run, size = list(word), len(word)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        merged, ranks = self.of(np.array(run[:-1], np.int64), np.array(run[1:], np.int64))
        heap = [(rank, i, run[i], run[i + 1], new) for i, (rank, new) in enumerate(zip(ranks.tolist(), merged.tolist()))
                if rank < UNRANKED]
        heapify(heap)
        while heap:
            _, i, left, right, new = heappop(heap)
            j = after[i]
            if run[i] != left or j >= size or run[j] != right:
                continue  # one of the runs is no more
            run[i], run[j], after[i] = new, -1, after[j]
            if after[i] < size:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < size:
                    found, rank = self.of(np.array([run[x]], np.int64), np.array([run[y]], np.int64))
                    if rank[0] < UNRANKED:
                        heappush(heap, (int(rank[0]), x, run[x], run[y], int(found[0])))
        return self.rank[[r for r in run if r >= 0]]


def rank_maps(ranks: dict[bytes, int]) -> Merges:
    """The merges that a vocabulary's ranks allow, for ``merged_ids``."""
    return Merges(ranks)


def merged_ids(word: Column, maps: Merges) -> Column:
    """Ids of a word in hexadecimal: a fold of the ranked merges over its bytes."""
    @F.pandas_udf("array<int>")
    def ids(words: pd.Series) -> pd.Series:
        return pd.Series(maps([bytes.fromhex(w) for w in words]))
    return ids(word)


# Cutting texts into words

class Cut(dict):
    """Numbers of the words of texts; parts met in this batch are kept with their words' numbers.

    A match of the pattern has no blank behind a non-blank, so a text may be cut before every
    blank that follows a non-blank: before each run of blanks, and at each single space. The parts
    are matched once each. Keys are the parts that follow a single space.
    """

    def __init__(self, pattern: str):
        import regex
        super().__init__()
        self.find = regex.compile(pattern).findall
        self.blanks = regex.compile(r"\s\s").search
        self.gaps = regex.compile(r"(\s{2,})").split
        self.numbers: dict[str, int] = {}

    def of(self, part: str) -> tuple[int, ...]:
        numbers = self.numbers
        return tuple([numbers.setdefault(w, len(numbers)) for w in self.find(part)])

    def __missing__(self, part: str) -> tuple[int, ...]:
        found = self[part] = self.of(" " + part)
        return found

    def words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts end to end, and how many each text has."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        leads, stretches, per_text = [], [], []  # a run of blanks, and what follows up to the next one
        for text in texts:
            if text and self.blanks(text):
                pieces = self.gaps(text)
                leads += ["", *pieces[1::2]]
                stretches += pieces[::2]
                per_text.append(len(pieces) // 2 + 1)
            else:
                leads.append("")
                stretches.append(text or "")
                per_text.append(1)
        lists = pc.split_pattern(pa.array(stretches, pa.large_string()), " ")
        parts = lists.flatten().dictionary_encode()
        offsets, which = lists.offsets.to_numpy().astype(np.int64), parts.indices.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        different = parts.dictionary.to_pylist()
        firsts = [self.of(lead + different[i]) for lead, i in zip(leads, which[offsets[:-1]].tolist())]
        which[offsets[:-1]] = np.arange(len(firsts)) + len(different)
        found = [self[part] for part in different] + firsts
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        numbers = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        upto = np.concatenate([[0], np.cumsum(sizes[which])])
        ends = offsets[np.cumsum(per_text)]
        return numbers[runs((np.cumsum(sizes) - sizes)[which], sizes[which])], np.diff(upto[ends], prepend=0)


def squeezed(values: np.ndarray) -> bytes:
    """32-bit numbers by planes of bytes, compressed."""
    import zstandard
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unsqueezed(value: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _cut(pattern: str, buckets: int):
    """Batches: per document the numbers of its words, commonest word first; the words by bucket.

    Texts are cut as they are read; a batch closes after about ``BATCH_CHARS`` characters.
    """
    def closed(batch: int, ids: list, found: list[np.ndarray], sizes: list[np.ndarray], cut: Cut) -> pd.DataFrame:
        import xxhash
        import zstandard
        pack = zstandard.ZstdCompressor(level=3).compress
        cut.clear()  # the parts have done their work
        numbers = np.concatenate(found)
        words = [w.encode("utf-8", "surrogatepass") for w in cut.numbers]
        common = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
        place = np.empty(len(words), np.uint32)
        place[common] = np.arange(len(words), dtype=np.uint32)
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        bucket = np.fromiter((xxhash.xxh3_64_intdigest(words[i]) % buckets for i in order), np.int64, len(words))
        order, bucket = order[np.argsort(bucket, kind="stable")], np.sort(bucket)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = [*starts[1:], len(words)]
        return pd.DataFrame({
            "batch": [batch], "ids": [ids], "sizes": [squeezed(np.concatenate(sizes))],
            "numbers": [squeezed(place[numbers])], "order": [squeezed(place[order])],
            "buckets": [bucket[starts].tolist()],
            "words": [[pack(BORDER.join([words[i] for i in order[a:b]])) for a, b in zip(starts, ends)]]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        batch = TaskContext.get().partitionId() << 32
        ids, found, sizes, cut, chars = [], [], [], Cut(pattern), 0
        for rows in batches:
            lengths = pc.fill_null(pc.utf8_length(rows.column("text")), 0).to_numpy()
            at = 0
            while at < rows.num_rows:  # few texts at a time as Python strings
                room = min(BATCH_CHARS - chars, SLICE_CHARS)
                upto = at + 1 + int(np.searchsorted(np.cumsum(lengths[at:]), room))
                part = rows.slice(at, upto - at)
                ids += part.column("id").to_pylist()
                numbers, counts = cut.words(part.column("text").to_pylist())
                found.append(numbers)
                sizes.append(counts)
                chars += int(lengths[at:upto].sum())
                at = upto
                if chars >= BATCH_CHARS:
                    yield pa.RecordBatch.from_pandas(closed(batch, ids, found, sizes, cut), BATCH_TYPE)
                    batch, ids, found, sizes, cut, chars = batch + 1, [], [], [], Cut(pattern), 0
        if ids:
            yield pa.RecordBatch.from_pandas(closed(batch, ids, found, sizes, cut), BATCH_TYPE)
    return run


BATCH = ("batch long, ids array<long>, sizes binary, numbers binary, order binary, buckets array<long>, "
         "words array<binary>")
BATCH_TYPE = pa.schema([("batch", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()),
                        ("numbers", pa.binary()), ("order", pa.binary()), ("buckets", pa.list_(pa.int64())),
                        ("words", pa.list_(pa.binary()))])


def _ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of each batch, a row for every bucket."""
    for frame in frames:
        for batch, buckets, words in zip(frame["batch"], frame["buckets"], frame["words"]):
            yield pd.DataFrame({"batch": batch, "bucket": list(buckets), "words": list(words)})


def _answers(merges: Merges):
    """The words of a bucket are folded once each; for each batch the ids of those it asked for."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        asked = [unpack(w).split(BORDER) for w in rows["words"]]
        words = list(set().union(*asked))
        place = {w: i for i, w in enumerate(words)}
        found = merges(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids, starts = np.concatenate(found), np.cumsum(sizes) - sizes
        at = [np.fromiter(map(place.__getitem__, part), np.int64, len(part)) for part in asked]
        return pd.DataFrame({"batch": rows["batch"].tolist(), "bucket": rows["bucket"].tolist(),
                             "sizes": [squeezed(sizes[a]) for a in at],
                             "found": [squeezed(ids[runs(starts[a], sizes[a])]) for a in at]})
    return run


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of many runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _assemble(batches: pa.Table, answers: pa.Table) -> pa.Table:
    """Ids of every document of a batch."""
    out = []
    answers = answers.sort_by("bucket")
    for row in batches.to_pylist():
        order, numbers, sizes = unsqueezed(row["order"]), unsqueezed(row["numbers"]), unsqueezed(row["sizes"])
        lengths, starts = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        ids = np.empty(0, np.int32)
        if len(order):
            in_order = np.concatenate([unsqueezed(s) for s in answers["sizes"].to_pylist()]).astype(np.int64)
            if len(in_order) != len(order):
                raise ValueError(f"words of batch {row['batch']} are not all answered")
            lengths[order], starts[order] = in_order, np.cumsum(in_order) - in_order
            ids = np.concatenate([unsqueezed(f) for f in answers["found"].to_pylist()]).astype(np.int32)
        borders = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        for first, last in in_parts(borders):
            own = numbers[borders[first]:borders[last]]
            upto = np.concatenate([[0], np.cumsum(lengths[own])])
            offsets = pa.array(upto[borders[first:last + 1] - borders[first]], pa.int32())
            laid = pa.array(ids[runs(starts[own], lengths[own])], pa.int32())
            out.append(pa.table([pa.array(row["ids"][first:last], pa.int64()),
                                 pa.ListArray.from_arrays(offsets, laid)], schema=ENCODED_TYPE))
    return pa.concat_tables(out) if out else ENCODED_TYPE.empty_table()


def in_parts(edges: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of rows that hold about ``PART_IDS`` entries together, at least a row each, by their edges."""
    first = 0
    while first < len(edges) - 1:
        last = max(first + 1, int(np.searchsorted(edges, edges[first] + PART_IDS, "right")) - 1)
        yield first, last
        first = last


ENCODED_TYPE = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, id_col: str = "doc_id",
           text_col: str = "text", bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """One row per document: ``<id>, ids`` with the token ids of its text in order."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, chars // bucket_chars)
    parts = max(1, -(-chars // BATCH_CHARS))
    # Both readers take all columns, so that they share one exchange and texts are cut once.
    batches = texts.mapInArrow(_cut(pattern, buckets), BATCH).repartition(parts, "batch")
    asked = (batches.mapInPandas(_ask, "batch long, bucket long, words binary")
             .repartition(buckets, "bucket"))  # few bytes, much work: not to be merged by size
    answers = asked.groupBy("bucket").applyInPandas(
        _answers(Merges(ranks)), "batch long, bucket long, sizes binary, found binary")
    return (batches.groupBy("batch").cogroup(answers.groupBy("batch"))
            .applyInArrow(_assemble, "id long, ids array<int>").withColumnRenamed("id", id_col))


def decode(encoded: DataFrame, ranks: dict[bytes, int], *, ids_col: str = "ids",
           out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids of a row stand for; null where ids are null or lack a piece."""
    ship_package(encoded.sparkSession)
    pieces = {rank: piece for piece, rank in ranks.items()}
    known = np.array(sorted(pieces), np.int64)
    held = pa.array([pieces[i] for i in known.tolist()], pa.large_binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (batch.slice(first, last - first) for batch in batches
                     for first, last in in_parts(batch.column(ids_col).offsets.to_numpy())):
            lists = rows.column(ids_col)
            edges = lists.offsets.to_numpy()
            ids = pc.fill_null(lists.values.slice(edges[0], edges[-1] - edges[0]), -1).to_numpy().astype(np.int64)
            edges = edges - edges[0]
            place = np.minimum(np.searchsorted(known, ids), len(known) - 1)
            strange = np.concatenate([[0], np.cumsum(known[place] != ids)])[edges]
            joined = held.take(pa.array(place))
            _, begins, data = joined.buffers()
            begins = np.frombuffer(begins, np.int64)[edges] if len(ids) else np.zeros(len(edges), np.int64)
            whole = pa.array((np.diff(strange) == 0) & lists.is_valid().to_numpy(zero_copy_only=False))
            found = pa.Array.from_buffers(pa.large_binary(), len(lists), [whole.buffers()[1], pa.py_buffer(begins), data])
            yield pa.RecordBatch.from_arrays([*rows.columns, found.cast(pa.binary())],
                                             names=[*rows.schema.names, out])
    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(out, BinaryType())]))


def op11_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Ids of every whole document and the bytes they decode to, as checksums."""
    import public_tokenizers
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = decode(encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
