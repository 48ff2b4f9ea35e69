"""Bounded-space online packing of tokenized documents into fixed-length sequences.

Every partition reads its documents once and keeps a fixed number of open windows. A
document longer than a window fills windows of its own and leaves its last part; a part goes
into the open window that it leaves least room in; when none has room, the fullest window is
emitted and a new one opened. What is open at a partition's end is merged: the leftover
pieces of many partitions are laid end to end and cut at the window length, so only the last
sequence of a merge group is not full.

Nulls and edges: a null text is an empty document, of the end token alone; rows that share an
id are packed row by row; ids and texts of any length are taken whole. Further columns are
ignored. An empty table gives no piece.
"""
from __future__ import annotations

import json
import os
import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.llm.common import table, work_table

LENGTH, OPEN_WINDOWS, END_ID = 4096, 64, 2
#: Leftover windows that are merged with each other.
MERGED_WINDOWS = 2048
#: Bytes of text whose chunks are looked up together.
BATCH_BYTES = 4_000_000
PIECES = ("id long, start long, length long, ids binary, doc_tokens long, window long, offset long, "
          "closed boolean")


class Tokens(dict):
    """Token ids, as little-endian 32-bit values, of chunks between spaces and line ends.

    For tokenizers that lower-case, drop white space and never join tokens across it, so that
    a text's ids are those of its chunks in order. A new chunk of Latin letters is split by the
    tokenizer's own pattern and its pieces go straight to the merge model; any other chunk goes
    through the whole tokenizer. Chunks met are kept, up to a limit, and those met before them,
    so that frequent ones outlast the limit.
    """

    LIMIT, KEPT = 400_000, 60_000
    #: Characters that need neither normalization nor special tokens.
    PLAIN = re.compile("[\x21-\x3b=\x3f-\x7b}~\xa1-\u024f]*")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            splits = json.load(file)["pre_tokenizer"]["pretokenizers"]
        self.pieces = regex.compile(next(x["pattern"]["Regex"] for x in splits if x["type"] == "Split"))
        self.model, self.known, self.before = self.whole.model, {}, {}
        # Byte-level alphabet: printable bytes stand for themselves, the others for 256 upwards.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def of_texts(self, texts: pa.Array) -> tuple[memoryview, list[int]]:
        """Ids of all texts end to end, and where each text's begin and end among them.

        Each different chunk of the batch is looked up once.
        """
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        chunks = lists.flatten().dictionary_encode()
        laid = pa.array(map(self.__getitem__, chunks.dictionary.to_numpy(zero_copy_only=False)), pa.large_binary()).take(
            chunks.indices)
        _, begins, data = laid.buffers()
        edges = lists.offsets.to_numpy()
        at = np.frombuffer(begins, np.int64)[laid.offset + edges - edges[0]]
        return memoryview(data if data is not None else b""), at.tolist()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            ids = self.encoded(chunk)
        if len(self) >= self.LIMIT:
            self.before = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def rest(self) -> None:
        """Keeps ``KEPT`` chunks and pieces only, for a worker outlives its task.

        The first ones met since the last clearing are the frequent ones.
        """
        few, known = dict(islice(self.items(), self.KEPT)), dict(islice(self.known.items(), self.KEPT))
        self.clear()
        self.update(few)
        self.known, self.before = known, {}

    def encoded(self, chunk: str) -> bytes:
        if not self.PLAIN.fullmatch(chunk):
            return array("I", self.whole.encode(chunk, add_special_tokens=False).ids).tobytes()
        low = chunk.lower()
        body = low[:-1]
        if low.isalpha():
            return self.spelt(low) if low == chunk else self[low]
        if body.isalpha() and not low[-1].isnumeric():  # a word with one mark behind it
            return self[body] + self.piece(low[-1])
        return b"".join([self[p] if p.isalpha() else self.piece(p) for p in self.pieces.findall(low)])

    def piece(self, piece: str) -> bytes:
        """Ids of a part of a chunk."""
        ids = self.known.get(piece)
        if ids is None:
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            ids = self.known[piece] = self.spelt(piece)
        return ids

    def spelt(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()


_tokens: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


class OpenWindows:
    """At most ``limit`` windows with room left; places by best fit."""

    def __init__(self, length: int, limit: int, first: int):
        self.length, self.limit, self.next = length, limit, first
        self.rooms: list[tuple[int, int]] = []

    def full(self) -> int:
        """A window for a part that fills it."""
        self.next += 1
        return self.next - 1

    def place(self, size: int) -> tuple[int, int, int | None]:
        """Window and offset for a part, and the window that was emitted for it."""
        emitted = None
        at = bisect_left(self.rooms, (size, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.limit:
                emitted = self.rooms.pop(0)[1]
            room, window = self.length, self.full()
        if room > size:
            insort(self.rooms, (room - size, window))
        return window, self.length - room, emitted


def _runs(texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of row runs of about so many bytes; a longer text is a run of its own."""
    begin, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(texts):
        yield begin, len(texts)


def _pack(path: str, length: int, limit: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        context = TaskContext.get()
        ids_of, end = tokens(path), array("I", [end_id]).tobytes()
        windows = OpenWindows(length, limit, context.partitionId() << 40)
        held: dict[int, list[tuple]] = {}  # pieces of open windows
        schema = pa.schema([(name, pa.binary() if name == "ids" else pa.bool_() if name == "closed" else pa.int64())
                            for name, _ in (column.split() for column in PIECES.split(", "))])

        def batch_of(pieces: list[tuple], closed: bool) -> pa.RecordBatch:
            columns = [*zip(*pieces), [closed] * len(pieces)]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, schema.types)], schema=schema)

        for batch in batches:
            for begin, upto in _runs(batch.column("text")):
                out = []
                data, at = ids_of.of_texts(batch.column("text").slice(begin, upto - begin))
                for key, since, until in zip(batch.column("id").slice(begin, upto - begin).to_pylist(), at, at[1:]):
                    ids = bytes(data[since:until]) + end
                    n = len(ids) // 4
                    whole = n - n % length
                    for start in range(0, whole, length):
                        out.append((key, start, length, ids[4 * start:4 * (start + length)], n,
                                    windows.full(), 0))
                    if whole < n:
                        window, offset, emitted = windows.place(n - whole)
                        held.setdefault(window, []).append(
                            (key, whole, n - whole, ids[4 * whole:], n, window, offset))
                        if emitted is not None:
                            out += held.pop(emitted)
                        if offset + n - whole == length:
                            out += held.pop(window)
                if out:
                    yield batch_of(out, True)
        ids_of.rest()
        for pieces in held.values():
            yield batch_of(pieces, False)
    return run


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH, open_windows: int = OPEN_WINDOWS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``<id>, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds little-endian unsigned 32-bit token ids; a document's ids end with ``end_id``.
    The pieces of a sequence, by ``offset``, fill it from 0 without gaps.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pieces = work_table(texts.mapInArrow(_pack(tokenizer, length, open_windows, end_id), PIECES), "pieces")
    closed = pieces.filter("closed").select("*", F.col("window").alias("sequence_id"))
    left = pieces.filter("not closed")
    # A few windows for each partition: laid end to end within merge groups.
    sizes = work_table(left.groupBy("window").agg(F.sum("length").alias("fill")), "open_windows")
    groups = -(-sizes.count() // MERGED_WINDOWS) or 1
    along = Window.partitionBy("group").orderBy("window").rowsBetween(Window.unboundedPreceding, -1)
    bases = (sizes.withColumn("group", F.pmod(F.xxhash64("window"), F.lit(groups)))
             .withColumn("base", F.coalesce(F.sum("fill").over(along), F.lit(0)))
             .select("window", "base", "group"))
    at = F.col("base") + F.col("offset")
    cut = (left.join(bases, "window")
           .withColumn("_at", at)
           .withColumn("_cell", F.explode(F.sequence(F.floor(at / length),
                                                     F.floor((at + F.col("length") - 1) / length))))
           .withColumn("_from", F.greatest("_at", F.col("_cell") * length))
           .withColumn("_to", F.least(F.col("_at") + F.col("length"), (F.col("_cell") + 1) * length))
           .withColumn("_skip", F.col("_from") - F.col("_at")))
    merged = cut.select(
        "id", (F.col("start") + F.col("_skip")).alias("start"), (F.col("_to") - F.col("_from")).alias("length"),
        F.col("ids").substr((4 * F.col("_skip") + 1).cast("int"),
                            (4 * (F.col("_to") - F.col("_from"))).cast("int")).alias("ids"),
        "doc_tokens", (F.lit(-1) - F.col("group") * (1 << 32) - F.col("_cell")).alias("sequence_id"),
        (F.col("_from") - F.col("_cell") * length).alias("offset"))
    columns = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return closed.select(*columns).unionByName(merged.select(*columns)).withColumnRenamed("id", id_col)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens; a checksum stands for a piece's ids."""
    import public_tokenizers
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
