"""What several operators of this subpackage share: work tables, uneven joins, words."""
from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a lookup that may be broadcast; with at most 200 bytes a row that is 40 MB.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a local session that names none gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return "/tmp/checkpoints/scorewatch-llm"


def work_table(df: DataFrame, name: str) -> DataFrame:
    """Write a result that is read more than once to the shared folder; give a scan of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most so many rows; reads no more of it than that."""
    return df.limit(rows + 1).count() <= rows


def attach_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], total: int,
                  size: str = "_n") -> DataFrame:
    """Join one row per group, with the group's row count in ``size``, onto the rows.

    Groups that hold over one part in 50,000 of all rows are at most 50,000, so they are
    broadcast and their rows stay where they are; only rows of small groups are shuffled.
    """
    least = max(100, total // 50_000)
    keys = list(keys)
    large = F.broadcast(groups.filter(F.col(size) >= least).drop(size))
    small = groups.filter(F.col(size) < least).drop(size)
    return (rows.join(large, keys)
            .unionByName(rows.join(large.select(*keys), keys, "left_anti").join(small, keys)))


def texts_in_pieces(pdf, column: str, chars: int = 3_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of row runs of about so many characters; a longer text is a run of its own."""
    begin, held = 0, 0
    for i, text in enumerate(pdf[column]):
        n = len(text) if text is not None else 0
        if held and held + n > chars:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(pdf):
        yield begin, len(pdf)


class WordHashes(dict):
    """64-bit hashes of words (as bytes), kept for the words met last."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


#: One for each Python worker, whatever it runs.
HASHES = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; bytes know ASCII blanks and letters only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text is not None else []


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def chained(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of so many words, in order."""
    n = len(hashes) - length + 1
    out = mixed(hashes[:n] + np.uint64(length))
    for i in range(1, length):
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + hashes[i:i + n])
    return out


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this library's modules to the executors, once per application."""
    import shutil
    import tempfile
    from pathlib import Path

    if spark.sparkContext.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    into = tempfile.mkdtemp(prefix="scorewatch-")
    spark.sparkContext.addPyFile(
        shutil.make_archive(f"{into}/{package.name}", "zip", package.parent, package.name))
    _shipped.add(spark.sparkContext.applicationId)
