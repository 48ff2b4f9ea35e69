"""Intermediate tables in the cluster's shared folder.

A result that many later tables scan is written once and read back: its joins run
once, later scans prune columns and partitions, and a lost executor costs a
re-read, not a recomputation.
"""
from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partitions of a cached result table of a few rows per group.
KEPT_PARTITIONS = 8

_stages: dict[tuple[str, str], DataFrame] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for cut lineage and written intermediates.

    Taken from the session. Only a local session without one gets a folder of
    its own; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scorewatch-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table to the shared folder and return a scan of it.

    Rows are rebalanced on the partition columns, which merges small partitions
    into one file and splits hot ones.
    """
    spark = df.sparkSession
    slug = re.sub(r"\W+", "_", name).strip("_")
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{slug}-{uuid.uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """A small result table that others are drawn from, cached in a few partitions.

    A cached plan keeps its number of shuffle partitions; a union of such tables would run a task
    for each of them, nearly all empty.
    """
    return df.repartition(KEPT_PARTITIONS).cache()


def staged(spark: SparkSession, name: str, build: Callable[[], DataFrame],
           partition_by: Sequence[str] = ()) -> DataFrame:
    """``stage`` once per application and name."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _stages:
        _stages[key] = stage(build(), name, partition_by)
    return _stages[key]
