"""Helpers for cluster runs: shared scratch tables and joins that survive hot keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # a key with more rows than this is hot
HOT_LOOKUP_ROWS = 500_000  # the most lookup rows of hot keys that are sent to every executor

_scopes: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that `spark.checkpoint.dir` names."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def set_scratch_if_unset(spark: SparkSession) -> None:
    """For entry points of single-machine runs: a folder of their own where none is configured."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="feedlark-"))


def small_batches(spark: SparkSession, records: int = 1_000, size: str = "16m") -> None:
    """For entry points whose rows hold whole texts: fewer rows go to a Python worker at a time, unless the session has
    limits of its own. Workers live as long as their executor and keep the memory of the largest batch."""
    for name, value in (("maxRecordsPerBatch", str(records)), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{name}"
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)


def scratch_folder(spark: SparkSession) -> str:
    """Holds all intermediate tables of this application; may be deleted once it has ended."""
    return f"{scratch_root(spark)}/feedlark-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return "/".join([scratch_folder(spark), *_scopes[-1:], f"{label}-{uuid.uuid4().hex}"])


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is stored inside is deleted at the end: for work that repeats without end, as in a stream."""
    _scopes.append(f"scope-{uuid.uuid4().hex}")
    folder = f"{scratch_folder(spark)}/{_scopes[-1]}"
    try:
        yield
    finally:
        _scopes.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where several jobs read one costly result: the text is cleaned once, later jobs read only
    the columns they need, and a lost executor costs a re-read and not the whole lineage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(df: DataFrame, label: str) -> DataFrame:
    """`materialise` with zstd: for the flows, where texts and bags of words take most of the room."""
    return materialise(df, label, "zstd")


def settle(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """Store what `build` returns, and delete all that was stored on the way to it."""
    path = scratch_path(spark, label)
    with scratch_scope(spark):
        found = build()
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def tasks_of(spark: SparkSession) -> int:
    """Tasks of a stage whose work cannot be told from the size of its input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread rows over all cores when they are read by fewer than half as many tasks.

    A small parquet file is read by one task; large inputs are split by size and left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if 2 * df.rdd.getNumPartitions() <= cores else df


def hot_key_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    load: str,
    hot_rows: int = HOT_ROWS,
    how: str = "left",
    most: int = HOT_LOOKUP_ROWS,
) -> DataFrame:
    """Join of many `rows` to a stored `lookup` whose column `load` counts the rows per key.

    Lookup rows of keys above `hot_rows` are broadcast, and the rows of such a key stay where they
    are; all other keys meet in an ordinary shuffle join. The broadcast has at most `most` rows: if
    there are more, only the keys of ten times the load are taken for hot, and so on.
    """
    while (found := lookup.filter(F.col(load) > hot_rows).limit(most + 1).count()) > most:
        hot_rows = max(hot_rows, 1) * 10
    if not found:
        return rows.join(lookup.drop(load), on, how)
    hot = F.broadcast(lookup.filter(F.col(load) > hot_rows).drop(load))
    cold = lookup.filter(F.col(load) <= hot_rows).drop(load)
    hot_part = rows.join(hot, on)
    cold_part = rows.join(hot.select(on), on, "left_anti").join(cold, on, how)
    return hot_part.unionByName(cold_part)
