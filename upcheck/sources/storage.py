"""Materialisation in the shared folder (``spark.checkpoint.dir``).

Writing an intermediate result as parquet cuts the lineage (a lost executor
only re-reads files) and lets several later steps read it without
recomputing the plan that produced it.
"""

from __future__ import annotations

import gc
from contextlib import contextmanager
from typing import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from upcheck.session import scratch_path

_TRACKED: list[list[str]] = []

#: Bytes of input for each partition that shuffles of a write begin with (adaptive execution joins small ones), and partitions at most.
INPUT_A_PARTITION, MOST_PARTITIONS = 4 << 20, 2000


def _input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, by Spark's statistics; rows held elsewhere count nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 1 << 50)


@contextmanager
def write_settings(df: DataFrame) -> Iterator[None]:
    """Settings for a write of ``df``; the session's come back.

    Shuffles begin with partitions by the size of the input, so a task's memory does
    not grow with it.  Generated methods stay below what the JVM compiles (8000 bytes):
    projections of dozens of expressions are otherwise interpreted.
    """
    spark, key = df.sparkSession, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = {key: str(max(least, min(MOST_PARTITIONS, _input_bytes(df) // INPUT_A_PARTITION))), "spark.sql.codegen.hugeMethodLimit": "8000"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def tracked() -> Iterator[list[str]]:
    """Collect the paths that ``materialize`` writes inside the block (for ``discard``)."""
    _TRACKED.append(paths := [])
    try:
        yield paths
    finally:
        _TRACKED[:] = [p for p in _TRACKED if p is not paths]  # not one that is equal


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete materialised folders; frames that read them are of no use afterwards."""
    while paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner find the shuffles of steps whose results are written; else their files stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] | None = None) -> str:
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with write_settings(df):
        w.save(path)
    return path


def materialize_path(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> str:
    """Write ``df`` below the shared folder; where."""
    path = scratch_path(df.sparkSession, "materialized", name)
    for paths in _TRACKED:
        paths.append(path)
    return write_table(df, path, partition_by=partition_by)


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and return a DataFrame reading it."""
    return df.sparkSession.read.schema(df.schema).parquet(materialize_path(df, name, partition_by))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
