"""Joins that hot keys cannot stall, and bounded row expansion.

A key that holds a third of all rows is one shuffle partition.  AQE splits such
a partition of the row side of an inner, left, semi or anti join when both
children of the sort-merge join are plain shuffles.  So the library joins rows
only with *written* key tables (a per-id status read back from the shared
folder), never with an aggregation in flight: no sampling, no list of hot keys
and no salt, and the split goes by measured bytes, whichever key is hot and
however many are.

Null keys match nothing, yet a plain join would send all of them to one task;
``keyed_join`` deals them over tasks by their content.

``repeat_rows`` emits each row ``count`` times with arrays of at most
``fanout`` elements and spreads large counts over tasks.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DEAL = "__sk_deal"


def keyed_join(rows: DataFrame, table: DataFrame, keys: str | Sequence[str], how: str) -> DataFrame:
    """``rows.join(table, keys, how)`` for ``how`` in inner, left, left_semi, left_anti.

    Rows with a null key join on a second key as well, a hash of the row and of
    the task that read it, so they spread like any others.  Both are the same
    when a lost task runs again.  ``table`` should be a written table.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    deal = F.when(null, F.xxhash64(F.spark_partition_id(), *rows.columns)).otherwise(F.lit(0).cast("long"))
    left = rows.withColumn(_DEAL, deal)
    right = table.withColumn(_DEAL, F.lit(0).cast("long"))
    return left.join(right, [*keys, _DEAL], how).drop(_DEAL)


def repeat_rows(df: DataFrame, count_col: str, fanout: int = 4096, most: int | None = None) -> DataFrame:
    """Each row ``count_col`` times (bag expansion).

    Arrays never exceed ``fanout`` elements: a count is cut into chunks of
    ``fanout`` (two levels cover ``fanout**3`` copies), and the chunks are dealt
    round-robin over tasks before they are expanded, so a tuple with a third of
    all rows is written by many tasks.  One pass over ``df``.

    ``most`` is the largest count where the caller knows it; if it is ``fanout`` at
    most, rows are expanded where they are, without that shuffle.
    """
    c = F.col(count_col)
    cols = [x for x in df.columns if x != count_col]
    if most is not None and most <= fanout:
        return df.where(c > 0).select(*cols, F.explode(F.sequence(F.lit(1), c.cast("int"))).alias("__rr")).drop("__rr")
    outer = fanout * fanout

    def chunk(n, size):
        """Sizes of the chunks of ``n``."""
        number = ((n - 1) / size).cast("long")
        return F.transform(F.sequence(F.lit(0).cast("long"), number), lambda i: F.least(n - i * size, F.lit(size).cast("long")))

    big = df.where(c > 0).select(*cols, F.explode(chunk(c.cast("long"), outer)).alias("__rr_n"))
    big = big.select(*cols, F.explode(chunk(F.col("__rr_n"), fanout)).alias("__rr_n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (big.repartition(parts)
            .select(*cols, F.explode(F.sequence(F.lit(1), F.col("__rr_n"))).alias("__rr")).drop("__rr"))
