"""Reference tables from a relational database over JDBC.

Column pruning and filters are pushed into the generated SQL by Spark's JDBC
source; reading a schema does not read rows.  Large tables are read in
parallel slices when a numeric ``partition_column`` is given.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10000) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``; partitioning needs all four values."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    part = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(v is not None for v in part):
        if any(v is None for v in part):
            raise ValueError("partition_column, lower_bound, upper_bound and num_partitions go together")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_jdbc_table(spark: SparkSession, options: dict[str, str],
                    columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.format("jdbc").options(**options).load()
    return df.select(*columns) if columns else df


def jdbc_target_schema(spark: SparkSession, options: dict[str, str]) -> T.StructType:
    """The table's schema; Spark resolves it with a zero-row query."""
    return spark.read.format("jdbc").options(**options).load().schema
