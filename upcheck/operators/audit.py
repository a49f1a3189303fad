"""The audit table: one fixed schema shared by every check.

An audit row carries the identity columns of the offending upload row, the
list of columns at fault (``conflict_columns``) and whether the library
resolves the problem itself (``resolved`` = 'yes', the authority's values
replace the upload's) or the row is quarantined ('no').
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upcheck.sources.storage import materialize

AUDIT_LIST_COL = "conflict_columns"
AUDIT_FLAG_COL = "resolved"


def audit_schema(key_fields: Sequence[T.StructField]) -> T.StructType:
    return T.StructType([*(T.StructField(f.name, f.dataType, True) for f in key_fields),
                         T.StructField(AUDIT_LIST_COL, T.ArrayType(T.StringType(), True), True),
                         T.StructField(AUDIT_FLAG_COL, T.StringType(), True)])


def key_fields(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    by_name = {f.name: f for f in df.schema.fields}
    return [by_name[k] for k in keys]


def empty_audit(spark: SparkSession, key_fields_: Sequence[T.StructField]) -> DataFrame:
    return spark.createDataFrame([], audit_schema(key_fields_))


def as_audit(df: DataFrame, keys: Sequence[str], conflict_list, resolved) -> DataFrame:
    """Project rows onto the audit schema (keys, list, flag)."""
    return df.select(*keys,
                     conflict_list.cast(T.ArrayType(T.StringType())).alias(AUDIT_LIST_COL),
                     resolved.cast("string").alias(AUDIT_FLAG_COL))


def union_audit(*audits: DataFrame) -> DataFrame:
    """Concatenate audit tables of the same key schema (by name, bag semantics)."""
    first, *rest = audits
    cols = first.columns
    out = first
    for a in rest:
        if sorted(a.columns) != sorted(cols):
            raise ValueError(f"audit schemas differ: {cols} vs {a.columns}")
        out = out.unionByName(a)
    return out


def lookup_audit(audit: DataFrame, id_col: str, value) -> DataFrame:
    """All audit rows of one upload id."""
    return audit.where(F.col(id_col) == F.lit(value))


def summarize_audit(audit: DataFrame) -> DataFrame:
    """Counts per (conflict list, resolved) - the metric form of the audit."""
    return (audit
            .groupBy(F.array_join(AUDIT_LIST_COL, ",").alias(AUDIT_LIST_COL), AUDIT_FLAG_COL)
            .agg(F.count(F.lit(1)).alias("n_rows")))


def unknown_id_report(unknown: DataFrame, id_col: str, n: int = 20) -> DataFrame:
    """``(id, n_unknown)``: the first ``n`` of distinct unknown ids, each beside the number of all of them."""
    ids = materialize(unknown.select(id_col).where(F.col(id_col).isNotNull()).distinct(), "unknown_ids")
    return ids.orderBy(id_col).limit(n).withColumn("n_unknown", F.lit(ids.count()).cast("long"))


def audit_sample(audit: DataFrame, id_col: str, n: int = 20) -> DataFrame:
    """``(conflict_columns, resolved, ids)``: of every kind of conflict the ``n`` ids that hash least.

    The same ids on every run and however the audit is partitioned.  Each task
    keeps ``n`` ids of a kind at most before rows are shuffled.
    """
    kind = [F.array_join(AUDIT_LIST_COL, ",").alias(AUDIT_LIST_COL), F.col(AUDIT_FLAG_COL)]
    ids = audit.select(*kind, F.col(id_col).cast("string").alias("__id")).where("__id is not null").distinct()
    least = Window.partitionBy(AUDIT_LIST_COL, AUDIT_FLAG_COL).orderBy(F.md5(F.col("__id").cast("binary")), "__id")
    chosen = ids.withColumn("__rank", F.row_number().over(least)).where(F.col("__rank") <= n)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__rank", "__id"))), lambda x: x["__id"])
    return chosen.groupBy(AUDIT_LIST_COL, AUDIT_FLAG_COL).agg(listed.alias("ids"))


def sample_ids(audit: DataFrame, id_col: str, n: int = 20) -> list:
    """The ``n`` offending ids that hash least, for a log line: the same on every run, never an unbounded collect."""
    ids = audit.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    return [r[0] for r in ids.orderBy(F.md5(F.col(id_col).cast("string").cast("binary")), id_col).limit(n).collect()]
