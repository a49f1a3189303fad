"""Whole-row anti join: rows that no row of another table equals in every column.

Bag semantics: a row that occurs twice and has no match stays twice.  A null in
any key column matches nothing, so such rows always stay (unlike
``exceptAll``/``subtract``, which take nulls as equal and count or drop copies).

Rows meet on a 128-bit digest of the key columns instead of on the columns
themselves, so hundreds of columns, nested ones and maps sort and shuffle as two
numbers; where digests agree the columns themselves decide.  The other table is
reduced to distinct rows and written, so a row that a third of all rows repeat is
split by AQE.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upcheck.sources.storage import materialize

_ONE, _TWO, _ROW = "__rw_one", "__rw_two", "__rw_row"


def _named(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def comparable(value: Column, kind: T.DataType) -> Column:
    """``value`` in a form that can be compared and hashed: maps as entries in order, 0.0 for -0.0."""
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_entries(value))
        pair = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return comparable(entries, T.ArrayType(pair))
    if isinstance(kind, T.ArrayType) and _changes(kind.elementType):
        return F.transform(value, lambda x: comparable(x, kind.elementType))
    if isinstance(kind, T.StructType) and _changes(kind):
        made = F.struct(*[comparable(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), made)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
    return value


def _changes(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_changes(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _changes(kind.elementType)
    return isinstance(kind, (T.MapType, T.FloatType, T.DoubleType))


def unmatched_rows(rows: DataFrame, other: DataFrame, columns: Sequence[str] | None = None,
                   other_columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``rows`` that no row of ``other`` equals.

    ``columns`` (all by default) pair with ``other_columns`` (the same names by
    default); further columns of ``rows`` are carried along.
    """
    columns = list(rows.columns if columns is None else columns)
    others = list(columns if other_columns is None else other_columns)
    if len(columns) != len(others) or not columns:
        raise ValueError("columns and other_columns must pair up")
    types = {f.name: f.dataType for f in rows.schema.fields}
    have = {f.name: f.dataType for f in other.schema.fields}
    differing = [c for c, o in zip(columns, others) if have[o].simpleString() != types[c].simpleString()]
    if differing:
        raise ValueError(f"columns differ in type: {differing}")

    def whole(df: DataFrame, names: Sequence[str], schema: dict) -> DataFrame:
        """The key as a struct, null where one of its columns is."""
        full = ~F.array_contains(F.array(*[_named(c).isNull() for c in names]), True)  # one level deep, however many
        made = F.struct(*[comparable(_named(c), schema[c]).alias(f"c{i}") for i, c in enumerate(names)])
        return df.withColumn(_ROW, F.when(full, made))
    digests = [F.xxhash64(F.lit(seed), _ROW) for seed in (1, 2)]
    right = whole(other, others, have).select(_ROW).where(F.col(_ROW).isNotNull()).distinct()
    # rows that agree in both digests are kept together: one entry holds them all, so a join key is unique
    table = materialize(right.select(digests[0].alias(_ONE), digests[1].alias(_TWO), _ROW)
                        .groupBy(_ONE, _TWO).agg(F.collect_set(_ROW).alias("__rw_rows")), "distinct_rows")
    keyed = whole(rows, columns, types)
    # rows that match nothing are dealt by what they hold, not sent to one task
    alone = [F.xxhash64(F.spark_partition_id(), F.lit(seed), *[comparable(_named(c), types[c]) for c in columns]) for seed in (1, 2)]
    full = F.col(_ROW).isNotNull()
    keyed = keyed.withColumns({name: F.when(full, d).otherwise(a) for name, d, a in zip((_ONE, _TWO), digests, alone)})
    joined = keyed.join(table, [_ONE, _TWO], "left")
    unmatched = ~full | F.col("__rw_rows").isNull() | ~F.array_contains("__rw_rows", F.col(_ROW))
    return joined.where(unmatched).select(*[_named(c) for c in rows.columns])
