"""Per-column anti joins: which rows have a value that their id does not have in the authority.

``column_mismatches`` is one such join.  ``status_by_columns`` puts one for each
identity column in place of the single join on unpivoted entries that
``conflict_status`` makes; the result is the same.  ``chosen_status`` takes the
cheaper one by written sizes: entries travel as (id, column, value) texts, once
for all columns; pairs of a column travel in its own type, without duplicates, but
each column is a join of its own.  So columns pay when values repeat within ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.operators.audit import AUDIT_LIST_COL
from upcheck.operators.reconcile import ReconcileSpec, conflict_status
from upcheck.operators.skew import keyed_join
from upcheck.sources.storage import materialize

ENTRIES, COLUMNS = "entries", "columns"
#: Pairs of all columns may be this share of the entries for columns to be taken.
SHARE = 0.5


def column_mismatches(rows: DataFrame, authority: DataFrame, spec: ReconcileSpec, column: str) -> DataFrame:
    """Rows (bag) whose (id, ``column``) no row of the aligned authority has; a null matches nothing."""
    pairs = materialize(authority.select(spec.id_col, column).dropna().distinct(), f"pairs_{column}")
    return keyed_join(rows, pairs, [spec.id_col, column], "left_anti").select(*rows.columns)


def _distinct(conflicts: DataFrame, spec: ReconcileSpec) -> dict[str, DataFrame]:
    """Per attribute the distinct (scope..., id, value) of conflicting tuples, written."""
    return {k: materialize(conflicts.select(*spec.ids, k).distinct(), f"values_{k}") for k in spec.attr_cols}


def status_by_columns(conflicts: DataFrame, authority: DataFrame, spec: ReconcileSpec, values: dict[str, DataFrame] | None = None) -> DataFrame:
    """``conflict_status`` by one anti join for the id and one for each attribute."""
    ids, values = list(spec.ids), values or _distinct(conflicts, spec)
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys])
    every = materialize(conflicts.groupBy(*ids).agg(F.bool_or(null).alias("__cw_null")), "conflict_ids")
    hit = materialize(every.select(spec.id_col).where(F.col(spec.id_col).isNotNull()).distinct(), "ids")
    relevant = materialize(authority.join(hit, spec.id_col, "left_semi"), "relevant")
    unknown = keyed_join(every, materialize(relevant.select(spec.id_col).distinct(), "known"), spec.id_col, "left_anti").select(*ids, F.lit(-1).alias("__cw_at"))
    wrong = [column_mismatches(values[k], relevant, spec, k).select(*ids, F.lit(i).alias("__cw_at")).distinct() for i, k in enumerate(spec.attr_cols)]
    found = reduce(DataFrame.unionByName, [every.select(*ids, F.lit(None).cast("int").alias("__cw_at")), unknown, *wrong])
    flags = found.groupBy(*ids).agg(*[F.coalesce(F.bool_or(F.col("__cw_at") == i), F.lit(False)).alias(f"__cw_{i + 1}") for i in range(-1, len(spec.attr_cols))])
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ids])
    joined = flags.alias("l").join(every.alias("r"), same).select(*[F.col(f"l.{c}") for c in flags.columns], "__cw_null")
    unknown_list = F.array(F.lit(spec.id_col), *[F.when(F.col("__cw_null"), F.lit(k)) for k in spec.attr_cols])
    known_list = F.array(*[F.when(F.col(f"__cw_{i + 1}"), F.lit(k)) for i, k in enumerate(spec.attr_cols)])
    listed = F.array_compact(F.when(F.col("__cw_0"), unknown_list).otherwise(known_list))
    return joined.select(*ids, F.col("__cw_0").alias("__uc_unknown"), listed.alias(AUDIT_LIST_COL))


def chosen(conflicts: DataFrame, spec: ReconcileSpec) -> tuple[str, dict[str, DataFrame]]:
    """The strategy, and the written values by column that decided it."""
    values = _distinct(conflicts, spec)
    pairs = sum(v.count() for v in values.values())
    tuples = conflicts.select(*spec.audit_keys).distinct().count()
    return (COLUMNS if pairs <= SHARE * tuples * len(spec.attr_cols) else ENTRIES), values


def chosen_status(conflicts: DataFrame, authority: DataFrame, spec: ReconcileSpec) -> DataFrame:
    """``conflict_status`` by the strategy that moves less."""
    strategy, values = chosen(conflicts, spec)
    return status_by_columns(conflicts, authority, spec, values) if strategy == COLUMNS else conflict_status(conflicts, authority, spec)
