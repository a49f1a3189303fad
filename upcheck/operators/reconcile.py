"""Reconciliation of an upload with an authoritative cross-reference table.

The upload's identity columns (an id plus attributes such as sequence id, run
and antigen) must match one authority row exactly.  Rows that do not are
*conflicts*.  For every conflicting id the library records which columns
disagree (the audit), drops ids the authority does not know, and rebuilds all
rows of the other conflicting ids from the authority's values.

Plan shape (all declarative, Catalyst/AQE choose the physical joins):

1. ``groupBy(identity tuple).count()`` of the upload, ``left_anti`` the
   distinct authority tuples -> conflicting tuples with their row counts.
   The aggregation is partial, so a hot group of identical rows collapses
   map-side before the shuffle; only identity columns are read.
2. the conflicting tuples are unpivoted into ``(id, column, value)`` entries
   and left-joined to the distinct entries of the authority rows of those
   ids; one ``groupBy(id)`` of booleans gives, per id, whether the id is
   unknown and which columns disagree.  Aggregates are bounded (no per-id
   lists of values), so an id holding a third of all rows costs no more
   memory than any other.
3. one join of the upload, keyed by id, with the per-id status extended by
   the authority rows of the conflicting known ids splits the rows into
   kept / dropped / rebuilt.  That side is written first (it holds only ids
   that conflict): AQE broadcasts it when it measures it small, and splits
   hot ids of the upload otherwise (``skew``).
4. the audit is the conflicting tuples of listed ids repeated by their
   counts (bounded arrays) - no second pass over the upload.

With ``scope`` columns in the spec (say, the file a row came from) each scope
is an upload of its own: statuses, rebuilds and the audit are per (scope, id).

Nulls never match in any join (plain equality), as in the source semantics:
a null attribute always conflicts, a null id is never known.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upcheck.operators.audit import AUDIT_LIST_COL, as_audit
from upcheck.operators.skew import keyed_join, repeat_rows
from upcheck.sources.storage import materialize

# internal column names (prefixed so they cannot clash with upload columns)
_CNAME = "__uc_col"
_VALUE = "__uc_val"
_HIT = "__uc_hit"
_ANYNULL = "__uc_anynull"
_UNKNOWN = "__uc_unknown"
_FLAG = "__uc_f"
_FIX = "__uc_a"
_FIXED = "__uc_fix"
_BAD = "__uc_bad"
_TIMES = "__uc_times"


class UnresolvedConflictError(RuntimeError):
    """Rows still disagree with the authority after reconciliation."""


@dataclass(frozen=True)
class ReconcileSpec:
    """Identity columns of the upload and their authority counterparts.

    ``attr_cols[i]`` pairs with ``authority_attrs[i]``; the id pairs with
    ``authority_id``.  The order of ``attr_cols`` is the order of names in
    ``conflict_columns``.
    """

    id_col: str
    attr_cols: tuple[str, ...]
    authority_id: str
    authority_attrs: tuple[str, ...]
    scope: tuple[str, ...] = ()

    def __post_init__(self):
        if len(self.attr_cols) != len(self.authority_attrs):
            raise ValueError("attr_cols and authority_attrs must pair up")

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.id_col, *self.attr_cols)

    @property
    def ids(self) -> tuple[str, ...]:
        """What one status is for: the id, within its scope."""
        return (*self.scope, self.id_col)

    @property
    def audit_keys(self) -> tuple[str, ...]:
        return (*self.scope, *self.keys)


@dataclass
class Reconciled:
    clean: DataFrame          # upload rows, conflicts replaced, unknown ids dropped
    audit: DataFrame          # one row per conflicting upload row (audit schema)
    unresolved: DataFrame     # rows of ``clean`` that still cannot match (null id, null authority value)
    metrics: Observation      # rows, replaced_rows, unresolved_rows (after an action on ``clean``)


def align_authority(authority: DataFrame, spec: ReconcileSpec,
                    upload: DataFrame | None = None) -> DataFrame:
    """Project the authority onto the upload's identity names (and types).

    A number that the upload's type cannot hold exactly (1.5 as an integer)
    becomes null, so it matches nothing: a value is never bent until it fits.
    """
    types = {f.name: f.dataType for f in upload.schema.fields} if upload is not None else {}
    have = {f.name: f.dataType for f in authority.schema.fields}
    cols = []
    for src, dst in zip((spec.authority_id, *spec.authority_attrs), spec.keys):
        c = F.col(src)
        if dst in types and types[dst] != have[src]:
            cast = c.try_cast(types[dst])
            if isinstance(have[src], T.NumericType) and isinstance(types[dst], T.NumericType):
                cast = F.when(cast.cast(have[src]) == c, cast)
            c = cast
        cols.append(c.alias(dst))
    return authority.select(*cols)


def exact_mismatches(upload: DataFrame, authority: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upload identity tuples without an exactly equal authority tuple (bag)."""
    keys = list(keys)
    return upload.select(*keys).join(authority.select(*keys), keys, "left_anti")


def unknown_ids(upload: DataFrame, authority: DataFrame, id_col: str) -> DataFrame:
    """Distinct upload ids absent from the authority (a null id is never known)."""
    return (upload.select(id_col).distinct()
            .join(authority.select(id_col).distinct(), id_col, "left_anti"))


def _entries(df: DataFrame, spec: ReconcileSpec, ids: Sequence[str], with_nullflag: bool) -> DataFrame:
    # the id itself is in every entry, so its own one has no value but says that it is there
    values = [F.when(F.col(k).isNotNull(), F.lit("")) if i == 0 else F.col(k).cast("string") for i, k in enumerate(spec.keys)]
    pairs = F.array(*[F.struct(F.lit(i).cast("tinyint").alias(_CNAME), v.alias(_VALUE)) for i, v in enumerate(values)])
    cols = [F.col(c) for c in ids]
    if with_nullflag:
        cols.append(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys]).alias(_ANYNULL))
    return df.select(*cols, F.inline(pairs))


def conflict_status(conflicts: DataFrame, authority: DataFrame, spec: ReconcileSpec) -> DataFrame:
    """Per conflicting id: ``(scope..., id, __uc_unknown, conflict_columns)``.

    * unknown id -> ``[id]``, plus every attribute when one of the id's
      conflicting rows has a null identity value (such a row cannot be set
      aside as 'unknown only' because nulls never compare equal);
    * known id -> each attribute for which no authority row of that id has
      the row's value (null always disagrees), in ``attr_cols`` order;
    * an id whose values all occur, but never together in one authority row,
      gets an empty list: it is rebuilt, but not audited.

    ``conflicts`` holds conflicting identity tuples (distinct or not); the
    null id, if present, forms one group.
    """
    entries = (_entries(conflicts, spec, spec.ids, with_nullflag=True)
               .groupBy(*spec.ids, _CNAME, _VALUE).agg(F.bool_or(_ANYNULL).alias(_ANYNULL)))
    # only authority rows of ids that conflict can matter: filter before
    # unpivoting.  The ids are distinct and written, so that an id with very many
    # conflicting tuples is one row here, and AQE can split a hot id of the authority
    hit = materialize(conflicts.select(spec.id_col).where(F.col(spec.id_col).isNotNull()).distinct(), "conflict_ids")
    relevant = authority.join(hit, spec.id_col, "left_semi")
    known = (_entries(relevant, spec, [spec.id_col], with_nullflag=False)
             .where(F.col(_VALUE).isNotNull())
             .distinct()
             .withColumn(_HIT, F.lit(True)))
    miss = F.col(_HIT).isNull()
    flags = (entries.join(known, [spec.id_col, _CNAME, _VALUE], "left")
             .groupBy(*spec.ids)
             .agg(F.bool_or((F.col(_CNAME) == 0) & miss).alias(_UNKNOWN),
                  F.bool_or(_ANYNULL).alias(_ANYNULL),
                  *[F.bool_or((F.col(_CNAME) == i + 1) & miss).alias(f"{_FLAG}{i}")
                    for i in range(len(spec.attr_cols))]))
    unknown_list = F.array(F.lit(spec.id_col),
                           *[F.when(F.col(_ANYNULL), F.lit(k)) for k in spec.attr_cols])
    known_list = F.array(*[F.when(F.col(f"{_FLAG}{i}"), F.lit(k))
                           for i, k in enumerate(spec.attr_cols)])
    lst = F.array_compact(F.when(F.col(_UNKNOWN), unknown_list).otherwise(known_list))
    return flags.select(*spec.ids, _UNKNOWN, lst.alias(AUDIT_LIST_COL))


def _resolved_flag(spec: ReconcileSpec) -> Column:
    return F.when(F.array_contains(AUDIT_LIST_COL, spec.id_col), F.lit("no")).otherwise(F.lit("yes"))


def _audit_rows(tuples: DataFrame, status: DataFrame, spec: ReconcileSpec) -> DataFrame:
    """One audit row per conflicting upload row, built from the conflicting
    tuples and their row counts (no second pass over the upload): each tuple
    of an id with a non-empty list is repeated as often as it occurs."""
    listed = status.where(F.size(AUDIT_LIST_COL) > 0).select(*spec.ids, AUDIT_LIST_COL)
    rows = tuples.where(F.col(spec.id_col).isNotNull()).join(listed, list(spec.ids))
    return as_audit(repeat_rows(rows, "count", most=_largest(tuples, "count")), spec.audit_keys, F.col(AUDIT_LIST_COL), _resolved_flag(spec))


def _largest(table: DataFrame, column: str) -> int:
    """The largest number in a column of a written table."""
    return table.agg(F.max(column)).first()[0] or 0


@dataclass
class Conflicts:
    """The narrow, written tables that decide everything about an upload's ids."""

    authority: DataFrame  # aligned
    tuples: DataFrame     # conflicting identity tuples with their number of rows
    status: DataFrame     # per conflicting non-null id

    def audit(self, spec: ReconcileSpec) -> DataFrame:
        return _audit_rows(self.tuples, self.status, spec)

    def fixes(self, spec: ReconcileSpec) -> DataFrame:
        """``(scope..., id, __uc_a0...)``: the authority rows of conflicting known ids."""
        known = self.status.where(~F.col(_UNKNOWN)).select(*spec.ids)
        values = self.authority.select(spec.id_col, *[F.col(k).alias(f"{_FIX}{i}") for i, k in enumerate(spec.attr_cols)])
        return known.join(values, spec.id_col)


def identity_counts(upload: DataFrame, spec: ReconcileSpec) -> DataFrame:
    """Identity tuples and how often they occur (one narrow pass; hot copies collapse before the shuffle)."""
    return upload.groupBy(*spec.audit_keys).count()


def find_conflicts(upload: DataFrame, authority: DataFrame, spec: ReconcileSpec, counts: DataFrame | None = None) -> Conflicts:
    """Compare identity tuples and write the conflicting ones and their ids' status.

    ``counts`` are the upload's ``identity_counts`` where they are written already."""
    auth = align_authority(authority, spec, upload)
    keys = list(spec.keys)
    counts = identity_counts(upload, spec) if counts is None else counts
    tuples = materialize(counts.join(auth.select(*keys).distinct(), keys, "left_anti"), "conflict_tuples")
    status = conflict_status(tuples, auth, spec).where(F.col(spec.id_col).isNotNull())
    return Conflicts(auth, tuples, materialize(status, "conflict_status"))


def conflict_audit(upload: DataFrame, authority: DataFrame, spec: ReconcileSpec) -> DataFrame:
    """Audit rows for every conflicting upload row (no row-level rebuild)."""
    found = find_conflicts(upload, authority, spec)
    # a null id is never known and never equal to anything: each such row
    # conflicts on every identity column
    null_rows = repeat_rows(found.tuples.where(F.col(spec.id_col).isNull()), "count", most=_largest(found.tuples, "count"))
    every = F.array(*[F.lit(k) for k in spec.keys])
    return found.audit(spec).unionByName(as_audit(null_rows, spec.audit_keys, every, F.lit("no")))


def per_id_table(found: Conflicts, spec: ReconcileSpec, more: DataFrame | None = None, times: bool = False) -> DataFrame:
    """Per conflicting id one row (unknown) or its authority rows (known); ids
    of ``more`` (``(scope..., id, flags...)``) are joined in.  With ``times`` each
    also says how many rows of the id conflict.  Written: it is the one table
    that upload rows meet."""
    ids = list(spec.ids)
    fixes = found.fixes(spec).withColumn(_FIXED, F.lit(True))
    table = found.status.select(*ids, _UNKNOWN)
    if times:
        table = table.join(found.tuples.groupBy(*ids).agg(F.sum("count").alias(_TIMES)), ids)
    table = table.join(fixes, ids, "left")
    return materialize(table if more is None else table.join(more, ids, "full"), "per_id")


def rebuilt(rows: DataFrame, table: DataFrame, spec: ReconcileSpec) -> DataFrame:
    """``rows`` and the columns of ``table`` (``per_id_table``): rows of unknown ids
    are dropped; a row of a conflicting known id meets every authority row of
    its id and takes their identity values (n rows and m of the authority make
    n*m; with how often the id conflicts in ``table``, each as often: n*m*k by
    arithmetic, expanded after the join).  ``__uc_fix`` says which were rebuilt, ``__uc_bad`` which can never match."""
    joined = keyed_join(rows, table, spec.ids, "left").where(~F.coalesce(F.col(_UNKNOWN), F.lit(False)))
    fix = F.coalesce(F.col(_FIXED), F.lit(False))
    place = {k: i for i, k in enumerate(spec.attr_cols)}
    more = [c for c in table.columns if c not in spec.ids and not c.startswith(_FIX) and c not in (_UNKNOWN, _FIXED, _TIMES)]
    if _TIMES in table.columns:
        joined = repeat_rows(joined.withColumn(_TIMES, F.when(fix, F.col(_TIMES)).otherwise(F.lit(1))), _TIMES, most=_largest(table, _TIMES))
    out = joined.select(
        *[F.when(fix, F.col(f"{_FIX}{place[c]}")).otherwise(F.col(c)).alias(c) if c in place else F.col(c)
          for c in rows.columns], *more, fix.alias(_FIXED))
    bad = F.col(spec.id_col).isNull() | (F.col(_FIXED) & reduce(
        lambda a, b: a | b, [F.col(k).isNull() for k in spec.attr_cols]))
    return out.withColumn(_BAD, bad)


def count_unresolvable(found: Conflicts, spec: ReconcileSpec) -> int:
    """Identity tuples that can never match: a null id, or a conflicting id one
    of whose authority rows has a null attribute.  Reads narrow tables only."""
    nulls = found.tuples.where(F.col(spec.id_col).isNull())
    any_null = reduce(lambda a, b: a | b, [F.col(f"{_FIX}{i}").isNull() for i in range(len(spec.attr_cols))])
    return nulls.count() + found.fixes(spec).where(any_null).count()


def quarantine_rows(rows: DataFrame, spec: ReconcileSpec) -> DataFrame:
    """Audit rows for ``rows`` (with ``__uc_bad``) that can never match."""
    keys = list(spec.keys)
    null_list = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys]))
    every = F.array(*[F.lit(k) for k in keys])
    return as_audit(rows.where(F.col(_BAD)), spec.audit_keys,
                    F.when(F.col(spec.id_col).isNull(), every).otherwise(null_list), F.lit("no"))


def observed(rows: DataFrame, obs: Observation) -> DataFrame:
    """Count rows, rebuilt rows and rows that can never match while they pass."""
    return rows.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col(_FIXED), 1)).alias("replaced_rows"),
        F.count(F.when(F.col(_BAD), 1)).alias("unresolved_rows"))


def reconcile(upload: DataFrame, authority: DataFrame, spec: ReconcileSpec,
              on_unresolvable: str = "keep", dedupe_ids: bool = True) -> Reconciled:
    """Compare identity columns with the authority; return clean rows and the audit.

    ``on_unresolvable``: ``'fail'`` raises at once when a row can never match
    (null id, or a rebuild from an authority row with a null value), decided
    from the narrow tables; ``'keep'`` keeps such rows in ``clean`` and lists
    them in ``unresolved`` too; ``'quarantine'`` moves them from ``clean`` into
    the audit with ``resolved='no'``.

    ``dedupe_ids=False`` is the bag form: an id with k conflicting rows is
    rebuilt k times, so its n rows and m authority rows make n*m*k.

    The conflicting tuples and the per-id table are written (they hold
    conflicting ids only).  The clean rows are then lazy: one pass over the
    upload with one join by id.
    """
    if on_unresolvable not in ("fail", "keep", "quarantine"):
        raise ValueError("on_unresolvable must be 'fail', 'keep' or 'quarantine'")
    found = find_conflicts(upload, authority, spec)
    if on_unresolvable == "fail" and (n := count_unresolvable(found, spec)):
        raise _unresolved_error(n)
    obs = Observation()  # unique name: reconciled frames may be reconciled again
    rows = rebuilt(upload, per_id_table(found, spec, times=not dedupe_ids), spec)
    both = observed(rows, obs)
    audit = found.audit(spec)
    if on_unresolvable == "quarantine":
        audit = audit.unionByName(quarantine_rows(rows, spec))
        both = both.where(~F.col(_BAD))
    unresolved = (rows.where(F.col(_BAD)) if on_unresolvable != "quarantine" else rows.limit(0)).select(*upload.columns)
    return Reconciled(clean=both.select(*upload.columns), audit=audit, unresolved=unresolved, metrics=obs)


def residual(clean: DataFrame, authority: DataFrame, spec: ReconcileSpec) -> DataFrame:
    """Identity tuples of ``clean`` still without an exact authority match
    (the full re-check; ``Reconciled.unresolved`` is its cheap equivalent)."""
    auth = align_authority(authority, spec, clean)
    return exact_mismatches(clean, auth, spec.keys)


def _unresolved_error(n: int) -> UnresolvedConflictError:
    return UnresolvedConflictError(
        f"{n} identity tuple(s) or row(s) still disagree with the authority after reconciliation "
        "(null id, or authority rows with null identity values)")


def assert_resolved(rec_or_rows: Reconciled | DataFrame) -> None:
    """Raise if rows cannot match the authority (runs a job on the rows)."""
    rows = rec_or_rows.unresolved if isinstance(rec_or_rows, Reconciled) else rec_or_rows
    if not rows.isEmpty():
        raise _unresolved_error(rows.count())


def assert_resolved_metrics(rec: Reconciled) -> None:
    """Raise from the metrics observed while ``rec.clean`` was computed (no extra job)."""
    n = rec.metrics.get["unresolved_rows"]  # a missing metric is an error, not a pass
    if n:
        raise _unresolved_error(n)
