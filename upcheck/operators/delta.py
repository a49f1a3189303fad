"""Reconciliation kept up to date when the authority changes.

Whether a row conflicts, what its id's conflict list is and what it is rebuilt
from depend on the authority rows of its own id only.  So two snapshots of the
authority are compared by counts, and everything is worked out again for the ids
whose authority rows differ; all else is taken over from the run before.

``changed_ids`` is one aggregation over both snapshots (identity columns only,
partial, so copies collapse before the shuffle).  The ids are written: what
follows filters the upload's written identity counts, the new snapshot and, for
the rebuild, the upload by a semi join with them, before anything is shuffled by
tuple.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.operators.reconcile import (Conflicts, ReconcileSpec, align_authority, find_conflicts, identity_counts,
                                         per_id_table, rebuilt)
from upcheck.operators.skew import keyed_join
from upcheck.sources.storage import materialize


@dataclass
class Kept:
    """What one run leaves for the next: all written, all narrow."""

    authority: DataFrame  # aligned snapshot
    counts: DataFrame     # identity tuples of the upload
    found: Conflicts


@dataclass
class Update:
    """``ids`` are those whose authority rows changed; ``clean`` and ``audit`` replace what was there for them."""

    ids: DataFrame
    clean: DataFrame
    audit: DataFrame
    kept: Kept


def keep(upload: DataFrame, authority: DataFrame, spec: ReconcileSpec) -> Kept:
    """A full run that can be updated: its snapshot of the authority, tuple counts and conflicts."""
    auth = materialize(align_authority(authority, spec, upload), "authority")
    counts = materialize(identity_counts(upload, spec), "identity_counts")
    # the snapshot bears the upload's names already
    return Kept(auth, counts, find_conflicts(upload, auth, _aligned(spec), counts))


def _aligned(spec: ReconcileSpec) -> ReconcileSpec:
    return ReconcileSpec(spec.id_col, spec.attr_cols, spec.id_col, spec.attr_cols, spec.scope)


def clean_rows(upload: DataFrame, kept: Kept, spec: ReconcileSpec) -> DataFrame:
    """The upload's rows by the conflicts found: rebuilt, dropped or as they are."""
    return rebuilt(upload, per_id_table(kept.found, spec), spec).select(*upload.columns)


def changed_ids(old: DataFrame, new: DataFrame, spec: ReconcileSpec) -> DataFrame:
    """Distinct ids for which two aligned snapshots differ, as bags of identity tuples; nulls are values here."""
    keys = list(spec.keys)
    both = old.select(*keys, F.lit(-1).alias("__d")).unionByName(new.select(*keys, F.lit(1).alias("__d")))
    differing = both.groupBy(*keys).agg(F.sum("__d").alias("__d")).where("__d <> 0")
    return differing.select(spec.id_col).where(F.col(spec.id_col).isNotNull()).distinct()


def update(upload: DataFrame, kept: Kept, authority: DataFrame, spec: ReconcileSpec) -> Update:
    """Work out again what a new snapshot of the authority changes, from the tables of the last run."""
    auth = materialize(align_authority(authority, spec, upload), "authority")
    ids = materialize(changed_ids(kept.authority, auth, spec), "changed_ids")
    again = keyed_join(kept.counts, ids, spec.id_col, "left_semi")
    part = find_conflicts(upload, auth.join(ids, spec.id_col, "left_semi"), _aligned(spec), again)
    rows = keyed_join(upload, ids, spec.id_col, "left_semi").select(*upload.columns)
    clean = rebuilt(rows, per_id_table(part, spec), spec).select(*upload.columns)

    def replaced(before: DataFrame, now: DataFrame, name: str) -> DataFrame:
        return materialize(keyed_join(before, ids, spec.id_col, "left_anti").select(*before.columns).unionByName(now), name)
    found = Conflicts(auth, replaced(kept.found.tuples, part.tuples, "conflict_tuples"), replaced(kept.found.status, part.status, "conflict_status"))
    return Update(ids, clean, part.audit(spec), Kept(auth, kept.counts, found))


def replace_ids(before: DataFrame, now: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """``before`` with the rows of ``ids`` (written) replaced by ``now``."""
    return keyed_join(before, ids, id_col, "left_anti").select(*before.columns).unionByName(now.select(*before.columns))
