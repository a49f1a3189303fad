"""DataFrame -> DataFrame operators."""

from upcheck.operators.columns import (
    SchemaCheck,
    SchemaMismatchError,
    check_schema,
    drop_all_null,
    normalise_columns,
    normalised_names,
    schema_report,
)
from upcheck.operators.audit import (
    AUDIT_FLAG_COL,
    AUDIT_LIST_COL,
    audit_schema,
    empty_audit,
    lookup_audit,
    summarize_audit,
    union_audit,
)
from upcheck.operators.reconcile import (
    ReconcileSpec,
    Reconciled,
    UnresolvedConflictError,
    align_authority,
    assert_resolved,
    assert_resolved_metrics,
    conflict_audit,
    conflict_status,
    exact_mismatches,
    reconcile,
    residual,
    unknown_ids,
)
from upcheck.operators.skew import keyed_join, repeat_rows
from upcheck.operators.validate import (
    TokenRule,
    clean_tokens,
    flag_tokens,
    invalid_columns,
    quarantine_by_key,
    validate_tokens,
)

__all__ = [
    "AUDIT_FLAG_COL", "AUDIT_LIST_COL", "ReconcileSpec", "Reconciled", "SchemaCheck",
    "SchemaMismatchError", "TokenRule", "UnresolvedConflictError", "align_authority",
    "assert_resolved", "assert_resolved_metrics", "audit_schema", "check_schema", "clean_tokens",
    "conflict_audit", "conflict_status", "flag_tokens", "drop_all_null", "empty_audit", "exact_mismatches",
    "invalid_columns", "lookup_audit", "normalise_columns", "normalised_names",
    "quarantine_by_key", "reconcile", "residual", "schema_report", "summarize_audit",
    "union_audit", "unknown_ids", "validate_tokens", "repeat_rows", "keyed_join",
]
