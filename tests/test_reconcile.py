"""Reconciliation goldens (hand-derived) and invariants."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upcheck.operators.reconcile import (ReconcileSpec, UnresolvedConflictError, align_authority, assert_resolved, assert_resolved_metrics, conflict_audit, exact_mismatches, reconcile, residual)

SPEC = ReconcileSpec("id", ("sequence_id", "run", "antigen"), "sample_id", ("alias", "run", "antigen"))
AUTH_SCHEMA = T.StructType([T.StructField("sample_id", T.StringType()),
                            T.StructField("alias", T.StringType()),
                            T.StructField("run", T.LongType()),
                            T.StructField("antigen", T.StringType())])
UP_SCHEMA = T.StructType([T.StructField("id", T.StringType()),
                          T.StructField("sequence_id", T.StringType()),
                          T.StructField("run", T.LongType()),
                          T.StructField("antigen", T.StringType()),
                          T.StructField("pay", T.StringType())])

AUTH = [("P1", "S1", 21, "agA"), ("P2", "S2", 21, "agB"), ("P3", "S3a", 22, "agC"),
        ("P3", "S3b", 23, "agC"), ("P4", "S4", 21, "agD"), ("P5", "S5", 24, "agE")]
UPLOAD = [("P1", "S1", 21, "agA", "p1"),
          ("P2", "S9", 21, "agB", "p2"),
          ("P3", "S3a", 23, "agC", "p3"),
          ("P4", "S4", 21, None, "p4"),
          ("X9", "S1", 21, "agA", "p5"),
          ("X8", "S1", 21, None, "p6"),
          ("P5", "S5", 24, "agE", "p7"),
          ("P5", "bad", 25, "agE", "p8")]


@pytest.fixture()
def frames(spark):
    return (spark.createDataFrame(UPLOAD, UP_SCHEMA), spark.createDataFrame(AUTH, AUTH_SCHEMA))


def _audit_rows(df):
    return sorted((r.id, r.pay if "pay" in r else None, tuple(r.conflict_columns), r.resolved)
                  for r in df.collect())


def test_golden_clean(frames):
    up, auth = frames
    rec = reconcile(up, auth, SPEC)
    got = sorted(tuple(r) for r in rec.clean.collect())
    assert got == sorted([
        ("P1", "S1", 21, "agA", "p1"),
        ("P2", "S2", 21, "agB", "p2"),
        ("P3", "S3a", 22, "agC", "p3"),
        ("P3", "S3b", 23, "agC", "p3"),
        ("P4", "S4", 21, "agD", "p4"),
        ("P5", "S5", 24, "agE", "p7"),
        ("P5", "S5", 24, "agE", "p8"),
    ])
    assert rec.metrics.get["replaced_rows"] == 6
    assert_resolved(rec)
    assert residual(rec.clean, auth, SPEC).count() == 0


def test_golden_audit(frames):
    up, auth = frames
    rec = reconcile(up, auth, SPEC)
    got = sorted((r.id, r.sequence_id, tuple(r.conflict_columns), r.resolved) for r in rec.audit.collect())
    assert got == sorted([
        ("P2", "S9", ("sequence_id",), "yes"),
        ("P4", "S4", ("antigen",), "yes"),
        ("X9", "S1", ("id",), "no"),
        ("X8", "S1", ("id", "sequence_id", "run", "antigen"), "no"),
        ("P5", "bad", ("sequence_id", "run"), "yes"),
    ])
    assert rec.audit.columns == ["id", "sequence_id", "run", "antigen", "conflict_columns", "resolved"]
    # the stand-alone audit operator agrees
    assert sorted(map(tuple, conflict_audit(up, auth, SPEC).collect())) == \
        sorted(map(tuple, rec.audit.collect()))


def test_duplicate_conflicting_rows_not_multiplied(spark):
    up = spark.createDataFrame([("P2", "S9", 21, "agB", "a"), ("P2", "S9", 21, "agB", "b")], UP_SCHEMA)
    auth = spark.createDataFrame([AUTH[1]], AUTH_SCHEMA)
    rec = reconcile(up, auth, SPEC)
    assert sorted(r.pay for r in rec.clean.collect()) == ["a", "b"]
    assert rec.audit.count() == 2  # one audit row per conflicting upload row (bag)


def test_null_id_is_fatal_or_quarantined(spark):
    up = spark.createDataFrame([(None, "S1", 21, "agA", "n"), ("P1", "S1", 21, "agA", "ok")], UP_SCHEMA)
    auth = spark.createDataFrame(AUTH, AUTH_SCHEMA)
    rec = reconcile(up, auth, SPEC)
    with pytest.raises(UnresolvedConflictError):
        assert_resolved(rec)
    q = reconcile(up, auth, SPEC, on_unresolvable="quarantine")
    assert [r.pay for r in q.clean.collect()] == ["ok"]
    rows = q.audit.collect()
    assert len(rows) == 1 and rows[0].id is None and rows[0].resolved == "no"
    assert list(rows[0].conflict_columns) == ["id", "sequence_id", "run", "antigen"]


def test_authority_null_value_is_fatal(spark):
    up = spark.createDataFrame([("P1", "S9", 21, "agA", "x")], UP_SCHEMA)
    auth = spark.createDataFrame([("P1", "S1", 21, None)], AUTH_SCHEMA)
    rec = reconcile(up, auth, SPEC)
    with pytest.raises(UnresolvedConflictError):
        assert_resolved(rec)
    assert residual(rec.clean, auth, SPEC).count() == 1


def test_no_conflicts_gives_empty_audit(spark):
    up = spark.createDataFrame([("P1", "S1", 21, "agA", "x")], UP_SCHEMA)
    auth = spark.createDataFrame(AUTH, AUTH_SCHEMA)
    rec = reconcile(up, auth, SPEC)
    assert rec.audit.count() == 0 and rec.clean.count() == 1


def _naive_audit(spark, up, auth):
    """The step-by-step anti-join form, per column, as the source describes it."""
    a = align_authority(auth, SPEC, up)
    mis = exact_mismatches(up, a, SPEC.keys)
    unk = mis.join(a.select("id").distinct(), "id", "left_anti")
    lists = {}
    for r in unk.collect():
        lists.setdefault(r.id, ["id"])
    rest = mis.join(unk, list(SPEC.keys), "left_anti")
    for c in SPEC.attr_cols:
        bad = rest.join(a.select("id", c), ["id", c], "left_anti")
        for r in bad.select("id").collect():
            lst = lists.setdefault(r.id, [])
            if c not in lst:
                lst.append(c)
    return sorted((r.id, r.sequence_id, r.run, r.antigen, tuple(lists[r.id]))
                  for r in mis.collect() if r.id in lists and lists[r.id])


def test_one_pass_audit_equals_anti_join_form(spark):
    from upcheck.plans import fixtures as fx
    up = fx.spark_fixture(spark, "/root/testdata/sf0.001", fx.SUB)
    auth = fx.spark_fixture(spark, "/root/testdata/sf0.001", fx.AUTH)
    got = sorted((r.id, r.sequence_id, r.run, r.antigen, tuple(r.conflict_columns))
                 for r in reconcile(up, auth, SPEC).audit.collect())
    assert got == _naive_audit(spark, up, auth)
    assert len(got) > 100


def test_invariants_on_fixture(spark):
    from upcheck.plans import fixtures as fx
    sf = "/root/testdata/sf0.001"
    up = fx.spark_fixture(spark, sf, fx.SUB)
    auth = fx.spark_fixture(spark, sf, fx.AUTH)
    rec = reconcile(up, auth, SPEC)
    clean = rec.clean.cache()
    unknown = {r.id for r in rec.audit.where(F.col("resolved") == "no").collect()}
    assert unknown and not unknown & {r.id for r in clean.select("id").collect()}
    again = reconcile(clean, auth, SPEC)  # idempotent
    assert again.audit.count() == 0
    assert sorted(map(tuple, again.clean.collect())) == sorted(map(tuple, clean.collect()))


def test_observed_residual_equals_full_recheck(spark):
    from upcheck.operators.reconcile import assert_resolved_metrics
    up = spark.createDataFrame([(None, "S1", 21, "agA", "n"), ("P1", "S9", 21, "agA", "x"),
                                ("P2", "S2", 21, "agB", "ok")], UP_SCHEMA)
    auth = spark.createDataFrame([("P1", "S1", 21, None), ("P2", "S2", 21, "agB")], AUTH_SCHEMA)
    rec = reconcile(up, auth, SPEC)
    rows = rec.clean.collect()
    assert len(rows) == 3
    assert rec.metrics.get["unresolved_rows"] == residual(rec.clean, auth, SPEC).count() == 2
    with pytest.raises(UnresolvedConflictError):
        assert_resolved_metrics(rec)


def test_fractional_authority_value_is_a_conflict(spark):
    up = spark.createDataFrame([("P1", "S1", 1, "A")], "id string, sequence_id string, run bigint, antigen string")
    auth = spark.createDataFrame([("P1", "S1", 1.5, "A")], "id string, sequence_id string, run double, antigen string")
    spec = ReconcileSpec("id", ("sequence_id", "run", "antigen"), "id", ("sequence_id", "run", "antigen"))
    audit = reconcile(up, auth, spec).audit.collect()
    assert [r.conflict_columns for r in audit] == [["run"]]
    with pytest.raises(UnresolvedConflictError):
        reconcile(up, auth, spec, on_unresolvable="fail")


def test_missing_metric_is_an_error(spark):
    class Rec:
        class metrics:
            get = {}
    with pytest.raises(KeyError):
        assert_resolved_metrics(Rec)


def test_scopes_are_uploads_of_their_own(spark):
    up = spark.createDataFrame([("a", "P1", "S9", 1, "A"), ("b", "P1", "S1", 1, "A")], "file string, id string, sequence_id string, run int, antigen string")
    auth = spark.createDataFrame([("P1", "S1", 1, "A"), ("P1", "S2", 1, "A")], "id string, sequence_id string, run int, antigen string")
    spec = ReconcileSpec("id", ("sequence_id", "run", "antigen"), "id", ("sequence_id", "run", "antigen"), scope=("file",))
    rec = reconcile(up, auth, spec)
    assert sorted((r.file, r.sequence_id) for r in rec.clean.collect()) == [("a", "S1"), ("a", "S2"), ("b", "S1")]
    assert [(r.file, r.sequence_id) for r in rec.audit.collect()] == [("a", "S9")]
