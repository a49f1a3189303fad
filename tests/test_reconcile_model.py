"""Reconciliation against a brute-force Python model on random small inputs."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from upcheck.operators.reconcile import ReconcileSpec, reconcile

ATTRS = ("s", "r", "a")
SPEC = ReconcileSpec("id", ATTRS, "aid", ("as_", "ar", "aa"))
UP = T.StructType([T.StructField("id", T.StringType()), T.StructField("s", T.StringType()),
                   T.StructField("r", T.LongType()), T.StructField("a", T.StringType()),
                   T.StructField("pay", T.LongType())])
AU = T.StructType([T.StructField("aid", T.StringType()), T.StructField("as_", T.StringType()),
                   T.StructField("ar", T.LongType()), T.StructField("aa", T.StringType())])

ids = st.sampled_from(["P1", "P2", "P3", "X1", None])
svals = st.sampled_from(["S1", "S2", None])
rvals = st.sampled_from([1, 2, None])
avals = st.sampled_from(["A", "B", None])
up_rows = st.lists(st.tuples(ids, svals, rvals, avals, st.integers(0, 9)), min_size=1, max_size=12)
au_rows = st.lists(st.tuples(st.sampled_from(["P1", "P2", "P3"]), svals, rvals, avals), max_size=8)


def model(upload, auth):
    """The semantics written out per row, the slow obvious way."""
    def eq(x, y):  # SQL equality: null never equal
        return x is not None and y is not None and x == y

    def exact(t):
        return any(all(eq(x, y) for x, y in zip(t, a)) for a in auth)

    conflicts = [u for u in upload if not exact(u[:4])]
    known = {a[0] for a in auth}
    lists = {}
    for cid in {c[0] for c in conflicts}:
        rows = [c for c in conflicts if c[0] == cid]
        if cid is None or cid not in known:
            nulls = any(v is None for c in rows for v in c[:4])
            lists[cid] = ["id", *ATTRS] if nulls else ["id"]
        else:
            lists[cid] = [k for i, k in enumerate(ATTRS)
                          if any(not any(a[0] == cid and eq(a[1 + i], c[1 + i]) for a in auth)
                                 for c in rows)]
    audit = Counter((c[:4], tuple(lists[c[0]])) for c in conflicts
                    if c[0] is not None and lists[c[0]])
    conflict_ids = {c[0] for c in conflicts if c[0] is not None}
    clean = Counter()
    for u in upload:
        if u[0] in conflict_ids and u[0] not in known:
            continue
        if u[0] in conflict_ids:
            for a in auth:
                if a[0] == u[0]:
                    clean[(a[0], a[1], a[2], a[3], u[4])] += 1
        else:
            clean[u] += 1
    return clean, audit


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(up_rows, au_rows)
def test_reconcile_matches_model(spark, upload, auth):
    rec = reconcile(spark.createDataFrame(upload, UP), spark.createDataFrame(auth, AU), SPEC)
    exp_clean, exp_audit = model(upload, auth)
    assert Counter(tuple(r) for r in rec.clean.collect()) == exp_clean
    got_audit = Counter((tuple(r)[:4], tuple(r.conflict_columns)) for r in rec.audit.collect())
    assert got_audit == exp_audit
    for r in rec.audit.collect():
        assert r.resolved == ("no" if "id" in r.conflict_columns else "yes")
