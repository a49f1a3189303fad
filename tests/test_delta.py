"""Updates after a change of the authority equal a full run on the new snapshot."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_reconcile_model import AU, SPEC, UP, model
from upcheck.operators import delta
from upcheck.operators.reconcile import reconcile


def _authority(rnd, ids):
    return [(i, rnd.choice(["S1", "S2", None]), rnd.choice([1, 2]), rnd.choice(["A", "B"])) for i in ids for _ in range(rnd.choice([0, 1, 1, 2]))]


@pytest.mark.parametrize("seed", range(3))
def test_updates_equal_full_runs(spark, seed):
    rnd = random.Random(seed)
    ids = [f"P{i}" for i in range(30)]
    rows = [(rnd.choice([*ids, None]), rnd.choice(["S1", "S2", None]), rnd.choice([1, 2, None]), rnd.choice(["A", "B"]), k) for k in range(150)]
    upload = spark.createDataFrame(rows, UP)
    auth = _authority(rnd, ids)
    kept = delta.keep(upload, spark.createDataFrame(auth, AU), SPEC)
    clean = delta.clean_rows(upload, kept, SPEC)
    assert Counter(map(tuple, clean.collect())) == model(rows, auth)[0]
    for _ in range(2):
        touched = rnd.sample(ids, 6)
        later = [a for a in auth if a[0] not in touched] + _authority(rnd, touched)
        changed = {i for i in touched if Counter(a for a in auth if a[0] == i) != Counter(a for a in later if a[0] == i)}
        change = delta.update(upload, kept, spark.createDataFrame(later, AU), SPEC)
        assert {r.id for r in change.ids.collect()} == changed
        expected, audit = model(rows, later)
        assert Counter(map(tuple, change.clean.collect())) == Counter({r: n for r, n in expected.items() if r[0] in changed})
        clean = delta.replace_ids(clean, change.clean, change.ids, "id")
        assert Counter(map(tuple, clean.collect())) == expected
        got = Counter((tuple(r)[:4], tuple(r.conflict_columns)) for r in change.kept.found.audit(SPEC).collect())
        assert got == audit
        assert {r.id for r in change.audit.select("id").collect()} <= changed
        kept, auth = change.kept, later


def test_nothing_changed(spark):
    upload = spark.createDataFrame([("P1", "S1", 1, "A", 1)], UP)
    authority = spark.createDataFrame([("P1", "S1", 1, "A"), ("P2", None, None, None)], AU)
    change = delta.update(upload, delta.keep(upload, authority, SPEC), authority.orderBy(F.desc("aid")), SPEC)
    assert change.ids.count() == change.clean.count() == change.audit.count() == 0


def test_only_touched_ids_are_joined(spark, scratch):
    """Of 2,000 ids one changes: its rows alone reach the joins by tuple and the rebuild."""
    rows = [(f"P{i}", "S1", 1, "A", i) for i in range(2000)]
    upload = spark.createDataFrame(rows, UP)
    auth = [(f"P{i}", "S1" if i % 2 else "S2", 1, "A") for i in range(2000)]
    kept = delta.keep(upload, spark.createDataFrame(auth, AU), SPEC)
    later = [a if a[0] != "P7" else ("P7", "S3", 1, "A") for a in auth]
    change = delta.update(upload, kept, spark.createDataFrame(later, AU), SPEC)
    assert [tuple(r) for r in change.clean.collect()] == [("P7", "S3", 1, "A", 7)]
    assert change.audit.count() == 1 and kept.found.status.count() == 1000 and change.kept.found.status.count() == 1001


@pytest.mark.parametrize("dedupe", [True, False])
def test_bag_form(spark, dedupe):
    """k conflicting rows, n rows and m authority rows of an id: n*m, or n*m*k."""
    upload = spark.createDataFrame([("P1", "S9", 1, "A", 1), ("P1", "S9", 1, "A", 2), ("P1", "S8", 1, "A", 3), ("P1", "S1", 1, "A", 4), ("P2", "S2", 1, "A", 5), ("X", "S1", 1, "A", 6)], UP)
    authority = spark.createDataFrame([("P1", "S1", 1, "A"), ("P1", "S3", 2, "B"), ("P2", "S2", 1, "A")], AU)
    clean = reconcile(upload, authority, SPEC, dedupe_ids=dedupe).clean
    got = Counter(map(tuple, clean.collect()))
    times = 1 if dedupe else 3
    assert got == Counter({("P1", s, r, a, pay): times for s, r, a in (("S1", 1, "A"), ("S3", 2, "B")) for pay in (1, 2, 3, 4)} | {("P2", "S2", 1, "A", 5): 1})


def test_bag_form_of_a_hot_id(spark):
    """One id with 300 conflicting rows: counts multiply, no stage joins k copies."""
    upload = spark.createDataFrame([("P1", "S9", 1, "A", k) for k in range(300)], UP)
    authority = spark.createDataFrame([("P1", "S1", 1, "A"), ("P1", "S2", 1, "A")], AU)
    assert reconcile(upload, authority, SPEC, dedupe_ids=False).clean.count() == 300 * 300 * 2
