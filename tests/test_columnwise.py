"""Per-column anti joins: the same status as the join on entries, and the choice between both."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_reconcile_model import AU, SPEC, UP
from upcheck.operators import columnwise
from upcheck.operators.reconcile import align_authority, conflict_status, find_conflicts
from upcheck.plans import fixtures as fx
from upcheck.plans.catalog import DUP_SPEC


def _sorted(df):
    return sorted((str(r[:-1]), tuple(r[-1])) for r in map(tuple, df.select(*sorted(set(df.columns) - {"conflict_columns"}), "conflict_columns").collect()))


@pytest.mark.parametrize("scoped", [False, True])
def test_both_strategies_agree(spark, scoped):
    rnd = random.Random(2)
    ids = [f"P{i}" for i in range(12)]
    rows = [(rnd.choice([*ids, "X", None]), rnd.choice(["S1", "S2", None]), rnd.choice([1, 2, None]), rnd.choice(["A", "B", None]), k % 2) for k in range(150)]
    upload = spark.createDataFrame(rows, UP)
    authority = spark.createDataFrame([(rnd.choice(ids[:9]), rnd.choice(["S1", "S2", None]), rnd.choice([1, 2]), rnd.choice(["A", "B"])) for _ in range(14)], AU)
    spec = replace(SPEC, scope=("pay",)) if scoped else SPEC
    found = find_conflicts(upload, authority, spec)
    a, b = conflict_status(found.tuples, found.authority, spec), columnwise.status_by_columns(found.tuples, found.authority, spec)
    assert _sorted(a) == _sorted(b) and a.count() > 8


def test_both_strategies_agree_on_repeated_ids(spark):
    sf = "/root/testdata/sf0.001"
    up, auth = fx.spark_fixture(spark, sf, fx.DUP_UPLOAD), fx.spark_fixture(spark, sf, fx.DUP_AUTH)
    found = find_conflicts(up, auth, DUP_SPEC)
    assert _sorted(conflict_status(found.tuples, found.authority, DUP_SPEC)) == _sorted(columnwise.status_by_columns(found.tuples, found.authority, DUP_SPEC))


def test_the_choice_goes_by_sizes(spark):
    apart = spark.range(60).select(F.concat(F.lit("P"), "id").alias("id"), F.concat(F.lit("S"), "id").alias("s"), F.col("id").alias("r"), F.lit("A").alias("a"))
    assert columnwise.chosen(apart, SPEC)[0] == columnwise.ENTRIES  # every tuple has values of its own
    same = spark.range(60).select(F.lit("P1").alias("id"), F.lit("S").alias("s"), F.col("id").alias("r"), F.lit("A").alias("a"))
    assert columnwise.chosen(same, SPEC)[0] == columnwise.COLUMNS  # one id, values repeat
    auth = align_authority(spark.createDataFrame([("P1", "S", 3, "B")], AU), SPEC)
    for tuples in (apart, same):
        assert _sorted(columnwise.chosen_status(tuples, auth, SPEC)) == _sorted(conflict_status(tuples, auth, SPEC))
