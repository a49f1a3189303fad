"""A hot id holding a third of all rows: sort-merge joins with AQE skew splitting."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_reconcile_model import AU, SPEC, UP, model
from upcheck.operators.reconcile import reconcile
from upcheck.operators.skew import keyed_join, repeat_rows
from upcheck.operators.validate import TokenRule, quarantine_by_key, validate_tokens

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",          # force shuffled joins
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _data():
    upload = []
    for i in range(3000):
        if i % 3 == 0:   # hot id, conflicting sequence id on every other row
            upload.append(("HOT", "S9" if i % 2 else "S1", 1, "A", i))
        else:
            pid = f"P{i % 400}"
            upload.append((pid, "S1" if i % 7 else "S2", 1, "A" if i % 11 else None, i))
    auth = [("HOT", "S1", 1, "A"), ("HOT", "S1", 2, "A")] + [(f"P{j}", "S1", 1, "A") for j in range(350)]
    return upload, auth


def _tasks(spark, out, path, where):
    """How many tasks wrote rows that ``where`` holds for."""
    out.write.parquet(path)
    return spark.read.parquet(path).where(where).select(F.col("_metadata.file_path").alias("f")).distinct().count()


def test_keyed_join_is_the_plain_join(spark):
    big = spark.createDataFrame([("H", i) for i in range(500)] + [("a", 1), (None, 2), (None, 2)], "k string, v int")
    small = spark.createDataFrame([("H", 10), ("H", 11), ("a", 12), ("b", 13), (None, 14)], "k string, w int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(map(str, big.join(small, "k", how).collect()))
        assert plain == sorted(map(str, keyed_join(big, small, "k", how).collect())), how


def test_null_keys_spread(spark, skew_conf, scratch):
    spark.range(6000).selectExpr("case when id % 3 = 0 then null else id end as k", "id as v").repartition(8).write.parquet(f"{scratch}/big")
    spark.range(100).selectExpr("id as k", "id as w").write.parquet(f"{scratch}/small")
    out = keyed_join(spark.read.parquet(f"{scratch}/big"), spark.read.parquet(f"{scratch}/small"), "k", "left")
    assert out.where("k is null").count() == 2000
    assert _tasks(spark, out, f"{scratch}/out", "k is null") > 4


def test_hot_key_of_a_written_table_is_split(spark, skew_conf, scratch):
    spark.range(30000).selectExpr("case when id % 3 = 0 then -1 else id end as k", "sha2(cast(id as string), 512) as v").repartition(8).write.parquet(f"{scratch}/big")
    spark.range(-1, 100).selectExpr("id as k", "id as w").write.parquet(f"{scratch}/small")
    out = keyed_join(spark.read.parquet(f"{scratch}/big"), spark.read.parquet(f"{scratch}/small"), "k", "left")
    assert out.where("k = -1 and w = -1").count() == 10000
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert _tasks(spark, out, f"{scratch}/out", "k = -1") > 1


def test_hot_id_on_the_authority_side(spark, skew_conf):
    upload = [("HOT", "S9", 1, "A", 1), ("P1", "S1", 1, "A", 2)]
    auth = [("HOT", f"S{i}", 1, "A") for i in range(10, 1500)] + [("P1", "S1", 1, "A")]
    rec = reconcile(spark.createDataFrame(upload, UP), spark.createDataFrame(auth, AU), SPEC)
    exp_clean, exp_audit = model(upload, auth)
    assert Counter(tuple(r) for r in rec.clean.collect()) == exp_clean
    assert Counter((tuple(r)[:4], tuple(r.conflict_columns)) for r in rec.audit.collect()) == exp_audit


def test_quarantine_by_key_keeps_null_keys(spark, skew_conf):
    df = spark.createDataFrame([("H", i) for i in range(300)] + [(None, i) for i in range(300)] + [("a", 1)], "k string, v int")
    kept = quarantine_by_key(df, df.where("k = 'H'"), "k")
    assert Counter(r.k for r in kept.collect()) == {None: 300, "a": 1}


def test_repeat_rows_bounded(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 100), ("d", 37)], "k string, count long")
    got = Counter(r.k for r in repeat_rows(df, "count", fanout=4).collect())
    assert got == {"a": 1, "b": 5, "c": 100, "d": 37}


def test_hot_id_reconcile_matches_model(spark, skew_conf):
    upload, auth = _data()
    rec = reconcile(spark.createDataFrame(upload, UP), spark.createDataFrame(auth, AU), SPEC)
    clean = rec.clean
    got = Counter(tuple(r) for r in clean.collect())
    exp_clean, exp_audit = model(upload, auth)
    assert got == exp_clean
    assert sum(1 for k in got.elements() if k[0] == "HOT") == 2000   # 1000 rows x 2 authority rows
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    got_audit = Counter((tuple(r)[:4], tuple(r.conflict_columns)) for r in rec.audit.collect())
    assert got_audit == exp_audit


def test_hot_id_quarantine(spark, skew_conf):
    rows = [("HOT", "ACD" if i % 500 else "AC1", "x") for i in range(3000)] + \
           [(f"P{i}", "ACD", "x") for i in range(6000)] + [("Q1", "AC1", "x")]
    df = spark.createDataFrame(rows, "id string, s string, t string")
    clean, audit = validate_tokens(df, None, TokenRule(("s",), "ACDEFGHIKLMNPQRSTVWY"), "id", ("id",))
    assert clean.count() == 6000 and audit.count() == 7


def test_small_counts_are_expanded_in_place(spark):
    """Counts known to be small cost no shuffle; the rows are the same."""
    df = spark.createDataFrame([("a", 3), ("b", 0), ("c", 1), ("d", None)], "k string, count long")
    here = repeat_rows(df, "count", fanout=4, most=3)
    assert "Exchange" not in here._jdf.queryExecution().executedPlan().toString()
    assert Counter(r.k for r in here.collect()) == Counter(r.k for r in repeat_rows(df, "count", fanout=4).collect()) == {"a": 3, "c": 1}
    assert Counter(r.k for r in repeat_rows(df, "count", fanout=2, most=3).collect()) == {"a": 3, "c": 1}
