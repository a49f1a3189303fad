"""Holds over uploads: state by id, against a plain replay of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from upcheck.plans.stream_demo import HOLD_FIXES
from upcheck.streaming.holds import DECISION, VERDICT, latest, settled, start_holds, state_store, verdicts


def _plain(told):
    """Decisions by (id, upload) after the verdicts in this order."""
    block, held, seen, out = {}, {}, set(), {}
    for id_, upload, _, fault, fix in told:
        if (id_, upload) in seen:
            continue
        seen.add((id_, upload))
        if fault:
            block[id_] = upload
            out[id_, upload] = ("quarantined", upload)
        elif id_ not in block:
            out[id_, upload] = ("clean", None)
        elif not fix:
            held.setdefault(id_, []).append(upload)
            out[id_, upload] = ("held", block[id_])
        else:
            out[id_, upload] = ("clean", None)
            for u in held.pop(id_, []):
                out[id_, u] = ("released", upload)
            del block[id_]
    return out


def _follow(spark, base):
    with state_store(spark):
        q = start_holds(spark, f"{base}/verdicts", f"{base}/decisions", f"{base}/checkpoint")
        q.awaitTermination()
    assert q.exception() is None
    return spark.read.schema(DECISION).parquet(f"{base}/decisions")


def test_random_uploads_in_random_batches(spark, scratch):
    rnd = random.Random(4)
    told = [(f"i{i}", f"u{u}", u, rnd.random() < 0.3, rnd.random() < 0.3) for u in range(12) for i in range(15) if rnd.random() < 0.8]
    cuts = [0, 3, 4, 9, 12]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        batch = [v for v in told if a <= v[2] < b]
        batch += [v for v in told if v[2] < a and rnd.random() < 0.3]  # replayed
        rnd.shuffle(batch)
        spark.createDataFrame(batch, VERDICT).write.parquet(f"{scratch}/verdicts/{k}")
        decisions = _follow(spark, scratch)
        got = {(r.id, r.upload): (r.status, r.by) for r in latest(decisions).collect()}
        assert got == _plain([v for v in told if v[2] < b])
    before = decisions.count()
    spark.createDataFrame(told, VERDICT).write.parquet(f"{scratch}/verdicts/again")
    assert _follow(spark, scratch).count() == before  # a replay adds nothing


def test_verdicts_and_rows(spark, scratch):
    rows = [("a", "u1", True), ("a", "u1", False), ("a", "u2", False), ("b", "u1", False), (None, "u1", True), (None, "u2", False), ("c", "u2", None), ("d", None, False)]
    df = spark.createDataFrame(rows, "id string, upload string, fault boolean")
    told = verdicts(df, "id", "upload", F.lit(1), F.col("fault"), F.lit(False))
    assert sorted((r.id, r.upload, r.fault) for r in told.collect()) == [("a", "u1", True), ("a", "u2", False), ("b", "u1", False), ("c", "u2", True)]
    decisions = spark.createDataFrame([("a", "u1", "quarantined", "u1", 1), ("a", "u2", "held", "u1", 1), ("a", "u2", "released", "u3", 3),
                                       ("b", "u1", "clean", None, 1), ("c", "u2", "quarantined", "u2", 1)], DECISION)
    got = sorted(((str(r.id), r.upload, str(r.fault), r.status, r.by) for r in settled(df, decisions, "id", "upload", F.col("fault")).collect()), key=str)
    assert got == sorted([("a", "u1", "True", "quarantined", "u1"), ("a", "u1", "False", "quarantined", "u1"), ("a", "u2", "False", "released", "u3"),
                          ("b", "u1", "False", "clean", None), ("None", "u1", "True", "quarantined", "u1"), ("None", "u2", "False", "clean", None),
                          ("c", "u2", "None", "quarantined", "u2"), ("d", None, "False", "clean", None)], key=str)


def test_state_setting_comes_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with pytest.raises(ZeroDivisionError):
        with state_store(spark):
            assert spark.conf.get(key).endswith("RocksDBStateStoreProvider")
            1 / 0
    assert spark.conf.get(key, None) == before and HOLD_FIXES


def test_state_stays_in_spark(spark, scratch):
    """No row of the state passes through a worker's Python, one verdict is kept once, and the first of two that differ counts."""
    told = [("a", "u1", 1, True, False), ("a", "u2", 2, False, False), ("a", "u3", 3, False, True), ("b", "u1", 1, False, False)]
    spark.createDataFrame(told, VERDICT).write.parquet(f"{scratch}/verdicts/0")
    _follow(spark, scratch)
    again = [*told, ("b", "u1", 1, True, False), ("b", "u2", None, False, False), ("b", "u0", 9, False, False)]
    spark.createDataFrame(again, VERDICT).write.parquet(f"{scratch}/verdicts/1")
    with state_store(spark):
        q = start_holds(spark, f"{scratch}/verdicts", f"{scratch}/decisions", f"{scratch}/checkpoint")
        q.awaitTermination()
    operators = q.lastProgress["stateOperators"]
    assert {x["operatorName"] for x in operators} == {"dedupe", "stateStoreSave"}
    assert {x["operatorName"]: x["numRowsTotal"] for x in operators} == {"dedupe": 7, "stateStoreSave": 2}
    got = [tuple(r) for r in spark.read.schema(DECISION).parquet(f"{scratch}/decisions").select(*DECISION.names).collect()]
    assert sorted(got, key=str) == sorted([("a", "u1", "quarantined", "u1", 1), ("a", "u2", "held", "u1", 2), ("a", "u2", "released", "u3", 3), ("a", "u3", "clean", None, 3),
                                           ("b", "u1", "clean", None, 1), ("b", "u0", "clean", None, 9), ("b", "u2", "clean", None, None)], key=str)
