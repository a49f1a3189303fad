"""What goes through the driver does not grow with the documents."""

import random

from pyspark.sql import functions as F

from upcheck.llm import simhash


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_simhash_search_broadcasts_nothing(spark, tmp_path):
    """A query's hundreds of variants are made after Spark has estimated their size, so few queries looked small enough to broadcast."""
    rnd = random.Random(4)
    fps = spark.createDataFrame([(rnd.getrandbits(64) - (1 << 63), 1) for _ in range(400)], "fp long, docs long")
    fps.write.parquet(f"{tmp_path}/fps")
    index = spark.read.parquet(f"{tmp_path}/fps")
    near = simhash.within(index.where("fp % 4 = 0"), index, simhash.RADIUS)
    plan = _plan(near)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert near.where(F.col("fp") == F.col("near")).count() == index.where("fp % 4 = 0").count()


def test_simhash_answers_are_not_broadcast(spark, edge_dir):
    from upcheck.llm.queries import op3_simhash
    assert "Broadcast" not in _plan(op3_simhash(spark, edge_dir))
