"""Bloom filter: no key is lost, few others pass, the join after it is exact."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from upcheck.operators import bloom
from upcheck.operators.reconcile import exact_mismatches


@pytest.fixture(scope="module")
def sides(spark):
    upload = spark.range(20_000).select(F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.concat(F.lit("P"), F.col("id") * 3)).alias("id"), (F.col("id") % 7).alias("run"))
    authority = spark.range(400_000).select(F.concat(F.lit("P"), F.col("id")).alias("id"), (F.col("id") % 5).alias("run"))
    return upload, authority


def test_no_key_is_lost_and_few_others_pass(sides):
    upload, authority = sides
    made = bloom.bloom_filter(upload, ["id"])
    assert made.keys == 19_600 and made.bits >= 14 * made.keys and made.blocks.count() <= made.bits // (64 * 512)
    assert bloom.possible(upload, made, ["id"]).count() == 19_600  # all but null keys
    passed = bloom.possible(authority, made, ["id"])
    assert passed.columns == authority.columns
    kept = passed.count()
    inside = authority.join(upload.select("id"), "id", "left_semi").count()
    assert inside <= kept <= inside + 0.04 * 400_000  # shuffled after it: a tenth of the rows


@pytest.mark.parametrize("most", [bloom.MOST_BITS, 1 << 10])
def test_mismatches_are_exact_with_and_without(sides, most):
    upload, authority = sides
    assert (bloom.bloom_filter(upload, ["id", "run"], most) is None) == (most < 1 << 20)
    got = bloom.filtered_mismatches(upload, authority, ["id", "run"], most)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, exact_mismatches(upload, authority, ["id", "run"]).collect()))


def test_rows_are_dropped_before_the_shuffle(sides):
    upload, authority = sides
    passed = bloom.possible(authority, bloom.bloom_filter(upload, ["id", "run"]), ["id", "run"])
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert passed.count() < 0.06 * 400_000


def test_empty_sides(spark):
    none = spark.createDataFrame([], "id string")
    one = spark.createDataFrame([("a",), (None,)], "id string")
    assert bloom.filtered_mismatches(none, one, ["id"]).count() == 0
    assert bloom.filtered_mismatches(one, none, ["id"]).count() == 2
