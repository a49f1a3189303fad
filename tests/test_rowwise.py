"""Whole-row anti join against a plain comparison of all rows."""

import math
import random
from collections import Counter

import pytest

from upcheck.operators.rowwise import unmatched_rows


def test_against_all_pairs(spark):
    rnd = random.Random(1)
    row = lambda: (rnd.choice([1, 2, None]), rnd.choice(["a", "b", None, ""]), rnd.choice([0.0, -0.0, 1.5, float("nan")]))
    left, right = [row() for _ in range(120)], [row() for _ in range(12)]
    schema = "x int, y string, z double"

    def equal(a, b):
        return all(u is not None and v is not None and (u == v or (isinstance(u, float) and math.isnan(u) and math.isnan(v))) for u, v in zip(a, b))
    got = unmatched_rows(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()
    expected = [a for a in left if not any(equal(a, b) for b in right)]
    assert Counter(map(str, map(tuple, got))) == Counter(map(str, expected)) and 0 < len(expected) < len(left)


def test_nested_columns_maps_and_other_names(spark):
    schema = "id int, s struct<a:int,b:array<double>>, m map<string,int>, more string"
    rows = [(1, (1, [0.0]), {"k": 1, "l": 2}, "x"), (1, (1, [0.0]), {"k": 1, "l": 2}, "y"), (2, (1, None), {"k": 1}, "x"), (3, (1, [1.0]), {}, "x"), (4, None, {}, "x")]
    other = [(1, (1, [-0.0]), {"l": 2, "k": 1}), (2, (1, None), {"k": 2}), (3, (1, [1.0]), {}), (4, None, {})]
    right = spark.createDataFrame(other, "id2 int, `s.2` struct<a:int,b:array<double>>, m map<string,int>")
    got = unmatched_rows(spark.createDataFrame(rows, schema), right, ["id", "s", "m"], ["id2", "s.2", "m"])
    assert sorted((r.id, r.more) for r in got.collect()) == [(2, "x"), (4, "x")]
    assert got.columns == ["id", "s", "m", "more"]


def test_hundreds_of_columns(spark):
    names = [f"c{i}" for i in range(300)]
    df = spark.range(50).selectExpr(*[f"id + {i} as {n}" for i, n in enumerate(names)])
    assert unmatched_rows(df, df.where("c0 % 2 = 0")).count() == 25


def test_types_must_agree_and_empty_tables(spark):
    one, none = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([], "x int")
    with pytest.raises(ValueError, match="type"):
        unmatched_rows(one, spark.createDataFrame([(1,)], "x long"))
    assert unmatched_rows(one, none).count() == 1 and unmatched_rows(none, one).count() == 0
    assert unmatched_rows(one.unionAll(one), none).count() == 2
