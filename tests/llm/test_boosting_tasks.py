"""Trees fitted in tasks: as those fitted in memory, whatever the blocks, and on every proposal however many there are."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from upcheck.llm import boosting_tasks, pii
from upcheck.llm.boosting import Boosted, isotonic
from upcheck.llm.boosting_tasks import calibrated, grown, held_out, margins, packed, pooled
from upcheck.llm.common import Scratch

GRIDS = [np.arange(8, dtype=float)] * 4
ROWS = "cell binary, kind int, y int, n long, unit double"


def _rows(spark, n=1500):
    rnd = np.random.default_rng(5)
    cells = np.unique(rnd.integers(0, 8, size=(n, 4)).astype(np.uint8), axis=0)
    y = ((cells[:, 0] > 3) & (cells[:, 2] < 6)).astype(int) ^ (rnd.random(len(cells)) < 0.1)
    rows = [(bytes(c), int(c[1]) % 3, int(v), int(k), 0.5) for c, v, k in zip(cells, y, rnd.integers(1, 9, len(cells)))]
    return cells, rows, spark.createDataFrame(rows, ROWS).repartition(5)


def _fitted(spark, df, trees=6):
    scratch = Scratch(spark)
    blocks = packed(df, 4, scratch)
    state, fine = grown(blocks, GRIDS, 10_000.0, 4, trees=trees)
    return blocks, state, fine, held_out(blocks, state, fine, scratch)


def test_fit_does_not_depend_on_blocks(spark, monkeypatch):
    _, _, df = _rows(spark)
    _, one, fine, held = _fitted(spark, df, 3)
    for block, fan in ((100, 64), (100, 1)):
        monkeypatch.setattr(boosting_tasks, "BLOCK", block)
        monkeypatch.setattr(boosting_tasks, "FAN", fan)
        blocks, many, same, other = _fitted(spark, df.repartition(3), 3)
        assert blocks.count() > 1 and same == fine
        for name in ("prior", "feature", "place", "value"):
            assert (getattr(one, name) == getattr(many, name)).all(), name
        key = lambda d: sorted(map(tuple, d.collect()))
        assert key(held) == key(other)
        fits = [pooled(x.select(F.col("kind").alias("group"), F.col("held").alias("score"), "y", "w"), parts) for x, parts in ((held, 1), (other, 7))]
        assert all((a == b).all() for g in fits[0] for a, b in zip(fits[0][g], fits[1][g])) and fits[0].keys() == fits[1].keys() == {0, 1, 2}


def test_fit_equals_one_in_memory(spark):
    cells, rows, df = _rows(spark)
    _, state, fine, held = _fitted(spark, df)
    y, w = np.array([r[2] for r in rows]), np.array([r[3] * r[4] for r in rows])
    plain = Boosted(trees=6).fit(cells.astype(float), y, w)
    mine = calibrated(state, GRIDS, (np.zeros(1), np.zeros(1))).model.margin(cells.astype(float))
    assert np.abs(plain.margin(cells.astype(float)) - mine).max() < 1e-6
    assert (mine == margins(cells.T, state, 4)).all()
    assert sum(r.w for r in held.collect()) == round(w.sum() * fine)  # every part of every row is held out once
    got = pooled(held.select(F.lit(0).alias("group"), F.col("held").alias("score"), "y", "w"), 5)[0]
    told = sorted(((r.held, -r.y, r.w) for r in held.collect()))
    xs, ys = isotonic(np.array([t[0] for t in told]), -np.array([t[1] for t in told], float), np.array([t[2] for t in told], float))
    assert np.allclose(got[0], xs) and np.allclose(got[1], ys)


def test_all_cells_are_learned_from(spark, monkeypatch):
    """More cells of proposals than a driver was given before: none is joined with another, none left out."""
    rnd = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789"
    word = lambda: "".join(rnd.choices(letters[:rnd.randint(20, 46)], k=rnd.randint(16, 90))) + rnd.choice(["", "-", "_", "=", "/"]) + "".join(rnd.choices("0123456789", k=rnd.randint(1, 9)))
    some = lambda: rnd.choice(["", "key = ", "call ", "card ", "host ", "mail ", "page ", '"', "(", "= "])
    docs = spark.createDataFrame([(i, " and ".join(some() + word() for _ in range(10))) for i in range(7000)], "doc_id long, text string").repartition(8)
    cells = pii.counted(docs, Scratch(spark))
    told = cells.agg(F.count("*").alias("cells"), F.sum("n").alias("n")).first()
    assert told.cells > 35_000 and cells.select("cell", "kind", "y").distinct().count() == told.cells
    seen = {}

    def spy(rows, folds, scratch):
        blocks = packed(rows, folds, scratch)
        seen["rows"] = rows.where("unit < 1").agg(F.count("*"), F.sum("n")).first()
        seen["blocks"] = sum(len(b.y) for b in blocks.collect())
        seen["all"] = rows.count()
        return blocks

    def short(*args):
        state, fine = grown(*args, trees=2)
        seen["places"] = {int(p) for p in state.place.ravel()}
        return state, fine
    monkeypatch.setattr(pii, "packed", spy)
    monkeypatch.setattr(pii, "grown", short)
    monkeypatch.setattr(pii, "DOCS_WEIGHT", 10_000.0)
    model, _ = pii.train(docs)
    assert tuple(seen["rows"]) == (told.cells, told.n) and seen["blocks"] == seen["all"] > boosting_tasks.BLOCK
    assert all(c == np.inf or c in pii.GRID[f] for f, c in zip(model.model.feature.ravel(), model.model.cut.ravel()))


def test_no_documents(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    model, thresholds = pii.train(docs)
    assert set(thresholds) == set(pii.KINDS)
    _, every, x, _ = pii._examined(*pii.text_bytes(pa.array(["call 555-010-9999"])))
    assert len(model.rate(x)) == len(every) and thresholds["phone"] <= max(model.rate(x))
