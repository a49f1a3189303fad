"""Boosted trees and isotonic calibration fitted in tasks, over any number of rows.

Rows are places on grids of values (``place`` p of a feature: its value is above the first p
of the grid), with a kind, a label, a count and a weight for each of that many.  What a row
counts is dealt over folds, as alike as can be.  Rows are packed into blocks, one to a row of
a written table.  A level of a tree is one pass over the blocks: tasks add up
gradients and curvatures by model, node, feature and place, and the driver, which gets the
sums, picks the cuts among those values of the grids that are quantiles of all rows.  The models that leave out a fold each
and the one that takes all grow in the same passes.  Margins are worked out anew in each
pass, so that nothing but the trees is kept between passes.

Gradients, curvatures and weights are rounded to multiples of a power of two that is so
small that their sums are exact.  They do not depend on how rows fall into tasks, and rows
that fill no more than a block are worked on where the driver is, with the same result.

Isotonic fits pool neighbours within ranges of scores in tasks; the driver pools what is left.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.llm.boosting import BINS, Boosted, Calibrated, pool
from upcheck.llm.common import Scratch

#: Rows of a block, and tasks whose sums the driver adds; those of more are added in tasks first.
BLOCK, FAN = 1 << 15, 64
_NONE = 255  # no cut: grids have fewer values
_PARTS = ["cells", "kind", "y", "w"]
_BLOCK_SQL = ", ".join(f"{c} binary" for c in _PARTS)


@dataclass
class State:
    """Trees of all models so far: those that are done, and the levels of the next one."""

    prior: np.ndarray  # models
    feature: np.ndarray  # models x trees x inner nodes
    place: np.ndarray
    value: np.ndarray  # models x trees x leaves
    done: int
    level: int


def packed(rows: DataFrame, folds: int, scratch: Scratch, name: str = "blocks") -> DataFrame:
    """Blocks of ``rows (cell, kind, y, n, unit)``: so many of a kind (a number) and label, and what one weighs."""
    size = rows.count()
    first = F.pmod(F.xxhash64("cell", "kind", "y"), F.lit(folds)).cast("int").alias("first")
    dealt = rows.select("cell", "kind", "y", "n", "unit", first).repartition(max(1, -(-size // BLOCK)), "cell", "kind", "y")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK:
                yield one(held)
                held = []
        if held:
            yield one(held)

    def one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        cells = t.column("cell").to_pylist()
        cells = np.frombuffer(b"".join(cells), np.uint8).reshape(len(cells), -1).T.tobytes()
        n, unit, at = (t.column(c).to_numpy() for c in ("n", "unit", "first"))
        w = np.stack([(n + (at + f) % folds) // folds * unit for f in range(folds)])  # each part n / folds, rounded either way
        small = [t.column(c).to_numpy().astype(np.uint8).tobytes() for c in ("kind", "y")]
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (cells, *small, w.tobytes())], names=_PARTS)
    return scratch.save(dealt.mapInArrow(pack, _BLOCK_SQL), name)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``cells`` by feature, kinds, labels, and weights by fold, of each block; small ones as one."""
    held: list[tuple] = []
    for batch in batches:
        for cells, kind, y, w in zip(*(batch.column(c) for c in _PARTS)):
            y = np.frombuffer(y.as_py(), np.uint8)
            held.append((np.frombuffer(cells.as_py(), np.uint8).reshape(-1, len(y)), np.frombuffer(kind.as_py(), np.uint8), y, np.frombuffer(w.as_py()).reshape(-1, len(y))))
            if sum(len(b[2]) for b in held) >= BLOCK:
                yield tuple(np.concatenate(x, axis=-1) for x in zip(*held))
                held = []
    if held:
        yield tuple(np.concatenate(x, axis=-1) for x in zip(*held))


def _taught(w: np.ndarray, model: int) -> np.ndarray:
    """Weights that a model learns from: of all folds but its own."""
    return sum((x for f, x in enumerate(w) if f != model), np.zeros(w.shape[1]))


def _descended(cells: np.ndarray, feature: np.ndarray, place: np.ndarray, at: list):
    """Of the last nodes' values ``at`` the one that each row comes to."""
    while len(at) > 1:
        first = len(at) // 2 - 1
        at = [at[2 * i] if place[first + i] == _NONE else np.where(cells[feature[first + i]] > place[first + i], at[2 * i + 1], at[2 * i]) for i in range(len(at) // 2)]
    return at[0]


def margins(cells: np.ndarray, state: State, model: int, start: np.ndarray | None = None, first: int = 0) -> np.ndarray:
    """Log odds by a model's trees from ``first`` on, over those of the earlier ones."""
    out = np.full(cells.shape[1], state.prior[model]) if start is None else start
    for t in range(first, state.done):
        out = out + _descended(cells, state.feature[model, t], state.place[model, t], list(state.value[model, t]))
    return out


def _sums(block: tuple, state: State, places: int, fine: float, known: list[np.ndarray] | None = None) -> np.ndarray:
    """Gradients and curvatures (times ``fine``) by model, node, feature and place; ``known``: the models' margins."""
    cells, _, y, w = block
    models, nodes = len(state.prior), 1 << state.level
    out = np.zeros((models, 2, nodes, len(cells), places))
    for m in range(models):
        mine = _taught(w, m)
        p = 1 / (1 + np.exp(-(margins(cells, state, m) if known is None else known[m])))
        g, h = np.rint(fine * mine * (p - (y > 0))), np.rint(fine * mine * p * (1 - p))
        at = _descended(cells, state.feature[m, state.done], state.place[m, state.done], list(range(nodes)))
        slot = np.zeros(len(y), np.intp) + np.asarray(at, np.intp) * places
        for f in range(len(cells)):
            where = slot + cells[f]
            out[m, 0, :, f] = np.bincount(where, g, nodes * places).reshape(nodes, places)
            out[m, 1, :, f] = np.bincount(where, h, nodes * places).reshape(nodes, places)
    return out


def _added(blocks: DataFrame, of, shape: tuple) -> np.ndarray:
    """The sum of ``of(block)`` over all blocks."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for block in _blocks(batches):
            out += of(block)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for batch in batches:
            for x in batch.column("sums"):
                out += np.frombuffer(x.as_py()).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])
    parts = blocks.mapInArrow(total, "sums binary")
    if (n := parts.rdd.getNumPartitions()) > FAN:
        parts = parts.repartition(math.isqrt(n)).mapInArrow(add, "sums binary")
    out = np.zeros(shape)
    for r in parts.collect():
        out += np.frombuffer(r.sums).reshape(shape)
    return out


def _edges(weight: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """Which values of a grid are quantiles, BINS - 1 of them, of a feature with so much weight at each place."""
    upto = weight.cumsum()
    at = np.searchsorted(upto, upto[-1] * np.arange(1, BINS) / BINS, side="left")
    return np.isin(np.arange(len(grid)), at)


def _cut(state: State, sums: np.ndarray, grids: list[np.ndarray], edges: list[np.ndarray], rate: float, ridge: float) -> None:
    """Choose the cuts of a level from its sums; with the last level's, the leaves' values."""
    depth = state.value.shape[2].bit_length() - 1
    first, t = (1 << state.level) - 1, state.done
    for m in range(len(state.prior)):
        gs, hs = sums[m].cumsum(axis=-1)  # nodes x features x places
        for c in range(1 << state.level):
            gt, ht = gs[c, 0, -1], hs[c, 0, -1]
            best, chosen, at = 1e-9, -1, _NONE
            for f, grid in enumerate(grids):
                g, h = gs[c, f, :len(grid)], hs[c, f, :len(grid)]
                gain = g ** 2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt ** 2 / (ht + ridge)
                gain = np.where(edges[f], gain, -np.inf)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, chosen, at = gain[k], f, k
            state.feature[m, t, first + c], state.place[m, t, first + c] = max(chosen, 0), at
            if state.level == depth - 1:
                left = (gs[c, chosen, at], hs[c, chosen, at]) if chosen >= 0 else (gt, ht)
                state.value[m, t, 2 * c] = -rate * left[0] / (left[1] + ridge)
                state.value[m, t, 2 * c + 1] = -rate * (gt - left[0]) / (ht - left[1] + ridge)


def grown(blocks: DataFrame, grids: list[np.ndarray], total: float, folds: int, trees: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0) -> tuple[State, float]:
    """The trees of all models, the last of which leaves out no fold, and what weights are multiplied by for exact sums.

    ``total`` is the weight of all rows, or more."""
    models, places, inner = folds + 1, max(map(len, grids)) + 1, (1 << depth) - 1
    fine = 2.0 ** (52 - math.ceil(math.log2(max(total, 1.0))))
    here = None
    if blocks.agg(F.sum(F.octet_length("y"))).first()[0] <= BLOCK:
        schema = pa.schema([(c, pa.binary()) for c in _PARTS])
        here = list(_blocks([pa.RecordBatch.from_pylist([r.asDict() for r in blocks.collect()], schema)]))

    def added(of, shape: tuple) -> np.ndarray:
        return _added(blocks, of, shape) if here is None else sum((of(b) for b in here), np.zeros(shape))

    def weights(block: tuple) -> np.ndarray:
        _, _, y, w = block
        return np.array([[np.rint(fine * x).sum() for x in (mine, mine * (y > 0))] for mine in (_taught(w, m) for m in range(models))])

    def marginal(block: tuple) -> np.ndarray:
        return np.stack([np.bincount(x, np.rint(fine * block[3].sum(axis=0)), places) for x in block[0]])
    edges = [_edges(x[:len(g) + 1], g) for x, g in zip(added(marginal, (len(grids), places)), grids)]
    all_, right = added(weights, (models, 2)).T / fine
    state = State(np.log((right + 1.0) / (all_ - right + 1.0)), np.zeros((models, trees, inner), np.int64), np.full((models, trees, inner), _NONE),
                  np.zeros((models, trees, inner + 1)), 0, 0)
    known = None if here is None else [[np.full(len(b[2]), x) for x in state.prior] for b in here]
    for t in range(trees):
        for level in range(depth):
            state.level = level
            if here is None:
                sums = added(lambda block: _sums(block, state, places, fine), (models, 2, 1 << level, len(grids), places))
            else:
                sums = sum((_sums(b, state, places, fine, k) for b, k in zip(here, known)), np.zeros((models, 2, 1 << level, len(grids), places)))
            _cut(state, sums / fine, grids, edges, rate, ridge)
        state.done, state.level = t + 1, 0
        if here is not None:
            known = [[margins(b[0], state, m, k[m], t) for m in range(models)] for b, k in zip(here, known)]
    return state, fine


def held_out(blocks: DataFrame, state: State, fine: float, scratch: Scratch, name: str = "held") -> DataFrame:
    """``(kind, y, w, held)``: each row's part in a fold with its margin by the model that left it out; weights are whole numbers."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells, kind, y, w in _blocks(batches):
            for m, mine in enumerate(w):
                use = mine > 0
                held = margins(cells[:, use], state, m)
                yield pa.RecordBatch.from_arrays([pa.array(kind[use].astype(np.int32)), pa.array(y[use].astype(np.int32)), pa.array(np.rint(mine[use] * fine).astype(np.int64)), pa.array(held)], names=["kind", "y", "w", "held"])
    return scratch.save(blocks.mapInArrow(score, "kind int, y int, w long, held double"), name)


def pooled(rows: DataFrame, parts: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each group of ``rows (group, score, y, w)`` the points of its isotonic fit; weights are whole numbers, so sums are exact."""
    rows = rows.groupBy("group", "score", "y").agg(F.sum("w").alias("w"))  # a score that many have is not one task's
    dealt = rows.repartitionByRange(parts, "group", "score").sortWithinPartitions("group", "score", F.desc("y"))

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list] = {}
        for batch in batches:
            for group, score, y, w in zip(*(batch.column(c).to_pylist() for c in ("group", "score", "y", "w"))):
                pool(blocks.setdefault(group, []), y * w, w, score, score)
        out = [(g, str(a), str(b), lo, hi) for g, found in blocks.items() for a, b, lo, hi in found]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int32(), pa.string(), pa.string(), pa.float64(), pa.float64()))], names=["group", "sum", "weight", "low", "high"])
    found: dict[int, list] = {}
    for r in sorted(dealt.mapInArrow(shrink, "`group` int, sum string, weight string, low double, high double").collect(), key=lambda r: (r.group, r.low, r.high)):
        pool(found.setdefault(r.group, []), int(r["sum"]), int(r.weight), r.low, r.high)
    return {g: (np.array([x for b in blocks for x in b[2:]]), np.array([b[0] / b[1] for b in blocks for _ in (0, 1)])) for g, blocks in found.items()}


def calibrated(state: State, grids: list[np.ndarray], points: tuple[np.ndarray, np.ndarray]) -> Calibrated:
    """The model that leaves out nothing, cutting at the grids' values, with its calibration."""
    trees, inner = state.feature.shape[1:]
    model = Boosted(trees, (inner + 1).bit_length() - 1)
    model.prior, model.feature, model.value = float(state.prior[-1]), state.feature[-1], state.value[-1]
    model.cut = np.array([[np.inf if p == _NONE else grids[f][p] for f, p in zip(*x)] for x in zip(state.feature[-1], state.place[-1])])
    out = Calibrated()
    out.model, out.points = model, points
    return out
