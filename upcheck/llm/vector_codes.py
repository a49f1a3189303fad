"""Vector code compression: one small codebook for each part of a vector, trained with Drake-Hamerly bounds.

Components become integers, so all decisions are exact.  Each part of each
vector keeps its ``b`` closest entries in order, an upper bound of the distance
to the first, a lower bound for every later one and one outer bound for all
entries beyond.  Rounds move entries; bounds are loosened by those moves.  As
long as the first entry's upper bound is below the bound of the next rank,
nothing is computed.  Else the distance to the first entry is made exact; then
integer distances decide among the ranks that its bound reaches, and among all
entries where it reaches the outer bound.  Ties, which bounds can't tell, always
end in integers, and the lower index wins.  After a round ``b`` falls to the
rank that all but the share ``SPARE`` of those part decisions needed.

A round is one pass over a written table (vectors, entries, bounds) that writes
the next one; rows whose entry changed add to sums and counts of both entries,
once a batch, in the same table.  Only these sums (entries x components) reach the driver.
Bounds are rounded outwards to 32 bits.

Defined results: rows with a null vector, or one with null or non-finite
components, are left out; vectors of equal length, divisible by the parts, are
needed, else the job fails, as with components over 2**62; repeated rows count
each; a codebook starts from the first rows by id (nulls last, then by
components), fewer than asked for if there are not so many; an empty table has
no codes.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.llm.common import Scratch

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Part decisions that may need more ranks than are kept.
SPARE = 0.01
#: Vectors that numpy works on at a time.
ROWS = 4096
LIMIT = 1 << 62
SLACK = 1e-12  # of 64-bit square roots


def up(x: np.ndarray) -> np.ndarray:
    """32-bit upper bounds of 64-bit values."""
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def down(x: np.ndarray) -> np.ndarray:
    """32-bit lower bounds of 64-bit values."""
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries (or to those of each row)."""
    gap = x[:, None, :] - (entries[None] if entries.ndim == 2 else entries)
    return (gap * gap).sum(axis=2)


def exact(x: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """All as 64-bit integers, or as Python's where squares may not fit."""
    largest = max(int(np.abs(a).max(initial=0)) for a in (x, *books))
    kind = np.int64 if 4 * largest * largest * max(1, x.shape[2]) < LIMIT else object
    return x.astype(kind), [a.astype(kind) for a in books]


@dataclass
class Kept:
    """Closest entries and bounds of one part of some vectors."""

    near: np.ndarray   # (n, b) entries, the assigned one first
    upper: np.ndarray  # (n,) of the distance to the first
    lower: np.ndarray  # (n, b): at t - 1, of the distances to all entries from rank t on; the last is the outer bound

    @staticmethod
    def searched(x: np.ndarray, book: np.ndarray, b: int) -> "Kept":
        """From the distances to all entries."""
        square = distances(x, book)
        order = np.argsort(square, axis=1, kind="stable")
        root = roots(np.take_along_axis(square, order, axis=1))
        beyond = np.full((len(x), b), np.inf)
        known = root[:, 1:b + 1]
        beyond[:, :known.shape[1]] = known * (1 - SLACK)
        return Kept(order[:, :b].astype(np.uint8), up(root[:, 0] * (1 + SLACK)), down(beyond))

    def moved(self, moves: np.ndarray) -> None:
        """Loosen the bounds by how far entries moved, and order them again."""
        self.upper = up(self.upper.astype(np.float64) + moves[self.near[:, 0]])
        lower = self.lower.astype(np.float64)
        lower[:, :-1] -= moves[self.near[:, 1:]]
        lower[:, -1] -= moves.max(initial=0)
        self.lower = np.minimum.accumulate(down(lower)[:, ::-1], axis=1)[:, ::-1]

    def cut(self, b: int) -> None:
        """Keep ``b`` ranks; what goes is below the new outer bound."""
        self.near, self.lower = self.near[:, :b], np.ascontiguousarray(self.lower[:, :b])

    def decided(self, x: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Find each row's entry again; returns how many ranks that took (b + 1: all entries)."""
        b = self.near.shape[1]
        used = np.ones(len(x), np.int64)
        open_ = np.flatnonzero(self.upper >= self.lower[:, 0])
        if not len(open_):
            return used
        first = book[self.near[open_, 0]] - x[open_]
        self.upper[open_] = up(roots((first * first).sum(axis=1)) * (1 + SLACK))
        below = self.upper[open_, None] < self.lower[open_]
        ranks = np.where(below.any(axis=1), below.argmax(axis=1) + 1, b + 1)
        used[open_] = ranks
        for t in range(2, b + 1):
            at = open_[ranks == t]
            if len(at):
                near = np.sort(self.near[at, :t], axis=1)
                square = distances(x[at], book[near])
                order = np.argsort(square, axis=1, kind="stable")
                root = roots(np.take_along_axis(square, order, axis=1))
                self.near[at, :t] = np.take_along_axis(near, order, axis=1)
                self.upper[at] = up(root[:, 0] * (1 + SLACK))
                lower = self.lower[at]
                lower[:, :t - 1] = np.minimum(down(root[:, 1:] * (1 - SLACK)), lower[:, t - 1:t])
                self.lower[at] = lower
        at = open_[ranks == b + 1]
        if len(at):
            again = Kept.searched(x[at], book, b)
            self.near[at], self.upper[at], self.lower[at] = again.near, again.upper, again.lower
        return used


def _packed(near: list[np.ndarray], upper: list[np.ndarray], lower: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Entries and bounds of all parts of each row, as two binaries of fixed size."""
    entries = np.ascontiguousarray(np.concatenate(near, axis=1))
    bounds = np.ascontiguousarray(np.concatenate([np.concatenate([u[:, None], w], axis=1) for u, w in zip(upper, lower)], axis=1).astype("<f4"))
    return _binary(entries), _binary(bounds)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())])


def _unpacked(column: pa.Array, width: int, kind: str) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(len(column), width)


def _components(column: pa.Array, size: int, parts: int) -> np.ndarray:
    """(rows, parts, components) of a list column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != size).any() or size % parts:
        raise ValueError(f"vectors of one length divisible by {parts} are needed, not of {sorted({size, *lengths.tolist()})}")
    return column.flatten().to_numpy().reshape(len(column), parts, size // parts)


def pass_over(rows: DataFrame, books: list[np.ndarray], keep: list[str], size: int, before: int | None, after: int) -> DataFrame:
    """Assign every part anew: rows with their entries and bounds, and ``tally`` on one row of a batch.

    ``books`` are (parts, entries, components) of this pass and, where ``before``
    ranks are kept already, of the last one.  ``tally`` has what sums and counts
    of entries change by, then how many decisions took 1, 2, ... ranks, or all.
    """
    parts, entries, length = books[0].shape
    sent = rows.sparkSession.sparkContext.broadcast(books)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                x, (book, *last) = exact(_components(part.column("x"), size, parts), sent.value)
                sums = np.zeros((parts, entries, length), dtype=object if book.dtype == object else np.int64)
                counts, used = np.zeros((parts, entries), np.int64), np.zeros(entries + 2, np.int64)
                kept = []
                if before is not None:
                    near = _unpacked(part.column("near"), parts * before, "u1").reshape(-1, parts, before)
                    bounds = _unpacked(part.column("bounds"), parts * (before + 1), "<f4").reshape(-1, parts, before + 1)
                    step = book - last[0]
                    moves = roots((step * step).sum(axis=2)) * (1 + SLACK)
                for p in range(parts):
                    if before is None:
                        k = Kept.searched(x[:, p], book[p], after)
                        gone, come = np.zeros(0, np.int64), np.arange(len(x))
                        used[-1] += len(x)
                    else:
                        k = Kept(near[:, p].copy(), bounds[:, p, 0].copy(), bounds[:, p, 1:].copy())
                        old = k.near[:, 0].copy()
                        k.moved(moves[p])
                        ranks = k.decided(x[:, p], book[p])
                        used += np.bincount(np.where(ranks > before, entries + 1, ranks), minlength=entries + 2)
                        k.cut(after)
                        gone = come = np.flatnonzero(old != k.near[:, 0])
                        np.subtract.at(sums[p], old[gone], x[gone, p])
                        np.subtract.at(counts[p], old[gone], 1)
                    np.add.at(sums[p], k.near[come, 0], x[come, p])
                    np.add.at(counts[p], k.near[come, 0], 1)
                    kept.append(k)
                tally = [Decimal(int(v)) for v in (*sums.ravel().tolist(), *counts.ravel().tolist(), *used.tolist())]
                entries_, bounds_ = _packed([k.near for k in kept], [k.upper for k in kept], [k.lower for k in kept])
                tallies = pa.array([tally, *[None] * (part.num_rows - 1)], pa.list_(pa.decimal128(38, 0)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), part.column("x"), entries_, bounds_, tallies], names=[*keep, "x", "near", "bounds", "tally"])
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), "x array<bigint>, near binary, bounds binary, tally array<decimal(38,0)>"])
    return rows.mapInArrow(run, schema)


def coded(rows: DataFrame, book: np.ndarray, keep: list[str], size: int, b: int) -> DataFrame:
    """``keep``, ``code`` (an entry for each part) and ``error``, the squared distances summed over parts."""
    parts = len(book)
    sent = rows.sparkSession.sparkContext.broadcast(book)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                x, (now,) = exact(_components(part.column("x"), size, parts), [sent.value])
                codes = _unpacked(part.column("near"), parts * b, "u1").reshape(-1, parts, b)[:, :, 0]
                gap = x - now[np.arange(parts)[None], codes]
                error = (gap * gap).sum(axis=(1, 2)) if size else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), _binary(np.ascontiguousarray(codes)), pa.array(error.tolist(), pa.int64())], names=[*keep, "code", "error"])
    return rows.select(*keep, "x", "near").mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), "code binary, error bigint"]))


def ranks_needed(used: list[int], b: int, entries: int) -> int:
    """The rank that all but the share SPARE of the decisions got by with; at most ``b``, at least an eighth of the entries."""
    open_, seen = sum(used[2:]), 0
    for t in range(2, b + 1):
        seen += used[t]
        if open_ - seen <= SPARE * (open_ + used[1]):
            break
    else:
        t = b
    return max(1, min(b, max(t, entries // 8)))


def compress(vectors: DataFrame, vector: str, order: str, keep: list[str], parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``(keep, code, error)`` of every vector, and the codebooks (parts, entries, components).

    ``code`` has one byte for each part, its entry's index; ``order`` is the id that chooses the first entries.
    """
    if entries > 255:
        raise ValueError("an entry's index must fit one byte")
    scratch = Scratch(vectors.sparkSession)
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    value = lambda v: F.floor(v.cast("double") * scale)
    checked = lambda v: F.when(F.abs(v.cast("double") * scale) < float(LIMIT), value(v)).otherwise(F.raise_error(F.lit("a component over 2**62")).cast("bigint"))
    names = [f"keep{i}" for i in range(len(keep))]
    rows = (vectors.where(F.col(vector).isNotNull() & finite)
            .select(*(F.col(c).alias(n) for c, n in zip(keep, names)), F.transform(vector, checked).alias("x"), F.col(order).alias("place")))
    first = [r.x for r in rows.select("place", "x").orderBy(F.asc_nulls_last("place"), "x").limit(entries).collect()]
    rows = rows.drop("place")
    size = len(first[0]) if first else 0
    if size % parts or any(len(x) != size for x in first):
        raise ValueError(f"vectors of one length divisible by {parts} are needed")
    k = len(first)
    book = np.array(first, dtype=object).reshape(k, parts, size // parts).transpose(1, 0, 2) if k else np.zeros((parts, 0, 0), object)
    if not k:
        empty = rows.select(*names, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("bigint").alias("error"))
        return empty.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "code", "error"), book
    sums, counts = np.zeros(book.shape, dtype=object), np.zeros((parts, k), dtype=object)
    books, before, after, table = [book.astype(np.int64)], None, max(1, min(k, max(2, k // 4))), rows
    for n in range(rounds + 1):
        table = scratch.save(pass_over(table, books, names, size, before, after), f"vectors{n}")
        if n:
            scratch.drop(f"vectors{n - 1}")
        told = {r.pos: int(r.total) for r in table.where("tally is not null").select(F.posexplode("tally").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("total")).collect()}
        flat = np.array([told.get(i, 0) for i in range(sums.size + counts.size + k + 2)], dtype=object)
        sums = sums + flat[:sums.size].reshape(sums.shape)
        counts = counts + flat[sums.size:sums.size + counts.size].reshape(counts.shape)
        before, after = after, ranks_needed(flat[sums.size + counts.size:].tolist(), after, k)
        if n < rounds:
            book = np.array([[[v // counts[p, e] for v in sums[p, e]] if counts[p, e] else book[p, e].tolist() for e in range(k)] for p in range(parts)], dtype=object).reshape(book.shape)
            books = [book.astype(np.int64), books[0]]
    out = coded(table, books[0], names, size, before)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "code", "error"), book
