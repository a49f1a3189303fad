"""Best-fit packing of tokenized documents by bin completion.

How full sequences can get depends on how many pieces there are of each length,
and there are at most ``CAPACITY`` lengths.  So the driver plans over these
counts: it takes the largest length left, enumerates all undominated fillings of
the room beside it, least waste first, and branches on them, each as often as the
counts allow and once.  Branches with the fewest choices against this order come
first, of these the earliest choices.  A branch is cut when a lower bound (volume,
and pieces too large to share a sequence) says it can't beat the incumbent, at
first the best-fit decreasing solution, or when what it leaves was met before.  A
plan that meets the bound ends the search, and so do ``NODES`` choices or ``STEPS``
steps of the enumeration; within these the plan is the least possible.  Pieces then get their places in parallel: a piece's rank among those of its
length says which copy of which filling it belongs to.

Defined results: null and empty texts are one piece with the end token alone; an
empty table gives no rows; repeated rows are packed each.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from heapq import heappop, heappush
from itertools import islice
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upcheck.llm import vocab
from upcheck.llm.common import Scratch, ranges, slices, text_bytes, word_spans
from upcheck.llm.vocab import WordLevel

CAPACITY = 2048
END_ID = 0
#: Pieces of one length are ranked in so many parts, so that no length is one task's.
PARTS = 256
#: Most choices of a filling in a search, and most steps in enumerating fillings (each some seconds, whatever the input).
NODES, STEPS = 4_000, 4_000_000

Filling = tuple[int, ...]
Plan = list[tuple[int, Filling]]  # copies, lengths


# ------------------------------------------------------------------ planning over counts

def best_fit_decreasing(counts: np.ndarray, capacity: int) -> Plan:
    """Best-fit decreasing, a length at a time: its pieces go to the fullest sequences that take them."""
    rooms: dict[int, list[list]] = {}  # room -> groups [copies, filling]
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            fit = min((r for r in rooms if r >= length), default=None)
            if fit is None:
                each = capacity // length
                full, rest = divmod(left, each)
                for copies, times in ((full, each), (1 if rest else 0, rest)):
                    if copies:
                        rooms.setdefault(capacity - times * length, []).append([copies, (length,) * times])
                break
            group = rooms[fit][-1]
            take = min(left, group[0])
            group[0] -= take
            if not group[0]:
                rooms[fit].pop()
                if not rooms[fit]:
                    del rooms[fit]
            rooms.setdefault(fit - length, []).append([take, (*group[1], length)])
            left -= take
    return [(copies, filling) for groups in rooms.values() for copies, filling in groups]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences needed at least: for every k, pieces over ``capacity`` - k share with none of k or more (Martello and Toth's L2)."""
    number, volume = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(counts * np.arange(len(counts))))  # of lengths below i
    half = capacity // 2
    k = np.arange(half + 1)
    alone = number[-1] - number[capacity - k + 1]
    large = number[capacity - k + 1] - number[half + 1]
    room = large * capacity - (volume[capacity - k + 1] - volume[half + 1])
    return int((alone + large + np.maximum(0, -((room - (volume[half + 1] - volume[k])) // capacity))).max())


def _multisets(total: int, below: int, lengths: list[int], most: list[int], reach: list[int], steps: list[int]) -> Iterator[Filling]:
    """All multisets of the first ``below`` lengths that add up to ``total``, those with larger pieces first."""
    if total == 0:
        yield ()
        return
    for i in range(bisect_right(lengths, total, 0, below) - 1, -1, -1):
        if not reach[i + 1] >> total & 1:
            return
        x = lengths[i]
        for k in range(min(most[i], total // x), 0, -1):
            steps[0] -= 1
            if steps[0] < 0:
                return
            if reach[i] >> (total - k * x) & 1:
                for rest in _multisets(total - k * x, i, lengths, most, reach, steps):
                    yield (x,) * k + rest


def _dominated(filling: Filling, waste: int, left: np.ndarray, there: int) -> bool:
    """Whether a spare piece fits into the waste, or takes the place of one or two smaller ones beside the first."""
    for x in set(filling):
        if filling.count(x) == left[x]:
            there &= ~(1 << x)
    rest = sorted(set(filling[1:]))
    spare = lambda low: there >> low & ((1 << (waste + 1)) - 1)  # noqa: E731  # lengths from low to low + waste
    if spare(0) or any(spare(x) >> 1 for x in rest):
        return True
    pairs = (x + y for a, x in enumerate(rest) for y in rest[a:] if x != y or filling[1:].count(x) > 1)
    return any(spare(x) for x in pairs)


def fillings(left: np.ndarray, capacity: int, most_waste: int | None = None, steps: list[int] | None = None) -> Iterator[Filling]:
    """All undominated fillings around the largest piece that waste ``most_waste`` at most, least waste first."""
    steps = [STEPS] if steps is None else steps
    largest = int(np.flatnonzero(left)[-1])
    room = capacity - largest
    rest = left[:max(room, largest) + 1].copy()
    rest[largest] -= 1
    lengths = np.flatnonzero(rest[:room + 1]).tolist()
    most = [min(int(rest[x]), room // x) for x in lengths]
    mask, reach = (1 << (room + 1)) - 1, [1]
    for x, n in zip(lengths, most):
        bits, part = reach[-1], 1
        while n:
            take = min(part, n)
            bits |= bits << (take * x) & mask
            n -= take
            part *= 2
        reach.append(bits)
    there = sum(1 << x for x in np.flatnonzero(left).tolist())
    for waste in range(min(room, room if most_waste is None else most_waste) + 1):
        if reach[-1] >> (room - waste) & 1:
            for found in _multisets(room - waste, len(lengths), lengths, most, reach, steps):
                if not _dominated((largest, *found), waste, left, there):
                    yield (largest, *found)


def _options(left: np.ndarray, capacity: int, most_waste: int, steps: list[int]) -> Iterator[tuple[int, Filling]]:
    """Fillings with how often to take them: as often as the counts allow within the waste, then once."""
    for filling in fillings(left, capacity, most_waste, steps):
        lengths, times = np.unique(filling, return_counts=True)
        waste = capacity - sum(filling)
        copies = int((left[lengths] // times).min())
        if waste:
            copies = min(copies, most_waste // waste)
        yield copies, filling
        if copies > 1:
            yield 1, filling


def bin_completion(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES, steps: int = STEPS) -> Plan:
    """A plan with as few sequences as the search finds; ``counts[length]`` pieces each."""
    best = best_fit_decreasing(counts, capacity)
    fewest = sum(c for c, _ in best)
    bound = lower_bound(counts, capacity)
    sizes = np.arange(len(counts))
    seen: dict[bytes, int] = {}
    effort, serial = [steps], 0
    heap: list[tuple] = [(0, 0, 0, None, 0)]  # choices against the order, depth, serial, path, options used
    while heap and fewest > bound and nodes > 0 and effort[0] > 0:
        against, depth, _, path, skip = heappop(heap)
        left, used, plan = counts.copy(), 0, path
        while plan:
            plan, copies, filling = plan
            np.subtract.at(left, list(filling), copies)
            used += copies
        while left.any():
            spare = (fewest - 1 - used) * capacity - int((left * sizes).sum())
            option = next(islice(_options(left, capacity, spare, effort), skip, None), None) if spare >= 0 else None
            nodes -= 1
            if option is None:
                break
            serial += 1
            heappush(heap, (against + 1, depth, serial, path, skip + 1))
            copies, filling = option
            np.subtract.at(left, list(filling), copies)
            path, used, depth, skip = (path, copies, filling), used + copies, depth + 1, 0
            if used + lower_bound(left, capacity) >= fewest:
                break
            key = hashlib.blake2b(left.tobytes(), digest_size=16).digest()
            if seen.get(key, fewest) <= used:
                break
            seen[key] = used
        else:
            if used < fewest:
                best, fewest = [], used
                while path:
                    path, copies, filling = path
                    best.append((copies, filling))
                best.reverse()
    return best


def slots(plan: Plan) -> np.ndarray:
    """Rows (length, first rank, first sequence, copies, offset), by length and rank; ranks count pieces of a length."""
    rows, used, sequence = [], {}, 0
    for copies, filling in plan:
        offset = 0
        for x in filling:
            rows.append((x, used.get(x, 0), sequence, copies, offset))
            used[x] = used.get(x, 0) + copies
            offset += x
        sequence += copies
    out = np.array(rows, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


# ------------------------------------------------------------------ Spark

def tokenized(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: each document's ids and END_ID, cut where longer than ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    source = docs.sparkSession.sparkContext.broadcast(vocab.read(path))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocab.loaded(WordLevel, source.value)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets, 1 << 20):  # the more text, the more words repeat
                part, edge = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                starts, _, first = word_spans(part, edge)
                # a word with the white space after it: the text itself, cut before every word
                whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(part))), pa.py_buffer(part)])
                coded = whole.dictionary_encode()
                begin, size = words.encode([w.rstrip(b"\t\n\x0b\x0c\r ") for w in coded.dictionary.to_pylist()])
                which = coded.indices.to_numpy()
                begin, size = begin[which], size[which]
                total = np.zeros(len(size) + 1, np.int64)
                np.cumsum(size, out=total[1:])
                ends = total[first]  # of the documents' ids
                ids = np.full(int(total[-1]) + j - i, END_ID, np.uint32)
                ids[np.arange(total[-1]) + np.repeat(np.arange(j - i), np.diff(ends))] = words.pool[ranges(begin, size)]
                lengths = np.diff(ends) + 1
                pieces = -(-lengths // capacity)
                row = np.repeat(np.arange(j - i), pieces)
                number = ranges(np.zeros(j - i, np.int64), pieces)
                start = number * capacity
                length = np.minimum(capacity, lengths[row] - start)
                at = np.append(0, np.cumsum(length)) * 4
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(at), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i).take(pa.array(row)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), packed],
                                                 names=["doc_id", "piece", "start", "length", "ids"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, piece int, start long, length long, ids binary")


def packed(pieces: DataFrame, order: list[str], capacity: int = CAPACITY, parts: int = PARTS) -> DataFrame:
    """All columns of ``pieces`` (each 1 to ``capacity`` long), ``sequence_id`` and ``offset``.

    ``pieces`` is read twice, so it should be a written table; ``order`` are
    columns that tell pieces apart (equal rows may change places).
    """
    spark = pieces.sparkSession
    marked = pieces.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = marked.groupBy("length", "_part").agg(F.count("*").alias("c")).toPandas()  # capacity x parts rows at most
    sizes = sizes.sort_values(["length", "_part"]).reset_index(drop=True)
    counts = np.zeros(capacity + 1, np.int64)
    np.add.at(counts, sizes["length"].to_numpy(np.int64), sizes["c"].to_numpy(np.int64))
    c, length = sizes["c"].to_numpy(np.int64), sizes["length"].to_numpy(np.int64)
    begin = np.cumsum(c) - c - (np.cumsum(counts) - counts)[length]
    before = np.zeros((capacity + 1, parts), np.int64)
    before[length, sizes["_part"].to_numpy(np.int64)] = begin
    table = slots(bin_completion(counts, capacity))
    sent = spark.sparkContext.broadcast((before, table))
    ranked = marked.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order)).cast("long"))
    types = [(f.name, f.dataType.simpleString()) for f in pieces.schema] + [("sequence_id", "bigint"), ("offset", "bigint")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, table = sent.value
        wide = np.int64(1) << np.int64(44)
        keys = table[:, 0] * wide + table[:, 1]
        for batch in batches:
            length, part = batch.column("length").to_numpy(), batch.column("_part").to_numpy()
            rank = batch.column("_rank").to_numpy() - 1 + before[length, part]
            slot = table[np.searchsorted(keys, length * wide + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n, _ in types[:-2]), pa.array(slot[:, 2] + rank - slot[:, 1]), pa.array(slot[:, 4])], names=[n for n, _ in types])
    return ranked.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in types))


def pack(docs: DataFrame, path: str, scratch: Scratch | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` for all of ``docs``."""
    scratch = scratch or Scratch(docs.sparkSession)
    pieces = tokenized(docs, path, capacity).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packed(scratch.save(pieces, "pieces"), ["doc_id", "piece", "ids_crc32"], capacity)
