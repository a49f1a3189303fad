"""Candidate contexts for exact repeats of long windows, over bytes or words.

Every window of ``window`` symbols has one anchor: of the ``k``-grams inside,
the one with the least hash (the first, if several share it).  The anchor
depends on the window's content alone, so equal windows have equal anchors at
equal places.  Only windows whose anchor occurs twice or more can repeat.  An
anchor's context is the run of all windows that chose it.  Equal contexts are
counted before anything is compared; what a method finds about one distinct
context then goes back to all its places.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.llm.common import (Scratch, keyed, ranges, slices, span_hashes, text_bytes, word_hashes)

#: A group of distinct contexts beyond this many is settled window by window instead (exactly).
GROUP_LIMIT = 32_768
#: Context bytes that one run of a method works on at most, but for a group of up to GROUP_LIMIT.
CHUNK_BYTES = 3 << 20
_LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Unit:
    """What windows are made of: ``words`` or bytes; ``window`` and ``k`` count those."""

    words: bool
    window: int
    k: int


def _symbols(data: np.ndarray, offsets: np.ndarray, unit: Unit):
    """Symbols to hash, the first symbol of every row, and each symbol's bytes."""
    if unit.words:
        starts, ends, first, hashes = word_hashes(data, offsets)
        return hashes, first, starts, ends
    return data, offsets, None, None


def anchors(symbols: np.ndarray, first: np.ndarray, unit: Unit):
    """Row, anchor, its hash, first and last window of every run of windows with one anchor."""
    none = np.zeros(0, np.int64)
    n, w = len(symbols), unit.window - unit.k + 1
    if n < unit.window:
        return none, none, none.view(np.uint64), none, none
    at = np.arange(n - unit.k + 1)
    grams = span_hashes(symbols, at, at + unit.k)
    bits = np.uint64(max(1, int(n).bit_length()))
    least = (grams >> bits << bits) | at.astype(np.uint64)  # ties: the first
    span = 1
    while span < w:
        step = min(span, w - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    where = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    lengths = np.maximum(np.diff(first) - unit.window + 1, 0)
    starts = ranges(first[:-1], lengths)
    if not len(starts):
        return none, none, none.view(np.uint64), none, none
    rows, where = np.repeat(np.arange(len(lengths)), lengths), where[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (where[1:] != where[:-1]) | (rows[1:] != rows[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(starts)) - 1
    return rows[begin], where[begin], grams[where[begin]], starts[begin], starts[end]


def _emit_anchors(unit: Unit):
    schema = pa.schema([("h", pa.int64()), ("rk", pa.int64()), ("info", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("rk").to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets):
                part = data[offsets[i]:offsets[j]]
                symbols, first, _, _ = _symbols(part, offsets[i:j + 1] - offsets[i], unit)
                rows, at, h, lo, hi = anchors(symbols, first, unit)
                info = ((at - first[rows]) << 20) | ((at - lo) << 10) | (at - hi)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(keys[i:j][rows]), pa.array(info)], schema=schema)
    return run


def _emit_contexts(unit: Unit):
    schema = pa.schema([("rk", pa.int64()), ("doc", pa.int64()), ("pos", pa.int64()), ("h", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("ctx", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs = batch.column("rk").to_numpy(), batch.column("doc").to_numpy()
            data, offsets = text_bytes(batch.column("text"))
            infos = batch.column("infos")
            for i, j in slices(offsets):
                part = data[offsets[i]:offsets[j]]
                symbols, first, starts, ends = _symbols(part, offsets[i:j + 1] - offsets[i], unit)
                cut = infos.slice(i, j - i)
                info = cut.flatten().to_numpy(zero_copy_only=False)
                rows = np.repeat(np.arange(j - i), cut.value_lengths().to_numpy(zero_copy_only=False))
                at, back, fore = first[rows] + (info >> 20), (info >> 10) & 1023, info & 1023
                lo, end = at - back, at - fore + unit.window
                h = span_hashes(symbols, at, at + unit.k).view(np.int64)
                if unit.words:
                    raw = part.tobytes()
                    texts = [b" ".join(raw[s:e].split()) for s, e in zip(starts[lo].tolist(), ends[end - 1].tolist())]
                else:
                    raw = part.tobytes()
                    texts = [raw[s:e] for s, e in zip(lo.tolist(), end.tolist())]
                for s in range(0, len(texts), 20_000):
                    t = slice(s, s + 20_000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[i:j][rows[t]]), pa.array(docs[i:j][rows[t]]), pa.array((lo - first[rows])[t]), pa.array(h[t]),
                        pa.array(back[t].astype(np.int32)), pa.array((back - fore + 1)[t].astype(np.int32)), pa.array(texts[t], pa.binary())], schema=schema)
    return run


Finder = Callable[[np.ndarray, np.ndarray, list, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups (rows arrive in order of h) of about CHUNK_BYTES."""
    held, size = [], 0
    for batch in batches:
        at = 0
        h = batch.column("h").to_numpy()
        lengths = np.diff(np.frombuffer(batch.column("ctx").cast(pa.large_binary()).buffers()[1], np.int64)[:len(h) + 1])
        total = np.cumsum(lengths)
        while at < len(h):
            room = CHUNK_BYTES - size
            cut = int(np.searchsorted(total, (total[at - 1] if at else 0) + max(room, 0), side="right"))
            while cut < len(h) and (cut > 0 and h[cut] == h[cut - 1] or cut == 0 and held and h[0] == held[-1].column("h")[-1].as_py()):
                cut += 1
            if cut > at:
                held.append(batch.slice(at, cut - at))
                size += int(total[cut - 1] - (total[at - 1] if at else 0))
            if cut < len(h):
                if held:
                    yield pa.Table.from_batches(held)
                held, size = [], 0
            at = cut
    if held:
        yield pa.Table.from_batches(held)


def _runs(flags: np.ndarray, first: np.ndarray, n: np.ndarray) -> list[list[int]]:
    """For each context, first and last of every run of flagged windows."""
    padded = np.zeros(len(flags) + len(n) * 2, dtype=np.int8)  # an unflagged place before and after each
    shift = np.arange(len(n)) * 2 + 1
    padded[ranges(first + shift, n)] = flags
    edge = np.diff(padded)
    up, down = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1)
    owner = np.searchsorted(first + shift, up, side="right") - 1
    pairs = np.stack([up - (first + shift)[owner], down - (first + shift)[owner]], axis=1).reshape(-1)
    cuts = np.searchsorted(owner, np.arange(len(n) + 1)) * 2
    flat = pairs.tolist()
    return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


_FOUND = pa.schema([("ck", pa.int64()), ("runs", pa.list_(pa.int32()))])


def _apply(find: Finder, unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            h, lo, n, copies, doc, pos = (table.column(c).to_numpy() for c in ("h", "lo", "n", "copies", "doc", "pos"))
            first = np.cumsum(n) - n
            flags = find(h, lo, table.column("ctx").to_pylist(), n, copies, np.stack([doc, pos]), unit)
            yield pa.RecordBatch.from_arrays([pa.array(table.column("ck").to_numpy()), pa.array(_runs(flags, first, n), pa.list_(pa.int32()))], schema=_FOUND)
    return run


def _emit_windows(unit: Unit):
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("ck", pa.int64()), ("o", pa.int32()), ("copies", pa.int64()), ("doc", pa.int64()), ("pos", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for s in range(0, len(rows), 1000):
                out = []
                for r in rows[s:s + 1000]:
                    items = r["ctx"].split(b" ") if unit.words else r["ctx"]
                    for o in range(r["n"]):
                        piece = items[o:o + unit.window]
                        d = xxhash.xxh3_128_digest(b" ".join(piece) if unit.words else piece)
                        out.append((int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), r["ck"], o, r["copies"], r["doc"], r["pos"] + o))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
    return run


def repeated_windows(docs: DataFrame, unit: Unit, find: Finder, earlier_only: bool, scratch: Scratch) -> DataFrame:
    """``(rk, starts)``: first and last starts of all runs of repeated windows of a document, flat.

    ``find`` gets the distinct contexts of whole groups (hash, windows before
    the anchor, bytes, number of windows, copies, first place) and says which
    windows repeat.  With ``earlier_only`` the first place of a window (least
    doc_id, then start) isn't counted as a repeat.  Documents without one are left out.
    """
    rows = keyed(docs)
    marks = scratch.save(rows.select("rk", "text").mapInArrow(_emit_anchors(unit), "h long, rk long, info long"), "anchors")
    shared = scratch.save(marks.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "shared")
    places = scratch.save(marks.join(shared, "h").groupBy("rk").agg(F.collect_set("info").alias("infos")), "places")
    scratch.release()
    scratch.drop("anchors", "shared")
    found = scratch.save(
        rows.select("rk", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), "text").join(places, "rk")
        .mapInArrow(_emit_contexts(unit), "rk long, doc long, pos long, h long, lo int, n int, ctx binary")
        .withColumn("ck", F.xxhash64("h", "lo", "ctx")), "contexts")
    scratch.release()
    scratch.drop("places")
    least = F.min(F.struct("doc", "pos")).alias("at")
    distinct = scratch.save(
        found.groupBy("ck", "h", "lo", "n", "ctx").agg(F.count("*").alias("copies"), least)
        .select("ck", "h", "lo", "n", "ctx", "copies", "at.doc", "at.pos"), "distinct")
    scratch.release()
    large = distinct.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > GROUP_LIMIT).select("h")
    large = scratch.save(large, "large")
    has_large = not large.isEmpty()
    normal = distinct.join(large, "h", "left_anti") if has_large else distinct
    kept = scratch.save(
        normal.repartition("h").sortWithinPartitions("h").select("ck", "h", "lo", "n", "ctx", "copies", "doc", "pos")
        .mapInArrow(_apply(find, unit), "ck long, runs array<int>"), "found")
    if has_large:
        kept = kept.unionByName(_large_groups(distinct.join(large, "h", "left_semi"), unit, earlier_only, scratch))
    first = distinct.select("ck", F.col("doc").alias("doc0"), F.col("pos").alias("pos0"))
    place = found.select("ck", "rk", "doc", "pos", "n")
    if earlier_only:
        known = scratch.save(kept.join(first, "ck"), "known")
        own = (F.col("doc") == F.col("doc0")) & (F.col("pos") == F.col("pos0"))
        runs = F.when(own, F.col("runs")).otherwise(F.array(F.lit(0), F.col("n") - 1))
    else:
        known = kept if not has_large else scratch.save(kept, "known")
        runs = F.col("runs")
    starts = F.transform(runs, lambda x: x + F.col("pos"))
    out = (place.join(known, "ck").select("rk", starts.alias("starts")).where(F.size("starts") > 0)
           .groupBy("rk").agg(F.flatten(F.collect_set("starts")).alias("starts")))
    out = scratch.save(out, "starts")
    scratch.release()
    scratch.drop(*[x for x in scratch.paths if x in ("contexts", "distinct", "large", "found", "known")])
    return out


def _large_groups(contexts: DataFrame, unit: Unit, earlier_only: bool, scratch: Scratch) -> DataFrame:
    """Groups beyond GROUP_LIMIT, exactly: count every window by its 128-bit digest."""
    windows = scratch.save(
        contexts.select("ck", "n", "ctx", "copies", "doc", "pos")
        .mapInArrow(_emit_windows(unit), "d1 long, d2 long, ck long, o int, copies long, doc long, pos long"), "windows")
    totals = scratch.save(
        windows.groupBy("d1", "d2").agg(F.sum("copies").alias("c"), F.min(F.struct("doc", "pos")).alias("at")).where("c > 1"), "totals")
    hit = windows.join(totals, ["d1", "d2"])
    if earlier_only:
        hit = hit.where((F.col("doc") != F.col("at.doc")) | (F.col("pos") != F.col("at.pos")))
    single = hit.groupBy("ck").agg(F.flatten(F.collect_list(F.array("o", "o"))).alias("runs"))
    return contexts.select("ck").join(single, "ck", "left").select("ck", F.coalesce("runs", F.array().cast("array<int>")).alias("runs"))


def covered(starts: "list[int]", window: int) -> list[dict]:
    """Maximal runs that the windows starting in ``starts`` (first, last, ...) cover."""
    spans: list[dict] = []
    for a, b in sorted(zip(starts[::2], starts[1::2])):
        if spans and a <= spans[-1]["e"]:
            spans[-1]["e"] = max(spans[-1]["e"], b + window)
        else:
            spans.append({"s": a, "e": b + window})
    return spans


SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def covered_spans(starts: DataFrame, window: int) -> DataFrame:
    """``(rk, cut)``: maximal covered runs of each document, in order."""
    schema = pa.schema([("rk", pa.int64()), ("cut", SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [covered(x, window) for x in batch.column("starts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rk"), pa.array(cut, SPANS)], schema=schema)
    return starts.mapInArrow(run, "rk long, cut array<struct<s:int,e:int>>")


def kept_spans(cut, length):
    """Column of the runs between the runs of ``cut``: ``length`` is the end."""
    none = F.array().cast("array<struct<s:int,e:int>>")
    ends = F.concat(F.array(F.lit(0)), F.transform(cut, lambda x: x["e"]))
    begins = F.concat(F.transform(cut, lambda x: x["s"]), F.array(length.cast("int")))
    runs = F.zip_with(ends, begins, lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    return F.filter(F.coalesce(runs, none), lambda x: x["s"] < x["e"])
