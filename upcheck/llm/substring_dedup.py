"""Substring deduplication over words with a compressed FM-index per shard.

A shard holds the distinct contexts of some anchors (``repeats``) as one text.
Its FM-index is the Burrows-Wheeler transform in a wavelet matrix of packed bits
with a running count for every 64.  Windows are searched backwards, all at once;
a search ends as soon as the matching statistic can't grow, that is when one
place is left.  Intervals that reach the window's length are reported, and the
earliest place in each keeps its words.

Defined results: null text has no words; texts with fewer words than a window
stay; a null id comes after all ids; rows with the same id and text keep what
the first of them keeps.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.llm.common import SPACES, Scratch, ranges
from upcheck.llm.repeats import Unit, covered_spans, kept_spans, keyed, repeated_windows

WINDOW = 20
ANCHOR = 7


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence of ranks by prefix doubling (its last value is the only one of its kind)."""
    n, span = len(ranks), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-span] = ranks[span:] + 1
        key = ranks * (int(ranks.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        step = np.ones(n, np.int64)
        step[0] = 0
        step[1:] = key[order[1:]] != key[order[:-1]]
        ranks = np.empty(n, np.int64)
        ranks[order] = np.cumsum(step)
        if ranks[order[-1]] == n - 1 or span * 2 >= n:
            return order
        span *= 2


class FMIndex:
    """Backward search over a sequence of symbols; separators are 0 and are never searched for."""

    def __init__(self, symbols: np.ndarray, order: np.ndarray):
        last = symbols[order - 1]  # the first suffix's predecessor is the last symbol
        self.n, self.bits = len(symbols), max(1, int(symbols.max()).bit_length())
        counts = np.bincount(symbols, minlength=1 << self.bits)
        self.before = np.cumsum(counts) - counts
        self.levels = []
        for bit in reversed(range(self.bits)):
            one = (last >> bit & 1).astype(bool)
            packed = np.packbits(np.append(one, np.zeros(-self.n % 64 + 64, dtype=bool)), bitorder="little").view("<u8")
            running = np.cumsum(np.bitwise_count(packed)) - np.bitwise_count(packed)
            self.levels.append((packed, running.astype(np.int64), self.n - int(one.sum())))
            last = np.concatenate([last[~one], last[one]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first ``i`` of the transform."""
        begin = np.zeros(len(symbol), np.int64)
        for level, (packed, running, zeros) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            for x in (begin, i):
                word = x >> 6
                ones = running[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << (x & 63).astype(np.uint64)) - np.uint64(1)))
                x[:] = np.where(one, zeros + ones, x - ones)
        return i - begin

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with ``symbol`` before those in [lo, hi)."""
        base = self.before[symbol]
        return base + self.rank(symbol, lo.copy()), base + self.rank(symbol, hi.copy())


def find_later(h, lo, contexts, n, copies, place, unit: Unit) -> np.ndarray:
    """Which windows of distinct contexts stand earlier elsewhere."""
    ids: dict[bytes, int] = {}
    words = [c.split(b" ") for c in contexts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int(sizes.sum()) + len(words), np.int64)
    symbols[ranges(begin, sizes)] = np.fromiter((ids.setdefault(w, len(ids) + 1) for c in words for w in c), np.int64, int(sizes.sum()))
    ends = begin + sizes
    ranks = symbols + len(words)
    ranks[ends] = np.arange(len(words))  # every separator is one of its kind
    order = suffix_order(ranks)
    index = FMIndex(symbols, order)
    windows = ranges(begin, n)
    flags = np.zeros(len(windows), dtype=bool)
    live = np.arange(len(windows))
    lo_, hi_ = np.zeros(len(windows), np.int64), np.full(len(windows), index.n, np.int64)
    for step in reversed(range(unit.window)):
        lo_, hi_ = index.extend(symbols[windows[live] + step], lo_, hi_)
        more = hi_ - lo_ > 1
        live, lo_, hi_ = live[more], lo_[more], hi_[more]
    if not len(live):
        return flags
    found, which = np.unique(lo_, return_inverse=True)
    length = np.zeros(len(found), np.int64)
    length[which] = hi_ - lo_
    owner = np.repeat(np.arange(len(words)), sizes + 1)
    at = order[ranges(found, length)]
    group = np.repeat(np.arange(len(found)), length)
    doc, pos = place[0][owner[at]], place[1][owner[at]] + at - begin[owner[at]]
    to = np.lexsort((pos, doc, group))
    head = to[np.cumsum(length) - length]
    mine = windows[live]
    own = owner[mine]
    flags[live] = (doc[head][which] != place[0][own]) | (pos[head][which] != place[1][own] + mine - begin[own])
    return flags


def find_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, scratch: Scratch | None = None) -> DataFrame:
    """``(rk, cut)``: maximal runs of words, covered by windows that also start earlier."""
    unit = Unit(words=True, window=window, k=anchor)
    starts = repeated_windows(docs, unit, find_later, True, scratch or Scratch(docs.sparkSession))
    return covered_spans(starts, window)


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(doc_id, text, n_words, cut, kept)``: every document with its removed runs and its remaining words."""
    cut = find_spans(docs, window, anchor)
    none = F.array().cast("array<struct<s:int,e:int>>")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SPACES), lambda w: w != "")
    joined = (keyed(docs).join(cut, "rk", "left")
              .select("doc_id", "text", F.coalesce("cut", none).alias("cut"), words.alias("words")))
    parts = F.flatten(F.transform(kept_spans(F.col("cut"), F.size("words")), lambda x: F.slice(F.col("words"), x["s"] + 1, x["e"] - x["s"])))
    kept = F.array_join(F.when(F.size("cut") == 0, F.col("words")).otherwise(parts), " ")
    return joined.select("doc_id", "text", F.size("words").cast("long").alias("n_words"), "cut", kept.alias("kept"))
