"""Suffix-array deduplication: cut every byte inside a long string that stands twice.

Suffixes are sorted deep-shallow: a multikey quicksort over eight-byte symbols
orders them to a shallow depth, and blind tries order the groups that still
share a prefix there.  Only suffixes at anchors are sorted (``repeats``), to the
right and, reversed, to the left; the longest common prefixes of neighbours in
both orders say of every window around an anchor whether it repeats.

Defined results: null text is empty and loses nothing; texts shorter than the
window stay; rows that repeat an id are documents of their own; bytes and not
characters are cut, so ``kept`` is binary.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.llm.common import Scratch, unused
from upcheck.llm.repeats import Unit, covered_spans, kept_spans, keyed, repeated_windows

WINDOW = 200
#: Shared bytes of an anchor: longer ones make fewer false candidates, shorter ones fewer anchors.
ANCHOR = 65
#: Bytes that the multikey quicksort looks at before blind tries take over.
SHALLOW = 32


class Node:
    """Inner node of a blind trie: strings below share ``depth`` bytes; kids go by the byte there (-1: end)."""

    __slots__ = ("depth", "kids")

    def __init__(self, depth: int, kids: dict):
        self.depth, self.kids = depth, kids


def common_prefix(a: bytes, b: bytes) -> int:
    m = min(len(a), len(b))
    differ = int.from_bytes(a[:m], "big") ^ int.from_bytes(b[:m], "big")
    return m - (differ.bit_length() + 7) // 8


def blind_trie_order(strings: list[bytes], members: list[int]) -> list[tuple[int, int]]:
    """Members in the order of their strings, each with its common prefix with the one before (-1: none)."""
    root: Node | list[int] = [members[0]]
    for m in members[1:]:
        s = strings[m]
        at = root
        while isinstance(at, Node):  # blind: only the branching bytes are looked at
            kid = at.kids.get(s[at.depth] if at.depth < len(s) else -1)
            at = next(iter(at.kids.values())) if kid is None else kid
        other = strings[at[0]]
        shared = common_prefix(s, other)
        if shared == len(s) == len(other):
            at.append(m)
            continue
        above, at = None, root
        while isinstance(at, Node) and at.depth < shared:
            above, byte = at, s[at.depth]
            at = at.kids[byte]
        mine = s[shared] if shared < len(s) else -1
        if isinstance(at, Node) and at.depth == shared:
            at.kids[mine] = [m]
            continue
        new = Node(shared, {other[shared] if shared < len(other) else -1: at, mine: [m]})
        if above is None:
            root = new
        else:
            above.kids[byte] = new
    out: list[tuple[int, int]] = []
    stack: list[tuple[Node | list[int], int]] = [(root, -1)]
    while stack:
        at, shared = stack.pop()
        if isinstance(at, Node):
            kids = [at.kids[b] for b in sorted(at.kids)]
            stack.extend((kid, at.depth) for kid in reversed(kids[1:]))
            stack.append((kids[0], shared))
        else:
            out.append((at[0], shared))
            out.extend((m, len(strings[at[0]])) for m in at[1:])
    return out


def deep_shallow_sort(strings: list[bytes], groups: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order by (group, string), and each string's common prefix with the one before; -1 where a group begins."""
    n = len(strings)
    words = np.frombuffer(b"".join(s[:shallow].ljust(shallow, b"\0") for s in strings), dtype=">u8").reshape(n, shallow // 8).astype(np.uint64)
    sizes = np.fromiter((len(s) for s in strings), np.int64, n)
    order = np.argsort(groups, kind="stable")
    lcp = np.zeros(n, np.int64)
    begins = np.ones(n, dtype=bool)  # of groups that are still to be ordered
    begins[1:] = groups[order[1:]] != groups[order[:-1]]
    lcp[begins] = -1
    for level in range(shallow // 8):
        part = np.cumsum(begins)
        open_ = np.bincount(part, minlength=part[-1] + 1)[part] > 1
        at = np.flatnonzero(open_)
        if not len(at):
            break
        word = words[order[at], level]
        to = np.lexsort((word, part[at]))
        order[at], word = order[at[to]], word[to]
        split = np.flatnonzero((word[1:] != word[:-1]) & (part[at[1:]] == part[at[:-1]])) + 1
        differ = word[split] ^ word[split - 1]
        same = 7 - (np.frexp(differ.astype(np.float64))[1] - 1) // 8
        for b in range(7):  # frexp rounds up just below a power of two
            same = np.where((same == b) & (differ >> np.uint64(56 - 8 * b) == 0), b + 1, same)
        lcp[at[split]] = 8 * level + same
        begins[at[split]] = True
    edge = np.append(np.flatnonzero(begins), n)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if b - a > 1:
            sorted_ = blind_trie_order(strings, order[a:b].tolist())
            order[a:b] = [m for m, _ in sorted_]
            lcp[a + 1:b] = [shared for _, shared in sorted_[1:]]
    # padding may look like zero bytes: no prefix is longer than either string
    lcp[1:] = np.minimum(lcp[1:], np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    return order, lcp


def find_repeats(h, lo, contexts, n, copies, place, unit: Unit) -> np.ndarray:
    """Which windows of distinct contexts stand twice, by the two orders around the anchors."""
    count = len(contexts)
    first = np.cumsum(n) - n
    flags = np.zeros(int(n.sum()), dtype=bool)
    backs = lo.tolist()
    order_r, lcp_r = deep_shallow_sort([c[b:] for c, b in zip(contexts, backs)], h)
    order_l, lcp_l = deep_shallow_sort([c[:b][::-1] for c, b in zip(contexts, backs)], h)
    right, left = np.empty(count, np.int64), np.empty(count, np.int64)
    hi = lo - n + 1
    for o in range(int(hi.min()), int(lo.max()) + 1):
        at = np.flatnonzero((hi <= o) & (o <= lo))
        if not len(at):
            continue
        right[order_r] = np.cumsum(lcp_r < unit.window - o)
        left[order_l] = np.cumsum(lcp_l < o)
        key = right[at] * (count + 1) + left[at]
        to = np.argsort(key, kind="stable")
        same = key[to[1:]] == key[to[:-1]]
        hit = copies[at] > 1
        hit[to[1:][same]] = True
        hit[to[:-1][same]] = True
        flags[first[at] + lo[at] - o] = hit
    return flags


def find_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, scratch: Scratch | None = None) -> DataFrame:
    """``(rk, cut)``: maximal runs of bytes, covered by strings of ``window`` bytes that also start elsewhere."""
    unit = Unit(words=False, window=window, k=anchor)
    starts = repeated_windows(docs, unit, find_repeats, False, scratch or Scratch(docs.sparkSession))
    return covered_spans(starts, window)


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(doc_id, text, cut, kept)``: every document with its removed runs and its remaining bytes (binary)."""
    cut = find_spans(docs, window, anchor)
    none = F.array().cast("array<struct<s:int,e:int>>")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    joined = keyed(docs).join(cut, "rk", "left").select("doc_id", "text", F.coalesce("cut", none).alias("cut"), raw.alias("raw"))
    parts = F.transform(kept_spans(F.col("cut"), F.octet_length("raw")), lambda x: F.substring(F.col("raw"), x["s"] + 1, x["e"] - x["s"]).cast("string"))
    kept = F.when(F.size("cut") == 0, F.col("raw")).otherwise(F.array_join(parts, "").cast("binary"))
    return joined.select("doc_id", "text", "cut", kept.alias("kept"))


def _goes_on(raw, at):
    """Whether the byte there is inside a character."""
    return F.hex(F.substring(raw, at + 1, F.lit(1))).between("80", "BF")


def _whole(raw, cut):
    """``cut`` shrunk to whole characters."""
    after = lambda s: F.when(~_goes_on(raw, s), 0).when(~_goes_on(raw, s + 1), 1).when(~_goes_on(raw, s + 2), 2).otherwise(3)
    back = lambda e: F.when(~_goes_on(raw, e), 0).when(~_goes_on(raw, e - 1), 1).when(~_goes_on(raw, e - 2), 2).otherwise(3)
    return F.filter(F.transform(cut, lambda x: F.struct((x["s"] + after(x["s"])).alias("s"), (x["e"] - back(x["e"])).alias("e"))), lambda x: x["s"] < x["e"])


def shortened(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Rows of ``docs`` without the repeated bytes, as far as they form whole characters; ``n_chars`` is counted anew."""
    key, cut, raw = (unused(c, docs.columns) for c in ("rk", "cut", "raw"))
    spans = find_spans(docs, window, anchor).select(F.col("rk").alias(key), F.col("cut").alias(cut))
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(spans, key, "left").withColumn(raw, F.col("text").cast("binary"))
    kept = kept_spans(_whole(F.col(raw), F.col(cut)), F.octet_length(raw))
    parts = F.transform(kept, lambda x: F.substring(F.col(raw), x["s"] + 1, x["e"] - x["s"]).cast("string"))
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(F.array_join(parts, ""))
    return rows.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
