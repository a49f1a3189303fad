"""N-gram Jaccard join with parity sketches.

A document is the set of its five-word shingles.  Two sets of sizes a and b have
a Jaccard likeness of 0.75 exactly when they differ in at most (a + b) / 7
shingles.  Shingles are dealt over 2**k blocks, k by size band, and a block's
sketch is the exclusive-or of the hashes in it.  One shingle that only one set
has spoils one block, so of any d + 1 filled blocks one agrees in two sets that
differ in d shingles: a document joins others on its first d + 1 filled blocks
(``block_keys``; one with too few filled blocks also joins on its empty ones).

Equal sets are one class first.  In a bucket of equal blocks every class is
held against the bucket's least class only; where links then leave a bucket's
classes in several components, the pairs across these are held against each
other too, so no link between components is lost and no group's pairs are all
made.  Pairs meet as whole-set sketches first: one bit for about one shingle, the
parity of those that fall on it, so the Hamming distance of two sketches is at
most the number of differing shingles.  What passes is verified on the sets.

Defined results: A-Z are lower-cased; a text of one to four words is one
shingle; null texts and texts without words have no shingles and stand alone;
repeated rows are linked; a component's id is its least id that isn't null.
Shingles and classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.llm.common import Scratch, keyed, mixed, ranges, slices, span_hashes, text_bytes, unused, word_hashes
from upcheck.llm.components import components

SHINGLE = 5
#: Classes of a bucket that meet in one unit; larger buckets are dealt into blocks.
BLOCK = 2048
#: Pairs that a task holds before it makes them distinct.
PACK = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# ------------------------------------------------------------------ sets and keys (numpy)

def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one row after another, and where each row's begin."""
    _, _, first, hashes = word_hashes(LOWER[data], offsets)
    count = np.diff(first)
    many = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    begin = ranges(first[:-1], many)
    row = np.repeat(np.arange(len(count)), many)
    h = span_hashes(hashes, begin, begin + np.minimum(size, count[row]))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.searchsorted(row[new], np.arange(len(count) + 1))


def differences(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest number of differing shingles that links of a set of n may allow, by the partner's size."""
    return (n + (3 * n + 3) // 4) // 7, (n + 4 * n // 3) // 7


def band(d: np.ndarray) -> np.ndarray:
    """k of the 2**k blocks for links that allow d differences: half as many blocks again as must be filled, and four."""
    return np.ceil(np.log2(1.5 * (d + 1) + 4)).astype(np.int64)


def most(k: np.ndarray) -> np.ndarray:
    """The most differences in band k."""
    return ((2.0 ** k - 4) / 1.5 - 1 + 1e-9).astype(np.int64)


def block_keys(h: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of all blocks that rows join on."""
    n = np.diff(begin)
    least, greatest = differences(n)
    low, high = band(least), band(greatest)
    rows = np.flatnonzero(n > 0)
    task = np.concatenate([rows, rows[high[rows] > low[rows]]])  # a set that reaches into two bands joins in both
    k = np.concatenate([low[rows], high[rows[high[rows] > low[rows]]]])
    need = np.minimum(greatest[task], most(k)) + 1
    size = n[task]
    at = ranges(begin[:-1][task], size)
    owner = np.repeat(np.arange(len(task)), size)
    spread = mixed(h[at] ^ (k[owner].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    block = (spread & ((np.uint64(1) << k[owner].astype(np.uint64)) - np.uint64(1))).astype(np.int64)
    base = np.cumsum(1 << k) - (1 << k)
    place = base[owner] + block
    order = np.argsort(place, kind="stable")
    place, spread = place[order], spread[order]
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    head = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    parity = mixed(np.bitwise_xor.reduceat(spread, head) + np.uint64(1))
    place = place[head]
    owner = np.searchsorted(base, place, side="right") - 1
    filled = np.bincount(owner, minlength=len(task))
    rank = np.arange(len(place)) - (np.cumsum(filled) - filled)[owner]
    keep = rank < need[owner]
    few = filled < need
    empty = ranges(base[few], (1 << k)[few])
    empty = np.setdiff1d(empty, place, assume_unique=True)
    place, parity = np.append(place[keep], empty), np.append(parity[keep], np.zeros(len(empty), np.uint64))
    owner = np.searchsorted(base, place, side="right") - 1
    number = ((place - base[owner]).astype(np.uint64) << np.uint64(6)) | k[owner].astype(np.uint64)
    return task[owner], mixed(parity ^ mixed(number + np.uint64(1)))


def sketches(h: np.ndarray, begin: np.ndarray) -> list[bytes]:
    """Each set's parity bits: a power of two of them, as many as shingles or up to twice as many, 64 at least."""
    n = np.diff(begin)
    bits = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    base = np.cumsum(bits) - bits
    owner = np.repeat(np.arange(len(n)), n)
    place = base[owner] + (mixed(h) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(place, minlength=int(bits.sum())) & 1
    raw = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [raw[a:b] for a, b in zip((base // 8).tolist(), ((base + bits) // 8).tolist())]


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch with ``size`` bytes: halves of a parity sketch add up to a shorter one."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size // 8), axis=0)


def may_link(n, m, distance):
    """Whether sets of these sizes whose sketches have this distance can link."""
    return 7 * distance <= n + m


def class_ids(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of each row's set."""
    return span_hashes(h, begin[:-1], begin[1:]).view(np.int64)


# ------------------------------------------------------------------ tasks

def _sliced(batch: pa.RecordBatch):
    data, offsets = text_bytes(batch.column("text"))
    for i, j in slices(offsets):
        yield i, j, *shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, h, begin in _sliced(batch):
            yield pa.RecordBatch.from_arrays([batch.column("rk").slice(i, j - i), batch.column("doc_id").slice(i, j - i), pa.array(np.diff(begin)), pa.array(class_ids(h, begin)), pa.array(sketches(h, begin), pa.binary())], names=["rk", "doc_id", "n", "cls", "sketch"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: set[int] = set()  # a class sends its keys once from a task
    for batch in batches:
        for i, j, h, begin in _sliced(batch):
            ids = class_ids(h, begin)
            fresh = np.zeros(j - i, dtype=bool)
            for at, c in enumerate(ids.tolist()):
                if c not in done:
                    done.add(c)
                    fresh[at] = True
            n = np.where(fresh, np.diff(begin), 0)
            chosen = h[ranges(begin[:-1], n)]
            row, key = block_keys(chosen, np.append(0, np.cumsum(n)))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids[row])], names=["key", "cls"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, cls, lead) of keys that two or more classes have; rows come in order of key and class."""
    key0, lead0, told = None, 0, False
    for batch in batches:
        key, cls = batch.column("key").to_numpy(), batch.column("cls").to_numpy()
        if not len(key):
            continue
        joins = key0 is not None and key[0] == key0
        if joins:  # goes on where the last batch ended
            key, cls = np.append(key0, key), np.append(lead0, cls)
        new = np.append(True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]))
        key, cls = key[new], cls[new]
        head = np.append(True, key[1:] != key[:-1])
        run = np.cumsum(head) - 1
        start = np.flatnonzero(head)
        size = np.diff(np.append(start, len(key)))
        out = size[run] > 1
        if joins and told:
            out[0] = False
            out[1:] |= run[1:] == 0
        lead = cls[start][run]
        told = bool(size[-1] > 1 or joins and told and len(start) == 1)
        key0, lead0 = key[-1], lead[-1]
        yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(cls[out]), pa.array(lead[out])], names=["key", "cls", "lead"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, h, begin in _sliced(batch):
            raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(begin * 8), pa.py_buffer(h)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(class_ids(h, begin)), raw], names=["cls", "shingles"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([p, q])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= 75 * (len(both) - common))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (a, b) with sizes n, m and sketches x, y those that may link."""
    for batch in batches:
        n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
        far = np.zeros(batch.num_rows, np.int64)
        for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())):
            size = min(len(x), len(y))
            far[i] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()
        keep = pa.array(may_link(n, m, far), pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])


def _unit_pairs(cls: np.ndarray, label: np.ndarray, n: np.ndarray, side: np.ndarray, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a unit in different components that may link; of two sides only pairs across these.

    Sizes that can link have sketches of one length or of one and its double."""
    a, b = [], []
    length = np.fromiter(map(len, raw), np.int64, len(raw))
    for size in np.unique(length).tolist():
        own, more = np.flatnonzero(length == size), np.flatnonzero(length == 2 * size)
        every = np.append(own, more)
        sketch = np.stack([folded(raw[i], size) for i in every])
        for k, i in enumerate(own):
            rest = every[k + 1:]
            ok = (label[rest] != label[i]) & (4 * np.minimum(n[rest], n[i]) >= 3 * np.maximum(n[rest], n[i]))
            if side[0] != side[-1]:
                ok &= side[rest] != side[i]
            ok = np.flatnonzero(ok)
            if len(ok):
                at = rest[ok]
                at = at[may_link(n[at], n[i], np.bitwise_count(sketch[ok + k + 1] ^ sketch[k]).sum(axis=1, dtype=np.int64))]
                a.append(np.full(len(at), cls[i]))
                b.append(cls[at])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _unique(pairs: list[np.ndarray]) -> np.ndarray:
    """Distinct columns (a, b), a < b, of arrays of pairs."""
    both = np.sort(np.concatenate(pairs, axis=1), axis=0)
    order = np.lexsort((both[1], both[0]))
    both = both[:, order]
    return both[:, np.append(True, (both[:, 1:] != both[:, :-1]).any(axis=0))] if both.shape[1] else both


def _crossed(slots: int):
    """Pairs of each unit (key, p, q) as rows (slot, packed pairs).

    Rows come in order of unit and side, and a unit's are held together (at
    most about twice BLOCK).  Two classes meet in many units: a task sends a pair
    once, packed with others of its slot, and the slot makes pairs distinct."""
    schema = pa.schema([("slot", pa.int32()), ("pairs", pa.binary())])

    def found(table: pa.Table) -> list[np.ndarray]:
        cls, label, n, side = (table.column(c).to_numpy() for c in ("cls", "label", "n", "side"))
        raw = table.column("sketch").to_pylist()
        unit = np.stack([table.column(c).to_numpy() for c in ("key", "p", "q")])
        edge = np.flatnonzero(np.append(True, (unit[:, 1:] != unit[:, :-1]).any(axis=0)))
        return [np.stack(_unit_pairs(cls[i:j], label[i:j], n[i:j], side[i:j], raw[i:j])) for i, j in zip(edge, np.append(edge[1:], len(cls))) if j - i > 1]

    def packed(pairs: np.ndarray) -> pa.RecordBatch:
        slot = (mixed(pairs[0].astype(np.uint64) ^ mixed(pairs[1].astype(np.uint64))) % np.uint64(slots)).astype(np.int32)
        order = np.argsort(slot, kind="stable")
        slot, pairs = slot[order], pairs[:, order]
        edge = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(slot[edge]), pa.array([pairs[:, i:j].T.tobytes() for i, j in zip(edge, np.append(edge[1:], len(slot)))], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        ready: list[np.ndarray] = [np.zeros((2, 0), np.int64)]

        def add(table: pa.Table) -> None:
            ready.extend(found(table))
            if sum(x.shape[1] for x in ready) > PACK:
                ready[:] = [_unique(ready)]
        for batch in batches:
            unit = np.stack([batch.column(c).to_numpy() for c in ("key", "p", "q")])
            if not unit.shape[1]:
                continue
            change = np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(axis=0))
            last = int(change[-1]) + 1 if len(change) else 0  # where the last unit of the batch begins
            if held and (last or any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in ("key", "p", "q"))):
                add(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            elif last:
                add(pa.Table.from_batches([batch.slice(0, last)]))
            held.append(batch.slice(last))
            if ready[0].shape[1] > PACK // 2:
                yield packed(ready.pop(0))
                ready.insert(0, np.zeros((2, 0), np.int64))
        if held:
            add(pa.Table.from_batches(held))
        pairs = _unique(ready)
        if pairs.shape[1]:
            yield packed(pairs)
    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of whole slots, which come one after another."""
    slot, held = None, [np.zeros((2, 0), np.int64)]

    def told() -> pa.RecordBatch:
        pairs = _unique(held)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
    for batch in batches:
        for s, raw in zip(batch.column("slot").to_pylist(), batch.column("pairs").to_pylist()):
            if s != slot and slot is not None:
                yield told()
                held = [np.zeros((2, 0), np.int64)]
            slot = s
            held.append(np.frombuffer(raw, np.int64).reshape(-1, 2).T)
            if len(held) > 64:
                held = [_unique(held)]
    yield told()


# ------------------------------------------------------------------ Spark

def _filtered(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the class pairs ``(a, b)`` whose sizes and sketches allow a link."""
    left = classes.select(F.col("cls").alias("a"), "n", F.col("sketch").alias("x"))
    right = classes.select(F.col("cls").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    near = 4 * F.least("n", "m") >= 3 * F.greatest("n", "m")
    return pairs.join(left, "a").join(right, "b").where(near).select("a", "b", "n", "m", "x", "y").mapInArrow(_near, "a long, b long")


def _linked(pairs: DataFrame, rows: DataFrame, classes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Those of the class pairs ``(a, b)`` that link, by their sets; these are made of one document of each class."""
    pairs = scratch.save(pairs, f"{name}_pairs")
    used = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    chosen = scratch.save(classes.join(used, "cls", "left_semi").select("rk"), f"{name}_chosen")
    sets = scratch.save(rows.join(chosen, "rk", "left_semi").select("text").mapInArrow(_sets, "cls long, shingles binary").dropDuplicates(["cls"]), f"{name}_sets")
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
    links = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_verified, "a long, b long")
    return scratch.save(links, f"{name}_links")


def labelled(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(rk, doc_id, n_shingles, label)``: rows that links connect share a label; null: no shingles."""
    rows = keyed(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    members = scratch.save(rows.mapInArrow(_classes, f"rk long, doc_id {id_type}, n long, cls long, sketch binary"), "members")
    keys = rows.select("text").mapInArrow(_keys, "key long, cls long")
    buckets = scratch.save(
        keys.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(_buckets, "key long, cls long, lead long"), "buckets")
    scratch.release()
    met = buckets.select("cls").distinct()
    one = F.min(F.struct("rk", "n", "sketch")).alias("x")
    classes = scratch.save(members.join(met, "cls", "left_semi").groupBy("cls").agg(one).select("cls", "x.rk", "x.n", "x.sketch"), "classes")
    stars = buckets.where("cls <> lead").select(F.col("lead").alias("a"), F.col("cls").alias("b")).distinct()
    stars = scratch.save(_filtered(stars, classes), "stars")
    links = _linked(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), rows, classes, scratch, "first")
    labels = scratch.save(components(links, scratch, "first"), "first_labels")
    apart = stars.join(_named(labels, "a"), "a", "left").join(_named(labels, "b"), "b", "left")
    apart = apart.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")
    links, labels = _extended(links, labels, _linked(apart, rows, classes, scratch, "second"), scratch, "second")
    across = _across(buckets, labels, classes, scratch)
    links, labels = _extended(links, labels, _linked(across, rows, classes, scratch, "third"), scratch, "third")
    placed = members.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    placed = scratch.save(placed.select("rk", "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("label", "cls")).alias("label")), "placed")
    scratch.drop(*[x for x in scratch.paths if x != "placed"])
    return placed


def joined(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: documents that links connect share the least of their ids."""
    scratch = scratch or Scratch(docs.sparkSession)
    placed = labelled(docs, scratch)
    least = scratch.save(placed.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id")), "least")
    return placed.join(least, "label", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Rows of ``docs``: of those that links connect the one with the least id, and all without shingles."""
    scratch = scratch or Scratch(docs.sparkSession)
    placed = labelled(docs, scratch)
    key, alone = unused("rk", docs.columns), unused("alone", docs.columns)
    first = placed.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rk")).alias("x"))
    kept = scratch.save(first.select(F.col("x.rk").alias(key), F.lit(False).alias(alone)).unionByName(
        placed.where("label is null").select(F.col("rk").alias(key), F.lit(True).alias(alone)).distinct()), "kept_rows")
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(kept, key)
    # rows that repeat id and text share a key: of those with shingles one stays; nothing tells the others apart, so
    # they pass as they are and no task has to number them
    one = rows.where(~F.col(alone)).dropDuplicates([key])
    return rows.where(alone).unionAll(one).select(*docs.columns)


def _extended(links: DataFrame, labels: DataFrame, more: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """Links and labels with ``more`` links."""
    if more.isEmpty():
        return links, labels
    links = links.unionByName(more)
    return links, scratch.save(components(links, scratch, name), f"{name}_labels")


def _named(labels: DataFrame, column: str) -> DataFrame:
    return labels.select(F.col("node").alias(column), F.col("label").alias(f"label_{column}"))


def _across(buckets: DataFrame, labels: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Class pairs of a bucket in different components that may link; the bucket's least class is verified already.

    A bucket of more than BLOCK classes is dealt into blocks, and each two
    blocks meet in a unit of their own.
    """
    rest = buckets.where("cls <> lead").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    rest = scratch.save(rest.select("key", "cls", F.coalesce("label", "cls").alias("label")), "labelled")
    torn = rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("c")).where("lo <> hi")
    torn = scratch.save(torn.select("key", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")), "torn")
    side = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    dealt = rest.join(torn, "key").withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = dealt.select("key", F.least("side", "other").alias("p"), F.greatest("side", "other").alias("q"), "cls", "label", "side")
    units = units.join(classes.select("cls", "n", "sketch"), "cls")
    slots = 4 * int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (units.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "side")
            .mapInArrow(_crossed(slots), "slot int, pairs binary")
            .repartition("slot").sortWithinPartitions("slot").mapInArrow(_unpacked, "a long, b long"))
