"""Merkle manifest of a table: a tree of SHA-256 digests for each group of rows, one tree over the groups.

The leaves of a group, in order, are the lowest level; eight consecutive nodes
(the last run may be shorter) have one parent, until one node remains, the
group's subroot.  Subroots in the order of their groups are leaves of the last
tree, whose top is the root.

A parent keeps a copy of its hash state as it was before each child.  Folding a
changed leaf takes the copy of its slot, adds the new digest and the siblings to
the right, and goes on with the result one level higher; what stands to the left
is never hashed again.

On Spark a tree is worked on in blocks of ``BLOCK`` nodes, which are whole
subtrees of ``LEVELS`` levels and never span groups, so a group with most of the
rows is as many blocks as it needs.  A leaf's place comes from a range
partitioning and the sizes of the ranges before.  Going up, each step turns a
block into one node of the next step's blocks.  Going down, each step hands a
node's siblings to the block below it, so every block of leaves has the siblings
of its top up to the root, and its rows need no other block.  Equal rows travel
as one row with a count until then.

Defined results: leaves of a group ascend by order column, nulls first, then by
digest; repeated rows are a leaf each, one after another; the null group is a
group of its own, before all others; an empty table has no rows.  A null field
is ``-``, an empty text ``0:``.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upcheck.llm.common import Scratch

WIDTH, LEVELS = 8, 3
#: Nodes of a block: a subtree of LEVELS levels.
BLOCK = WIDTH ** LEVELS

Level = tuple[bytes, bytes]  # a node's siblings in its run, left and right of it


# ------------------------------------------------------------------ digests

def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The digest of a row with these fields."""
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


class Block:
    """A subtree: levels of digests, and each parent's hash states before its children."""

    def __init__(self, digests: list[bytes], rise: int | None):
        """``rise`` levels above ``digests``; None: until one node remains."""
        self.levels, self.states = [digests], []
        while (len(self.levels) <= rise) if rise is not None else (len(self.levels[-1]) > 1):
            nodes, states, parents = self.levels[-1], [], []
            for s in range(0, len(nodes), WIDTH):
                parent = hashlib.sha256()
                for child in nodes[s:s + WIDTH]:
                    states.append(parent.copy())
                    parent.update(child)
                parents.append(parent.hexdigest().encode())
            self.states.append(states)
            self.levels.append(parents)

    @property
    def top(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[Level]:
        """Of node ``at``, level by level up to the top."""
        out = []
        for nodes in self.levels[:-1]:
            run = at // WIDTH * WIDTH
            out.append((b"".join(nodes[run:at]), b"".join(nodes[at + 1:run + WIDTH])))
            at //= WIDTH
        return out

    def folded(self, at: int, digest: bytes) -> bytes:
        """The top with ``digest`` in place of node ``at``: every parent's state before its child, resumed."""
        for nodes, states in zip(self.levels, self.states):
            state = states[at].copy()
            state.update(digest)
            state.update(b"".join(nodes[at + 1:at // WIDTH * WIDTH + WIDTH]))
            digest, at = state.hexdigest().encode(), at // WIDTH
        return digest


class Above:
    """The way from a block's top to the root: the states left of it, and the siblings right of it."""

    def __init__(self, levels: list[Level]):
        self.levels = levels
        self.states = [hashlib.sha256(left) for left, _ in levels]

    def folded(self, digest: bytes) -> bytes:
        for (_, right), kept in zip(self.levels, self.states):
            state = kept.copy()
            state.update(digest)
            state.update(right)
            digest = state.hexdigest().encode()
        return digest


def rise_of(total: int, step: int) -> int | None:
    """How far a block of the step goes up in a tree of ``total`` leaves: to its end where one block holds all nodes."""
    return None if -(-total // BLOCK ** step) <= BLOCK else LEVELS


# ------------------------------------------------------------------ places

def placed(nodes: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """Rows ``(tree, *, copies)`` with their first place ``at`` in the tree, and the tree's ``total``.

    A sort into ranges, the number of rows of a tree in each range, and a running sum.
    """
    columns = ["tree", *order]
    kept = [c for c in nodes.columns if c != "copies"]
    sorted_ = nodes.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("range", F.spark_partition_id())
    types = {f.name: f.dataType.simpleString() for f in sorted_.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, seen = None, 0
        for batch in batches:
            before = []
            for name, copies in zip(batch.column("tree").to_pylist(), batch.column("copies").to_pylist()):
                if name != tree:
                    tree, seen = name, 0
                before.append(seen)
                seen += copies
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], names=[*batch.schema.names, "before"])

    rows = scratch.save(sorted_.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in sorted_.columns), "before bigint"])), "ranges")
    w = Window.partitionBy("tree")
    sizes = rows.groupBy("tree", "range").agg(F.sum("copies").alias("size"))
    first = sizes.select("tree", "range", (F.sum("size").over(w.orderBy("range")) - F.col("size")).alias("first"), F.sum("size").over(w).alias("total"))
    return rows.join(scratch.save(first, "range_sizes"), ["tree", "range"]).select(*kept, "copies", (F.col("first") + F.col("before")).alias("at"), "total")


def cut(rows: DataFrame, size: int) -> DataFrame:
    """Runs of equal leaves cut at multiples of ``size``; ``block`` numbers the pieces."""
    rows = rows.select("*", F.explode(F.sequence(F.expr(f"at div {size}"), F.expr(f"(at + copies - 1) div {size}"))).alias("block"))
    first = F.greatest("at", F.col("block") * size)
    return rows.withColumns({"at": first, "copies": F.least(F.col("at") + F.col("copies"), (F.col("block") + 1) * size) - first})


def leaf_blocks(rows: DataFrame) -> DataFrame:
    """``(tree, block, total, nodes)``; a run over very many blocks is cut in two steps, so arrays stay short."""
    return _blocks(cut(cut(rows, BLOCK * BLOCK).drop("block"), BLOCK), ["at", "copies", "key", "digest", "changed"])


def _blocks(rows: DataFrame, columns: list[str]) -> DataFrame:
    """At most BLOCK nodes are collected for a block."""
    return rows.groupBy("tree", "block", "total").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("nodes"))


def _digests(nodes: list[dict]) -> list[bytes]:
    return [d for x in nodes for d in [x["digest"].encode()] * x.get("copies", 1)]


# ------------------------------------------------------------------ up and down

def lifted(blocks: DataFrame, step: int) -> DataFrame:
    """``(tree, at, digest, total)``: the top of every block, a node of the next step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 64):
                part = batch.slice(s, 64)
                tops = [Block(_digests(nodes), rise_of(total, step)).top.decode() for nodes, total in zip(part.column("nodes").to_pylist(), part.column("total").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("tree"), part.column("block"), pa.array(tops, pa.string()), part.column("total")], names=["tree", "at", "digest", "total"])
    return blocks.mapInArrow(run, "tree string, at bigint, digest string, total bigint")


class Steps:
    """All blocks of a forest, written step by step, and the tops of its trees."""

    def __init__(self, blocks: DataFrame, scratch: Scratch, name: str):
        self.blocks, tops = [scratch.save(blocks, f"{name}_blocks")], []
        largest = self.blocks[0].agg(F.max("total")).first()[0] or 0
        while True:
            step = len(self.blocks) - 1
            nodes = scratch.save(lifted(self.blocks[-1], step), f"{name}_nodes")
            done = F.col("total") <= BLOCK ** (step + 1)
            tops.append(nodes.where(done).select("tree", "digest"))
            if largest <= BLOCK ** (step + 1):
                break
            up = nodes.where(~done).withColumn("block", F.floor(F.col("at") / BLOCK))
            self.blocks.append(scratch.save(_blocks(up, ["at", "digest"]), f"{name}_blocks"))
        self.tops = tops[0]
        for more in tops[1:]:
            self.tops = self.tops.unionByName(more)

    def ways(self, above: DataFrame, scratch: Scratch, down_to: int) -> DataFrame:
        """``(tree, block, way, subroot)``: the way from each block of step ``down_to`` to the root.

        ``above`` has ``(tree, way, subroot)``, the way from every tree's top.
        """
        ways = None
        for step in range(len(self.blocks) - 1, down_to, -1):
            here = scratch.save(handed(self._with(step, above, ways), step), "ways")
            ways = here.withColumnRenamed("at", "block")
        return self._with(down_to, above, ways)

    def _with(self, step: int, above: DataFrame, ways: DataFrame | None) -> DataFrame:
        """Blocks of a step with the way from each top: from the step above, or from the tree's top where the tree ends here."""
        blocks, done = self.blocks[step], F.col("total") <= BLOCK ** (step + 1)
        ends = blocks.where(done).join(above, "tree")
        return ends if ways is None else ends.unionByName(blocks.where(~done).join(ways, ["tree", "block"]))


WAY = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
WAY_SQL = "array<struct<left:string,right:string>>"


def handed(blocks: DataFrame, step: int, trees: bool = False) -> DataFrame:
    """``(tree, at, way, subroot)`` of every node of blocks that have a way themselves.

    With ``trees`` the nodes are the tops of trees: ``tree`` is then the one whose top a node is, and ``subroot`` the node.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                nodes = one["nodes"]
                block = Block(_digests(nodes), rise_of(one["total"], step))
                ways = [[{"left": a.decode(), "right": b.decode()} for a, b in block.siblings(i)] + one["way"] for i in range(len(nodes))]
                tree = [x["key"] for x in nodes] if trees else [one["tree"]] * len(nodes)
                subroot = [x["digest"] for x in nodes] if trees else [one["subroot"]] * len(nodes)
                yield pa.RecordBatch.from_arrays([
                    pa.array(tree, pa.string()), pa.array([x["at"] for x in nodes], pa.int64()), pa.array(ways, WAY), pa.array(subroot, pa.string())],
                    names=["tree", "at", "way", "subroot"])
    return blocks.mapInArrow(run, f"tree string, at bigint, way {WAY_SQL}, subroot string")


def proven(blocks: DataFrame, root: str, key_type: str, key: str) -> DataFrame:
    """One row for each leaf: its proof (the siblings of a level as one text, left to right) and what its changed digest folds to."""
    names = [key, "leaf", "changed_leaf", "subroot", "root", "slots", "proof", "folded_root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.schema.field("nodes").type.value_type
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                block = Block(_digests(one["nodes"]), rise_of(one["total"], 0))
                above = Above([(x["left"].encode(), x["right"].encode()) for x in one["way"]])
                beyond = [(a + b).decode() for a, b in above.levels]
                upper = [len(a) // 64 for a, _ in above.levels]
                out: dict[str, list] = {name: [] for name in names}
                at = 0
                for node in one["nodes"]:
                    for _ in range(node["copies"]):
                        digest = (node["changed"] or node["digest"]).encode()
                        levels = block.siblings(at)
                        for name, value in zip(names, (
                                node["key"], node["digest"], node["changed"], one["subroot"], root,
                                [len(a) // 64 for a, _ in levels] + upper, [(a + b).decode() for a, b in levels] + beyond,
                                above.folded(block.folded(at, digest)).decode())):
                            out[name].append(value)
                        at += 1
                key_arrow = keys.field(keys.get_field_index("key")).type
                types = [key_arrow, pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types)], names=names)
    return blocks.mapInArrow(run, f"`{key}` {key_type}, leaf string, changed_leaf string, subroot string, root string, slots array<int>, proof array<string>, folded_root string")


def manifest(rows: DataFrame, fields: list[str], group: str, order: str, changed: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """``order``, leaf, changed_leaf, subroot, root, slots, proof, folded_root of every row.

    A leaf digests ``fields``.  Where ``when`` holds, ``changed`` gives other
    values of some fields; the digest of those is ``changed_leaf``, and
    ``folded_root`` is the root with it in place of the leaf.  Elsewhere
    ``changed_leaf`` is null and ``folded_root`` is folded from the leaf itself.
    ``proof`` has a text for each level, the digests of the run's other nodes;
    ``slots`` says how many of them stand to the left.
    """
    scratch = Scratch(rows.sparkSession)
    key_type = rows.schema[order].dataType.simpleString()
    other = leaf(*((changed or {}).get(f, F.col(f)) for f in fields))
    tree = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = rows.select(tree.alias("tree"), F.col(order).alias("key"), leaf(*map(F.col, fields)).alias("digest"), F.when(F.lit(False) if when is None else when, other).alias("changed"))
    counted = leaves.groupBy("tree", "key", "digest", "changed").agg(F.count("*").alias("copies"))
    trees = Steps(leaf_blocks(placed(counted, ["key", "digest"], scratch)), scratch, "leaf")

    # the trees' tops are the leaves of one more tree, in the order of their groups
    tops = trees.tops.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", F.lit(None).cast("string").alias("changed"), F.lit(1).cast("bigint").alias("copies"))
    last = Steps(leaf_blocks(placed(tops, ["key"], scratch)), scratch, "group")
    root = last.tops.first()
    start = last.tops.select("tree", F.expr(f"cast(array() as {WAY_SQL})").alias("way"), F.lit("").alias("subroot"))
    above = scratch.save(handed(last.ways(start, scratch, 0), 0, trees=True).drop("at"), "ways")
    blocks = trees.ways(above, scratch, 0)
    return proven(blocks, root.digest if root else "", key_type, order)

