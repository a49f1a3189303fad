"""Byte-level BPE encoding and decoding, long texts by tree concatenation.

A text of up to ``LEAF`` characters is encoded as it is.  A longer one is halved
until its parts are that short; parts of a text of over ``SPREAD`` characters
are rows of their own, encoded wherever there is room.  Then halves are joined
pair by pair: a window around the join is encoded again and grows until its
outer tokens are those that the left and right side have there.  In BPE a sequence of tokens is right if every
two neighbours are, so beyond such a window nothing can change.

Defined results: null and empty texts have no ids and decode to the empty text;
repeated rows are encoded each; a special token's text becomes its id.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upcheck.llm import vocab
from upcheck.llm.vocab import ByteLevel

LEAF, SPREAD = 1 << 14, 1 << 20
#: Tokens at both ends of a window that must be as before, and tokens on each side to begin with.
GUARD, WINDOW = 2, 8


def _goes_on(raw: bytes) -> bool:
    """Whether a token begins inside a character."""
    return 0x80 <= raw[0] < 0xC0


def concatenated(left: np.ndarray, right: np.ndarray, bpe: ByteLevel) -> np.ndarray:
    """Ids of the text whose halves have these ids."""
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    width = WINDOW
    while True:
        a, b = max(0, len(left) - width), min(len(right), width)
        while a > 0 and _goes_on(bpe.raw[left[a]]):
            a -= 1
        while b < len(right) and _goes_on(bpe.raw[right[b]]):
            b += 1
        again = bpe.encode(bpe.decode([*left[a:], *right[:b]]).decode())
        agrees_left = a == 0 or np.array_equal(again[:GUARD], left[a:a + GUARD])
        agrees_right = b == len(right) or np.array_equal(again[-GUARD:], right[b - GUARD:b])
        if agrees_left and agrees_right:
            return np.concatenate([left[:a], again, right[b:]])
        width *= 2


def tree(parts: list[np.ndarray], bpe: ByteLevel) -> np.ndarray:
    """Ids of a text from those of its parts, joined pair by pair."""
    while len(parts) > 1:
        parts = [concatenated(parts[i], parts[i + 1], bpe) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def halves(text: str, leaf: int) -> list[str]:
    """The leaves of the tree of halves."""
    if len(text) <= leaf:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], leaf) + halves(text[middle:], leaf)


def encoded(text: str, bpe: ByteLevel, leaf: int = LEAF) -> np.ndarray:
    return tree([bpe.encode(t) for t in halves(text, leaf)], bpe)


def _list(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


#: Rows of output at a time: ids of a few MB of text.
ROWS = 1000


def _edge(n: Column, i: Column, count: Column) -> Column:
    """Where part ``i`` of ``count`` begins in ``n`` characters; their product can pass 32 bits."""
    return F.floor(n.cast("long") * i / count).cast("int")


def encode(docs: DataFrame, path: str, leaf: int = LEAF, spread: int = SPREAD) -> DataFrame:
    """``(doc_id, ids)`` of rows ``(doc_id, text)`` with the vocabulary file ``path``."""
    source = docs.sparkSession.sparkContext.broadcast(vocab.read(path))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    n = F.length("text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocab.loaded(ByteLevel, source.value)
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                ids = _list([encoded(t, bpe, leaf) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names if c != "text"), ids], names=[*(c for c in part.schema.names if c != "text"), "ids"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocab.loaded(ByteLevel, source.value)
        for batch in batches:
            for s in range(batch.num_rows):
                parts: dict[int, np.ndarray] = {}
                leaves = batch.column("leaves").slice(s, 1).flatten()
                numbers, lists = leaves.field("leaf").to_pylist(), leaves.field("ids")
                for at, number in enumerate(numbers):
                    parts.setdefault(number, lists[at].values.to_numpy())
                copies = len(numbers) // len(parts)  # rows repeated with the same id and text
                ids = tree([parts[k] for k in sorted(parts)], bpe)
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("doc_id")[s].as_py()] * copies, batch.schema.field("doc_id").type), _list([ids] * copies)], names=["doc_id", "ids"])

    short = rows.where(n <= spread).mapInArrow(run, f"doc_id {id_type}, ids array<int>")
    count = F.pow(F.lit(2), F.ceil(F.log2(n / F.lit(spread)))).cast("int")  # parts of at most spread characters
    edge = lambda i: _edge(n, i, F.col("count"))
    cut = F.transform(F.sequence(F.lit(0), F.col("count") - 1), lambda i: F.struct(i.alias("leaf"), F.substring(F.col("text"), edge(i) + 1, edge(i + 1) - edge(i)).alias("text")))
    leaves = (rows.where(n > spread).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rk"), count.alias("count"))
              .select("doc_id", "rk", F.explode(cut).alias("x")).select("doc_id", "rk", "x.leaf", "x.text").repartition("rk", "leaf"))
    coded = leaves.mapInArrow(run, f"doc_id {id_type}, rk long, leaf int, ids array<int>")
    long = (coded.groupBy("doc_id", "rk").agg(F.collect_list(F.struct("leaf", "ids")).alias("leaves")).drop("rk")
            .mapInArrow(join, f"doc_id {id_type}, ids array<int>"))
    return short.unionByName(long)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """All columns of ``rows`` and the ``decoded`` text of ``ids``; bytes that form no character become U+FFFD."""
    source = rows.sparkSession.sparkContext.broadcast(vocab.read(path))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocab.loaded(ByteLevel, source.value)
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                ids = part.column("ids")
                flat, sizes = ids.flatten().to_numpy(zero_copy_only=False).tolist(), ids.value_lengths().fill_null(0).to_pylist()
                texts, at = [], 0
                for size in sizes:
                    texts.append(bpe.decode(flat[at:at + size]).decode("utf-8", "replace"))
                    at += size
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])
    return rows.mapInArrow(run, schema)
