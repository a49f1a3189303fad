"""Helpers shared by the operators: row keys, byte buffers, word spans, hashes, disk."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upcheck.session import scratch_path

#: Bytes of text that numpy works on at a time; one longer document is worked on alone.
SLICE_BYTES = 1 << 19

#: Words are maximal runs of anything but these six bytes.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SPACES = "[\\x20\\x09-\\x0D]+"

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


# ------------------------------------------------------------------ frames

def keyed(docs: DataFrame) -> DataFrame:
    """``(rk, doc_id, text)`` of a documents table; other columns are left out.

    ``rk`` hashes id and text, so every scan gives a row the same key.  Rows
    that repeat id and text share a key, and what holds for one holds for all.
    """
    return docs.select(F.xxhash64("doc_id", "text").alias("rk"), "doc_id", "text")


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column is called so (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Scratch:
    """Tables written to the shared folder, deleted as soon as they are read for the last time."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, "llm", name)
        df.write.option("compression", "zstd").parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark's cleaner find the shuffles of steps whose results are written."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


# ------------------------------------------------------------------ buffers

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, null as empty, and the offsets of its rows."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges ``(i, j)`` of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of every row (rows + 1 values)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < n]
    first[edges] = inside[edges]
    edges = edges[edges > 0] - 1
    last[edges] = inside[edges]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


# ------------------------------------------------------------------ hashes

def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n; kept by the worker up to four slices."""
    got = _POWERS.get(int(base))
    if got is None or len(got) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        got = np.full(size, base, dtype=np.uint64)
        got[0] = 1
        np.multiply.accumulate(got, out=got)
        if size <= 4 * SLICE_BYTES:
            _POWERS[int(base)] = got
    return got[:n]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``symbols[s:e]``; equal runs hash alike wherever they stand."""
    n = len(symbols)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(BASE_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``word_spans`` and a hash of each word."""
    starts, ends, first = word_spans(data, offsets)
    return starts, ends, first, span_hashes(data, starts, ends)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the runs ``start .. start + length``, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
