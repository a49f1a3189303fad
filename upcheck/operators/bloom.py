"""A Bloom filter in DataFrame functions: rows that surely match nothing go before any shuffle.

For a join with a much larger table.  The filter is built where the rows of the
smaller side are: bits of a word are or-ed in every task, then by word, then
words are put into blocks; nothing of it passes through the driver.  Its number
of bits follows the counted keys and has a limit (``MOST_BITS``), so the table of
blocks that probing joins with is small whatever the keys are; beyond the limit
there is no filter, and the plain join remains.

A row that passes may still match nothing: the join after the filter is exact.
A key with a null matches nothing and never passes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upcheck.sources.storage import materialize

#: Bits for each key: with two hashes about one row in 50 passes by chance.
BITS_A_KEY = 14
#: 32 MB of bits at most, which is what a probing task holds.
MOST_BITS = 1 << 28
WORD, WORDS = 64, 512  # bits of a word, words of a block
HASHES = (1, 2)


@dataclass(frozen=True)
class Filter:
    """``blocks (block, words)`` of ``bits`` bits over ``keys`` keys."""

    blocks: DataFrame
    bits: int
    keys: int


def _place(columns: Sequence[str], seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(bits))


def _full(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def bloom_filter(rows: DataFrame, columns: Sequence[str], most_bits: int = MOST_BITS) -> Filter | None:
    """The filter over the distinct keys of ``rows``, written; None if it would take more than ``most_bits``."""
    columns = list(columns)
    keys = rows.select(*columns).where(_full(columns)).distinct()
    n = keys.count()
    block = WORD * WORDS
    bits = block * max(1, -(-n * BITS_A_KEY // block))
    if bits > most_bits:
        return None
    places = keys.select(F.explode(F.array(*[_place(columns, seed, bits) for seed in HASHES])).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("p") % WORD).cast("int"))
    words = places.groupBy(F.floor(F.col("p") / WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))
    entry = F.struct((F.col("word") % WORDS).alias("at"), F.col("bits").alias("bits"))
    known = words.groupBy(F.floor(F.col("word") / WORDS).alias("block")).agg(F.map_from_entries(F.collect_list(entry)).alias("known"))
    filled = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(WORDS - 1).cast("bigint")), lambda i: F.coalesce(F.col("known")[i], F.lit(0).cast("bigint")))
    return Filter(materialize(known.select("block", filled.alias("words")), "bloom"), bits, n)


def possible(rows: DataFrame, filter_: Filter | None, columns: Sequence[str]) -> DataFrame:
    """Rows whose key may be among the filter's keys; all rows if there is no filter.

    Types must be those of the filter's keys.  Blocks are at most ``MOST_BITS``
    bits in all, which makes the broadcast safe.
    """
    if filter_ is None:
        return rows
    out = rows.where(_full(columns))
    for seed in HASHES:
        place = _place(columns, seed, filter_.bits)
        blocks = F.broadcast(filter_.blocks.select(F.col("block").alias("__b_block"), F.col("words").alias("__b_words")))
        out = (out.withColumn("__b_place", place).withColumn("__b_block", F.floor(F.col("__b_place") / (WORD * WORDS)))
               .join(blocks, "__b_block"))
        word = F.element_at("__b_words", (F.floor(F.col("__b_place") / WORD) % WORDS + 1).cast("int"))
        bit = F.call_function("shiftrightunsigned", word, (F.col("__b_place") % WORD).cast("int")).bitwiseAND(F.lit(1))
        out = out.where(bit == 1).select(*rows.columns)
    return out


def filtered_mismatches(upload: DataFrame, authority: DataFrame, keys: Sequence[str], most_bits: int = MOST_BITS) -> DataFrame:
    """``reconcile.exact_mismatches`` against a large authority: its rows that equal no upload row are dropped where they are read."""
    keys = list(keys)
    left = upload.select(*keys)
    right = possible(authority.select(*keys), bloom_filter(left, keys, most_bits), keys)
    return left.join(right, keys, "left_anti")
