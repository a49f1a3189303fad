"""SimHash fingerprints and radius search, in DataFrame functions only.

Every word votes on 64 bits with its hash, weighted by its length squared (up to
eight characters: long words say more about a text than articles do) and by how
often it stands there.  A bit is set where more than half of the weight votes
for it.  ``within`` finds all fingerprints in a Hamming radius: 64 bits are cut
into three blocks, each the key of one table; of two fingerprints within the
radius one block differs by a third of it at most, so queries look up all such
variants of their blocks.

Defined results: a text without words (null, empty, blank) has the fingerprint
0; equal texts have equal fingerprints; rows with one id follow each other in
order of a text hash; null ids come after all others.  Votes of a text are exact
up to 2**32 of total weight, that is for about 600 MB of text in one row.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upcheck.llm.common import SPACES

RADIUS = 8  # of near copies; see README for what it finds
EDGES = (0, 21, 42, 64)
_LANES = 0x0000000100000001
_LEAST = -(1 << 63)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def votes(term: Column) -> list[Column]:
    """Aggregates of one text's terms: the total weight, and for bits i and i + 32 the weight that votes for them."""
    weight = F.coalesce(F.pow(F.least(F.length(term), F.lit(8)), 2).cast("long"), F.lit(0).cast("long"))
    hashed = F.xxhash64(term)
    lanes = [F.sum(F.shiftrightunsigned(hashed, i).bitwiseAND(F.lit(_LANES)) * weight).alias(f"v{i}") for i in range(32)]
    return [F.sum(weight).alias("total"), *lanes]


def fingerprint() -> Column:
    """64 bits as a long from the columns of ``votes``."""
    out = F.lit(0).cast("long")
    for i in range(32):
        low = F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"v{i}"), 32)
        out = out.bitwiseOR(F.when(low * 2 > F.col("total"), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
        out = out.bitwiseOR(F.when(high * 2 > F.col("total"), F.lit(_signed(1 << (i + 32)))).otherwise(F.lit(0)).cast("long"))
    return out


def words(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), SPACES)


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def hexed(x: Column) -> Column:
    return F.lpad(F.lower(F.hex(x)), 16, "0")


def followed(docs: DataFrame) -> DataFrame:
    """``(bucket, rn, ghost, doc_id, text, next)``: each document with the text after it in descending ids.

    Ids are cut into ranges at quantiles, one range to a task.  The largest
    document of a range is also sent to the range above as a ghost, where the
    last document needs it; that of the topmost goes to the lowest range's end.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST))
    row = (docs.select(id_.alias("k"))
           .agg(F.percentile_approx("k", [(i + 1) / parts for i in range(parts)]).alias("q"), F.max("k").alias("top")).first())
    bounds = sorted({*(row["q"] or []), *([] if row["top"] is None else [row["top"]])})
    cuts = F.array(*[F.lit(x).cast("long") for x in bounds]) if bounds else F.array().cast("array<bigint>")
    own = F.size(F.filter(cuts, lambda x: x < F.col("k")))
    above = F.when(F.col("k") == (bounds[-1] if bounds else 0), F.struct(F.lit(0).alias("bucket"), F.lit(2).alias("ghost")))
    above = above.when(F.array_contains(cuts, F.col("k")), F.struct((F.col("own") + 1).alias("bucket"), F.lit(1).alias("ghost")))
    placed = docs.select("doc_id", "text", id_.alias("k")).withColumn("own", own)
    copies = F.filter(F.array(F.struct(F.col("own").alias("bucket"), F.lit(0).alias("ghost")), above), lambda x: x.isNotNull())
    placed = placed.select("doc_id", "text", "k", F.explode(copies).alias("at")).select("doc_id", "text", "k", "at.bucket", "at.ghost")
    order = Window.partitionBy("bucket").orderBy((F.col("ghost") == 2), F.col("k").desc(), F.xxhash64("text"), "text")
    return placed.select("bucket", F.row_number().over(order).alias("rn"), "ghost", "doc_id", "text", F.lead("text").over(order).alias("next"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp)``, all texts whole, with one shuffle.

    The edited text has its last half replaced by as much of the next document.
    """
    text, after = F.coalesce("text", F.lit("")), F.coalesce("next", F.lit(""))
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(text, F.lit(1), n - half), F.substring(after, F.lit(1), half))
    rows = followed(docs).select("bucket", "rn", "ghost", "doc_id", n.cast("long").alias("n_chars"), text.alias("text"), F.when(F.col("ghost") == 0, edited).alias("edited"))
    both = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.when(F.col("ghost") == 0, F.struct(F.lit(1).alias("which"), F.col("edited").alias("t"))))
    split = (rows.select("bucket", "rn", "ghost", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("sha"), F.explode(F.filter(both, lambda x: x.isNotNull())).alias("x"))
             .select("bucket", "rn", "ghost", "doc_id", "n_chars", "sha", "x.which", F.explode_outer(words(F.col("x.t"))).alias("term")))
    keys = ["bucket", "rn", "ghost", "doc_id", "n_chars", "sha"]
    each = split.groupBy(*keys, "which").agg(*votes(F.col("term"))).select(*keys, "which", fingerprint().alias("fp"))
    pair = each.groupBy(*keys).agg(F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp"))
    order = Window.partitionBy("bucket").orderBy("rn")
    return (pair.withColumn("next_fp", F.lead("fp").over(order)).where("ghost = 0")
            .select("doc_id", "n_chars", F.col("sha").alias("edited_sha256"), "fp", "edited_fp", "next_fp"))


def _flips(low: int, high: int, most: int) -> Column:
    """Array of all longs with ``most`` bits at most, from bit ``low`` to below ``high``."""
    flips = [_signed(sum(1 << b for b in bits)) for k in range(most + 1) for bits in combinations(range(low, high), k)]
    return F.split(F.lit(",".join(map(str, flips))), ",").cast("array<bigint>")


def within(queries: DataFrame, index: DataFrame, radius: int = 3) -> DataFrame:
    """``(fp, near, docs)``: for each distinct ``fp`` of ``queries`` all of ``index (fp, docs)`` in the radius.

    A pair comes from one table only: that of the first block that differs little.
    Both sides are shuffled: a query has hundreds of variants, which Spark's estimate, made
    before they are built, leaves out, so that it would send all of them through the driver.
    """
    most, blocks = radius // 3, [(low, high, F.lit(_signed((1 << high) - (1 << low)))) for low, high in zip(EDGES, EDGES[1:])]
    part = lambda mask: F.col("fp").bitwiseAND(mask)
    varied = lambda t, low, high, mask: F.transform(_flips(low, high, most), lambda x: F.struct(F.lit(t).alias("t"), part(mask).bitwiseXOR(x).alias("key")))
    left = queries.select("fp").distinct().select("fp", F.explode(F.concat(*(varied(t, *block) for t, block in enumerate(blocks)))).alias("e")).select("fp", "e.t", "e.key")
    entry = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), part(mask).alias("key")) for t, (_, _, mask) in enumerate(blocks)]))
    right = index.select("fp", "docs", entry.alias("e")).select(F.col("fp").alias("near"), "docs", "e.t", "e.key")
    differ = F.col("fp").bitwiseXOR(F.col("near"))
    first = F.lit(len(blocks))
    for t, (_, _, mask) in reversed(list(enumerate(blocks))):
        first = F.when(F.bit_count(differ.bitwiseAND(mask)) <= most, t).otherwise(first)
    return left.hint("merge").join(right, ["t", "key"]).where((F.bit_count(differ) <= radius) & (first == F.col("t"))).select("fp", "near", "docs")
