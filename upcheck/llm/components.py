"""Connected components of a table of links, by stars, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcheck.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """``(node, label)`` with the least node each linked node can reach; ``links (a, b)``.

    Every round ties each node's larger neighbours to the least node around it
    (large star), then its smaller neighbours (small star).  Rounds end when
    nothing changes; their number grows with the logarithm of the nodes.
    """
    stars = scratch.save(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), f"{name}0")
    state, turn = None, 0
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.save(large, f"{name}{turn + 1}")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = scratch.save(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), f"{name}{turn + 2}")
        found = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        scratch.drop(*([f"{name}{turn}", f"{name}{turn + 1}"]))
        stars, turn = after, turn + 2
        if state == found:
            break
        state = found
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
