"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (longs ``a``, ``b``); root is its smallest node.

    Each round links the larger neighbours, then the smaller neighbours, of every node to the
    smallest one it knows, and writes the links to the shared folder, so a lost executor repeats
    at most one round. The joins sort and merge: no link table passes through the driver. Rounds grow with the logarithm of the longest path. Nothing is collected
    but the count and checksum that tell when the links stop changing.
    """
    links = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low.hint("merge"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low.hint("merge"), "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        links = materialize(small, "links")
        last, mark = mark, _mark(links)
        if mark == last:
            break
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.shiftright(F.xxhash64("b", "a"), 24))).first())
