"""Merkle manifest of a dataset: a hash tree over its rows, and for every row its proof.

Rows become leaves; the leaves of a group, in the order of their ids, are hashed in runs of
``arity`` level by level to the group's subroot, and the subroots likewise to the root.

A nested-struct rollup builds the tree: the digits of a leaf's rank are columns, and one
aggregate after the other groups the lowest digit away and nests the children's structs in an
array of their parent. This goes on inside blocks of ``arity ** levels`` nodes, which are dealt
out once, so all aggregates of a block run where its rows are; the blocks' tops are the nodes of
the next, shorter round. On the way back every block row takes the path above it (one aggregate
of two rows a block), a nested ``transform`` walks down to the leaves and adds every level's
siblings, and ``explode`` emits a row a leaf, without joining leaves to nodes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import materialize
from hearth.llm.order import running

_PATH = "array<struct<left:string,right:string>>"


def leaf_of(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields: ``-`` for null, else UTF-8 length, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _joined(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda k: k["h"]), "")


def _blocks(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """``stratum, block, n, node``: the nodes of every block under one nested struct."""
    digits = [f"d{i}" for i in range(levels)]
    size = arity**levels
    tree = nodes.select("stratum", F.expr(f"position div {size}").alias("block"), "n",
                        *[F.expr(f"cast(position div {arity**i} % {arity} as int)").alias(d) for i, d in enumerate(digits)],
                        F.struct("h", "body").alias("node")).repartition("stratum", "block")
    for i, digit in enumerate(digits):
        kids = F.transform(F.sort_array(F.collect_list(F.struct(digit, "node"))), lambda x: x["node"])
        tree = tree.groupBy("stratum", "block", "n", *digits[i + 1:]).agg(kids.alias("kids"))
        # a stratum with one node left is done
        h = F.when(F.col("n") > arity**i, F.sha2(_joined(F.col("kids")), 256)).otherwise(F.col("kids")[0]["h"])
        tree = tree.select("stratum", "block", "n", *digits[i + 1:], F.struct(h.alias("h"), "kids").alias("node"))
    return tree


def _leaves(node: Column, n: Column, path: Column, arity: int, level: int) -> Column:
    """``(h, body, path)`` of all nodes at the bottom of a block."""
    if not level:
        return F.array(F.struct(node["h"].alias("h"), node["body"].alias("body"), path.alias("path")))
    kids = node["kids"]

    def below(kid: Column, i: Column) -> Column:
        beside = F.struct(_joined(F.slice(kids, 1, i)).alias("left"), _joined(F.slice(kids, i + 2, arity)).alias("right"))
        own = F.when(n > arity ** (level - 1), F.array(beside)).otherwise(F.array().cast(_PATH))
        return _leaves(kid, n, F.concat(own, path), arity, level - 1)

    return F.flatten(F.transform(kids, below))


def _climb(nodes: DataFrame, most: int, arity: int, levels: int, above: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stratum, h, body, path, subroot, root`` of every node (stratum, position, n, h, body).

    ``most`` is the largest n; ``above`` gets the strata's tops (stratum, h) and returns what is
    above them (stratum, path, subroot, root).
    """
    size = arity**levels
    blocks = materialize(_blocks(nodes, arity, levels), "blocks")
    if most <= size:
        up = above(blocks.select("stratum", "node.h")).withColumn("block", F.lit(0).cast("long"))
    else:
        tops = blocks.select("stratum", F.col("block").alias("position"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), "node.h",
                             F.col("block").alias("body"))
        up = _climb(tops, -(-most // size), arity, levels, above).withColumnRenamed("body", "block")
    both = blocks.unionByName(up.select("stratum", "block", "path", "subroot", "root"), allowMissingColumns=True)
    held = both.groupBy("stratum", "block").agg(*[F.first(c, True).alias(c) for c in ("n", "node", "path", "subroot", "root")])
    leaves = _leaves(F.col("node"), F.col("n"), F.col("path"), arity, levels)
    return held.select("stratum", F.explode(leaves).alias("x"), "subroot", "root").select("stratum", "x.*", "subroot", "root")


def manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id",
             group_col: str = "lang", arity: int = 2, levels: int = 8, claim: Column | None = None) -> DataFrame:
    """``id, leaf, claim, group, subroot, root, path`` of every row.

    ``path`` holds the siblings from the leaf up to the root: per level the digests to the left
    and right of the own node, each concatenated; ``fold`` recomputes the root from it. ``claim``
    is another leaf of the row that comes along, to be checked against the proof. Null groups are
    a group of their own, before the others (by UTF-8 bytes). Null ids come first; rows that agree
    in id are ordered by their leaves, repeated rows are leaves of their own. A group of one row
    has its leaf as subroot. Null and empty fields differ. An empty table has no rows. Other columns
    may have any names.
    """
    claim = F.lit(None).cast("string") if claim is None else claim
    group = F.col(group_col).cast("string")
    rows = docs.select(F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("stratum"), F.col(id_col).alias("id"),
                       leaf_of([F.col(f) for f in fields]).alias("leaf"), claim.alias("claim"), F.monotonically_increasing_id().alias("row"))
    ranked = running(materialize(rows, "leaves"), "stratum", ["id", "leaf", "row"], label="ranked")
    nodes = ranked.select("stratum", F.col("start").alias("position"), F.col("of").alias("n"), F.col("leaf").alias("h"), F.struct("id", "claim").alias("body"))
    most = ranked.agg(F.max("of")).first()[0] or 1

    def groups(tops: DataFrame) -> DataFrame:
        named = running(tops.withColumn("all", F.lit("")), "all", ["stratum"], label="groups")
        count = named.agg(F.max("of")).first()[0] or 1
        inner = named.select(F.col("all").alias("stratum"), F.col("start").alias("position"), F.col("of").alias("n"), "h", F.struct("stratum", "h").alias("body"))
        top = _climb(inner, count, arity, levels, lambda t: t.select("stratum", F.array().cast(_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("h").alias("root")))
        return top.select("body.stratum", "path", F.col("body.h").alias("subroot"), "root")

    found = _climb(nodes, most, arity, levels, groups)
    return found.select("body.id", F.col("h").alias("leaf"), "body.claim", F.when(F.col("stratum") != "-", F.expr("substring(stratum, 2)")).alias("group"),
                        "subroot", "root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a proof, level by level and left to right, concatenated."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")
