"""Fixpoints over relations of edges: what is reached, and the highest value that flows along.

Both run semi-naive: a round joins only what the round before found new, drops what is known, and
writes the rest to the shared folder, so no lineage grows and cycles end by themselves. The driver
learns one number per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.session import cut, kept

#: Rows of a round that may be broadcast; a larger one is joined by shuffling, where adaptive
#: execution splits a hub with many edges.
BROADCAST_ROWS = 200_000
#: Rows of a round of which one task may hold all in a hash table, if they share a node. Up to here
#: edges are streamed past the round instead of being sorted for it.
HASHED_ROWS = 5_000_000


def _small(df: DataFrame, once: bool = False) -> tuple[DataFrame, int]:
    """A checkpointed round, behind a hint for its size, and its number of rows. `once` says that no
    node comes twice, so that no task can get many of them."""
    n = df.count()
    if n <= BROADCAST_ROWS:
        return F.broadcast(df), n
    return (df.hint("shuffle_hash") if once or n <= HASHED_ROWS else df), n


def _met(known: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """What is known of the keys of a round. A small round is sent to what is known, which then is
    not shuffled; for a large one all that is known comes back."""
    near, n = _small(new.select(*keys), once=True)
    return known.join(near, list(keys), "left_semi") if n <= BROADCAST_ROWS else known


def walkable(edges: DataFrame) -> DataFrame:
    """Distinct edges (src, dst, same) without null ends and loops, written once."""
    return kept(edges.where("src is not null and dst is not null and src <> dst")
                .groupBy("src", "dst").agg(F.bool_or("same").alias("same")))


def reach(edges: DataFrame, start: DataFrame) -> DataFrame:
    """`edges` (src, dst, same) and `start` (origin, node) -> origin, node, hops, kept for each node
    reached from an origin that does not start from it.

    `hops` is the least number of edges; `kept` tells whether a path of that many has `same` on every
    edge. Repeated edges are one; rows with a null end lead nowhere.
    """
    edges = walkable(edges)
    found = cut(start.where("node is not null").select("origin", "node", F.lit(0).alias("hops"), F.lit(True).alias("kept")).distinct())
    known, frontier, hops = found, found, 0
    while True:
        hops += 1
        near, n = _small(frontier)
        if not n:
            return known.where("hops > 0")
        new = cut(edges.join(near, edges["src"] == near["node"])
                  .groupBy("origin", F.col("dst").alias("node")).agg(F.bool_or(F.col("kept") & F.col("same")).alias("kept")))
        new = new.join(_met(known, new, "origin", "node").select("origin", "node"), ["origin", "node"], "left_anti")
        frontier = cut(new.select("origin", "node", F.lit(hops).alias("hops"), "kept"))
        known = known.unionByName(frontier)


def plain(edges: DataFrame) -> DataFrame:
    """Distinct edges (src, dst) for any number of calls of `highest_along`, written once."""
    return kept(edges.where("src is not null and dst is not null and src <> dst").select("src", "dst").distinct())


def highest(edges: DataFrame, values: DataFrame) -> DataFrame:
    """`edges` (src, dst) and `values` (node, value int) -> node, value: the highest value of each node
    and of all nodes it can be reached from. Nodes without any are left out."""
    return highest_along(plain(edges), values)


def highest_along(edges: DataFrame, values: DataFrame) -> DataFrame:
    """`highest` over edges that `plain` has written."""
    best = cut(values.where("value is not null").groupBy("node").agg(F.max("value").alias("value")))
    known, frontier = best, best
    while True:
        near, n = _small(frontier, once=True)
        if not n:
            return known.groupBy("node").agg(F.max("value").alias("value"))
        offered = cut(edges.join(near, edges["src"] == near["node"]).groupBy(F.col("dst").alias("node"))
                      .agg(F.max("value").alias("offered")))
        held = _met(known, offered, "node").groupBy("node").agg(F.max("value").alias("value"))
        frontier = cut(offered.join(held, "node", "left").where("value is null or offered > value")
                       .select("node", F.col("offered").alias("value")))
        known = known.unionByName(frontier)
