"""Connected components by local contraction, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.session import kept

#: Rounds whose roots are joined in one plan.
JOINS = 3
#: Per-round masks that shuffle the order of ids; any distinct numbers do.
_MIX = 0x9E3779B97F4A7C15


def _mask(turn: int) -> int:
    x = (turn * _MIX) & (2**64 - 1)
    return x - 2**64 if x >= 2**63 else x


def components(links: DataFrame) -> DataFrame:
    """(a, b) long links -> (node, root): one root per component, for every node of a link.

    Each round every node moves to its first neighbour in an order that changes by round, links
    follow their ends, and links inside one node fall away. About half of the nodes go per round
    whatever the shape, so rounds grow with the logarithm of the nodes. Minima are combined
    map-side; a node with very many links can be split by the adaptive join, as one side of each
    join has one row per node. Roots are handed down from the last round to the first, so each round
    is joined in its own size, and are written on the way, so no plan on the driver grows with the
    rounds. Rounds are kept as Parquet, whose size Spark knows: a checkpoint takes over the size that
    was estimated for its plan, which for joins is a product, and over rounds that number alone, three
    times as long in each, fills the driver. Nothing is collected but the number of links left.
    """
    pairs = (links.where("a is not null and b is not null and a <> b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    pairs = kept(pairs)
    steps: list[DataFrame] = []
    while pairs.count():
        mask = F.lit(_mask(len(steps)))
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = kept(both.groupBy(F.col("a").alias("node"))
                    .agg(F.min(F.col("b").bitwiseXOR(mask)).alias("near"))
                    .select("node", F.least(F.col("near"), F.col("node").bitwiseXOR(mask))
                            .bitwiseXOR(mask).alias("parent")))
        left = step.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = step.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        pairs = kept(pairs.join(left, "a").join(right, "b").where("pa <> pb")
                     .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                     .distinct())
        steps.append(step)
    if not steps:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = steps.pop().withColumnRenamed("parent", "root")
    while steps:
        above = roots.select(F.col("node").alias("parent"), "root")
        roots = (steps.pop().join(above, "parent", "left")
                 .select("node", F.coalesce("root", "parent").alias("root")))
        if len(steps) % JOINS == 0:
            roots = kept(roots)
    return roots
