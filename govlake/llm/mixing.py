"""Mixing sources to target weights by a splitting tree of block quotas, in DataFrame expressions only.

Every source has a target, in words, of at most twice its size. Its documents are cut into blocks of
BLOCK words; the blocks, in the order of a hash, once and then a second time, are taken until the
target is reached, the last one in part. How many of each source's blocks every output shard gets is
decided by a tree: the root holds the quotas of all sources, and each node deals half of its blocks
to its left child, as many of each source as a draw without replacement gives (a multivariate
hypergeometric draw, one source after the other), until the leaves are shards. Quotas are whole
numbers that add up at every node. A shard then owns an interval of the permuted blocks of each
source, so shards are disjoint and together hold the mix; inside a shard, blocks are shuffled by hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import last_before
from .shared import cut, partitions, text_of

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
BLOCK = 256
#: Blocks of a shard, about.
SHARD = 4096
#: Quotas that one node of the tree holds. More sources than this share bundles; inside a bundle
#: the permuted blocks of its sources are dealt together, which is the same draw.
BUNDLES = 256
#: Sources that may be broadcast; beyond, the join shuffles.
BROADCAST_SOURCES = 100_000
#: Levels of the tree that one task grows before its nodes are dealt out.
GROWN = 8
#: Factors of the permutation k -> a k + c modulo the number of blocks; one of them has no divisor in
#: common with it unless it is a multiple of both.
_FACTORS = (1_000_003, 999_983)


def words(text: Column) -> Column:
    """How many runs of characters other than ASCII white space a text has."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")).cast("long")


def running(rows: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """Each row with `before_<value>`: the sum of every value over the rows ahead of it in the order.

    Rows are dealt by ranges of the whole order; one row of sums per range is broadcast. `order` has
    to be total.
    """
    spread = cut(rows.repartitionByRange(partitions(rows.sparkSession), *order)
                 .withColumn("_part", F.spark_partition_id()))
    sums = spread.groupBy("_part").agg(*(F.sum(v).alias(f"_{v}") for v in values))
    over = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("_part", *(F.coalesce(F.sum(f"_{v}").over(over), F.lit(0)).alias(f"_{v}") for v in values))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (spread.join(F.broadcast(ahead), "_part")
            .select(*rows.columns, *((F.col(f"_{v}") + F.coalesce(F.sum(v).over(within), F.lit(0))).alias(f"before_{v}")
                                     for v in values)))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """`source`, `size` and further columns -> with number (from 0, by code point, null last) and target.

    All targets together are `share` of all sizes, in proportion to the weights, which repeat; where that
    is more than MOST times a source's size, the target stops there and the rest goes to the others
    by weight. Sources without words have target zero.
    """
    keyed = sizes.withColumn("missing", F.col("source").isNull()).withColumn("one", F.lit(1).cast("long"))
    numbered = running(keyed, ["missing", "source"], ["one"])
    kinds = F.array(*(F.lit(float(w)) for w in weights))
    made = (numbered.withColumn("number", F.col("before_one"))
            .withColumn("weight", F.get(kinds, (F.col("number") % len(weights)).cast("int")))
            .withColumn("most", F.col("size") * MOST).withColumn("level", F.col("most") / F.col("weight")))
    made = cut(made.drop("missing", "one", "before_one"))
    total, weight = made.agg(F.coalesce(F.sum("size"), F.lit(0)) * share, F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    # by the level at which a source is full; it is full if what is left reaches that level
    filled = running(made, ["level", "number"], ["most", "weight"])
    full = F.lit(total) - F.col("before_most") >= F.col("level") * (F.lit(weight) - F.col("before_weight"))
    filled = filled.withColumn("full", full)
    spent, open_weight = filled.agg(F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))), F.lit(0)),
                                    F.sum(F.when(~F.col("full"), F.col("weight")))).first()
    each = (total - spent) / open_weight if open_weight else 0.0
    return filled.withColumn("target", F.when(F.col("full"), F.col("most").cast("double"))
                             .otherwise(F.least(F.lit(float(each)) * F.col("weight"), F.col("most").cast("double")))
                             ).drop("before_most", "before_weight", "weight", "most", "level", "full")


# --- the tree -----------------------------------------------------------------------------------

def drawn(own: Column, rest: Column, draws: Column, chance: Column) -> Column:
    """A hypergeometric number: of `draws` taken out of `rest` things, how many are of `own` kind.

    By inversion with the number `chance` in 0..1, over all outcomes within twelve deviations and
    twelve of the likeliest one; what lies beyond has a probability under 1e-30.
    """
    n, k, m = (c.cast("double") for c in (rest, own, draws))
    spread = F.sqrt(F.greatest(m * k / n * ((n - k) / n) * ((n - m) / F.greatest(n - 1, F.lit(1.0))), F.lit(0.0)))
    reach, mode = F.ceil(spread * 12) + 12, F.floor((m + 1) * (k + 1) / (n + 2))
    low = F.greatest(F.lit(0).cast("long"), draws - (rest - own), mode - reach)
    high = F.least(draws, own, mode + reach)
    # of x the next outcome's weight in proportion to its own
    ratio = lambda x: ((k - x) * (m - x)) / ((x + 1) * (n - k - m + x + 1))
    one, none = F.lit(1.0), F.lit(0.0)
    whole = F.aggregate(F.sequence(low, high), F.struct(one.alias("w"), none.alias("sum")), lambda s, x: F.struct(
        (s["w"] * ratio(x)).alias("w"), (s["sum"] + s["w"]).alias("sum")), lambda s: s["sum"])
    found = F.aggregate(
        F.sequence(low, high), F.struct(one.alias("w"), (whole * chance).alias("left"), high.alias("at")),
        lambda s, x: F.struct((s["w"] * ratio(x)).alias("w"), (s["left"] - s["w"]).alias("left"),
                              F.when((s["left"] > 0) & (s["left"] <= s["w"]), x).otherwise(s["at"]).alias("at")),
        lambda s: s["at"])
    return F.when((rest == 0) | (draws == 0) | (own == 0), F.lit(0).cast("long")).when(own == rest, draws).otherwise(found)


def chance(*of: Column) -> Column:
    """A number in 0..1, never 0, fixed by what it is of."""
    return ((F.xxhash64(F.lit(2718), *of).bitwiseAND(F.lit(2**53 - 1))).cast("double") + 1) / float(2**53)


def _split(quotas: Column, node: Column) -> Column:
    """Each quota of a node with `left`, the blocks its left child gets."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda s, q: s + q["blocks"])
    kind = "array<struct<bundle:int,start:long,blocks:long,left:long>>"
    start = F.struct(total.alias("rest"), F.ceil(total / 2).cast("long").alias("draws"),
                     F.array().cast(kind).alias("done"))

    def step(s: Column, q: Column) -> Column:
        left = drawn(q["blocks"], s["rest"], s["draws"], chance(node, q["bundle"]))
        # the draw is made once and then used
        return F.element_at(F.transform(F.array(left), lambda x: F.struct(
            (s["rest"] - q["blocks"]).alias("rest"), (s["draws"] - x).alias("draws"),
            F.concat(s["done"], F.array(F.struct(q["bundle"].alias("bundle"), q["start"].alias("start"),
                                                 q["blocks"].alias("blocks"), x.alias("left")))).cast(kind).alias("done"))), 1)

    return F.aggregate(quotas, start, step, lambda s: s["done"])


def shards(quotas: DataFrame, levels: int) -> DataFrame:
    """(bundle, blocks) -> bundle, start, blocks, shard: which interval of each bundle's permuted
    blocks each of 2^levels shards owns. At most BUNDLES quotas meet in one row."""
    kind = "array<struct<bundle:int,start:long,blocks:long>>"
    nodes = quotas.where("blocks > 0").agg(F.array_sort(F.collect_list(F.struct(
        F.col("bundle").cast("int").alias("bundle"), F.lit(0).cast("long").alias("start"),
        F.col("blocks").cast("long").alias("blocks")))).cast(kind).alias("quotas"))
    nodes = nodes.select(F.lit(1).cast("long").alias("node"), "quotas")
    for level in range(levels):
        made = nodes.select("node", _split(F.col("quotas"), F.col("node")).alias("split"))
        left = F.transform("split", lambda q: F.struct(q["bundle"].alias("bundle"), q["start"].alias("start"),
                                                       q["left"].alias("blocks")))
        right = F.transform("split", lambda q: F.struct(q["bundle"].alias("bundle"), (q["start"] + q["left"]).alias("start"),
                                                        (q["blocks"] - q["left"]).alias("blocks")))
        some = lambda a: F.filter(a, lambda q: q["blocks"] > 0)
        nodes = made.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), some(left).alias("quotas")),
            F.struct((F.col("node") * 2 + 1).alias("node"), some(right).alias("quotas")))).alias("n")).select("n.*")
        if (level + 1) % GROWN == 0 and level + 1 < levels:
            nodes = nodes.repartition(partitions(quotas.sparkSession), "node")
    return nodes.select((F.col("node") - 2**levels).alias("shard"), F.explode("quotas").alias("q")).select("shard", "q.*")


# --- the mix ------------------------------------------------------------------------------------

def sized(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: row (a number of its own), doc_id, source, key (hash of the text), size."""
    made = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64(text_of()).alias("key"),
                       words(text_of()).alias("size"))
    return cut(made.withColumn("row", F.monotonically_increasing_id()))


def mix(rows: DataFrame, block: int = BLOCK, shard: int = SHARD, bundles: int = BUNDLES,
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """`sized` rows -> (sources, pieces).

    sources: source, size, target and more. pieces: one row per block of the mix: row, copy (0 or 1),
    block, words (taken, from the block's start), shard, place (order inside the shard). The words
    taken of each source are its target, rounded. Equal rows of `docs` are dealt apart, and a re-run
    takes as much of each; a hot source spreads over tasks by the hash of its blocks.
    """
    spark = rows.sparkSession
    sources = rows.groupBy("source").agg(
        F.sum("size").alias("size"), F.sum(F.ceil(F.col("size") / block)).cast("long").alias("blocks"))
    sources = targets(sources, weights, share).withColumn("wanted", F.round("target").cast("long"))
    # a second copy of every block stands ready where the first does not do
    sources = sources.withColumn("copies", F.when(F.col("wanted") > F.col("size"), 2).otherwise(1))
    # a source without a target has no block in the order
    ready = sources.select("number", F.when(F.col("wanted") > 0, F.col("size") * F.col("copies")).otherwise(0).alias("words"),
                           F.when(F.col("wanted") > 0, F.col("blocks") * F.col("copies")).otherwise(0).alias("count"))
    offsets = (running(ready, ["number"], ["words", "count"])
               .select("number", F.col("before_words").alias("first_word"), F.col("before_count").alias("first_block")))
    sources = cut(sources.join(offsets, "number"))
    few = sources.count() <= BROADCAST_SOURCES
    side = sources.where("wanted > 0").select(F.col("source").alias("of"), "number", "wanted", "copies", "first_word",
                                              "first_block")
    side = F.broadcast(side) if few else side
    blocks = (rows.where("size > 0").join(side, F.col("source").eqNullSafe(F.col("of")))
              .select("row", "number", "wanted", "copies", "first_word", "first_block", "size",
                      F.xxhash64("doc_id", "key").alias("key"),
                      F.explode(F.sequence(F.lit(0), F.ceil(F.col("size") / block).cast("int") - 1)).alias("block"))
              .select("*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
              .select("row", "number", "copy", "block", "wanted", "first_word", "first_block",
                      F.xxhash64(F.lit(1414), "key", "block", "copy").alias("mixed"),
                      F.least(F.lit(block), F.col("size") - F.col("block") * block).cast("long").alias("words"))
              .withColumn("one", F.lit(1).cast("long")))
    order = ["number", "copy", "mixed", "row", "block"]
    placed = running(blocks, order, ["words", "one"])
    before = F.col("before_words") - F.col("first_word")
    taken = (placed.withColumn("words", F.least(F.col("words"), F.col("wanted") - before))
             .withColumn("rank", F.col("before_one") - F.col("first_block")).where("words > 0")
             .select("row", "number", "copy", "block", "words", "rank", "mixed"))
    taken = cut(taken)

    # quotas of bundles: one source each, unless there are too many
    bundled = F.pmod(F.col("number"), F.lit(bundles)).cast("int") if sources.count() > bundles else F.col("number").cast("int")
    quotas = taken.groupBy("number").agg(F.count(F.lit(1)).alias("quota")).withColumn("bundle", bundled)
    ahead = Window.partitionBy("bundle").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    quotas = cut(quotas.withColumn("at", F.coalesce(F.sum("quota").over(ahead), F.lit(0))))
    sums = cut(quotas.groupBy("bundle").agg(F.sum("quota").alias("blocks")))
    total = sums.agg(F.sum("blocks")).first()[0] or 0
    levels = max(0, math.ceil(math.log2(max(1, total) / shard)))
    owned = shards(sums, levels)

    dealt = quotas.join(F.broadcast(sums), "bundle").select("number", "bundle", "at", "blocks")
    dealt = F.broadcast(dealt) if few else dealt
    a, b = _FACTORS
    factor = F.when(F.col("blocks") % a != 0, a).when(F.col("blocks") % b != 0, b).otherwise(1)
    spot = F.pmod((F.col("at") + F.col("rank")) * factor + 12_345, F.col("blocks"))
    asked = taken.join(dealt, "number").select(
        "bundle", spot.alias("spot"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("owner"),
        "row", "number", "copy", "block", "words", "mixed")
    starts = owned.select("bundle", F.col("start").alias("spot"), F.lit(0).alias("kind"), F.col("shard").alias("owner"),
                          *(F.lit(None).cast(t).alias(c) for c, t in (("row", "long"), ("number", "long"), ("copy", "int"),
                                                                      ("block", "int"), ("words", "long"), ("mixed", "long"))))
    pieces = (last_before(starts.unionByName(asked), ["bundle", "spot", "kind"], F.col("owner"), "shard")
              .where("kind = 1").select("row", "number", "copy", "block", "words", "shard",
                                        F.xxhash64(F.lit(1732), "mixed", "copy").alias("place")))
    return sources, pieces


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target, taken, and pieces (blocks taken) and
    first_shard (the least shard that has one of them).

    A null text has size 0, and rows without words are never taken; null sources are one source, a
    null doc_id is as good as another. Repeated rows are taken each; an empty table gives no rows.
    """
    rows = sized(docs)
    sources, pieces = mix(rows, **options)
    side = sources.select(F.col("source").alias("of"), F.col("size").alias("source_size"), "target")
    side = F.broadcast(side) if sources.count() <= BROADCAST_SOURCES else side
    known = rows.join(side, F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("words"),
        F.lit(None).cast("long").alias("shard"))
    used = pieces.select("row", *(F.lit(None).cast(t).alias(c) for c, t in (
        ("doc_id", "long"), ("size", "long"), ("source_size", "long"), ("target", "double"))), "words", "shard")
    return (known.unionByName(used).groupBy("row")
            .agg(F.max("doc_id").alias("doc_id"), F.max("size").alias("size"), F.max("source_size").alias("source_size"),
                 F.max("target").alias("target"), F.sum("words").alias("taken"),
                 F.count("shard").alias("pieces"), F.min("shard").alias("first_shard")).drop("row"))


def in_shards(docs: DataFrame, pieces: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix itself: shard, place, doc_id, copy, block and the words taken, space-joined, in the order
    of place inside each shard; one partition may hold several shards, none is split unless it is
    larger than its range."""
    texts = docs.select("doc_id", text_of().alias("text")).withColumn("key", F.xxhash64("text"))
    named = pieces.join(rows.select("row", "doc_id", "key"), "row")
    text = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]++"), F.lit(0))
    return (named.join(texts.dropDuplicates(["doc_id", "key"]), [named["doc_id"].eqNullSafe(texts["doc_id"]),
                                                                 named["key"] == texts["key"]])
            .select("shard", "place", named["doc_id"], "copy", "block",
                    F.array_join(F.slice(text, F.col("block") * block + 1, F.col("words").cast("int")), " ").alias("text"))
            .repartitionByRange(partitions(docs.sparkSession), "shard", "place").sortWithinPartitions("shard", "place"))
