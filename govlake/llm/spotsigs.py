"""SpotSigs document fingerprints, in DataFrame expressions only.

Anchors are the short words that occur in most documents of each language. A signature is an anchor with the chain
of content words (words that are no anchors) that follows it, and a fingerprint is the set of
signatures of the whole text, as 32-bit hashes in order. Fingerprints are compared by Jaccard
likeness. The pairs of `edited_pairs` are fixed, so it neither partitions nor prunes; `length_part`
is given out, and `likeness` prunes by length where a bound is asked for.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import last_before
from .shared import cut, text_of

#: Content words in a chain.
CHAIN = 3
#: How many anchors are taken, and the most characters one has.
ANCHORS, ANCHOR_CHARS = 64, 5
#: Languages that have anchors of their own, the commonest; all others together are one more.
LANGUAGES = 256


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def anchors(docs: DataFrame, count: int = ANCHORS) -> list[str]:
    """For each language (`lang`, if there is one; unknown ones are one more) the `count` words of at
    most ANCHOR_CHARS characters that most of its documents have, ties in alphabetical order; all of
    them together, in alphabetical order. A common language takes no places from the others; beyond
    LANGUAGES of them the rarest share the places of one. Counts are combined map-side; `count` words
    for each language reach the driver, whatever stands in `lang`."""
    spoken = F.lower(F.trim(F.coalesce(F.col("lang").cast("string"), F.lit("")))) if "lang" in docs.columns else F.lit("")
    if "lang" in docs.columns:
        often = docs.groupBy(spoken.alias("spoken")).count().orderBy(F.desc("count"), "spoken").limit(LANGUAGES)
        known = [r.spoken for r in often.collect()]
        spoken = F.when(spoken.isin(known), spoken).otherwise("")
    seen = docs.select(spoken.alias("spoken"), F.explode(F.array_distinct(F.filter(
        words(text_of()), lambda w: F.length(w) <= ANCHOR_CHARS))).alias("word"))
    order = Window.partitionBy("spoken").orderBy(F.desc("count"), "word")
    top = (seen.groupBy("spoken", "word").count().withColumn("place", F.row_number().over(order))
           .where(F.col("place") <= count).select("word").distinct())
    return sorted(r.word for r in top.collect())


def with_signatures(df: DataFrame, text: str, name: str, common: list[str]) -> DataFrame:
    """`df` with the sorted distinct signature hashes of a text column.

    The start of the text is an anchor too, and a chain may be cut short by its end, so every text
    with a word has a signature; a text without words has none. Anchors in a row each start a chain.
    """
    every, own, spots = (f"__{name}_{x}" for x in ("words", "content", "spots"))
    is_anchor = (lambda w: w.isin(common)) if common else (lambda w: F.lit(False))
    return (df.withColumn(every, words(F.col(text)))
            .withColumn(own, F.filter(every, lambda w: ~is_anchor(w)))
            # of the anchor number j at place p, p - j content words come before it
            .withColumn(spots, F.filter(F.transform(every, lambda w, p: F.when(is_anchor(w), p)),
                                        lambda p: p.isNotNull()))
            .withColumn(name, F.when(F.size(every) == 0, F.array().cast("array<int>")).otherwise(
                F.sort_array(F.array_distinct(F.concat(
                    F.array(F.hash(F.lit("^"), F.slice(own, 1, CHAIN))),
                    F.transform(spots, lambda p, j: F.hash(F.get(every, p), F.slice(own, p - j + 1, CHAIN))))))))
            .drop(every, own, spots))


def as_text(signatures: Column) -> Column:
    """The whole set as hexadecimal digits, eight per signature; empty for an empty set."""
    return F.lower(F.array_join(F.transform(signatures, lambda s: F.lpad(
        F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def length_part(size: Column, likeness: float) -> Column:
    """Partition of a set length: sets with at least this likeness are in one or in neighbouring
    partitions, as the shorter has at least that share of the longer one's length."""
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / math.log(1 / likeness)).cast("int")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard likeness of two sets, 0 to 1; two empty sets are alike. Pairs whose lengths rule out
    `at_least` are pruned to 0 without looking at the members."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    found = shared / (small + large - shared)
    exact = F.when(large == 0, 1.0).when(small < large * at_least, 0.0).otherwise(found)
    return exact if at_least == 0 else F.when(exact >= at_least, exact).otherwise(0.0)


def edited_pairs(docs: DataFrame, count: int = ANCHORS) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and both likenesses.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of
    the next document in descending doc_id (null doc_ids come last), after the last one the first.
    Rows that share doc_id and text are one document there, and each gets its result; of several
    texts under one doc_id the order is by their hash. Null texts are empty. A table of one
    document is its own next.

    Each text is shuffled once, by its own key, and half a text at most goes to the neighbour.
    """
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("key", F.xxhash64("text"))
    common = anchors(docs, count)
    me = F.struct("doc_id", "key")
    # cut first: the keys are made once, not once more to find the ranges
    chain = cut(rows.groupBy("doc_id", "key", F.length("text").alias("n_chars")).count())
    first = chain.orderBy(F.desc("doc_id"), F.desc("key")).limit(1).collect()
    if not first:
        first = [(None, 0, 0)]
    wrap = F.struct(F.lit(first[0][0]).cast("long").alias("doc_id"), F.lit(first[0][1]).cast("long").alias("key"))
    linked = last_before(chain.drop("count"), ["doc_id", "key"], me, "next", strictly=True).select(
        F.col("doc_id").alias("to_id"), F.col("key").alias("to_key"), F.col("n_chars").alias("to_chars"),
        F.coalesce("next", wrap).alias("next"))
    asks = linked.select(F.col("next.doc_id").alias("next_id"), F.col("next.key").alias("next_key"),
                         "to_id", "to_key", F.floor(F.col("to_chars") / 2).cast("int").alias("half"))
    # repeated rows send once; without any the rows go as they are
    sender = rows if chain.where("count > 1").isEmpty() else rows.dropDuplicates(["doc_id", "key"])
    sent = sender.join(asks, sender["doc_id"].eqNullSafe(asks["next_id"]) & (sender["key"] == asks["next_key"]))
    sent = (with_signatures(sent, "text", "next_signatures", common)
            .select("to_id", "to_key", "half", "next_signatures",
                    F.substring("text", F.lit(1), F.col("half")).alias("head")))
    both = (rows.join(sent, rows["doc_id"].eqNullSafe(sent["to_id"]) & (rows["key"] == sent["to_key"]))
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.col("half")).cast("int")),
                                           F.col("head"))))
    made = with_signatures(with_signatures(both, "text", "signatures", common), "edited", "edited_signatures", common)
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("signatures")).alias("fingerprint"),
        as_text(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
        length_part(F.size("signatures"), 0.8).alias("length_part"))
