"""Anonymization: generalise, measure k, suppress, and attack the result.

A group's size is additive, so every measurement starts from counts over the finest grouping
and re-aggregates them; rows of people are shuffled once, already counted.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govlake.design import K
from govlake.functions.masks import pseudonymize
from govlake.functions.rows import literal
from govlake.functions.values import decade, decade_band
from govlake.session import cut

PUBLISHED = ("age_band", "region", "segment", "marketing_consent")


def _stats(groups: DataFrame, k: int) -> DataFrame:
    small = F.col("n") < k
    return groups.agg(
        F.count(F.lit(1)).alias("combinations"),
        F.min("n").alias("smallest_group"),
        F.count_if(small).alias("combos_below_k"),
        F.coalesce(F.sum(F.when(small, F.col("n"))), F.lit(0)).cast("bigint")
         .alias("rows_at_risk"))


def group_sizes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def k_profile(df: DataFrame, cols: Sequence[str], k: int = K) -> DataFrame:
    """Combinations, smallest group, groups below k and the people in them."""
    return _stats(group_sizes(df, cols), k)


def k_compare(df: DataFrame, candidates: Mapping[str, Sequence[str]], k: int = K) -> DataFrame:
    """`k_profile` for several candidate column sets, from one pass over the people."""
    every = list(dict.fromkeys(c for cols in candidates.values() for c in cols))
    base = group_sizes(df, every)
    out = None
    for label, cols in candidates.items():
        groups = base.groupBy(*cols).agg(F.sum("n").alias("n"))
        row = _stats(groups, k).select(F.lit(label).alias("quasi_identifiers"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def lattice(df: DataFrame, hierarchies: Mapping[str, Mapping[str, Column]], k: int = K) -> DataFrame:
    """All minimal generalisations under which nobody stands in a group below k.

    `hierarchies` has for each quasi-identifier its levels, from the finest to the coarsest, each a
    column over `df`. A generalisation picks one level of each; it is minimal if refining any pick
    leaves a group below k. Returns generalisation, combinations, smallest_group, people.

    People are grouped once, at the finest levels; all else adds up those counts. The lattice is
    climbed by height: what is coarser than a safe generalisation is safe too and never looked at.
    One job per height decides all its candidates, and one row for each reaches the driver.
    """
    names = list(hierarchies)
    levels = {q: list(hierarchies[q].items()) for q in names}
    picks = {f"{i}_{j}": column for i, q in enumerate(names) for j, (_, column) in enumerate(levels[q])}
    base = cut(df.select(*(c.cast("string").alias(n) for n, c in picks.items()))
               .groupBy(*picks).agg(F.count(F.lit(1)).alias("n")))
    heights = [len(levels[q]) - 1 for q in names]
    safe: list[tuple[int, ...]] = []
    found: list[tuple] = []
    for height in range(sum(heights) + 1):
        nodes = [v for v in itertools.product(*(range(h + 1) for h in heights)) if sum(v) == height
                 and not any(all(a <= b for a, b in zip(s, v, strict=True)) for s in safe)]
        if not nodes:
            continue
        group = F.array(*(F.struct(F.lit(i).alias("node"), F.array(*(F.col(f"{q}_{j}") for q, j in enumerate(v))).alias("of"))
                          for i, v in enumerate(nodes)))
        sizes = base.select("n", F.inline(group)).groupBy("node", "of").agg(F.sum("n").alias("n"))
        for r in sizes.groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("least"), F.sum("n").alias("people")).collect():
            if r.least >= k:
                v = nodes[r.node]
                safe.append(v)
                label = ", ".join(f"{q}={levels[q][j][0]}" for q, j in zip(names, v, strict=True))
                found.append((label, r.c, r.least, r.people))
    return literal(df.sparkSession, found, "generalisation string, combinations bigint, smallest_group bigint, people bigint")


def risk_groups(df: DataFrame, cols: Sequence[str], k: int = K) -> DataFrame:
    """The groups that would single people out."""
    return group_sizes(df, cols).where(F.col("n") < k)


def with_decade(customers: DataFrame) -> DataFrame:
    return customers.withColumn("decade", decade(F.col("birth_year")))


def publish_profile(customers: DataFrame, k: int = K) -> DataFrame:
    """The shareable profile: no key of any kind, small groups withheld rather than blurred."""
    return (customers.where(F.col("birth_year").isNotNull())
            .groupBy(decade_band(F.col("birth_year")).alias("age_band"),
                     "region", "segment", "marketing_consent")
            .agg(F.count(F.lit(1)).alias("people_in_group"))
            .where(F.col("people_in_group") >= k))


def suppression_rate(customers: DataFrame, k: int = K) -> DataFrame:
    """Groups and people published against those eligible, from the same group counts."""
    groups = publish_profile(customers, k=0)
    kept = F.col("people_in_group") >= k
    people = F.sum(F.when(kept, F.col("people_in_group")))
    return groups.agg(
        F.count_if(kept).alias("groups_published"),
        F.coalesce(people, F.lit(0)).cast("bigint").alias("people_published"),
        F.coalesce(F.sum("people_in_group"), F.lit(0)).cast("bigint").alias("people_eligible"))


def join_cardinality(published: DataFrame, people: DataFrame,
                     on: Sequence[str] = ("region", "segment")) -> DataFrame:
    """How many people each published row could be, if an attacker joins on shared columns.

    Pairs are counted by multiplying group sizes; they are never produced.
    """
    left = published.groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))
    right = people.groupBy(*on).agg(F.count(F.lit(1)).alias("persons"))
    both = left.join(right, list(on))
    return both.agg(
        F.coalesce(F.sum(F.col("rows") * F.col("persons")), F.lit(0)).cast("bigint")
         .alias("pairs"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("published_rows"),
        F.min("persons").alias("fewest_matches"))


def smallest_groups(published: DataFrame, by: Sequence[str] = ("region",)) -> DataFrame:
    return published.groupBy(*by).agg(
        F.count(F.lit(1)).alias("groups"),
        F.min("people_in_group").alias("smallest_group"),
        F.sum("people_in_group").alias("people"))


def bruteforce_rate(hashes: DataFrame, column: str, keys: DataFrame, key_format,
                    version: int = 1) -> DataFrame:
    """Share of unsalted hashes reversed by hashing every key of a known format.

    `keys` holds the whole key space, one distinct BIGINT `id` per row; `key_format` maps it to the
    guessed key. Guesses are hashed where their rows are; hashes are counted per value first, so
    repeated values cost one row.
    """
    guess: Column = key_format(F.col("id"))
    guesses = keys.select(pseudonymize(guess, version).alias(column), F.lit(True).alias("_hit"))
    targets = hashes.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return targets.join(guesses, column, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("hashes"),
        F.coalesce(F.sum(F.when(F.col("_hit"), F.col("n"))), F.lit(0)).cast("bigint")
         .alias("reversed"),
        F.round(F.sum(F.when(F.col("_hit"), F.col("n")).otherwise(0)) / F.sum("n"), 4)
         .alias("share_reversed"))
