"""Allow and block rules for URLs by a sorted sweep over prefix intervals.

A host turned around label by label (`org.example.`) makes a rule's subdomains one interval of
keys, and its path makes another inside each host. A sweep over the sorted keys carries the stack
of rules that the last rule seen is nested in; whatever rule covers a key is on that stack. The
first sweep finds the rule hosts above each URL, the second the longest rule path under each of
them; the longest host with a fitting path decides, then the longest path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordered import last_before

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER),
                      F.lit(""))


def path_of(url: Column) -> Column:
    """From there up to ? # or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """example.org -> org.example. so that a host's subdomains share its key as a prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows for a short list of rules."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _stacks(rules: DataFrame, key: str, within: list[str], prefixes: Column, *carry: str) -> DataFrame:
    """Each rule with the rules it is nested in, itself last: joined on its own prefixes."""
    above = rules.select(*within, F.col(key).alias("prefix"), *carry)
    return (rules.select(*within, key, F.explode(F.array_distinct(prefixes)).alias("prefix"))
            .join(above, [*within, "prefix"])
            .groupBy(*within, key)
            .agg(F.array_sort(F.collect_list(F.struct(F.length("prefix").alias("size"), "prefix", *carry)))
                 .alias("stack")))


def verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    `rules` has host, path, verdict. A rule fits its host and all subdomains where the URL's path
    starts with the rule's. Of two rules with the same host and path the one that blocks counts;
    rules with a null or an empty host fit nothing, a null rule path is empty. Without a fitting
    rule the verdict is `default`, also for null URLs and URLs without ://. Repeated pages stay;
    no other column of `pages` is read.
    """
    asked = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = (rules.where("host <> ''")
             .select(host_key(F.translate("host", UPPER, LOWER)).alias("rule_key"),
                     F.translate("host", UPPER, LOWER).alias("rule_host"),
                     F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
             .groupBy("rule_key", "rule_host", "rule_path")
             .agg(F.bool_or(F.col("verdict") == "block").alias("blocks")))
    urls = asked.select("host", "path").distinct()

    # first sweep: the rule hosts above each URL
    labels = F.split("rule_key", r"\.")
    host_prefixes = F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                                lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))
    hosts = _stacks(known.select("rule_key").distinct(), "rule_key", [], host_prefixes)
    keyed = urls.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "path", "host",
                        F.lit(None).cast("array<struct<size:int,prefix:string>>").alias("stack"))
    starts = hosts.select(F.col("rule_key").alias("key"), F.lit(0).alias("kind"), F.lit("").alias("path"),
                          F.lit("").alias("host"), "stack")
    swept = last_before(keyed.unionByName(starts), ["key", "kind", "path", "host"], F.col("stack"), "above")
    above = F.expr("filter(above, r -> startswith(key, r.prefix))")
    probes = (swept.where("kind = 1").select("host", "path", F.explode(above).alias("r"))
              .select("host", "path", F.col("r.prefix").alias("rule_key")))

    # second sweep: the longest rule path under each of those hosts
    path_prefixes = F.transform(F.sequence(F.lit(0), F.length("rule_path")),
                                lambda n: F.substring("rule_path", F.lit(1), n))
    nested = (_stacks(known, "rule_path", ["rule_key", "rule_host"], path_prefixes, "blocks"))
    asks = probes.select("rule_key", F.col("path").alias("at"), F.lit(1).alias("kind"), "host",
                         F.lit(None).cast("struct<rule_key:string,rule_host:string,"
                                          "stack:array<struct<size:int,prefix:string,blocks:boolean>>>").alias("own"))
    begins = nested.select("rule_key", F.col("rule_path").alias("at"), F.lit(0).alias("kind"),
                           F.lit("").alias("host"), F.struct("rule_key", "rule_host", "stack").alias("own"))
    swept = last_before(asks.unionByName(begins), ["rule_key", "at", "kind", "host"], F.col("own"), "seen")
    fits = F.expr("try_element_at(filter(seen.stack, r -> startswith(at, r.prefix)), -1)")
    decided = (swept.where("kind = 1 and seen.rule_key = rule_key")
               .select("host", F.col("at").alias("path"), "seen.rule_host", fits.alias("r"))
               .where("r is not null")
               .groupBy("host", "path")
               .agg(F.max(F.struct(F.length("rule_host").alias("a"), F.col("r.size").alias("b"),
                                   F.concat("rule_host", "r.prefix").alias("rule"),
                                   F.col("r.blocks").alias("blocks"))).alias("best")))
    chosen = decided.select("host", "path", "best.rule",
                            F.when(F.col("best.blocks"), "block").otherwise("allow").alias("verdict"))
    return (asked.join(chosen, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("verdict", F.lit(default)).alias("verdict")))
