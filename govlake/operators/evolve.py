"""Change and its proof: snapshots compared by value, column replacement, freshness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MigrationRefused(RuntimeError):
    """The state a migration starts from is not there (it ran already, or never could)."""


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str],
                  values: Sequence[str]) -> DataFrame:
    """Keys whose presence or values differ, with both values side by side.

    Equivalent to a full outer join with a null-safe comparison, done as one union and one
    grouping: a single shuffle with map-side reduction instead of two shuffles and a sort.
    Keys must identify a row within each snapshot.
    """
    def side(df: DataFrame, is_before: bool) -> DataFrame:
        return df.select(*keys, *values, F.lit(is_before).alias("_before"))

    def of(column: str, is_before: bool) -> Column:
        chosen = F.col("_before") if is_before else ~F.col("_before")
        return F.max(F.when(chosen, F.col(column)))

    merged = side(before, True).unionByName(side(after, False)).groupBy(*keys).agg(
        F.bool_or("_before").alias("in_before"), F.bool_or(~F.col("_before")).alias("in_after"),
        *[of(v, True).alias(f"{v}_before") for v in values],
        *[of(v, False).alias(f"{v}_after") for v in values])
    changed = F.col("in_before") != F.col("in_after")
    for v in values:
        changed = changed | ~F.col(f"{v}_before").eqNullSafe(F.col(f"{v}_after"))
    return merged.where(changed)


def object_set_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Objects that appeared, vanished or changed type, by name."""
    return snapshot_diff(before, after, ["table_schema", "table_name"], ["table_type"])


_COLUMN_KEY = ["table_schema", "table_name", "column_name"]


def _column_facts(columns: DataFrame, tags: DataFrame) -> DataFrame:
    """Comments and tags as one relation with one row per fact about a column."""
    text = F.lit(None).cast("string")
    return columns.select(*_COLUMN_KEY, F.lit(True).alias("is_column"), "comment",
                          text.alias("tag_name"), text.alias("tag_value")).unionByName(
        tags.select(*_COLUMN_KEY, F.lit(False).alias("is_column"), text.alias("comment"),
                    "tag_name", "tag_value"))


def tag_text(where: Column | None = None, template: str = "%s=%s") -> Column:
    """Aggregate: the sorted `tag=value` list of one column, whatever the tag names.

    The list holds the tags of one column, so it stays short however large the catalog is.
    """
    held = F.col("tag_name").isNotNull()
    tag = F.when(held if where is None else held & where, F.struct("tag_name", "tag_value"))
    return F.concat_ws(", ", F.transform(
        F.array_sort(F.collect_set(tag)),
        lambda t: F.format_string(template, t["tag_name"], t["tag_value"])))


def metadata_snapshot(columns: DataFrame, tags: DataFrame) -> DataFrame:
    """Per column its comment and its tags as text, to be stored before a change. Tags of a column
    that does not exist are no column."""
    return (_column_facts(columns, tags).groupBy(*_COLUMN_KEY).agg(
        F.bool_or("is_column").alias("is_column"), F.max("comment").alias("comment"),
        tag_text().alias("tags")).where("is_column").drop("is_column"))


def metadata_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Difference of two stored snapshots, by value and not by count."""
    return snapshot_diff(before, after, _COLUMN_KEY, ["comment", "tags"])


def metadata_change(before: tuple[DataFrame, DataFrame],
                    after: tuple[DataFrame, DataFrame]) -> DataFrame:
    """`metadata_diff` of two live states, each (columns, tags), in a single grouping.

    Snapshotting each side and comparing would group the same keys three times.
    """
    facts = _column_facts(*before).withColumn("_before", F.lit(True)).unionByName(
        _column_facts(*after).withColumn("_before", F.lit(False)))
    then, now = F.col("_before"), ~F.col("_before")
    merged = facts.groupBy(*_COLUMN_KEY).agg(
        F.bool_or(then & F.col("is_column")).alias("in_before"),
        F.bool_or(now & F.col("is_column")).alias("in_after"),
        F.max(F.when(then, F.col("comment"))).alias("comment_before"),
        tag_text(then).alias("tags_before"),
        F.max(F.when(now, F.col("comment"))).alias("comment_after"),
        tag_text(now).alias("tags_after"))
    there = F.col("in_before") | F.col("in_after")
    return merged.where(there).where((F.col("in_before") != F.col("in_after"))
                        | ~F.col("comment_before").eqNullSafe(F.col("comment_after"))
                        | (F.col("tags_before") != F.col("tags_after")))


def fingerprint(df: DataFrame, column: str | Column) -> DataFrame:
    """Rows, non-null, null, smallest, largest and distinct values of one column."""
    value = F.col(column) if isinstance(column, str) else column
    return df.agg(F.count(F.lit(1)).alias("rows_total"), F.count(value).alias("rows_with_value"),
                  F.count_if(value.isNull()).alias("rows_null"), F.min(value).alias("smallest"),
                  F.max(value).alias("largest"), F.count_distinct(value).alias("distinct_values"))


def equivalent(df: DataFrame, new_column: str, expression: Column) -> DataFrame:
    """Null-safe mismatches between a replacement column and what it replaces."""
    same = F.col(new_column).eqNullSafe(expression)
    return df.agg(F.count(F.lit(1)).alias("rows_total"), F.count_if(~same).alias("mismatches"))


def digest(df: DataFrame) -> DataFrame:
    """item, n, low, high: a digest of each column's values and, as item `*`, of the rows, whatever
    their order. `n` counts non-null values (rows for `*`); `low` and `high` are sums of two 64-bit
    hashes as exact decimals, nulls with a hash of their own, so a value put in place of another, or a row more, shows. One scan, a
    few numbers per task; columns are taken by name.
    """
    columns = sorted(df.columns)

    def summed(*of: Column) -> tuple[Column, Column]:
        return tuple(F.coalesce(F.sum(F.xxhash64(F.lit(seed), *of).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")
                     for seed in (17, 71))

    aggregates = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        low, high = summed(value)
        aggregates += [F.count(value).alias(f"n{i}"), low.alias(f"l{i}"), high.alias(f"h{i}")]
    # a null is skipped by a hash, so each value goes with whether it is there
    low, high = summed(*(x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())))
    one = df.agg(F.count(F.lit(1)).alias("n_all"), low.alias("l_all"), high.alias("h_all"), *aggregates)
    entries = [F.struct(F.lit(name).alias("item"), F.col(f"n{i}").alias("n"), F.col(f"l{i}").alias("low"), F.col(f"h{i}").alias("high"))
               for name, i in [("*", "_all"), *((c, i) for i, c in enumerate(columns))]]
    return one.select(F.inline(F.array(*entries)))


def digest_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """item, equal: each column and the rows (`*`) of two frames, by their digests; an item that only
    one side has is not equal. No join of rows: two scans and a few rows each."""
    both = (digest(before).withColumn("side", F.lit(1)).unionByName(digest(after).withColumn("side", F.lit(2)))
            .groupBy("item").agg(F.count(F.lit(1)).alias("sides"), F.count_distinct("n", "low", "high").alias("kinds")))
    return both.select("item", ((F.col("sides") == 2) & (F.col("kinds") == 1)).alias("equal"))


def require_column(df: DataFrame, column: str) -> None:
    """Guard for a step that removes `column`: a second run stops before it changes anything."""
    if column not in df.columns:
        raise MigrationRefused(f"{column} is already gone: nothing to migrate")


def freshness(df: DataFrame, built_at: str, key: str) -> DataFrame:
    return df.agg(F.min(built_at).alias("oldest_build"), F.max(built_at).alias("newest_build"),
                  F.count(F.lit(1)).alias("rows_total"),
                  F.count_distinct(key).alias("keys_distinct"))
