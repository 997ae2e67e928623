"""Lookup join that survives a heavy key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
BUCKETS = 1 << 18


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("_bucket")


def heavy_buckets(keys: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Hash buckets of the key holding more rows than one task should take, and the number of
    parts to split each into.

    Counting buckets instead of keys keeps the count small whatever the number of keys: at most
    2^18 integers per map task after the local combine, and at most 2^18 heavy buckets to
    broadcast (2 MB). A bucket is heavy above max(rows_per_task, four times its fair share), so
    at most a quarter of them can be, and their parts add up to less than 2^18.
    """
    counts = (keys.where(F.col(key).isNotNull())
              .groupBy(bucket_of(key)).agg(F.count(F.lit(1)).alias("_rows")))
    # the total is summed over the buckets, 2^18 rows at most, instead of counting the keys again
    total = F.sum("_rows").over(Window.partitionBy())
    limit = F.greatest(F.lit(rows_per_task), F.ceil(total * 4 / BUCKETS))
    return (counts.withColumn("_limit", limit).where("_rows > _limit")
            .select("_bucket", F.ceil(F.col("_rows") / F.col("_limit")).cast("int").alias("_parts")))


def lookup(rows: DataFrame, table: DataFrame, key: str, keys_from: DataFrame | None = None,
           rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Left-join `rows` to `table` (one row per key), keeping every row exactly once.

    Rows of a heavy bucket are spread over parts by a hash of their content and the bucket's few
    table rows are repeated per part, so no task receives a whole heavy key. The hash makes a
    re-run of a lost task assign the same parts. `keys_from` may name a cheaper relation holding
    the same keys; it only steers the split, never the result.
    """
    source = keys_from if keys_from is not None else rows
    heavy = F.broadcast(heavy_buckets(source, key, rows_per_task))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    part = F.when(parts > 1, F.pmod(F.xxhash64(*rows.columns), parts)).otherwise(0).cast("int")
    spread = (rows.withColumn("_bucket", bucket_of(key)).join(heavy, "_bucket", "left")
              .withColumn("_part", part).drop("_bucket", "_parts"))
    copies = (table.withColumn("_bucket", bucket_of(key)).join(heavy, "_bucket", "left")
              .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
              .drop("_bucket", "_parts"))
    return spread.join(copies, [key, "_part"], "left").drop("_part")
