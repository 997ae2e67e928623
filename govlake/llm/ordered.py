"""What came last in a global order, without a partition that holds one key's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, partitions, unused


def last_before(rows: DataFrame, order: list[str], value: Column, name: str,
                strictly: bool = False) -> DataFrame:
    """Each row with the last non-null `value` at or before it in the order of the columns, or
    strictly before it.

    Rows are dealt by ranges of the whole order, so one key with a third of the rows spreads over
    many tasks. Within a range a running window finds the value; what reaches over from earlier
    ranges is one row per range, the only thing broadcast (as many rows as there are ranges).
    `order` has to be total up to rows for which the result is the same.
    """
    n = partitions(rows.sparkSession)
    part, seen, over = (unused(rows.columns, f"_{x}") for x in ("part", "seen", "over"))
    spread = cut(rows.withColumn(seen, value).repartitionByRange(n, *order)
                 .withColumn(part, F.spark_partition_id()))
    tails = _tails(spread, part, seen, over, order)
    within = Window.partitionBy(part).orderBy(*order)
    if strictly:
        within = within.rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    reach = tails.select(part, F.last(over, ignorenulls=True).over(ahead).alias(over))
    return (spread.withColumn(name, F.last(seen, ignorenulls=True).over(within))
            .join(F.broadcast(reach), part, "left")
            .withColumn(name, F.coalesce(F.col(name), F.col(over)))
            .drop(part, seen, over))


def _tails(spread: DataFrame, part: str, seen: str, over: str, order: list[str]) -> DataFrame:
    """One row per range: its last non-null value, null where it has none."""
    last = (spread.where(F.col(seen).isNotNull()).groupBy(part)
            .agg(F.max_by(seen, F.struct(*order)).alias(over)))
    return spread.select(part).distinct().join(last, part, "left")
