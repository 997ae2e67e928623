"""Metadata coverage: what is untagged, undescribed, unowned, and did we see enough to say so.

Column and tag relations are merged by union and one grouping rather than joined: one shuffle,
reduced map-side, and a table with very many columns or copied rows stays spread out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.design import OWNERS

KEY = ["table_schema", "table_name", "column_name"]


def _merged(columns: DataFrame, tags: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per column of the catalog: is it classified, is it described? `by` names further keys of
    both relations."""
    key = [*by, *KEY]
    seen = columns.select(*key, F.lit(True).alias("is_column"), F.lit(False).alias("is_tag"),
                          (F.coalesce(F.col("comment"), F.lit("")) != "").alias("described"))
    tagged = (tags.where((F.col("tag_name") == "classification") & F.col("tag_value").isNotNull())
              .select(*key, F.lit(False).alias("is_column"), F.lit(True).alias("is_tag"),
                      F.lit(False).alias("described")))
    return (seen.unionByName(tagged).groupBy(*key)
            .agg(F.bool_or("is_column").alias("is_column"),
                 F.bool_or("is_tag").alias("classified"),
                 F.bool_or("described").alias("described"))
            .where("is_column").drop("is_column"))


def untagged(columns: DataFrame, tags: DataFrame) -> DataFrame:
    return _merged(columns, tags).where(~F.col("classified")).select(*KEY)


def undescribed(columns: DataFrame) -> DataFrame:
    return columns.where(F.coalesce(F.col("comment"), F.lit("")) == "").select(*KEY)


def matrix(columns: DataFrame, tags: DataFrame) -> DataFrame:
    """Per table: columns, columns without classification, columns without description."""
    return _merged(columns, tags).groupBy("table_schema", "table_name").agg(
        F.count(F.lit(1)).alias("columns_total"),
        F.count_if(~F.col("classified")).alias("missing_classification"),
        F.count_if(~F.col("described")).alias("missing_description"))


def totals(columns: DataFrame, tags: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`matrix` summed over all tables, in one aggregate."""
    return _merged(columns, tags, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("columns_total"),
        F.count_if(~F.col("classified")).alias("missing_classification"),
        F.count_if(~F.col("described")).alias("missing_description"))


def inspected(columns: DataFrame) -> DataFrame:
    """Positive control: columns seen per schema; an absence check is void without it."""
    return columns.groupBy("table_schema").agg(
        F.count_distinct("table_name").alias("tables_seen"),
        F.count(F.lit(1)).alias("columns_seen"))


def vocabulary(tags: DataFrame) -> DataFrame:
    return tags.groupBy("tag_name", "tag_value").agg(F.count(F.lit(1)).alias("columns_using"))


def tagged_columns(tags: DataFrame) -> DataFrame:
    """Tagged columns per table; a fresh copy of a governed table is absent here."""
    return (tags.groupBy("table_schema", "table_name")
            .agg(F.count_distinct("column_name").alias("tagged_columns")))


def ownership_exceptions(tables: DataFrame, owner: str = OWNERS,
                         allowed: Sequence[str] = ()) -> DataFrame:
    """Objects not owned by the expected group, each marked as a named exception or not."""
    return (tables.where(~F.col("table_owner").eqNullSafe(owner))
            .select("table_schema", "table_name", "table_owner",
                    F.col("table_name").isin(list(allowed)).alias("named_exception")))
