"""Lineage as declared, append-only rows: table edges with a time, and column edges.

Table edge columns: source_table, source_path, source_type, target_schema, target_table,
event_time. A file edge has no source_table. Column edge columns: source_table,
source_column, target_table, target_column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.functions.rows import literal
from govlake.operators import graph

TABLE_EDGES = ("source_table string, source_path string, source_type string, "
               "target_schema string, target_table string, event_time timestamp")
COLUMN_EDGES = ("source_table string, source_column string, target_table string, "
                "target_column string")
IDENTIFIERS = ("national_id", "email", "date_of_birth")


def source() -> Column:
    """The table read, or `FILE: path` where a file was."""
    return F.coalesce(F.col("source_table"), F.concat(F.lit("FILE: "), F.col("source_path")))


def record(spark: SparkSession, sources: Sequence[str], target: str, at: str,
           column_map: Mapping[str, Sequence[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Edges of one step. A source holding `/` is a path. `column_map` maps a target column to
    the `table.column` names it is made from."""
    schema = target.split(".")[0]
    edges = [(None if "/" in s else s, s if "/" in s else None,
              "PATH" if "/" in s else "TABLE", schema, target) for s in sources]
    table_rows = literal(
        spark, edges, "source_table string, source_path string, source_type string, "
               "target_schema string, target_table string"
    ).withColumn("event_time", F.lit(at).cast("timestamp"))
    pairs = [(*s.rsplit(".", 1), target, column)
             for column, origins in (column_map or {}).items() for s in origins]
    return table_rows, literal(spark, pairs, COLUMN_EDGES)


def edges(lineage: DataFrame, schema: str | None = None) -> DataFrame:
    """Distinct edges, into one layer or all, file edges included."""
    if schema is not None:
        lineage = lineage.where(F.col("target_schema") == schema)
    return lineage.select(source().alias("source"), "target_table", "source_type").distinct()


def last_seen(lineage: DataFrame) -> DataFrame:
    """Each edge with the last time it was written."""
    return (lineage.groupBy("target_table", source().alias("source"))
            .agg(F.max("event_time").alias("last_seen")))


def current(lineage: DataFrame) -> DataFrame:
    """Edges of the latest run of each target: what feeds it now, not what ever fed it.

    Runs are reduced to one row per edge before the latest time is looked up, and the lookup is
    by target and time, so the edges of a busy target spread over its run times.
    """
    seen = last_seen(lineage)
    latest = seen.groupBy("target_table").agg(F.max("last_seen").alias("last_seen"))
    return seen.join(latest, ["target_table", "last_seen"]).select(
        "target_table", "source", "last_seen")


def trace(column_edges: DataFrame, columns: Sequence[str] = IDENTIFIERS) -> DataFrame:
    """Where did the identifiers go: distinct column edges leaving one of `columns`."""
    return column_edges.where(F.col("source_column").isin(list(columns))).distinct()


def _node(table: str, column: str) -> Column:
    return F.concat_ws("|", table, column)


def column_graph(column_edges: DataFrame) -> DataFrame:
    """Column edges as (src, dst, same), where `same` says that the name was kept."""
    return column_edges.select(_node("source_table", "source_column").alias("src"),
                               _node("target_table", "target_column").alias("dst"),
                               (F.col("source_column") == F.col("target_column")).alias("same"))


def identifier_reach(column_edges: DataFrame, identifiers: Sequence[str] = IDENTIFIERS) -> DataFrame:
    """Where the identifiers end up, however many steps on and under whatever name.

    identifier, table_name, column_name, hops (least number of steps from a column of that name) and
    path_class: `kept` if a shortest path never changes the name, else `renamed`. Columns that are
    sources under the identifier's own name are where it starts, not where it ends up.
    """
    start = column_edges.where(F.col("source_column").isin(list(identifiers))).select(
        F.col("source_column").alias("origin"), _node("source_table", "source_column").alias("node"))
    found = graph.reach(column_graph(column_edges), start)
    return found.select(F.col("origin").alias("identifier"), F.split_part("node", F.lit("|"), F.lit(1)).alias("table_name"),
                        F.split_part("node", F.lit("|"), F.lit(2)).alias("column_name"), "hops",
                        F.when(F.col("kept"), "kept").otherwise("renamed").alias("path_class"))


def recent(lineage: DataFrame, n: int, *tiebreak: str) -> DataFrame:
    """The last `n` events; a top-n per task and one merge, never a full sort."""
    order = [F.col("event_time").desc(), *[F.col(c) for c in tiebreak]]
    return lineage.orderBy(*order).limit(n)
