"""Classification tags as rows: set, unset, validate, derive, propagate.

Tags live in their own relation, never in column metadata: Spark carries metadata through
plain projections, while a fresh copy of a governed table must start with no tags at all.

Relation columns: table_schema, table_name, column_name, tag_name, tag_value.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.design import SENSITIVITY_RANK, TABLES, TAG_VOCABULARY, column_tags
from govlake.functions.rows import literal
from govlake.operators import graph
from govlake.operators.evolve import tag_text
from govlake.operators.lineage import column_graph
from govlake.session import cut

TAG_SCHEMA = ("table_schema string, table_name string, column_name string, "
              "tag_name string, tag_value string")
_COLUMN = ["table_schema", "table_name", "column_name"]


class TagValueNotAllowed(ValueError):
    """A tag assignment or policy names a value outside the governed vocabulary."""


def require_allowed(tags: Mapping[str, str],
                    vocabulary: Mapping[str, tuple[str, ...]] = TAG_VOCABULARY) -> None:
    for key, value in tags.items():
        allowed = vocabulary.get(key)
        if allowed is None or value not in allowed:
            raise TagValueNotAllowed(f"value {value!r} is not allowed for tag {key!r}; "
                                     f"allowed: {list(allowed or ())}")


def _rows(spark: SparkSession, table: str, column: str, tags: Mapping[str, str]) -> DataFrame:
    schema, name = table.split(".")
    return literal(spark, [(schema, name, column, k, v) for k, v in tags.items()], TAG_SCHEMA)


def set_tags(meta: DataFrame, table: str, column: str, tags: Mapping[str, str],
             vocabulary: Mapping[str, tuple[str, ...]] = TAG_VOCABULARY) -> DataFrame:
    """Assign tags to a column; an existing value of the same tag is replaced."""
    require_allowed(tags, vocabulary)
    return unset_tags(meta, table, column, *tags).unionByName(
        _rows(meta.sparkSession, table, column, tags))


def assign(meta: DataFrame, assignments: DataFrame,
           vocabulary: Mapping[str, tuple[str, ...]] = TAG_VOCABULARY) -> DataFrame:
    """`set_tags` for many columns at once: the relation after all allowed assignments.

    An assigned value replaces the one held. Old and new rows meet in one grouping per column
    and tag. Assignments outside the vocabulary change nothing; see `refused`.
    """
    allowed = assignments.join(F.broadcast(vocabulary_rows(meta.sparkSession, vocabulary)),
                               ["tag_name", "tag_value"], "left_semi")
    new = F.col("_new")
    merged = (meta.withColumn("_new", F.lit(False))
              .unionByName(allowed.select(*meta.columns).withColumn("_new", F.lit(True)))
              .groupBy(*_COLUMN, "tag_name").agg(
                  F.max(F.when(new, F.col("tag_value"))).alias("_assigned"),
                  F.max(F.when(~new, F.col("tag_value"))).alias("_held")))
    return merged.select(*_COLUMN, "tag_name",
                         F.coalesce("_assigned", "_held").alias("tag_value"))


def refused(assignments: DataFrame,
            vocabulary: Mapping[str, tuple[str, ...]] = TAG_VOCABULARY) -> DataFrame:
    """Assignments outside the vocabulary, each with the values it could have used."""
    listed = F.create_map(*(F.lit(x) for k, values in vocabulary.items() for x in (k, ", ".join(values))))
    allowed = F.create_map(*(F.lit(x) for k, values in vocabulary.items() for v in values
                             for x in (f"{k}={v}", True)))
    known = allowed[F.concat_ws("=", "tag_name", "tag_value")]
    return (assignments.where(known.isNull())
            .select(*_COLUMN, "tag_name", "tag_value", listed[F.col("tag_name")].alias("allowed")))


def unset_tags(meta: DataFrame, table: str, column: str, *names: str) -> DataFrame:
    schema, name = table.split(".")
    hit = ((F.col("table_schema") == schema) & (F.col("table_name") == name)
           & (F.col("column_name") == column) & F.col("tag_name").isin(list(names)))
    return meta.where(~hit)


def designed_tags(spark: SparkSession, *tables: str) -> DataFrame:
    rows = [(*t.split("."), column, k, v) for t in (tables or TABLES)
            for column, tags in column_tags(t).items() for k, v in tags.items()]
    return literal(spark, rows, TAG_SCHEMA)


def vocabulary_rows(spark: SparkSession,
                    vocabulary: Mapping[str, tuple[str, ...]] = TAG_VOCABULARY) -> DataFrame:
    return literal(spark, [(k, v) for k, values in vocabulary.items() for v in values],
                   "tag_name string, tag_value string")


def violations(meta: DataFrame,
               vocabulary: Mapping[str, tuple[str, ...]] = TAG_VOCABULARY) -> DataFrame:
    """Values in use that the vocabulary does not list, with how many columns carry them.

    Counted per value first, so the anti-join sees distinct values only.
    """
    used = meta.groupBy("tag_name", "tag_value").agg(F.count(F.lit(1)).alias("columns_using"))
    return used.join(vocabulary_rows(meta.sparkSession, vocabulary),
                     ["tag_name", "tag_value"], "left_anti")


def _rank(value: Column) -> Column:
    rank = F.lit(0)
    for level, n in SENSITIVITY_RANK.items():
        rank = F.when(value == level, n).otherwise(rank)
    return rank


def _level(rank: Column) -> Column:
    name = F.lit(None).cast("string")
    for level, n in SENSITIVITY_RANK.items():
        name = F.when(rank == n, level).otherwise(name)
    return name


def inheritance_gaps(column_edges: DataFrame, meta: DataFrame) -> DataFrame:
    """Columns classified below something they are made from, however many steps back.

    table_schema, table_name, column_name, classification (its own, null if it has none) and
    inherited (the highest of all its ancestors). Values outside the vocabulary rank lowest.
    """
    return gaps_along(graph.plain(column_graph(column_edges)), meta)


def gaps_along(flow: DataFrame, meta: DataFrame) -> DataFrame:
    """`inheritance_gaps` over a column graph that `graph.plain` has written, for several states of the tags."""
    node = F.concat_ws("|", F.concat_ws(".", "table_schema", "table_name"), "column_name")
    own = cut(meta.where(F.col("tag_name") == "classification").groupBy(node.alias("node"))
              .agg(F.max(_rank(F.col("tag_value"))).alias("value")))
    all_of = graph.highest_along(flow, own.where("value > 0"))
    found = (all_of.join(own.withColumnRenamed("value", "own"), "node", "left")
             .where("own is null or own < value"))
    full = F.split_part("node", F.lit("|"), F.lit(1))
    return found.select(F.split_part(full, F.lit("."), F.lit(1)).alias("table_schema"),
                        F.split_part(full, F.lit("."), F.lit(2)).alias("table_name"),
                        F.split_part("node", F.lit("|"), F.lit(2)).alias("column_name"),
                        _level(F.col("own")).alias("classification"), _level(F.col("value")).alias("inherited"))


def raise_inherited(column_edges: DataFrame, meta: DataFrame) -> DataFrame:
    """The assignments that close all gaps: each such column takes what it inherits."""
    return raise_along(graph.plain(column_graph(column_edges)), meta)


def raise_along(flow: DataFrame, meta: DataFrame) -> DataFrame:
    """`raise_inherited` over a column graph that `graph.plain` has written."""
    return gaps_along(flow, meta).select(
        *_COLUMN, F.lit("classification").alias("tag_name"), F.col("inherited").alias("tag_value"))


def table_sensitivity(meta: DataFrame) -> DataFrame:
    """Table-level classification: the highest one any of its columns carries."""
    return (meta.where(F.col("tag_name") == "classification")
            .groupBy("table_schema", "table_name").agg(F.max(_rank(F.col("tag_value"))).alias("_rank"))
            .select("table_schema", "table_name", _level(F.col("_rank")).alias("classification")))


def propagate(meta: DataFrame, source: str, target: str,
              column_map: Mapping[str, str]) -> DataFrame:
    """Copy the source columns' tags onto the target columns (target column -> source column)."""
    schema, name = source.split(".")
    to_schema, to_name = target.split(".")
    pairs = literal(meta.sparkSession, [(s, t) for t, s in column_map.items()],
                    "column_name string, target string")
    copied = (meta.where((F.col("table_schema") == schema) & (F.col("table_name") == name))
              .join(pairs, "column_name")
              .select(F.lit(to_schema).alias("table_schema"), F.lit(to_name).alias("table_name"),
                      F.col("target").alias("column_name"), "tag_name", "tag_value"))
    return meta.unionByName(copied)


def statements(meta: DataFrame) -> DataFrame:
    """One `ALTER TABLE ... SET TAGS` text per tagged column."""
    return meta.groupBy(*_COLUMN).agg(
        tag_text(template="'%s' = '%s'").alias("t")).where("t <> ''").select(
        *_COLUMN,
        F.concat(F.lit("ALTER TABLE "), F.concat_ws(".", "table_schema", "table_name"),
                 F.lit(" ALTER COLUMN "), F.col("column_name"), F.lit(" SET TAGS ("),
                 F.col("t"), F.lit(");")).alias("stmt"))
