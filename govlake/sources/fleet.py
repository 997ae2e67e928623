"""A company-wide catalog derived from the test tables, for the metadata operators.

A real catalog has millions of columns, tags, grants and lineage events, so the operators over
them are tested on relations that grow with the data: one catalog object per customer, one
column per order, one grant per part, one lineage event per event, one column edge per line
item. Every value is a function of its own row, computed without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from govlake.design import ALL_USERS, LAYERS, OWNERS, TAG_VOCABULARY
from govlake.sources.fixture import table

SCHEMAS, CATALOGS = 25, 4
LAYER_ORDER = tuple(sorted(LAYERS))
DATA_TYPES = ("STRING", "DATE", "DECIMAL(12,2)", "STRING", "BOOLEAN")
LEVELS = TAG_VOCABULARY["classification"]
# the last value is retired: it stands for a tag someone forgot to remove
PII_TYPES = (*TAG_VOCABULARY["pii_type"], "dob_date")
GRANTEES = ("analyst", "data_engineer", "auditor", ALL_USERS, "analyst_eu", "contractor")
COLUMN_NAMES = ("email", "national_id", "date_of_birth", "amount", "status", "region", "city")


def pick(values: tuple[str, ...], index: str) -> str:
    """SQL for the value at a zero-based index."""
    return f"elt(int({index}) + 1, {', '.join(repr(v) for v in values)})"


def schema_of(key: str) -> str:
    """`<layer>_<n>`: one of 25 schemas, five per layer."""
    n = f"(({key}) % {SCHEMAS})"
    return f"{pick(LAYER_ORDER, f'{n} % {len(LAYER_ORDER)}')} || '_' || {n}"


def catalog_of(key: str) -> str:
    return f"'env' || ((({key}) % {SCHEMAS}) % {CATALOGS})"


def table_of(key: str) -> str:
    return f"'t' || ({key})"


def full_name(key: str) -> str:
    return f"{schema_of(key)} || '.' || {table_of(key)}"


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "customer").selectExpr("c_custkey AS k").selectExpr(
        f"{catalog_of('k')} AS table_catalog", f"{schema_of('k')} AS table_schema",
        f"{table_of('k')} AS table_name",
        """CASE WHEN k % 11 = 0 THEN 'VIEW' WHEN k % 13 = 0 THEN 'MATERIALIZED_VIEW'
           ELSE 'MANAGED' END AS table_type""",
        f"CASE WHEN k % 41 = 0 THEN 'user' || k % 7 ELSE '{OWNERS}' END AS table_owner"))


def tables_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same catalog later: some objects dropped, some changed type, some new."""
    before = tables(spark, sf_dir).selectExpr("*", "bigint(substring(table_name, 2)) AS k")
    kept = before.where("k % 29 <> 0").selectExpr(
        "table_catalog", "table_schema", "table_name",
        "CASE WHEN k % 37 = 0 THEN 'EXTERNAL' ELSE table_type END AS table_type", "table_owner")
    new = before.where("k % 31 = 0").selectExpr(
        "table_catalog", "table_schema", "'backing_' || table_name AS table_name", "table_type",
        "table_owner")
    return kept.unionByName(new)


_COLUMN = (f"{schema_of('o_custkey')} AS table_schema", f"{table_of('o_custkey')} AS table_name",
           "CASE WHEN o_orderkey % 37 = 0 THEN 'region_' ELSE 'c' END || o_orderkey AS column_name")


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        *_COLUMN, f"{pick(DATA_TYPES, f'o_orderkey % {len(DATA_TYPES)}')} AS data_type",
        """CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN ''
           ELSE 'Column ' || o_orderkey END AS comment""")


def column_tags(spark: SparkSession, sf_dir: str, later: bool = False) -> DataFrame:
    """Tags of every column, some outside the governed names, some left over from columns that are
    gone. `later` gives the state after a rebuild that lost a few tags and changed a few values."""
    level = f"CASE WHEN o % 97 = 0 THEN 'secret' ELSE {pick(LEVELS, f'o % {len(LEVELS)}')} END"
    has_level = "o % 59 <> 0"
    if later:
        level = f"CASE WHEN o % 71 = 0 THEN 'restricted' ELSE {level} END"
        has_level += " AND o % 67 <> 0"

    def tag(condition: str, name: str, value: str) -> str:
        return f"IF({condition}, struct('{name}' AS tag_name, {value} AS tag_value), NULL)"

    pii = pick(PII_TYPES, f"floor(o / 7) % {len(PII_TYPES)}")
    carried = ", ".join((tag(has_level, "classification", level), tag("o % 7 = 0", "pii_type", pii),
                         tag("o % 31 = 0", "filter_key", "'region'"),
                         tag("o % 61 = 0", "cost_center", f"'cc' || (o + {int(later)} * int(o % 2)) % 5")))
    return (table(spark, sf_dir, "orders").selectExpr(*_COLUMN, "o_orderkey AS o")
            .selectExpr("table_schema", "table_name",
                        "CASE WHEN o % 173 = 0 THEN 'gone' || o ELSE column_name END AS column_name",
                        f"inline(array_compact(array({carried})))"))


def privileges(spark: SparkSession, sf_dir: str, later: bool = False) -> DataFrame:
    """One grant row per part, at catalog, schema or table level; objects repeat.

    Each grantee reaches two catalogs, four schemas and single tables, so no one sees all.
    `later` gives the state after a maintenance run that did not restore every grant.
    """
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS p", f"floor(p_partkey / 10) % {len(GRANTEES)} AS g",
        "CASE WHEN p_partkey % 10 = 0 THEN 'CATALOG' WHEN p_partkey % 10 < 5 THEN 'SCHEMA' "
        "ELSE 'TABLE' END AS object_type")
    if later:
        rows = rows.where("p % 101 <> 0")
    s = f"(p * 7 % 4 * {len(GRANTEES)} + g)"
    return rows.selectExpr(
        f"{pick(GRANTEES, 'g')} AS grantee",
        """CASE WHEN p % 30 = 0 THEN 'BROWSE' WHEN p % 10 = 0 THEN 'USE_CATALOG'
           WHEN p % 10 < 3 THEN 'USE_SCHEMA' ELSE 'SELECT' END AS privilege_type""",
        "object_type",
        f"""CASE object_type WHEN 'CATALOG' THEN 'env' || (g + floor(p / 60) % 2) % {CATALOGS}
            WHEN 'SCHEMA' THEN {catalog_of(s)} || '.' || {schema_of(s)}
            ELSE {catalog_of('p')} || '.' || {full_name('p')} END AS object_key""",
        "CASE WHEN p % 9 = 8 THEN 'CATALOG' ELSE 'NONE' END AS inherited_from")


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        f"CASE WHEN event_id % 9 <> 0 THEN {full_name('event_id * 31 % 100')} END AS source_table",
        "CASE WHEN event_id % 9 = 0 THEN '/landing/file' || event_id % 5 END AS source_path",
        "CASE WHEN event_id % 9 = 0 THEN 'PATH' ELSE 'TABLE' END AS source_type",
        f"{schema_of('user_id')} AS target_schema", f"{full_name('user_id')} AS target_table",
        "ts AS event_time", "event_id")


def column_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = pick(COLUMN_NAMES, f"l_linenumber % {len(COLUMN_NAMES)}")
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{full_name('l_partkey')} AS source_table", f"{name} AS source_column",
        f"{full_name('l_suppkey')} AS target_table",
        f"CASE WHEN l_partkey % 2 = 0 THEN {name} ELSE {name} || '_copy' END AS target_column")


SUFFIXES = ("", "_copy", "_hash")


def column_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column edges many steps deep: tables are numbered by order, each feeds the one of a sixteenth
    of its number, and some lead back. Names change on the way, and some tables are hubs."""
    name = pick(COLUMN_NAMES, f"l_linenumber % {len(COLUMN_NAMES)}")
    target = "if(l_partkey % 17 = 0, l_orderkey * 16, floor(l_orderkey / 16))"
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{full_name('l_orderkey')} AS source_table",
        f"{name} || {pick(SUFFIXES, 'l_partkey % 3')} AS source_column",
        f"{full_name(target)} AS target_table",
        f"{name} || {pick(SUFFIXES, 'int((l_partkey + l_suppkey) % 3)')} AS target_column")


def flow_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifications of one column of every third of those tables, and of one in ten a second."""
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").selectExpr("o_orderkey AS k", "0 AS j")
    more = table(spark, sf_dir, "orders").where("o_orderkey % 10 = 0").selectExpr("o_orderkey AS k", "3 AS j")
    return rows.unionByName(more).selectExpr(
        f"{schema_of('k')} AS table_schema", f"{table_of('k')} AS table_name",
        f"{pick(COLUMN_NAMES, f'(k + j) % {len(COLUMN_NAMES)}')} || {pick(SUFFIXES, 'floor(k / 7) % 3')} AS column_name",
        "'classification' AS tag_name",
        f"if(k % 97 = 0, 'secret', {pick(LEVELS, f'floor(k / 5) % {len(LEVELS)}')}) AS tag_value")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """member, group_name: every supplier as a person in one team, some with a group of their own."""
    people = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS k")
    return (people.selectExpr("'s' || k AS member", "'team' || k % 40 AS group_name")
            .unionByName(people.where("k % 9 = 0").selectExpr("'s' || k AS member", f"{pick(GRANTEES, f'k % {len(GRANTEES)}')} AS group_name"))
            .unionByName(people.where("k % 50 = 0").selectExpr("'s' || k AS member", f"'{OWNERS}' AS group_name")))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """group_name, parent: teams in departments, departments in the granted groups, one cycle."""
    people = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS k")
    return (people.selectExpr("'team' || k % 40 AS group_name", "'dept' || k % 8 AS parent")
            .unionByName(people.selectExpr("'dept' || k % 8 AS group_name", f"{pick(GRANTEES, f'k % 8 % {len(GRANTEES)}')} AS parent"))
            .unionByName(people.where("k % 40 = 3").selectExpr("'dept3' AS group_name", "'team3' AS parent"))
            .distinct())
