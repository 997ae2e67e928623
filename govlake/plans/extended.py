"""Queries that need more than one plan: fixpoints over relations, sums kept up to date, searches over
a lattice, and tables that are written, refused and changed. Registered beside the others."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake import design
from govlake.design import K, OWNERS, SENSITIVITY_RANK, Constraint, Expectation
from govlake.functions.rows import literal
from govlake.operators import access, anonymize, evolve, gold, graph, lineage, quality, tags
from govlake.plans import build, mutants
from govlake.plans import publish as pub
from govlake.plans.registry import PINNED, Layers, persona, register
from govlake.principal import AccessDenied, Principal
from govlake.session import cut, shared_folder
from govlake.sources import audit, fixture, fleet, ingest

SVC = Principal.of("svc", OWNERS)


# ---- fixpoints ------------------------------------------------------------------------------

_IDS = ", ".join(f"'{c}'" for c in lineage.IDENTIFIERS)


@register("lineage_identifier_reach", f"""
SELECT identifier, table_name, column_name, hops::INT AS hops, CASE WHEN kept THEN 'kept' ELSE 'renamed' END AS path_class
FROM (
  WITH RECURSIVE flow AS (SELECT DISTINCT * FROM ff WHERE source_table <> target_table OR source_column <> target_column),
  walk AS (
    SELECT DISTINCT source_column AS identifier, source_table AS t, source_column AS c, 0 AS hops, true AS kept
    FROM ff WHERE source_column IN ({_IDS})
    UNION
    SELECT w.identifier, f.target_table, f.target_column, w.hops + 1, w.kept AND f.source_column = f.target_column
    FROM walk w JOIN flow f ON f.source_table = w.t AND f.source_column = w.c WHERE w.hops < 24),
  least AS (SELECT *, min(hops) OVER (PARTITION BY identifier, t, c) AS m FROM walk)
  SELECT identifier, t AS table_name, c AS column_name, hops, bool_or(kept) AS kept
  FROM least WHERE hops = m AND hops > 0 GROUP BY ALL)""", "ff")
def _reach(spark, sf):
    return lineage.identifier_reach(fleet.column_flow(spark, sf))


_RANK = "CASE level " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in SENSITIVITY_RANK.items()) + " ELSE 0 END"
_LEVEL = "CASE {} " + " ".join(f"WHEN {n} THEN '{k}'" for k, n in SENSITIVITY_RANK.items()) + " END"


@register("tag_inheritance_gaps", f"""
SELECT split_part(t, '.', 1) AS table_schema, split_part(t, '.', 2) AS table_name, c AS column_name,
       {_LEVEL.format('own')} AS classification, {_LEVEL.format('best')} AS inherited
FROM (
  WITH RECURSIVE own AS (
    SELECT table_schema || '.' || table_name AS t, column_name AS c, max({_RANK}) AS r FROM ftag GROUP BY ALL),
  flow AS (SELECT DISTINCT * FROM ff),
  walk AS (
    SELECT t, c, r FROM own WHERE r > 0
    UNION
    SELECT f.target_table, f.target_column, w.r FROM walk w JOIN flow f ON f.source_table = w.t AND f.source_column = w.c)
  SELECT w.t, w.c, max(own.r) AS own, max(w.r) AS best FROM walk w LEFT JOIN own ON own.t = w.t AND own.c = w.c GROUP BY ALL)
WHERE own IS NULL OR own < best""", "ff", "ftag")
def _gaps(spark, sf):
    return tags.inheritance_gaps(fleet.column_flow(spark, sf), fleet.flow_tags(spark, sf))


@register("tag_inheritance_closed", """
SELECT count(DISTINCT table_schema || '.' || table_name || '.' || column_name) > 0 AS had_tags, 0::BIGINT AS gaps_left
FROM ftag""", "ftag")
def _closed(spark, sf):
    """Once every gap takes what it inherits, none is left."""
    flow, held = graph.plain(lineage.column_graph(fleet.column_flow(spark, sf))), fleet.flow_tags(spark, sf)
    raised = cut(tags.assign(held, tags.raise_along(flow, held)))
    return held.agg((F.count(F.lit(1)) > 0).alias("had_tags")).withColumn(
        "gaps_left", tags.gaps_along(flow, raised).agg(F.count(F.lit(1))).scalar())


def _lake(spark: SparkSession, *schemas: str) -> pub.Lake:
    """A lake of this query's own, in the shared folder."""
    lake = pub.Lake(spark, shared_folder(spark, "lake"), f"q{uuid.uuid4().hex[:12]}_")
    lake.create_schemas(*schemas)
    return lake


@register("table_tags_stored", """
SELECT table_schema, table_name, 'sensitivity' AS tag_name,
       CASE max(CASE tag_value WHEN 'internal' THEN 1 WHEN 'confidential' THEN 2 WHEN 'restricted' THEN 3 ELSE 0 END)
            WHEN 1 THEN 'internal' WHEN 2 THEN 'confidential' WHEN 3 THEN 'restricted' END AS tag_value
FROM (SELECT DISTINCT * FROM fg2 WHERE tag_name = 'classification'
      UNION ALL SELECT f.* FROM fg f WHERE tag_name = 'classification' AND NOT EXISTS (
        SELECT 1 FROM fg2 g WHERE g.table_schema = f.table_schema AND g.table_name = f.table_name
          AND g.column_name = f.column_name AND g.tag_name = 'classification'))
GROUP BY table_schema, table_name""", "fg", "fg2")
def _table_tags(spark, sf):
    """Column tags stored twice, the later state over the earlier; the tables' own tags read back."""
    lake = _lake(spark)
    for later in (False, True):
        lake.note(pub.TAGS, fleet.column_tags(spark, sf, later).where("tag_name = 'classification'"))
        pub.tag_tables(lake)
    return lake.held(pub.TABLE_TAGS)


# ---- access of members ----------------------------------------------------------------------

def _level(kind: str, key: str, *privileges: str) -> str:
    flags = ", ".join(f"bool_or(privilege_type IN ('{p}', 'ALL_PRIVILEGES')) AS {a}" for p, a in
                      (("USE_CATALOG", "uc"), ("USE_SCHEMA", "us"), ("SELECT", "sel"), ("BROWSE", "br")))
    return f"(SELECT member, object_key AS {key}, {flags} FROM held WHERE object_type = '{kind}' GROUP BY ALL)"


@register("effective_access_members", f"""
SELECT member, count(*) FILTER (owns OR browse OR (uc AND (us OR st))) AS objects_visible,
       count(*) FILTER (owns OR (uc AND us AND sel)) AS objects_readable
FROM (
  WITH RECURSIVE up AS (
    SELECT member, group_name AS g FROM fm
    UNION SELECT up.member, fgr.parent FROM up JOIN fgr ON fgr.group_name = up.g),
  names AS (SELECT * FROM up UNION SELECT member, member FROM fm UNION SELECT member, 'account users' FROM fm),
  held AS (SELECT DISTINCT member, privilege_type, object_type, object_key FROM fp JOIN names ON grantee = g)
  SELECT m.member, n.member IS NOT NULL OR r.member IS NOT NULL AS owns, coalesce(c.uc, false) AS uc,
         coalesce(s.us, false) OR coalesce(c.us, false) AS us, coalesce(t.sel, false) AS st,
         coalesce(t.sel, false) OR coalesce(s.sel, false) OR coalesce(c.sel, false) AS sel,
         coalesce(t.br, false) OR coalesce(s.br, false) OR coalesce(c.br, false) AS browse
  FROM (SELECT DISTINCT member FROM fm) m CROSS JOIN ft
  LEFT JOIN {_level('CATALOG', 'k1')} c ON c.member = m.member AND k1 = table_catalog
  LEFT JOIN {_level('SCHEMA', 'k2')} s ON s.member = m.member AND k2 = table_catalog || '.' || table_schema
  LEFT JOIN {_level('TABLE', 'k3')} t ON t.member = m.member AND k3 = table_catalog || '.' || table_schema || '.' || table_name
  LEFT JOIN (SELECT DISTINCT member, g FROM names) n ON n.member = m.member AND n.g = table_owner
  LEFT JOIN (SELECT DISTINCT member FROM names WHERE g = 'data_owners') r ON r.member = m.member)
GROUP BY member""", "ft", "fp", "fm", "fgr")
def _members(spark, sf):
    return access.access_of_members(fleet.tables(spark, sf), fleet.privileges(spark, sf),
                                    fleet.members(spark, sf), fleet.groups(spark, sf))


# ---- gold kept up to date -------------------------------------------------------------------

@register("gold_revenue_incremental", f"SELECT * FROM rev WHERE customers_active >= {K}", "rev")
def _incremental(spark, sf):
    """Stored sums of an earlier state, brought up to date by inserts, updates and deletes of orders
    and customers: the same as a recomputation from all rows."""
    at = Layers(spark, sf)
    number = F.substring("order_id", 2, 30).cast("bigint") % 10
    more = (F.col("amount") + 1000).cast("decimal(12,2)")
    right = ("amount", "status")
    wrong = (more.alias("amount"), F.when(more > 50_000, "completed").otherwise("refunded").alias("status"))
    # of each order: what was stored of it, twice or wrongly, and what has to change since
    versions = [(when, F.struct(F.lit(state).alias("state"), *version, F.lit(weight).alias("weight")))
                for state, when, version, weight in (
                    ("then", ~number.isin(3, 4), right, 1), ("then", number == 4, wrong, 1), ("then", number == 5, right, 1),
                    ("delta", number.isin(3, 4), right, 1), ("delta", number == 4, wrong, -1), ("delta", number == 5, right, -1))]
    orders = at.valid_orders().select("customer_id", "order_date", "currency", F.inline(F.array_compact(F.array(
        *(F.when(when, version) for when, version in versions)))))
    sums = cut(gold.partials(orders, "weight", "state"))    # orders are classified once for both
    parts, delta = (sums.where(F.col("state") == state).drop("state") for state in ("then", "delta"))
    person = F.substring("customer_id", 2, 30).cast("bigint")
    people = at.customers().select("customer_id", "region")
    moved, late, twice = person % 9 == 0, person % 11 == 0, person % 13 == 0
    elsewhere = people.where(moved).withColumn("region", F.when(F.col("region") == "asia", "europe").otherwise("asia"))
    early = people.where(~moved).unionByName(elsewhere)
    people_then = early.where(~late).unionByName(early.where(twice & ~late))
    came = (people.where(moved & ~late).unionByName(people.where(late))).withColumn("weight", F.lit(1))
    went = (elsewhere.where(~late).unionByName(early.where(twice & ~late))).withColumn("weight", F.lit(-1))

    home = cut(gold.homes(people_then))
    groups = cut(gold.revenue_state(parts, home))
    parts, groups = gold.apply_partials(parts, groups, home, delta)
    home, groups = gold.apply_customers(parts, groups, home, came.unionByName(went))
    return gold.published(groups, K).withColumn("order_month", F.col("order_month").cast("date"))


# ---- the lattice of generalisations ---------------------------------------------------------

#: Levels of each quasi-identifier: its name and the same value in DuckDB's and in Spark's words.
_LATTICE = {
    "age": (("year", "birth_year", "birth_year"), ("decade", "decade", "int(floor(birth_year / 10) * 10)"), ("any", "'*'", "'*'")),
    "place": (("country", "country", "country"), ("region", "region", "region"), ("any", "'*'", "'*'")),
    "segment": (("segment", "segment", "segment"), ("any", "'*'", "'*'")),
    "consent": (("consent", "marketing_consent", "marketing_consent"), ("any", "'*'", "'*'")),
}


def _lattice_sql() -> str:
    nodes = []
    for a, (an, ax, _) in enumerate(_LATTICE["age"]):
        for p, (pn, px, _) in enumerate(_LATTICE["place"]):
            for s, (sn, sx, _) in enumerate(_LATTICE["segment"]):
                for c, (cn, cx, _) in enumerate(_LATTICE["consent"]):
                    nodes.append(f"""SELECT 'age={an}, place={pn}, segment={sn}, consent={cn}' AS generalisation,
  {a} AS a, {p} AS p, {s} AS s, {c} AS c, count(*) AS combinations, min(n) AS smallest_group, sum(n)::BIGINT AS people
FROM (SELECT {ax} AS w, {px} AS x, {sx} AS y, {cx} AS z, count(*) AS n FROM people GROUP BY ALL)""")
    return f"""
WITH node AS ({' UNION ALL '.join(nodes)}), safe AS (SELECT * FROM node WHERE smallest_group >= {K})
SELECT generalisation, combinations, smallest_group, people FROM safe o WHERE NOT EXISTS (
  SELECT 1 FROM safe i WHERE i.a <= o.a AND i.p <= o.p AND i.s <= o.s AND i.c <= o.c AND i.generalisation <> o.generalisation)"""


@register("k_lattice", f"SELECT * FROM ({_lattice_sql()})", "people")
def _k_lattice(spark, sf):
    return anonymize.lattice(Layers(spark, sf).customers(),
                             {q: {name: F.expr(column) for name, _, column in levels} for q, levels in _LATTICE.items()}, K)


# ---- equality of whole tables ---------------------------------------------------------------

_PEOPLE = [c for c in design.TABLES["silver.customers"] if not c.startswith("_")]
_NUMBER = "substr(customer_id, 2)::BIGINT"
#: How each variant differs from silver customers, in DuckDB's words.
_VARIANTS = {
    "refill": "SELECT * FROM sc",
    "changed": f"SELECT * REPLACE (CASE WHEN {_NUMBER} % 500 = 7 THEN upper(city) ELSE city END AS city) FROM sc",
    "swapped": "SELECT * REPLACE (CASE WHEN customer_id = (SELECT min(customer_id) FROM sc) "
               "THEN (SELECT max_by(city, customer_id) FROM sc) WHEN customer_id = (SELECT max(customer_id) FROM sc) "
               "THEN (SELECT min_by(city, customer_id) FROM sc) ELSE city END AS city) FROM sc",
    "doubled": "SELECT * FROM sc UNION ALL SELECT * FROM sc WHERE customer_id = (SELECT min(customer_id) FROM sc)",
    "narrower": "SELECT * EXCLUDE (phone) FROM sc",
}


def _digest_sql() -> str:
    def text(columns, of):
        cells = " || '|' || ".join(f"coalesce({c}::VARCHAR, '~')" for c in columns)
        return f"(SELECT md5(string_agg({cells}, chr(10) ORDER BY {cells})) FROM {of})"
    rows = []
    for name in _VARIANTS:
        for c in _PEOPLE:
            same = "false" if name == "narrower" and c == "phone" else f"{text([c], 'sc')} = {text([c], f'v_{name}')}"
            rows.append(f"SELECT '{name}' AS variant, '{c}' AS item, {same} AS equal")
        same = "false" if name == "narrower" else f"{text(_PEOPLE, 'sc')} = {text(_PEOPLE, f'v_{name}')}"
        rows.append(f"SELECT '{name}', '*', {same}")
    made = ", ".join(f"v_{n} AS ({q})" for n, q in _VARIANTS.items())
    return f"SELECT * FROM (WITH {made} {' UNION ALL '.join(rows)})"


@register("refill_digest", _digest_sql(), "sc")
def _refill_digest(spark, sf):
    """Silver customers against a refill of other column order and against four damaged copies: one cell
    changed, two cells swapped, a row twice, a column lost."""
    sc = Layers(spark, sf).customers().select(*_PEOPLE)
    number = F.substring("customer_id", 2, 30).cast("bigint")
    ends = sc.agg(F.min("customer_id").alias("a"), F.max("customer_id").alias("z"), F.min_by("city", "customer_id").alias("ca"),
                  F.max_by("city", "customer_id").alias("cz"))
    first, last, city_first, city_last = (ends.select(c).scalar() for c in ("a", "z", "ca", "cz"))
    city = F.col("city")
    variants = {
        "refill": sc.select(*reversed(_PEOPLE)).repartition(5),
        "changed": sc.withColumn("city", F.when(number % 500 == 7, F.upper(city)).otherwise(city)),
        "swapped": sc.withColumn("city", F.when(F.col("customer_id") == first, city_last)
                                 .when(F.col("customer_id") == last, city_first).otherwise(city)),
        "doubled": sc.unionByName(sc.where(F.col("customer_id") == first)),
        "narrower": sc.drop("phone"),
    }
    out = None
    for name, df in variants.items():
        found = evolve.digest_diff(sc, df).select(F.lit(name).alias("variant"), "item", "equal")
        out = found if out is None else out.unionByName(found)
    return out


# ---- tables that are written, refused and changed -------------------------------------------

class Diary:
    """What a table held after each step, and what refused the steps that failed. The states are a few
    numbers for each step, taken at once."""

    def __init__(self, lake: pub.Lake, table: str, measures: Callable[[DataFrame], list], kind: str):
        self.lake, self.table, self.measures, self.kind = lake, table, measures, kind
        self.rows: list[tuple] = []

    def step(self, action: str, do: Callable[[], object] = lambda: None) -> None:
        refused = ""
        try:
            do()
        except (quality.ConstraintViolation, quality.UnsafeConstraint, quality.ExpectationFailed, pub.SchemaMismatch,
                evolve.MigrationRefused, AccessDenied, AnalysisException, ValueError) as wrong:
            refused = type(wrong).__name__
        held: tuple = (None,) * (len(self.kind.split(", ")))
        if self.lake.exists(self.table):
            df = self.lake.read(self.table)
            held = (", ".join(df.columns), *(df.agg(*self.measures(df)).first()))
        self.rows.append((len(self.rows) + 1, action, refused, *held))

    def report(self) -> DataFrame:
        return literal(self.lake.spark, self.rows, f"step int, action string, refused string, {self.kind}")


_ORDER = ["order_id", "customer_id", "order_date", "amount", "currency", "status", "card_number"]


def _orders_measured(df: DataFrame) -> list:
    day = next((c for c in ("order_date", "order_month") if c in df.columns), None)
    return [F.count(F.lit(1)), (F.sum("amount") * 100).cast("bigint"), F.count_if(F.col("status") == "completed"),
            F.count_if(F.col("status") == "cancelled"), F.count_distinct(day) if day else F.lit(0).cast("bigint")]


def _cycle_sql() -> str:
    every = ", ".join(_ORDER)
    no_card = ", ".join(c for c in _ORDER if c != "card_number")
    month = no_card.replace("order_date, ", "")
    steps = [
        ("publish", "", every, "s1"), ("append with negative amounts", "ConstraintViolation", every, "s1"),
        ("append of four columns", "", every, "s3"), ("update of one status", "", every, "s4"),
        ("update to an unknown status", "ConstraintViolation", every, "s4"), ("delete of old orders", "", every, "s6"),
        ("refill with another type", "SchemaMismatch", every, "s6"), ("refill in another order", "", every, "s1"),
        ("write as a masked reader", "AccessDenied", every, "s1"), ("add a column", "", f"{every}, order_year", "s1"),
        ("drop a column that a rule reads", "ValueError", f"{every}, order_year", "s1"),
        ("drop two columns", "", no_card, "s1"), ("migrate with a wrong derivation", "MigrationRefused", no_card, "s1"),
        ("migrate to months", "", f"{month}, order_month", "s7"), ("migrate again", "MigrationRefused", f"{month}, order_month", "s7"),
        ("drop a schema that is not empty", "AnalysisException", f"{month}, order_month", "s7"),
        ("drop the table", "", None, None), ("drop the empty schema", "", None, None)]
    rows = []
    for i, (action, refused, columns, state) in enumerate(steps, 1):
        held = "NULL::VARCHAR, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT" if state is None else (
            f"'{columns}', count(*), (sum(amount) * 100)::BIGINT, count(*) FILTER (status = 'completed'), "
            "count(*) FILTER (status = 'cancelled'), count(DISTINCT order_date)")
        rows.append(f"SELECT {i}::INT AS step, '{action}' AS action, '{refused}' AS refused, {held} {'FROM ' + state if state else ''}")
    first = ", ".join(f"{h} AS {n}" for h, n in zip(
        ("'" + every + "'", "count(*)", "(sum(amount) * 100)::BIGINT", "count(*) FILTER (status = 'completed')",
         "count(*) FILTER (status = 'cancelled')", "count(DISTINCT order_date)"),
        ("columns", "n_rows", "cents", "completed", "cancelled", "dates"), strict=True))
    rows[0] = f"SELECT 1::INT AS step, 'publish' AS action, '' AS refused, {first} FROM s1"
    return f"""SELECT * FROM (
WITH s1 AS (SELECT order_date, amount, currency, status FROM so),
s3 AS (SELECT * FROM s1 UNION ALL SELECT NULL, amount, NULL, status FROM s1 WHERE currency = 'EUR'),
s4 AS (SELECT * REPLACE (CASE WHEN status = 'refunded' AND amount > 100000 THEN 'cancelled' ELSE status END AS status) FROM s3),
s6 AS (SELECT * FROM s4 WHERE order_date >= DATE '1994-01-01' OR order_date IS NULL),
s7 AS (SELECT * REPLACE (date_trunc('month', order_date) AS order_date) FROM s1)
{' UNION ALL '.join(rows)})"""


@register("write_cycle", _cycle_sql(), "so")
def _write_cycle(spark, sf):
    """One table through all writes: published, appended, updated, deleted from, refilled by name, reshaped,
    migrated, dropped; each refusal leaves the state before it."""
    lake, table = _lake(spark, "silver"), "silver.orders"
    orders = cut(Layers(spark, sf).orders().select(*_ORDER))
    d = Diary(lake, table, _orders_measured, "columns string, n_rows bigint, cents bigint, completed bigint, cancelled bigint, dates bigint")
    for rule in design.CONSTRAINTS:
        if rule.table == table and rule.name in ("amount_non_negative", "status_known"):
            pub.add_constraint(lake, rule, SVC)
    d.step("publish", lambda: pub.publish(lake, orders, table, SVC))
    d.step("append with negative amounts", lambda: pub.append(
        lake, orders.withColumn("amount", (-F.col("amount") - 1).cast("decimal(12,2)")), table, SVC))
    d.step("append of four columns", lambda: pub.append(
        lake, orders.where("currency = 'EUR'").select(F.concat(F.lit("A"), "order_id").alias("order_id"), "customer_id", "amount", "status"),
        table, SVC))
    d.step("update of one status", lambda: pub.update(
        lake, table, "status", F.lit("cancelled"), SVC, (F.col("status") == "refunded") & (F.col("amount") > 100_000)))
    d.step("update to an unknown status", lambda: pub.update(lake, table, "status", F.lit("shipped"), SVC, F.col("currency") == "USD"))
    d.step("delete of old orders", lambda: pub.delete(lake, table, F.col("order_date") < "1994-01-01", SVC))
    d.step("refill with another type", lambda: pub.publish(lake, orders.withColumn("amount", F.col("amount").cast("string")), table, SVC))
    d.step("refill in another order", lambda: pub.publish(lake, orders.select(*reversed(_ORDER)), table, SVC))
    d.step("write as a masked reader", lambda: pub.delete(lake, table, F.lit(True), persona("analyst")))
    d.step("add a column", lambda: pub.add_column(lake, table, "order_year", F.year("order_date"), SVC))
    d.step("drop a column that a rule reads", lambda: pub.drop_column(lake, table, "status", SVC))

    def two():
        pub.drop_column(lake, table, "order_year", SVC)
        pub.drop_column(lake, table, "card_number", SVC)

    d.step("drop two columns", two)
    month = F.trunc("order_date", "month")
    d.step("migrate with a wrong derivation", lambda: pub.migrate(
        lake, table, "order_date", "order_month", month, SVC, derivation=F.last_day("order_date")))
    again = lambda: pub.migrate(lake, table, "order_date", "order_month", month, SVC,
                                derivation=F.make_date(F.year("order_date"), F.month("order_date"), F.lit(1)))
    d.step("migrate to months", again)
    d.step("migrate again", again)
    d.step("drop a schema that is not empty", lambda: lake.drop_schema("silver"))
    d.step("drop the table", lambda: lake.drop(table))
    d.step("drop the empty schema", lambda: lake.drop_schema("silver"))
    return d.report()


_MINOR = Constraint("born_before_2000", "silver.customers", "birth_year < 2000")
_FEW = ["customer_id", "email", "region", "birth_year"]


def _lifecycle_sql() -> str:
    steps = [("publish", "", "", "a"), ("a rule that stored rows break", "ConstraintViolation", "", "a"),
             ("delete the rows that break it", "", "", "b"), ("add the rule", "", "born_before_2000", "b"),
             ("add it twice", "ValueError", "born_before_2000", "b"),
             ("a rule on the current date", "UnsafeConstraint", "born_before_2000", "b"),
             ("append rows that break it", "ConstraintViolation", "born_before_2000", "b"),
             ("drop its column", "ValueError", "born_before_2000", "b"), ("drop the rule", "", "", "b"),
             ("drop it twice", "ValueError", "", "b"), ("a build offers its rules again", "", "", "b"),
             ("append rows that broke it", "", "", "a"), ("add the rule to such rows", "ConstraintViolation", "", "a")]
    rows = [f"SELECT {i}::INT AS step, '{a}' AS action, '{r}' AS refused, '{', '.join(_FEW)}' AS columns, count(*) AS n_rows, "
            f"count(*) FILTER (birth_year >= 2000) AS breaking, '{rules}' AS rules FROM {state}"
            for i, (a, r, rules, state) in enumerate(steps, 1)]
    return f"SELECT * FROM (WITH a AS (SELECT * FROM sc), b AS (SELECT * FROM sc WHERE birth_year < 2000 OR birth_year IS NULL) {' UNION ALL '.join(rows)})"


@register("constraint_lifecycle", _lifecycle_sql(), "sc")
def _constraint_lifecycle(spark, sf):
    """A rule added, refused, enforced, dropped: dropped rules stay dropped when a build comes again."""
    lake, table = _lake(spark, "silver"), "silver.customers"
    people = cut(Layers(spark, sf).customers().select(*_FEW))

    def measured(df):
        rules = ", ".join(r.name for r in lake.rules(table))
        return [F.count(F.lit(1)), F.count_if(F.col("birth_year") >= 2000), F.lit(rules)]

    d = Diary(lake, table, measured, "columns string, n_rows bigint, breaking bigint, rules string")
    late = people.where("birth_year >= 2000")
    d.step("publish", lambda: pub.publish(lake, people, table, SVC))
    d.step("a rule that stored rows break", lambda: pub.add_constraint(lake, _MINOR, SVC))
    d.step("delete the rows that break it", lambda: pub.delete(lake, table, F.col("birth_year") >= 2000, SVC))
    d.step("add the rule", lambda: pub.add_constraint(lake, _MINOR, SVC))
    d.step("add it twice", lambda: pub.add_constraint(lake, _MINOR, SVC))
    d.step("a rule on the current date", lambda: pub.add_constraint(
        lake, Constraint("not_unborn", table, "birth_year <= year(current_date())"), SVC))
    d.step("append rows that break it", lambda: pub.append(lake, late, table, SVC))
    d.step("drop its column", lambda: pub.drop_column(lake, table, "birth_year", SVC))
    d.step("drop the rule", lambda: pub.drop_constraint(lake, table, _MINOR.name, SVC))
    d.step("drop it twice", lambda: pub.drop_constraint(lake, table, _MINOR.name, SVC))
    d.step("a build offers its rules again", lambda: lake.note_new(pub.RULES, quality.constraint_rows(spark, [_MINOR])))
    d.step("append rows that broke it", lambda: pub.append(lake, late, table, SVC))
    d.step("add the rule to such rows", lambda: pub.add_constraint(lake, _MINOR, SVC))
    return d.report()


_BUILD_RULES = (Expectation("amount_present", "amount IS NOT NULL", "observe"),
                Expectation("not_cancelled", "status <> 'cancelled'", "drop"),
                Expectation("order_id_present", "order_id IS NOT NULL", "fail"))


@register("fail_update_refused", """
SELECT * FROM (
WITH t AS (SELECT amt, lower(trim(status)) AS status FROM typed), kept AS (SELECT * FROM t WHERE status <> 'cancelled')
SELECT 1::INT AS step, 'publish' AS action, '' AS refused, 'order_id, amount, status' AS columns, count(*) AS n_rows,
       count(*) FILTER (amt IS NULL) AS without_amount FROM kept
UNION ALL SELECT 2, 'refill with rows that have no key', 'ExpectationFailed', 'order_id, amount, status', count(*),
       count(*) FILTER (amt IS NULL) FROM kept
UNION ALL SELECT 3, 'refill where the rule only drops', '', 'order_id, amount, status', count(*), count(*) FILTER (amt IS NULL)
FROM kept WHERE status <> 'refunded'
UNION ALL SELECT 4, 'offered, without amount, cancelled, without key', '', '', count(*), count(*) FILTER (amt IS NULL) FROM t
UNION ALL SELECT 5, 'dropped', '', '', count(*) FILTER (status = 'cancelled'), 0 FROM t)""", "typed")
def _fail_update_refused(spark, sf):
    """A build step with all three modes: a fail-mode rule refuses the whole refill, the table and its
    counts stay as they were."""
    lake, table = _lake(spark, "silver"), "silver.kept_orders"
    rows = cut(Layers(spark, sf).typed_orders().select("order_id", "amount", "status"))
    broken = rows.withColumn("order_id", F.when(F.col("status") != "refunded", F.col("order_id")))
    reports = []
    d = Diary(lake, table, lambda df: [F.count(F.lit(1)), F.count_if(F.col("amount").isNull())],
              "columns string, n_rows bigint, without_amount bigint")
    d.step("publish", lambda: reports.append(pub.publish(lake, rows, table, SVC, expectations=_BUILD_RULES)))
    d.step("refill with rows that have no key", lambda: pub.publish(lake, broken, table, SVC, expectations=_BUILD_RULES))
    softer = (*_BUILD_RULES[:2], Expectation("order_id_present", "order_id IS NOT NULL", "drop"))
    d.step("refill where the rule only drops", lambda: pub.publish(lake, broken, table, SVC, expectations=softer))
    got = reports[0].metrics
    d.rows.append((4, "offered, without amount, cancelled, without key", "", "", got["total"], got["failed_amount_present"]))
    d.rows.append((5, "dropped", "", "", got["failed_not_cancelled"], got["failed_order_id_present"]))
    return d.report()


@register("landing_report", f"""
SELECT count(*) AS n_rows, count(*) FILTER ({_NUMBER} % 10 = 0) AS rescued_rows,
       count(*) AS stamped_rows, true AS files_listed, true AS bytes_counted,
       count(*) FILTER ({_NUMBER} % 10 = 0) AS rescued_with_key
FROM bc""", "bc")
def _landing(spark, sf):
    """Landing files in which every tenth line has a field too many: the line keeps its good prefix and is
    rescued whole, every row is stamped, and the folder's files are listed without being read."""
    folder = shared_folder(spark, "landing")
    rows = Layers(spark, sf).bronze_customers().select("customer_id", "city")
    extra = F.when(F.substring("customer_id", 2, 30).cast("bigint") % 10 == 0, F.lit(",more")).otherwise("")
    lines = rows.select(F.concat("customer_id", F.lit(","), "city", extra).alias("value"))
    header = spark.createDataFrame([("customer_id,city",)], "value string")
    # every file starts with its header
    lines.repartition(4).sortWithinPartitions(F.col("value")).write.text(f"{folder}/lines")
    (spark.read.text(f"{folder}/lines", wholetext=True)
     .select(F.concat(F.lit(header.first().value + "\n"), "value").alias("value")).write.text(f"{folder}/csv"))
    got = ingest.read_csv_all_string(spark, f"{folder}/csv", ["customer_id", "city"], PINNED)
    listed = ingest.list_landing(spark, f"{folder}/csv").where("path LIKE '%part-%'").agg(
        (F.count(F.lit(1)) > 0).alias("files"), F.min(F.col("bytes") > 0).alias("bytes"))
    rescued = F.col(ingest.RESCUED).isNotNull()
    return got.where("customer_id is not null").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(rescued).alias("rescued_rows"),
        F.count_if(F.col("_ingested_at") == F.lit(PINNED).cast("timestamp")).alias("stamped_rows"),
        listed.select("files").scalar().alias("files_listed"), listed.select("bytes").scalar().alias("bytes_counted"),
        F.count_if(rescued & F.col(ingest.RESCUED).startswith("C")).alias("rescued_with_key"))


# ---- the suite, put to the test -------------------------------------------------------------

def _built(spark, sf) -> build.Build:
    """The whole platform built from the test tables, in a lake of its own."""
    at, outside = Layers(spark, sf), _lake(spark, "events")
    events = audit.from_test_events(fixture.table(spark, sf, "events")).withColumn(
        "request_params", F.create_map(F.lit("table"), F.lit(f"{design.CATALOG}.silver.orders")))
    pub.publish(outside, events, "events.audit", SVC)
    return build.run(_lake(spark), at.bronze_customers(), at.bronze_orders(), SVC, PINNED,
                     audit_source=f"{outside.env}events.audit")


@register("suite_mutants", f"""
SELECT mutant, control, fires OR (control = 'D3' AND NOT EXISTS (SELECT 1 FROM rev WHERE customers_active >= {K}))
  OR (control = 'D4' AND NOT EXISTS (SELECT 1 FROM sc GROUP BY region, segment HAVING count(*) >= {K}))
  OR (control = 'D5' AND NOT EXISTS (SELECT 1 FROM anon)) AS fired
FROM (VALUES {", ".join(f"('{m}', '{c}', {str(fires).lower()})" for m, c, fires in mutants.expected())}) v(mutant, control, fires)""",
          "rev", "sc", "anon")
def _suite_mutants(spark, sf):
    """Every control over the metadata of a real build, and over each of its mutants: it fires on the fault that
    it is for and on no other."""
    b = _built(spark, sf)
    published = {t: b.lake.read(f"gold.{t}") for t in ("revenue_by_region_month", "customer_segment_profile",
                                                       "customer_profile_anonymized")}
    return mutants.matrix(b.meta(access.grant_rows(spark, design.GRANTS)), build.reconciliation(b.lake), published, SVC)


@register("build_metadata", """
SELECT * FROM (VALUES ('bronze', 2::BIGINT, true, true), ('gold', 3, true, true), ('governance', 1, true, true), ('silver', 4, true, true))
v(table_schema, objects, columns_typed, tables_tagged)""")
def _build_metadata(spark, sf):
    """What the books of a build say: its objects, that every column has a type, that every table has its own tag."""
    b = _built(spark, sf)
    typed = b.lake.held(pub.COLUMNS).groupBy("table_schema", "table_name").agg(
        F.bool_and(F.col("data_type") != "").alias("typed"))
    tagged = b.lake.held(pub.TABLE_TAGS).select("table_schema", "table_name", F.col("tag_value").isNotNull().alias("tagged"))
    keys = ["table_schema", "table_name"]
    return (b.lake.held(pub.OBJECTS).join(typed, keys, "left").join(tagged, keys, "left").groupBy("table_schema")
            .agg(F.count(F.lit(1)).alias("objects"), F.bool_and(F.coalesce("typed", F.lit(False))).alias("columns_typed"),
                 F.bool_and(F.coalesce("tagged", F.lit(False))).alias("tables_tagged")))
