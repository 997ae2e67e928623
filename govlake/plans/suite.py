"""The state suite: one row `id, control, expected, actual, status` per control, read-only.

Expected values are design constants or relations, never row counts of one load. A control
that sees nothing fails: a minimum over no rows is NULL, and NULL is not a pass. The suite runs
as an exempt identity, so it proves nothing about access; persona reads do that.

Texts in `actual` list designed values that are present and count the others, so no control
collects an unbounded list; the rows behind a count come from the operator it is built on.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake import design
from govlake.design import CONSTRAINTS, GRANTS, K, LAYERS, OWNERS, ROUTINES, TAG_VOCABULARY
from govlake.functions.rows import literal
from govlake.operators import access, coverage, quality, tags
from govlake.principal import Principal


@dataclass(frozen=True)
class Meta:
    """The metadata relations the suite inspects."""

    schemata: DataFrame         # schema_name
    tables: DataFrame           # table_schema, table_name, table_type, table_owner
    columns: DataFrame          # table_schema, table_name, column_name, data_type, comment
    column_tags: DataFrame      # table_schema, table_name, column_name, tag_name, tag_value
    privileges: DataFrame       # see access.GRANT_SCHEMA
    routines: DataFrame         # routine_name
    constraints: DataFrame      # table_name, constraint_name, expression


def designed_meta(spark: SparkSession) -> Meta:
    """Metadata of a platform that matches the design exactly."""
    def split(table: str) -> list[str]:
        return table.split(".")

    objects = [(design.CATALOG, *split(t), "VIEW" if t in design.VIEWS else "MANAGED",
                "platform" if split(t)[1] in design.OWNER_EXCEPTIONS else OWNERS)
               for t in design.TABLES]
    cols = [(*split(t), c, kind, design.DESCRIPTIONS[c])
            for t, columns in design.TABLES.items() for c, kind in columns.items()]
    return Meta(
        schemata=literal(spark, [(s,) for s in LAYERS], "schema_name string"),
        tables=literal(spark, objects, "table_catalog string, table_schema string, "
                       "table_name string, table_type string, table_owner string"),
        columns=literal(spark, cols, "table_schema string, table_name string, "
                        "column_name string, data_type string, comment string"),
        column_tags=tags.designed_tags(spark),
        privileges=access.grant_rows(spark, GRANTS),
        routines=literal(spark, [(r,) for r in ROUTINES], "routine_name string"),
        constraints=quality.constraint_rows(spark, CONSTRAINTS))


@dataclass(frozen=True)
class Control:
    """One control over a one-row aggregate: what is shown, and when it passes."""

    id: str
    title: str
    expected: str
    actual: Column
    passed: Column

    def row(self) -> Column:
        return F.struct(
            F.lit(self.id).alias("id"), F.lit(self.title).alias("control"),
            F.lit(self.expected).alias("expected"), self.actual.cast("string").alias("actual"),
            F.when(self.passed, "PASS").otherwise("FAIL").alias("status"))


def emit(measured: DataFrame, *controls: Control, by: Sequence[str] = ()) -> DataFrame:
    """Controls that share a scan share one aggregate; each becomes a row."""
    return measured.select(*by, F.inline(F.array(*[c.row() for c in controls])))


def _zero(id_: str, title: str, column: str) -> Control:
    return Control(id_, title, "0", F.col(column), F.col(column) == 0)


class _Listing:
    """Distinct values against a designed list: which are there, and how many others.

    One flag per designed value, so nothing is collected however many values there are.
    """

    def __init__(self, name: str, column: str, allowed: Sequence[str], where: Column | None = None):
        self.name, self.allowed = name, sorted(allowed)
        value = F.col(column)
        self._value = value if where is None else F.when(where, value)

    def aggregates(self) -> list[Column]:
        seen = [F.coalesce(F.bool_or(self._value == v), F.lit(False)).alias(f"{self.name}{i}")
                for i, v in enumerate(self.allowed)]
        return [*seen, F.count_if(~self._value.isin(self.allowed)).alias(f"{self.name}_others")]

    def control(self, id_: str, title: str, all_required: bool) -> Control:
        others, flags = F.col(f"{self.name}_others"), [F.col(f"{self.name}{i}")
                                                       for i in range(len(self.allowed))]
        shown = [F.when(f, v) for f, v in zip(flags, self.allowed)]
        more = F.when(others > 0, F.concat(F.lit("+"), others.cast("string"), F.lit(" other")))
        passed = others == 0
        for flag in flags if all_required else ():
            passed = passed & flag
        return Control(id_, title, ", ".join(self.allowed), F.concat_ws(", ", *shown, more), passed)


# Each control below is an aggregate over metadata rows. `by` names columns that tell several states of
# the metadata apart: then there is a row per control and state, see plans/mutants.py.

def structure(meta: Meta, principal: Principal, by: Sequence[str] = (), exempt: Column | None = None
              ) -> list[DataFrame]:
    exempt = F.lit(principal.holds(OWNERS)) if exempt is None else exempt
    owned = _Listing("owned", "table_name", design.OWNER_EXCEPTIONS,
                     ~F.col("table_owner").eqNullSafe(OWNERS))
    layers = _Listing("layer", "schema_name", LAYERS)
    objects = meta.tables.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *owned.aggregates())
    schemas = meta.schemata.groupBy(*by).agg(F.count_if(F.col("schema_name") == "default").alias("strays"),
                                             *layers.aggregates())
    wanted = len(design.TABLES)
    return [
        emit(objects,
             Control("A0", "Suite runs as an exempt identity", f"a member of {OWNERS}",
                     F.concat(F.lit(f"{principal.name} | owner="), exempt.cast("string")), exempt),
             Control("A1", "Objects the suite can inspect", str(wanted), F.col("n"),
                     F.col("n") == wanted),
             owned.control("A4", "Objects owned outside the owner group", True), by=by),
        emit(schemas, layers.control("A2", "Schemas are those designed", True),
             _zero("A3", "No stray default schema", "strays"), by=by),
    ]


def classification(meta: Meta, by: Sequence[str] = ()) -> list[DataFrame]:
    tag, value = F.col("tag_name"), F.col("tag_value")
    levels = _Listing("level", "tag_value", TAG_VOCABULARY["classification"],
                      tag == "classification")
    pii = _Listing("pii", "tag_value", TAG_VOCABULARY["pii_type"], tag == "pii_type")
    retired = F.lit(False)
    for name, old in design.RETIRED_TAG_VALUES:
        retired = retired | ((tag == name) & (value == old))
    on_anonymized = ((F.col("table_schema") == "gold") & (tag == "pii_type")
                     & (F.col("table_name") == "customer_profile_anonymized"))
    used = meta.column_tags.groupBy(*by).agg(F.count_if(retired).alias("retired"),
                                             F.count_if(on_anonymized).alias("masked_gold"),
                                             *levels.aggregates(), *pii.aggregates())
    return [
        emit(coverage.totals(meta.columns, meta.column_tags, by),
             _zero("B1", "Columns without a classification", "missing_classification"),
             _zero("B2", "Columns without a description", "missing_description"), by=by),
        emit(used, levels.control("B3", "Classification values stay in the vocabulary", False),
             pii.control("B4", "PII type values stay in the vocabulary", False),
             _zero("B5", "Retired tag values are unused", "retired"),
             _zero("D6", "The anonymized table matches no mask", "masked_gold"), by=by),
    ]


def privileges(meta: Meta, expected: Sequence[tuple[str, str, str, str]] = GRANTS, by: Sequence[str] = (),
               states: Callable[[DataFrame], DataFrame] = lambda df: df) -> list[DataFrame]:
    """`states` repeats the designed rows for each state of the metadata that `by` tells apart."""
    spark = meta.privileges.sparkSession
    designed = states(access.grant_rows(spark, expected))
    held = meta.privileges.where(F.col("inherited_from") == "NONE")
    grant = access_text().alias("grant")
    sides = (held.select(*by, grant, F.lit(True).alias("held"))
             .unionByName(designed.select(*by, grant, F.lit(False).alias("held")))
             .groupBy(*by, "grant").agg(F.bool_or("held").alias("held"),
                                        F.bool_or(~F.col("held")).alias("designed")))
    counts = sides.groupBy(*by).agg(F.count_if("held").alias("seen"),
                                    F.count_if(~F.col("held")).alias("missing"),
                                    F.count_if(~F.col("designed")).alias("extra"))
    routines = _Listing("routine", "routine_name", ROUTINES)

    def none_or_count(column: str) -> Column:
        n = F.col(column)
        return F.when(n == 0, f"(none {column})").otherwise(
            F.concat(n.cast("string"), F.lit(f" {column}")))

    everyone = meta.privileges.groupBy(*by).agg(F.count_if(access.is_forbidden()).alias("n"))
    wanted = states(quality.constraint_rows(spark, CONSTRAINTS))
    rules = quality.constraint_diff(meta.constraints, wanted, by).groupBy(*by).agg(
        F.count_if(F.col("status") != "ok").alias("n"))
    return [
        emit(counts,
             Control("C0", "The grant scan sees the matrix", f">= {len(expected)}",
                     F.col("seen"), F.col("seen") >= len(expected)),
             Control("C1", "No designed grant is missing", "0 missing", none_or_count("missing"),
                     F.col("missing") == 0),
             Control("C2", "No grant exists outside the design", "0 extra",
                     none_or_count("extra"), F.col("extra") == 0), by=by),
        emit(everyone, _zero("C3", "No BROWSE for everyone on the catalog", "n"), by=by),
        emit(meta.routines.groupBy(*by).agg(*routines.aggregates()),
             routines.control("C4", "Governance functions are those designed", True), by=by),
        # by expression, not by name: a weakened rule keeps its name
        emit(rules, _zero("C5", "CHECK rules equal the design", "n"), by=by),
    ]


def data(counts: DataFrame, published: Mapping[str, DataFrame], k: int = K, by: Sequence[str] = ()) -> list[DataFrame]:
    """`counts`: one row per entity, as `quality.reconcile` gives. `published`: gold tables."""
    text = F.concat(F.col("silver_rows").cast("string"), F.lit(" + "),
                    F.col("quarantined").cast("string"), F.lit(" vs "),
                    F.col("bronze_rows").cast("string"))
    out = [counts.select(
        *by, F.when(F.col("tbl") == "customers", "D1").otherwise("D2").alias("id"),
        F.concat(F.lit("Nothing lost between bronze and silver: "), "tbl").alias("control"),
        F.lit("silver + quarantined = bronze").alias("expected"), text.alias("actual"),
        F.when(F.col("difference_must_be_zero") == 0, "PASS").otherwise("FAIL").alias("status"))]
    for id_, table, size in (("D3", "revenue_by_region_month", "customers_active"),
                             ("D4", "customer_segment_profile", "customers"),
                             ("D5", "customer_profile_anonymized", "people_in_group")):
        out.append(emit(published[table].groupBy(*by).agg(F.min(size).alias("n")), Control(
            id_, f"Smallest published group: {table}", f">= {k}", F.col("n"), F.col("n") >= k), by=by))
    return out


def run(meta: Meta, counts: DataFrame, published: Mapping[str, DataFrame], principal: Principal,
        k: int = K) -> DataFrame:
    """All controls as one relation."""
    rows = (structure(meta, principal) + classification(meta) + privileges(meta)
            + data(counts, published, k))
    out = rows[0]
    for row in rows[1:]:
        out = out.union(row)
    return out


def discover(meta: Meta) -> dict[str, DataFrame]:
    """What is there, before anything is asserted about it."""
    return {
        "schemata": meta.schemata,
        "tables": meta.tables,
        "coverage": coverage.matrix(meta.columns, meta.column_tags),
        "vocabulary": coverage.vocabulary(meta.column_tags),
        "grants": access.direct_grants(meta.privileges),
        "routines": meta.routines,
        "constraints": meta.constraints,
    }


# what each control of a whole catalog is about, in the order of the report
OFFENCES = {
    "A4": "Objects owned outside the owner group", "B1": "Columns without a classification",
    "B2": "Columns without a description", "B3": "Classification values stay in the vocabulary",
    "B4": "PII type values stay in the vocabulary", "B5": "Retired tag values are unused",
    "B6": "Tags belong to columns that exist", "C1": "No designed grant is missing",
    "C2": "No grant exists outside the design", "C3": "No BROWSE for everyone on the catalog",
    "C4": "Governance functions are those designed",
}


def offenders(meta: Meta, expected_grants: DataFrame) -> DataFrame:
    """control, offender: one row for each thing that makes a control fail, none where it passes.

    Nothing is counted, cut or gathered; tags are looked up in the vocabulary, columns met once."""
    column = F.concat_ws(".", "table_schema", "table_name", "column_name")
    tagged = F.concat(column, F.lit(": "), F.concat_ws("=", "tag_name", "tag_value"))
    tag, value, used = F.col("tag_name"), F.col("tag_value"), meta.column_tags

    def rows(id_: str, df: DataFrame, text: Column | str) -> DataFrame:
        return df.select(F.lit(id_).alias("control"), (F.col(text) if isinstance(text, str) else text).alias("offender"))

    def outside(id_: str, name: str) -> DataFrame:
        return rows(id_, used.where((tag == name) & ~value.isin(*TAG_VOCABULARY[name])), tagged)

    retired = F.lit(False)
    for name, old in design.RETIRED_TAG_VALUES:
        retired = retired | ((tag == name) & (value == old))
    foreign = ~F.col("table_owner").eqNullSafe(OWNERS) & ~F.col("table_name").isin(*design.OWNER_EXCEPTIONS)
    keys = ["table_schema", "table_name", "column_name"]
    grants = access.matrix_diff(access.direct_grants(meta.privileges), access.direct_grants(expected_grants))
    everyone = access.forbidden(meta.privileges).select(access_text().alias("offender")).distinct()
    wanted = literal(meta.routines.sparkSession, [(r,) for r in ROUTINES], "routine_name string")
    out = [
        rows("A4", meta.tables.where(foreign), F.concat_ws(".", "table_schema", "table_name")),
        rows("B1", coverage.untagged(meta.columns, used), column),
        rows("B2", coverage.undescribed(meta.columns), column),
        outside("B3", "classification"), outside("B4", "pii_type"),
        rows("B5", used.where(retired), tagged),
        rows("B6", used.join(meta.columns.select(*keys).distinct(), keys, "left_anti"), tagged),
        rows("C1", grants.where(F.col("side") == "missing"), "grant"),
        rows("C2", grants.where(F.col("side") == "extra"), "grant"),
        rows("C3", everyone, "offender"),
        rows("C4", meta.routines.join(wanted, "routine_name", "left_anti"), "routine_name"),
    ]
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def access_text() -> Column:
    return F.concat_ws(" | ", "grantee", "privilege_type", "object_type", "object_key")


def verdicts(found: DataFrame) -> DataFrame:
    """One row per control of OFFENCES: how many offenders it has, PASS or FAIL."""
    listed = literal(found.sparkSession, list(OFFENCES.items()), "id string, title string").select(
        F.col("id").alias("control"), "title", F.lit(0).cast("bigint").alias("n"))
    counted = found.groupBy("control").agg(F.count(F.lit(1)).alias("n"))
    return (listed.unionByName(counted.select("control", F.lit(None).cast("string").alias("title"), "n"))
            .groupBy("control").agg(F.max("title").alias("title"), F.sum("n").alias("offenders"))
            .withColumn("status", F.when(F.col("offenders") == 0, "PASS").otherwise("FAIL")))
