"""Does every control of the state suite fire, and on nothing else? Seeded faults, carried as rows.

A mutant is a fault in one relation of the metadata. Each relation is repeated once for itself and
once for each of its mutants, with the fault applied to those rows; the controls then run once, by
mutant, so the whole matrix of controls and mutants is one plan over metadata rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.functions.rows import literal
from govlake.plans import suite
from govlake.principal import Principal

#: The metadata as it is.
NONE = "none"


@dataclass(frozen=True)
class Mutant:
    """A fault: rows that go, columns that change where a condition holds, or rows that come. `fires` are the controls
    that have to fail, and no other may."""

    name: str
    relation: str
    fires: tuple[str, ...]
    gone: str = "false"
    changed: Mapping[str, str] = field(default_factory=dict)
    added: Mapping[str, str] | None = None      # column -> SQL value of one new row; others are null


MUTANTS = (
    Mutant("masked_runner", "principal", ("A0",), changed={"exempt": "false"}),
    Mutant("object_lost", "tables", ("A1",), gone="table_schema = 'silver' AND table_name = 'orders'"),
    Mutant("schema_lost", "schemata", ("A2",), gone="schema_name = 'landing'"),
    Mutant("default_schema", "schemata", ("A2", "A3"), added={"schema_name": "'default'"}),
    Mutant("foreign_owner", "tables", ("A4",), changed={"table_owner": "if(table_name = 'quarantine_orders', 'me', table_owner)"}),
    Mutant("class_lost", "column_tags", ("B1",),
           gone="table_name = 'orders' AND table_schema = 'silver' AND column_name = 'amount' AND tag_name = 'classification'"),
    Mutant("text_lost", "columns", ("B2",), changed={"comment": "if(column_name = 'city', '', comment)"}),
    Mutant("new_level", "column_tags", ("B3",), added={
        "table_schema": "'silver'", "table_name": "'orders'", "column_name": "'amount'", "tag_name": "'classification'", "tag_value": "'secret'"}),
    Mutant("new_pii_type", "column_tags", ("B4",), added={
        "table_schema": "'silver'", "table_name": "'orders'", "column_name": "'amount'", "tag_name": "'pii_type'", "tag_value": "'iris'"}),
    Mutant("retired_value", "column_tags", ("B4", "B5"), added={
        "table_schema": "'silver'", "table_name": "'orders'", "column_name": "'amount'", "tag_name": "'pii_type'", "tag_value": "'dob_date'"}),
    Mutant("masked_gold", "column_tags", ("D6",), added={
        "table_schema": "'gold'", "table_name": "'customer_profile_anonymized'", "column_name": "'region'", "tag_name": "'pii_type'",
        "tag_value": "'name'"}),
    Mutant("blind_scan", "privileges", ("C0", "C1"), changed={"inherited_from": "'CATALOG'"}),
    Mutant("grant_swapped", "privileges", ("C1", "C2"),
           changed={"privilege_type": "if(grantee = 'auditor' AND privilege_type = 'SELECT', 'MODIFY', privilege_type)"}),
    Mutant("grant_added", "privileges", ("C2",), added={
        "grantee": "'contractor'", "privilege_type": "'SELECT'", "object_type": "'CATALOG'", "object_key": "'prod'", "inherited_from": "'NONE'"}),
    Mutant("browse_for_all", "privileges", ("C2", "C3"), added={
        "grantee": "'account users'", "privilege_type": "'BROWSE'", "object_type": "'CATALOG'", "object_key": "'prod'", "inherited_from": "'NONE'"}),
    Mutant("function_lost", "routines", ("C4",), gone="routine_name = 'mask_last4'"),
    Mutant("rule_weakened", "constraints", ("C5",), changed={"expression": "if(constraint_name = 'amount_non_negative', 'true', expression)"}),
    Mutant("rule_lost", "constraints", ("C5",), gone="constraint_name = 'status_known'"),
    Mutant("customer_lost", "counts", ("D1",), changed={
        "silver_rows": "if(tbl = 'customers', silver_rows - 1, silver_rows)",
        "difference_must_be_zero": "if(tbl = 'customers', -1, difference_must_be_zero)"}),
    Mutant("order_lost", "counts", ("D2",), changed={
        "silver_rows": "if(tbl = 'orders', silver_rows - 1, silver_rows)",
        "difference_must_be_zero": "if(tbl = 'orders', -1, difference_must_be_zero)"}),
    Mutant("small_revenue_group", "revenue_by_region_month", ("D3",), changed={"customers_active": "4"}),
    Mutant("small_segment", "customer_segment_profile", ("D4",), changed={"customers": "4"}),
    Mutant("small_profile", "customer_profile_anonymized", ("D5",), changed={"people_in_group": "4"}),
)


def seeded(df: DataFrame, mutants: list[Mutant]) -> DataFrame:
    """Each row once as it is and once for each mutant, with that mutant's fault; column `mutant`."""
    names = F.array(*(F.lit(m.name) for m in mutants), F.lit(NONE))
    rows = df.withColumn("mutant", F.explode(names))
    for m in mutants:
        rows = rows.where(~((F.col("mutant") == m.name) & F.coalesce(F.expr(m.gone), F.lit(False))))
    for column, kind in df.dtypes:
        value = F.col(column)
        for m in mutants:
            if column in m.changed:
                value = F.when(F.col("mutant") == m.name, F.expr(m.changed[column]).cast(kind)).otherwise(value)
        rows = rows.withColumn(f"_{column}", value)
    rows = rows.select(*(F.col(f"_{c}").alias(c) for c in df.columns), "mutant")
    one = df.sparkSession.range(1)
    for m in mutants:
        if m.added:
            rows = rows.unionByName(one.select(*(F.expr(m.added.get(c, "null")).cast(t).alias(c) for c, t in df.dtypes),
                                               F.lit(m.name).alias("mutant")))
    return rows


def matrix(meta: suite.Meta, counts: DataFrame, published: Mapping[str, DataFrame], principal: Principal,
           mutants: tuple[Mutant, ...] = MUTANTS) -> DataFrame:
    """mutant, control, fired: every control on every mutant and on the metadata as it is.

    A control whose relations a mutant leaves alone says what it says of the metadata as it is.
    """
    of = {m: [x for x in mutants if x.relation == m] for m in {x.relation for x in mutants}}
    by = ["mutant"]

    def own(*relations: str) -> list[Mutant]:
        return [m for r in relations for m in of.get(r, [])]

    def grown(df: DataFrame, relation: str, *others: str) -> DataFrame:
        """The relation with its own faults, and as it is for the mutants of the relations it meets."""
        rows = seeded(df, own(relation))
        rest = [m.name for m in own(*others)]
        return rows.unionByName(df.withColumn("mutant", F.explode(F.array(*map(F.lit, rest))))) if rest else rows

    def states(df: DataFrame) -> DataFrame:
        names = [m.name for m in own("privileges", "constraints")] + [NONE]
        return df.withColumn("mutant", F.explode(F.array(*map(F.lit, names))))

    exempt = F.col("mutant").isin([m.name for m in own("principal")])
    seen = suite.Meta(
        schemata=grown(meta.schemata, "schemata"), tables=grown(meta.tables, "tables", "principal"),
        columns=grown(meta.columns, "columns", "column_tags"), column_tags=grown(meta.column_tags, "column_tags", "columns"),
        privileges=grown(meta.privileges, "privileges", "constraints"), routines=grown(meta.routines, "routines"),
        constraints=grown(meta.constraints, "constraints", "privileges"))
    parts = (suite.structure(seen, principal, by, ~exempt & F.lit(principal.holds(suite.OWNERS)))
             + suite.classification(seen, by) + suite.privileges(seen, by=by, states=states)
             + suite.data(grown(counts, "counts"), {t: grown(df, t) for t, df in published.items()}, by=by))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    verdict = found.select("mutant", F.col("id").alias("control"), (F.col("status") != "PASS").alias("fired"))
    # what a mutant does not touch is as it was, and a control that sees nothing fails
    plain = verdict.where(F.col("mutant") == NONE).select("control", F.col("fired").alias("before"))
    grid = literal(meta.tables.sparkSession, [(m, c) for m, c, _ in expected(mutants)], "mutant string, control string")
    return (grid.join(verdict, ["mutant", "control"], "left").join(plain, "control", "left")
            .select("mutant", "control", F.coalesce("fired", "before", F.lit(True)).alias("fired")))


#: Every control of the suite.
CONTROLS = ("A0", "A1", "A2", "A3", "A4", "B1", "B2", "B3", "B4", "B5", "C0", "C1", "C2", "C3", "C4", "C5",
            "D1", "D2", "D3", "D4", "D5", "D6")


def expected(mutants: tuple[Mutant, ...] = MUTANTS) -> list[tuple[str, str, bool]]:
    """mutant, control, fires: what the matrix has to be where every relation has rows."""
    return [(m, c, c in fires) for m, fires in [(NONE, ()), *((x.name, x.fires) for x in mutants)] for c in CONTROLS]
