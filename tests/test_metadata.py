"""Tags, coverage, privileges, snapshots, lineage."""

import datetime as dt

import pytest

from support import rows
from govlake import design
from govlake.design import GRANTS, OWNERS, PERSONAS
from govlake.operators import access, coverage, evolve, lineage, tags
from govlake.plans.registry import persona
from govlake.plans.suite import designed_meta
from govlake.principal import Principal


@pytest.fixture(scope="module")
def meta(spark):
    return designed_meta(spark)


def test_design_totals(meta):
    use = {(r.tag_name, r.tag_value): r.columns_using for r in coverage.vocabulary(
        meta.column_tags.where("table_schema <> 'governance'")).collect()}
    assert [use["classification", v] for v in ("confidential", "internal", "restricted")] == [15, 62, 25]
    bronze = coverage.matrix(meta.columns, meta.column_tags).where("table_schema = 'bronze'")
    assert rows(bronze, "table_name", "columns_total") == [("customers", 17), ("orders", 9)]
    pii = meta.column_tags.where("table_schema = 'bronze' and tag_name = 'pii_type'").count()
    assert pii == 10


def test_missing_tag_is_reported_as_exactly_that_column(meta):
    assert coverage.untagged(meta.columns, meta.column_tags).count() == 0
    one_less = tags.unset_tags(meta.column_tags, "bronze.customers", "segment", "classification")
    assert rows(coverage.untagged(meta.columns, one_less)) == [("bronze", "customers", "segment")]
    restored = tags.set_tags(one_less, "bronze.customers", "segment", {"classification": "internal"})
    assert coverage.untagged(meta.columns, restored).count() == 0


def test_empty_and_null_descriptions_both_count(spark):
    cols = spark.createDataFrame([("s", "t", "a", None), ("s", "t", "b", ""), ("s", "t", "c", "text")],
                                 "table_schema string, table_name string, column_name string, comment string")
    assert rows(coverage.undescribed(cols), "column_name") == [("a",), ("b",)]
    none = spark.createDataFrame([], tags.TAG_SCHEMA)
    assert rows(coverage.matrix(cols, none)) == [("s", "t", 3, 3, 2)]


def test_set_tags_replaces_and_validates(spark):
    meta = spark.createDataFrame([("s", "t", "c", "pii_type", "name")], tags.TAG_SCHEMA)
    after = tags.set_tags(meta, "s.t", "c", {"pii_type": "email", "classification": "restricted"})
    assert rows(after, "tag_name", "tag_value") == [("classification", "restricted"), ("pii_type", "email")]
    with pytest.raises(tags.TagValueNotAllowed, match="'secret'.*'classification'.*internal"):
        tags.set_tags(meta, "s.t", "c", {"classification": "secret"})


def test_table_sensitivity_is_the_highest(meta):
    got = dict(rows(tags.table_sensitivity(meta.column_tags.where("table_schema = 'gold'")),
                    "table_name", "classification"))
    assert set(got.values()) == {"internal"}
    assert dict(rows(tags.table_sensitivity(meta.column_tags), "table_name", "classification"))["orders"] == "restricted"


def test_fresh_copy_has_no_tags_until_propagated(spark):
    src = tags.designed_tags(spark, "bronze.customers")
    assert coverage.tagged_columns(src).where("table_name = 'copy'").count() == 0
    both = tags.propagate(src, "bronze.customers", "silver.copy", {"mail": "email", "region": "region"})
    assert rows(both.where("table_name = 'copy'"), "column_name", "tag_name", "tag_value") == [
        ("mail", "classification", "restricted"), ("mail", "pii_type", "email"),
        ("region", "classification", "internal"), ("region", "filter_key", "region")]
    stmt = {r.column_name: r.stmt for r in tags.statements(src).collect()}
    assert stmt["email"] == ("ALTER TABLE bronze.customers ALTER COLUMN email SET TAGS "
                             "('classification' = 'restricted', 'pii_type' = 'email');")


def test_ownership_with_a_named_exception(meta):
    got = coverage.ownership_exceptions(meta.tables, OWNERS, design.OWNER_EXCEPTIONS)
    assert rows(got) == [("governance", "audit_log", "platform", True)]


EXPECTED_SCHEMAS = {
    "owner": {"bronze", "gold", "governance", "silver"},
    "analyst": {"gold", "silver"},
    "analyst_eu": {"gold", "silver"},
    "data_engineer": {"bronze", "gold", "silver"},
    "auditor": {"bronze", "gold", "governance", "silver"},
    "nobody": set(),
}


@pytest.mark.parametrize("who", sorted(PERSONAS))
def test_visible_schemas_per_persona(meta, who):
    seen = access.visible_schemas(meta.tables, meta.privileges, persona(who))
    assert {r.table_schema for r in seen.collect()} == EXPECTED_SCHEMAS[who]


@pytest.mark.parametrize("who", sorted(PERSONAS))
def test_relation_and_single_table_rule_agree(meta, who):
    owners = {(r.table_schema, r.table_name): r.table_owner for r in meta.tables.collect()}
    for r in access.effective(meta.tables, meta.privileges, persona(who)).collect():
        assert r.missing_level == access.missing_level(
            GRANTS, persona(who), r.table_catalog, r.table_schema, r.table_name,
            owners[r.table_schema, r.table_name])


def test_auditor_sees_everything_and_reads_one_view(meta):
    got = access.effective(meta.tables, meta.privileges, persona("auditor"))
    assert got.where("can_see").count() == 10
    assert rows(got.where("can_read"), "table_name") == [("audit_log",)]
    assert got.where("table_name = 'customers'").first().missing_level == "USE_SCHEMA"


def test_schema_grants_reach_new_tables_and_table_ownership_does_not(spark, meta):
    new = spark.createDataFrame([("prod", "silver", "fresh", "MANAGED", "someone")], meta.tables.schema)
    assert access.effective(new, meta.privileges, persona("analyst")).first().can_read
    got = access.effective(new, meta.privileges, persona("owner"), catalog_owner="platform")
    assert not got.first().can_read


def test_all_privileges_on_a_catalog(meta):
    dev = access.grant_rows(meta.tables.sparkSession, [("data_engineer", "ALL_PRIVILEGES", "CATALOG", "prod")])
    assert access.effective(meta.tables, dev, persona("data_engineer")).where("can_read").count() == 10
    assert access.missing_level([("g", "ALL_PRIVILEGES", "CATALOG", "c")], Principal.of("x", "g"), "c", "s", "t") is None


def test_grant_and_revoke_act_at_one_level(meta):
    held = ("analyst", "SELECT", "SCHEMA", "prod.silver")
    assert access.grant(meta.privileges, [held]).count() == 19
    elsewhere = access.revoke(meta.privileges, [("analyst", "SELECT", "TABLE", "prod.silver.customers")])
    assert elsewhere.count() == 19
    gone = access.revoke(meta.privileges, [held])
    diff = access.matrix_diff(access.direct_grants(gone), access.direct_grants(meta.privileges))
    assert rows(diff) == [("missing", "analyst | SELECT | SCHEMA | prod.silver")]
    back = access.grant(gone, [held])
    assert access.matrix_diff(access.direct_grants(back), access.direct_grants(meta.privileges)).count() == 0
    extra = access.grant(meta.privileges, [("account users", "BROWSE", "CATALOG", "prod")])
    assert access.forbidden(extra).count() == 1 and access.forbidden(meta.privileges).count() == 0
    inherited = meta.privileges.selectExpr("grantee", "privilege_type", "object_type", "object_key",
                                           "'CATALOG' AS inherited_from")
    assert access.direct_grants(inherited).count() == 0
    assert access.revoke(inherited, [held]).count() == 19


def test_metadata_is_filtered_by_what_a_principal_sees(meta):
    seen = access.visible(meta.columns, meta.tables, meta.privileges, persona("analyst"))
    assert {r.table_schema for r in seen.select("table_schema").distinct().collect()} == {"gold", "silver"}
    assert access.visible(meta.columns, meta.tables, meta.privileges, Principal.of("x")).count() == 0


def test_snapshot_diff_is_null_safe(spark):
    b = spark.createDataFrame([(1, "x", None), (2, "y", "q"), (3, None, None), (4, "same", None)],
                              "k int, v string, w string")
    a = spark.createDataFrame([(1, "x", "new"), (2, "y", "q"), (5, None, None), (4, "same", None)],
                              "k int, v string, w string")
    got = {r.k: (r.in_before, r.in_after, r.w_before, r.w_after)
           for r in evolve.snapshot_diff(b, a, ["k"], ["v", "w"]).collect()}
    assert got == {1: (True, True, None, "new"), 3: (True, False, None, None), 5: (False, True, None, None)}


def test_metadata_diff_reports_values_not_counts(spark, meta):
    cols = meta.columns.where("table_schema = 'silver' and table_name = 'customers'")
    before_tags = meta.column_tags.where("table_schema = 'silver' and table_name = 'customers'")
    before = evolve.metadata_snapshot(cols, before_tags)
    assert before.count() == 17 and before.where("tags <> ''").count() == 17
    assert evolve.metadata_diff(before, before).count() == 0
    swapped = tags.set_tags(before_tags, "silver.customers", "city", {"classification": "internal"})
    got = rows(evolve.metadata_diff(before, evolve.metadata_snapshot(cols, swapped)),
               "column_name", "tags_before", "tags_after")
    assert got == [("city", "classification=confidential, pii_type=address",
                    "classification=internal, pii_type=address")]
    live = evolve.metadata_change((cols, before_tags), (cols.where("column_name <> 'email'"), swapped))
    assert rows(live, "column_name", "in_before", "in_after") == [
        ("city", True, True), ("email", True, False)]      # its tags are left, the column is gone


def test_any_tag_is_kept_and_orphans_are_no_columns(spark):
    columns = spark.createDataFrame([("s", "t", "c1", "x"), ("s", "t", "c2", None)],
                                    "table_schema string, table_name string, column_name string, comment string")
    held = spark.createDataFrame([("s", "t", "c1", "cost_center", "42"), ("s", "t", "gone", "pii_type", "name")],
                                 tags.TAG_SCHEMA)
    later = spark.createDataFrame([("s", "t", "c1", "cost_center", "43"), ("s", "t", "c1", "a_tag", "z")], tags.TAG_SCHEMA)
    assert rows(evolve.metadata_snapshot(columns, held), "column_name", "tags") == [("c1", "cost_center=42"), ("c2", "")]
    assert rows(evolve.metadata_change((columns, held), (columns, later)), "column_name", "tags_before", "tags_after") == [
        ("c1", "cost_center=42", "a_tag=z, cost_center=43")]
    assert [r.stmt for r in tags.statements(later).collect()] == [
        "ALTER TABLE s.t ALTER COLUMN c1 SET TAGS ('a_tag' = 'z', 'cost_center' = '43');"]


def test_bulk_assignment_replaces_and_refuses(spark):
    held = spark.createDataFrame([("s", "t", "a", "pii_type", "name"), ("s", "t", "b", "classification", "internal")],
                                 tags.TAG_SCHEMA)
    new = spark.createDataFrame([("s", "t", "a", "pii_type", "email"), ("s", "t", "b", "pii_type", "dob_date"),
                                 ("s", "t", "c", "nope", "x"), ("s", "t", "c", "filter_key", "region")],
                                tags.TAG_SCHEMA)
    assert rows(tags.assign(held, new), "column_name", "tag_name", "tag_value") == [
        ("a", "pii_type", "email"), ("b", "classification", "internal"), ("c", "filter_key", "region")]
    assert rows(tags.refused(new), "column_name", "tag_value", "allowed") == [
        ("b", "dob_date", "name, email, phone, national_id, address, dob, payment_card"), ("c", "x", None)]


def test_lineage(spark):
    old, _ = lineage.record(spark, ["/landing/a.csv"], "bronze.t", "2026-01-01")
    rewired, _ = lineage.record(spark, ["bronze.t", "silver.x"], "silver.t", "2026-01-02")
    now, cols = lineage.record(spark, ["bronze.t"], "silver.t", "2026-01-03",
                               {"mail": ["bronze.t.email"], "n": ["bronze.t.amount"]})
    log = old.unionByName(rewired).unionByName(now).unionByName(now)
    assert rows(lineage.edges(log)) == [("FILE: /landing/a.csv", "bronze.t", "PATH"),
                                        ("bronze.t", "silver.t", "TABLE"), ("silver.x", "silver.t", "TABLE")]
    assert rows(lineage.edges(log, "silver"), "source") == [("bronze.t",), ("silver.x",)]
    assert rows(lineage.current(log), "target_table", "source") == [
        ("bronze.t", "FILE: /landing/a.csv"), ("silver.t", "bronze.t")]
    assert dict(rows(lineage.last_seen(log), "source", "last_seen"))["bronze.t"] == dt.datetime(2026, 1, 3)
    assert rows(lineage.trace(cols)) == [("bronze.t", "email", "silver.t", "mail")]
    assert [r.target_table for r in lineage.recent(log, 2, "target_table").collect()] == ["silver.t"] * 2
