"""Policies, personas and governed reads."""

import pytest

from support import rows
from govlake import design
from govlake.design import ColumnMask, POLICIES, RowFilter, TAG_VOCABULARY
from govlake.operators import policy, tags
from govlake.operators.tags import TagValueNotAllowed
from govlake.plans.registry import Layers, persona
from govlake.principal import AccessDenied, Principal, require_exempt


@pytest.fixture(scope="module")
def catalog(spark, sf):
    return Layers(spark, sf).catalog()


def test_owner_reads_raw_values(catalog):
    raw = catalog.tables["silver.customers"]
    assert rows(catalog.read("silver.customers", persona("owner"))) == rows(raw)


def test_analyst_sees_no_raw_identifier(catalog):
    raw = {c: {r[0] for r in catalog.tables["silver.customers"].select(c).collect()}
           for c in ("first_name", "email", "phone", "national_id", "city")}
    seen = catalog.read("silver.customers", persona("analyst")).collect()
    for column, values in raw.items():
        assert not values & {r[column] for r in seen}
    assert len(seen) == catalog.tables["silver.customers"].count()


def test_regional_analyst_sees_one_region(catalog):
    seen = catalog.read("silver.customers", persona("analyst_eu"))
    assert [tuple(r) for r in seen.groupBy("region").count().collect()] == [("europe", 24)]


def test_filter_runs_on_raw_values_even_if_the_column_is_masked(spark):
    t = {"t": {"region": {"filter_key": "region", "pii_type": "name"}}}
    grants = [("analyst", "USE_CATALOG", "CATALOG", "prod"), ("analyst", "USE_SCHEMA", "SCHEMA", "prod.s"),
              ("analyst", "SELECT", "TABLE", "prod.s.t")]
    df = spark.createDataFrame([("EUROPE",), ("asia",), (None,)], "region string")
    cat = policy.GovernedCatalog({"s.t": df}, {"s.t": t["t"]}, grants=grants)
    assert rows(cat.read("s.t", persona("analyst_eu"))) == [("***",)]


@pytest.mark.parametrize("who,level", [("nobody", "USE_CATALOG"), ("analyst", "USE_SCHEMA"),
                                       ("auditor", "USE_SCHEMA")])
def test_bronze_is_denied_above_the_table(catalog, who, level):
    with pytest.raises(AccessDenied, match=level):
        catalog.read("bronze.customers", persona(who))


def test_untagged_table_is_untouched_until_tagged(spark):
    df = spark.createDataFrame([("x@y", "z")], "email string, other string")
    bare = policy.GovernedCatalog({"silver.new": df}, {})
    assert rows(bare.read("silver.new", persona("analyst"))) == [("x@y", "z")]
    covered = bare.with_tags("silver.new", {"email": {"pii_type": "email"}})
    assert rows(covered.read("silver.new", persona("analyst"))) == [("x***@y", "z")]


def test_two_masks_block_access_instead_of_choosing(spark):
    extra = ColumnMask("mask_contact", "mask_full", (("pii_type", "email"),))
    df = spark.createDataFrame([("x@y",)], "email string")
    cat = policy.GovernedCatalog({"silver.t": df}, {"silver.t": {"email": {"pii_type": "email"}}},
                                 (*POLICIES, extra))
    with pytest.raises(policy.PolicyConflict, match="email"):
        cat.read("silver.t", persona("analyst"))
    assert rows(cat.read("silver.t", persona("owner"))) == [("x@y",)]


def test_text_mask_on_a_date_is_denied_and_linted(spark):
    df = spark.createDataFrame([("1951-05-18",)], "d string").selectExpr("date(d) date_of_birth")
    tagged = {"silver.t": {"date_of_birth": {"pii_type": "dob"}}}
    cat = policy.GovernedCatalog({"silver.t": df}, tagged)
    with pytest.raises(policy.MaskTypeMismatch, match="CAST_INVALID_INPUT"):
        cat.read("silver.t", persona("analyst"))
    cat.read("silver.t", persona("owner"))          # the exempt owner sees nothing wrong
    columns = spark.createDataFrame([("silver", "t", "date_of_birth", "DATE"), ("silver", "t", "region", "STRING")],
                                    "table_schema string, table_name string, column_name string, data_type string")
    meta = spark.createDataFrame([("silver", "t", "date_of_birth", "pii_type", "dob")], tags.TAG_SCHEMA)
    assert rows(policy.lint(columns, meta), "column_name", "issue") == [
        ("date_of_birth", "type mismatch"), ("region", "unfiltered region")]


def test_lint_is_silent_on_a_sound_design(spark):
    from govlake.plans.suite import designed_meta
    meta = designed_meta(spark)
    issues = rows(policy.lint(meta.columns, meta.column_tags), "table_name", "column_name", "issue")
    assert issues == [("customer_profile_anonymized", "region", "unfiltered region"),
                      ("quarantine_customers", "region", "unfiltered region")]


def test_policy_creation_checks_tags_functions_and_arity():
    for p in POLICIES:
        assert policy.create(p) is p
    with pytest.raises(TagValueNotAllowed, match="payment_card"):
        policy.create(ColumnMask("m", "mask_full", (("pii_type", "dob_date"),)))
    with pytest.raises(ValueError, match="3 argument"):
        policy.create(ColumnMask("m", "pseudonymize", (("pii_type", "name"),), args=(1, 2)))
    with pytest.raises(ValueError, match="does not exist"):
        policy.create(ColumnMask("m", "mask_all", (("pii_type", "name"),)))
    with pytest.raises(ValueError, match="BOOLEAN"):
        policy.create(RowFilter("f", "mask_full", (("filter_key", "region"),), to="analyst"))


def test_retiring_a_policy_checks_use_then_narrows_the_vocabulary(spark):
    meta = tags.designed_tags(spark, "silver.customers", "bronze.customers")
    with pytest.raises(policy.PolicyInUse, match="date_of_birth"):
        policy.retire("mask_dob", meta, POLICIES, TAG_VOCABULARY)
    meta = tags.unset_tags(meta, "bronze.customers", "date_of_birth", "pii_type")
    rest, vocabulary = policy.retire("mask_dob", meta, POLICIES, TAG_VOCABULARY)
    assert [p.name for p in rest] == [p.name for p in POLICIES if p.name != "mask_dob"]
    assert "dob" not in vocabulary["pii_type"] and "email" in vocabulary["pii_type"]
    assert "mask_dob" in policy.unused_functions(rest)
    with pytest.raises(KeyError):
        policy.retire("mask_dob", meta, rest, vocabulary)
    with pytest.raises(TagValueNotAllowed):
        tags.set_tags(meta, "silver.customers", "email", {"pii_type": "dob"}, vocabulary)


def test_barrier_gives_the_same_rows(catalog):
    lazy = catalog.read("silver.customers", persona("analyst_eu"))
    cut = catalog.read("silver.customers", persona("analyst_eu"), barrier=True)
    assert rows(cut) == rows(lazy)


def test_masks_add_no_shuffle_and_keep_pruning(catalog):
    seen = catalog.read("silver.customers", persona("analyst_eu")).select("segment", "email")
    text = seen._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange hashpartitioning" not in text
    assert "c_acctbal" not in text and "c_name" not in text


def test_views_keep_owner_rights(spark):
    log = spark.createDataFrame([("a@x",)], "user_email string")
    cat = policy.GovernedCatalog({"governance.audit_log": log},
                                 {"governance.audit_log": {"user_email": {"pii_type": "email"}}})
    assert rows(cat.read("governance.audit_log", persona("auditor"))) == [("a@x",)]
    with pytest.raises(AccessDenied):
        cat.read("governance.audit_log", persona("analyst"))


def test_register_exposes_only_readable_tables(catalog, spark):
    made = catalog.register(persona("analyst_eu"), "eu_")
    assert made == ["eu_silver_customers"]
    got = spark.sql("SELECT region, count(*) AS n FROM eu_silver_customers GROUP BY region").collect()
    assert [tuple(r) for r in got] == [("europe", 24)]


def test_builder_must_be_exempt():
    with pytest.raises(AccessDenied):
        require_exempt(persona("data_engineer"))
    require_exempt(Principal.of("svc", design.OWNERS))


def test_tags_of_matches_the_design(spark):
    meta = tags.designed_tags(spark)
    assert policy.tags_of(meta, "silver.orders") == design.column_tags("silver.orders")


def test_matched_covers_the_policy_table(spark):
    got = policy.matched(tags.designed_tags(spark)).where("kind = 'ROW_FILTER'")
    assert got.count() == 4
    email = policy.matched(tags.designed_tags(spark)).where("policy_name = 'mask_email'")
    assert {r.column_name for r in email.collect()} == {"email", "user_email"}
    unused = policy.usage(tags.designed_tags(spark), POLICIES, ("mask_full", "idle")).where("status <> 'ok'")
    assert ("idle", "function unused") in {(r.function_name, r.status) for r in unused.collect()}


def test_lint_looks_at_readers_types_and_functions(spark):
    columns = spark.createDataFrame([("s", "t", "a", "STRING"), ("s", "t", "b", "DATE"), ("s", "t", "region", "STRING")],
                                    "table_schema string, table_name string, column_name string, data_type string")
    meta = spark.createDataFrame([("s", "t", "a", "pii_type", "email"), ("s", "t", "b", "pii_type", "dob")],
                                 "table_schema string, table_name string, column_name string, tag_name string, tag_value string")

    def masks(*readers, function="mask_full"):
        return [design.ColumnMask(f"m{i}", function, (("pii_type", "email"),), to=to, exempt=exempt)
                for i, (to, exempt) in enumerate(readers)]

    def issues(policies):
        return {(r.column_name, r.issue) for r in policy.lint(columns, meta, policies).collect()} - {("region", "unfiltered region")}

    assert issues(masks(("auditor", None), ("contractor", None))) == set()
    assert issues(masks(("auditor", None), ("account users", "auditor"))) == set()
    assert issues(masks(("auditor", None), ("account users", None))) == {("a", "conflict")}
    assert issues(masks(("analyst", None), ("analyst_eu", None))) == {("a", "conflict")}      # one persona is in both
    assert issues(masks(("auditor", None), function="filter_by_region")) == {("a", "type mismatch")}
    assert issues(masks(("auditor", None), function="nowhere")) == {("a", "function missing")}
    filters = [design.RowFilter("f", "filter_by_region", (("pii_type", "email"),), to="auditor", args=("europe",))]
    assert policy.lint(columns, meta, filters).collect()[0].issue == "unfiltered region"
    tagged = meta.unionByName(spark.createDataFrame([("s", "t", "region", "pii_type", "email")], meta.schema))
    assert policy.lint(columns, tagged, filters).count() == 0
