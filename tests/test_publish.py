"""Publishing, changing and building real tables; landing files; the suite over a build."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from support import rows
from govlake import design
from govlake.design import CONSTRAINTS, OWNERS, Constraint, Expectation
from govlake.operators import access, evolve, lineage, quality, tags
from govlake.plans import build, suite
from govlake.plans import publish as pub
from govlake.plans.registry import Layers, persona
from govlake.principal import AccessDenied, Principal
from govlake.sources import audit, fixture, ingest

SVC = Principal.of("svc", OWNERS)


@pytest.fixture()
def lake(spark, tmp_path):
    env = "t" + tmp_path.name.replace("-", "_").replace("[", "").replace("]", "")[-24:] + "_"
    made = pub.Lake(spark, str(tmp_path / "lake"), env)
    made.create_schemas("s")
    return made


def people(spark, *values):
    return spark.createDataFrame(list(values), "id string, year int, flag boolean")


def test_publish_refill_and_history(lake, spark):
    pub.publish(lake, people(spark, ("a", 1990, True)), "s.t", SVC)
    lake.describe("s.t", {"year": "it's the year"})
    report = pub.publish(lake, people(spark, ("b", 1991, False), ("c", None, None))
                         .select("flag", "id", "year"), "s.t", SVC)
    assert report.rows == 2
    assert lake.read("s.t").columns == ["id", "year", "flag"]       # by name, not by position
    assert rows(lake.read("s.t"), "id") == [("b",), ("c",)]
    comments = {r.col_name: r.comment for r in spark.sql(
        f"DESCRIBE {lake.database('s')}.t").collect()}
    assert comments["year"] == "it's the year"                      # the contract survives refills


@pytest.mark.parametrize("offered", ["id, flag AS year, flag", "id, year", "id, year, flag, 1 AS x",
                                     "id, string(year) AS year, flag"])
def test_a_refill_with_other_columns_is_refused(lake, spark, offered):
    df = people(spark, ("a", 1990, True))
    pub.publish(lake, df, "s.t", SVC)
    with pytest.raises(pub.SchemaMismatch):
        pub.publish(lake, df.selectExpr(*offered.split(", ")), "s.t", SVC)
    assert rows(lake.read("s.t")) == [("a", 1990, True)]


def test_masked_identity_cannot_build(lake, spark):
    with pytest.raises(AccessDenied, match="masked"):
        pub.publish(lake, people(spark, ("a", 1, True)), "s.t", persona("data_engineer"))
    assert not lake.exists("s.t")


def test_rules_belong_to_the_table(lake, spark):
    adult = Constraint("adult", "s.t", "year < 2010")
    pub.publish(lake, people(spark, ("a", 1990, True), ("b", 2015, None)), "s.t", SVC)
    with pytest.raises(quality.ConstraintViolation, match="adult"):
        pub.add_constraint(lake, adult, SVC)                        # stored rows must pass
    assert lake.rules("s.t") == []
    pub.delete(lake, "s.t", F.col("year") >= 2010, SVC)
    pub.add_constraint(lake, adult, SVC)
    with pytest.raises(ValueError, match="already"):
        pub.add_constraint(lake, adult, SVC)
    late = people(spark, ("c", 2020, None))
    for write in (lambda: pub.append(lake, late, "s.t", SVC), lambda: pub.publish(lake, late, "s.t", SVC),
                  lambda: pub.update(lake, "s.t", "year", F.lit(2020), SVC),
                  lambda: pub.rewrite(lake, "s.t", lambda df: df.unionByName(late), SVC)):
        with pytest.raises(quality.ConstraintViolation, match="adult"):
            write()
        assert rows(lake.read("s.t"), "id") == [("a",)]
    with pytest.raises(ValueError, match="adult"):
        pub.drop_column(lake, "s.t", "year", SVC)
    other = pub.Lake(spark, lake.root, lake.env)                    # another session's handle
    assert other.rules("s.t") == [adult] and other.rules("s.u") == []
    pub.drop_constraint(lake, "s.t", "adult", SVC)
    assert pub.append(lake, late, "s.t", SVC).rows == 1
    with pytest.raises(quality.ConstraintViolation):
        pub.add_constraint(lake, adult, SVC)
    with pytest.raises(ValueError, match="no CHECK"):
        pub.drop_constraint(lake, "s.t", "adult", SVC)


def test_migration_is_proved_on_what_is_stored(lake, spark):
    pub.publish(lake, people(spark, ("a", 1990, True), ("b", None, None)), "s.t", SVC)
    wrong = F.floor(F.col("year") / 10).cast("int")
    with pytest.raises(evolve.MigrationRefused):
        pub.migrate(lake, "s.t", "year", "decade", wrong, SVC, derivation=(wrong + 1))
    with pytest.raises(evolve.MigrationRefused):
        pub.migrate(lake, "s.t", "year", "decade", wrong, SVC, expected={"rows_total": 3})
    assert lake.read("s.t").columns == ["id", "year", "flag"]
    text = F.left(F.col("year").cast("string"), F.lit(3)).cast("int")
    pub.migrate(lake, "s.t", "year", "decade", wrong, SVC, derivation=text)
    assert rows(lake.read("s.t"), "id", "decade") == [("a", 199), ("b", None)]


def test_csv_keeps_quotes_commas_backslashes_and_line_breaks(spark, tmp_path):
    hard = [("1", 'say "hi", ok'), ("2", "ends in \\"), ("3", "two\nlines"), ("4", '"'), ("5", " , "), ("6", None)]
    df = spark.createDataFrame(hard, "id string, v string")
    ingest.write_csv(df, str(tmp_path / "out"))
    back = ingest.read_csv_all_string(spark, str(tmp_path / "out"), ["id", "v"], multi_line=True)
    assert rows(back, "id", "v", "_rescued_data") == sorted(((i, v, None) for i, v in hard), key=repr)
    (tmp_path / "in.csv").write_text('id,v\n1,"say ""hi"", ok"\n2,b,c\n')
    got = ingest.read_csv_all_string(spark, str(tmp_path / "in.csv"), ["id", "v"])
    assert rows(got, "id", "v", "_rescued_data") == [("1", 'say "hi", ok', None), ("2", "b", "2,b,c")]


def test_failed_check_leaves_the_published_version(lake, spark):
    rule = [Constraint("plausible", "s.t", "year > 1900")]
    pub.publish(lake, people(spark, ("a", 1990, True), ("n", None, True)), "s.t", SVC, rule)
    with pytest.raises(quality.ConstraintViolation, match="plausible.*year > 1900.*12"):
        pub.publish(lake, people(spark, ("b", 12, True)), "s.t", SVC, rule)
    assert rows(lake.read("s.t"), "id") == [("a",), ("n",)]


def test_append_checks_the_batch(lake, spark):
    rule = [Constraint("plausible", "s.t", "year > 1900")]
    pub.publish(lake, people(spark, ("a", 1990, True)), "s.t", SVC, rule)
    bad = spark.createDataFrame([("x", 1950), ("y", 1)], "id string, year int")
    with pytest.raises(quality.ConstraintViolation):
        pub.append(lake, bad, "s.t", SVC, rule)
    assert lake.read("s.t").count() == 1
    pub.append(lake, bad, "s.t", SVC)               # rule off: the same rows land
    assert rows(lake.read("s.t")) == [("a", 1990, True), ("x", 1950, None), ("y", 1, None)]
    pub.delete(lake, "s.t", F.col("year") < 1900, SVC)
    quality.enforce(lake.read("s.t"), rule)         # and the rule can come back
    with pytest.raises(pub.SchemaMismatch):
        pub.append(lake, spark.createDataFrame([(1,)], "nope int"), "s.t", SVC)


def test_update_delete_and_columns(lake, spark):
    pub.publish(lake, people(spark, ("a", 1990, True), ("b", None, False)), "s.t", SVC)
    pub.update(lake, "s.t", "year", F.lit(2000), SVC, where=F.lit(False))
    assert rows(lake.read("s.t"), "year") == sorted([(1990,), (None,)], key=repr)
    pub.update(lake, "s.t", "year", F.col("year") + 1, SVC)
    pub.delete(lake, "s.t", F.col("year") > 9999, SVC)      # NULL verdict keeps the row
    assert lake.read("s.t").count() == 2
    pub.add_column(lake, "s.t", "decade", (F.col("year") / 10).cast("int"), SVC)
    assert lake.read("s.t").columns[-1] == "decade"
    pub.drop_column(lake, "s.t", "year", SVC)
    assert rows(lake.read("s.t")) == [("a", True, 199), ("b", False, None)]
    with pytest.raises(evolve.MigrationRefused):
        pub.drop_column(lake, "s.t", "year", SVC)


def test_migration_runs_once_and_refuses_twice(lake, spark):
    df = spark.createDataFrame([("a", "1951-05-18"), ("b", None)], "id string, dob string")
    pub.publish(lake, df, "s.t", SVC)
    year = F.year(F.col("dob").cast("date"))
    pub.migrate(lake, "s.t", "dob", "birth_year", year, SVC)
    assert rows(lake.read("s.t")) == [("a", 1951), ("b", None)]
    with pytest.raises(evolve.MigrationRefused, match="already gone"):
        pub.migrate(lake, "s.t", "dob", "birth_year", year, SVC)
    assert rows(lake.read("s.t")) == [("a", 1951), ("b", None)]


def test_materialized_view_objects_and_expectations(lake, spark):
    rules = [Expectation("pos", "year >= 0", "observe"), Expectation("flagged", "flag", "drop"),
             Expectation("keyed", "id IS NOT NULL", "fail")]
    before = lake.objects("s")
    source = people(spark, ("a", -1, True), ("b", 5, False), ("c", 5, None), ("d", 5, True))
    report, made = pub.refresh_view(lake, "s.mv", source, SVC, rules)
    assert report.rows == 2 and rows(lake.read("s.mv"), "id") == [("a",), ("d",)]
    assert made == ["s.mv", "s.mv_expectations"]
    pub.refresh_view(lake, "s.mv", source, SVC, rules)
    log = lake.read("s.mv_expectations")
    assert rows(log.select("expectation", "mode", "passed", "failed").distinct()) == [
        ("flagged", "drop", 2, 2), ("keyed", "fail", 4, 0), ("pos", "observe", 3, 1)]
    assert log.select("run").distinct().count() == 2
    with pytest.raises(quality.ExpectationFailed, match="keyed"):
        pub.refresh_view(lake, "s.mv", people(spark, (None, 1, True)), SVC, rules)
    assert lake.read("s.mv").count() == 2
    new = {r.table_name for r in evolve.object_set_diff(before, lake.objects("s")).collect()}
    assert new == {"mv", "mv_expectations"}
    lake.drop("s.mv")
    left = evolve.object_set_diff(before, lake.objects("s")).collect()
    assert [r.table_name for r in left] == ["mv_expectations"]      # the drop is not transitive


def test_only_an_empty_schema_drops(lake, spark):
    pub.publish(lake, people(spark, ("a", 1, True)), "s.t", SVC)
    with pytest.raises(Exception, match="SCHEMA_NOT_EMPTY|not empty|RESTRICT"):
        lake.drop_schema("s")
    lake.drop("s.t")
    lake.drop_schema("s")


def test_csv_round_trip_keeps_text_and_rescues_long_rows(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.csv").write_text("id,postcode\n1,00001\n2,\n3,00009,extra\n")
    got = ingest.read_csv_all_string(spark, str(folder / "a.csv"), ["id", "postcode"], "2026-01-01 00:00:00")
    assert [f.dataType.simpleString() for f in got.schema.fields[:3]] == ["string"] * 3
    assert rows(got, "id", "postcode", "_rescued_data") == [
        ("1", "00001", None), ("2", None, None), ("3", "00009", "3,00009,extra")]
    fit = quality.fidelity(got.cache(), ["postcode"]).first()
    assert tuple(fit) == (3, 1, 2)
    files = ingest.list_landing(spark, str(folder)).collect()
    assert [f.bytes for f in files] == [len("id,postcode\n1,00001\n2,\n3,00009,extra\n")]
    assert ingest.header(spark, str(folder / "a.csv")) == ["id", "postcode"]
    out = str(tmp_path / "out")
    ingest.write_csv(got.select("id", "postcode"), out)
    back = ingest.read_csv_all_string(spark, out, ["id", "postcode"])
    assert rows(back, "id", "postcode") == [("1", "00001"), ("2", None), ("3", "00009")]


def test_audit_view(spark):
    events = spark.createDataFrame(
        [("2026-01-01", ("a@x",), "uc", "get", {"t": "prod.silver"}, ("200",)),
         ("2026-01-02", ("b@x",), "uc", "get", {"t": "dev.silver"}, ("403",))],
        "event_time string, user_identity struct<email:string>, service_name string, "
        "action_name string, request_params map<string,string>, response struct<status_code:string>")
    log = audit.audit_log(events, "prod")
    assert rows(log, "user_email", "status_code") == [("a@x", "200")]
    assert log.columns == list(design.TABLES["governance.audit_log"])
    assert audit.recent(audit.audit_log(events, "silver"), 1).first().user_email == "b@x"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("build")
    at = Layers(spark, "/root/testdata/sf0.01")
    landing = str(root / "landing")
    for name, df in (("customers", at.bronze_customers()), ("orders", at.bronze_orders())):
        ingest.write_csv(df.drop("_rescued_data", "_ingested_at"), f"{landing}/{name}")
    texts = {name: ingest.read_csv_all_string(
        spark, f"{landing}/{name}",
        [c for c in design.TABLES[f"bronze.{name}"] if not c.startswith("_")], "2026-09-21 00:00:00")
        for name in ("customers", "orders")}
    lake = pub.Lake(spark, str(root / "lake"), "built_")
    spark.sql("CREATE DATABASE IF NOT EXISTS platform_events")
    events = audit.from_test_events(fixture.table(spark, at.sf, "events")).withColumn(
        "request_params", F.create_map(F.lit("table"), F.when(F.col("event_id") % 2 == 0, "prod.silver.orders")
                                       .otherwise("dev.x")))
    events.write.mode("overwrite").saveAsTable("platform_events.audit")
    return lake, texts, build.run(lake, texts["customers"], texts["orders"], SVC, "2026-09-21 01:00:00",
                                  audit_source="platform_events.audit")


def test_build_from_csv_matches_the_golden_counts(built):
    lake, _, b = built
    assert {t: r.rows for t, r in b.reports.items()} == {
        "bronze.customers": 1500, "bronze.orders": 15000, "silver.customers": 1450,
        "silver.quarantine_customers": 50, "silver.orders": 14310, "silver.quarantine_orders": 690,
        "gold.revenue_by_region_month": 395, "gold.customer_segment_profile": 25,
        "gold.customer_profile_anonymized": 147}
    for r in build.reconciliation(lake).collect():
        assert r.difference_must_be_zero == 0
    for table, columns in design.TABLES.items():
        if table not in design.VIEWS:
            kinds = {f.name: f.dataType.simpleString().upper() for f in lake.read(table).schema.fields}
            assert list(kinds.items()) == list(columns.items()), table


def test_governed_reads_of_a_build(built):
    _, _, b = built
    cat = b.catalog()
    eu = persona("analyst_eu")
    assert cat.read("silver.customers", eu).count() == 294
    assert cat.read("gold.revenue_by_region_month", eu).count() == 79
    assert {r.region for r in cat.read("gold.customer_profile_anonymized", eu).collect()} == set(design.REGIONS)
    card = cat.read("silver.orders", eu).first().card_number
    assert card.startswith("****") and len(card) == 8
    with pytest.raises(AccessDenied, match="USE_SCHEMA"):
        cat.read("bronze.orders", eu)


def test_metadata_outlives_the_session(built):
    lake, _, b = built
    other = pub.Lake(lake.spark, lake.root, lake.env)               # nothing handed over but the place
    cat, eu = build.reopen(other), persona("analyst_eu")
    assert cat.read("silver.customers", eu).count() == 294
    assert cat.read("silver.orders", eu).first().card_number.startswith("****")
    assert dict(cat.tags["silver.customers"]) == {c: dict(t) for c, t in b.tags["silver.customers"].items() if t}
    with pytest.raises(quality.ConstraintViolation, match="amount_non_negative"):
        pub.update(other, "silver.orders", "amount", F.lit(-9).cast("decimal(12,2)"), SVC)
    with pytest.raises(quality.ConstraintViolation, match="status_known"):
        pub.append(other, other.read("silver.orders").limit(1).withColumn("status", F.lit("shipped")), "silver.orders", SVC)
    assert other.read("silver.orders").count() == 14310
    assert rows(lineage.edges(other.read(pub.LINEAGE), "gold")) == rows(lineage.edges(b.edges, "gold"))
    assert ("bronze.customers", "date_of_birth", "silver.customers", "birth_year") in rows(
        lineage.trace(other.read(pub.COLUMN_LINEAGE).drop("event_time")))


def test_books_are_only_appended_and_hold_the_last_word(lake, spark):
    kind = tags.TAG_SCHEMA
    one = lambda v: spark.createDataFrame([("s", "t", "c", "classification", v)], kind)
    assert lake.held(pub.TAGS).collect() == [] and not lake.exists(pub.TAGS)
    lake.note(pub.TAGS, one("internal"))
    other = pub.Lake(spark, lake.root, lake.env)
    other.note(pub.TAGS, spark.createDataFrame([("s", "t", "d", "classification", "restricted")], kind))
    lake.note(pub.TAGS, one("confidential"))
    assert rows(lake.held(pub.TAGS), "column_name", "tag_value") == [("c", "confidential"), ("d", "restricted")]
    lake.note_new(pub.TAGS, one("internal"))
    assert rows(other.held(pub.TAGS), "column_name", "tag_value") == [("c", "confidential"), ("d", "restricted")]
    lake.note(pub.TAGS, one(None), gone=True)
    lake.note_new(pub.TAGS, one("internal"))
    assert rows(other.held(pub.TAGS), "column_name") == [("d",)] and lake.noted(pub.TAGS).count() == 4
    pub.tag_tables(lake)
    pub.tag_tables(lake)
    assert rows(lake.held(pub.TABLE_TAGS), "table_name", "tag_value") == [("t", "restricted")]
    assert lake.noted(pub.TABLE_TAGS).count() == 1
    pub.untag(lake, "s.t", "d", ["classification"], SVC)
    pub.tag_tables(lake)
    assert lake.held(pub.TABLE_TAGS).collect() == []


def test_objects_and_columns_follow_the_tables(lake, spark):
    pub.publish(lake, people(spark, ("a", 1990, True)), "s.t", SVC)
    lake.describe("s.t", {"id": "the key"})
    assert rows(lake.columns("s"), "column_name", "data_type", "comment") == [
        ("flag", "BOOLEAN", None), ("id", "STRING", "the key"), ("year", "INT", None)]
    pub.drop_column(lake, "s.t", "year", SVC)
    assert rows(lake.columns("s"), "column_name") == [("flag",), ("id",)]
    lake.drop("s.t")
    assert lake.objects("s").collect() == [] and lake.columns("s").collect() == []


def test_a_column_named_in_a_text_is_free(lake, spark):
    pub.publish(lake, people(spark, ("a", 1990, True)), "s.t", SVC)
    pub.add_constraint(lake, Constraint("named", "s.t", "id <> 'year'"), SVC)
    pub.drop_column(lake, "s.t", "year", SVC)
    with pytest.raises(ValueError, match="named"):
        pub.drop_column(lake, "s.t", "id", SVC)


def test_a_second_build_keeps_what_stewards_stored(built):
    """A tag raised, a tag removed, a rule of another table and a dropped rule all outlive a build."""
    lake, texts, _ = built
    pub.tag(lake, "silver.customers", "city", {"classification": "restricted"}, SVC)
    pub.untag(lake, "silver.customers", "phone", ["pii_type"], SVC)
    mine = Constraint("mine", "extra.mine", "x > 0")
    pub.add_constraint(lake, mine, SVC)
    pub.drop_constraint(lake, "silver.orders", "status_known", SVC)
    edges = lake.read(pub.LINEAGE).count()
    again = build.run(lake, texts["customers"], texts["orders"], SVC, "2026-09-21 02:00:00")
    assert again.tags["silver.customers"]["city"]["classification"] == "restricted"
    assert "pii_type" not in again.tags["silver.customers"]["phone"]
    assert lake.rules("extra.mine") == [mine]
    assert "status_known" not in {r.name for r in lake.rules("silver.orders")}
    assert lake.read(pub.LINEAGE).count() > edges
    assert ("silver", "customers", "restricted") in rows(lake.held(pub.TABLE_TAGS), "table_schema", "table_name", "tag_value")
    # as it was, for the tests that follow
    pub.tag(lake, "silver.customers", "city", {"classification": "confidential"}, SVC)
    pub.tag(lake, "silver.customers", "phone", {"pii_type": "phone"}, SVC)
    pub.drop_constraint(lake, "extra.mine", "mine", SVC)
    pub.add_constraint(lake, next(r for r in CONSTRAINTS if r.name == "status_known"), SVC)


def test_second_run_refills_in_place(built):
    lake, texts, _ = built
    again = build.run(lake, texts["customers"], texts["orders"], SVC, "2026-09-22 01:00:00")
    assert again.reports["silver.orders"].rows == 14310
    fresh = evolve.freshness(lake.read("silver.customers"), "_silver_built_at", "customer_id").first()
    assert str(fresh.oldest_build) == "2026-09-22 01:00:00" and fresh.keys_distinct == 1450
    assert rows(lineage.edges(again.edges, "gold"), "source") == [
        ("silver.customers",), ("silver.customers",), ("silver.customers",), ("silver.orders",)]
    spark = lake.spark
    text = {r.col_name: r.comment for r in spark.sql("DESCRIBE built_silver.customers").collect()}
    assert text["email"] == design.DESCRIPTIONS["email"]


def run_suite(lake, meta, principal=persona("owner"), **changed):
    published = {t: lake.read(f"gold.{t}") for t in (
        "revenue_by_region_month", "customer_segment_profile", "customer_profile_anonymized")}
    published.update(changed)
    got = suite.run(meta, build.reconciliation(lake), published, principal).collect()
    return {r.id: r for r in got}


def test_suite_passes_on_a_real_build(built):
    from govlake.operators import access, policy
    lake, _, b = built
    meta = b.meta(access.grant_rows(lake.spark, design.GRANTS))
    got = run_suite(lake, meta)
    assert {i: (r.actual, r.status) for i, r in got.items() if r.status != "PASS"} == {}
    assert meta.columns.count() == sum(len(c) for c in design.TABLES.values()) == 108
    assert lake.read("governance.audit_log").count() == 500 * 10
    cat = policy.GovernedCatalog({"governance.audit_log": lake.read("governance.audit_log")}, b.tags)
    assert cat.read("governance.audit_log", persona("auditor")).first().user_email.startswith("user")
    masked = lake.spark.sql("SELECT built_governance.mask_last4('4000111122223333')").first()[0]
    assert masked == "****3333"


def test_suite_passes_on_the_design(built):
    got = run_suite(built[0], suite.designed_meta(built[0].spark))
    assert len(got) == 22 and {r.status for r in got.values()} == {"PASS"}
    assert got["D2"].actual == "14310 + 690 vs 15000"


def test_every_metadata_control_can_fail(built):
    lake, spark = built[0], built[0].spark
    m = suite.designed_meta(spark)
    secret = spark.createDataFrame([("silver", "orders", "amount", "classification", "secret")],
                                   m.column_tags.schema)
    retired = spark.createDataFrame([("silver", "orders", "amount", "pii_type", "dob_date"),
                                     ("gold", "customer_profile_anonymized", "region", "pii_type", "name")],
                                    m.column_tags.schema)
    stray = spark.createDataFrame([("default",)], m.schemata.schema)
    browse = spark.createDataFrame([("account users", "BROWSE", "CATALOG", "prod", "NONE")],
                                   m.privileges.schema)
    faulty = suite.Meta(
        schemata=m.schemata.unionByName(stray),
        tables=m.tables.withColumn("table_owner", F.when(F.col("table_name") == "customers", "me")
                                   .otherwise(F.col("table_owner"))).where("table_name <> 'orders'"),
        columns=m.columns.withColumn("comment", F.when(F.col("column_name") != "email", F.col("comment"))),
        column_tags=m.column_tags.where("column_name <> 'segment'").unionByName(secret).unionByName(retired),
        privileges=m.privileges.where("grantee <> 'auditor'").unionByName(browse),
        routines=m.routines.where("routine_name <> 'mask_dob'"),
        constraints=m.constraints.withColumn("expression", F.when(
            F.col("constraint_name") == "region_known", "true").otherwise(F.col("expression"))))
    none = lake.read("gold.customer_segment_profile").limit(0)
    small = lake.read("gold.customer_profile_anonymized").withColumn("people_in_group", F.lit(4).cast("long"))
    tiny = lake.read("gold.revenue_by_region_month").withColumn("customers_active", F.lit(1).cast("long"))
    got = run_suite(lake, faulty, persona("analyst"), customer_segment_profile=none,
                    customer_profile_anonymized=small, revenue_by_region_month=tiny)
    passed = {i for i, r in got.items() if r.status == "PASS"}
    assert passed == {"D1", "D2"}, passed
    assert got["D4"].actual is None                 # nothing seen is a failure, not a pass
    assert got["C1"].actual == "4 missing" and got["C2"].actual == "1 extra"
    assert got["A4"].actual == "audit_log, +2 other"


def test_row_controls_can_fail(built):
    lake = built[0]
    lost = quality.reconcile("customers", lake.read("bronze.customers"), lake.read("silver.customers"),
                             lake.read("silver.quarantine_customers").limit(1))
    published = {t: lake.read(f"gold.{t}") for t in (
        "revenue_by_region_month", "customer_segment_profile", "customer_profile_anonymized")}
    found = suite.data(lost.unionByName(lost.withColumn("tbl", F.lit("orders"))), published)[0]
    assert rows(found, "id", "status") == [("D1", "FAIL"), ("D2", "FAIL")]


def test_empty_grant_scan_fails_rather_than_reads_clean(spark):
    m = suite.designed_meta(spark)
    blind = suite.Meta(**{**m.__dict__, "privileges": m.privileges.limit(0)})
    got = {}
    for df in suite.privileges(blind):
        got.update(rows(df, "id", "status"))
    assert got["C0"] == "FAIL" and got["C1"] == "FAIL" and got["C2"] == "PASS"


def test_discovery_lists_every_relation(spark):
    found = suite.discover(suite.designed_meta(spark))
    assert found["grants"].count() == 19 and found["coverage"].count() == 10
    assert found["constraints"].count() == len(CONSTRAINTS)


def test_fail_fix_pass(spark):
    """The order of a repair: the suite fails, its offenders are mended, the suite passes."""
    meta = suite.designed_meta(spark)
    expected = meta.privileges
    assert not suite.verdicts(suite.offenders(meta, expected)).where("status = 'FAIL'").count()
    broken = replace(
        meta, column_tags=meta.column_tags.where("column_name <> 'city'").unionByName(
            spark.createDataFrame([("silver", "orders", "amount", "pii_type", "made_up"), ("silver", "x", "y", "t", "v")],
                                  meta.column_tags.schema)),
        privileges=access.revoke(meta.privileges, [("auditor", "SELECT", "TABLE", "x")]).limit(18))
    found = suite.offenders(broken, expected)
    status = {r.control: (r.offenders, r.status) for r in suite.verdicts(found).collect()}
    assert status["B1"][1] == status["B4"][1] == status["B6"][1] == status["C1"][1] == "FAIL" and status["A4"] == (0, "PASS")
    assert "silver.orders.amount: pii_type=made_up" in {r.offender for r in found.collect()}
    mended = replace(broken, column_tags=meta.column_tags, privileges=access.grant(
        broken.privileges, design.GRANTS).distinct())
    assert not suite.verdicts(suite.offenders(mended, expected)).where("status = 'FAIL'").count()
