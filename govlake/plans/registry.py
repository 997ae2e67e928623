"""Every query the engine answers over the test tables, with its DuckDB counterpart.

A query is a function (spark, sf_dir) -> DataFrame; build times are left out because they
differ between runs. All run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake import design
from govlake.design import AS_OF, CONSTRAINTS, EXPECTATIONS, K, OWNERS, PERSONAS, POLICIES
from govlake.functions import masks
from govlake.functions.rows import literal
from govlake.functions.values import day, present
from govlake.operators import (access, anonymize, coverage, evolve, gold, lineage, policy, quality,
                               silver, tags)
from govlake.plans import suite
from govlake.plans.oracle import AS_OF as SQL_AS_OF
from govlake.plans.oracle import with_
from govlake.principal import Principal
from govlake.session import shared_folder
from govlake.sources import audit, fixture, fleet, ingest

Query = Callable[[SparkSession, str], DataFrame]
PINNED = "2026-09-21 00:00:00"

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, *ctes: str):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_(sql, *ctes)
        return fn
    return keep


@dataclass(frozen=True)
class Layers:
    """The layers of one data folder, as lazy frames without build times."""

    spark: SparkSession
    sf: str

    def bronze_customers(self) -> DataFrame:
        return fixture.bronze_customers(self.spark, self.sf, PINNED)

    def bronze_orders(self) -> DataFrame:
        return fixture.bronze_orders(self.spark, self.sf, PINNED)

    def customers(self) -> DataFrame:
        return silver.customers(self.bronze_customers(), PINNED).drop(
            "_ingested_at", "_silver_built_at")

    def orders(self) -> DataFrame:
        return silver.orders(
            self.bronze_orders(), self.bronze_customers(), AS_OF, PINNED,
            keys_from=fixture.order_customer_ids(self.spark, self.sf),
        ).drop("_ingested_at", "_silver_built_at")

    def valid_orders(self) -> DataFrame:
        """Orders passing their own rules, for aggregates that join silver customers anyway."""
        return silver.row_valid_orders(self.bronze_orders(), AS_OF, PINNED)

    def order_outcomes(self) -> DataFrame:
        """Orders per reason as the split itself labels them, NULL for the accepted ones."""
        labelled = silver.classify_orders(self.bronze_orders(), self.bronze_customers(), AS_OF,
                                          fixture.order_customer_ids(self.spark, self.sf))
        return labelled.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))

    def order_counts(self) -> DataFrame:
        return silver.order_counts(self.bronze_orders(), self.bronze_customers(), AS_OF)

    def typed_orders(self) -> DataFrame:
        """All orders typed, defects included: what a build step receives."""
        return silver.type_orders(self.bronze_orders(), PINNED).drop(
            "_ingested_at", "_silver_built_at")

    def catalog(self) -> policy.GovernedCatalog:
        names = ("bronze.customers", "silver.customers")
        return policy.GovernedCatalog(
            {"bronze.customers": self.bronze_customers(), "silver.customers": self.customers()},
            {t: design.column_tags(t) for t in names})


def persona(name: str) -> Principal:
    return Principal.of(name, *PERSONAS[name])


# ---- layers ---------------------------------------------------------------------------------

@register("bronze_customers", "SELECT * EXCLUDE (_rescued_data) FROM bc", "bc")
def _bronze_customers(spark, sf):
    return Layers(spark, sf).bronze_customers().drop("_rescued_data", "_ingested_at")


@register("bronze_orders", "SELECT * EXCLUDE (_rescued_data) FROM bo", "bo")
def _bronze_orders(spark, sf):
    return Layers(spark, sf).bronze_orders().drop("_rescued_data", "_ingested_at")


@register("csv_ingest", r"""
SELECT * EXCLUDE (_rescued_data) REPLACE (nullif(email, '') AS email,
  CASE right(customer_id, 1) WHEN '1' THEN 'say "hi", ' || city WHEN '2' THEN city || '\'
       WHEN '3' THEN city || chr(10) || 'second line' WHEN '4' THEN '"' || city || '"'
       WHEN '5' THEN ' ' || city || ',' ELSE city END AS city) FROM bc""", "bc")
def _csv_ingest(spark, sf):
    """Land the customers as CSV and read them back as text: nothing is typed, trimmed or split, also
    with quotes, commas, backslashes and line breaks in a field."""
    landing = shared_folder(spark, "landing")
    bronze = Layers(spark, sf).bronze_customers().drop("_rescued_data", "_ingested_at")
    last, city = F.right("customer_id", F.lit(1)), F.col("city")
    hard = (F.when(last == "1", F.concat(F.lit('say "hi", '), city)).when(last == "2", F.concat(city, F.lit("\\")))
            .when(last == "3", F.concat(city, F.lit("\nsecond line")))
            .when(last == "4", F.concat(F.lit('"'), city, F.lit('"')))
            .when(last == "5", F.concat(F.lit(" "), city, F.lit(","))).otherwise(city))
    ingest.write_csv(bronze.withColumn("city", hard), landing)
    return ingest.read_csv_all_string(spark, landing, bronze.columns, PINNED, multi_line=True).drop(
        "_rescued_data", "_ingested_at")


@register("bronze_fidelity_leading_zeros", """
SELECT count(*) AS n_rows, count(_rescued_data) AS rescued_rows,
       count(*) FILTER (postcode LIKE '0%') AS postcode_leading_zero,
       count(*) FILTER (national_id LIKE '0%') AS national_id_leading_zero FROM bc""", "bc")
def _fidelity(spark, sf):
    return quality.fidelity(Layers(spark, sf).bronze_customers(), ["postcode", "national_id"])


@register("silver_customers", "SELECT * FROM sc", "sc")
def _silver_customers(spark, sf):
    return Layers(spark, sf).customers()


@register("silver_orders", "SELECT * FROM so", "so")
def _silver_orders(spark, sf):
    return Layers(spark, sf).orders()


@register("quarantine_customers", "SELECT * EXCLUDE (_rescued_data) FROM qc", "qc")
def _quarantine_customers(spark, sf):
    return silver.quarantine_customers(Layers(spark, sf).bronze_customers(), PINNED).drop(
        "_rescued_data", "_ingested_at", "_quarantined_at")


@register("quarantine_orders", "SELECT * EXCLUDE (_rescued_data) FROM qo", "qo")
def _quarantine_orders(spark, sf):
    at = Layers(spark, sf)
    return silver.quarantine_orders(
        at.bronze_orders(), at.bronze_customers(), AS_OF, PINNED,
        keys_from=fixture.order_customer_ids(spark, sf),
    ).drop("_rescued_data", "_ingested_at", "_quarantined_at")


@register("reject_reason_report", """
SELECT 'orders' AS tbl, reject_reason, count(*) AS n_rows FROM qo GROUP BY ALL
UNION ALL SELECT 'customers', reject_reason, count(*) FROM qc GROUP BY ALL""", "qo", "qc")
def _reject_report(spark, sf):
    at = Layers(spark, sf)
    people = quality.reject_report(silver.quarantine_customers(at.bronze_customers(), PINNED))
    orders = (at.order_counts().where(F.col("reject_reason").isNotNull() & (F.col("n_rows") > 0))
              .select("reject_reason", "n_rows"))
    return (orders.select(F.lit("orders").alias("tbl"), "*")
            .unionByName(people.select(F.lit("customers").alias("tbl"), "*")))


def _reconciliation(at: Layers) -> DataFrame:
    labelled = silver.classify_customers(at.bronze_customers()).groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("n_rows"))
    return (quality.reconcile_outcomes("customers", at.bronze_customers(), labelled)
            .unionByName(quality.reconcile_outcomes("orders", at.bronze_orders(), at.order_outcomes())))


@register("reconciliation", """
SELECT *, silver_rows + quarantined - bronze_rows AS difference_must_be_zero FROM (
  SELECT 'customers' AS tbl, (SELECT count(*) FROM bc) AS bronze_rows,
         (SELECT count(*) FROM sc) AS silver_rows, (SELECT count(*) FROM qc) AS quarantined
  UNION ALL
  SELECT 'orders', (SELECT count(*) FROM bo), (SELECT count(*) FROM so),
         (SELECT count(*) FROM qo))""", "bc", "sc", "qc", "bo", "so", "qo")
def _reconcile(spark, sf):
    return _reconciliation(Layers(spark, sf))


@register("cast_loss_report", """
SELECT count(*) FILTER (TRY_CAST(date_of_birth AS DATE) IS NULL) AS date_of_birth_null,
       count(*) FILTER (TRY_CAST(date_of_birth AS DATE) IS NULL AND date_of_birth IS NOT NULL)
           AS date_of_birth_unparseable,
       count(*) FILTER (TRY_CAST(created_at AS TIMESTAMP) IS NULL) AS created_at_null,
       count(*) FILTER (TRY_CAST(created_at AS TIMESTAMP) IS NULL AND created_at IS NOT NULL)
           AS created_at_unparseable,
       count(*) FILTER (TRY_CAST(marketing_consent AS BOOLEAN) IS NULL) AS marketing_consent_null,
       count(*) FILTER (TRY_CAST(marketing_consent AS BOOLEAN) IS NULL
                        AND marketing_consent IS NOT NULL) AS marketing_consent_unparseable
FROM bc WHERE trim(coalesce(email, '')) <> ''""", "bc")
def _cast_loss(spark, sf):
    accepted = Layers(spark, sf).bronze_customers().where(present(F.col("email")))
    return quality.cast_loss(accepted, {
        "date_of_birth": day(F.col("date_of_birth")),
        "created_at": F.col("created_at").try_cast("timestamp"),
        "marketing_consent": F.col("marketing_consent").try_cast("boolean")})


@register("referential_check", """
SELECT 'silver orders in silver customers' AS check_name,
       (SELECT count(*) FROM so ANTI JOIN sc USING (customer_id)) AS orphans
UNION ALL
SELECT 'bronze orders in silver customers',
       (SELECT count(*) FROM bo ANTI JOIN sc USING (customer_id))""", "so", "sc", "bo")
def _referential(spark, sf):
    at = Layers(spark, sf)
    out = []
    for label, child in (("silver", at.orders()), ("bronze", at.bronze_orders())):
        out.append(quality.referential(child, at.customers(), "customer_id").select(
            F.lit(f"{label} orders in silver customers").alias("check_name"), "orphans"))
    return out[0].unionByName(out[1])


@register("raw_parent_orphans", f"""
SELECT count(*) AS orphans_if_joined_to_raw FROM typed
WHERE amt >= 0 AND dt <= {SQL_AS_OF} AND customer_id IN (SELECT customer_id FROM bc)
  AND customer_id NOT IN (SELECT customer_id FROM sc)""", "typed", "bc", "sc")
def _raw_parent_orphans(spark, sf):
    return Layers(spark, sf).order_counts().agg(
        F.sum("raw_only").alias("orphans_if_joined_to_raw"))


@register("unique_key_check", """
SELECT 'customers' AS tbl, count(*) AS rows_total, count(DISTINCT customer_id) AS keys_distinct
FROM sc UNION ALL
SELECT 'orders', count(*), count(DISTINCT order_id) FROM so""", "sc", "so")
def _unique(spark, sf):
    at = Layers(spark, sf)
    return (quality.unique(at.customers(), "customer_id").select(F.lit("customers").alias("tbl"), "*")
            .unionByName(quality.unique(at.orders(), "order_id")
                         .select(F.lit("orders").alias("tbl"), "*")))


@register("status_profile", """
SELECT status AS value, count(*) AS n,
       round(count(*) / (SELECT count(*) FROM so), 4) AS share FROM so GROUP BY status""", "so")
def _status_profile(spark, sf):
    at = Layers(spark, sf)
    groups = silver.accepted_groups(at.bronze_orders(), at.bronze_customers(), ["status"])
    return quality.profile(groups, "status", weight="n")


@register("currency_vocabulary_diff", """
SELECT coalesce(f.value, l.value) AS value, coalesce(n, 0) AS n,
       CASE WHEN l.value IS NULL THEN 'unexpected' WHEN f.value IS NULL THEN 'absent'
            ELSE 'ok' END AS status
FROM (SELECT currency AS value, count(*) AS n FROM so GROUP BY currency) f
FULL JOIN (SELECT unnest(['AED', 'EUR', 'GBP', 'JPY', 'USD']) AS value) l
  ON l.value = f.value""", "so")
def _currency_diff(spark, sf):
    at = Layers(spark, sf)
    groups = silver.accepted_groups(at.bronze_orders(), at.bronze_customers(), ["currency"])
    return quality.vocabulary_diff(groups, "currency", ("AED", "EUR", "GBP", "JPY", "USD"),
                                   weight="n")


# ---- masks, filters, governed reads ---------------------------------------------------------

@register("governed_revenue_analyst_eu",
          f"SELECT * FROM rev WHERE customers_active >= {K} AND region = 'europe'", "rev")
def _governed_revenue(spark, sf):
    at = Layers(spark, sf)
    table = gold.revenue(at.valid_orders(), at.customers(), K, PINNED)
    return (_one_table("gold.revenue_by_region_month", table)
            .read("gold.revenue_by_region_month", persona("analyst_eu"))
            .drop("_gold_built_at").withColumn("order_month", F.col("order_month").cast("date")))


def _mask_query(name: str, fn, column: str, sql: str, of: str = "bc", key: str = "customer_id"):
    @register(name, f"SELECT {key}, {sql} AS masked FROM {of}", of)
    def run(spark, sf):
        at = Layers(spark, sf)
        source = at.bronze_customers() if of == "bc" else at.bronze_orders()
        return source.select(key, fn(F.col(column)).alias("masked"))


_MASK_EMAIL_SQL = """CASE WHEN email IS NULL OR email = '' THEN email
     ELSE left(email, 1) || '***@' || split_part(email, '@', 2) END"""
_mask_query("mask_full", masks.mask_full, "first_name", "'***'")
_mask_query("mask_email", masks.mask_email, "email", _MASK_EMAIL_SQL)
_mask_query("mask_last4", masks.mask_last4, "card_number", "'****' || right(card_number, 4)",
            "bo", "order_id")
_mask_query("pseudonymize", masks.pseudonymize, "national_id", "sha256(national_id || '1')")
_mask_query("mask_dob", masks.mask_dob, "date_of_birth", "left(date_of_birth, 4) || '-**-**'")
_mask_query("mask_dob_date", lambda c: masks.mask_dob_date(day(c)), "date_of_birth",
            "make_date(year(TRY_CAST(date_of_birth AS DATE)), 1, 1)")


@register("row_filter_region",
          "SELECT customer_id, region FROM bc WHERE list_contains(['europe', 'asia'], lower(region))",
          "bc")
def _row_filter(spark, sf):
    rows = Layers(spark, sf).bronze_customers()
    return rows.where(masks.filter_by_region(F.col("region"), "europe,asia")).select(
        "customer_id", "region")


_GOVERNED_SQL = f"""
SELECT customer_id, '***' AS first_name, '***' AS last_name, {_MASK_EMAIL_SQL} AS email,
       '***' AS phone, sha256(national_id || '1') AS national_id, '***' AS street_address,
       '***' AS city, '***' AS postcode, country, region, segment, marketing_consent, created_at,
       birth_year
FROM sc"""


@register("governed_customers_analyst_eu", _GOVERNED_SQL + " WHERE region = 'europe'", "sc")
def _governed_eu(spark, sf):
    return Layers(spark, sf).catalog().read("silver.customers", persona("analyst_eu"))


@register("governed_customers_analyst", _GOVERNED_SQL, "sc")
def _governed_analyst(spark, sf):
    return Layers(spark, sf).catalog().read("silver.customers", persona("analyst"))


@register("governed_customers_owner", "SELECT * FROM sc", "sc")
def _governed_owner(spark, sf):
    return Layers(spark, sf).catalog().read("silver.customers", persona("owner"))


@register("governed_bronze_engineer", f"""
SELECT customer_id, '***' AS first_name, '***' AS last_name, {_MASK_EMAIL_SQL} AS email,
       '***' AS phone, left(date_of_birth, 4) || '-**-**' AS date_of_birth,
       sha256(national_id || '1') AS national_id, '***' AS street_address, '***' AS city,
       '***' AS postcode, country, region, segment, marketing_consent, created_at
FROM bc""", "bc")
def _governed_bronze(spark, sf):
    return (Layers(spark, sf).catalog().read("bronze.customers", persona("data_engineer"))
            .drop("_rescued_data", "_ingested_at"))


def _one_table(table: str, df: DataFrame, tag_table: str | None = None) -> policy.GovernedCatalog:
    return policy.GovernedCatalog({table: df}, {table: design.column_tags(tag_table or table)})


@register("governed_orders_analyst", """
SELECT order_id, customer_id, order_date, amount, currency, status,
       '****' || right(card_number, 4) AS card_number FROM so""", "so")
def _governed_orders(spark, sf):
    return _one_table("silver.orders", Layers(spark, sf).orders()).read(
        "silver.orders", persona("analyst"))


@register("governed_quarantine_analyst", f"""
SELECT customer_id, '***' AS first_name, {_MASK_EMAIL_SQL} AS email,
       left(date_of_birth, 4) || '-**-**' AS date_of_birth, region, reject_reason
FROM qc""", "qc")
def _governed_quarantine(spark, sf):
    held = silver.quarantine_customers(Layers(spark, sf).bronze_customers(), PINNED)
    return _one_table("silver.quarantine_customers", held).read(
        "silver.quarantine_customers", persona("analyst_eu")).select(
        "customer_id", "first_name", "email", "date_of_birth", "region", "reject_reason")


@register("governed_region_counts", """
SELECT 'owner' AS who, region, count(*) AS rows_visible FROM sc GROUP BY region
UNION ALL SELECT 'analyst', region, count(*) FROM sc GROUP BY region
UNION ALL SELECT 'analyst_eu', region, count(*) FROM sc WHERE region = 'europe' GROUP BY region""",
          "sc")
def _region_counts(spark, sf):
    catalog, out = Layers(spark, sf).catalog(), None
    for who in ("owner", "analyst", "analyst_eu"):
        seen = (catalog.read("silver.customers", persona(who)).groupBy("region")
                .agg(F.count(F.lit(1)).alias("rows_visible"))
                .select(F.lit(who).alias("who"), "region", "rows_visible"))
        out = seen if out is None else out.unionByName(seen)
    return out


@register("governed_mask_aggregate", """
SELECT '***' AS status, count(*) AS n, count(DISTINCT currency) AS currencies FROM typed""",
          "typed")
def _mask_aggregate(spark, sf):
    demo = Layers(spark, sf).typed_orders().select("order_id", "order_date", "amount",
                                                   "currency", "status")
    named = {**design.column_tags("silver.orders"),
             "status": {"classification": "internal", "pii_type": "name"}}
    view = policy.GovernedCatalog({"silver.orders_quality_demo": demo},
                                  {"silver.orders_quality_demo": named})
    return (view.read("silver.orders_quality_demo", persona("analyst")).groupBy("status")
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("currency").alias("currencies")))


_POLICY_ROWS = ", ".join(
    f"('{p.name}', '{'ROW_FILTER' if isinstance(p, design.RowFilter) else 'COLUMN_MASK'}', "
    f"'{p.function}', '{k}', '{v}')" for p in POLICIES for k, v in p.match)
_POLICY_SQL = (f"(VALUES {_POLICY_ROWS}) p(policy_name, kind, function_name, tag_name, tag_value)")


@register("policy_resolution_matrix", f"""
SELECT table_schema, policy_name, kind, function_name, count(*) AS columns_matched,
       count(DISTINCT table_name) AS tables_matched
FROM fg JOIN {_POLICY_SQL} USING (tag_name, tag_value) GROUP BY ALL""", "fg")
def _policy_matrix(spark, sf):
    return (policy.matched(fleet.column_tags(spark, sf))
            .groupBy("table_schema", "policy_name", "kind", "function_name")
            .agg(F.count(F.lit(1)).alias("columns_matched"),
                 F.count_distinct("table_name").alias("tables_matched")))


@register("policy_function_inventory", f"""
SELECT policy_name, kind, coalesce(u.function_name, r.function_name) AS function_name,
       coalesce(columns_matched, 0)::BIGINT AS columns_matched,
       CASE WHEN r.function_name IS NULL THEN 'function missing'
            WHEN policy_name IS NULL THEN 'function unused' ELSE 'ok' END AS status
FROM (SELECT p.policy_name, p.kind, p.function_name, count(fg.tag_name) AS columns_matched
      FROM {_POLICY_SQL} LEFT JOIN fg USING (tag_name, tag_value) GROUP BY ALL) u
FULL JOIN (SELECT unnest(['filter_by_region', 'mask_dob', 'mask_dob_date', 'mask_full',
                          'mask_last4', 'pseudonymize']) AS function_name) r
  ON r.function_name = u.function_name""", "fg")
def _function_inventory(spark, sf):
    known = ("filter_by_region", "mask_dob", "mask_dob_date", "mask_full", "mask_last4",
             "pseudonymize")
    return policy.usage(fleet.column_tags(spark, sf), POLICIES, known)


_LINTED = (*POLICIES,
           design.ColumnMask("mask_contact", "mask_full", (("pii_type", "email"), ("pii_type", "name"))),
           # names a function that is not there
           design.ColumnMask("mask_lost", "mask_nowhere", (("cost_center", "cc1"),)))


@register("policy_lint", f"""
SELECT table_schema, table_name, column_name, issue FROM (
  SELECT table_schema, table_name, column_name, count(DISTINCT policy_name) > 1 AS conflict,
         bool_or(policy_name <> 'mask_lost' AND data_type <> 'STRING') AS mismatch,
         bool_or(policy_name = 'mask_lost') AS missing
  FROM fc JOIN fg USING (table_schema, table_name, column_name)
  JOIN (SELECT policy_name, tag_name, tag_value FROM {_POLICY_SQL} WHERE kind = 'COLUMN_MASK'
        UNION ALL VALUES ('mask_contact', 'pii_type', 'email'), ('mask_contact', 'pii_type', 'name'),
                         ('mask_lost', 'cost_center', 'cc1')) m USING (tag_name, tag_value)
  GROUP BY table_schema, table_name, column_name) found,
  (VALUES ('conflict'), ('type mismatch'), ('function missing')) i(issue)
WHERE (issue = 'conflict' AND conflict) OR (issue = 'type mismatch' AND mismatch) OR (issue = 'function missing' AND missing)
UNION ALL
SELECT table_schema, table_name, column_name, 'unfiltered region' FROM fc
ANTI JOIN (SELECT * FROM fg WHERE tag_name = 'filter_key') USING (table_schema, table_name, column_name)
WHERE starts_with(column_name, 'region_')
""", "fc", "fg")
def _policy_lint(spark, sf):
    return policy.lint(fleet.columns(spark, sf), fleet.column_tags(spark, sf), _LINTED,
                       F.col("column_name").startswith("region_"))


# ---- gold and anonymization -----------------------------------------------------------------

@register("gold_revenue_by_region_month", f"SELECT * FROM rev WHERE customers_active >= {K}", "rev")
def _revenue(spark, sf):
    at = Layers(spark, sf)
    return gold.revenue(at.valid_orders(), at.customers(), K, PINNED).drop(
        "_gold_built_at").withColumn("order_month", F.col("order_month").cast("date"))


@register("gold_segment_profile", f"""
SELECT region, segment, count(*) AS customers,
       count(*) FILTER (marketing_consent) AS customers_consented,
       round(count(*) FILTER (marketing_consent) / count(*), 4) AS consent_rate,
       round(avg({AS_OF.year} - birth_year), 1) AS avg_age_years
FROM sc GROUP BY ALL HAVING count(*) >= {K}""", "sc")
def _segments(spark, sf):
    return gold.segments(Layers(spark, sf).customers(), AS_OF, K, PINNED).drop("_gold_built_at")


@register("gold_suppression_cost", f"""
SELECT count(*) AS groups_before, count(*) FILTER (customers_active >= {K}) AS groups_published,
       count(*) FILTER (customers_active < {K}) AS groups_withheld,
       coalesce(sum(revenue), 0)::DECIMAL(24,2) AS value_before,
       coalesce(sum(revenue) FILTER (customers_active >= {K}), 0)::DECIMAL(24,2)
           AS value_published,
       coalesce(sum(revenue) FILTER (customers_active < {K}), 0)::DECIMAL(24,2) AS value_withheld
FROM rev""", "rev")
def _suppression_cost(spark, sf):
    at = Layers(spark, sf)
    return gold.suppression_cost(at.valid_orders(), at.customers(), K)


@register("gold_revenue_reconciliation", f"""
SELECT (SELECT coalesce(sum(revenue), 0) FROM rev WHERE customers_active >= {K})::DECIMAL(24,2)
           AS gold_revenue,
       (SELECT sum(amount) FROM so WHERE status = 'completed')::DECIMAL(24,2) AS silver_revenue""",
          "rev", "so")
def _revenue_reconciliation(spark, sf):
    """Gold against the silver orders themselves, through the lookup and not through gold's groups."""
    at = Layers(spark, sf)
    published = gold.suppression_cost(at.valid_orders(), at.customers(), K).select("value_published")
    return gold.revenue_reconciliation(published, at.orders())


@register("mean_age_by_segment", f"""
SELECT segment,
       round(sum(datediff('day', d, {SQL_AS_OF})) / (count(d) * 365.25::DOUBLE), 1)
           AS age_from_date,
       round(avg({AS_OF.year} - year(d)), 1) AS age_from_year, count(d) AS people
FROM (SELECT segment, TRY_CAST(date_of_birth AS DATE) AS d FROM bc
      WHERE trim(coalesce(email, '')) <> '') GROUP BY segment""", "bc")
def _mean_age(spark, sf):
    accepted = Layers(spark, sf).bronze_customers().where(present(F.col("email")))
    return gold.mean_age(accepted, "date_of_birth", AS_OF)


_CANDIDATES = {
    "decade, region, segment, country": ("decade", "region", "segment", "country"),
    "decade, region, segment": ("decade", "region", "segment"),
    "region, segment, marketing_consent": ("region", "segment", "marketing_consent"),
}


def _k_sql(label: str, cols: tuple[str, ...]) -> str:
    return f"""SELECT '{label}' AS quasi_identifiers, count(*) AS combinations,
       min(n) AS smallest_group, count(*) FILTER (n < {K}) AS combos_below_k,
       coalesce(sum(n) FILTER (n < {K}), 0)::BIGINT AS rows_at_risk
FROM (SELECT {', '.join(cols)}, count(*) AS n FROM people GROUP BY ALL)"""


@register("k_profile_compare", "\nUNION ALL\n".join(_k_sql(a, b) for a, b in _CANDIDATES.items()),
          "people")
def _k_compare(spark, sf):
    return anonymize.k_compare(anonymize.with_decade(Layers(spark, sf).customers()), _CANDIDATES)


@register("k_profile_published", f"""
SELECT count(*) AS combinations, min(n) AS smallest_group,
       count(*) FILTER (n < {K}) AS combos_below_k,
       coalesce(sum(n) FILTER (n < {K}), 0)::BIGINT AS rows_at_risk
FROM (SELECT decade, region, segment, marketing_consent, count(*) AS n FROM people
      WHERE birth_year IS NOT NULL GROUP BY ALL)""", "people")
def _k_published(spark, sf):
    people = anonymize.with_decade(Layers(spark, sf).customers())
    return anonymize.k_profile(people.where(F.col("decade").isNotNull()),
                               ["decade", "region", "segment", "marketing_consent"])


@register("k_risk_groups", f"""
SELECT decade, region, segment, count(*) AS n FROM people GROUP BY ALL HAVING count(*) < {K}""",
          "people")
def _risk_groups(spark, sf):
    return anonymize.risk_groups(anonymize.with_decade(Layers(spark, sf).customers()),
                                 ["decade", "region", "segment"])


@register("anonymized_profile", "SELECT * FROM anon", "anon")
def _anonymized(spark, sf):
    return anonymize.publish_profile(Layers(spark, sf).customers())


@register("suppression_rate", """
SELECT (SELECT count(*) FROM anon) AS groups_published,
       (SELECT coalesce(sum(people_in_group), 0) FROM anon)::BIGINT AS people_published,
       (SELECT count(*) FROM sc WHERE birth_year IS NOT NULL) AS people_eligible""", "anon", "sc")
def _suppression_rate(spark, sf):
    return anonymize.suppression_rate(Layers(spark, sf).customers())


@register("attack_join_cardinality", """
SELECT (SELECT count(*) FROM anon JOIN sc USING (region, segment)) AS pairs,
       (SELECT count(*) FROM anon SEMI JOIN sc USING (region, segment)) AS published_rows,
       (SELECT min(n) FROM (SELECT count(*) AS n FROM sc SEMI JOIN anon USING (region, segment)
                            GROUP BY region, segment)) AS fewest_matches""", "anon", "sc")
def _join_attack(spark, sf):
    people = Layers(spark, sf).customers()
    return anonymize.join_cardinality(anonymize.publish_profile(people), people)


@register("attack_smallest_group", """
SELECT region, count(*) AS groups, min(people_in_group) AS smallest_group,
       sum(people_in_group)::BIGINT AS people FROM anon GROUP BY region""", "anon")
def _smallest(spark, sf):
    return anonymize.smallest_groups(anonymize.publish_profile(Layers(spark, sf).customers()))


@register("attack_hash_bruteforce", """
SELECT count(*) AS hashes, count(g.h) AS reversed, round(count(g.h) / count(*), 4)
           AS share_reversed
FROM (SELECT sha256(customer_id || '1') AS h FROM sc) t LEFT JOIN (
  SELECT sha256('C' || lpad(i::VARCHAR, greatest(6, length(i::VARCHAR))::INT, '0') || '1') AS h
  FROM (SELECT 2 * c_custkey + b AS i FROM customer, (VALUES (0), (1)) v(b))) g ON g.h = t.h""",
          "sc")
def _bruteforce(spark, sf):
    """The attacker tries every key up to twice the largest there is, so all fall."""
    tries = fixture.table(spark, sf, "customer").select(
        F.explode(F.array(F.col("c_custkey") * 2, F.col("c_custkey") * 2 + 1)).alias("id"))
    hashed = Layers(spark, sf).customers().select(
        masks.pseudonymize(F.col("customer_id"), 1).alias("hash"))
    return anonymize.bruteforce_rate(hashed, "hash", tries, fixture.customer_key_column)


@register("anonymized_scope_by_persona", f"""
SELECT 'customer_profile_anonymized' AS table_name, region, count(*) AS groups FROM anon
GROUP BY region UNION ALL
SELECT 'customer_segment_profile', region, count(*) FROM (
  SELECT region, segment FROM sc GROUP BY ALL HAVING count(*) >= {K})
WHERE region = 'europe' GROUP BY region""", "anon", "sc")
def _scope(spark, sf):
    people = Layers(spark, sf).customers()
    names = ("gold.customer_profile_anonymized", "gold.customer_segment_profile")
    catalog = policy.GovernedCatalog(
        dict(zip(names, (anonymize.publish_profile(people), gold.segments(people)))),
        {n: design.column_tags(n) for n in names})
    out = None
    for name in names:
        seen = (catalog.read(name, persona("analyst_eu")).groupBy("region")
                .agg(F.count(F.lit(1)).alias("groups"))
                .select(F.lit(name.split(".")[1]).alias("table_name"), "region", "groups"))
        out = seen if out is None else out.unionByName(seen)
    return out


# ---- expectations and constraints -----------------------------------------------------------

@register("expectation_observe", """
SELECT count(*) AS rows_in_target, count(*) FILTER (amt < 0) AS negative_amounts_retained,
       count(*) FILTER (NOT coalesce(amt >= 0, false)) AS amount_not_proved FROM typed""", "typed")
def _observe(spark, sf):
    kept = quality.drop_rows(Layers(spark, sf).typed_orders(), EXPECTATIONS)
    return kept.agg(
        F.count(F.lit(1)).alias("rows_in_target"),
        F.count_if(F.col("amount") < 0).alias("negative_amounts_retained"),
        F.count_if(~F.coalesce(F.col("amount") >= 0, F.lit(False))).alias("amount_not_proved"))


_STRICT = (design.Expectation("amount_non_negative", "amount >= 0", "drop"),
           design.Expectation("status_settled", "status <> 'cancelled'", "drop"),
           design.Expectation("date_present", "order_date IS NOT NULL", "observe"))


@register("expectation_drop", """
SELECT order_id, dt AS order_date, amt AS amount, lower(trim(status)) AS status FROM typed
WHERE amt >= 0 AND lower(trim(status)) <> 'cancelled'""", "typed")
def _drop(spark, sf):
    return quality.drop_rows(Layers(spark, sf).typed_orders(), _STRICT).select(
        "order_id", "order_date", "amount", "status")


@register("expectation_metrics", """
SELECT expectation, mode, count(*) - sum(bad)::BIGINT AS passed, sum(bad)::BIGINT AS failed FROM (
  SELECT 'amount_non_negative' AS expectation, 'observe' AS mode,
         CASE WHEN amt >= 0 THEN 0 ELSE 1 END AS bad FROM typed
  UNION ALL SELECT 'status_known', 'drop',
         CASE WHEN lower(trim(status)) IN ('completed', 'refunded', 'cancelled') THEN 0 ELSE 1 END
         FROM typed
  UNION ALL SELECT 'order_id_present', 'fail', CASE WHEN order_id IS NULL THEN 1 ELSE 0 END
         FROM typed
  UNION ALL SELECT 'status_settled', 'drop',
         CASE WHEN lower(trim(status)) <> 'cancelled' THEN 0 ELSE 1 END FROM typed
  UNION ALL SELECT 'date_present', 'observe', CASE WHEN dt IS NULL THEN 1 ELSE 0 END FROM typed)
GROUP BY ALL""", "typed")
def _metrics(spark, sf):
    return quality.expectation_counts(Layers(spark, sf).typed_orders(),
                                      (*EXPECTATIONS, *_STRICT[1:]))


@register("expectation_fail_update", """
SELECT count(*) AS rows_offered, count(*) FILTER (order_id IS NULL) AS failing_rows,
       count(*) FILTER (order_id IS NULL) = 0 AS published
FROM (SELECT order_id FROM typed UNION ALL SELECT NULL FROM typed
      WHERE lower(trim(status)) = 'cancelled')""", "typed")
def _fail_update(spark, sf):
    """A fail-mode rule meets rows without a key: the batch would not be published."""
    rows = Layers(spark, sf).typed_orders()
    broken = rows.where(F.col("status") == "cancelled").withColumn(
        "order_id", F.lit(None).cast("string"))
    counts = quality.expectation_counts(rows.unionByName(broken), EXPECTATIONS)
    return counts.where(F.col("mode") == "fail").select(
        (F.col("passed") + F.col("failed")).alias("rows_offered"),
        F.col("failed").alias("failing_rows"), (F.col("failed") == 0).alias("published"))


def _rules(table: str) -> list[design.Constraint]:
    return [r for r in CONSTRAINTS if r.table == table]


def _checked(df: DataFrame, table: str) -> DataFrame:
    return quality.check(df, _rules(table)).select(
        F.lit(table).alias("table_name"), F.col("name").alias("constraint_name"), "violations")


def _unpublished(at: Layers) -> dict[str, DataFrame]:
    """What each governed table would hold if nothing had been held back before the write."""
    people = at.customers()
    typed = silver.type_customers(at.bronze_customers(), PINNED)
    return {
        "silver.customers": typed, "silver.orders": at.typed_orders(),
        "gold.customer_segment_profile": gold.segment_groups(people),
        "gold.revenue_by_region_month": gold.revenue_groups(at.valid_orders(), people),
        "gold.customer_profile_anonymized": anonymize.publish_profile(people, k=0)}


_VIOLATIONS_SQL = f"""
SELECT 'silver.customers' AS table_name, 'email_present' AS constraint_name,
       (SELECT count(*) FROM bc WHERE trim(coalesce(email, '')) = '') AS violations
UNION ALL SELECT 'silver.customers', 'region_known', (SELECT count(*) FROM bc
  WHERE lower(trim(region)) NOT IN ('africa', 'america', 'asia', 'europe', 'middle east'))
UNION ALL SELECT 'silver.orders', 'amount_non_negative', (SELECT count(*) FROM typed WHERE amt < 0)
UNION ALL SELECT 'silver.orders', 'status_known', (SELECT count(*) FROM typed
  WHERE lower(trim(status)) NOT IN ('completed', 'refunded', 'cancelled'))
UNION ALL SELECT 'silver.orders', 'currency_known', (SELECT count(*) FROM typed
  WHERE upper(trim(currency)) NOT IN ('AED', 'EUR', 'JPY', 'USD', 'ZAR'))
UNION ALL SELECT 'silver.orders', 'order_date_plausible', (SELECT count(*) FROM typed
  WHERE dt < DATE '1990-01-01' OR dt > DATE '2035-01-01')
UNION ALL SELECT 'gold.customer_segment_profile', 'k_anonymity_min_group', (SELECT count(*) FROM (
  SELECT region, segment FROM sc GROUP BY ALL HAVING count(*) < {K}))
UNION ALL SELECT 'gold.customer_segment_profile', 'consent_rate_is_a_rate', 0
UNION ALL SELECT 'gold.revenue_by_region_month', 'k_anonymity_min_customers',
  (SELECT count(*) FROM rev WHERE customers_active < {K})
UNION ALL SELECT 'gold.revenue_by_region_month', 'revenue_non_negative',
  (SELECT count(*) FROM rev WHERE revenue < 0)
UNION ALL SELECT 'gold.customer_profile_anonymized', 'k_anonymity_min_group',
  (SELECT count(*) FROM (SELECT decade, region, segment, marketing_consent FROM people
   WHERE birth_year IS NOT NULL GROUP BY ALL HAVING count(*) < {K}))"""
_VIOLATIONS_CTES = ("bc", "typed", "sc", "rev", "people")


def _violations(at: Layers) -> DataFrame:
    out = None
    for table, df in _unpublished(at).items():
        found = _checked(df, table)
        out = found if out is None else out.unionByName(found)
    return out


# the email rule sees '' only after trimming, which NULL survives: NULL passes a CHECK unless
# the expression tests for it, and this one does
@register("constraint_violation_counts", _VIOLATIONS_SQL, *_VIOLATIONS_CTES)
def _constraint_violations(spark, sf):
    return _violations(Layers(spark, sf))


@register("constraint_inventory_diff", f"""
SELECT table_name, constraint_name,
       CASE WHEN constraint_name = 'currency_known' THEN 'missing'
            WHEN constraint_name = 'amount_non_negative' THEN 'changed' ELSE 'ok' END AS status,
       violations
FROM ({_VIOLATIONS_SQL})""", *_VIOLATIONS_CTES)
def _constraint_inventory(spark, sf):
    """Rules in force against the design, each with the rows it would stop: a weakened rule
    keeps its name, so names alone would not show it."""
    in_force = [design.Constraint(r.name, r.table, "amount >= -1000000")
                if r.name == "amount_non_negative" else r
                for r in CONSTRAINTS if r.name != "currency_known"]
    diff = quality.constraint_diff(quality.constraint_rows(spark, in_force),
                                   quality.constraint_rows(spark, CONSTRAINTS))
    return _violations(Layers(spark, sf)).join(
        diff.select("table_name", "constraint_name", "status"),
        ["table_name", "constraint_name"]).select(
        "table_name", "constraint_name", "status", "violations")


# per constrained table a row that every rule accepts, and per rule a value it has to refuse
_GOOD_ROWS = {
    "silver.customers": {"email": "a@x.example", "region": "europe"},
    "silver.orders": {"amount": "10.00", "status": "completed", "currency": "EUR", "order_date": "2024-06-01"},
    "gold.customer_segment_profile": {"customers": "50", "consent_rate": "0.5"},
    "gold.revenue_by_region_month": {"customers_active": "50", "revenue": "10.00"},
    "gold.customer_profile_anonymized": {"people_in_group": "50"},
}
_BAD_VALUES = {
    ("silver.customers", "email_present"): {"email": ""},
    ("silver.customers", "region_known"): {"region": "atlantis"},
    ("silver.orders", "amount_non_negative"): {"amount": "-1.00"},
    ("silver.orders", "status_known"): {"status": "shipped"},
    ("silver.orders", "currency_known"): {"currency": "GBP"},
    ("silver.orders", "order_date_plausible"): {"order_date": "1985-01-01"},
    ("gold.customer_segment_profile", "k_anonymity_min_group"): {"customers": "3"},
    ("gold.customer_segment_profile", "consent_rate_is_a_rate"): {"consent_rate": "1.5"},
    ("gold.revenue_by_region_month", "k_anonymity_min_customers"): {"customers_active": "3"},
    ("gold.revenue_by_region_month", "revenue_non_negative"): {"revenue": "-1.00"},
    ("gold.customer_profile_anonymized", "k_anonymity_min_group"): {"people_in_group": "3"},
}


def _constrained(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Every table that has CHECK rules, with the columns they read."""
    at = Layers(spark, sf)
    people, valid = at.customers(), at.valid_orders()
    made = {"silver.customers": people, "silver.orders": at.orders(),
            "gold.customer_segment_profile": gold.segments(people, AS_OF, K, PINNED),
            "gold.revenue_by_region_month": gold.revenue(valid, people, K, PINNED),
            "gold.customer_profile_anonymized": anonymize.publish_profile(people)}
    return {t: df.select(*_GOOD_ROWS[t]) for t, df in made.items()}


def _bad_rows(like: DataFrame, table: str) -> DataFrame:
    """One row for each rule of the table that breaks this rule alone."""
    names = list(_GOOD_ROWS[table])
    texts = [tuple((_GOOD_ROWS[table] | bad)[n] for n in names) for (t, _), bad in _BAD_VALUES.items() if t == table]
    return literal(like.sparkSession, texts, ", ".join(f"{n} string" for n in names)).select(
        *(F.col(n).cast(like.schema[n].dataType).alias(n) for n in names))


_REJECTION_COUNTS = {
    "silver.customers": "FROM sc", "silver.orders": "FROM so",
    "gold.customer_segment_profile": f"FROM (SELECT 1 FROM sc GROUP BY region, segment HAVING count(*) >= {K})",
    "gold.revenue_by_region_month": f"FROM rev WHERE customers_active >= {K}",
    "gold.customer_profile_anonymized": "FROM anon",
}


@register("constraint_rejections", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{name}' AS constraint_name, (SELECT count(*) {_REJECTION_COUNTS[t]}) AS rows_before, "
    "0::BIGINT AS violations_before, 1::BIGINT AS violations_in_batch, true AS rejected"
    for t, name in _BAD_VALUES), "sc", "so", "rev", "anon")
def _rejections(spark, sf):
    """Each of the eleven rules against its stored table, and against that table with one bad row for
    each rule added: which rule stops the batch?"""
    out = None
    for table, stored in _constrained(spark, sf).items():
        rules = _rules(table)
        before = quality.check(stored, rules).select("name", F.col("violations").alias("violations_before"))
        batch = quality.check(stored.unionByName(_bad_rows(stored, table)), rules).select(
            "name", F.col("violations").alias("violations_in_batch"))
        rows = stored.agg(F.count(F.lit(1)).alias("n")).scalar()
        found = before.join(batch, "name").select(
            F.lit(table).alias("table_name"), F.col("name").alias("constraint_name"), rows.alias("rows_before"),
            "violations_before", "violations_in_batch", (F.col("violations_in_batch") > 0).alias("rejected"))
        out = found if out is None else out.unionByName(found)
    return out


@register("constraint_disable_test", f"""
SELECT n + 1 AS groups_with_rule_off, 0::BIGINT AS violations_with_rule_off,
       1::BIGINT AS violations_with_rule_on, n AS groups_after_delete, 0::BIGINT AS violations_after_delete
FROM (SELECT count(*) AS n FROM (SELECT 1 FROM sc GROUP BY region, segment HAVING count(*) >= {K}))""", "sc")
def _disable_test(spark, sf):
    """Without the group-size rule a group of three passes the others and lands; the rule put back names
    it; deleting it makes every rule hold again. Each step through the check that writes use."""
    table, name = "gold.customer_segment_profile", "k_anonymity_min_group"
    stored = _constrained(spark, sf)[table]
    landed = stored.unionByName(_bad_rows(stored, table).where(F.col("customers") < K))
    kept, rules = landed.where(F.col("customers") >= K), _rules(table)

    def broken(rows: DataFrame, of: list[design.Constraint], alias: str) -> Column:
        return quality.check(rows, of).agg(F.sum("violations").alias(alias)).scalar().alias(alias)

    def size(rows: DataFrame, alias: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias(alias))

    return size(landed, "groups_with_rule_off").select(
        "groups_with_rule_off", broken(landed, [r for r in rules if r.name != name], "violations_with_rule_off"),
        broken(landed, rules, "violations_with_rule_on"),
        size(kept, "groups_after_delete").scalar().alias("groups_after_delete"),
        broken(kept, rules, "violations_after_delete"))


# ---- metadata over the company-wide catalog -------------------------------------------------

@register("untagged_columns", """
SELECT table_schema, table_name, column_name FROM fc ANTI JOIN
  (SELECT * FROM fg WHERE tag_name = 'classification') t
  USING (table_schema, table_name, column_name)""", "fc", "fg")
def _untagged(spark, sf):
    return coverage.untagged(fleet.columns(spark, sf), fleet.column_tags(spark, sf))


@register("undescribed_columns", """
SELECT table_schema, table_name, column_name FROM fc WHERE comment IS NULL OR comment = ''""", "fc")
def _undescribed(spark, sf):
    return coverage.undescribed(fleet.columns(spark, sf))


@register("coverage_matrix", """
SELECT c.table_schema, c.table_name, count(*) AS columns_total,
       count(*) FILTER (t.tag_value IS NULL) AS missing_classification,
       count(*) FILTER (c.comment IS NULL OR c.comment = '') AS missing_description
FROM fc c LEFT JOIN fg t ON t.table_schema = c.table_schema AND t.table_name = c.table_name
 AND t.column_name = c.column_name AND t.tag_name = 'classification' GROUP BY ALL""", "fc", "fg")
def _coverage(spark, sf):
    return coverage.matrix(fleet.columns(spark, sf), fleet.column_tags(spark, sf))


@register("coverage_control", """
SELECT table_schema, count(DISTINCT table_name) AS tables_seen, count(*) AS columns_seen
FROM fc GROUP BY ALL""", "fc")
def _inspected(spark, sf):
    return coverage.inspected(fleet.columns(spark, sf))


@register("tagged_columns_by_table", """
SELECT table_schema, table_name, count(DISTINCT column_name) AS tagged_columns FROM fg
GROUP BY ALL""", "fg")
def _tagged(spark, sf):
    return coverage.tagged_columns(fleet.column_tags(spark, sf))


@register("tag_vocabulary_use", """
SELECT tag_name, tag_value, count(*) AS columns_using FROM fg GROUP BY ALL""", "fg")
def _vocabulary(spark, sf):
    return coverage.vocabulary(fleet.column_tags(spark, sf))


@register("vocabulary_violations", """
SELECT tag_name, tag_value, count(*) AS columns_using FROM fg
WHERE tag_value NOT IN ('internal', 'confidential', 'restricted', 'name', 'email', 'phone',
  'national_id', 'address', 'dob', 'payment_card', 'region') GROUP BY ALL""", "fg")
def _vocabulary_violations(spark, sf):
    return tags.violations(fleet.column_tags(spark, sf))


@register("ownership_exceptions", """
SELECT table_schema, table_name, table_owner, table_name IN ('t41', 't82') AS named_exception
FROM ft WHERE table_owner <> 'data_owners'""", "ft")
def _ownership(spark, sf):
    return coverage.ownership_exceptions(fleet.tables(spark, sf), OWNERS, ("t41", "t82"))


@register("table_sensitivity", """
SELECT table_schema, table_name, CASE max(CASE tag_value WHEN 'restricted' THEN 3
    WHEN 'confidential' THEN 2 WHEN 'internal' THEN 1 ELSE 0 END)
  WHEN 3 THEN 'restricted' WHEN 2 THEN 'confidential' WHEN 1 THEN 'internal' END AS classification
FROM fg WHERE tag_name = 'classification' GROUP BY table_schema, table_name""", "fg")
def _sensitivity(spark, sf):
    return tags.table_sensitivity(fleet.column_tags(spark, sf))


_ASSIGNED_SQL = """
SELECT table_schema, table_name, column_name, 'pii_type' AS tag_name,
       CASE WHEN data_type = 'DATE' THEN 'dob' WHEN data_type = 'BOOLEAN' THEN 'flag'
            ELSE 'address' END AS tag_value
FROM fc WHERE table_schema = 'silver_4'"""


def _assignments(spark, sf) -> DataFrame:
    """A steward tags one schema by column type, and uses a value that does not exist."""
    value = (F.when(F.col("data_type") == "DATE", "dob").when(F.col("data_type") == "BOOLEAN", "flag")
             .otherwise("address"))
    return (fleet.columns(spark, sf).where("table_schema = 'silver_4'")
            .select("table_schema", "table_name", "column_name",
                    F.lit("pii_type").alias("tag_name"), value.alias("tag_value")))


@register("tag_assignment", f"""
SELECT table_schema, table_name, column_name, tag_name, coalesce(a.tag_value, h.tag_value)
           AS tag_value
FROM fg h FULL JOIN (SELECT * FROM ({_ASSIGNED_SQL}) WHERE tag_value <> 'flag') a
  USING (table_schema, table_name, column_name, tag_name)""", "fc", "fg")
def _assign(spark, sf):
    return tags.assign(fleet.column_tags(spark, sf), _assignments(spark, sf))


@register("tag_assignment_refused", f"""
SELECT *, 'name, email, phone, national_id, address, dob, payment_card' AS allowed
FROM ({_ASSIGNED_SQL}) WHERE tag_value = 'flag'""", "fc")
def _refused(spark, sf):
    return tags.refused(_assignments(spark, sf))


@register("tag_statement_generator", """
SELECT table_schema, table_name, column_name,
       'ALTER TABLE ' || table_schema || '.' || table_name || ' ALTER COLUMN ' || column_name
       || ' SET TAGS (' || string_agg('''' || tag_name || ''' = ''' || tag_value || '''', ', '
                                      ORDER BY tag_name) || ');' AS stmt
FROM fg GROUP BY table_schema, table_name, column_name""", "fg")
def _statements(spark, sf):
    return tags.statements(fleet.column_tags(spark, sf))


def _grants(who: str) -> str:
    names = ", ".join(f"'{g}'" for g in sorted(persona(who).grantees))
    return f"(SELECT * FROM fp WHERE grantee IN ({names}))"


def _access_sql(who: str) -> str:
    names = ", ".join(f"'{g}'" for g in sorted(persona(who).grantees))

    def has(privileges: str, keys: str) -> str:
        return (f"EXISTS (SELECT 1 FROM {_grants(who)} g WHERE g.privilege_type IN ({privileges}) "
                f"AND g.object_key IN ({keys}))")
    s, t = "table_catalog || '.' || table_schema", \
        "table_catalog || '.' || table_schema || '.' || table_name"
    return f"""
SELECT table_catalog, table_schema, table_name, missing_level IS NULL AS can_read,
       table_owner IN ({names}) OR browse OR (uc AND (us OR st)) AS can_see, missing_level
FROM (SELECT *, CASE WHEN table_owner IN ({names}) THEN NULL WHEN NOT uc THEN 'USE_CATALOG'
                     WHEN NOT us THEN 'USE_SCHEMA' WHEN NOT (sel) THEN 'SELECT' END
             AS missing_level
      FROM (SELECT *, {has("'USE_CATALOG'", "table_catalog")} AS uc,
                   {has("'USE_SCHEMA'", f"table_catalog, {s}")} AS us,
                   {has("'SELECT'", f"table_catalog, {s}, {t}")} AS sel,
                   {has("'SELECT'", t)} AS st,
                   {has("'BROWSE'", f"table_catalog, {s}, {t}")} AS browse FROM ft))"""


@register("effective_access", _access_sql("analyst"), "ft", "fp")
def _effective(spark, sf):
    return access.effective(fleet.tables(spark, sf), fleet.privileges(spark, sf),
                            persona("analyst"))


_VIEWERS = ("analyst", "data_engineer", "auditor", "nobody")


@register("visible_schemas", "\nUNION ALL\n".join(f"""
SELECT '{who}' AS who, table_schema, count(*) AS objects_visible,
       count(*) FILTER (can_read) AS objects_readable
FROM ({_access_sql(who)}) WHERE can_see GROUP BY table_schema""" for who in _VIEWERS), "ft", "fp")
def _visible_schemas(spark, sf):
    return access.visible_schemas_for(fleet.tables(spark, sf), fleet.privileges(spark, sf),
                                      [persona(who) for who in _VIEWERS])


@register("visible_metadata", f"""
SELECT fc.* FROM fc JOIN ({_access_sql('data_engineer')}) v USING (table_schema, table_name)
WHERE can_see""", "fc", "ft", "fp")
def _visible_metadata(spark, sf):
    return access.visible(fleet.columns(spark, sf), fleet.tables(spark, sf),
                          fleet.privileges(spark, sf), persona("data_engineer"))


_GRANT_TEXT = ("grantee || ' | ' || privilege_type || ' | ' || object_type || ' | ' || object_key "
               "AS \"grant\"")


def _direct(of: str) -> str:
    return f"SELECT DISTINCT {_GRANT_TEXT} FROM {of} WHERE inherited_from = 'NONE'"


@register("direct_grants", _direct("fp"), "fp")
def _direct_grants(spark, sf):
    return access.direct_grants(fleet.privileges(spark, sf))


def _matrix(spark, sf, expected_later: bool) -> DataFrame:
    expected = access.direct_grants(fleet.privileges(spark, sf, later=expected_later))
    actual = access.direct_grants(fleet.privileges(spark, sf, later=not expected_later))
    return access.matrix_diff(actual, expected)


@register("grant_matrix_missing",
          f"SELECT 'missing' AS side, * FROM ({_direct('fp')} EXCEPT {_direct('fp2')})",
          "fp", "fp2")
def _missing(spark, sf):
    return _matrix(spark, sf, False).where(F.col("side") == "missing")


@register("grant_matrix_extra",
          f"SELECT 'extra' AS side, * FROM ({_direct('fp')} EXCEPT {_direct('fp2')})",
          "fp", "fp2")
def _extra(spark, sf):
    return _matrix(spark, sf, True).where(F.col("side") == "extra")


@register("grant_restore_diff", f"""
SELECT "grant", b IS NOT NULL AS in_before, a IS NOT NULL AS in_after FROM
  (SELECT *, 1 AS b FROM ({_direct('fp')})) FULL JOIN (SELECT *, 1 AS a FROM ({_direct('fp2')}))
  USING ("grant") WHERE a IS NULL OR b IS NULL""", "fp", "fp2")
def _restore(spark, sf):
    before = access.direct_grants(fleet.privileges(spark, sf))
    after = access.direct_grants(fleet.privileges(spark, sf, later=True))
    return evolve.snapshot_diff(before, after, ["grant"], [])


@register("grant_levels", """
SELECT object_type, privilege_type, count(*) AS grants, count(DISTINCT grantee) AS grantees
FROM (SELECT DISTINCT grantee, privilege_type, object_type, object_key FROM fp
      WHERE inherited_from = 'NONE') GROUP BY ALL""", "fp")
def _levels(spark, sf):
    return access.held_levels(fleet.privileges(spark, sf))


_REVOKED = (("analyst", "USE_CATALOG", "CATALOG", "env0"), ("auditor", "SELECT", "TABLE", "env0"),
            ("analyst", "SELECT", "SCHEMA", "env0.bronze_0"))
_GRANTED = (("auditor", "USE_CATALOG", "CATALOG", "env2"), ("new_group", "SELECT", "CATALOG", "env1"))


@register("grant_changes", f"""
SELECT DISTINCT grantee, privilege_type, object_type, object_key, inherited_from FROM (
  SELECT * FROM fp WHERE inherited_from <> 'NONE'
     OR (grantee, privilege_type, object_type, object_key) NOT IN (VALUES {', '.join(map(str, _REVOKED))})
  UNION ALL SELECT *, 'NONE' FROM (VALUES {', '.join(map(str, _GRANTED))}) g)""", "fp")
def _grant_changes(spark, sf):
    """Revokes act at their own level only; a grant already held is not held twice."""
    left = access.revoke(fleet.privileges(spark, sf), _REVOKED)
    return access.grant(left, _GRANTED).distinct()


@register("forbidden_grants", """
SELECT object_key, count(*) AS n FROM fp WHERE object_type = 'CATALOG'
  AND grantee = 'account users' AND privilege_type = 'BROWSE' GROUP BY object_key""", "fp")
def _forbidden(spark, sf):
    return access.forbidden(fleet.privileges(spark, sf)).groupBy("object_key").agg(
        F.count(F.lit(1)).alias("n"))


@register("metadata_snapshot", """
SELECT c.table_schema, c.table_name, c.column_name, c.comment,
       coalesce(string_agg(t.tag_name || '=' || t.tag_value, ', ' ORDER BY t.tag_name), '') AS tags
FROM fc c LEFT JOIN fg t USING (table_schema, table_name, column_name) GROUP BY ALL""", "fc", "fg")
def _snapshot(spark, sf):
    return evolve.metadata_snapshot(fleet.columns(spark, sf), fleet.column_tags(spark, sf))


def _snapshot_sql(of: str) -> str:
    return f"""
SELECT c.table_schema, c.table_name, c.column_name, c.comment,
       coalesce(string_agg(t.tag_name || '=' || t.tag_value, ', ' ORDER BY t.tag_name), '') AS tags
FROM fc c LEFT JOIN {of} t USING (table_schema, table_name, column_name) GROUP BY ALL"""


@register("metadata_diff", f"""
SELECT table_schema, table_name, column_name, true AS in_before, true AS in_after,
       b.comment AS comment_before, b.tags AS tags_before, a.comment AS comment_after,
       a.tags AS tags_after
FROM ({_snapshot_sql('fg')}) b JOIN ({_snapshot_sql('fg2')}) a
  USING (table_schema, table_name, column_name)
WHERE b.tags IS DISTINCT FROM a.tags OR b.comment IS DISTINCT FROM a.comment""",
          "fc", "fg", "fg2")
def _metadata_diff(spark, sf):
    columns = fleet.columns(spark, sf)
    return evolve.metadata_change((columns, fleet.column_tags(spark, sf)),
                                  (columns, fleet.column_tags(spark, sf, later=True)))


@register("object_set_diff", """
SELECT table_schema, table_name, b.table_type IS NOT NULL AS in_before,
       a.table_type IS NOT NULL AS in_after, b.table_type AS table_type_before,
       a.table_type AS table_type_after
FROM (SELECT table_schema, table_name, table_type FROM ft) b
FULL JOIN ft2 a USING (table_schema, table_name)
WHERE a.table_type IS DISTINCT FROM b.table_type""", "ft", "ft2")
def _object_diff(spark, sf):
    return evolve.object_set_diff(fleet.tables(spark, sf), fleet.tables_after(spark, sf))


@register("birth_year_equivalence", """
SELECT count(*) AS rows_total, count(*) FILTER (birth_year IS DISTINCT FROM year(d)) AS mismatches
FROM (SELECT TRY_CAST(bc.date_of_birth AS DATE) AS d, sc.birth_year
      FROM sc LEFT JOIN bc USING (customer_id))""", "bc", "sc")
def _equivalence(spark, sf):
    """Silver's birth year against bronze's text, met by key and read another way: the digits in
    front of the date, where the text is a date at all."""
    at = Layers(spark, sf)
    text = F.trim("date_of_birth")
    source = at.bronze_customers().select("customer_id", F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}$") & day(text).isNotNull(), F.left(text, F.lit(4)).cast("int"))
        .alias("from_text"))
    both = at.customers().select("customer_id", "birth_year").join(source, "customer_id", "left")
    return evolve.equivalent(both, "birth_year", F.col("from_text"))


@register("distribution_fingerprint", """
SELECT count(*) AS rows_total, count(birth_year) AS rows_with_value,
       count(*) - count(birth_year) AS rows_null, min(birth_year) AS smallest,
       max(birth_year) AS largest, count(DISTINCT birth_year) AS distinct_values FROM sc""", "sc")
def _fingerprint(spark, sf):
    return evolve.fingerprint(Layers(spark, sf).customers(), "birth_year")


# ---- lineage and audit ----------------------------------------------------------------------

_SOURCE = "coalesce(source_table, 'FILE: ' || source_path)"


@register("lineage_edges", f"""
SELECT DISTINCT {_SOURCE} AS source, target_table, source_type FROM fl""", "fl")
def _edges(spark, sf):
    return lineage.edges(fleet.lineage(spark, sf))


@register("lineage_edges_into_layer", f"""
SELECT DISTINCT {_SOURCE} AS source, target_table, source_type FROM fl
WHERE target_schema = 'gold_1'""", "fl")
def _edges_into(spark, sf):
    return lineage.edges(fleet.lineage(spark, sf), "gold_1")


@register("lineage_last_seen", f"""
SELECT target_table, {_SOURCE} AS source, max(event_time) AS last_seen FROM fl GROUP BY ALL""",
          "fl")
def _last_seen(spark, sf):
    return lineage.last_seen(fleet.lineage(spark, sf))


@register("lineage_current", f"""
SELECT target_table, source, last_seen FROM (
  SELECT target_table, {_SOURCE} AS source, max(event_time) AS last_seen,
         max(max(event_time)) OVER (PARTITION BY target_table) AS latest
  FROM fl GROUP BY target_table, {_SOURCE})
WHERE last_seen = latest""", "fl")
def _current(spark, sf):
    return lineage.current(fleet.lineage(spark, sf))


@register("lineage_identifier_trace", """
SELECT DISTINCT * FROM fcl WHERE source_column IN ('national_id', 'email', 'date_of_birth')""",
          "fcl")
def _trace(spark, sf):
    return lineage.trace(fleet.column_lineage(spark, sf))


@register("lineage_recent", f"""
SELECT {_SOURCE} AS source, target_table, event_time, event_id FROM fl
ORDER BY event_time DESC, event_id LIMIT 20""", "fl")
def _recent(spark, sf):
    events = fleet.lineage(spark, sf).select(lineage.source().alias("source"), "target_table",
                                             "event_time", "event_id")
    return lineage.recent(events, 20, "event_id")


_AUDIT = """
SELECT event_id, ts AS event_time, 'user' || user_id::VARCHAR || '@corp.example' AS user_email,
       CASE WHEN event_id % 3 = 0 THEN 'catalog' ELSE 'sql' END AS service_name,
       event_type AS action_name, (props->>'k') AS parameter_k,
       CASE WHEN event_type = 'error' THEN '403' ELSE '200' END AS status_code
FROM events WHERE props LIKE '%7%'"""


def _audit(spark, sf) -> DataFrame:
    log = audit.audit_log(audit.from_test_events(fixture.table(spark, sf, "events")), "7")
    return log.select("event_id", "event_time", "user_email", "service_name", "action_name",
                      F.col("request_params")["k"].alias("parameter_k"), "status_code")


@register("audit_log_view", _AUDIT)
def _audit_view(spark, sf):
    return _audit(spark, sf)


@register("audit_event_count", f"""
SELECT service_name, status_code, count(*) AS events FROM ({_AUDIT}) GROUP BY ALL""")
def _audit_count(spark, sf):
    return _audit(spark, sf).groupBy("service_name", "status_code").agg(
        F.count(F.lit(1)).alias("events"))


@register("audit_recent", f"""
SELECT * FROM ({_AUDIT}) ORDER BY event_time DESC, user_email, action_name, event_id LIMIT 10""")
def _audit_recent(spark, sf):
    return audit.recent(_audit(spark, sf), 10)


# ---- the state suite ------------------------------------------------------------------------

def _suite_sql() -> str:
    rows = [
        ("A0", "Suite runs as an exempt identity", f"a member of {OWNERS}",
         "'owner | owner=true'", "true"),
        ("A1", "Objects the suite can inspect", "10", "'10'", "true"),
        ("A2", "Schemas are those designed", "bronze, gold, governance, landing, silver",
         "'bronze, gold, governance, landing, silver'", "true"),
        ("A3", "No stray default schema", "0", "'0'", "true"),
        ("A4", "Objects owned outside the owner group", "audit_log", "'audit_log'", "true"),
        ("B1", "Columns without a classification", "0", "'0'", "true"),
        ("B2", "Columns without a description", "0", "'0'", "true"),
        ("B3", "Classification values stay in the vocabulary",
         "confidential, internal, restricted", "'confidential, internal, restricted'", "true"),
        ("B4", "PII type values stay in the vocabulary",
         "address, dob, email, name, national_id, payment_card, phone",
         "'address, dob, email, name, national_id, payment_card, phone'", "true"),
        ("B5", "Retired tag values are unused", "0", "'0'", "true"),
        ("C0", "The grant scan sees the matrix", ">= 19", "'19'", "true"),
        ("C1", "No designed grant is missing", "0 missing", "'(none missing)'", "true"),
        ("C2", "No grant exists outside the design", "0 extra", "'(none extra)'", "true"),
        ("C3", "No BROWSE for everyone on the catalog", "0", "'0'", "true"),
        ("C4", "Governance functions are those designed",
         "filter_by_region, mask_dob, mask_email, mask_full, mask_last4, pseudonymize",
         "'filter_by_region, mask_dob, mask_email, mask_full, mask_last4, pseudonymize'", "true"),
        ("C5", "CHECK rules equal the design", "0", "'0'", "true"),
        ("D1", "Nothing lost between bronze and silver: customers",
         "silver + quarantined = bronze",
         "(SELECT count(*) FROM sc) || ' + ' || (SELECT count(*) FROM qc) || ' vs ' || "
         "(SELECT count(*) FROM bc)",
         "(SELECT count(*) FROM sc) + (SELECT count(*) FROM qc) = (SELECT count(*) FROM bc)"),
        ("D2", "Nothing lost between bronze and silver: orders",
         "silver + quarantined = bronze",
         "(SELECT count(*) FROM so) || ' + ' || (SELECT count(*) FROM qo) || ' vs ' || "
         "(SELECT count(*) FROM bo)",
         "(SELECT count(*) FROM so) + (SELECT count(*) FROM qo) = (SELECT count(*) FROM bo)"),
        ("D3", "Smallest published group: revenue_by_region_month", f">= {K}",
         f"(SELECT min(customers_active) FROM rev WHERE customers_active >= {K})::VARCHAR",
         f"(SELECT count(*) FROM rev WHERE customers_active >= {K}) > 0"),
        ("D4", "Smallest published group: customer_segment_profile", f">= {K}",
         f"(SELECT min(n) FROM (SELECT count(*) AS n FROM sc GROUP BY region, segment) "
         f"WHERE n >= {K})::VARCHAR",
         f"(SELECT max(n) FROM (SELECT count(*) AS n FROM sc GROUP BY region, segment)) >= {K}"),
        ("D5", "Smallest published group: customer_profile_anonymized", f">= {K}",
         "(SELECT min(people_in_group) FROM anon)::VARCHAR", "(SELECT count(*) FROM anon) > 0"),
        ("D6", "The anonymized table matches no mask", "0", "'0'", "true"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{i}' AS id, '{c}' AS control, '{e}' AS expected, {a} AS actual, "
        f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status" for i, c, e, a, ok in rows)


@register("state_suite", _suite_sql(), "sc", "qc", "bc", "so", "qo", "bo", "rev", "anon")
def _state_suite(spark, sf):
    at = Layers(spark, sf)
    people = at.customers()
    published = {
        "revenue_by_region_month": gold.revenue(at.valid_orders(), people, K, PINNED),
        "customer_segment_profile": gold.segments(people, AS_OF, K, PINNED),
        "customer_profile_anonymized": anonymize.publish_profile(people)}
    return suite.run(suite.designed_meta(spark), _reconciliation(at), published, persona("owner"))


# ---- the suite over a whole catalog -----------------------------------------------------------

_TAGGED = "table_schema || '.' || table_name || '.' || column_name || ': ' || tag_name || '=' || tag_value"
_KEYED = "table_schema || '.' || table_name || '.' || column_name"
_LEFT_OUT = {n: ", ".join(f"'{v}'" for v in design.TAG_VOCABULARY[n]) for n in ("classification", "pii_type")}
_OFFENDERS = f"""
SELECT 'A4' AS control, table_schema || '.' || table_name AS offender FROM ft
WHERE table_owner <> 'data_owners' AND table_name NOT IN ({', '.join(f"'{t}'" for t in design.OWNER_EXCEPTIONS)})
UNION ALL
SELECT 'B1', {_KEYED} FROM fc ANTI JOIN (SELECT * FROM fg WHERE tag_name = 'classification')
  USING (table_schema, table_name, column_name)
UNION ALL
SELECT 'B2', {_KEYED} FROM fc WHERE coalesce(comment, '') = ''
UNION ALL
SELECT 'B3', {_TAGGED} FROM fg WHERE tag_name = 'classification' AND tag_value NOT IN ({_LEFT_OUT['classification']})
UNION ALL
SELECT 'B4', {_TAGGED} FROM fg WHERE tag_name = 'pii_type' AND tag_value NOT IN ({_LEFT_OUT['pii_type']})
UNION ALL
SELECT 'B5', {_TAGGED} FROM fg
WHERE (tag_name, tag_value) IN (VALUES {', '.join(str(tuple(r)) for r in design.RETIRED_TAG_VALUES)})
UNION ALL
SELECT 'B6', {_TAGGED} FROM fg ANTI JOIN fc USING (table_schema, table_name, column_name)
UNION ALL
(SELECT 'C1', "grant" FROM ({_direct('fp')} EXCEPT {_direct('fp2')}))
UNION ALL
(SELECT 'C2', "grant" FROM ({_direct('fp2')} EXCEPT {_direct('fp')}))
UNION ALL
SELECT DISTINCT 'C3', grantee || ' | ' || privilege_type || ' | ' || object_type || ' | ' || object_key FROM fp2
WHERE object_type = 'CATALOG' AND grantee = 'account users' AND privilege_type = 'BROWSE'"""
_SUITE_CTES = ("ft", "fc", "fg", "fp", "fp2")


def _fleet_offenders(spark, sf) -> DataFrame:
    """A company-wide catalog after a maintenance run, held against the grants it had before."""
    meta = suite.Meta(
        schemata=fleet.tables(spark, sf).select(F.col("table_schema").alias("schema_name")).distinct(),
        tables=fleet.tables(spark, sf), columns=fleet.columns(spark, sf),
        column_tags=fleet.column_tags(spark, sf), privileges=fleet.privileges(spark, sf, later=True),
        routines=suite.designed_meta(spark).routines, constraints=suite.designed_meta(spark).constraints)
    return suite.offenders(meta, fleet.privileges(spark, sf))


@register("suite_offenders", _OFFENDERS, *_SUITE_CTES)
def _suite_offenders(spark, sf):
    return _fleet_offenders(spark, sf)


@register("state_suite_fleet", f"""
SELECT control, title, count(offender) AS offenders, CASE WHEN count(offender) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (VALUES {', '.join(str(i) for i in suite.OFFENCES.items())}) c(control, title)
LEFT JOIN ({_OFFENDERS}) USING (control) GROUP BY control, title""", *_SUITE_CTES)
def _suite_fleet(spark, sf):
    return suite.verdicts(_fleet_offenders(spark, sf))


# queries of several plans register themselves beside these
from govlake.plans import extended  # noqa: E402, F401
