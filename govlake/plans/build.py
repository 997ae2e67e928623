"""The medallion build: bronze in, silver and quarantine split, gold aggregates out.

Tags are registered before a table is published, so there is no moment at which a new table
can be read unmasked. Each step records its lineage. Classified orders are written once and
both silver outputs read that table, so the lookup of the parent is paid once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake import design
from govlake.design import CONSTRAINTS, K
from govlake.functions.masks import FUNCTIONS, register_sql
from govlake.functions.rows import literal
from govlake.functions.values import as_time
from govlake.operators import anonymize, gold, lineage, policy, quality, silver, tags
from govlake.plans import suite
from govlake.plans.publish import COLUMN_LINEAGE, LINEAGE, RULES, TAGS, Lake, RunReport, publish, tag_tables
from govlake.principal import Principal, require_exempt


@dataclass
class Build:
    """A build in progress: tables published so far, their tags and their lineage."""

    lake: Lake
    principal: Principal
    at: str
    as_of: dt.date = design.AS_OF
    tags: dict[str, Mapping[str, Mapping[str, str]]] = field(default_factory=dict)
    reports: dict[str, RunReport] = field(default_factory=dict)
    edges: DataFrame | None = None
    column_edges: DataFrame | None = None

    def put(self, table: str, df: DataFrame, sources: list[str],
            renamed: Mapping[str, str] = MappingProxyType({})) -> DataFrame:
        """Tag, publish with its CHECK rules, describe, record lineage; return the table.

        A column comes from the column of its name in each source, or from the one `renamed` gives."""
        self.tags[table] = policy.tags_of(self.lake.held(TAGS), table)
        fresh = not self.lake.exists(table)
        self.reports[table] = publish(self.lake, df, table, self.principal)
        if fresh:
            self.lake.describe(table, {c: design.DESCRIPTIONS[c] for c in design.TABLES[table]})
        origins = {s: design.TABLES[s] for s in sources if s in design.TABLES}
        made_from = {c: [f"{s}.{renamed.get(c, c)}" for s, has in origins.items() if renamed.get(c, c) in has]
                     for c in df.columns}
        rows, columns = lineage.record(self.lake.spark, sources, table, self.at, made_from)
        self.edges = rows if self.edges is None else self.edges.unionByName(rows)
        self.column_edges = columns if self.column_edges is None else self.column_edges.unionByName(columns)
        return self.lake.read(table)

    def open_books(self) -> None:
        """Store the designed tags and CHECK rules before anything is published.

        Only what the lake has never known is added: a tag that a steward changed or removed, a rule
        that was dropped and the rules of other tables stay as they are."""
        self.lake.note_new(TAGS, tags.designed_tags(self.lake.spark))
        self.lake.note_new(RULES, quality.constraint_rows(self.lake.spark, CONSTRAINTS))

    def close_books(self) -> None:
        """Add this run's lineage to the history, and the tables' own tags."""
        self.lake.note(LINEAGE, self.edges)
        self.lake.note(COLUMN_LINEAGE, self.column_edges.withColumn("event_time", as_time(self.at)))
        tag_tables(self.lake)

    def meta(self, privileges: DataFrame) -> suite.Meta:
        """The metadata of what was built, read back from the lake's books.

        Ownership follows the builder's group, except where the design names an exception; tags
        and rules are those stored with the lake, functions those created in governance.
        """
        spark = self.lake.spark
        owner = F.when(F.col("table_name").isin(list(design.OWNER_EXCEPTIONS)), "platform").otherwise(
            design.OWNERS)
        functions = [(f.name,) for f in spark.catalog.listFunctions(f"{self.lake.env}governance")
                     if not f.isTemporary and f.name in FUNCTIONS]
        return suite.Meta(
            schemata=self.lake.schemas(),
            tables=self.lake.objects(*design.LAYERS).select(
                F.lit(design.CATALOG).alias("table_catalog"), "*", owner.alias("table_owner")),
            columns=self.lake.columns(*design.LAYERS),
            column_tags=self.lake.held(TAGS),
            privileges=privileges,
            routines=literal(spark, functions, "routine_name string"),
            constraints=self.lake.held(RULES))

    def catalog(self) -> policy.GovernedCatalog:
        return policy.GovernedCatalog({t: self.lake.read(t) for t in self.tags}, dict(self.tags))


def reopen(lake: Lake) -> policy.GovernedCatalog:
    """The governed catalog of a lake built in any session, from the tags stored with it."""
    return policy.GovernedCatalog({t: lake.read(t) for t in design.TABLES if lake.exists(t)},
                                  policy.StoredTags(lake.held(TAGS)))


def run(lake: Lake, bronze_customers: DataFrame, bronze_orders: DataFrame, principal: Principal,
        at: str, as_of: dt.date = design.AS_OF, k: int = K,
        audit_source: str | None = None) -> Build:
    """Build or refill every layer (actions). Bronze frames may come from any reader;
    `audit_source` names a table of audit events outside the layers."""
    require_exempt(principal)
    lake.create_schemas(*design.LAYERS)
    b = Build(lake, principal, at, as_of)
    b.open_books()
    people_raw = b.put("bronze.customers", bronze_customers, ["/landing/customers.csv"])
    orders_raw = b.put("bronze.orders", bronze_orders, ["/landing/orders.csv"])

    people = b.put("silver.customers", silver.customers(people_raw, at), ["bronze.customers"],
                   {"birth_year": "date_of_birth"})
    b.put("silver.quarantine_customers", silver.quarantine_customers(people_raw, at),
          ["bronze.customers"])

    labelled = silver.classify_orders(orders_raw, people_raw, as_of)
    publish(lake, labelled, "governance.classified_orders", principal,
            replace=lake.exists("governance.classified_orders"))
    accepted, rejected = quality.split(lake.read("governance.classified_orders"))
    orders = b.put("silver.orders", silver.type_orders(accepted, at),
                   ["bronze.orders", "silver.customers"])
    b.put("silver.quarantine_orders",
          rejected.withColumn("_quarantined_at", as_time(at)),
          ["bronze.orders", "bronze.customers", "silver.customers"])
    # the working copy holds raw card numbers: its files go with it
    lake.drop("governance.classified_orders")
    lake.delete_folder(f"{lake.root}/governance/classified_orders")

    b.put("gold.revenue_by_region_month", gold.revenue(orders, people, k, at),
          ["silver.orders", "silver.customers"])
    b.put("gold.customer_segment_profile", gold.segments(people, as_of, k, at),
          ["silver.customers"])
    b.put("gold.customer_profile_anonymized", anonymize.publish_profile(people, k),
          ["silver.customers"])
    register_sql(lake.spark, f"{lake.env}governance")
    lake.spark.sql(f"DROP FUNCTION {lake.env}governance.mask_dob_date")     # retired
    if audit_source is not None:
        _audit_view(b, audit_source)
    b.close_books()
    return b


def _audit_view(b: Build, source: str) -> None:
    """The audit view over a stored event table; a view is tagged but carries no mask."""
    name = "governance.audit_log"
    b.tags[name] = policy.tags_of(b.lake.held(TAGS), name)
    b.lake.create_view(name, f"""
        SELECT event_time, user_identity.email, service_name, action_name, request_params,
               response.status_code
        FROM {source} WHERE contains(to_json(request_params), '{design.CATALOG}')""",
        {c: design.DESCRIPTIONS[c] for c in design.TABLES[name]})


def reconciliation(lake: Lake) -> DataFrame:
    return quality.reconcile(
        "customers", lake.read("bronze.customers"), lake.read("silver.customers"),
        lake.read("silver.quarantine_customers")).unionByName(quality.reconcile(
            "orders", lake.read("bronze.orders"), lake.read("silver.orders"),
            lake.read("silver.quarantine_orders")))
