"""The intended state of the platform: layers, groups, vocabularies, tags, grants, rules.

Everything here is a design constant that checks compare against. Fixture facts (row counts
of one load) are never put here; they live in the tests.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

CATALOG = "prod"
LAYERS = ("bronze", "gold", "governance", "landing", "silver")

OWNERS = "data_owners"
ALL_USERS = "account users"
K = 5                                   # smallest group that may be published
AS_OF = dt.date(2026, 9, 21)            # pinned "today" of the checked queries

# Governed tags and the values each accepts.
TAG_VOCABULARY = {
    "classification": ("internal", "confidential", "restricted"),
    "pii_type": ("name", "email", "phone", "national_id", "address", "dob", "payment_card"),
    "filter_key": ("region",),
}
SENSITIVITY_RANK = {"internal": 1, "confidential": 2, "restricted": 3}
RETIRED_TAG_VALUES = (("pii_type", "dob_date"),)

# Value vocabularies of the business columns in the test tables.
REGIONS = ("africa", "america", "asia", "europe", "middle east")
CURRENCIES = ("AED", "EUR", "JPY", "USD", "ZAR")
STATUSES = ("completed", "refunded", "cancelled")
PLAUSIBLE_FROM, PLAUSIBLE_TO = "1990-01-01", "2035-01-01"

# Order reject reasons, first match wins.
ORDER_REASONS = ("orphan_customer", "customer_quarantined", "unparseable_amount",
                 "unparseable_date", "negative_amount", "future_order_date")

_CUSTOMER_TEXT = ("customer_id", "first_name", "last_name", "email", "phone", "date_of_birth",
                  "national_id", "street_address", "city", "postcode", "country", "region",
                  "segment", "marketing_consent", "created_at")
_ORDER_TEXT = ("order_id", "customer_id", "order_date", "amount", "currency", "card_number",
               "status")


def _strings(*names: str) -> dict[str, str]:
    return {name: "STRING" for name in names}


_BRONZE_CUSTOMERS = {**_strings(*_CUSTOMER_TEXT, "_rescued_data"), "_ingested_at": "TIMESTAMP"}
_BRONZE_ORDERS = {**_strings(*_ORDER_TEXT, "_rescued_data"), "_ingested_at": "TIMESTAMP"}
_REJECTED = {"reject_reason": "STRING", "_quarantined_at": "TIMESTAMP"}

# table -> column -> type; the ten objects a full build leaves behind
TABLES: dict[str, dict[str, str]] = {
    "bronze.customers": _BRONZE_CUSTOMERS,
    "bronze.orders": _BRONZE_ORDERS,
    "silver.customers": {
        **_strings("customer_id", "first_name", "last_name", "email", "phone", "national_id",
                   "street_address", "city", "postcode", "country", "region", "segment"),
        "marketing_consent": "BOOLEAN", "created_at": "TIMESTAMP", "_ingested_at": "TIMESTAMP",
        "_silver_built_at": "TIMESTAMP", "birth_year": "INT"},
    "silver.quarantine_customers": {**_BRONZE_CUSTOMERS, **_REJECTED},
    "silver.orders": {
        "order_id": "STRING", "customer_id": "STRING", "order_date": "DATE",
        "amount": "DECIMAL(12,2)", "currency": "STRING", "status": "STRING",
        "card_number": "STRING", "_ingested_at": "TIMESTAMP", "_silver_built_at": "TIMESTAMP"},
    "silver.quarantine_orders": {**_BRONZE_ORDERS, **_REJECTED},
    "gold.revenue_by_region_month": {
        "region": "STRING", "order_month": "TIMESTAMP", "currency": "STRING",
        "orders": "BIGINT", "customers_active": "BIGINT", "revenue": "DECIMAL(22,2)",
        "avg_order_value": "DECIMAL(18,2)", "_gold_built_at": "TIMESTAMP"},
    "gold.customer_segment_profile": {
        "region": "STRING", "segment": "STRING", "customers": "BIGINT",
        "customers_consented": "BIGINT", "consent_rate": "DOUBLE", "avg_age_years": "DOUBLE",
        "_gold_built_at": "TIMESTAMP"},
    "gold.customer_profile_anonymized": {
        "age_band": "STRING", "region": "STRING", "segment": "STRING",
        "marketing_consent": "BOOLEAN", "people_in_group": "BIGINT"},
    "governance.audit_log": {
        "event_time": "TIMESTAMP", "user_email": "STRING", "service_name": "STRING",
        "action_name": "STRING", "request_params": "MAP<STRING,STRING>",
        "status_code": "STRING"},
}
VIEWS = ("governance.audit_log",)
OWNER_EXCEPTIONS = ("audit_log",)       # owned by an identity that can read the audit source

# Sensitivity of a column follows from what it holds; unlisted columns are internal.
_RESTRICTED = {"first_name", "last_name", "email", "phone", "national_id", "street_address",
               "card_number", "_rescued_data", "user_email"}
_CONFIDENTIAL = {"customer_id", "date_of_birth", "birth_year", "city", "postcode"}
_PII_TYPE = {
    "first_name": "name", "last_name": "name", "email": "email", "user_email": "email",
    "phone": "phone", "national_id": "national_id", "street_address": "address",
    "city": "address", "postcode": "address", "date_of_birth": "dob",
    "card_number": "payment_card",
}
REGION_FILTERED = ("bronze.customers", "silver.customers", "gold.revenue_by_region_month",
                   "gold.customer_segment_profile")


def column_tags(table: str) -> dict[str, dict[str, str]]:
    """Designed tags of one table: column -> {tag: value}."""
    tags: dict[str, dict[str, str]] = {}
    for column in TABLES[table]:
        level = ("restricted" if column in _RESTRICTED
                 else "confidential" if column in _CONFIDENTIAL else "internal")
        tags[column] = {"classification": level}
        if column in _PII_TYPE:
            tags[column]["pii_type"] = _PII_TYPE[column]
        if column == "region" and table in REGION_FILTERED:
            tags[column]["filter_key"] = "region"
    return tags


# What a reader needs to know about a column, by name.
DESCRIPTIONS = {
    "customer_id": "Key of the customer; joins orders to people, so it is treated as confidential.",
    "first_name": "Given name.",
    "last_name": "Family name.",
    "email": "Contact address; lower-cased and trimmed from silver on.",
    "phone": "Phone number as given.",
    "date_of_birth": "Birth date as ISO text.",
    "birth_year": "Year of birth; the full date is not kept in this layer.",
    "national_id": "Government number as text, so zeros in front survive.",
    "street_address": "Street and house number.",
    "city": "Town of residence.",
    "postcode": "Postal code as text.",
    "country": "Country of residence.",
    "region": "Sales region; decides which rows a regional reader sees.",
    "segment": "Commercial segment of the customer.",
    "marketing_consent": "Whether marketing contact was agreed to.",
    "created_at": "When the customer record was opened.",
    "order_id": "Key of the order.",
    "order_date": "Day the order was placed.",
    "amount": "Order value in the order's own currency.",
    "currency": "Currency code of the amount.",
    "card_number": "Payment card number.",
    "status": "State of the order.",
    "_rescued_data": "Source text that did not fit the schema; normally empty.",
    "_ingested_at": "When the row was loaded.",
    "_silver_built_at": "Silver build that wrote the row.",
    "_gold_built_at": "Gold build that wrote the row.",
    "_quarantined_at": "When the row was last refused.",
    "reject_reason": "The first rule the row failed.",
    "order_month": "First day of the order month.",
    "orders": "Completed orders in the group.",
    "customers_active": "Distinct customers in the group; the k of the suppression rule.",
    "revenue": "Sum of completed amounts, never mixed across currencies.",
    "avg_order_value": "Mean completed amount in the group.",
    "customers": "Customers in the group.",
    "customers_consented": "Customers in the group who agreed to marketing contact.",
    "consent_rate": "Consented customers over customers.",
    "avg_age_years": "Mean age of the group in years.",
    "age_band": "Decade of birth.",
    "people_in_group": "People sharing this combination; never below the threshold.",
    "event_time": "When the audited action happened.",
    "user_email": "Identity that acted.",
    "service_name": "Service the action belongs to.",
    "action_name": "The audited action.",
    "request_params": "Parameters of the request.",
    "status_code": "Outcome of the request.",
}

# The privilege matrix, 19 direct grants.
GRANTS: tuple[tuple[str, str, str, str], ...] = tuple(
    (grantee, privilege, level, f"{CATALOG}.{path}" if path else CATALOG)
    for grantee, privilege, level, path in (
        ("auditor", "BROWSE", "CATALOG", ""),
        ("auditor", "USE_CATALOG", "CATALOG", ""),
        ("analyst", "USE_CATALOG", "CATALOG", ""),
        ("data_engineer", "USE_CATALOG", "CATALOG", ""),
        ("data_engineer", "READ_VOLUME", "SCHEMA", "landing"),
        ("data_engineer", "USE_SCHEMA", "SCHEMA", "landing"),
        ("data_engineer", "SELECT", "SCHEMA", "bronze"),
        ("data_engineer", "USE_SCHEMA", "SCHEMA", "bronze"),
        ("data_engineer", "SELECT", "SCHEMA", "silver"),
        ("data_engineer", "USE_SCHEMA", "SCHEMA", "silver"),
        ("analyst", "SELECT", "SCHEMA", "silver"),
        ("analyst", "USE_SCHEMA", "SCHEMA", "silver"),
        ("data_engineer", "SELECT", "SCHEMA", "gold"),
        ("data_engineer", "USE_SCHEMA", "SCHEMA", "gold"),
        ("analyst", "SELECT", "SCHEMA", "gold"),
        ("analyst", "USE_SCHEMA", "SCHEMA", "gold"),
        ("auditor", "USE_SCHEMA", "SCHEMA", "governance"),
        ("auditor", "SELECT", "TABLE", "governance.audit_log"),
        ("account users", "SELECT", "TABLE", "gold.customer_profile_anonymized"),
    ))

# The functions that must exist in the governance schema.
ROUTINES = ("filter_by_region", "mask_dob", "mask_email", "mask_full", "mask_last4",
            "pseudonymize")


@dataclass(frozen=True)
class ColumnMask:
    """Mask every column carrying one of `match` (tag, value) pairs, for `to` minus `exempt`."""

    name: str
    function: str
    match: tuple[tuple[str, str], ...]
    to: str = ALL_USERS
    exempt: str | None = OWNERS
    args: tuple = ()                    # arguments after the matched column


@dataclass(frozen=True)
class RowFilter:
    """Keep rows for which function(matched column, *args) is TRUE, for members of `to`."""

    name: str
    function: str
    match: tuple[tuple[str, str], ...]
    to: str
    exempt: str | None = None
    args: tuple = ()


POLICIES: tuple[ColumnMask | RowFilter, ...] = (
    ColumnMask("mask_name_address", "mask_full", (("pii_type", "name"), ("pii_type", "address"))),
    ColumnMask("mask_email", "mask_email", (("pii_type", "email"),)),
    ColumnMask("mask_phone", "mask_full", (("pii_type", "phone"),)),
    ColumnMask("mask_payment_card", "mask_last4", (("pii_type", "payment_card"),)),
    ColumnMask("mask_dob", "mask_dob", (("pii_type", "dob"),)),
    ColumnMask("mask_national_id", "pseudonymize", (("pii_type", "national_id"),), args=(1,)),
    RowFilter("regional_access_eu", "filter_by_region", (("filter_key", "region"),),
              to="analyst_eu", args=("europe",)),
)


@dataclass(frozen=True)
class Constraint:
    """A CHECK rule: a row violates it only when the expression is FALSE; NULL passes."""

    name: str
    table: str
    expr: str


@dataclass(frozen=True)
class Expectation:
    """A build rule: a row fails it when the expression is not TRUE (NULL fails)."""

    name: str
    expr: str
    mode: str                           # observe | drop | fail


def _any_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


CONSTRAINTS: tuple[Constraint, ...] = (
    Constraint("email_present", "silver.customers", "email IS NOT NULL AND email <> ''"),
    Constraint("region_known", "silver.customers", _any_of("region", REGIONS)),
    Constraint("amount_non_negative", "silver.orders", "amount >= 0"),
    Constraint("status_known", "silver.orders", _any_of("status", STATUSES)),
    Constraint("currency_known", "silver.orders", _any_of("currency", CURRENCIES)),
    Constraint("order_date_plausible", "silver.orders",
               f"order_date BETWEEN DATE'{PLAUSIBLE_FROM}' AND DATE'{PLAUSIBLE_TO}'"),
    Constraint("k_anonymity_min_group", "gold.customer_segment_profile", f"customers >= {K}"),
    Constraint("k_anonymity_min_customers", "gold.revenue_by_region_month",
               f"customers_active >= {K}"),
    Constraint("consent_rate_is_a_rate", "gold.customer_segment_profile",
               "consent_rate BETWEEN 0 AND 1"),
    Constraint("revenue_non_negative", "gold.revenue_by_region_month", "revenue >= 0"),
    Constraint("k_anonymity_min_group", "gold.customer_profile_anonymized",
               f"people_in_group >= {K}"),
)

EXPECTATIONS: tuple[Expectation, ...] = (
    Expectation("amount_non_negative", "amount >= 0", "observe"),
    Expectation("status_known", _any_of("status", STATUSES), "drop"),
    Expectation("order_id_present", "order_id IS NOT NULL", "fail"),
)

# persona -> groups, as the access checks use them
PERSONAS: dict[str, tuple[str, ...]] = {
    "owner": (OWNERS,),
    "analyst": ("analyst",),
    "analyst_eu": ("analyst", "analyst_eu"),
    "data_engineer": ("data_engineer",),
    "auditor": ("auditor",),
    "nobody": (),
}
