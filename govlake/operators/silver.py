"""Bronze to silver: typing, normalisation and the accept / quarantine split.

Each bronze table is classified once. The label is the first rule a row fails, NULL for an
accepted row, so the two outputs are complements by construction.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govlake.design import AS_OF
from govlake.functions.values import (as_date, as_time, birth_year, day, money, present,
                                      tidy_lower, tidy_upper)
from govlake.operators.joins import ROWS_PER_TASK, lookup
from govlake.operators.quality import classify, split

# 0 unknown to the source, 1 known but quarantined, 2 accepted
_UNKNOWN, _QUARANTINED, _ACCEPTED = 0, 1, 2


def classify_customers(bronze: DataFrame) -> DataFrame:
    return classify(bronze, [("missing_email", ~present(F.col("email")))])


def type_customers(bronze: DataFrame, built_at: str | None = None) -> DataFrame:
    """Typed projection; a value that does not parse becomes NULL and is counted elsewhere."""
    return bronze.select(
        "customer_id", "first_name", "last_name",
        tidy_lower(F.col("email")).alias("email"),
        "phone", "national_id", "street_address", "city", "postcode", "country",
        tidy_lower(F.col("region")).alias("region"),
        "segment",
        F.col("marketing_consent").try_cast("boolean").alias("marketing_consent"),
        F.col("created_at").try_cast("timestamp").alias("created_at"),
        "_ingested_at",
        as_time(built_at).alias("_silver_built_at"),
        birth_year(F.col("date_of_birth")).alias("birth_year"))


def customers(bronze: DataFrame, built_at: str | None = None) -> DataFrame:
    accepted, _ = split(classify_customers(bronze))
    return type_customers(accepted, built_at)


def quarantine_customers(bronze: DataFrame, at: str | None = None) -> DataFrame:
    _, rejected = split(classify_customers(bronze))
    return rejected.withColumn("_quarantined_at", as_time(at))


def customer_states(bronze_customers: DataFrame) -> DataFrame:
    """One row per customer key: is any of its rows accepted? Pre-aggregated, so copies of one
    customer cost a task one row each and can never multiply orders."""
    state = F.when(present(F.col("email")), _ACCEPTED).otherwise(_QUARANTINED)
    return bronze_customers.groupBy("customer_id").agg(F.max(state).alias("_parent"))


def _own_rules(as_of: dt.date) -> list[tuple[str, Column]]:
    """The order rules that need no other table, in precedence."""
    amount, date = money(F.col("amount")), day(F.col("order_date"))
    return [("unparseable_amount", amount.isNull()),
            ("unparseable_date", date.isNull()),
            ("negative_amount", amount < 0),
            ("future_order_date", date > as_date(as_of))]


def _parent_rules() -> list[tuple[str, Column]]:
    parent = F.coalesce(F.col("_parent"), F.lit(_UNKNOWN))
    return [("orphan_customer", parent == _UNKNOWN),
            ("customer_quarantined", parent == _QUARANTINED)]


def classify_orders(bronze_orders: DataFrame, bronze_customers: DataFrame,
                    as_of: dt.date = AS_OF, keys_from: DataFrame | None = None,
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Bronze orders plus `reject_reason`, from one lookup against the validated parent."""
    known = lookup(bronze_orders, customer_states(bronze_customers), "customer_id",
                   keys_from, rows_per_task)
    return (classify(known, _parent_rules() + _own_rules(as_of))
            .select(*bronze_orders.columns, "reject_reason"))


def type_orders(bronze: DataFrame, built_at: str | None = None) -> DataFrame:
    return bronze.select(
        "order_id", "customer_id",
        day(F.col("order_date")).alias("order_date"),
        money(F.col("amount")).alias("amount"),
        tidy_upper(F.col("currency")).alias("currency"),
        tidy_lower(F.col("status")).alias("status"),
        "card_number", "_ingested_at",
        as_time(built_at).alias("_silver_built_at"))


def orders(bronze_orders: DataFrame, bronze_customers: DataFrame, as_of: dt.date = AS_OF,
           built_at: str | None = None, keys_from: DataFrame | None = None) -> DataFrame:
    accepted, _ = split(classify_orders(bronze_orders, bronze_customers, as_of, keys_from))
    return type_orders(accepted, built_at)


def quarantine_orders(bronze_orders: DataFrame, bronze_customers: DataFrame,
                      as_of: dt.date = AS_OF, at: str | None = None,
                      keys_from: DataFrame | None = None) -> DataFrame:
    _, rejected = split(classify_orders(bronze_orders, bronze_customers, as_of, keys_from))
    return rejected.withColumn("_quarantined_at", as_time(at))


def row_valid_orders(bronze_orders: DataFrame, as_of: dt.date = AS_OF,
                     built_at: str | None = None) -> DataFrame:
    """Typed orders passing their own rules; the parent is still to be checked.

    Feed this to an aggregate that inner-joins silver customers anyway: that join is the
    parent check, so the row-level lookup is not paid twice.
    """
    accepted, _ = split(classify(bronze_orders, _own_rules(as_of)))
    return type_orders(accepted, built_at)


def order_counts(bronze_orders: DataFrame, bronze_customers: DataFrame,
                 as_of: dt.date = AS_OF) -> DataFrame:
    """Rows per reject reason (NULL = accepted), plus how many of them would be orphaned by
    joining the raw parent instead of the validated one.

    Orders are counted per customer before the parent is looked up, so the join sees one row
    per customer however many orders that customer has.
    """
    own = classify(bronze_orders.select("customer_id", "order_date", "amount"), _own_rules(as_of))
    reasons = [name for name, _ in _own_rules(as_of)]
    counters = [F.count_if(F.col("reject_reason") == r).alias(r) for r in reasons]
    per_customer = own.groupBy("customer_id").agg(
        F.count_if(F.col("reject_reason").isNull()).alias("ok"), *counters)
    joined = per_customer.join(customer_states(bronze_customers), "customer_id", "left")
    parent = F.coalesce(F.col("_parent"), F.lit(_UNKNOWN))
    rows = sum((F.col(r) for r in reasons), F.col("ok"))
    outcomes = F.array(
        F.struct(F.lit("orphan_customer").alias("reject_reason"),
                 F.when(parent == _UNKNOWN, rows).otherwise(0).alias("n")),
        F.struct(F.lit("customer_quarantined").alias("reject_reason"),
                 F.when(parent == _QUARANTINED, rows).otherwise(0).alias("n")),
        *[F.struct(F.lit(r).alias("reject_reason"),
                   F.when(parent == _ACCEPTED, F.col(r)).otherwise(0).alias("n"))
          for r in reasons],
        F.struct(F.lit(None).cast("string").alias("reject_reason"),
                 F.when(parent == _ACCEPTED, F.col("ok")).otherwise(0).alias("n")))
    raw_only = F.when(parent == _QUARANTINED, F.col("ok")).otherwise(0)
    return (joined.select(raw_only.alias("raw_only"), F.explode(outcomes).alias("o"))
            .groupBy("o.reject_reason")
            .agg(F.sum("o.n").alias("n_rows"),
                 F.sum(F.when(F.col("o.reject_reason") == "customer_quarantined",
                              F.col("raw_only")).otherwise(0)).alias("raw_only")))



def accepted_groups(bronze_orders: DataFrame, bronze_customers: DataFrame, by: list[str],
                    as_of: dt.date = AS_OF) -> DataFrame:
    """Silver orders counted by typed columns `by`, without building silver row by row.

    Orders shrink to one row per customer and group before their parent is checked.
    """
    counted = (row_valid_orders(bronze_orders, as_of).groupBy("customer_id", *by)
               .agg(F.count(F.lit(1)).alias("n")))
    parents = (bronze_customers.where(present(F.col("email"))).select("customer_id").distinct())
    return (counted.join(parents, "customer_id", "left_semi")
            .groupBy(*by).agg(F.sum("n").alias("n")))
