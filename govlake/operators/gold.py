"""Silver to gold: group facts, published only for groups large enough to hide a person."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.design import AS_OF, K
from govlake.functions.values import as_date, as_time
from govlake.session import cut


def revenue_groups(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Completed revenue by region, month and currency, before suppression.

    Both sides are reduced before they meet: orders to one row per customer, month and
    currency, customers to one row per key and region with its number of copies. The join and
    the shuffles carry those partial sums, so a customer with a third of all orders is a few
    hundred rows, and the distinct count runs over reduced rows only.
    """
    per_customer = (
        orders.where(F.col("status") == "completed")
        .groupBy("customer_id",
                 F.date_trunc("month", F.col("order_date")).alias("order_month"), "currency")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total")))
    home = customers.groupBy("customer_id", "region").agg(F.count(F.lit(1)).alias("copies"))
    return (per_customer.join(home, "customer_id")
            .groupBy("region", "order_month", "currency")
            .agg(F.sum(F.col("n") * F.col("copies")).alias("orders"),
                 F.count_distinct("customer_id").alias("customers_active"),
                 F.sum(F.col("total") * F.col("copies")).cast("decimal(22,2)").alias("revenue"))
            .withColumn("avg_order_value",
                        F.round(F.col("revenue") / F.col("orders"), 2).cast("decimal(18,2)")))


def revenue(orders: DataFrame, customers: DataFrame, k: int = K,
            built_at: str | None = None) -> DataFrame:
    return (revenue_groups(orders, customers).where(F.col("customers_active") >= k)
            .withColumn("_gold_built_at", as_time(built_at)))


def segment_groups(customers: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    """Counts, consent rate and mean age by region and segment, before suppression.

    Age is counted in whole years from the stored birth year; with a full date at hand use
    `mean_age`. Sums are of integers, so the result does not depend on row order.
    """
    return customers.groupBy("region", "segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if("marketing_consent").alias("customers_consented"),
        F.round(F.count_if("marketing_consent") / F.count(F.lit(1)), 4).alias("consent_rate"),
        F.round(F.avg(F.lit(as_of.year) - F.col("birth_year")), 1).alias("avg_age_years"))


def segments(customers: DataFrame, as_of: dt.date = AS_OF, k: int = K,
             built_at: str | None = None) -> DataFrame:
    return (segment_groups(customers, as_of).where(F.col("customers") >= k)
            .withColumn("_gold_built_at", as_time(built_at)))


def mean_age(customers: DataFrame, birth_date: str, as_of: dt.date = AS_OF) -> DataFrame:
    """Mean age per segment both ways: from days of the full date, and from the year alone."""
    date = F.col(birth_date).try_cast("date")
    days, year = F.datediff(as_date(as_of), date), F.year(date)
    return customers.groupBy("segment").agg(
        F.round(F.sum(days) / (F.count(date) * F.lit(365.25)), 1).alias("age_from_date"),
        F.round(F.avg(F.lit(as_of.year) - year), 1).alias("age_from_year"),
        F.count(date).alias("people"))


def suppression_cost(orders: DataFrame, customers: DataFrame, k: int = K) -> DataFrame:
    """What the threshold costs: groups and value before, published and withheld."""
    big = F.col("customers_active") >= k
    groups = revenue_groups(orders, customers)
    return groups.agg(
        F.count(F.lit(1)).alias("groups_before"),
        F.count_if(big).alias("groups_published"),
        F.count_if(~big).alias("groups_withheld"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("decimal(24,2)").alias("value_before"),
        F.coalesce(F.sum(F.when(big, F.col("revenue"))), F.lit(0)).cast("decimal(24,2)")
         .alias("value_published"),
        F.coalesce(F.sum(F.when(~big, F.col("revenue"))), F.lit(0)).cast("decimal(24,2)")
         .alias("value_withheld"))


def revenue_reconciliation(published: DataFrame, orders: DataFrame) -> DataFrame:
    """Published gold revenue (one row, `value_published`) beside the revenue summed over the silver
    orders, so rows lost or repeated on the way to gold show as a difference beyond suppression."""
    silver = orders.where(F.col("status") == "completed").agg(
        F.sum("amount").cast("decimal(24,2)").alias("silver_revenue"))
    return published.select(F.col("value_published").alias("gold_revenue"),
                            silver.scalar().alias("silver_revenue"))


# ---- revenue kept up to date: stored partial sums, merged with what changed -------------------
#
# A delta is rows with a weight: 1 for a row that came, -1 for one that went, so an update is both.
# Partials hold what one customer adds to one month and currency, homes where a customer lives and in
# how many copies, groups the published sums before suppression. Distinct customers follow from the
# partials: a customer counts in a group while its weight there is not zero.

_PART = ["customer_id", "order_month", "currency"]
_GROUP = ["region", "order_month", "currency"]


def partials(orders: DataFrame, weight: str | None = None, *more: str) -> DataFrame:
    """customer_id, order_month, currency, n, total of completed orders, by weight; also by `more`."""
    w = F.lit(1) if weight is None else F.col(weight)
    return (orders.where(F.col("status") == "completed")
            .groupBy(*more, "customer_id", F.date_trunc("month", F.col("order_date")).alias("order_month"), "currency")
            .agg(F.sum(w.cast("bigint")).alias("n"), F.sum(F.col("amount") * w).cast("decimal(22,2)").alias("total")))


def homes(customers: DataFrame, weight: str | None = None) -> DataFrame:
    w = F.lit(1) if weight is None else F.col(weight)
    return customers.groupBy("customer_id", "region").agg(F.sum(w.cast("bigint")).alias("copies"))


def merged(stored: DataFrame, delta: DataFrame, keys: list[str], zero: str) -> DataFrame:
    """Stored sums and a delta's sums as new sums; rows whose `zero` column ends at 0 are gone."""
    values = [c for c in stored.columns if c not in keys]
    return (stored.unionByName(delta.select(*stored.columns)).groupBy(*keys)
            .agg(*(F.sum(v).cast(stored.schema[v].dataType).alias(v) for v in values)).where(F.col(zero) != 0))


def _changed(stored: DataFrame, delta: DataFrame, keys: list[str], zero: str) -> tuple[DataFrame, DataFrame]:
    """`merged` written once, and what it changes: the new rows of the delta's keys with sign 1, and
    those they replace with sign -1. Stored rows and the delta meet in one grouping."""
    values = [c for c in stored.columns if c not in keys]
    kind = {v: stored.schema[v].dataType for v in values}
    old = [F.sum(F.when(~F.col("_delta"), F.col(v))).cast(kind[v]).alias(f"_old_{v}") for v in values]
    both = cut(stored.withColumn("_delta", F.lit(False)).unionByName(delta.select(*stored.columns).withColumn("_delta", F.lit(True)))
               .groupBy(*keys).agg(*(F.sum(v).cast(kind[v]).alias(v) for v in values), *old,
                                   F.bool_or(~F.col("_delta")).alias("_stored"), F.bool_or("_delta").alias("_changed")))

    def side(prefix: str, sign: int):
        return F.struct(*(F.col(f"{prefix}{v}").alias(v) for v in values), F.lit(sign).alias("sign"))

    sides = F.array_compact(F.array(F.when(F.col(zero) != 0, side("", 1)), F.when(F.col("_stored"), side("_old_", -1))))
    return both.where(F.col(zero) != 0).select(*stored.columns), both.where("_changed").select(*keys, F.inline(sides))


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_GROUP).agg(F.sum("orders").alias("orders"), F.sum("customers_active").alias("customers_active"),
                                     F.sum("revenue").cast("decimal(22,2)").alias("revenue"))


def revenue_state(parts: DataFrame, home: DataFrame) -> DataFrame:
    """The group sums from partials and homes: region, order_month, currency, orders,
    customers_active, revenue."""
    return _grouped(_contribution(parts.withColumn("sign", F.lit(1)).join(home, "customer_id")))


def _contribution(joined: DataFrame) -> DataFrame:
    sign = F.col("sign")
    return joined.select(
        *_GROUP, (F.col("n") * F.col("copies") * sign).alias("orders"), sign.cast("bigint").alias("customers_active"),
        (F.col("total") * F.col("copies") * sign).cast("decimal(22,2)").alias("revenue"))


def apply_orders(parts: DataFrame, groups: DataFrame, home: DataFrame, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge weighted orders (column `weight`): the new partials and groups. The delta is read once."""
    return apply_partials(parts, groups, home, partials(delta, "weight"))


def apply_partials(parts: DataFrame, groups: DataFrame, home: DataFrame, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`apply_orders` of a delta that is partial sums by weight already. Only partials of the delta's
    keys are compared, and only they are joined to the homes, before and after in one join."""
    now, shift = _changed(parts, delta.where("n <> 0 or total <> 0"), _PART, "n")
    return now, merged(groups, _grouped(_contribution(shift.join(home, "customer_id"))), _GROUP, "orders")


def apply_customers(parts: DataFrame, groups: DataFrame, home: DataFrame, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge weighted customers: the new homes and groups. Only partials of the delta's customers are
    read again, in one join from where they lived to where they live."""
    now, shift = _changed(home, homes(delta, "weight").where("copies <> 0"), ["customer_id", "region"], "copies")
    return now, merged(groups, _grouped(_contribution(shift.join(parts, "customer_id"))), _GROUP, "orders")


def published(groups: DataFrame, k: int = K) -> DataFrame:
    """What is published of stored groups: those large enough, with their mean."""
    return groups.where(F.col("customers_active") >= k).select(
        *_GROUP, "orders", "customers_active", "revenue",
        F.round(F.col("revenue") / F.col("orders"), 2).cast("decimal(18,2)").alias("avg_order_value"))
