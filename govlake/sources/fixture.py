"""Bronze tables derived from the star-schema test tables.

Each customer and order becomes an all-text record with a known share of defects: blank
emails, unparseable dates and amounts, negative amounts, future dates, orphan customers.
The output is a function of the input row alone, so it is the same at every run and scales
with the tables. The currency lookup follows the customer's nation.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from govlake.functions.values import as_time

ID_WIDTH, ORDER_WIDTH = 6, 8


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its footer is read once per session: a plan that names a table several
    times, or a folder of very many files, should not pay for schema discovery each time."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def pad(number: str, width: int, fill: str = "0") -> str:
    """Left-pad digits to `width`; longer numbers stay whole (plain lpad would cut them)."""
    text = f"string({number})"
    return f"lpad({text}, greatest({width}, length({text})), '{fill}')"


def customer_key(key: str) -> str:
    return f"'C' || {pad(key, ID_WIDTH)}"


def customer_key_column(key: Column) -> Column:
    text = key.cast("string")
    return F.concat(F.lit("C"), F.lpad(text, F.greatest(F.lit(ID_WIDTH), F.length(text)),
                                       F.lit("0")))


# k is the customer's key
_CUSTOMER = (
    f"{customer_key('k')} AS customer_id",
    "'Given' || k % 50 AS first_name",
    "'Family' || k % 400 AS last_name",
    """CASE WHEN k % 83 = 0 THEN '' WHEN k % 89 = 0 THEN '   ' WHEN k % 97 = 0 THEN NULL
       ELSE ' Given' || k % 50 || '.' || k || '@Mail' || k % 4 || '.example ' END AS email""",
    f"'+1-555-' || {pad('k * 7919 % 10000000', 7)} AS phone",
    """CASE WHEN k % 101 = 0 THEN 'not-a-date'
       ELSE string(date_add(DATE'1940-01-01', int(k * 7919 % 25000))) END AS date_of_birth""",
    f"{pad('k * 104729 % 1000000000', 9)} AS national_id",
    "k || ' Main Street' AS street_address",
    "'City' || k % 120 AS city",
    f"{pad('k * 37 % 100000', 5)} AS postcode",
    "n_name AS country",
    "r_name AS region",
    "lower(c_mktsegment) AS segment",
    "CASE WHEN k * 7 % 20 < 11 THEN 'True' ELSE 'False' END AS marketing_consent",
    "string(date_add(DATE'1993-01-01', int(k % 700))) AS created_at",
    "string(NULL) AS _rescued_data",
)

_ORDER_CUSTOMER = (f"CASE WHEN o_orderkey % 331 = 0 THEN 'C9' || {pad('o_orderkey % 100000', 5)} "
                   f"ELSE {customer_key('o_custkey')} END AS customer_id")

# o is the order's key, a its amount as text; the card's key is reduced first so that the product
# stays inside BIGINT for any order key
_ORDER = (
    f"'O' || {pad('o', ORDER_WIDTH)} AS order_id",
    "customer_id",
    """CASE WHEN o % 313 = 0 THEN '2099-01-01' WHEN o % 509 = 0 THEN 'bad-date'
       ELSE string(date(o_orderdate)) END AS order_date""",
    "CASE WHEN o % 307 = 0 THEN '-' || a WHEN o % 521 = 0 THEN 'n/a' ELSE a END AS amount",
    """CASE n_regionkey WHEN 0 THEN ' zar' WHEN 1 THEN 'usd' WHEN 2 THEN 'JPY' WHEN 3 THEN 'eur '
       WHEN 4 THEN 'AED' END AS currency""",
    f"{pad('((o % 3000000000) * 2654435761) % 10000000000000000', 16, '4')} AS card_number",
    """CASE WHEN o % 50 < 45 THEN ' Completed' WHEN o % 50 < 48 THEN 'refunded'
       ELSE 'CANCELLED' END AS status""",
    "string(NULL) AS _rescued_data",
)


def bronze_customers(spark: SparkSession, sf_dir: str, ingested_at: str | None = None) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k")
            .join(nation, "c_nationkey").join(region, "n_regionkey")
            .selectExpr(*_CUSTOMER).withColumn("_ingested_at", as_time(ingested_at)))


def order_customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join key of every bronze order, straight from the scan (no lookup of the currency)."""
    return table(spark, sf_dir, "orders").selectExpr(_ORDER_CUSTOMER)


def bronze_orders(spark: SparkSession, sf_dir: str, ingested_at: str | None = None) -> DataFrame:
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_regionkey")
    nation_of = table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS o", "o_custkey", _ORDER_CUSTOMER, "o_orderdate",
        "string(CAST(o_totalprice AS decimal(12,2))) AS a")
    # both sides shuffle plainly, so adaptive execution may split a customer with many orders
    return (orders.join(nation_of, "o_custkey").join(nation, "c_nationkey")
            .selectExpr(*_ORDER).withColumn("_ingested_at", as_time(ingested_at)))
