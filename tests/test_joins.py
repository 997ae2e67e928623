"""The lookup join against brute force, with and without heavy keys."""

from collections import Counter

from pyspark.sql import functions as F

from support import rows
from govlake.operators import silver
from govlake.operators.joins import bucket_of, heavy_buckets, lookup


def facts(spark, n=3000):
    # key 0 holds a third of all rows; some rows have no match, some no key at all
    key = (F.when(F.col("id") % 3 == 0, F.lit("0"))
            .when(F.col("id") % 50 == 1, F.lit(None))
            .otherwise((F.col("id") % 97 + 1).cast("string")))
    return spark.range(n).select(F.col("id").alias("row"), key.alias("k"))


def parents(spark):
    return spark.range(0, 60).select(F.col("id").cast("string").alias("k"),
                                     (F.col("id") * 10).alias("v"))


def test_lookup_equals_plain_left_join(spark):
    f, p = facts(spark), parents(spark)
    want = rows(f.join(p, "k", "left"), "row", "k", "v")
    for per_task in (10, 200, 10**9):
        got = lookup(f, p, "k", rows_per_task=per_task)
        assert rows(got, "row", "k", "v") == want
    assert rows(lookup(f, p, "k", keys_from=f.select("k"), rows_per_task=25), "row", "k", "v") == want


def test_heavy_key_is_spread_over_parts(spark):
    f = facts(spark)
    heavy = heavy_buckets(f, "k", rows_per_task=100).collect()
    zero = spark.range(1).select(F.lit("0").alias("k")).select(bucket_of("k")).first()[0]
    assert [(r["_bucket"], r["_parts"]) for r in heavy] == [(zero, 10)]     # 1,000 of 3,000 rows
    part = F.pmod(F.xxhash64(*f.columns), F.lit(10))
    sizes = Counter(r.p for r in f.where("k = '0'").select(part.alias("p")).collect())
    assert len(sizes) == 10 and max(sizes.values()) < 160


def test_nothing_is_heavy_below_the_limit(spark):
    assert heavy_buckets(facts(spark), "k").count() == 0


def test_order_classification_with_split_keys(spark):
    customers = spark.range(20).selectExpr("'C' || id AS customer_id", "IF(id % 5 = 0, '', 'a@x') AS email")
    orders = spark.range(4000).selectExpr(
        "'O' || id AS order_id", "'C' || IF(id % 3 = 0, 1, id % 25) AS customer_id",
        "'2020-01-01' AS order_date", "'1.00' AS amount")
    want = rows(silver.classify_orders(orders, customers))
    assert rows(silver.classify_orders(orders, customers, rows_per_task=50)) == want
    counts = {r.reject_reason: r.n_rows for r in silver.order_counts(orders, customers).collect() if r.n_rows}
    assert counts == dict(Counter(r[-1] for r in want))


def test_exact_copies_survive(spark):
    copies = spark.range(500).select(F.lit("7").alias("k"), F.lit(1).alias("row"))
    assert lookup(copies, parents(spark), "k", rows_per_task=50).where("v = 70").count() == 500
