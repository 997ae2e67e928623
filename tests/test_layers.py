"""Silver and gold on the test tables: golden counts and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from support import rows
from govlake.operators import anonymize, gold, quality, silver
from govlake.plans.registry import Layers
from govlake.sources import fixture

GOLDEN = {
    "0.001": dict(customers=(150, 146, 4), orders=(1500, 1446, 54), raw_only=37,
                  reasons=dict(customer_quarantined=38, orphan_customer=5, unparseable_amount=2,
                               unparseable_date=2, negative_amount=3, future_order_date=4),
                  groups=(385, 78), value="322324833.37", published="118402572.66",
                  profile=(0, 0, 145), zeros=(150, 150)),
    "0.01": dict(customers=(1500, 1450, 50), orders=(15000, 14310, 690), raw_only=492,
                 reasons=dict(customer_quarantined=495, orphan_customer=46, unparseable_amount=28,
                              unparseable_date=29, negative_amount=46, future_order_date=46),
                 groups=(397, 395), value="3214254170.91", published="3213551222.92",
                 profile=(147, 892, 1436), zeros=(271, 955)),
    "0.1": dict(customers=(15000, 14501, 499), orders=(150000, 143096, 6904), raw_only=4905,
                reasons=dict(customer_quarantined=4951, orphan_customer=454,
                             unparseable_amount=280, unparseable_date=289, negative_amount=472,
                             future_order_date=458),
                groups=(400, 400), value="32205695276.93", published="32205695276.93",
                profile=(350, 14356, 14356), zeros=(1622, 1910)),
}


@pytest.fixture(scope="module", params=sorted(GOLDEN))
def case(request, spark):
    return Layers(spark, f"/root/testdata/sf{request.param}"), GOLDEN[request.param]


def test_order_reasons(case):
    at, want = case
    got = {r.reject_reason: r.n_rows for r in at.order_counts().collect()}
    assert {k: v for k, v in got.items() if k and v} == want["reasons"]
    assert got[None] == want["orders"][1]
    assert at.order_counts().agg(F.sum("raw_only")).first()[0] == want["raw_only"]


def test_row_level_split_equals_counts(case):
    at, want = case
    keys = fixture.order_customer_ids(at.spark, at.sf)
    labelled = silver.classify_orders(at.bronze_orders(), at.bronze_customers(), keys_from=keys)
    counts = {r.reject_reason: r["count"] for r in labelled.groupBy("reject_reason").count().collect()}
    assert counts.pop(None) == want["orders"][1]
    assert counts == want["reasons"]


def test_customer_split(case):
    at, want = case
    bronze = at.bronze_customers()
    total, kept, held = want["customers"]
    assert (bronze.count(), silver.customers(bronze).count(),
            silver.quarantine_customers(bronze).count()) == (total, kept, held)
    zeros = quality.leading_zeros(bronze, ["postcode", "national_id"]).first()
    assert tuple(zeros) == want["zeros"]


def test_gold_suppression(case):
    at, want = case
    cost = gold.suppression_cost(at.valid_orders(), at.customers()).first()
    assert (cost.groups_before, cost.groups_published) == want["groups"]
    assert (str(cost.value_before), str(cost.value_published)) == (want["value"], want["published"])
    published = gold.revenue(at.valid_orders(), at.customers())
    assert published.where("customers_active < 5").count() == 0


def test_published_profile(case):
    at, want = case
    rate = anonymize.suppression_rate(at.customers()).first()
    assert tuple(rate) == want["profile"]
    assert anonymize.publish_profile(at.customers()).where("people_in_group < 5").count() == 0


def small_bronze(spark):
    customers = spark.createDataFrame(
        [("C1", " A@x "), ("C2", None), ("C3", "  "), ("C4", "b@x"), ("C4", "b@x"), ("C4", None)],
        "customer_id string, email string")
    orders = spark.createDataFrame([
        ("ok", "C1", "2020-01-01", "5.00"), ("zero", "C1", "2020-01-01", "0"),
        ("neg", "C1", "2020-01-01", "-1"), ("negquar", "C2", "2020-01-01", "-1"),
        ("future", "C1", "2099-01-01", "5"), ("badboth", "C1", "x", "y"),
        ("baddate", "C1", "x", "5"), ("orphan", "C9", "x", "y"), ("nokey", None, "2020-01-01", "5"),
        ("blank", "C3", "2020-01-01", "5"), ("copies", "C4", "2020-01-01", "5")],
        "order_id string, customer_id string, order_date string, amount string")
    return customers, orders


def test_reason_precedence_and_copies_of_a_parent(spark):
    customers, orders = small_bronze(spark)
    got = dict(rows(silver.classify_orders(orders, customers), "order_id", "reject_reason"))
    assert got == {"ok": None, "zero": None, "neg": "negative_amount",
                   "negquar": "customer_quarantined", "future": "future_order_date",
                   "badboth": "unparseable_amount", "baddate": "unparseable_date",
                   "orphan": "orphan_customer", "nokey": "orphan_customer",
                   "blank": "customer_quarantined", "copies": None}
    counts = {r.reject_reason: r.n_rows for r in silver.order_counts(orders, customers).collect()}
    want = {}
    for reason in got.values():
        want[reason] = want.get(reason, 0) + 1
    assert {k: v for k, v in counts.items() if v} == want


def test_accepted_groups_equal_silver(spark):
    customers, orders = small_bronze(spark)
    full = orders.selectExpr("*", "' Completed' AS status", "'usd ' AS currency",
                             "'4' AS card_number", "current_timestamp() AS _ingested_at")
    groups = silver.accepted_groups(full, customers, ["status", "currency"])
    assert rows(groups) == [("completed", "USD", 3)]
    assert silver.orders(full, customers).count() == 3


def test_revenue_weighs_copies_of_a_customer(spark):
    orders = spark.createDataFrame(
        [("a", "2020-01-03", "10.00", "USD", "completed"), ("a", "2020-01-09", "5.01", "USD", "completed"),
         ("b", "2020-01-31", "1.00", "USD", "completed"), ("b", "2020-02-01", "1.00", "USD", "refunded")],
        "customer_id string, order_date string, amount string, currency string, status string"
    ).selectExpr("customer_id", "date(order_date) order_date", "decimal(amount) amount_",
                 "cast(amount as decimal(12,2)) amount", "currency", "status")
    people = spark.createDataFrame([("a", "eu"), ("a", "eu"), ("b", "eu")],
                                   "customer_id string, region string")
    got = gold.revenue_groups(orders, people).first()
    plain = orders.join(people, "customer_id").where("status = 'completed'").agg(
        F.count(F.lit(1)), F.count_distinct("customer_id"), F.sum("amount"),
        F.round(F.avg("amount"), 2)).first()
    assert (got.orders, got.customers_active, got.revenue, got.avg_order_value) == tuple(plain)


def test_mean_age_forms(spark):
    df = spark.createDataFrame([("s", "2000-01-01"), ("s", "1990-12-31"), ("s", "bad")],
                               "segment string, dob string")
    r = gold.mean_age(df, "dob", dt.date(2026, 9, 21)).first()
    assert (r.age_from_year, r.people) == (31.0, 2) and abs(r.age_from_date - 31.2) < 0.06


def test_k_measurement(spark):
    df = spark.createDataFrame([("x", 1)] * 6 + [("x", None)] * 2 + [("y", 1)], "a string, b int")
    assert tuple(anonymize.k_profile(df, ["a", "b"]).first()) == (3, 1, 2, 3)
    both = {r.quasi_identifiers: tuple(r)[1:] for r in anonymize.k_compare(
        df, {"ab": ("a", "b"), "a": ("a",)}).collect()}
    assert both == {"ab": (3, 1, 2, 3), "a": (2, 1, 1, 1)}
    assert rows(anonymize.risk_groups(df, ["a"])) == [("y", 1)]


def test_attack_counts_pairs_without_making_them(spark):
    published = spark.createDataFrame([("eu", "r"), ("eu", "r"), ("na", "r")], "region string, segment string")
    people = spark.createDataFrame([("eu", "r")] * 3 + [("zz", "r")], "region string, segment string")
    assert tuple(anonymize.join_cardinality(published, people).first()) == (
        published.join(people, ["region", "segment"]).count(), 2, 3)


def test_bruteforce_finds_exactly_the_guessable(spark):
    from govlake.functions.masks import pseudonymize
    ids = [f"C{i:06d}" for i in (1, 1, 5, 999, 1000)] + ["other"]
    hashes = spark.createDataFrame([(i,) for i in ids], "id string").select(
        pseudonymize(F.col("id")).alias("h"))
    got = anonymize.bruteforce_rate(hashes, "h", hashes.sparkSession.range(1000), fixture.customer_key_column).first()
    assert tuple(got) == (6, 4, 0.6667)
