"""CHECK rules, expectations, splits and reports."""

import pytest
from pyspark.sql import functions as F

from support import rows
from govlake import design
from govlake.design import CONSTRAINTS, Constraint, Expectation
from govlake.operators import quality


def amounts(spark):
    return spark.createDataFrame([("a", 5), ("b", -1), ("c", None)], "id string, amount int")


RULE = Constraint("amount_non_negative", "t", "amount >= 0")


def test_null_passes_a_check_and_fails_an_expectation(spark):
    df = amounts(spark)
    found = quality.check(df, [RULE]).first()
    assert found.violations == 1 and '"id":"b"' in found["sample"]
    counted = quality.expectation_counts(df, [Expectation("e", "amount >= 0", "observe")]).first()
    assert (counted.passed, counted.failed) == (1, 2)
    assert rows(quality.drop_rows(df, [Expectation("e", "amount >= 0", "drop")])) == [("a", 5)]


def test_enforce_names_rule_expression_and_row(spark):
    with pytest.raises(quality.ConstraintViolation) as error:
        quality.enforce(amounts(spark), [RULE])
    text = str(error.value)
    assert "amount_non_negative" in text and "amount >= 0" in text and '"b"' in text
    quality.enforce(amounts(spark).where("id <> 'b'"), [RULE])


@pytest.fixture(scope="module")
def open_rows(spark):
    return spark.createDataFrame([], "n int, order_date date, u string, rank int, t timestamp, s struct<n:int>, "
                                     "status string, current_date_text string")


@pytest.mark.parametrize("expr", [
    "order_date <= current_date()", "order_date <= current_date", "n > rand()", "n > randn(3)", "n > uniform(1, 5)",
    "count(n) > 5", "n IN (SELECT 1)", "row_number() OVER (ORDER BY n) = 1", "u = current_user()", "u = user()",
    "u = session_user()", "t < now()", "t < localtimestamp()", "unix_timestamp() > n", "u = current_database()",
    "u = current_catalog()", "u <> current_timezone()", "u = uuid()", "u = input_file_name()", "spark_partition_id() = n",
    "monotonically_increasing_id() > n", "EXISTS (SELECT 1)", "bool_and(n > 1)", "max_by(n, n) > 1", "n", "gone > 1",
    "shuffle(array(n, 2))[0] = 1", "u = randstr(3)", "kurtosis(n) > 1", "t < try_to_timestamp(string(current_time()))"])
def test_unstable_checks_are_refused(open_rows, expr):
    with pytest.raises(quality.UnsafeConstraint):
        quality.validate_constraint(Constraint("c", "t", expr), open_rows)


@pytest.mark.parametrize("expr", [
    "status <> 'select count(now())'", "rank > 0", "rank + n > 0", "current_date_text = ''",
    "exists(array(n), x -> x > 1)", "s.n > 1", "date_trunc('month', order_date) = order_date", "hash(n) > 1",
    "greatest(n, rank) < 9", "n IS NULL"])
def test_stable_checks_are_accepted(open_rows, expr):
    assert quality.validate_constraint(Constraint("c", "t", expr), open_rows).expr == expr


def test_columns_a_check_reads(open_rows):
    assert quality.columns_read(open_rows, "status <> 'rank' AND N > s.n") == {"status", "n", "s"}
    assert quality.columns_read(open_rows, "exists(array(n), rank -> rank > 1)") == {"n"}


def test_designed_checks_are_stable(spark):
    for table, columns in design.TABLES.items():
        like = spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in columns.items()))
        for rule in CONSTRAINTS:
            if rule.table == table:
                quality.validate_constraint(rule, like)


# one unacceptable row per rule; only the named rule may refuse it
GOOD = {
    "silver.customers": dict(email="a@x", region="europe"),
    "silver.orders": dict(amount="10.00", status="completed", currency="EUR", order_date="2024-06-01"),
    "gold.customer_segment_profile": dict(customers=100, consent_rate=0.5),
    "gold.revenue_by_region_month": dict(customers_active=9, revenue="1.00"),
    "gold.customer_profile_anonymized": dict(people_in_group=9),
}
BAD = [
    ("silver.customers", "email_present", dict(email=None)),
    ("silver.customers", "email_present", dict(email="")),
    ("silver.customers", "region_known", dict(region="apac")),
    ("silver.orders", "amount_non_negative", dict(amount="-1.00")),
    ("silver.orders", "status_known", dict(status="shipped")),
    ("silver.orders", "currency_known", dict(currency="GBP")),
    ("silver.orders", "order_date_plausible", dict(order_date="1985-01-01")),
    ("gold.customer_segment_profile", "k_anonymity_min_group", dict(customers=3)),
    ("gold.customer_segment_profile", "consent_rate_is_a_rate", dict(consent_rate=1.5)),
    ("gold.revenue_by_region_month", "k_anonymity_min_customers", dict(customers_active=4)),
    ("gold.revenue_by_region_month", "revenue_non_negative", dict(revenue="-0.01")),
    ("gold.customer_profile_anonymized", "k_anonymity_min_group", dict(people_in_group=3)),
]
TYPES = dict(email="string", region="string", amount="decimal(12,2)", status="string",
             currency="string", order_date="date", customers="bigint", consent_rate="double",
             customers_active="bigint", revenue="decimal(22,2)", people_in_group="bigint")


def frame(spark, values):
    schema = ", ".join(f"{c} string" for c in values)
    text = {c: None if v is None else str(v) for c, v in values.items()}
    df = spark.createDataFrame([tuple(text.values())], schema)
    return df.select(*[F.col(c).cast(TYPES[c]).alias(c) for c in values])


@pytest.mark.parametrize("table,rule,change", BAD)
def test_each_rule_refuses_its_row_and_nothing_else_does(spark, table, rule, change):
    rules = [r for r in CONSTRAINTS if r.table == table]
    good, bad = frame(spark, GOOD[table]), frame(spark, {**GOOD[table], **change})
    assert quality.check(good, rules).where("violations > 0").count() == 0
    assert [r.name for r in quality.check(bad, rules).where("violations > 0").collect()] == [rule]
    # switched off, the same row lands: the rule was what stopped it
    quality.enforce(bad, [r for r in rules if r.name != rule])


def test_constraint_diff_sees_weakened_rules(spark):
    def table(*rules):
        return spark.createDataFrame(rules, "table_name string, constraint_name string, expression string")
    diff = quality.constraint_diff(
        table(("t", "a", "x > 0"), ("t", "b", "y > -9"), ("t", "d", "z")),
        table(("t", "a", "x > 0"), ("t", "b", "y > 0"), ("t", "c", "w")))
    assert dict(rows(diff, "constraint_name", "status")) == {
        "a": "ok", "b": "changed", "c": "missing", "d": "extra"}


def test_classify_takes_the_first_rule_and_treats_null_as_passing(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    labelled = quality.classify(df, [("small", F.col("n") < 3), ("odd", F.col("n") % 2 == 1)])
    assert rows(labelled) == sorted([(1, "small"), (5, "odd"), (None, None)], key=repr)
    kept, held = quality.split(labelled)
    assert kept.columns == ["n"] and kept.count() + held.count() == 3


def test_reports(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "v string")
    assert rows(quality.profile(df, "v"), "value", "n", "share") == sorted(
        [("x", 2, 0.5), ("y", 1, 0.25), (None, 1, 0.25)], key=repr)
    assert dict(rows(quality.vocabulary_diff(df.dropna(), "v", ["x", "z"]), "value", "status")) == {
        "x": "ok", "y": "unexpected", "z": "absent"}
    parent = spark.createDataFrame([("x",)], "v string")
    assert quality.referential(df, parent, "v").first().orphans == 2
    assert tuple(quality.unique(df.dropna(), "v").first()) == (3, 2)
    r = quality.reconcile("t", df, df.where("v = 'x'"), df.where("v = 'y'")).first()
    assert tuple(r) == ("t", 4, 2, 1, -1)


def test_observed_counts_arrive_with_the_write(spark):
    rules = [Expectation("pos", "amount >= 0", "observe"), Expectation("named", "id <> 'a'", "drop")]
    kept, seen = quality.apply(amounts(spark), rules)
    kept.write.format("noop").mode("overwrite").save()
    assert seen.get == {"total": 3, "failed_pos": 2, "failed_named": 1}
    with pytest.raises(quality.ExpectationFailed):
        quality.raise_on_failed([Expectation("pos", "amount >= 0", "fail")], seen.get)
