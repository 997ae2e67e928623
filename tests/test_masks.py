"""Mask functions on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from govlake.functions import masks
from govlake.functions.values import decade_band, money, present


def one(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.m for r in df.select("i", fn(F.col("v")).alias("m")).orderBy("i").collect()]


def test_mask_full_hides_null(spark):
    assert one(spark, masks.mask_full, ["x", None]) == ["***", "***"]


def test_mask_email(spark):
    assert one(spark, masks.mask_email, ["rudi@x.de", "", None, "noat", "a@b@c"]) == [
        "r***@x.de", "", None, "n***@", "a***@b"]


def test_mask_last4(spark):
    assert one(spark, masks.mask_last4, ["4000123412341111", "12", None]) == [
        "****1111", "****12", None]


def test_pseudonymize_golden_vector(spark):
    got = one(spark, lambda c: masks.pseudonymize(c, 1), ["696-55-1549", None])
    assert got == ["e01159252fdffff4cb5f7c2f9ac0a1b0a0789be2cf83ab6a099e3fcd78d91e15", None]
    assert one(spark, lambda c: masks.pseudonymize(c, 2), ["696-55-1549"]) != got[:1]


def test_mask_dob(spark):
    assert one(spark, masks.mask_dob, ["1951-05-18", None]) == ["1951-**-**", None]
    assert one(spark, masks.mask_dob_date, [dt.date(1951, 5, 18), None], "date") == [
        dt.date(1951, 1, 1), None]


def test_filter_by_region(spark):
    assert one(spark, lambda c: masks.filter_by_region(c, "eu"), ["EU", "na", None]) == [
        True, False, None]
    assert one(spark, lambda c: masks.filter_by_region(c, "eu, na"), ["na"]) == [False]


def test_values(spark):
    assert [str(v) for v in one(spark, money, ["12.345", "", "n/a", None])] == [
        "12.35", "None", "None", "None"]
    assert one(spark, present, ["x", "", "  ", None]) == [True, False, False, False]
    assert one(spark, decade_band, [1979, 1980, None], "int") == ["1970s", "1980s", None]


@pytest.mark.parametrize("name", sorted(masks.FUNCTIONS))
def test_functions_are_pure_columns(spark, name):
    fn, takes, gives, arity = masks.FUNCTIONS[name]
    args = ["europe"] if name == "filter_by_region" else [1] if arity == 2 else []
    df = spark.range(1).select(F.lit(None).cast(takes).alias("v")).select(
        fn(F.col("v"), *args).alias("m"))
    assert df.schema["m"].dataType.simpleString().upper() == gives


def test_sql_functions_equal_the_column_functions(spark):
    assert set(masks.register_sql(spark)) == set(masks.FUNCTIONS)
    values = ["rudi@x.de", "", None, "noat", "696-55-1549", "EUROPE", "12"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    df.createOrReplaceTempView("mask_input")
    extra = {"pseudonymize": [1], "filter_by_region": ["europe,asia"]}
    for name, (fn, takes, _, _) in masks.FUNCTIONS.items():
        v = F.col("v").try_cast("date") if takes == "DATE" else F.col("v")
        args = extra.get(name, [])
        text = ", ".join([f"try_cast(v AS {takes})", *[repr(a) for a in args]])
        got = spark.sql(f"SELECT v, {name}({text}) AS m FROM mask_input")
        assert sorted(map(repr, got.collect())) == sorted(
            map(repr, df.select("v", fn(v, *args).alias("m")).collect())), name
