"""Column rules: blank keys, hashes, safe ratios, money, action types."""

import hashlib

from pyspark.sql import functions as F

from adlake.functions import columns as C


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_blank_key_equates_null_and_empty(spark):
    rows = one(spark, C.blank_key("x"), [(None,), ("",), ("a",)], "x string")
    assert rows == ["", "", "a"]


def test_safe_ratio_zero_and_null(spark):
    rows = one(spark, C.safe_ratio("a", "b"), [(1, 0), (1, None), (1, 4)], "a long, b long")
    assert rows == [None, None, 0.25]


def test_email_hash(spark):
    rows = one(spark, C.email_hash("e"), [(" User@Example.com ",), ("  ",), (None,)], "e string")
    assert rows == [hashlib.sha256(b"user@example.com").hexdigest(), None, None]


def test_phone_hash_keeps_digits_and_plus(spark):
    rows = one(spark, C.phone_hash("p"), [("+82 (10) 1234-5678",)], "p string")
    assert rows == [hashlib.sha256(b"+821012345678").hexdigest()]


def test_customer_key(spark):
    rows = one(spark, C.customer_key("e", "p"), [("a", None), (None, None)], "e string, p string")
    assert rows == [hashlib.sha256(b"a|").hexdigest(), None]


def test_money_text(spark):
    rows = one(spark, C.money_text_to_micros("s"), [("12.5",), ("",), ("bad",), (None,)], "s string")
    assert rows == [12_500_000, None, None, None]


def test_int_via_float_truncates(spark):
    rows = one(spark, C.int_via_float("s"), [("12.7",), ("x",), ("3",)], "s string")
    assert rows == [12, None, 3]


def test_normalize_action_type(spark):
    rows = one(spark, C.normalize_action_type("s"),
               [("Offline Purchase!!",), ("__",), ("구매 완료",), (None,)], "s string")
    assert rows == ["offline_purchase", None, "구매_완료", None]


def test_last_non_null_skips_nulls(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, None, 3), (1, "b", 2)], "k int, v string, t int")
    r = df.groupBy("k").agg(C.last_non_null("v", "t").alias("v")).collect()
    assert r[0]["v"] == "b"
