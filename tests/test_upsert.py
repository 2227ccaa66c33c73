"""MERGE semantics: one source row per key, checked in the plan that merges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlake.operators import upsert as U
from adlake.session import Window

SCHEMA = "k string, g string, d date, v int"
D = dt.date(2024, 1, 5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_repeated_source_key_fails_the_merging_job(spark):
    t = spark.createDataFrame([("1", "", D, 1)], SCHEMA)
    s = spark.createDataFrame([("1", None, D, 2), ("1", "", D, 3)], SCHEMA)
    out = U.upsert(t, s, ["k", "g"], blank_keys=["g"])  # building the plan runs nothing
    with pytest.raises(Exception, match=U.DUPLICATE_MATCH):
        out.collect()
    with pytest.raises(Exception, match=U.DUPLICATE_MATCH):  # also where only some columns are read
        out.select("v").collect()
    new = spark.createDataFrame([("9", "a", D, 2), ("9", "a", D, 3)], SCHEMA)
    with pytest.raises(Exception, match=U.DUPLICATE_MATCH):
        U.upsert(t, new, ["k", "g"], blank_keys=["g"]).collect()


def test_unique_source_merges(spark):
    t = spark.createDataFrame([("1", None, D, 1), ("2", "x", D, 2), (None, "n", D, 3), ("5", "", D, 9), ("5", "", D, 8)], SCHEMA)
    s = spark.createDataFrame([("1", "", D, 10), (None, "n", D, 30), ("4", None, D, 40), ("5", None, D, 50)], SCHEMA)
    got = rows(U.upsert(t, s, ["k", "g"], blank_keys=["g"]))
    assert got == sorted([("1", None, D, 10), ("2", "x", D, 2), (None, "n", D, 30), ("4", None, D, 40), ("5", "", D, 50), ("5", "", D, 50)], key=str)


def test_strict_null_keys_never_match_and_may_repeat(spark):
    t = spark.createDataFrame([(None, "a", D, 1), ("1", "a", D, 2)], SCHEMA)
    s = spark.createDataFrame([(None, "a", D, 5), (None, "a", D, 6), ("1", "a", D, 7)], SCHEMA)
    got = rows(U.upsert(t, s, ["k", "g"], strict_keys=True))
    assert got == sorted([(None, "a", D, 1), (None, "a", D, 5), (None, "a", D, 6), ("1", "a", D, 7)], key=str)


def test_rows_outside_the_window_pass_and_cannot_match(spark):
    old = dt.date(2023, 1, 1)
    t = spark.createDataFrame([("1", "a", old, 1), ("1", "a", None, 2), ("1", "a", D, 3)], SCHEMA)
    s = spark.createDataFrame([("1", "a", D, 9)], SCHEMA)
    got = rows(U.upsert(t, s, ["k", "g"], window=Window.of("2024-01-01", "2024-01-31"), date_col="d"))
    assert got == sorted([("1", "a", old, 1), ("1", "a", None, 2), ("1", "a", D, 9)], key=str)


def test_the_check_needs_no_shuffle_or_sort_of_its_own(spark):
    t = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("g"), F.lit(D).alias("d"), F.lit(1).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = U.upsert(t, t.withColumn("v", F.lit(2)), ["k", "g"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Sort [") == 2 and "Window" in plan


def test_same_load_twice_gives_the_same_table(spark):
    t = spark.createDataFrame([("1", "a", D, 1)], SCHEMA)
    s = spark.createDataFrame([("1", "a", D, 5), ("2", None, D, 6)], SCHEMA)
    once = U.upsert(t, s, ["k", "g"], blank_keys=["g"])
    assert rows(U.upsert(once, s, ["k", "g"], blank_keys=["g"])) == rows(once)


def test_duplicate_keys_are_listed(spark):
    s = spark.createDataFrame([("1", None, D, 2), ("1", "", D, 3), ("2", "", D, 3)], SCHEMA)
    assert rows(U.duplicate_keys(s, ["k", "g"], blank_keys=["g"])) == [("1", "", 2)]
    with pytest.raises(U.DuplicateSourceKeys):
        U.assert_unique_source(s, ["k", "g"], blank_keys=["g"])
