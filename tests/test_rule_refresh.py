"""Rules and maps that change within a session, long rule lists, and read failures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlake.functions.columns import decimal_to_micros
from adlake.operators import core, governance, joins
from adlake.sources import io
from adlake.streaming import ingest

RULE = "rule_id string, branch_id string, match_keyword string, priority int, is_active boolean, updated_at timestamp"
MAP = ("channel_key string, account_id_norm string, branch_id string, effective_start_date date, effective_end_date date, "
       "is_active boolean, updated_at timestamp")


def _rules(spark, path, branch):
    spark.createDataFrame([("R1", branch, "red", 1, True, None)], RULE).write.mode("overwrite").parquet(path)
    return spark.read.schema(RULE).parquet(path)


def test_overwritten_rules_and_maps_take_effect(spark, tmp_path):
    names = spark.createDataFrame([("Red ring",)], "n string")
    facts = spark.createDataFrame([("META", "1", dt.date(2024, 1, 5))], "channel_key string, account_id_norm string, d date")
    for branch in ("V1", "V9"):
        rules = _rules(spark, str(tmp_path / "rules"), branch)
        assert core.branch_by_rule(names, rules, "n").first().branch_id == branch
        spark.createDataFrame([("META", "1", branch, dt.date(2024, 1, 1), None, True, None)], MAP).write.mode("overwrite").parquet(str(tmp_path / "map"))
        got = core.branch_by_account(facts, spark.read.schema(MAP).parquet(str(tmp_path / "map")), "d")
        assert got.first().branch_id == branch


def test_a_grown_map_no_longer_fits(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.range(3).write.parquet(path)
    assert joins.fits(spark.read.schema("id long").parquet(path), 5)
    spark.range(9).write.mode("overwrite").parquet(path)
    assert not joins.fits(spark.read.schema("id long").parquet(path), 5)


def test_long_and_short_rule_lists_rank_alike(spark):
    some = [("A", "V1", "red", None, True, None), ("B", "V2", "red ring", 1, True, None), ("C", "V3", "plate", 2, True, None), ("D", "V4", "plates", 2, True, None)]
    filler = [(f"F{i}", "V5", f"zz{i:05d}x", 9, True, None) for i in range(joins.RULE_CASE_MAX)]
    names = spark.createDataFrame([("Red Ring",), ("two plates",), ("blue",), (None,), ("zz00007x",)], "n string")
    want = {"Red Ring": "V1", "two plates": "V4", "blue": "UNKNOWN", None: "UNKNOWN"}
    for rules, last in ((some, "UNKNOWN"), (some + filler, "V5")):
        df = spark.createDataFrame(rules, RULE)
        assert (joins.keyword_rank(df, F.col("n"), core.rule_order()) is None) == (len(rules) > 4)
        assert {r.n: r.branch_id for r in core.branch_by_rule(names, df, "n").collect()} == want | {"zz00007x": last}


def test_unmatched_adgroups_with_a_long_rule_list(spark):
    rules = spark.createDataFrame([(f"F{i}", "V", f"key{i:05d}", 1, True, None) for i in range(joins.RULE_CASE_MAX + 1)], RULE)
    day, ts = dt.date(2024, 1, 10), dt.datetime(2024, 1, 10)
    rows = [("1", "c", "cn", g, n, day, "2.5", 1, 1, ts, ts) for g, n in (("g1", "has KEY00012 in it"), ("g2", "none"), ("g3", None))]
    raw = spark.createDataFrame(rows, "account_id string, campaign_id string, campaign_name string, ad_group_id string, ad_group_name string, "
                                "stat_date date, spend string, impressions long, clicks long, source_extract_ts timestamp, ingestion_ts timestamp")
    assert {r.ad_group_id for r in governance.unmatched_adgroups(raw, rules, day).collect()} == {"g2", "g3"}


def test_a_read_failure_raises_and_leaves_the_table(spark, tmp_path):
    table = tmp_path / "t"
    table.mkdir()
    (table / "part-0.parquet").write_bytes(b"not parquet")
    batch = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1)], "k string, stat_date date, seq int")
    with pytest.raises(Exception):
        ingest.merge_batch(spark, batch, str(table), ["k"], ["seq"])
    assert [p.name for p in table.iterdir()] == ["part-0.parquet"]
    assert not io.path_exists(spark, str(tmp_path / "none"))


def test_blank_money_is_no_amount(spark):
    df = spark.createDataFrame([("",), ("1.5",), (None,)], "s string").select(decimal_to_micros("s").alias("m"))
    assert [r.m for r in df.collect()] == [None, 1_500_000, None]
