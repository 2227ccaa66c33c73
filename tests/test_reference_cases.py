"""Behaviour cases the reference's own tests pin down, re-expressed on Spark."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlake.operators import breakdown as BD
from adlake.operators import upsert as U
from adlake.operators import usage as US
from adlake.plans import semantic as SQ
from adlake.session import Window
from adlake.sources import io
from adlake.sources.sheets import channel_key_of, parse_currency


def test_channel_codes(spark):
    codes = ["1_Meta", " 2_Google_Search ", "7_TikTok", "youtube", "unknown", None]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [r[0] for r in df.select(channel_key_of(F.col("c"))).collect()]
    assert got == ["META", "GOOGLE_ADS", "TIKTOK_ADS", "YOUTUBE", "OTHER", "OTHER"]


def test_currency_text(spark):
    df = spark.createDataFrame([("$91,952.10",), ("1,495",), ("",), ("$0.00",), ("n/a",)], "t string")
    got = [r[0] for r in df.select(parse_currency(F.col("t"))).collect()]
    assert got == [91952.10, 1495.0, None, 0.0, None]


def test_breakdown_unpivot_skips_blank_values(spark):
    df = spark.createDataFrame([("2024-01-01", "25-34", "", None, "Seoul")],
                               "date_start string, age string, gender string, country string, region string")
    out = BD.unpivot_breakdown(df, BD.META_KEYS, ["date_start"]).collect()
    assert [(r.breakdown_key, r.breakdown_value) for r in out] == [("age", "25-34"), ("region", "Seoul")]


def test_month_usage_sums_actual_else_estimate(spark):
    log = spark.createDataFrame([
        (100, None, "ok", dt.datetime(2026, 4, 1, 0, 0, 1)),
        (200, 150, "error", dt.datetime(2026, 4, 30, 23, 59)),
        (999, None, "ok", dt.datetime(2026, 3, 31, 23, 59)),
    ], "estimated_bytes long, actual_bytes long, status string, created_at timestamp")
    r = US.usage_month_state(log, dt.datetime(2026, 4, 15), budget=1000).collect()[0]
    assert r.used_bytes == 250


@pytest.mark.parametrize("used,level", [(690, "ok"), (700, "warning"), (850, "caution"), (950, "blocked")])
def test_usage_levels(spark, used, level):
    log = spark.createDataFrame([(used, None, "ok", dt.datetime(2026, 4, 2))],
                                "estimated_bytes long, actual_bytes long, status string, created_at timestamp")
    assert US.usage_month_state(log, dt.datetime(2026, 4, 15), budget=1000).collect()[0].level == level


def test_estimate_multiplier(spark):
    q = spark.createDataFrame([("2026-04-01", "2026-04-30"), ("2026-04-01", "2026-05-01"), ("last 90 days", None)],
                              "date_from string, date_to string")
    got = [r.estimated_query_bytes for r in US.usage_estimate(q).collect()]
    assert got == [10 * 1024 ** 2, 20 * 1024 ** 2, 10 * 1024 ** 2]


def test_contract_requires_report_date_range():
    with pytest.raises(SQ.ContractError) as e:
        SQ.validate({"measures": ["AdsCampaign.spend"]}, SQ.default_registry())
    assert e.value.code == "ads_campaign_report_date_required"
    SQ.validate({"measures": ["AdsCampaign.spend"],
                 "timeDimensions": [{"dimension": "AdsCampaign.reportDate", "dateRange": "last 7 days"}]},
                SQ.default_registry())
    with pytest.raises(SQ.ContractError):
        SQ.validate({"dimensions": ["Branch.branchName"],
                     "filters": [{"or": [{"member": "Orders.branchId", "operator": "equals", "values": ["x"]}]}]},
                    SQ.default_registry())


def test_last_n_days_ends_yesterday():
    assert SQ.date_range("last 7 days", dt.date(2026, 4, 10)) == (dt.date(2026, 4, 3), dt.date(2026, 4, 9))


def test_replace_range_rules(spark):
    t = spark.createDataFrame([("1", dt.date(2026, 4, 1), 1), ("2", dt.date(2026, 4, 1), 1), ("1", dt.date(2026, 5, 1), 1)],
                              "acct string, d date, v int")
    rows = spark.createDataFrame([("1", dt.date(2026, 4, 1), 9)], "acct string, d date, v int")
    out = sorted(U.replace_range(t, rows, "d", dt.date(2026, 4, 1), dt.date(2026, 4, 30), "acct", [" 1 ", "2"]).collect())
    assert [(r.acct, str(r.d), r.v) for r in out] == [("1", "2026-04-01", 9), ("1", "2026-05-01", 1)]
    assert U.replace_range(t, rows.limit(0), "d", dt.date(2026, 4, 1), dt.date(2026, 4, 30), "acct", ["1"]).count() == 3
    with pytest.raises(ValueError):
        U.replace_range(t, rows, "d", dt.date(2026, 4, 1), dt.date(2026, 4, 30), "acct", [" "])


def test_guards(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(io.EmptyLoad):
        io.truncate_load_guarded(spark, df.limit(0), str(tmp_path / "t"))
    with pytest.raises(io.MissingPartitionFilter):
        io.scan_window(df, "x", None)


def test_upsert_keep_if_null_and_window(spark):
    t = spark.createDataFrame([("a", dt.date(2026, 4, 1), "n1", 1), ("b", dt.date(2026, 1, 1), "old", 1)],
                              "k string, d date, name string, v int")
    s = spark.createDataFrame([("a", dt.date(2026, 4, 1), None, 2), ("b", dt.date(2026, 1, 1), "new", 2)],
                              "k string, d date, name string, v int")
    out = U.upsert(t, s, ["k", "d"], keep_if_null=["name"], window=Window.of("2026-04-01", "2026-04-30"),
                   date_col="d")
    got = sorted((r.k, r.name, r.v) for r in out.collect())
    # a: matched, name kept; b: outside the window, target row kept and the source row inserted
    assert got == [("a", "n1", 2), ("b", "new", 2), ("b", "old", 1)]
