"""Payloads through staging, ordered entity lists, history attributes and windowed reloads."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from adlake.operators import marts, scd2, staging
from adlake.operators import upsert as U
from adlake.session import ALL_TIME, Window
from adlake.sources import io
from adlake.sources import normalize as N

NOW = "2024-02-01 00:00:00"
DAY = dt.date(2024, 1, 5)
W = Window.of("2024-01-01", "2024-01-31")


def _payloads(spark, owner, *rows):
    return spark.createDataFrame([("7", i, json.dumps(r)) for i, r in enumerate(rows)], f"{owner} string, ingest_seq int, payload string")


@pytest.fixture()
def naver(spark):
    stats = _payloads(spark, "customer_id", {"adgroupId": "g", "cost": "", "impCnt": "4", "date": "2024-01-05"})
    camps = _payloads(spark, "customer_id", *[{"nccCampaignId": "c", "name": n} for n in ("zz first", "last")]).repartition(2)
    groups = _payloads(spark, "customer_id", *[{"nccAdgroupId": "g", "nccCampaignId": c, "name": n} for c, n in (("x", "zz"), ("c", "Group"))]).repartition(2)
    return N.norm_naver_perf(stats, camps, groups, W, "r", NOW, NOW)


def test_the_last_entry_of_an_entity_list_wins(naver):
    row = naver.first()
    assert (row.campaign_id, row.campaign_name, row.ad_group_name, row.stat_date) == ("c", "last", "Group", DAY)


def test_payloads_of_all_channels_stage_with_dates_and_blank_spend(spark, naver):
    meta = N.norm_meta_perf(_payloads(spark, "x", {"account_id": "act_1", "date_start": "2024-01-05", "spend": "1.5", "impressions": "3.0"}), "r", NOW, NOW)
    google = N.norm_google_perf(_payloads(spark, "customer_id", {"segments": {"date": "2024-01-05"}, "metrics": {"cost_micros": 5}}), "r", NOW, NOW)
    tiktok = N.norm_tiktok_perf(_payloads(spark, "advertiser_id", {"dimensions": {"stat_time_day": "2024-01-05 00:00:00"}, "metrics": {"spend": ""}}), "r", NOW, NOW)
    assert all("source_payload" in p.columns for p in (meta, google, tiktok, naver))
    out = staging.stg_ads_performance(meta, google, tiktok, naver, W, NOW, ["spend_micros"])
    assert dict(out.dtypes)["stat_date"] == "date"
    got = {r.channel_key: (r.stat_date, r.spend_micros) for r in out.collect()}
    assert got == {"META": (DAY, 1_500_000), "GOOGLE_ADS": (DAY, 5), "TIKTOK_ADS": (DAY, None), "NAVER_ADS": (DAY, None)}


def test_unreadable_payload_gives_an_empty_row(spark):
    bad = spark.createDataFrame([("not json",), (None,)], "payload string")
    assert [r.account_id for r in N.norm_meta_perf(bad, "r", NOW, NOW).collect()] == [None, None]


def test_history_keeps_attributes_and_breaks_ties_alike(spark):
    cols = ("channel_key string, account_id_norm string, creative_id string, creative_name string, body_text string, headline string, "
            "description_text string, call_to_action string, thumbnail_url string, content_hash string, valid_from_ts timestamp, load_ts timestamp")
    ts = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [("META", "1", "c", "n", b, "h", "d", "cta", "t", h, at, ts[0]) for b, h, at in (
        ("old", "h1", ts[0]), ("tie", "h2", ts[1]), ("lost", "h1", ts[1]), ("same", "h2", ts[2]))]
    for order in (rows, rows[::-1]):
        got = scd2.scd2_creative(spark.createDataFrame(order, cols).repartition(3)).orderBy("valid_from_ts").collect()
        assert [(r.body_text, r.headline, r.thumbnail_url, r.is_current) for r in got] == [("old", "h", "t", False), ("tie", "h", "t", True)]


def test_a_window_reloads_alike_when_run_again(spark, tmp_path):
    path, spec = str(tmp_path / "t"), io.TableSpec("t", "stat_date", cluster_by=["k"])
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]
    first = spark.createDataFrame([(k, 1, d) for d in days for k in ("a", "b")], "k string, v int, stat_date date")
    io.write_window(spark, first, path, spec, ALL_TIME)
    window = Window(days[1], days[2])
    changed = spark.createDataFrame([("a", 2, days[1]), ("c", 2, days[1])], "k string, v int, stat_date date")
    want = {("a", 1, days[0]), ("b", 1, days[0]), ("a", 2, days[1]), ("b", 1, days[1]), ("c", 2, days[1]), ("a", 1, days[3]), ("b", 1, days[3])}
    for _ in range(2):
        merged = U.upsert(io.read_table(spark, path, spec, ALL_TIME), changed, ["k", "stat_date"], window=window, date_col="stat_date")
        io.write_window(spark, merged.filter(F.col("stat_date") != F.lit(days[2])), path, spec, window)
        got = [(r.k, r.v, r.stat_date) for r in io.read_table(spark, path, spec, ALL_TIME).collect()]
        assert len(got) == len(want) and set(got) == want


def test_blended_rows_of_one_source_leave_the_others_null(spark):
    mc = spark.createDataFrame([(DAY, "b", "EUR", 1, 1, 5, 1.0, None)], "report_date date, branch_id string, currency_code string, impressions long, "
                               "clicks long, spend_native_micros long, conversions double, conversion_value_native_micros long")
    mb = spark.createDataFrame([(DAY, "b", "USD", 2, 9)], "report_date date, branch_id string, currency_code string, orders long, net_revenue_native_micros long")
    mw = spark.createDataFrame([(DAY, "b", 3, 4, 5), (DAY, None, 1, 1, 1)], "report_date date, branch_id string, users long, sessions long, event_count long")
    ms = spark.createDataFrame([], "report_date date, branch_id string, response_count long, avg_answer_score double")
    dim = spark.createDataFrame([("b", "Branch", "EUR")], "branch_id string, branch_name string, currency string")
    got = {(r.branch_id, r.currency_code): (r.ad_spend_native_micros, r.ad_conversion_value_native_micros, r.orders, r.users) for r in marts.mart_blended_daily(mc, mb, mw, ms, dim).collect()}
    assert got == {("b", "EUR"): (5, None, None, 3), ("b", "USD"): (None, None, 2, 3), (None, None): (None, None, None, None)}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_naver_lookup_moves_picked_columns_only(spark):
    from adlake.sources import normalize as N
    ads = spark.createDataFrame([("1", '{"adId":"9","nccAdgroupId":"g","adName":"n"}')], "customer_id string, payload string")
    groups = spark.createDataFrame([("1", 1, '{"nccAdgroupId":"g","nccCampaignId":"c"}')], "customer_id string, ingest_seq int, payload string")
    out = N.norm_naver_creative(ads, groups, Window.of("2024-01-01", "2024-01-31"), "r", None, None)
    assert [tuple(r) for r in out.select("account_id", "campaign_id", "ad_group_id", "ad_id", "creative_name").collect()] == [("1", "c", "g", "9", "n")]
    lines = _plan(out.select("account_id", "campaign_id", "ad_id")).split("\n")
    left = lines[next(k for k, x in enumerate(lines) if "Join LeftOuter" in x) + 1]
    assert "Project [" in left and " AS ad_id#" in left and "source_payload" not in left


def test_creative_assets_read_each_channel_once(spark):
    from adlake.operators import creative as CR
    from adlake.sources import normalize as N
    w = Window.of("2024-01-01", "2024-01-31")
    g = spark.createDataFrame([("1", '{"ad_group_ad":{"ad":{"id":"9","image_ad":{"image_url":"i"},"video_ad":{"video":{"asset":"x/assets/7"}}}}}')],
                              "customer_id string, payload string")
    out = CR.stg_creative_asset(None, w, google=N.norm_google_creative(g, w, "r", None, None))
    assert sorted((r["asset_type"], r["asset_seq"], r["asset_url"], r["video_id"]) for r in out.collect()) == [("IMAGE", 1, "i", None), ("VIDEO", 1, None, "7")]
    assert _plan(out).count("from_json") == 1
