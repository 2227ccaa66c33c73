"""Breakdown payloads: one row a key, geo constants, pooled regions, collapse, bad dates."""

import datetime as dt
import json

from adlake.operators.breakdown import stg_breakdown
from adlake.session import ALL_TIME, Window
from adlake.sources import normalize as N

W = Window.of("2024-01-01", "2024-01-31")
NOW = "2024-02-01 00:00:00"


def meta(spark, *insights):
    return N.norm_meta_breakdown(spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in insights], "payload string"), "r", NOW, NOW)


def google(spark, *rows):
    return N.norm_google_breakdown(spark.createDataFrame([("7", k, json.dumps(x)) for k, x in rows], "customer_id string, breakdown_key string, payload string"),
                                   W, "r", NOW, NOW)


BASE = {"account_id": "act_1", "campaign_id": "c", "campaign_name": "C", "date_start": "2024-01-03", "impressions": "10", "clicks": "3.0", "spend": "1.25"}


def test_meta_rows_by_key(spark):
    rows = meta(spark, {**BASE, "age": "18-24", "gender": "female"}, {**BASE, "country": " "}, {**BASE, "region": "Seoul", "age": None}, "{not json").collect()
    assert sorted((r.breakdown_key, r.breakdown_value, r.age, r.gender) for r in rows) == [
        ("age", "18-24", "18-24", "female"), ("gender", "female", "18-24", "female"), ("region", "Seoul", None, None)]
    r = rows[0]
    assert (r.account_id, r.ad_group_id, r.ad_group_name, r.stat_date, r.impressions, r.clicks, r.spend_micros) == ("1", "c", "C", dt.date(2024, 1, 3), 10, 3, 1_250_000)
    assert json.loads(r.source_payload)["spend"] == "1.25"


def test_malformed_dates_do_not_abort(spark):
    assert [r.stat_date for r in meta(spark, {**BASE, "age": "x", "date_start": "03.01.2024"}).collect()] == [None]
    row = {"campaign": {"id": "c"}, "segments": {"date": "soon"}, "ad_group_criterion": {"gender": {"type": "MALE"}}}
    assert [r.stat_date for r in google(spark, ("gender", row)).collect()] == [W.end]
    perf = N.norm_meta_perf(spark.createDataFrame([(json.dumps({**BASE, "date_start": "x"}),)], "payload string"), "r", NOW, NOW)
    assert perf.first().stat_date is None


def geo(country, region=None):
    return {"campaign": {"id": "c", "name": "C"}, "segments": {"date": "2024-01-03", "geo_target_region": region},
            "user_location_view": {"country_criterion_id": country}, "metrics": {"impressions": 1, "clicks": 1, "cost_micros": 5, "conversions": 0.5, "conversions_value": 1.5}}


def test_google_geo_values(spark):
    cases = [("geo_target_country", geo(2840), "geoTargetConstants/2840"), ("geo_target_country", geo("geoTargetConstants/1"), "geoTargetConstants/1"),
             ("geo_target_region", geo(2840, "21137"), "geoTargetConstants/21137"), ("geo_target_region", geo(2410, "21137"), "others"),
             ("geo_target_region", geo(2124, " "), "others"), ("geo_target_region", geo(None, "5"), "others")]
    for key, row, value in cases:
        assert [(r.breakdown_value, r[key], r.source_view) for r in google(spark, (key, row)).collect()] == [(value, value, "user_location_view")]
    dropped = google(spark, ("geo_target_country", geo(None)), ("gender", geo(2840)), ("geo_target_country", {**geo(2840), "campaign": {"id": ""}}), ("city", geo(1)))
    assert dropped.count() == 0


def test_payloads_to_staging(spark):
    rows = google(spark, *[("geo_target_region", geo(2410, str(k))) for k in range(4)], ("age_range", {"campaign": {"id": "c"}, "ad_group_criterion": {"age_range": {"type": "AGE_RANGE_18_24"}}}))
    raw = N.google_breakdown_raw(rows)
    others = raw.where("breakdown_value = 'others'").first()
    assert (others.impressions, others.cost_micros, others.conversions, others.conversion_value_micros) == (4, 20, 2.0, 6_000_000)
    assert others.source_payload is not None
    out = {(r.channel_key, r.breakdown_key, r.breakdown_value): (r.impressions, r.conversion_value_micros)
           for r in stg_breakdown(meta(spark, {**BASE, "gender": "male"}), raw, ALL_TIME, NOW).collect()}
    assert out == {("GOOGLE_ADS", "geo_target_region", "others"): (4, 6_000_000), ("GOOGLE_ADS", "age", "18-24"): (0, 0), ("META", "gender", "male"): (10, None)}
