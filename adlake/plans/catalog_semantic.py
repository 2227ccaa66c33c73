"""Registered metrics-layer queries over the marts built from the driver tables."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from adlake.operators import marts
from adlake.plans import semantic as SQ
from adlake.plans.catalog import ctx, finish, query
from adlake.session import Window, checkpoint_dir
from adlake.sources import fixtures as fx
from adlake.sources.sheets import channel_key_of

ALL = ["1990-01-01", "2030-12-31"]
ROUND = {"Surveys__avgScore"}


class _Sources(dict):
    """Cube sources built on first use (a query touches one or a few cubes)."""

    def __init__(self, spark, sf):
        super().__init__()
        self.c = ctx(spark, sf)
        self.spark, self.sf = spark, sf

    def __missing__(self, cube):
        c = self.c
        if cube == "AdsCampaign":
            v = c.mart_campaign()
        elif cube == "Orders":
            v = marts.mart_business_daily(c.fact_orders(), c.gov["dim_branch"])
        elif cube == "Surveys":
            v = marts.mart_survey_daily(c.fact_survey(), c.gov["dim_branch"])
        elif cube == "Branch":
            v = c.gov["dim_branch"].withColumn("country_code", F.lit(None).cast("string"))
        elif cube == "Channel":
            ext = fx.external_raw(self.spark, self.sf)
            chan_map = (ext.select(F.trim("channel_code").alias("raw_code")).distinct()
                           .withColumn("channel_key", channel_key_of(F.col("raw_code")))
                           .withColumn("is_active", F.col("channel_key") != "OTHER"))
            v = SQ.channel_cube_source(chan_map)
        else:
            raise KeyError(cube)
        self[cube] = v
        return v


def sources(spark, sf):
    return _Sources(spark, sf)


def run(spark, sf, q, today=_dt.date(2024, 2, 1)):
    return finish(SQ.semantic_query(q, sources(spark, sf), today), rounded=ROUND)


QUERIES_SQ = {
    "cube_ads_campaign": {
        "measures": ["AdsCampaign.spend", "AdsCampaign.impressions", "AdsCampaign.clicks", "AdsCampaign.ctr",
                     "AdsCampaign.cpc", "AdsCampaign.roas"],
        "dimensions": ["AdsCampaign.channelKey", "AdsCampaign.sourceTier"],
        "timeDimensions": [{"dimension": "AdsCampaign.reportDate", "dateRange": ALL}]},
    "cube_orders": {
        "measures": ["Orders.orders", "Orders.netRevenue", "Orders.grossRevenue"],
        "dimensions": ["Orders.branchId", "Orders.currencyCode", "Orders.sourceTier"],
        "timeDimensions": [{"dimension": "Orders.reportDate", "dateRange": ALL}]},
    "cube_surveys": {
        "measures": ["Surveys.responseCount", "Surveys.avgScore"],
        "dimensions": ["Surveys.branchId"],
        "timeDimensions": [{"dimension": "Surveys.reportDate", "dateRange": ALL}]},
    "cube_branch": {"dimensions": ["Branch.branchId", "Branch.branchName", "Branch.currency"]},
    "cube_channel": {"dimensions": ["Channel.channelKey", "Channel.channelName"]},
    "sq_measures_dims": {
        "measures": ["AdsCampaign.spend", "AdsCampaign.clicks"],
        "dimensions": ["AdsCampaign.channelKey", "AdsCampaign.campaignId"],
        "timeDimensions": [{"dimension": "AdsCampaign.reportDate", "dateRange": ALL}],
        "order": [["AdsCampaign.spend", "desc"], ["AdsCampaign.channelKey", "asc"], ["AdsCampaign.campaignId", "asc"]],
        "limit": 25, "offset": 5},
    "sq_granularity": {
        "measures": ["AdsCampaign.spend", "AdsCampaign.impressions"],
        "dimensions": ["AdsCampaign.channelKey"],
        "timeDimensions": [{"dimension": "AdsCampaign.reportDate", "granularity": "week", "dateRange": ALL}]},
    "sq_date_range": {
        "measures": ["Orders.orders", "Orders.netRevenue"],
        "dimensions": ["Orders.branchId"],
        "timeDimensions": [{"dimension": "Orders.reportDate", "granularity": "day", "dateRange": "last 90 days"}]},
    "sq_filters": {
        "measures": ["AdsCampaign.spend", "AdsCampaign.clicks"],
        "dimensions": ["AdsCampaign.channelKey", "AdsCampaign.campaignName"],
        "timeDimensions": [{"dimension": "AdsCampaign.reportDate", "granularity": "month",
                            "dateRange": ["1997-01-01", "1998-12-31"]}],
        "filters": [{"or": [{"member": "AdsCampaign.channelKey", "operator": "equals", "values": ["META", "NAVER_ADS"]},
                            {"member": "AdsCampaign.campaignName", "operator": "contains", "values": ["SHEET"]}]},
                    {"member": "AdsCampaign.sourceTier", "operator": "notEquals", "values": ["demo"]},
                    {"member": "AdsCampaign.clicks", "operator": "gt", "values": ["500"]}]},
    "sq_filters_nested": {
        "measures": ["AdsCampaign.spend", "AdsCampaign.clicks"],
        "dimensions": ["AdsCampaign.channelKey"],
        "timeDimensions": [{"dimension": "AdsCampaign.reportDate", "granularity": "month",
                            "dateRange": ["1996-01-01", "1998-12-31"]}],
        "filters": [{"and": [
            {"or": [{"member": "AdsCampaign.channelKey", "operator": "equals", "values": ["META"]},
                    {"and": [{"member": "AdsCampaign.channelKey", "operator": "notEquals", "values": ["META"]},
                             {"member": "AdsCampaign.reportDate", "operator": "gt", "values": ["1997-03-10"]}]}]},
            {"or": [{"member": "AdsCampaign.clicks", "operator": "gt", "values": ["3000"]},
                    {"and": [{"member": "AdsCampaign.impressions", "operator": "lte", "values": ["100000"]},
                             {"member": "AdsCampaign.spend", "operator": "gte", "values": ["10"]}]}]},
            {"or": []}]}]},
    "sq_join": {
        "measures": ["AdsCampaign.spend", "AdsCampaign.clicks"],
        "dimensions": ["Branch.branchName", "Channel.channelName"],
        "timeDimensions": [{"dimension": "AdsCampaign.reportDate", "dateRange": ALL}]},
}

TODAYS = {"sq_date_range": _dt.date(2001, 8, 1)}

for _name, _q in QUERIES_SQ.items():
    def _mk(q=_q, name=_name):
        def fn(spark, sf):
            return run(spark, sf, q, TODAYS.get(name, _dt.date(2024, 2, 1)))
        fn.__name__ = f"q_{name}"
        return fn
    query(_name)(_mk())


# The same queries over marts stored by month; the whole range is one refresh window.
MART_WINDOW = Window.of("1990-01-01", "2030-12-31")
STORED = {"cube_orders_stored": "cube_orders", "cube_surveys_stored": "cube_surveys", "sq_date_range_stored": "sq_date_range"}


def _stored(spark, sf, name):
    q = QUERIES_SQ[STORED[name]]
    cube = q["measures"][0].split(".")[0]
    path = f"{checkpoint_dir(spark).rstrip('/')}/mart-{cube}-{uuid.uuid4().hex}"
    SQ.refresh_mart(spark, cube, sources(spark, sf)[cube], path, MART_WINDOW)
    return finish(SQ.semantic_query(q, {cube: SQ.stored_mart(spark, path)}, TODAYS.get(STORED[name], _dt.date(2024, 2, 1))), rounded=ROUND)


for _name in STORED:
    query(_name)(lambda spark, sf, name=_name: _stored(spark, sf, name))


@query("sq_numeric")
def q_sq_numeric(spark, sf):
    """Numeric text from a landed result: numbers parse, other text is kept."""
    df = SQ.semantic_query(QUERIES_SQ["cube_orders"], sources(spark, sf), _dt.date(2024, 2, 1))
    txt = df.select("Orders__branchId", "Orders__currencyCode",
                    F.when(F.col("Orders__currencyCode") == "KRW", F.format_number("Orders__netRevenue", 2))
                     .otherwise(F.col("Orders__netRevenue").cast("string")).alias("net_text"),
                    F.col("Orders__orders").cast("string").alias("orders_text"))
    return finish(SQ.numeric_columns(txt, ["net_text", "orders_text"]))
