"""Filter trees of the metrics layer: what goes to rows, what to groups, what is refused."""

import datetime as dt

import pytest

from adlake.plans import semantic as SQ

DAY = dt.date(2024, 1, 2)
ALL = [{"dimension": "AdsCampaign.reportDate", "dateRange": ["2024-01-01", "2024-12-31"]}]


@pytest.fixture(scope="module")
def sources(spark):
    ads = spark.createDataFrame(
        [(DAY, "B1", "META", "c1", "Summer Sale", 10, 5), (DAY, "B1", "META", "c2", "winter", 20, 7),
         (dt.date(2024, 1, 9), "B2", "NAVER_ADS", "c3", None, 100, 50), (dt.date(2024, 2, 1), "B2", "TIKTOK_ADS", "c4", "sale 100%", 1, 1)],
        "report_date date, branch_id string, channel_key string, campaign_id string, campaign_name string, impressions long, clicks long")
    more = {"spend_native_micros": "clicks * 1000000", "conversion_value_native_micros": "clicks * 0", "source_tier": "'api'"}
    return {"AdsCampaign": ads.selectExpr("*", *[f"{e} AS {c}" for c, e in more.items()])}


def ask(sources, filters, dims=("AdsCampaign.campaignId",), **more):
    q = {"measures": ["AdsCampaign.clicks"], "dimensions": list(dims), "timeDimensions": ALL, "filters": filters, **more}
    return sorted(r[0] for r in SQ.semantic_query(q, sources, dt.date(2024, 2, 1)).collect())


def f(member, op, *values):
    return {"member": f"AdsCampaign.{member}", "operator": op, "values": list(values)}


def test_and_of_dimension_and_measure_is_divided(sources):
    assert ask(sources, [{"and": [f("channelKey", "equals", "META"), f("clicks", "gt", "5")]}]) == ["c2"]
    deep = [{"and": [{"and": [f("clicks", "lt", "50"), f("channelKey", "notEquals", "TIKTOK_ADS")]}, f("impressions", "gte", "20")]}]
    assert ask(sources, deep) == ["c2"]


def test_or_on_one_side_only(sources):
    assert ask(sources, [{"or": [f("channelKey", "equals", "META"), f("campaignName", "contains", "100%")]}]) == ["c1", "c2", "c4"]
    assert ask(sources, [{"or": [f("clicks", "gt", 40), {"and": [f("impressions", "lt", 5), f("clicks", "lt", 2)]}]}]) == ["c3", "c4"]
    for mixed in ([f("channelKey", "equals", "META"), f("clicks", "gt", 5)],
                  [f("channelKey", "equals", "META"), {"and": [f("channelKey", "set"), f("clicks", "gt", 5)]}]):
        with pytest.raises(SQ.FilterError, match="or cannot mix dimensions and measures: AdsCampaign.channelKey"):
            ask(sources, [{"or": mixed}])


def test_empty_groups_and_values(sources):
    everything = ["c1", "c2", "c3", "c4"]
    for empty in ({"or": []}, {"and": []}, {"or": [{"and": []}]}, {"and": [{"or": []}]}):
        assert ask(sources, [empty]) == everything
    assert ask(sources, [{"or": [{"and": []}, f("channelKey", "equals", "META")]}]) == ["c1", "c2"]
    assert ask(sources, [f("channelKey", "equals")]) == ask(sources, [f("campaignName", "contains")]) == []
    assert ask(sources, [f("channelKey", "notEquals")]) == ask(sources, [f("campaignName", "notContains")]) == everything
    with pytest.raises(SQ.FilterError, match="takes one value"):
        ask(sources, [f("clicks", "gt")])


def test_dates_and_numbers(sources):
    assert ask(sources, [f("reportDate", "gt", "2024-01-02")]) == ["c3", "c4"]
    assert ask(sources, [f("reportDate", "beforeOrOnDate", "2024-01-09T00:00:00")]) == ["c1", "c2", "c3"]
    assert ask(sources, [f("reportDate", "inDateRange", "2024-01-03", "2024-01-31")]) == ["c3"]
    assert ask(sources, [f("reportDate", "notInDateRange", "2024-01-02")]) == ["c3", "c4"]
    assert ask(sources, [f("reportDate", "equals", "2024-01-02")]) == ["c1", "c2"]
    assert ask(sources, [f("clicks", "equals", "5", 7)]) == ["c1", "c2"]
    assert ask(sources, [f("campaignName", "gt", "5")]) == []
    for wrong in (f("reportDate", "gt", "yesterday"), f("channelKey", "afterDate", "2024-01-01"), f("clicks", "lt", "many"), f("clicks", "like", "x"), {"operator": "set"}):
        with pytest.raises(SQ.FilterError):
            ask(sources, [wrong])


def test_null_names_and_unselected_measures(sources):
    assert ask(sources, [f("campaignName", "notContains", "sale")]) == ["c2", "c3"]
    assert ask(sources, [f("campaignName", "notSet")]) == ["c3"]
    assert ask(sources, [{"and": [f("impressions", "gt", 15), f("campaignName", "set")]}]) == ["c2"]


def test_order_by_what_is_not_selected_is_refused(sources):
    with pytest.raises(ValueError, match="does not select"):
        ask(sources, [], order={"AdsCampaign.reportDate": "asc"})


def test_row_part_reaches_the_scan(spark, sources, tmp_path):
    path = str(tmp_path / "mart")
    sources["AdsCampaign"].write.partitionBy("report_date").parquet(path)
    q = {"measures": ["AdsCampaign.clicks"], "dimensions": ["AdsCampaign.campaignId"], "timeDimensions": ALL,
         "filters": [{"and": [f("channelKey", "equals", "META"), f("clicks", "gt", 1), f("reportDate", "lt", "2024-01-05")]}]}
    out = SQ.semantic_query(q, {"AdsCampaign": spark.read.parquet(path)}, DAY)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(channel_key), EqualTo(channel_key,META)]" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "report_date" in pruned and "2024-01-05" in pruned
    assert len(out.collect()) == 2
