"""Raw normalisers: landed vendor payloads (JSON lines) -> typed raw rows.

The HTTP fetch is not part of the warehouse; payloads are assumed landed as
JSON text, one object per line/row. Each normaliser parses with a declared
schema (``from_json``, never inference) and applies the channel's rules as
column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from adlake.functions.columns import (decimal_to_micros, first_nonblank, int_via_float, money_text_to_micros,
                                      normalize_action_type, parsed, strip_account_prefix)
from adlake.session import Window

ACTIONS = "array<struct<action_type:string,value:string>>"
META_INSIGHT = (f"struct<account_id:string,account_name:string,campaign_id:string,campaign_name:string,"
                f"adset_id:string,adset_name:string,ad_id:string,ad_name:string,date_start:string,"
                f"attribution_setting:string,impressions:string,clicks:string,inline_link_clicks:string,"
                f"spend:string,actions:{ACTIONS},action_values:{ACTIONS},conversions:{ACTIONS},"
                f"conversion_values:{ACTIONS}>")
GOOGLE_ROW = ("struct<campaign:struct<id:string,name:string,advertising_channel_type:string>,"
              "ad_group:struct<id:string,name:string>,ad_group_ad:struct<ad:struct<id:string,name:string>>,"
              "segments:struct<date:string,conversion_action:string,conversion_action_name:string,"
              "conversion_action_category:string>,"
              "metrics:struct<impressions:bigint,clicks:bigint,cost_micros:bigint,conversions:double,"
              "conversions_value:double,all_conversions:double,all_conversions_value:string>,"
              "conversion_action:struct<resource_name:string,id:string,name:string,category:string,type:string,"
              "status:string,primary_for_goal:boolean,include_in_conversions_metric:boolean>>")
TIKTOK_ROW = ("struct<dimensions:struct<ad_id:string,stat_time_day:string>,"
              "metrics:struct<campaign_id:string,adgroup_id:string,impressions:string,clicks:string,spend:string,"
              "conversion:string,value:string>>")
NAVER_STAT = ("struct<adgroupId:string,nccAdgroupId:string,id:string,campaignId:string,nccCampaignId:string,"
              "adgroupName:string,date:string,impressions:string,impCnt:string,clicks:string,clkCnt:string,"
              "cost:string,salesAmt:string,ctr:string,avgCpc:string>")
NAVER_ENTITY = ("struct<nccCampaignId:string,campaignId:string,nccAdgroupId:string,adgroupId:string,id:string,"
                "name:string,campaignName:string,adgroupName:string>")


def _ctx_cols(ingestion_id: str, now, extract_ts) -> list[Column]:
    return [F.lit(ingestion_id).alias("ingestion_id"), F.lit(now).cast("timestamp").alias("ingestion_ts"),
            F.lit(extract_ts).cast("timestamp").alias("source_extract_ts")]


def decimal_half_up(c: Column, scale: int = 6) -> Column:
    """Numeric text / number rounded HALF_UP to ``scale`` places (decimal)."""
    d = c.cast("string").try_cast("decimal(38,12)")
    return F.round(d, scale).cast(f"decimal(38,{scale})")


def norm_meta_perf(payload: DataFrame, ingestion_id: str, now, extract_ts) -> DataFrame:
    """Meta insight rows: adset -> ad group, ints via float, spend kept as numeric."""
    p = parsed(payload.select("payload"), "payload", META_INSIGHT, "i")
    i = lambda n: F.col(f"i.{n}")
    return p.select(
        *_ctx_cols(ingestion_id, now, extract_ts),
        strip_account_prefix(i("account_id")).alias("account_id"), i("account_name").alias("account_name"),
        i("campaign_id").alias("campaign_id"), i("campaign_name").alias("campaign_name"),
        F.lit(None).cast("string").alias("campaign_type"),
        i("adset_id").alias("ad_group_id"), i("adset_name").alias("ad_group_name"),
        i("ad_id").alias("ad_id"), i("ad_name").alias("ad_name"),
        F.try_to_date(i("date_start")).alias("stat_date"), i("attribution_setting").alias("attribution_setting"),
        int_via_float(i("impressions")).alias("impressions"), int_via_float(i("clicks")).alias("clicks"),
        int_via_float(i("inline_link_clicks")).alias("link_clicks"),
        i("spend").alias("spend"), money_text_to_micros(i("spend")).alias("spend_micros"),
        F.to_json(i("actions")).alias("actions_json"), F.to_json(i("action_values")).alias("action_values_json"),
        F.to_json(i("conversions")).alias("conversions_json"),
        F.to_json(i("conversion_values")).alias("conversion_values_json"),
        F.col("payload").alias("source_payload"))


def norm_google_perf(payload: DataFrame, ingestion_id: str, now, extract_ts) -> DataFrame:
    """Google ad rows: nested message -> columns; cost stays in micros."""
    p = parsed(payload.select("customer_id", "payload"), "payload", GOOGLE_ROW, "r")
    m = F.col("r.metrics")
    return p.select(
        *_ctx_cols(ingestion_id, now, extract_ts), "customer_id",
        F.col("r.campaign.id").alias("campaign_id"), F.col("r.campaign.name").alias("campaign_name"),
        F.when(F.col("r.ad_group").isNotNull(), F.coalesce(F.col("r.ad_group.id"), F.lit(""))).alias("ad_group_id"),
        F.when(F.col("r.ad_group").isNotNull(), F.coalesce(F.col("r.ad_group.name"), F.lit(""))).alias("ad_group_name"),
        F.col("r.ad_group_ad.ad.id").alias("ad_id"), F.col("r.ad_group_ad.ad.name").alias("ad_name"),
        F.try_to_date(F.col("r.segments.date")).alias("stat_date"),
        F.when(m.isNotNull(), F.coalesce(m.impressions, F.lit(0))).alias("impressions"),
        F.when(m.isNotNull(), F.coalesce(m.clicks, F.lit(0))).alias("clicks"),
        F.coalesce(m.cost_micros, F.lit(0)).alias("cost_micros"),
        F.when(m.isNotNull(), F.coalesce(m.conversions, F.lit(0.0))).alias("conversions"),
        F.when(m.isNotNull(), F.coalesce(m.conversions_value, F.lit(0.0))).alias("conversions_value"),
        F.col("payload").alias("source_payload"))


def resource_tail(c: Column) -> Column:
    """Id after ``.../assets/`` in a resource name; any other text is kept whole."""
    return (F.when(c.isNull() | (c == ""), F.lit(None))
             .when(c.rlike(r"(^|/)assets/[^/]*$"), F.regexp_extract(c, r"assets/([^/]*)$", 1))
             .otherwise(c))


def norm_google_action(payload: DataFrame, ingestion_id: str, now, extract_ts, w: Window) -> DataFrame:
    """Campaign conversion actions: type = normalised category, else normalised
    name; rows without a type or with a non-positive count are skipped; value to
    6 places HALF_UP."""
    p = parsed(payload.select("customer_id", "payload"), "payload", GOOGLE_ROW, "r")
    seg, m = F.col("r.segments"), F.col("r.metrics")
    cat = seg.conversion_action_category
    name = F.coalesce(seg.conversion_action_name, F.lit(""))
    res = F.coalesce(seg.conversion_action, F.lit(""))
    atype = F.coalesce(normalize_action_type(cat), normalize_action_type(name))
    count = F.when(m.isNotNull(), F.coalesce(m.all_conversions, F.lit(0.0))).otherwise(F.lit(0.0))
    out = p.select(
        *_ctx_cols(ingestion_id, now, extract_ts), "customer_id",
        F.col("r.campaign.id").alias("campaign_id"), F.col("r.campaign.name").alias("campaign_name"),
        F.coalesce(F.try_to_date(F.when(F.coalesce(seg.date, F.lit("")) != "", seg.date)), F.lit(w.end)).alias("stat_date"),
        res.alias("conversion_action_resource_name"), resource_tail(res).alias("conversion_action_id"),
        F.when(name != "", name).alias("conversion_action_name"), F.when(cat != "", cat).alias("conversion_action_category"),
        atype.alias("action_type_raw"), count.alias("action_count"),
        decimal_half_up(F.coalesce(m.all_conversions_value, F.lit("0"))).alias("action_value"),
        F.col("payload").alias("source_payload"))
    return out.filter(F.col("action_type_raw").isNotNull() & (F.col("action_count") > 0))


def norm_google_conv_dim(payload: DataFrame, ingestion_id: str, now, extract_ts, w: Window,
                         order_col: str = "ingest_seq") -> DataFrame:
    """Conversion-action dimension: first row per resource name (else id) per account."""
    p = parsed(payload.select("customer_id", order_col, "payload"), "payload", GOOGLE_ROW, "r")
    ca = F.col("r.conversion_action")
    res, cid = F.coalesce(ca["resource_name"], F.lit("")), F.coalesce(ca["id"], F.lit(""))
    key = F.when(res != "", res).otherwise(cid)
    rows = p.filter(ca.isNotNull()).withColumn("__k", key).filter(F.col("__k") != "")
    rk = F.row_number().over(W.partitionBy("customer_id", "__k").orderBy(order_col))
    rows = rows.withColumn("__rn", rk).filter(F.col("__rn") == 1)
    return rows.select(
        *_ctx_cols(ingestion_id, now, extract_ts), F.lit(w.end).alias("collected_date"), "customer_id",
        F.when(res != "", res).alias("conversion_action_resource_name"),
        F.coalesce(F.when(cid != "", cid), resource_tail(res)).alias("conversion_action_id"),
        F.when(F.coalesce(ca["name"], F.lit("")) != "", ca["name"]).alias("conversion_action_name"),
        ca["category"].alias("conversion_action_category"), ca["type"].alias("conversion_action_type"),
        ca["status"].alias("conversion_action_status"),
        F.coalesce(ca["primary_for_goal"], F.lit(False)).alias("primary_for_goal"),
        F.coalesce(ca["include_in_conversions_metric"], F.lit(False)).alias("include_in_conversions_metric"),
        F.col("payload").alias("source_payload"))


def norm_tiktok_perf(payload: DataFrame, ingestion_id: str, now, extract_ts) -> DataFrame:
    """TikTok report rows: date = first 10 chars; numbers via float; missing -> 0."""
    p = parsed(payload.select("advertiser_id", "payload"), "payload", TIKTOK_ROW, "r")
    m, d = F.col("r.metrics"), F.col("r.dimensions")
    num = lambda c: F.coalesce(int_via_float(F.coalesce(c, F.lit("0"))), F.lit(0))
    return p.select(
        *_ctx_cols(ingestion_id, now, extract_ts), "advertiser_id",
        F.coalesce(m.campaign_id, F.lit("")).alias("campaign_id"), F.coalesce(m.adgroup_id, F.lit("")).alias("ad_group_id"),
        F.coalesce(d.ad_id, F.lit("")).alias("ad_id"),
        F.try_to_date(F.substring(F.coalesce(d.stat_time_day, F.lit("")), 1, 10), "yyyy-MM-dd").alias("stat_date"),
        F.col("payload").alias("source_payload"),
        num(m.impressions).alias("impressions"), num(m.clicks).alias("clicks"),
        F.coalesce(m.spend, F.lit("")).alias("spend"), num(m.conversion).alias("conversions"),
        F.coalesce(F.coalesce(m.value, F.lit("0")).try_cast("double"), F.lit(0.0)).alias("conversions_value"))


def _naver_campaigns(campaigns: DataFrame, order_col: str) -> DataFrame:
    """(__cc, __cid, __cname): the name of each campaign, the last list entry wins."""
    e = parsed(campaigns.select(F.col("customer_id").alias("__cc"), order_col, "payload"), "payload", NAVER_ENTITY, "e")
    c = e.select("__cc", order_col, first_nonblank(F.col("e.nccCampaignId"), F.col("e.campaignId"), F.col("e.id")).alias("__cid"),
                 F.coalesce(first_nonblank(F.col("e.name"), F.col("e.campaignName")), F.lit("")).alias("__cname"))
    return c.filter(F.col("__cid").isNotNull()).groupBy("__cc", "__cid").agg(F.max_by("__cname", order_col).alias("__cname"))


def _naver_adgroups(adgroups: DataFrame, order_col: str) -> DataFrame:
    """(__ac, __aid, __acid, __aname): campaign and name of each ad group, the last list entry wins."""
    e = parsed(adgroups.select(F.col("customer_id").alias("__ac"), order_col, "payload"), "payload", NAVER_ENTITY, "e")
    a = e.select("__ac", order_col, first_nonblank(F.col("e.nccAdgroupId"), F.col("e.adgroupId"), F.col("e.id")).alias("__aid"),
                 F.coalesce(first_nonblank(F.col("e.nccCampaignId"), F.col("e.campaignId")), F.lit("")).alias("__acid"),
                 F.coalesce(first_nonblank(F.col("e.name"), F.col("e.adgroupName")), F.lit("")).alias("__aname"))
    return a.filter(F.col("__aid").isNotNull()).groupBy("__ac", "__aid").agg(
        F.max_by("__acid", order_col).alias("__acid"), F.max_by("__aname", order_col).alias("__aname"))


def norm_naver_perf(stats: DataFrame, campaigns: DataFrame, adgroups: DataFrame, w: Window,
                    ingestion_id: str, now, extract_ts, order_col: str = "ingest_seq") -> DataFrame:
    """Naver stats with alias picks and names looked up from the entity lists.

    ``stats``/``campaigns``/``adgroups`` carry ``customer_id`` and a JSON
    ``payload``, the lists also their position (``order_col``). Campaign id comes from the stat, else from its ad group; the
    date defaults to the window end; ad ids are always NULL.
    """
    s = parsed(stats.select("customer_id", "payload"), "payload", NAVER_STAT, "s")
    c = _naver_campaigns(campaigns, order_col)
    a = _naver_adgroups(adgroups, order_col)
    ag = first_nonblank(F.col("s.adgroupId"), F.col("s.nccAdgroupId"), F.col("s.id"))
    s = s.withColumn("__ag", ag)
    s = s.join(a, (s.customer_id == a.__ac) & (s.__ag == a.__aid), "left")
    camp = F.coalesce(first_nonblank(F.col("s.campaignId"), F.col("s.nccCampaignId")),
                      F.when(F.col("__acid") != "", F.col("__acid")), F.lit(""))
    s = s.withColumn("__camp", camp)
    s = s.join(c, (s.customer_id == c.__cc) & (s.__camp == c.__cid), "left")
    pick = lambda a1, a2: F.coalesce(F.col(f"s.{a1}"), F.col(f"s.{a2}"), F.lit("0"))
    return s.select(
        *_ctx_cols(ingestion_id, now, extract_ts), F.col("customer_id").alias("account_id"),
        F.when(F.col("__camp") != "", F.col("__camp")).alias("campaign_id"),
        F.when(F.coalesce("__cname", F.lit("")) != "", F.col("__cname")).alias("campaign_name"),
        F.col("__ag").alias("ad_group_id"),
        F.coalesce(first_nonblank(F.col("s.adgroupName")), F.when(F.col("__aname") != "", F.col("__aname")))
         .alias("ad_group_name"),
        F.lit(None).cast("string").alias("ad_id"), F.lit(None).cast("string").alias("ad_name"),
        F.coalesce(F.try_to_date(F.col("s.date"), "yyyy-MM-dd"), F.lit(w.end)).alias("stat_date"),
        int_via_float(pick("impressions", "impCnt")).alias("impressions"),
        int_via_float(pick("clicks", "clkCnt")).alias("clicks"),
        F.coalesce(F.col("s.cost"), F.col("s.salesAmt"), F.lit("")).alias("spend"),
        F.col("s.ctr").alias("ctr"), F.col("s.avgCpc").alias("avg_cpc"), F.col("payload").alias("source_payload"))


META_BREAKDOWN = META_INSIGHT[:-1] + ",age:string,gender:string,country:string,region:string>"
GOOGLE_BREAKDOWN = ("struct<campaign:struct<id:string,name:string>,segments:struct<date:string,geo_target_region:string>,"
                    "ad_group_criterion:struct<age_range:struct<type:string>,gender:struct<type:string>>,"
                    "user_location_view:struct<country_criterion_id:string>,"
                    "metrics:struct<impressions:bigint,clicks:bigint,cost_micros:bigint,conversions:double,conversions_value:double>>")

# Countries (United States, Canada, Mexico) whose regions are kept; all others count as "others".
REGION_COUNTRIES = ["geoTargetConstants/2840", "geoTargetConstants/2124", "geoTargetConstants/2484"]

# The view each Google breakdown is queried from.
BREAKDOWN_VIEWS = {
    "age_range": "age_range_view",
    "gender": "gender_view",
    "geo_target_country": "user_location_view",
    "geo_target_region": "user_location_view",
}


def norm_meta_breakdown(payload: DataFrame, ingestion_id: str, now, extract_ts) -> DataFrame:
    """Meta campaign insights -> one row for each breakdown key an insight has a value of.

    A payload whose request named two breakdowns (age and gender) gives two rows; blank values
    give none. The ad-group columns repeat the campaign. An unreadable payload gives no rows.
    """
    p = parsed(payload.select("payload"), "payload", META_BREAKDOWN, "i")
    i = lambda n: F.col(f"i.{n}")
    keys = ["age", "gender", "country", "region"]
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), i(k).alias("v")) for k in keys])
    rows = p.withColumn("b", F.explode(F.filter(pairs, lambda x: F.trim(F.coalesce(x["v"], F.lit(""))) != "")))
    return rows.select(
        *_ctx_cols(ingestion_id, now, extract_ts), strip_account_prefix(i("account_id")).alias("account_id"), i("account_name").alias("account_name"),
        i("campaign_id").alias("campaign_id"), i("campaign_name").alias("campaign_name"),
        i("campaign_id").alias("ad_group_id"), i("campaign_name").alias("ad_group_name"),
        F.try_to_date(i("date_start")).alias("stat_date"), F.col("b.k").alias("breakdown_key"), F.col("b.v").alias("breakdown_value"),
        *[i(k).alias(k) for k in keys], i("attribution_setting").alias("attribution_setting"),
        int_via_float(i("impressions")).alias("impressions"), int_via_float(i("clicks")).alias("clicks"),
        int_via_float(i("inline_link_clicks")).alias("link_clicks"), decimal_half_up(i("spend")).alias("spend"),
        money_text_to_micros(i("spend")).alias("spend_micros"),
        *[F.to_json(i(c)).alias(f"{c}_json") for c in ("actions", "action_values", "conversions", "conversion_values")],
        F.col("payload").alias("source_payload"))


def geo_constant(value: Column) -> Column:
    """``geoTargetConstants/<id>`` of an id in digits; other text stays, blank text is null."""
    t = F.trim(value)
    return F.when(t.rlike("^[0-9]+$"), F.concat(F.lit("geoTargetConstants/"), t)).when(t != "", t)


def norm_google_breakdown(payload: DataFrame, w: Window, ingestion_id: str, now, extract_ts) -> DataFrame:
    """Google breakdown rows (customer_id, breakdown_key, payload) -> long breakdown rows, not yet collapsed.

    The key says which query a payload answers. Rows without a campaign or a value are dropped; a
    region outside the kept countries, or none, is "others"; a missing date is the window's end.
    """
    p = parsed(payload.select("customer_id", "breakdown_key", "payload"), "payload", GOOGLE_BREAKDOWN, "r")
    m, key = F.col("r.metrics"), F.col("breakdown_key")
    country = geo_constant(F.col("r.user_location_view.country_criterion_id"))
    region = F.when(country.isin(REGION_COUNTRIES), geo_constant(F.col("r.segments.geo_target_region")))
    value = (F.when(key == "age_range", F.col("r.ad_group_criterion.age_range.type"))
              .when(key == "gender", F.col("r.ad_group_criterion.gender.type"))
              .when(key == "geo_target_country", country)
              .when(key == "geo_target_region", F.coalesce(region, F.lit("others"))))
    view = F.create_map(*[F.lit(x) for kv in BREAKDOWN_VIEWS.items() for x in kv])
    date = F.col("r.segments.date")
    rows = p.withColumn("v", value).filter((F.coalesce(F.col("r.campaign.id"), F.lit("")) != "") & (F.coalesce("v", F.lit("")) != ""))
    return rows.select(
        *_ctx_cols(ingestion_id, now, extract_ts), "customer_id", F.col("r.campaign.id").alias("campaign_id"),
        F.coalesce(F.col("r.campaign.name"), F.lit("")).alias("campaign_name"),
        F.coalesce(F.try_to_date(F.when(date != "", date)), F.lit(w.end)).alias("stat_date"), "breakdown_key", F.col("v").alias("breakdown_value"),
        *[F.when(key == k, F.col("v")).alias(k) for k in BREAKDOWN_VIEWS],
        F.coalesce(m.impressions, F.lit(0)).alias("impressions"), F.coalesce(m.clicks, F.lit(0)).alias("clicks"),
        F.coalesce(m.cost_micros, F.lit(0)).alias("cost_micros"), F.coalesce(m.conversions, F.lit(0.0)).alias("conversions"),
        F.coalesce(m.conversions_value, F.lit(0.0)).alias("conversions_value"), view[key].alias("source_view"), F.col("payload").alias("source_payload"))


def google_breakdown_raw(rows: DataFrame) -> DataFrame:
    """The collapsed raw table of :func:`norm_google_breakdown` rows, with the value in micros; a grain keeps its smallest payload."""
    out = agg_google_breakdown(rows.withColumn("ingest_seq", F.col("source_payload")))
    return out.withColumn("conversion_value_micros", (F.col("conversions_value") * 1_000_000).cast("bigint"))


def agg_google_breakdown(rows: DataFrame, order_col: str = "ingest_seq") -> DataFrame:
    """Collapse duplicate breakdown grains: sums, latest timestamps, first row's
    other fields, value to 6 places HALF_UP. One partial aggregation, no sort."""
    keys = ["customer_id", "campaign_id", "stat_date", "breakdown_key", "breakdown_value"]
    others = [c for c in rows.columns if c not in keys + ["impressions", "clicks", "cost_micros", "conversions",
                                                          "conversions_value", "source_extract_ts", "ingestion_ts",
                                                          order_col]]
    first = [F.min_by(F.col(c), F.col(order_col)).alias(c) for c in others]
    return (rows.groupBy(*keys).agg(
        F.sum(F.coalesce("impressions", F.lit(0))).alias("impressions"),
        F.sum(F.coalesce("clicks", F.lit(0))).alias("clicks"),
        F.sum(F.coalesce("cost_micros", F.lit(0))).alias("cost_micros"),
        F.sum(F.coalesce("conversions", F.lit(0.0))).alias("conversions"),
        F.sum(F.coalesce("conversions_value", F.lit(0.0))).alias("conversions_value"),
        F.max("source_extract_ts").alias("source_extract_ts"), F.max("ingestion_ts").alias("ingestion_ts"),
        *first)
        .withColumn("conversions_value", decimal_half_up(F.col("conversions_value"))))


GOOGLE_CREATIVE = ("struct<campaign:struct<id:string>,ad_group:struct<id:string>,segments:struct<date:string>,"
                   "ad_group_ad:struct<ad_strength:string,status:string,ad:struct<id:string,name:string,type:string,"
                   "final_urls:array<string>,image_ad:struct<image_url:string>,video_ad:struct<video:struct<asset:string>>>>>")
GOOGLE_ASSET = ("struct<campaign:struct<id:string,advertising_channel_type:string>,ad_group:struct<id:string>,"
                "ad_group_ad:struct<ad:struct<id:string>>,asset_group:struct<id:string>,"
                "ad_group_ad_asset_view:struct<asset:string,field_type:string,performance_label:string>,"
                "asset_group_asset:struct<asset:string,field_type:string,performance_label:string>,"
                "segments:struct<date:string>,metrics:struct<impressions:bigint,clicks:bigint,cost_micros:bigint,"
                "conversions:double,conversions_value:double>>")
TIKTOK_AD = ("struct<ad_id:string,campaign_id:string,adgroup_id:string,ad_name:string,ad_format:string,ad_text:string,"
             "video_id:string,image_ids:array<string>,image_url:string,video_url:string,landing_page_url:string>")
NAVER_AD = ("struct<nccAdId:string,adId:string,id:string,nccCampaignId:string,campaignId:string,nccAdgroupId:string,"
            "adgroupId:string,adName:string,name:string,type:string,adType:string,"
            "ad:struct<headline:string,description:string,image:struct<url:string>>>")


def norm_google_creative(payload: DataFrame, w: Window, ingestion_id: str, now, extract_ts) -> DataFrame:
    """Google ads -> creative rows (creative id = ad id), url and video-id arrays;
    text fields are not collected (assets-only policy)."""
    p = parsed(payload.select("customer_id", "payload"), "payload", GOOGLE_CREATIVE, "r")
    ad = F.col("r.ad_group_ad.ad")
    img = ad.image_ad.image_url
    vid = ad.video_ad.video.asset
    none = F.lit(None).cast("string")
    return p.filter(ad.isNotNull()).select(
        *_ctx_cols(ingestion_id, now, extract_ts),
        F.coalesce(F.try_to_date(F.when(F.coalesce(F.col("r.segments.date"), F.lit("")) != "", F.col("r.segments.date"))),
                   F.lit(w.end)).alias("collected_date"), "customer_id",
        F.col("r.campaign.id").alias("campaign_id"), F.col("r.ad_group.id").alias("ad_group_id"),
        F.coalesce(ad.id, F.lit("")).alias("ad_id"), F.coalesce(ad.id, F.lit("")).alias("creative_id"),
        F.coalesce(ad["name"], F.lit("")).alias("creative_name"), ad["type"].alias("ad_type"),
        F.col("r.ad_group_ad.ad_strength").alias("ad_strength"), F.col("r.ad_group_ad.status").alias("status"),
        none.alias("headline_1"), none.alias("headline_2"), none.alias("headline_3"), none.alias("description_1"),
        none.alias("description_2"), none.alias("business_name"), none.alias("call_to_action"),
        F.coalesce(ad.final_urls, F.array().cast("array<string>")).alias("final_urls"),
        F.when(F.coalesce(img, F.lit("")) != "", F.array(img)).otherwise(F.array().cast("array<string>")).alias("image_urls"),
        F.when(F.coalesce(vid, F.lit("")) != "",
               F.array(F.when(F.coalesce(resource_tail(vid), F.lit("")) != "", resource_tail(vid)).otherwise(vid)))
         .otherwise(F.array().cast("array<string>")).alias("youtube_video_ids"), F.col("payload").alias("source_payload"))


def norm_google_asset(ad_rows: DataFrame | None, pmax_rows: DataFrame | None, w: Window, ingestion_id: str, now,
                      extract_ts) -> DataFrame:
    """Asset performance rows: ad-group assets and PMax asset-group assets
    (``is_pmax``, ``source_view``), either of which may be None; rows without
    an asset id are dropped."""
    def side(df, view, pmax):
        p = parsed(df.select("customer_id", "payload"), "payload", GOOGLE_ASSET, "r")
        v, m = F.col(f"r.{view}"), F.col("r.metrics")
        res = F.coalesce(v.asset, F.lit(""))
        return p.select(
            *_ctx_cols(ingestion_id, now, extract_ts),
            F.coalesce(F.try_to_date(F.when(F.coalesce(F.col("r.segments.date"), F.lit("")) != "", F.col("r.segments.date"))),
                       F.lit(w.end)).alias("stat_date"), "customer_id",
            F.col("r.campaign.id").alias("campaign_id"),
            F.col("r.campaign.advertising_channel_type").alias("campaign_channel_type"),
            (F.col("r.asset_group.id") if pmax else F.lit(None).cast("string")).alias("asset_group_id"),
            (F.lit(None).cast("string") if pmax else F.col("r.ad_group.id")).alias("ad_group_id"),
            (F.lit(None).cast("string") if pmax else F.col("r.ad_group_ad.ad.id")).alias("ad_id"),
            resource_tail(res).alias("asset_id"), F.when(res != "", res).alias("asset_resource_name"),
            v.field_type.alias("field_type"), v.performance_label.alias("performance_label"),
            F.lit(pmax).alias("is_pmax"),
            F.coalesce(m.impressions, F.lit(0)).alias("impressions"), F.coalesce(m.clicks, F.lit(0)).alias("clicks"),
            F.coalesce(m.cost_micros, F.lit(0)).alias("cost_micros"),
            F.coalesce(m.conversions, F.lit(0.0)).alias("conversions"),
            F.coalesce(m.conversions_value, F.lit(0.0)).alias("conversions_value"),
            decimal_to_micros(F.coalesce(m.conversions_value, F.lit(0.0))).alias("conversions_value_micros"),
            F.lit(view).alias("source_view"), F.col("payload").alias("source_payload"))
    sides = [side(df, view, pmax) for df, view, pmax in (
        (ad_rows, "ad_group_ad_asset_view", False), (pmax_rows, "asset_group_asset", True)) if df is not None]
    out = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    return out.filter(F.col("asset_id").isNotNull() & (F.col("asset_id") != ""))


def norm_tiktok_creative(ads: DataFrame, w: Window, ingestion_id: str, now, extract_ts) -> DataFrame:
    """TikTok ads -> creative rows: creative id = ad id, thumbnail = image."""
    p = parsed(ads.select("advertiser_id", "payload"), "payload", TIKTOK_AD, "a")
    a = F.col("a")
    e = lambda c: F.coalesce(c, F.lit(""))
    return p.select(
        *_ctx_cols(ingestion_id, now, extract_ts), F.lit(w.end).alias("collected_date"), "advertiser_id",
        e(a.campaign_id).alias("campaign_id"), e(a.adgroup_id).alias("ad_group_id"), e(a.ad_id).alias("ad_id"),
        e(a.ad_id).alias("creative_id"), e(a.ad_name).alias("creative_name"), e(a.ad_format).alias("ad_format"),
        e(a.ad_text).alias("body_text"), e(a.video_id).alias("video_id"), e(a.image_url).alias("image_url"),
        e(a.image_url).alias("thumbnail_url"), e(a.video_url).alias("video_url"),
        e(a.landing_page_url).alias("landing_page_url"), F.col("payload").alias("source_payload"))


def norm_naver_creative(ads: DataFrame, adgroups: DataFrame, w: Window, ingestion_id: str, now,
                        extract_ts, order_col: str = "ingest_seq") -> DataFrame:
    """Naver ads -> creative rows; campaign from the ad, else from its ad group.

    An ad's columns are picked before the lookup, so the join moves those a reader wants and not
    the parsed payload.
    """
    p = parsed(ads.select("customer_id", "payload"), "payload", NAVER_AD, "a")
    ad_id = first_nonblank(F.col("a.nccAdId"), F.col("a.adId"), F.col("a.id"))
    p = p.select(
        F.col("customer_id").alias("account_id"), first_nonblank(F.col("a.nccCampaignId"), F.col("a.campaignId")).alias("__camp"),
        first_nonblank(F.col("a.nccAdgroupId"), F.col("a.adgroupId")).alias("ad_group_id"), ad_id.alias("ad_id"),
        first_nonblank(F.col("a.adName"), F.col("a.name")).alias("creative_name"),
        first_nonblank(F.col("a.type"), F.col("a.adType")).alias("ad_type"),
        F.col("a.ad.headline").alias("headline"), F.col("a.ad.description").alias("body_text"),
        F.col("a.ad.image.url").alias("thumbnail_url"), F.col("payload").alias("source_payload"))
    a = _naver_adgroups(adgroups, order_col).drop("__aname")
    p = p.join(a, (p.account_id == a.__ac) & (p.ad_group_id == a.__aid), "left")
    return p.select(
        *_ctx_cols(ingestion_id, now, extract_ts), F.lit(w.end).alias("collected_date"), "account_id",
        F.coalesce("__camp", F.when(F.col("__acid") != "", F.col("__acid"))).alias("campaign_id"), "ad_group_id", "ad_id",
        F.col("ad_id").alias("creative_id"), "creative_name", "ad_type", "headline", "body_text", "thumbnail_url",
        "source_payload")
