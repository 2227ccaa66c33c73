"""Audience breakdowns: unpivot, staging, branch fact, geo names, recent mart, DQ."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import micros_to_double, nonblank, safe_ratio, strip_account_prefix, sum0
from adlake.operators.core import branch_by_account
from adlake.operators.joins import bounded_broadcast
from adlake.session import Window

# Breakdown keys kept per channel.
META_KEYS = ["age", "gender", "country", "region"]
GOOGLE_KEYS = ["age_range", "gender", "geo_target_country", "geo_target_region"]
GEO_KEYS = ["geo_target_country", "geo_target_region"]

# Google age-range codes and their labels (anything else is Unknown).
AGE_LABELS = {
    "AGE_RANGE_18_24": "18-24",
    "AGE_RANGE_25_34": "25-34",
    "AGE_RANGE_35_44": "35-44",
    "AGE_RANGE_45_54": "45-54",
    "AGE_RANGE_55_64": "55-64",
    "AGE_RANGE_65_UP": "65+",
    "AGE_RANGE_UNDETERMINED": "Unknown",
}

# Korean names of countries used in geo display names.
COUNTRY_NAME_KO = {
    "United States": "미국",
    "Canada": "캐나다",
    "Mexico": "멕시코",
    "South Korea": "대한민국",
    "Korea, Republic of": "대한민국",
    "Japan": "일본",
    "China": "중국",
    "United Arab Emirates": "아랍에미리트",
    "Singapore": "싱가포르",
    "Hong Kong": "홍콩",
    "Taiwan": "대만",
}


def unpivot_breakdown(wide: DataFrame, keys: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per non-blank breakdown key of each insight row (lateral unpivot).

    ``keep`` columns are carried; the per-key columns stay as they are, so a
    row of key ``age`` still has its ``gender`` value (the reference fills
    every column of the row).
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in keys])
    out = wide.select(*keep, *[c for c in keys if c not in keep], F.explode(pairs).alias("__p"))
    out = out.filter(F.col("__p.v").isNotNull() & (F.trim(F.col("__p.v")) != ""))
    return out.select(*keep, *[c for c in keys if c not in keep],
                      F.col("__p.k").alias("breakdown_key"), F.col("__p.v").alias("breakdown_value"))


def age_label(code: Column) -> Column:
    m = F.create_map(*[x for kv in AGE_LABELS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(m[code], F.lit("Unknown"))


def stg_breakdown(meta: DataFrame, google: DataFrame, w: Window, now=None) -> DataFrame:
    """Campaign x day x key x value sums from Meta and Google breakdown rows.

    Values are projected (trimmed, age codes labelled) before grouping, so
    two codes that map to one label form one row.
    """
    lt = F.coalesce(F.col("source_extract_ts"), F.col("ingestion_ts"),
                    *([F.lit(now).cast("timestamp")] if now else []))
    base = lambda df: (df.filter(w.contains("stat_date"))
                         .filter(F.col("campaign_id").isNotNull() & (F.trim("campaign_id") != "")
                                 & F.col("breakdown_value").isNotNull() & (F.trim("breakdown_value") != "")))
    m = base(meta).filter(F.col("breakdown_key").isin(META_KEYS)).select(
        F.lit("META").alias("channel_key"), strip_account_prefix("account_id").alias("account_id_norm"),
        F.coalesce("campaign_id", F.lit("")).alias("campaign_id"), "campaign_name", "stat_date", "breakdown_key",
        F.coalesce(nonblank(F.trim("breakdown_value")), F.lit("Unknown")).alias("breakdown_value"),
        "impressions", "clicks", F.col("spend_micros"), F.lit(None).cast("double").alias("conversions"),
        F.lit(None).cast("bigint").alias("conversion_value_micros"), "attribution_setting", lt.alias("load_ts"))
    g = base(google).filter(F.col("breakdown_key").isin(GOOGLE_KEYS)).select(
        F.lit("GOOGLE_ADS").alias("channel_key"), F.col("customer_id").alias("account_id_norm"),
        F.coalesce("campaign_id", F.lit("")).alias("campaign_id"), "campaign_name", "stat_date",
        F.when(F.col("breakdown_key") == "age_range", F.lit("age")).otherwise(F.col("breakdown_key")).alias("breakdown_key"),
        F.when(F.col("breakdown_key") == "age_range", age_label(F.col("breakdown_value")))
         .otherwise(F.coalesce(nonblank(F.trim("breakdown_value")), F.lit("Unknown"))).alias("breakdown_value"),
        "impressions", "clicks", F.col("cost_micros").alias("spend_micros"), "conversions",
        "conversion_value_micros", F.lit(None).cast("string").alias("attribution_setting"), lt.alias("load_ts"))
    keys = ["channel_key", "account_id_norm", "campaign_id", "stat_date", "breakdown_key", "breakdown_value"]
    agg = lambda df, table: (df.groupBy(*keys).agg(
        F.max("campaign_name").alias("campaign_name"), sum0("impressions").alias("impressions"),
        sum0("clicks").alias("clicks"), sum0("spend_micros").alias("spend_micros"),
        (sum0("conversions") if table.startswith("raw_ads.google") else F.lit(None).cast("double")).alias("conversion_count"),
        (sum0("conversion_value_micros") if table.startswith("raw_ads.google") else F.lit(None).cast("bigint"))
        .alias("conversion_value_micros"),
        F.max("attribution_setting").alias("attribution_setting"), F.max("load_ts").alias("load_ts"))
        .withColumn("source_table", F.lit(table)))
    return (agg(m, "raw_ads.meta_ads_campaign_breakdown_raw")
            .unionByName(agg(g, "raw_ads.google_ads_campaign_breakdown_raw")))


def fact_breakdown(stg: DataFrame, account_map: DataFrame, w: Window) -> DataFrame:
    """Breakdown fact with the account's branch (newest mapping wins)."""
    return branch_by_account(stg.filter(w.contains("stat_date")), account_map, "stat_date")


# ------------------------------------------------------------------ geo names
def geo_display_name(name: Column, country: Column, target_type: Column, geo_id: Column) -> Column:
    """English display name: country for COUNTRY rows, else "name, country"
    unless the name already contains the country (case-insensitive)."""
    n, c, t = F.trim(F.coalesce(name, F.lit(""))), F.trim(F.coalesce(country, F.lit(""))), \
        F.upper(F.trim(F.coalesce(target_type, F.lit(""))))
    first = lambda *xs: F.coalesce(*[F.when(x != "", x) for x in xs], F.lit("Unknown"))
    return (F.when(geo_id == "others", F.lit("Others"))
             .when(t == "COUNTRY", first(c, n))
             .when((n != "") & (c != "") & (F.instr(F.lower(n), F.lower(c)) == 0), F.concat(n, F.lit(", "), c))
             .otherwise(first(n, c)))


def country_name_ko(country: Column) -> Column:
    m = F.create_map(*[x for kv in COUNTRY_NAME_KO.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.when(F.coalesce(country, F.lit("")) != "", F.coalesce(m[country], country))


def geo_display_name_ko(name: Column, country: Column, target_type: Column, geo_id: Column) -> Column:
    """Korean display name; the containment test is case-sensitive."""
    n = F.trim(F.coalesce(name, F.lit("")))
    c = F.trim(F.coalesce(country_name_ko(country), F.lit("")))
    t = F.upper(F.trim(F.coalesce(target_type, F.lit(""))))
    first = lambda *xs: F.coalesce(*[F.when(x != "", x) for x in xs], F.lit("미확인"))
    return (F.when(geo_id == "others", F.lit("기타"))
             .when(t == "COUNTRY", first(c, n))
             .when((n != "") & (c != "") & (F.instr(n, c) == 0), F.concat(n, F.lit(", "), c))
             .otherwise(first(n, c)))


def geo_ids_distinct(breakdown_raw: DataFrame, w: Window) -> DataFrame:
    """Distinct non-blank geo ids of geo breakdown rows in the window."""
    return (breakdown_raw.filter(w.contains("stat_date") & F.col("breakdown_key").isin(GEO_KEYS))
            .select(F.trim("breakdown_value").alias("geo_target_constant_id"))
            .filter(F.col("geo_target_constant_id") != "").distinct())


def geo_map_build(ids: DataFrame, metadata: DataFrame) -> DataFrame:
    """Map rows for ids: metadata with display names, an Others bucket, else Unknown."""
    md = bounded_broadcast(metadata)
    j = ids.join(md, "geo_target_constant_id", "left")
    gid, found = F.col("geo_target_constant_id"), F.col("target_type").isNotNull()
    return j.select(
        gid,
        F.when(found, F.col("target_type")).when(gid == "others", F.lit("BUCKET")).otherwise(F.lit("UNKNOWN"))
         .alias("target_type"),
        F.when(found, F.col("country_code")).alias("country_code"),
        F.when(found, F.col("country_name")).alias("country_name"),
        F.when(found, F.col("target_name")).when(gid == "others", F.lit("Others")).otherwise(F.lit("Unknown"))
         .alias("target_name"),
        F.when(found, geo_display_name(F.col("target_name"), F.col("country_name"), F.col("target_type"), gid))
         .when(gid == "others", F.lit("Others")).otherwise(F.lit("Unknown")).alias("display_name"),
        F.when(found, geo_display_name_ko(F.col("target_name"), F.col("country_name"), F.col("target_type"), gid))
         .when(gid == "others", F.lit("기타")).otherwise(F.lit("미확인")).alias("display_name_ko"),
        F.when(found, F.lit("metadata")).when(gid == "others", F.lit("rule_bucket"))
         .otherwise(F.lit("fallback_unknown")).alias("source"))


def mart_breakdown_recent(fact: DataFrame, dim_branch: DataFrame, geo_map: DataFrame,
                          today: _dt.date, days: int = 30) -> DataFrame:
    """Last ``days`` days of breakdown facts with geo display names and ratios."""
    f = fact.filter(F.col("stat_date") >= F.lit(today - _dt.timedelta(days=days)))
    b = bounded_broadcast(dim_branch.select(F.col("branch_id").alias("__bid"), "branch_name"))
    g = geo_map.select(F.col("geo_target_constant_id").alias("__gid"), F.col("display_name").alias("__dn"),
                       F.col("display_name_ko").alias("__dk"))
    is_geo = F.col("breakdown_key").isin(GEO_KEYS)
    f = f.join(b, f.branch_id == b.__bid, "left").join(g, is_geo & (F.col("breakdown_value") == g.__gid), "left")
    val = F.coalesce(F.col("breakdown_value"), F.lit("Unknown"))
    return f.select(
        F.col("stat_date").alias("report_date"), "branch_id", "branch_name", "channel_key", "campaign_id",
        "campaign_name", "breakdown_key", "breakdown_value",
        F.when(is_geo, F.coalesce("__dn", F.lit("Unknown"))).otherwise(val).alias("breakdown_value_name"),
        F.when(is_geo, F.coalesce("__dk", F.lit("미확인"))).otherwise(val).alias("breakdown_value_name_ko"),
        "impressions", "clicks", F.col("spend_micros").alias("spend_native_micros"),
        F.col("conversion_count").alias("conversions"),
        F.col("conversion_value_micros").alias("conversion_value_native_micros"),
        safe_ratio("clicks", "impressions").alias("ctr"),
        safe_ratio(micros_to_double("spend_micros"), "clicks").alias("cpc"))


def dq_unknown_geo(mart: DataFrame, w: Window, now) -> DataFrame:
    """One DQ result row: geo rows whose display name is Unknown in the window."""
    m = mart.filter(w.contains("report_date") & F.col("breakdown_key").isin(GEO_KEYS))
    a = m.agg(F.count(F.lit(1)).alias("total_rows"),
              F.count_if(F.col("breakdown_value_name") == "Unknown").alias("unknown_rows"))
    fail = F.col("unknown_rows") > 0
    return a.select(
        F.lit(now).cast("timestamp").alias("check_ts"), F.lit(w.end).alias("check_date"),
        F.lit("mart.v_campaign_breakdown_recent").alias("table_name"),
        F.lit("geo_breakdown_value_name_unknown").alias("check_name"),
        F.when(fail, F.lit("WARN")).otherwise(F.lit("INFO")).alias("severity"),
        F.when(fail, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"),
        F.col("unknown_rows").alias("failed_rows"), "total_rows",
        F.when(F.col("total_rows") > 0, F.col("unknown_rows") / F.col("total_rows")).otherwise(F.lit(0.0))
         .alias("unknown_ratio"),
        F.to_json(F.struct(F.lit(w.start.isoformat()).alias("start_date"), F.lit(w.end.isoformat()).alias("end_date"),
                           F.col("total_rows").alias("total_geo_rows"), F.col("unknown_rows"))).alias("details"))
