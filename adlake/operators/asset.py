"""Google asset performance: staging keep rule, branch fact and daily mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import load_ts, micros_to_double, safe_ratio
from adlake.operators.core import branch_by_account
from adlake.operators.dedup import latest_by
from adlake.session import Window

# Field types kept per campaign kind.
MEDIA_FIELDS = ["MARKETING_IMAGE", "SQUARE_MARKETING_IMAGE", "PORTRAIT_MARKETING_IMAGE", "YOUTUBE_VIDEO"]
SEARCH_FIELDS = ["HEADLINE", "DESCRIPTION"]

ASSET_KEYS = ["channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_id", "asset_group_id",
              "asset_id", "field_type", "stat_date", "source_view"]
ASSET_COLUMNS = [*ASSET_KEYS, "campaign_channel_type", "performance_label", "impressions", "clicks", "spend_micros",
                 "conversion_count", "conversion_value_micros", "is_pmax", "load_ts"]
ASSET_BLANK = ["campaign_id", "ad_group_id", "ad_id", "asset_group_id", "source_view"]


def asset_keep():
    """PMax: media fields; Search: headline/description; other known channel types: media."""
    ft = F.upper(F.col("field_type"))
    ct = F.col("campaign_channel_type")
    pmax = F.col("is_pmax") == F.lit(True)
    not_pmax = F.col("is_pmax") == F.lit(False)
    return ((pmax & ft.isin(MEDIA_FIELDS))
            | (not_pmax & (ct == "SEARCH") & ft.isin(SEARCH_FIELDS))
            | (not_pmax & ct.isNotNull() & (ct != "SEARCH") & ft.isin(MEDIA_FIELDS)))


def stg_asset(google_asset: DataFrame, w: Window, now=None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Asset rows with a channel type (column, else from the JSON payload), kept by
    rule and deduplicated on ten keys (five compared as blank keys)."""
    ct = F.upper(F.coalesce(F.col("campaign_channel_type"),
                            F.get_json_object("source_payload", "$.campaign.advertising_channel_type")))
    s = (google_asset.filter(w.contains("stat_date") & F.col("asset_id").isNotNull() & (F.col("asset_id") != ""))
         .select(F.lit("GOOGLE_ADS").alias("channel_key"), F.col("customer_id").alias("account_id_norm"),
                 "campaign_id", ct.alias("campaign_channel_type"), "ad_group_id", "ad_id", "asset_group_id",
                 "asset_id", "field_type", "performance_label", "stat_date", "impressions", "clicks",
                 F.col("cost_micros").alias("spend_micros"), F.col("conversions").alias("conversion_count"),
                 F.col("conversions_value_micros").alias("conversion_value_micros"), "is_pmax", "source_view",
                 load_ts(now).alias("load_ts"), *[c for c in tiebreak if c not in ASSET_COLUMNS])
         .filter(asset_keep()))
    return latest_by(s, ASSET_KEYS, ["load_ts"], tiebreak, blank_keys=ASSET_BLANK)


def fact_asset(stg: DataFrame, account_map: DataFrame, w: Window) -> DataFrame:
    """Asset fact with the account's branch (overlaps resolve to the newest mapping)."""
    return branch_by_account(stg.filter(w.contains("stat_date")), account_map, "stat_date")


def mart_asset_daily(fact: DataFrame) -> DataFrame:
    """Asset fact with ctr = clicks / impressions and cpa = spend / conversions."""
    return fact.select(
        F.col("stat_date").alias("report_date"), "branch_id", "channel_key", "account_id_norm", "campaign_id",
        "campaign_channel_type", "ad_group_id", "ad_id", "asset_group_id", "asset_id", "field_type",
        "performance_label", "is_pmax", "source_view", "impressions", "clicks", "spend_micros",
        "conversion_count", "conversion_value_micros",
        safe_ratio("clicks", "impressions").alias("ctr"),
        safe_ratio(micros_to_double("spend_micros"), "conversion_count").alias("cpa"))
