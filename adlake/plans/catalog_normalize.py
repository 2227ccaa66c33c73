"""Registered normaliser queries over payloads derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.plans.catalog import NOW, finish, query
from adlake.session import Window
from adlake.sources import fixtures as fx
from adlake.sources import normalize as N

RUN = "run-0001"
W = Window.of("1995-01-01", "2001-12-31")


@query("norm_meta_perf")
def q_norm_meta_perf(spark, sf):
    out = N.norm_meta_perf(fx.meta_insight_payloads(spark, sf), RUN, NOW, NOW)
    return finish(out, drop=("ingestion_id", "source_payload", "spend", "actions_json", "action_values_json",
                             "conversions_json", "conversion_values_json"))


@query("norm_google_perf")
def q_norm_google_perf(spark, sf):
    return finish(N.norm_google_perf(fx.google_perf_payloads(spark, sf), RUN, NOW, NOW),
                  drop=("ingestion_id", "source_payload"))


@query("norm_google_action")
def q_norm_google_action(spark, sf):
    return finish(N.norm_google_action(fx.google_action_payloads(spark, sf), RUN, NOW, NOW, W),
                  drop=("ingestion_id", "source_payload"))


@query("norm_google_conv_dim")
def q_norm_google_conv_dim(spark, sf):
    return finish(N.norm_google_conv_dim(fx.google_conv_dim_payloads(spark, sf), RUN, NOW, NOW, W),
                  drop=("ingestion_id", "source_payload"))


@query("norm_tiktok_perf")
def q_norm_tiktok_perf(spark, sf):
    return finish(N.norm_tiktok_perf(fx.tiktok_payloads(spark, sf), RUN, NOW, NOW), drop=("ingestion_id", "source_payload"))


@query("norm_naver_perf")
def q_norm_naver_perf(spark, sf):
    p = fx.naver_payloads(spark, sf)
    return finish(N.norm_naver_perf(p["stats"], p["campaigns"], p["adgroups"], W, RUN, NOW, NOW),
                  drop=("ingestion_id", "source_payload"))


@query("agg_google_breakdown")
def q_agg_google_breakdown(spark, sf):
    from adlake.plans.catalog import BCtx, ctx
    _, g = ctx(spark, sf, BCtx).long()
    rows = g.select("customer_id", "campaign_id", "campaign_name", "stat_date", "breakdown_key", "breakdown_value",
                    "impressions", "clicks", "cost_micros", "conversions",
                    (F.col("conversion_value_micros") / F.lit(1e6)).alias("conversions_value"),
                    "source_extract_ts", "ingestion_ts", F.col("load_seq").alias("ingest_seq"))
    return finish(N.agg_google_breakdown(rows))


# ------------------------------------------------------------------ creatives
from adlake.operators import creative as CR  # noqa: E402


def _meta_creatives(spark, sf):
    p = fx.creative_payloads(spark, sf).withColumn("ingest_seq", F.col("doc_id"))
    return CR.norm_meta_creative(p, None, RUN, NOW, NOW)


@query("extract_creative_assets")
def q_extract_creative_assets(spark, sf):
    p = fx.creative_payloads(spark, sf)
    return finish(CR.extract_creative_assets(p, "creative_json", ["doc_id", "ad_id"]))


@query("extract_creative_texts")
def q_extract_creative_texts(spark, sf):
    p = fx.creative_payloads(spark, sf)
    return finish(CR.extract_creative_texts(p, "creative_json", ["doc_id", "ad_id"]))


@query("norm_meta_creative")
def q_norm_meta_creative(spark, sf):
    p = fx.creative_payloads(spark, sf).withColumn("ingest_seq", F.col("doc_id"))
    return finish(CR.norm_meta_creative(p, None, RUN, NOW, NOW), drop=("ingestion_id", "assets_json", "source_payload"))


def _channel_creatives(spark, sf):
    g = N.norm_google_creative(fx.google_creative_payloads(spark, sf), W, RUN, NOW, NOW)
    t = N.norm_tiktok_creative(fx.tiktok_ad_payloads(spark, sf), W, RUN, NOW, NOW)
    n = N.norm_naver_creative(fx.naver_ad_payloads(spark, sf), fx.naver_adgroup_payloads(spark, sf), W, RUN, NOW, NOW)
    return g, t, n


@query("stg_creative_snapshot")
def q_stg_creative_snapshot(spark, sf):
    from adlake.session import ALL_TIME
    g, t, n = _channel_creatives(spark, sf)
    out = CR.stg_creative_snapshot(_meta_creatives(spark, sf), ALL_TIME, google=g, tiktok=t, naver=n)
    return finish(out.withColumn("valid_from_date", F.to_date("valid_from_ts")))


@query("stg_creative_asset")
def q_stg_creative_asset(spark, sf):
    from adlake.session import ALL_TIME
    g, t, _ = _channel_creatives(spark, sf)
    out = CR.stg_creative_asset(_meta_creatives(spark, sf), ALL_TIME, google=g, tiktok=t)
    return finish(out.withColumn("valid_from_date", F.to_date("valid_from_ts")))


# ------------------------------------------------------------------ streaming ingest
@query("stream_ingest_meta_perf")
def q_stream_ingest_meta_perf(spark, sf):
    """Meta insight payloads landed as JSON files in three drops, ingested by a
    file stream (two files per micro-batch) with a latest-wins merge per batch."""
    import uuid
    from adlake.session import checkpoint_dir
    from adlake.streaming.ingest import ingest_landed, read_table
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-q-{uuid.uuid4().hex}"
    p = fx.meta_insight_payloads(spark, sf).withColumn("__h", F.abs(F.hash("payload")) % 3)
    for drop in range(3):
        p.filter(F.col("__h") == drop).select("payload").write.mode("overwrite").json(f"{base}/landing/drop={drop}")
    ingest_landed(spark, f"{base}/landing/*", f"{base}/table",
                  lambda df: N.norm_meta_perf(df, RUN, NOW, NOW),
                  keys=["account_id", "campaign_id", "ad_group_id", "ad_group_name", "ad_id", "stat_date"],
                  order=["ingestion_ts", "spend_micros", "clicks", "impressions", "campaign_name", "ad_name"],
                  blank_keys=["ad_group_id", "ad_group_name"], name=uuid.uuid4().hex, max_files_per_trigger=12,
                  partition_col="stat_month")
    return finish(read_table(spark, f"{base}/table").drop("stat_month"),
                  drop=("ingestion_id", "source_payload", "spend", "actions_json", "action_values_json",
                        "conversions_json", "conversion_values_json"))


# ------------------------------------------------------------------ creative / asset normalisers
@query("norm_google_creative")
def q_norm_google_creative(spark, sf):
    out = N.norm_google_creative(fx.google_creative_payloads(spark, sf), W, RUN, NOW, NOW)
    return finish(out.withColumn("final_urls", F.array_join("final_urls", "|"))
                     .withColumn("image_urls", F.array_join("image_urls", "|"))
                     .withColumn("youtube_video_ids", F.array_join("youtube_video_ids", "|")), drop=("ingestion_id", "source_payload"))


@query("norm_google_asset")
def q_norm_google_asset(spark, sf):
    p = fx.google_asset_payloads(spark, sf)
    return finish(N.norm_google_asset(p["ad"], p["pmax"], W, RUN, NOW, NOW), drop=("ingestion_id", "source_payload"))


@query("norm_tiktok_creative")
def q_norm_tiktok_creative(spark, sf):
    return finish(N.norm_tiktok_creative(fx.tiktok_ad_payloads(spark, sf), W, RUN, NOW, NOW), drop=("ingestion_id", "source_payload"))


@query("norm_naver_creative")
def q_norm_naver_creative(spark, sf):
    return finish(N.norm_naver_creative(fx.naver_ad_payloads(spark, sf), fx.naver_adgroup_payloads(spark, sf), W, RUN, NOW, NOW),
                  drop=("ingestion_id", "source_payload"))


@query("norm_google_asset_ad")
def q_norm_google_asset_ad(spark, sf):
    p = fx.google_asset_payloads(spark, sf)
    out = N.norm_google_asset(p["ad"], None, W, RUN, NOW, NOW)
    return finish(out, drop=("ingestion_id", "source_payload"))


@query("norm_google_asset_pmax")
def q_norm_google_asset_pmax(spark, sf):
    p = fx.google_asset_payloads(spark, sf)
    out = N.norm_google_asset(None, p["pmax"], W, RUN, NOW, NOW)
    return finish(out, drop=("ingestion_id", "source_payload"))


# ------------------------------------------------------------------ payloads through staging
#: Payloads of one run share their load time; the staged columns themselves break ties.
STAGED_TIES = ["spend_micros", "clicks", "impressions", "conversion_count", "conversion_value_micros", "ad_group_name"]
ASSET_TIES = ["performance_label", "impressions", "clicks", "spend_micros", "conversion_count", "conversion_value_micros",
              "campaign_channel_type", "campaign_id", "ad_group_id", "ad_id", "asset_group_id"]


@query("stg_ads_performance_from_payloads")
def q_stg_ads_performance_from_payloads(spark, sf):
    """Vendor payloads of all four channels, normalised and staged."""
    from adlake.operators.staging import stg_ads_performance
    from adlake.session import ALL_TIME
    n = fx.naver_payloads(spark, sf)
    return finish(stg_ads_performance(
        N.norm_meta_perf(fx.meta_insight_payloads(spark, sf), RUN, NOW, NOW),
        N.norm_google_perf(fx.google_perf_payloads(spark, sf), RUN, NOW, NOW),
        N.norm_tiktok_perf(fx.tiktok_payloads(spark, sf), RUN, NOW, NOW),
        N.norm_naver_perf(n["stats"], n["campaigns"], n["adgroups"], W, RUN, NOW, NOW), ALL_TIME, NOW, STAGED_TIES))


@query("stg_breakdown_from_payloads")
def q_stg_breakdown_from_payloads(spark, sf):
    """Breakdown payloads of both channels, unpivoted, collapsed and staged."""
    from adlake.operators.breakdown import stg_breakdown
    from adlake.session import ALL_TIME
    p = fx.breakdown_payloads(spark, sf)
    google = N.google_breakdown_raw(N.norm_google_breakdown(p["google"], W, RUN, NOW, NOW))
    return finish(stg_breakdown(N.norm_meta_breakdown(p["meta"], RUN, NOW, NOW), google, ALL_TIME, NOW))


@query("stg_asset_from_payloads")
def q_stg_asset_from_payloads(spark, sf):
    """Google asset payloads, normalised and staged."""
    from adlake.operators.asset import stg_asset
    from adlake.session import ALL_TIME
    p = fx.google_asset_payloads(spark, sf)
    return finish(stg_asset(N.norm_google_asset(p["ad"], p["pmax"], W, RUN, NOW, NOW), ALL_TIME, NOW, ASSET_TIES))


def _history(df):
    out = df.withColumns({c.replace("_ts", "_epoch"): F.unix_timestamp(c) for c in ("valid_from_ts", "valid_to_ts")})
    return finish(out)


@query("scd2_creative_from_staging")
def q_scd2_creative_from_staging(spark, sf):
    """Creative history of the staged snapshots of all four channels."""
    from adlake.operators.scd2 import KEYS, scd2_creative
    from adlake.session import ALL_TIME
    g, t, n = _channel_creatives(spark, sf)
    return _history(scd2_creative(CR.stg_creative_snapshot(
        _meta_creatives(spark, sf), ALL_TIME, google=g, tiktok=t, naver=n, dealt=KEYS["scd2_creative"])))


@query("scd2_creative_asset_from_staging")
def q_scd2_creative_asset_from_staging(spark, sf):
    """Asset history of the staged creative assets."""
    from adlake.operators.scd2 import scd2_creative_asset
    from adlake.session import ALL_TIME
    g, t, _ = _channel_creatives(spark, sf)
    return _history(scd2_creative_asset(CR.stg_creative_asset(_meta_creatives(spark, sf), ALL_TIME, google=g, tiktok=t)))
