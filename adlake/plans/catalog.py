"""Registered queries: each operator run over the whole driver tables.

Every entry takes ``(spark, sf_dir)``, derives the operator inputs from the
driver tables through the adapter views, runs the operator over its whole
input (the window covers all dates) and returns a DataFrame. Timestamps and
tie-break helper columns are dropped and order-dependent double sums rounded
to 6 places so the result compares exactly with the DuckDB oracle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType, TimestampNTZType

from adlake.operators import core, marts, staging
from adlake.session import ALL_TIME, share_shuffles
from adlake.sources import fixtures as fx

NOW = "2024-02-01 00:00:00"
TODAY = _dt.date(2024, 2, 1)
TIE = ["tie1", "tie2", "tie3", "tie4", "tie5"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# Doubles that are sums of doubles depend on summation order; they are
# rounded to 6 places. Ratios are computed from exact integer sums and are
# left as they are (bit-identical in both engines).
ROUNDED = {"conversions", "conversion_count", "action_count", "purchase_count", "ad_conversions"}


def finish(df: DataFrame, drop=(), rounded=ROUNDED) -> DataFrame:
    """Drop helper columns and timestamps, round order-dependent double sums."""
    cols = []
    for f in df.schema.fields:
        if f.name in drop or f.name in TIE or isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            continue
        if isinstance(f.dataType, DoubleType) and f.name in rounded:
            cols.append(F.round(F.col(f.name), 6).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ builders
_CTX: dict = {}


def ctx(spark: SparkSession, sf_dir: str, kind=None):
    """The shared lazy plan builder for (session, data folder).

    Queries of one session reuse the DataFrame objects (plans) built by earlier
    queries instead of rebuilding identical plans; every query still executes
    its whole plan from the landed tables.
    """
    kind = kind or Ctx
    key = (id(spark), sf_dir, kind.__name__)
    c = _CTX.get(key)
    if c is None or c.spark is not spark:
        c = kind(spark, sf_dir)
        _CTX[key] = c
    return c


class Ctx:
    """Operator inputs for one (session, sf_dir); everything stays lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir
        share_shuffles(spark)
        self.w = ALL_TIME
        self._c: dict = {}

    def _memo(self, k, fn):
        if k not in self._c:
            self._c[k] = fn()
        return self._c[k]

    @property
    def raws(self):
        return self._memo("raws", lambda: fx.ads_perf_raws(self.spark, self.sf))

    @property
    def gov(self):
        return self._memo("gov", lambda: fx.governance(self.spark, self.sf))

    def accounts(self):
        """Segments of the account map, built once for all facts of a plan."""
        return self._memo("accounts", lambda: core.account_segments(self.gov["account_map"]))

    def dealt(self):
        """What staged ad rows are dealt by: by account if the lookup of accounts will be a shuffle join."""
        return staging.PERF_DEALT if self.accounts().small else staging.PERF_DEALT_MANY_ACCOUNTS

    def stg_perf(self):
        r = self.raws
        return self._memo("stg_perf", lambda: staging.stg_ads_performance(
            r["meta"], r["google"], r["tiktok"], r["naver"], self.w, NOW, TIE, self.dealt()))

    def stg_action(self):
        return self._memo("stg_action", lambda: staging.stg_ads_action(
            fx.meta_action_raw(self.spark, self.sf), fx.google_action_raw(self.spark, self.sf),
            self.gov["action_map"], self.w, NOW))

    def fact_mkt(self):
        g = self.gov
        return self._memo("fact_mkt", lambda: core.fact_marketing(
            self.stg_perf(), self.accounts(), g["rules"], g["dim_branch"], self.w, TIE))

    def dim_campaign(self):
        r = self.raws
        return self._memo("dim_campaign", lambda: core.dim_campaign_current(
            r["meta"], r["google"], r["tiktok"], r["naver"], self.w, NOW))

    def fact_campaign(self):
        return self._memo("fact_campaign", lambda: core.fact_campaign_daily(
            self.fact_mkt(), self.dim_campaign(), self.w))

    def fact_action(self):
        return self._memo("fact_action", lambda: core.fact_action(
            self.stg_action(), self.accounts(), self.w))

    def stg_web(self):
        return self._memo("stg_web", lambda: staging.stg_web_event(fx.ga4_raw(self.spark, self.sf), self.w, NOW))

    def fact_web(self):
        return self._memo("fact_web", lambda: core.fact_web_event(self.stg_web(), self.gov["property_map"], self.w))

    def stg_orders(self):
        return self._memo("stg_orders", lambda: staging.stg_order_line(
            fx.sales_raw(self.spark, self.sf), fx.fever_raw(self.spark, self.sf), self.w, NOW, TIE))

    def fact_orders(self):
        g = self.gov
        return self._memo("fact_orders", lambda: core.fact_order_line(
            self.stg_orders(), g["fever_map"], g["sales_map"], self.w))

    def stg_survey(self):
        return self._memo("stg_survey", lambda: staging.stg_survey_response(
            fx.survey_raw(self.spark, self.sf), self.w, NOW))

    def fact_survey(self):
        return self._memo("fact_survey", lambda: core.fact_survey(
            self.stg_survey(), self.gov["survey_map"], self.w))

    def dim_ad(self):
        r = self.raws
        return self._memo("dim_ad", lambda: core.dim_ad_current(
            r["meta"], r["google"], r["tiktok"], r["naver"], self.w, NOW))

    def mart_campaign(self):
        return self._memo("mart_campaign", lambda: marts.mart_campaign_daily(
            self.fact_campaign(), self.fact_action(), fx.external_raw(self.spark, self.sf),
            self.gov["dim_branch"]))


# ------------------------------------------------------------------ queries
@query("stg_ads_performance")
def q_stg_ads_performance(spark, sf):
    return finish(ctx(spark, sf).stg_perf())


@query("stg_ads_action")
def q_stg_ads_action(spark, sf):
    return finish(ctx(spark, sf).stg_action())


@query("branch_by_account")
def q_branch_by_account(spark, sf):
    c = ctx(spark, sf)
    f = c.stg_perf().select("channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_group_name",
                            "ad_id", "stat_date", "load_ts", *TIE)
    return finish(core.branch_by_account(f, c.accounts(), "stat_date"))


@query("branch_by_rule")
def q_branch_by_rule(spark, sf):
    c = ctx(spark, sf)
    f = c.stg_perf().select("channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_group_name",
                            "ad_id", "stat_date", "load_ts", *TIE)
    return finish(core.branch_by_rule(f, c.gov["rules"], "ad_group_name"))


@query("fact_marketing")
def q_fact_marketing(spark, sf):
    return finish(ctx(spark, sf).fact_mkt())


@query("dim_campaign_current")
def q_dim_campaign_current(spark, sf):
    return finish(ctx(spark, sf).dim_campaign())


@query("fact_campaign_daily")
def q_fact_campaign_daily(spark, sf):
    return finish(ctx(spark, sf).fact_campaign())


@query("fact_action")
def q_fact_action(spark, sf):
    return finish(ctx(spark, sf).fact_action(), drop=("source_table",))


@query("mart_campaign_daily")
def q_mart_campaign_daily(spark, sf):
    return finish(ctx(spark, sf).mart_campaign())


@query("mart_branch_channel_daily")
def q_mart_branch_channel_daily(spark, sf):
    return finish(marts.mart_branch_channel_daily(ctx(spark, sf).mart_campaign()))


@query("dim_account")
def q_dim_account(spark, sf):
    c = ctx(spark, sf)
    r = c.raws
    made = fx.with_load_times(fx.view(spark, sf, "fx_creative")).withColumnsRenamed({"account_id_norm": "account_id", "valid_date": "collected_date"})
    naver = made.filter(F.col("asset_type") == "VIDEO").withColumn("account_id", F.concat(F.lit("n-"), F.col("account_id")))
    return finish(core.dim_account(r["meta"], r["google"], r["tiktok"], r["naver"], c.w, NOW, meta_creative=made, naver_creative=naver))


@query("dim_ad_current")
def q_dim_ad_current(spark, sf):
    return finish(ctx(spark, sf).dim_ad())


@query("dim_channel")
def q_dim_channel(spark, sf):
    # The whole literal dimension, with a flag for channels that have landed ad performance.
    c = ctx(spark, sf)
    seen = c.stg_perf().select("channel_key").distinct().withColumn("has_performance", F.lit(True))
    return finish(core.dim_channel(spark, NOW).join(seen, "channel_key", "left")
                  .withColumn("has_performance", F.coalesce("has_performance", F.lit(False))))


@query("mart_ad_daily")
def q_mart_ad_daily(spark, sf):
    c = ctx(spark, sf)
    return finish(marts.mart_ad_daily(c.fact_mkt(), c.gov["dim_branch"], c.dim_campaign(), c.dim_ad(), TODAY))


@query("stg_web_event")
def q_stg_web_event(spark, sf):
    return finish(ctx(spark, sf).stg_web())


@query("fact_web_event")
def q_fact_web_event(spark, sf):
    return finish(ctx(spark, sf).fact_web())


@query("mart_web_daily")
def q_mart_web_daily(spark, sf):
    c = ctx(spark, sf)
    return finish(marts.mart_web_daily(c.fact_web(), c.gov["dim_branch"]))


@query("stg_order_line")
def q_stg_order_line(spark, sf):
    return finish(ctx(spark, sf).stg_orders())


@query("fact_order_line")
def q_fact_order_line(spark, sf):
    return finish(ctx(spark, sf).fact_orders())


@query("mart_business_daily")
def q_mart_business_daily(spark, sf):
    c = ctx(spark, sf)
    return finish(marts.mart_business_daily(c.fact_orders(), c.gov["dim_branch"]))


@query("stg_survey_response")
def q_stg_survey_response(spark, sf):
    return finish(ctx(spark, sf).stg_survey())


@query("fact_survey")
def q_fact_survey(spark, sf):
    return finish(ctx(spark, sf).fact_survey())


@query("mart_survey_daily")
def q_mart_survey_daily(spark, sf):
    c = ctx(spark, sf)
    return finish(marts.mart_survey_daily(c.fact_survey(), c.gov["dim_branch"]))


@query("mart_blended_daily")
def q_mart_blended_daily(spark, sf):
    c = ctx(spark, sf)
    b = c.gov["dim_branch"]
    return finish(marts.mart_blended_daily(
        c.mart_campaign(), marts.mart_business_daily(c.fact_orders(), b), marts.mart_web_daily(c.fact_web(), b),
        marts.mart_survey_daily(c.fact_survey(), b), b))


@query("dim_customer")
def q_dim_customer(spark, sf):
    c = ctx(spark, sf)
    d = core.dim_customer(c.stg_orders(), c.stg_survey(), c.w)
    return finish(d.withColumn("first_seen_date", F.to_date("first_seen_ts"))
                   .withColumn("latest_seen_date", F.to_date("latest_seen_ts")))


# ------------------------------------------------------------------ breakdowns
from adlake.operators import breakdown as BD  # noqa: E402

BD_TODAY = _dt.date(2024, 3, 1)


class BCtx(Ctx):
    def long(self):
        def mk():
            wide = fx.breakdown_wide(self.spark, self.sf)
            keep_m = ["account_id", "campaign_id", "campaign_name", "stat_date", "impressions", "clicks",
                      "spend_micros", "attribution_setting", "ingestion_ts", "source_extract_ts", "load_seq"]
            keep_g = ["customer_id", "campaign_id", "campaign_name", "stat_date", "impressions", "clicks",
                      "cost_micros", "conversions", "conversion_value_micros", "ingestion_ts", "source_extract_ts",
                      "load_seq"]
            return (BD.unpivot_breakdown(wide["meta"], BD.META_KEYS, keep_m),
                    BD.unpivot_breakdown(wide["google"], BD.GOOGLE_KEYS, keep_g))
        return self._memo("bd_long", mk)

    def stg_bd(self):
        m, g = self.long()
        return self._memo("stg_bd", lambda: BD.stg_breakdown(m, g, self.w, NOW))

    def fact_bd(self):
        return self._memo("fact_bd", lambda: BD.fact_breakdown(self.stg_bd(), self.accounts(), self.w))

    def geo_map(self):
        def mk():
            _, g = self.long()
            fx.register(self.spark, self.sf, ["fx_geo_meta"])
            return BD.geo_map_build(BD.geo_ids_distinct(g, self.w), self.spark.table("fx_geo_meta"))
        return self._memo("geo_map", mk)

    def mart_bd(self):
        return self._memo("mart_bd", lambda: BD.mart_breakdown_recent(
            self.fact_bd(), self.gov["dim_branch"], self.geo_map(), BD_TODAY))


@query("norm_meta_breakdown")
def q_norm_meta_breakdown(spark, sf):
    m, _ = ctx(spark, sf, BCtx).long()
    return finish(m.select("account_id", "campaign_id", "stat_date", "breakdown_key", "breakdown_value",
                           "impressions", "load_seq"))


@query("norm_google_breakdown")
def q_norm_google_breakdown(spark, sf):
    _, g = ctx(spark, sf, BCtx).long()
    return finish(g.select("customer_id", "campaign_id", "stat_date", "breakdown_key", "breakdown_value",
                           "impressions", "load_seq"))


@query("stg_breakdown")
def q_stg_breakdown(spark, sf):
    return finish(ctx(spark, sf, BCtx).stg_bd())


@query("fact_breakdown")
def q_fact_breakdown(spark, sf):
    return finish(ctx(spark, sf, BCtx).fact_bd())


@query("geo_ids_distinct")
def q_geo_ids_distinct(spark, sf):
    c = ctx(spark, sf, BCtx)
    return finish(BD.geo_ids_distinct(c.long()[1], c.w))


@query("geo_map_build")
def q_geo_map_build(spark, sf):
    return finish(ctx(spark, sf, BCtx).geo_map())


@query("mart_breakdown_recent")
def q_mart_breakdown_recent(spark, sf):
    return finish(ctx(spark, sf, BCtx).mart_bd())


@query("dq_unknown_geo")
def q_dq_unknown_geo(spark, sf):
    from adlake.session import Window as Win
    c = ctx(spark, sf, BCtx)
    return finish(BD.dq_unknown_geo(c.mart_bd(), Win.of("2024-02-01", "2024-02-29"), NOW))


# ------------------------------------------------------------------ governance, usage
from adlake.operators import governance as GV, usage as US  # noqa: E402

def _usage_window():
    from adlake.session import Window as Win
    return Win.of("2024-01-05", "2024-01-20")


@query("source_readiness")
def q_source_readiness(spark, sf):
    g = fx.governance(spark, sf)
    return finish(GV.source_readiness(fx.view(spark, sf, "fx_source_config"), g["rules"]))


@query("source_activation")
def q_source_activation(spark, sf):
    g = fx.governance(spark, sf)
    return finish(GV.source_activation(fx.view(spark, sf, "fx_source_config"), g["rules"], g["account_map"]))


@query("unmatched_adgroups")
def q_unmatched_adgroups(spark, sf):
    c = ctx(spark, sf)
    return finish(GV.unmatched_adgroups(c.raws["naver"], c.gov["rules"], _dt.date(2001, 6, 1), tiebreak=TIE))


@query("usage_by_user")
def q_usage_by_user(spark, sf):
    return finish(US.usage_by_user(fx.view(spark, sf, "fx_job_log"), _usage_window()))


@query("usage_by_workload")
def q_usage_by_workload(spark, sf):
    return finish(US.usage_by_workload(fx.view(spark, sf, "fx_job_log"), _usage_window()))


@query("usage_free_tier")
def q_usage_free_tier(spark, sf):
    return finish(US.usage_free_tier(fx.view(spark, sf, "fx_job_log"), _usage_window()))


@query("usage_month_state")
def q_usage_month_state(spark, sf):
    return finish(US.usage_month_state(fx.view(spark, sf, "fx_query_log"), _dt.datetime(2024, 1, 15, 12),
                                       budget=100 * 1024 ** 3))


@query("usage_estimate")
def q_usage_estimate(spark, sf):
    q = fx.view(spark, sf, "fx_query_log").select("id", "date_from", "date_to")
    return finish(US.usage_estimate(q))


# ------------------------------------------------------------------ assets
from adlake.operators import asset as AS  # noqa: E402


def _asset_fact(c: Ctx):
    raw = fx.with_load_times(fx.view(c.spark, c.sf, "fx_asset_raw"))
    return AS.fact_asset(AS.stg_asset(raw, c.w, NOW, TIE), c.accounts(), c.w)


@query("stg_asset")
def q_stg_asset(spark, sf):
    c = ctx(spark, sf)
    return finish(AS.stg_asset(fx.with_load_times(fx.view(spark, sf, "fx_asset_raw")), c.w, NOW, TIE))


@query("fact_asset")
def q_fact_asset(spark, sf):
    return finish(_asset_fact(ctx(spark, sf)))


@query("mart_asset_daily")
def q_mart_asset_daily(spark, sf):
    return finish(AS.mart_asset_daily(_asset_fact(ctx(spark, sf))))


@query("enrich_branch")
def q_enrich_branch(spark, sf):
    """Facts built with an older map and rule list, then re-enriched with the current ones."""
    c = ctx(spark, sf)
    g = c.gov
    old_map = g["account_map"].filter(F.col("updated_seq") == 1)
    old_rules = g["rules"].filter(F.col("rule_id").isin("R1", "R2", "R3"))
    old = core.fact_marketing(c.stg_perf(), old_map, old_rules, g["dim_branch"], c.w, TIE)
    return finish(core.enrich_branch(old, c.accounts(), g["rules"], c.w, naver_rows=c.stg_perf()))


@query("geo_display_name")
def q_geo_display_name(spark, sf):
    """Display names (English and Korean) for the geo ids seen in the breakdowns."""
    c = ctx(spark, sf, BCtx)
    ids = BD.geo_ids_distinct(c.long()[1], c.w)
    fx.register(spark, sf, ["fx_geo_meta"])
    md = spark.table("fx_geo_meta")
    j = ids.join(md, "geo_target_constant_id", "inner")
    args = (F.col("target_name"), F.col("country_name"), F.col("target_type"), F.col("geo_target_constant_id"))
    return finish(j.select("geo_target_constant_id", BD.geo_display_name(*args).alias("display_name"),
                           BD.geo_display_name_ko(*args).alias("display_name_ko")))


@query("geo_map_upsert")
def q_geo_map_upsert(spark, sf):
    """A map built earlier (metadata with older names, odd ids only) upserted with
    the current build: matched ids take the new values, others are kept."""
    from adlake.operators.upsert import upsert
    c = ctx(spark, sf, BCtx)
    _, g = c.long()
    fx.register(spark, sf, ["fx_geo_meta"])
    md = spark.table("fx_geo_meta")
    old_md = md.withColumn("target_name", F.concat(F.col("target_name"), F.lit(" (old)")))
    ids = BD.geo_ids_distinct(g, c.w)
    old = BD.geo_map_build(ids.filter(F.length("geo_target_constant_id") % 2 == 1), old_md)
    return finish(upsert(old, c.geo_map(), ["geo_target_constant_id"]))
