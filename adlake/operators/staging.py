"""Staging loads: landed raw tables -> typed, unified, deduplicated stg rows.

Each function returns the rows to write for a date window; the caller passes
them to :func:`adlake.operators.upsert.upsert` with the table's keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import (decimal_to_micros, email_hash, latest_value, load_ts,
                                      money_text_to_micros, phone_hash, strip_account_prefix)
from adlake.operators.dedup import latest_by
from adlake.operators.joins import bounded_broadcast
from adlake.session import Window

PERF_COLUMNS = ["channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_group_name",
                "ad_id", "currency_code", "stat_date", "impressions", "clicks", "spend_micros",
                "conversion_count", "conversion_value_micros", "source_table", "load_ts"]
PERF_KEYS = ["channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_group_name",
             "ad_id", "currency_code", "stat_date"]

#: What staged rows are dealt by: the campaign and day, or the account, where facts look up so many accounts that they have to be dealt by them anyway.
PERF_DEALT, PERF_DEALT_MANY_ACCOUNTS = ("account_id_norm", "campaign_id", "stat_date"), ("account_id_norm",)


def _perf_branch(df: DataFrame, channel: str, account: F.Column, spend_micros: F.Column,
                 conv_count: F.Column, conv_value: F.Column, table: str, w: Window, now,
                 extra: Sequence[str], has_group_name: bool = True) -> DataFrame:
    return df.filter(w.contains("stat_date")).select(
        F.lit(channel).alias("channel_key"), account.alias("account_id_norm"),
        "campaign_id", "ad_group_id",
        (F.col("ad_group_name") if has_group_name else F.lit(None).cast("string")).alias("ad_group_name"),
        "ad_id", F.lit(None).cast("string").alias("currency_code"), "stat_date",
        F.col("impressions").cast("bigint").alias("impressions"),
        F.col("clicks").cast("bigint").alias("clicks"),
        spend_micros.alias("spend_micros"), conv_count.cast("double").alias("conversion_count"),
        conv_value.alias("conversion_value_micros"), F.lit(table).alias("source_table"),
        load_ts(now).alias("load_ts"), *[c for c in extra if c not in PERF_COLUMNS])


def stg_ads_performance(meta: DataFrame, google: DataFrame, tiktok: DataFrame, naver: DataFrame,
                        w: Window, now=None, tiebreak: Sequence[str] = (), dealt: Sequence[str] = PERF_DEALT) -> DataFrame:
    """Four channels to one schema, latest row per staging key.

    Meta strips ``act_`` and keeps spend as numeric text; Google spend is
    ``cost_micros``; Naver spend is text (blank -> NULL); Meta and Naver have
    no conversions. Money is carried as integer micros. ``tiebreak`` names staged
    columns or further columns of all four raw tables. Rows are dealt by ``dealt``, staging
    keys that following steps share, so that these find their rows dealt already.
    """
    extra = list(tiebreak)
    null_d = F.lit(None).cast("double")
    null_m = F.lit(None).cast("bigint")
    u = (_perf_branch(meta, "META", strip_account_prefix("account_id"), money_text_to_micros("spend"),
                      null_d, null_m, "raw_ads.meta_ads_performance_raw", w, now, extra)
         .unionByName(_perf_branch(google, "GOOGLE_ADS", F.col("customer_id").cast("string"),
                                   F.col("cost_micros").cast("bigint"), F.col("conversions"),
                                   decimal_to_micros("conversions_value"),
                                   "raw_ads.google_ads_performance_raw", w, now, extra))
         .unionByName(_perf_branch(tiktok, "TIKTOK_ADS", F.col("advertiser_id").cast("string"),
                                   decimal_to_micros("spend"), F.col("conversions"),
                                   decimal_to_micros("conversions_value"),
                                   "raw_ads.tiktok_ads_performance_raw", w, now, extra,
                                   has_group_name=False))
         .unionByName(_perf_branch(naver, "NAVER_ADS", F.col("account_id").cast("string"),
                                   money_text_to_micros("spend"), null_d, null_m,
                                   "raw_ads.naver_ads_performance_raw", w, now, extra)))
    # dealt once: the facts' coarser keys and the campaign rollup need no further shuffle
    return latest_by(u.repartition(*dealt), PERF_KEYS, ["load_ts"], tiebreak, blank_keys=["ad_group_name"])


ACTION_JSON = "array<struct<action_type:string,value:string>>"


def stg_ads_action(meta: DataFrame, google: DataFrame, action_map: DataFrame, w: Window,
                   now=None) -> DataFrame:
    """Unified long action table (Meta ad level + Google campaign level).

    Meta counts and values come from two JSON arrays joined on the six ad keys
    and the raw action type. The reference's row-level LEFT JOIN multiplies
    counts by the number of matching value rows and values by the number of
    count rows; the same sums are computed here from per-key aggregates joined
    one-to-one, so no key group is ever expanded into pairs. Unmapped or
    disabled action types drop (inner join to the enabled map).
    """
    keys = ["account_id_norm", "campaign_id", "ad_group_id", "ad_id", "stat_date", "action_type_raw"]
    m = meta.filter(w.contains("stat_date")).withColumn(
        "account_id_norm", strip_account_prefix("account_id")).withColumn("load_ts", load_ts(now))
    acts = (m.select(*keys[:-1], "load_ts",
                     F.explode(F.from_json("actions_json", ACTION_JSON)).alias("a"))
             .select(*keys[:-1], "load_ts", F.col("a.action_type").alias("action_type_raw"),
                     F.col("a.value").try_cast("double").alias("action_count"))
             .filter(F.col("action_type_raw").isNotNull() & (F.col("action_type_raw") != "")
                     & (F.col("action_count") > 0)))
    acts_g = acts.groupBy(*keys).agg(F.sum("action_count").alias("cnt_sum"),
                                     F.count(F.lit(1)).alias("cnt_rows"),
                                     F.max("load_ts").alias("load_ts"))
    vals = (m.select(*keys[:-1], F.explode(F.from_json("action_values_json", ACTION_JSON)).alias("v"))
             .select(*keys[:-1], F.col("v.action_type").alias("action_type_raw"),
                     money_text_to_micros("v.value").alias("action_value_micros")))
    vals_g = vals.groupBy(*keys).agg(F.sum(F.coalesce("action_value_micros", F.lit(0))).alias("val_sum"),
                                     F.count(F.lit(1)).alias("val_rows"))
    # Plain equality on every key (NULL keys never match), as the reference.
    j = acts_g.join(vals_g, on=[acts_g[k] == vals_g[k] for k in keys], how="left").select(
        F.lit("META").alias("channel_key"), *[acts_g[k] for k in keys],
        (F.col("cnt_sum") * F.coalesce("val_rows", F.lit(1))).alias("action_count"),
        (F.coalesce("val_sum", F.lit(0)) * F.col("cnt_rows")).alias("action_value_micros"),
        F.lit("raw_ads.meta_ads_performance_raw").alias("source_table"), acts_g["load_ts"])
    g = (google.filter(w.contains("stat_date"))
               .filter(F.col("action_type_raw").isNotNull() & (F.col("action_type_raw") != "")
                       & (F.col("action_count").try_cast("double") > 0))
               .select(F.lit("GOOGLE_ADS").alias("channel_key"),
                       F.col("customer_id").cast("string").alias("account_id_norm"),
                       F.col("campaign_id").cast("string").alias("campaign_id"),
                       F.lit(None).cast("string").alias("ad_group_id"),
                       F.lit(None).cast("string").alias("ad_id"), "stat_date",
                       F.col("action_type_raw").cast("string").alias("action_type_raw"),
                       F.col("action_count").try_cast("double").alias("action_count"),
                       F.coalesce(money_text_to_micros(F.col("action_value").cast("string")),
                                  F.lit(None).cast("bigint")).alias("action_value_micros"),
                       F.lit("raw_ads.google_ads_action_raw").alias("source_table"),
                       load_ts(now).alias("load_ts")))
    u = j.unionByName(g)
    amap = bounded_broadcast(action_map.filter(F.col("is_enabled") == F.lit(True)).select(
        F.col("channel_key").alias("__mc"), F.col("action_type_raw").alias("__mr"),
        F.col("action_type_std").alias("__ms")))
    mapped = (u.join(amap, (u.channel_key == amap.__mc) & (u.action_type_raw == amap.__mr), "inner")
               .withColumn("action_type", F.coalesce(F.when(F.col("__ms") != "", F.col("__ms")),
                                                     F.col("action_type_raw"))))
    return (mapped.groupBy("channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_id",
                           "stat_date", "action_type")
                  .agg(F.sum("action_count").alias("action_count"),
                       F.sum(F.coalesce("action_value_micros", F.lit(0))).alias("action_value_micros"),
                       latest_value("source_table", "load_ts").alias("source_table"),
                       F.max("load_ts").alias("load_ts")))


WEB_KEYS = ["event_date", "property_id", "source", "medium", "campaign", "event_name"]


def stg_web_event(ga4: DataFrame, w: Window, now=None) -> DataFrame:
    """Daily web rollup: exact distinct users and sessions, event rows.

    Distincts are taken in two levels. Events are first reduced to a row per key, user and
    session (combined in the map tasks), then to a row per key and user and one per key and
    session, and these are counted by key. No row is copied per distinct count, and a key that
    holds much of the events is spread over the tasks by its users and sessions until only
    counts are left.
    """
    visits = (ga4.filter(w.contains("event_date")).groupBy(*WEB_KEYS, "user_pseudo_id", "session_id")
              .agg(F.count(F.lit(1)).alias("n"), F.max(load_ts(now)).alias("load_ts")))
    by_user = visits.groupBy(*WEB_KEYS, "user_pseudo_id").agg(F.sum("n").alias("n"), F.max("load_ts").alias("load_ts"))
    by_session = visits.groupBy(*WEB_KEYS, "session_id").agg(F.max("load_ts").alias("load_ts"))
    some = lambda c: F.col(c).isNotNull().cast("bigint")  # noqa: E731 - a null is no user or session
    rows = by_user.select(*WEB_KEYS, some("user_pseudo_id").alias("users"), F.lit(0).cast("bigint").alias("sessions"), "n", "load_ts").unionByName(
        by_session.select(*WEB_KEYS, F.lit(0).cast("bigint").alias("users"), some("session_id").alias("sessions"), F.lit(0).cast("bigint").alias("n"), "load_ts"))
    return rows.groupBy(*WEB_KEYS).agg(
        F.sum("users").alias("users"), F.sum("sessions").alias("sessions"), F.sum("n").alias("event_count"),
        F.lit(None).cast("bigint").alias("event_value_micros"), F.max("load_ts").alias("load_ts"))


ORDER_COLUMNS = ["order_source", "source_system", "order_id", "order_line_id", "order_ts", "order_date",
                 "customer_email_hash", "customer_phone_hash", "product_id", "venue_name", "quantity",
                 "gross_amount_micros", "discount_amount_micros", "net_amount_micros", "currency",
                 "payment_status", "load_ts"]


def stg_order_line(sales: DataFrame, fever: DataFrame, w: Window, now=None,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """SALES and FEVER order lines, PII hashed, latest row per line.

    The lines of an order are dealt together, so that counting orders needs no further shuffle.
    """
    extra = list(tiebreak)
    s = sales.filter(w.contains("order_date")).select(
        F.lit("SALES").alias("order_source"), "source_system", "order_id", "order_line_id",
        "order_ts", "order_date", email_hash("customer_email").alias("customer_email_hash"),
        phone_hash("customer_phone").alias("customer_phone_hash"), "product_id",
        F.lit(None).cast("string").alias("venue_name"), "quantity", "gross_amount_micros",
        "discount_amount_micros", "net_amount_micros", "currency", "payment_status",
        load_ts(now).alias("load_ts"), *extra)
    f = fever.filter(w.contains("order_date")).select(
        F.lit("FEVER").alias("order_source"), F.lit(None).cast("string").alias("source_system"),
        F.col("fever_order_id").alias("order_id"), F.col("ticket_id").alias("order_line_id"),
        "order_ts", "order_date", email_hash("customer_email").alias("customer_email_hash"),
        F.lit(None).cast("string").alias("customer_phone_hash"),
        F.col("event_id").alias("product_id"), "venue_name", "quantity", "gross_amount_micros",
        "discount_amount_micros", "net_amount_micros", "currency", "payment_status",
        load_ts(now).alias("load_ts"), *extra)
    return latest_by(s.unionByName(f).repartition("order_id"), ["order_source", "order_id", "order_line_id"], ["load_ts"], tiebreak)


def stg_survey_response(survey: DataFrame, w: Window, now=None,
                        tiebreak: Sequence[str] = ()) -> DataFrame:
    """Survey answers with PII hashes, latest row per (source, response, question).

    The reference does not deduplicate here, so a repeated answer breaks its
    merge; keeping the latest row makes the merge well defined.
    """
    s = survey.filter(w.contains("response_date")).select(
        "response_date", "response_ts", "survey_source", "response_id",
        email_hash("customer_email").alias("customer_email_hash"),
        phone_hash("customer_phone").alias("customer_phone_hash"),
        "survey_id", "question_id", "answer_type", "answer_text",
        F.col("answer_score").cast("double").alias("answer_score"),
        load_ts(now).alias("load_ts"), *tiebreak)
    return latest_by(s, ["survey_source", "response_id", "question_id"], ["load_ts"], tiebreak)
