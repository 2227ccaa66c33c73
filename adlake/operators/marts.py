"""Mart views: reporting rollups with safe ratio metrics.

Money stays in integer micros (``*_micros``); ratios are doubles computed as
``SAFE_DIVIDE(x, NULLIF(y, 0))``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import micros_to_double, safe_ratio, sum0
from adlake.operators.joins import bounded_broadcast


def _with_branch(df: DataFrame, dim_branch: DataFrame, cols=("branch_name",)) -> DataFrame:
    b = bounded_broadcast(dim_branch.select(F.col("branch_id").alias("__bid"),
                                            *[F.col(c).alias(f"__b_{c}") for c in cols]))
    out = df.join(b, df.branch_id == b.__bid, "left").drop("__bid")
    for c in cols:
        out = out.withColumnRenamed(f"__b_{c}", c)
    return out


def mart_ad_daily(fact: DataFrame, dim_branch: DataFrame, dim_campaign: DataFrame, dim_ad: DataFrame,
                  today) -> DataFrame:
    """Ad-day fact with branch, current campaign and ad names and ratios."""
    f = _with_branch(fact, dim_branch)
    c = dim_campaign.filter((F.col("is_current") == F.lit(True)) & (F.col("effective_from_date") <= F.lit(today)))
    c = c.select(F.col("channel_key").alias("__cc"), F.col("account_id_norm").alias("__ca"),
                 F.col("campaign_id").alias("__ci"), "campaign_name")
    a = dim_ad.filter((F.col("is_current") == F.lit(True)) & (F.col("effective_from_date") <= F.lit(today)))
    a = a.select(F.col("channel_key").alias("__ac"), F.col("account_id_norm").alias("__aa"),
                 F.col("ad_id").alias("__ai"), "ad_name")
    f = f.join(c, (f.channel_key == c.__cc) & (f.account_id_norm == c.__ca) & (f.campaign_id == c.__ci), "left")
    f = f.join(a, (f.channel_key == a.__ac) & (f.account_id_norm == a.__aa) & (f.ad_id == a.__ai), "left")
    return f.select(
        F.col("stat_date").alias("report_date"), "branch_id", "branch_name", "channel_key", "account_id_norm",
        "campaign_id", "campaign_name", "ad_group_id", "ad_id", "ad_name", "currency_code", "impressions",
        "clicks", F.col("spend_micros").alias("spend_native_micros"),
        F.col("conversion_count").alias("conversions"),
        F.col("conversion_value_micros").alias("conversion_value_native_micros"),
        safe_ratio("clicks", "impressions").alias("ctr"),
        safe_ratio(micros_to_double("spend_micros"), "clicks").alias("cpc"),
        safe_ratio("conversion_value_micros", "spend_micros").alias("roas"))


def purchases_by_campaign(action_fact: DataFrame) -> DataFrame:
    return (action_fact.filter(F.col("action_type") == "purchase")
            .groupBy(F.col("stat_date").alias("report_date"), "branch_id", "channel_key", "account_id_norm",
                     "campaign_id")
            .agg(F.sum("action_count").alias("purchase_count"),
                 F.sum("action_value_micros").alias("purchase_value_micros")))


CAMPAIGN_MART_COLUMNS = [
    "report_date", "branch_id", "branch_name", "channel_key", "account_id_norm", "campaign_id",
    "campaign_name", "currency_code", "impressions", "clicks", "spend_native_micros",
    "contract_spend_native_micros", "effective_spend_native_micros", "active_time_contract_count",
    "purchase_count", "purchase_value_micros", "conversions", "conversion_value_native_micros", "ctr", "cpc",
    "effective_cpc", "roas", "effective_roas", "source_tier"]


def mart_campaign_daily(campaign_fact: DataFrame, action_fact: DataFrame, external: DataFrame,
                        dim_branch: DataFrame) -> DataFrame:
    """API campaigns (``api_real``) UNION ALL external sheet rows (``sheet``).

    Purchases come from the action fact (type ``purchase``) matched on date,
    branch, channel, account and campaign (not currency, as the reference).
    """
    pc = purchases_by_campaign(action_fact)
    b = _with_branch(campaign_fact, dim_branch)
    keys = ["report_date", "branch_id", "channel_key", "account_id_norm", "campaign_id"]
    api = b.join(pc, keys, "left").select(
        *keys, "branch_name", "campaign_name", "currency_code", "impressions", "clicks",
        F.col("spend_micros").alias("spend_native_micros"),
        F.lit(None).cast("bigint").alias("contract_spend_native_micros"),
        F.col("spend_micros").alias("effective_spend_native_micros"),
        F.lit(0).cast("bigint").alias("active_time_contract_count"),
        F.coalesce("purchase_count", F.lit(0.0)).alias("purchase_count"),
        F.coalesce("purchase_value_micros", F.lit(0)).cast("bigint").alias("purchase_value_micros"),
        "conversions", F.col("conversion_value_micros").alias("conversion_value_native_micros"),
        safe_ratio("clicks", "impressions").alias("ctr"),
        safe_ratio(micros_to_double("spend_micros"), "clicks").alias("cpc"),
        safe_ratio(micros_to_double("spend_micros"), "clicks").alias("effective_cpc"),
        safe_ratio("conversion_value_micros", "spend_micros").alias("roas"),
        safe_ratio("conversion_value_micros", "spend_micros").alias("effective_roas"),
        F.lit("api_real").alias("source_tier"))
    e = _with_branch(external, dim_branch)
    sheet = (e.groupBy(F.col("date").alias("report_date"), "branch_id", "branch_name", "channel_key")
              .agg(F.sum("impressions").cast("bigint").alias("impressions"),
                   F.sum("clicks").cast("bigint").alias("clicks"),
                   F.sum("spend_usd_micros").alias("spend_native_micros"),
                   F.sum("transactions").cast("double").alias("purchase_count"),
                   F.sum("transactions").cast("double").alias("conversions"))
              .select("report_date", "branch_id", "branch_name", "channel_key",
                      F.lit("external_sheet").alias("account_id_norm"),
                      F.concat(F.lit("external_sheet:"), F.col("channel_key")).alias("campaign_id"),
                      F.concat(F.lit("External Sheet "), F.col("channel_key")).alias("campaign_name"),
                      F.lit("USD").alias("currency_code"), "impressions", "clicks", "spend_native_micros",
                      F.lit(None).cast("bigint").alias("contract_spend_native_micros"),
                      F.col("spend_native_micros").alias("effective_spend_native_micros"),
                      F.lit(0).cast("bigint").alias("active_time_contract_count"), "purchase_count",
                      F.lit(None).cast("bigint").alias("purchase_value_micros"), "conversions",
                      F.lit(None).cast("bigint").alias("conversion_value_native_micros"),
                      safe_ratio("clicks", "impressions").alias("ctr"),
                      safe_ratio(micros_to_double("spend_native_micros"), "clicks").alias("cpc"),
                      safe_ratio(micros_to_double("spend_native_micros"), "clicks").alias("effective_cpc"),
                      F.lit(None).cast("double").alias("roas"), F.lit(None).cast("double").alias("effective_roas"),
                      F.lit("sheet").alias("source_tier")))
    return api.select(*CAMPAIGN_MART_COLUMNS).unionByName(sheet.select(*CAMPAIGN_MART_COLUMNS))


def mart_branch_channel_daily(mart_campaign: DataFrame) -> DataFrame:
    """Branch x channel x currency x day roll-up; ratios of sums."""
    return (mart_campaign.groupBy("report_date", "branch_id", "channel_key", "currency_code")
            .agg(F.max("branch_name").alias("branch_name"),
                 F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
                 F.sum("spend_native_micros").alias("spend_native_micros"),
                 F.sum("conversions").alias("conversions"),
                 F.sum("conversion_value_native_micros").alias("conversion_value_native_micros"))
            .withColumn("ctr", safe_ratio("clicks", "impressions"))
            .withColumn("cpc", safe_ratio(micros_to_double("spend_native_micros"), "clicks"))
            .withColumn("roas", safe_ratio("conversion_value_native_micros", "spend_native_micros")))


def mart_business_daily(fact_order: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Orders per day, branch and currency: distinct orders and money sums."""
    f = _with_branch(fact_order, dim_branch)
    return (f.groupBy(F.col("order_date").alias("report_date"), "branch_id", F.col("currency").alias("currency_code"))
             .agg(F.max("branch_name").alias("branch_name"),
                  F.count_distinct("order_id").alias("orders"),
                  sum0("quantity").alias("quantity"),
                  sum0("gross_amount_micros").alias("gross_revenue_native_micros"),
                  sum0("discount_amount_micros").alias("discount_amount_native_micros"),
                  sum0("net_amount_micros").alias("net_revenue_native_micros")))


def mart_web_daily(fact_web: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Web totals per day and branch (daily distincts are added, not re-distincted)."""
    f = _with_branch(fact_web, dim_branch)
    return (f.groupBy(F.col("event_date").alias("report_date"), "branch_id")
             .agg(F.max("branch_name").alias("branch_name"), sum0("users").alias("users"),
                  sum0("sessions").alias("sessions"), sum0("event_count").alias("event_count")))


def mart_survey_daily(fact_survey: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Distinct responses and mean score per day and branch."""
    f = _with_branch(fact_survey, dim_branch)
    return (f.groupBy(F.col("response_date").alias("report_date"), "branch_id")
             .agg(F.max("branch_name").alias("branch_name"),
                  F.count_distinct("response_id").alias("response_count"),
                  F.avg("answer_score").alias("avg_answer_score")))


def mart_blended_daily(mart_campaign: DataFrame, mart_business: DataFrame, mart_web: DataFrame,
                       mart_survey: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Measures of all four marts by (date, branch, currency).

    Ad, business and key rows are padded to one shape and grouped once. Web and survey keys take
    the branch's currency; their values join on date and branch only, so they repeat per currency
    (as the reference).
    """
    keys = ["report_date", "branch_id", "currency_code"]
    ad = {"impressions": "ad_impressions", "clicks": "ad_clicks", "spend_native_micros": "ad_spend_native_micros",
          "conversions": "ad_conversions", "conversion_value_native_micros": "ad_conversion_value_native_micros"}
    biz = ["orders", "net_revenue_native_micros"]
    web = mart_web.select("report_date", "branch_id", "users", "sessions", "event_count")
    sv = mart_survey.select("report_date", "branch_id", "response_count", "avg_answer_score")
    cur = bounded_broadcast(dim_branch.select("branch_id", F.col("currency").alias("currency_code")))
    seen = web.select("report_date", "branch_id").unionByName(sv.select("report_date", "branch_id")).join(cur, "branch_id", "left")
    padded = (mart_campaign.select(*keys, *[F.col(c).alias(a) for c, a in ad.items()])
              .unionByName(mart_business.select(*keys, *biz), allowMissingColumns=True)
              .unionByName(seen.select(*keys), allowMissingColumns=True))
    summed = padded.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in [*ad.values(), *biz]])
    out = (_with_branch(summed, dim_branch).join(web, ["report_date", "branch_id"], "left")
           .join(sv, ["report_date", "branch_id"], "left"))
    return out.select("report_date", "branch_id", "branch_name", "currency_code", *ad.values(), *biz,
                      "users", "sessions", "event_count", "response_count", "avg_answer_score")
