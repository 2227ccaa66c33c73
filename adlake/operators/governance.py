"""Source readiness / activation views and unmatched Naver ad groups."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import is_blank, sum0
from adlake.operators.core import rule_order
from adlake.operators.joins import bounded_broadcast, keyword_rank, keyword_rule_match


def _any_active_rule(rules: DataFrame) -> DataFrame:
    """One row: whether any keyword rule is active (uncorrelated EXISTS)."""
    return rules.agg(F.coalesce(F.max(F.col("is_active").cast("int")), F.lit(0)).alias("__r")) \
                .select((F.col("__r") == 1).alias("__has_rule"), F.lit(1).alias("__one"))


def _with_rule_flag(config: DataFrame, rules: DataFrame) -> DataFrame:
    flag = F.broadcast(_any_active_rule(rules))  # exactly one row
    return config.withColumn("__one", F.lit(1)).join(flag, "__one", "left").drop("__one")


def source_readiness(config: DataFrame, rules: DataFrame) -> DataFrame:
    """Readiness and setup notes per configured source."""
    c = _with_rule_flag(config, rules)
    no_acct = is_blank("account_id_norm")
    naver_no_rule = (F.col("channel_key") == "NAVER_ADS") & ~F.col("__has_rule")
    mode = F.upper(F.coalesce(F.col("credential_mode"), F.lit("ENV")))
    secret_missing = (mode == "SECRET_MANAGER") & is_blank("secret_ref")
    readiness = (F.when(no_acct, "MISSING_SETUP").when(naver_no_rule, "MISSING_SETUP")
                  .when(secret_missing, "MISSING_SETUP").when(F.col("status") == "ACTIVE", "ACTIVE_READY")
                  .when(F.col("status") == "PENDING_SETUP", "MISSING_SETUP").otherwise("REVIEW"))
    # The note texts.
    notes = (F.when(no_acct, "set account_id_norm first")
              .when(naver_no_rule, "seed naver_adgroup_branch_rule then API smoke test")
              .when(secret_missing, "set secret_ref or switch credential_mode to ENV")
              .when(mode == "ENV", "verify providers.*.env_file and API smoke test")
              .otherwise("review source setup"))
    return c.select(*config.columns, (~no_acct).alias("has_account_id"), (~is_blank("secret_ref")).alias("has_secret_ref"),
                    readiness.alias("readiness"), notes.alias("notes"))


def source_activation(config: DataFrame, rules: DataFrame, account_map: DataFrame) -> DataFrame:
    """Whether each source has an active branch mapping, and what blocks it.

    The correlated EXISTS on the account map becomes a left join to the
    distinct active (channel, account) keys.
    """
    c = _with_rule_flag(config, rules)
    keys = (account_map.filter(F.col("is_active") == F.lit(True))
            .select(F.col("channel_key").alias("__mc"), F.col("account_id_norm").alias("__ma")).distinct()
            .withColumn("__mapped", F.lit(True)))
    keys = bounded_broadcast(keys)
    c = c.join(keys, (c.channel_key == keys.__mc) & (c.account_id_norm == keys.__ma), "left")
    mapped = F.coalesce(F.col("__mapped"), F.lit(False))
    naver = F.col("channel_key") == "NAVER_ADS"
    mode = F.upper(F.coalesce(F.col("credential_mode"), F.lit("ENV")))
    blocker = (F.when(is_blank("account_id_norm"), "MISSING_ACCOUNT_ID")
                .when((mode == "SECRET_MANAGER") & is_blank("secret_ref"), "MISSING_SECRET_REF")
                .when(naver & ~F.col("__has_rule"), "MISSING_BRANCH_RULE")
                .when(~naver & ~mapped, "MISSING_BRANCH_MAPPING"))
    return c.select(*config.columns, (~is_blank("account_id_norm")).alias("has_account_id"),
                    (~is_blank("secret_ref")).alias("has_secret_ref"),
                    F.when(naver, F.col("__has_rule")).otherwise(mapped).alias("has_active_mapping"),
                    blocker.alias("activation_blocker"))


def unmatched_adgroups(naver_raw: DataFrame, rules: DataFrame, today: _dt.date, days: int = 30,
                       tiebreak=()) -> DataFrame:
    """Recent Naver ad-group days whose name matches no active keyword rule.

    One row per (account, campaign, ad group, day) is kept (the latest load),
    as the reference keeps one ranked row per group, so repeated loads do not
    multiply the metrics; spend is cast to a number before summing.
    """
    from adlake.operators.dedup import latest_by
    r = naver_raw.filter(F.col("stat_date") >= F.lit(today - _dt.timedelta(days=days)))
    r = r.withColumn("__lt", F.coalesce("source_extract_ts", "ingestion_ts"))
    r = latest_by(r, ["account_id", "campaign_id", "ad_group_id", "stat_date"], ["__lt"], tiebreak,
                  blank_keys=["ad_group_id"])
    kr = keyword_rank(rules, F.col("ad_group_name"), rule_order())
    if kr is not None:
        r = r.filter(kr[0].isNull())
    else:  # too many rules for one CASE: match the distinct names and drop those that have a rule
        named = keyword_rule_match(r, "ad_group_name", rules).select(F.col("ad_group_name").alias("__nm"))
        r = r.join(named, F.col("ad_group_name") == F.col("__nm"), "left_anti")
    spend = F.trim(F.col("spend")).try_cast("decimal(38,9)") * F.lit(1_000_000)
    return (r.groupBy("stat_date", "account_id", "campaign_id", "campaign_name", "ad_group_id", "ad_group_name")
             .agg(sum0("impressions").alias("impressions"), sum0("clicks").alias("clicks"),
                  sum0(spend).cast("bigint").alias("spend_micros")))
