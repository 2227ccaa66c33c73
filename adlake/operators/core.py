"""Core dimensions and facts: branch resolution, dedup, rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.functions.columns import (blank_key, customer_key, last_non_null, load_ts,
                                      strip_account_prefix, sum0)
from adlake.operators.dedup import latest_by
from adlake.operators.joins import (Segments, best_effective_lookup, bounded_broadcast, build_segments, effective_lookup,
                                    keyword_rank, keyword_rule_match)
from adlake.session import Window

UNKNOWN = "UNKNOWN"
MAP_PRIORITY = ("effective_start_date", "updated_at")


def account_segments(account_map: DataFrame | Segments) -> Segments:
    """Non-overlapping (channel, account) -> branch segments; newest start wins.

    Facts take a map or these segments; a plan of several facts builds them once.
    """
    if isinstance(account_map, Segments):
        return account_map
    return build_segments(account_map, ["channel_key", "account_id_norm"], ["branch_id"], priority=MAP_PRIORITY)


def branch_by_account(facts: DataFrame, account_map: DataFrame | Segments, date_col: str,
                      out_col: str = "branch_id") -> DataFrame:
    """Effective-dated account -> branch lookup; NULL end is open, default UNKNOWN.

    Overlapping active mappings resolve to the newest effective start, then
    the newest update. The overlap is resolved on the (small) map side, so
    every fact row matches at most one segment and needs no deduplication.
    """
    seg = account_segments(account_map)
    out = effective_lookup(facts, seg.rows.withColumnRenamed("branch_id", "__seg_branch"), [F.col("channel_key"), F.col("account_id_norm")],
                           ["channel_key", "account_id_norm"], date_col, ["__seg_branch"], small=seg.small)
    return out.withColumn(out_col, F.coalesce(F.col("__seg_branch"), F.lit(UNKNOWN))).drop("__seg_branch")


def rule_order():
    """Best keyword rule first: priority asc, longer keyword, newest, rule id."""
    return [F.col("priority").asc_nulls_first(), F.length("match_keyword").desc(), F.col("updated_at").desc(),
            F.col("rule_id").desc()]


def rule_priority():
    """The same ranking (NULL priority first) as a struct whose maximum is the best rule."""
    return [F.col("priority").isNull().alias("pn"), (-F.col("priority")).alias("p0"), F.length("match_keyword").alias("p1"),
            F.col("updated_at").alias("p2"), F.col("rule_id").alias("p3")]


def _rule_per_name(df: DataFrame, rules: DataFrame, name_col: str) -> DataFrame:
    """Fallback for very large rule sets: best rule per distinct name via join."""
    pr = rules.withColumn("rule_p", F.struct(*rule_priority()))
    per_name = keyword_rule_match(df, name_col, pr, ["branch_id", "rule_p"],
                                  priority=[F.col("rule_p").alias("p")])
    return per_name.select(F.col(name_col).alias("__nm"), F.col("branch_id").alias("__rb"),
                           F.col("rule_p").alias("__rp"))


def branch_by_rule(facts: DataFrame, rules: DataFrame, name_col: str,
                   out_col: str = "branch_id") -> DataFrame:
    """Keyword rules: ``lower(name)`` contains the keyword; default UNKNOWN.

    A small rule list becomes a CASE expression (no join); a large one is
    matched against the distinct names and joined back on the name.
    """
    kr = keyword_rank(rules, F.col(name_col), rule_order())
    if kr is not None:
        rank, value = kr
        return facts.withColumn(out_col, F.coalesce(value(rank), F.lit(UNKNOWN)))
    pn = _rule_per_name(facts, rules, name_col)
    out = facts.join(pn, facts[name_col] == pn["__nm"], "left").drop("__nm", "__rp")
    return out.withColumn(out_col, F.coalesce(F.col("__rb"), F.lit(UNKNOWN))).drop("__rb")


NAVER_GROUP = ["account_id_norm", "campaign_id", "stat_date"]


def naver_rule_branch(naver_rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Best rule per (account, campaign, ad group, day) over all names it had.

    Returns the keys (ad group as blank key ``__ag``) and ``rule_branch_id``.
    The aggregation is partial (map-side), so a hot ad group cannot pile up.
    """
    rows = naver_rows.select(*NAVER_GROUP, blank_key("ad_group_id").alias("__ag"), "ad_group_name")
    kr = keyword_rank(rules, F.col("ad_group_name"), rule_order())
    if kr is not None:
        rank, value = kr
        best = rows.select(*NAVER_GROUP, "__ag", rank.alias("__rk")).groupBy(*NAVER_GROUP, "__ag") \
                   .agg(F.min("__rk").alias("__rk"))
        return best.select(*NAVER_GROUP, "__ag", value(F.col("__rk")).alias("rule_branch_id"))
    pn = _rule_per_name(rows, rules, "ad_group_name")
    j = rows.join(pn, rows.ad_group_name == pn.__nm, "inner")
    return j.groupBy(*NAVER_GROUP, "__ag").agg(F.max_by("__rb", "__rp").alias("rule_branch_id"))


def fact_marketing(stg: DataFrame, account_map: DataFrame, rules: DataFrame, dim_branch: DataFrame,
                   w: Window, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Ad-level daily fact with branch and currency, latest row per fact key.

    Naver rows take the branch of the best keyword rule over all names their
    ad group had that day; other channels use the effective-dated account
    map. Currency is the row's own, else KRW for Naver, else the branch
    currency, else USD.

    The branch is constant within a fact key (it depends on channel, account,
    campaign, ad group and day only), so deduplication runs first and the
    lookups touch one row per key.
    """
    s = stg.filter(w.contains("stat_date"))
    cols = ["stat_date", "channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_id",
            "impressions", "clicks", "spend_micros", "conversion_count", "conversion_value_micros",
            "load_ts", "currency_code", *tiebreak]

    def latest(rows):
        return latest_by(rows, ["stat_date", "channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_id"],
                         ["load_ts"], tiebreak, blank_keys=["ad_group_id", "ad_id"])

    # Only Naver rows take the rules; other channels use the account map.
    is_naver = F.col("channel_key") == "NAVER_ADS"
    sn = s.filter(is_naver)
    kr = keyword_rank(rules, F.col("ad_group_name"), rule_order())
    if kr is not None:
        # the best rank of an ad group's names that day, beside its rows: nothing to join
        rank, value = kr
        best = F.min(rank).over(W.partitionBy(*NAVER_GROUP, blank_key("ad_group_id")))
        known = F.col("account_id_norm").isNotNull() & F.col("campaign_id").isNotNull()
        dn = latest(sn.withColumn("rule_branch_id", F.when(known, value(best))).select(*cols, "rule_branch_id"))
    else:
        rb = naver_rule_branch(sn, rules).select(
            F.col("account_id_norm").alias("__ra"), F.col("campaign_id").alias("__rc"),
            F.col("stat_date").alias("__rd"), F.col("__ag").alias("__rg"), "rule_branch_id")
        dn = latest(sn.select(*cols))
        dn = dn.join(rb, (dn.account_id_norm == rb.__ra) & (dn.campaign_id == rb.__rc) & (dn.stat_date == rb.__rd)
                     & (blank_key(dn.ad_group_id) == rb.__rg), "left")
    dn = dn.withColumn("branch_id", F.coalesce("rule_branch_id", F.lit(UNKNOWN)))
    do = branch_by_account(latest(s.filter(~is_naver).select(*cols)), account_map, "stat_date", "branch_id")
    keep = [*cols, "branch_id"]
    d = do.select(*keep).unionByName(dn.select(*keep))
    b = bounded_broadcast(dim_branch.select(F.col("branch_id").alias("__bb"), F.col("currency").alias("__bc")))
    d = d.join(b, d.branch_id == b.__bb, "left").withColumn(
        "currency_code", F.coalesce(F.col("currency_code"),
                                    F.when(F.col("channel_key") == "NAVER_ADS", F.lit("KRW")),
                                    F.col("__bc"), F.lit("USD"))).drop("__bb", "__bc")
    return d.select("stat_date", "channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_id",
                    "impressions", "clicks", "spend_micros", "conversion_count", "conversion_value_micros",
                    "load_ts", "branch_id", "currency_code", *tiebreak)


def fact_campaign_daily(fact: DataFrame, dim_campaign: DataFrame | None, w: Window) -> DataFrame:
    """Campaign-day rollup of the ad fact; NULL metrics count as 0.

    The campaign name is the current dimension row's, the latest with a name where
    several are current. Ad rows are summed first (hash sums with map-side
    combining), so the join sees one row per campaign and day.
    """
    keys = ["channel_key", "account_id_norm", "campaign_id"]
    daily = (fact.filter(w.contains("stat_date"))
             .groupBy(F.col("stat_date").alias("report_date"), "branch_id", *keys, "currency_code")
             .agg(sum0("impressions").alias("impressions"), sum0("clicks").alias("clicks"),
                  sum0("spend_micros").alias("spend_micros"),
                  sum0("conversion_count").cast("double").alias("conversions"),
                  sum0("conversion_value_micros").alias("conversion_value_micros"),
                  F.max("load_ts").alias("load_ts")))
    if dim_campaign is None:
        return daily.withColumn("campaign_name", F.lit(None).cast("string"))
    c = dim_campaign.filter(F.col("is_current") == F.lit(True)) if "is_current" in dim_campaign.columns \
        else dim_campaign
    names = (c.filter(F.col("effective_from_date") <= F.lit(w.end))
             .groupBy(*keys).agg(last_non_null("campaign_name", "load_ts").alias("campaign_name")))
    return daily.join(names, keys, "left")


def fact_action(stg_action: DataFrame, account_map: DataFrame, w: Window) -> DataFrame:
    """Action fact: account branch lookup (one match per row, newest mapping)."""
    s = stg_action.filter(w.contains("stat_date"))
    s = branch_by_account(s, account_map, "stat_date")
    return latest_by(s, ["stat_date", "channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_id",
                         "action_type"], ["load_ts"], blank_keys=["ad_group_id", "ad_id"])


def map_segments(m: DataFrame, keys: Sequence[str], value_cols=("branch_id",)) -> Segments:
    """Segments of a governance map, carrying the priority columns."""
    m = m.withColumn("__es", F.col("effective_start_date")).withColumn("__up", F.col("updated_at"))
    return build_segments(m, list(keys), list(value_cols) + ["__es", "__up"], priority=MAP_PRIORITY)


def fact_web_event(stg_web: DataFrame, property_map: DataFrame, w: Window) -> DataFrame:
    """Web fact: property -> branch, newest start / update wins overlaps."""
    s = stg_web.filter(w.contains("event_date"))
    seg = map_segments(property_map, ["property_id"])
    return best_effective_lookup(s, [(seg, [F.col("property_id")], ["property_id"])], "event_date",
                                 ["branch_id"], ["__es", "__up"], default={"branch_id": UNKNOWN}).drop("__es", "__up")


def fact_order_line(stg_orders: DataFrame, fever_map: DataFrame, sales_map: DataFrame,
                    w: Window) -> DataFrame:
    """Order fact: customer key and branch.

    FEVER lines match the event map by event id, or by venue for map rows
    without an event id (the OR-join is split into two equi lookups); SALES
    lines match by source system. The newest mapping wins.
    """
    s = stg_orders.filter(w.contains("order_date")).withColumn(
        "customer_key", customer_key("customer_email_hash", "customer_phone_hash"))
    fe = fever_map.filter(F.col("event_id").isNotNull())
    fv = fever_map.filter(F.col("event_id").isNull() & F.col("venue_name").isNotNull())
    is_fever = F.col("order_source") == "FEVER"
    is_sales = F.col("order_source") == "SALES"
    lookups = [
        (map_segments(fe, ["event_id"]), [F.when(is_fever, F.col("product_id"))], ["event_id"]),
        (map_segments(fv, ["venue_name"]), [F.when(is_fever, F.col("venue_name"))], ["venue_name"]),
        (map_segments(sales_map, ["source_system"]), [F.when(is_sales, F.col("source_system"))], ["source_system"]),
    ]
    out = best_effective_lookup(s, lookups, "order_date", ["branch_id"], ["__es", "__up"],
                                default={"branch_id": UNKNOWN})
    return out.drop("__es", "__up", "customer_email_hash", "customer_phone_hash")


def fact_survey(stg_survey: DataFrame, survey_map: DataFrame, w: Window) -> DataFrame:
    """Survey fact: map rows with a NULL survey id apply to every survey."""
    s = stg_survey.filter(w.contains("response_date")).withColumn(
        "customer_key", customer_key("customer_email_hash", "customer_phone_hash"))
    exact = survey_map.filter(F.col("survey_id").isNotNull())
    wild = survey_map.filter(F.col("survey_id").isNull())
    lookups = [
        (map_segments(exact, ["survey_source", "survey_id"]), [F.col("survey_source"), F.col("survey_id")],
         ["survey_source", "survey_id"]),
        (map_segments(wild, ["survey_source"]), [F.when(F.col("survey_id").isNotNull(), F.col("survey_source"))],
         ["survey_source"]),
    ]
    out = best_effective_lookup(s, lookups, "response_date", ["branch_id"], ["__es", "__up"],
                                default={"branch_id": UNKNOWN})
    return out.drop("__es", "__up", "customer_email_hash", "customer_phone_hash")


# ------------------------------------------------------------------ dimensions
# The eight channels of the channel dimension.
CHANNELS = [
    ("META", "Meta Ads", "facebook_ads", True),
    ("GOOGLE_ADS", "Google Ads", "google_ads", True),
    ("TIKTOK_ADS", "TikTok Ads", "tiktok_ads", True),
    ("NAVER_ADS", "Naver Ads", "naver_ads", True),
    ("GA4", "GA4", "ga4", False),
    ("FEVER", "Fever", "fever", False),
    ("SALES", "Sales", "sales", False),
    ("SURVEY", "Survey", "survey", False),
]


def dim_channel(spark, now=None) -> DataFrame:
    df = spark.createDataFrame(CHANNELS, "channel_key string, channel_name string, platform_name string, "
                                         "is_paid_media boolean")
    return df.withColumn("load_ts", F.lit(now).cast("timestamp") if now else F.current_timestamp())


def _grouped(df: DataFrame, channel: str, account, cols: dict, date_col: str, w: Window, now) -> DataFrame:
    sel = [F.lit(channel).alias("channel_key"), account.alias("account_id_norm")]
    sel += [(v if not isinstance(v, str) else F.col(v)).alias(k) for k, v in cols.items()]
    d = df.filter(w.contains(date_col)).withColumn("__lt", load_ts(now))
    return (d.groupBy(*sel).agg(F.max(date_col).alias("effective_from_date"), F.max("__lt").alias("load_ts")))


def dim_account(meta: DataFrame, google: DataFrame, tiktok: DataFrame, naver: DataFrame, w: Window,
                now=None, meta_creative: DataFrame | None = None,
                naver_creative: DataFrame | None = None) -> DataFrame:
    """Accounts seen in any source; last non-null name / timezone / currency."""
    null = F.lit(None).cast("string")
    cols = {"account_name": null, "timezone": null, "currency": null}
    parts = [
        _grouped(meta, "META", strip_account_prefix("account_id"),
                 {**cols, "account_name": F.col("account_name") if "account_name" in meta.columns else null},
                 "stat_date", w, now),
        _grouped(google, "GOOGLE_ADS", F.col("customer_id").cast("string"), cols, "stat_date", w, now),
        _grouped(tiktok, "TIKTOK_ADS", F.col("advertiser_id").cast("string"), cols, "stat_date", w, now),
        _grouped(naver, "NAVER_ADS", F.col("account_id").cast("string"), cols, "stat_date", w, now),
    ]
    if meta_creative is not None:
        parts.append(_grouped(meta_creative, "META", F.col("account_id"), cols, "collected_date", w, now))
    if naver_creative is not None:
        parts.append(_grouped(naver_creative, "NAVER_ADS", F.col("account_id"), cols, "collected_date", w, now))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.filter(F.col("account_id_norm").isNotNull() & (F.col("account_id_norm") != ""))
    return (u.groupBy("channel_key", "account_id_norm")
             .agg(last_non_null("account_name", "load_ts").alias("account_name"),
                  last_non_null("timezone", "load_ts").alias("timezone"),
                  last_non_null("currency", "load_ts").alias("currency"),
                  F.max("load_ts").alias("load_ts")))


def dim_campaign_current(meta: DataFrame, google: DataFrame, tiktok: DataFrame, naver: DataFrame,
                         w: Window, now=None) -> DataFrame:
    """Current campaign attributes: last non-null name / type / status.

    Ordered by (load time, last stat date) of each attribute combination.
    """
    null = F.lit(None).cast("string")
    parts = [
        _grouped(meta, "META", strip_account_prefix("account_id"),
                 {"campaign_id": "campaign_id", "campaign_name": "campaign_name",
                  "campaign_type": "campaign_type", "status": null}, "stat_date", w, now),
        _grouped(google, "GOOGLE_ADS", F.col("customer_id").cast("string"),
                 {"campaign_id": "campaign_id", "campaign_name": "campaign_name",
                  "campaign_type": null, "status": null}, "stat_date", w, now),
        _grouped(tiktok, "TIKTOK_ADS", F.col("advertiser_id").cast("string"),
                 {"campaign_id": "campaign_id", "campaign_name": null,
                  "campaign_type": null, "status": null}, "stat_date", w, now),
        _grouped(naver, "NAVER_ADS", F.col("account_id").cast("string"),
                 {"campaign_id": "campaign_id", "campaign_name": "campaign_name",
                  "campaign_type": null, "status": null}, "stat_date", w, now),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    u = u.filter(F.col("campaign_id").isNotNull() & (F.col("campaign_id") != ""))
    o = ("load_ts", "effective_from_date")
    return (u.groupBy("channel_key", "account_id_norm", "campaign_id")
             .agg(last_non_null("campaign_name", *o).alias("campaign_name"),
                  last_non_null("campaign_type", *o).alias("campaign_type"),
                  last_non_null("status", *o).alias("status"),
                  F.max("effective_from_date").alias("effective_from_date"),
                  F.max("load_ts").alias("load_ts"))
             .withColumn("effective_to_date", F.lit(None).cast("date"))
             .withColumn("is_current", F.lit(True)))


def dim_ad_current(meta: DataFrame, google: DataFrame, tiktok: DataFrame, naver: DataFrame,
                   w: Window, now=None) -> DataFrame:
    """Current ad attributes: campaign, ad group, name, status last non-null."""
    null = F.lit(None).cast("string")
    base = {"campaign_id": "campaign_id", "ad_group_id": "ad_group_id", "ad_id": "ad_id"}
    parts = [
        _grouped(meta, "META", strip_account_prefix("account_id"),
                 {**base, "ad_name": "ad_name", "status": null}, "stat_date", w, now),
        _grouped(google, "GOOGLE_ADS", F.col("customer_id").cast("string"),
                 {**base, "ad_name": "ad_name", "status": null}, "stat_date", w, now),
        _grouped(tiktok, "TIKTOK_ADS", F.col("advertiser_id").cast("string"),
                 {**base, "ad_name": null, "status": null}, "stat_date", w, now),
        _grouped(naver, "NAVER_ADS", F.col("account_id").cast("string"),
                 {**base, "ad_name": "ad_name", "status": "status"}, "stat_date", w, now),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    u = u.filter(F.col("ad_id").isNotNull() & (F.col("ad_id") != ""))
    o = ("load_ts", "effective_from_date")
    return (u.groupBy("channel_key", "account_id_norm", "ad_id")
             .agg(last_non_null("campaign_id", *o).alias("campaign_id"),
                  last_non_null("ad_group_id", *o).alias("ad_group_id"),
                  last_non_null("ad_name", *o).alias("ad_name"),
                  last_non_null("status", *o).alias("status"),
                  F.max("effective_from_date").alias("effective_from_date"),
                  F.max("load_ts").alias("load_ts"))
             .withColumn("effective_to_date", F.lit(None).cast("date"))
             .withColumn("is_current", F.lit(True)))


def dim_customer(stg_orders: DataFrame, stg_survey: DataFrame, w: Window) -> DataFrame:
    """Customers from orders and surveys: key, hashes, first and last seen.

    The anonymous key (no email and no phone) is dropped. Each source is
    pre-aggregated per hash pair before the union (partial aggregation).
    """
    def src(df, date_col, ts_col):
        return (df.filter(w.contains(date_col))
                  .groupBy(F.col("customer_email_hash").alias("email_hash"),
                           F.col("customer_phone_hash").alias("phone_hash"))
                  .agg(F.min(ts_col).alias("first_seen_ts"), F.max(ts_col).alias("latest_seen_ts"),
                       F.max("load_ts").alias("load_ts")))
    u = src(stg_orders, "order_date", "order_ts").unionByName(src(stg_survey, "response_date", "response_ts"))
    u = u.withColumn("customer_key", F.sha2(F.concat(F.coalesce("email_hash", F.lit("")), F.lit("|"),
                                                     F.coalesce("phone_hash", F.lit(""))), 256))
    u = u.filter(F.col("customer_key") != F.sha2(F.lit("|"), 256))
    return (u.groupBy("customer_key")
             .agg(F.max("email_hash").alias("email_hash"), F.max("phone_hash").alias("phone_hash"),
                  F.min("first_seen_ts").alias("first_seen_ts"), F.max("latest_seen_ts").alias("latest_seen_ts"),
                  F.max("load_ts").alias("load_ts")))


def enrich_branch(fact: DataFrame, account_map: DataFrame, rules: DataFrame, w: Window,
                  naver_rows: DataFrame | None = None, date_col: str = "stat_date") -> DataFrame:
    """Recompute the branch of fact rows in the window after map or rule changes.

    Returns the whole fact with ``branch_id`` updated and ``branch_changed``
    set on rows whose branch moved (so a writer rewrites only the partitions
    that hold a change). Keys are compared NULL-safely, so rows with NULL ad
    group or ad ids are enriched too (the reference's plain ``=`` skips them).
    Naver rows take the best keyword rule over their ad group's names that
    day (``naver_rows``: staged Naver rows with ``ad_group_name``).
    """
    inside = w.contains(date_col)
    f_in = fact.filter(inside)
    f_out = fact.filter(~inside | F.col(date_col).isNull()).withColumn("branch_changed", F.lit(False))
    e = branch_by_account(f_in, account_map, date_col, "__acct_branch")
    new = F.col("__acct_branch")
    if naver_rows is not None:
        rb = naver_rule_branch(naver_rows.filter(inside & (F.col("channel_key") == "NAVER_ADS")), rules)
        rb = rb.select(F.col("account_id_norm").alias("__ra"), F.col("campaign_id").alias("__rc"),
                       F.col(date_col).alias("__rd"), F.col("__ag").alias("__rg"), "rule_branch_id")
        e = e.join(rb, (F.col("channel_key") == "NAVER_ADS") & (e.account_id_norm == rb.__ra)
                   & (e.campaign_id == rb.__rc) & (e[date_col] == rb.__rd)
                   & (blank_key(e.ad_group_id) == rb.__rg), "left").drop("__ra", "__rc", "__rd", "__rg")
        new = F.when(F.col("channel_key") == "NAVER_ADS", F.coalesce("rule_branch_id", F.lit(UNKNOWN))).otherwise(new)
    e = (e.withColumn("branch_changed", F.coalesce(F.col("branch_id"), F.lit("")) != new)
          .withColumn("branch_id", new))
    e = e.drop(*[c for c in ("__acct_branch", "rule_branch_id") if c in e.columns])
    return f_out.unionByName(e.select(*f_out.columns))
