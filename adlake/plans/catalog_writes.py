"""Registered queries for MERGE, reload, retention and table-layout operators.

Stateful operators run as two-batch scenarios over the driver tables: batch 1
(even load sequence) is the existing table, batch 2 (all rows, changed) is the
new load; the query returns the resulting table state.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, LongType, StringType, StructField, StructType)

from adlake.operators import staging, upsert as U
from adlake.operators.dedup import latest_by
from adlake.plans.catalog import NOW, TIE, Ctx, ctx, finish, query
from adlake.session import ALL_TIME, Window, checkpoint_dir
from adlake.sources import fixtures as fx
from adlake.sources import io

PERF_KEYS = staging.PERF_KEYS


def _perf_batches(c: Ctx):
    """(batch-1 stg rows, batch-2 stg rows): even loads vs all loads, changed."""
    r = c.raws
    even = {k: v.filter(F.col("load_seq") % 2 == 0) for k, v in r.items()}
    t = staging.stg_ads_performance(even["meta"], even["google"], even["tiktok"], even["naver"], c.w, NOW, TIE, c.dealt())
    t = t.withColumn("currency_code", F.when(F.col("tie1") % 5 == 0, F.lit("EUR")))
    s = c.stg_perf().withColumn("impressions", F.col("impressions") + 1)
    return t, s


@query("upsert")
def q_upsert(spark, sf):
    c = ctx(spark, sf)
    t, s = _perf_batches(c)
    out = U.upsert(t.drop(*TIE, "load_ts"), s.drop(*TIE, "load_ts"), PERF_KEYS,
                   blank_keys=["ad_group_name", "currency_code"], keep_if_null=["ad_group_name", "currency_code"],
                   window=ALL_TIME, date_col="stat_date", dealt=c.dealt())
    return finish(out)


@query("upsert_unique_source")
def q_upsert_unique_source(spark, sf):
    r = ctx(spark, sf).raws
    g = r["google"].select(F.lit("GOOGLE_ADS").alias("channel_key"), F.col("customer_id").alias("account_id_norm"),
                           "campaign_id", "ad_group_id", "ad_group_name", "ad_id",
                           F.lit(None).cast("string").alias("currency_code"), "stat_date")
    # Campaign-day keys over ad-level rows: a MERGE on them would see many rows.
    return finish(U.duplicate_keys(g, ["channel_key", "account_id_norm", "campaign_id", "ad_group_id", "stat_date"],
                                   blank_keys=["ad_group_id"]))


@query("insert_if_absent")
def q_insert_if_absent(spark, sf):
    b = fx.governance(spark, sf)["dim_branch"]
    target = b.filter(F.col("branch_id") < "VENUE_13")
    source = b.withColumn("branch_name", F.concat(F.col("branch_name"), F.lit(" (new)")))
    return finish(U.insert_if_absent(target, source, ["branch_id"]))


@query("backfill_anti")
def q_backfill_anti(spark, sf):
    c = ctx(spark, sf)
    t, _ = _perf_batches(c)
    legacy = c.stg_perf()
    keys = ["stat_date", "channel_key", "account_id_norm", "campaign_id", "ad_group_id", "ad_id"]
    return finish(U.backfill_anti(legacy, t, keys))


@query("replace_range")
def q_replace_range(spark, sf):
    c = ctx(spark, sf)
    t, s = _perf_batches(c)
    accounts = [" 1", "2", "2", "3 ", "5", "8", "13", "21", "34", "55", "89"]
    rows = s.filter(F.col("stat_date").between(F.lit(_dt.date(1996, 1, 1)), F.lit(_dt.date(1997, 12, 31)))
                    & F.col("account_id_norm").isin([a.strip() for a in accounts]))
    out = U.replace_range(t.drop("load_ts"), rows.drop("load_ts"), "stat_date", _dt.date(1996, 1, 1),
                          _dt.date(1997, 12, 31), "account_id_norm", accounts + ["144"])
    return finish(out)


@query("append_dedup")
def q_append_dedup(spark, sf):
    c = ctx(spark, sf)
    t, s = _perf_batches(c)
    t = t.withColumn("currency_code", F.lit(None).cast("string"))
    both = U.append_rows(t, s.withColumn("load_ts", F.col("load_ts") + F.expr("INTERVAL 1 DAY")))
    return finish(latest_by(both, PERF_KEYS, ["load_ts"], TIE, blank_keys=["ad_group_name"]))


@query("delete_window")
def q_delete_window(spark, sf):
    f = ctx(spark, sf).fact_mkt()
    w = Window.of("1997-01-01", "1997-12-31")
    return finish(U.delete_window(f, "stat_date", w, F.col("channel_key") == "META"))


@query("purge_before")
def q_purge_before(spark, sf):
    return finish(U.purge_before(ctx(spark, sf).fact_mkt(), "stat_date", _dt.date(1999, 1, 1)))


@query("purge_rolling_30d")
def q_purge_rolling_30d(spark, sf):
    today = _dt.date(2024, 2, 1)
    return finish(U.purge_before(ctx(spark, sf).stg_web(), "event_date", today - _dt.timedelta(days=30)))


GA4_SCHEMA = StructType([
    StructField("event_date", DateType()), StructField("property_id", StringType()),
    StructField("source", StringType()), StructField("medium", StringType()),
    StructField("campaign", StringType()), StructField("event_name", StringType()),
    StructField("user_pseudo_id", StringType()), StructField("session_id", StringType()),
    StructField("page_location", StringType()), StructField("engagement_time_msec", LongType()),
])


@query("ensure_schema")
def q_ensure_schema(spark, sf):
    g = fx.ga4_raw(spark, sf).select("event_date", "property_id", "source", "medium", "campaign", "event_name",
                                      "user_pseudo_id", "session_id", "load_seq")
    return finish(io.ensure_schema(g, GA4_SCHEMA))


@query("scan_window")
def q_scan_window(spark, sf):
    return finish(io.scan_window(ctx(spark, sf).fact_mkt(), "stat_date", Window.of("1998-01-01", "1998-12-31")))


def _shared(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/q-{name}-{uuid.uuid4().hex}"


@query("truncate_load_guarded")
def q_truncate_load_guarded(spark, sf):
    path = _shared(spark, "guarded")
    b = fx.governance(spark, sf)["dim_branch"]
    io.truncate_load_guarded(spark, b, path)
    try:
        io.truncate_load_guarded(spark, b.limit(0), path)   # refused, table kept
    except io.EmptyLoad:
        pass
    return spark.read.parquet(path)


WEB_SPEC = io.TableSpec("stg_web_event_daily", "event_date",
                        cluster_by=("property_id", "source", "medium"), ttl_days=20)


@query("layout")
def q_layout(spark, sf):
    path = _shared(spark, "layout")
    c = ctx(spark, sf)
    io.write_window(spark, c.stg_web(), path, WEB_SPEC, ALL_TIME)
    return finish(spark.read.parquet(path))


@query("partition_ttl")
def q_partition_ttl(spark, sf):
    path = _shared(spark, "ttl")
    c = ctx(spark, sf)
    io.write_window(spark, c.stg_web(), path, WEB_SPEC, ALL_TIME)
    io.partition_ttl(spark, path, WEB_SPEC, _dt.date(2024, 2, 1))
    return finish(spark.read.parquet(path))


EVENT_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("user_id", LongType()),
    StructField("event_type", StringType()), StructField("value", DoubleType()),
])


@query("load_json_typed")
def q_load_json_typed(spark, sf):
    """Landed JSON lines (every 97th line truncated) read under a declared schema."""
    path = _shared(spark, "json")
    fx.register(spark, sf, [])
    ev = spark.table("events")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    line = F.when(F.col("event_id") % 97 == 0, F.substring(line, 1, 12)).otherwise(line)
    ev.select(line.alias("value")).write.mode("overwrite").text(path)
    df = io.load_json_typed(spark, path, EVENT_SCHEMA)
    return df.select("event_id", "user_id", "event_type", "value",
                     F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


# ------------------------------------------------------------------ SCD2
from adlake.operators import scd2 as S2  # noqa: E402


def _epoch(df):
    out = df
    for c in ("valid_from_ts", "valid_to_ts"):
        if c in out.columns:
            out = out.withColumn(c.replace("_ts", "_epoch"), F.unix_timestamp(c))
    return out


def _two_batches(fn, snap):
    first = fn(snap.filter(F.col("load_seq") % 2 == 0), None)
    return fn(snap, first)


@query("scd2_creative")
def q_scd2_creative(spark, sf):
    snap = fx.creative_snapshot(spark, sf)
    return finish(_epoch(_two_batches(S2.scd2_creative, snap)))


@query("scd2_creative_asset")
def q_scd2_creative_asset(spark, sf):
    snap = fx.creative_snapshot(spark, sf)
    return finish(_epoch(_two_batches(S2.scd2_creative_asset, snap)))


@query("scd2_bridge_ad_creative")
def q_scd2_bridge_ad_creative(spark, sf):
    snap = fx.creative_snapshot(spark, sf)
    return finish(_two_batches(S2.scd2_bridge_ad_creative, snap))


def _stored_batches(spark, sf, name):
    """The same two loads as above through a stored history that only touched key buckets are rewritten of."""
    snap, path = fx.creative_snapshot(spark, sf), _shared(spark, name)
    S2.refresh_history(spark, name, snap.filter(F.col("load_seq") % 2 == 0), path, buckets=8)
    S2.refresh_history(spark, name, snap, path, buckets=8)
    return finish(_epoch(spark.read.parquet(path).drop(S2.BUCKET)))


for _name in S2.KEYS:
    query(f"{_name}_stored")(lambda spark, sf, name=_name: _stored_batches(spark, sf, name))


# ------------------------------------------------------------------ sheets
from adlake.sources import sheets as SH  # noqa: E402


#: Columns (folders) of which each pair of values is one sheet.
SHEET = ("branch_id", "year")


def _write_sheets(spark, sf):
    """CSV sheets a branch and year (spend, impressions, clicks, CR) landed in the shared folder.

    Rows come from the external-sheet view, in order-key order within a sheet; some rows are
    short, have a blank channel, an unparsable date or a ` 0:00:00` suffix. All rows of a
    date are in one sheet, so the last of a key is the last in order-key order.
    """
    base = _shared(spark, "sheets")
    e = fx.external_raw(spark, sf).withColumn("year", F.year("date"))
    k = F.col("okey")
    date_txt = (F.when(k % 31 == 0, F.lit("n/a"))
                 .when(k % 2 == 0, F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" 0:00:00")))
                 .otherwise(F.date_format("date", "yyyy-MM-dd")))
    code = F.when(k % 29 == 0, F.lit("")).otherwise(F.col("channel_code"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))  # noqa: E731 - cells with commas are quoted
    spend = quoted(F.concat(F.lit("$"), F.format_number(F.col("spend_usd_micros") / F.lit(1e6), 2)))
    paths = {}
    for name, header, cells, short_mod in [
        ("spend", "DATE,CD_MKT_CHANNEL,SPEND", [spend], 23),
        ("impressions", "DATE,CD_MKT_CHANNEL,IMPRESSIONS", [quoted(F.format_number(F.col("impressions"), 0))], 23),
        ("clicks", "DATE,CD_MKT_CHANNEL,CLICKS", [F.col("clicks").cast("string")], 37),
        ("cr", "DATE,CD_MKT_CHANNEL,MXP_TRANSACTIONS,MXP_PLAN_VIEWS,CR",
         [F.col("transactions").cast("string"), F.col("plan_views").cast("string"),
          F.concat(F.format_number(F.col("transactions") * 100 / (F.col("plan_views") + 1), 1), F.lit("%"))], 19),
    ]:
        line = F.when(k % short_mod == 0, F.concat_ws(",", date_txt, code)).otherwise(
            F.concat_ws(",", date_txt, code, *cells))
        rows = e.withColumn("okey", F.col("order_key")).select(*SHEET, "okey", line.alias("value"))
        heads = rows.select(*SHEET).distinct().select(*SHEET, F.lit(-1).cast("bigint").alias("okey"), F.lit(header).alias("value"))
        path = f"{base}/{name}"
        (rows.unionByName(heads).repartition(*SHEET).sortWithinPartitions(*SHEET, "okey")
             .select(*SHEET, "value").write.partitionBy(*SHEET).text(path))
        paths[name] = path
    return paths


@query("read_metric_sheet")
def q_read_metric_sheet(spark, sf):
    p = _write_sheets(spark, sf)
    return SH.read_metric_sheet(spark, p["spend"]).drop("__idx", "year")


@query("read_cr_sheet")
def q_read_cr_sheet(spark, sf):
    p = _write_sheets(spark, sf)
    return SH.read_cr_sheet(spark, p["cr"]).drop("__idx", "year")


@query("combine_metric_sheets")
def q_combine_metric_sheets(spark, sf):
    p = _write_sheets(spark, sf)
    return SH.combine_metric_sheets(SH.read_metric_sheet(spark, p["spend"]), SH.read_metric_sheet(spark, p["impressions"]),
                                    SH.read_metric_sheet(spark, p["clicks"]), SH.read_cr_sheet(spark, p["cr"]))


@query("run_history")
def q_run_history(spark, sf):
    from adlake.operators.runlog import run_history
    log = fx.view(spark, sf, "fx_run_log").withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    out = run_history(log, _dt.date(2024, 1, 25))
    return finish(out.withColumn("started_epoch", F.unix_timestamp("started_at"))
                     .withColumn("ended_epoch", F.unix_timestamp("ended_at")))
