"""Query-usage accounting over a job log and the app's query log."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.session import Window

FREE_TIER_BYTES = 1024 ** 4
DEFAULT_QUERY_BYTES = 10 * 1024 ** 2


def _root_jobs(job_log: DataFrame, w: Window) -> DataFrame:
    """Finished root query jobs created in [start, end + 1 day)."""
    start = _dt.datetime.combine(w.start, _dt.time())
    end = _dt.datetime.combine(w.end + _dt.timedelta(days=1), _dt.time())
    return job_log.filter((F.col("creation_time") >= F.lit(start)) & (F.col("creation_time") < F.lit(end))
                          & (F.col("job_type") == "QUERY") & (F.col("state") == "DONE")
                          & F.col("parent_job_id").isNull())


def _gib(c):
    return F.round(c / F.lit(float(1024 ** 3)), 6)


def usage_by_user(job_log: DataFrame, w: Window) -> DataFrame:
    j = _root_jobs(job_log, w)
    return (j.groupBy("region", "user_email")
             .agg(F.count(F.lit(1)).alias("root_jobs"), F.sum("total_bytes_billed").alias("billed_bytes"))
             .withColumn("billed_gib", _gib(F.col("billed_bytes")))
             .orderBy(F.col("billed_bytes").desc()))


def workload_class():
    # The workload names and the statement texts they are told by.
    q, t = F.col("query"), F.col("statement_type")
    return (F.when(q.like("CALL `%ops.sp_load_all`%"), "warehouse_call_sp_load_all")
             .when(q.like("CALL `%ops.sp_load_%"), "warehouse_other_proc_calls")
             .when(q.rlike(r"BEGIN\s+TRANSACTION;\s*DELETE\s+FROM `.*\.raw_ads\."), "raw_idempotent_load_script")
             .when(t == "SELECT", "ad_hoc_select").when(t == "SCRIPT", "other_script")
             .otherwise(F.coalesce(t, F.lit("UNKNOWN"))))


def usage_by_workload(job_log: DataFrame, w: Window, n: int | None = None) -> DataFrame:
    """Workload classes by region and billed bytes; with ``n`` the top ``n`` of each region."""
    j = _root_jobs(job_log, w).withColumn("workload", workload_class())
    out = (j.groupBy("region", "workload")
            .agg(F.count(F.lit(1)).alias("root_jobs"), F.sum("total_bytes_billed").alias("billed_bytes"))
            .withColumn("billed_gib", _gib(F.col("billed_bytes"))))
    if n is None:
        return out
    rank = F.row_number().over(W.partitionBy("region").orderBy(F.col("billed_bytes").desc(), "workload"))
    return out.withColumn("__rk", rank).filter(F.col("__rk") <= n).drop("__rk")


def usage_free_tier(job_log: DataFrame, w: Window) -> DataFrame:
    """Root billed bytes over all regions as a percent of the 1 TiB free tier."""
    j = _root_jobs(job_log, w)
    return (j.agg(F.coalesce(F.sum("total_bytes_billed"), F.lit(0)).alias("root_billed_bytes_total"))
             .withColumn("free_tier_percent", F.col("root_billed_bytes_total") / F.lit(float(FREE_TIER_BYTES)) * 100))


def usage_level(ratio):
    return (F.when(ratio >= 0.95, "blocked").when(ratio >= 0.85, "caution")
             .when(ratio >= 0.7, "warning").otherwise("ok"))


def usage_month_state(query_log: DataFrame, now: _dt.datetime, budget: int = FREE_TIER_BYTES) -> DataFrame:
    """This UTC month's bytes (actual else estimated, blocked excluded) vs budget."""
    start = _dt.datetime(now.year, now.month, 1)
    end = _dt.datetime(now.year + (now.month == 12), now.month % 12 + 1, 1)
    q = query_log.filter((F.col("created_at") >= F.lit(start)) & (F.col("created_at") < F.lit(end))
                         & ~F.col("status").eqNullSafe(F.lit("blocked")))
    used = F.coalesce(F.sum(F.coalesce("actual_bytes", "estimated_bytes")), F.lit(0)).cast("bigint")
    ratio = (F.col("used_bytes") / F.lit(float(budget))) if budget > 0 else F.lit(1.0)
    return (q.agg(used.alias("used_bytes")).withColumn("budget_bytes", F.lit(budget).cast("bigint"))
             .withColumn("__ratio", ratio)
             .withColumn("percent", F.least(F.lit(100.0), F.floor(F.col("__ratio") * 1000 + 0.5) / 10))
             .withColumn("level", usage_level(F.col("__ratio")))
             .withColumn("blocked", F.col("level") == "blocked").drop("__ratio"))


def usage_estimate(query_log: DataFrame, base_bytes: int = DEFAULT_QUERY_BYTES) -> DataFrame:
    """Estimated bytes: base x ceil(days / 30); 30 days unless a date pair is given."""
    f, t = F.try_to_date(F.col("date_from"), "yyyy-MM-dd"), F.try_to_date(F.col("date_to"), "yyyy-MM-dd")
    days = F.when(f.isNotNull() & t.isNotNull(), F.greatest(F.lit(1), F.datediff(t, f) + 1)).otherwise(F.lit(30))
    return query_log.withColumn("range_days", days).withColumn(
        "estimated_query_bytes", F.lit(base_bytes) * F.greatest(F.lit(1), F.ceil(F.col("range_days") / 30)))
