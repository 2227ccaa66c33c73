"""Marts kept by month and the two-level web rollup."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlake.operators import staging
from adlake.plans import semantic as SQ
from adlake.session import Window

SCHEMA = "report_date date, branch_id string, currency_code string, orders long, net_revenue_native_micros long, gross_revenue_native_micros long"
YEAR = Window.of("2024-01-01", "2024-12-31")
Q = {"measures": ["Orders.orders"], "dimensions": ["Orders.branchId"],
     "timeDimensions": [{"dimension": "Orders.reportDate", "dateRange": ["2024-02-10", "2024-03-05"]}]}


def mart(spark, orders=1):
    return spark.createDataFrame([(dt.date(2024, m, d), "B1", "USD", orders, 0, 0) for m in range(1, 7) for d in (1, 5, 10, 28)], SCHEMA)


def plan(spark, path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    try:
        return SQ.semantic_query(Q, {"Orders": SQ.stored_mart(spark, path)}, dt.date(2024, 6, 1))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_range_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "m")
    SQ.refresh_mart(spark, "Orders", mart(spark), path, YEAR)
    pruned = plan(spark, path).split("PartitionFilters: [")[1].split("], ")[0]
    assert "report_month" in pruned and "2024-02-01" in pruned and "2024-03-01" in pruned
    got = SQ.semantic_query(Q, {"Orders": SQ.stored_mart(spark, path)}, dt.date(2024, 6, 1)).collect()
    assert [tuple(r) for r in got] == [("B1", 4)]  # 10 and 28 February, 1 and 5 March


def test_a_refresh_window_replaces_its_months_only(spark, tmp_path):
    path = str(tmp_path / "m")
    SQ.refresh_mart(spark, "Orders", mart(spark), path, YEAR)
    SQ.refresh_mart(spark, "Orders", mart(spark, 10), path, Window.of("2024-03-01", "2024-03-31"))
    by_month = {r[0].month: r[1] for r in SQ.stored_mart(spark, path).groupBy("report_month").agg(F.sum("orders")).collect()}
    assert by_month == {1: 4, 2: 4, 3: 40, 4: 4, 5: 4, 6: 4}
    SQ.refresh_mart(spark, "Orders", mart(spark).limit(0), path, Window.of("2024-06-01", "2024-06-30"))
    assert SQ.stored_mart(spark, path).where("report_month = '2024-06-01'").count() == 0
    with pytest.raises(ValueError, match="whole months"):
        SQ.refresh_mart(spark, "Orders", mart(spark), path, Window.of("2024-03-02", "2024-03-31"))


def test_web_rollup_counts_exactly_without_expand(spark):
    day = dt.date(2024, 1, 1)
    rows = [(day, "p", "g", None, "c", "view", f"u{i % 5}" if i % 7 else None, f"s{i % 11}" if i % 3 else None) for i in range(200)]
    rows += [(day, "hot", None, None, None, "view", f"u{i}", f"s{i // 2}") for i in range(500)]
    rows += [(day, "none", "x", "y", "z", "view", None, None)] * 3
    ga4 = spark.createDataFrame(rows, "event_date date, property_id string, source string, medium string, campaign string, event_name string, "
                                      "user_pseudo_id string, session_id string")
    ga4 = ga4.withColumns({"source_extract_ts": F.lit(None).cast("timestamp"), "ingestion_ts": F.lit(None).cast("timestamp")})
    out = staging.stg_web_event(ga4, YEAR, "2024-02-01 00:00:00")
    want = {}
    for r in rows:
        u, s, n = want.setdefault(r[:6], (set(), set(), [0]))
        u.add(r[6])
        s.add(r[7])
        n[0] += 1
    got = {tuple(r)[:6]: (r["users"], r["sessions"], r["event_count"]) for r in out.collect()}
    assert got == {k: (len(u - {None}), len(s - {None}), n[0]) for k, (u, s, n) in want.items()}
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
