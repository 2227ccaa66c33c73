"""Rows are dealt once for the steps that follow, and inputs read once are not landed first."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlake.operators import joins
from adlake.operators import upsert as U
from adlake.plans.registry import QUERIES
from adlake.session import share_shuffles
from adlake.sources import fixtures as fx

DAY = dt.datetime(1996, 5, 6)
TABLES = {
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                 "l_tax double, l_shipdate timestamp",
                 [(k, p, s, n, 2.0, 3.0, 0.1, 0.02, DAY) for k, p, s, n in (
                     (1, 11, 5, 1), (1, 14, 6, 3), (2, 51, 5, 2), (3, 15, 6, 3), (3, 15, 6, 3), (4, 11, 5, 4), (5, 14, 7, 5), (6, 11, None, 4), (6, 12, 6, 7))]),
    "part": ("p_partkey long, p_name string", [(11, "red ring"), (12, "plate"), (14, "hot"), (15, "ring"), (51, "bolt")]),
    "supplier": ("s_suppkey long", [(5,), (6,), (7,)]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(k, f"N{k}", k % 5) for k in range(12)]),
    "customer": ("c_custkey long, c_nationkey int, c_mktsegment string", [(1, 2, "BUILDING")]),
    "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double", [(k, 1, DAY, 7.0) for k in range(1, 7)]),
    "events": ("event_id long, user_id long, event_type string, ts timestamp, value double",
               [(k, k % 3, "purchase", dt.datetime(2024, 1, 20), 1.5) for k in range(1, 9)]),
    "documents": ("doc_id long, text string, lang string, source string, n_chars long", [(3, "some text", "en", "src1", 9)]),
    "labels": ("doc_id long, quality int, toxic int", [(3, 1, 0)])}


@pytest.fixture
def sf(spark, tmp_path):
    for t in fx.BASE_TABLES:
        schema, data = TABLES.get(t, ("none int", []))
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{t}.parquet"))
    fx._REGISTERED.clear()
    yield str(tmp_path)
    fx._REGISTERED.clear()


def plan(spark, df):
    """Lines of the physical plan, made without broadcasts by size, each with the lines above it that deal rows out for their step."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        text = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out, path = [], []
    for line in text.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [x for x in path if x[0] < depth]
        out.append((line, [x for _, x in path]))
        if "Exchange hashpartitioning(" in line and "ENSURE_REQUIREMENTS" in line:
            path.append((depth, line))
    return out


def dealt(lines):
    """Lines that deal rows out where the code asks for it, with the shuffles above them."""
    return [(line, above) for line, above in lines if "REPARTITION_BY_COL" in line]


def rows(df):
    return sorted(map(str, df.collect()))


def without_small_maps(spark, sf, monkeypatch, name):
    """The query as it is where the account map is too large to be broadcast."""
    from adlake.plans import catalog
    monkeypatch.setattr(joins.fits, "__defaults__", (0,))
    catalog._CTX.clear()
    try:
        return QUERIES[name](spark, sf)
    finally:
        catalog._CTX.clear()


@pytest.mark.parametrize("name", ["fact_campaign_daily", "mart_campaign_daily", "mart_ad_daily", "enrich_branch"])
def test_facts_of_many_accounts_are_dealt_once(spark, sf, monkeypatch, name):
    """No shuffle follows that of the staged rows: the account map, names and purchases come to where the facts are."""
    want = rows(QUERIES[name](spark, sf))
    df = without_small_maps(spark, sf, monkeypatch, name)
    staged = dealt(plan(spark, df))
    assert staged and not [above for _, above in staged if above]
    assert want and rows(df) == want


def test_campaign_sums_need_no_shuffle_of_their_own(spark, sf):
    """With a small account map rows lie by campaign and day; only the names join deals the sums out again."""
    staged = dealt(plan(spark, QUERIES["fact_campaign_daily"](spark, sf)))
    assert staged and all(len(above) == 1 and "campaign_id" in above[0] for _, above in staged)


def test_inputs_of_the_blended_mart_are_not_landed(spark, sf, monkeypatch):
    landed = []
    real = fx._land
    monkeypatch.setattr(fx, "_land", lambda spark, sf, name, df: landed.append(name) or real(spark, sf, name, df))
    got = rows(QUERIES["mart_blended_daily"](spark, sf))
    assert len(got) and not landed


def test_a_history_of_staged_creatives_deals_them_once(spark, sf):
    df = QUERIES["scd2_creative_from_staging"](spark, sf)
    staged = dealt(plan(spark, df))
    assert len(staged) == 1 and "creative_id" in staged[0][0] and not staged[0][1]
    assert {r.content_hash for r in df.collect()} and all(len(r.content_hash) == 64 and r.content_hash == r.content_hash.lower() for r in df.collect())


SCHEMA = "k string, g string, n string, v int"


def test_dealt_rows_are_merged_where_they_are(spark):
    share_shuffles(spark)
    t = spark.createDataFrame([("1", "a", None, 1), ("1", None, "x", 2), (None, "a", "x", 3), ("2", "b", None, 4)], SCHEMA).repartition("k")
    s = spark.createDataFrame([("1", "a", "", 10), ("1", None, "x", 20), (None, "a", "x", 30), (None, None, "x", 40), ("3", None, None, 50)], SCHEMA).repartition("k")
    out = U.upsert(t, s, ["k", "g", "n"], blank_keys=["n"], dealt=["k"])
    assert rows(out) == rows(U.upsert(t, s, ["k", "g", "n"], blank_keys=["n"]))
    assert len(rows(out)) == 6
    found = dealt(plan(spark, out))  # rows without the key they are dealt by are merged by themselves
    assert len(found) == 4 and [len(above) for _, above in found] == [0, 0, 1, 1]


def test_repeated_source_keys_of_dealt_rows_fail_the_job(spark):
    t = spark.createDataFrame([("1", "a", "x", 1)], SCHEMA)
    for twice in ([("1", "a", "x", 2)] * 2, [(None, "a", "x", 2)] * 2):
        with pytest.raises(Exception, match=U.DUPLICATE_MATCH):
            U.upsert(t, spark.createDataFrame(twice, SCHEMA), ["k", "g", "n"], blank_keys=["n"], dealt=["k"]).collect()
    same = spark.createDataFrame([("1", "a", None, 5), ("1", "a", "", 6)], SCHEMA)
    with pytest.raises(ValueError, match="dealt"):
        U.upsert(t, same, ["k", "g", "n"], blank_keys=["n"], dealt=["n"])
    assert rows(U.upsert(t, t.withColumn("v", F.lit(9)), ["k"], dealt=["k"])) == rows(t.withColumn("v", F.lit(9)))
