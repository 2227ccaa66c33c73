"""Latest-wins, effective-dated segments and keyword rules."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adlake.operators.dedup import latest_by
from adlake.operators.joins import dyadic_ranges, keyword_rank, resolve_effective_segments
from adlake.operators import core

D = dt.date


def test_latest_by_blank_keys_and_tiebreak(spark):
    df = spark.createDataFrame([("a", None, 1, 1), ("a", "", 1, 2), ("a", "x", 5, 0)],
                               "k string, g string, ts int, tie int")
    out = sorted(latest_by(df, ["k", "g"], ["ts"], ["tie"], blank_keys=["g"]).collect())
    assert [(r.g, r.tie) for r in out] == [("", 2), ("x", 0)]


def test_segments_resolve_overlap_newest_start(spark):
    m = spark.createDataFrame([
        ("a", "B1", D(2020, 1, 1), D(2020, 6, 30), True, 1),
        ("a", "B2", D(2020, 3, 1), None, True, 1),
        ("a", "B3", D(2020, 1, 1), None, False, 9),
    ], "k string, branch_id string, effective_start_date date, effective_end_date date, is_active boolean, u int")
    seg = resolve_effective_segments(m, ["k"], ["branch_id"], priority=["effective_start_date", "u"])
    got = sorted((r.seg_start, r.seg_end, r.branch_id) for r in seg.collect())
    assert got == [(D(2020, 1, 1), D(2020, 2, 29), "B1"), (D(2020, 3, 1), D(2020, 6, 30), "B2"),
                   (D(2020, 7, 1), D(9999, 12, 31), "B2")]


def brute_best(rows, key, day):
    live = [(r[2] or D(1, 1, 1), r[5], r[1]) for r in rows if r[0] == key and r[4] and r[2] is not None and r[2] <= day <= (r[3] or D(9999, 12, 31))]
    return max(live)[2] if live else None


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("single", [True, False])
def test_segments_equal_brute_force_on_every_day(spark, seed, single):
    rng, base = random.Random(seed), D(1969, 12, 1)
    rows = []
    for k in ("a", "b", None):
        for i in range(25):
            s = base + dt.timedelta(days=rng.randrange(90))
            rows.append((k, f"B{i}", s, rng.choice([None, s + dt.timedelta(days=rng.randrange(-2, 40))]), rng.random() < 0.9, i))
    rows += [("c", "X", D(1, 1, 1), D(1, 1, 2), True, 0), ("c", "Y", D(9999, 12, 30), D(9999, 12, 31), True, 0), ("d", "Z", None, None, True, 0)]
    m = spark.createDataFrame(rows, "k string, branch_id string, effective_start_date date, effective_end_date date, is_active boolean, u int")
    seg = resolve_effective_segments(m.coalesce(1) if single else m.repartition(5), ["k"], ["branch_id"], priority=["effective_start_date", "u"]).collect()
    for k in ("a", "b", "c", "d"):
        own = sorted((r.seg_start, r.seg_end, r.branch_id) for r in seg if r.k == k)
        assert all(x[1] < y[0] for x, y in zip(own, own[1:]))
        for day in [base + dt.timedelta(days=i) for i in range(-3, 140)] + [D(1, 1, 1), D(1, 1, 3), D(9999, 12, 30), D(9999, 12, 31)]:
            got = [b for s, e, b in own if s <= day <= e]
            assert got == ([brute_best(rows, k, day)] if brute_best(rows, k, day) else []), (k, day)


def test_dyadic_ranges_tile_the_interval(spark):
    rng = random.Random(4)
    wide = (329_414, 3_981_472)  # the first and last day of SQL dates
    pairs = [(0, 0), (5, 4), wide] + [tuple(sorted(rng.sample(range(1 << 12), 2))) for _ in range(40)]
    rows = spark.createDataFrame(pairs, "f int, l int").select("f", "l", dyadic_ranges(F.col("f"), F.col("l")).alias("r")).collect()
    for f, l, r in rows:
        days = [d for x in r for d in range(x.place << x.level, (x.place + 1) << x.level)]
        assert sorted(days) == list(range(f, l + 1))
        assert len(r) <= 44


def test_many_mappings_of_one_key_make_no_pairs(spark):
    n = 100_000
    m = spark.range(n).select(F.lit("hot").alias("k"), F.concat(F.lit("B"), F.col("id")).alias("branch_id"), F.lit(True).alias("is_active"),
                              F.date_add(F.lit(D(1900, 1, 1)), (F.col("id") % 40000).cast("int")).alias("effective_start_date"), F.col("id").alias("u"))
    m = m.withColumn("effective_end_date", F.date_add("effective_start_date", (F.col("u") % 20000).cast("int")))
    seg = resolve_effective_segments(m, ["k"], ["branch_id"], priority=["u"])
    assert "Join" not in seg._jdf.queryExecution().optimizedPlan().toString()
    assert seg.count() <= 2 * n
    got = {r.seg_start: r.branch_id for r in seg.where("seg_start BETWEEN '1950-01-01' AND '1950-01-10'").collect()}
    for day, branch in got.items():
        k = (day - D(1900, 1, 1)).days
        live = [u for u in range(n) if u % 40000 <= k <= u % 40000 + u % 20000]
        assert branch == f"B{max(live)}"


def test_segments_are_built_once_and_handed_in(spark):
    amap = spark.createDataFrame([("META", "1", "V1", D(2020, 1, 1), None, True, None)],
                                 "channel_key string, account_id_norm string, branch_id string, effective_start_date date, "
                                 "effective_end_date date, is_active boolean, updated_at timestamp")
    seg = core.account_segments(amap)
    assert core.account_segments(seg) is seg and seg.small
    assert "Exchange" not in seg.rows._jdf.queryExecution().executedPlan().toString()
    facts = spark.createDataFrame([("META", "1", D(2021, 1, 1))], "channel_key string, account_id_norm string, stat_date date")
    assert core.branch_by_account(facts, seg, "stat_date").first().branch_id == core.branch_by_account(facts, amap, "stat_date").first().branch_id == "V1"


def test_branch_by_account_unknown_and_inactive(spark):
    amap = spark.createDataFrame([
        ("META", "1", "V1", D(2020, 1, 1), D(2020, 1, 31), True, None),
        ("META", "2", "V2", D(2020, 1, 1), None, False, None),
    ], "channel_key string, account_id_norm string, branch_id string, effective_start_date date, "
       "effective_end_date date, is_active boolean, updated_at timestamp")
    facts = spark.createDataFrame([("META", "1", D(2020, 1, 15)), ("META", "1", D(2020, 2, 1)),
                                   ("META", "2", D(2020, 1, 15)), ("META", "3", D(2020, 1, 15))],
                                  "channel_key string, account_id_norm string, stat_date date")
    out = core.branch_by_account(facts, amap, "stat_date")
    got = sorted((r.account_id_norm, str(r.stat_date), r.branch_id) for r in out.collect())
    assert got == [("1", "2020-01-15", "V1"), ("1", "2020-02-01", "UNKNOWN"),
                   ("2", "2020-01-15", "UNKNOWN"), ("3", "2020-01-15", "UNKNOWN")]


def test_keyword_rank_priority_then_length(spark):
    rules = spark.createDataFrame([
        ("R1", "V1", "red", 11, True, None), ("R2", "V2", "red ring", 11, True, None),
        ("R3", "V3", "ring", 5, False, None), ("R4", "V4", "plate", 10, True, None),
    ], "rule_id string, branch_id string, match_keyword string, priority int, is_active boolean, "
       "updated_at timestamp")
    names = spark.createDataFrame([("Red Ring",), ("red plate",), ("blue",), (None,)], "n string")
    out = core.branch_by_rule(names, rules, "n")
    got = {r.n: r.branch_id for r in out.collect()}
    assert got == {"Red Ring": "V2", "red plate": "V4", "blue": "UNKNOWN", None: "UNKNOWN"}


def _rules(spark, n, seed=0):
    rng = random.Random(seed)
    words = ["ab", "a", "rä", "ring", "red", "blue ring", "%_x", "ümlaut"]
    rows = [(f"R{i:06d}", f"V{i % 17}", words[i] if i < len(words) else "".join(rng.choices("abcdering ", k=rng.randrange(1, 9))).strip() or "q",
             rng.choice([None, 1, 2, 3]), rng.random() < 0.9, dt.datetime(2024, 1, 1 + i % 28)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "rule_id string, branch_id string, match_keyword string, priority int, is_active boolean, updated_at timestamp")


def _brute_rule(rows, name):
    live = [(p is None, -(p or 0), len(k), u, i, b) for i, b, k, p, a, u in rows if a and k and k.lower() in (name or "").lower()]
    return max(live)[-1] if live else "UNKNOWN"


@pytest.mark.parametrize("n", [0, 10, 64, 65, 2000, 100_000])
def test_rules_match_alike_at_every_number(spark, n):
    rng = random.Random(n)
    rows, rules = _rules(spark, n)
    names = ["Red Ring", "RÄ", "", None, "a", "x", "100%_x", "blue ring of ümlauts"] + ["".join(rng.choices("abcderingXYZ ", k=rng.randrange(1, 30))) for _ in range(60)]
    df = spark.createDataFrame([(x,) for x in names], "n string")
    got = {r.n: r.branch_id for r in core.branch_by_rule(df, rules, "n").collect()}
    assert got == {x: _brute_rule(rows, x) for x in names}


def test_no_long_case_in_the_plan(spark):
    _, rules = _rules(spark, 2000)
    plan = core.branch_by_rule(spark.createDataFrame([("a",)], "n string"), rules, "n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN") < 20 and "Cartesian" not in plan and "instr" not in plan


def test_campaign_days_are_dealt_once(spark):
    """Staged rows go through fact keys and keyword rules without another shuffle; long rule lists give the same branches."""
    from adlake.operators import joins, staging
    from adlake.session import ALL_TIME
    day, ts = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1)
    rows = [(ch, "1", camp, g, n, ad, None, day, 1, 1, 1, 1.0, 1, "t", ts) for ch, camp, g, n, ad in (
        ("NAVER_ADS", "c", "g", "red one", "a"), ("NAVER_ADS", "c", "g", "blue", "b"), ("NAVER_ADS", None, "g", "red", "a"),
        ("NAVER_ADS", "c", None, "blue", "a"), ("NAVER_ADS", "c", "", "none", "b"), ("META", "c", "g", "red", "a"), (None, "c", "g", "red", "a"))]
    stg = spark.createDataFrame(rows, "channel_key string, account_id_norm string, campaign_id string, ad_group_id string, ad_group_name string, "
                                "ad_id string, currency_code string, stat_date date, impressions long, clicks long, spend_micros long, "
                                "conversion_count double, conversion_value_micros long, source_table string, load_ts timestamp")
    accounts = spark.createDataFrame([("META", "1", "V9", day, None, True, ts)], "channel_key string, account_id_norm string, branch_id string, "
                                     "effective_start_date date, effective_end_date date, is_active boolean, updated_at timestamp")
    branches = spark.createDataFrame([("V1", "EUR")], "branch_id string, currency string")
    some = [("R1", "V1", "red", 1, True, ts), ("R2", "V2", "BLUE", 2, True, ts)]
    filler = [(f"F{i}", "V5", f"zz{i:05d}x", 9, True, ts) for i in range(joins.RULE_CASE_MAX)]
    found = []
    for rules in (some, some + filler):
        r = spark.createDataFrame(rules, "rule_id string, branch_id string, match_keyword string, priority int, is_active boolean, updated_at timestamp")
        fact = core.fact_marketing(stg.repartition(*staging.PERF_DEALT), accounts, r, branches, ALL_TIME)
        found.append(sorted((x.channel_key, x.campaign_id or "", x.ad_group_id or "", x.ad_id, x.branch_id) for x in fact.collect()))
        if rules is some:
            assert fact._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin") == 0
            assert fact._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 2
    assert found[0] == found[1] == sorted([
        ("META", "c", "g", "a", "V9"), ("NAVER_ADS", "", "g", "a", "UNKNOWN"), ("NAVER_ADS", "c", "", "a", "V2"), ("NAVER_ADS", "c", "", "b", "V2"),
        ("NAVER_ADS", "c", "g", "a", "V1"), ("NAVER_ADS", "c", "g", "b", "V1")])
