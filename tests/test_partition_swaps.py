"""Journalled partition swaps: a killed job leaves the old or the new window."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from adlake.operators import reload
from adlake.session import Window
from adlake.sources import io

SPEC = io.TableSpec("swap", "d", cluster_by=("a",))
W = Window.of("2024-01-01", "2024-01-10")
DAYS = [dt.date(2024, 1, k) for k in (1, 2, 3)]


def table(spark, tmp_path, extra=()):
    path = str(tmp_path / "t")
    rows = [("A", d, 1) for d in DAYS] + [("B", d, 2) for d in DAYS[1:]] + [("A", dt.date(2024, 2, 1), 9), *extra]
    io.append_table(spark.createDataFrame(rows, "a string, d date, v int"), path, SPEC)
    return path


def state(spark, path):
    return sorted(tuple(r) for r in io.read_table(spark, path, SPEC, Window.of("1999-01-01", "2099-01-01")).select("a", "d", "v").collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


class Killed(BaseException):
    pass


def new_rows(spark):
    return spark.createDataFrame([("A", DAYS[0], 100), ("B", DAYS[1], 2)], "a string, d date, v int")


OLD_OUTSIDE = [("A", dt.date(2024, 2, 1), 9)]
NEW = sorted([("A", DAYS[0], 100), ("B", DAYS[1], 2)] + OLD_OUTSIDE)


def test_window_write_replaces_and_empties(spark, tmp_path):
    path = table(spark, tmp_path)
    io.write_window(spark, new_rows(spark), path, SPEC, W)
    assert state(spark, path) == NEW
    assert not os.path.exists(f"{path}/d=2024-01-03") and io.pending_swaps(spark, path) == []


@pytest.mark.parametrize("moment", ["stage", "journal", "overwrite", "first_delete", "unjournal"])
def test_kill_at_any_moment_leaves_old_or_new(spark, tmp_path, monkeypatch, moment):
    path = table(spark, tmp_path, [("C", dt.date(2024, 1, 4), 5)])
    before = state(spark, path)
    remove, write, apply = io.remove_path, io._write_text, io._apply_swap
    dead = []

    def killed(*a, **k):
        dead.append(True)
        raise Killed

    def remove_once(spark_, p):  # the clean-up of a dead process doesn't run either
        if dead:
            return None
        if moment == "overwrite" and "d=" in p or moment == "unjournal" and p.endswith(".json"):
            killed()
        remove(spark_, p)
        if moment == "first_delete" and "d=" in p:
            killed()

    monkeypatch.setattr(io, "remove_path", remove_once)
    if moment == "stage":
        monkeypatch.setattr(io, "_write_text", killed)
    if moment == "journal":
        monkeypatch.setattr(io, "_apply_swap", killed)
    with pytest.raises(Killed):
        io.write_window(spark, new_rows(spark), path, SPEC, W)
    monkeypatch.setattr(io, "remove_path", remove)
    monkeypatch.setattr(io, "_write_text", write)
    monkeypatch.setattr(io, "_apply_swap", apply)
    assert state(spark, path) == (before if moment == "stage" else NEW)
    assert io.pending_swaps(spark, path) == []


def test_a_half_written_journal_counts_as_none(spark, tmp_path):
    path = table(spark, tmp_path)
    before = state(spark, path)
    os.makedirs(f"{path}/_journal")
    open(f"{path}/_journal/2024.json.part", "w").write("{")
    assert io.recover(spark, path) == 0 and state(spark, path) == before


def test_failed_job_leaves_no_staged_files(spark, tmp_path):
    path = table(spark, tmp_path)
    before, folder = state(spark, path), io.checkpoint_dir(spark).removeprefix("file://")
    staged = set(os.listdir(folder))
    bad = new_rows(spark).withColumn("v", F.when(F.col("v") > 50, F.raise_error(F.lit("boom")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="boom"):
        io.write_window(spark, bad, path, SPEC, W)
    assert state(spark, path) == before and set(os.listdir(folder)) == staged


def test_reload_range(spark, tmp_path):
    path = table(spark, tmp_path)
    rows = spark.createDataFrame([("A", DAYS[2], 7)], "a string, d date, v int")
    for _ in range(2):  # again gives the same
        reload.reload_range(spark, rows, path, SPEC, W, "a", [" A ", "A", "Z"])
        assert state(spark, path) == sorted([("A", DAYS[2], 7), ("B", DAYS[1], 2), ("B", DAYS[2], 2)] + OLD_OUTSIDE)
    before = state(spark, path)
    reload.reload_range(spark, rows.limit(0), path, SPEC, W, "a", ["A"])
    assert state(spark, path) == before
    with pytest.raises(ValueError, match="at least one account"):
        reload.reload_range(spark, rows, path, SPEC, W, "a", [" "])
    with pytest.raises(Exception, match="outside the window"):
        reload.reload_range(spark, rows.withColumn("d", F.lit(dt.date(2025, 1, 1))), path, SPEC, W, "a", ["A"])
    assert state(spark, path) == before


def test_one_account_map_change_rewrites_only_its_dates(spark, tmp_path):
    spec = io.TableSpec("fact", "stat_date", cluster_by=("channel_key",))
    days = [dt.date(2024, 3, k) for k in range(1, 9)]
    rows = [("META", acct, None, "c", "g", d, "V1" if acct == "1" else "UNKNOWN") for d in days for acct in ("1", "2") if acct == "1" or d.day in (3, 5)]
    schema = "channel_key string, account_id_norm string, ad_id string, campaign_id string, ad_group_id string, stat_date date, branch_id string"
    path = str(tmp_path / "fact")
    io.append_table(spark.createDataFrame(rows, schema), path, spec)
    amap = "channel_key string, account_id_norm string, branch_id string, effective_start_date date, effective_end_date date, is_active boolean, updated_at timestamp"
    known = [("META", "1", "V1", dt.date(2020, 1, 1), None, True, None)]
    rules = spark.createDataFrame([], "rule_id string, branch_id string, match_keyword string, priority int, is_active boolean, updated_at timestamp")
    w = Window.of("2024-03-01", "2024-03-31")
    before = files(path)
    assert reload.enrich_stored_fact(spark, path, spec, spark.createDataFrame(known, amap), rules, w) == []
    assert files(path) == before
    changed = spark.createDataFrame([*known, ("META", "2", "V2", dt.date(2020, 1, 1), None, True, None)], amap)
    dates = reload.enrich_stored_fact(spark, path, spec, changed, rules, w)
    assert dates == [dt.date(2024, 3, 3), dt.date(2024, 3, 5)]
    after = files(path)
    moved = {f for f in before if f not in after} | {f for f in after if after[f] != before.get(f)}
    assert moved and all("stat_date=2024-03-03" in f or "stat_date=2024-03-05" in f for f in moved)
    got = {(r["account_id_norm"], r["branch_id"]) for r in io.read_table(spark, path, spec, w).collect()}
    assert got == {("1", "V1"), ("2", "V2")}
    assert io.read_table(spark, path, spec, w).count() == len(rows)
    assert reload.enrich_stored_fact(spark, path, spec, changed, rules, w) == []
