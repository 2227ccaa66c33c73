"""Jobs that rewrite part of a stored fact: idempotent range reloads and branch enrichment."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.core import enrich_branch
from adlake.operators.upsert import replace_range
from adlake.session import Window
from adlake.sources import io


def reload_range(spark: SparkSession, rows: DataFrame, path: str, spec: io.TableSpec, w: Window, account_col: str,
                 accounts: Sequence[str]) -> None:
    """Delete the accounts' rows of the window from the stored table and add ``rows``, all or nothing.

    Only the window's partitions are read and written. An empty payload changes nothing; an empty
    account list is an error. A row outside the window, or without a date, is an error that fails
    the job before anything is written, since a reload could not replace it later.
    """
    if not [a for a in accounts if a is not None and a.strip()]:
        raise ValueError("replace_range needs at least one account")
    io.recover(spark, path)
    inside = F.coalesce(w.contains(spec.date_col), F.lit(False))
    late = F.raise_error(F.concat(F.lit("reload_range: row outside the window, "), F.coalesce(F.col(spec.date_col).cast("string"), F.lit("no date"))))
    rows = rows.filter(F.when(inside, F.lit(True)).otherwise(late.cast("boolean")))
    if not io.path_exists(spark, path):
        io.append_table(rows, path, spec)
        return
    if rows.isEmpty():
        return
    table = io.read_table(spark, path, spec, w)
    io.write_window(spark, replace_range(table, rows, spec.date_col, w.start, w.end, account_col, accounts), path, spec, w)


def changed_dates(enriched: DataFrame, date_col: str) -> list[_dt.date]:
    """Partitions that hold a row whose branch moved."""
    return sorted(r[0] for r in enriched.filter("branch_changed").select(date_col).distinct().collect())  # one row a partition


def enrich_stored_fact(spark: SparkSession, path: str, spec: io.TableSpec, account_map: DataFrame, rules: DataFrame, w: Window,
                       naver_rows: DataFrame | None = None) -> list[_dt.date]:
    """Bring the branches of a stored fact up to date; rewrites only partitions with a change and returns their dates.

    The first job reads the columns that decide a branch and finds the changed dates; the second
    reads and writes those partitions alone, all or nothing.
    """
    fact = io.read_table(spark, path, spec, w)
    dates = changed_dates(enrich_branch(fact, account_map, rules, w, naver_rows, spec.date_col), spec.date_col)
    if dates:
        some = fact.filter(F.col(spec.date_col).isin(dates))
        names = None if naver_rows is None else naver_rows.filter(F.col(spec.date_col).isin(dates))
        io.rewrite_partitions(spark, enrich_branch(some, account_map, rules, w, names, spec.date_col).drop("branch_changed"), path, spec, dates)
    return dates
