"""MERGE semantics as DataFrame functions: upsert, insert-if-absent, backfill.

Each function returns the new state of the target; writing it back is the job
of :mod:`adlake.sources.io` (partition overwrite of the window only).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.functions.columns import blank_key
from adlake.session import Window


class DuplicateSourceKeys(ValueError):
    """A MERGE source has more than one row for a target key."""


def _key_exprs(df: DataFrame, keys: Sequence[str], blank_keys: Sequence[str]) -> list[Column]:
    return [blank_key(df[k]) if k in blank_keys else df[k] for k in keys]


def duplicate_keys(source: DataFrame, keys: Sequence[str], blank_keys: Sequence[str] = ()) -> DataFrame:
    """Keys that occur more than once in ``source`` (a MERGE would fail on them)."""
    ks = _key_exprs(source, keys, blank_keys)
    return (source.groupBy(*[k.alias(n) for k, n in zip(ks, keys)])
                  .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def assert_unique_source(source: DataFrame, keys: Sequence[str], blank_keys: Sequence[str] = ()) -> None:
    """Raise :class:`DuplicateSourceKeys` when a key has several source rows."""
    if duplicate_keys(source, keys, blank_keys).limit(1).count() > 0:
        raise DuplicateSourceKeys(f"MERGE source has duplicate keys on {list(keys)}")


#: Start of the error that a job raises when one of its MERGE keys has several source rows.
DUPLICATE_MATCH = "MERGE must match at most one source row per key"


def unique_by(source: DataFrame, key: Sequence[str], shown: Sequence[str]) -> DataFrame:
    """``source`` with a check in its plan: the job that reads it fails when ``key`` (columns) repeats.

    The count runs in the partitioning and order that a sort-merge join on ``key`` needs, so a
    MERGE gets it without a shuffle or sort of its own.
    """
    n = F.count(F.lit(1)).over(W.partitionBy(*key))
    text = F.concat(F.lit(f"{DUPLICATE_MATCH}: "), F.to_json(F.struct(*[F.col(c) for c in shown])))
    return source.withColumn("__n", n).withColumn("__s", F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))).drop("__n")


def merge_key(keys: Sequence[str], blank_keys: Sequence[str], prefix: str) -> Column:
    """The keys as one comparable value: blank keys as ``IFNULL(k, '')``, null equal to null."""
    return F.struct(*[(blank_key(F.col(f"{prefix}{k}")) if k in blank_keys else F.col(f"{prefix}{k}")).alias(f"k{i}")
                      for i, k in enumerate(keys)])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], blank_keys: Sequence[str] = (),
           keep_if_null: Sequence[str] = (), keep_old_first: Sequence[str] = (), least: Sequence[str] = (),
           greatest: Sequence[str] = (), window: Window | None = None, date_col: str | None = None,
           strict_keys: bool = False, update_cols: Sequence[str] | None = None, dealt: Sequence[str] = ()) -> DataFrame:
    """MERGE ``source`` into ``target`` and return the new target.

    Matching is on ``keys`` (``blank_keys`` compared as ``IFNULL(k, '')``;
    other keys null-safe unless ``strict_keys``, which reproduces plain ``=``
    where NULL keys never match and are inserted again). Only target rows with
    ``date_col`` inside ``window`` can match; the rest pass through unchanged.
    Matched rows take the source value, except ``keep_if_null``
    (``COALESCE(s, t)``), ``keep_old_first`` (``COALESCE(t, s)``), ``least``
    and ``greatest`` (NULL-safe: a NULL side is ignored). Columns not in
    ``update_cols`` (when given) keep the target value.

    A key with several source rows fails the job that computes the result
    (``DUPLICATE_MATCH``), before anything is written; rows that cannot match
    (NULL in a strict key) are exempt and all inserted. Repeated target rows
    of a key are each updated.

    ``dealt`` names plain keys that both sides have been dealt by already: rows that have them are
    matched where they are (see ``share_shuffles``), rows with a NULL in one are merged by themselves.
    """
    cols = target.columns
    src = source.select(*[F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
                          for c in cols])
    if not set(dealt) <= set(keys) - set(blank_keys):
        raise ValueError(f"rows can be dealt by keys that are compared as they are only, not by {list(dealt)}")
    merge = partial(_merge, keys=keys, blank_keys=blank_keys, keep_if_null=keep_if_null, keep_old_first=keep_old_first, least=least,
                    greatest=greatest, window=window, date_col=date_col, strict_keys=strict_keys, update_cols=update_cols)
    if not dealt:
        return merge(target, src)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in dealt])
    return merge(target.filter(known), src.filter(known), dealt=dealt).unionByName(merge(target.filter(~known), src.filter(~known)))


def _merge(target: DataFrame, src: DataFrame, keys, blank_keys, keep_if_null, keep_old_first, least, greatest, window, date_col, strict_keys,
           update_cols, dealt: Sequence[str] = ()) -> DataFrame:
    """``upsert`` of a source with the target's columns, in which no row has a NULL in a key of ``dealt``."""
    cols = target.columns
    untouched = []
    if window is not None and date_col is not None:
        inside = window.contains(F.col(date_col))
        untouched.append(target.filter(~inside | F.col(date_col).isNull()))
        target = target.filter(inside)
    plain = [k for k in keys if k not in blank_keys] if strict_keys else []
    if plain:  # a NULL in a plain key never matches: no join, and no task that gathers such rows
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in plain])
        untouched += [target.filter(~known), src.filter(~known)]
        target, src = target.filter(known), src.filter(known)
    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in cols], F.lit(True).alias("__t"))
    s = src.select(*[F.col(c).alias(f"__s_{c}") for c in cols])
    rest = [k for k in keys if k not in dealt]
    t = t.withColumn("__tk", merge_key(rest, blank_keys, "__t_") if rest else F.lit(0))
    s = s.withColumn("__sk", merge_key(rest, blank_keys, "__s_") if rest else F.lit(0))
    s = unique_by(s, [*(f"__s_{k}" for k in dealt), "__sk"], [f"__s_{k}" for k in keys])
    j = t.join(s, on=[*(F.col(f"__t_{k}") == F.col(f"__s_{k}") for k in dealt), F.col("__tk") == F.col("__sk")], how="full_outer")
    matched = F.col("__t").isNotNull() & F.col("__s").isNotNull()
    out = []
    for c in cols:
        tc, sc = F.col(f"__t_{c}"), F.col(f"__s_{c}")
        if c in keys:
            v = F.when(F.col("__t").isNotNull(), tc).otherwise(sc)
            if c in keep_if_null:
                v = F.when(matched, F.coalesce(sc, tc)).otherwise(v)
        else:
            if update_cols is not None and c not in update_cols:
                upd = tc
            elif c in keep_if_null:
                upd = F.coalesce(sc, tc)
            elif c in keep_old_first:
                upd = F.coalesce(tc, sc)
            elif c in least:
                upd = F.least(tc, sc)
            elif c in greatest:
                upd = F.greatest(tc, sc)
            else:
                upd = sc
            v = F.when(matched, upd).when(F.col("__s").isNotNull(), sc).otherwise(tc)
        out.append(v.alias(c))
    merged = j.select(*out)
    for rest in untouched:
        merged = merged.unionByName(rest)
    return merged


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE with an insert branch only: add source rows whose key is new."""
    src = source.select(*target.columns)
    new = src.join(target.select(*keys), on=[src[k].eqNullSafe(target[k]) for k in keys], how="left_anti")
    return target.unionByName(new)


def backfill_anti(legacy: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Legacy rows to copy: those with no target row equal on ``keys``.

    Plain ``=`` as the reference's NOT EXISTS: a legacy row with a NULL key
    never finds a match and is always copied.
    """
    t = target.select(*[F.col(k).alias(f"__b_{k}") for k in keys])
    return legacy.join(t, on=[legacy[k] == t[f"__b_{k}"] for k in keys], how="left_anti")


def replace_range(target: DataFrame, rows: DataFrame, date_col: str, start, end, account_col: str,
                  accounts: Sequence[str]) -> DataFrame:
    """Idempotent reload: drop target rows in [start, end] for the accounts, add ``rows``.

    Accounts are trimmed, deduplicated and sorted; an empty account list is an
    error. An empty payload changes nothing (the reference returns before the
    delete). Deletion covers every listed account, even one with no new rows.
    """
    accts = sorted({a.strip() for a in accounts if a is not None and a.strip()})
    if not accts:
        raise ValueError("replace_range needs at least one account")
    if rows.isEmpty():
        return target
    doomed = F.col(date_col).between(F.lit(start), F.lit(end)) & F.col(account_col).isin(accts)
    keep = target.filter(~doomed | F.col(date_col).isNull() | F.col(account_col).isNull())
    return keep.unionByName(rows.select(*target.columns))


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Plain append (duplicates are removed later by latest-wins reads)."""
    return target.unionByName(rows.select(*target.columns))


def delete_window(target: DataFrame, date_col: str, window: Window, pred: Column | None = None) -> DataFrame:
    """Delete rows in the window (optionally only those matching ``pred``)."""
    doomed = window.contains(date_col)
    if pred is not None:
        doomed = doomed & pred
    return target.filter(~doomed | doomed.isNull())


def purge_before(target: DataFrame, date_col: str, cutoff) -> DataFrame:
    """Retention: keep rows dated on or after ``cutoff``."""
    return target.filter(~(F.col(date_col) < F.lit(cutoff)) | F.col(date_col).isNull())
