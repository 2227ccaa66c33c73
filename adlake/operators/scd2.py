"""Slowly changing dimensions (type 2) rebuilt from change points.

The reference closes the current row and inserts every differing staged row,
comparing staged rows only with the current version; with several days in one
window that yields several current rows. Here the existing history and the
staged snapshots are merged per key, ordered by validity start, and only rows
whose change value differs from the previous version are kept; one ``lead``
sets the end (next start minus one second, or minus one day for date grain).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.functions.columns import blank_key, nonblank
from adlake.operators.dedup import latest_by
from adlake.sources import io


def scd2(staged: DataFrame, history: DataFrame | None, keys: Sequence[str], change: str | Column,
         valid_from: str, valid_to: str, attrs: Sequence[str], order: Sequence[str] = ("load_ts",),
         grain: str = "second") -> DataFrame:
    """New full history for ``keys`` from ``staged`` snapshots and ``history``.

    ``staged`` is first collapsed to one row per key and validity start (the
    latest load wins, ties go to the greater change value, then attributes), so a key's history holds at most one row per start:
    the per-key window is bounded by the number of distinct starts, not by
    the number of loads. Existing versions keep their start; a staged row
    with the same start replaces it. ``change`` compares with NULL as ``''``.
    """
    chg = F.col(change) if isinstance(change, str) else change
    cols = list(keys) + [valid_from] + list(attrs)
    s = staged.withColumn("__chg", blank_key(chg)).withColumn("__src", F.lit(1))
    s = latest_by(s, list(keys) + [valid_from], [*order, "__chg"], [a for a in attrs if a not in order], hashed=True)
    s = s.select(*cols, "__chg", "__src")
    if history is not None:
        h = history.withColumn("__chg", blank_key(chg)).withColumn("__src", F.lit(0)).select(*cols, "__chg", "__src")
        s = latest_by(s.unionByName(h), list(keys) + [valid_from], ["__src"], hashed=True)
    # The hash leads the sort: keys that begin with a channel are alike in their first column.
    s = s.withColumn("__kh", F.hash(*keys))
    w = W.partitionBy("__kh", *keys).orderBy(valid_from)
    s = s.withColumn("__prev", F.lag("__chg").over(w))
    s = s.filter(F.col("__prev").isNull() | (F.col("__prev") != F.col("__chg")))
    nxt = F.lead(valid_from).over(w)
    end = nxt - F.expr("INTERVAL 1 SECOND") if grain == "second" else F.date_sub(nxt, 1)
    return (s.withColumn(valid_to, end).withColumn("is_current", nxt.isNull())
             .drop("__chg", "__src", "__prev", "__kh"))


def asset_fingerprint(url="asset_url", video="video_id", image_hash="image_hash", thumb="thumbnail_url") -> Column:
    """First non-blank of url, video, hash, thumbnail (blank is not a value)."""
    return F.coalesce(nonblank(url), nonblank(video), nonblank(image_hash), nonblank(thumb))


#: Keys of each dimension's history.
KEYS = {
    "scd2_creative": ["channel_key", "account_id_norm", "creative_id"],
    "scd2_creative_asset": ["channel_key", "account_id_norm", "creative_id", "asset_type", "asset_seq"],
    "scd2_bridge_ad_creative": ["channel_key", "account_id_norm", "ad_id"],
}
BUCKET = "key_bucket"


def incremental(fn: Callable[[DataFrame, DataFrame | None], DataFrame], staged: DataFrame, history: DataFrame,
                keys: Sequence[str]) -> DataFrame:
    """``fn(staged, history)``, but only keys that ``staged`` has are chained anew.

    A key's versions depend on its own rows alone, so the history of all other keys passes through
    as it is. Keys compare null-safely.
    """
    touched = staged.select(*[F.col(k).alias(f"__t_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__t_{k}")) for k in keys]
    new = fn(staged, history.join(touched, same, "left_semi"))
    return new.unionByName(history.join(touched, same, "left_anti").select(*new.columns))


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Partition of a key's whole history."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def refresh_history(spark: SparkSession, name: str, staged: DataFrame, path: str, buckets: int = 256) -> list[int]:
    """Bring a stored history up to date with a load; returns the partitions it read and wrote.

    The history of ``name`` (one of ``KEYS``) is kept by key bucket, a key's versions together. A
    load reads the buckets its keys fall into, chains those keys anew and swaps these partitions,
    all or nothing; the others are neither read nor written. Choose ``buckets`` well above the
    keys of a day's load over the size of a partition; it must not change for a stored table. An
    empty load changes nothing, and the same load again gives the same table.
    """
    fn, keys = globals()[name], KEYS[name]
    spec = io.TableSpec(name, BUCKET, cluster_by=tuple(keys), require_partition_filter=False)
    io.recover(spark, path)
    touched = sorted(r[0] for r in staged.select(key_bucket(keys, buckets).alias("b")).distinct().collect())  # at most ``buckets``
    if not touched:
        return []
    if not io.path_exists(spark, path):
        new, old = fn(staged, None), []
    else:
        stored = spark.read.parquet(path).filter(F.col(BUCKET).isin(touched))
        old = sorted(r[0] for r in stored.select(BUCKET).distinct().collect())
        new = incremental(fn, staged, stored.drop(BUCKET), keys)
    io.swap_partitions(spark, new.withColumn(BUCKET, key_bucket(keys, buckets)), path, spec, old)
    return touched


def scd2_creative(snapshot: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Creative versions keyed by (channel, account, creative), change = content hash.

    One row per creative and day first (the reference keys omit the ad, so
    several ads of one creative would otherwise compete).
    """
    attrs = ["creative_name", "body_text", "headline", "description_text", "call_to_action", "thumbnail_url", "content_hash", "load_ts"]
    return scd2(snapshot, history, KEYS["scd2_creative"], "content_hash",
                "valid_from_ts", "valid_to_ts", attrs)


def scd2_creative_asset(assets: DataFrame, history: DataFrame | None = None) -> DataFrame:
    attrs = ["asset_url", "video_id", "image_hash", "thumbnail_url", "width", "height", "duration_sec", "load_ts"]
    a = assets.withColumn("asset_fingerprint", asset_fingerprint())
    h = None if history is None else history.withColumn("asset_fingerprint", asset_fingerprint())
    out = scd2(a, h, KEYS["scd2_creative_asset"], "asset_fingerprint",
               "valid_from_ts", "valid_to_ts", attrs)
    return out


def scd2_bridge_ad_creative(snapshot: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Ad -> creative mapping by day; a new creative id opens a new version."""
    s = snapshot.withColumn("valid_from_date", F.to_date("valid_from_ts"))
    h = history
    return scd2(s, h, KEYS["scd2_bridge_ad_creative"], "creative_id", "valid_from_date",
                "valid_to_date", ["creative_id", "load_ts"], grain="day")
