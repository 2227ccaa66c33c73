"""Session construction, load windows and the shared checkpoint folder."""

from __future__ import annotations

import datetime as _dt
import os
import tempfile
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Window:
    """Inclusive date window ``[start, end]`` a load procedure works on."""

    start: _dt.date
    end: _dt.date

    @staticmethod
    def of(start: str | _dt.date, end: str | _dt.date) -> "Window":
        s = _dt.date.fromisoformat(start) if isinstance(start, str) else start
        e = _dt.date.fromisoformat(end) if isinstance(end, str) else end
        if e < s:
            raise ValueError(f"window end {e} is before start {s}")
        return Window(s, e)

    def contains(self, col: str | Column) -> Column:
        c = F.col(col) if isinstance(col, str) else col
        return c.between(F.lit(self.start), F.lit(self.end))


# Covers every date in the driver tables; used when an operator must run over
# whole tables.
ALL_TIME = Window(_dt.date(1900, 1, 1), _dt.date(2199, 12, 31))


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "adlake") -> SparkSession:
    """Build (or reuse) a session tuned for the warehouse workload.

    AQE re-plans joins and coalesces shuffle partitions at runtime and splits
    skewed join partitions; the session time zone is pinned to UTC because all
    warehouse timestamps are UTC instants.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def share_shuffles(spark: SparkSession) -> None:
    """Let joins use the partitions rows are in when these are made by some of the join's keys.

    Facts dealt by account join by account, campaign or ad; by default Spark would deal them anew for
    each of these joins.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset in
    local mode (tests) a private scratch folder is created and registered. On a
    cluster an unset folder is an error: executors don't share local disks.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="adlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
