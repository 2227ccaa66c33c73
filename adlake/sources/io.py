"""Typed loads and partition-level writes.

Tables are Parquet folders partitioned by their date column. Writes replace
only the partitions a load touches (dynamic partition overwrite), staged first
under the session's checkpoint folder because a path cannot be overwritten
while it is being read, and journalled beside the table so that a killed job
leaves the old or the new window.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adlake.session import Window, checkpoint_dir


class MissingPartitionFilter(ValueError):
    """A partitioned fact table was read without a date bound."""


class EmptyLoad(ValueError):
    """A guarded full overwrite received zero rows."""


@dataclass(frozen=True)
class TableSpec:
    """Physical layout of a warehouse table."""

    name: str
    date_col: str
    cluster_by: Sequence[str] = ()
    keys: Sequence[str] = ()
    blank_keys: Sequence[str] = ()
    require_partition_filter: bool = True
    ttl_days: int | None = None
    extra: dict = field(default_factory=dict)


def load_json_typed(spark: SparkSession, path: str, schema: StructType,
                    corrupt_col: str = "_corrupt_record") -> DataFrame:
    """JSON lines read under the target's declared schema (never inferred).

    Malformed lines are kept with their text in ``corrupt_col`` (PERMISSIVE).
    """
    s = schema
    if corrupt_col not in schema.fieldNames():
        s = StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])
    return (spark.read.schema(s).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_col).json(path))


def scan_window(df: DataFrame, date_col: str, window: Window | None) -> DataFrame:
    """Read of a partitioned fact: a date bound is mandatory (partition pruning)."""
    if window is None:
        raise MissingPartitionFilter(f"a window on {date_col} is required")
    return df.filter(window.contains(date_col))


def read_table(spark: SparkSession, path: str, spec: TableSpec, window: Window | None = None) -> DataFrame:
    recover(spark, path)
    df = spark.read.parquet(path)
    if spec.require_partition_filter:
        return scan_window(df, spec.date_col, window)
    return df if window is None else df.filter(window.contains(spec.date_col))


def ensure_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Add missing columns as typed NULLs and order columns as declared.

    Columns the schema does not know are kept at the end (additive evolution).
    """
    have = set(df.columns)
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c not in set(schema.fieldNames())]
    return df.select(*cols, *extra)


def layout(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cluster rows for writing: one range shuffle by date and cluster keys, then sorted.

    Rows of a date land in neighbouring tasks (a large date in several) and are sorted, so Parquet row-group min/max
    statistics prune well on the cluster columns.
    """
    out = df.repartitionByRange(F.col(spec.date_col), *spec.cluster_by)
    if spec.cluster_by:
        out = out.sortWithinPartitions(spec.date_col, *spec.cluster_by)
    return out


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table's folder is there; errors of the file system are raised, not taken for no."""
    p, fs = _fs(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of staged files."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def _existing_dates(spark: SparkSession, path: str, spec: TableSpec, window: Window) -> list[_dt.date]:
    if not path_exists(spark, path):
        return []
    p, fs = _fs(spark, path)
    if not any(s.getPath().getName().startswith(f"{spec.date_col}=") for s in fs.listStatus(p)):
        return []  # a table without any partition yet
    cur = spark.read.parquet(path)
    return [r[0] for r in cur.filter(window.contains(spec.date_col)).select(spec.date_col).distinct().collect()]


JOURNAL = "_journal"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it, so it is there whole or not at all."""
    p, fs = _fs(spark, f"{path}.part")
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(p, _fs(spark, path)[0]):
        raise OSError(f"could not write {path}")


def pending_swaps(spark: SparkSession, path: str) -> list[str]:
    """Journal entries of partition swaps of the table at ``path`` that have not ended, oldest first."""
    p, fs = _fs(spark, f"{path.rstrip('/')}/{JOURNAL}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return [f"{path.rstrip('/')}/{JOURNAL}/{n}" for n in sorted(names) if n.endswith(".json")]


def _apply_swap(spark: SparkSession, path: str, entry: str) -> None:
    """Carry out one journal entry from its staged copy; doing it again gives the same table."""
    todo = json.loads(spark.read.text(entry, wholetext=True).first()[0])
    if todo["dates"]:
        staged = spark.read.schema(StructType.fromJson(todo["schema"])).parquet(todo["stage"])
        (staged.sortWithinPartitions(todo["date_col"], *todo["cluster_by"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(todo["date_col"]).parquet(path))
    for d in todo["gone"]:
        remove_path(spark, f"{path.rstrip('/')}/{todo['date_col']}={d}")
    remove_path(spark, entry)  # from here on the swap is done
    remove_path(spark, todo["stage"])


def recover(spark: SparkSession, path: str) -> int:
    """Finish the partition swaps that an earlier job began and did not end; returns their number.

    Readers and writers of a table call this first: whatever the moment of a kill, they see the
    old window (nothing was journalled yet) or the new one.
    """
    entries = pending_swaps(spark, path)
    for entry in entries:
        _apply_swap(spark, path, entry)
    return len(entries)


def swap_partitions(spark: SparkSession, rows: DataFrame, path: str, spec: TableSpec, old_values: Sequence) -> None:
    """Replace the partitions ``old_values`` and those that ``rows`` has with ``rows``, all or nothing.

    ``rows`` may read the table itself: it is staged in the shared folder, laid out as it will be
    written. Then a journal entry beside the table names the staged copy, the partitions to
    replace and those left empty; from that moment the new state holds, and a job that dies while
    it replaces them is finished by :func:`recover`.
    """
    stage = f"{checkpoint_dir(spark).rstrip('/')}/stage-{spec.name}-{uuid.uuid4().hex}"
    try:
        layout(rows, spec).write.mode("overwrite").parquet(stage)
        staged = spark.read.schema(rows.schema).parquet(stage)
        dates = {r[0] for r in staged.select(spec.date_col).distinct().collect()}  # one row a partition
        todo = {"stage": stage, "date_col": spec.date_col, "cluster_by": list(spec.cluster_by), "dates": sorted(map(str, dates)),
                "gone": sorted(map(str, set(old_values) - dates)), "schema": json.loads(rows.schema.json())}
        entry = f"{path.rstrip('/')}/{JOURNAL}/{_dt.datetime.now(_dt.timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex}.json"
        _write_text(spark, entry, json.dumps(todo))
    except BaseException:
        remove_path(spark, stage)  # nothing was journalled, the old state holds
        raise
    _apply_swap(spark, path, entry)


def write_window(spark: SparkSession, new_state: DataFrame, path: str, spec: TableSpec,
                 window: Window) -> None:
    """Replace the window's partitions of the table at ``path`` with ``new_state``, all or nothing.

    ``new_state`` may read the table itself (it usually does: a MERGE). Partitions of the window
    that end up empty are removed. A swap that an earlier job left unfinished is finished first.
    """
    recover(spark, path)
    swap_partitions(spark, new_state.filter(window.contains(spec.date_col)), path, spec, _existing_dates(spark, path, spec, window))


def rewrite_partitions(spark: SparkSession, new_state: DataFrame, path: str, spec: TableSpec, values: Sequence) -> None:
    """Replace just the listed partitions with ``new_state``, all or nothing; the others are neither read nor written.

    ``new_state`` should read the table partition by partition, so that the values reach its scan.
    """
    recover(spark, path)
    if values:
        swap_partitions(spark, new_state.filter(F.col(spec.date_col).isin(sorted(values))), path, spec, values)


def truncate_load_guarded(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Full overwrite that refuses an empty input (keeps the old table)."""
    if rows.isEmpty():
        raise EmptyLoad(f"refusing to overwrite {path} with zero rows")
    rows.write.mode("overwrite").parquet(path)


def append_table(rows: DataFrame, path: str, spec: TableSpec) -> None:
    """Append landed rows; an empty payload writes nothing."""
    if rows.isEmpty():
        return
    recover(rows.sparkSession, path)
    layout(rows, spec).write.mode("append").partitionBy(spec.date_col).parquet(path)


def purge_partitions_before(spark: SparkSession, path: str, spec: TableSpec, cutoff: _dt.date) -> int:
    """Retention by partition: delete date partitions older than ``cutoff``."""
    if not path_exists(spark, path):
        return 0
    recover(spark, path)
    cur = spark.read.parquet(path)
    old = [r[0] for r in cur.filter(F.col(spec.date_col) < F.lit(cutoff)).select(spec.date_col).distinct().collect()]
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for d in old:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{spec.date_col}={d.isoformat()}")
        p.getFileSystem(conf).delete(p, True)
    return len(old)


def partition_ttl(spark: SparkSession, path: str, spec: TableSpec, today: _dt.date) -> int:
    """Expire partitions older than ``spec.ttl_days`` (staging keeps 45 days)."""
    if not spec.ttl_days:
        return 0
    return purge_partitions_before(spark, path, spec, today - _dt.timedelta(days=spec.ttl_days))
