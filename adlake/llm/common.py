"""Helpers shared by the text operators: table reads, scratch tables, bounded Arrow slices.

Scratch tables are written below the folder the session names in ``spark.checkpoint.dir``,
so every executor sees them and a lost executor only re-reads files. They are removed when
the Python process ends.
"""

from __future__ import annotations

import atexit
import contextlib
import json
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import checkpoint_dir

#: Text of one slice handled at a time inside a task.
SLICE_BYTES = 2_000_000

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended already
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of executions inside are deleted as soon as each has ended."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/adlake-llm/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    with shuffles_freed(spark):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


def discard(table: DataFrame) -> None:
    """Remove a table of ``materialize`` that nothing reads any more."""
    _remove(table.sparkSession, table._scratch)


def among(df: DataFrame, ids: list, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``df`` with one of ``ids``, a list of bounded length."""
    kind = df.schema[id_col].dataType.simpleString()
    wanted = df.sparkSession.range(1).select(F.explode(F.from_json(F.lit(json.dumps(ids)), f"array<{kind}>")).alias(id_col))
    return df.join(F.broadcast(wanted), id_col, "left_semi")


def numbered(docs: DataFrame, *cols: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns renamed to c0, c1, ... (no name clashes then), and what ``cols`` are called in it."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), [names[docs.columns.index(c)] for c in cols]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes in each piece (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.cast(pc.binary_length(batch.column(column)), pa.int64()), 0).to_numpy(zero_copy_only=False)
        part = size.cumsum() // limit
        start = 0
        for end in [*((part[1:] != part[:-1]).nonzero()[0] + 1).tolist(), batch.num_rows]:
            yield batch.slice(start, end - start)
            start = end


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a slice, null read as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


#: A text without a match has only code points below U+0300: no combining marks, Latin letters.
BEYOND_LATIN = re.compile("[\u0300-\U0010ffff]")


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of a Unicode pattern with \\p{L}, \\p{N} and \\s.

    Texts below U+0300 go through an equal pattern of the standard library with the classes
    written out, which is about twice as fast.
    """
    whole = regex.compile(pattern).findall
    classes = {c: "".join(re.escape(chr(k)) for k in range(0x300) if regex.match(c, chr(k))) for c in (r"\p{L}", r"\p{N}", r"\s")}
    out, inside, i = [], False, 0
    while i < len(pattern):
        c = next((c for c in classes if pattern.startswith(c, i)), None)
        if c:
            out.append(classes[c] if inside else f"[{classes[c]}]")
        elif pattern.startswith(r"\S", i) and not inside:
            c = r"\S"
            out.append(f"[^{classes[chr(92) + 's']}]")
        else:
            c = pattern[i:i + 2] if pattern[i] == "\\" else pattern[i]
            inside = c == "[" or inside and c != "]"
            out.append(c)
        i += len(c)
    latin, beyond = re.compile("".join(out)).findall, BEYOND_LATIN.search
    return lambda text: whole(text) if beyond(text) else latin(text)
