"""Near-duplicate documents by SimHash fingerprints with pigeonring candidate pruning.

Fingerprint: the bitwise majority over the XXH64 hashes of all word shingles of the whole
text. Two fingerprints link when at most ``max_distance`` of their 64 bits differ.

Candidates: the bits form a ring of ``segments`` equal boxes. If a pair differs in at most t
bits, some box starts a chain in which, for every length l, the first l boxes together differ
in at most floor(l * t / segments) bits (pigeonring principle). The leading boxes whose budget
is zero must agree exactly, so they are an equi-join key; the later budgets prune the joined
pairs; the full Hamming distance decides.

Skew: exact copies collapse to one distinct fingerprint before any join. A key shared by more
than ``bucket_limit`` distinct fingerprints (a large family of near copies) is not paired
directly: the chain's one-error run is added to the key with one bit masked in turn, so at
most 2 ** (1 + free bits) fingerprints share a refined key, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from adlake.llm.common import materialize, numbered, slices, texts
from adlake.llm.components import connected_components

BITS = 64
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str, shingle_words: int) -> int:
    """SimHash of one whole text (signed 64-bit); no word at all gives zero."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = (end - length)[:n].tolist()
    end = end[len(words) - n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(start, end)], dtype="<u8")
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp) for every row; null or empty text gives fp 0. Repeated rows stay repeated."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _fingerprinted(rows, "text", "fp", shingle_words, [0])


def _fingerprinted(docs: DataFrame, text_col: str, name: str, shingle_words: int, kept: list[int]) -> DataFrame:
    """The columns of ``docs`` at the places ``kept`` and the fingerprint of each row's text."""
    fields = [docs.schema.fields[k] for k in kept]
    names = [f.name for f in fields] + [name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            fp = pa.array([fingerprint(t, shingle_words) for t in texts(part, text_col)], pa.int64())
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), fp], names)

    return docs.mapInArrow(run, StructType([*fields, StructField(name, LongType())]))


def _hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _rotated(fp: Column, bits: int) -> Column:
    return fp if bits == 0 else F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, BITS - bits))


def _run_length(segments: int, t: int, errors: int) -> int:
    """Most leading boxes of a chain that together may differ in at most ``errors`` bits."""
    return max(l for l in range(segments + 1) if l * t // segments <= errors)


def _close(a: Column, b: Column, segments: int, t: int) -> Column:
    """Chain budgets from the start box on, then the full Hamming distance."""
    width, x = BITS // segments, a.bitwiseXOR(b)
    ok = F.bit_count(x) <= t
    for errors in range(t):
        ok = (F.bit_count(F.shiftrightunsigned(x, BITS - width * _run_length(segments, t, errors))) <= errors) & ok
    return ok


def links(distinct_fps: DataFrame, max_distance: int = 2, segments: int = 16, bucket_limit: int = 256) -> DataFrame:
    """All pairs (u < v) of distinct fingerprints (column ``fp``) within ``max_distance`` bits."""
    if not 1 <= max_distance < segments or BITS % segments:
        raise ValueError("needs 1 <= max_distance < segments and segments dividing 64")
    t, width = max_distance, BITS // segments
    zero = width * _run_length(segments, t, 0)
    one = width * _run_length(segments, t, 1)
    ring = F.array(*[F.struct(F.lit(s).alias("s"), _rotated(F.col("fp"), s * width).alias("r")) for s in range(segments)])
    rows = distinct_fps.select("fp", F.explode(ring).alias("x")).select(
        "fp", F.col("x.s").alias("s"), F.col("x.r").alias("r"), F.shiftrightunsigned("x.r", BITS - zero).alias("key"))
    sizes = rows.groupBy("s", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(rows.join(sizes, ["s", "key"]).select("fp", "s", "r", "key", "n"), "simhash-shared")
    plain = shared.where(F.col("n") <= bucket_limit).select("fp", "s", "r", F.lit(-1).alias("m"), "key")
    masks = F.array(*[F.lit(m) for m in range(one - zero)])
    dense = (
        shared.where(F.col("n") > bucket_limit).select("fp", "s", "r", F.explode(masks).alias("m"))
        .withColumn("key", F.expr(f"shiftrightunsigned(r, {BITS - one}) & ~shiftleft(1L, m)")))
    keyed = plain.unionByName(dense)
    a, b = keyed.alias("a"), keyed.alias("b")
    pairs = a.join(b, (F.col("a.s") == F.col("b.s")) & (F.col("a.m") == F.col("b.m")) & (F.col("a.key") == F.col("b.key"))
                   & (F.col("a.fp") < F.col("b.fp")) & _close(F.col("a.r"), F.col("b.r"), segments, t))
    return pairs.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    max_distance: int = 2, segments: int = 16, bucket_limit: int = 256) -> DataFrame:
    """(doc_id, fingerprint, component_id, group_fingerprint) for every row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest doc_id reachable
    over links, the row's own included; ``group_fingerprint`` a fingerprint of the component, the
    same for all its rows, which names it also where no row has an id. Rows without a word have fingerprint zero and link like
    any other; null text counts as empty. Repeated rows each get a row. A null doc_id is kept
    and never becomes a component_id unless its whole component has no other id. An empty table
    gives no rows; other columns of ``docs`` are ignored.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle_words), "simhash-fp")
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    roots = connected_components(links(classes.select("fp"), max_distance, segments, bucket_limit))
    linked = classes.join(roots, classes["fp"] == roots["vertex"])
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = linked.join(smallest, "root").select("fp", "root", F.col("component_id").alias("linked_id"))
    whole = classes.join(named, "fp", "left").select(
        "fp", F.coalesce("linked_id", "first_id").alias("component_id"), F.coalesce("root", "fp").alias("group"))
    return fps.join(whole, "fp").select("doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id", _hex(F.col("group")).alias("group_fingerprint"))


def keep_one_per_group(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of ``near_duplicates``, all columns.

    It is the row whose doc_id is the component_id; rows that repeat that id keep one copy a group, the
    first by text. A group without any doc_id keeps its first row by text. The rows of such a group, and
    those of an id that occurs in several groups, are found by their fingerprints, made again with
    ``shingle_words``. Any column names may occur in ``docs``.
    """
    rows, (i, text) = numbered(docs, id_col, text_col)
    named = groups.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("head")).agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("first"),
        (F.min("group_fingerprint") < F.max("group_fingerprint")).alias("several")).where("first").drop("first")
    found = rows.join(named, F.col(i) == F.col("head"))
    named = _first(found.where("NOT several"), "head", text).select(*rows.columns)

    heads = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("head"), "fingerprint", "group_fingerprint").distinct()
    several = _fingerprinted(found.where("several"), text, "fp", shingle_words, list(range(len(rows.columns))))
    several = several.join(heads, (F.col(i) == F.col("head")) & (_hex(F.col("fp")) == F.col("fingerprint")))
    several = _first(several, "group_fingerprint", text, "fp").select(*rows.columns)

    without = _fingerprinted(rows.where(F.col(i).isNull()), text, "fp", shingle_words, list(range(len(rows.columns))))
    nameless = groups.where("doc_id IS NULL AND component_id IS NULL").select("fingerprint", "group_fingerprint").distinct()
    without = _first(without, "fp", text).join(nameless, _hex(F.col("fp")) == F.col("fingerprint"))
    without = _first(without, "group_fingerprint", text, "fp").select(*rows.columns)
    return named.unionByName(several).unionByName(without).toDF(*docs.columns)


def _first(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key; only one a key and map task is shuffled."""
    return rows.withColumn("nth", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("nth = 1").drop("nth")
