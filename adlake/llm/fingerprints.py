"""Bottom-k sketches of word-shingle hashes, as DataFrame expressions.

A sketch is the sorted array of the k smallest distinct 64-bit hashes of a text's word
shingles. Sketches of parts merge into the sketch of the whole; two sketches estimate
resemblance and containment, one estimates the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from adlake.llm.common import materialize

K = 64
SHINGLE_WORDS = 5
#: Ids in one bucket of the neighbour search; it bounds what a window partition can hold.
BUCKET_IDS = 1000


def words(text: Column) -> Column:
    """Lower-cased words between ASCII white space."""
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def sketch(words_col: str, k: int = K, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Sketch of an array column of words: fewer words than a shingle count as one shingle, none give no hash.

    ``words_col`` should be a computed column, so that it isn't evaluated again for each shingle.
    """
    n, c = shingle_words, f"`{words_col}`"
    hashes = f"transform(sequence(0, size({c}) - {n}), i -> xxhash64({', '.join(f'{c}[i + {j}]' for j in range(n))}))"
    short = f"if(size({c}) = 0, cast(array() as array<bigint>), array(xxhash64(array_join({c}, ' '))))"
    return F.expr(f"slice(sort_array(array_distinct(if(size({c}) >= {n}, {hashes}, {short}))), 1, {k})")


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1; two empty sketches are alike."""
    union = merge(a, b, k)
    return F.when(F.size(union) == 0, 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union))


def distinct_count(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(s, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; an empty a is contained."""
    both = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / distinct_count(a, k)))


def digest(s: Column) -> Column:
    """The sketch as a string: 16 hex digits a hash."""
    return F.array_join(F.transform(s, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _floor_div(col: str, width: int) -> Column:
    return F.expr(f"({col} - pmod({col}, {width}L)) div {width}L")


def successors(keys: DataFrame, width: int = BUCKET_IDS, direct: int = 10_000) -> DataFrame:
    """(k, next_k): the next larger key of every distinct integer key (column ``k``), the first after the last.

    Keys are bucketed by value, so a window partition holds at most ``width`` keys; the order of
    buckets is the same question on a thousandth of the range. Up to ``direct`` keys are ordered at once.
    """
    def ordered(level: DataFrame) -> DataFrame:
        if level.count() <= direct:
            return level.select("k", F.lead("k").over(W.orderBy("k")).alias("next_k"))
        rows = level.withColumn("b", _floor_div("k", width))
        inside = rows.select("k", "b", F.lead("k").over(W.partitionBy("b").orderBy("k")).alias("next_k"))
        heads = materialize(rows.groupBy("b").agg(F.min("k").alias("head")), "succ-heads")
        after = ordered(heads.select(F.col("b").alias("k"))).select(F.col("k").alias("b"), F.col("next_k").alias("nb"))
        first = after.join(heads.select(F.col("b").alias("nb"), "head"), "nb").select("b", "head")
        return inside.join(first, "b", "left").select("k", F.coalesce("next_k", "head").alias("next_k"))

    whole = materialize(ordered(keys.select("k").distinct()), "succ")
    least = whole.agg(F.min("k").alias("least"))
    return whole.join(F.broadcast(least), F.lit(True)).select("k", F.coalesce("next_k", "least").alias("next_k"))  # one row


def with_next(docs: DataFrame, sketched: bool = True, width: int = BUCKET_IDS, k: int = K) -> DataFrame:
    """(doc_id, text, s, next_text, next_s): every row beside the next one by ascending doc_id, the first after the last.

    Rows of the same id follow each other by text; rows without an id come before all others, in
    the order of their texts' hashes: they are numbered down from the smallest id by hash, so they
    spread over buckets like rows with ids (equal texts without an id stay together). Texts are
    shuffled once, by bucket of ids; the first row of the next bucket is added to each bucket, so no
    window spans more than ``width`` ids. Null text reads as empty. Ids are integers.
    """
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise ValueError(f"ids are integers, not {docs.schema['doc_id'].dataType.simpleString()}")
    known = docs.agg(F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("without")).first()
    number, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    if known["without"]:
        share = F.shiftrightunsigned(F.xxhash64(text), 11) / F.lit(2.0 ** 53)  # from 0 to below 1
        number = F.coalesce(number, F.floor(share * known["without"]) + F.lit((known["low"] or 0) - known["without"]))
    rows = docs.select("doc_id", text.alias("text"), number.alias("k"))
    rows = rows.withColumn("b", _floor_div("k", width))
    heads = materialize(rows.groupBy("b").agg(F.min("k").alias("k")), "next-heads")
    follow = successors(heads.select(F.col("b").alias("k")), width)
    heads = heads.join(follow, heads["b"] == follow["next_k"]).select(follow["k"].alias("b"), heads["k"])  # a bucket, and the first id after it
    heads = materialize(heads, "next-first")
    ghosts = rows.select("k", "text").join(heads, "k").groupBy("b", "k").agg(F.min("text").alias("text"))
    both = rows.withColumn("ghost", F.lit(0)).unionByName(ghosts.select(F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", "k", "b", F.lit(1).alias("ghost")))
    dealt = both.repartition("b")
    if sketched:
        dealt = dealt.withColumn("w", words(F.col("text"))).withColumn("s", sketch("w", k)).drop("w")
    w = W.partitionBy("b").orderBy("ghost", "k", "text")
    cols = ["text", *(["s"] if sketched else [])]
    near = dealt.select("doc_id", *cols, "ghost", *[F.lead(c).over(w).alias(f"next_{c}") for c in cols])
    return near.where("ghost = 0").drop("ghost")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles) per row.

    The edited text replaces the last floor(n_chars / 2) code points by as many of the next
    document's first ones (or all it has). Null text counts as empty; an empty text has an empty
    fingerprint, alike only to another empty one. A single row follows itself. Repeated rows each
    get a row and follow each other. An empty table gives no rows; other columns are ignored. Ids
    that are not integers raise a ValueError.
    """
    rows = with_next(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), k=k)
    edited = rows.withColumn("n", F.length("text")).withColumn(
        "edited", F.expr("concat(substring(text, 1, n - n div 2), substring(next_text, 1, cast(n div 2 as int)))"))
    both = edited.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "s", "next_s",
        words(F.col("edited")).alias("w")).withColumn("e", sketch("w", k)).drop("w")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", digest(F.col("s")).alias("fingerprint"), digest(F.col("e")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("e"), k).alias("near_edited"), resemblance(F.col("s"), F.col("next_s"), k).alias("near_next"),
        distinct_count(F.col("s"), k).alias("n_shingles"))
