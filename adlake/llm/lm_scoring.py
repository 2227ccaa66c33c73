"""Stupid-backoff language-model scores, computed relationally.

Counts of n-grams of orders 1 to ``order`` over the whole corpus are tables partitioned by
their key; documents are exploded into n-grams, joined to the tables, and summed.

Words become 64-bit hashes: two words share an id with odds of about m * m / 2 ** 65 among m
words (3e-6 at 10 million). Tables have one row a key, so they are the built side of hash joins
and spread evenly over the partitions; the exploded side is not sorted.

    S(c | a b) = count(a b c) / count(a b), or alpha * S(c | b), down to count(c) / tokens.

Context that is missing at the start of a text counts as backed off.

With ``min_count`` 1 every n-gram of the scored texts is in the tables, as the corpus is those
texts, so positions back off at the start of a text only and the log scores telescope: a text's
sum is that of log count over its n-grams of the highest order, less log count of the contexts
of all but the first of them, and constants. The key is a 64-bit hash of the n-gram's word ids.
Each order is one shuffle: exploded n-grams are dealt by key into parts of a bounded number (their
number grows with the corpus), in packed rows of one slice of texts each. A part counts its keys,
joins its n-grams to that table, and returns the sums of each slice's documents as one packed
row; a second, smaller shuffle adds up the rows of a slice.

With a larger ``min_count``, n-grams of order 2 and more with fewer occurrences are pruned from
the tables, and keys are the word ids, so that a table row knows its context and its suffix. An
n-gram can only be found if its suffix is, so the log score of a position is the unigram's plus,
for each longer n-gram found, the difference it makes. That difference is a property of the
table row, so each order is one explode, one join, and one sum per document.

No per-position state is shuffled. In the pruned form counts combine within a slice of texts, and
a frequent n-gram's join rows are split by adaptive skew handling. In the whole form n-grams that
are frequent in a slice reach their part as a count, and their terms are joined by Spark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import discard, materialize, slices, texts

#: N-grams of one part of a count table; a part is held by one task.
PART_GRAMS = 3_000_000
#: Text packed at a time, and n-grams of a packed row at most.
PACKED_BYTES, PACKED_GRAMS = 6_000_000, 4_000_000
#: Occurrences in one slice from which an n-gram is sent as a count.
FREQUENT = 1_000


class _Ids(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def word_ids(text: str, known: _Ids) -> np.ndarray:
    """64-bit ids of the words between ASCII white space, A-Z lower-cased."""
    words = text.encode("utf-8", "replace").lower().split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


class _Slice:
    """Word ids of a slice of texts in one array, with the text, place and length of each."""

    def __init__(self, part: pa.RecordBatch) -> None:
        known = _Ids()
        ids = [word_ids(t, known) for t in texts(part, "text")]
        self.size = np.array([len(x) for x in ids], dtype=np.int64)
        self.flat = np.concatenate(ids)
        self.text = np.repeat(np.arange(len(ids)), self.size)
        self.place = np.arange(len(self.flat)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.length = self.size[self.text]

    def starts(self, n: int) -> np.ndarray:
        """Where n-grams of ``n`` words begin."""
        return np.flatnonzero(self.place + n <= self.length)

    def words(self, at: np.ndarray, n: int) -> list[np.ndarray]:
        return [self.flat[at + j].view(np.int64) for j in range(n)]

    def keys(self, at: np.ndarray, n: int) -> np.ndarray:
        """64-bit keys of the n-grams that begin at ``at``."""
        key = self.flat[at]
        with np.errstate(over="ignore"):
            for j in range(1, n):
                key = key * np.uint64(0x9E3779B97F4A7C15) + self.flat[at + j]
                key = (key ^ (key >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                key = (key ^ (key >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                key ^= key >> np.uint64(31)
        return key.view(np.int64)


def _keys(n: int) -> list[str]:
    return [f"g{j}" for j in range(n)]


def exploded(docs: DataFrame, n: int, by_doc: bool) -> DataFrame:
    """N-grams of ``docs`` (doc, text) as rows (doc, g0..), or (g0.., n) without ``by_doc``; n: occurrences.

    Without ``by_doc`` repeated n-grams are combined within a slice of texts, else they are a row
    an occurrence (words have n, always 1).
    """
    counted = n == 1 or not by_doc
    fields = ([f"doc {docs.schema['doc'].dataType.simpleString()}"] if by_doc else []) + [f"{k} long" for k in _keys(n)] + (["n int"] if counted else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            s = _Slice(part)
            at, count = s.starts(n), None
            if not by_doc:
                _, first, count = np.unique(s.keys(at, n), return_index=True, return_counts=True)
                at = at[first]
            out = [pa.array(c) for c in s.words(at, n)]
            if counted:
                out.append(pa.array(np.ones(len(at), np.int32) if count is None else count.astype(np.int32)))
            if by_doc:
                out.insert(0, part.column("doc").take(pa.array(s.text[at], pa.int64())))
            yield pa.RecordBatch.from_arrays(out, [f.split()[0] for f in fields])

    return docs.select("doc", "text").mapInArrow(run, ", ".join(fields))


def keyed_counts(docs: DataFrame, n: int) -> DataFrame:
    """(key, n) of the n-grams of ``docs`` (doc, text), combined within a slice of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            s = _Slice(part)
            key, count = np.unique(s.keys(s.starts(n), n), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count.astype(np.int32))], ["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n int")


def keyed_terms(docs: DataFrame, n: int, order: int) -> DataFrame:
    """(doc, key, w) of the n-grams whose log count times w is a term of the telescoped score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            s = _Slice(part)
            at = s.starts(n)
            w = _weights(s, at, n, order)
            at, w = at[w != 0], w[w != 0]
            out = [part.column("doc").take(pa.array(s.text[at], pa.int64())), pa.array(s.keys(at, n)), pa.array(w)]
            yield pa.RecordBatch.from_arrays(out, ["doc", "key", "w"])

    return docs.select("doc", "text").mapInArrow(run, f"doc {docs.schema['doc'].dataType.simpleString()}, key long, w tinyint")


def lengths(docs: DataFrame) -> DataFrame:
    """(doc, size): words of every row of ``docs`` (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            size = [len(t.encode("utf-8", "replace").split()) for t in texts(part, "text")]
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(size, pa.int64())], ["doc", "size"])

    return docs.select("doc", "text").mapInArrow(run, f"doc {docs.schema['doc'].dataType.simpleString()}, size long")


def _weights(s: _Slice, at: np.ndarray, n: int, order: int) -> np.ndarray:
    """How often the log count of each n-gram that begins at ``at`` enters the telescoped score."""
    if n == order:
        return np.ones(len(at), np.int8)
    whole = s.length[at] == n  # a shorter text's one term
    inner = (s.place[at] > 0) & (s.place[at] + order <= s.length[at]) if n == order - 1 else np.zeros(len(at), dtype=bool)
    return whole.astype(np.int8) - inner.astype(np.int8)


def _binary(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary values that hold ``data`` from each of ``cuts`` to the next."""
    ends = (np.append(cuts, len(data)) * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


#: What a packed row holds: n-grams of documents, counts of frequent n-grams, or those n-grams' terms.
GRAMS, COUNTS, TERMS = range(3)


def _frequent(key: np.ndarray, least: int) -> np.ndarray:
    """Keys with at least ``least`` occurrences among ``key``."""
    bins = (key & 0xFFFF).astype(np.int64)
    crowded = key[(np.bincount(bins, minlength=1 << 16) >= least)[bins]]
    found, count = np.unique(crowded, return_counts=True)
    return found[count >= least]


def _dealt(key: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key: an even share of the range of its upper half."""
    return ((key.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint16 if parts <= 1 << 16 else np.uint32)


def exploded_parts(docs: DataFrame, n: int, order: int, parts: int) -> DataFrame:
    """(part, slice, kind, docs, runs, keys, weights): the n-grams of ``docs`` (doc, text) dealt into ``parts`` by key.

    A row holds those of one slice of texts and one part as packed columns: 64-bit keys with their
    8-bit weights, ordered by document; ``runs`` has the number of n-grams of each of ``docs``. An
    n-gram that is frequent in a slice is sent to its part as one count, and its weights, summed by
    document, travel apart (to any part), so that no part gathers the occurrences of a hot n-gram.
    """
    shape = f"part int, slice long, kind tinyint, docs array<{docs.schema['doc'].dataType.simpleString()}>, runs binary, keys binary, weights binary"
    names = [f.split()[0] for f in shape.split(", ")]

    def packed(rows: pa.RecordBatch, own: int, kind: int, part: np.ndarray, text: np.ndarray, key: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
        """One row for each part of ``part`` (ascending), one run for each document in it."""
        moved = np.append(True, part[1:] != part[:-1])
        cuts, edges = np.flatnonzero(moved), np.flatnonzero(moved | np.append(True, text[1:] != text[:-1]))
        cut_edges = np.searchsorted(edges, cuts)
        owners = rows.column("doc").take(pa.array(text[edges], pa.int64()))
        return pa.RecordBatch.from_arrays([
            pa.array(part[cuts].astype(np.int32)), pa.array(np.full(len(cuts), own)), pa.array(np.full(len(cuts), kind, np.int8)),
            pa.ListArray.from_arrays(pa.array(np.append(cut_edges, len(edges)).astype(np.int32)), owners),
            _binary(np.diff(np.append(edges, len(key))).astype(np.int32), cut_edges), _binary(key, cuts), _binary(weight, cuts)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, rows in enumerate(slices(batches, "text", PACKED_BYTES)):
            s, place = _Slice(rows), task + number
            starts = s.starts(n)
            for lo in range(0, len(starts), PACKED_GRAMS):
                at = starts[lo:lo + PACKED_GRAMS]
                key, text, weight = s.keys(at, n), s.text[at], _weights(s, at, n, order)
                often = _frequent(key, FREQUENT)
                if len(often):
                    hot = np.isin(key, often)
                    counted = np.bincount(np.searchsorted(often, key[hot]), minlength=len(often))
                    part = _dealt(often, parts)
                    way = np.argsort(part, kind="stable")
                    yield packed(rows, place, COUNTS, part[way], text[hot][np.zeros(len(way), int)], often[way], counted[way])
                    by_text = np.lexsort((key[hot], text[hot]))
                    k, t, w = key[hot][by_text], text[hot][by_text], weight[hot][by_text].astype(np.int64)
                    new = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (t[1:] != t[:-1])))
                    k, t, w = k[new], t[new], np.add.reduceat(w, new)
                    k, t, w = k[w != 0], t[w != 0], w[w != 0]
                    if len(k):
                        yield packed(rows, place, TERMS, np.full(len(k), int(key[0]) % parts), t, k, w)
                    key, text, weight = key[~hot], text[~hot], weight[~hot]
                if len(key):
                    part = _dealt(key, parts)
                    way = np.argsort(part, kind="stable")
                    yield packed(rows, place, GRAMS, part[way], text[way], key[way], weight[way])

    return docs.select("doc", "text").mapInArrow(run, shape)


def joined_sums(exploded: DataFrame, parts: int, kind: str) -> DataFrame:
    """(slice, docs, sums, key, v, w): a part's n-grams joined to its count table, log counts times weights summed by document.

    All occurrences of a key are in one part, so the table of a part is whole. The sums of one
    slice's documents are a row, packed in 64-bit floats. Rows with a key are the log counts v of
    frequent n-grams, and the weights w of those in a document, which are still to be joined.
    """
    shape = f"slice long, docs array<{kind}>, sums binary, key long, v double, w long"
    names = [f.split()[0] for f in shape.split(", ")]
    kinds = [pa.int64(), None, pa.binary(), pa.int64(), pa.float64(), pa.int64()]

    def rows(n: int, of_docs: pa.DataType, **given: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([given.get(c, pa.nulls(n, k or of_docs)) for c, k in zip(names, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, runs, keys, weights, counts, places, listed = [], [], [], [], [], [], None
        for batch in batches:
            listed = batch.schema.field("docs").type
            for row in range(batch.num_rows):
                what, key = batch.column("kind")[row].as_py(), np.frombuffer(batch.column("keys")[row].as_py(), np.int64)
                weight, sizes = batch.column("weights")[row].as_py(), np.frombuffer(batch.column("runs")[row].as_py(), np.int32)
                if what == COUNTS:
                    counts.append((key, np.frombuffer(weight, np.int64)))
                    continue
                if what == TERMS:
                    owner = batch.column("docs")[row].values.take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
                    each = pa.ListArray.from_arrays(pa.array(np.arange(len(key) + 1, dtype=np.int32)), owner).cast(listed)
                    yield rows(len(key), listed, docs=each, key=pa.array(key), w=pa.array(np.frombuffer(weight, np.int64)))
                    continue
                docs.append(batch.column("docs").slice(row, 1))
                places.append(batch.column("slice")[row].as_py())
                runs.append(sizes)
                keys.append(key)
                weights.append(np.frombuffer(weight, np.int8))
        key = np.concatenate([*keys, np.zeros(0, np.int64)])
        del keys
        by_key = np.argsort(key)
        key = key[by_key]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
        occurrences = np.diff(np.append(first, len(by_key)))
        table, count = key[first], occurrences.copy()  # the count table of this part
        del key
        if counts:
            often, at = np.unique(np.concatenate([k for k, _ in counts]), return_inverse=True)
            more = np.zeros(len(often), np.int64)
            np.add.at(more, at, np.concatenate([c for _, c in counts]))
            place = np.searchsorted(table, often)
            here = np.flatnonzero(place < len(table))
            here = here[table[place[here]] == often[here]]
            count[place[here]] += more[here]
            more[here] = count[place[here]]
            yield rows(len(often), listed, key=pa.array(often), v=pa.array(np.log(more)))
        found = np.empty(len(by_key))
        found[by_key] = np.repeat(np.log(count), occurrences)
        del by_key
        lo = 0
        for owner, own, sizes, weight in zip(docs, places, runs, weights):
            v = found[lo:lo + len(weight)] * weight
            lo += len(weight)
            yield rows(1, listed, slice=pa.array([own]), docs=owner, sums=pa.array([np.add.reduceat(v, np.cumsum(sizes) - sizes).tobytes()], pa.binary()))

    return exploded.repartitionById(parts, F.col("part")).mapInArrow(run, shape)


def added_up(found: DataFrame, parts: int, kind: str) -> DataFrame:
    """(doc, v): the packed sums of ``joined_sums``, those of one slice from all parts added up in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, sums = [], []
        for batch in batches:
            if batch.num_rows:
                docs.append(batch.column("docs").flatten())
                sums += [np.frombuffer(x) for x in batch.column("sums").to_pylist()]
        if docs:
            coded = pa.chunked_array(docs).combine_chunks().dictionary_encode(null_encoding="encode")
            v = np.bincount(coded.indices.to_numpy(zero_copy_only=False), weights=np.concatenate(sums), minlength=len(coded.dictionary))
            for lo in range(0, len(v), 100_000):
                yield pa.RecordBatch.from_arrays([coded.dictionary[lo:lo + 100_000], pa.array(v[lo:lo + 100_000])], ["doc", "v"])

    return found.where("sums IS NOT NULL").select("slice", "docs", "sums").repartition(parts, "slice").mapInArrow(run, f"doc {kind}, v double")


def whole_sums(docs: DataFrame, order: int, alpha: float) -> list[DataFrame]:
    """Tables (doc, v, n) that add up to the scores against tables of every n-gram."""
    kind = docs.schema["doc"].dataType.simpleString()
    sizes = materialize(lengths(docs), "lm-sizes")
    grams = {n: F.sum(F.greatest(F.col("size") - (n - 1), F.lit(0))).alias(f"n{n}") for n in range(1, order + 1)}
    seen = sizes.agg(*grams.values()).first()
    total = seen["n1"] or 0
    steps = sum((F.when(F.col("size") > i, float(order - 1 - i)).otherwise(0.0) for i in range(order - 1)), F.lit(0.0))
    unigrams = F.col("size") if order == 1 else F.least(F.col("size"), F.lit(1))
    fixed = steps * math.log(alpha) - unigrams * math.log(max(total, 1))
    sums = [sizes.select("doc", fixed.alias("v"), F.col("size").alias("n"))]
    for n in range(order, max(order - 2, 0), -1):  # one shuffle each: counts and scores come from the same parts
        parts = max(-(-(seen[f"n{n}"] or 0) // PART_GRAMS), 1)
        found = materialize(joined_sums(exploded_parts(docs, n, order, parts), parts, kind), f"lm-found-{n}")
        rows = added_up(found, parts, kind)
        table = found.where("v IS NOT NULL").select("key", F.col("v").alias("log"))
        if not table.isEmpty():
            terms = found.where("w IS NOT NULL").select(F.col("docs")[0].alias("doc"), "key", "w")
            rows = rows.unionByName(terms.join(table, "key").select("doc", (F.col("log") * F.col("w")).alias("v")))
        sums.append(materialize(rows.groupBy("doc").agg(F.sum("v").alias("v"), F.lit(0).cast("long").alias("n")), f"lm-sum-{n}"))
        discard(found)
    for n in range(order - 2, 0, -1):  # terms of texts of n words only
        terms = materialize(keyed_terms(docs, n, order), f"lm-terms-{n}")
        if not terms.isEmpty():
            counts = keyed_counts(docs, n).groupBy("key").agg(F.sum("n").alias("c")).where("c > 1")
            table = materialize(counts.select("key", F.log("c").alias("v")), f"lm-log-{n}")
            found = terms.join(table.hint("shuffle_hash"), "key")
            sums.append(materialize(found.groupBy("doc").agg(F.sum(F.col("v") * F.col("w")).alias("v"), F.lit(0).cast("long").alias("n")), f"lm-sum-{n}"))
            discard(table)
        discard(terms)
    return sums


def count_tables(docs: DataFrame, order: int = 3, min_count: int = 1, alpha: float = 0.4) -> tuple[list[DataFrame], int]:
    """Per order the table (g0.., c, s, v), for the last one (g0.., v), and the number of tokens.

    c: occurrences in the whole corpus; s: log score of a position whose longest find is this
    n-gram; v: what the n-gram adds to the score its suffix would give.
    """
    tables: list[DataFrame] = []
    uni = materialize(exploded(docs, 1, False).groupBy("g0").agg(F.sum("n").alias("c")), "lm-uni")
    total = uni.agg(F.sum("c")).first()[0] or 0
    penalty = F.log(F.lit(float(alpha)))
    score = F.log(F.col("c") / F.lit(float(max(total, 1)))) + (order - 1) * penalty
    first = uni.withColumn("s", score).withColumn("v", F.col("s"))
    first._scratch = uni._scratch
    tables.append(first)
    for n in range(2, order + 1):
        counts = materialize(exploded(docs, n, False).groupBy(*_keys(n)).agg(F.sum("n").alias("c")).where(F.col("c") >= min_count), f"lm-{n}")
        lower, own = tables[-1], _keys(n - 1)
        context = [F.col(f"g{j}").alias(f"x{j}") for j in range(n - 1)]
        suffix = [F.col(f"g{j + 1}").alias(f"y{j}") for j in range(n - 1)]
        rows = counts.select("*", *context, *suffix)
        by_context = lower.select(*[F.col(k).alias(f"x{j}") for j, k in enumerate(own)], F.col("c").alias("cc"))
        by_suffix = lower.select(*[F.col(k).alias(f"y{j}") for j, k in enumerate(own)], F.col("s").alias("ss"))
        joined = rows.join(by_context.hint("shuffle_hash"), [f"x{j}" for j in range(len(own))]).join(by_suffix.hint("shuffle_hash"), [f"y{j}" for j in range(len(own))])
        full = joined.withColumn("s", F.log(F.col("c") / F.col("cc")) + (order - n) * penalty)
        more = ["c", "s"] if n < order else []  # the next order needs them
        tables.append(materialize(full.select(*_keys(n), *more, (F.col("s") - F.col("ss")).alias("v")), f"lm-table-{n}"))
        discard(counts)
    return tables, total


def pruned_sums(docs: DataFrame, order: int, min_count: int, alpha: float) -> list[DataFrame]:
    """Tables (doc, v, n) that add up to the scores against the tables of ``count_tables``."""
    tables, _ = count_tables(docs, order, min_count, alpha)
    sums = []
    for n, table in enumerate(tables, start=1):
        found = exploded(docs, n, True).join(table.select(*_keys(n), "v").hint("shuffle_hash"), _keys(n))
        if n == 1:  # every word is a unigram of the table
            summed = found.groupBy("doc").agg(F.sum(F.col("v") * F.col("n")).alias("v"), F.sum("n").alias("n"))
        else:
            summed = found.groupBy("doc").agg(F.sum("v").alias("v"), F.lit(0).cast("long").alias("n"))
        sums.append(materialize(summed, f"lm-sum-{n}"))
        discard(table)
    return sums


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3, min_count: int = 1, alpha: float = 0.4) -> DataFrame:
    """(doc_id, n_tokens, log_score, per_token, perplexity) for every row of ``docs``.

    The corpus counted is ``docs`` itself, every row of it. ``log_score`` sums natural logs over
    the words of the whole text, rounded to 6 places. Null and empty texts have no tokens: score
    0, null per_token and perplexity. Rows that repeat a doc_id are scored together as one
    document and each get the sum; rows without doc_id likewise. An empty table gives no rows;
    other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    sums = whole_sums(rows, order, alpha) if min_count <= 1 else pruned_sums(rows, order, min_count, alpha)
    parts = sums[0]
    for more in sums[1:]:
        parts = parts.unionByName(more)
    whole = parts.groupBy("doc").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    out = rows.select("doc").alias("d").join(whole.alias("w"), F.col("d.doc").eqNullSafe(F.col("w.doc")), "left")
    n, v = F.coalesce("w.n", F.lit(0)).cast("long"), F.round(F.coalesce("w.v", F.lit(0.0)), 6)
    return out.select(
        F.col("d.doc").alias("doc_id"), n.alias("n_tokens"), v.alias("log_score"),
        F.when(n > 0, F.round(v / n, 6)).alias("per_token"), F.when(n > 0, F.round(F.exp(-v / n), 4)).alias("perplexity"))
