"""Byte-level BPE encoding and decoding by a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary resolves pre-tokens that are tokens
themselves. Tier 2: other pre-tokens are merged with a heap of candidate pairs over a doubly
linked list of bytes, lowest rank first, leftmost first among equals.

The vocabulary is a rank file in the tiktoken format, read from a path parameter; its bytes
travel with the task closure, so executors need no local file. Encoding is exact for whole
texts of any length; a task holds one slice of texts and a bounded memo.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import slices, splitter, texts

#: Entries of a worker's memo of merged pre-tokens; a full memo starts anew.
MEMO_ENTRIES = 400_000


class PerfectHash:
    """Minimal perfect hash over byte strings: key i has one slot of n, found without probing.

    Keys fall into n / 3 groups by one hash. Groups of several keys are placed, the largest first,
    by the smallest displacement whose second hashes land on free slots; groups of one key then
    take the slots that are left and store them directly.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.groups = n, max(1, n // 3)
        hashes = self.hash(keys)
        group = (hashes % np.uint64(self.groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[order], np.arange(self.groups + 1))
        sizes = np.diff(bounds)
        self.shift = np.zeros(self.groups, dtype=np.int64)  # a displacement, or -1 - slot
        self.key_at = np.full(n, -1, dtype=np.int64)
        for g in np.argsort(-sizes, kind="stable").tolist():
            if sizes[g] < 2:
                break
            own = order[bounds[g]:bounds[g + 1]]
            for first in range(0, 1 << 22, 128):
                at = np.sort(self._slot(hashes[own][None, :], np.arange(first, first + 128)[:, None]), axis=1)
                fits = (self.key_at[at] < 0).all(axis=1) & (np.diff(at, axis=1) > 0).all(axis=1)
                if fits.any():
                    self.shift[g] = first + int(fits.argmax())
                    self.key_at[self._slot(hashes[own], self.shift[g])] = own
                    break
            else:
                raise ValueError("equal keys")
        single = np.flatnonzero(sizes == 1)
        free = np.flatnonzero(self.key_at < 0)
        self.shift[single] = -1 - free
        self.key_at[free] = order[bounds[single]]
        self.check = hashes[self.key_at] if n else hashes

    @staticmethod
    def hash(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slot(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (hashes ^ (np.asarray(shift).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0x165667B19E3779F9)
        return ((x >> np.uint64(32)) % np.uint64(max(self.n, 1))).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Index of the only key each string can be, or -1; the caller compares the bytes."""
        if not self.n or not keys:
            return np.full(len(keys), -1, dtype=np.int64)
        h = self.hash(keys)
        shift = self.shift[(h % np.uint64(self.groups)).astype(np.int64)]
        at = np.where(shift < 0, -1 - shift, self._slot(h, shift))
        return np.where(self.check[at] == h, self.key_at[at], -1)


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, rank_file: bytes, pattern: str, index: PerfectHash | None = None):
        pairs = [line.split() for line in rank_file.splitlines() if line.strip()]
        self.tokens = [base64.b64decode(t) for t, _ in pairs]
        self.ids = [int(r) for _, r in pairs]
        self.rank = dict(zip(self.tokens, self.ids))
        self.index = index or PerfectHash(self.tokens)
        self.split = splitter(pattern)
        self.memo: dict[str, bytes] = {}
        by_id = [b""] * (max(self.ids, default=-1) + 1)
        for t, i in zip(self.tokens, self.ids):
            by_id[i] = t
        self.by_id = pa.array(by_id, pa.binary())

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one pre-token: heap of adjacent pairs over linked bytes."""
        get, n = self.rank.get, len(word)
        end = list(range(1, n + 1))  # the part at i covers word[i:end[i]], the next begins there; 0: merged away
        prev = list(range(-1, n - 1))
        shift = n.bit_length()  # heap entries: rank, then position
        mask = (1 << shift) - 1
        heap = [r << shift | i for i in range(n - 1) if (r := get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & mask
            j = end[i]
            if not j or j >= n:
                continue
            stop = end[j]
            if get(word[i:stop]) != entry >> shift:
                continue  # one of the two parts has changed since
            end[i], end[j] = stop, 0
            if stop < n:
                prev[stop] = i
                if (r := get(word[i:end[stop]])) is not None:
                    heapq.heappush(heap, r << shift | i)
            h = prev[i]
            if h >= 0 and (r := get(word[h:stop])) is not None:
                heapq.heappush(heap, r << shift | h)
        out, i = [], 0
        while i < n:
            out.append(get(word[i:end[i]]))
            i = end[i]
        return out

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of the texts)."""
        split = [self.split(t) for t in batch]
        distinct = list(set().union(*split)) if split else []
        coded = [w.encode("utf-8", "replace") for w in distinct]
        table: dict[str, bytes] = {}
        memo, tokens, ids = self.memo, self.tokens, self.ids
        for word, raw, at in zip(distinct, coded, self.index.find(coded).tolist()):
            if at >= 0 and tokens[at] == raw:
                table[word] = np.int32(ids[at]).tobytes()
                continue
            found = memo.get(word)
            if found is None:
                found = np.array(self.merge(raw), dtype="<i4").tobytes()
                if len(memo) >= MEMO_ENTRIES:
                    memo.clear()
                if len(word) <= 64:
                    memo[word] = found
            table[word] = found
        parts = [b"".join(map(table.__getitem__, words)) for words in split]
        offsets = np.zeros(len(batch) + 1, dtype=np.int64)
        np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
        return np.frombuffer(b"".join(parts), dtype="<i4"), offsets

    def encode_lists(self, batch: list[str]) -> pa.ListArray:
        """The ids of each text as a list."""
        ids, offsets = self.encode(batch)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """Bytes of each list of ids; null for a null list."""
        at = lists.offsets.to_numpy()
        taken = self.by_id.take(lists.values.slice(int(at[0]), int(at[-1] - at[0])))
        ends = np.frombuffer(taken.buffers()[1], dtype=np.int32)[taken.offset:taken.offset + len(taken) + 1]
        offsets = pa.py_buffer(np.ascontiguousarray(ends[at - at[0]]))
        out = pa.Array.from_buffers(pa.binary(), len(lists), [None, offsets, taken.buffers()[2]])
        return pc.if_else(lists.is_valid(), out, pa.scalar(None, pa.binary()))


@lru_cache(maxsize=4)
def _read(rank_path: str, pattern: str) -> tuple[bytes, PerfectHash]:
    with open(rank_path, "rb") as f:
        raw = f.read()
    return raw, ByteBpe(raw, pattern).index


_CODECS: dict[str, ByteBpe] = {}


def _codec(shipped, pattern: str) -> ByteBpe:
    """A worker's codec, built once from what the driver sent."""
    raw, index = shipped.value
    key = f"{xxhash.xxh3_64_hexdigest(raw)} {pattern}"
    if key not in _CODECS:
        _CODECS[key] = ByteBpe(raw, pattern, index)
    return _CODECS[key]


def _shipped(spark, rank_path: str, pattern: str) -> "object":
    """The vocabulary file and its perfect hash as a broadcast (about two megabytes, whatever the data)."""
    return spark.sparkContext.broadcast(_read(rank_path, pattern))


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, token_ids array<int>) for every row of ``docs``.

    Null and empty texts give an empty array; repeated rows stay repeated; an empty table gives
    no rows; other columns are ignored. No special tokens: their strings are ordinary text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    vocabulary = _shipped(docs.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for part in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), codec.encode_lists(texts(part, "text"))], ["doc_id", "token_ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, token_ids array<int>")


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode``, then ``decode`` of its ids, in one pass: (doc_id, token_ids, decoded), so a task needs one codec, not two."""
    kind = docs.schema[id_col].dataType.simpleString()
    vocabulary = _shipped(docs.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for part in slices(batches, "text"):
            lists = codec.encode_lists(texts(part, "text"))
            yield pa.RecordBatch.from_arrays([part.column(0), lists, codec.decode(lists)], ["doc_id", "token_ids", "decoded"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, token_ids array<int>, decoded binary")


def decode(encoded: DataFrame, rank_path: str, pattern: str, ids_col: str = "token_ids") -> DataFrame:
    """Add ``decoded`` (binary): the bytes of each row's token ids; a null list gives null.

    All other columns of ``encoded`` pass through.
    """
    vocabulary = _shipped(encoded.sparkSession, rank_path, pattern)
    names = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([*part.columns, codec.decode(part.column(ids_col))], [*names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*names).schema)
    return encoded.select(*names).mapInArrow(run, schema + ", decoded binary")
