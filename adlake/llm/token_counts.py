"""Token counts by prefix dynamic programming over a BPE vocabulary with word ends.

For every prefix of a text the table holds the exact number of tokens the tokenizer gives for
that prefix, so truncation and budget questions need no second encoding.

Words are independent, so the table is built word by word. Inside a word of bytes b, the last
token of the encoding of b[:j] is the one vocabulary entry u ending at j that is compatible
with the last token of the encoding of b[:j - len(u)], and
count[j] = count[j - len(u)] + 1. A prefix that ends inside a word ends that word there, so
its last token is looked for among the entries that carry the word-end mark. Two neighbouring
tokens are compatible when no merge across their border would have come before the merges that
built them.

The tokenizer file gives vocabulary, merges, normalisation and special strings; its library
is used for normalising and splitting texts with characters from U+0300 on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import BEYOND_LATIN, slices, splitter, texts

#: Bounds of a worker's memos; a full memo starts anew.
MEMO_ENTRIES = 800_000
#: Prefixes up to so many bytes keep their state, since many words share them.
SHARED_PREFIX = 7


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)}


class PrefixCounter:
    """Counts of all prefixes for one tokenizer file."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        model = spec["model"]
        mark, char = model["end_of_word_suffix"], _byte_chars()
        self.library = Tokenizer.from_str(tokenizer_json)
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = set(specials)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")")
        self.hint = tuple(specials)
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words, self.split = regex.compile(pattern), splitter(pattern)

        def symbol(token: str) -> tuple[bytes, bool]:
            final = token.endswith(mark) and token != mark
            return bytes(char[c] for c in (token[: -len(mark)] if final else token)), final

        # order[token]: when its merge runs (single symbols: before all); halves[token]: what it is merged from
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        self.halves: list[tuple[int, int]] = []
        self.joint: dict[tuple[int, int], int] = {}
        for token in model["vocab"]:
            raw, final = symbol(token)
            if len(raw) == 1:
                (self.final if final else self.inner)[raw] = len(self.halves)
                self.halves.append((-1, -1))
        self.atoms = len(self.halves)
        for left, right in model["merges"]:
            (a, _), (b, final) = symbol(left), symbol(right)
            i, j = self.inner[a], (self.final if final else self.inner)[b]
            at = self.joint.setdefault((i, j), len(self.halves))
            if at == len(self.halves):
                self.halves.append((i, j))
                (self.final if final else self.inner)[a + b] = at
        self.longest = max(map(len, [*self.inner, *self.final]), default=1)
        self.pairs: dict[int, bool] = {}
        self.ends: dict[bytes, tuple[int, int]] = {t: (i, -1) for t, i in self.inner.items()}
        for t, i in self.final.items():
            self.ends[t] = (self.ends.get(t, (-1, -1))[0], i)
        self.memo: dict[str, int] = {}
        self.prefix: dict[bytes, tuple[int, int, int]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the tokens ``left`` and ``right`` stay apart when their bytes are encoded together.

        Undo the merges of both, the latest first, and watch the two symbols at the border: a
        merge of those that runs before the merge just undone would have taken them. Among equal
        merges the leftmost runs first, so the border's merge yields to one on its left only.
        """
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            known = self._apart(left, right)
            if len(self.pairs) >= 4 * MEMO_ENTRIES:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        # ``before``: merges with an order below it ran while the two symbols stood side by side
        before = 1 << 60
        while True:
            merge = self.joint.get((left, right))
            if merge is not None and merge < before:
                return False
            if left < self.atoms and right < self.atoms:
                return True
            if left > right:  # the left symbol was made later: step back before its merge
                before, left = left, self.halves[left][1]
            else:
                before, right = right + 1, self.halves[right][0]

    def word(self, text: str) -> int:
        """Tokens of one word."""
        found = self.memo.get(text)
        if found is None:
            found = self.table(text.encode("utf-8", "replace"))[-1][2]
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            if len(text) <= 64:
                self.memo[text] = found
        return found

    def table(self, raw: bytes) -> list[tuple[int, int, int]]:
        """For every prefix of a word's bytes, the empty one first: (last token, count, count if the word ended here)."""
        prefix, ends, pairs, compatible, longest = self.prefix, self.ends, self.pairs, self.compatible, self.longest
        n = len(raw)
        states = [(-1, 0, 0)]
        for j in range(1, n + 1):
            head = raw[:j] if j <= SHARED_PREFIX else b""
            state = prefix.get(head) if head else None
            if state is None:
                last = count = closed = 0
                inner_open = final_open = True
                for i in range(max(0, j - longest), j):
                    u = ends.get(raw[i:j])
                    if u is None:
                        continue
                    left, so_far, _ = states[i]
                    inner, final = u
                    if inner_open and inner >= 0 and (i == 0 or (pairs.get(left << 32 | inner) or compatible(left, inner))):
                        last, count, inner_open = inner, so_far + 1, False
                        if not final_open:
                            break
                    if final_open and final >= 0 and (i == 0 or (pairs.get(left << 32 | final) or compatible(left, final))):
                        closed, final_open = so_far + 1, False
                        if not inner_open:
                            break
                state = (last, count, closed)
                if head:
                    if len(prefix) >= MEMO_ENTRIES:
                        prefix.clear()
                    prefix[head] = state
            states.append(state)
        return states

    def _pieces(self, text: str) -> Iterator[tuple[str, list[tuple[int, int]] | None]]:
        """Normalised pieces with the spans of their words; a special string has None."""
        if not any(s in text for s in self.hint):
            parts = [text]
        else:
            parts = [p for p in self.cut.split(text) if p]
        for part in parts:
            if part in self.special:
                yield part, None
            elif BEYOND_LATIN.search(part):
                norm = self.library.normalizer.normalize_str(part)
                yield norm, [span for _, span in self.library.pre_tokenizer.pre_tokenize_str(norm)]
            else:  # below U+0300 normalisation only lower-cases (white space is dropped anyway)
                norm = part.lower()
                yield norm, [m.span() for m in self.words.finditer(norm)]

    def _plain(self, text: str) -> int:
        """Count of a short ordinary string (a part of a contraction or special string)."""
        return sum(self.word(m) for m in self.split(text.lower()))

    def _counts(self, word: str) -> list[int]:
        """Counts at each code point of a word as the splitter cuts it there."""
        if word[0] == "'" and word[1:2].isalpha():  # 'r of 're is two words as long as it is a prefix
            return [self._plain(word[:k]) for k in range(1, len(word))] + [self.word(word)]
        raw = word.encode("utf-8", "replace")
        table = self.table(raw)
        return [table[j][2] for j in range(1, len(raw) + 1) if j == len(raw) or raw[j] & 0xC0 != 0x80]

    def total(self, text: str) -> int:
        """Tokens of the whole text: the table's last entry."""
        if not BEYOND_LATIN.search(text) and not any(s in text for s in self.hint):
            memo, word = self.memo, self.word
            return sum([memo.get(w) or word(w) for w in self.split(text.lower())])
        total = 0
        for piece, spans in self._pieces(text):
            total += 1 if spans is None else sum(self.word(piece[a:b]) for a, b in spans)
        return total

    def prefix_counts(self, text: str) -> np.ndarray:
        """table[k]: tokens of the first k code points of the normalised text."""
        out, base = [np.zeros(1, dtype=np.int32)], 0
        for piece, spans in self._pieces(text):
            table, done = np.empty(len(piece), dtype=np.int32), 0
            if spans is None:
                table[:-1] = [base + self._plain(piece[:k]) for k in range(1, len(piece))]
                base += 1
                table[-1] = base
                done = len(piece)
            for a, b in spans or ():
                table[done:a] = base
                table[a:b] = self._counts(piece[a:b])
                table[a:b] += base
                base, done = int(table[b - 1]), b
            table[done:] = base
            out.append(table)
        return np.concatenate(out)

    def fit(self, text: str, budget: int) -> int:
        """Longest prefix of the normalised text, in code points, that has at most ``budget`` tokens.

        Counts at word ends only grow, so the answer lies before the end of the first word that
        passes the budget; only that word's inner prefixes are looked up.
        """
        base = start = 0
        for piece, spans in self._pieces(text):
            if spans is None:
                spans = [(0, len(piece))]
                counts = lambda w: [self._plain(w[:k]) for k in range(1, len(w))] + [1]
            else:
                counts = self._counts
            for a, b in spans:
                word = piece[a:b]
                n = 1 if word in self.special else self.word(word)
                if base + n > budget:
                    inner = [k + 1 for k, c in enumerate(counts(word)) if base + c <= budget]
                    return start + a + max(inner, default=0)
                base += n
            start += len(piece)
        return start


@lru_cache(maxsize=4)
def _counter(tokenizer_json: str) -> PrefixCounter:
    return PrefixCounter(tokenizer_json)


def _shipped(docs: DataFrame, tokenizer_path: str) -> "object":
    with open(tokenizer_path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars) for every row of ``docs``.

    ``fit_chars``: length, in code points, of the longest prefix of the normalised text with at
    most ``limit`` tokens (null unless the text is over the limit). Totals add up the last entries of
    the words' prefix tables, which are remembered; the entries of the word that crosses the limit
    place the cut. ``prefix_tables`` gives the whole table of a text.
    Null text counts as empty: no bytes, no tokens. Repeated rows stay repeated, an empty table
    gives no rows, other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    vocabulary = _shipped(docs, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary.value)
        for part in slices(batches, "text"):
            own = texts(part, "text")
            n = [counter.total(t) for t in own]
            fit = [counter.fit(t, limit) if k > limit else None for t, k in zip(own, n)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(t.encode("utf-8", "replace")) for t in own], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([k > limit for k in n], pa.bool_()), pa.array(fit, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def prefix_tables(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, prefix_counts array<int>): the whole table of every row, one entry a code point and one for the empty prefix."""
    kind = docs.schema[id_col].dataType.simpleString()
    vocabulary = _shipped(docs, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary.value)
        for part in slices(batches, "text", 500_000):
            tables = [counter.prefix_counts(t) for t in texts(part, "text")]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(tables, pa.list_(pa.int32()))], ["doc_id", "prefix_counts"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, prefix_counts array<int>")


def truncate(tables: DataFrame, budget: int) -> DataFrame:
    """(doc_id, fit_chars) answered from stored tables: the longest prefix within ``budget`` tokens."""
    fits = F.expr(f"array_max(filter(transform(prefix_counts, (c, k) -> if(c <= {int(budget)}, k, -1)), k -> k >= 0))")
    return tables.select("doc_id", fits.cast("long").alias("fit_chars"))
