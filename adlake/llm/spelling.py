"""Spelling variants by finite-state composition.

Two words are near if one inserted, deleted or replaced code point turns one into the other. All
near pairs are what the composition V . E . V accepts, where V is the minimal acyclic acceptor of
the vocabulary and E the transducer that copies code points, edits once, and copies again.

The composition is cut by its initial states. The place of a pair's edit is the length of the
words' common beginning; a region [low, high) of places fixes what comes before and behind it, so
all words that agree there form one initial state (and one final state) of V, and the pairs with
the edit in that region are found among those words alone. Each word starts in two regions, its
halves, as the shorter and as the longer word of a pair; a region whose words are more than
``LIMIT`` is halved again, up to single places, where the alphabet bounds the words. So no
initial state holds an unbounded group and every pair is found in exactly one of them.

Tasks build the minimal acceptors of their initial states with one register of states, so equal
right languages are one state throughout the task, walk the composition, and return a sum and the
best partner for each word and initial state. No pair leaves a task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import discard, materialize, slices, texts

#: Words an initial state may have before its region is halved.
LIMIT = 1000
#: Shares a word that is too common a key is dealt over.
SALTS = 16
#: Entries after which a task's tables are emptied.
COUNTED, STATES, KNOWN = 200_000, 300_000, 200_000

MIN_LENGTH = 7


def damaged_runs(doc_id, text: str, least: int, runs=None) -> Counter:
    """Results of at least ``least`` code points of one text, with their occurrences.

    Runs are lower-cased in A-Z. A run whose crc32 with the id is divisible by 31 loses one code point.
    """
    runs = runs or re.compile("[A-Za-zÀ-ÿ]{%d,}" % least).findall
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in Counter(runs(text.encode("utf-8", "replace").lower().decode())).items():
        h = zlib.crc32(run.encode(), seed)
        if h % 31 == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): results of at least ``min_length`` code points and ``min_count`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile("[A-Za-zÀ-ÿ]{%d,}" % min_length).findall
        counted: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())], ["word", "n"])
            counted.clear()
            return rows

        for part in slices(batches, "text"):
            for doc, text in zip(part.column("id").to_pylist(), texts(part, "text")):
                counted.update(damaged_runs(doc, text, min_length, find))
                if len(counted) >= COUNTED:
                    yield out()
        if counted:
            yield out()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Acceptors:
    """Minimal acyclic acceptors that share one register: equal right languages are one state."""

    def __init__(self) -> None:
        self.final: list[bool] = []
        self.moves: list[dict[str, int]] = []
        self.register: dict[tuple, int] = {}
        self.known: dict[tuple[int, int], list[str]] = {}

    def _state(self, final: bool, moves: dict[str, int]) -> int:
        key = (final, *moves.items())
        at = self.register.get(key)
        if at is None:
            at = self.register[key] = len(self.final)
            self.final.append(final)
            self.moves.append(moves)
        return at

    def add(self, words: list[str]) -> int:
        """Initial state of the acceptor of ``words`` (ascending, distinct)."""
        path: list[list] = [[False, {}]]
        last = ""

        def close(down_to: int) -> None:
            for i in range(len(last), down_to, -1):
                final, moves = path.pop()
                path[-1][1][last[i - 1]] = self._state(final, moves)

        for word in words:
            same, most = 0, min(len(last), len(word))
            while same < most and last[same] == word[same]:
                same += 1
            close(same)
            path.extend([False, {}] for _ in range(len(word) - same))
            path[-1][0] = True
            last = word
        close(0)
        return self._state(*path[0])

    def shared(self, a: int, b: int) -> list[str]:
        """Strings that lead from both states to a final one: E copies them after its edit."""
        key = (a, b) if a < b else (b, a)
        found = self.known.get(key)
        if found is None:
            found, open_ = [], [(a, b, "")]
            while open_:
                a, b, s = open_.pop()
                if self.final[a] and self.final[b]:
                    found.append(s)
                x, y = self.moves[a], self.moves[b]
                if len(x) > len(y):
                    x, y = y, x
                for c, to in x.items():
                    other = y.get(c)
                    if other is not None:
                        open_.append((to, other, s + c))
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[key] = found
        return found

    def near(self, short: list[str], long: list[str], at_end: bool) -> Iterator[tuple[str, str]]:
        """Pairs one edit apart: two of ``short`` by a replacement, one of each by an insertion.

        ``short`` has words of one length, ``long`` words of one more. An insertion into a row of
        equal code points counts at its last place; ``at_end`` admits one behind the last code point.
        """
        first = self.add(short)
        open_ = [(first, self.add(long) if long else None, "")]
        while open_:
            a, b, s = open_.pop()
            moves = self.moves[a]
            if len(moves) > 1:
                ways = list(moves.items())
                for i, (c, x) in enumerate(ways):
                    for d, y in ways[:i]:
                        for t in self.shared(x, y):
                            yield s + d + t, s + c + t
            more = self.moves[b] if b is not None else {}
            for c, y in more.items():
                if at_end and self.final[a] and self.final[y]:
                    yield s, s + c
                for d, x in moves.items():
                    other = self.moves[y].get(d) if d != c else None
                    if other is not None:
                        for t in self.shared(x, other):
                            yield s + d + t, s + c + d + t
            for c, x in moves.items():
                open_.append((x, more.get(c), s + c))


def _roles(words: DataFrame) -> DataFrame:
    """(word, n, m, low, high): each word as the shorter (m its length) and the longer one, in both halves."""
    half = lambda m: F.floor((m + 1) / 2).cast("int")
    size = F.char_length("word")
    regions = [F.struct(m.alias("m"), low.alias("low"), high.alias("high"))
               for m in (size, size - 1) for low, high in ((F.lit(0), half(m)), (half(m), m + 1))]
    return words.select("word", "n", F.inline(F.array(*regions)))


def _key() -> Column:
    behind = F.greatest(F.col("m") - F.col("high"), F.lit(0))
    return F.xxhash64("m", "low", "high", F.expr("substring(word, 1, low)"), F.right(F.col("word"), behind))


def initial_states(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(key, word, n, m, low, high): the words of every initial state, none with more than ``limit`` unless a single place."""
    live, settled = _roles(words).withColumn("key", _key()), []
    while True:
        hot = materialize(live.groupBy("key", "low", "high").count().where((F.col("count") > limit) & (F.col("high") - F.col("low") > 1)).select("key").distinct(), "spell-hot")
        if hot.isEmpty():
            break
        dealt = hot.select("key", F.lit(True).alias("hot"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        marked = live.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")).join(dealt, ["key", "salt"], "left")
        marked = materialize(marked.drop("salt"), "spell-marked")
        settled.append(marked.where("hot IS NULL").drop("hot"))
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.inline(F.array(F.struct(F.col("low").alias("l"), middle.alias("h")), F.struct(middle.alias("l"), F.col("high").alias("h"))))
        live = marked.where("hot").select("word", "n", "m", halves).withColumnsRenamed({"l": "low", "h": "high"}).withColumn("key", _key())
    columns = ["key", "word", "n", "m", "low", "high"]
    out = live.select(columns)
    for rows in settled:
        out = out.unionByName(rows.select(columns))
    return out


def _composed(group: list[tuple], fsa: Acceptors) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest n of one, the smallest of those) of rows (word, n, m, low, high) of one key."""
    exact: dict[tuple, list[dict]] = {}
    for word, n, m, low, high in group:  # a key is a hash, so the parts themselves decide
        behind = max(m - high, 0)
        end = len(word) - behind
        own = exact.setdefault((m, low, high, word[:low], word[end:]), [{}, {}])
        own[len(word) - m][word[low:end]] = n
    for (m, _, high, head, tail), (short, long) in exact.items():
        if not short or len(short) + len(long) < 2:
            continue
        best: dict[tuple[int, str], list] = {}
        for u, v in fsa.near(sorted(short), sorted(long), high > m):
            longer = len(v) > len(u)
            nu, nv = short[u], long[v] if longer else short[v]
            for key, other, n in (((0, u), v, nv), ((int(longer), v), u, nu)):
                have = best.get(key)
                if have is None:
                    best[key] = [1, n, other]
                    continue
                have[0] += 1
                if n > have[1] or n == have[1] and head + other + tail < head + have[2] + tail:
                    have[1], have[2] = n, other
        for (_, u), (count, n, other) in best.items():
            yield head + u + tail, count, n, head + other + tail


def neighbours(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(word, n_near, top_n, top): near words of each word that has some, the largest n among them, and the smallest word with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "n_near", "top_n", "top"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        fsa, group, at, out = Acceptors(), [], None, []

        def flush(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "word", "n", "m", "low", "high"))):
                if key != at:
                    if len(group) > 1:
                        out.extend(_composed(group, fsa))
                        if len(fsa.final) > STATES:
                            fsa = Acceptors()
                        if len(out) > 20_000:
                            yield flush(out)
                            out = []
                    group, at = [], key
                group.append(row)
        if len(group) > 1:
            out.extend(_composed(group, fsa))
        if out:
            yield flush(out)

    states = initial_states(words, limit).repartition("key").sortWithinPartitions("key")
    found = states.mapInArrow(run, "word string, n_near long, top_n long, top string")
    best = F.min(F.struct((-F.col("top_n")).alias("down"), F.col("top").alias("top")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.down")).alias("top_n"), F.col("b.top").alias("top"))


def group_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = 2, ratio: int = 10, limit: int = LIMIT,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root): the words of all texts with their usual spellings.

    A word's form is its near word of largest n (ties: the smallest in code-point order) if that n
    is at least ``ratio`` times its own, else null; the root follows forms to the last, and is the
    word itself if it has none. Null and empty texts have no words, a null id counts as the empty
    string, repeated rows count each; an empty table gives no rows; other columns are ignored.
    """
    words = materialize(vocabulary(docs, min_length, min_count, id_col, text_col), "spell-words")
    near = neighbours(words, limit)
    rows = words.join(near, "word", "left")
    usual = (F.col("top_n") >= ratio * F.col("n"))
    rows = materialize(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   F.when(usual, F.col("top")).alias("form"), F.when(usual, F.col("top_n")).alias("form_n")), "spell-forms")
    # n grows by the ratio with each step, so paths are short; each round doubles their length
    links = materialize(rows.where("form IS NOT NULL").select("word", F.col("form").alias("to")), "spell-links")
    while True:
        step = links.select(F.col("word").alias("to"), F.col("to").alias("further"))
        joined = materialize(links.join(step, "to", "left"), "spell-links")
        moved = not joined.where("further IS NOT NULL").isEmpty()
        discard(links)
        links = joined.select("word", F.coalesce("further", "to").alias("to"))
        links._scratch = joined._scratch
        if not moved:
            break
    return rows.join(links, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("to", "word").alias("root"))
