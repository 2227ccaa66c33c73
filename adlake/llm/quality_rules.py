"""Document quality by rules plus an isolation forest over the rules' statistics.

One pass computes the rule statistics of every whole text. Forests of random split trees are
grown on labelled rows, one for each group of statistics (GROUPS), as in a single forest the
ordinary spread of one statistic hides the others; each tree isolates its own few rows, drawn from
all labelled ones, as the method has it. The anomaly score of a document in each forest is
2 ** (-mean path length / expected path length). Every labelled row is scored and counted: the
score thresholds are those that together reject most labelled bad rows while rejecting at most
``max_false_reject`` of labelled good ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import discard, materialize, slices, texts

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
WINDOW = 5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_lower", "n_marks", "n_lines", "n_stutter")
#: Words, letters and lines added to the ratios' divisors, so that one capitalised key in a short text is not an anomaly.
PRIOR_WORDS, PRIOR_LETTERS, PRIOR_LINES = 10, 400, 5
#: Columns of ``features`` that share a forest.
GROUPS = ((0, 1, 2), (3, 4, 5), (6,))
#: Scores are counted in steps of 1 / GRID before those near a threshold are told apart.
GRID = 1 << 16
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], dtype=np.uint64)


def repeated_window_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside a ``width``-word window that occurs at least twice, the first included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.uint64)
    with np.errstate(over="ignore"):
        code = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            x = ids[k:k + n] + np.uint64(k + 1)
            x = (x ^ (x >> np.uint64(15))) * _MIX[k]
            code += x ^ (x >> np.uint64(29))
    order = np.sort(code)
    dup = order[1:][order[1:] == order[:-1]]
    if not dup.size:
        return 0
    at = np.flatnonzero(np.isin(code, dup))  # equal codes: compare the words themselves
    rows = np.stack([ids[at + k] for k in range(width)], axis=1)
    _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    at = at[counts[inverse.reshape(-1)] > 1]
    covered = np.zeros(len(words), dtype=bool)
    for k in range(width):
        covered[at + k] = True
    return int(covered.sum())


def _count(b: bytes, chars: bytes) -> int:
    return len(b) - len(b.translate(None, chars))


def statistics(text: str) -> tuple[int, ...]:
    """BASE then EXTRA of one whole text."""
    b = text.encode("utf-8", "replace")
    words = b.split()
    worded = [x for x in b.split(b"\n") if x.strip()]
    return (len(words), len(text) - _count(b, SPACE), _count(b, SYMBOLS), len(worded) - len(set(worded)),
            repeated_window_words(words), _count(b, UPPER), _count(b, LOWER), _count(b, b"!?"), len(worded), sum(map(eq, words, islice(words, 1, None))))


def _measured(part: pa.RecordBatch, text_col: str) -> np.ndarray:
    return np.array([statistics(t) for t in texts(part, text_col)], dtype=np.int64).reshape(-1, len(BASE) + len(EXTRA))


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, BASE..., EXTRA...) for every row; null text counts as empty."""
    names = [*BASE, *EXTRA]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = _measured(part, "text")
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(found[:, k]) for k in range(len(names)))], ["doc_id", *names])

    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def features(stat: np.ndarray) -> np.ndarray:
    """Features of rows of BASE + EXTRA, in the order GROUPS counts them.

    Shares of symbols, capitals and shouting marks; share of duplicate lines, share of words in
    repeated windows and mean word length; share of words that repeat the one before.
    """
    s = dict(zip([*BASE, *EXTRA], stat.T.astype(float)))
    words = s["n_words"] + PRIOR_WORDS
    return np.stack([
        s["n_symbols"] / words, s["n_upper"] / (s["n_upper"] + s["n_lower"] + PRIOR_LETTERS), s["n_marks"] / words,
        s["n_dup_lines"] / (s["n_lines"] + PRIOR_LINES), s["n_repeat_words"] / words, s["word_chars"] / np.maximum(s["n_words"], 1),
        s["n_stutter"] / words], axis=1)


def _expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    h = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Array form of the trees: split feature (-1: leaf), cut, left child, and path length at leaves."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    path: np.ndarray
    norm: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1) of every row."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for f, c, l, p in zip(self.feature, self.cut, self.left, self.path):
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                at = f[node]
                inner = at >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(at, 0)] >= c[node]
                node = np.where(inner, l[node] + right, node)
            total += p[node]
        return 2.0 ** (-total / len(self.feature) / max(self.norm, 1e-9))


def grow_forest(x: np.ndarray, trees: int = 200, sample: int = 256, seed: int = 7) -> Forest:
    """Isolation forest: each tree splits a random subsample at random cuts of random features."""
    rng = np.random.default_rng(seed)
    sample = min(sample, len(x))
    depth = int(np.ceil(np.log2(max(sample, 2))))
    size, used = 2 ** (depth + 1), 1  # small arrays: every executor holds them
    out = {k: np.zeros((trees, size), dtype=d) for k, d in (("feature", np.int8), ("cut", float), ("left", np.int32), ("path", float))}
    out["feature"][:] = -1
    for t in range(trees):
        todo, free = [(0, rng.choice(len(x), sample, replace=False), 0)], 1
        while todo:
            node, rows, d = todo.pop()
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            varied = np.flatnonzero(high > low)
            if d >= depth or len(rows) < 2 or not varied.size:
                out["path"][t, node] = d + _expected_path(np.array([len(rows)]))[0]
                continue
            f = int(rng.choice(varied))
            cut = rng.uniform(low[f], high[f])
            cut = cut if cut > low[f] else high[f]
            right = x[rows, f] >= cut
            out["feature"][t, node], out["cut"][t, node], out["left"][t, node] = f, cut, free
            todo += [(free, rows[~right], d + 1), (free + 1, rows[right], d + 1)]
            free += 2
        used = max(used, free)
    out = {k: v[:, :used].copy() for k, v in out.items()}
    return Forest(**out, norm=float(_expected_path(np.array([sample]))[0]))


def _exact(good: DataFrame, forest: int, ranks: list[int], counts: dict[int, int]) -> list[float]:
    """The scores of ``good`` in one forest that ``ranks`` rows (ascending) precede from above; ``counts`` has its rows by GRID step."""
    steps = sorted(counts, reverse=True)
    start = np.cumsum([0, *(counts[s] for s in steps)])  # rows above each step
    wanted = sorted({steps[i] for i in np.searchsorted(start, ranks, side="right") - 1})
    score = F.col("scores")[forest]
    rows = good.where(F.floor(score * GRID).isin(wanted)).groupBy(score.alias("score")).count().collect()
    above, found = {s: int(start[i]) for i, s in enumerate(steps)}, []
    for r in sorted(rows, key=lambda r: -r["score"]):
        step = int(np.floor(r["score"] * GRID))
        found.append((above[step], r["score"]))
        above[step] += r["count"]
    at = np.searchsorted([n for n, _ in found], ranks, side="right") - 1
    return [found[i][1] for i in at]


def calibrate(scored: DataFrame, forests: int, max_false_reject: float, steps: int = 8) -> np.ndarray:
    """Threshold of each forest above which rows are rejected, counted over every row of ``scored``.

    ``scored`` has (good, passed, scores): label, base rules, and the score in each forest. Of the
    good rows that ``passed`` the base rules at most a share of ``max_false_reject`` lies above any
    threshold. All start above every such row; the one that rejects most further bad rows for each
    good row given up is lowered, until none helps or the share is used up. Only counts reach the
    driver: of GRID steps, of the scores in those with a candidate, and of rows between candidates.
    """
    passed = scored.where("passed")
    found = passed.where("good").select(F.posexplode(F.transform("scores", lambda s: F.floor(s * GRID))).alias("forest", "step")).groupBy(
        "forest", "step").count().collect()
    if not found or scored.where("NOT good").isEmpty():
        return np.ones(forests)  # nothing to calibrate against: the forests reject nothing
    n_good = sum(r["count"] for r in found if r["forest"] == 0)
    limit = int(max_false_reject * n_good)
    unit = max(1, limit // steps)
    ranks = [r for r in range(0, 2 * limit + 1, unit) if r < n_good]
    levels = [_exact(passed.where("good"), k, ranks, {r["step"]: r["count"] for r in found if r["forest"] == k}) for k in range(forests)]
    above = F.array(*[sum((F.lit(c) >= F.col("scores")[k]).cast("int") for c in cuts) for k, cuts in enumerate(levels)])
    rows = passed.groupBy("good", above.alias("above")).count().collect()
    # a row lies above its forest's cuts from number ``first`` on
    first, good, n = np.array([r["above"] for r in rows]), np.array([r["good"] for r in rows]), np.array([r["count"] for r in rows])
    at = np.zeros(forests, dtype=np.int64)

    def rejected(at: np.ndarray, kind: np.ndarray) -> int:
        return int(n[kind & (first <= at).any(axis=1)].sum())

    while True:
        caught, best = rejected(at, ~good), None
        for k in range(forests):
            for more in range(1, len(levels[k]) - at[k]):
                tried = at.copy()
                tried[k] += more
                if rejected(tried, good) > limit:
                    break
                gain = (rejected(tried, ~good) - caught) / (more * unit)
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, tried)
        if best is None:
            return np.array([cuts[a] for cuts, a in zip(levels, at)])
        at = best[1]


@dataclass
class Rules:
    """The fitted judge: base rules need no fit; without forests they alone reject."""

    forests: tuple[Forest, ...] = ()
    thresholds: np.ndarray | None = None

    def verdicts(self, stat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(base_failed, kept, anomaly) for rows of BASE + EXTRA; anomaly: the largest score in units of its threshold, rejected above 1."""
        failed = _base_failed(stat)
        score = (forest_scores(self.forests, features(stat)) / self.thresholds).max(axis=1) if self.forests and len(stat) else np.zeros(len(stat))
        return failed, ~failed & (score <= 1), score


def _base_failed(stat: np.ndarray) -> np.ndarray:
    words, repeated = stat[:, 0], stat[:, 4]
    return (words < 10) | (100 * repeated > 20 * words)


def forest_scores(forests: tuple[Forest, ...], x: np.ndarray) -> np.ndarray:
    """Anomaly scores, a column for each of GROUPS."""
    return np.stack([f.score(x[:, list(group)]) for f, group in zip(forests, GROUPS)], axis=1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_false_reject: float = 0.002, trees: int = 200, sample: int = 256) -> Rules:
    """Grow the forests on labelled rows of ``docs`` and calibrate their thresholds on all of them.

    ``labels`` has (doc_id, quality 0/1); null labels are ignored and several labels of a document
    count as their minimum. Without labelled rows of both kinds the forests reject nothing.
    """
    stats = materialize(rule_statistics(docs, id_col, text_col), "rule-statistics")
    try:
        return _fit(stats, labels, max_false_reject, trees, sample)
    finally:
        discard(stats)


def _fit(stats: DataFrame, labels: DataFrame, max_false_reject: float = 0.002, trees: int = 200, sample: int = 256) -> Rules:
    """``fit`` from the stored rows of ``rule_statistics``."""
    names = [*BASE, *EXTRA]
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    labelled = stats.join(known, "doc_id").select("doc_id", *names, "good")
    # each tree draws its rows from as many as all trees hold, the first by a hash of the id
    drawn = labelled.orderBy(F.xxhash64("doc_id"), "doc_id", *names).limit(trees * sample).toArrow()
    if not drawn.num_rows:
        return Rules()
    stat = np.stack([drawn.column(n).to_numpy() for n in names], axis=1)
    x = features(stat[np.lexsort((*stat.T, np.array(drawn.column("doc_id").to_pylist())))])  # the order decides the trees
    forests = tuple(grow_forest(x[:, list(group)], trees, sample, seed=7 + k) for k, group in enumerate(GROUPS))
    shared = stats.sparkSession.sparkContext.broadcast(forests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            stat = _rows(part)
            scores = forest_scores(shared.value, features(stat))
            yield pa.RecordBatch.from_arrays(
                [part.column("good"), pa.array(~_base_failed(stat)), pa.array(list(scores), pa.list_(pa.float64()))], ["good", "passed", "scores"])

    scored = materialize(labelled.mapInArrow(run, "good boolean, passed boolean, scores array<double>"), "rule-scores")
    try:
        return Rules(forests, calibrate(scored, len(forests), max_false_reject))
    finally:
        discard(scored)


def _rows(part: pa.RecordBatch) -> np.ndarray:
    return np.stack([part.column(n).to_numpy() for n in (*BASE, *EXTRA)], axis=1)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, BASE..., base_failed, kept, anomaly) for every row of ``docs``; options as in ``fit``.

    Null and empty texts have no words, so they fail the base rules. Repeated rows each get a row;
    an empty table gives no rows; other columns are ignored.
    """
    stats = materialize(rule_statistics(docs, id_col, text_col), "rule-statistics")
    rules = docs.sparkSession.sparkContext.broadcast(_fit(stats, labels, **options))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            failed, kept, score = rules.value.verdicts(_rows(part))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(part.column(n) for n in BASE), pa.array(failed), pa.array(kept), pa.array(score)],
                ["doc_id", *BASE, "base_failed", "kept", "anomaly"])

    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in BASE) + ", base_failed boolean, kept boolean, anomaly double"
    return stats.mapInArrow(run, schema)


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns, filtered in place without a shuffle."""
    rules = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            yield part.filter(pa.array(rules.value.verdicts(_measured(part, text_col))[1]))

    return docs.mapInArrow(run, docs.schema)
