"""Quality classifier by co-training of a text view and a metadata view.

The content view is a logistic regression on hashed words, stripped punctuation runs and
immediate repetitions; the metadata view one on language, source, length and layout. Each round
both are fitted, each labels the rows of an unlabelled pool it is most sure of, and hands them
to the other view. Afterwards each view is calibrated on held-out labelled rows, a logistic
regression on the calibrated margins combines them, and every document is scored.

Training sees bounded samples only: ``max_labelled`` labelled rows and ``max_pool`` unlabelled
ones, chosen by a hash of the id. Scoring covers every row and whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import among, slices, texts
from adlake.llm.linear import Dense, Sparse, logistic, margin, newton_logistic, sigmoid

DIMENSION = 1 << 16
#: A hashed feature is used if it is in so many labelled rows and deviates by so many standard errors from the classes' shares.
LEAST_ROWS, LEAST_Z = 5, 3.5
MEMO_ENTRIES = 500_000
EDGE = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_META_LANG, _META_SOURCE = 8, 32
META_DIMENSION = 7 + _META_LANG + _META_SOURCE
_UPPER = bytes(range(65, 91))
_ALNUM = bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]) + b" \t\n\r"


def _word_features(word: bytes) -> tuple[int, ...]:
    core, end = word.strip(EDGE), word[len(word.rstrip(EDGE)):]
    return tuple(zlib.crc32(x) % DIMENSION for x in (core, b"\0" + end[:3]) if x.strip(b"\0"))


def content_features(text: str, used: np.ndarray | None = None, memo: dict[bytes, tuple[int, ...]] | None = None) -> np.ndarray:
    """Distinct hashed features of a whole text; with ``used`` only those a model has weights for."""
    words = text.encode("utf-8", "replace").lower().split()
    memo = {} if memo is None else memo
    found: set[int] = set()
    for w in set(words):
        own = memo.get(w)
        if own is None:
            own = _word_features(w)
            if used is not None:
                own = tuple(f for f in own if used[f])
            if len(memo) >= MEMO_ENTRIES:
                memo.clear()
            memo[w] = own
        if own:
            found.update(own)
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    if repeats:
        found.add(zlib.crc32(b"\1repeat%d" % min(9, 20 * repeats // len(words))) % DIMENSION)
    return np.fromiter(found, np.int64, len(found))


def meta_features(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """Language, source, length and layout of a document."""
    b = text.encode("utf-8", "replace")
    lines, size = b.count(b"\n") + 1, len(b)
    out = np.zeros(META_DIMENSION)
    out[:7] = (np.log1p(size) / 10, np.log1p(lines) / 5, np.log1p(size / lines) / 8, (size - len(b.translate(None, _UPPER))) / (size + 50),
               len(b.translate(None, _ALNUM)) / (size + 50), b.count(b" ") / (size + 50), 1.0 if size < 80 else 0.0)
    out[7 + zlib.crc32((lang or "").encode()) % _META_LANG] = 1
    out[7 + _META_LANG + zlib.crc32((source or "").encode()) % _META_SOURCE] = 0.5
    return out


@dataclass
class Model:
    """Both views, their calibrations, the weights that combine them, and the threshold of the verdict."""

    content: np.ndarray
    meta: np.ndarray
    calibration: np.ndarray  # 2 x (slope, offset)
    combine: np.ndarray
    threshold: float
    added: tuple[int, int] = (0, 0)

    def score(self, rows: list[np.ndarray], meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of being good by content, by metadata, and together."""
        m = np.stack([margin(Sparse(rows, unit=True), self.content), margin(Dense(meta), self.meta)], axis=1)
        c = m * self.calibration[:, 0] + self.calibration[:, 1]
        return sigmoid(c[:, 0]), sigmoid(c[:, 1]), sigmoid(c @ self.combine[:2] + self.combine[2])


def telling(x: Sparse, y: np.ndarray) -> np.ndarray:
    """Which hashed features are frequent enough and differ enough between the classes to learn from."""
    n, bad, share = x.back(np.ones(len(y)), DIMENSION), x.back(1 - y, DIMENSION), (1 - y).mean()
    return (n >= LEAST_ROWS) & (np.abs(bad - n * share) > LEAST_Z * np.sqrt(np.maximum(n, 1) * share * (1 - share)))


def train(rows: list[np.ndarray], meta: np.ndarray, y: np.ndarray, rounds: int = 3, sure: float = 0.97, add: int = 150,
          max_false_reject: float = 0.004) -> Model | None:
    """Co-train on labelled (y 0/1) and unlabelled (y -1) rows; None without labelled rows of both kinds."""
    known = np.flatnonzero(y >= 0)
    hold = known[np.arange(len(known)) % 3 == 2]
    base = np.setdiff1d(known, hold)
    if len(set(y[base].tolist())) < 2 or len(set(y[hold].tolist())) < 2:
        return None
    pool = set(np.flatnonzero(y < 0).tolist())
    extra: list[dict[int, int]] = [{}, {}]  # pseudo-labels handed to each view

    def fit(view: int) -> np.ndarray:
        own = np.array([*base.tolist(), *extra[view]], dtype=np.int64)
        target = np.array([*y[base].tolist(), *extra[view].values()], dtype=float)
        trust = np.where(np.arange(len(own)) < len(base), 1.0, 0.3)
        if view:
            return logistic(Dense(meta[own]), target, META_DIMENSION, trust, l2=1e-5)
        used = telling(Sparse([rows[i] for i in base], unit=True), y[base].astype(float))
        return logistic(Sparse([rows[i][used[rows[i]]] for i in own], unit=True), target, DIMENSION, trust, l2=1e-5, steps=200)

    views = [fit(0), fit(1)]
    for _ in range(rounds):
        left = sorted(pool)
        if not left:
            break
        chances = [sigmoid(margin(Sparse([rows[i] for i in left], unit=True), views[0])), sigmoid(margin(Dense(meta[left]), views[1]))]
        for view in (0, 1):
            p, to = chances[view], extra[1 - view]
            for label, order in ((1, np.argsort(-p, kind="stable")), (0, np.argsort(p, kind="stable"))):
                confident = p >= sure if label else p <= 1 - sure
                for k in [k for k in order.tolist() if confident[k]][:add]:
                    to[left[k]] = label
        pool -= set(extra[0]) & set(extra[1])
        views = [fit(0), fit(1)]
    target = y[hold].astype(float)
    m = np.stack([margin(Sparse([rows[i] for i in hold], unit=True), views[0]), margin(Dense(meta[hold]), views[1])], axis=1)
    calibration = np.stack([newton_logistic(m[:, [v]], target) for v in (0, 1)])
    c = m * calibration[:, 0] + calibration[:, 1]
    combine = newton_logistic(c, target)
    good = sigmoid(c @ combine[:2] + combine[2])[target > 0]
    cut = float(np.quantile(good, max_false_reject, method="lower"))
    return Model(views[0], views[1], calibration, combine, min(0.5, cut), (len(extra[0]), len(extra[1])))


def _columns(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    have = set(docs.columns)
    pick = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), pick(lang_col).alias("lang"), pick(source_col).alias("source"))


def _featured(part: pa.RecordBatch, used: np.ndarray | None = None, memo: dict | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    own = texts(part, "text")
    meta = [meta_features(t, a, b) for t, a, b in zip(own, part.column("lang").to_pylist(), part.column("source").to_pylist())]
    return [content_features(t, used, memo) for t in own], np.array(meta).reshape(-1, META_DIMENSION)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 14_000, max_pool: int = 2000, **options) -> Model | None:
    """Model from at most ``max_labelled`` labelled and ``max_pool`` unlabelled rows of ``docs`` (doc_id, text, lang, source).

    Good: quality 1 and not toxic (null toxic counts as 0). Several labels of a document count as
    the worst. Null labels are ignored.
    """
    good = (F.col("quality") > 0) & (F.coalesce("toxic", F.lit(0)) == 0)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min(good.cast("int")).alias("y"))
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().join(known, "doc_id", "left").select("doc_id", F.coalesce("y", F.lit(-1)).alias("y"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sample = ids.where("y >= 0").orderBy(*order).limit(max_labelled).unionByName(ids.where("y < 0").orderBy(*order).limit(max_pool))
    chosen = {r["doc_id"]: r["y"] for r in sample.collect()}  # at most max_labelled + max_pool pairs
    if not chosen:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, tuple[int, ...]] = {}
        for part in slices(batches, "text"):
            rows, meta = _featured(part, None, memo)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(rows, pa.list_(pa.int32())), pa.array(list(meta), pa.list_(pa.float64()))], ["doc_id", "c", "m"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = among(docs, list(chosen)).mapInArrow(run, f"doc_id {kind}, c array<int>, m array<double>").toArrow().combine_chunks()
    ids = got.column("doc_id").to_pylist()
    order = sorted(range(len(ids)), key=ids.__getitem__)
    unique = [k for before, k in zip([None, *order], order) if before is None or ids[before] != ids[k]]
    unique = [unique[i] for i in np.random.default_rng(5).permutation(len(unique))]

    def lists(name: str) -> list[np.ndarray]:
        column = got.column(name).chunk(0)
        ends, values = column.offsets.to_numpy(), column.values.to_numpy()
        return [values[ends[k]:ends[k + 1]] for k in unique]

    return train(lists("c"), np.array(lists("m")), np.array([chosen[ids[k]] for k in unique]), **options) if ids else None


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          **options) -> DataFrame:
    """(doc_id, p_content, p_meta, p_good, kept) for every row of ``docs``; options as in ``fit`` and ``train``.

    Null and empty texts are scored like any other (no content feature). Without labelled rows of
    both kinds nothing can be learned: the probabilities are null and every row is kept. Repeated
    rows stay repeated; an empty table gives no rows; missing lang or source columns read as null;
    further columns are ignored.
    """
    rows = _columns(docs, id_col, text_col, lang_col, source_col)
    model = fit(rows, labels, **options)
    if model is None:
        none = F.lit(None).cast("double")
        return rows.select("doc_id", none.alias("p_content"), none.alias("p_meta"), none.alias("p_good"), F.lit(True).alias("kept"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, memo = shipped.value.content[:-1] != 0, {}
        for part in slices(batches, "text"):
            a, b, both = shipped.value.score(*_featured(part, used, memo))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(a), pa.array(b), pa.array(both), pa.array(both >= shipped.value.threshold)],
                ["doc_id", "p_content", "p_meta", "p_good", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, p_content double, p_meta double, p_good double, kept boolean")


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
         **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns, filtered in place without a shuffle."""
    model = fit(_columns(docs, id_col, text_col, lang_col, source_col), labels, **options)
    if model is None:
        return docs
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, memo = shipped.value.content[:-1] != 0, {}
        for part in slices(batches, text_col):
            none = pa.nulls(part.num_rows, pa.string())
            view = pa.RecordBatch.from_arrays(
                [part.column(text_col), *(part.column(c).cast(pa.string()) if c in part.schema.names else none for c in (lang_col, source_col))],
                ["text", "lang", "source"])
            yield part.filter(pa.array(shipped.value.score(*_featured(view, used, memo))[2] >= shipped.value.threshold))

    return docs.mapInArrow(run, docs.schema)
