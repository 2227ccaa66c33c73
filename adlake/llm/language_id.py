"""Language identification with error-correcting output codes.

Every language has a codeword of bits; one binary classifier per bit, a logistic regression on
hashed character n-grams, predicts it. Up to six languages use the exhaustive code (every way to
part them in two), more use the best of some random dense codes by its least distance.

Decoding is loss-weighted: a codeword's distance to a text is the sum over bits of the logistic
loss of the classifier's margin against the bit, weighted by how often that classifier is right on
validation rows of that language. The nearest codeword wins (ties: the smallest language). A text
is flagged as ambiguous if the next codeword is nearer than for all but a hundredth of the
validation rows decoded rightly.

Training sees at most ``max_rows`` rows, dealt evenly over the languages by a hash of the id;
prediction covers every row and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import among, slices, texts
from adlake.llm.linear import sigmoid

DIMENSION = 1 << 12
MAX_ROWS = 4000
FOLDS = 4
HELD_OUT = 2
UNKNOWN = "und"
#: Places that ids are hashed to for the sample, and how many times the rows wanted are ranked.
PLACES, SPARE = 1 << 40, 4
#: Bytes of a text whose n-grams are counted at a time.
CHUNK = 1 << 20
#: Languages up to which every bipartition is a bit.
EXHAUSTIVE = 6
_SPACED = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def _hashed(codes: np.ndarray, order: int) -> np.ndarray:
    mixed = (codes ^ np.uint32(order * 0x5BD1E995 & 0xFFFFFFFF)) * np.uint32(2654435761)
    return (mixed >> np.uint32(20)).astype(np.int64)


def ngram_profile(text: str) -> np.ndarray | None:
    """Square roots of the shares of hashed byte 1- to 3-grams of the lower-cased text; None if it has no letter.

    ASCII characters that are no letters count as blanks, and rows of blanks as one.
    """
    if not any(map(str.isalpha, text)):
        return None
    whole = (" " + text.lower() + " ").encode("utf-8", "replace").translate(_SPACED)
    counts = np.zeros(DIMENSION)
    for at in range(0, len(whole), CHUNK):
        b = np.frombuffer(whole[at:at + CHUNK + 2], np.uint8)
        b = b[np.append(True, (b[1:] != 32) | (b[:-1] != 32))].astype(np.uint32)
        two = (b[:-1] << np.uint32(8)) | b[1:]
        three = (two[:-1] << np.uint32(8)) | b[2:]
        for order, codes in ((1, b[b != 32]), (2, two), (3, three)):
            counts += np.bincount(_hashed(codes, order), minlength=DIMENSION)
    return np.sqrt(counts / counts.sum())


def codewords(classes: int, seed: int = 7, draws: int = 200) -> np.ndarray:
    """(classes x bits) of -1 and 1, distinct rows, no constant column."""
    if classes < 2:
        return np.zeros((classes, 0))
    if classes <= EXHAUSTIVE:
        bits = np.arange(1, 2 ** (classes - 1))
        rest = (bits[None, :] >> np.arange(classes - 1)[:, None]) & 1
        return np.vstack([np.full(len(bits), -1.0), 2.0 * rest - 1])
    rng, width = np.random.default_rng(seed), int(np.ceil(10 * np.log2(classes)))
    best, best_distance = None, -1.0
    for _ in range(draws):
        code = rng.choice([-1.0, 1.0], (classes, width))
        code = code[:, np.abs(code.sum(axis=0)) < classes]
        agree = code @ code.T
        np.fill_diagonal(agree, -width)
        distance = (code.shape[1] - agree.max()) / 2
        if distance > best_distance:
            best, best_distance = code, distance
    return best


def _loss(margins: np.ndarray, code: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(rows x classes) weighted logistic losses of margins (rows x bits) against every codeword."""
    hit, miss = np.logaddexp(0, -margins), np.logaddexp(0, margins)
    positive = code > 0
    return hit @ np.where(positive, weights, 0).T + miss @ np.where(positive, 0, weights).T


@dataclass
class Decoder:
    """Languages, ascending, with their codewords, the bits' classifiers and what validation rows taught."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray
    sharpness: float = 1.0
    least_gap: float = 0.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[:-1] + self.weights[-1]

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nearest and next codeword, the nearest one's share of the softmax of -losses, and their difference of losses."""
        loss = _loss(self.margins(x), self.code, self.trust)
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(x))
        near = loss[rows, order[:, 0]]
        share = 1 / np.exp(np.clip(-self.sharpness * (loss - near[:, None]), -700, 0)).sum(axis=1)
        if len(self.languages) < 2:
            return order[:, 0], order[:, 0], share, np.full(len(x), np.inf)
        return order[:, 0], order[:, 1], share, loss[rows, order[:, 1]] - near


def _bit_classifiers(x: np.ndarray, targets: np.ndarray, l2: float = 1e-5, steps: int = 150, rate: float = 0.5) -> np.ndarray:
    """Weights (the last row the constants) of one logistic regression per column of ``targets``, full-batch Adagrad."""
    w, seen = np.zeros((x.shape[1] + 1, targets.shape[1])), np.full((x.shape[1] + 1, targets.shape[1]), 1e-8)
    positive = targets > 0
    for _ in range(steps):
        e = (sigmoid(x @ w[:-1].astype(x.dtype) + w[-1]) - positive) / len(x)
        g = np.vstack([x.T @ e.astype(x.dtype) + l2 * w[:-1], e.sum(axis=0)])
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


def fit_decoder(x: np.ndarray, languages: list[str], validate: np.ndarray) -> Decoder:
    """Fit on profiles ``x`` (rows x DIMENSION) with their languages; ``validate`` marks the rows kept from the classifiers."""
    names = sorted(set(languages))
    own = np.array([names.index(v) for v in languages])
    code = codewords(len(names))
    learn = ~validate
    for k in range(len(names)):  # a language must not be left out of either part
        mine = own == k
        if validate[mine].all() or not validate[mine].any():
            learn = learn | mine
            validate = validate | mine
    weights = _bit_classifiers(x[learn], code[own[learn]])
    right = np.sign(x[validate] @ weights[:-1] + weights[-1]) == code[own[validate]]
    trust = np.array([(right[own[validate] == k].sum(axis=0) + 1) / ((own[validate] == k).sum() + 2) for k in range(len(names))]).reshape(code.shape)
    model = Decoder(names, code, weights, trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-12))
    loss = _loss(model.margins(x[validate]), code, model.trust)
    at = np.arange(len(loss)), own[validate]
    fit = {s: (-s * loss[at] - np.log(np.exp(-s * (loss - loss.min(axis=1, keepdims=True))).sum(axis=1)) + s * loss.min(axis=1)).mean() for s in (0.5, 1, 2, 4, 8, 16)}
    model.sharpness = float(max(fit, key=fit.get))
    near, _, _, gap = model.decode(x[validate])
    if len(names) > 1 and (near == own[validate]).any():
        model.least_gap = float(np.quantile(gap[near == own[validate]], 0.01))
    return model


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the remainder kept from learning; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def training_profiles(docs: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[np.ndarray, list[str], np.ndarray]:
    """Profiles, languages and validation marks of at most ``max_rows`` rows (one a language at least) that may be learnt from.

    Rows with an id, a text with a letter and a language, the held-out remainder left out. An id
    with several rows gives its smallest (language, text), so repeated ids can make the sample smaller. The languages and the chosen ids are
    collected; their number is bounded by ``max_rows`` or the number of languages.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    usable = rows.where("doc IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("doc")))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return np.zeros((0, DIMENSION)), [], np.zeros(0, bool)
    each = max(max_rows // len(sizes), 1)
    place = F.pmod(F.xxhash64("doc", F.lit(11)), F.lit(PLACES))
    # only about SPARE times the rows wanted of a language are ranked, so no task ranks a share of all rows
    near = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(PLACES, -(-SPARE * each * PLACES // n)))])
    ranked = usable.select("lang", "doc", place.alias("place")).where(F.col("place") < near[F.col("lang")]).distinct()
    ids = ranked.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc"))).where(F.col("at") <= each)
    chosen = among(usable, sorted({r["doc"] for r in ids.select("doc").collect()}), "doc")
    single = chosen.groupBy("doc").agg(F.min(F.struct("lang", "text")).alias("r")).select("doc", "r.*", F.crc32(F.col("doc").cast("string").cast("binary")).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [ngram_profile(t) for t in texts(part, "text")]
            packed = [None if p is None else p.astype(np.float32)[p > 0].tobytes() for p in found]
            places = [None if p is None else np.flatnonzero(p).astype(np.int16).tobytes() for p in found]
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("h"), pa.array(packed, pa.binary()), pa.array(places, pa.binary())], ["lang", "h", "v", "i"])

    got = single.mapInArrow(run, "lang string, h long, v binary, i binary").where("v IS NOT NULL").collect()
    got.sort(key=lambda r: (r["h"], r["lang"], r["v"]))
    x = np.zeros((len(got), DIMENSION), np.float32)
    for k, r in enumerate(got):
        x[k, np.frombuffer(r["i"], np.int16)] = np.frombuffer(r["v"], np.float32)
    return x, [r["lang"] for r in got], np.array([r["h"] // FOLDS % 5 == 0 for r in got], bool)


def identify(docs: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, next_lang, ambiguous) for every row of ``docs``.

    ``lang_pred`` is a language of the rows learnt from, or ``und`` with score 0 if the text is
    null, has no letter, or nothing could be learnt. ``score`` is the nearest codeword's share of
    the softmax of -losses. ``next_lang`` is the next codeword's language, null if there is none.
    Predictions use the text only. A null id is neither held out nor learnt from; repeated rows
    are predicted alike; an empty table gives no rows; other columns are ignored. A single
    language learnt is predicted with score 1.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    x, languages, validate = training_profiles(docs, max_rows, id_col, text_col, lang_col)
    model = fit_decoder(x, languages, validate) if languages else None
    names = ["doc_id", "held_out", "lang_pred", "score", "next_lang", "ambiguous"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [None if model is None else ngram_profile(t) for t in texts(part, "text")]
            known = [k for k, p in enumerate(found) if p is not None]
            lang, score = [UNKNOWN] * len(found), [0.0] * len(found)
            following: list[str | None] = [None] * len(found)
            flag = [False] * len(found)
            for at in range(0, len(known), 256):
                some = known[at:at + 256]
                near, after, share, gap = model.decode(np.array([found[k] for k in some]))
                for k, a, b, s, g in zip(some, near.tolist(), after.tolist(), share.tolist(), gap.tolist()):
                    lang[k], score[k] = model.languages[a], s
                    if b != a:
                        following[k], flag[k] = model.languages[b], g < model.least_gap
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(following, pa.string()), pa.array(flag, pa.bool_())], names)

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, next_lang string, ambiguous boolean")
