"""Mixing documents to target domain weights by soft membership.

A softmax classifier on hashed byte pairs, trained on a bounded sample of a labelled table,
gives every document posteriors over the domains. Nonnegative rates r, one a document, are
fitted so that the expected tokens of each domain, sum(r * tokens * posterior), match its target.

The fit is projected gradient least squares from r = 1. Residuals are weighted with the inverse
of the token-weighted Gram matrix of the posteriors, so a plain step solves the unclipped problem.
Later ones choose between the plain step, which always comes closer, and steps with the Gram matrix
of the rows whose rate is positive, which solve the problem for those. The fit ends when targets
are met or a plain step moves no rate, and says how far from the targets it ended. A document's rate depends on its posteriors
and on the sequence of step vectors alone, so a pass is one aggregate over the table of
posteriors and only (domains) numbers reach the driver; no rate table is rewritten.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from adlake.llm.common import among, materialize, numbered, slices, texts
from adlake.llm.linear import multinomial, softmax

DIMENSION = 1024
#: Feature rows that a task holds at a time, however short the texts are.
ROWS_AT_ONCE = 256

#: Target shares of tokens by domain used by the registered query and the pipeline.
TARGETS = {"en": 0.55, "fr": 0.18, "de": 0.15, "es": 0.12}


def text_features(text: str) -> np.ndarray:
    """Hashed byte-pair histogram of a whole text (A-Z lower-cased), square-rooted and scaled to length one."""
    return _scaled(pair_counts(text))


def pair_counts(text: str) -> np.ndarray:
    """Counts of the hashed byte pairs of a whole text (A-Z lower-cased)."""
    b = np.frombuffer(text.encode("utf-8", "replace").lower(), dtype=np.uint8)
    if len(b) < 2:
        return np.zeros(DIMENSION, dtype=np.int64)
    pairs = (b[:-1].astype(np.uint32) << 8 | b[1:]) * np.uint32(2654435761) >> np.uint32(22)
    return np.bincount(pairs, minlength=DIMENSION)


def _scaled(counts: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts.astype(float))
    return x / (np.linalg.norm(x) or 1.0)


@dataclass
class Mix:
    """Domains, classifier, and the step vectors found so far."""

    domains: list[str]
    weights: np.ndarray | None
    steps: list[list[float]] = field(default_factory=list)
    residual: float = 0.0

    def posteriors(self, own: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full((len(own), len(self.domains)), 1 / max(len(self.domains), 1))
        out = np.empty((len(own), len(self.domains)))
        x = np.ones((min(len(own), ROWS_AT_ONCE), DIMENSION + 1))
        for at in range(0, len(own), ROWS_AT_ONCE):
            some = own[at:at + ROWS_AT_ONCE]
            for row, t in zip(x, some):
                row[:-1] = text_features(t)
            out[at:at + len(some)] = softmax(x[:len(some)] @ self.weights)
        return out

    def exact_rate(self, p: str = "p") -> Column:
        """Rate of a row with posteriors in the array column ``p``."""
        r = F.lit(1.0)
        for g in self.steps:
            r = moved(r, p, g)
        return r

    def rate(self, p: str = "p") -> Column:
        return F.round(self.exact_rate(p), 6)


def moved(rate: Column, p: str, step: list[float]) -> Column:
    """``rate`` after a projected step."""
    return F.greatest(F.lit(0.0), rate - sum((F.col(p)[d] * F.lit(float(v)) for d, v in enumerate(step)), F.lit(0.0)))


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], max_labelled: int = 4000) -> Mix:
    """Domain classifier from at most ``max_labelled`` rows of ``labelled`` (doc_id, domain), chosen by a hash of the id.

    Rows with a null id, a null domain or a domain without target are ignored; a document with
    several domains counts as the first by name. Without labelled rows posteriors are uniform.
    """
    known = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    chosen = {r["doc_id"]: domains.index(r["domain"]) for r in known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).collect()}
    if not chosen:
        return Mix(domains, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            # only the pairs that occur: a row is a few KB on its way to the driver
            n = [pair_counts(t) for t in texts(part, "text")]
            at = [np.flatnonzero(row) for row in n]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(at, pa.list_(pa.int16())), pa.array([row[a] for row, a in zip(n, at)], pa.list_(pa.int64()))], ["doc_id", "at", "n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = among(docs.select("doc_id", "text"), list(chosen)).mapInArrow(run, f"doc_id {kind}, at array<short>, n array<long>").toArrow()
    if not got.num_rows:
        return Mix(domains, None)
    ids, x = got.column("doc_id").to_pylist(), np.ones((got.num_rows, DIMENSION + 1))
    k = 0
    for batch in got.to_batches():  # straight into the matrix, no Python numbers
        for at, n in zip(batch.column("at"), batch.column("n")):
            counts = np.zeros(DIMENSION, dtype=np.int64)
            counts[at.values.to_numpy()] = n.values.to_numpy()
            x[k, :-1] = _scaled(counts)
            k += 1
    del got
    order = sorted(range(len(ids)), key=lambda i: (ids[i], x[i, :8].tolist()))
    return Mix(domains, multinomial(x[order], np.array([chosen[ids[i]] for i in order]), len(domains)))


def with_posteriors(docs: DataFrame, mix: Mix, text_col: str = "text") -> DataFrame:
    """``docs`` with _t (words between ASCII white space) and _p (posteriors) added."""
    shipped = docs.sparkSession.sparkContext.broadcast((mix.domains, mix.weights))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Mix(*shipped.value)
        for part in slices(batches, text_col):
            own = texts(part, text_col)
            n = [len(t.encode("utf-8", "replace").split()) for t in own]
            p = pa.array(list(model.posteriors(own)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64()), p], [*names, "_t", "_p"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("_t", LongType()), StructField("_p", ArrayType(DoubleType()))]))


def fit(posteriors: DataFrame, mix: Mix, targets: dict[str, float], total: float | None = None, max_steps: int = 40, tolerance: float = 1e-6) -> Mix:
    """Find the steps; ``posteriors`` has (_t, _p). ``total``: tokens to aim at, by default those there are.

    Shares are scaled to one. A domain that no document belongs to can't be reached; the others
    are then matched as well as least squares allows. ``mix.residual`` is the largest miss of a
    domain as a share of all tokens.
    """
    n = len(mix.domains)
    p = [F.col("_p")[d] for d in range(n)]

    def sums(rate: Column) -> list[Column]:
        """Tokens of each domain, and the Gram matrix of rows with a positive rate."""
        free = F.col("_t") * (rate > 0).cast("int")
        return [*(F.sum(rate * F.col("_t") * p[d]) for d in range(n)), *(F.sum(free * p[a] * p[b]) for a in range(n) for b in range(n))]

    first = posteriors.agg(F.sum("_t"), *sums(F.lit(1.0))).first()
    if not first[0]:
        return mix
    share = np.array([targets[d] for d in mix.domains], dtype=float)
    goal = share / share.sum() * (first[0] if total is None else total)
    now, free = np.array(first[1:n + 1], dtype=float), np.array(first[n + 1:], dtype=float).reshape(n, n)
    floor = 1e-9 * np.trace(free) / n
    inverse = np.linalg.pinv(free + floor * np.eye(n))
    mix.residual = float(np.abs(now - goal).max() / goal.sum())
    while mix.residual >= tolerance and len(mix.steps) < max_steps:
        plain = inverse @ (now - goal)
        newton = np.linalg.pinv(free + (1e-9 * np.trace(free) / n + 1e-6 * floor) * np.eye(n)) @ (now - goal)
        tried = [[float(v) for v in step] for step in (plain, newton, newton / 4)]
        rated = posteriors.select("_t", "_p", mix.exact_rate("_p").alias("_r"))
        rated = rated.select("*", *[moved(F.col("_r"), "_p", step).alias(f"_r{k}") for k, step in enumerate(tried)])
        got = rated.agg(F.sum(F.col("_t") * F.pow(F.col("_r0") - F.col("_r"), 2)), *[c for k in range(len(tried)) for c in sums(F.col(f"_r{k}"))]).first()
        if (got[0] / first[0]) ** 0.5 < 0.1 * tolerance:
            break  # the projected gradient is zero: as close as least squares comes
        ends = np.array(got[1:], dtype=float).reshape(len(tried), n + n * n)
        misses = [float(d @ inverse @ d) for d in ends[:, :n] - goal]
        best = int(np.argmin(misses))
        if misses[best] >= float((now - goal) @ inverse @ (now - goal)):
            break  # nothing closer in double precision
        mix.steps.append(tried[best])
        now, free = ends[best, :n], ends[best, n:].reshape(n, n)
        mix.residual = float(np.abs(now - goal).max() / goal.sum())
    return mix


def solve(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
          max_labelled: int = 4000, total: float | None = None) -> tuple[Mix, DataFrame]:
    """(fitted mix, table of (doc_id, _t, _p) for every row of ``docs``)."""
    targets = TARGETS if targets is None else targets
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    mix = train(rows, labelled, sorted(targets), max_labelled)
    table = materialize(with_posteriors(rows, mix).drop("text"), "mix-posteriors")
    return fit(table, mix, targets, total), table


def copies(rate: Column, id_col: Column) -> Column:
    """Whole copies of a document: the rate rounded up or down by a hash of the id, right on average."""
    u = F.pmod(F.xxhash64(id_col, F.lit("mix")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, **options) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>..., rate, copies, residual) for every row of ``docs``.

    residual, the same in every row, is the largest miss of a domain's target as a share of all tokens.

    Null and empty texts have no tokens and uniform-looking posteriors; they get a rate like any
    other. Repeated rows stay repeated; an empty table gives no rows; other columns are ignored.
    """
    mix, table = solve(docs, labelled, targets, **options)
    return table.select(
        "doc_id", F.col("_t").alias("n_tokens"), *[F.col("_p")[d].alias(f"p_{name}") for d, name in enumerate(mix.domains)],
        mix.rate("_p").alias("rate"), copies(mix.rate("_p"), F.col("doc_id")).alias("copies"),
        F.lit(mix.residual).alias("residual"))


def apply(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` mixed: each row as often as its copies say. Texts are classified again in place, not shuffled.

    Null and empty texts are rated like any other, rows without an id share one rounding, each of
    several equal rows is copied by itself, an empty table stays empty. All columns of ``docs``
    come back, whatever their names.
    """
    mix, _ = solve(docs, labelled, targets, id_col=id_col, text_col=text_col, **options)
    rows, (i, text) = numbered(docs, id_col, text_col)
    many = with_posteriors(rows, mix, text).withColumn("n", copies(mix.rate("_p"), F.col(i))).where("n > 0")
    return many.select(*rows.columns, F.explode(F.expr("sequence(1L, n)")).alias("n")).drop("n").toDF(*docs.columns)
