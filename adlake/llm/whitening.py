"""Whitening directions of embeddings by a bidiagonal qd solver.

1. Blockwise QR: every task folds its centred rows into one triangle, R = qr([R; rows]), and a
   tree of grouped foldings joins the triangles of all tasks. Memory is one triangle and one batch.
2. Householder reflections from both sides bring the last triangle (width x width) to an upper
   bidiagonal B; the covariance's eigenvalues are B's squared singular values over n.
3. dqds, the differential qd algorithm with shifts, finds the squared singular values. It only
   adds, multiplies and divides positive numbers, so small ones come out as accurate as large ones.
4. A twisted factorisation of B'B - s I, joined where it is nearest to singular, gives each
   direction as products of its multipliers; reflections carry it back.

Steps 2 to 4 work on one triangle, whose size is the vectors' width and not their number. The
sums, the distinct vectors, the triangles and the projections are Spark's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import materialize

EPS = np.finfo(float).eps
#: Triangles joined at a time.
FAN_IN = 16
#: Rows of a batch folded at a time, in float64 entries.
BLOCK = 1 << 18
LONG_MAX = 2 ** 63 - 1


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal and right reflectors of U' r W; reflector k acts on places k + 1 onward."""
    a = np.array(r, dtype=float)
    d = a.shape[0]
    right: list[np.ndarray] = []

    def reflector(x: np.ndarray) -> np.ndarray:
        """v with (I - 2 v v') x along the first axis; zero if x is there already."""
        v = x.copy()
        scale = np.abs(x).max(initial=0.0)
        if scale == 0 or not x[1:].any():
            return np.zeros_like(x)
        v /= scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 1:
            w = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
            right.append(w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """One transform by ``shift``; None if the shift is beyond the least value."""
    n = len(q)
    nq, ne = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    least = d
    for k in range(n - 1):
        if d < 0:
            return None
        nq[k] = d + e[k]
        if nq[k] == 0:
            ne[k], d = 0.0, q[k + 1] - shift
        else:
            t = q[k + 1] / nq[k]
            ne[k] = e[k] * t
            d = d * t - shift
        least = min(least, d)
    if d < 0:
        return None
    nq[-1] = d
    return nq, ne, least


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal, falling, to high relative accuracy."""
    found: list[float] = []
    blocks = [(diagonal.astype(float) ** 2, above.astype(float) ** 2, 0.0)]
    while blocks:
        q, e, base = blocks.pop()
        least = 0.0
        while len(q):
            n = len(q)
            if n == 1:
                found.append(base + q[0])
                break
            tiny = e <= EPS * EPS * np.minimum(base + q[1:], base + q[:-1])
            if tiny[-1]:
                found.append(base + q[-1])
                q, e, least = q[:-1], e[:-1], 0.0
                continue
            if tiny.any():
                at = int(np.flatnonzero(tiny)[-1]) + 1
                blocks.append((q[:at], e[:at - 1], base))
                q, e, least = q[at:], e[at:], 0.0
                continue
            # the smaller eigenvalue of the last 2 x 2 block bounds the least one from above
            half = (q[-2] + e[-1] + q[-1]) / 2
            root = np.sqrt(max(half * half - q[-2] * q[-1], 0.0))
            corner = q[-2] * q[-1] / (half + root) if half + root > 0 else 0.0
            done = None
            for shift in (min(corner, least) * (1 - 1e-3) if least > 0 else 0.0, min(corner, least) / 4 if least > 0 else 0.0, 0.0):
                done = _dqds(q, e, shift)
                if done is not None:
                    break
            if done is None:  # only rounding can make an unshifted transform fail
                done = (np.maximum(q, 0.0), np.zeros_like(e), 0.0)
            q, e, least = done
            base += shift
    return np.sort(np.array(found))[::-1]


def twisted_vectors(diagonal: np.ndarray, above: np.ndarray, value: float) -> Iterator[np.ndarray]:
    """Unit vectors z with B'B z = value z from the twisted factorisations of B'B - value I, the nearest to singular first."""
    n = len(diagonal)
    floor = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0), 1e-300) * 1e-150
    a = np.where(np.abs(diagonal) < floor, floor, diagonal)
    least = EPS * EPS * max(value, 1e-300)

    def clear(x: float) -> float:
        return x if abs(x) > least else np.copysign(least, x)

    s, p, down, up = np.empty(n), np.empty(n), np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    s[0] = -value
    for k in range(n - 1):
        pivot = clear(s[k] + a[k] * a[k])
        down[k] = a[k] * above[k] / pivot
        s[k + 1] = down[k] * (above[k] / a[k]) * s[k] - value
    p[-1] = a[-1] * a[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = clear(above[k] * above[k] + p[k + 1])
        up[k] = a[k] * above[k] / pivot
        p[k] = p[k + 1] * (a[k] * a[k] / pivot) - value
    for twist in np.argsort(np.abs(s + p + value), kind="stable"):
        z = np.zeros(n)
        z[twist] = 1.0
        for k in range(twist - 1, -1, -1):
            z[k] = -down[k] * z[k + 1]
        for k in range(twist, n - 1):
            z[k + 1] = -up[k] * z[k]
        size = np.linalg.norm(z)
        if np.isfinite(size) and size > 0:
            yield z / size


def leading_directions(triangle: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All squared singular values of ``triangle``, falling, its first right singular vectors as columns, and which of these have value zero.

    Where a superdiagonal entry is negligible the bidiagonal falls into blocks with vectors of their
    own. Vectors of close values of one block are made orthogonal to those found before.
    """
    d = triangle.shape[1]
    scale = np.abs(triangle).max(initial=0.0)
    if not scale > 0:
        return np.zeros(d), np.eye(d)[:, :components], np.ones(min(components, d), bool)
    diagonal, above, right = bidiagonal(triangle / scale)
    above[np.abs(above) <= EPS * 1e-2 * np.maximum(np.abs(diagonal[1:]), np.abs(diagonal[:-1]))] = 0.0
    cuts = [0, *(np.flatnonzero(above == 0) + 1).tolist(), d]
    parts = []
    for lo, hi in zip(cuts, cuts[1:]):
        parts.extend((v, lo, hi) for v in squared_singular_values(diagonal[lo:hi], above[lo:hi - 1]))
    parts.sort(key=lambda x: -x[0])
    values = np.array([v for v, _, _ in parts])
    kept: list[np.ndarray] = []
    for value, lo, hi in parts[:components]:
        best, best_size = None, 0.0
        for own in twisted_vectors(diagonal[lo:hi], above[lo:hi - 1], value):
            z = np.zeros(d)
            z[lo:hi] = own
            for _ in range(2):
                for k in kept:
                    z -= (k @ z) * k
            size = np.linalg.norm(z)
            if size > best_size:
                best, best_size = z, size
            if size > 0.5:
                break
        if best is None or best_size < 1e-8:
            best = next(u for u in (np.eye(d)[i] - sum(k[i] * k for k in kept) for i in range(d)) if np.linalg.norm(u) > 0.1)
        kept.append(best / np.linalg.norm(best))
    vectors = np.array(kept).T
    for k in range(len(right) - 1, -1, -1):
        w = right[k]
        vectors[k + 1:] -= 2 * np.outer(w, w @ vectors[k + 1:])
    none = values[:components] <= values[0] * (d * EPS) ** 2
    return values * scale * scale, vectors, none


def _entries(column) -> tuple[np.ndarray, int]:
    """(rows, width) array of a list column without nulls whose lists have one width."""
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1), rows


def _fold(triangle: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    stacked = rows if triangle is None else np.vstack([triangle, rows])
    return np.linalg.qr(stacked, mode="r")


def triangle_of(vectors: DataFrame, mean: np.ndarray, fan_in: int = FAN_IN) -> np.ndarray:
    """R of the QR factorisation of the centred ``x`` of ``vectors``, square, padded with zero rows."""
    d = len(mean)
    shape = "part int, r binary"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        triangle = None
        step = max(BLOCK // d, 1)
        for batch in batches:
            if batch.num_rows:
                x, rows = _entries(batch.column("x"))
                for at in range(0, rows, step):
                    triangle = _fold(triangle, x[at:at + step] - mean)
        if triangle is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([triangle.tobytes()], pa.binary())], ["part", "r"])

    def join(group: pa.Table) -> pa.Table:
        triangle = None
        for r in group.column("r").to_pylist():
            triangle = _fold(triangle, np.frombuffer(r).reshape(-1, d))
        return pa.table({"part": group.column("part")[:1], "r": pa.array([triangle.tobytes()], pa.binary())})

    found = materialize(vectors.select("x").mapInArrow(fold, shape), "white-r")
    while found.count() > fan_in:
        found = materialize(found.withColumn("part", F.floor(F.col("part") / fan_in).cast("int")).groupBy("part").applyInArrow(join, shape), "white-r")
    triangle = np.zeros((0, d))
    for row in found.orderBy("part").collect():  # at most fan_in triangles
        triangle = _fold(triangle, np.frombuffer(row["r"]).reshape(-1, d))
    return np.vstack([triangle, np.zeros((d - len(triangle), d))])


@dataclass
class Whitening:
    """What whitens a row: centre and scaled directions, with the figures of the fit list."""

    n: int
    sums: list[int]
    values: np.ndarray
    trace: float
    directions: np.ndarray
    none: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN for a component without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = ((x - self.mean) @ self.directions) / np.sqrt(self.values)
        out[:, self.none] = np.nan
        return out


def integer_vectors(rows: DataFrame, vector_col: str) -> DataFrame:
    """``rows`` whose vector is whole and finite, with x = floor(256 c) of each entry."""
    whole = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.where(F.col(vector_col).isNotNull() & F.coalesce(whole, F.lit(False))).withColumn(
        "x", F.transform(vector_col, lambda c: F.floor(c.cast("double") * 256).cast("long"))).drop(vector_col)


def column_sums(fit: DataFrame) -> list[tuple[int, int, list[int]]]:
    """(width, vectors, exact sums of each place) of the lists ``x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            column = batch.column("x")
            width = column.value_lengths().to_numpy(zero_copy_only=False)
            for w in np.unique(width).tolist():
                x, rows = _entries(column.filter(pa.array(width == w))) if w else (np.zeros((int((width == 0).sum()), 0), np.int64), int((width == 0).sum()))
                exact = x if np.abs(x.astype(float)).max(initial=0.0) < 2 ** 40 else x.astype(object)
                own = totals.setdefault(w, [0] * (w + 1))
                own[0] += rows
                for i, s in enumerate(exact.sum(axis=0).tolist(), start=1):
                    own[i] += int(s)
        flat = [(w, i, s) for w, own in totals.items() for i, s in enumerate(own)]
        if flat:
            w, i, s = zip(*flat)
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.int32()), pa.array(i, pa.int32()), pa.array([Decimal(v) for v in s], pa.decimal128(38, 0))], ["w", "i", "s"])

    parts = fit.select("x").mapInArrow(run, "w int, i int, s decimal(38,0)")
    totals: dict[int, list[int]] = {}
    widths = parts.where("i = 0").groupBy("w").agg(F.sum("s").alias("s")).orderBy(F.desc("s"), F.desc("w")).limit(1)
    rows = parts.join(F.broadcast(widths.select("w")), "w").groupBy("w", "i").agg(F.sum("s").alias("s"))
    for r in rows.collect():  # one row for each place of the commonest width
        totals.setdefault(r["w"], [0] * (r["w"] + 1))[r["i"]] = int(r["s"])
    return [(w, own[0], own[1:]) for w, own in totals.items()]


def fit_whitening(fit: DataFrame, n: int, sums: list[int], components: int) -> Whitening:
    """Directions of the distinct vectors ``fit`` (x), all of one width."""
    mean = np.array([s / n for s in sums])
    squares, vectors, none = leading_directions(triangle_of(fit, mean), components)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return Whitening(n, sums, squares[:components] / n, float(squares.sum() / n), vectors * signs, none)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, components without variance left out."""
    live = np.flatnonzero(~model.none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(live)
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            if batch.num_rows:
                z = model.project(_entries(batch.column("x"))[0])[:, live]
                z = np.column_stack([z, np.ones(len(z))])
                total += z.T @ z
        i, j = np.divmod(np.arange((k + 1) ** 2), k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    if not len(live):
        return 0.0
    total = np.zeros((len(live) + 1, len(live) + 1))
    for r in fit.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r["i"], r["j"]] = r["v"]
    total /= model.n
    return float(np.abs(total[:-1, :-1] - np.outer(total[-1, :-1], total[-1, :-1]) - np.eye(len(live))).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the places of (n x - S) ** 2 of each row, exact; None beyond 64 bits."""
    largest, most = int(np.abs(x.astype(float)).max(initial=0.0)), max(map(abs, sums), default=0)
    small = max(largest, 1) * max(largest, most, 1) * max(len(sums), 1) < 2 ** 62
    own, other = (x, np.array(sums, np.int64)) if small else (x.astype(object), np.array(sums, object))
    squares, products, rest = (own * own).sum(axis=1).tolist(), (own * other).sum(axis=1).tolist(), sum(s * s for s in sums)
    exact = (n * n * int(a) - 2 * n * int(b) + rest for a, b in zip(squares, products))
    return [v if v <= LONG_MAX else None for v in exact]


def whiten(embeddings: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component.

    Rows whose vector is null or holds null or non-finite entries are dropped. Entries become
    floor(256 c), saturating at 64 bits; the fit list is each distinct result once, so repeated
    rows weigh nothing, and every one of them has its own result. Vectors of another width than
    the commonest of the fit list (ties: the widest), and empty ones, are dropped too. There are
    no more components than places. A component without variance has null ``whitened``, and null
    ``explained`` if no component has any; ``deviation`` is null where it exceeds 64 bits. A null
    id is kept. No rows left, or an empty table, gives no rows. Other columns are ignored.
    """
    kind = embeddings.schema[id_col].dataType.simpleString()
    shape = f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    kept = integer_vectors(embeddings.select(F.col(id_col), F.col(vector_col)), vector_col)
    fit = materialize(kept.select("x").distinct(), "white-fit")
    found = column_sums(fit)
    width, n, sums = found[0] if found else (0, 0, [])
    if not width:
        return embeddings.sparkSession.createDataFrame([], shape)
    fit = fit.where(F.size("x") == width)
    model = fit_whitening(fit, n, sums, components)
    error, explained = identity_error(fit, model), (model.values / model.trace).tolist() if model.trace > 0 else [None] * len(model.values)
    names = [f.split()[0] for f in shape.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for whole in batches:
            for at in range(0, whole.num_rows, step := max(BLOCK // width, 1)):
                batch = whole.slice(at, step)
                x, rows = _entries(batch.column("x"))
                z = model.project(x).ravel()
                columns = [
                    batch.column(id_col).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)),
                    pa.array([v for v in deviations(x, n, sums) for _ in range(k)], pa.int64()),
                    pa.array(z, pa.float64(), mask=np.isnan(z)),
                    pa.array(explained * rows, pa.float64()),
                    pa.array(np.full(rows * k, error))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return kept.where(F.size("x") == width).select(id_col, "x").mapInArrow(run, shape)
