"""Whitening of embeddings by a bidiagonal qd solver.

The centred fit rows are reduced by blockwise QR: each task keeps one triangle while it
reads, triangles are merged by sixteens until one is left, and only that one (a square
matrix of the dimension) reaches the driver. Householder reflections make it bidiagonal;
differential qd sweeps with shifts below the smallest eigenvalue give its singular values
to high relative accuracy, without ever forming a covariance; for each leading one, twisted
factorisations from both ends meet where the residual is least and give the direction.

Rows become integers x = floor(256 c), so equal rows are found exactly, sums are exact and
``n * x - S`` is centred without rounding. The fit list holds each x vector once.

Plan: one pass turns vectors into integers (staged); ``distinct`` aggregates on the map
side before its shuffle, so repeated vectors are never hot; sums, QR blocks and the check
of the whitened covariance each give one small row a task, reduced in Spark.

Defined cases: rows whose vector is null or holds nulls, non-finite entries or entries
with no 64-bit x take no part; an empty vector has no components; vectors of different
lengths are different spaces, each fitted on its own; a space has as many components as
its rank allows (none if all its rows are equal); ``deviation`` is null where it is beyond
64 bits, ``deviation_exact`` has its digits in any case; null and repeated ids are kept
like others; an empty table gives no rows; other columns are not read, so their names
cannot clash. A direction's largest entry is positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stage

EPS = np.finfo(np.float64).eps
#: Triangles that one task merges.
FAN_IN = 16
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double, deviation_exact string")


# --- the solver: one square matrix -----------------------------------------------------------

def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(u, beta) with (1 - beta u u') x along the first axis."""
    size = np.linalg.norm(x)
    if size == np.abs(x[0]):
        return x, 0.0
    u = x.copy()
    u[0] += math.copysign(size, x[0])
    return u, 2.0 / float(u @ u)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and V, with r = U B V'."""
    m, d = r.copy(), len(r)
    v = np.eye(d)
    for k in range(d):
        u, beta = _reflector(m[k:, k])
        if beta:
            m[k:, k:] -= np.outer(beta * u, u @ m[k:, k:])
        if k < d - 2:
            u, beta = _reflector(m[k, k + 1:].copy())
            if beta:
                m[k:, k + 1:] -= np.outer(m[k:, k + 1:] @ u, beta * u)
                v[:, k + 1:] -= np.outer(v[:, k + 1:] @ u, beta * u)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform and a lower bound of what is left (only for shift 0);
    None if the shift was above the smallest eigenvalue."""
    d, inverse, qs, es = q[0] - shift, 0.0, [], []
    for i in range(len(e)):
        if d < 0.0:
            return None
        inverse += 1.0 / d if d else math.inf
        top = d + e[i]
        t = q[i + 1] / top
        qs.append(top)
        es.append(e[i] * t)
        d = d * t - shift
    if d < 0.0:
        return None
    return [*qs, d], es, 1.0 / (inverse + (1.0 / d if d else math.inf))


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues, falling, of B'B from the squares of B's diagonal and superdiagonal.
    A sweep without shift bounds the smallest eigenvalue from below by the inverse's
    trace; the next one is shifted by that bound, so no eigenvalue is ever passed."""
    top = float(max(q.max(initial=0.0), e.max(initial=0.0)))
    if not top:
        return np.zeros(len(q))
    # a zero on the diagonal is a tiny number: far less than rounding in the matrix itself
    floor = (EPS * EPS * 1e-2) * top
    work = [([max(float(x), floor) for x in q], [float(x) for x in e], 0.0)]
    found: list[float] = []
    while work:
        q_, e_, base = work.pop()
        for _ in range(400 * len(q_) + 400):
            small = [i for i, x in enumerate(e_) if x <= EPS * EPS * (base + min(q_[i], q_[i + 1])) or x < 1e-290]
            if small:
                i = small[-1]
                work.append((q_[:i + 1], e_[:i], base))
                q_, e_ = q_[i + 1:], e_[i + 1:]
            if len(q_) == 1:
                found.append(base + q_[0])
                break
            if q_[0] < q_[-1]:  # turned over, small ends come last
                q_, e_ = _turned(q_, e_)
            q_, e_, bound = _sweep(q_, e_, 0.0)
            for shift in (bound * (1 - 8 * EPS * len(q_)), bound * 0.5, 0.0):
                if (shifted := _sweep(q_, e_, shift)) is not None:
                    q_, e_, base = shifted[0], shifted[1], base + shift
                    break
        else:
            raise RuntimeError("the qd sweeps did not settle")
        q_, e_ = [], []
    return np.sort(np.array(found))[::-1]


def _turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The same bidiagonal from its other end."""
    return q[::-1], e[::-1]


def twisted(a: np.ndarray, b: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B'B (diagonal ``a``, superdiagonal ``b`` of B) to ``value``.
    The factorisation from the top and the one from the bottom are joined at the twist
    with the least residual. Entries are of size 1. ``others``: vectors of nearly the same eigenvalue, to which
    the result is orthogonal."""
    size, tiny = len(a), EPS * EPS * max(float(np.max(np.abs(a))) ** 2, 1e-280)
    safe = np.where(a == 0.0, math.sqrt(tiny), a)
    d, low = safe ** 2, np.append(b / safe[:-1], 0.0)
    s, p = np.empty(size), np.empty(size)
    down, up = np.zeros(size), np.zeros(size)
    s[0] = -value
    for i in range(size - 1):
        pivot = s[i] + d[i] or tiny
        down[i] = d[i] * low[i] / pivot
        s[i + 1] = down[i] * low[i] * s[i] - value
    p[-1] = d[-1] - value
    for i in range(size - 2, -1, -1):
        p[i + 1] = p[i + 1] or tiny
        pivot = d[i] * low[i] ** 2 + p[i + 1] or tiny
        t = d[i] / pivot
        up[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    residual = np.abs(s + p + value)

    best, rest = None, 1e-3
    for k in np.argsort(residual, kind="stable"):
        z = np.zeros(size)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(k, size - 1):
            z[i + 1] = -up[i] * z[i]
        z /= np.linalg.norm(z)
        left = z
        for o in [*others, *others]:
            left = left - (left @ o) * o
        norm = float(np.linalg.norm(left))
        if norm <= rest:
            continue
        left = left / norm
        image = a * left
        image[:-1] += b * left[1:]
        back = a * image
        back[1:] += b * image[:-1]
        if np.linalg.norm(back - value * left) <= 1e-8 * math.sqrt(size) * max(1.0, value):  # an eigenvector
            best, rest = left, norm
        if rest > 0.5:
            break
    if best is None:
        raise RuntimeError("no twist gives an eigenvector")
    return best


def principal(r: np.ndarray, most: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues of r'r, unit directions as columns) of its leading ``most``, as far as
    its rank goes."""
    scale = float(np.max(np.abs(r), initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((len(r), 0))
    a, b, v = bidiagonalise(r / scale)
    values = dqds(a ** 2, b ** 2)
    seen = values[:most][values[:most] > (max(len(r), min(rows, 1 << 20)) * EPS) ** 2 * values[0]]
    found: list[np.ndarray] = []
    for k, value in enumerate(seen):
        near = [found[j] for j in range(k) if seen[j] - value <= 1e-6 * seen[j]]
        found.append(twisted(a, b, float(value), near))
    out = v @ np.stack(found, axis=1)
    for k in range(out.shape[1]):
        if out[np.argmax(np.abs(out[:, k])), k] < 0:
            out[:, k] = -out[:, k]
    return seen * scale * scale, out


# --- the distributed part ----------------------------------------------------------------------

def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def integer_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = b.filter(b.column(1).is_valid())
            entries = held.column(1)
            flat = entries.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            lengths = entries.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(all="ignore"):
                scaled = np.floor(256.0 * flat)
                wrong = ~(np.abs(scaled) < 2.0 ** 63)  # also null, NaN and infinite
            row = np.repeat(np.arange(len(lengths)), lengths)
            good = np.ones(len(lengths), bool)
            good[row[wrong]] = False
            x = scaled[good[row]].astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths[good])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([held.column(0).filter(pa.array(good)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))],
                                             names=["vec_id", "x"])

    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .mapInArrow(run, "vec_id long, x array<long>")


def _sums(fit: DataFrame, d: int) -> list[int]:
    """Exact sum of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            x = _matrix(b.column(0), d)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(high), pa.array(low)], names=["at", "high", "low"])

    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    rows = fit.mapInArrow(run, "at int, high long, low long").groupBy("at").agg(*wide).collect()  # one row a dimension
    return [int(r.high) * (1 << 32) + int(r.low) for r in sorted(rows, key=lambda r: r.at)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n; the difference is taken in whole numbers where these hold it."""
    if n * int(np.abs(x).max(initial=0)) < 1 << 61 and max(map(abs, sums)) < 1 << 61:
        return (n * x - np.array(sums, np.int64)) / float(n)
    return x - np.array([s / n for s in sums])


def _triangle(fit: DataFrame, d: int, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows, by blocks and then by sixteens."""
    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        r = np.zeros((0, d))
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                r = np.linalg.qr(np.vstack([r, _centred(_matrix(b.column(0).slice(at, 4096), d), n, sums)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["block", "r"])

    def merge(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("block").to_numpy())
        blocks = [np.frombuffer(group.column("r")[int(i)].as_py()).reshape(-1, d) for i in order]
        r = np.linalg.qr(np.vstack(blocks), mode="r")
        return pa.table({"block": pa.array([group.column("block")[0].as_py() // FAN_IN], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    blocks = stage(fit.mapInArrow(reduce_rows, "block long, r binary"), "triangles")
    while blocks.limit(2).count() > 1:
        by = F.floor(F.col("block") / FAN_IN).alias("by")
        blocks = stage(blocks.groupBy(by).applyInArrow(merge, "block long, r binary"), "triangles")
    r = np.frombuffer(blocks.first().r).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


def _identity_error(fit: DataFrame, d: int, n: int, sums: list[int], onto: np.ndarray) -> float:
    """Largest entry of the whitened fit rows' covariance minus the identity."""
    k = onto.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = _centred(_matrix(b.column(0), d), n, sums) @ onto
            total += w.sum(axis=0)
            products += w.T @ w
        both = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both)), pa.int32()), pa.array(both)], names=["at", "v"])

    rows = fit.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()  # k + k*k rows
    v = np.array([r.v for r in sorted(rows, key=lambda r: r.at)]) / n
    return float(np.max(np.abs(v[k:].reshape(k, k) - np.outer(v[:k], v[:k]) - np.eye(k))))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[list[int | None], list[str]]:
    """Sum over dimensions of (n x - S)^2: as 64-bit numbers where it fits, as digits always."""
    about = ((n * x.astype(np.float64) - np.array(sums, np.float64)) ** 2).sum(axis=1)
    if about.max(initial=0.0) < 2.0 ** 62:  # then arithmetic modulo 2^64 is exact
        part = np.int64(n) * x - np.array(sums, np.int64)
        exact = (part * part).sum(axis=1).tolist()
    else:
        exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact], [str(v) for v in exact]


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Every row that takes part on up to ``components`` leading components, one row each."""
    points = stage(integer_rows(vectors, id_col, vec_col), "integer-rows")
    out = None
    for d in sorted(r[0] for r in points.select(F.size("x")).distinct().collect()):  # at most one row a length
        space = points.filter(F.size("x") == d)
        rows = _whitened_space(space, d, components) if d else None
        if rows is not None:
            out = rows if out is None else out.unionByName(rows)
    return out if out is not None else points.sparkSession.createDataFrame([], RESULT)


def _whitened_space(space: DataFrame, d: int, components: int) -> DataFrame | None:
    fit = stage(space.select("x").distinct(), "fit-list")
    n = fit.count()
    sums = _sums(fit, d)
    r = _triangle(fit, d, n, sums)
    squares, directions = principal(r, min(components, d), n)
    if not len(squares):
        return None
    onto = directions * (math.sqrt(n) / np.sqrt(squares))
    error = _identity_error(fit, d, n, sums, onto)
    k = len(squares)
    shares = squares / float((r * r).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                x = _matrix(b.column(1), d)
                w = _centred(x, n, sums) @ onto
                exact, digits = _deviations(x, n, sums)
                times = np.repeat(np.arange(len(x)), k)
                size = len(times)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(times)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                     pa.array(np.full(size, n), pa.int64()), pa.array(exact, pa.int64()).take(pa.array(times)),
                     pa.array(w.ravel()), pa.array(np.tile(shares, len(x))), pa.array(np.full(size, error)),
                     pa.array(digits, pa.string()).take(pa.array(times))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    return space.mapInArrow(run, RESULT)
