"""Embedding whitening by a bidiagonal qd solver.

Vectors become whole numbers. The distinct ones are centred by their exact sums, and each task reduces its blocks of rows
to the triangular factor of a QR decomposition; factors are stacked and reduced again, a few hundred at a time, until one is
left, whatever the number of rows. No product of the rows with themselves is ever formed, so the condition of the data is
not squared. Householder reflections turn the factor into an upper bidiagonal matrix B. Its singular values come from the
differential qd algorithm with shifts (dqds), which keeps their relative accuracy, and their right singular vectors
from twisted factorisations of B'B in its form L D L'. The reflections carry these back to the directions of the data.

Only factors of the size dimensions x dimensions come to the driver. Every row is then projected where it lies, and the
covariance of the projected fit list is measured from sums over all tasks.

Defined cases: vectors that are null, empty, or hold null or non-finite entries are left out, as are those with an entry
of 2^40 or more (it has no exact sum here) and those of another length than the most frequent one (the longer one of two
that are as frequent); rows may repeat and count once in the fit list; a null id stays null. Directions without any
variance have no unit scale: no row is returned for them, so one distinct vector, or an empty table, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swapbook.llm import ship
from swapbook.llm.store import stored

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 40)
#: Rows that are reduced at a time, and factors that meet in one task.
BLOCK, FAN_IN = 4096, 64
EPS = np.finfo(float).eps


# ---- singular values and directions of a small triangular factor ----


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v of unit length and the number a, with (1 - 2 v v') x = a e1."""
    norm = np.linalg.norm(x)
    if norm == 0:
        return np.zeros_like(x), 0.0
    v = x.copy()
    a = -math.copysign(norm, x[0])
    v[0] -= a
    return v / np.linalg.norm(v), a


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of an upper bidiagonal matrix, and the reflections from the right."""
    m = r.astype(float).copy()
    d = len(m)
    right = []
    for k in range(d):
        v, a = _reflector(m[k:, k])
        m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        m[k, k], m[k + 1 :, k] = a, 0
        if k < d - 2:
            v, a = _reflector(m[k, k + 1 :])
            m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ v, v)
            m[k, k + 1], m[k, k + 2 :] = a, 0
            right.append(v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), right


def carried_back(right: list[np.ndarray], z: np.ndarray) -> np.ndarray:
    """Directions of the data from columns in the basis of the bidiagonal matrix."""
    z = z.copy()
    for k in range(len(right) - 1, -1, -1):
        z[k + 1 :] -= 2 * np.outer(right[k], right[k] @ z[k + 1 :])
    return z


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One transform; the smallest of its d tells whether the shift was below the smallest eigenvalue."""
    d = q[0] - shift
    least = d
    nq, ne = [], []
    for i in range(len(e)):
        total = d + e[i]
        ratio = q[i + 1] / total if total else math.inf
        nq.append(total)
        ne.append(e[i] * ratio)
        d = d * ratio - shift
        if not d >= least:
            least = d
            if d < 0 or math.isnan(d):
                return nq, ne, d
    nq.append(d)
    return nq, ne, least


def eigenvalues(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B, from the squares of the diagonal and superdiagonal of B."""
    found: list[float] = []
    waiting = [(list(q), list(e), 0.0)]
    drop = (len(q) * EPS) ** 2  # moves no singular value by more than this part of it
    while waiting:
        q, e, moved = waiting.pop()
        while q:
            if len(q) == 1:
                found.append(moved + max(q[0], 0.0))
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= drop * (moved + min(q[i], q[i + 1]))), None)
            if cut is not None:
                waiting.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1]:  # the large ones first, so that the small ones come off at the end
                q, e = q[::-1], e[::-1]
            # the smaller eigenvalue of the last two rows is an upper bound, and near convergence a close one
            a, b, c2 = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            half = (a + b) / 2
            det = max(a * b - c2, 0.0)
            bound = det / (half + math.sqrt(max(half * half - det, 0.0))) if half > 0 else 0.0
            for shift in (bound * (1 - 4 * EPS), None, bound / 4, bound / 64, 0.0):
                if shift is None:
                    # what the failed one has left over moves it below the smallest eigenvalue, near the end at least
                    shift = max(first + least, 0.0) * (1 - 4 * EPS) if least > -first else bound / 2
                first = shift
                nq, ne, least = _dqds(q, e, shift)
                if least >= 0 and all(map(math.isfinite, ne)):
                    break
            q, e, moved = nq, ne, moved + shift
    return sorted(found, reverse=True)


def _factors(d: np.ndarray, low: np.ndarray, value: float) -> tuple[np.ndarray, ...]:
    """Stationary and progressive factors of L D L' - value, and the remainders of all twists."""
    n = len(d)
    tiny = EPS * EPS * float(np.max(d))
    s, p = np.empty(n), np.empty(n)
    plus, up = np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + d[i]
        plus[i] = d[i] * low[i] / (pivot if pivot else tiny)
        s[i + 1] = plus[i] * low[i] * s[i] - value
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * low[i] ** 2 + p[i + 1]
        t = d[i] / (pivot if pivot else tiny)
        up[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    rest = s + p + value
    rest[-1] = s[-1] + d[-1]
    return plus, up, rest


def _twisted(d: np.ndarray, low: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """A vector of L D L' near the value, and the value that fits it."""
    for _ in range(8):
        plus, up, rest = _factors(d, low, value)
        r = int(np.argmin(np.abs(rest)))
        z = np.zeros(len(d))
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -plus[i] * z[i + 1]
        for i in range(r, len(d) - 1):
            z[i + 1] = -up[i] * z[i]
        size = z @ z
        if not math.isfinite(size):  # a cluster that this form cannot tell apart
            return np.zeros(len(d)), value
        step = rest[r] / size
        if not math.isfinite(step) or abs(step) <= 2 * EPS * value:
            break
        value = max(value + step, 0.0)
    return z / math.sqrt(size), value


def directions(diagonal: np.ndarray, above: np.ndarray, values: list[float]) -> np.ndarray:
    """Right singular vectors of a bidiagonal matrix for some of the squares of its singular values, as columns."""
    n = len(diagonal)
    top = max(values, default=0.0)
    random = np.random.default_rng(1)
    columns = np.zeros((n, len(values)))
    # where the superdiagonal vanishes, the matrix falls into blocks with vectors of their own
    ends = [*(np.flatnonzero(above**2 <= (n * EPS) ** 2 * np.minimum(diagonal[:-1] ** 2, diagonal[1:] ** 2)) + 1).tolist(), n]
    blocks = list(zip([0, *ends[:-1]], ends))
    own = {b: eigenvalues((diagonal[b[0] : b[1]] ** 2).tolist(), (above[b[0] : b[1] - 1] ** 2).tolist()) for b in blocks}
    ranked = sorted(((v, b) for b in blocks for v in own[b]), key=lambda x: -x[0])
    for k, (value, (lo, hi)) in enumerate(ranked[: len(values)]):
        d = diagonal[lo:hi] ** 2
        low = above[lo : hi - 1] / diagonal[lo : hi - 1]
        z, _ = _twisted(d, low, value)
        near = [j for j in range(k) if ranked[j][1] == (lo, hi) and abs(ranked[j][0] - value) <= 1e-3 * top]
        for attempt in range(5):
            # close neighbours: what the vector shares with theirs is taken off; too little left, another start
            rest = z - columns[lo:hi, near] @ (columns[lo:hi, near].T @ z)
            rest -= columns[lo:hi, near] @ (columns[lo:hi, near].T @ rest)
            left = np.linalg.norm(rest)
            if left > 0.5 or attempt == 4:
                break
            z = random.standard_normal(hi - lo)
            z = _solved(d, low, value, z - columns[lo:hi, near] @ (columns[lo:hi, near].T @ z))
        columns[lo:hi, k] = rest / left
    return columns


def _solved(d: np.ndarray, low: np.ndarray, value: float, right: np.ndarray) -> np.ndarray:
    """A step of inverse iteration with the stationary factors of L D L' - value, of unit length."""
    plus, _, _ = _factors(d, low, value)
    n, tiny = len(d), EPS * float(np.max(np.abs(d)))
    pivots, s = np.empty(n), -value
    y = right.copy()
    for i in range(n):
        pivots[i] = s + d[i]
        if i < n - 1:
            s = plus[i] * low[i] * s - value
            y[i + 1] -= plus[i] * y[i]
    y /= np.where(np.abs(pivots) < tiny, tiny, pivots)
    for i in range(n - 2, -1, -1):
        y[i] -= plus[i] * y[i + 1]
    return y / np.linalg.norm(y)


def components(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Singular values squared, directions (columns) and the sum of all squares, of a triangular factor."""
    if not r.size or not r.any():
        return np.zeros(0), np.zeros((len(r), 0)), 0.0
    scale = float(np.abs(r).max())
    diagonal, above, right = bidiagonal(r / scale)
    values = eigenvalues((diagonal**2).tolist(), (above**2).tolist())
    # a direction without variance shows as rounding
    real = [v for v in values[:most] if v > values[0] * (len(r) * EPS) ** 2 * 16]
    z = directions(diagonal, above, real)
    return np.array(real) * scale**2, carried_back(right, z), float((r * r).sum())


# ---- over the rows ----


@dataclass
class Fit:
    """What every row needs: the size of the fit list, sums, directions over the root of the variance, and shares."""

    n: int
    sums: list[int]
    weights: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: whole numbers of 64 bits where they fit, of Python beyond."""
    most = max([abs(s) for s in sums] + [int(np.abs(x).max()) * n if x.size else 0])
    if most < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squares(dev: np.ndarray) -> list[int | None]:
    """Sums of squares per row; null where a long cannot hold one."""
    most = int(np.abs(dev).max()) if dev.size else 0
    wide = dev if dev.dtype != object and most * most * max(dev.shape[1], 1) < 1 << 63 else dev.astype(object)
    return [int(s) if s < 1 << 63 else None for s in (wide * wide).sum(axis=1).tolist()]


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(vec_id, x): the rows that take part, in whole numbers."""
    v = F.col(vector)
    good = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double") * SCALE) < LARGEST, F.lit(False)))  # NaN is above all
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).filter(v.isNotNull() & (F.size("v") > 0) & good)
    return rows.select("vec_id", whole_numbers(F.col("v")).alias("x"))


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension; a row per dimension comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                n += len(x)
                own = x.sum(axis=0) if len(x) * int(np.abs(x).max()) < 1 << 62 else x.astype(object).sum(axis=0)
                totals = own.astype(object) if totals is None else totals + own
        if n:
            texts = [str(n), *map(str, totals)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), pa.array(texts)], ["at", "total"])

    parts = fit.mapInArrow(run, "at long, total string").withColumn("total", F.col("total").cast("decimal(38,0)"))
    found = [int(r.total) for r in parts.groupBy("at").agg(F.sum("total").alias("total")).orderBy("at").collect()]
    return (found[0], found[1:]) if found else (0, [])


def triangular(rows: np.ndarray) -> np.ndarray:
    """The R of a QR decomposition, square."""
    r = np.linalg.qr(rows, mode="r")
    return r if len(r) == rows.shape[1] else np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])


def factor(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The triangular factor of all centred rows."""
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                x = matrix(batch.column(0).slice(start, BLOCK))
                centred = (deviations(x, n, sums) / n).astype(float)
                r = triangular(centred if r is None else np.vstack([r, centred]))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([np.frombuffer(b).reshape(d, d) for b in sorted(rows["r"])])
        return pd.DataFrame({"r": [triangular(stacked).tobytes()]})

    factors = stored(fit.mapInArrow(run, "r binary"))
    while (left := factors.count()) > FAN_IN:
        groups = -(-left // FAN_IN)
        dealt = factors.withColumn("g", F.pmod(F.xxhash64("r"), F.lit(groups)))
        factors = stored(dealt.groupBy("g").applyInPandas(lambda rows: merged(rows), "r binary"))
    blocks = sorted(bytes(row.r) for row in factors.collect())  # FAN_IN factors at most
    return triangular(np.vstack([np.frombuffer(b).reshape(d, d) for b in blocks])) if blocks else np.zeros((d, d))


def _measured(fit: DataFrame, model: Fit) -> float:
    """The largest entry of the covariance of the projected fit list minus the identity."""
    k = model.weights.shape[1]
    shared = ship.broadcast(fit.sparkSession.sparkContext, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ship.received(shared)
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = (deviations(matrix(batch.column(0)), known.n, known.sums) / known.n).astype(float) @ known.weights
                total += np.vstack([w.sum(axis=0), w.T @ w])
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "total"])

    parts = fit.mapInArrow(run, "at long, total double").groupBy("at").agg(F.sum("total").alias("total"))
    totals = np.array([r.total for r in parts.orderBy("at").collect()]).reshape(k + 1, k) / model.n
    mean = totals[0]
    return float(np.abs(totals[1:] - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0


def learn(rows: DataFrame, most: int = COMPONENTS) -> Fit:
    """A fit on the distinct vectors of (x)."""
    sizes = rows.groupBy(F.size("x").alias("size")).count().agg(F.max(F.struct("count", "size")).alias("m")).first()
    size = sizes.m["size"] if sizes.m else 0
    fit = stored(rows.filter(F.size("x") == size).select("x").distinct())
    n, sums = _sums(fit)
    values, vectors, total = components(factor(fit, n, sums), most) if n else (np.zeros(0), np.zeros((0, 0)), 1.0)
    model = Fit(n, sums, vectors / np.sqrt(values / n) if len(values) else np.zeros((len(sums), 0)), values / total if len(values) else values)
    if len(values):
        model.identity_error = _measured(fit, model)
    return model


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error per usable row and component."""
    rows = usable(vectors, id_col, vector)
    model = learn(rows, most)
    k, size = model.weights.shape[1], len(model.sums)
    kind = rows.schema["vec_id"].dataType.simpleString()
    fields = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    shared = ship.broadcast(vectors.sparkSession.sparkContext, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ship.received(shared)
        for batch in batches:
            for start in range(0, batch.num_rows if k else 0, BLOCK):
                part = batch.slice(start, BLOCK)
                dev = deviations(matrix(part.column(1)), known.n, known.sums)
                w = (dev / known.n).astype(float) @ known.weights
                m = len(dev)
                again = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, known.n)), pa.array(squares(dev), pa.int64()).take(again), pa.array(w.ravel()),
                        pa.array(np.tile(known.explained, m)), pa.array(np.full(m * k, known.identity_error)),
                    ],
                    [f.split()[0] for f in fields.split(", ")],
                )

    return rows.filter(F.size("x") == size).mapInArrow(run, fields)
