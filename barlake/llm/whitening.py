"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers x = floor(scale * c) + offset. The fit list holds each distinct x vector once: n vectors
with sums S per dimension. Its covariance has divisor n; its eigenvectors are the components, by falling eigenvalue.

1. ``vectors``: rows with a whole vector as ``x``. A vector that is null, empty or holds null or non-finite entries is
   dropped; so is one whose length is not the most frequent (ties: the longer). Entries beyond 2^53 are cut there.
2. ``moments``: n and S by exact partial sums per task.
3. Blockwise QR: every task reduces its centred rows to one triangle R, block by block; triangles are reduced ``FAN``
   at a time in levels until one is left, so no task holds more than ``FAN`` triangles or a block of rows.
4. On the d x d triangle: Householder reflections reduce R to upper bidiagonal form; it is split where its off-diagonal
   vanishes, dqds finds the squared singular values of each piece to high relative accuracy, and twisted
   factorisations of B'B - e give their vectors, carried back through the reflections.
5. Rows are projected in batches; the deviation is exact integer arithmetic. One more pass over the fit list measures
   the covariance of what came out.

The driver holds n, S and a few d x d matrices (d: the dimension). Components whose eigenvalue is zero to working
precision are left out, so fewer distinct vectors than dimensions give fewer components; a single vector or an empty
table gives no rows. Repeated rows and null ids come back as they are. A deviation beyond a long is null."""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.graph import saved
from barlake.llm.text import list_array

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
BLOCK = 4096
FAN = 16
EPS = float(np.finfo(float).eps)


# ---- the triangle: bidiagonal form, singular values, vectors ----

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(diagonal, off-diagonal, right reflections) of ``r`` by Householder reflections from both sides."""
    a, d = r.copy(), r.shape[0]
    right: list[tuple[int, np.ndarray]] = []

    def reflection(x: np.ndarray) -> tuple[np.ndarray, float]:
        norm = float(np.linalg.norm(x))
        v = x.copy()
        if norm == 0 or len(x) == 1:
            return np.zeros_like(x), float(x[0])
        v[0] += math.copysign(norm, x[0])
        return v / np.linalg.norm(v), -math.copysign(norm, x[0])

    q, e = np.zeros(d), np.zeros(max(d - 1, 0))
    for k in range(d):
        v, q[k] = reflection(a[k:, k])
        a[k:, k + 1:] -= 2 * np.outer(v, v @ a[k:, k + 1:])
        if k + 1 < d:
            w, e[k] = reflection(a[k, k + 1:])
            a[k + 1:, k + 1:] -= 2 * np.outer(a[k + 1:, k + 1:] @ w, w)
            right.append((k + 1, w))
    return q, e, right


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B, falling, for B with squared diagonal ``q`` and squared off-diagonal ``e``, all positive.

    A step takes B'B - s to the same form; every number in it stays positive while s is below the least eigenvalue,
    so a step that turns negative is void and a smaller shift is tried: first close to the least intermediate number of
    the last step, then one over the sum of their inverses, then none. Shifts are summed in two parts."""
    if sum(q[:len(q) // 2]) < sum(q[len(q) // 2:]):     # the least values converge at the end
        q, e = _flipped(q, e)
    q, e = list(q), list(e)
    found: list[float] = []
    taken = rest = 0.0
    least = bound = 0.0

    def step(s: float) -> tuple[list[float], list[float], list[float]] | None:
        d, qs, es = q[0] - s, [], []
        ds = [d]
        for k in range(len(q) - 1):
            if not d > 0:
                return None
            qs.append(d + e[k])
            t = q[k + 1] / qs[k]
            es.append(e[k] * t)
            d = d * t - s
            ds.append(d)
        return ([*qs, d], es, ds) if d >= 0 else None

    while q:
        if len(q) == 1 or e[-1] <= EPS * EPS * (q[-1] + taken):
            found.append(taken + (rest + q.pop()))
            e = e[:-1]
            least = bound = 0.0
            continue
        cut = next((k for k in range(len(e) - 1) if e[k] <= EPS * EPS * min(q[k] + taken, q[k + 1] + taken)), None)
        if cut is not None:     # it falls apart: each piece has its own eigenvalues
            for part in ((q[:cut + 1], e[:cut]), (q[cut + 1:], e[cut + 1:])):
                found += [taken + (rest + x) for x in dqds(*part)]
            break
        for s in (0.98 * least, bound, 0.0):
            if (new := step(s)) is not None:
                break
        q, e, ds = new if new is not None else (q, [*e[:-1], 0.0], [0.0])   # q[-1] vanished: it is an eigenvalue
        total = taken + (rest + s)
        rest = (rest + s) - (total - taken)
        taken = total
        least = max(0.0, min(ds))
        bound = (1 - 1e-9) / sum(1 / x for x in ds) if least > 0 else 0.0
    return sorted(found, reverse=True)


def _flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The same eigenvalues with the order of rows and columns reversed: B' turned round, made upper again by one step
    without shift."""
    n = len(q)
    lq, le = [], []                     # B B' = U U' read from the other end: squares of its factors
    d = q[n - 1]
    for k in range(n - 2, -1, -1):
        lq.append(d + e[k])
        t = q[k] / lq[-1] if lq[-1] > 0 else 0.0
        le.append(e[k] * t)
        d = d * t
    return [*lq, d], le


def twisted(q: np.ndarray, b: np.ndarray, value: float, others: list[np.ndarray]) -> tuple[float, np.ndarray]:
    """(eigenvalue, unit eigenvector) of B'B for the bidiagonal B (``q`` over ``b``) near ``value``.

    B'B - value is factorised from the top and from the bottom; where the two meet in the smallest pivot the vector is
    solved by multiplications only. The pivot corrects the value. Among nearly equal values the vector is kept at right
    angles to the ``others``; if little of it is left, the next smallest pivot is taken."""
    n = len(q)
    if n == 1:
        return value, np.ones(1)
    d, low = q * q, b / q[:-1]
    tiny = EPS * EPS * float(d.max())
    for _ in range(3):
        s, p = np.zeros(n), np.zeros(n)
        plus, minus = np.zeros(n - 1), np.zeros(n - 1)
        s[0], p[-1] = -value, d[-1] - value
        for k in range(n - 1):
            pivot = s[k] + d[k]
            plus[k] = d[k] * low[k] / (pivot if pivot else tiny)
            s[k + 1] = plus[k] * low[k] * s[k] - value
        for k in range(n - 2, -1, -1):
            pivot = d[k] * low[k] ** 2 + p[k + 1]
            t = d[k] / (pivot if pivot else tiny)
            minus[k] = low[k] * t
            p[k] = p[k + 1] * t - value
        gamma = s + p + value
        for at in np.argsort(np.abs(gamma), kind="stable").tolist():
            z = np.zeros(n)
            z[at] = 1.0
            for k in range(at - 1, -1, -1):
                z[k] = -plus[k] * z[k + 1]
            for k in range(at, n - 1):
                z[k + 1] = -minus[k] * z[k]
            size = float(z @ z)
            z /= math.sqrt(size)
            left = z.copy()
            for _ in range(2):
                for o in others:
                    left -= (o @ left) * o
            norm = float(np.linalg.norm(left))
            if norm > 0.5:
                break
        if norm < 1 - 1e-9 or abs(gamma[at]) / size <= 4 * EPS * value:
            break
        value += gamma[at] / size
    return value, left / norm


def singular(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest squared singular values of a square matrix above working precision, and their unit right
    vectors as rows."""
    dim = r.shape[0]
    q, e, right = bidiagonal(r)
    norm = float(np.sqrt((q * q).sum() + (e * e).sum()))
    if not norm:
        return np.zeros(0), np.zeros((0, dim))
    q = np.where(np.abs(q) < EPS * norm, EPS * norm, q)
    small = np.flatnonzero(np.abs(e) <= EPS * np.maximum(np.minimum(np.abs(q[:-1]), np.abs(q[1:])), EPS * norm))
    pieces = [(lo, hi) for lo, hi in zip([0, *(small + 1).tolist()], [*(small + 1).tolist(), dim])]
    every = sorted(((x, lo, hi) for lo, hi in pieces for x in dqds((q[lo:hi] ** 2).tolist(), (e[lo:hi - 1] ** 2).tolist())),
                   reverse=True)
    values, vectors, within = [], [], {}
    for value, lo, hi in every[:k]:
        if value <= (dim * EPS * norm) ** 2:
            break
        value, z = twisted(q[lo:hi], e[lo:hi - 1], value, within.setdefault(lo, []))
        within[lo].append(z)
        full = np.zeros(dim)
        full[lo:hi] = z
        for at, w in reversed(right):
            full[at:] -= 2 * (w @ full[at:]) * w
        values.append(value)
        vectors.append(full / np.linalg.norm(full))
    return np.array(values), np.array(vectors).reshape(len(values), dim)


# ---- rows ----

@dataclass
class Model:
    n: int                      # vectors of the fit list
    sums: list[int]             # per dimension
    values: np.ndarray          # eigenvalues of the covariance, falling
    explained: np.ndarray       # their shares of the trace
    directions: np.ndarray      # a unit vector per row
    identity_error: float       # largest absolute entry of the covariance of the whitened fit list less the identity


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of equally long lists of numbers."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def _whole(batches: Iterator[pa.RecordBatch], scale: int, offset: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("c")
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.cast(pc.list_flatten(lists), pa.float64()).to_numpy(zero_copy_only=False)     # null entries: NaN
        row = np.repeat(np.arange(len(lengths)), lengths)
        good = (lengths > 0) & (np.bincount(row[~np.isfinite(flat)], minlength=len(lengths)) == 0)
        x = np.floor(np.clip(scale * np.where(np.isfinite(flat), flat, 0.0), -2.0**53, 2.0**53)).astype(np.int64) + offset
        kept, values = np.flatnonzero(good), x[good[row]]
        starts = np.concatenate(([0], np.cumsum(lengths[good])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(kept)), pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()),
                                                                                    pa.array(values)).cast(pa.list_(pa.int64()))],
            names=["id", "x"])


def vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
            offset: int = OFFSET) -> DataFrame:
    """(id, x) of the rows with a whole vector of the most frequent length."""
    found = df.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("c"))
    schema = T.StructType([found.schema["id"], T.StructField("x", T.ArrayType(T.LongType()))])
    rows = saved(found.mapInArrow(lambda it: _whole(it, scale, offset), schema))
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == length.d) if length else rows


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums = 0, None
    for batch in batches:
        x = _matrix(batch.column("x"))
        if len(x):
            here = [int(v) for v in x.sum(axis=0)]
            n, sums = n + len(x), here if sums is None else [s + v for s, v in zip(sums, here)]
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sums], pa.list_(pa.int64()))],
                                         names=["n", "sums"])


def moments(fit: DataFrame) -> tuple[int, list[int]]:
    """(n, sums per dimension), exact."""
    parts = fit.mapInArrow(_partial_sums, "n long, sums array<long>")
    rows = (parts.select("n", F.posexplode("sums").alias("k", "s")).groupBy("k")
            .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    return (rows[0].n, [int(r.s) for r in sorted(rows)]) if rows else (0, [])


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole) - np.array([(s % n) / n for s in sums])


def _triangle(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
    """R of the QR factorisation of all blocks of rows below one another, made square."""
    r = None
    for block in blocks:
        r = np.linalg.qr(block if r is None else np.vstack((r, block)), mode="r")
    if r is not None and r.shape[0] < r.shape[1]:
        r = np.vstack((r, np.zeros((r.shape[1] - r.shape[0], r.shape[1]))))
    return r


def _triangle_rows(r: np.ndarray | None, group: int) -> pa.Table:
    rows = [] if r is None else [r.ravel()]
    return pa.table({"part": pa.array([group] * len(rows), pa.int64()),
                     "r": pa.array(rows, pa.list_(pa.float64()))})


def triangle(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred fit list, up to the signs of its rows."""
    d, schema = len(sums), "part long, r array<double>"

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            for batch in batches:
                for lo in range(0, batch.num_rows, BLOCK):
                    yield _centred(_matrix(batch.column("x").slice(lo, BLOCK)), n, sums)
        yield from _triangle_rows(_triangle(blocks()), 0).to_batches()

    def join(table: pa.Table) -> pa.Table:
        return _triangle_rows(_triangle(r.reshape(d, d) for r in _matrix(table["r"])), table["part"][0].as_py() // FAN)

    level = fit.mapInArrow(leaf, schema)
    level = saved(level.withColumn("part", F.spark_partition_id().cast("long")))
    while level.count() > 1:
        level = saved(level.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(join, schema))
    return np.array(level.first().r).reshape(d, d)


def _projected(x: np.ndarray, m: Model) -> np.ndarray:
    return _centred(x, m.n, m.sums) @ m.directions.T / np.sqrt(m.values)


def identity_error(fit: DataFrame, m: Model) -> float:
    k = len(m.values)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = _projected(_matrix(batch.column("x")), m) if batch.num_rows else np.zeros((0, k))
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["c"])

    rows = (fit.mapInArrow(products, "c array<double>").select(F.posexplode("c").alias("k", "c")).groupBy("k")
            .agg(F.sum("c").alias("c")).collect())
    covariance = np.array([r.c for r in sorted(rows)]).reshape(k, k) / m.n
    return float(np.abs(covariance - np.eye(k)).max())


def fit_list(rows: DataFrame, k: int = COMPONENTS) -> Model | None:
    """The components of the distinct vectors of ``rows`` (column ``x``); None without a vector."""
    fit = saved(rows.select("x").distinct())
    n, sums = moments(fit)
    if not n:
        return None
    r = triangle(fit, n, sums)
    squares, directions = singular(r, k)
    total = float((r * r).sum())
    m = Model(n, sums, squares / n, squares / total if total else squares, directions, 0.0)
    if len(squares):
        m.identity_error = identity_error(fit, m)
    return m


def _deviations(x: np.ndarray, m: Model) -> list[int | None]:
    shift = [s // m.n for s in m.sums]
    base = [s - m.n * c for s, c in zip(m.sums, shift)]          # n x - S = n (x - shift) - base
    z = x - np.array(shift, np.int64)
    most = m.n * (int(np.abs(z).max(initial=0)) + 1)
    if most * most * z.shape[1] < 2**62:
        y = m.n * z - np.array(base, np.int64)
        return (y * y).sum(axis=1).tolist()
    y = z.astype(object) * m.n - np.array(base, object)
    return [v if v < 2**63 else None for v in (y * y).sum(axis=1)]


def whiten(rows: DataFrame, m: Model | None) -> DataFrame:
    """(id, deviation, whitened) of the rows (id, x): a number per component; no row without a model."""
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows if m else 0, BLOCK):
                part = batch.slice(lo, BLOCK)
                x = _matrix(part.column("x"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(_deviations(x, m), pa.int64()),
                     list_array(np.full(len(x), len(m.values)), pa.array(_projected(x, m).ravel()))],
                    names=["id", "deviation", "whitened"])

    return rows.mapInArrow(project, T.StructType([rows.schema["id"], T.StructField("deviation", T.LongType()),
                                                  T.StructField("whitened", T.ArrayType(T.DoubleType()))]))
