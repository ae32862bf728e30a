"""Whitening of embeddings: blockwise QR, a bidiagonal form, its singular values by qd steps, directions by twisted factors.

Tasks reduce the centred rows to triangles of the vectors' width; only those matrices, never rows, meet on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.vectors import matrix
from tracelake.session import materialise

#: Rows that one factorisation takes beside the triangle so far.
BLOCK = 4096
#: Triangles that are joined at once, and that the driver takes at most.
FAN_IN = 16
#: Singular values below this share of the largest are rounding: such a direction holds no variance.
NO_VARIANCE = 2.0**-44
#: Eigenvalues nearer than this, relative to their size, need their directions made orthogonal.
NEAR = 1e-3
#: Off-diagonal squares below this share of a value no longer change it.
EPS = 2.0**-52
NEGLIGIBLE = (16 * EPS) ** 2
#: Stands in for a pivot of exactly zero.
LEAST_PIVOT = EPS**1.5
#: Squares below this count as nothing beside the largest.
TINY = 1e-60


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """``id`` and ``x``: whole numbers ``floor(scale * c) + shift`` of each finite vector's entries. Vectors that are null or
    hold a null or non-finite entry are left out, shorter ones end in zero entries; ids may be null or repeated."""
    finite = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    kept = df.where(finite)
    width = kept.agg(F.max(F.size(vec_col))).first()[0] or 0
    whole = F.transform(vec_col, lambda c: F.floor(c.cast("double") * scale) + shift)
    rest = F.array_repeat(F.lit(shift).cast("long"), F.lit(width) - F.size(vec_col))
    return kept.select(F.col(id_col).alias("id"), F.concat(whole, rest).alias("x"))


def whitened(vectors: DataFrame, components: int = 8) -> DataFrame:
    """``vectors`` (``id``, ``x``: arrays of whole numbers) projected on the leading eigenvectors of their covariance,
    each to variance 1: ``id``, ``component`` (from 1, by falling eigenvalue), ``n``, ``deviation`` (sum of (n x - S)^2 over the
    dimensions, S their sums; null if it exceeds 64 bits), ``whitened``, ``explained`` (share of all variance) and
    ``identity_error`` (largest entry of the whitened rows' covariance less the identity, measured over the rows).

    Sums are exact. Tasks centre rows exactly and keep the triangle of a QR factorisation; triangles are joined in groups of
    ``FAN_IN``. Householder steps make the last one bidiagonal, shifted qd steps give its singular values to high relative
    accuracy, twisted factorisations the directions. Each direction's largest entry is positive.

    Vectors narrower than the widest count as padded with zeros. Repeated rows count each. With fewer dimensions than
    ``components`` there are as many as dimensions; directions without variance give no rows, and so do an empty table and
    one of equal vectors.
    """
    spark = vectors.sparkSession
    kept = materialise(vectors.select("id", "x"), "whiten-rows")
    width, n = kept.agg(F.max(F.size("x")), F.count("*")).first()
    schema = f"id {kept.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n or not width:
        return spark.createDataFrame([], schema)
    sums = np.zeros(width, np.int64)
    parts = kept.mapInArrow(_sums(width), "dim int, total long")
    for dim, total in parts.groupBy("dim").agg(F.sum("total")).collect():  # one number a dimension
        sums[dim] = total
    values, directions = spectrum(_triangle(kept, n, sums), components)
    variance = values**2 / n
    count = min(components, int((values > values[0] * NO_VARIANCE).sum()))
    if not count:
        return spark.createDataFrame([], schema)
    scaled = directions[:, :count] / np.sqrt(variance[:count])
    ident = kept.schema["id"].dataType.simpleString()
    rows = materialise(kept.mapInArrow(_project(n, sums, scaled), f"id {ident}, deviation long, w array<double>"), "whiten-out")
    error = _identity_error(rows, n, count)
    shares = F.array(*[F.lit(float(v / variance.sum())) for v in variance[:count]])
    long = rows.select("id", "deviation", F.posexplode("w").alias("i", "whitened"))
    return long.select(
        "id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def _sums(width: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += matrix(batch.column("x"), width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], ["dim", "total"])

    return add


def _joined(triangle: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Triangle of all rows so far; its rows never exceed its width."""
    return np.linalg.qr(np.vstack([triangle, rows]), mode="r")


def _reduce(n: int, sums: np.ndarray):
    """One triangle of a task's centred rows. ``n x - S`` is a whole number, so centring loses nothing."""
    width = len(sums)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle, waiting, held, seen = np.zeros((0, width)), [], 0, False
        for batch in batches:
            seen = True
            waiting.append((n * matrix(batch.column("x"), width) - sums) / n)
            held += len(waiting[-1])
            if held >= BLOCK:
                triangle, waiting, held = _joined(triangle, np.vstack(waiting)), [], 0
        if seen:
            triangle = _joined(triangle, np.vstack([np.zeros((0, width)), *waiting]))
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(triangle).tobytes()], pa.binary())], ["r"])

    return reduce


def _triangle(kept: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Square triangle of all centred rows: tasks' triangles joined in rounds, the last few on the driver."""
    width = len(sums)

    def join(group: pd.DataFrame) -> pd.DataFrame:
        triangle = np.zeros((0, width))
        for packed in group["r"]:
            triangle = _joined(triangle, np.frombuffer(packed).reshape(-1, width))
        return pd.DataFrame({"r": [np.ascontiguousarray(triangle).tobytes()]})

    parts = materialise(kept.mapInArrow(_reduce(n, sums), "r binary"), "whiten-triangles")
    while (left := parts.count()) > FAN_IN:
        dealt = parts.withColumn("__g", F.pmod(F.xxhash64("r"), F.lit(-(-left // FAN_IN))))
        parts = materialise(dealt.groupBy("__g").applyInPandas(join, "r binary"), "whiten-triangles")
    last = join(pd.DataFrame({"r": [row.r for row in parts.collect()]}))["r"][0]
    found = np.frombuffer(last).reshape(-1, width)
    return np.vstack([found, np.zeros((width - len(found), width))])


def _project(n: int, sums: np.ndarray, scaled: np.ndarray):
    width = len(sums)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = n * matrix(batch.column("x"), width) - sums
            far = int(np.abs(apart).max(initial=0))
            if width * far * far < 2**63:
                deviation = pa.array((apart**2).sum(axis=1), pa.int64())
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in apart]
                deviation = pa.array([v if v < 2**63 else None for v in exact], pa.int64())
            w = (apart / n) @ scaled
            offsets = pa.array(np.arange(len(w) + 1, dtype=np.int32) * scaled.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), deviation, lists], ["id", "deviation", "w"])

    return project


def _identity_error(rows: DataFrame, n: int, count: int) -> float:
    """Largest entry of the rows' covariance less the identity. Rows are sums of exactly centred ones, so only what rounding
    left of their mean is taken off."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, total = np.zeros((count, count)), np.zeros(count)
        for batch in batches:
            w = batch.column("w").flatten().to_numpy(zero_copy_only=False).reshape(-1, count)
            products += w.T @ w
            total += w.sum(axis=0)
        at = pa.array(np.arange(count * count + count, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([at, pa.array(np.concatenate([products.ravel(), total]))], ["at", "part"])

    parts = rows.select("w").mapInArrow(multiply, "at int, part double").groupBy("at").agg(F.sum("part"))
    flat = np.zeros(count * count + count)
    for at, part in parts.collect():  # (components + 1) x components numbers
        flat[at] = part
    mean = flat[count * count :] / n
    covariance = flat[: count * count].reshape(count, count) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(count)).max())


def spectrum(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of a square matrix, falling, and as columns the right singular vectors of the first ``count``.

    The bidiagonal form falls into blocks where its superdiagonal is rounding; equal values of different blocks thus have
    directions of their own."""
    width = len(r)
    diagonal, above, rotation = bidiagonal(r)
    largest = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    if largest == 0:
        return np.zeros(width), np.eye(width)[:, :count]
    diagonal, above = diagonal / largest, above / largest
    diagonal[np.abs(diagonal) < sqrt(TINY)] = sqrt(TINY)  # a zero would stop the qd steps; this is far below rounding
    cuts = [0, *(np.flatnonzero(np.abs(above) < EPS) + 1).tolist(), width]
    blocks = list(zip(cuts, cuts[1:]))
    squares = [np.sort(qd_values(diagonal[i:j] ** 2, above[i : j - 1] ** 2))[::-1] for i, j in blocks]
    order = sorted(((v, b, k) for b, found in enumerate(squares) for k, v in enumerate(found)), key=lambda t: (-t[0], t[1:]))
    local = np.zeros((width, min(count, width)))
    for b, (i, j) in enumerate(blocks):
        places = [at for at, (_, of, _) in enumerate(order[:count]) if of == b]
        if places:
            local[i:j, places] = _directions(diagonal[i:j].tolist(), above[i : j - 1].tolist(), squares[b][: len(places)])
    found = rotation @ local
    signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    return np.sqrt([v for v, _, _ in order]) * largest, found * signs


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V of ``r = U B V'`` by Householder reflections."""
    a = np.array(r, float)
    width = len(a)
    v = np.eye(width)
    for k in range(width):
        w, factor = _reflector(a[k:, k])
        a[k:, k:] -= factor * np.outer(w, w @ a[k:, k:])
        if k + 2 < width:
            w, factor = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= factor * np.outer(a[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= factor * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Vector w and factor f such that ``x - f w (w x)`` has only a first entry."""
    w = np.array(x)
    scale = np.abs(w).max(initial=0.0)
    if scale == 0:
        return w, 0.0
    w /= scale
    w[0] += np.copysign(np.linalg.norm(w), w[0])
    return w, 2.0 / (w @ w)


def qd_values(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix from the squares of its entries, by differential qd steps with shifts.

    A step whose shift exceeds the least value fails and is done again with a shift that cannot. Values leave where the last
    off-diagonal entry vanishes; a block falls apart where another one does.
    """
    found = []
    blocks = [(q.tolist(), e.tolist(), 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        for _ in range(100 + 30 * len(q)):
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= NEGLIGIBLE * (moved + min(q[i], q[i + 1])) or e[i] < TINY), None)
            if cut is not None:
                blocks += [(q[: cut + 1], e[:cut], moved), (q[cut + 1 :], e[cut + 1 :], moved)]
                break
            if 1.5 * q[0] < q[-1]:  # small values have to come last
                q, e = q[::-1], e[::-1]
            low = _safe(q, e)
            high = max(low, _bold(q, e))
            for shift in (high, (high + low) / 2, (high + 7 * low) / 8, low, 0.0):
                step = _qd_step(q, e, shift)
                if step:
                    break
            q, e = step
            moved += shift
        else:
            raise ArithmeticError("qd steps did not converge")
    return np.array(found)


def _bold(q: list[float], e: list[float]) -> float:
    """Smaller eigenvalue of the last two rows, which is at least the least value."""
    a, c, b = q[-2] + e[-1], q[-1], e[-1] * q[-1]
    half = (a - c) / 2
    return min(a, c) - b / (abs(half) + sqrt(half * half + b))


def _safe(q: list[float], e: list[float]) -> float:
    """Lower bound of the least value: one over the trace of the inverse."""
    p = q[-1]
    trace = 1.0 / p
    for value, off in zip(q[-2::-1], e[::-1]):
        p *= value / (off + p)
        trace += 1.0 / p if p > 0 else float("inf")
    return (1 - 1e-12) / trace


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    d = q[0] - shift
    new_q, new_e = [], []
    for i, off in enumerate(e):
        if d < 0:
            return None
        sum_ = d + off
        ratio = q[i + 1] / sum_
        new_q.append(sum_)
        new_e.append(off * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    new_q.append(max(d, TINY))
    return new_q, new_e


def _directions(diagonal: list[float], above: list[float], squares: np.ndarray) -> np.ndarray:
    """Right singular vectors of the bidiagonal matrix, one for each squared singular value (falling)."""
    n = len(diagonal)
    d = [a * a for a in diagonal]
    low = [b / a for a, b in zip(diagonal, above)]
    found = np.zeros((n, len(squares)))
    rng = np.random.default_rng(7)
    first = 0
    for k, value in enumerate(squares):
        if k and squares[k - 1] - value > NEAR * squares[k - 1]:
            first = k
        near = found[:, first:k]
        factors = _twisted(d, low, float(value))
        z = _apart(_solve_twisted(factors, None), near)
        if z is None:  # a direction of a neighbour came out again: iterate with the same factors on the rest of the space
            z = _apart(rng.standard_normal(n), found[:, :k])
            for _ in range(4):
                z = _apart(_solve_twisted(factors, z), found[:, first:k], always=True)
            z = _apart(z, found[:, :k], always=True)
        found[:, k] = z
    return found


def _apart(z: np.ndarray, others: np.ndarray, always: bool = False) -> np.ndarray | None:
    """``z`` at length 1 and orthogonal to ``others``; nothing if little of it is left."""
    z = z / np.linalg.norm(z)
    for _ in range(2):
        z = z - others @ (others.T @ z)
    left = np.linalg.norm(z)
    if left < 0.1 and not always:
        return None
    z = z / left
    z = z - others @ (others.T @ z)
    return z / np.linalg.norm(z)


def _twisted(d: list[float], low: list[float], value: float):
    """Stationary and progressive factors of ``L D L' - value`` and where to twist them: at the least pivot."""
    n = len(d)
    plus, l_plus, s = [0.0] * n, [0.0] * n, [0.0] * n
    s[0] = -value
    for i in range(n - 1):
        plus[i] = d[i] + s[i] or LEAST_PIVOT
        l_plus[i] = d[i] * low[i] / plus[i]
        s[i + 1] = l_plus[i] * low[i] * s[i] - value
    plus[-1] = d[-1] + s[-1] or LEAST_PIVOT
    minus, u, p = [0.0] * n, [0.0] * n, [0.0] * n
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        minus[i + 1] = d[i] * low[i] * low[i] + p[i + 1] or LEAST_PIVOT
        part = d[i] / minus[i + 1]
        u[i] = low[i] * part
        p[i] = p[i + 1] * part - value
    pivots = [a + b + value for a, b in zip(s, p)]
    at = min(range(n), key=lambda i: abs(pivots[i]))
    return plus, l_plus, minus, u, pivots[at] or LEAST_PIVOT, at


def _solve_twisted(factors, right: np.ndarray | None) -> np.ndarray:
    """``(L D L' - value) z = right`` through the twisted factors; without ``right`` the unit vector at the twist, scaled, for
    which the solution needs no pivot."""
    plus, l_plus, minus, u, pivot, at = factors
    n = len(plus)
    z = np.zeros(n)
    if right is None:
        z[at] = 1.0
    else:
        y = np.array(right, float)
        for i in range(at):
            y[i + 1] -= l_plus[i] * y[i]
        for i in range(n - 1, at, -1):
            y[i - 1] -= u[i - 1] * y[i]
        z = y
        z[:at] /= plus[:at]
        z[at + 1 :] /= minus[at + 1 :]
        z[at] /= pivot
    for i in range(at - 1, -1, -1):
        z[i] -= l_plus[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] -= u[i] * z[i]
    largest = np.abs(z).max()
    return z / largest
