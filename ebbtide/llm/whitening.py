"""Whitening of embeddings through a bidiagonal matrix, its singular values by dqds and its vectors by twisted factorisations.

The vectors become whole numbers; each distinct one counts once. Tasks reduce blocks of centred rows by QR, and the
triangles are reduced in the same way, a few at a time, down to one of the size of a vector. That one is bidiagonalised
by Householder reflections. The differential quotient-difference algorithm with shifts finds its singular values to
high relative accuracy; for each, the stationary and the progressive factorisation of the shifted matrix meet at the
row with the smallest pivot, which gives the vector. The directions then go to the tasks that hold the rows.

Defined results: rows are dropped when the vector is null or empty, holds null or a non-finite entry, or an entry beyond
the whole numbers of 64 bits, or has not the most frequent length (the longest of equally frequent ones); rows without
an id stay. Equal vectors count once in the fit, and every row of them is returned. Directions without spread (rank
deficiency, a single vector) are left out, so there may be fewer than asked for; an empty table gives no rows; a
deviation beyond 64 bits is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbtide.llm.shared import stored

GRID, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 4096
MERGED = 16  # triangles reduced by one task
_EPS = np.finfo(float).eps
_HALF = 1 << 31


# --- a bidiagonal matrix: singular values and right singular vectors


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U' r W, and W, by Householder reflections from both sides."""
    a, d = r.astype(float).copy(), r.shape[1]
    w = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        v, size = x.copy(), np.max(np.abs(x), initial=0.0)
        if size == 0 or not np.any(x[1:]):
            return v, 0.0
        v /= size
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v, 2.0 / (v @ v)

    for k in range(d):
        v, scale = reflector(a[k:, k])
        a[k:, k:] -= scale * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v, scale = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= scale * np.outer(a[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= scale * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _dqds_step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One transform of the squares of diagonal and superdiagonal; the last value is the smallest pivot."""
    new_q, new_e, d = np.empty_like(q), np.empty_like(e), q[0] - shift
    least = d
    for k in range(len(e)):
        new_q[k] = d + e[k]
        ratio = q[k + 1] / new_q[k] if new_q[k] > 0 else np.inf
        new_e[k] = e[k] * ratio
        d = d * ratio - shift
        if not d >= least:
            least = d
    new_q[-1] = d
    return new_q, new_e, least


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix without zeros on its diagonal, largest first."""
    found: list[float] = []
    blocks = [(diagonal.astype(float) ** 2, above.astype(float) ** 2, 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        while len(q):
            small = np.flatnonzero(e <= _EPS**2 * np.minimum(q[:-1], q[1:])) if len(e) else e.astype(int)
            if len(small):  # falls apart into two matrices
                cut = int(small[-1])
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if len(q) == 1:
                found.append(float(q[0] + moved))
                break
            # The last two rows give a shift; one that goes past the smallest value is reduced until it does not.
            b, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1]
            half, off = (b - c) / 2, q[-2] * e[-1]
            shift = max(0.0, c - off / (half + np.copysign(np.hypot(half, np.sqrt(off)), half))) if off > 0 else 0.0
            shift = min(shift, float(q.min())) * (1 - 4 * _EPS)
            for _ in range(12):
                new_q, new_e, least = _dqds_step(q, e, shift)
                if least >= 0 and np.all(np.isfinite(new_q)) and np.all(new_q[:-1] > 0):
                    break
                shift = shift / 4 if shift > _EPS * (moved + q.min()) else 0.0
            else:
                shift = 0.0
                new_q, new_e, _ = _dqds_step(q, e, 0.0)
            q, e, moved = new_q, new_e, moved + shift
    return np.array(sorted(found, reverse=True))


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float, near: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B'B for an eigenvalue, from the stationary and progressive factorisations of B'B - value.

    ``near`` holds vectors of values so close that the twist has to be told from theirs.
    """
    n = len(diagonal)
    q, e = diagonal**2, np.append(above**2, 0.0)
    off = diagonal[:-1] * above  # of B'B; its diagonal is q[i] + e[i - 1]
    tiny = _EPS * max(value, float(q.max())) * _EPS
    safe = lambda x: x if abs(x) > tiny else np.copysign(tiny, x)
    down, s = np.empty(n), -value  # stationary: pivots from the top
    for k in range(n):
        down[k] = safe(q[k] + s)
        s = (s / down[k]) * e[k] - value if k < n - 1 else s
    stationary = down - q  # what is left of the shift at each row
    up, p = np.empty(n), q[-1] - value  # progressive: pivots from the bottom
    progressive = np.empty(n)
    progressive[-1] = p
    for k in range(n - 2, -1, -1):
        up[k + 1] = safe(e[k] + p)
        p = (p / up[k + 1]) * q[k] - value
        progressive[k] = p
    gamma = stationary + progressive + value
    best, best_left = None, -1.0
    for twist in np.argsort(np.abs(gamma))[: 1 + 2 * len(near)]:
        z = np.zeros(n)
        z[twist] = 1.0
        for k in range(twist - 1, -1, -1):
            z[k] = -(off[k] / down[k]) * z[k + 1]
        for k in range(twist, n - 1):
            z[k + 1] = -(off[k] / up[k + 1]) * z[k]
        z /= np.linalg.norm(z)
        for _ in range(2):
            for other in near:
                z -= (z @ other) * other
        left = float(np.linalg.norm(z))
        if left > best_left:
            best, best_left = z / max(left, tiny), left
        if left > 0.7:
            break
    return best


def _unreduced(diagonal: np.ndarray, above: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows between which nothing but rounding connects the matrix."""
    cuts = np.flatnonzero(np.abs(above) <= 8 * _EPS * np.sqrt(np.abs(diagonal[:-1] * diagonal[1:]))) + 1
    edges = [0, *cuts.tolist(), len(diagonal)]
    yield from zip(edges[:-1], edges[1:])


def principal(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of r'r, largest first and without those of no spread, and their unit vectors as columns."""
    diagonal, above, w = bidiagonal(r)
    size = max(np.max(np.abs(diagonal), initial=0.0), np.max(np.abs(above), initial=0.0))
    if size == 0:
        return np.empty(0), np.empty((len(diagonal), 0))
    diagonal, above = diagonal / size, above / size
    diagonal[np.abs(diagonal) < _EPS * len(diagonal)] = _EPS * len(diagonal) * 1e-3  # no spread: below what is kept
    pairs: list[tuple[float, np.ndarray]] = []
    for a, b in _unreduced(diagonal, above):
        own, link = diagonal[a:b], above[a : b - 1]
        done: list[tuple[float, np.ndarray]] = []
        for value in dqds(own, link):
            near = [z for other, z in done if other - value <= 1e-3 * other]
            z = twisted(own, link, value, near)
            done.append((value, z))
        for value, z in done:
            whole = np.zeros(len(diagonal))
            whole[a:b] = z
            pairs.append((value, whole))
    pairs.sort(key=lambda x: -x[0])
    kept = [x for x in pairs if x[0] > (4 * _EPS * len(diagonal)) ** 2 * pairs[0][0]]
    vectors = w @ np.array([z for _, z in kept]).T
    for k in range(vectors.shape[1]):  # a fixed sign
        vectors[:, k] *= np.copysign(1.0, vectors[np.argmax(np.abs(vectors[:, k])), k])
    return np.array([v for v, _ in kept])[:most] * size**2, vectors[:, :most]


# --- whole numbers, sums and triangles over tables


def whole_numbers(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id and x of the rows that take part."""
    grid = F.transform(column, lambda c: F.floor(c.cast("double") * GRID))
    real = F.forall(column, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double") * GRID) < 9.2e18), F.lit(False)))
    rows = embeddings.where(F.col(column).isNotNull() & (F.size(column) > 0) & real).select(F.col(key).cast("long").alias("vec_id"), F.transform(grid, lambda c: c + SHIFT).alias("x"))
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("x") == (length[0]["d"] if length else 0))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def _add_up(parts: DataFrame, width: int) -> list:
    """Sums of the entries of the arrays ``v``, one array a task, by place; ``width`` of them come to the driver."""
    places = parts.select(F.posexplode("v").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = [0] * width
    for row in places:
        out[row["k"]] = row["v"]
    return out


def sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of every dimension."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, [0] * d, [0] * d
        for batch in _blocks(batches):
            x = _matrix(batch.column(0), d)
            n += len(x)
            high = [a + b for a, b in zip(high, (x >> 31).sum(0).tolist())]
            low = [a + b for a, b in zip(low, (x & (_HALF - 1)).sum(0).tolist())]
        totals = [n, *(h * _HALF + l for h, l in zip(high, low))]
        yield pa.RecordBatch.from_arrays([pa.array([[str(t) for t in totals]], pa.list_(pa.string()))], names=["v"])

    parts = fit.select("x").mapInArrow(job, "v array<string>").select(F.expr("transform(v, t -> cast(t as decimal(38,0)))").alias("v"))
    n, *s = (int(v) for v in _add_up(parts, d + 1))
    return n, s


class Centre:
    """n x - S for blocks of vectors, exactly."""

    def __init__(self, n: int, s: list[int]):
        self.n, self.mean = n, [t // n for t in s]
        self.rest = [t % n for t in s]  # S = n mean + rest

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """As 64-bit numbers where all fit, else as Python's."""
        mean, rest = np.array(self.mean, np.int64), np.array(self.rest, np.int64)
        least, most = x.min(initial=0), x.max(initial=0)
        span = max(abs(int(least) - m) for m in (min(self.mean), max(self.mean))) + max(abs(int(most) - m) for m in (min(self.mean), max(self.mean)))
        if (span + 1) * self.n < 1 << 62:
            return (x - mean) * self.n - rest
        return (x.astype(object) - np.array(self.mean, object)) * self.n - np.array(self.rest, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S/n in double precision, subtracted before any rounding."""
        return (self.scaled(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        y = self.scaled(x)
        if y.dtype != object and int(np.abs(y).max(initial=0)) < (1 << 31) // max(1, int(np.sqrt(y.shape[1])) + 1):
            return (y * y).sum(1).tolist()
        return [t if t < 1 << 63 else None for t in (sum(int(v) * int(v) for v in row) for row in y)]


def triangle(fit: DataFrame, centre: Centre, d: int) -> np.ndarray:
    """R of the QR factorisation of all centred rows: blocks within tasks, then triangles of several tasks at once."""

    def reduced(blocks: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for block in blocks:
            r = np.linalg.qr(np.vstack([r, block]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], names=["r"])

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return reduced(centre.rows(_matrix(batch.column(0), d)) for batch in _blocks(batches))

    def of_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return reduced(row.values.to_numpy().reshape(-1, d) for batch in batches for row in batch.column(0))

    parts = stored(fit.select("x").mapInArrow(of_rows, "r array<double>"), "triangles")
    n = parts.count()
    while n > 1:
        n = -(-n // MERGED)
        parts = parts.repartition(n).mapInArrow(of_triangles, "r array<double>")
    rows = parts.collect()  # one triangle
    r = np.array(rows[0]["r"]).reshape(-1, d) if rows else np.zeros((0, d))
    return np.vstack([r, np.zeros((d - len(r), d))])


REPORT = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def whitened(embeddings: DataFrame, components: int = COMPONENTS, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per vector and component, in order of falling variance."""
    spark = embeddings.sparkSession
    empty = spark.createDataFrame([], REPORT + ", identity_error double")
    rows = whole_numbers(embeddings, column, key)
    fit = stored(rows.select("x").distinct(), "distinct-vectors")
    d = fit.select(F.coalesce(F.max(F.size("x")), F.lit(0)).alias("d")).first()["d"]
    if not d:
        return empty
    n, s = sums(fit, d)
    centre = Centre(n, s)
    r = triangle(fit, centre, d)
    values, vectors = principal(r, components)
    if not len(values):
        return empty
    share = values / float(np.sum(r * r))  # the trace is the sum of all squares
    project = vectors / np.sqrt(values / n)
    k = len(values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in _blocks(batches):
            w = centre.rows(_matrix(batch.column(0), d)) @ project
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["v"])

    # The rows are centred, so the mean of their projections is zero.
    covariance = np.array(_add_up(fit.select("x").mapInArrow(moments, "v array<double>"), k * k), float).reshape(k, k) / n
    error = float(np.abs(covariance - np.eye(k)).max())

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), d)
            w = centre.rows(x) @ project
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n)),
                    pa.array(centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(w.ravel()), pa.array(np.tile(share, len(x))),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained"],
            )

    return rows.select("vec_id", "x").mapInArrow(job, REPORT).withColumn("identity_error", F.lit(error))
