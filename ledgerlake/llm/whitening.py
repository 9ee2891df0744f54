"""Embedding whitening with components from FEAST contour integration.

1. Each entry ``c`` of a remaining vector becomes the whole number ``x =
   floor(1024 * c) + 100000``; sums per dimension are exact.
2. The covariance is summed from rows centred before multiplying: each task
   sums its own rows, tasks are summed by matrix entry in a shuffle. Only the
   covariance (dimension squared, whatever the number of rows) reaches the
   driver.
3. Inertia counts (signs of a symmetric indefinite factorisation of the
   shifted covariance) cut the upper spectrum into intervals of known
   eigenvalue counts. Each interval is one task: complex shifted solves on the
   nodes of a contour around it, summed by quadrature, project random vectors
   onto its eigenvectors; Rayleigh-Ritz extracts them, and the projection is
   repeated until the residuals are at rounding level and the number found is
   the one counted.
4. Centred rows are projected and scaled; the covariance of the result is
   summed over all rows once more to state its distance from the identity.

Defined cases: vectors that are null, empty or hold null or non-finite entries
are dropped, and so are those with an entry of 2^42 or more in size (its
``x`` would not be exact in double) and those not of the most frequent length
(ties: the longer). Repeated rows count each. A component without variance
cannot be scaled to one and is left out, so equal vectors, or a single one,
give no row. Equal eigenvalues: any orthonormal vectors of their space. A
``deviation`` above the range of long is null; ``deviation_text`` has all of
its digits. Null ids are carried through; an empty table gives no row; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare

SHIFT, SCALE = 100000, 1024
#: Entries below this size have an exact whole number in double.
_LIMIT = float(1 << 42)
RESULT = "vec_id long, component int, n long, deviation long, deviation_text string, whitened double, explained double, identity_error double"


def whole(batch, dim: int) -> np.ndarray:
    """int64 rows ``x`` of a batch's vectors of ``dim`` entries."""
    c = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.floor(c * SCALE).astype(np.int64) + SHIFT


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` (array of double) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= _LIMIT))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"))
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad)


def frequent_length(rows: DataFrame) -> int | None:
    found = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return None if found is None else found["d"]


def column_sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of ``x`` per dimension."""

    def run(batches):
        import pyarrow as pa

        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for b in batches:
            x = whole(b, dim)
            n, high, low = n + len(x), high + (x >> 26).sum(axis=0), low + (x & ((1 << 26) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in ([n] * dim, np.arange(dim), high, low)], names=["n", "i", "high", "low"])

    each = rows.select("vector").mapInArrow(run, "n long, i long, high long, low long")
    got = {r["i"]: r for r in each.groupBy("i").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]).collect()}
    return got[0]["n"], [(got[i]["high"] << 26) + got[i]["low"] for i in range(dim)]


class Centre:
    """Exact mean as whole part and remainder: ``x - S / n`` without loss."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sum over dimensions of ``(n * x - S) ** 2`` of each row."""
        y = x - self.whole
        most = int(np.abs(y).max(initial=0)) + 1
        if (self.n * most) ** 2 * x.shape[1] < 1 << 62:
            return ((self.n * y - self.rest) ** 2).sum(axis=1).tolist()
        return ((self.n * y.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1).tolist()


def _summed_products(rows: DataFrame, dim: int, width: int, project) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``w`` and of ``w w'`` over all rows, ``w = project(x)`` of
    ``width`` entries; upper triangle by entry, summed over tasks in a shuffle."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros((width + 1, width))
        for b in batches:
            w = project(whole(b, dim))
            total[:width] += w.T @ w
            total[width] += w.sum(axis=0)
        i, j = np.nonzero(np.triu(np.ones((width + 1, width), bool)) | (np.arange(width + 1) == width)[:, None])
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])

    entries = rows.select("vector").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width + 1, width))
    for r in entries.collect():  # width squared rows
        out[r["i"], r["j"]] = r["v"]
    upper = out[:width]
    return out[width], np.triu(upper) + np.triu(upper, 1).T


# --- eigenpairs of a symmetric matrix ------------------------------------------


def negatives(matrix: np.ndarray) -> int:
    """Number of negative eigenvalues of a symmetric matrix, from the pivots of
    an LDL' factorisation with Bunch-Kaufman pivoting (Sylvester's law)."""
    a, n, k, found = matrix.astype(np.float64).copy(), len(matrix), 0, 0
    bound = (1 + 17**0.5) / 8

    def swap(p, q):
        if p != q:
            a[[p, q], k:] = a[[q, p], k:]
            a[k:, [p, q]] = a[k:, [q, p]]

    while k < n:
        here, column = abs(a[k, k]), np.abs(a[k + 1 :, k])
        most = column.max(initial=0.0)
        if max(here, most) == 0:
            k += 1
            continue
        step = 1
        if here < bound * most:
            far = k + 1 + int(column.argmax())
            row = np.abs(a[far, k:])
            row[far - k] = 0
            if here * row.max() < bound * most**2:
                if abs(a[far, far]) >= bound * row.max():
                    swap(k, far)
                else:
                    swap(k + 1, far)
                    step = 2
        d, w = a[k : k + step, k : k + step], a[k + step :, k : k + step]
        found += int((np.linalg.eigvalsh(d) < 0).sum())
        a[k + step :, k + step :] -= w @ np.linalg.solve(d, w.T)
        k += step
    return found


def intervals(matrix: np.ndarray, k: int, most: int = 4) -> list[tuple[float, float, int]]:
    """(low, high, count) of disjoint intervals that hold at least the ``k``
    largest eigenvalues above rounding level, each at most ``most`` of them
    unless they lie closer than can be told apart."""
    top = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-6)
    if not top > 0:
        return []
    eye, least = np.eye(len(matrix)), top * 1e-12

    def above(s: float) -> int:
        return len(matrix) - negatives(matrix - s * eye)

    k = min(k, above(least))
    if not k:
        return []
    low, high, count = least, top, above(least)
    while count > k and high - low > 1e-10 * top:
        mid = (low + high) / 2
        n = above(mid)
        low, high, count = (mid, high, n) if n >= k else (low, mid, count)
    out, todo = [], [(low, top, count, 0)]
    while todo:
        a, b, na, nb = todo.pop()
        if na == nb:
            continue
        cut = None
        if na - nb > most and b - a > 1e-9 * top:
            # a cut that no eigenvalue touches
            for share in (0.5, 0.38, 0.62, 0.27, 0.73):
                c, gap = a + share * (b - a), 1e-6 * (b - a)
                n = above(c - gap)
                if n == above(c + gap):
                    cut = c
                    break
        if cut is None:
            out.append((a, b, na - nb))
        else:
            todo += [(a, cut, na, n), (cut, b, n, nb)]
    return out


def contour_eigenpairs(matrix: np.ndarray, low: float, high: float, count: int, nodes: int = 8, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high`` and their vectors
    (columns). Raises if another number is found."""
    n = len(matrix)
    size = min(n, 2 * count + 4)
    at, weight = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(0.5j * np.pi * (at + 1))
    centre, radius = (low + high) / 2, (high - low) / 2
    y = np.random.default_rng(count).standard_normal((n, size))
    scale, best, kept = np.linalg.norm(matrix, 2), np.inf, None
    for _ in range(rounds):
        p = np.zeros((n, size))
        for e, w in zip(turn, weight):
            shifted = (centre + radius * e) * np.eye(n) - matrix
            p += 0.5 * w * (radius * e * np.linalg.solve(shifted, y.astype(complex))).real
        q, _ = np.linalg.qr(p)
        value, u = np.linalg.eigh(q.T @ matrix @ q)
        y = q @ u
        inside = (value > low) & (value < high)
        if inside.sum() == count:
            x, v = y[:, inside], value[inside]
            error = np.linalg.norm(matrix @ x - x * v, axis=0).max() / scale
            if error < best:
                kept = v, x
            if error < 1e-14 or (best < 1e-11 and error > best / 4):
                return kept
            best = min(best, error)
    if kept is None or best > 1e-9:
        raise ValueError(f"not all of the {count} eigenvalues between {low} and {high} were found")
    return kept


def components(spark: SparkSession, matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their vectors (columns), one
    task per interval of the spectrum."""
    parts = intervals(matrix, k)
    if not parts:
        return np.zeros(0), np.zeros((len(matrix), 0))
    shared = spark.sparkContext.broadcast((matrix, parts))  # dimension squared numbers

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for i in b.column("id").to_pylist():
                m, cut = shared.value
                _, x = contour_eigenpairs(m, *cut[i])
                yield pa.RecordBatch.from_arrays([pa.array(x.T.tolist(), pa.list_(pa.float64()))], names=["x"])

    found = spark.range(0, len(parts), 1, len(parts)).mapInArrow(run, "x array<double>").collect()
    basis, _ = np.linalg.qr(np.array([r["x"] for r in found]).T)
    value, u = np.linalg.eigh(basis.T @ matrix @ basis)  # Rayleigh-Ritz over all intervals
    order = np.argsort(value)[::-1][:k]
    return value[order], basis @ u[:, order]


def whiten(vectors: DataFrame, k: int = 8) -> DataFrame:
    """One row per remaining vector and component: :data:`RESULT`."""
    spark = prepare(vectors.sparkSession)
    rows = usable(vectors)
    dim = frequent_length(rows)
    if dim is None:
        return spark.createDataFrame([], RESULT)
    rows = rows.where(F.size("vector") == dim)
    n, sums = column_sums(rows, dim)
    centre = Centre(n, sums)
    _, products = _summed_products(rows, dim, dim, centre.centred)
    covariance = products / n
    value, vector = components(spark, covariance, k)
    if not len(value):
        return spark.createDataFrame([], RESULT)
    scaled = vector / np.sqrt(value)
    mean, second = _summed_products(rows, dim, len(value), lambda x: centre.centred(x) @ scaled)
    spread = second / n - np.outer(mean / n, mean / n)
    error = float(np.abs(spread - np.eye(len(value))).max())
    explained = (value / np.trace(covariance)).tolist()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            x = whole(b, dim)
            far = centre.deviations(x)
            w = centre.centred(x) @ scaled
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(value), pa.int32()), pa.array(w.ravel()))
            short = pa.array([d if d < 1 << 63 else None for d in far], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), short, pa.array(map(str, far), pa.string()), lists], names=["vec_id", "deviation", "deviation_text", "w"])

    out = rows.mapInArrow(run, "vec_id long, deviation long, deviation_text string, w array<double>")
    out = out.select("vec_id", "deviation", "deviation_text", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "deviation_text",
        "whitened",
        F.element_at(F.array(*[F.lit(x) for x in explained]), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
