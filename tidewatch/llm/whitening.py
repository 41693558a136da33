"""Embedding whitening by spectrum slicing.

Entries become integers x = floor(64 c) + 1000000. Sums and the covariance (divisor n) come
from distributed passes over the fit list, each distinct x vector once; only d sums and d x d
covariance entries reach the driver. There the LDL^T inertia of the shifted covariance counts
the eigenvalues above a shift: bisection on these counts isolates each leading eigenvalue,
Rayleigh quotient iteration converges inside the interval, and counts on both sides of the
result certify its number. Eigenvalues closer than rounding form a cluster, whose basis comes
from block inverse iteration.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut, map_arrow

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")
_ALPHA = (1 + 17 ** 0.5) / 8  # Bunch and Kaufman's bound for a one by one pivot


def count_below(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``v`` lie below ``shift``: the negative pivots of
    LDL^T of v - shift I, with one by one and two by two pivots."""
    a = v - shift * np.eye(len(v))
    n, k, negative = len(a), 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        col = np.abs(a[k + 1:, k])
        two = False
        if col.size and (most := float(col.max())) > 0 and abs(a[k, k]) < _ALPHA * most:
            r = k + 1 + int(col.argmax())
            other = np.abs(a[k:, r])
            other[r - k] = 0
            widest = float(other.max())
            if abs(a[k, k]) * widest < _ALPHA * most * most:
                if abs(a[r, r]) >= _ALPHA * widest:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:
            d = a[k:k + 2, k:k + 2].copy()
            det = d[0, 0] * d[1, 1] - d[0, 1] * d[1, 0]
            negative += 1 if det < 0 else 2 * int(d[0, 0] + d[1, 1] < 0)
            rest = a[k + 2:, k:k + 2].copy()
            if rest.size:
                a[k + 2:, k + 2:] -= rest @ np.linalg.solve(d, rest.T)
            k += 2
        else:
            d = a[k, k]
            negative += int(d < 0)
            if d != 0 and k + 1 < n:
                rest = a[k + 1:, k].copy()
                a[k + 1:, k + 1:] -= np.outer(rest / d, rest)
            k += 1
    return negative


def _solve(v: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    for grow in (0.0, 1.0, 16.0):  # an exactly singular shift is moved by a rounding error
        try:
            x = np.linalg.solve(v - (shift + grow * 2e-16 * max(abs(shift), 1e-300)) * np.eye(len(v)), b)
            if np.isfinite(x).all():
                return x
        except np.linalg.LinAlgError:
            pass
    return b


def _start(d: int, columns: int) -> np.ndarray:
    return np.random.default_rng(12345).standard_normal((d, columns))


def leading(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of the symmetric positive semidefinite ``v``, falling,
    and their unit eigenvectors as columns. Eigenvalues that are zero but for rounding are left
    out. Equal eigenvalues get an orthonormal basis of their space."""
    d = len(v)
    size = float(np.abs(v).sum(axis=1).max()) if d else 0.0
    if not size:
        return np.zeros(0), np.zeros((d, 0))
    tiny = 4 * d * 2.2e-16 * size
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = d - count_below(v, shift)
        return counts[shift]

    top = size * (1 + 1e-9)
    values, vectors = [], []
    todo = [(tiny, top, above(tiny), above(top))]  # the last interval is the highest
    while todo and len(values) < wanted:
        lo, hi, at_lo, at_hi = todo.pop()
        inside = at_lo - at_hi
        if not inside or at_hi >= wanted:
            continue
        found = _iterate(v, lo, hi, tiny) if inside == 1 else None
        if found is not None and above(found[0] - tiny) == at_lo and above(found[0] + tiny) == at_hi:
            values.append(found[0])
            vectors.append(found[1])
        elif hi - lo <= 2 * tiny:
            e, x = _cluster(v, (lo + hi) / 2, inside)
            values += list(e)
            vectors += list(x.T)
        else:
            mid = (lo + hi) / 2
            n = above(mid)
            todo += [(lo, mid, at_lo, n), (mid, hi, n, at_hi)]
    return np.array(values[:wanted]), np.array(vectors[:wanted]).reshape(-1, d).T


def _iterate(v: np.ndarray, lo: float, hi: float, tiny: float) -> tuple[float, np.ndarray] | None:
    """Rayleigh quotient iteration from the middle of (lo, hi); None if it leaves the interval."""
    x = _start(len(v), 1)[:, 0]
    shift = (lo + hi) / 2
    for _ in range(2):
        x = _solve(v, shift, x / np.linalg.norm(x))
    x /= np.linalg.norm(x)
    last = np.inf
    for _ in range(40):
        shift = float(x @ v @ x)
        if not lo < shift < hi:
            return None
        residual = float(np.linalg.norm(v @ x - shift * x))
        if residual >= last and residual <= tiny:
            break
        last = residual
        x = _solve(v, shift, x)
        x /= np.linalg.norm(x)
    shift = float(x @ v @ x)
    return (shift, x) if lo < shift < hi and np.linalg.norm(v @ x - shift * x) <= tiny else None


def _cluster(v: np.ndarray, shift: float, size: int) -> tuple[np.ndarray, np.ndarray]:
    x = _start(len(v), size)
    for _ in range(4):
        x = np.linalg.qr(_solve(v, shift, x))[0]
    e, turn = np.linalg.eigh(x.T @ v @ x)
    return e[::-1], (x @ turn)[:, ::-1]


def _matrix(column) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(fit: DataFrame) -> list[int]:
    """Exact sums per dimension: every task adds halves of 32 bits, Spark adds the tasks'."""

    def run(batches):
        import pyarrow as pa

        total: list[int] = []
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0))
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                own = [(int(h) << 32) + int(w) for h, w in zip(high, low)]
                total = [s + t for s, t in zip(total, own)] if total else own
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()),
                                          pa.array([str(t) for t in total], pa.string())], ["i", "s"])

    out = map_arrow(fit.select("x"), run, "i int, s string").groupBy("i").agg(
        F.expr("sum(cast(s AS decimal(38, 0)))").alias("s")).collect()  # one row a dimension
    return [int(r.s) for r in sorted(out)]


class Centre:
    """x - S/n without rounding of the large parts: whole and fractional part of S/n apart."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.whole = n, np.array([s // n for s in sums], dtype=np.int64)
        self.rest = [s % n for s in sums]
        self.part = np.array([r / n for r in self.rest])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum over dimensions of (n x - S)^2; null where it passes 64 bits."""
        off = x - self.whole
        most = (float(np.abs(off).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < 2 ** 62:
            return ((self.n * off - np.array(self.rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * off.astype(object) - np.array(self.rest, dtype=object)) ** 2).sum(axis=1)
        return [int(e) if e < 2 ** 63 else None for e in exact]


def _covariance(fit: DataFrame, width: int, n: int, rows) -> np.ndarray:
    """Covariance, divisor n, of ``rows(x)``, which are centred but for rounding."""

    def run(batches):
        import pyarrow as pa

        total, product = np.zeros(width), np.zeros((width, width))
        for b in batches:
            if b.num_rows:
                y = rows(_matrix(b.column(0)))
                total += y.sum(axis=0)
                product += y.T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.r_[np.full(width, -1), i], pa.int32()), pa.array(np.r_[np.arange(width), j], pa.int32()),
            pa.array(np.r_[total, product[i, j]])], ["i", "j", "v"])

    out = np.zeros((width, width))
    mean = np.zeros(width)
    for r in map_arrow(fit.select("x"), run, "i int, j int, v double").groupBy("i", "j").agg(
            F.sum("v").alias("v")).collect():  # d (d + 3) / 2 rows
        if r.i < 0:
            mean[r.j] = r.v / n
        else:
            out[r.i, r.j] = out[r.j, r.i] = r.v / n
    return out - np.outer(mean, mean)


def prepared(embeddings: DataFrame) -> DataFrame:
    """vec_id and x of the rows with a vector of finite entries (and at least one)."""
    entry = f"cast(floor(least(greatest({SCALE} * cast(c AS double), -9e15D), 9e15D)) AS long) + {SHIFT}L"
    return embeddings.selectExpr("cast(vec_id AS long) AS vec_id", "embedding").where(
        "size(embedding) > 0 AND forall(embedding, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))"
    ).selectExpr("vec_id", f"transform(embedding, c -> {entry}) AS x")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per row of (vec_id, embedding) and component: n (vectors fitted on), deviation,
    whitened, explained and identity_error.

    Rows whose vector is null, empty or holds null or non-finite entries give no rows. Vectors
    must have one length: where several occur, the commonest of the fit list counts (of equally
    common ones the longest) and rows of other lengths give no rows. Repeated vectors are fitted
    once and each gets its rows, as do repeated and null ids. Equal eigenvalues get some
    orthonormal basis. There are no more components than the covariance has rank: a single
    distinct vector or an empty table gives no rows. ``deviation`` is null where it passes 64
    bits; entries beyond 9e15 after scaling count as 9e15. Extra columns are ignored."""
    spark = embeddings.sparkSession
    clean = prepared(embeddings)
    fit = cut(clean.select("x").distinct(), "fit")
    lengths = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], SCHEMA)
    d, n = lengths
    fit, clean = fit.where(f"size(x) = {d}"), clean.where(f"size(x) = {d}")
    centre = Centre(n, _sums(fit))
    v = _covariance(fit, d, n, centre)
    values, vectors = leading(v, min(components, d))
    k = len(values)
    if not k:
        return spark.createDataFrame([], SCHEMA)
    scaled, share = vectors / np.sqrt(values), values / np.trace(v)
    off = _covariance(fit, k, n, lambda x: centre(x) @ scaled) - np.eye(k)
    error = float(np.abs(off).max())

    def run(batches):
        import pyarrow as pa

        for b in batches:
            m = b.num_rows
            if m:
                x = _matrix(b.column(1))
                ids = b.column(0).take(pa.array(np.repeat(np.arange(m), k)))
                deviation = pa.array(centre.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, n), pa.int64()), deviation,
                    pa.array((centre(x) @ scaled).ravel()), pa.array(np.tile(share, m)),
                    pa.array(np.full(m * k, error))],
                    [f.split()[0] for f in SCHEMA.split(", ")])

    return map_arrow(clean, run, SCHEMA)
