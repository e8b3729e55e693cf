"""Whitening of embeddings by a bidiagonal qd solver (operator 13).

Components become integers, so sums are exact. Centred rows are reduced block by block to triangular factors
(QR), and factors of tasks are merged sixteen at a time until one, R, is left: the covariance itself is never
formed. Householder reflections make R bidiagonal, dqds (differential quotient-difference with shifts) finds
its singular values to high relative accuracy, and twisted factorisations recover the right singular vectors, which
the reflections turn into whitening directions. R has as many rows as a vector has entries, whatever the table holds.

The fit list holds every distinct vector once. Rows whose vector is null, empty, or holds null or non-finite entries
are dropped, and so are vectors of another length than the most common one among the distinct (the longer one of
equals), as they have no place in one covariance. Entries beyond 64 bits are the largest number of 64 bits. Rows that repeat a
vec_id are rows of their own; a null vec_id stays. `deviation` is null where the exact value needs more than 64 bits.
Where an eigenvalue is zero (fewer distinct vectors than components, constant entries), `whitened` is null;
`explained` is null where all are. Directions of equal eigenvalues are any orthonormal ones. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.common import discard, grouped, materialise, tidy

COMPONENTS = 4
SCALE = 256
BLOCK_ROWS = 4096
FAN_IN = 16  # triangular factors merged by one task
EPS = float(np.finfo(np.float64).eps)
CLOSE = 1e-3  # eigenvalues nearer than this, relatively, get directions made orthogonal


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit v and the value a with (I - 2 v vT) x = a e1."""
    size = float(np.linalg.norm(x))
    if size == 0.0:
        return np.zeros_like(x), 0.0
    first = -math.copysign(size, x[0])
    v = x.copy()
    v[0] -= first
    return v / np.linalg.norm(v), first


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal and right reflectors of a square matrix; reflector k acts on entries k + 1 and on."""
    work, size = r.astype(np.float64, copy=True), len(r)
    diagonal, above, right = np.zeros(size), np.zeros(max(0, size - 1)), []
    for k in range(size):
        v, diagonal[k] = reflector(work[k:, k])
        work[k:, k + 1 :] -= 2 * np.outer(v, v @ work[k:, k + 1 :])
        if k < size - 1:
            w, above[k] = reflector(work[k, k + 1 :])
            work[k + 1 :, k + 1 :] -= 2 * np.outer(work[k + 1 :, k + 1 :] @ w, w)
            right.append(w)
    return diagonal, above, right


def _sweep(q: list[float], e: list[float], lo: int, hi: int, shift: float):
    """One differential transform of the part lo..hi: new q and e and the smallest d, or None where the shift was too large."""
    new_q, new_e, d = [], [], q[lo] - shift
    least = d
    for i in range(lo, hi):
        if d < 0.0:
            return None
        total = d + e[i]
        if total == 0.0:
            return None
        ratio = q[i + 1] / total
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if d < 0.0:
        return None
    new_q.append(d)
    return new_q, new_e, least


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix from the squares of its entries, largest first."""
    q, e, found = [float(v) for v in q], [float(v) for v in e], []
    small = (10 * EPS) ** 2
    parts = [(0, len(q) - 1, 0.0)]
    while parts:
        lo, hi, sigma = parts.pop()
        least = 0.0
        for _ in range(100 * (hi - lo + 2)):
            if lo > hi:
                break
            if lo == hi or e[hi - 1] <= small * (sigma + q[hi]):
                found.append(sigma + q[hi])
                hi -= 1
                least = 0.0
                continue
            cut = next((i for i in range(hi - 2, lo - 1, -1) if e[i] <= small * (sigma + min(q[i], q[i + 1]))), None)
            if cut is not None:
                parts.append((lo, cut, sigma))
                lo, least = cut + 1, 0.0
                continue
            if q[hi] > 1.5 * q[lo]:  # the small end belongs at the bottom
                q[lo : hi + 1], e[lo:hi], least = q[lo : hi + 1][::-1], e[lo:hi][::-1], 0.0
            # The last diagonal entry less its neighbour's reach is about the smallest value; too much is tried again with less.
            shift = least / 4 if least < q[hi] else max(0.0, q[hi] - math.sqrt(q[hi] * e[hi - 1])) * (1 - 4 * EPS)
            if not least:
                shift = 0.0
            done = _sweep(q, e, lo, hi, shift)
            while done is None and shift > 0.0:
                shift = shift / 4 if shift > small * q[hi] else 0.0
                done = _sweep(q, e, lo, hi, shift)
            if done is None:  # a zero on the diagonal with nothing beside it
                e[next(i for i in range(lo, hi) if q[i] + e[i] == 0.0)] = 0.0
                continue
            q[lo : hi + 1], e[lo:hi], least = done
            sigma += shift
        else:
            raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(found))[::-1]


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float, earlier: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of BT B for an eigenvalue: the twisted factorisation with the smallest pivot.

    With `earlier` vectors of nearly equal values, the factorisation serves inverse iteration orthogonal to those.
    """
    size, tiny = len(diagonal), 1e-290
    d, ratio = diagonal**2, above / diagonal[:-1]
    down, up = np.zeros(size - 1), np.zeros(size - 1)
    s, p = np.zeros(size), np.zeros(size)
    from_top, from_end = np.zeros(size), np.zeros(size)
    s[0], p[-1] = -value, d[-1] - value
    for i in range(size - 1):
        from_top[i] = s[i] + d[i] or tiny
        down[i] = d[i] * ratio[i] / from_top[i]
        s[i + 1] = down[i] * ratio[i] * s[i] - value
    for i in range(size - 2, -1, -1):
        from_end[i + 1] = d[i] * ratio[i] ** 2 + p[i + 1] or tiny
        up[i] = ratio[i] * d[i] / from_end[i + 1]
        p[i] = p[i + 1] * (d[i] / from_end[i + 1]) - value
    pivots = np.abs(s + p + value)
    at = int(np.argmin(np.where(np.isfinite(pivots), pivots, np.inf)))

    def back(z: np.ndarray) -> np.ndarray:
        for i in range(at - 1, -1, -1):
            z[i] -= down[i] * z[i + 1]
        for i in range(at, size - 1):
            z[i + 1] -= up[i] * z[i]
        return z / np.linalg.norm(z)

    if not earlier:
        z = np.zeros(size)
        z[at] = 1.0
        return back(z)
    middle = np.concatenate((from_top[:at], [max(pivots[at], EPS * value, tiny)], from_end[at + 1 :]))
    z = np.random.default_rng(len(earlier)).normal(size=size)
    for _ in range(6):
        for i in range(at):
            z[i + 1] -= down[i] * z[i]
        for i in range(size - 2, at - 1, -1):
            z[i] -= up[i] * z[i + 1]
        z = back(z / middle)
        for _ in range(2):
            for other in earlier:
                z -= (other @ z) * other
            z /= np.linalg.norm(z)
    return z


def right_vectors(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest squared singular values of a square matrix and the right singular vectors as rows."""
    size = len(r)
    diagonal, above, reflectors = bidiagonal(r)
    norm = float(max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0)))
    if norm == 0.0:
        return np.zeros(min(k, size)), np.eye(size)[:k]
    above[np.abs(above) <= EPS * norm] = 0.0
    ends = [*np.flatnonzero(above == 0.0), size - 1]
    values = []
    for lo, hi in zip([0, *(i + 1 for i in ends[:-1])], ends, strict=True):
        values += [(v, lo, hi + 1) for v in dqds(diagonal[lo : hi + 1] ** 2, above[lo:hi] ** 2)]
    values = sorted(values, reverse=True)[: min(k, size)]
    floor = np.where(np.abs(diagonal) < EPS**2 * norm, EPS**2 * norm, diagonal)
    vectors = []
    for number, (value, lo, hi) in enumerate(values):
        near = [
            v[lo:hi] for (other, a, _), v in zip(values[:number], vectors, strict=True) if a == lo and other - value <= CLOSE * other
        ]
        z = np.zeros(size)
        z[lo:hi] = twisted(floor[lo:hi], above[lo : hi - 1], value, near) if hi - lo > 1 else 1.0
        vectors.append(z)
    out = np.array(vectors)
    for j in range(len(reflectors) - 1, -1, -1):
        w = reflectors[j]
        out[:, j + 1 :] -= 2 * np.outer(out[:, j + 1 :] @ w, w)
    return np.array([v for v, _, _ in values]), out / np.linalg.norm(out, axis=1, keepdims=True)


def integers(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def gaps(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: in 64 bits where they surely suffice for the sum of squares, else as Python integers."""
    largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if len(sums) * (n * largest + max(map(abs, sums))) ** 2 < 1 << 63:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _triangular(matrix: np.ndarray) -> np.ndarray:
    return np.linalg.qr(matrix, mode="r")


def _sums(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(length, np.int64), np.zeros(length, np.int64), 0
        for batch in batches:
            x = integers(batch.column(0), length)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            n += len(x)
        columns = [np.arange(length), high, low, np.full(length, n)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["at", "high", "low", "n"])

    return work


def _factors_of_rows(n: int, sums: list[int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.zeros((0, len(sums)))
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                x = integers(batch.column(0).slice(begin, BLOCK_ROWS), len(sums))
                factor = _triangular(np.vstack((factor, gaps(x, n, sums).astype(np.float64) / n)))
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(factor), pa.int64()), pa.array(list(factor), pa.list_(pa.float64()))], names=["part", "row"])

    return work


def _merged(length: int, finish=None):
    """Factors with equal `part` become one, row by row, or what `finish` makes of it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, factor = None, np.zeros((0, length))

        def out():
            if finish is not None:
                return finish(factor)
            return pa.RecordBatch.from_arrays([pa.array([current[0]] * len(factor), pa.int64()), pa.array(list(factor), pa.list_(pa.float64()))], names=["part", "row"])

        for key, piece in grouped(batches, ["part"]):
            if key != current:
                if current is not None:
                    yield out()
                current, factor = key, np.zeros((0, length))
            factor = _triangular(np.vstack((factor, integers(piece.column(1), length))))
        if current is not None:
            yield out()

    return work


def _solution(n: int, length: int, k: int):
    def finish(factor: np.ndarray) -> pa.RecordBatch:
        square = np.zeros((length, length))
        square[: len(factor)] = factor
        values, directions = right_vectors(square, k)
        total = float((square**2).sum()) / n
        return pa.RecordBatch.from_arrays(
            [pa.array(range(1, len(values) + 1), pa.int32()), pa.array(values / n), pa.array([total] * len(values)), pa.array(list(directions), pa.list_(pa.float64()))],
            names=["component", "value", "total", "direction"],
        )

    return finish


class Model:
    """Sums, eigenvalues and directions; a few numbers per entry of a vector."""

    def __init__(self, n: int, sums: list[int], rows: list) -> None:
        self.n, self.sums = n, sums
        self.values = np.array([r["value"] for r in rows])
        self.directions = np.array([r["direction"] for r in rows])
        self.total = rows[0]["total"] if rows else 0.0
        floor = (len(sums) * EPS) ** 2 * self.values.max(initial=0.0)
        self.real = self.values > floor
        self.identity_error: float | None = None

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Columns of the components whose eigenvalue is not zero."""
        centred = gaps(x, self.n, self.sums).astype(np.float64) / self.n
        return (centred @ self.directions[self.real].T) / np.sqrt(self.values[self.real])


def _spread(model: Model):
    """Number, mean and centred products of the whitened rows of a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, 0.0, 0.0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            w = model.whitened(integers(batch.column(0), len(model.sums)))
            own = w.mean(axis=0)
            shift, both = own - mean, n + len(w)
            products = products + (w - own).T @ (w - own) + np.outer(shift, shift) * (n * len(w) / both)
            mean, n = mean + shift * (len(w) / both), both
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([mean.tolist()], pa.list_(pa.float64())), pa.array([products.ravel().tolist()], pa.list_(pa.float64()))],
                names=["n", "mean", "products"],
            )

    return work


def identity_error(fit: DataFrame, model: Model) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity; None without a component."""
    k = int(model.real.sum())
    if k == 0:
        return None
    parts = materialise(fit.mapInArrow(tidy(_spread(model)), "n long, mean array<double>, products array<double>"), "spread")
    mean = list(parts.agg(*[(F.sum(F.col("n") * F.get("mean", F.lit(i))) / model.n).alias(f"m{i}") for i in range(k)]).first())
    entries = [
        (F.sum(F.get("products", F.lit(i * k + j)) + F.col("n") * (F.get("mean", F.lit(i)) - mean[i]) * (F.get("mean", F.lit(j)) - mean[j])) / model.n).alias(f"c{i}_{j}")
        for i in range(k) for j in range(k)
    ]
    covariance = np.array(parts.agg(*entries).first()).reshape(k, k)
    discard(parts)
    return float(np.abs(covariance - np.eye(k)).max())


def fit_model(fit: DataFrame, length: int, components: int) -> Model:
    """Fit on a table of distinct integer vectors x of one length."""
    parts = fit.mapInArrow(tidy(_sums(length)), "at long, high long, low long, n long")
    sums = parts.groupBy("at").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]).orderBy("at").collect()
    n, totals = int(sums[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in sums]
    schema = "part long, row array<double>"
    factors = materialise(fit.mapInArrow(tidy(_factors_of_rows(n, totals)), schema), "factors")
    while True:
        parts_left = factors.agg(F.max("part")).first()[0]
        bucket = F.floor(F.col("part") / F.lit(FAN_IN)).alias("part")
        dealt = factors.select(bucket, "row").repartition("part").sortWithinPartitions("part")
        if parts_left < FAN_IN:
            shape = "component int, value double, total double, direction array<double>"
            solved = dealt.mapInArrow(tidy(_merged(length, _solution(n, length, components))), shape).orderBy("component").collect()
            discard(factors)
            return Model(n, totals, solved)
        before, factors = factors, materialise(dealt.mapInArrow(tidy(_merged(length)), schema), "factors")
        discard(before)


def finite_vector(c: Column) -> Column:
    x = F.transform(c, lambda v: v.cast("double"))
    return F.coalesce((F.size(c) > 0) & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))), F.lit(False))


def integer_vector(c: Column, scale: int = SCALE) -> Column:
    return F.transform(c, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("long"))


def whitened_rows(
    table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per remaining row and component."""
    usable = table.filter(finite_vector(F.col(vector_col)))
    rows = usable.select(F.col(id_col).cast("long").alias("vec_id"), integer_vector(F.col(vector_col)).alias("x"))
    shape = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    distinct = materialise(rows.select("x").distinct(), "fit")
    common = distinct.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if common is None:
        discard(distinct)
        return table.sparkSession.createDataFrame([], shape)
    length = common["length"]
    fit = distinct.filter(F.size("x") == length)
    model = fit_model(fit, length, components)
    model.identity_error = identity_error(fit, model)
    discard(distinct)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        explained = [v / model.total if model.total > 0 else None for v in model.values.tolist()]
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(begin, BLOCK_ROWS)
                x = integers(part.column(1), length)
                squares = (gaps(x, model.n, model.sums) ** 2).sum(axis=1)
                exact = [v if v < 1 << 63 else None for v in squares.tolist()]
                w = np.full((len(x), k), np.nan)
                w[:, model.real] = model.whitened(x)
                every = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * k, model.n)), pa.array(exact, pa.int64()).take(pa.array(every)),
                        pa.array(w.ravel(), mask=np.isnan(w.ravel())), pa.array(explained * len(x), pa.float64()),
                        pa.array([model.identity_error] * (len(x) * k), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.filter(F.size("x") == length).mapInArrow(tidy(place), shape)
