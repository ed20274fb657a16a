"""Whitening of embeddings onto the leading principal components of their integer grid.

Two narrow passes sum the grid vectors and the products of their centred entries; both sums are
tables of a size given by the dimensions alone. The symmetric matrix is reduced to tridiagonal form
by Householder reflections, the leading eigenvalues are bisected by Sturm counts, and their vectors
come from inverse iteration, orthogonalised again inside clusters. The projection travels with the
task's function, and a third pass measures what the projected rows' covariance is off the identity.

Entries are centred by the rounded mean, which keeps them whole numbers, and the mean's fraction is
taken out exactly. So the sums are the same in any order while they stay below 2^53.

Defined results: rows whose vector is null, or holds a null, a non-finite entry or one of 2^42 and
more, are left out; so are vectors of another length than the most frequent one (the longer of equally
frequent ones); null and repeated ids are rows like any other; components whose eigenvalue cannot be
told from zero are left out, so equal vectors alone, empty vectors and empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Entries from here on have no exact place on the grid.
TOO_LARGE = float(1 << 42)
#: Eigenvalues up to this share of the largest are rounding.
NEGLIGIBLE = 1e-11
#: Eigenvalues closer than this share of the matrix's size form a cluster.
CLUSTER = 1e-3
#: Entries handled at a time in a task.
CHUNK = 1 << 20


@dataclass(frozen=True)
class Whitening:
    """What a fit found: exact counts and sums, eigenvalues and components of the covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray  # one row per component
    explained: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        """Rounded mean of each dimension."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """Sum of the entries around the rounded mean, exact."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.centre)]

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened values of grid vectors less ``centre``, one column per component."""
        off = np.array([r / self.n for r in self.rest])
        return (y - off) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is whole and finite, as ``v`` of doubles."""
    fine = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < TOO_LARGE))
    return df.withColumn("v", F.col(vector).cast("array<double>")).filter(
        F.col("v").isNotNull() & fine)


def grids(column: pa.Array):
    """(rows, grid vectors) of a list column, by length and in chunks of bounded size."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, CHUNK // max(1, size))
        for i in range(0, len(rows), step):
            part = rows[i:i + step]
            values = column.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False)
            yield part, np.floor(values * SCALE).astype(np.int64).reshape(
                len(part), size) + SHIFT


def sums(rows: DataFrame) -> DataFrame:
    """(d, i, n, s): for each vector length and dimension, how many vectors and their exact sum."""
    def add(batches):
        total = {}
        for batch in batches:
            for part, x in grids(batch.column("v")):
                n, s = total.get(x.shape[1], (0, [0] * x.shape[1]))
                # Halves keep sums of a chunk far from overflow.
                low, high = (x & 0xFFFFFFFF).sum(0).tolist(), (x >> 32).sum(0).tolist()
                total[x.shape[1]] = n + len(part), [
                    t + (h << 32) + l for t, h, l in zip(s, high, low)]
        out = [(d, i, n, Decimal(v)) for d, (n, s) in total.items() for i, v in enumerate(s)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[k] for o in out], t) for k, t in enumerate(
                (pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)))], ["d", "i", "n", "s"])

    return rows.select("v").mapInArrow(add, "d int, i int, n long, s decimal(38,0)").groupBy(
        "d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def products(rows: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Sum over all rows of the centred vectors' products with themselves."""
    d = len(centre)
    upper = np.triu_indices(d)

    def add(batches):
        total = np.zeros((d, d))
        for batch in batches:
            for _, x in grids(batch.column("v")):
                y = (x - centre).astype(float)
                total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], ["k", "g"])

    found = rows.select("v").mapInArrow(add, "k long, g double").groupBy("k").agg(
        F.sum("g").alias("g")).toArrow()
    out = np.zeros((d, d))
    k, g = (found.column(c).to_numpy() for c in ("k", "g"))
    out[upper[0][k], upper[1][k]] = g
    return np.triu(out) + np.triu(out, 1).T


def tridiagonal(matrix: np.ndarray):
    """(diagonal, off-diagonal, reflectors) of a symmetric matrix, by Householder reflections."""
    a, n = matrix.astype(float).copy(), len(matrix)
    off, reflectors = np.zeros(max(n - 1, 0)), []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        length = np.linalg.norm(v)
        off[k] = -np.copysign(length, v[0])
        v[0] -= off[k]
        size = np.linalg.norm(v)
        v = v / size if size else v
        reflectors.append(v)
        block = a[k + 1:, k + 1:]
        p = block @ v
        w = p - (v @ p) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
    if n > 1:
        off[-1] = a[-1, -2]
    return np.diag(a).copy(), off, reflectors


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each value."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, q = np.zeros(len(at), int), None
    for k in range(len(diagonal)):
        with np.errstate(over="ignore"):
            q = diagonal[k] - at - (off[k - 1] ** 2 / q if k else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, bisected until no double lies between the bounds."""
    n, around = len(diagonal), np.append(0, np.abs(off)) + np.append(np.abs(off), 0)
    low = np.full(k, (diagonal - around).min())
    high = np.full(k, (diagonal + around).max())
    pad = np.finfo(float).eps * max(1.0, np.abs(low).max(), np.abs(high).max()) * n
    low, high = low - pad, high + pad
    rank = n - np.arange(k)  # the first is above n - 1 others, so n lie below its upper bound
    while True:
        middle = low + (high - low) / 2
        open_ = (low < middle) & (middle < high)
        if not open_.any():
            return high
        reached = below(diagonal, off, middle) >= rank
        high = np.where(open_ & reached, middle, high)
        low = np.where(open_ & ~reached, middle, low)


def solved(diagonal: np.ndarray, off: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of a tridiagonal system, rows exchanged for larger pivots, none below ``least``."""
    n = len(diagonal)
    d, low = diagonal.tolist(), off.tolist()
    up, up2, b = off.tolist() + [0.0], [0.0] * n, right.tolist()
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            d[i], low[i] = low[i], d[i]
            up[i], d[i + 1] = d[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], up2[i]
            b[i], b[i + 1] = b[i + 1], b[i]
        d[i] = d[i] if abs(d[i]) > least else least
        m = low[i] / d[i]
        d[i + 1] -= m * up[i]
        up[i + 1] -= m * up2[i]
        b[i + 1] -= m * b[i]
    d[-1] = d[-1] if abs(d[-1]) > least else least
    x = [0.0] * (n + 2)
    for i in range(n - 1, -1, -1):
        x[i] = (b[i] - up[i] * x[i + 1] - up2[i] * x[i + 2]) / d[i]
    return np.array(x[:n])


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix for falling eigenvalues, one row each."""
    n = len(diagonal)
    size = max(np.abs(diagonal).max(), np.abs(off).max() if n > 1 else 0.0)
    least = np.finfo(float).eps * size
    rng, out = np.random.default_rng(11), np.zeros((len(values), n))
    first = 0  # of the cluster
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * size:
            first = k
        x = rng.standard_normal(n)
        for _ in range(5):
            x = solved(diagonal - value, off, x / np.linalg.norm(x), least)
            x /= np.abs(x).max()
            for _ in range(2):  # once more for what rounding leaves
                x -= out[first:k].T @ (out[first:k] @ x)
        out[k] = x / np.linalg.norm(x)
    return out


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues of a symmetric matrix and their unit vectors, one row each."""
    diagonal, off, reflectors = tridiagonal(matrix)
    values = leading_values(diagonal, off, min(k, len(matrix)))
    values = values[values > NEGLIGIBLE * max(values[0], 0)] if len(values) else values
    vectors = leading_vectors(diagonal, off, values)
    for i in range(len(reflectors) - 1, -1, -1):
        v = reflectors[i]
        vectors[:, i + 1:] -= 2 * np.outer(vectors[:, i + 1:] @ v, v)
    top = np.abs(vectors).argmax(1) if len(vectors) else np.zeros(0, int)
    return values, vectors * np.sign(vectors[np.arange(len(vectors)), top])[:, None]


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Whitening of all usable vectors; None where there are none to speak of."""
    rows = usable(df, vector)
    totals = sums(rows)
    main = totals.filter("i = 0").orderBy(F.desc("n"), F.desc("d")).first()
    if main is None:
        return None
    found = {r["i"]: r for r in totals.filter(F.col("d") == main["d"]).collect()}
    plain = Whitening(main["n"], tuple(int(found[i]["s"]) for i in range(main["d"])),
                      np.zeros(0), np.zeros((0, main["d"])), np.zeros(0))
    off = np.array([r / plain.n for r in plain.rest])
    covariance = products(rows.filter(F.size("v") == main["d"]), plain.centre) / plain.n
    covariance -= np.outer(off, off)
    trace = np.trace(covariance)
    if not trace > 0:
        return None
    values, vectors = leading(covariance, components)
    return Whitening(plain.n, plain.sums, values, vectors, values / trace)


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    k, centre = len(model.values), model.centre

    def add(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in grids(batch.column("v")):
                w = model.project(x - centre)
                total += np.vstack([w.T @ w, w.sum(0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], ["k", "g"])

    rows = usable(df, vector).filter(F.size("v") == len(centre)).select("v")
    found = rows.mapInArrow(add, "k long, g double").groupBy("k").agg(
        F.sum("g").alias("g")).toArrow()
    total = np.zeros((k + 1, k))
    total.flat[found.column("k").to_numpy()] = found.column("g").to_numpy()
    mean = total[k] / model.n
    return float(np.abs(total[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(df: DataFrame, model: Whitening, vector: str = "embedding", key: str = "vec_id",
             error: float | None = None) -> DataFrame:
    """One row per usable vector and component: the whitened value and how far off the vector is.

    ``deviation`` is null where a long cannot hold it; ``deviation_decimal`` then may.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = (f"{key} {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double, deviation_decimal decimal(38,0)")
    k, centre, rest, n = len(model.values), model.centre, model.rest, model.n
    far = 10 ** 38

    def off(y: np.ndarray) -> list[int]:
        """Sum of the squares of n * x - S, exact."""
        most = n * int(np.abs(y).max(initial=0)) + max(map(abs, rest), default=0)
        if most * most * len(rest) < 1 << 63:
            return ((n * y - np.array(rest)) ** 2).sum(1).tolist()
        return [sum((n * v - r) ** 2 for v, r in zip(row, rest)) for row in y.tolist()]

    def give(batches):
        for batch in batches:
            for part, x in grids(batch.column("v")):
                y, m = x - centre, len(part)
                far_off = off(y)
                deviation = pa.array([v if v < 1 << 63 else None for v in far_off], pa.int64())
                decimal = pa.array([Decimal(v) if v < far else None for v in far_off],
                                   pa.decimal128(38, 0))
                w = model.project(y)
                for c in range(k):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key).take(pa.array(part)),
                         pa.array(np.full(m, c + 1), pa.int32()), pa.array(np.full(m, n)),
                         deviation, pa.array(np.ascontiguousarray(w[:, c])),
                         pa.array(np.full(m, model.explained[c])),
                         pa.array([error] * m, pa.float64()), decimal],
                        [f.split()[0] for f in schema.split(", ")])

    rows = usable(df, vector).filter(F.size("v") == len(centre))
    return rows.select(F.col(key), "v").mapInArrow(give, schema)


def whiten(df: DataFrame, vector: str = "embedding", key: str = "vec_id",
           components: int = COMPONENTS) -> DataFrame:
    """Fit over all rows, measure, and whiten every row."""
    model = fit(df, vector, components)
    if model is None or not len(model.values):
        empty = Whitening(1, (), np.zeros(0), np.zeros((0, 0)), np.zeros(0))
        return whitened(df.limit(0), empty, vector, key)
    return whitened(df, model, vector, key, identity_error(df, model, vector))
