"""Whitening of embeddings by a bidiagonal singular value decomposition of centred vectors, without a covariance matrix.

Entries become whole numbers, so that sums and deviations are exact. Each task reduces its centred vectors to one
triangular factor by QR, block after block; factors are reduced again in groups until a few are left. The last factor R
has the singular values and right singular vectors of all centred vectors. Householder reflections turn it into a
bidiagonal one, the dqds algorithm finds the singular values, and twisted factorisations give the vector of each. Only
the last steps run on the driver, on a square matrix of the vectors' dimension.

Defined results: vectors that are null, hold null or non-finite entries, or entries beyond 2**30 in size are dropped; so
are empty ones and those of another length than most (of equally frequent lengths the longest stays). Components whose
singular value is zero within rounding don't exist: constant vectors and a single vector give no rows, as does an empty
table. Repeated rows count and are returned each. Columns other than the id and the vector are left out. An exact
deviation is a decimal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import pieces_of, store

EPS = float(np.finfo(float).eps)
#: Vectors in one block of a QR step, and triangular factors that are reduced together.
BLOCK, FAN = 4096, 16


@dataclass(frozen=True)
class Whitening:
    """n vectors with per-dimension sums; directions are columns, by falling eigenvalue."""

    n: int
    sums: list[int]
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.directions / np.sqrt(self.eigenvalues))

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums of (n * x - sum)**2, exact."""
        whole, rest = np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n for s in self.sums], np.int64)
        y = x - whole
        most = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if most * most * x.shape[1] < 1 << 62:
            return pc.cast(pa.array(((y * self.n - rest) ** 2).sum(axis=1)), pa.decimal128(38, 0))
        wide = y.astype(object) * self.n - rest.astype(object)
        return pa.array((wide * wide).sum(axis=1).tolist(), pa.decimal128(38, 0))


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n, rounded once: whole parts are taken off as whole numbers."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole) - np.array([s % n / n for s in sums])


def matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int, offset: int) -> DataFrame:
    """id, x: the usable vectors as whole numbers floor(scale * c) + offset."""
    good = F.forall(F.col("v"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= float(1 << 30)))
    chosen = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return chosen.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(good).select("id", F.transform("v", lambda c: F.floor(c * scale) + F.lit(offset)).alias("x"))


def totals(x: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors of the commonest length, and their exact sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            length = pc.list_value_length(column).to_numpy()
            for size in np.unique(length).tolist():
                rows = matrix(column.filter(pa.array(length == size)), size)
                sums = np.zeros(size, object)
                for k in range(0, len(rows), BLOCK):
                    sums = sums + rows[k : k + BLOCK].sum(axis=0).astype(object)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size], pa.int32()), pa.array([len(rows)], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.decimal128(38, 0)))], names=["size", "n", "sums"]
                )

    parts = store(x.select("x").mapInArrow(run, "size int, n long, sums array<decimal(38,0)>"), "whiten-sums")
    top = parts.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).head()
    if not top:
        return 0, []
    sums = parts.filter(F.col("size") == top["size"]).select(F.posexplode("sums").alias("k", "s")).groupBy("k").agg(F.sum("s").alias("s"))
    return top["n"], [int(r["s"]) for r in sums.orderBy("k").collect()]  # one row for each dimension


def reduced(blocks: Iterator[np.ndarray], size: int) -> np.ndarray:
    """The triangular factor of all blocks' rows."""
    r = np.empty((0, size))
    for block in blocks:
        r = np.linalg.qr(np.vstack([r, block]), mode="r")
    return r


def triangular_factor(x: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the QR factorisation of all centred vectors: by tasks, then by groups of FAN until one group is left."""
    size = len(sums)

    def row(r: np.ndarray, part: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))], names=["part", "r"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (matrix(b.column(0), size) for batch in batches for b in pieces_of(batch, BLOCK * size * 8))
        r = reduced((centred(y, n, sums) for y in rows), size)
        if len(r):
            yield row(r, TaskContext.get().partitionId())

    def again(key: tuple, rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([row(reduced((np.array(r).reshape(-1, size) for r in rows.sort_by("part")["r"].to_pylist()), size), key[0].as_py())])

    schema = "part long, r array<double>"
    tasks = x.rdd.getNumPartitions()
    factors = x.select("x").mapInArrow(first, schema)
    while tasks > FAN:
        factors = factors.groupBy(F.expr(f"part div {FAN}").alias("group")).applyInArrow(again, schema)
        tasks = -(-tasks // FAN)
    found = sorted(factors.collect(), key=lambda r: r["part"])  # FAN square matrices at most
    r = reduced((np.array(f["r"]).reshape(-1, size) for f in found), size)
    return np.vstack([r, np.zeros((size - len(r), size))])


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v, beta: I - beta v v' maps x to a multiple of the first unit vector."""
    v, norm = x.copy(), float(np.linalg.norm(x))
    if norm == 0.0:
        return v, 0.0
    v[0] += np.copysign(norm, v[0])
    return v, 2.0 / float(v @ v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of r = U B V' by Householder reflections."""
    a, d = r.astype(float).copy(), r.shape[1]
    v = np.eye(d)
    for k in range(d):
        u, beta = reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(u, u @ a[k:, k:])
        if k < d - 2:
            u, beta = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= beta * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transform with shift; None if the shift is above the smallest eigenvalue."""
    d = least = q[0] - shift
    if d < 0.0:
        return None
    new_q, new_e = [0.0] * len(q), [0.0] * len(e)
    for i in range(len(e)):
        new_q[i] = d + e[i]
        ratio = q[i + 1] / new_q[i] if new_q[i] > 0.0 else 0.0
        new_e[i] = e[i] * ratio
        d = d * ratio - shift if new_q[i] > 0.0 else q[i + 1] - shift
        if not d >= 0.0:
            return None
        least = min(least, d)
    new_q[-1] = d
    return new_q, new_e, least


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix: differential qd transforms with shifts that keep all positive.

    What has been shifted off is only ever added back, so small values keep their relative accuracy.
    """
    q, e = (diagonal**2).tolist(), (above**2).tolist()
    found: list[float] = []
    work = [(q, e, 0.0)]  # parts that have come apart, each with what has been shifted off
    while work:
        q, e, shifted = work.pop()
        least = 0.0
        while True:
            if len(q) == 1:
                found.append(q[0] + shifted)
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (shifted + min(q[i], q[i + 1]))), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], shifted))
                q, e, least = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            for shift in (least * (1 - 1e-3), least * 0.5, least * 0.1, 0.0):
                step = qd_step(q, e, shift)
                if step:
                    break
            q, e, least = step
            shifted += shift
    return np.sort(np.array(found))[::-1]


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """The unit vector of B'B for an eigenvalue, from the twisted factorisation with the smallest pivot; the value corrected.

    With B'B = L D L', one factorisation runs down, one up; they are joined where they leave least.
    """
    n = len(diagonal)
    tiny = EPS * EPS * max(value, float((diagonal**2).max()))
    D = np.maximum(diagonal**2, tiny)
    L = above * diagonal[:-1] / D[:-1]
    down, up, s, p = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + D[i]
        down[i] = D[i] * L[i] / (pivot if abs(pivot) > tiny else tiny)
        s[i + 1] = down[i] * L[i] * s[i] - value
    p[-1] = D[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = D[i] * L[i] ** 2 + p[i + 1]
        ratio = D[i] / (pivot if abs(pivot) > tiny else tiny)
        up[i] = L[i] * ratio
        p[i] = p[i + 1] * ratio - value
    gamma = s + p + value
    k = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    size = float(np.linalg.norm(z))
    return z / size, value + float(gamma[k]) / size**2


def leading(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of r'r and their vectors, as columns; none for values that are zero within rounding."""
    diagonal, above, v = bidiagonal(r)
    scale = float(np.sqrt((diagonal**2).sum() + (above**2).sum()))
    if scale == 0.0:
        return np.empty(0), np.empty((len(r), 0))
    # where the matrix falls apart, vectors belong to one part each
    bounds = [0, *(np.flatnonzero(np.abs(above) <= len(diagonal) * EPS * scale) + 1).tolist(), len(diagonal)]
    found = [(float(x), a, b) for a, b in zip(bounds, bounds[1:], strict=False) for x in dqds(diagonal[a:b], above[a : b - 1])]
    found = [f for f in sorted(found, reverse=True) if f[0] > (len(diagonal) * EPS * scale) ** 2][:most]
    values, columns = [], []
    for value, a, b in found:
        z, better = twisted(diagonal[a:b], above[a : b - 1], value)
        if abs(better - value) <= 1e-8 * value:
            z, _ = twisted(diagonal[a:b], above[a : b - 1], better)
        whole = np.zeros(len(diagonal))
        whole[a:b] = z
        values.append(value)
        columns.append(whole)
    values, z = np.array(values), np.array(columns).T
    start = 0
    for k in range(1, len(values) + 1):  # vectors of close values are made orthogonal, and turned to those of their span
        if k == len(values) or values[k - 1] - values[k] > 1e-3 * values[k - 1]:
            if k - start > 1:
                basis = np.linalg.qr(z[:, start:k])[0]
                product = diagonal[:, None] * basis
                product[:-1] += above[:, None] * basis[1:]
                _, turn = np.linalg.eigh(product.T @ product)
                z[:, start:k] = basis @ turn[:, ::-1]
            start = k
    return values, v @ z


def fit(x: DataFrame, components: int = 8) -> Whitening:
    """The whitening of whole vectors (``whole_vectors``, stored), which are read twice."""
    n, sums = totals(x)
    if not n:
        return Whitening(0, [], np.empty((0, 0)), np.empty(0), 0.0)
    r = triangular_factor(x.filter(F.size("x") == len(sums)), n, sums)
    values, directions = leading(r, components)
    return Whitening(n, sums, directions, values / n, float((r**2).sum()) / n)


def identity_error(x: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, from all whitened vectors."""
    k, size = len(model.eigenvalues), len(model.sums)
    if not k:
        return 0.0
    names = [f"s{i}" for i in range(k * k + k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k + k)
        for batch in batches:
            for part in pieces_of(batch, BLOCK * size * 8):
                z = model.whitened(matrix(part.column(0), size))
                total += np.concatenate([(z.T @ z).ravel(), z.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array([t]) for t in total], names=names)

    row = x.select("x").mapInArrow(run, ", ".join(f"{c} double" for c in names)).agg(*[F.sum(c).alias(c) for c in names]).head()
    total = np.array(row) / model.n
    mean = total[k * k :]
    return float(np.abs(total[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8, scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """One row for each usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    x = store(whole_vectors(vectors, id_col, vec_col, scale, offset), "whiten-vectors")
    model = fit(x, components)
    size, k = len(model.sums), len(model.eigenvalues)
    x = x.filter(F.size("x") == size) if k else x.limit(0)
    error = identity_error(x, model)
    kind = x.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, BLOCK * size * 8):
                rows = matrix(part.column(1), size)
                at = pa.array(np.repeat(np.arange(len(rows)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pc.take(part.column(0), at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pc.take(model.deviations(rows), at),
                        pa.array(model.whitened(rows).ravel()), pa.array(np.tile(model.eigenvalues / model.trace, len(rows))),
                    ],
                    names=["id", "component", "deviation", "whitened", "explained"],
                )

    made = x.mapInArrow(run, f"id {kind}, component int, deviation decimal(38,0), whitened double, explained double")
    return made.select("id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))
