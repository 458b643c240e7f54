"""Embedding whitening by shifted CholeskyQR.

The centred rows are never gathered. Each Gram pass solves the rows against the
triangular factors found so far and sums their products, so the driver sees
d x d numbers a pass; the first factor comes from a shifted Gram matrix, which
can't fail, and the next ones repair its loss of orthogonality. The singular
values and vectors of the factors' product are those of the centred rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import picked

#: Entries of an integer vector stay within plus or minus this (2 to the 52nd).
LARGEST = 1 << 52
#: Passes at most; three do for any full-rank table, the others only serve dependent dimensions.
PASSES = 5
#: Singular values below this share of the largest are rounding errors of dependent dimensions.
LEAST_SIGMA = 1e-11
ROUND = 2.0**-53


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: n rows, integer sums per dimension, unit components in
    rows by falling eigenvalue, and the trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once: whole parts are subtracted as integers."""
        return centre(x, self.n, self.sums)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.components.T) / np.sqrt(self.eigenvalues)


def centre(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n / n for s in sums])
    return (x - whole) - part


def usable(vector: Column) -> Column:
    """Whether a vector is there and holds finite entries only."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector`` (array of double) of the rows that ``usable`` accepts."""
    own = picked(table, vec_id=id_col, vector=vector_col)
    return own.withColumn("vector", F.col("vector").cast("array<double>")).filter(usable(F.col("vector")))


def integers(column: pa.Array, d: int) -> np.ndarray:
    """floor(1024 c) + 100000 of a column of d-vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.clip(np.floor(1024.0 * flat), -LARGEST, LARGEST).astype(np.int64) + 100_000


def solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q R = rows, for an upper triangle R, column by column."""
    q = np.empty_like(rows)
    for j in range(r.shape[0]):
        q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def summed(rows: DataFrame, shape: tuple[int, int], task) -> np.ndarray:
    """The sum over all tasks of ``task(batches)``, a matrix each, entry by entry on the executors."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = task(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist())], ["i", "row"])

    kind = "bigint" if shape[0] == 1 else "double"
    parts = rows.mapInArrow(part, f"i int, row array<{kind}>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros(shape, object if kind == "bigint" else np.float64)
    # a sum of longs as a decimal can't overflow
    for r in parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)") if kind == "bigint" else "v").alias("v")).collect():
        out[r["i"], r["j"]] = int(r["v"]) if kind == "bigint" else r["v"]
    return out


def gram(rows: DataFrame, d: int, of) -> np.ndarray:
    """The d x d Gram matrix of ``of(vectors)`` over all rows."""

    def task(batches):
        total = None
        for b in batches:
            if b.num_rows:
                q = of(b.column("vector"))
                total = q.T @ q if total is None else total + q.T @ q
        return total

    return summed(rows.select("vector"), (d, d), task)


def fit(rows: DataFrame, most: int = 8) -> tuple[DataFrame, Whitening | None]:
    """The rows of the commonest length (ties: the longer) and their whitening.

    None where no row or no variance is left. Components whose singular value is
    under ``LEAST_SIGMA`` of the largest are left out.
    """
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None or common["d"] == 0:
        return rows.limit(0), None
    d, n = common["d"], common["count"]
    rows = rows.filter(F.size("vector") == d)

    def add(batches):
        total = None
        for b in batches:
            if b.num_rows:
                s = integers(b.column("vector"), d).sum(axis=0, keepdims=True)
                total = s if total is None else total + s
        return total

    sums = tuple(summed(rows.select("vector"), (1, d), add)[0].tolist())
    factors: list[np.ndarray] = []
    trace = 0.0
    for k in range(PASSES):

        def orthogonal(column: pa.Array, factors=tuple(factors)) -> np.ndarray:
            q = centre(integers(column, d), n, sums)
            for r in factors:
                q = solve(q, r)
            return q

        g = gram(rows, d, orthogonal)
        if k == 0:
            trace = float(np.trace(g))
            if trace == 0:
                return rows, None
        w, u = np.linalg.eigh(g)
        if k > 0 and np.abs(w - 1).max() < 1e-12 * d or k == PASSES - 1:
            break
        shift = 11 * (n * d + d * (d + 1)) * ROUND * float(np.trace(g))
        if k > 0 and w[0] > 1e-3:
            shift = 0.0
        factors.append(np.linalg.cholesky(g + shift * np.eye(d)).T)
    # the last Gram matrix is nearly the identity; its root closes the product in any case
    r = np.sqrt(np.maximum(w, 0))[:, None] * u.T
    for f in reversed(factors):
        r = r @ f
    _, sigma, components = np.linalg.svd(r)
    take = min(most, int((sigma > LEAST_SIGMA * sigma[0]).sum()))
    return rows, Whitening(n, sums, components[:take], sigma[:take] ** 2 / n, trace / n)


def deviation(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; null beyond 64 bits."""
    n = model.n
    whole = np.array([s // n for s in model.sums], np.int64)
    rest = np.array([s % n for s in model.sums], object)
    off = x - whole
    if (float(np.abs(off).max(initial=0)) + 1) * n < 2**31 / len(whole) ** 0.5:
        return ((off * n - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((off.astype(object) * n - rest) ** 2).sum(axis=1).tolist()
    return [v if v < 1 << 63 else None for v in exact]


def whitened(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 8) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for
    each remaining row and each of the first ``most`` components.

    Defined cases: a null vector, or one with a null or non-finite entry, is
    dropped, and so are vectors of another length than the commonest (ties: the
    longer). Entries beyond 2 to the 52nd after scaling count as that. Null,
    repeated and extra ids and rows are kept as they are; other columns are
    ignored. No rows, or rows without variance: no rows. Fewer independent
    dimensions than ``most``: fewer components. A deviation beyond 64 bits is
    null.

    Scale: every pass reads the one column and shuffles d x d sums per task; no
    row is shuffled, cached or collected, and a lost task is read again.
    """
    kind = picked(table, vec_id=id_col).schema["vec_id"].dataType
    shape = f"vec_id {kind.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double"
    rows, model = fit(vectors(table, id_col, vector_col), most)
    if model is None:
        return table.sparkSession.createDataFrame([], shape + ", identity_error double")
    d, k = len(model.sums), len(model.components)
    cov = gram(rows, k, lambda column: model.whiten(integers(column, d))) / model.n
    error = float(np.abs(cov - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = model.eigenvalues / model.trace
        for b in batches:
            x = integers(b.column("vector"), d)
            m, each = len(x), np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array(deviation(x, model), pa.int64()).take(pa.array(each)),
                    pa.array(model.whiten(x).ravel()),
                    pa.array(np.tile(share, m)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained"],
            )

    return rows.mapInArrow(project, shape).withColumn("identity_error", F.lit(error))
