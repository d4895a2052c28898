"""Embedding whitening by mixed-precision eigenvectors.

Three passes over the vectors, each summing inside the tasks:

1. rows and sums by dimension (integers stay exact);
2. the covariance, centred before multiplying, in float64.  A task sends its
   upper triangle once; Spark adds the triangles cell by cell;
3. the projection on the leading components, over the root of their eigenvalue.

Only the sums and the covariance, whose size is set by the dimension and not
by the rows, reach the driver.  There float32 gives the first eigenvectors, and
Ogita-Aishima iterations (four matrix products each) correct them in float64:
with R = I - X'X and S = X'VX the correction of pair (i, j) is
(S_ij + l_j R_ij) / (l_j - l_i) where the eigenvalues are apart, and R_ij / 2
where they aren't.  Eigenvalues that a round can't tell apart form a cluster;
V minus the cluster's mean is projected on the cluster's vectors, solved by
itself, and the vectors are turned by the result.

Defined cases: null vectors, vectors with null or non-finite entries and
empty ones are left out, and of several lengths only the commonest stays
(ties: the longest); repeated rows and ids each count; components whose
eigenvalue is zero to double precision have whitened entries null; an empty
table gives a model without components and empty results; other columns pass
through, but for one named like the output, which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, prepare_python

ROUNDS = 40
EPS = float(np.finfo(np.float64).eps)
ROOT = EPS ** 0.5


def finite(vector: Column) -> Column:
    """True where a vector has entries and all of them are finite numbers."""
    inf = float("inf")
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < inf))
    return F.coalesce((F.size(vector) > 0) & good, F.lit(False))


def usable(df: DataFrame, vector_col: str) -> DataFrame:
    """The rows of ``df`` that count: finite vectors of the commonest length."""
    df = df.where(finite(F.col(vector_col)))
    lengths = df.groupBy(F.size(vector_col).alias("d")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return df.where(F.size(vector_col) == (top[0]["d"] if top else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of one length as rows of a matrix, in its own number type."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _added(df: DataFrame, partials, kind: str) -> dict[int, int | float]:
    """Cell by cell sums of the arrays that the tasks send."""
    rows = df.mapInArrow(partials, f"cells array<{kind}>").select(F.posexplode("cells").alias("i", "v"))
    wide = "decimal(38,0)" if kind == "bigint" else "double"
    plain = int if kind == "bigint" else float
    return {r["i"]: plain(r["s"]) for r in rows.groupBy("i").agg(F.sum(F.col("v").cast(wide)).alias("s")).collect()}


def moments(df: DataFrame, vector_col: str) -> tuple[int, list]:
    """Rows and sums by dimension; exact for vectors of integers."""
    prepare_python(df.sparkSession)
    whole = dict(df.dtypes)[vector_col] in ("array<bigint>", "array<int>", "array<smallint>")

    def partials(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column(0)).astype(np.int64 if whole else np.float64)
                part = np.append(m.sum(axis=0), len(m))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total])], ["cells"])

    sums = _added(df.select(vector_col), partials, "bigint" if whole else "double")
    ordered = [sums[i] for i in sorted(sums)]
    return (int(ordered[-1]), ordered[:-1]) if ordered else (0, [])


def covariance(df: DataFrame, vector_col: str, n: int, mean: np.ndarray) -> np.ndarray:
    """The vectors' covariance (divisor ``n``), centred on ``mean`` before multiplying."""
    prepare_python(df.sparkSession)
    d = len(mean)
    upper = np.triu_indices(d)

    def partials(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                c = _matrix(b.column(0)).astype(np.float64) - mean
                total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total[upper]])], ["cells"])

    cells = _added(df.select(vector_col), partials, "double")
    out = np.zeros((d, d))
    out[upper] = [cells.get(i, 0.0) / max(n, 1) for i in range(len(upper[0]))]
    return out + np.triu(out, 1).T


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    d, scale = len(matrix), float(np.abs(matrix).max(initial=0.0))
    if not scale:
        return np.zeros(d), np.eye(d)
    a = matrix / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    size, least = np.linalg.norm(a, 2), np.inf
    for _ in range(ROUNDS):
        r, s = np.eye(d) - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        # under the root of the precision, rounding errors over a gap would turn vectors at random; sub-solves take those pairs
        delta = max(2 * (np.linalg.norm(s - np.diag(values), 2) + size * np.linalg.norm(r, 2)), ROOT * size)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > delta
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        for group in _clusters(values, delta):
            own = x[:, group]
            rest = own.T @ ((a - values[group].mean() * np.eye(d)) @ own)
            x[:, group] = own @ np.linalg.eigh((rest + rest.T) / 2)[1]
        change = np.linalg.norm(e, 2)
        if change <= d * EPS or change >= least / 2 and change < 10 * ROOT:
            break
        least = min(least, change)
    x = x @ (3 * np.eye(d) - x.T @ x) / 2  # what the last turn left of R, squared
    x = x / np.linalg.norm(x, axis=0)
    values = np.einsum("ij,ij->j", x, a @ x) * scale
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    return values[order], x * np.where(x[np.abs(x).argmax(axis=0), np.arange(d)] < 0, -1, 1)


def _clusters(values: np.ndarray, delta: float) -> list[np.ndarray]:
    """Index groups of two and more eigenvalues whose neighbours are at most ``delta`` away."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > delta) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], dtype=np.float64)

    def sound(self, k: int) -> np.ndarray:
        """Which of the first ``k`` components have an eigenvalue above rounding errors."""
        top = self.values[:k]
        return top > len(self.values) * EPS * max(self.values.max(initial=0.0), 0.0)


def fit(df: DataFrame, vector_col: str) -> Whitening:
    """The whitening of ``usable`` rows, from all of them."""
    n, sums = moments(df, vector_col)
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    mean = np.array([s / n for s in sums], dtype=np.float64)
    cov = covariance(df, vector_col, n, mean)
    values, vectors = eigen(cov)
    return Whitening(n, sums, values, vectors, float(np.trace(cov)))


def whiten(df: DataFrame, model: Whitening, vector_col: str, k: int, out_col: str = "whitened") -> DataFrame:
    """``df`` with the ``k`` leading whitened components of each ``usable`` row as ``out_col``."""
    prepare_python(df.sparkSession)
    df = fresh(df, [out_col], [vector_col])
    k = min(k, len(model.values))
    sound, mean = model.sound(k), model.mean
    weights = np.where(sound, model.vectors[:, :k] / np.sqrt(np.where(sound, model.values[:k], 1)), 0)
    at = df.columns.index(vector_col)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                got = (_matrix(b.column(at)).astype(np.float64) - mean) @ weights
                flat = pa.array(got.ravel(), mask=np.tile(~sound, len(got)))
                ends = pa.array(np.arange(0, got.size + 1, max(k, 1), dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, flat)], [*b.schema.names, out_col])

    empty = df.withColumn(out_col, F.array().cast("array<double>")).limit(0)
    return df.mapInArrow(project, empty.schema) if k else empty  # no components: no rows


def identity_error(whitened: DataFrame, model: Whitening, k: int, out_col: str = "whitened") -> float | None:
    """The largest entry of the whitened vectors' own covariance minus the identity; null components aside."""
    sound = np.flatnonzero(model.sound(k))
    if not len(sound):
        return None
    kept = whitened.select(F.array(*[F.get(out_col, int(i)) for i in sound]).alias("w"))
    n, sums = moments(kept, "w")
    return float(np.abs(covariance(kept, "w", n, np.array(sums) / n) - np.eye(len(sound))).max())
