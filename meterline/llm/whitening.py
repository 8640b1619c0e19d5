"""Operator 11: whitening of embeddings by their leading principal components.

Spark reduces the vectors twice: exact sums per dimension (integers), then the covariance of the
centred vectors, of which each task adds up one matrix and Spark sums these by cell. What reaches
the driver is a matrix of dimension x dimension, whatever the number of rows. There it is
reduced to tridiagonal form by Householder reflections; Sturm counts and bisection give the
leading eigenvalues, inverse iteration their vectors, orthogonalised anew within clusters of
close eigenvalues. The projection goes to the tasks with their code, k x dimension numbers. A
last reduction takes the covariance of the whitened vectors.

Entries are scaled to integers first, x = floor(``SCALE`` * c) + ``SHIFT``, so that sums and
deviations are exact.

Nulls and edge cases: rows whose vector is null, empty, or holds null or non-finite entries go;
so do rows with entries too large for whole doubles, and those whose length is not the most
frequent one (of equally frequent ones the longest stays). A null vec_id is kept as it is;
repeated rows count each time and are all returned. Components whose eigenvalue is lost in
rounding (rank-deficient vectors, one row, equal rows) are left out, so there may be fewer than
``k``, or none and no rows. A deviation beyond 64 bits is null. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.registry import query, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Scaled entries must stay below this, where every whole number is a double.
LARGEST = 2.0**53
#: Eigenvalues below this share of the largest are rounding.
NEGLIGIBLE = 1e-11
#: Eigenvalues closer than this share of the matrix's norm belong to one cluster.
CLUSTER = 1e-3
#: Sums are kept in two halves, of which the lower has so many bits.
HALF = 26

EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Model:
    """Count and exact sums of the fit list, its total variance, and its leading components."""

    n: int
    sums: tuple[int, ...]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray  # a row per component

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T


# --- Spark: reductions over all vectors ---------------------------------------------------


def scaled(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, x): the usable rows with their scaled integer vectors, all of one length."""
    c = F.transform(column, lambda v: v.cast("double"))
    fits = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST / SCALE / 2))
    rows = vectors.select(F.col(id_column).alias("id"), c.alias("c")).filter((F.size("c") > 0) & fits)
    lengths = rows.groupBy(F.size("c").alias("d")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("c") == (usual["d"] if usual else 0))
    return rows.select("id", F.transform("c", lambda v: F.floor(v * SCALE) + SHIFT).alias("x"))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """The vectors of a batch as rows of a matrix."""
    lists = batch.column(batch.schema.get_field_index(column))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def sums_of(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """How many vectors, and their exact sum in each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, "x")
                d = x.shape[1]
                low = x & ((1 << HALF) - 1)
                cells = [np.arange(d), np.full(d, len(x)), (x >> HALF).sum(axis=0), low.sum(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], ["i", "n", "high", "low"])

    wide = "decimal(38,0)"
    total = (
        rows.select("x")
        .mapInArrow(add, "i long, n long, high long, low long")
        .groupBy("i")
        .agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast(wide)).cast(wide).alias(c) for c in ("high", "low")))
        .orderBy("i")
        .collect()
    )
    sums = tuple((int(r["high"]) << HALF) + int(r["low"]) for r in total)
    return (total[0]["n"] if total else 0), sums


def covariance(rows: DataFrame, d: int, n: int, centred) -> np.ndarray:
    """Mean product of every two entries of ``centred(x)``, over all ``n`` rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                y = centred(_matrix(batch, "x"))
                products += y.T @ y
        i, j = np.triu_indices(d)
        cells = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(products[i, j])]
        yield pa.RecordBatch.from_arrays(cells, ["i", "j", "v"])

    cells = rows.select("x").mapInArrow(add, "i int, j int, v double")
    found = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (found.column(c).to_numpy() for c in ("i", "j", "v"))
    out = np.zeros((d, d))
    out[i, j] = out[j, i] = v / n
    return out


def fit(rows: DataFrame, k: int = COMPONENTS) -> Model:
    """The model of all ``rows`` (x), as ``scaled`` gives them."""
    n, sums = sums_of(rows)
    d = len(sums)
    if not n:
        return Model(0, (), 0.0, np.zeros(0), np.zeros((0, 0)))
    mean = np.array([s / n for s in sums])
    v = covariance(rows, d, n, lambda x: x - mean)
    values, vectors = leading_eigenpairs(v, min(k, d))
    real = values > NEGLIGIBLE * max(values[0], 0.0)
    return Model(n, sums, float(np.trace(v)), values[real], vectors[real])


def identity_error(rows: DataFrame, model: Model) -> float:
    """Largest entry, without sign, of the whitened vectors' covariance minus the identity."""
    k = len(model.eigenvalues)
    found = covariance(rows, k, model.n, model.project)
    return float(np.abs(found - np.eye(k)).max())


def whiten(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (id, x) as (id, deviation, whitened): a vector of a number per component."""
    n, sums = model.n, model.sums
    top = np.array([float(s) for s in sums])
    exact = np.array(sums, dtype=np.int64) if all(abs(s) < 1 << 62 for s in sums) else None

    def deviations(x: np.ndarray) -> list:
        rough = (np.abs(x.astype(float) * n) + np.abs(top)).max(axis=1)
        small = (rough < 2.0**62) & ((((x.astype(float) * n) - top) ** 2).sum(axis=1) < 2.0**62)
        if exact is not None and small.all():
            return ((x * n - exact) ** 2).sum(axis=1).tolist()
        out = [sum((v * n - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, "x")
                w = model.project(x)
                ends = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(w.ravel()))
                cells = [batch.column(0), pa.array(deviations(x), pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(cells, ["id", "deviation", "whitened"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "x").mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


# --- Driver: the leading eigenpairs of one small symmetric matrix --------------------------


def leading_eigenpairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and a unit vector for each."""
    diagonal, beside, reflectors = tridiagonal(v)
    values = largest_eigenvalues(diagonal, beside, k)
    vectors = eigenvectors(diagonal, beside, values)
    for at, u in reversed(reflectors):
        vectors[:, at:] -= 2.0 * np.outer(vectors[:, at:] @ u, u)
    # One step of orthogonalisation and scaling takes off what the way back has rounded.
    for i in range(k):
        vectors[i] -= (vectors[:i] @ vectors[i]) @ vectors[:i]
        vectors[i] /= np.linalg.norm(vectors[i])
    return values, vectors


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Householder reduction: diagonal, entries beside it, and (first index, unit vector) of each
    reflection I - 2uu' in the order of their application."""
    a = np.array(v, dtype=float)
    d, reflectors = len(a), []
    for i in range(d - 2):
        column = a[i + 1 :, i]
        length = float(np.linalg.norm(column))
        if np.abs(column[1:]).max() <= EPS * EPS * length:
            continue
        u = column.copy()
        u[0] += np.copysign(length, u[0])
        u /= np.linalg.norm(u)
        rest = a[i + 1 :, i + 1 :]
        p = rest @ u
        w = 2.0 * (p - (u @ p) * u)
        rest -= np.outer(u, w) + np.outer(w, u)
        a[i + 1, i] = a[i, i + 1] = -np.copysign(length, column[0])
        a[i + 2 :, i] = a[i, i + 2 :] = 0.0
        reflectors.append((i + 1, u))
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflectors


def below(diagonal: np.ndarray, beside: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each number of ``x``."""
    tiny = max(float(np.abs(beside).max(initial=0.0)), float(np.abs(diagonal).max()), 1e-250) * EPS * EPS
    count, q = np.zeros(len(x), dtype=int), np.ones(len(x))
    for i, entry in enumerate(diagonal):
        q = entry - x - (beside[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def largest_eigenvalues(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """Bisection between Gershgorin's bounds, for ``k`` eigenvalues at once."""
    d = len(diagonal)
    around = np.abs(np.append(beside, 0.0)) + np.abs(np.append(0.0, beside))
    margin = EPS * (np.abs(diagonal) + around).max() * d + 1e-300
    low = np.full(k, (diagonal - around).min() - margin)
    high = np.full(k, (diagonal + around).max() + margin)
    rank = d - 1 - np.arange(k)  # this many eigenvalues are smaller
    for _ in range(200):
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high)).any():
            break
        larger = below(diagonal, beside, middle) > rank
        low, high = np.where(larger, low, middle), np.where(larger, middle, high)
    return low + (high - low) / 2


def eigenvectors(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Inverse iteration; within a cluster each vector is kept orthogonal to those before."""
    d = len(diagonal)
    norm = float((np.abs(diagonal) + np.abs(np.append(beside, 0)) + np.abs(np.append(0, beside))).max()) or 1.0
    start = np.random.default_rng(11)
    out = np.zeros((len(values), d))
    first, shift = 0, np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * norm:
            first = i
        # Equal eigenvalues are solved for at distinct shifts.
        shift = min(float(value), shift - 10 * EPS * norm) if i > first else float(value)
        factors = factored(diagonal - shift, beside, EPS * norm)
        z = start.standard_normal(d)
        for _ in range(5):
            z = solved(factors, z / np.linalg.norm(z))
            z /= np.abs(z).max()
            for _ in range(2):
                z -= out[first:i].T @ (out[first:i] @ z)
        out[i] = z / np.linalg.norm(z)
    return out


def factored(diagonal: np.ndarray, beside: np.ndarray, tiny: float) -> tuple:
    """Gaussian elimination of a tridiagonal matrix, with rows exchanged for the larger pivot."""
    d = len(diagonal)
    pivot, over, over2 = diagonal.tolist(), [*beside.tolist(), 0.0], [0.0] * d
    under, steps = beside.tolist(), []
    for i in range(d - 1):
        exchange = abs(under[i]) > abs(pivot[i])
        if exchange:
            pivot[i], under[i] = under[i], pivot[i]
            over[i], pivot[i + 1] = pivot[i + 1], over[i]
            if i + 2 < d:
                over2[i], over[i + 1] = over[i + 1], 0.0
        if pivot[i] == 0.0:
            pivot[i] = tiny
        factor = under[i] / pivot[i]
        pivot[i + 1] -= factor * over[i]
        over[i + 1] -= factor * over2[i]
        steps.append((exchange, factor))
    pivot = [p if abs(p) > tiny else (tiny if p >= 0 else -tiny) for p in pivot]
    return pivot, over, over2, steps


def solved(factors: tuple, b: np.ndarray) -> np.ndarray:
    pivot, over, over2, steps = factors
    z = b.tolist()
    for i, (exchange, factor) in enumerate(steps):
        if exchange:
            z[i], z[i + 1] = z[i + 1], z[i]
        z[i + 1] -= factor * z[i]
    for i in range(len(z) - 1, -1, -1):
        above = (over[i] * z[i + 1] if i + 1 < len(z) else 0.0) + (over2[i] * z[i + 2] if i + 2 < len(z) else 0.0)
        z[i] = (z[i] - above) / pivot[i]
    return np.array(z)


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their leading components, a row per vector and component."""
    rows = scaled(table(spark, sf_dir, "embeddings"))
    model = fit(rows)
    found = whiten(rows, model) if len(model.eigenvalues) else rows.limit(0).selectExpr(
        "id", "0L AS deviation", "array(0D) AS whitened"
    )
    error = identity_error(rows, model) if len(model.eigenvalues) else 0.0
    explained = F.array(*(F.lit(float(e)) for e in model.explained)) if len(model.eigenvalues) else F.array(F.lit(0.0))
    return found.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
