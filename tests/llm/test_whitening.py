"""Whitening against numpy's own eigenvalues, and exact sums against Python's integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from meterline.llm import whitening
from meterline.llm.queries import QUERIES


@pytest.fixture()
def embeddings(spark, folder):
    def write(rows, partitions=3):
        schema = "vec_id long, embedding array<float>, label int, x string, id string, n long, whitened double"
        full = [(i, v, 1, "x", "i", 3, 0.5) for i, v in rows]
        spark.createDataFrame(full, schema).repartition(partitions).write.parquet(f"{folder}/embeddings.parquet")
        return QUERIES["op11_whitening"](spark, folder).collect()

    return write


def judged(rows, found, k=8):
    """Every column of ``found`` against numpy and Python's integers."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(column) for column in zip(*x, strict=True)]
    centred = np.array([[a - s / n for a, s in zip(v, sums, strict=True)] for v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > 1e-11 * values[0]).sum()))
    assert len(found) == n * k
    by = {(r["vec_id"], r["component"]): r for r in found}
    for c in range(1, k + 1):
        expected = centred @ vectors[:, c - 1] / math.sqrt(values[c - 1])
        got = np.array([by[i, c]["whitened"] for i, _ in rows])
        sign = np.sign(got @ expected)
        assert np.abs(got * sign - expected).max() < 1e-8
        assert abs(by[rows[0][0], c]["explained"] / (values[c - 1] / values.sum()) - 1) < 1e-9
    for (i, _), v in zip(rows, x, strict=True):
        assert by[i, 1]["deviation"] == sum((n * v[j] - sums[j]) ** 2 for j in range(d))
        assert by[i, 1]["n"] == n
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]}
    assert found[0]["identity_error"] < 1e-9


def test_random_vectors(embeddings):
    rng = np.random.default_rng(3)
    mix = rng.standard_normal((24, 24)) * np.linspace(3, 0.1, 24)
    rows = [(i, v.astype("float32").tolist()) for i, v in enumerate(rng.standard_normal((300, 24)) @ mix)]
    judged(rows, embeddings(rows))


def test_rank_deficient_vectors_have_fewer_components(embeddings):
    rng = np.random.default_rng(4)
    flat = np.zeros((50, 6))
    flat[:, 2] = rng.integers(-50, 50, 50)
    flat[:, 4] = rng.integers(-9, 9, 50)
    rows = [(i, v.tolist()) for i, v in enumerate(flat)]
    found = embeddings(rows)
    judged(rows, found)
    assert max(r["component"] for r in found) == 2


def test_unusable_rows_go(embeddings):
    good = [(i, [float(i % 7), float(i % 3), float(i * i % 11)]) for i in range(40)]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [float("nan"), 0.0, 0.0])]
    bad += [(54, [float("inf"), 0.0, 0.0]), (55, [1.0, 2.0]), (56, [3e38, 0.0, 0.0])]
    judged(good, embeddings(good + bad))


def test_null_ids_and_repeated_rows_stay(embeddings):
    rows = [(None, [1.0, 2.0])] * 20 + [(7, [3.0, -1.0])] * 20
    found = embeddings(rows)
    assert len(found) == 40 and {r["component"] for r in found} == {1}
    assert {round(abs(r["whitened"]), 9) for r in found} == {1.0}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [2.0, 3.0])], [(i, [2.0, 3.0]) for i in range(9)]])
def test_nothing_to_whiten(embeddings, rows):
    assert embeddings(rows) == []


def test_whole_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    judged(rows, QUERIES["op11_whitening"](spark, sf_dir).collect())


@pytest.mark.parametrize(
    "values",
    [
        [5.0, 5.0, 5.0, 2.0, 2.0, 1.0],
        [1.0] * 12,
        [1e12, 1e12 * (1 - 1e-9), 1e6, 1e6, 1.0, 0.0],
        [3.0],
        [4.0, 4.0 - 1e-7, 4.0 - 2e-7, 4.0 - 3e-7, 1.0],
    ],
)
def test_clusters_of_eigenvalues(values):
    rng = np.random.default_rng(5)
    basis = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    v = basis * np.array(values) @ basis.T
    v = (v + v.T) / 2
    k = min(8, len(values))
    found, vectors = whitening.leading_eigenpairs(v, k)
    size = max(values)
    assert np.abs(found - np.sort(values)[::-1][:k]).max() <= 1e-13 * size
    assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-13
    assert np.abs(vectors @ v - found[:, None] * vectors).max() < 1e-13 * size


def test_sturm_counts():
    diagonal, beside = np.array([2.0, -1.0, 3.0, 0.5]), np.array([1.0, 0.0, 2.0])
    exact = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1))
    x = np.linspace(-4, 6, 41) + 1e-3
    assert whitening.below(diagonal, beside, x).tolist() == [int((exact < v).sum()) for v in x]


def test_deviation_beyond_64_bits_is_null(spark):
    rows = spark.createDataFrame([(i, [2.0e12 * i, 1.0]) for i in range(3)], "vec_id long, embedding array<double>")
    x = whitening.scaled(rows)
    found = whitening.whiten(x, whitening.fit(x)).orderBy("id").collect()
    assert [r["deviation"] for r in found] == [None, 0, None]
