"""Whitening against eigenvectors of the covariance in plain numpy."""

import math
from collections import defaultdict

import numpy as np
import pytest

from longrec.llm import bidiagonal, queries, whitening

SF = "/root/testdata/sf0.01"


def brute(rows, most):
    """{(id, component): (n, deviation, whitened up to sign, explained)} by exact whole numbers and LAPACK."""
    def clean(v):
        return v is not None and all(c is not None and math.isfinite(c) for c in v)

    x = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if clean(v)]
    fit = sorted({v for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in fit])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    result = defaultdict(list)
    for i, own in x:
        scaled = [n * c - s for c, s in zip(own, sums, strict=True)]
        w = (np.array([c / n for c in scaled]) @ v[:, :most]) / np.sqrt(e[:most])
        for k in range(most):
            result[i, k + 1].append((n, sum(c * c for c in scaled), w[k], e[k] / e.sum()))
    return result


def check(got, rows, most):
    wanted, found, signs = brute(rows, most), defaultdict(list), {}
    for r in got:
        found[r.vec_id, r.component].append(r)
        assert r.identity_error < 1e-10
    assert {k: len(v) for k, v in found.items()} == {k: len(v) for k, v in wanted.items()}
    for key, own in wanted.items():
        for a, b in zip(sorted(found[key], key=lambda r: r.deviation), sorted(own, key=lambda r: r[1]), strict=True):
            assert (a.n, a.deviation) == b[:2] and a.explained == pytest.approx(b[3], rel=1e-10)
            assert abs(a.whitened) == pytest.approx(abs(b[2]), abs=1e-7)
            if abs(b[2]) > 1e-3:
                assert signs.setdefault(key[1], np.sign(a.whitened * b[2])) == np.sign(a.whitened * b[2])


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(queries.QUERIES["op12_embedding_whitening"](spark, SF).collect(), rows, 4)


def odd_rows(seed=3, n=60, dim=5):
    rng = np.random.default_rng(seed)
    rows = [(k % 50, (rng.normal(size=dim) * 10.0 ** -np.arange(dim)).tolist()) for k in range(n)]
    rows += [(None, rows[0][1]), (1, rows[0][1]), (2, rows[0][1]), (100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [1.0, float("nan"), 0.0, 0.0, 0.0])]
    return [*rows, (103, [float("-inf"), 0.0, 0.0, 0.0, 0.0])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<double>, whitened double, n string")


def test_rows_that_do_not_count(spark):
    rows = odd_rows()
    more = [(200, []), (201, [1.0, 2.0]), (202, [1e300, 0.0, 0.0, 0.0, 0.0])]
    df = frame(spark, rows + more).repartition(37)
    check(whitening.whitened_rows(df, whitening.fit(df, components=3)).collect(), rows, 3)


def test_sums_beyond_longs(spark):
    rows = [(k, [float(1 << 52) * (k % 7), float(1 << 40) * k]) for k in range(20)]
    df = frame(spark, rows)
    got = whitening.whitened_rows(df, whitening.fit(df)).collect()
    assert len(got) == 40 and {r.deviation for r in got} == {None} and all(math.isfinite(r.whitened) for r in got)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])] * 3, [(1, None)], [(1, [])]])
def test_without_variance(spark, rows):
    df = frame(spark, rows)
    assert whitening.whitened_rows(df, whitening.fit(df)).count() == 0


def matrices():
    rng = np.random.default_rng(1)
    turn = [np.linalg.qr(rng.normal(size=(24, 24)))[0] for _ in range(2)]
    yield "normal", rng.normal(size=(40, 40))
    yield "clusters", turn[0] * np.repeat([5, 5, 1, 1e-3], 6) @ turn[1]
    yield "rotation", turn[0] * 3
    yield "low rank", rng.normal(size=(30, 4)) @ rng.normal(size=(4, 30))
    yield "graded", np.diag(10.0 ** -np.arange(20)) @ rng.normal(size=(20, 20))
    yield "zeros", np.diag([3.0, 3, 0, 2, 0])
    yield "near", np.eye(21) + np.diag(np.ones(20), 1)
    for k in range(60):
        n = int(rng.integers(1, 10))
        yield f"small {k}", rng.integers(-2, 3, (n, n)).astype(float)


@pytest.mark.parametrize(("name", "matrix"), list(matrices()))
def test_singular_values(name, matrix):
    squares, vectors = bidiagonal.singular(matrix)
    wanted = np.linalg.svd(matrix, compute_uv=False)
    assert np.abs(np.sqrt(np.maximum(squares, 0)) - wanted).max() <= 1e-13 * max(wanted.max(), 1)
    assert np.abs(vectors.T @ vectors - np.eye(len(matrix))).max() < 1e-11
    assert np.abs(matrix.T @ (matrix @ vectors) - vectors * squares).max() < 1e-12 * max(wanted.max(), 1) ** 2


def test_small_values_keep_their_digits():
    """A bidiagonal matrix determines even its least singular values to full precision."""
    a, b = 10.0 ** -np.arange(12), 0.5 * 10.0 ** -np.arange(11)
    product = float(np.prod(bidiagonal.eigenvalues(a, b)))
    assert product == pytest.approx(float(np.prod(a)) ** 2, rel=1e-12)
