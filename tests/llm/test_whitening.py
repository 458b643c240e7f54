import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tenure.llm import whitening
from tenure.llm.queries import op13_whitening
from tests.llm.helpers import SF


def brute(vectors, most=8):
    """Per (row, component): n, deviation, |whitened|, explained, from numpy's eigenvectors."""
    x = np.floor(1024 * np.array(vectors, float)).astype(int) + 100_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    e, w = np.linalg.eigh(y.T @ y / n)
    e, w = e[::-1], w[:, ::-1]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    return n, dev, (y @ w / np.sqrt(np.maximum(e, 1e-300)))[:, :most], e[:most] / e.sum()


def compare(rows, ids, vectors, most):
    n, dev, white, share = brute(vectors)
    assert len(rows) == len(ids) * most
    sign = {}
    for r in rows:
        i, c = ids.index(r.vec_id), r.component - 1
        assert r.n == n and r.deviation == dev[i]
        assert abs(r.explained - share[c]) <= 1e-9 * share[c]
        if abs(white[i, c]) > 1e-3:
            assert sign.setdefault(c, math.copysign(1, r.whitened * white[i, c])) == math.copysign(1, r.whitened * white[i, c])
        assert abs(abs(r.whitened) - abs(white[i, c])) < 1e-6
        assert 0 <= r.identity_error < 1e-8
    assert len({r.identity_error for r in rows}) == 1


def test_query(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    compare(op13_whitening(spark, SF).collect(), [r[0] for r in rows], [r[1] for r in rows], 8)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for c in ("vector", "i", "row", "n", "component", "d"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_defined_cases(spark):
    rnd = np.random.default_rng(5)
    good = rnd.normal(size=(30, 4)).astype(np.float32).tolist()
    bad = [None, [1.0, None, 0.0, 2.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], []]
    rows = [*enumerate(good), *((100 + i, v) for i, v in enumerate(bad))]
    compare(whitening.whitened(frame(spark, rows).repartition(3)).collect(), list(range(30)), good, 4)
    # repeated rows and a null id count like others
    twice = [(None if i == 3 else i, v) for i, v in enumerate(good + good[:5])]
    got = whitening.whitened(frame(spark, twice)).collect()
    assert len(got) == 35 * 4 and got[0].n == 35 and sum(r.vec_id is None for r in got) == 4
    assert whitening.whitened(frame(spark, [])).count() == 0
    assert whitening.whitened(frame(spark, [(1, None)])).count() == 0
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0])] * 5)).count() == 0


def test_dependent_dimensions_and_scales(spark):
    """Constant and repeated dimensions give no component; small ones beside large ones are right."""
    rnd = np.random.default_rng(6)
    a = rnd.normal(size=(200, 3)) * [3e3, 1, 0.01]
    v = np.c_[a[:, 0], np.full(200, 7.0), a[:, 1], a[:, 0], a[:, 2]].astype(np.float32)
    got = whitening.whitened(frame(spark, [(i, r) for i, r in enumerate(v.tolist())])).collect()
    assert {r.component for r in got} == {1, 2, 3}
    assert got[0].identity_error < 1e-6
    n, dev, _, share = brute(v.astype(float)[:, [0, 2, 4]])
    x = np.floor(1024 * v.astype(float)).astype(int)
    assert {r.vec_id: r.deviation for r in got} == {i: sum((n * int(p) - int(s)) ** 2 for p, s in zip(row, x.sum(axis=0), strict=True)) for i, row in enumerate(x)}


def test_solve():
    rnd = np.random.default_rng(7)
    r = np.triu(rnd.normal(size=(6, 6))) + 5 * np.eye(6)
    rows = rnd.normal(size=(9, 6))
    assert np.allclose(whitening.solve(rows, r) @ r, rows)


def test_large_deviations():
    x = np.array([[1 << 40, 0], [100_000, 5]])
    m = whitening.Whitening(2, tuple(x.sum(axis=0).tolist()), np.eye(2), np.ones(2), 1.0)
    exact = sum((2 * int(a) - s) ** 2 for a, s in zip(x[0], m.sums, strict=True))
    assert whitening.deviation(x, m) == [exact if exact < 1 << 63 else None] * 2
