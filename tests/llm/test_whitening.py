"""Whitening against plain arithmetic over all rows."""

import math
from fractions import Fraction

import numpy as np
import pytest

from rosterlens.llm import whitening as W
from rosterlens.llm.store import table


def _plain(rows, k=32):
    """{row number: (deviation, whitened)} of (vec_id, vector), eigenvalue shares."""
    x = np.asarray([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(0)
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    centred = np.asarray([[float(Fraction(n * a - b, n)) for a, b in zip(r, s, strict=True)] for r in x])
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, deviation, centred @ q / np.sqrt(e), e / np.trace(cov)


def _same(got, rows, k=32):
    n, deviation, white, shares = _plain(rows, k)
    assert {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    k = white.shape[1]
    for i, (vec, _) in enumerate(rows):
        assert sorted(by[vec]) == list(range(1, k + 1))
        assert {r.deviation for r in by[vec].values()} == {deviation[i]}
    found = np.asarray([[by[v][c + 1].whitened for c in range(k)] for v, _ in rows])
    signs = np.sign((found * white).sum(0))
    assert np.abs(found - white * signs).max() < 1e-6
    assert np.allclose([by[rows[0][0]][c + 1].explained for c in range(k)], shares, rtol=1e-9)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_all_rows_of_the_table(spark, data):
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in table(spark, data, "embeddings").collect()]
    _same(W.op13_whitening(spark, data).collect(), rows)


def test_copies_odd_rows_and_extra_columns(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 5))
    rows = [(i, base[i % 40 if i < 60 else 7].tolist()) for i in range(400)]
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan")] * 5), (903, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (904, []), (905, [1.0, 2.0])]
    made = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "'a' as x", "1 as f", "2 as z", "3 as n").repartition(5)
    got = W.whiten(made).collect()
    assert {r.vec_id for r in got} == set(range(400))
    _same(got, rows)
    once = W.whiten(made, weights="one").collect()
    distinct = {tuple(math.floor(64 * c) for c in v): v for _, v in rows}
    assert {r.n for r in once} == {len(distinct)}
    assert {r.identity_error < 1e-9 for r in once} == {True}
    ids = spark.createDataFrame([(None, [0.0, 1.0]), (3, [1.0, 0.0]), (3, [0.5, 0.25])], "vec_id int, embedding array<float>")
    assert sorted((r.vec_id is None, r.component) for r in W.whiten(ids).collect()) == [(False, 1)] * 2 + [(False, 2)] * 2 + [(True, 1), (True, 2)]


def test_without_variance_and_without_rows(spark):
    same = spark.createDataFrame([(1, [0.5, 0.0]), (2, [0.5, 0.0])], "vec_id long, embedding array<float>")
    rows = W.whiten(same).collect()
    assert len(rows) == 4
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {(0, None, None, None)}
    none = W.whiten(same.limit(0))
    assert none.collect() == [] and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_magnitudes(spark):
    rows = [(i, [float(i % 7), float(i * i % 11), 1e3 * (i % 3)]) for i in range(50)]
    _same(W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3).collect(), rows, 3)
    huge = spark.createDataFrame([*rows, (99, [1e300, -1e307, 1e-300])], "vec_id long, embedding array<double>")
    got = W.whiten(huge).collect()
    assert len(got) == 51 * 3 and {r.deviation is None for r in got if r.vec_id == 99} == {True}


def test_deviation_is_exact():
    y = np.asarray([[3, -5], [1 << 40, 7]], np.int64)
    for n, total in ((10, [4, -9]), (1 << 30, [5, 6]), (3, [1 << 41, 2])):
        want = [sum((n * int(v) - s) ** 2 for v, s in zip(r, total, strict=True)) for r in y]
        assert W.deviations(y, n, total) == [w if w < 1 << 63 else None for w in want]


@pytest.mark.parametrize("tasks", [1, 3, 70])
def test_tree_of_sums(spark, tasks):
    from rosterlens.llm.vectors import sum_matrices

    parts = [(t, i, np.asarray([t, i, 1.0]).tobytes()) for t in range(tasks) for i in range(2)]
    got = sum_matrices(spark.createDataFrame(parts, "node long, i int, row binary").repartition(6), tasks, 2, 3, fan=4)
    assert got.tolist() == [[sum(range(tasks)), i * tasks, tasks] for i in range(2)]
