"""Whitening against numpy and exact fractions."""

from fractions import Fraction

import numpy as np
import pytest

from takerlens.llm import op12_whitening as op
from tests.llm.conftest import FOLDER, needs_tables

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, whitened string"


def table(spark, vectors, ids=None, files=3):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, "c", "n", "w") for i, v in zip(ids, vectors)], SCHEMA).repartition(files)


def whole(vectors):
    return [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]


def check(spark, vectors, got, components=32):
    x = np.array(whole(vectors), dtype=object)
    n, sums = len(x), x.sum(0)
    deviation = [int(((n * row - sums) ** 2).sum()) for row in x]
    centred = np.array([[float(Fraction(int(n * c - s), n)) for c, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    rows = {}
    for r in got:
        rows.setdefault(r.vec_id, {})[r.component] = r
    k = min(components, x.shape[1])
    for i in range(n):
        mine = [rows[i][c] for c in range(1, k + 1)]
        assert {(r.n, r.deviation) for r in mine} == {(n, deviation[i])}
        assert np.allclose([r.explained for r in mine], np.maximum(e[:k], 0) / v.trace(), rtol=1e-9, atol=1e-12)
    z = np.array([[rows[i][c].whitened for c in range(1, k + 1)] for i in range(n)])
    live = e[:k] / v.trace() > op.FLAT
    plain = centred @ w[:, :k][:, live] / np.sqrt(e[:k][live])
    sign = np.sign((z[:, live] * plain).sum(0))
    gap = np.abs(np.diff(e, append=-1)) / e[0] > 1e-6  # eigenvectors of equal values are not unique
    unique = (gap & np.roll(gap, 1))[:k][live]
    assert np.allclose((z[:, live] * sign)[:, unique], plain[:, unique], atol=1e-8)
    assert not z[:, ~live].any()
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    return z


def test_equal_to_numpy(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(300, 8)) @ np.diag([5, 3, 2, 1, .5, .3, .2, .1]) + 1).round(3).tolist()
    got = op.whiten(table(spark, vectors))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    z = check(spark, vectors, got.collect())
    assert np.allclose(z.T @ z / 300, np.eye(8), atol=1e-9)
    check(spark, vectors, op.whiten(table(spark, vectors), components=3).collect(), 3)


def test_rows_that_are_dropped_and_rows_that_stay(spark):
    good = [[0.5, 1.0], [2.0, -1.0], [2.0, -1.0], [0.25, 7.0]]
    odd = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0], [1.0, 2.0, 3.0]]
    rows = op.whiten(table(spark, good + odd, [0, 1, 1, None, *range(10, 17)])).collect()
    assert sorted(((r.vec_id, r.component) for r in rows), key=str) == sorted(
        [(i, c) for i in (0, 1, 1, None) for c in (1, 2)], key=str)
    assert {r.n for r in rows} == {4}
    assert op.whiten(table(spark, odd[:5])).count() == 0 and op.whiten(table(spark, good).limit(0)).count() == 0


def test_vectors_without_variance(spark):
    rows = op.whiten(table(spark, [[1.0, 2.0, 3.0]] * 3)).collect()
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {(0, 0.0, 0.0, 0.0)} and len(rows) == 9
    # Fewer vectors than dimensions: the components without variance stay 0.
    check(spark, vectors := [[1.0, 2.0, 3.0, 0.0], [2.0, 5.0, 1.0, 0.0], [0.0, 0.5, 9.0, 0.0]], op.whiten(table(spark, vectors)).collect())


def test_the_offset_loses_nothing(spark):
    """Tiny spreads far from 0 and wide spreads: sums of squares beyond 64 bits stay exact."""
    rng = np.random.default_rng(2)
    far = (rng.integers(0, 3, (50, 3)) / 64 + 3000).tolist()
    check(spark, far, op.whiten(table(spark, far)).collect())
    wide = (rng.integers(-2**18, 2**18, (40, 3)) * 1.0).tolist()
    check(spark, wide, op.whiten(table(spark, wide)).collect())
    with pytest.raises(Exception, match="64 bits"):
        huge = [[float(2**45 + i * 2**40), 0.0] for i in range(3)]
        op.whiten(table(spark, huge)).collect()


def test_exact_sums():
    rows = np.array([[2**61, 3], [2**61, -4], [-2**60, 5]])
    assert op.exact_sums(rows) == [2**61 + 2**61 - 2**60, 4]
    assert op.exact_squares(rows) == [2 * 2**122 + 2**120, 50]
    assert op.exact_squares(np.array([[2**30]] * 9)) == [9 * 2**60] and op.exact_squares(np.empty((0, 2), np.int64)) == [0, 0]


@needs_tables
def test_registered_query(spark):
    stored = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    got = op.op12_polarised_whitening(spark, FOLDER).collect()
    assert len(got) == 32 * len(stored)
    check(spark, [r.embedding for r in stored], [r for r in got])
