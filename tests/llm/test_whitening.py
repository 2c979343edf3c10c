from math import inf, nan

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barograph.llm import whitening
from barograph.llm.vectors import integer_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, whitened string, deviation string, n int, i int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "w", "d", 1, 2) for i, v in rows], SCHEMA)


def vectors(seed, count, size=6, spread=1.0):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(0, 0.3, (count, size)) @ rng.normal(0, spread, (size, size)) + rng.normal(0, 2, size)
    return [[float(np.float32(v)) for v in row] for row in mixed]


def integers(rows):
    return np.floor(1024 * np.array(rows, np.float64)).astype(np.int64) + whitening.SHIFT


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5).flatmap(lambda d: st.lists(
    st.lists(st.integers(-10 ** 6, 10 ** 6), min_size=d, max_size=d), min_size=1, max_size=8)))
def test_pair_squares_add_up(rows):
    matrix = np.array(rows, np.int64)
    for i in range(matrix.shape[1]):
        total, squares = whitening.pair_squares(matrix, i)
        for k, j in enumerate(range(i, matrix.shape[1])):
            sums = [row[i] if i == j else row[i] + row[j] for row in rows]
            assert total[k] == sum(sums) and squares[k] == sum(v * v for v in sums)


def test_covariance_is_that_of_numpy(spark):
    rows = vectors(1, 400)
    found = integer_vectors(table(spark, list(enumerate(rows))), {"vec_id": "bigint"})
    count, sums, matrix, trace = whitening.covariance(found)
    wanted = np.cov(integers(rows).T.astype(float), bias=True)
    assert count == 400 and [s + 400 * whitening.SHIFT for s in sums] == integers(rows).sum(0).tolist()
    assert np.allclose(matrix, wanted, rtol=1e-9, atol=1e-6) and trace == pytest.approx(np.trace(wanted), rel=1e-12)


def test_covariance_is_exact_for_huge_components(spark):
    rows = [[3e38, 1.0, 2.0], [-3e38, 2.0, 5.0], [3e38, 4.0, 1.0], [1.0, 8.0, 1.0]]
    found = integer_vectors(table(spark, list(enumerate(rows))), {"vec_id": "bigint"})
    whole = {r.vec_id: r.x for r in found.collect()}
    x = [[int(v) for v in whole[k]] for k in range(4)]
    _, _, matrix, _ = whitening.covariance(found)
    for i in range(3):
        for j in range(3):
            a, b = [r[i] for r in x], [r[j] for r in x]
            exact = (4 * sum(p * q for p, q in zip(a, b)) - sum(a) * sum(b)) / 16
            assert matrix[i, j] == pytest.approx(exact, rel=1e-14)


def check(found, rows):
    """Against numpy on ``rows``: (vec_id, vector) of the usable rows."""
    x = integers([v for _, v in rows])
    n, sums = len(x), x.sum(0)
    values, axes = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    white = (x - sums / n) @ axes / np.sqrt(values)
    keyed = {}
    for r in found:
        keyed.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    assert len(found) == n * len(values)
    signs = None
    for (i, _), row, xi in zip(rows, white, x):
        deviation = sum((n * int(v) - int(s)) ** 2 for v, s in zip(xi, sums))
        mine = keyed[(i, deviation)]
        got = np.array([mine[k + 1].whitened for k in range(len(values))])
        if signs is None:
            signs = np.sign(got * row)
        assert np.allclose(got * signs, row, rtol=1e-6, atol=1e-7)
        assert [mine[k + 1].explained for k in range(len(values))] == pytest.approx(
            (values / np.trace(np.cov(x.T.astype(float), bias=True))).tolist(), rel=1e-8)
    assert {r.n for r in found} == {n} and all(0 <= r.identity_error <= 1e-9 for r in found)


def test_query_equals_numpy_on_awkward_rows(spark, tmp_path):
    v = vectors(2, 120, size=10)
    good = [(k, x) for k, x in enumerate(v)] + [(500 + k, v[3]) for k in range(30)] + [(None, v[5]), (7, v[8])]
    bad = [(1000, None), (1001, [nan] + v[0][1:]), (1002, v[0][:-1] + [inf]), (1003, [None] + v[0][1:]), (1004, []), (1005, v[0][:4])]
    table(spark, good + bad).write.parquet(f"{tmp_path}/embeddings.parquet")
    check(whitening.op12_embedding_whitening(spark, str(tmp_path)).collect(), good)


def test_fewer_dimensions_than_components_and_dimensions_far_apart(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(k, [float(np.float32(a * s)) for a, s in zip(rng.normal(0, 1, 3), (900.0, 1.0, 0.02))]) for k in range(300)]
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    check(whitening.op12_embedding_whitening(spark, str(tmp_path)).collect(), rows)


def test_components_without_variance_are_null(spark, tmp_path):
    table(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0])]).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = {(r.vec_id, r.component): r for r in whitening.op12_embedding_whitening(spark, str(tmp_path)).collect()}
    assert [abs(found[i, 1].whitened) for i in (1, 2)] == pytest.approx([1, 1])
    assert found[1, 2].whitened is None and found[1, 1].explained == 1.0 and found[1, 1].identity_error < 1e-12
    one, _ = whitening.whiten(table(spark, [(1, [1.0, 2.0])]))
    assert one.first()["whitened"] == [None, None] and one.first()["deviation"] == 0


def test_deviation_beyond_64_bits_is_null(spark):
    found, _ = whitening.whiten(table(spark, [(k, [3e38 if k % 2 else 0.0, float(k)]) for k in range(40)]))
    assert {r.deviation for r in found.collect()} == {None}


def test_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = whitening.op12_embedding_whitening(spark, str(tmp_path))
    assert found.count() == 0 and found.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
