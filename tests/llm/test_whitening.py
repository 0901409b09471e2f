import math

import numpy as np
import pytest

from promptloom.llm import whitening

SCHEMA = "vec_id bigint, embedding array<double>, x string, i int, value int, n int, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, 3, 4) for i, v in rows], SCHEMA)


def expected(rows, components=4):
    """By numpy's own eigenvectors, with integers of any size."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fitted = sorted({tuple(x) for _, x in kept})
    n, sums = len(fitted), [sum(c) for c in zip(*fitted)]
    x = np.array(fitted, dtype=float)
    away = x - np.array([s / n for s in sums])
    cov = away.T @ away / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for _, v in kept]
    return kept, n, np.array(sums) / n, values[order], vectors[:, order], np.trace(cov), deviation


def check(spark, rows, components=4):
    found = whitening.whitened_embeddings(frame(spark, rows), components).collect()
    kept, n, mean, values, vectors, trace, deviation = expected(rows, components)
    assert len(found) == len(kept) * len(values)
    assert {row.n for row in found} == {n}
    assert sorted((str(row.vec_id), row.deviation) for row in found if row.component == 1) == sorted(
        (str(i), d) for (i, _), d in zip(kept, deviation)
    )
    for k in range(len(values)):
        own = sorted((str(r.vec_id), r.deviation, r.whitened) for r in found if r.component == k + 1)
        wanted = [(np.array(v) - mean) @ vectors[:, k] / math.sqrt(values[k]) for _, v in kept]
        for sign in (1, -1):
            wanted_rows = sorted((str(i), d, sign * w) for (i, _), d, w in zip(kept, deviation, wanted))
            if np.allclose([w for *_, w in own], [w for *_, w in wanted_rows], rtol=1e-8, atol=1e-8):
                break
        else:
            raise AssertionError(f"component {k + 1}")
        assert np.allclose([r.explained for r in found if r.component == k + 1], values[k] / trace, rtol=1e-9)
    assert max(row.identity_error for row in found) < 1e-9


def test_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    check(spark, [(r.vec_id, r.embedding) for r in rows])


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 5)) * [5, 3, 2, 1, 0.5] + 100)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (70, None), (71, []), (72, [1.0, None, 2.0, 1.0, 1.0])]
    rows += [(73, [float("nan")] * 5), (74, [1.0, float("inf"), 0.0, 0.0, -0.0]), (75, [-0.0, 0.0, -0.001, 0.001, 1.0])]
    check(spark, rows)


def test_other_dimensions_are_left_out(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 5.0]), (3, [4.0, 4.0]), (4, [1.0]), (5, [1.0, 2.0, 3.0])]
    found = whitening.whitened_embeddings(frame(spark, rows)).collect()
    assert sorted({row.vec_id for row in found}) == [1, 2, 3]
    assert sorted({row.component for row in found}) == [1, 2]


def test_hot_vector_counts_once(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((50, 6)))] + [(i, [9.0, 8.0, 7.0, 6.0, 5.0, 4.0]) for i in range(200, 900)]
    check(spark, rows)


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(3)
    check(spark, [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((30, 3)) * 1e5)])
    found = whitening.whitened_embeddings(frame(spark, [(1, [1e12, 0.0]), (2, [-1e12, 1.0])])).collect()
    assert {row.deviation for row in found} == {None}


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_without_variance(spark, rows):
    found = whitening.whitened_embeddings(frame(spark, rows)).collect()
    assert len(found) == 2 * len(rows)
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {(1, 0, None, 0.0, None)}


def test_component_without_variance(spark):
    found = whitening.whitened_embeddings(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])).collect()
    assert all((row.whitened is None) == (row.component > 1) for row in found)
    assert found[0].identity_error < 1e-12


def test_empty_table(spark):
    assert whitening.whitened_embeddings(frame(spark, [])).collect() == []
    assert whitening.whitened_embeddings(frame(spark, [(1, None)])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_eigenvectors(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 90))
    turn = np.linalg.qr(rng.standard_normal((n, n)))[0]
    spectra = [rng.random(n), 10.0 ** -np.arange(n), np.repeat(2.0, n), rng.integers(0, 3, n).astype(float), np.r_[1e6, np.ones(n - 1)]]
    for spectrum in spectra:
        a = (turn * spectrum) @ turn.T
        a = (a + a.T) / 2
        values, vectors = whitening.eigenvectors(a)
        size = np.linalg.norm(a)
        assert np.allclose(values, np.sort(spectrum)[::-1], atol=1e-12 * max(size, 1) * n)
        assert np.linalg.norm(a @ vectors - vectors * values) < 1e-13 * n * size
        assert np.linalg.norm(vectors.T @ vectors - np.eye(n)) < 1e-13 * n
        top, leading = whitening.eigenvectors(a, 3)
        assert np.allclose(top, values[:3], atol=1e-12 * max(size, 1) * n)
        assert leading.shape == (n, min(3, n))


def test_polar_factor():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((40, 40))
    a = a + a.T
    values, vectors = np.linalg.eigh(a)
    assert np.allclose(whitening.polar(a), (vectors * np.sign(values)) @ vectors.T, atol=1e-11)
