"""Whitening against numpy's eigenvalues of the whole covariance."""

import math

import numpy as np
import pytest

from daedap.llm import whitening
from daedap.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, component string, n string, whitened string, x string"


def embeddings(spark, vectors):
    rows = [(i, v, "a", "b", "c", "d") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def reference(vectors, wanted=16):
    """Per vector: id, n and deviation; then eigenvalues, -vectors and the fit list."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in kept}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in x.items()}
    matrix = np.array(fit, float) - np.array([s / n for s in sums])
    values, turn = np.linalg.eigh(matrix.T @ matrix / n)
    return x, n, sums, deviation, values[::-1], turn[:, ::-1]


def check(rows, vectors, wanted=16):
    x, n, sums, deviation, values, turn = reference(vectors)
    k = min(wanted, int((values > 1e-12 * values.sum()).sum()))
    assert len(rows) == len(x) * k
    found = {(r.vec_id, r.component): r for r in rows}
    for component in range(1, k + 1):
        e, u = values[component - 1], turn[:, component - 1]
        ours = np.array([found[i, component].whitened for i in x])
        theirs = np.array([(np.array(v, float) - np.array([s / n for s in sums])) @ u / math.sqrt(e) for v in x.values()])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-6
        for i in x:
            row = found[i, component]
            assert (row.n, row.deviation) == (n, deviation[i])
            assert abs(row.explained / (e / values.sum()) - 1) < 1e-9
            assert row.identity_error < 1e-9
    assert len({r.identity_error for r in rows}) <= 1


def random_vectors(n, d, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=d) * np.linspace(3, 1, d)).tolist()) for i in range(n)]


def test_whole_query(spark):
    vectors = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    check(QUERIES["op13_chebyshev_whitening"](spark, SF).collect(), vectors)


@pytest.mark.parametrize("n, d", [(300, 48), (300, 20), (300, 3), (5, 40), (2, 2)])
def test_shapes(spark, n, d):
    """More and fewer dimensions than components, fewer vectors than either."""
    vectors = random_vectors(n, d)
    check(whitening.whitened(embeddings(spark, vectors)).collect(), vectors)


def test_odd_rows_and_copies(spark):
    """A third of all rows is one vector; it counts once."""
    vectors = random_vectors(60, 20)
    vectors += [(100 + i, vectors[7][1]) for i in range(40)]
    rows = [*vectors, (1000, None), (1001, [1.0] * 19 + [None]), (1002, [math.nan] * 20), (1003, [math.inf] + [0.0] * 19)]
    check(whitening.whitened(embeddings(spark, rows).repartition(5)).collect(), rows)


def test_null_and_repeated_ids(spark):
    vectors = random_vectors(30, 4)
    rows = [*vectors, (None, vectors[3][1]), (5, vectors[6][1])]
    found = whitening.whitened(embeddings(spark, rows)).collect()
    assert len(found) == 32 * 4
    assert [r.whitened for r in found if r.vec_id is None] == [r.whitened for r in found if r.vec_id == 3]


def test_nothing_to_whiten(spark):
    assert whitening.whitened(embeddings(spark, [])).collect() == []
    assert whitening.whitened(embeddings(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whitened(embeddings(spark, [(1, []), (2, None)])).collect() == []


def test_what_cannot_be_told_raises(spark):
    with pytest.raises(Exception, match="different lengths"):
        whitening.whitened(embeddings(spark, [(1, [1.0, 2.0]), (2, [1.0])])).collect()
    with pytest.raises(Exception, match="too large"):
        whitening.whitened(embeddings(spark, [(1, [1e30, 2.0]), (2, [1.0, 2.0])])).collect()
    with pytest.raises(Exception, match="too large"):
        whitening.whitened(embeddings(spark, [(1, [1e9, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 1.0])])).collect()


def test_many_sums_are_added_up_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FEW_SUMS", 1)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 8)
    vectors = random_vectors(200, 24)
    rows = embeddings(spark, vectors)
    fit = whitening.fit_list(whitening.whole_vectors(rows))
    fit = whitening.FitList(fit.blocks.repartition(9), fit.n, fit.sums, 9)
    found = whitening.fitted(fit)
    _, n, _, _, values, turn = reference(vectors)
    assert fit.n == n and np.allclose(found.values, values[:16], rtol=1e-12)


def test_the_filter_damps_the_unwanted_part():
    """Against the same polynomial of the eigenvalues, and with the gap it opens."""
    rng = np.random.default_rng(1)
    values = np.concatenate([[10.0, 9.0], np.linspace(1, 0.1, 30)])
    basis, _ = np.linalg.qr(rng.normal(size=(32, 32)))
    matrix = basis * values @ basis.T
    q = rng.normal(size=(32, 4))
    out = whitening.filtered(lambda v: matrix @ v, q, 0.0, 1.0, 10.0, 8)
    gain = (basis.T @ out) / (basis.T @ q)
    expected = np.cosh(8 * np.arccosh((values + 0j - 0.5) / 0.5)).real
    expected /= expected[0]
    assert np.allclose(np.abs(gain), np.abs(expected)[:, None], atol=1e-9)
    assert np.abs(gain[2:]).max() < 1e-8


def test_uncertified_components_raise():
    rng = np.random.default_rng(2)
    noisy = lambda q: q * np.linspace(2, 1, 64)[:, None] + rng.normal(size=q.shape) * 1e-3
    with pytest.raises(ArithmeticError):
        whitening.principal_components(noisy, 64, 96.0)
