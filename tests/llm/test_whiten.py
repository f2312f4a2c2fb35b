from fractions import Fraction

import numpy as np
import pytest

from moodtick.llm import whiten
from moodtick.llm.common import read

SF = "/root/testdata/sf0.001"


def plain(rows):
    """n, exact deviations by key, and the covariance of the distinct whole vectors in Fractions."""
    kept = {k: tuple(int(np.floor(256 * float(c))) for c in v) for k, v in rows}
    fit = sorted(set(kept.values()))
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    deviation = {k: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for k, x in kept.items()}
    mean = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in fit) / n) for j in range(d)] for i in range(d)])
    return kept, fit, n, deviation, cov, np.array([float(m) for m in mean])


def check(df, components=4):
    usable = [(tuple(r), r.embedding) for r in df.select("vec_id", "embedding").collect()]
    usable = [(k[0], v) for k, v in usable if v and None not in v and np.isfinite(v).all()]
    kept, fit, n, deviation, cov, mean = plain(usable)
    found, model = whiten.whitened(df, components=components)
    out = found.collect()
    assert sorted(r.vec_id for r in out) == sorted(k for k, _ in usable)
    assert model.n == n and {r.vec_id: r.deviation for r in out} == {k: v if v < 2**63 else None for k, v in deviation.items()}
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert np.allclose(model.values, values[:components], rtol=1e-10, atol=1e-10 * values[0])
    assert model.trace == pytest.approx(np.trace(cov), rel=1e-12)
    gaps = np.array([min([abs(v - w) for j, w in enumerate(values) if j != i], default=1) for i, v in enumerate(values)]) / values[0]
    for c in np.flatnonzero(model.used):
        if gaps[c] > 1e-6:
            want = (np.array([kept[r.vec_id] for r in out]) - mean) @ vectors[:, c] / np.sqrt(values[c])
            got = np.array([r[-2][c] for r in out])
            assert np.allclose(got, want, atol=1e-7) or np.allclose(got, -want, atol=1e-7)
    if model.used.any():
        assert model.identity_error < 1e-9
    return found, model


def test_embeddings_against_fractions(spark):
    check(read(spark, SF, "embeddings").limit(120).select("vec_id", "embedding"))


def test_edge_cases(spark):
    """Nulls, NaN, infinities, repeated vectors and rows, another length, clashing columns, negative zero."""
    rows = [(i, [0.1 * i, -0.0, 1.5 - i * i, 3.0], 1, "d") for i in range(6)]
    rows += [(2, [0.2, -0.0, -2.5, 3.0], 1, "d"), (8, [0.5, 0.0, -23.5, 3.0], None, None)]
    bad = [(20, None, 1, "x"), (21, [None, 1.0, 1.0, 1.0], 1, "x"), (22, [float("nan"), 1.0, 1.0, 1.0], 1, "x"),
           (23, [float("inf"), 1.0, 1.0, 1.0], 1, "x"), (24, [], 1, "x"), (25, [1.0], 1, "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, whitened int, X string")
    found, model = check(df.where("vec_id != 25"))
    assert found.columns == ["vec_id", "embedding", "whitened", "X", "_whitened", "deviation"]
    out, _ = whiten.whitened(df)
    assert out.count() == 8
    one, model = whiten.whitened(df.where("vec_id = 3"))
    assert model.n == 1 and [(r.deviation, r._whitened) for r in one.collect()] == [(0, [None] * 4)]
    none, model = whiten.whitened(df.where("vec_id = 20"))
    assert model is None and none.count() == 0


def test_large_numbers_stay_exact(spark):
    """Entries whose squares and sums pass 53 and 63 bits; a deviation beyond a long is null."""
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(3) * 10.0**5).tolist()) for i in range(40)]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    huge = spark.createDataFrame([(i, [1e18 * i, 1e300, 1.0]) for i in range(4)], "vec_id long, embedding array<double>")
    found, model = whiten.whitened(huge)
    assert model.n == 2 and all(r.deviation is None for r in found.collect())
    assert all(abs(s) < 2**65 for s in model.sums) and model.used.tolist() == [True, False, False]


@pytest.mark.parametrize("spread", [0, 1e-14, 1e-9, 1e-4])
def test_clustered_eigenvalues(spread):
    """Vectors of eigenvalues that float32 cannot tell apart, checked by residual and angle."""
    rng = np.random.default_rng(5)
    d = 24
    q = np.linalg.qr(rng.standard_normal((d, d)))[0].astype(np.longdouble)
    for _ in range(3):  # orthogonal to extended precision
        q = q @ (np.eye(d) * 3 - q.T @ q) / 2
    values = np.array([5, 4, *(3 + spread * np.arange(4)), *(1 + spread * np.arange(6)), *[0.1] * 4, *np.linspace(0.01, 0.02, 8)], np.longdouble)
    a = (q * values) @ q.T
    found, x = whiten.eigenvectors((a + a.T) / 2)
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-17 * 5 * d
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-17 * d
    if spread >= 1e-9:
        order = np.argsort(-values, kind="stable")[:6]
        cosine = np.abs(np.einsum("ij,ij->j", x[:, :6], q[:, order]))
        assert np.abs(1 - cosine).max() < 1e-12


def test_products_are_exact_at_every_size():
    rng = np.random.default_rng(2)
    for top in (100, 2**28, 2**40):
        a = rng.integers(-top, top, (50, 3))
        want = [[sum(int(r[i]) * int(r[j]) for r in a) for j in range(3)] for i in range(3)]
        assert whiten.products(a, a).tolist() == want


def test_sums_do_not_depend_on_partitions(spark):
    df = read(spark, SF, "embeddings").select("vec_id", "embedding")
    a, b = (whiten.whitened(df.repartition(k))[1] for k in (1, 7))
    assert (a.values == b.values).all() and (a.components == b.components).all()
