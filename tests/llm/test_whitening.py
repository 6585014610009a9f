import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coursemill.llm.whitening import SHIFT, components, polar, whiten


def brute(rows):
    """By exact sums and the library's eigensolver."""
    fine = [(i, [int(np.floor(64.0 * c)) + SHIFT for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    most = max({len(v) for _, v in fine}, key=lambda k: (sum(len(v) == k for _, v in fine), k))
    fine = [(i, v) for i, v in fine if len(v) == most]
    kinds = sorted({tuple(v) for _, v in fine})
    n, total = len(kinds), [sum(c) for c in zip(*kinds)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, total)] for v in kinds])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    out = []
    for i, v in fine:
        d = [n * c - s for c, s in zip(v, total)]
        for k in range(min(16, most)):
            e = values[-1 - k]
            if e > 1e-9 * values[-1]:
                out.append((i, k + 1, n, sum(c * c for c in d), float(np.array(d) / n @ vectors[:, -1 - k] / np.sqrt(e)), e / values.sum()))
    return out


def held(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], abs(r[4]))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([abs(r[4]) for r in got], [abs(r[4]) for r in want], rtol=1e-7, atol=1e-9)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    for c in {r[1] for r in got}:  # one sign for all rows of a component
        a, b = np.array([r[4] for r in got if r[1] == c]), np.array([r[4] for r in want if r[1] == c])
        assert np.allclose(a, b, atol=1e-7) or np.allclose(a, -b, atol=1e-7)
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-9


def test_equals_brute_force(spark):
    random = np.random.default_rng(2)
    rows = [(i, (random.normal(size=20) * np.arange(1, 21) / 9).tolist()) for i in range(150)] + [(i, [0.5] * 20) for i in range(150, 240)]
    rows += [(0, rows[0][1]), (None, rows[1][1]), (300, None), (301, []), (302, [None] * 20), (303, [float("nan")] * 20), (304, [float("inf")] + [0.0] * 19), (305, [1.0, 2.0]), (306, [0.0] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as x", "2 as n", "3 as i", "4 as component").repartition(3)
    held(whiten(df).collect(), brute(rows))


def test_dependent_dimensions_and_float_vectors(spark):
    random = np.random.default_rng(4)
    base = random.integers(-9, 9, (40, 2)) / 64
    rows = [(i, [float(a), float(b), float(a + b), 0.25]) for i, (a, b) in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    held(whiten(df).collect(), brute(rows))
    assert {r.component for r in whiten(df).collect()} == {1, 2}


def test_deviation_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(k, [2e6 if k % 2 else -2e6, float(k)]) for k in range(400)], "vec_id long, embedding array<double>")
    assert all(r.deviation is None for r in whiten(df).collect())


def test_equal_and_no_vectors(spark):
    df = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)] + [(9, None)], "vec_id long, embedding array<double>")
    for some in (df, df.filter("embedding is null"), df.limit(0)):
        assert whiten(some).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10**6), st.sampled_from(["plain", "equal", "steep", "low"]))
def test_components_of_symmetric_matrices(size, seed, kind):
    random = np.random.default_rng(seed)
    q, _ = np.linalg.qr(random.normal(size=(size, size)))
    value = {"plain": random.normal(size=size), "equal": np.repeat([3.0, 1.0], size)[:size], "steep": 10.0 ** -np.arange(size), "low": np.r_[5.0, np.zeros(size)][:size]}[kind]
    a = (q * value) @ q.T
    got, vectors = components(a)
    scale = np.abs(value).max()
    assert np.allclose(got, np.sort(value)[::-1], atol=1e-13 * scale * size)
    assert np.allclose(vectors.T @ vectors, np.eye(size), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * got, atol=1e-12 * scale * size)


def test_polar_factor():
    random = np.random.default_rng(6)
    for spread in (0, 6, 12):
        u, _ = np.linalg.qr(random.normal(size=(9, 9)))
        w, _ = np.linalg.qr(random.normal(size=(9, 9)))
        a = (u * 10.0 ** -np.linspace(0, spread, 9)) @ w.T
        assert np.allclose(polar(a), u @ w.T, atol=1e-3 if spread == 12 else 1e-8)
    assert polar(np.diag([1.0, 0.0])) is None


@pytest.mark.parametrize("size", [64])
def test_components_at_the_size_of_the_table(size):
    random = np.random.default_rng(8)
    x = random.normal(size=(400, size))
    a = x.T @ x / 400
    got, vectors = components(a)
    want, true = np.linalg.eigh(a)
    assert np.allclose(got, want[::-1], rtol=1e-12)
    assert np.allclose(np.abs((vectors * true[:, ::-1]).sum(0)), 1, atol=1e-11)
