"""Whitening against numpy's own decomposition, and the cases of its docstring."""

import numpy as np
import pytest

from pelagia.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string"


def plain(rows, k=4):
    """vec_id, component -> (n, deviation, |whitened|, explained), by whole numbers and numpy."""
    x = [(v, [int(np.floor(256 * float(c))) for c in e]) for v, e in rows if e is not None and all(c is not None and np.isfinite(c) for c in e)]
    fit = sorted(set(map(tuple, (e for _, e in x))))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array(fit, float) - np.array(sums) / n
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    out = {}
    for v, own in x:
        far = sum((n * c - s) ** 2 for c, s in zip(own, sums, strict=True))
        w = (np.array(own) - np.array(sums) / n) @ q
        for c in range(min(k, len(sums))):
            out.setdefault((v, c + 1), []).append((n, far, abs(w[c]) / np.sqrt(e[c]), e[c] / e.sum()))
    return out


def sample(rng, n, d):
    spread = np.exp(-np.arange(d) / 3)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    return ((rng.standard_normal((n, d)) * spread) @ turn + rng.standard_normal(d)).astype(np.float32)


def test_rows_equal_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(sample(rng, 500, 12))]
    rows += [(7, rows[7][1])] * 40 + [(600 + i, rows[3][1]) for i in range(200)] + [(None, rows[1][1])]
    odd = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11)]
    df = spark.createDataFrame([(*r, "clash") for r in [*rows, *odd]], SCHEMA).repartition(7)
    want = plain(rows)
    got = whitening.whiten(df).collect()
    assert len(got) == 4 * len(rows)
    for r in got:
        n, far, w, explained = want[r["vec_id"], r["component"]][0]
        assert (r["n"], r["deviation"]) == (n, far)
        assert abs(abs(r["whitened"]) - w) < 1e-9 * max(1, w) and abs(r["explained"] - explained) < 1e-12
        assert r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in got}) == 1


@pytest.mark.parametrize("d", [1, 2, 3, 7, 40, 129])
def test_spectral_division(d):
    rng = np.random.default_rng(d)
    for kind in range(5):
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        e = [np.sort(rng.random(d))[::-1], np.ones(d), np.exp(-np.arange(d) * 1.0), np.repeat([3.0, 1.0], [d - d // 2, d // 2]), np.concatenate([[1e9], np.zeros(d - 1)])][kind]
        v = (q * e) @ q.T
        values, vectors = whitening.spectral(v)
        size = max(np.abs(e).max(), 1e-300)
        assert np.abs(np.sort(values)[::-1] - np.linalg.eigvalsh((v + v.T) / 2)[::-1]).max() < 1e-13 * size * d
        assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-13 * d
        assert np.abs((v + v.T) / 2 @ vectors - vectors * values).max() < 1e-13 * size * d


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(9)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    e = rng.standard_normal(30) * 10.0 ** -rng.integers(0, 14, 30)
    u = whitening.polar((q * e) @ q.T)
    assert np.abs(u.T @ u - np.eye(30)).max() < 1e-12
    big = np.abs(e) > 1e-9
    assert np.abs(np.diag(q.T @ u @ q)[big] - np.sign(e)[big]).max() < 1e-5


def test_few_flat_and_large_vectors(spark):
    frame = lambda rows: spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    assert whitening.whiten(frame([])).count() == 0
    assert whitening.whiten(frame([(1, None), (2, []), (3, [float("nan")])])).count() == 0
    one = whitening.whiten(frame([(1, [0.5, -0.001]), (2, [0.5, -0.001])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, 0.0, 0.0)] * 4
    line = whitening.whiten(frame([(i, [float(i), 2.0 * i, -0.0]) for i in range(5)] + [(9, [1.0])])).collect()
    assert sorted({(r["component"], r["whitened"] is None) for r in line}) == [(1, False), (2, True), (3, True)] and {r["vec_id"] for r in line} == set(range(5))
    assert all(abs(abs(r["whitened"]) - abs(r["vec_id"] - 2) / 2**0.5) < 1e-9 for r in line if r["component"] == 1)
    huge = [(i, [float(c) for c in v]) for i, v in enumerate(np.random.default_rng(1).integers(-(2**44), 2**44, (6, 3)))]
    want = plain([(i, [float(np.float32(c)) for c in v]) for i, v in huge])
    for r in whitening.whiten(frame(huge)).collect():
        far = want[r["vec_id"], r["component"]][0][1]
        assert r["deviation"] == (far if far < 2**63 else None)
        assert abs(abs(r["whitened"]) - want[r["vec_id"], r["component"]][0][2]) < 1e-9
