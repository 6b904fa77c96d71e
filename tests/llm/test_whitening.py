"""Whitening against numpy."""

import numpy as np
import pytest

from trialweave.llm import whitening


def plain(rows, components=4):
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in kept]
    size = min(set(sizes), key=lambda s: (-sizes.count(s), s), default=0)
    kept = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in kept if len(v) == size]
    fit = sorted({tuple(x) for _, x in kept})
    n = len(fit)
    if n < 2:
        return []
    sums = [sum(c) for c in zip(*fit)]
    x = np.array(fit, np.float64)
    cov = np.cov(x.T, bias=True).reshape(size, size)
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1], w[:, ::-1]
    k = min(components, int((e > e.sum() * size * np.finfo(float).eps).sum()))
    out = []
    for i, v in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        z = (np.array(v) - np.array(sums) / n) @ w[:, :k] / np.sqrt(e[:k])
        out += [(i, c + 1, n, deviation if deviation < 1 << 63 else None, z[c], e[c] / e.sum()) for c in range(k)]
    return out


def compare(df, rows):
    got = whitening.whiten(df).collect()
    want = plain(rows)
    assert len(got) == len(want)
    order = lambda r: (r[1], str(r[0]), str(r[3]), abs(round(r[4], 6)))
    signs = {}
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order)):
        assert g[:4] == w[:4]
        assert abs(abs(g[4]) - abs(w[4])) < 1e-8 and abs(g[5] - w[5]) < 1e-10 and g[6] < 1e-8
        if abs(g[4]) > 1e-6:
            signs.setdefault(g[1], set()).add(np.sign(g[4]) * np.sign(w[4]))
    assert all(len(s) == 1 for s in signs.values())


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)


def test_odd_vectors(spark, small_blocks):
    rng = np.random.default_rng(4)
    rows = [(k, [float(c) for c in np.float32(rng.normal(size=6) * [9, 7, 5, 3, 2, 1])]) for k in range(180)]
    rows[3] = (3, None)
    rows[4] = (4, [])
    rows[5] = (5, [1.0] * 5 + [None])
    rows[6] = (6, [float("nan")] * 6)
    rows[7] = (7, [float("inf")] * 6)
    rows[8] = (8, [1.0, 2.0])
    rows += [(None, rows[0][1]), rows[1], *[(1000 + k, rows[2][1]) for k in range(60)], (2000, [-0.0] * 6), (2001, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, x string, id string").repartition(5)
    compare(df, rows)


def test_fewer_components_than_asked(spark):
    rows = [(k, [float(k), 2.0 * k, 5.0]) for k in range(10)]
    compare(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), rows)


def test_large_numbers_stay_exact(spark):
    rows = [(k, [float(k) * 2**20, float(-k)]) for k in range(50)] + [(99, [2.0**40, 1.0])]
    got = {(r["id"], r["component"]): r["deviation"] for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {(r[0], r[1]): r[3] for r in plain(rows)} and None in got.values()


def test_nothing_to_fit(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        assert out.columns[:2] == ["id", "component"] and out.count() == 0
