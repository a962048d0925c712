import math

import numpy as np
import pytest

from offhours.llm import whitening as wh

VECTORS = "vec_id long, embedding array<float>, label int, whitened string, x string"


def table_of(spark, rows, schema=VECTORS):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "w", "x")
                                  for i, v in rows], schema)


def check(found, rows, components=16):
    """Everything the contract fixes, against whole-number sums and numpy's eigenvectors."""
    good = [
        (i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    listed = np.array(sorted({tuple(x) for _, x in good}), dtype=np.int64)
    n, sums = len(listed), listed.sum(0)
    away = (listed * n - sums) / n
    cov = away.T @ away / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, listed.shape[1])
    out = {}
    for r in found:
        out.setdefault(r["vec_id"], []).append(r)
    assert sorted(out) == sorted({i for i, _ in good})
    for i, x in good:
        mine = sorted((r for r in out[i]), key=lambda r: r["component"])
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        assert [r["component"] for r in mine] == list(range(1, k + 1))
        for c, r in enumerate(mine):
            assert (r["n"], r["deviation"]) == (n, deviation)
            wanted = (np.array(x) * n - sums) / n @ vectors[:, c] / math.sqrt(values[c])
            gaps = [abs(values[c] - v) / values[0] for j, v in enumerate(values) if j != c]
            if min(gaps, default=1) > 1e-6:
                assert abs(abs(r["whitened"]) - abs(wanted)) < 1e-7 * max(1, abs(wanted))
            assert r["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-9


def test_query_equals_numpy_on_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in wh.table(spark, sf_dir, "embeddings").collect()]
    check(wh.op11_embedding_whitening(spark, sf_dir).collect(), rows)


def test_nulls_copies_and_many_partitions(spark):
    pick = np.random.default_rng(2)
    rows = [(i, (pick.normal(size=6) * [9, 4, 2, 1, 0.5, 0.25]).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    rows += [(2000, None), (2001, []), (2002, [1.0, None, 2, 3, 4, 5]), (2003, [math.nan] * 6), (2004, [math.inf] * 6)]
    rows += [(2005, [1e20] * 6), (2006, [1.0, 2.0])]
    df = table_of(spark, rows).repartition(37)
    kept = [r for r in rows if r[0] < 2000]
    check(wh.whiten(df).collect(), kept)
    check(wh.whiten(df, components=2).collect(), kept, components=2)


def test_tables_without_variance_or_rows(spark):
    assert wh.whiten(table_of(spark, [])).count() == 0
    assert wh.whiten(table_of(spark, [(1, None), (2, [])])).count() == 0
    same = wh.whiten(table_of(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(same) == 4
    assert all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["identity_error"] is None for r in same)
    flat = wh.whiten(table_of(spark, [(i, [float(i), 3.0]) for i in range(5)])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat)
    assert all(r["identity_error"] < 1e-12 and r["n"] == 5 for r in flat)


def test_deviation_beyond_a_long_is_null():
    away = wh._away(np.array([[1 << 33, 0], [0, 0]]), 1 << 30, np.array([1 << 62, 5]))
    assert away.tolist() == [[(1 << 63) - (1 << 62), -5], [-(1 << 62), -5]]
    assert wh._deviations(away) == [None, None]
    assert wh._deviations(np.array([[3, 4], [0, 0]])) == [25, 0]
    edge = np.array([[3_037_000_499, 0], [3_037_000_499, 3_037_000_499]])
    assert wh._deviations(edge) == [3_037_000_499**2, None]


def scatter(x):
    away = x - x.mean(0)
    return away.T @ away


CASES = {
    "plain": lambda r: r.normal(size=(400, 20)) * 64,
    "whole numbers with ties": lambda r: r.integers(0, 2, size=(200, 8)).astype(float),
    "fewer vectors than dimensions": lambda r: r.normal(size=(5, 30)),
    "low rank": lambda r: r.normal(size=(150, 2)) @ r.normal(size=(2, 10)),
    "scales apart": lambda r: r.normal(size=(200, 3)) * [1e6, 1, 1e-6],
    "one dimension": lambda r: r.normal(size=(50, 1)),
    "axes": lambda r: np.repeat(np.eye(12) * 5, 3, 0),
    "constant": lambda r: np.ones((20, 4)),
}


@pytest.mark.parametrize("case", CASES)
def test_updates_and_merges_give_the_scatter_matrix(case):
    x = CASES[case](np.random.default_rng(1))
    whole, parts = wh.Spectrum(x.shape[1]), [wh.Spectrum(x.shape[1]) for _ in range(3)]
    for i, row in enumerate(x):
        whole.add(row)
        parts[i % 3].add(row)
    parts[0].merge(parts[1])
    parts[0].merge(parts[2])
    wanted = scatter(x)
    for found in (whole, parts[0]):
        built = found.vectors * found.values @ found.vectors.T
        assert np.abs(built - wanted).max() <= 1e-12 * max(1e-3, np.abs(wanted).max())
        assert np.abs(found.vectors.T @ found.vectors - np.eye(x.shape[1])).max() < 1e-12
        assert found.n == len(x) and np.allclose(found.mean, x.mean(0), atol=1e-9)


def test_secular_roots_are_eigenvalues():
    pick = np.random.default_rng(3)
    for k in (1, 2, 3, 10, 40):
        d = np.sort(pick.random(k)) * 10.0 ** pick.integers(-6, 6)
        z = pick.normal(size=k) * 10.0 ** pick.integers(-5, 1, size=k)
        z /= np.sqrt(z @ z)
        roots = d - np.diagonal(wh.secular_roots(d, z * z, 1.0))
        wanted = np.linalg.eigvalsh(np.diag(d) + np.outer(z, z))
        assert np.allclose(roots, wanted, rtol=0, atol=1e-13 * max(1.0, d.max()) * k)
        assert (np.diff(roots) > 0).all() and (roots > d).all()
