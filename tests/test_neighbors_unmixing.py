"""Exact neighbours against the full ranking, and constrained mixtures against
every support: small cases, copies, and clustered points where bounds prune."""

from itertools import combinations

import numpy as np
import pytest

from tessera.operators import neighbors as nb
from tessera.operators import unmixing as um


def _frame(spark, vectors, labels=None):
    rows = [(k, v.tolist(), int(labels[k]) if labels is not None else 0) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def _ranking(vectors, queries, k):
    out = {}
    for q in queries:
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        order = [p for p in np.lexsort((np.arange(len(vectors)), far)) if p != q][:k]
        out[q] = order
    return out


def _found(rows):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query, r["rank"])):
        got.setdefault(r.query, []).append(r.point)
    return got


def test_clusters_are_pruned(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 50, (20, 3))
    v = np.concatenate([c + rng.normal(0, 1, (60, 3)) for c in centres])
    df = _frame(spark, v)
    found, report = nb.knn(df, df.where("vec_id % 50 = 0"), 4)
    assert _found(found.collect()) == _ranking(v, range(0, len(v), 50), 4)
    r = report.first()
    assert (r.queries, r.points) == (24, 1200) and r.compared < 0.2 * r.queries * r.points


def test_copies_few_points_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(nb, "SLAB", 16)
    monkeypatch.setattr(nb, "BLOCK", 4)
    monkeypatch.setattr(nb, "PIVOTS", 5)
    rng = np.random.default_rng(4)
    v = np.concatenate([np.ones((150, 2)), rng.normal(0, 1, (100, 2)), np.ones((1, 2)) * 1e6])
    df = _frame(spark, v)
    odd = df.unionByName(spark.createDataFrame([(9999, None, 1)], df.schema))
    found, _ = nb.knn(odd, odd.where("vec_id % 10 = 0 or vec_id > 249"), 3)
    assert _found(found.collect()) == _ranking(v, [*range(0, 250, 10), 250], 3)
    few = df.where("vec_id in (0, 1, 200)")
    assert {q: len(p) for q, p in _found(nb.knn(few, few, 5)[0].collect()).items()} == {0: 2, 1: 2, 200: 2}
    assert nb.knn(df.limit(0), df, 3)[0].count() == 0
    assert nb.knn(df, df.limit(0), 3)[0].count() == 0


def test_vote(spark):
    rows = [(1, 1, 5, 7, 0.1), (1, 2, 6, 7, 0.2), (1, 3, 7, 2, 0.3), (2, 1, 5, 9, 0.1), (2, 2, 6, 4, 0.2)]
    df = spark.createDataFrame(rows, "query long, rank int, point long, label long, distance double")
    assert {(r.query, r.pred) for r in nb.knn_vote(df).collect()} == {(1, 7), (2, 4)}


def _best_mixture(x, ends):
    """Least squares on the simplex by trying every support."""
    best = np.inf
    for m in range(1, len(ends) + 1):
        for cols in combinations(range(len(ends)), m):
            e = ends[list(cols)]
            kkt = np.block([[e @ e.T, np.ones((m, 1))], [np.ones((1, m)), np.zeros((1, 1))]])
            a = np.linalg.lstsq(kkt, np.append(e @ x, 1), rcond=None)[0][:m]
            if a.min() > -1e-12 and abs(a.sum() - 1) < 1e-9:
                best = min(best, ((x - a @ e) ** 2).sum())
    return best


@pytest.mark.parametrize("k,d,copies", [(5, 4, 0), (5, 12, 1), (2, 1, 0), (1, 3, 0)])
def test_simplex_is_optimal(k, d, copies):
    rng = np.random.default_rng(k * d)
    ends = rng.normal(0, 1, (k, d))
    if copies:
        ends[1] = ends[0]
    x = np.concatenate([rng.normal(0, 2, (60, d)), ends, (ends[:1] + ends[-1:]) / 2])
    a, gap = um.simplex_ls(x, ends)
    assert a.min() >= 0 and np.allclose(a.sum(1), 1) and gap.max() < 1e-8 and gap.min() > -1e-8
    assert np.allclose(((x - a @ ends) ** 2).sum(1), [_best_mixture(r, ends) for r in x], atol=1e-8)
    assert um.simplex_ls(x[:0], ends)[0].shape == (0, k)


def test_sparse_path():
    rng = np.random.default_rng(9)
    ends = rng.normal(0, 1, (6, 9))
    ends[3] = ends[2] + 0.05 * rng.normal(0, 1, 9)          # nearly the same
    x = np.concatenate([rng.normal(0, 1, (80, 9)), np.zeros((1, 9)), ends])
    shares = [1.0, 0.7, 0.3, 0.05, 0.0]
    a, off = um.l1_path(x, ends, shares)
    assert off.max() < 1e-8
    assert (a[:, 0] == 0).all()
    full = np.linalg.lstsq(ends.T, x.T, rcond=None)[0].T
    assert np.allclose(a[:, -1] @ ends, full @ ends, atol=1e-6)
    # no small change of any abundance makes the aim smaller
    most = np.abs(x @ ends.T).max(1)
    for s, share in enumerate(shares[1:4], 1):
        def aim(b):
            return ((x - b @ ends) ** 2).sum(1) / 2 + share * most * np.abs(b).sum(1)
        for j in range(6):
            for step in (1e-4, -1e-4):
                b = a[:, s].copy()
                b[:, j] += step
                assert (aim(b) >= aim(a[:, s]) - 1e-12).all()
