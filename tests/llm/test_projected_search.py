import math

import numpy as np
import pytest

from fleetvolt.llm import projected_search as S


def usable(rows):
    return [(i, [float(c) for c in v]) for i, v in rows
            if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)]


def score(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def brute(rows, k, every):
    rows = usable(rows)
    out = []
    for a, (i, q) in enumerate(rows):
        if i % every == 0:
            found = sorted((-score(q, v), j) for b, (j, v) in enumerate(rows) if a != b and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def got(df, k, every):
    return sorted(tuple(r) for r in S.nearest(S.whole_vectors(df), f"vec_id % {every} = 0", k)
                  .select("query_id", "rank", "vec_id", "score").collect())


def recall(found, rows, k, every):
    """Share of the true neighbours found; a score as good as the k-th best counts. Scores must be exact."""
    vectors = dict(usable(rows))
    truth, hits, n = {}, 0, 0
    for q, r, i, s in brute(rows, k, every):
        truth.setdefault(q, []).append(s)
    for q, r, i, s in found:
        assert s == score(vectors[q], vectors[i]) and i != q
        hits += s >= min(truth[q])
    return hits / sum(map(len, truth.values()))


def test_chi_square_quantiles():
    assert abs(S.chi_square_quantile(0.95, 2) - 5.991464547) < 1e-6
    assert abs(S.chi_square_quantile(0.95, 10) - 18.307038053) < 1e-6


def test_distances_of_projections_follow_the_law():
    """Over one pair for each of many matrices (they are drawn by length)."""
    rng = np.random.default_rng(0)
    inside = []
    for length in range(2, 802):
        x, q = rng.normal(size=(1, length)), rng.normal(size=(1, length))
        top2 = float((x ** 2).sum()) + 3
        d2 = float((q ** 2).sum() + top2 - 2 * (x @ q.T)[0, 0])
        inside.append(((S.projected(x, top2) - S.projected(q, None)) ** 2).sum() / d2 <= S.chi_square_quantile(0.95, S.DIMS))
    assert 0.92 < np.mean(inside) < 0.98


def test_search_stops_early_on_clustered_vectors():
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(40, 32)), 200, axis=0) + 0.05 * rng.normal(size=(8000, 32))
    top2 = float((x ** 2).sum(axis=1).max())
    order, bounds = S.build_tree(S.projected(x, top2))
    assert sorted(order.tolist()) == list(range(8000)) and np.diff(bounds).max() <= S.LEAF
    tree = S.Tree(order.astype(np.int64), order.astype(np.int64), x[order], S.projected(x, top2)[order], bounds)
    s = S.Search(x[:8000:200], np.arange(0, 8000, 200), top2, 10, np.full(40, -np.inf), np.zeros(40, np.int64))
    s.run(tree)
    assert s.verified < 0.25 * 40 * 8000


def test_embeddings(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = got(df, 20, 20)
    assert len(found) == len(brute(rows, 20, 20)) and recall(found, rows, 20, 20) >= 0.9


def test_many_trees_and_norms(spark, monkeypatch):
    monkeypatch.setattr(S, "TREE_BYTES", 8 * 12 * 300)
    monkeypatch.setattr(S, "QUERY_BLOCK", 50)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 12)) * rng.lognormal(size=(4000, 1)) ** 0.5
    x[1000:2300] = x[7]                                    # a third of all vectors are one
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = got(df, 10, 20)
    assert len(found) == 2000 and recall(found, rows, 10, 20) >= 0.9
    own = [f for f in found if f[0] == 1000]
    top = max(f[3] for f in own)
    ties = [f[2] for f in own if f[3] == top]
    assert ties == sorted(ties)


def test_edge_vectors(spark):
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (6, [0.0, 0.0]), (7, [-1.0, 2.0]), (7, [-1.0, 2.0]), (8, []), (20, []), (9, [3.0]), (10, [1e-3, -1e-3]), (40, [1.0, 0.5]),
            (11, [0.25, 0.25]), (11, [0.5, 0.25]), (60, [1.0, 2.0, 3.0]), (80, [3.0, 1.0]), (80, [1.0, 1.0]), (100, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, 0.5, 1, "x") for r in rows], "vec_id long, embedding array<double>, score double, length int, cell string")
    assert got(df, 5, 20) == brute(rows, 5, 20)


def test_no_vectors(spark):
    assert got(spark.createDataFrame([], "vec_id long, embedding array<float>"), 5, 20) == []


@pytest.mark.parametrize("kind", ["float", "double"])
def test_one_vector(spark, kind):
    assert got(spark.createDataFrame([(0, [1.0, 2.0])], f"vec_id long, embedding array<{kind}>"), 5, 20) == []
