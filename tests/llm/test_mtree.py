import math

import numpy as np
import pytest

from fleetvolt.llm import mtree


def brute(rows, k, every=50):
    best = {}
    for i, v in rows:
        if i is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        q = tuple(math.floor(256 * float(np.float64(c))) for c in v)
        best.setdefault(i, set()).add(q)
    out = []
    for i, own in best.items():
        if i % every:
            continue
        q = max(own)
        found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, vs in best.items() for v in vs if j != i and len(v) == len(q))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def got(df, k, every=50):
    v = mtree.whole_vectors(df)
    return sorted(tuple(r) for r in mtree.top_k(v, v.where(f"vec_id % {every} = 0"), k)
                  .select("query_id", "rank", "vec_id", "score").collect())


def test_embeddings(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert got(df, 5, 5) == brute(rows, 5, 5)


def test_edge_vectors(spark):
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (6, [0.0, 0.0]), (7, [-1.0, 2.0]), (7, [-1.0, 2.0]), (8, []), (50, []), (9, [3.0]), (10, [1e-3, -1e-3]), (100, [1.0, 0.5]),
            (11, [0.25, 0.25]), (11, [0.5, 0.25]), (100, [0.5, 1.0]), (150, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cell string")
    assert got(df, 5) == brute(rows, 5)


def test_many_small_trees_with_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_ROWS", 64)
    monkeypatch.setattr(mtree, "PAGE", 8)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 6)).round(2)
    x[200:600] = x[3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df, 4, 20) == brute(rows, 4, 20)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert got(df, 5) == []


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_bounds_save_computations(spread):
    """On clustered vectors most distances are never computed; the result is exact either way."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 8)) * 200
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)) * 200 * spread).astype(np.int64)
    ids = np.arange(4000)
    top2 = float(mtree._norms(x).max())
    lift = np.sqrt(np.maximum(top2 - mtree._norms(x), 0))
    import pandas as pd
    pages = mtree._packed("c", 0, mtree.build_pages(ids, x, lift))
    assert isinstance(pages, pd.DataFrame)
    q = x[:50]
    none = np.zeros(50, np.int64)
    s = mtree.Search(q, ids[:50], top2, 5, none, none, np.zeros(50, bool))
    s.run(mtree.Tree(pages))
    score = q @ x.T
    score[np.arange(50), np.arange(50)] = np.iinfo(np.int64).min
    for r in range(50):
        order = np.lexsort((ids, -score[r].astype(float)))[:5]
        assert s.ids[r].tolist() == order.tolist() and s.scores[r].tolist() == score[r][order].tolist()
    if spread < 1:
        assert s.computed < 0.7 * 50 * 4000


def test_repeated_ids_match_sql(spark):
    """A third of all rows share one id, some with equal vectors; the SQL has the same meaning."""
    import duckdb
    import pandas as pd

    from fleetvolt.llm import oracle
    rng = np.random.default_rng(8)
    rows = [(int(i) if i % 3 else 7, rng.normal(size=4).round(1).astype("float32").tolist()) for i in range(300)]
    rows += [(50, [0.5, 0.5, 0.0, 1.0]), (50, [0.5, 0.25, 0.0, 1.0]), (100, [1.0, 0.0, 0.0, 0.0])]
    con = duckdb.connect()
    con.register("embeddings", pd.DataFrame(rows, columns=["vec_id", "embedding"]))
    want = sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({oracle.OP3})").fetchall())
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert got(df, 5) == brute(rows, 5) == want
