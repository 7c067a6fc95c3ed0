import zlib

import numpy as np

from fleetvolt.llm import sharding


def check(out, rows, shards=16):
    want = sorted(((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == want
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_documents(documents):
    check(sharding.shard_documents(documents.repartition(7)).collect(), [tuple(r) for r in documents.collect()])


def test_edge_documents(edge_docs, edge_rows):
    check(sharding.shard_documents(edge_docs, 3).collect(), edge_rows, 3)


def test_no_documents(no_docs):
    assert sharding.shard_documents(no_docs).count() == 0


def test_hypergeometric_follows_its_law():
    rng = np.random.default_rng(1)
    got = np.array([sharding.hypergeometric(rng, 30, 50, 20) for _ in range(20_000)])
    want = np.random.default_rng(2).hypergeometric(30, 50, 20, 20_000)
    assert abs(got.mean() - 7.5) < 0.06 and abs(got.var() - want.var()) < 0.15
    for g, b, n in ((0, 5, 3), (5, 0, 3), (4, 4, 8), (10**11, 3 * 10**11, 10**9)):
        k = sharding.hypergeometric(rng, g, b, n)
        assert max(0, n - b) <= k <= min(n, g)


def test_matrix_sums():
    counts, sizes = [5, 0, 17, 3], [9, 8, 8]
    m = np.array(sharding.communication_matrix(counts, sizes, 3))
    assert m.sum(axis=1).tolist() == counts and m.sum(axis=0).tolist() == sizes


def test_every_place_is_equally_likely(spark):
    """Rows of one input partition spread over shards and slots as a uniform shuffle does."""
    df = spark.range(4000).selectExpr("id AS doc_id", "cast(id AS string) AS text").repartitionByRange(4, "doc_id")
    out = sharding.shard_documents(df, 4).collect()
    first = np.bincount([r["shard"] for r in out if r["doc_id"] < 1000], minlength=4)
    assert abs(first - 250).max() < 60
    early = sum(r["slot"] < 500 for r in out if r["doc_id"] < 1000)
    assert abs(early - 500) < 80
