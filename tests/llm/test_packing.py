import re
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from fleetvolt.llm import packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def padding(bins, ends):
    total, low = 0, -1
    for end in ends:
        total += sum(end * n - s for top, n, s in bins if low < top <= end)
        low = end
    return total


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), min_size=1, max_size=9, unique_by=lambda x: x[0]),
       st.integers(1, 5))
def test_boundaries_are_optimal(rows, buckets):
    bins = sorted((length, n, length * n) for length, n in rows)
    ends = packing.optimal_boundaries(bins, buckets)
    tops = [b[0] for b in bins]
    assert ends == sorted(set(ends)) and ends[-1] == tops[-1] and len(ends) <= buckets
    best = min(padding(bins, [*c, tops[-1]]) for k in range(min(buckets, len(tops))) for c in combinations(tops[:-1], k))
    assert padding(bins, ends) == best


def check(out, rows, buckets, budget):
    want = sorted((r[0], len(WORD.findall(r[1] or ""))) for r in rows if r[0] is not None)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in out if r["doc_id"] is not None) == want and len(out) == len(rows)
    batches = {}
    for r in out:
        assert r["n_tokens"] <= r["pad_to"] and r["padding"] == r["pad_to"] - r["n_tokens"]
        batches.setdefault(r["batch"], []).append(r)
    assert sorted(batches) == list(range(len(batches)))
    last = {r["bucket"]: max(x["batch"] for x in out if x["bucket"] == r["bucket"]) for r in out}
    for b, held in batches.items():
        cap = max(1, budget // max(1, held[0]["pad_to"]))
        assert len({r["bucket"] for r in held}) == 1 and sorted(r["place"] for r in held) == list(range(len(held)))
        assert len(held) == cap or (len(held) < cap and b == last[held[0]["bucket"]])
    tops = sorted({r["n_tokens"] for r in out})
    if len(tops) <= 40:
        bins = [(t, sum(r["n_tokens"] == t for r in out), t * sum(r["n_tokens"] == t for r in out)) for t in tops]
        best = min(padding(bins, [*c, tops[-1]]) for k in range(min(buckets, len(tops), 4)) for c in combinations(tops[:-1], k))
        assert sum(r["padding"] for r in out) <= best


def test_documents(documents):
    rows = [tuple(r) for r in documents.collect()]
    check(packing.pack(documents, 16, 16_384).collect(), rows, 16, 16_384)


def test_edge_documents(edge_docs, edge_rows):
    check(packing.pack(edge_docs, 3, 100).collect(), edge_rows, 3, 100)


def test_no_documents(no_docs):
    assert packing.pack(no_docs).count() == 0


def test_bins_are_exact_then_bounded(spark):
    from pyspark.sql import functions as F
    n = [0, 1, 4095, 4096, 4097, 8191, 8192, 8193, 16383, 16384, 10**9, 10**12]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in n], "n long").select(packing.length_bin(F.col("n"))).collect()]
    assert got == sorted(got) and got[:6] == n[:6] and got[6] == got[7] == 8192 and got[-1] < 40 * 4096


def test_long_lengths_are_not_merged(spark, monkeypatch):
    rows = [(i, "w " * n) for i, n in enumerate([8192, 8193, 20, 30_001, 30_000, 30_002])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack(docs, 6).collect()
    check(out, rows, 6, 16_384)
    assert sum(r["padding"] for r in out) == 0 and len({r["bucket"] for r in out}) == 6
    monkeypatch.setattr(packing, "MOST", 5)                 # beyond the bound lengths share bins
    out = packing.pack(docs, 6).collect()
    assert len(out) == 6 and 0 < sum(r["padding"] for r in out) < 30


def test_rows_without_id_spread_over_the_ranges(spark):
    """75% of all rows have no id and one length; no range of the order holds them all."""
    from pyspark.sql import functions as F

    from fleetvolt.llm import common
    rows = spark.range(40_000).selectExpr("CASE WHEN id % 4 = 0 THEN id END AS doc_id", "5L AS size")
    placed = common.stored(rows.withColumn("h", F.xxhash64("doc_id", "size", F.lit(5), common.unnamed_row("doc_id"))), "t")
    blocks = placed.groupBy(F.floor(common.hash_place("h") * 40).alias("b")).count().collect()
    sizes = sorted(r["count"] for r in blocks)
    assert len(sizes) == 40 and sizes[-1] <= 1.5 * sizes[20]
    same = placed.where("doc_id IS NOT NULL AND h != xxhash64(doc_id, size, 5, CAST(NULL AS BIGINT))").count()
    assert same == 0                       # rows with an id keep their place on every layout


def test_boundaries_are_optimal_among_more_lengths_than_any_bound(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(packing, "word_count", lambda text: text.cast("long"))     # lengths without their words
    top = (1 << 19) + 11                                                            # lengths 0 to top, once each
    docs = spark.range(top + 1).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    out = packing.pack(docs, 2, 10**9)
    assert [r[0] for r in out.select("pad_to").distinct().orderBy("pad_to").collect()] == [(top - 1) // 2, top]
