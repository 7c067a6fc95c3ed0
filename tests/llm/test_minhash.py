import re

import duckdb
import pytest

from fleetvolt.llm import minhash, oracle
from fleetvolt.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(doc_id, n_shingles, component, kept) by all pairs."""
    sets = [shingle_set(r[1]) for r in rows]
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(rows[i][0]), find(rows[j][0])
                parent[max(x, y)] = min(x, y)
    out = []
    for r, s in zip(rows, sets):
        c = None if r[0] is None else find(r[0])
        out.append((r[0], len(s), c, r[0] == c))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_edge_cases_as_brute_force(edge_docs, edge_rows):
    assert got(minhash.near_duplicates(edge_docs)[0]) == brute(edge_rows)


def test_small_tables_as_sql(spark, documents, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(f"SELECT doc_id, n_shingles, component_id, kept FROM ({oracle.OP8})").fetchall()
    assert got(minhash.near_duplicates(documents)[0]) == sorted(want, key=str)


def test_no_documents(no_docs):
    out, links = minhash.near_duplicates(no_docs)
    assert out.count() == 0 and links.count() == 0


def test_group_of_near_copies_and_near_misses(spark):
    """One large group around a text, and texts that are similar to all of it, but not enough."""
    base = [f"word{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 60):
        text = list(base)
        text[k] = f"new{k}"
        rows.append((k, " ".join(text)))
    for k in range(60, 90):           # a chain of edits: linked to neighbours only
        text = list(base)
        for j in range(10, 10 + (k - 59) * 3, 3):
            text[j] = f"edit{j}"
        rows.append((k, " ".join(text)))
    for k in range(90, 120):          # far from each other and from the group
        rows.append((k, " ".join(base[:60] + [f"far{k}x{j}" for j in range(60)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minhash.near_duplicates(df)[0]) == brute(rows)


def test_blocks_split_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    test_group_of_near_copies_and_near_misses(spark)


@pytest.mark.parametrize("links,want", [
    ([], {}),
    ([(1, 2), (2, 3), (5, 4)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}),
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([(7, 7), (None, 3), (9, 100), (100, 9), (9, 50), (50, 2)], {2: 2, 9: 2, 50: 2, 100: 2}),
])
def test_components(spark, links, want):
    df = spark.createDataFrame(links, "u long, v long")
    assert {r["node"]: r["component"] for r in components(df).collect()} == want


def test_a_hub_with_many_unlike_partners(spark, monkeypatch):
    """Near copies of one text that differ from each other: one hub, many blocks; with and without the broadcast."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for k in range(3):
            words[(i * 7 + k * 40) % 120] = f"x{i}_{k}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, f"alone {i} " + " ".join(f"q{i}_{k}" for k in range(20))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "BLOCK", 8)
    want = {r[0]: r[2] for r in brute(rows)}
    for few in (200_000, 0):
        monkeypatch.setattr(minhash, "FEW", few)
        assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df)[0].collect()} == want
