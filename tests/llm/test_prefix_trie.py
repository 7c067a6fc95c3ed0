import hashlib
import math
import zlib

import duckdb
import numpy as np

from fleetvolt.llm import oracle
from fleetvolt.llm import prefix_trie as T

COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, md5(md5(role or "") + md5(text or "")), role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        made[c] = tuple(turns.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    kids = {}
    for seq in nodes:
        if seq:
            kids.setdefault(seq[:-1], []).append(seq)

    def totals(seq):
        own = (len(nodes[seq]) - 1) * (len(seq[-1][1].encode()) if seq else 0)
        below = [totals(k) for k in kids.get(seq, [])]
        return (sum(x[0] for x in below) or 1, own + sum(x[1] for x in below))

    out = []
    for seq, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(made[c]) == len(seq))
        out.append((min(members), len(seq), min(nodes[seq[:-1]]) if seq else None, len(members), len(kids.get(seq, [])), *totals(seq),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in T.prefix_trie(df).collect()), key=str)


def test_products_compose():
    rng = np.random.default_rng(3)
    e = rng.integers(0, T.PRIME, 500, dtype=np.uint64)
    e[:3] = T.PRIME - 1
    starts = np.array([0, 1, 7, 300])
    for base in T.bases(0):
        h, p = T.products(starts, e, base)
        for a, b in zip(starts, [*starts[1:], 500]):
            x, y = 0, 1
            for k in range(a, b):
                x, y = (x * base + int(e[k])) % T.PRIME, y * base % T.PRIME
                assert (int(h[k]), int(p[k])) == (x, y)


def test_families_ties_and_nulls(spark):
    rng = np.random.default_rng(2)
    words = ["hi", "", "hallo", "grüße", None, "x" * 40]
    rows = []
    for c in [*range(0, 60), *range(-25, 0), 7_000_000_001, 7_000_000_000, 123]:
        if c in (15, 20, -10):
            continue                                       # bases that are not there
        for t in range(int(rng.integers(1, 12))):
            rows.append((c, None if rng.random() < 0.2 else int(rng.integers(0, 6)), str(rng.choice(["user", "assistant"])) if rng.random() < 0.9 else None,
                         words[int(rng.integers(0, 6))]))
    rows += [(None, 0, "user", "nobody"), (0, 0, None, None), (0, 0, None, None), (5, None, "", None)] + rows[:20]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", depth int, f1 string")
    assert got(df) == brute(rows)


def test_one_conversation_over_many_ranges(spark):
    """A third of all turns are one conversation, half of them one repeated turn without a number."""
    rows = [(10, i if i % 2 else None, "user", f"t{i}" if i % 2 else "same") for i in range(600)]
    rows += [(11, i if i % 2 else None, "user", f"t{i}" if i % 2 else "same") for i in range(600)]
    rows += [(c, t, "user", f"{t}") for c in range(100, 300) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(12)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(df) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_equal_first_turn_and_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 2)
    rows = [(c, t, "user", "hello" if t < 2 else f"{c % 3} {t}") for c in range(0, 800) for t in range(11)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute(rows)


def test_colliding_fingerprints_start_anew(spark, monkeypatch):
    """With a base of 0 or 1 different sequences share fingerprints; the check on the texts must see it."""
    real = T.bases
    tried = []

    def weak(attempt):
        tried.append(attempt)
        return (1, 1) if attempt == 0 else real(attempt)

    monkeypatch.setattr(T, "bases", weak)
    rows = [(c, t, "user", ("ab" if c % 2 else "ba")[t % 2]) for c in range(1, 12) for t in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute(rows)
    assert 1 in tried


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    want = sorted(con.execute(f"SELECT {', '.join(COLS)} FROM ({oracle.OP13})").fetchall(), key=str)
    assert want and got(spark.read.parquet(f"{sf}/conversations.parquet")) == want
