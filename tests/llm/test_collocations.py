import re
from collections import Counter
from decimal import Decimal

import duckdb
import numpy as np
import pyarrow as pa

from fleetvolt.llm import collocations as C
from fleetvolt.llm import oracle

LOWER = {c: c + 32 for c in range(65, 91)}
COLS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, least=30, share=80, first=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    inside = set()
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * a >= share * cand[lang, w[i:i + k]]:
                    inside.add((lang, w[i:i + k]))
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in inside:
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            phrase = " ".join(w)
            out.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p, -a, l, r, n[lang], -s) for lang, x in out.items()
                  for i, (s, a, _, p, l, r) in enumerate(sorted(x)[:first]))


def got(df, **kw):
    return sorted(tuple(r[c] for c in COLS) for r in C.collocations(df, **kw).collect())


def test_edge_texts(spark):
    rows = [("en", "New York, new YORK. new york city; the city of new york"), (None, "a b c d a b c d"), ("und", "A b c d"),
            ("en", None), ("en", ""), ("en", " \t \n"), ("fr", "É\tét É  ét é"), ("fr", "É ét\rÉ ét\x0bÉ ét\x0c!?É ét"),
            ("", "x x x x x"), ("en", "one two\x00three one two\x00three"), ("de", "\U0001f600 z \U0001f600 z ｚ z ｚ z")]
    df = spark.createDataFrame([(1, *r, 5, "x") for r in rows] * 3, "doc_id long, lang string, text string, f long, fp string")
    assert got(df, least=3) == brute(rows * 3, least=3)
    assert got(df, least=2, share=50, first=4) == brute(rows * 3, least=2, share=50, first=4)


def test_random_texts_and_a_long_one(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "straße", "x."]
    rows = [("en" if i % 3 else None, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(200)]
    rows.append(("en", " ".join(rng.choice(vocabulary, 700_000))))          # several spans
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    assert got(df) == brute(rows)


def test_one_text_makes_up_most_rows(spark):
    rows = [("en", "red green blue red green blue dark red")] * 300 + [("en", f"red green word{i % 7}") for i in range(100)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    assert got(df) == brute(rows)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "lang string, text string")) == []


def test_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.execute(f"SELECT {', '.join(COLS)} FROM ({oracle.OP12})").fetchall())
    assert want and got(spark.read.parquet(f"{sf}/documents.parquet")) == want


def test_colliding_fingerprints_are_told_apart_on_the_text(monkeypatch):
    """With a first fingerprint of four bits nearly all runs collide."""
    real = C._Base.runs

    def weak(self, words, size, begin=None):
        out = real(self, words, size, begin)
        return out & np.uint64(15) if self.weak else out

    monkeypatch.setattr(C._Base, "weak", False, raising=False)
    monkeypatch.setattr(C._Base, "runs", weak)
    make = C.Cutter.__init__

    def init(self):
        make(self)
        self.one.weak = True

    monkeypatch.setattr(C.Cutter, "__init__", init)
    text = "a b a c b a d e f g h i j k l m n o p a b"
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text]), pa.array([7], pa.int32())], names=["lang", "text", "ptr"])
    runs = pa.Table.from_batches(list(C._count((1,), 0, None)([batch]))).to_pylist()
    assert len({r["fp"] for r in runs}) < len({(r["fp"], r["chk"]) for r in runs}) == 17        # with the empty run
    asked = pa.RecordBatch.from_arrays(
        [pa.array(["en"]), pa.array([text]), pa.array([[{"fp": r["fp"], "chk": r["chk"]} for r in runs]])], names=["lang", "text", "wanted"])
    names = {(r["fp"], r["chk"]): r["phrase"] for b in C._cut_out([asked]) for r in b.to_pylist()}
    found = Counter()
    for r in runs:
        found[names[r["fp"], r["chk"]]] += r["f"]
    assert found == Counter(text.split()) + Counter({'': len(text.split())})


def test_products_beyond_64_bits(spark):
    a, l, r = 9_000_000_000_000_000, 9_100_000_000_000_000, 9_200_000_000_000_001
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    score = df.selectExpr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r) AS s").first()["s"]
    assert score == 2_000_000 * a // (l + r) and int(Decimal(score)) == score
