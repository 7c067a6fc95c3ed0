import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fleetvolt.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": n < 50 or 100 * len(covered) > 50 * n, "n_lines": len(lines),
            "n_capitals": sum("A" <= c <= "Z" for c in text), "n_marks": sum(c in "!?" for c in text)}


def cells(m):
    def cell(x):
        return min(int(x * quality.CELLS), quality.CELLS - 1)
    words, chars = max(m["n_words"], 1), max(m["word_chars"], 1)
    mean = m["word_chars"] / words
    return [cell(min(m["n_symbols"] / words, 1.0)), cell(m["n_dup_lines"] / max(m["n_lines"], 1)), cell(m["n_repeat_words"] / words),
            cell(m["n_capitals"] / chars), cell(min(m["n_marks"] / words, 1.0)), cell(min(mean / 100, 1.0)), cell(1 / max(mean, 1.0))]


def tail(n, k, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p))
               for j in range(k + 1))


def brute_cutoffs(rows, risk, delta):
    """rows: (id, stratum, good, cells)."""
    tune, hold = defaultdict(list), defaultdict(list)
    for i, s, good, c in rows:
        (hold if zlib.crc32(f"holdout:{i}".encode()) % 3 else tune)[s].append((good, c))
    strata = [s for s in tune if any(g for g, _ in tune[s])]
    out = {}
    for s in strata:
        good, poor = ([c for g, c in tune[s] if g == side] for side in (True, False))
        plans = []
        for share in quality.TAILS:
            cut = []
            for rule in range(len(quality.RULES)):
                values = [c[rule] for c in good]
                t = min(v for v in {c[rule] for c in good + poor} if sum(x > v for x in values) <= share * len(values))
                caught, lost = sum(c[rule] > t for c in poor), sum(x > t for x in values)
                cut.append(t if caught * len(good) > lost * len(poor) else quality.CELLS)
            plans.append(cut)
        best = None
        for at, cut in enumerate(plans):
            def bad(c, cut=cut):
                return any(x > t for x, t in zip(c, cut))
            held = [c for g, c in hold[s] if g]
            k, n = sum(map(bad, held)), len(held)
            if k > n * risk or tail(n, k, risk) > delta / len(strata):
                break
            bads = [c for g, c in tune[s] if not g]
            gain = sum(map(bad, bads)) / max(len(bads), 1) - sum(map(bad, good)) / max(len(good), 1)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, cut)
        if best:
            out[s] = best[1]
    return out


def brute(rows, labels, risk, delta):
    """doc_id, measures, kept of every row."""
    known = defaultdict(list)
    for i, q in labels:
        if i is not None and q is not None:
            known[i].append(q)
    facts = [(r, base(r[1])) for r in rows]
    learnt = [(r[0], r[2], min(known[r[0]]) == 1, cells(m)) for r, m in facts if r[0] in known and not m["base_failed"]]
    cuts = brute_cutoffs(learnt, risk, delta)
    out = []
    for r, m in facts:
        cut = cuts.get(r[2])
        worse = cut is not None and any(c > t for c, t in zip(cells(m), cut))
        out.append((r[0], *(m[c] for c in quality.MEASURES), m["base_failed"], not m["base_failed"] and not worse))
    return sorted(out, key=str), cuts


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", *quality.MEASURES, "base_failed", "kept").collect()), key=str)


def test_documents(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows, lab = [tuple(r) for r in docs.collect()], [(r["doc_id"], r["quality"]) for r in labels.collect()]
    want, cuts = brute(rows, lab, 0.05, 0.05)
    assert got(quality.quality_report(docs, labels, 0.05, 0.05)) == want
    assert cuts


def test_cutoffs_reject_junk_and_spare_good_documents(spark):
    rows, labels = [], []
    for i in range(1500):
        words = [f"w{(i * 31 + j * 7) % 997}" for j in range(60 + i % 40)]
        junk = i % 10 == 3
        rows.append((i, " ".join(w + "###" if junk else w for w in words), "en" if i % 3 else None, "s", 1))
        labels.append((i, int(not junk)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    want, cuts = brute(rows, labels, 0.03, 0.05)
    found = got(quality.quality_report(docs, lab, 0.03, 0.05))
    assert found == want and set(cuts) == {"en", None}
    good = {i for i, q in labels if q}
    assert all(r[-1] == (r[0] in good) for r in found)
    kept = quality.keep_good(docs, lab, 0.03, 0.05)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == good


def test_edge_documents(spark, edge_docs, edge_rows):
    labels = [(1, 1), (1, 0), (3, 1), (None, 1), (9, None), (10, 0), (99, 1)]
    lab = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int")
    want, _ = brute(edge_rows, labels, 0.02, 0.05)
    assert got(quality.quality_report(edge_docs, lab)) == want
    kept = quality.keep_good(edge_docs, lab)
    assert kept.columns == edge_docs.columns and kept.where("m_kept != 1 OR kept != true").count() == 0
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((w[0] for w in want if w[-1]), key=str)


def test_nothing_to_do(spark, no_docs, edge_docs, edge_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality_report(no_docs, none).count() == 0
    assert got(quality.quality_report(edge_docs, none)) == brute(edge_rows, [], 0.02, 0.05)[0]


def test_repeated_windows(spark):
    texts = ["a b c a b c", "a a a a", "a b c d a b c e b c d", "x y", "", None, "p q r s p q", "\x1c a\x0bb\x0cc\x0da b c"] + [
        " ".join("abcde"[(i * i + i // 7) % 5] for i in range(n)) for n in (3, 10, 200)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in quality.measures(df).collect()}
    for i, t in enumerate(texts):
        want = base(t)
        assert {k: out[i][f"m_{k}"] for k in want} == want, t


@pytest.mark.parametrize("n,k,p", [(1, 0, 0.02), (50, 1, 0.05), (300, 2, 0.02), (5000, 80, 0.02), (100_000, 1900, 0.02), (20, 20, 0.5)])
def test_binomial_tail(spark, n, k, p):
    v = spark.range(1).select(quality.binomial_tail(F.lit(n), F.lit(k), p)).first()[0]
    want = 1.0 if k > n * p else tail(n, k, p)
    assert abs(v - want) <= 1e-8 * max(want, 1e-30) + 1e-300
