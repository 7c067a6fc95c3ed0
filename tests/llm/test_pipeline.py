from collections import Counter

import pytest

import corpus_pipeline as P
from fleetvolt.llm import mixing, toxicity

from . import test_minhash, test_packing, test_quality


def test_run_as_brute_force(spark, sf, documents):
    """Each stage's decisions against a brute-force version of it over what the stage before kept."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    lab = [(r["doc_id"], r["quality"]) for r in labels.collect()]
    stages, docs = dict(P.STAGES), documents

    predicted = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, labels).collect()}
    clean = P.stored(stages["toxicity"](spark, docs, sf), "t")
    rows = [tuple(r) for r in clean.collect()]
    assert {r[0] for r in rows} == {i for i, p in predicted.items() if not p}

    good = P.stored(stages["quality_rules"](spark, clean, sf), "t")
    want, _ = test_quality.brute(rows, lab, 0.02, 0.05)
    rows = [tuple(r) for r in good.collect()]
    assert {r[0] for r in rows} == {w[0] for w in want if w[-1]} and rows

    single = P.stored(stages["near_dedup"](spark, good, sf), "t")
    want = {w[0] for w in test_minhash.brute(rows) if w[-1]}
    rows = [tuple(r) for r in single.collect()]
    assert sorted(r[0] for r in rows) == sorted(want)

    mixed = P.stored(stages["mix_sources"](spark, single, sf), "t")
    times = {r["doc_id"]: int(r["taken"] / max(r["size"], 1) + 0.5) for r in mixing.mix(single).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in times.items() if n})
    by_id = {r[0]: r for r in rows}
    assert all(tuple(r) == by_id[r["doc_id"]] for r in mixed.collect())

    rows = [tuple(r) for r in mixed.collect()]
    test_packing.check(stages["packing"](spark, mixed, sf).collect(), rows, 16, 16_384)
    assert P.run(spark, sf).count() == len(rows)


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_take_edge_cases(spark, sf, edge_docs, no_docs, name):
    stage = dict(P.STAGES)[name]
    out = stage(spark, edge_docs, sf)
    if name != P.STAGES[-1][0]:
        assert out.columns == edge_docs.columns
        known = {tuple(map(str, r)) for r in edge_docs.collect()}
        assert {tuple(map(str, r)) for r in out.collect()} <= known
    else:
        assert out.count() == edge_docs.count()
    assert stage(spark, no_docs, sf).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_take_odd_column_names(spark, sf, documents, name):
    names = ["Score", "a.b", "M_Row", "with `ticks`", "row", "kept"]
    docs = documents.selectExpr("*", *(f"{i} AS `{c.replace('`', '``')}`" for i, c in enumerate(names)))
    out = dict(P.STAGES)[name](spark, docs, sf)
    assert out.count() > 0
    if name != P.STAGES[-1][0]:
        assert out.columns == docs.columns


def test_near_dedup_keeps_one_row_of_a_group(spark, sf, edge_docs):
    ids = [r["doc_id"] for r in P.near_dedup(spark, edge_docs, sf).collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 9, 10, 12, 13] and ids.count(None) == 2


def test_toxic_words_go_and_clean_documents_stay(spark, sf):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append((i, f"some plain words number {i % 7} " + ("vile rotten " if toxic else "kind gentle "), "en", "s", 1))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, lab).collect()}
    assert kept == {i for i, t in labels if not t}


def test_near_dedup_of_repeated_and_missing_ids(spark, sf):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near_a = a.replace("a30", "other")
    rows = [(5, near_a, "en"), (5, b, "en"), (3, a, "en"), (3, a, "de"), (9, c, "en"), (9, c.upper(), "en"), (9, None, "en"),
            (None, a, "en"), (None, a, "en"), (None, b, "en"), (None, None, "en"), (None, None, "en")]
    results = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts)
        results.append(sorted((tuple(r) for r in P.near_dedup(spark, docs, sf).collect()), key=str))
    assert results[0] == results[1]
    got = [(i, t.lower() if t else t) for i, t, _ in results[0]]
    assert sorted(got, key=str) == sorted([(5, b), (3, a), (9, c), (9, None), (None, a), (None, b), (None, None)], key=str)
