import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fleetvolt.llm import toxicity


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def corpus(n=900, seed=3):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(300)]
    bad = ["vile", "rotten", "awful"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choice(vocab, rng.integers(5, 120)).tolist()
        toxic = i % 6 == 0
        if toxic:
            for w in rng.choice(bad, 2):
                words.insert(int(rng.integers(0, len(words) + 1)), str(w).title() + ",")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    truth = {i: t for i, _, t in labels}
    assert len(out) == len(rows)
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if is_held_out(i)}
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert right / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = corpus(240)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, q, 1 - t if is_held_out(i) else t) for i, q, t in labels]
    a, b = (sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(
        docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()) for x in (labels, turned))
    assert a == b


def test_edge_documents(spark, edge_docs, edge_rows):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (4, 1, 1), (None, 1, 1), (9, 1, None), (10, 1, 0), (12, None, 0), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(edge_docs, labels).collect()
    assert sorted((r["doc_id"] for r in out), key=str) == sorted((r[0] for r in edge_rows), key=str)
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in out)
    kept = toxicity.drop_toxic(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.where("score != 0.5").count() == 0


def test_nothing_to_learn_from(spark, no_docs, edge_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(no_docs, none).count() == 0
    assert {r["score"] for r in toxicity.toxicity(edge_docs, none).collect()} == {0.5}


def test_features_by_hand():
    hasher = toxicity._hasher()
    found = toxicity.features(pa.array(["Ab, cd ab", "AB cd ab!", None, "", "ab", "cd ab"]), hasher)
    assert found[0].tolist() == found[1].tolist() and len(found[0]) == 1 + 2 + 2 + 1
    assert found[2].tolist() == found[3].tolist() == [0]
    assert set(found[4]) < set(found[0]) and set(found[5]) < set(found[0])


def test_scores_add_the_weights_of_distinct_features(spark):
    hasher = toxicity._hasher()
    texts = ["ab cd ab cd", "ab", None, "zz " * 5000]
    found = toxicity.features(pa.array(texts), hasher)
    places = np.unique(np.concatenate(found))
    weights = np.linspace(-1, 1, len(places))
    out = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), (places, weights)).orderBy("doc_id").collect()
    at = dict(zip(places.tolist(), weights))
    for r, f in zip(out, found):
        assert abs(r["score"] - 1 / (1 + np.exp(-sum(at[p] for p in f.tolist())))) < 1e-9
    assert out[0]["score"] == toxicity.score(spark.createDataFrame([(0, texts[0])], "doc_id long, text string").where(F.lit(True)), (places, weights)).first()["score"]


def test_groups_are_tasks_of_their_own(spark):
    rows = spark.createDataFrame([(i % 2, i) for i in range(40)], "group int, turn long")
    held = toxicity._dealt(rows).groupBy(F.spark_partition_id().alias("p")).agg(F.collect_set("group").alias("g")).collect()
    assert sorted(r["g"] for r in held) == [[0], [1]]


def test_states_of_the_groups_are_averaged(spark):
    rows, labels = corpus(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turn = F.xxhash64("doc_id", F.lit(17))
    order = docs.select("doc_id", turn.alias("t"), F.pmod(turn, F.lit(toxicity.SHARDS)).alias("g")).orderBy("t").collect()
    found = dict(zip((r[0] for r in rows), toxicity.features(pa.array([r[1] for r in rows]), toxicity._hasher())))
    truth = {i: t for i, _, t in labels}
    z, n = np.zeros(1 << toxicity.BITS), np.zeros(1 << toxicity.BITS)
    for _ in range(toxicity.ROUNDS):
        changes = []
        for group in range(toxicity.SHARDS):
            z1, n1 = z.copy(), n.copy()
            for r in (r for r in order if r["g"] == group):
                at = found[r["doc_id"]]
                w = toxicity._weights(z1, n1, at)
                g = toxicity._sigmoid(w.sum()) - truth[r["doc_id"]]
                z1[at] += g - (np.sqrt(n1[at] + g * g) - np.sqrt(n1[at])) / toxicity.ALPHA * w
                n1[at] += g * g
            changes.append((z1 - z, n1 - n))
        touched = np.maximum(sum((dn != 0).astype(int) for _, dn in changes), 1)
        z, n = z + sum(dz for dz, _ in changes) / touched, n + sum(dn for _, dn in changes) / touched
    want = toxicity._weights(z, n, np.arange(1 << toxicity.BITS))
    places, weights = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = np.zeros(1 << toxicity.BITS)
    got[places] = weights
    assert np.allclose(got, want, atol=1e-9)
