import re
from collections import defaultdict

from fleetvolt.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(3, 1, 2), factor=1.5, most=2.0):
    """The resharing rule, step by step."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, active = {s: 0.0 for s in names}, factor * sum(sizes.values()), set(names)
    while left > 1e-9 and active:
        total = sum(weight[s] for s in active)
        share = {s: left * weight[s] / total for s in active}
        over = {s for s in active if target[s] + share[s] > most * sizes[s] + 1e-9}
        if not over:
            for s in active:
                target[s] += share[s]
            break
        # those above stop at their cap, and the others share anew what is left
        for s in over:
            target[s] = most * sizes[s]
        active -= over
        left = factor * sum(sizes.values()) - sum(target[s] for s in names if s not in active)
    return target


def check(out, rows, block=128):
    size_of = [len(WORD.findall(r[1] or "")) for r in rows]
    assert sorted(((r["doc_id"], r["size"]) for r in out), key=str) == sorted(zip((r[0] for r in rows), size_of), key=str)
    sizes = defaultdict(int)
    for r, n in zip(rows, size_of):
        sizes[r[3]] += n
    want = targets(dict(sizes))
    by_target = defaultdict(lambda: [0, set()])
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        key = (r["source_size"], round(r["target"], 6))
        by_target[key][0] += r["taken"]
    for s, n in sizes.items():
        same = [x for x in sizes if (sizes[x], round(want[x], 6)) == (n, round(want[s], 6))]
        near = [k for k in by_target if k[0] == n and abs(k[1] - want[s]) < 1e-3]
        assert near, (s, n, want[s], list(by_target))
        assert abs(by_target[near[0]][0] - len(same) * want[s]) <= 2 * block * len(same) + 2


def test_documents(documents):
    out = mixing.mix(documents)
    first = sorted(tuple(r) for r in out.collect())
    check(out.collect(), [tuple(r) for r in documents.collect()])
    assert sorted(tuple(r) for r in mixing.mix(documents.repartition(5)).collect()) == first


def test_edge_documents(edge_docs, edge_rows):
    check(mixing.mix(edge_docs).collect(), edge_rows)


def test_no_documents(no_docs):
    assert mixing.mix(no_docs).count() == 0


def test_texts_without_words(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in mixing.mix(df).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_schedule_is_even_over_time(spark, documents):
    rows = documents.select("source", mixing.word_count(documents["text"]).alias("size"))
    sources, slots = mixing.schedule(mixing.source_targets(rows), 32)
    got = slots.collect()
    assert len({r["t"] for r in got}) == len(got)
    need = {r["number"]: r["slots"] for r in sources.collect()}
    per = defaultdict(list)
    for r in got:
        per[r["number"]].append((r["t"], r["rank"], r["block"], r["blocks"]))
    end = max(r["t"] for r in got) + 1
    for s, held in per.items():
        held.sort()
        assert [h[1] for h in held] == list(range(len(held))) and all(h[2] == h[1] % h[3] for h in held)
        assert abs(len(held) - need[s]) <= 1
        early = sum(t < end / 2 for t, *_ in held)
        assert abs(early - len(held) / 2) <= 4


def test_words_taken_of_each_document(spark, documents):
    """The whole method once more in plain Python: schedule, ranks, blocks and the words of each document in them."""
    import math

    from pyspark.sql import functions as F
    rows = [(r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in documents.collect()]
    hashes = {r["doc_id"]: r["h"] for r in spark.createDataFrame([(i, n) for i, _, n in rows], "doc_id long, size long").select(
        "doc_id", F.xxhash64("doc_id", "size", F.lit(3), F.lit(None).cast("long")).alias("h")).collect()}
    sizes = defaultdict(int)
    for _, source, n in rows:
        sizes[source] += n
    target = targets(dict(sizes))
    names = sorted((x for x in sizes if x is not None), key=lambda x: [ord(c) for c in x]) + [None] * (None in sizes)
    plan, low = {}, 0.0
    for name in names:
        n = sizes[name]
        length = max(math.ceil(n / max(math.ceil(n / 128), 1)), 1)
        blocks = max(math.ceil(n / length), 1)
        slots = target[name] * blocks / n if n else 0.0
        plan[name] = (length, blocks, math.ceil(low - 0.5), math.ceil(low + slots - 0.5))
        low += slots
    bits = math.ceil(math.log2(max(low + 1, 2)))
    want = {}
    for name in names:
        length, blocks, first, end = plan[name]
        times = [0] * blocks
        turns = sorted(int(format(i, f"0{bits}b")[::-1], 2) for i in range(first, end))
        for rank in range(min(len(turns), 2 * blocks)):
            times[rank % blocks] += 1
        at = 0
        for i, _, n in sorted((r for r in rows if r[1] == name), key=lambda r: (hashes[r[0]], r[0], r[2])):
            want[i] = sum(times[w // length] for w in range(at, at + n))
            at += n
    assert {r["doc_id"]: r["taken"] for r in mixing.mix(documents).collect()} == want
