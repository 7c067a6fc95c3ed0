"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its words, its pairs of neighbouring words and its pairs of words with one or two
words between (order kept), hashed into ``2**BITS`` places; a feature is there or not. Words are runs of
letters and digits, lower-cased in A-Z. Training is FTRL-proximal: every coordinate has its own rate,
which falls with the gradients it has seen, and an L1 term holds coordinates at exactly zero until
their evidence outweighs it. What is not zero is a short list of (place, weight), bounded by the number
of places, and is broadcast for scoring.

The classifier is fitted on at most ``SAMPLE`` labelled rows, those with the smallest hash of doc_id,
dealt over ``SHARDS`` groups. In every round each group runs FTRL once over its rows (a few
thousand, a bounded task) from the common state, and the groups' changes of state are averaged over
the groups that touched a coordinate. The state is a stored table of at most ``2**BITS`` touched places that the
tasks read; only the weights that are not zero come to the driver. Scores cover whole texts of all rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt.llm.common import bounded_batches, drop_stored, free_name, quoted, stored, whole_row
from fleetvolt.llm.wordhash import WordHasher, mix, separators

BITS = 20
SAMPLE = 20_000
SHARDS = 2
#: Chosen by three folds of the training rows (README has the figures).
ROUNDS = 2
ALPHA, BETA, L1, L2 = 5.0, 1.0, 3.0, 0.0
_BIAS = 0                     # this place belongs to the bias alone
_LETTERS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def _hasher() -> WordHasher:
    return WordHasher(separators(bytes(b for b in range(128) if b not in _LETTERS)))


def _places(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, text) of every feature occurrence."""
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    places, texts = [words], [text]
    for gap in (1, 2, 3):
        if len(words) > gap:
            same = text[gap:] == text[:-gap]
            pair = words[:-gap] * np.uint64(0x9E3779B97F4A7C15) + words[gap:] * np.uint64(2 * gap + 1)
            places.append(mix(pair[same] + np.uint64(gap)))
            texts.append(text[gap:][same])
    place = np.concatenate(places) >> np.uint64(64 - BITS)
    return np.maximum(place.astype(np.int64), 1), np.concatenate(texts)


def features(column: pa.Array, hasher: WordHasher) -> list[np.ndarray]:
    """The distinct places of each text, ascending; the bias is place 0."""
    words, at = hasher.words(column)
    place, text = _places(words, at)
    both = np.unique((text.astype(np.int64) << BITS) | place)
    cuts = np.searchsorted(both, np.arange(len(at), dtype=np.int64) << BITS)
    both &= (1 << BITS) - 1
    return [np.concatenate([[_BIAS], both[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]


def _weights(z: np.ndarray, n: np.ndarray, places) -> np.ndarray:
    """FTRL's closed form: zero up to L1, beyond it against the gradient sum. The bias has no L1."""
    zs = z[places]
    free = np.where(np.asarray(places) == _BIAS, 0.0, L1)
    w = -(zs - np.sign(zs) * free) / ((BETA + np.sqrt(n[places])) / ALPHA + L2)
    return np.where(np.abs(zs) > free, w, 0.0)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _squeezed(places: np.ndarray) -> bytes:
    """Ascending places as their differences, compressed: about a third of the bytes to shuffle."""
    return zlib.compress(np.diff(places, prepend=0).astype("<i4").tobytes(), 1)


def _places_of(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), "<i4"), dtype=np.int64)


def _train_rows(docs: DataFrame, labels: DataFrame, label: str, usable) -> DataFrame:
    """The bounded sample of labelled rows with their features and their group."""
    there = docs.select("doc_id").distinct()              # labels without a document use up no place
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
             .groupBy("doc_id").agg(F.max(label).alias("y")).join(there, "doc_id", "left_semi")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
             .select(F.col("doc_id").alias("of"), F.col("y").cast("int").alias("y")))
    # At most SAMPLE rows of two numbers: broadcast, so that the texts are not shuffled.
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("of"))

    def hashed(batches):
        hasher = _hasher()
        for batch in batches:
            found = features(batch.column("text"), hasher)
            yield pa.RecordBatch.from_arrays(
                [batch.column("group"), batch.column("turn"), batch.column("y"),
                 pa.array([_squeezed(f) for f in found], pa.binary())],
                names=["group", "turn", "y", "places"])

    bounded_batches(docs.sparkSession)
    turn = F.xxhash64("doc_id", F.lit(17))
    return stored(rows.select(F.pmod(turn, F.lit(SHARDS)).cast("int").alias("group"), turn.alias("turn"), "y", "text")
                  .mapInArrow(hashed, "group int, turn long, y int, places binary"), "train")


def _dealt(rows: DataFrame) -> DataFrame:
    """Each group in a task of its own (a hash of the few group numbers may put them in one), in its order."""
    return rows.repartitionById(SHARDS, "group").sortWithinPartitions("group", "turn")


_LEAST = -(1 << 63)
_ROW = "group int, turn long, y int, places binary, z binary, n binary"


def _packed(batches):
    """A batch of the state as one row for each group, which comes before the group's training rows."""
    for batch in batches:
        place, z, n = (batch.column(c).to_numpy() for c in ("place", "z", "n"))
        order = np.argsort(place)
        many = [SHARDS * [x] for x in (_squeezed(place[order]), z[order].tobytes(), n[order].tobytes())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SHARDS), pa.int32()), pa.array([_LEAST] * SHARDS, pa.int64()), pa.array([None] * SHARDS, pa.int32()),
             *(pa.array(x, pa.binary()) for x in many)], names=[c.split()[0] for c in _ROW.split(", ")])


def _learn(batches):
    """One pass of FTRL over each group's rows from the state that comes first; the changed places."""
    z0 = n0 = z1 = n1 = group = None

    def changed():
        touched = np.flatnonzero(n1 != n0)
        return pa.RecordBatch.from_arrays([pa.array(touched, pa.int64()), pa.array(z1[touched] - z0[touched]),
                                           pa.array(n1[touched] - n0[touched])], names=["place", "z", "n"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("group", "y")]
        for own, y, places, z, n in zip(*columns, *(batch.column(c) for c in ("places", "z", "n"))):
            if own != group:                           # every group starts from the common state
                if group is not None:
                    yield changed()
                z0, n0, z1, n1 = (np.zeros(1 << BITS) for _ in range(4))
                group = own
            at = _places_of(places.as_py())
            if y is None:
                z0[at] = z1[at] = np.frombuffer(z.as_buffer())
                n0[at] = n1[at] = np.frombuffer(n.as_buffer())
                continue
            w = _weights(z1, n1, at)
            g = _sigmoid(w.sum()) - y                  # features are 0 or 1
            s = (np.sqrt(n1[at] + g * g) - np.sqrt(n1[at])) / ALPHA
            z1[at] += g - s * w
            n1[at] += g * g
    if group is not None:
        yield changed()


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable=None) -> tuple[np.ndarray, np.ndarray]:
    """(places, weights) of the non-zero coordinates. ``usable`` restricts the label rows (a condition on
    their doc_id). Without any labelled row there are no coordinates and every score is a half."""
    spark = docs.sparkSession
    rows = _train_rows(docs, labels, label, F.lit(True) if usable is None else usable)
    none = F.lit(None).cast("binary")
    train = rows.select("*", none.alias("z"), none.alias("n"))
    state = None
    for _ in range(ROUNDS):
        both = train if state is None else train.unionByName(state.mapInArrow(_packed, _ROW))
        change = _dealt(both).mapInArrow(_learn, "place long, z double, n double").withColumn("new", F.lit(1))
        if state is not None:
            change = change.unionByName(state.withColumn("new", F.lit(0)))
        # The old state, and the average over the groups that touched the place.
        moved = [(F.sum(F.when(F.col("new") == 0, F.col(c)).otherwise(0.0))
                  + F.sum(F.when(F.col("new") == 1, F.col(c)).otherwise(0.0)) / F.greatest(F.sum("new"), F.lit(1))).alias(c) for c in ("z", "n")]
        after = stored(change.groupBy("place").agg(*moved), "state")
        if state is not None:
            drop_stored(state)
        state = after
    # FTRL's closed form again; L1 holds most of the at most 2**BITS places at zero.
    free = F.when(F.col("place") == _BIAS, F.lit(0.0)).otherwise(F.lit(L1))
    weight = F.when(F.abs("z") > free, -(F.col("z") - F.signum("z") * free) / ((BETA + F.sqrt("n")) / ALPHA + L2)).otherwise(0.0)
    found = state.select("place", weight.alias("w")).where("w != 0").toArrow()
    drop_stored(rows)
    drop_stored(state)
    places = found.column("place").to_numpy()
    order = np.argsort(places)
    return places[order], found.column("w").to_numpy()[order]


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], name: str = "score") -> DataFrame:
    """``docs`` with the score of the whole text (column text; null: empty) in a column ``name``."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model[0].astype(np.int64), model[1].astype(np.float64)))
    rows = docs.select(F.col("text").cast("string").alias("words_"), whole_row(docs).alias("row_"))
    schema = rows.drop("words_").withColumn("score_", F.lit(0.0)).schema

    def scores(batches):
        places, values = sent.value
        weight = np.zeros(1 << BITS)
        weight[places] = values
        hasher = _hasher()
        for batch in batches:
            words, at = hasher.words(batch.column("words_"))
            place, text = _places(words, at)
            held = weight[place] != 0
            both = np.unique((text[held].astype(np.int64) << BITS) | place[held])
            total = np.bincount(both >> BITS, weight[both & ((1 << BITS) - 1)], batch.num_rows)
            found = pa.array(_sigmoid(total + weight[_BIAS]))
            yield pa.RecordBatch.from_arrays([batch.column("row_"), found], names=["row_", "score_"])

    bounded_batches(spark)
    return rows.mapInArrow(scores, schema).select("row_.*", F.col("score_").alias(name))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Labels are learnt only from rows whose crc32 of the doc_id as text leaves no remainder of 1 by 3; the
    others are held out. A document labelled several times counts once, as toxic if any label says so.
    Null and empty texts get the score of a text without features. A null doc_id is not held out. Repeated
    rows score alike. Only doc_id and text are read. An empty table gives an empty result."""
    model = fit(docs.select("doc_id", "text"), labels, "toxic", ~held_out(F.col("doc_id")))
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns."""
    model = fit(docs.select("doc_id", "text"), labels, "toxic", ~held_out(F.col("doc_id")))
    name = free_name(docs, "score")
    return score(docs, model, name).where(F.col(quoted(name)) < threshold).drop(name)
