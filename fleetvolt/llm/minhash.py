"""Near-duplicates by circulant MinHash.

Two permutations make all signature coordinates. The first one spreads the shingles of a text over
the places of a ring; the second one gives every place a value. Coordinate k is the smallest value
found when the ring is turned by k places, so the coordinates of one shingle are a run of
neighbouring values of the ring.

1. One pass over the whole texts gives each row its number of shingles, a digest of its set, the
   band keys and a one-byte form of the signature. Texts are not shuffled for this.
2. Rows with equal sets become one node (its smallest doc_id), so copies cost one row.
3. The smallest node of a band bucket is its hub, and is compared with the others of all its buckets.
   A pair whose signatures agree in fewer than ``AGREE`` of the coordinates is passed over; the others
   are confirmed on the full sets that are rebuilt from the texts.
4. Connected components of the links. A hub whose partners are in one component by now needs no more
   work, however many they are; this is how large groups of copies avoid all their pairs. For the other
   hubs all pairs of partners from different components are compared (every pair that shares a bucket is
   among them), in blocks of about ``BLOCK`` nodes a side, so no hub is one task.
5. Connected components of all links.

What may be missed is a pair that no bucket holds, or whose signatures agree in too few places. At
the similarity of 0.75 with 32 bands of 4 rows the first has a chance of (1 - 0.75^4)^32 = 5e-6 and the
second of about 2e-7; both fall steeply above it. Every link that is returned is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt.llm.common import bounded_batches, drop_stored, stored
from fleetvolt.llm.components import components
from fleetvolt.llm.wordhash import WordHasher, mix, shingles

BANDS, ROWS = 32, 4
RING = 1 << 20
WIDTH = 5
#: Share of the coordinates in which the signatures of a pair must agree.
AGREE = 0.55
#: Nodes of a side of a block of pairs.
BLOCK = 256
#: Hubs that are broadcast.
FEW = 200_000

_SKETCH = "doc_id long, digest binary, n_shingles long, sig binary, keys array<long>"


class _Sketcher:
    """Signatures of shingle sets; the ring is made once per task."""

    def __init__(self, seed: int = 7):
        size = BANDS * ROWS
        ring = np.random.default_rng(seed).permutation(RING).astype(np.uint32)
        self.turned = np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[:size]]), size)
        self.shift = np.uint64(64 - (RING.bit_length() - 1))
        self.mult = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
        self.band = mix(np.arange(100, 100 + BANDS, dtype=np.uint64))

    def signature(self, numbers: np.ndarray) -> np.ndarray:
        places = (numbers * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        least = self.turned[places[:2048]].min(axis=0)
        for at in range(2048, len(places), 2048):
            least = np.minimum(least, self.turned[places[at:at + 2048]].min(axis=0))
        return least

    def keys(self, signatures: np.ndarray) -> np.ndarray:
        rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
        return mix((rows * self.mult).sum(axis=2, dtype=np.uint64) + self.band).view(np.int64)


def _sketch(batches):
    hasher, sketcher = WordHasher(), _Sketcher()
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()),
                        ("sig", pa.binary()), ("keys", pa.list_(pa.int64()))])
    for batch in batches:
        numbers, at = shingles(*hasher.words(batch.column("text")), WIDTH)
        digests, sizes, signatures = [], [], []
        for a, b in zip(at[:-1], at[1:]):
            if a == b:
                digests.append(None)
                sizes.append(0)
                continue
            own = np.unique(numbers[a:b])
            sizes.append(len(own))
            digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            signatures.append(sketcher.signature(own))
        signed = np.array(signatures, np.uint32).reshape(len(signatures), BANDS * ROWS)
        small, keys, k = (signed & 0xFF).astype(np.uint8), sketcher.keys(signed), 0
        sigs, bands = [], []
        for d in digests:
            sigs.append(None if d is None else small[k].tobytes())
            bands.append(None if d is None else keys[k])
            k += d is not None
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], schema=schema)


def sketches(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest of the shingle set (null without words),
    n_shingles, one-byte signature, band keys."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sketch, _SKETCH)


# -- exact confirmation in blocks ------------------------------------------------------------------

def _agreeing(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(n, BANDS * ROWS)


def _groups(batches, key: str):
    """Tables of the rows of one value of ``key``; the rows come sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(col[1:] != col[:-1]) + 1).tolist(), len(col)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and held[0].column(key)[0].as_py() != col[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _wanted(table: pa.Table) -> list[tuple[int, np.ndarray]]:
    """For the rows of one task: (row, rows it must be compared with). ``mode`` 0 compares the hub
    (side 0) with the others; 1 compares all of side 0 among themselves, 2 side 0 with side 1."""
    n = table.num_rows
    node, comp, size = (table.column(c).to_numpy() for c in ("node", "comp", "n"))
    side, mode = table.column("side").to_numpy(), int(table.column("mode")[0].as_py())
    sig = _agreeing(table.column("sig"), n)
    need = int(np.ceil(AGREE * BANDS * ROWS))
    rows = np.flatnonzero(side == 0)
    out = []
    for i in rows:
        others = np.flatnonzero(side == 1) if mode != 1 else rows[rows > i]
        others = others[(comp[others] != comp[i]) & (node[others] != node[i])]
        a, b = size[others], size[i]
        others = others[4 * np.minimum(a, b) >= 3 * np.maximum(a, b)]
        if len(others):
            others = others[(sig[others] == sig[i]).sum(axis=1) >= need]
        if len(others):
            out.append((int(i), others))
    return out


_TASK = "task string, mode int, side int, node long, comp long, n long, sig binary"


def _filter_by_signature(batches):
    """Keep the rows of a task that have a pair to confirm."""
    for table in _groups(batches, "task"):
        rows: set[int] = set()
        for i, others in _wanted(table):
            rows.add(i)
            rows.update(others.tolist())
        if rows:
            yield from table.take(sorted(rows)).combine_chunks().to_batches()


def _confirm(batches):
    """Links of each task, on the full sets of its texts: (u, v, common, either)."""
    hasher = WordHasher()
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("common", pa.int64()), ("either", pa.int64())])

    def with_sets(source):
        for batch in source:
            numbers, at = shingles(*hasher.words(batch.column("text")), WIDTH)
            sets = [np.unique(numbers[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sets, pa.binary())], names=[*names, "set"])

    names = ["task", "mode", "side", "node", "comp", "n", "sig"]
    for table in _groups(with_sets(batches), "task"):
        node = table.column("node").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("set")]
        found = []
        for i, others in _wanted(table):
            own = sets[i]
            many = np.concatenate([sets[j] for j in others])
            at = np.concatenate([[0], np.cumsum([len(sets[j]) for j in others])])
            place = np.minimum(np.searchsorted(own, many), len(own) - 1)
            hits = np.concatenate([[0], np.cumsum(own[place] == many)])
            common = hits[at[1:]] - hits[at[:-1]]
            either = len(own) + np.diff(at) - common
            for j, c, e in zip(others, common, either):
                if 100 * c >= 75 * e:
                    found.append((int(node[i]), int(node[j]), int(c), int(e)))
        if found:
            u, v, c, e = (pa.array(x, pa.int64()) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([u, v, c, e], schema=schema)


def _by_task(rows: DataFrame) -> DataFrame:
    return rows.repartition("task").sortWithinPartitions("task", "side", "node")


def _links(tasks: DataFrame, docs: DataFrame) -> DataFrame:
    """Exact links of the tasks' wanted pairs. The signatures thin the tasks out first, and only
    what is left fetches its texts."""
    bounded_batches(docs.sparkSession)
    left = stored(_by_task(tasks.select(*[c.split()[0] for c in _TASK.split(", ")]))
                  .mapInArrow(_filter_by_signature, _TASK), "tasks")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    # The ids alone first: while they are few they are broadcast, and then the texts of all other
    # documents are not shuffled; beyond the broadcast threshold it is a shuffled join.
    ids = stored(left.select("node").distinct(), "ids")
    texts = texts.join(ids, "node", "left_semi")
    links = (_by_task(left.join(texts, "node"))
             .mapInArrow(_confirm, "u long, v long, common long, either long"))
    links = stored(links.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                   .agg(F.max("common").alias("common"), F.max("either").alias("either")), "links")
    drop_stored(left)
    drop_stored(ids)
    return links


def _few(hubs: DataFrame) -> DataFrame:
    """A stored table of hubs as the side of a join: broadcast up to ``FEW`` rows of two numbers."""
    return F.broadcast(hubs) if hubs.count() <= FEW else hubs


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per row of ``docs``, links between different shingle sets, each confirmed exactly).

    The first has doc_id, n_shingles, component_id and kept. Words are lower-cased in A-Z only; a
    text of fewer than five words has its whole sequence as its one shingle; a null, empty or blank
    text has none and is linked with nothing (its component is itself). Rows that repeat a doc_id
    are one document: they share a component, also with different texts. A row without doc_id takes
    no part: its component_id is null and it is kept. Only doc_id and text are read, so extra columns
    may have any name. An empty table gives empty results.

    The links are not all similar pairs: partners of a hub that are already in one component are not
    compared. They are a subset that determines the components.
    """
    sketch = stored(sketches(docs), "sketch")
    # Equal sets are one node. Partial sums combine in every task, so a large group of copies sends
    # one row per task.
    nodes = stored(sketch.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"),
        F.first("keys").alias("keys")), "nodes")
    cells = nodes.select(F.explode("keys").alias("bucket"), "node")
    buckets = (cells.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("size"))
               .where("size > 1").drop("size"))
    # A pair that shares several buckets with one hub counts once.
    pairs = stored(cells.join(buckets, "bucket").where("node != hub").select("hub", "node").distinct(), "pairs")
    facts = nodes.select("node", "n", "sig")
    width = pairs.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    # Only hubs of several blocks need their number beside each pair: at most pairs / BLOCK of them. While they are few they
    # are broadcast, so that the pairs of a large hub are not gathered by a join on it.
    large = stored(width.where("blocks > 1"), "large")
    pairs = pairs.join(_few(large), "hub", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))

    # Each hub with the others of its buckets; the partners of one hub are dealt over chunks.
    spread = pairs.withColumn("task", F.concat_ws(
        ":", F.col("hub").cast("string"), F.pmod(F.xxhash64("node"), F.col("blocks")).cast("string")))
    hubs = width.select(F.col("hub").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("at"))
    hubs = hubs.select("node", F.concat_ws(":", F.col("node").cast("string"), F.col("at").cast("string")).alias("task"),
                       F.lit(0).alias("side"))
    star = (hubs.unionByName(spread.select("task", "node", F.lit(1).alias("side"))).join(facts, "node")
            .withColumn("comp", F.col("node")).withColumn("mode", F.lit(0)))
    links = _links(star, docs)
    belongs = components(links)

    # Hubs whose partners are in several components: all pairs between those, block by block.
    placed = pairs.join(belongs, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    mixed = stored(placed.groupBy("hub").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                   .where("lo < hi").select("hub"), "mixed")
    rest = (placed.join(_few(mixed), "hub").join(facts, "node")
            .withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks"))))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rest = (rest.withColumn("task", F.concat_ws(":", F.col("hub").cast("string"),
                                                F.least("block", "other").cast("string"),
                                                F.greatest("block", "other").cast("string")))
            .withColumn("side", (F.col("block") > F.col("other")).cast("int"))
            .withColumn("mode", F.when(F.col("block") == F.col("other"), 1).otherwise(2)))
    more = _links(rest, docs)
    every = links.unionByName(more)
    # A doc_id with several texts joins their sets.
    several = (sketch.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
               .where("lo < hi").select("doc_id"))
    same_id = (sketch.join(several, "doc_id").select("digest", F.col("doc_id").alias("u"))
               .join(nodes.select("digest", F.col("node").alias("v")), "digest").select("u", "v"))
    final = components(every.select("u", "v").unionAll(same_id))
    owner = (nodes.select("digest", "node").join(final, "node", "left")
             .select("digest", F.coalesce("component", "node").alias("found")))
    out = (sketch.select("doc_id", "digest", "n_shingles").join(owner, "digest", "left")
           .select("doc_id", "n_shingles",
                   F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id")))
    out = out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out, every
