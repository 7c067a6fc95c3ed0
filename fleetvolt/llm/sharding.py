"""A uniform shuffle into shards of exact sizes.

The rows of every input partition are put into a random order where they lie. How many of them each
shard gets is drawn from the multivariate hypergeometric law, partition after partition from what
the shards still lack: exactly the counts that a uniform shuffle of all rows would give. The first
so many rows of the local order go to shard 0, the next to shard 1, and so on. In its shard every
row then gets its slot by a second, independent permutation.

Only one count per input partition reaches the driver, and one row of cut points per partition goes
back. Slots are ranks over ranges of the second permutation, so no shard is one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt.llm.common import blocks_for, hash_place, running_before, stored

_PLACE_BITS = 33      # monotonically_increasing_id keeps the row's place in its low 33 bits


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One draw of how many of ``draws`` items, taken without putting back, are good ones.

    Inversion over the ratios of neighbouring probabilities around the mode; 14 standard deviations
    to either side leave out less than 1e-40. It works for counts of any size.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    share = good / total
    width = int(14 * (draws * share * (1 - share)) ** 0.5) + 30
    k = np.arange(max(low, mode - width), min(high, mode + width) + 1, dtype=np.float64)
    step = (np.log(good - k[:-1]) + np.log(draws - k[:-1])
            - np.log(k[1:]) - np.log(bad - draws + k[1:]))
    weight = np.concatenate([[0.0], np.cumsum(step)])
    odds = np.cumsum(np.exp(weight - weight.max()))
    return int(k[min(np.searchsorted(odds, rng.random() * odds[-1], "right"), len(k) - 1)])


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """How many rows each partition sends to each shard. Row sums are the partitions' counts, column
    sums the shards' sizes."""
    rng, left = np.random.default_rng(seed), list(sizes)
    matrix = []
    for count in counts:
        row, draws, rest = [], count, sum(left)
        for s, lacks in enumerate(left):
            rest -= lacks
            got = draws if s == len(left) - 1 else hypergeometric(rng, lacks, rest, draws)
            row.append(got)
            draws -= got
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def shuffle_into_shards(rows: DataFrame, key: list[str], shards: int = 16, seed: int = 11) -> DataFrame:
    """Add ``shard`` (0..shards-1; the counts differ by one at most) and ``slot`` (0.. without gaps in
    the shard) to every row.

    ``key`` names the columns that the random orders are hashed from, together with the row's place in its
    partition, so rows that agree in all of them spread like others; nulls are values like others. Column names starting with ``__`` are taken. An
    empty table gives an empty result.
    """
    spark = rows.sparkSession
    placed = (rows.withColumn("__local", F.xxhash64(*key, F.lit(seed)))
              .sortWithinPartitions("__local", *key).withColumn("__id", F.monotonically_increasing_id()))
    placed = stored(placed.withColumn("__part", F.shiftright("__id", _PLACE_BITS))
                    .withColumn("__pos", F.col("__id").bitwiseAND((1 << _PLACE_BITS) - 1))
                    .drop("__local"), "placed")
    counts = sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in counts)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    cuts = spark.createDataFrame(
        [(p, np.cumsum(row)[:-1].tolist()) for (p, _), row in zip(counts, matrix)], "__part long, __cuts array<long>")
    dealt = (placed.join(cuts, "__part")
             .withColumn("shard", F.size(F.filter("__cuts", lambda c: c <= F.col("__pos"))))
             .withColumn("__order", F.xxhash64(F.lit(seed + 1), *key, "__id")).drop("__cuts", "__part", "__pos", "__id"))
    return running_before(dealt, ["shard"], hash_place("__order"), ["__order", *key],
                          blocks_for(total // shards), F.lit(1), "slot").drop("__order")


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 11) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1; null: 1), text_crc32 (null: of no bytes), shard and
    slot of every row of ``docs``. Only doc_id and text are read."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return shuffle_into_shards(rows, ["doc_id", "size", "text_crc32"], shards, seed)
