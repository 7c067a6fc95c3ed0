"""Optimal length buckets and token-budget batches.

All lengths are counted into one histogram. Dynamic programming over it chooses the bucket
boundaries for which padding every document to its bucket's boundary adds the fewest tokens in
all. Inside a bucket the documents, in a shuffled order, fill batches of as many rows as the token
budget allows at the boundary's length.

The histogram has a row for every length that occurs, whatever the input's size: a corpus of W words has at
most sqrt(2 W) + 1 lengths (137 billion words, all lengths different, make 524,288 of them), so the boundaries are
optimal among all lengths for every table. Only a caller who sets ``MOST`` lets lengths share bins beyond that many
rows: a bin for every length up to ``EXACT`` and ``EXACT`` bins for each doubling beyond. Counts, sums and the largest
length of each bin are exact there too; boundaries are then optimal among the bins' largest lengths only.
"""

from __future__ import annotations

from array import array

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetvolt.llm.common import blocks_for, drop_stored, hash_place, running_before, stored, unnamed_row, word_count

EXACT = 4096
MOST: int | None = None      # rows of the histogram beyond which lengths share bins (None: never)


def length_bin(length: Column) -> Column:
    """Bin of a length: itself up to ``EXACT``, then ``EXACT`` equal bins for each doubling."""
    octave = F.floor(F.log2(F.greatest(length, F.lit(EXACT)) / F.lit(EXACT)) + F.lit(1e-9)).cast("int")
    width = F.pow(F.lit(2.0), octave).cast("long")
    return F.when(length < EXACT, length).otherwise(
        F.lit(EXACT) * (octave + 1) + F.floor((length - F.lit(EXACT) * width) / width)).cast("long")


def optimal_boundaries(bins: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Boundaries, ascending, of at most ``buckets`` buckets with the least padding. ``bins``: (largest
    length, rows, sum of lengths), ascending.

    Ending a bucket at bin j that began after bin i costs L_j (C_j - C_i) - (S_j - S_i) with running
    counts C and sums S. For a fixed i that is a line in L_j, so each layer is a lower envelope of
    lines whose queries come in order: O(bins) a layer, in whole numbers.
    """
    if not bins:
        return []
    n = len(bins)
    length = [0] + [b[0] for b in bins]
    rows, sums = [0], [0]
    for _, c, s in bins:
        rows.append(rows[-1] + c)
        sums.append(sums[-1] + s)
    cost = [length[j] * rows[j] - sums[j] for j in range(n + 1)]     # one bucket for the first j bins
    came = [array("l", [0]) * (n + 1)]
    for _ in range(1, min(buckets, n)):
        hull: list[tuple[int, int, int]] = []      # (slope, intercept, i)
        new, origin, at = cost[:], array("l", [0]) * (n + 1), 0
        for j in range(1, n + 1):
            i = j - 1
            if i:
                line = (-rows[i], cost[i] + sums[i], i)
                while len(hull) > at + 1 and _useless(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
            x = length[j]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            new[j] = x * rows[j] - sums[j]          # fewer buckets may do as well
            if hull:
                best = new[j] + hull[at][0] * x + hull[at][1]
                if best < new[j]:
                    new[j], origin[j] = best, hull[at][2]
        came.append(origin)
        cost = new
    ends, j, layer = [], n, len(came) - 1
    while j:
        ends.append(length[j])
        j, layer = came[layer][j], layer - 1
    return ends[::-1]


def _useless(a: tuple, b: tuple, c: tuple) -> bool:
    """Line b is nowhere below both a and c (slopes fall from a to c)."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(docs: DataFrame, buckets: int = 16, budget: int = 16_384, seed: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens (words; null text: 0), bucket, pad_to (the bucket's
    boundary), padding, batch (numbered over all buckets), place in the batch (from 0).

    The batches of a bucket hold max(1, budget // pad_to) rows, so a document beyond the budget is a
    batch of its own; only a bucket's last batch may hold fewer. Repeated rows are rows of their own,
    and null ids are ids like others. Only doc_id and text are read. An empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    sized = stored(docs.select("doc_id", word_count(F.col("text")).alias("n_tokens"))
                   .withColumn("__order", F.xxhash64("doc_id", "n_tokens", F.lit(seed), unnamed_row("doc_id"))), "sized")
    lengths = stored(sized.groupBy("n_tokens").agg(F.count("*").alias("n")), "lengths")
    key = F.col("n_tokens") if MOST is None or lengths.count() <= MOST else length_bin(F.col("n_tokens"))
    found = (lengths.groupBy(key.alias("bin"))
             .agg(F.max("n_tokens").alias("top"), F.sum("n").alias("n"), F.sum(F.col("n_tokens") * F.col("n")).alias("total"))
             .select("top", "n", "total").toArrow())
    bins = sorted(zip(*(found.column(c).to_pylist() for c in ("top", "n", "total"))))
    drop_stored(lengths)
    ends = optimal_boundaries(bins, buckets)
    table, first, low = [], 0, -1
    for b, end in enumerate(ends):
        rows = sum(n for top, n, _ in bins if low < top <= end)
        cap = max(1, budget // max(1, end))
        table.append((b, end, cap, first))
        first, low = first + -(-rows // cap), end
    # A handful of boundaries: the bucket is a CASE over them, so no join is needed.
    def by_bucket(value) -> Column:
        out = F.lit(None).cast("long")
        for row in reversed(table):
            out = F.when(F.col("n_tokens") <= row[1], F.lit(value(row)).cast("long")).otherwise(out)
        return out
    placed = sized.withColumn("bucket", by_bucket(lambda r: r[0]).cast("int"))
    total = sum(n for _, n, _ in bins)
    ranked = running_before(placed, ["bucket"], hash_place("__order"), ["__order", "doc_id", "n_tokens"],
                            blocks_for(total // max(1, len(ends))), F.lit(1), "__rank")
    cap = by_bucket(lambda r: r[2])
    return ranked.select(
        "doc_id", "n_tokens", "bucket", by_bucket(lambda r: r[1]).alias("pad_to"),
        (by_bucket(lambda r: r[1]) - F.col("n_tokens")).alias("padding"),
        (by_bucket(lambda r: r[3]) + F.floor(F.col("__rank") / cap)).cast("long").alias("batch"),
        (F.col("__rank") % cap).cast("long").alias("place"))
