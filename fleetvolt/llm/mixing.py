"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only.

The words of a source, its documents in a shuffled order, are cut into equal blocks. Van der Corput
points in base 2 are mapped through the cumulative weights of the sources (each counted in the slots
that its target needs), which names the source of every slot. The first 2^m points are the grid i / 2^m
in bit-reversed order, so a source gets its number of slots to within one, evenly over time. The k-th
slot of a source takes its block k modulo the number of blocks; with targets of at most twice a
source's size, no block is used more than twice.

Slots of a source are ranked, and its words numbered, over ranges of the order whose sums are added up
first, so a source with a third of all rows is spread like the rest. Only windows over one row per
source are ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetvolt.llm.common import blocks_for, hash_place, running_before, stored, unnamed_row, word_count

WEIGHTS = (3, 1, 2)
#: Slots that one row of the schedule's first step makes.
RUN = 4096


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, factor: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """One row per source of ``rows`` (source, size): number, source, source_size, docs, target.

    Sources in order of code points, null last, weigh ``weights`` in turn and share ``factor`` times all
    words; a target stops at ``most`` times its source's size and the excess goes to the others by
    weight, until none is above. That is one level per unit of weight, up to which all targets are
    filled: with the sources sorted by the level at which they are full, running sums give it.
    """
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(float(x)) for x in weights])
    s = (rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
         .withColumn("number", (F.row_number().over(by_code) - 1).cast("long"))
         .withColumn("weight", F.get(pattern, (F.col("number") % len(weights)).cast("int")))
         .withColumn("full", F.col("source_size") * F.lit(most)))
    filled = Window.orderBy(F.col("full") / F.col("weight"), "number")
    done = filled.rowsBetween(Window.unboundedPreceding, -1)
    rest = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = (s.withColumn("aim", F.sum("source_size").over(whole) * F.lit(factor))
         .withColumn("level", (F.col("aim") - F.coalesce(F.sum("full").over(done), F.lit(0.0)))
                     / F.sum("weight").over(rest)))
    held = F.min(F.when(F.col("level") <= F.col("full") / F.col("weight"),
                        F.struct(F.col("full") / F.col("weight"), "number", "level"))).over(whole)
    level = F.coalesce(held["level"], F.lit(0.0))
    return s.select("number", "source", "source_size", "docs",
                    F.least(F.col("full"), level * F.col("weight")).alias("target"))


def schedule(sources: DataFrame, block_words: int = 128) -> tuple[DataFrame, DataFrame]:
    """(sources with their blocks, slots). Slots: t (time, from 0), number (of the source), rank (among
    the source's slots by time), block (of the source that the slot takes)."""
    everything = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    many = F.greatest(F.ceil(F.col("source_size") / F.lit(block_words)), F.lit(1))
    s = (sources.withColumn("length", F.greatest(F.ceil(F.col("source_size") / many), F.lit(1)).cast("long"))
         .withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / F.col("length")), F.lit(1)).cast("long"))
         .withColumn("slots", F.when(F.col("source_size") > 0,
                                     F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))
         .withColumn("low", F.coalesce(F.sum("slots").over(everything), F.lit(0.0)))
         .withColumn("bits", F.ceil(F.log2(F.greatest(F.sum("slots").over(Window.partitionBy()) + 1, F.lit(2.0)))).cast("int")))
    s = stored(s.withColumn("first", F.ceil(F.col("low") - F.lit(0.5)).cast("long"))
               .withColumn("end", F.ceil(F.col("low") + F.col("slots") - F.lit(0.5)).cast("long")), "sources")
    runs = (s.where(F.col("end") > F.col("first"))
            .withColumn("run", F.explode(F.sequence("first", F.col("end") - 1, F.lit(RUN).cast("long")))))
    points = (runs.repartition("number", "run").select(
        "number", "blocks", "bits",
        F.explode(F.sequence("run", F.least(F.col("run") + (RUN - 1), F.col("end") - 1))).alias("point")))
    # The point i / 2^m comes at the time whose m bits are those of i in reverse.
    t = F.expr("conv(reverse(lpad(bin(point), bits, '0')), 2, 10)").cast("long")
    points = stored(points.withColumn("t", t), "points")
    total = points.count()
    ranked = running_before(points, ["number"], F.col("t") / F.pow(F.lit(2.0), F.col("bits")), ["t"],
                            blocks_for(total), F.lit(1), "rank")
    return s, ranked.select("t", "number", "rank", (F.col("rank") % F.col("blocks")).alias("block"), "blocks")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, factor: float = 1.5, most: int = 2,
        block_words: int = 128, seed: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target (of its source), taken (words of it
    that the mix takes, repeats counted; at most ``most`` times its size).

    Texts without words and null texts have size 0 and are taken 0 times. A null source is a source.
    Repeated rows are rows of their own, and null ids are ids like others. Only doc_id, text and source
    are read. The taken words of a source are its target to within two blocks. An empty table gives an
    empty result.
    """
    rows = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
                  .withColumn("order", F.xxhash64("doc_id", "size", F.lit(seed), unnamed_row("doc_id"))), "sizes")
    sources, slots = schedule(source_targets(rows, weights, factor, most), block_words)
    used = (slots.where(F.col("rank") < F.col("blocks") * F.lit(most))
            .groupBy("number", "block").agg(F.count("*").alias("times")))
    facts = sources.select(F.col("source").alias("of"), "number", "source_size", "target", "length")
    known = stored(rows.join(facts, F.col("source").eqNullSafe(F.col("of")), "left").drop("of", "source"), "known")
    total = rows.count()
    streams = running_before(known, ["number"], hash_place("order"), ["order", "doc_id", "size"],
                             blocks_for(total), F.col("size"), "start")
    keys = ["doc_id", "size", "source_size", "target", "number", "start"]
    end = F.col("start") + F.col("size")
    pieces = (streams.where("size > 0")
              .withColumn("block", F.explode(F.sequence(F.expr("start div length"), F.expr("(start + size - 1) div length"))))
              .withColumn("words", F.least(end, (F.col("block") + 1) * F.col("length"))
                          - F.greatest(F.col("start"), F.col("block") * F.col("length"))))
    taken = (pieces.join(used, ["number", "block"], "left").groupBy(*keys)
             .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")))
    empty = streams.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
    return taken.unionByName(empty).select("doc_id", "size", "source_size", "target", "taken")
