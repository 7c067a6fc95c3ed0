"""Connected components of a link table, as Spark joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt.llm.common import drop_stored, stored


def _distinct(df: DataFrame) -> DataFrame:
    return df.where(F.col("u") != F.col("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _distinct(both.join(least, "u").where(F.col("v") > F.col("u"))
                     .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return _distinct(down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionAll(least.select("u", F.col("m").alias("v"))))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (columns ``u``, ``v``, long): the smallest
    node that is reachable. Alternating large-star and small-star rounds; every round is written to
    the shared folder, and the rounds end when every edge points at its component's smallest node.

    The sums per node combine in every task before the shuffle, and a node with very many links is
    split by the adaptive skew join. Null ends and self-links are ignored; an empty table gives an
    empty result.
    """
    edges = stored(_distinct(links.select(F.col("u").cast("long"), F.col("v").cast("long")).dropna()), "edges")
    for _ in range(max_rounds):
        # A forest of depth one: no node is both an end and a start, and each has one parent.
        ends = edges.groupBy("u").agg(F.count("*").alias("n"))
        bad = (ends.where("n > 1").select("u").unionAll(
            edges.select(F.col("v").alias("u")).join(ends.select("u"), "u", "left_semi")
        ).unionAll(edges.where("u < v").select("u")).limit(1).count())
        if not bad:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
        after = stored(_small_star(_large_star(edges)), "edges")
        drop_stored(edges)
        edges = after
    raise RuntimeError("components did not settle")
