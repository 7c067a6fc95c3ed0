"""A corpus pipeline: toxic documents go, then those of low quality, one document of each group of
near-duplicates stays, the sources are mixed to target weights, and the mix is packed into batches.

Each stage applies one operator of ``fleetvolt.llm`` to all rows that its predecessor kept. All but the last
return rows with the columns of ``documents``; extra columns, nulls, empty texts and empty tables pass
through as each operator defines it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetvolt.llm import minhash, mixing, packing, quality
from fleetvolt.llm import toxicity as tox
from fleetvolt.llm.common import quoted, stored, whole_row

#: The learnt stages and the shuffles cannot be written in SQL; the tests hold ``run`` against a
#: brute-force version.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    return tox.drop_toxic(docs, _labels(spark, sf_dir))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the certified cutoffs reject go."""
    return quality.keep_good(docs, _labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id, or the
    smallest hash of doc_id and text among several texts of that id. Different texts of one doc_id are
    documents of their own, so a text goes only if a near-duplicate of it stays. Rows without doc_id take
    no part, but exact copies of a text among them count once. Of rows with the same doc_id and text the
    one with the smallest hash of its columns (but maps) stays."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").alias("own"), text.alias("words"), whole_row(docs).alias("row"),
                       F.xxhash64(*[F.col(quoted(c)) for c, t in docs.dtypes if "map<" not in t]).alias("turn"))
    named, unnamed = rows.where("own IS NOT NULL"), rows.where("own IS NULL")
    # Only the ids with several texts get a key for each text.
    several = stored(named.groupBy("own").agg(F.min(F.xxhash64("words")).alias("lo"), F.max(F.xxhash64("words")).alias("hi"))
                     .where("lo < hi").select(F.col("own").alias("of")), "several")
    keyed = named.join(several, F.col("own") == F.col("of"), "left").withColumn(
        "key", F.when(F.col("of").isNull(), F.col("own").cast("long")).otherwise(F.xxhash64("own", "words")))
    found, _ = minhash.near_duplicates(keyed.select(F.col("key").alias("doc_id"), F.col("words").alias("text")))
    groups = found.select(F.col("doc_id").alias("key"), "component_id").distinct()
    keep = (keyed.select("own", "key").distinct().join(groups, "key").groupBy("component_id")
            .agg(F.min(F.struct("own", "key"))["key"].alias("key")).select("key"))
    kept = keyed.join(keep, "key", "left_semi").groupBy("key").agg(F.min_by("row", "turn").alias("row"))
    kept = kept.select("row").unionByName(unnamed.groupBy("words").agg(F.min_by("row", "turn").alias("row")).select("row"))
    return kept.select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes as often as the mix takes its words, rounded: not at all, once or twice. Rows
    that share a doc_id come equally often."""
    taken = mixing.mix(docs)
    times = (taken.groupBy("doc_id").agg(F.sum("taken").alias("t"), F.sum("size").alias("s"))
             .select("doc_id", F.round(F.col("t") / F.greatest("s", F.lit(1))).cast("int").alias("times"))
             .where("times > 0"))
    rows = docs.select(F.col("doc_id").alias("own"), whole_row(docs).alias("row"))
    joined = rows.join(times, F.col("own").eqNullSafe(F.col("doc_id")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Buckets and batches of all that the mix holds."""
    return packing.pack(docs)


STAGES = [("toxicity", toxicity), ("quality_rules", quality_rules), ("near_dedup", near_dedup),
          ("mix_sources", mix_sources), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
