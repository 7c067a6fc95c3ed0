"""The registered queries of this folder: thin wrappers that apply an operator, with production
parameters, to its whole table. Each takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetvolt.llm import collocations as phrases
from fleetvolt.llm import minhash, mixing, mtree, packing, prefix_trie, projected_search, quality, sharding, token_counts, token_store, toxicity, warc


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, folder, "pages"))


def op2_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op3_mtree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = mtree.whole_vectors(_table(spark, folder, "embeddings"))
    return mtree.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, folder, "documents"), _tokenizer("byte_bpe_50k.json"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.token_round_trip(_table(spark, folder, "documents"), _tokenizer("word_bpe_49k.json"))


def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"))[0]


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.shard_documents(_table(spark, folder, "documents"), 16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op11_projected_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = projected_search.whole_vectors(_table(spark, folder, "embeddings"))
    return projected_search.nearest(vectors, "vec_id % 20 = 0", 20)


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_warc, op2_length_buckets, op3_mtree_top_k, op4_mixing, op5_token_counts, op6_toxicity, op7_token_files,
        op8_minhash_near_dedup, op9_quality_rules, op10_sharding,
        op11_projected_neighbours, op12_collocations, op13_prefix_trie)}
