"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import chat, pages as web
from tidemark.llm.classes import class_bigram_scores
from tidemark.llm.divergence import divergence
from tidemark.llm.hnsw import nearest_by_cosine
from tidemark.llm.impact import top_inner_products
from tidemark.llm.merges import decoded, encoded as merged_ids
from tidemark.llm.near_copies import near_copy_groups
from tidemark.llm.oracles import ORACLES
from tidemark.llm.packing import packed
from tidemark.llm.pieces import encoded
from tidemark.llm.quality import judged
from tidemark.llm.repeats import digests
from tidemark.llm.resample import resampled
from tidemark.llm.ship import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_maximal_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All logged conversations that no longer one begins with, as training texts."""
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op2_impact_ordered_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products for every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_inner_products(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op3_superminhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents, on 4-word shingles at a similarity of 0.8."""
    groups = near_copy_groups(table(spark, sf_dir, "documents"), width=4, percent=80)
    return groups.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op4_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 35-word windows."""
    return digests(table(spark, sf_dir, "documents"), window=35)


def op5_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors by cosine found for every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_by_cosine(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op6_class_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability under class bigrams learned from six sevenths of them."""
    return class_bigram_scores(table(spark, sf_dir, "documents"))


def op7_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best segmentations of every document into pieces, with a checksum of the ids."""
    rows = encoded(table(spark, sf_dir, "documents"), n=3)
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op8_recurrent_block_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article text of every page."""
    pages = table(spark, sf_dir, "pages")
    return web.main_texts(pages.select("page_id", "url", "html"), web.learned(pages))


def op9_byte_network_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document as a network over bytes sees it."""
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences whose lengths are powers of two, 1024 at most."""
    return packed(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_iceberg_prefix_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms each source favours."""
    return divergence(table(spark, sf_dir, "documents"))


def op12_regex_split_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn by how much they resemble the benchmark texts."""
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merge_round_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    rows = decoded(merged_ids(table(spark, sf_dir, "documents")))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_maximal_conversations": op1_maximal_conversations,
        "op2_impact_ordered_topk": op2_impact_ordered_topk,
        "op3_superminhash_groups": op3_superminhash_groups,
        "op4_repeated_windows": op4_repeated_windows,
        "op5_hnsw_neighbours": op5_hnsw_neighbours,
        "op6_class_bigrams": op6_class_bigrams,
        "op7_nbest_pieces": op7_nbest_pieces,
        "op8_recurrent_block_labels": op8_recurrent_block_labels,
        "op9_byte_network_quality": op9_byte_network_quality,
        "op10_power_of_two_packing": op10_power_of_two_packing,
        "op11_iceberg_prefix_divergence": op11_iceberg_prefix_divergence,
        "op12_regex_split_resampling": op12_regex_split_resampling,
        "op13_merge_round_bpe": op13_merge_round_bpe,
    }


def llm_oracles() -> dict[str, str]:
    return dict(ORACLES)
