"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, clusters, embed, exact, minhash, repair, suffixes, urls
from .common import read
from .lines import fuzzy_lines
from .mixing import mix
from .packing import pack
from .quality import classify
from .trie import token_counts


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"))


def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), with_ids=False)


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.read_back(chat.format_chats(chat.conversation_events(rows)))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(read(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_vectors(read(spark, sf_dir, "embeddings"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines(read(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read(spark, sf_dir, "pages"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(read(spark, sf_dir, "conversations")))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.cut_repeats(read(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_vectors(read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_quality_classifier,
        op2_nnls_packing,
        op3_chat_formatting,
        op4_source_mixing,
        op5_exact_dedup,
        op6_embedding_near_dedup,
        op7_minhash_near_dedup,
        op8_line_dedup,
        op9_url_filters,
        op10_token_counts,
        op11_conversation_repair,
        op12_suffix_dedup,
        op13_centroid_clustering,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express an operator; the others are tested against brute force."""
    return {
        "op3_chat_formatting": chat.ORACLE,
        "op5_exact_dedup": exact.ORACLE,
        "op6_embedding_near_dedup": embed.ORACLE,
        "op7_minhash_near_dedup": minhash.ORACLE,
        "op9_url_filters": urls.ORACLE,
        "op11_conversation_repair": repair.ORACLE,
        "op12_suffix_dedup": suffixes.ORACLE,
        "op13_centroid_clustering": clusters.ORACLE,
    }
