"""A training-data pipeline over ``documents``: five stages of the llm operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracefoundry.llm.common import cut, read
from tracefoundry.llm.exact import exact_duplicates
from tracefoundry.llm.minhash import near_duplicates
from tracefoundry.llm.mixing import mix
from tracefoundry.llm.packing import pack
from tracefoundry.llm.quality import classify

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` as a table with ``row``, an id of each row, and what orders rows: ``points`` and ``mark``."""
    points = F.char_length(F.coalesce("text", F.lit("")))
    return cut(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row"), points.alias("points"), F.xxhash64(*COLUMNS).alias("mark")), name)


def _chosen(rows: DataFrame, decisions: DataFrame, group: str, longest: bool) -> DataFrame:
    """One row of each group that ``decisions`` (doc_id, which is the row, and ``group``) names.

    The longest if asked for, then the smallest doc_id, null last; rows equal
    in these are told apart by their content, so the choice follows the rows.
    """
    first = F.struct(*([F.negative("points").alias("p")] if longest else []), F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "row")
    named = decisions.select(F.col("doc_id").alias("row"), F.col(group).alias("group"))
    best = rows.select("row", "doc_id", "points", "mark").join(named, "row").groupBy("group").agg(F.min(first).alias("first"))
    return rows.join(best.select(F.col("first.row").alias("row")), "row", "left_semi").select(COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier keeps: of repeated rows all or none, whatever their doc_id; null, empty and blank texts go."""
    return classify(docs, carry=COLUMNS).where("kept").select(COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest original of each group of equal texts: one row, also of rows repeated whole or without a doc_id."""
    rows = _rows(docs, "pipeline-exact")
    return _chosen(rows, exact_duplicates(rows.select(F.col("row").alias("doc_id"), "text")), "keep_id", True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates; rows without a doc_id are in groups like others, and chosen last."""
    rows = _rows(docs, "pipeline-near")
    return _chosen(rows, near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")), "component_id", False)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes each of them, whether they have a doc_id or share it."""
    rows = _rows(docs, "pipeline-mix")
    taken = mix(rows, carry=["row"]).where("taken > 0").select("row", (F.col("taken") / F.col("size")).cast("int").alias("times"))
    met = rows.join(taken, "row")
    return met.select(*COLUMNS, F.explode(F.sequence(F.lit(1), "times"))).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids' places and digests; a row is packed as often as it comes, a null text as its end id."""
    return pack(docs, with_ids=False)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", near_dedup),
    ("mix_sources", source_mix),
    ("packing", packing),
]

#: SQL cannot express the trained classifier, MinHash or the tokenizer; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
