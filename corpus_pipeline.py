"""A training corpus in five stages: quality, exact dedup, near-dedup, decontamination, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopstrata.llm import decontamination, exact_dedup, pieces, quality, simhash
from shopstrata.llm.common import table, written
from shopstrata.llm.queries import model_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3; fitted on the labelled ones among them, held-out rows left out."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).filter("score >= 0.3").select("row.*")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_duplicates(docs).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: one with the smallest id, or one without if no row has an id."""
    return simhash.near_duplicates(docs).filter("kept").select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, with digests of the ids and of the text they decode to."""
    found = pieces.encode(docs, model_path(), carry=["doc_id"], keep=["ids"])
    return found.select("row.doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminated),
    ("encoding", encoded),
]

#: No SQL has these stages: tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
