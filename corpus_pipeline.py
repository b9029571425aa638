"""Cleaning of a training corpus in stages, each by one of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import decontam, jaccard, quality, secrets, tokens
from riskweave.llm.common import documents
from riskweave.session import scratch_path



def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.kept_rows(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Of rows that repeat both id and text one stays. Rows without an id belong to no group and stay.
    """
    found = jaccard.jaccard_components(docs)
    first = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id is null"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; an altered name or number does not hide the rest of a copy."""
    return decontam.without(docs, decontam.contaminated_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), veto="window"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sentencepiece_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and whether they decode to its text."""
    return tokens.encode(docs)


#: (name, function) in order; a function takes (spark, docs, sf_dir).
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scan", secret_scan),
    ("SentencePiece coding", sentencepiece_coding),
]

#: Encoding has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each is written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
