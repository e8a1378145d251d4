"""From raw documents to packed training sequences, each stage written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlake.config import scratch_dir
from depotlake.llm import decontam, jaccard, langid, packing, secrets
from depotlake.llm.common import staged, table
from depotlake.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop junk, not what has no known language; a source is a host, a lang what the document declares."""
    found = langid.identify(docs, F.col("lang"), host=F.col("source"))
    return found.where(~F.col("junk")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of every group; rows without doc_id stay.

    Five-word shingles, similarity 0.8. Of rows that agree in doc_id and text one stays.
    """
    groups = staged(jaccard.near_duplicates(docs, jaccard.Rule(size=5, percent=80)), "groups")
    away = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = jaccard.without(docs, away)
    repeated = groups.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with hits in at least a twentieth of their words; all others stay as they are."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets; all documents stay."""
    return secrets.redact(docs, secrets.train(secrets.example_findings(spark)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left, neighbours on the curve side by side."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", pack),
]

# Tokenising, similarity and trained models are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
