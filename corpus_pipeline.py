"""The corpus pipeline: documents through the operators of ledgerlake.llm.

Each stage works on all that the stage before it kept.  The result of a stage
is written to the shared folder and read back as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.llm import decontaminate, neardup, packing, quality, secrets
from ledgerlake.llm.common import table, written
from ledgerlake.llm.queries import word_bpe_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets inside a document are replaced; no document goes."""
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in sequences."""
    return packing.pack(docs, word_bpe_path)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secret_scan", secret_scan), ("packing", pack)]

#: The last stage needs a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
