"""Helpers shared by the operators: table reads, written intermediates, and
the bound on Arrow batches that the numpy operators work in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: Rows of an Arrow batch handed to Python.  Texts can be long, so a batch is
#: kept small; the operators cut it again into blocks of BLOCK_BYTES.
ARROW_ROWS = 256
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches of the session that ``df`` belongs to."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the
    lineage, and what is read later survives a lost executor."""
    path = scratch_path(df.sparkSession, kind)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
