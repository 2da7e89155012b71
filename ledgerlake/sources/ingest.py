"""Landing files: raw request batches arrive as files (all text, or typed
with NaN for missing) and are read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.casting import nan_to_null
from ..operators.union import concat_batches


def read_landing(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: T.StructType | None = None, **options) -> DataFrame:
    """Read a landing batch (parquet / json / csv); NaN becomes null."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.load(path))


def read_landing_batches(spark: SparkSession, paths, fmt: str = "parquet", **options) -> DataFrame:
    """Several request batches with differing columns: union by name with
    widening (zero-width batches skipped)."""
    return concat_batches([read_landing(spark, p, fmt, **options) for p in paths])
