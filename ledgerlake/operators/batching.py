"""Ordered positions and fixed-size chunks without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import checkpoint_root


def with_global_index(df: DataFrame, order_cols, index_col: str = "row_index") -> DataFrame:
    """0-based position of every row in the order of ``order_cols``.

    Range-partition and sort, tag each row with its partition and in-partition
    id, checkpoint (reliable, in the shared folder: ids stay stable if a task
    is retried), then add each partition's row offset.  Rows that tie are
    ordered by a hash of the row, so a value that many rows share is spread
    over partitions and the positions do not depend on the input's order.  Only the per-partition
    counts -- one row per partition -- meet in one place.
    """
    checkpoint_root(df.sparkSession)
    order_cols = list(order_cols)
    tie = F.xxhash64(*[f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
    by = [*order_cols, "__tie"]
    tagged = (df.withColumn("__tie", tie).repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie")
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__base"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", "__base",
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    out = tagged.join(F.broadcast(offsets), "__pid")   # one row per partition
    return (out.withColumn(index_col, (F.col("__off") + F.col("__mid") - F.col("__base")).cast("long"))
               .drop("__pid", "__mid", "__base", "__off"))


def chunk_ids(df: DataFrame, order_cols, size: int, chunk_col: str = "batch_id") -> DataFrame:
    """Consecutive chunks of ``size`` rows in the order of ``order_cols``."""
    if size <= 0:
        raise ValueError("chunk_size must be positive")
    idx = with_global_index(df, order_cols, "__idx")
    return idx.withColumn(chunk_col, F.floor(F.col("__idx") / size).cast("long")).drop("__idx")


def filter_symbols(df: DataFrame, symbols, col: str = "ts_code") -> DataFrame:
    """Rows whose ``col`` is in ``symbols``: a literal list becomes an IN
    predicate (pushed to the scan); a DataFrame of symbols becomes a left
    semi join (AQE turns it into a broadcast when it is small at run time)."""
    if isinstance(symbols, DataFrame):
        keys = symbols.select(F.col(symbols.columns[0]).alias("__sym")).distinct()
        return df.join(keys, df[col] == keys["__sym"], "left_semi")
    return df.where(F.col(col).isin(list(symbols)))


def symbol_universe(df: DataFrame, col: str = "ts_code") -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()
