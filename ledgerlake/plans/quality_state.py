"""Quality measures kept beside the data, so that a report reads no old rows.

After each detail write, one small aggregate of the years written is stored
under ``<root>/quality/years`` (rows and null cells of every column, by year),
replacing what was stored for these years; and one row of the batch under
``<root>/quality/batches`` (rows landed, kept, rejected, duplicates), replaced
when the same batch runs again.  Both merge by addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.dedup import dedup_counts
from ..session import read_or_none
from ..sources.lake import YEAR, Lake

_YEARS = "column_name string, n_rows long, n_nulls long, layer string, dataset_name string, year int"
_BATCHES = "landed_rows long, rows_before long, rows_after long, duplicate_rows long, table_name string, batch string"


def _write(lake: Lake, df: DataFrame, kind: str, by) -> None:
    (df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
       .parquet(f"{lake.root}/quality/{kind}"))


def _read(lake: Lake, kind: str, schema: str) -> DataFrame:
    df = read_or_none(lambda: lake.spark.read.schema(schema).parquet(f"{lake.root}/quality/{kind}"))
    return lake.spark.createDataFrame([], schema) if df is None else df


def note_years(lake: Lake, layer: str, dataset: str, years) -> None:
    """Measure the given years of a stored dataset: one pass over these years,
    one row per year and column."""
    df = lake.read_years(layer, dataset, years, refresh=False) if years else None
    if df is None:
        return
    cols = [c for c in df.columns if c != YEAR]
    sums = df.groupBy(YEAR).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_nulls")) for i, c in enumerate(cols)]))
    rows = sums.select(YEAR, "n_rows", each.alias("c")).select(
        "c.column_name", "n_rows", "c.n_nulls", F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset_name"), YEAR)
    _write(lake, rows, "years", ["layer", "dataset_name", YEAR])


def note_batch(lake: Lake, table_name: str, batch: str, landed: DataFrame, prepared: DataFrame, key) -> None:
    """Measure a batch: rows landed, typed rows, survivors, duplicates."""
    n = landed.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    row = dedup_counts(prepared, key).select(
        n.alias("landed_rows"), "rows_before", "rows_after", "duplicate_rows", F.lit(table_name).alias("table_name"), F.lit(batch).alias("batch"))
    _write(lake, row, "batches", ["table_name", "batch"])


def column_state(lake: Lake, layer: str = "dwd") -> DataFrame:
    """(dataset_name, column_name, row_count, null_count) of whole datasets,
    merged from the years' measures."""
    state = _read(lake, "years", _YEARS).where(F.col("layer") == layer)
    # a column that a year does not have is null in all of that year's rows
    per_year = state.groupBy("dataset_name", YEAR).agg(F.max("n_rows").alias("n"))
    total = per_year.groupBy("dataset_name").agg(F.sum("n").alias("row_count"))
    held = state.groupBy("dataset_name", "column_name").agg(F.sum("n_rows").alias("seen"), F.sum("n_nulls").alias("nulls"))
    return held.join(total, "dataset_name").select(
        "dataset_name", "column_name", "row_count", (F.col("row_count") - F.col("seen") + F.col("nulls")).alias("null_count"))


def batch_state(lake: Lake) -> DataFrame:
    """(table_name, n_batches, landed_rows, rows_before, rows_after,
    duplicate_rows) over all batches of each table."""
    state = _read(lake, "batches", _BATCHES)
    return state.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_batches"), *[F.sum(c).alias(c) for c in
                                           ("landed_rows", "rows_before", "rows_after", "duplicate_rows")])


def state_report(lake: Lake, fetch: DataFrame | None = None) -> DataFrame:
    """One row per detail table: its batches, its rows and null cells as they
    are stored now, its partitions, and, with a table of fetch statistics
    (``batch_stats``), what was fetched.  Reads the kept measures only."""
    columns = column_state(lake).groupBy(F.col("dataset_name").alias("table_name")).agg(
        F.max("row_count").alias("row_count"), F.sum("null_count").alias("nulls_total"),
        F.map_from_entries(F.collect_list(F.struct("column_name", "null_count"))).alias("null_counts"))
    partitions = (_read(lake, "years", _YEARS).where("layer = 'dwd'").groupBy(F.col("dataset_name").alias("table_name"), YEAR)
                  .agg(F.max("n_rows").alias("row_count")).groupBy("table_name")
                  .agg(F.sort_array(F.collect_list(F.struct(YEAR, "row_count"))).alias("partitions")))
    out = columns.join(partitions, "table_name", "left").join(batch_state(lake), "table_name", "left")
    return out if fetch is None else out.join(fetch, "table_name", "left")
