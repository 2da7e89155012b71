"""Data-quality measures as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _quote(name: str) -> str:
    return "'" + name.replace("'", "''") + "'"


def null_profile(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, column_name, null_count) for every column, from ONE
    aggregate pass; NaN is a value, not a null; an empty table gives zeros."""
    cols = df.columns
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, null_count long")
    aggs = [F.sum(F.col(c).isNull().cast("long")).alias(f"n{i}") for i, c in enumerate(cols)]
    pairs = ", ".join(f"{_quote(c)}, coalesce(n{i}, 0L)" for i, c in enumerate(cols))
    return (df.agg(*aggs)
              .select(F.lit(table_name).alias("table_name"),
                      F.expr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")))


def nulls_total(df: DataFrame) -> F.Column:
    """Aggregate expression: total null cells of a frame."""
    terms = [F.col(c).isNull().cast("long") for c in df.columns]
    return F.coalesce(F.sum(reduce(lambda a, b: a + b, terms)), F.lit(0)).cast("long")


def batch_stats(batch_log: DataFrame, table_col: str = "table_name") -> DataFrame:
    """Sum request statistics per table over a batch log with columns
    (table_name, fetched_rows, request_count, success_count, retry_count,
    [messages array<string>]).  Messages are counted here; their text stays
    one row per message in ``batch_messages`` (never gathered per table)."""
    aggs = [F.sum(c).cast("long").alias(c) for c in
            ("fetched_rows", "request_count", "success_count", "retry_count") if c in batch_log.columns]
    if "messages" in batch_log.columns:
        aggs.append(F.coalesce(F.sum(F.size(F.coalesce("messages", F.array()))), F.lit(0))
                    .cast("long").alias("message_count"))
    return batch_log.groupBy(table_col).agg(*aggs)


def batch_messages(batch_log: DataFrame, table_col: str = "table_name") -> DataFrame:
    """(table_name, message) -- one row per logged message, in log order
    within each batch row."""
    return batch_log.select(table_col, F.explode("messages").alias("message"))


def table_quality(table_name: str, prepared: DataFrame, survivors: DataFrame, key) -> DataFrame:
    """One row per table: rows_before, rows_after, pk_duplicates, nulls_total.

    Two distributed aggregates: a grouping on the key (before / after /
    duplicates) and a null count on the survivors, brought in as a scalar
    subquery.
    """
    from .dedup import dedup_counts
    counts = dedup_counts(prepared, key)
    nulls = survivors.agg(nulls_total(survivors).alias("nulls_total")).scalar()
    return counts.select(F.lit(table_name).alias("table_name"), "rows_before", "rows_after",
                         F.col("duplicate_rows").alias("pk_duplicates"), nulls.alias("nulls_total"))


def nested_report(quality: DataFrame, nulls: DataFrame, partitions: DataFrame | None = None,
                  coverage: DataFrame | None = None) -> DataFrame:
    """One nested row per table: the quality counts, a map column -> null
    count, and the list of partitions written (layer, year, row_count and,
    where given, file_count and path).

    ``quality``: (table_name, rows_before, rows_after, pk_duplicates,
    nulls_total); ``nulls``: (table_name, column_name, null_count);
    ``partitions``: (layer, dataset_name, year, row_count); ``coverage``:
    (table_name, coverage struct).  Each nested value is bounded by a
    table's width, its years or a date range, never by its rows.
    """
    null_maps = nulls.groupBy("table_name").agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "null_count"))).alias("null_counts"))
    out = quality.join(null_maps, "table_name", "left")
    if partitions is not None:
        kept = ["layer", "year", "row_count", *[c for c in ("file_count", "path") if c in partitions.columns]]
        parts = (partitions.groupBy(F.col("dataset_name").alias("table_name"))
                 .agg(F.sort_array(F.collect_list(F.struct(*kept))).alias("partitions")))
        out = out.join(parts, "table_name", "left")
    if coverage is not None:
        out = out.join(coverage, "table_name", "left")
    return out


def write_report(report: DataFrame, path: str, fmt: str = "json") -> None:
    """Report sink: the report table written as JSON lines (or Parquet)."""
    report.write.mode("overwrite").format(fmt).save(path)
