"""Primary-key duplicate count and survivorship deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..functions.rows import completeness_score, update_priority
from ..specs import SPELLING

_HELPERS = ("__prio", "__score", "__rn")


def require_columns(df: DataFrame, columns, what: str = "key") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing {what} column(s) {missing}; present: {df.columns}")


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType) or type(dt).__name__ == "VariantType":
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def survivor_order(df: DataFrame, key, order_first=(), score_exclude=()) -> tuple[DataFrame, list[Column]]:
    """Add the helper columns and return the ranking order of the rule:

    1. update priority desc (only if ``update_flag`` exists),
    2. completeness desc (non-null count over the data columns),
    3. ``order_first`` (caller's recency hints such as a batch number),
    4. every remaining column desc: a total order, so ties never depend on
       the input order or on partitioning.
    """
    key = list(key)
    data_cols = [c for c in df.columns if c not in _HELPERS]
    scored = [c for c in data_cols if c not in {*score_exclude, SPELLING}]
    out = df.withColumn("__score", completeness_score(scored))
    order: list[Column] = []
    if "update_flag" in df.columns:
        out = out.withColumn("__prio", update_priority("update_flag"))
        order.append(F.col("__prio").desc())
    order.append(F.col("__score").desc())
    hinted = set()
    for o in order_first:
        if isinstance(o, str):
            hinted.add(o)
            order.append(F.col(o).desc_nulls_last())
        else:
            order.append(o)
    for c in data_cols:
        if c in key or c in hinted or not _orderable(df.schema[c].dataType):
            continue
        order.append(F.col(c).desc_nulls_last())
    return out, order


def survivorship_dedup(df: DataFrame, key, order_first=(), score_exclude=()) -> DataFrame:
    """Keep one row per primary key (null key values form one group).

    Written as a ``row_number() = 1`` rank filter: Catalyst plans a partial
    WindowGroupLimit before the exchange, so every map task ships at most one
    row per key -- a key holding a third of the table costs one row per
    task in the shuffle, not a third of the table in one task.
    """
    key = list(key)
    require_columns(df, key)
    ranked, order = survivor_order(df, key, order_first, score_exclude)
    w = Window.partitionBy(*[F.col(k) for k in key]).orderBy(*order)
    return (ranked.withColumn("__rn", F.row_number().over(w))
                  .where(F.col("__rn") == 1)
                  .drop(*[h for h in _HELPERS if h in ranked.columns or h == "__rn"]))


def pk_duplicate_groups(df: DataFrame, key) -> DataFrame:
    """Groups of the primary key seen more than once (null values group)."""
    key = list(key)
    require_columns(df, key)
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def pk_duplicate_count(df: DataFrame, key, table_name: str | None = None) -> DataFrame:
    """One row: rows beyond the first of every key group (0 for none / empty)."""
    agg = pk_duplicate_groups(df, key).agg(
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))
    if table_name is not None:
        agg = agg.select(F.lit(table_name).alias("table_name"), "duplicate_rows")
    return agg


def dedup_counts(df: DataFrame, key) -> DataFrame:
    """rows_before, rows_after, duplicate_rows of a survivorship dedup, all
    from one grouping on the key (rows_after = number of key groups)."""
    key = list(key)
    require_columns(df, key)
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_before"),
        F.count(F.lit(1)).cast("long").alias("rows_after"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
    )
