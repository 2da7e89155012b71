"""Research-ready products: the daily master table and the financial
event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..specs import TABLE_SPECS
from .clean import EVENT_SCHEMA, add_source_tag
from .dedup import require_columns, survivorship_dedup
from .union import union_aligned


def left_join_suffix(left: DataFrame, right: DataFrame, key, suffix: str) -> DataFrame:
    """Left equi-join on ``key``; right columns whose names clash with the
    left get ``suffix``.  Null key values never match."""
    key = list(key)
    require_columns(left, key)
    require_columns(right, key)
    renames = {c: f"{c}{suffix}" for c in right.columns if c not in key and c in left.columns}
    if renames:
        right = right.withColumnsRenamed(renames)
    return left.join(right, on=key, how="left")


def build_daily_master(daily: DataFrame, daily_basic: DataFrame, adj_factor: DataFrame) -> DataFrame:
    """daily LEFT JOIN daily_basic LEFT JOIN adj_factor on (ts_code,
    trade_date), then one survivor per key.  All three inputs and the
    dedup are hash-partitioned on the same key, so the plan has one
    exchange per input and none for the dedup."""
    key = TABLE_SPECS["daily"].primary_key
    merged = left_join_suffix(daily, daily_basic, key, "_daily_basic")
    merged = left_join_suffix(merged, adj_factor, key, "_adj_factor")
    return survivorship_dedup(merged, key)


def build_financial_event_stream(frames: dict[str, DataFrame | None],
                                 spark: SparkSession | None = None) -> DataFrame:
    """Aligned union of the statement tables, each tagged with its source
    table.  No dedup across sources.  The nine event columns always exist
    (typed); rows are sorted within partitions by the event order."""
    tagged = [add_source_tag(df, name) for name, df in frames.items() if df is not None]
    session = tagged[0].sparkSession if tagged else spark
    if session is None:
        raise ValueError("no statement tables and no session for an empty result")
    # the typed nine columns lead, whatever the tables hold
    return (union_aligned([session.createDataFrame([], EVENT_SCHEMA), *tagged])
            .sortWithinPartitions("ts_code", "real_ann_date", "end_date", "ann_date", "source_table"))


def product_inputs(product: str) -> tuple[str, ...]:
    """The tables that a summary product is built from, by the catalogue."""
    return tuple(name for name, table in TABLE_SPECS.items() if table.dws_dataset == product)


def build_dws_outputs(dwd: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The summary products that the given detail tables allow: the joined
    daily table needs all of its inputs, the event stream at least one."""
    daily = [dwd.get(name) for name in product_inputs("daily_master")]
    events = {name: dwd[name] for name in product_inputs("financial_events") if name in dwd}
    joined = {"daily_master": build_daily_master(*daily)} if all(d is not None for d in daily) else {}
    return joined | ({"financial_events": build_financial_event_stream(events)} if events else {})
