"""Query API over the summary layer (parameters are bound as literals,
never spliced into SQL text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.calendar import to_date_param
from ..sources.lake import YEAR, Lake
from ..specs import EVENT_COLUMNS


def query_daily_master(lake: Lake, year: int, ts_code: str | None = None,
                       start_date=None, end_date=None) -> DataFrame:
    """One year partition of daily_master, optional symbol and closed date
    range (a falsy parameter adds no filter), ordered by ts_code,
    trade_date.  The year filter prunes partitions; the others push down to
    the Parquet scan."""
    df = lake.read_year("dws", "daily_master", year)
    if df is None:
        raise FileNotFoundError(f"no daily_master data at {lake.path('dws', 'daily_master')}")
    if ts_code:
        df = df.where(F.col("ts_code") == F.lit(ts_code))
    if start_date:
        df = df.where(F.col("trade_date") >= F.lit(to_date_param(start_date)))
    if end_date:
        df = df.where(F.col("trade_date") <= F.lit(to_date_param(end_date)))
    return df.drop(YEAR).orderBy(F.col("ts_code").asc_nulls_last(), F.col("trade_date").asc_nulls_last())


def query_financial_events(lake: Lake, ts_code: str, start_date=None, end_date=None) -> DataFrame:
    """Events of one symbol over all years, optional closed range on
    real_ann_date; nine columns ordered by real_ann_date, end_date,
    source_table.  Events lie by the year of real_ann_date, so the range names
    the years to read: of the years noted beside the data, only their
    directories are listed.  Files are sorted by symbol and date, and carry a
    Bloom filter of the symbols where they have too many for a dictionary, so
    row groups without the symbol are skipped."""
    if not ts_code:
        raise ValueError("ts_code is required")
    if lake.stored_schema("dws", "financial_events") is None:
        raise FileNotFoundError(f"no financial_events data at {lake.path('dws', 'financial_events')}")
    s, e = (to_date_param(d) if d else None for d in (start_date, end_date))
    years = [y for y in lake.years("dws", "financial_events", refresh=False) if (s is None or y >= s.year) and (e is None or y <= e.year)]
    df = lake.read_years("dws", "financial_events", years, refresh=False).where(F.col("ts_code") == F.lit(ts_code))
    if s is not None:
        df = df.where(F.col("real_ann_date") >= F.lit(s))
    if e is not None:
        df = df.where(F.col("real_ann_date") <= F.lit(e))
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in EVENT_COLUMNS]
    return df.select(*cols).orderBy(F.col("real_ann_date").asc_nulls_last(),
                                    F.col("end_date").asc_nulls_last(),
                                    F.col("source_table").asc_nulls_last())


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)
