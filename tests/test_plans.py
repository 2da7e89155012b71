"""Plan shapes the scale design relies on, read from ``explain()``."""

import contextlib
import datetime as dt
import io

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerlake.operators.asof import asof_join
from ledgerlake.operators.dedup import survivorship_dedup
from ledgerlake.plans.query import query_daily_master


def plan_of(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_dedup_limits_each_key_before_the_shuffle(spark):
    # one key holds a third of the rows
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit("HOT"))
                                     .otherwise(F.col("id").cast("string")).alias("k"),
                                     F.col("id").alias("v"))
    plan = plan_of(survivorship_dedup(df, ["k"]), "simple")
    before_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_exchange          # partial limit on the map side
    assert survivorship_dedup(df, ["k"]).where(F.col("k") == "HOT").count() == 1


def test_asof_has_no_cartesian_or_nested_loop(spark):
    t = spark.createDataFrame([("A", dt.date(2024, 1, 5))], "k string, d date")
    e = spark.createDataFrame([("A", dt.date(2024, 1, 2), 1)], "k string, ed date, eid int")
    plan = plan_of(asof_join(t, e, by="k", left_on="d", right_on="ed", columns=["eid"]))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_query_prunes_years_and_pushes_filters(spark, lake):
    rows = [("A", dt.date(2024, 1, 2), 1.0), ("A", dt.date(2025, 1, 2), 2.0)]
    lake.write_years("dws", "daily_master", spark.createDataFrame(rows, "ts_code string, trade_date date, close double"),
                     "trade_date")
    plan = plan_of(query_daily_master(lake, 2025, "A", "20250101", "20250131"))
    assert "PartitionFilters: [isnotnull(year" in plan and "= 2025)" in plan
    assert "EqualTo(ts_code,A)" in plan and "GreaterThanOrEqual(trade_date,2025-01-01)" in plan


def test_files_are_zstd_and_hold_bounded_rows(spark, lake):
    lake.max_rows_per_file = 400
    rows = spark.range(3000).select(F.format_string("S%04d", F.col("id") % 90).alias("ts_code"), F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 700).cast("int")).alias("trade_date"),
                                    F.col("id").alias("vol"))
    lake.write_years("dwd", "daily", rows, "trade_date", sort_cols=("ts_code", "trade_date"))
    files = [r[0] for r in lake.scan("dwd", "daily").select(F.input_file_name()).distinct().collect()]
    total = 0
    for f in files:
        footer = pq.read_metadata(f.removeprefix("file://").removeprefix("file:"))
        total += footer.num_rows
        assert 0 < footer.num_rows <= 400
        groups = [footer.row_group(g) for g in range(footer.num_row_groups)]
        assert {g.column(c).compression for g in groups for c in range(g.num_columns)} == {"ZSTD"}
        codes = [g.column(c).statistics for g in groups for c in range(g.num_columns) if g.column(c).path_in_schema == "ts_code"]
        assert all(s.min <= s.max for s in codes)
    assert total == 3000
