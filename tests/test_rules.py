"""Semantic rules of the survey (§7.3) not covered elsewhere: null join keys,
null partition years, missing summary inputs, query ranges, empty event
stream, affected-year rewrites."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.products import build_daily_master, build_financial_event_stream, left_join_suffix
from ledgerlake.plans.query import query_daily_master, query_financial_events
from ledgerlake.specs import EVENT_COLUMNS

D = dt.date


def test_null_keys_never_match_in_joins(spark):
    left = spark.createDataFrame([(None, D(2025, 1, 2), 1.0), ("A", D(2025, 1, 2), 2.0)],
                                 "ts_code string, trade_date date, close double")
    right = spark.createDataFrame([(None, D(2025, 1, 2), 9.0), ("A", D(2025, 1, 2), 8.0)],
                                  "ts_code string, trade_date date, close double")
    got = {r.ts_code: r.close_daily_basic for r in
           left_join_suffix(left, right, ["ts_code", "trade_date"], "_daily_basic").collect()}
    assert got == {None: None, "A": 8.0}


def test_null_partition_year_is_not_written(spark, lake):
    df = spark.createDataFrame([("A", D(2024, 5, 1), 1.0), ("B", None, 2.0)],
                               "ts_code string, trade_date date, close double")
    years = lake.upsert("dwd", "daily", df, ["ts_code", "trade_date"], "trade_date")
    assert years == [2024]
    stored = lake.scan("dwd", "daily")
    assert [r.ts_code for r in stored.collect()] == ["A"]
    assert [tuple(r) for r in lake.null_year_report().collect()] == [("dwd", "daily", 1)]


def test_upsert_rewrites_only_touched_years(spark, lake):
    base = spark.createDataFrame([("A", D(2023, 3, 1), 1.0), ("A", D(2024, 3, 1), 2.0)],
                                 "ts_code string, trade_date date, close double")
    lake.upsert("dwd", "daily", base, ["ts_code", "trade_date"], "trade_date")
    files_2023 = {r[0] for r in lake.read_year("dwd", "daily", 2023).select(F.input_file_name()).collect()}
    upd = spark.createDataFrame([("A", D(2024, 3, 1), 3.0), ("B", D(2024, 3, 2), 4.0)],
                                "ts_code string, trade_date date, close double")
    assert lake.upsert("dwd", "daily", upd, ["ts_code", "trade_date"], "trade_date") == [2024]
    after_2023 = {r[0] for r in lake.read_year("dwd", "daily", 2023).select(F.input_file_name()).collect()}
    assert after_2023 == files_2023           # the untouched year's files are the same files
    got = sorted((r.ts_code, r.trade_date, r.close) for r in lake.scan("dwd", "daily").collect())
    assert got == [("A", D(2023, 3, 1), 1.0), ("A", D(2024, 3, 1), 3.0), ("B", D(2024, 3, 2), 4.0)]


def test_daily_master_with_empty_side_tables_gives_nulls(spark):
    daily = spark.createDataFrame([("A", D(2025, 1, 2), 10.0)], "ts_code string, trade_date date, close double")
    empty = spark.createDataFrame([], "ts_code string, trade_date date")
    out = build_daily_master(daily, empty, empty).collect()
    assert len(out) == 1 and out[0].close == 10.0


def test_empty_event_stream_has_the_nine_typed_columns(spark):
    out = build_financial_event_stream({"income": None}, spark)
    assert out.columns == list(EVENT_COLUMNS) and dict(out.dtypes)["real_ann_date"] == "date"
    assert out.count() == 0


def test_query_ranges_are_closed_and_falsy_means_no_filter(spark, lake):
    rows = [("A", D(2025, 1, d), float(d)) for d in (2, 3, 6, 7)] + [("B", D(2025, 1, 3), 1.0)]
    dm = spark.createDataFrame(rows, "ts_code string, trade_date date, close double")
    lake.write_years("dws", "daily_master", dm, "trade_date")
    got = query_daily_master(lake, 2025, "A", "20250103", "2025-01-06").collect()
    assert [r.trade_date.day for r in got] == [3, 6]
    assert "year" not in got[0].asDict()
    assert query_daily_master(lake, 2025, "", None, "").count() == 5
    with pytest.raises(FileNotFoundError):
        query_daily_master(lake.__class__(spark, lake.root + "-none"), 2025).collect()


def test_financial_events_query_needs_a_symbol_and_bounds_years(spark, lake):
    ev = spark.createDataFrame(
        [("A", "income", D(2024, 12, 31), None, D(2024, 12, 30), D(2024, 9, 30), "1", "1", "0"),
         ("A", "income", D(2025, 1, 6), D(2025, 1, 5), D(2025, 1, 5), D(2024, 12, 31), "1", "1", "0"),
         ("B", "income", D(2025, 1, 6), None, D(2025, 1, 6), D(2024, 12, 31), "1", "1", "0")],
        ", ".join(f"{c} {'date' if c.endswith('date') else 'string'}" for c in EVENT_COLUMNS))
    lake.write_years("dws", "financial_events", ev, "real_ann_date")
    got = query_financial_events(lake, "A", "20250101").collect()
    assert [(r.ts_code, r.real_ann_date) for r in got] == [("A", D(2025, 1, 5))]
    assert query_financial_events(lake, "A").count() == 2
    with pytest.raises(ValueError):
        query_financial_events(lake, "")


def test_upsert_keeps_the_fuller_row_and_null_keys(spark, lake):
    base = spark.createDataFrame(
        [("A", D(2024, 1, 2), 1.0, None), ("B", D(2024, 1, 2), 2.0, "x"), (None, D(2024, 1, 3), 3.0, None),
         ("C", D(2024, 2, 1), 4.0, "y")], "ts_code string, trade_date date, close double, tag string")
    key = ["ts_code", "trade_date"]
    lake.upsert("dwd", "daily", base, key, "trade_date")
    upd = spark.createDataFrame(
        [("A", D(2024, 1, 2), 5.0, "z"), ("B", D(2024, 1, 2), None, None), (None, D(2024, 1, 3), 6.0, None)],
        "ts_code string, trade_date date, close double, tag string")
    lake.upsert("dwd", "daily", upd, key, "trade_date")
    got = {r.ts_code: (r.close, r.tag) for r in lake.scan("dwd", "daily").collect()}
    # A: fuller new row wins; B: old fuller row stays; null key: tie on completeness -> newer batch
    assert got == {"A": (5.0, "z"), "B": (2.0, "x"), None: (6.0, None), "C": (4.0, "y")}


def test_stored_dataset_fixes_column_types_for_later_batches(spark, lake):
    from ledgerlake.plans.lakehouse import process_table
    first = spark.createDataFrame([("A", "20250102", "10.5", "x1"), ("B", "20250102", "11", "7")],
                                  "ts_code string, trade_date string, close string, note string")
    process_table(lake, "daily", first, "20150101")
    later = spark.createDataFrame([("A", "20250103", "12", "8")],
                                  "ts_code string, trade_date string, close string, note string")
    process_table(lake, "daily", later, "20150101")
    types = dict(lake.scan("dwd", "daily").dtypes)
    assert types["close"] == "double" and types["note"] == "string"   # note stays text
    notes = sorted(r.note for r in lake.scan("dwd", "daily").collect())
    assert notes == ["7", "8", "x1"]


def test_landing_files_need_no_staging(spark, lake):
    from ledgerlake.plans.lakehouse import history_build
    from ledgerlake.session import scratch_path
    path = scratch_path(spark, "landing-files")
    spark.createDataFrame([("A", "20250102", "10.5"), ("A", "20250102", None), ("B", "20250103", "11")],
                          "ts_code string, trade_date string, close string").write.parquet(path)
    log = history_build(spark, lake.root, {"daily": spark.read.parquet(path)}, stage_landing=False)
    got = {(r.layer, r.dataset_name, r.year): r.row_count for r in log.collect()}
    assert got == {("ods", "daily", 2025): 2, ("dwd", "daily", 2025): 2, ("dws", "daily_master", 2025): 2}
    closes = {r.ts_code: r.close for r in lake.scan("dwd", "daily").collect()}
    assert closes == {"A": 10.5, "B": 11.0}


def test_a_column_added_by_a_later_year_is_read_with_nulls_elsewhere(spark, lake):
    a = spark.createDataFrame([("A", D(2023, 5, 1), 1.0)], "ts_code string, trade_date date, close double")
    lake.upsert("dwd", "daily", a, ["ts_code", "trade_date"], "trade_date")
    b = spark.createDataFrame([("A", D(2024, 5, 1), 2.0, 7.0)],
                              "ts_code string, trade_date date, close double, vol double")
    lake.upsert("dwd", "daily", b, ["ts_code", "trade_date"], "trade_date")
    got = {r.trade_date.year: r.vol for r in lake.scan("dwd", "daily").collect()}
    assert got == {2023: None, 2024: 7.0}
