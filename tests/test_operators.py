"""Operator semantics: edge values, tie rules, widening, as-of against brute
force, coverage, chunking."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.casting import cast_numeric_like, numeric_like_profile
from ledgerlake.functions.dates import parse_date_multi
from ledgerlake.operators.asof import asof_join
from ledgerlake.operators.batching import chunk_ids
from ledgerlake.operators.calendar import (coverage_summary, latest_trade_date, recent_trade_dates,
                                           trade_dates_between)
from ledgerlake.operators.clean import clean_table, empty_table
from ledgerlake.operators.dedup import pk_duplicate_count, survivorship_dedup
from ledgerlake.operators.quality import null_profile
from ledgerlake.operators.union import union_aligned


def test_date_edge_values(spark):
    vals = ["", "None", "null", "NULL", None, " 20250103 ", "2025-1-3", "2025/01/03", "20250230",
            "13:00-15:00", "\t20250105\n"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.d for r in df.select(parse_date_multi("v").alias("d")).collect()]
    d3 = dt.date(2025, 1, 3)
    assert got == [None, None, None, None, None, d3, d3, d3, None, None, dt.date(2025, 1, 5)]


def test_numeric_like_edge_values(spark):
    df = spark.createDataFrame(
        [("+1.5", ".5", "1e3", " 7 ", "NaN", "1", None), ("-2", "3", "2E-2", "8", "1", "x", None)],
        "a string, b string, c string, d string, e string, f string, g string")
    prof = {r.column_name: r.all_numeric for r in numeric_like_profile(df).collect()}
    assert prof == {"a": True, "b": True, "c": True, "d": True, "e": False, "f": False, "g": True}
    out = cast_numeric_like(df)
    types = dict(out.dtypes)
    assert types["a"] == types["g"] == "double" and types["e"] == types["f"] == "string"
    assert out.collect()[0].d == 7.0


def test_update_flag_beats_completeness_and_completeness_beats_recency(spark):
    df = spark.createDataFrame(
        [("A", "1", None, 1), ("A", "0", 5.0, 2), ("B", "0", None, 3), ("B", "0", 6.0, 1)],
        "ts_code string, update_flag string, close double, seq int")
    out = {r.ts_code: r.seq for r in survivorship_dedup(df, ["ts_code"], order_first=["seq"]).collect()}
    assert out == {"A": 1, "B": 1}


def test_dedup_is_order_and_partition_invariant(spark):
    rows = [(f"K{i % 7}", i % 3, None if i % 4 == 0 else float(i % 5), f"t{i % 2}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, a int, b double, c string")
    base = sorted(survivorship_dedup(df, ["k"]).collect())
    random.seed(3)
    random.shuffle(rows)
    shuffled = spark.createDataFrame(rows, df.schema).repartition(5)
    assert sorted(survivorship_dedup(shuffled, ["k"]).collect()) == base
    again = survivorship_dedup(survivorship_dedup(df, ["k"]), ["k"])
    assert sorted(again.collect()) == base


def test_null_keys_group_in_dedup_and_duplicate_count(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert survivorship_dedup(df, ["k"]).count() == 2
    assert pk_duplicate_count(df, ["k"]).collect()[0].duplicate_rows == 1
    assert pk_duplicate_count(df.limit(0), ["k"]).collect()[0].duplicate_rows == 0


def test_missing_key_column_is_a_clear_error(spark):
    df = spark.createDataFrame([("x", "20250101")], "ts_code string, ann_date string")
    with pytest.raises(KeyError, match="end_date"):
        clean_table("income", df)


def test_null_profile_counts_nulls_not_nan(spark):
    df = spark.createDataFrame([(float("nan"), None), (1.0, "x")], "a double, b string")
    prof = {r.column_name: r.null_count for r in null_profile(df, "t").collect()}
    assert prof == {"a": 0, "b": 1}


def test_union_widening(spark):
    a = spark.createDataFrame([(1, 1.5, dt.date(2025, 1, 1))], "id int, v double, d date")
    b = spark.createDataFrame([(2, "abc", "n/a", 7)], "id long, v string, d string, extra int")
    out = union_aligned([a, b])
    assert dict(out.dtypes) == {"id": "bigint", "v": "string", "d": "string", "extra": "int"}
    assert sorted(r.v for r in out.collect()) == ["1.5", "abc"]


def test_empty_table_is_typed(spark):
    e = empty_table(spark, "income", {"revenue": __import__("pyspark.sql.types", fromlist=["x"]).DoubleType()})
    assert dict(e.dtypes)["ann_date"] == "date" and "real_ann_date" in e.columns and e.count() == 0


def _brute_asof(trades, events):
    out = []
    for k, d in trades:
        cands = [(ed, eid) for ek, ed, eid in events if ek == k and ed is not None and ed <= d]
        out.append((k, d, max(cands)[1] if cands else None))
    return sorted(out, key=lambda r: (r[0], r[1], r[2] or -1))


def test_asof_matches_brute_force_with_a_hot_key(spark):
    random.seed(7)
    base = dt.date(2024, 1, 1)
    keys = ["HOT"] * 300 + [f"K{i}" for i in range(40)]
    trades = [(random.choice(keys), base + dt.timedelta(days=random.randint(0, 60))) for _ in range(600)]
    events = [(random.choice(keys + [None]), random.choice([None] + [base + dt.timedelta(days=random.randint(-5, 60))] * 9), i)
              for i in range(400)]
    t = spark.createDataFrame(trades, "k string, d date")
    e = spark.createDataFrame(events, "k string, ed date, eid int")
    got = asof_join(t, e, by="k", left_on="d", right_on="ed", columns=["eid"], tiebreak=["eid"])
    got = sorted(((r.k, r.d, r.eid) for r in got.collect()), key=lambda r: (r[0], r[1], r[2] or -1))
    assert got == _brute_asof(trades, events)
    # never looks into the future
    bad = asof_join(t, e, by="k", left_on="d", right_on="ed", columns=["eid"]).where(F.col("ed") > F.col("d"))
    assert bad.count() == 0


def test_calendar_functions(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(14)]
    cal = spark.createDataFrame([("SSE", d, 0 if d.weekday() >= 5 else 1) for d in days],
                                "exchange string, cal_date date, is_open int")
    assert [r.cal_date.day for r in trade_dates_between(cal, "20240105", "2024-01-09").collect()] == [5, 8, 9]
    assert latest_trade_date(cal, "20240107").collect()[0].latest_open == dt.date(2024, 1, 5)
    assert latest_trade_date(cal, "20231231").collect()[0].latest_open is None
    assert [r.cal_date.day for r in recent_trade_dates(cal, "20240114", 3).collect()] == [10, 11, 12]
    with pytest.raises(ValueError):
        recent_trade_dates(cal, "20240114", 0)
    actual = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 1, 2),), (dt.date(2030, 1, 1),)], "d date")
    cov = coverage_summary(cal, actual, "d", "20240101", "20240105").collect()[0]
    assert (cov.expected_dates, cov.actual_dates, cov.covered_dates) == (5, 2, 1)
    assert [x.day for x in cov.missing_dates] == [1, 3, 4, 5]


def test_chunk_ids_are_consecutive(spark):
    df = spark.range(0, 1234).select((F.col("id") * 7 % 1234).alias("k")).repartition(6)
    got = {r.k: r.batch_id for r in chunk_ids(df, ["k"], 100).collect()}
    assert all(got[k] == k // 100 for k in range(1234))


def test_empty_batch_keeps_landing_types_and_gets_statement_extras(spark):
    df = spark.createDataFrame([], "ts_code string, ann_date string, end_date string, revenue string")
    out = clean_table("income", df).frame
    types = dict(out.dtypes)
    assert types["ann_date"] == types["real_ann_date"] == "date" and types["revenue"] == "string"
    assert "source_table" in types and out.count() == 0


@pytest.mark.parametrize("bucket", ["year", "month", None])
def test_asof_across_buckets_matches_brute_force(spark, bucket):
    random.seed(11)
    base = dt.date(2021, 6, 1)
    keys = ["HOT"] * 20 + [f"K{i}" for i in range(8)]
    trades = [(random.choice(keys), base + dt.timedelta(days=random.randint(0, 1500))) for _ in range(500)]
    # sparse events: many trades must take their match from an earlier year
    events = [(random.choice(keys), base + dt.timedelta(days=random.randint(-100, 1500)), i) for i in range(40)]
    t = spark.createDataFrame(trades, "k string, d date")
    e = spark.createDataFrame(events, "k string, ed date, eid int")
    got = asof_join(t, e, by="k", left_on="d", right_on="ed", columns=["eid"], tiebreak=["eid"], bucket=bucket)
    got = sorted(((r.k, r.d, r.eid) for r in got.collect()), key=lambda r: (r[0], r[1], r[2] or -1))
    assert got == _brute_asof(trades, events)


@pytest.mark.parametrize("bucket", ["auto", "hour"])
def test_asof_on_timestamps_matches_brute_force(spark, bucket):
    random.seed(5)
    base = dt.datetime(2024, 12, 30, 9, 0)
    keys = ["HOT"] * 20 + [f"K{i}" for i in range(5)]
    trades = [(random.choice(keys), base + dt.timedelta(minutes=random.randint(0, 6000))) for _ in range(400)]
    events = [(random.choice(keys), base + dt.timedelta(minutes=random.randint(-300, 6000)), i) for i in range(30)]
    t = spark.createDataFrame(trades, "k string, d timestamp_ntz")
    e = spark.createDataFrame(events, "k string, ed timestamp_ntz, eid int")
    got = asof_join(t, e, by="k", left_on="d", right_on="ed", columns=["eid"], tiebreak=["eid"], bucket=bucket)
    got = sorted(((r.k, r.d, r.eid) for r in got.collect()), key=lambda r: (r[0], r[1], r[2] or -1))
    assert got == _brute_asof(trades, events)


@pytest.mark.parametrize("bucket", ["auto", 7, None])
def test_asof_on_numbers_matches_brute_force(spark, bucket):
    random.seed(8)
    keys = ["HOT"] * 20 + [f"K{i}" for i in range(5)]
    trades = [(random.choice(keys), random.randint(-50, 3000)) for _ in range(400)]
    events = [(random.choice(keys), random.randint(0, 2500), i) for i in range(40)]
    t = spark.createDataFrame(trades, "k string, d long")
    e = spark.createDataFrame(events, "k string, ed long, eid int")
    joined = asof_join(t, e, by="k", left_on="d", right_on="ed", columns=["eid"], tiebreak=["eid"], bucket=bucket)
    got = sorted(((r.k, r.d, r.eid) for r in joined.collect()), key=lambda r: (r[0], r[1], r[2] or -1))
    assert got == _brute_asof(trades, events)
    none = asof_join(t, e.where("eid < 0"), by="k", left_on="d", right_on="ed", columns=["eid"], bucket=bucket)
    assert none.where("eid IS NULL").count() == len(trades)


def test_batch_stats_sum_and_messages_stay_rows(spark):
    from ledgerlake.operators.quality import batch_messages, batch_stats
    log = spark.createDataFrame(
        [("daily", 10, 1, 1, 0, ["retry 1"]), ("daily", 5, 1, 1, 2, ["a", "b"]), ("income", 3, 1, 1, 0, None)],
        "table_name string, fetched_rows long, request_count long, success_count long, retry_count long, "
        "messages array<string>")
    got = {r.table_name: (r.fetched_rows, r.retry_count, r.message_count) for r in batch_stats(log).collect()}
    assert got == {"daily": (15, 2, 3), "income": (3, 0, 0)}
    assert sorted(r.message for r in batch_messages(log).collect()) == ["a", "b", "retry 1"]


def test_nested_report_round_trips_as_json(spark):
    from ledgerlake.operators.quality import nested_report, table_quality, write_report
    from ledgerlake.session import scratch_path
    df = spark.createDataFrame([("A", 1.0, None), ("A", None, None), ("B", 2.0, "x")],
                               "ts_code string, close double, tag string")
    survivors = survivorship_dedup(df, ["ts_code"])
    q = table_quality("daily", df, survivors, ["ts_code"])
    parts = spark.createDataFrame([("dwd", "daily", 2025, 2), ("ods", "daily", 2025, 3)],
                                  "layer string, dataset_name string, year int, row_count long")
    rep = nested_report(q, null_profile(survivors, "daily"), parts)
    path = scratch_path(spark, "report")
    write_report(rep, path)
    row = spark.read.json(path).collect()[0]
    assert (row.rows_before, row.rows_after, row.pk_duplicates, row.nulls_total) == (3, 2, 1, 1)
    assert row.null_counts.asDict() == {"ts_code": 0, "close": 0, "tag": 1}
    assert [(p.layer, p.year, p.row_count) for p in row.partitions] == [("dwd", 2025, 2), ("ods", 2025, 3)]


def test_landing_batches_with_different_columns_concatenate(spark):
    from ledgerlake.session import scratch_path
    from ledgerlake.sources.ingest import read_landing_batches
    p1, p2 = scratch_path(spark, "batch"), scratch_path(spark, "batch")
    spark.createDataFrame([(1, float("nan"))], "id long, v double").write.parquet(p1)
    spark.createDataFrame([(2, "x", 3.5)], "id long, tag string, v double").write.parquet(p2)
    out = read_landing_batches(spark, [p1, p2])
    assert dict(out.dtypes) == {"id": "bigint", "v": "double", "tag": "string"}
    assert sorted((r.id, r.v, r.tag) for r in out.collect()) == [(1, None, None), (2, 3.5, "x")]


def test_summary_outputs_need_all_daily_inputs_and_any_statement(spark):
    from ledgerlake.operators.products import build_dws_outputs
    day = spark.createDataFrame([("A", dt.date(2025, 1, 2), 1.0)], "ts_code string, trade_date date, close double")
    inc = spark.createDataFrame([("A", dt.date(2025, 1, 6), dt.date(2024, 12, 31), dt.date(2025, 1, 5), "income")],
                                "ts_code string, ann_date date, end_date date, real_ann_date date, source_table string")
    assert set(build_dws_outputs({"daily": day, "income": inc})) == {"financial_events"}
    out = build_dws_outputs({"daily": day, "daily_basic": day, "adj_factor": day, "income": inc})
    assert set(out) == {"daily_master", "financial_events"}
    assert out["daily_master"].columns[:3] == ["ts_code", "trade_date", "close"]
    assert out["financial_events"].count() == 1


def test_observed_profile_equals_the_profile_pass(spark):
    from pyspark.sql import Observation
    from ledgerlake.functions.casting import numeric_columns_from, numeric_like_columns, numeric_profile_aggs
    df = spark.createDataFrame([(" 1.5", "a", None, "7", "1"), ("2", "3", None, "x", "0")],
                               "p string, q string, r string, s string, is_open string")
    cands, aggs = numeric_profile_aggs(df)
    obs = Observation("profile-test")
    df.observe(obs, *aggs).write.format("noop").mode("overwrite").save()
    assert sorted(numeric_columns_from(cands, obs.get)) == sorted(numeric_like_columns(df.drop("is_open")))
    assert sorted(numeric_columns_from(cands, obs.get)) == ["p", "r"]
    # stored as text stays text; s, stored as double, holds other text here and is not cast to null
    cands, aggs = numeric_profile_aggs(df, known_types={"s": "double", "p": "string"})
    obs = Observation("profile-test-known")
    df.observe(obs, *aggs).write.format("noop").mode("overwrite").save()
    assert sorted(numeric_columns_from(cands, obs.get, {"s": "double", "p": "string"})) == ["r"]
