"""Incremental runs: types that no cut of the batches changes, keys that move
to another year, landing files read once, streams that go on where they died,
rejected rows, measures kept beside the data."""

import datetime as dt
import glob
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.asof import asof_join, asof_join_by_group
from ledgerlake.operators.calendar import coverage_missing_dates, coverage_summary, day_bitmaps, merge_day_bitmaps
from ledgerlake.plans.lakehouse import daily_update, history_build, process_table, rebuild_summary, rejects
from ledgerlake.plans.quality_state import batch_state, column_state, state_report
from ledgerlake.session import scratch_path
from ledgerlake.sources.lake import Lake
from ledgerlake.sources.landing import LandingFolder
from ledgerlake.streaming import update_stream as streams
from test_plans import plan_of

D = dt.date
KEY = ["ts_code", "trade_date"]


def bars(spark, *rows, more="code string"):
    return spark.createDataFrame(list(rows), f"ts_code string, trade_date string, close string, {more}")


# ---- types -------------------------------------------------------------------------
def test_numbers_that_turn_to_text_are_spelled_as_they_came(spark, lake):
    values = ["000123", "12345678901234567891", "1.50", "7", " 8 ", "1e3"]
    for i, v in enumerate(values):
        process_table(lake, "daily", bars(spark, (f"S{i}", f"{2020 + i}0102", "1", v)), "20150101")
    assert dict(lake.scan("dwd", "daily").dtypes)["code"] == "double"
    years = process_table(lake, "daily", bars(spark, ("T", "20210103", "2", "n/a")), "20150101")
    assert years == list(range(2020, 2026))                  # all were rewritten, so all are rebuilt
    rebuild_summary(lake, years)
    for layer, name in (("dwd", "daily"), ("dws", "daily_master")):
        got = {r.ts_code: r.code for r in lake.scan(layer, name).collect()}
        assert got == {**{f"S{i}": v for i, v in enumerate(values)}, "T": "n/a"}
        assert dict(lake.scan(layer, name).dtypes)["close"] == "double"
    # text stays text for later numbers
    process_table(lake, "daily", bars(spark, ("U", "20220103", "2", "007")), "20150101")
    assert {r.code for r in lake.scan("dwd", "daily").where("ts_code = 'U'").collect()} == {"007"}


def test_a_numeric_text_keeps_a_stored_integer_column(spark, lake):
    stored = spark.createDataFrame([("A", D(2023, 1, 2), 5), ("A", D(2024, 1, 2), 2**60)], "ts_code string, trade_date date, vol bigint")
    lake.upsert("dwd", "daily", stored, KEY, "trade_date")
    before = set(lake.read_year("dwd", "daily", 2023).inputFiles())
    process_table(lake, "daily", spark.createDataFrame([("B", "20240103", "9")], "ts_code string, trade_date string, vol string"), "20150101")
    assert dict(lake.scan("dwd", "daily").dtypes)["vol"] == "bigint"
    assert set(lake.read_year("dwd", "daily", 2023).inputFiles()) == before
    # a fraction widens it to double, digits that a double cannot hold are kept
    process_table(lake, "daily", spark.createDataFrame([("C", "20240103", "9.5")], "ts_code string, trade_date string, vol string"), "20150101")
    assert dict(lake.scan("dwd", "daily").dtypes)["vol"] == "double"
    process_table(lake, "daily", spark.createDataFrame([("D", "20240103", "x")], "ts_code string, trade_date string, vol string"), "20150101")
    got = {(r.ts_code, r.year): r.vol for r in lake.scan("dwd", "daily").collect()}
    assert got[("A", 2024)] == str(2**60) and got[("C", 2024)] == "9.5" and got[("D", 2024)] == "x"


def test_spelling_is_no_column_of_the_table(spark, lake):
    process_table(lake, "daily", bars(spark, ("A", "20240102", "1.50", "07")), "20150101")
    assert "__spelling" not in lake.scan("dwd", "daily").columns + lake.read_year("dwd", "daily", 2024).columns
    rebuild_summary(lake, [2024])
    assert "__spelling" not in lake.scan("dws", "daily_master").columns


# ---- lake --------------------------------------------------------------------------
def test_a_key_that_changes_its_year_has_one_row(spark, lake):
    def rows(*some):
        return spark.createDataFrame(list(some), "k string, day date, v int")

    lake.upsert("dwd", "daily", rows(("A", D(2023, 1, 2), 1), ("B", D(2023, 5, 2), 1), ("C", D(2022, 5, 2), 1), (None, D(2022, 1, 1), 1)), ["k"], "day")
    # A moves on, C moves back over a year it leaves empty, the null key moves too
    assert lake.upsert("dwd", "daily", rows(("A", D(2024, 1, 2), 2), ("C", D(2021, 1, 1), 2), (None, D(2024, 1, 1), 2)), ["k"], "day", across_years=True) == [2021, 2022, 2023, 2024]
    got = sorted(((r.k or "", r.year, r.v) for r in lake.scan("dwd", "daily").collect()))
    assert got == [("", 2024, 2), ("A", 2024, 2), ("B", 2023, 1), ("C", 2021, 2)]
    assert lake.read_year("dwd", "daily", 2022).count() == 0


def test_reads_of_other_lake_objects_see_new_years_and_types(spark, lake):
    other = Lake(spark, lake.root)
    assert other.scan("dwd", "daily") is None
    lake.upsert("dwd", "daily", spark.createDataFrame([("A", D(2023, 1, 2), 1)], "ts_code string, trade_date date, v int"), KEY, "trade_date")
    assert other.scan("dwd", "daily").count() == 1
    lake.upsert("dwd", "daily", spark.createDataFrame([("A", D(2024, 1, 2), "x")], "ts_code string, trade_date date, v string"), KEY, "trade_date")
    assert sorted(r.v for r in other.scan("dwd", "daily").collect()) == ["1", "x"]
    assert other.years("dwd", "daily") == [2023, 2024] and other.read_years("dwd", "daily", [2024, 2030]).count() == 1


def test_files_are_zstd(spark, lake):
    lake.upsert("dwd", "daily", spark.createDataFrame([("A", D(2023, 1, 2), 1)], "ts_code string, trade_date date, v int"), KEY, "trade_date")
    files = glob.glob(f"{lake.root.removeprefix('file:')}/dwd/daily/year=2023/*.parquet")
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def rows_read(df):
    """Rows that the Parquet scan handed on (row groups that were not skipped)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_symbol_lookup_skips_row_groups_by_their_bloom_filter(spark, lake):
    n = 60_000                       # too many symbols for a dictionary page, dealt out so that ranges do not tell
    df = spark.range(n).select(F.concat(F.lit("S"), F.sha2(F.col("id").cast("string"), 256)).alias("ts_code"), F.lit(D(2024, 1, 2)).alias("trade_date"))
    conf = {"parquet.block.size": 1 << 18, "parquet.bloom.filter.enabled#ts_code": "true"}
    path = scratch_path(spark, "blooms")
    df.coalesce(1).write.options(**conf).parquet(path)
    wanted = df.where("ts_code like 'S5%'").first().ts_code
    read = rows_read(spark.read.parquet(path).where(F.col("ts_code") == wanted))
    assert 0 < read < n / 2
    assert lake.write_years("dws", "daily_master", df, "trade_date") == [2024]
    assert lake.read_year("dws", "daily_master", 2024).where(F.col("ts_code") == wanted).count() == 1


def test_events_query_lists_only_the_years_of_its_range(spark, lake):
    from ledgerlake.plans.query import query_financial_events
    from ledgerlake.specs import EVENT_COLUMNS
    rows = [("A", "income", D(y, 5, 1), None, D(y, 5, 1), D(y, 3, 31), "1", "1", "0") for y in (2021, 2022, 2023)]
    ev = spark.createDataFrame(rows, ", ".join(f"{c} {'date' if c.endswith('date') else 'string'}" for c in EVENT_COLUMNS))
    lake.write_years("dws", "financial_events", ev, "real_ann_date")
    asked = query_financial_events(lake, "A", "20220101", "20221231")
    assert {f.split("/year=")[1][:4] for f in asked.inputFiles()} == {"2022"}
    assert asked.count() == 1 and query_financial_events(lake, "A").count() == 3 and query_financial_events(lake, "A", "20300101").count() == 0


# ---- landing folders ------------------------------------------------------------------
CAL = [("SSE", f"202401{d:02d}", "1") for d in range(1, 31)]


def test_only_new_files_are_read(spark):
    home = scratch_path(spark, "landing")
    schema = "ts_code string, trade_date string, close string, code string"

    def run(root, landing, as_of):
        cal = spark.createDataFrame(CAL, "exchange string, cal_date string, is_open string")
        daily_update(spark, root, {"daily": landing, "trade_cal": cal}, as_of)

    lakes = [Lake(spark, scratch_path(spark, "lake")) for _ in range(2)]
    bars(spark, ("A", "20240103", "1", "x"), ("A", "20240112", "5", "later")).write.parquet(f"{home}/one")
    folder = LandingFolder(spark, home, schema, f"{home}-state")
    assert len(folder.new_files()) >= 1
    run(lakes[0].root, folder, "20240104")
    run(lakes[1].root, spark.read.schema(schema).parquet(f"{home}/one"), "20240104")
    bars(spark, ("A", "20240104", "2", "y"), ("A", "20240103", "3", "z")).write.parquet(f"{home}/two")
    folder = LandingFolder(spark, home, schema, f"{home}-state")
    waiting = folder.new_files()
    # the file with a day behind the first run's window is read again, no other
    assert any("/two/" in f for f in waiting) and all("/two/" in f or _later(spark, f) for f in waiting)
    assert set(map(_tail, folder.rows().inputFiles())) == set(map(_tail, waiting))
    for as_of, n in (("20240107", 2), ("20240112", 3)):
        run(lakes[0].root, LandingFolder(spark, home, schema, f"{home}-state"), as_of)
        run(lakes[1].root, spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(home), as_of)
        got = [sorted((r.ts_code, r.trade_date, r.close, r.code) for r in lake.scan("dws", "daily_master").collect()) for lake in lakes]
        assert got[0] == got[1] and len(got[0]) == n and got[0][0][2] == 3.0
    assert LandingFolder(spark, home, schema, f"{home}-state").new_files() == []
    run(lakes[0].root, LandingFolder(spark, home, schema, f"{home}-state"), "20240112")      # nothing to read


def _later(spark, path):
    return spark.read.parquet(path).where("trade_date > '20240104'").count() > 0


def _tail(path):
    return path.rsplit("/", 1)[-1]


def test_a_file_written_anew_is_new(spark):
    home = scratch_path(spark, "landing")
    spark.range(1).select(F.lit("a").alias("v")).coalesce(1).write.parquet(home)
    folder = LandingFolder(spark, home, "v string", f"{home}-state")
    assert folder.commit() == 0                     # nothing was read
    first = folder.new_files()
    assert folder.commit() == len(first) and folder.new_files() == []
    spark.range(2).select(F.lit("b").alias("v")).coalesce(1).write.mode("overwrite").parquet(home)
    assert folder.__class__(spark, home, "v string", f"{home}-state").rows().count() == 2


# ---- streams ------------------------------------------------------------------------
@pytest.mark.parametrize("dies", ["summary", "detail"])
def test_a_stream_that_died_goes_on_behind_the_last_step(spark, monkeypatch, dies):
    home, root = scratch_path(spark, "stream"), scratch_path(spark, "lake")
    rows = bars(spark, ("A", "20240102", "1", "x"), ("B", "20230102", "2", "y"))
    rows.write.parquet(f"{home}/in")
    steps = []
    real = {"raw": streams.process_table.__globals__["write_raw"], "detail": streams.process_table.__globals__["persist_detail"], "summary": streams.rebuild_summary}
    broken = {dies}

    def spied(step):
        def run(*args, **kw):
            steps.append(step)
            if step in broken:
                raise RuntimeError(f"lost in {step}")
            return real[step](*args, **kw)
        return run

    monkeypatch.setitem(streams.process_table.__globals__, "write_raw", spied("raw"))
    monkeypatch.setitem(streams.process_table.__globals__, "persist_detail", spied("detail"))
    monkeypatch.setattr(streams, "rebuild_summary", spied("summary"))

    def drain():
        streams.drain(spark, {"daily": (f"{home}/in", rows.schema)}, root, f"{home}/checkpoints")

    with pytest.raises(Exception, match="lost in"):
        drain()
    broken.clear()
    drain()
    assert steps == (["raw", "detail", "summary", "summary"] if dies == "summary" else ["raw", "detail", "detail", "summary"])
    lake = Lake(spark, root)
    assert sorted((r.ts_code, r.close) for r in lake.scan("dws", "daily_master").collect()) == [("A", 1.0), ("B", 2.0)]
    drain()
    assert len(steps) == 4                           # no new file, no step


# ---- coverage ------------------------------------------------------------------------
def test_groups_without_rows_and_merged_bitmaps(spark):
    cal = spark.createDataFrame([("SSE", D(2024, 1, d), int(d % 7 not in (6, 0))) for d in range(1, 31)], "exchange string, cal_date date, is_open int")
    rows = spark.createDataFrame([("A", D(2024, 1, 2)), ("A", D(2024, 1, 2)), ("A", D(2024, 1, 30)), ("A", D(2024, 1, 6)), ("A", D(2025, 1, 2)), ("A", None),
                                  ("Z", D(2024, 1, 3)), (None, D(2024, 1, 4))], "s string, d date")
    universe = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "s string")
    got = {r.s: r for r in coverage_summary(cal, rows, "d", "20240101", "20240130", ["s"], universe=universe).collect()}
    open_days = sorted(r.cal_date for r in cal.where("is_open = 1").collect())
    assert set(got) == {"A", "B", None}
    for s, days in (("A", {D(2024, 1, 2), D(2024, 1, 30), D(2024, 1, 6), D(2025, 1, 2)}), ("B", set()), (None, {D(2024, 1, 4)})):
        assert got[s].missing_dates == [d for d in open_days if d not in days]
        assert (got[s].expected_dates, got[s].actual_dates, got[s].covered_dates) == (len(open_days), len(days), sum(d in days for d in open_days))
    assert coverage_missing_dates(cal, rows, "d", "20240101", "20240130", ["s"], universe=universe).where("s = 'B'").count() == len(open_days)
    parts = [day_bitmaps(rows.where(c), "d", "20240101", "20240130", ["s"]) for c in ("day(d) < 5", "day(d) >= 5")]
    merged = merge_day_bitmaps(parts[0].unionByName(parts[1]), ["s"])
    whole = day_bitmaps(rows, "d", "20240101", "20240130", ["s"])
    assert sorted(merged.where("s is not null").collect()) == sorted(whole.where("s is not null").collect())
    with pytest.raises(ValueError):
        coverage_summary(cal, rows, "d", "19000101", "20240130")


# ---- as-of -----------------------------------------------------------------------------
def brute(left, right):
    out = []
    for k, d in left:
        found = [(e, i) for kk, e, i in right if k is not None and kk == k and d is not None and e is not None and e <= d]
        out.append((k, d, max(found)[1] if found else None))
    return sorted(out, key=str)


def test_asof_of_dates_reads_the_left_side_once(spark):
    path = scratch_path(spark, "asof")
    left = [("HOT", D(2019, 1, 1) + dt.timedelta(days=3 * i % 2500)) for i in range(400)] + [("K", D(2030, 1, 1)), ("K", D(1990, 1, 1)), (None, D(2020, 1, 1)), ("K", None), ("none", D(2020, 1, 1))]
    right = [("HOT", D(2018, 12, 31) + dt.timedelta(days=97 * i), i) for i in range(20)] + [("K", D(2020, 2, 29), 100), ("K", D(2020, 2, 29), 101), ("K", None, 7), (None, D(2000, 1, 1), 8)]
    spark.createDataFrame(left, "k string, d date").withColumn("days", F.lit("clash")).write.parquet(path)
    t, e = spark.read.parquet(path), spark.createDataFrame(right, "k string, ed date, eid int")
    joined = asof_join(t, e, by="k", left_on="d", right_on="ed", columns=["eid"], tiebreak=["eid"])
    assert sorted(((r.k, r.d, r.eid) for r in joined.collect()), key=str) == brute(left, right)
    assert joined.columns == ["k", "d", "days", "ed", "eid"]
    # a frame that has not run: afterwards the plan is printed as planned and as executed
    plan = plan_of(asof_join(t, e, by="k", left_on="d", right_on="ed", columns=["eid"], tiebreak=["eid"]), "simple")
    assert plan.count("FileScan parquet") == 1
    none = asof_join(t, e.where("eid < 0"), by="k", left_on="d", right_on="ed", columns=["eid"])
    assert none.where("eid IS NULL").count() == len(left)


def test_asof_by_group_of_dates(spark):
    t = spark.createDataFrame([("A", D(2021, 5, 1)), ("A", D(2023, 1, 1)), ("A", D(2019, 1, 1))], "k string, d date")
    e = spark.createDataFrame([("A", D(2020, 1, 1), "x", 1), ("A", D(2021, 1, 1), "y", 2), ("A", D(2022, 6, 1), "y", 3)], "k string, ed date, g string, v int")
    got = {r.d.year: (r.x_v, r.y_v) for r in asof_join_by_group(t, e, by="k", left_on="d", right_on="ed", group_col="g", groups=["x", "y"], columns=["v"]).collect()}
    assert got == {2021: (1, 2), 2023: (1, 3), 2019: (None, None)}


def test_asof_of_numbers_with_an_outlier_spreads_the_others(spark):
    events = [("HOT", i, i) for i in range(10_000)] + [("HOT", 10**18, 10_000)]
    e = spark.createDataFrame(events, "k string, ed long, eid int")
    left = [("HOT", i * 7 % 10_500) for i in range(500)] + [("HOT", 10**18), ("HOT", -1)]
    t = spark.createDataFrame(left, "k string, d long")
    joined = asof_join(t, e, by="k", left_on="d", right_on="ed", columns=["eid"])
    assert sorted(((r.k, r.d, r.eid) for r in joined.collect()), key=str) == brute(left, events)
    from ledgerlake.operators.asof import _span
    sizes = e.groupBy(_span(e, "ed", "auto")(F.col("ed")).alias("b")).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 200 and sizes[1] > 500


# ---- rejects and measures ----------------------------------------------------------------
def test_rejected_rows_and_measures_by_batch(spark, lake):
    fin = spark.createDataFrame([("A", "20240331", "20240401", "1", "5"), ("A", "20240331", None, "1", "6"), ("A", "20240331", "20240402", "2", "7"),
                                 ("A", "20240331", "soon", "2", "8"), ("A", "20240331", "20240403", None, "9")],
                                "ts_code string, end_date string, ann_date string, report_type string, revenue string")
    for _ in range(2):
        process_table(lake, "income", fin, "20150101", batch="one")
    got = sorted((r.reason, json.loads(r.row)["revenue"]) for r in rejects(lake).collect())
    assert got == [("no announcement date", "6"), ("no announcement date", "8"), ("other statement type", "7"), ("other statement type", "9")]
    state = batch_state(lake).first()
    assert (state.landed_rows, state.rows_before, state.n_batches) == (5, 1, 1) and lake.scan("dwd", "income").count() == 1
    process_table(lake, "income", fin.withColumn("ann_date", F.lit("20250401")).withColumn("extra", F.lit("x")), "20150101", batch="two")
    cols = {r.column_name: (r.row_count, r.null_count) for r in column_state(lake).collect()}
    stored = lake.scan("dwd", "income")
    assert cols == {c: (stored.count(), stored.where(F.col(c).isNull()).count()) for c in stored.columns if c != "year"}
    fetch = spark.createDataFrame([("income", 12)], "table_name string, fetched_rows long")
    row = state_report(lake, fetch).first()
    assert row.fetched_rows == 12 and row.n_batches == 2 and [p.year for p in row.partitions] == [2024, 2025] and row.null_counts["extra"] == 1


def test_history_without_a_side_table(spark, lake):
    history_build(spark, lake.root, {"daily": bars(spark, ("A", "20240102", "1", "x"))})
    assert lake.scan("dws", "daily_master").count() == 1
