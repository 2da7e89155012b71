"""Whole flows on a small market of our own: three symbols on two exchanges
over a year end, with a late correction, a restated figure and a statement
"""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators.calendar import clean_calendar, recent_trade_dates
from ledgerlake.plans.lakehouse import daily_update, history_build
from ledgerlake.session import scratch_path

OPEN_DAYS = ["2021-12-28", "2021-12-29", "2021-12-30", "2022-01-04", "2022-01-05", "2022-01-06", "2022-01-07"]
SYMBOLS = {"ALFA.X": 20.0, "BETA.X": 55.5, "GAMA.Y": 7.25}


def text_table(spark, columns, rows):
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], ", ".join(f"{c} string" for c in columns.split()))


def market(spark, days=OPEN_DAYS, bump=0.0, restated=None):
    """Landing tables; ``bump`` moves the last day's close, ``restated``
    replaces ALFA's second figure."""
    bars, basics, factors = [], [], []
    for s, (symbol, price) in enumerate(SYMBOLS.items()):
        for k, day in enumerate(days):
            close = price + k + (bump if day == days[-1] else 0)
            bars.append((symbol, day.replace("-", "") if k % 2 else day, close, 1000 * (s + 1) + k))
            if symbol != "GAMA.Y":
                basics.append((symbol, day, round(close / 4, 3)))
            factors.append((symbol, day, 1 + s))
    bars.append(("ALFA.X", days[0], None, None))              # an emptier repeat of the first bar
    income = [("ALFA.X", "2021-12-29", "2021-12-28", "2021-09-30", 310), ("ALFA.X", "2022-01-06", None, "2021-12-31", restated or 330),
              ("BETA.X", "2022-01-05", "2022-01-04", "2021-12-31", 90), ("BETA.X", None, "2022-01-07", "2022-03-31", 95)]
    closed = [("MAIN", "2022-01-03", 0, "2021-12-30")]
    calendar = [("SSE", day, 1, None) for day in days] + [("SSE", "2022-01-03", 0, None)] + closed
    return {
        "daily": text_table(spark, "ts_code trade_date close vol", bars),
        "daily_basic": text_table(spark, "ts_code trade_date turnover", basics),
        "adj_factor": text_table(spark, "ts_code trade_date adj_factor", factors),
        "income": text_table(spark, "ts_code ann_date f_ann_date end_date amount", income),
        "trade_cal": text_table(spark, "exchange cal_date is_open pretrade_date", calendar),
        "suspend_d": spark.createDataFrame([], "ts_code string, trade_date string, suspend_timing string"),
    }


def test_history_build(spark, lake):
    report_path = scratch_path(spark, "report")
    log = history_build(spark, lake.root, market(spark), fallback_date="20210101", report_path=report_path)
    rows = {(r.layer, r.dataset_name, r.year): r.row_count for r in log.collect()}
    assert rows[("ods", "daily", 2021)] >= 9                        # the raw layer merges by key too
    assert (rows[("dwd", "daily", 2021)], rows[("dwd", "daily", 2022)]) == (9, 12)
    assert (rows[("dws", "daily_master", 2021)], rows[("dws", "daily_master", 2022)]) == (9, 12)
    assert ("dwd", "suspend_d", 2021) not in rows
    master = {(r.ts_code, r.trade_date.isoformat()): r for r in lake.scan("dws", "daily_master").collect()}
    first = master[("ALFA.X", "2021-12-28")]
    assert (first.close, first.vol, first.adj_factor) == (20.0, 1000.0, 1.0)      # the fuller row
    assert master[("GAMA.Y", "2022-01-07")].turnover is None                        # left join
    events = lake.scan("dws", "financial_events").collect()
    seen = {(r.ts_code, r.end_date.isoformat()): r.real_ann_date.isoformat() for r in events}
    assert seen == {("ALFA.X", "2021-09-30"): "2021-12-28", ("ALFA.X", "2021-12-31"): "2022-01-06", ("BETA.X", "2021-12-31"): "2022-01-04"}
    report = {r.table_name: r for r in spark.read.json(report_path).collect()}
    assert set(report) == set(market(spark))
    assert (report["daily"].rows_before, report["daily"].rows_after) == (22, 21)
    assert (report["income"].rows_before, report["suspend_d"].rows_before) == (3, 0)


def test_daily_update_corrects_and_repeats(spark, lake):
    early = OPEN_DAYS[:-1]
    history_build(spark, lake.root, market(spark, early), fallback_date="20210101")
    late = market(spark, bump=0.75, restated=333)
    assert recent_trade_dates(clean_calendar(late["trade_cal"]), "20220107", 5).count() == 5
    once = sorted(tuple(r) for r in daily_update(spark, lake.root, late, "20220107").collect())
    before = sorted(map(str, lake.scan("dws", "daily_master").collect()))
    assert sorted(tuple(r) for r in daily_update(spark, lake.root, late, "20220107").collect()) == once
    assert sorted(map(str, lake.scan("dws", "daily_master").collect())) == before
    last = lake.read_year("dws", "daily_master", 2022).where(F.col("trade_date") == dt.date(2022, 1, 7))
    assert {r.ts_code: r.close for r in last.collect()} == {"ALFA.X": 26.75, "BETA.X": 62.25, "GAMA.Y": 14.0}
    figures = lake.read_year("dwd", "income", 2022).where("ts_code = 'ALFA.X'").collect()
    assert [r.amount for r in figures] == [333.0]
    assert lake.read_year("dwd", "daily", 2021).count() == 9        # an untouched year


def test_update_takes_new_days_from_its_own_calendar(spark, lake):
    base = market(spark, OPEN_DAYS[:4])
    base["trade_cal"] = base["trade_cal"].where("cal_date <= '2021-12-30'")     # a stored calendar that stops early
    history_build(spark, lake.root, base, fallback_date="20210101")
    daily_update(spark, lake.root, market(spark), "20220107")
    got = {r.trade_date for r in lake.read_year("dwd", "daily", 2022).select("trade_date").distinct().collect()}
    assert got == {dt.date(2022, 1, d) for d in (4, 5, 6, 7)}


def test_products_follow_the_catalogue(spark):
    from ledgerlake.operators.products import build_dws_outputs, product_inputs
    assert product_inputs("daily_master") == ("daily", "daily_basic", "adj_factor")
    bars = spark.createDataFrame([("A", dt.date(2022, 1, 4), 1.0)], "ts_code string, trade_date date, close double")
    assert build_dws_outputs({"daily": bars}) == {}
    assert set(build_dws_outputs({"daily": bars, "daily_basic": bars, "adj_factor": bars})) == {"daily_master"}
