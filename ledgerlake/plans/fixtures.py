"""Model-shaped views derived from the driver's tables.

Each view exists twice: as a Spark DataFrame built from the Parquet tables
and as DuckDB SQL over the same tables (the oracle side).  Nulls, bad
values and text forms are derived from integer ids with modular arithmetic,
identically on both sides, so every view grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(c: str):
    return F.to_date(F.col(c))


# ---------------------------------------------------------------- bars_raw
def bars_raw(spark, sf_dir) -> DataFrame:
    """Daily bars as landing text: one row per event; trade_date in four
    text forms; close null every 7th id; tag null every 5th id."""
    ev = table(spark, sf_dir, "events")
    d = _d("ts")
    form = F.col("event_id") % 4
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ts_code"),
        F.when(form == 0, F.date_format(d, "yyyyMMdd"))
         .when(form == 1, F.date_format(d, "yyyy-MM-dd"))
         .when(form == 2, F.date_format(d, "yyyy/MM/dd"))
         .otherwise(F.concat(F.lit("  "), F.date_format(d, "yyyyMMdd"), F.lit(" "))).alias("trade_date"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.format_string("%.2f", F.col("value"))).alias("close"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("event_type")).alias("tag"),
        (F.col("event_id") % 2).cast("string").alias("update_flag"),
        F.col("event_id"),
    )


BARS_RAW_SQL = """bars_raw AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS ts_code,
         CASE event_id % 4 WHEN 0 THEN strftime(CAST(ts AS DATE), '%Y%m%d')
                           WHEN 1 THEN strftime(CAST(ts AS DATE), '%Y-%m-%d')
                           WHEN 2 THEN strftime(CAST(ts AS DATE), '%Y/%m/%d')
                           ELSE '  ' || strftime(CAST(ts AS DATE), '%Y%m%d') || ' ' END AS trade_date,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE printf('%.2f', value) END AS close,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS tag,
         CAST(event_id % 2 AS VARCHAR) AS update_flag,
         event_id
  FROM events)"""


# ----------------------------------------------------------- basic / adj
def _latest_per_day(ev: DataFrame, event_type: str) -> DataFrame:
    """Typed detail rows of one event type, one per (ts_code, trade_date):
    the largest event_id of the day."""
    rows = ev.where(F.col("event_type") == event_type).select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ts_code"),
        _d("ts").alias("trade_date"), "event_id", "value")
    best = rows.groupBy("ts_code", "trade_date").agg(F.max(F.struct("event_id", "value")).alias("b"))
    return best.select("ts_code", "trade_date", F.col("b.event_id").alias("event_id"),
                       F.col("b.value").alias("value"))


def basic(spark, sf_dir) -> DataFrame:
    """daily_basic-shaped detail: close clashes with the bars on purpose."""
    rows = _latest_per_day(table(spark, sf_dir, "events"), "view")
    return rows.select("ts_code", "trade_date", F.col("value").alias("close"),
                       ((F.col("event_id") % 97).cast("double") / 4).alias("turnover_rate"),
                       "event_id")


def adj(spark, sf_dir) -> DataFrame:
    """adj_factor-shaped detail."""
    rows = _latest_per_day(table(spark, sf_dir, "events"), "purchase")
    return rows.select("ts_code", "trade_date",
                       (F.lit(1.0) + (F.col("event_id") % 13).cast("double") / 8).alias("adj_factor"),
                       "event_id")


_LATEST_SQL = """(SELECT 'U' || CAST(user_id AS VARCHAR) AS ts_code, CAST(ts AS DATE) AS trade_date,
          event_id, value
   FROM events WHERE event_type = '{t}'
   QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) = 1)"""
BASIC_SQL = ("basic AS (SELECT ts_code, trade_date, value AS close, "
             "CAST(event_id % 97 AS DOUBLE) / 4 AS turnover_rate, event_id FROM "
             + _LATEST_SQL.format(t="view") + ")")
ADJ_SQL = ("adj AS (SELECT ts_code, trade_date, 1.0::DOUBLE + CAST(event_id % 13 AS DOUBLE) / 8 AS adj_factor, "
           "event_id FROM " + _LATEST_SQL.format(t="purchase") + ")")


# ------------------------------------------------------------------- cal
def cal(spark, sf_dir) -> DataFrame:
    """Trading calendar over the days the events cover: SSE open Monday to
    Friday, SZSE open every day."""
    days = table(spark, sf_dir, "events").select(_d("ts").alias("cal_date")).distinct()
    weekday = (~F.dayofweek("cal_date").isin(1, 7)).cast("int")
    sse = days.select(F.lit("SSE").alias("exchange"), "cal_date", weekday.alias("is_open"))
    szse = days.select(F.lit("SZSE").alias("exchange"), "cal_date", F.lit(1).alias("is_open"))
    return sse.unionByName(szse)


CAL_SQL = """cal AS (
  SELECT 'SSE' AS exchange, cal_date,
         CAST(CASE WHEN dayofweek(cal_date) IN (0, 6) THEN 0 ELSE 1 END AS INTEGER) AS is_open
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS cal_date FROM events)
  UNION ALL
  SELECT 'SZSE' AS exchange, cal_date, CAST(1 AS INTEGER) AS is_open
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS cal_date FROM events))"""


def cal_raw(spark, sf_dir) -> DataFrame:
    """The calendar as landing text: SSE dates yyyyMMdd, SZSE dates
    yyyy-MM-dd; is_open unreadable ('x') on the 13th of a month at SSE."""
    c = cal(spark, sf_dir)
    return c.select(
        "exchange",
        F.when(F.col("exchange") == "SSE", F.date_format("cal_date", "yyyyMMdd"))
         .otherwise(F.date_format("cal_date", "yyyy-MM-dd")).alias("cal_date"),
        F.when((F.col("exchange") == "SSE") & (F.dayofmonth("cal_date") == 13), F.lit("x"))
         .otherwise(F.col("is_open").cast("string")).alias("is_open"))


# ------------------------------------------------- suspend_raw / limit_raw
def suspend_raw(spark, sf_dir) -> DataFrame:
    """Trading suspensions as landing text, one per event; the time range
    null for every 3rd of them, so a fuller row of the day survives."""
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ts_code"),
        F.date_format(_d("ts"), "yyyyMMdd").alias("trade_date"),
        F.when(k % 3 != 0, F.concat(F.lpad((k % 12).cast("string"), 2, "0"), F.lit(":00-15:00"))).alias("suspend_timing"),
        F.when(k % 2 == 0, "S").otherwise("R").alias("suspend_type"), "event_id")


def limit_raw(spark, sf_dir, room: float = 10.0) -> DataFrame:
    """Price limits as landing text, one per event, ``room`` above."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ts_code"),
        F.date_format(_d("ts"), "yyyyMMdd").alias("trade_date"),
        F.format_string("%.2f", F.col("value") + room).alias("up_limit"),
        F.format_string("%.2f", F.col("value")).alias("down_limit"), "event_id")


SUSPEND_SQL = """suspend_raw AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS ts_code, strftime(CAST(ts AS DATE), '%Y%m%d') AS trade_date,
         CASE WHEN event_id % 3 <> 0 THEN lpad(CAST(event_id % 12 AS VARCHAR), 2, '0') || ':00-15:00' END AS suspend_timing,
         CASE WHEN event_id % 2 = 0 THEN 'S' ELSE 'R' END AS suspend_type, event_id
  FROM events)"""
LIMIT_SQL = """limit_raw AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS ts_code, strftime(CAST(ts AS DATE), '%Y%m%d') AS trade_date,
         printf('%.2f', value + 10) AS up_limit, printf('%.2f', value + 20) AS later_limit,
         printf('%.2f', value) AS down_limit, event_id
  FROM events)"""


# ---------------------------------------------------------------- fin_raw
def fin_raw(spark, sf_dir) -> DataFrame:
    """Financial statements as landing text, one per order: ts_code from the
    customer; ann_date null every 11th order; f_ann_date 0-4 days earlier,
    null every 3rd; end_date = day before the order's quarter; report_type
    '2' for status P; update_flag '1' every 4th; ``src`` assigns one of the
    three statement tables."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = _d("o_orderdate")
    return o.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ts_code"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.date_format(d, "yyyyMMdd")).alias("ann_date"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.date_format(F.date_sub(d, (k % 5).cast("int")), "yyyyMMdd")).alias("f_ann_date"),
        F.date_format(F.date_sub(F.trunc(d, "quarter"), 1), "yyyyMMdd").alias("end_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit("2")).otherwise(F.lit("1")).alias("report_type"),
        F.lit("1").alias("comp_type"),
        F.when(k % 4 == 0, F.lit("1")).otherwise(F.lit("0")).alias("update_flag"),
        F.format_string("%.2f", F.col("o_totalprice")).alias("amount"),
        F.col("o_orderpriority").alias("priority"),
        F.when(k % 3 == 0, F.lit("fina_indicator")).when(k % 3 == 1, F.lit("income"))
         .otherwise(F.lit("balancesheet")).alias("src"),
        k.alias("o_orderkey"),
    )


FIN_RAW_SQL = """fin_raw AS (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ts_code,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE strftime(CAST(o_orderdate AS DATE), '%Y%m%d') END AS ann_date,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL
              ELSE strftime(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 5 AS INTEGER), '%Y%m%d') END AS f_ann_date,
         strftime(CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) AS DATE) - 1, '%Y%m%d') AS end_date,
         CASE WHEN o_orderstatus = 'P' THEN '2' ELSE '1' END AS report_type,
         '1' AS comp_type,
         CASE WHEN o_orderkey % 4 = 0 THEN '1' ELSE '0' END AS update_flag,
         printf('%.2f', o_totalprice) AS amount,
         o_orderpriority AS priority,
         CASE o_orderkey % 3 WHEN 0 THEN 'fina_indicator' WHEN 1 THEN 'income' ELSE 'balancesheet' END AS src,
         o_orderkey
  FROM orders)"""

# typed financial rows after the PIT guard and statement filter (oracle side)
FIN_SQL = """fin AS (
  SELECT ts_code, src, o_orderkey, CAST(amount AS DOUBLE) AS amount,
         CAST(strptime(ann_date, '%Y%m%d') AS DATE) AS ann_date,
         CAST(strptime(f_ann_date, '%Y%m%d') AS DATE) AS f_ann_date,
         CAST(strptime(end_date, '%Y%m%d') AS DATE) AS end_date,
         update_flag,
         least(CAST(strptime(ann_date, '%Y%m%d') AS DATE),
               coalesce(CAST(strptime(f_ann_date, '%Y%m%d') AS DATE),
                        CAST(strptime(ann_date, '%Y%m%d') AS DATE))) AS real_ann_date
  FROM fin_raw WHERE ann_date IS NOT NULL AND report_type = '1')"""


# ----------------------------------------------------------------- trades
def trades(spark, sf_dir) -> DataFrame:
    """Trade rows keyed like the statements: one per line item, ts_code of
    the ordering customer, trade_date = ship date."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return j.select("l_orderkey", "l_linenumber", "l_extendedprice",
                    F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ts_code"),
                    _d("l_shipdate").alias("trade_date"))


TRADES_SQL = """trades AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice, 'C' || CAST(o_custkey AS VARCHAR) AS ts_code,
         CAST(l_shipdate AS DATE) AS trade_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FIXTURE_SQL = {"suspend_raw": SUSPEND_SQL, "limit_raw": LIMIT_SQL, 
    "bars_raw": BARS_RAW_SQL, "basic": BASIC_SQL, "adj": ADJ_SQL, "cal": CAL_SQL,
    "fin_raw": FIN_RAW_SQL, "fin": FIN_SQL, "trades": TRADES_SQL,
}
_DEPENDS = {"fin": ("fin_raw",)}


def with_fixtures(names, body: str, extra_ctes: str = "") -> str:
    """``WITH <fixture CTEs>[, extra] <body>`` for the oracle side."""
    order: list[str] = []

    def add(n):
        for dep in _DEPENDS.get(n, ()):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [FIXTURE_SQL[n] for n in order]
    if extra_ctes:
        ctes.append(extra_ctes.strip().rstrip(","))
    return "WITH " + ",\n".join(ctes) + "\n" + body
