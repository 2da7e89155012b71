"""Query catalogue: every operator of the library as a query over the
driver's tables, each with its DuckDB oracle SQL where SQL can say it.

A query is ``fn(spark, sf_dir) -> DataFrame``.  Column names match the
oracle's exactly; every computed column is aliased on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from ..operators.clean import clean_table, empty_table, prepare_table
from ..operators.dedup import dedup_counts, pk_duplicate_count, survivorship_dedup
from ..operators.quality import null_profile
from ..functions.dates import parse_date_multi
from ..functions.rows import completeness_score
from . import fixtures as fx
from .fixtures import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---- shared oracle fragments -------------------------------------------------
def _parse_sql(c: str) -> str:
    t = f"trim({c})"
    return (f"CASE WHEN {t} IN ('', 'None', 'null', 'NULL') THEN NULL ELSE "
            f"CAST(COALESCE(try_strptime({t}, '%Y%m%d'), try_strptime({t}, '%Y-%m-%d'), "
            f"try_strptime({t}, '%Y/%m/%d')) AS DATE) END")


BARS_TYPED_SQL = f"""bars AS (
  SELECT ts_code, {_parse_sql('trade_date')} AS trade_date, TRY_CAST(trim(close) AS DOUBLE) AS close,
         tag, update_flag, event_id
  FROM bars_raw)"""

DAILY_SQL = BARS_TYPED_SQL + """,
daily AS (
  SELECT * FROM bars
  QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date
          ORDER BY CAST(update_flag = '1' AS INT) DESC,
                   CAST(close IS NOT NULL AS INT) + CAST(tag IS NOT NULL AS INT) DESC,
                   event_id DESC) = 1)"""


def _daily(spark, d) -> DataFrame:
    return clean_table("daily", fx.bars_raw(spark, d), order_first=["event_id"]).frame


# ---- cleaning, parsing, typing ----------------------------------------------------
@query("clean_daily", with_fixtures(["bars_raw"],
       "SELECT ts_code, trade_date, close, tag, update_flag, event_id FROM daily", DAILY_SQL))
def q_clean_daily(spark, d):
    return _daily(spark, d).select("ts_code", "trade_date", "close", "tag", "update_flag", "event_id")


_PARSE_INPUT = """SELECT event_id,
         CASE event_id % 10 WHEN 0 THEN '' WHEN 1 THEN 'None' WHEN 2 THEN 'null' WHEN 3 THEN 'NULL'
              WHEN 4 THEN substr(trim(trade_date), 1, 6) || '32'
              WHEN 5 THEN '13:00-15:00' ELSE trade_date END AS raw_date
  FROM bars_raw"""


@query("parse_dates", with_fixtures(["bars_raw"],
       f"SELECT event_id, {_parse_sql('raw_date')} AS trade_date FROM ({_PARSE_INPUT})"))
def q_parse_dates(spark, d):
    b = fx.bars_raw(spark, d)
    m = F.col("event_id") % 10
    raw = (F.when(m == 0, F.lit("")).when(m == 1, F.lit("None")).when(m == 2, F.lit("null"))
            .when(m == 3, F.lit("NULL"))
            .when(m == 4, F.concat(F.substring(F.trim("trade_date"), 1, 6), F.lit("32")))
            .when(m == 5, F.lit("13:00-15:00")).otherwise(F.col("trade_date")))
    return b.select("event_id", parse_date_multi(raw).alias("trade_date"))


@query("completeness_score", with_fixtures(["bars_raw"],
       "SELECT event_id, CAST(4 + CAST(close IS NOT NULL AS INT) + CAST(tag IS NOT NULL AS INT) AS INT) "
       "AS score FROM bars_raw"))
def q_completeness_score(spark, d):
    b = fx.bars_raw(spark, d)
    return b.select("event_id", completeness_score(b.columns).alias("score"))


@query("dedup_complete", with_fixtures(["bars_raw"], """
SELECT ts_code, trade_date, event_id FROM bars
QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date
        ORDER BY CAST(close IS NOT NULL AS INT) + CAST(tag IS NOT NULL AS INT) DESC, event_id DESC) = 1""",
       BARS_TYPED_SQL))
def q_dedup_complete(spark, d):
    prepared = prepare_table("daily", fx.bars_raw(spark, d).drop("update_flag"))
    out = survivorship_dedup(prepared, ("ts_code", "trade_date"), order_first=["event_id"])
    return out.select("ts_code", "trade_date", "event_id")


@query("dedup_update_flag", with_fixtures(["bars_raw"], """
SELECT ts_code, trade_date, close, tag, update_flag, event_id FROM bars
QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date
        ORDER BY CAST(update_flag = '1' AS INT) DESC,
                 CAST(close IS NOT NULL AS INT) + CAST(tag IS NOT NULL AS INT) DESC,
                 close DESC NULLS LAST, tag DESC NULLS LAST, update_flag DESC NULLS LAST,
                 event_id DESC NULLS LAST) = 1""", BARS_TYPED_SQL))
def q_dedup_update_flag(spark, d):
    # no recency hint: ties fall to the total order over the data columns
    prepared = prepare_table("daily", fx.bars_raw(spark, d))
    out = survivorship_dedup(prepared, ("ts_code", "trade_date"))
    return out.select("ts_code", "trade_date", "close", "tag", "update_flag", "event_id")


@query("dedup_row_counts", with_fixtures(["bars_raw"], """
SELECT CAST(SUM(n) AS BIGINT) AS rows_before, CAST(COUNT(*) AS BIGINT) AS rows_after,
       CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM bars GROUP BY ts_code, trade_date)""", BARS_TYPED_SQL))
def q_dedup_row_counts(spark, d):
    prepared = prepare_table("daily", fx.bars_raw(spark, d))
    return dedup_counts(prepared, ("ts_code", "trade_date"))


@query("pk_duplicates", with_fixtures(["bars_raw"], """
SELECT 'lineitem' AS table_name, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
UNION ALL
SELECT 'daily' AS table_name, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM bars GROUP BY ts_code, trade_date HAVING COUNT(*) > 1)""", BARS_TYPED_SQL))
def q_pk_duplicates(spark, d):
    li = fx.table(spark, d, "lineitem")
    bars = prepare_table("daily", fx.bars_raw(spark, d))
    return (pk_duplicate_count(li, ("l_orderkey", "l_linenumber"), "lineitem")
            .unionByName(pk_duplicate_count(bars, ("ts_code", "trade_date"), "daily")))


def _null_sql(table_alias: str, source: str, cols) -> str:
    parts = [f"SELECT '{table_alias}' AS table_name, '{c}' AS column_name, "
             f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM {source}" for c in cols]
    return "\nUNION ALL\n".join(parts)


@query("null_profile", with_fixtures(["bars_raw", "fin_raw"],
       _null_sql("bars_raw", "bars_raw", ["ts_code", "trade_date", "close", "tag", "update_flag", "event_id"])
       + "\nUNION ALL\n"
       + _null_sql("fin_raw", "fin_raw", ["ts_code", "ann_date", "f_ann_date", "end_date", "report_type",
                                          "comp_type", "update_flag", "amount", "priority", "src", "o_orderkey"])
       + "\nUNION ALL\n"
       + _null_sql("daily", "daily", ["ts_code", "trade_date", "close", "tag", "update_flag", "event_id"]),
       DAILY_SQL))
def q_null_profile(spark, d):
    return (null_profile(fx.bars_raw(spark, d), "bars_raw")
            .unionByName(null_profile(fx.fin_raw(spark, d), "fin_raw"))
            .unionByName(null_profile(_daily(spark, d), "daily")))


# ---- financial statements ----------------------------------------------------------
from ..operators.asof import asof_join, asof_join_by_group  # noqa: E402
from ..operators.batching import chunk_ids, filter_symbols, symbol_universe  # noqa: E402
from ..operators.calendar import (clean_calendar, coverage_missing_dates, coverage_summary,  # noqa: E402
                                  latest_open_for, recent_trade_dates, trade_dates_between)
from ..operators.products import (build_daily_master, build_financial_event_stream,  # noqa: E402
                                  left_join_suffix)
from ..operators.quality import batch_stats  # noqa: E402
from ..operators.union import concat_batches, union_aligned  # noqa: E402
from ..functions.casting import cast_numeric_like, numeric_like_profile  # noqa: E402
from ..functions.dates import date_text, date_windows, iso_text, year_span  # noqa: E402
from ..session import scratch_path  # noqa: E402


def _fin_prepared(spark, d) -> DataFrame:
    """All statements typed, PIT-guarded and filtered (no dedup).  The
    statement dataset's numeric columns are declared, so no profile pass."""
    return prepare_table("income", fx.fin_raw(spark, d), numeric_columns=["amount"])


@query("clean_financial", with_fixtures(["fin"], """
SELECT ts_code, end_date, ann_date, f_ann_date, real_ann_date, 'income' AS source_table, update_flag,
       amount, o_orderkey
FROM fin
QUALIFY row_number() OVER (PARTITION BY ts_code, end_date, ann_date
        ORDER BY CAST(update_flag = '1' AS INT) DESC, CAST(f_ann_date IS NOT NULL AS INT) DESC,
                 o_orderkey DESC) = 1"""))
def q_clean_financial(spark, d):
    res = clean_table("income", fx.fin_raw(spark, d).drop("src"), order_first=["o_orderkey"])
    return res.frame.select("ts_code", "end_date", "ann_date", "f_ann_date", "real_ann_date",
                            "source_table", "update_flag", "amount", "o_orderkey")


@query("real_ann_date", with_fixtures(["fin"],
       "SELECT o_orderkey, ann_date, f_ann_date, real_ann_date FROM fin"))
def q_real_ann_date(spark, d):
    return _fin_prepared(spark, d).select("o_orderkey", "ann_date", "f_ann_date", "real_ann_date")


# ---- auxiliary tables and calendar --------------------------------------------------
STOCK_RAW_SQL = """stock_raw AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS ts_code, c_name AS name, c_mktsegment AS industry,
         CAST(c_nationkey AS VARCHAR) AS area,
         strftime(DATE '1990-01-01' + CAST(c_custkey % 3000 AS INTEGER), '%Y%m%d') AS list_date,
         printf('%.2f', c_acctbal) AS acctbal
  FROM customer
  UNION ALL
  SELECT 'C' || CAST(c_custkey AS VARCHAR), c_name, NULL, CAST(c_nationkey AS VARCHAR),
         strftime(DATE '1990-01-01' + CAST(c_custkey % 3000 AS INTEGER), '%Y%m%d'),
         printf('%.2f', c_acctbal)
  FROM customer WHERE c_custkey % 10 = 0)"""


def _stock_raw(spark, d) -> DataFrame:
    """Customers as a symbol table; every 10th symbol arrives twice, the
    second copy without its industry (the fuller row must survive)."""
    c = fx.table(spark, d, "customer")

    def rows(src, industry):
        return src.select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ts_code"),
            F.col("c_name").alias("name"), industry.alias("industry"),
            F.col("c_nationkey").cast("string").alias("area"),
            F.date_format(F.date_add(F.lit("1990-01-01").cast("date"),
                                     (F.col("c_custkey") % 3000).cast("int")), "yyyyMMdd").alias("list_date"),
            F.format_string("%.2f", F.col("c_acctbal")).alias("acctbal"))

    return rows(c, F.col("c_mktsegment")).unionByName(
        rows(c.where(F.col("c_custkey") % 10 == 0), F.lit(None).cast("string")))


@query("clean_aux", with_fixtures([], """
SELECT ts_code, name, industry, CAST(area AS DOUBLE) AS area, CAST(strptime(list_date, '%Y%m%d') AS DATE) AS list_date,
       CAST(acctbal AS DOUBLE) AS acctbal
FROM stock_raw
QUALIFY row_number() OVER (PARTITION BY ts_code ORDER BY CAST(industry IS NOT NULL AS INT) DESC) = 1""",
       STOCK_RAW_SQL))
def q_clean_aux(spark, d):
    res = clean_table("stock_basic", _stock_raw(spark, d))
    return res.frame.select("ts_code", "name", "industry", "area", "list_date", "acctbal")


@query("calendar_clean", with_fixtures(["cal"], """
SELECT exchange, cal_date, is_open FROM cal
WHERE NOT (exchange = 'SSE' AND dayofmonth(cal_date) = 13)"""))
def q_calendar_clean(spark, d):
    return clean_calendar(fx.cal_raw(spark, d)).select("exchange", "cal_date", "is_open")


# ---- data-dependent typing ------------------------------------------------------------
def _events_text(spark, d) -> DataFrame:
    e = fx.table(spark, d, "events")
    v = F.format_string("%.2f", F.col("value"))
    return e.select(
        "event_id",
        F.col("event_id").cast("string").alias("event_id_s"),
        F.when(F.col("event_id") % 17 == 0, F.concat(F.lit(" "), v, F.lit(" ")))
         .when(F.col("event_id") % 19 == 0, F.concat(F.lit("+"), v)).otherwise(v).alias("value_s"),
        "event_type", "props",
        F.when(F.col("event_id") % 1000 == 7, F.concat(F.lit("x"), F.col("user_id").cast("string")))
         .otherwise(F.col("user_id").cast("string")).alias("user_code"),
        F.lit(None).cast("string").alias("empty_s"))


EVENTS_TEXT_SQL = """events_text AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS event_id_s,
         CASE WHEN event_id % 17 = 0 THEN ' ' || printf('%.2f', value) || ' '
              WHEN event_id % 19 = 0 THEN '+' || printf('%.2f', value)
              ELSE printf('%.2f', value) END AS value_s,
         event_type, props,
         CASE WHEN event_id % 1000 = 7 THEN 'x' || CAST(user_id AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END AS user_code,
         CAST(NULL AS VARCHAR) AS empty_s
  FROM events)"""
_NUM_RE = r"^[+-]?(?:\d+(?:\.\d+)?|\.\d+)(?:[eE][+-]?\d+)?$"


def _profile_sql(cols) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COALESCE(bool_and(regexp_matches(trim({c}), '{_NUM_RE}')), true) "
        f"AS all_numeric FROM events_text" for c in cols)


_EMPTY_COLUMNS = {"income": {"ts_code": "string", "end_date": "date", "ann_date": "date", "amount": "string", "source_table": "string", "real_ann_date": "date"},
                  "suspend_d": {"ts_code": "string", "trade_date": "date", "suspend_timing": "string"}}


@query("empty_table_schema", with_fixtures(["fin_raw", "suspend_raw"], """
SELECT table_name, column_name, data_type, CAST(n_values AS BIGINT) AS n_values FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, "
    + {"source_table": "COUNT(*)", "real_ann_date": "0 * COUNT(*)"}.get(c, f"COUNT({c})") + f" AS n_values FROM {'fin_raw' if t == 'income' else 'suspend_raw'}"
    for t, cols in _EMPTY_COLUMNS.items() for c, kind in cols.items()) + ")"))
def q_empty_table_schema(spark, d):
    """Typed empty tables as the first part of a union with landing rows of
    all tables: they give the columns that the rows lack and the types of
    those that are parsed; values per column are those of the rows."""
    out = []
    for name, raw in (("income", fx.fin_raw(spark, d)), ("suspend_d", fx.suspend_raw(spark, d))):
        kept = [c for c in _EMPTY_COLUMNS[name] if c in raw.columns]
        rows = raw.select(*[parse_date_multi(c, raw.schema[c].dataType).alias(c) if _EMPTY_COLUMNS[name][c] == "date" else F.col(c) for c in kept])
        if name == "income":
            rows = rows.withColumn("source_table", F.lit("income"))
        extra = {c: T.StringType() for c in kept if c not in ("ts_code", "end_date", "ann_date", "trade_date")}
        full = union_aligned([empty_table(spark, name, extra), rows])
        counts = full.agg(*[F.count(c).alias(c) for c in full.columns])
        entries = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col(c).alias("n_values")) for c, t in full.dtypes]
        out.append(counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*entries))))
    return union_aligned(out)


@query("numeric_like_profile", with_fixtures([], _profile_sql(
    ["event_id_s", "value_s", "event_type", "props", "user_code", "empty_s"]), EVENTS_TEXT_SQL))
def q_numeric_like_profile(spark, d):
    return numeric_like_profile(_events_text(spark, d))


@query("numeric_like_cast", with_fixtures([], """
SELECT event_id, CAST(event_id_s AS DOUBLE) AS event_id_s, CAST(trim(value_s) AS DOUBLE) AS value_s,
       event_type, user_code, CAST(empty_s AS DOUBLE) AS empty_s
FROM events_text""", EVENTS_TEXT_SQL))
def q_numeric_like_cast(spark, d):
    out = cast_numeric_like(_events_text(spark, d))
    return out.select("event_id", "event_id_s", "value_s", "event_type", "user_code", "empty_s")


@query("date_text", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS ymd,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS iso
FROM orders""")
def q_date_text(spark, d):
    o = fx.table(spark, d, "orders")
    return o.select("o_orderkey", date_text(F.to_date("o_orderdate")).alias("ymd"),
                    iso_text("o_orderdate").alias("iso"))


# ---- landing batches and unions ----------------------------------------------------------
@query("ingest_nan_to_null", """
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value FROM events""")
def q_ingest_nan_to_null(spark, d):
    from ..sources.ingest import read_landing
    e = fx.table(spark, d, "events")
    landing = e.select("event_id", F.when(F.col("event_id") % 9 == 0, F.lit(float("nan")))
                       .otherwise(F.col("value")).alias("value"))
    path = scratch_path(spark, "landing")
    landing.write.parquet(path)
    return read_landing(spark, path).select("event_id", "value")


@query("concat_batches", """
SELECT event_id, CAST(value AS VARCHAR) AS value, event_type AS tag, 0 AS batch FROM events WHERE event_id % 3 = 0
UNION ALL
SELECT event_id, printf('%.2f', value) AS value, CAST(NULL AS VARCHAR) AS tag, 1 AS batch FROM events WHERE event_id % 3 = 1
UNION ALL
SELECT event_id, CAST(NULL AS VARCHAR) AS value, event_type AS tag, 2 AS batch FROM events WHERE event_id % 3 = 2""")
def q_concat_batches(spark, d):
    e = fx.table(spark, d, "events")
    m = F.col("event_id") % 3
    a = e.where(m == 0).select("event_id", "value", F.col("event_type").alias("tag"), F.lit(0).alias("batch"))
    b = e.where(m == 1).select("event_id", F.format_string("%.2f", "value").alias("value"), F.lit(1).alias("batch"))
    c = e.where(m == 2).select("event_id", F.col("event_type").alias("tag"), F.lit(2).alias("batch"))
    empty = spark.range(0).select()          # a zero-width batch is skipped
    return concat_batches([a, empty, b, c]).select("event_id", "value", "tag", "batch")


@query("union_aligned", """
SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS v, CAST(NULL AS INTEGER) AS extra FROM customer
UNION ALL
SELECT s_suppkey AS id, s_name AS v, s_nationkey AS extra FROM supplier""")
def q_union_aligned(spark, d):
    c = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("v"))
    s = fx.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("v"),
                                              F.col("s_nationkey").alias("extra"))
    return union_aligned([c, s]).select("id", "v", "extra")


# ---- joins and products ---------------------------------------------------------------------
@query("left_join_suffix", with_fixtures(["bars_raw", "basic"], """
SELECT d.ts_code, d.trade_date, d.close, b.close AS close_daily_basic, d.event_id,
       b.event_id AS event_id_daily_basic, b.turnover_rate
FROM daily d LEFT JOIN basic b ON d.ts_code = b.ts_code AND d.trade_date = b.trade_date""", DAILY_SQL))
def q_left_join_suffix(spark, d):
    out = left_join_suffix(_daily(spark, d), fx.basic(spark, d), ("ts_code", "trade_date"), "_daily_basic")
    return out.select("ts_code", "trade_date", "close", "close_daily_basic", "event_id",
                      "event_id_daily_basic", "turnover_rate")


_MASTER_COLS = ("ts_code", "trade_date", "close", "tag", "update_flag", "event_id", "close_daily_basic",
                "turnover_rate", "event_id_daily_basic", "adj_factor", "event_id_adj_factor")
MASTER_SQL = DAILY_SQL + """,
master AS (
  SELECT d.ts_code, d.trade_date, d.close, d.tag, d.update_flag, d.event_id,
         b.close AS close_daily_basic, b.turnover_rate, b.event_id AS event_id_daily_basic,
         a.adj_factor, a.event_id AS event_id_adj_factor
  FROM daily d
  LEFT JOIN basic b ON d.ts_code = b.ts_code AND d.trade_date = b.trade_date
  LEFT JOIN adj a ON d.ts_code = a.ts_code AND d.trade_date = a.trade_date)"""


def _master(spark, d) -> DataFrame:
    return build_daily_master(_daily(spark, d), fx.basic(spark, d), fx.adj(spark, d))


@query("daily_master", with_fixtures(["bars_raw", "basic", "adj"], "SELECT * FROM master", MASTER_SQL))
def q_daily_master(spark, d):
    return _master(spark, d).select(*_MASTER_COLS)


# financial statements split in three tables with different value columns;
# fina_indicator has no report_type, f_ann_date or comp_type.
def _statement_slices(spark, d) -> dict[str, DataFrame]:
    raw = fx.fin_raw(spark, d)
    base = ["ts_code", "ann_date", "f_ann_date", "end_date", "report_type", "comp_type", "update_flag"]
    return {
        "fina_indicator": raw.where(F.col("src") == "fina_indicator").select(
            "ts_code", "ann_date", "end_date", "update_flag", F.col("amount").alias("roe"), "o_orderkey"),
        "income": raw.where(F.col("src") == "income").select(
            *base, F.col("amount").alias("revenue"), "o_orderkey"),
        "balancesheet": raw.where(F.col("src") == "balancesheet").select(
            *base, F.col("amount").alias("total_assets"), "o_orderkey"),
    }


def _event_stream(spark, d) -> DataFrame:
    cleaned = {n: clean_table(n, df, order_first=["o_orderkey"]).frame
               for n, df in _statement_slices(spark, d).items()}
    return build_financial_event_stream(cleaned)


_EVENT_OUT = ("ts_code", "source_table", "ann_date", "f_ann_date", "real_ann_date", "end_date",
              "report_type", "comp_type", "update_flag", "roe", "revenue", "total_assets", "o_orderkey")
EVENTS_SQL = """fr AS (
  SELECT ts_code, src, o_orderkey, CAST(amount AS DOUBLE) AS amount,
         CAST(strptime(ann_date, '%Y%m%d') AS DATE) AS ann_date,
         CAST(strptime(f_ann_date, '%Y%m%d') AS DATE) AS f_ann_date,
         CAST(strptime(end_date, '%Y%m%d') AS DATE) AS end_date, report_type, comp_type, update_flag
  FROM fin_raw WHERE ann_date IS NOT NULL),
fi AS (
  SELECT ts_code, 'fina_indicator' AS source_table, ann_date, CAST(NULL AS DATE) AS f_ann_date,
         ann_date AS real_ann_date, end_date, CAST(NULL AS VARCHAR) AS report_type, '' AS comp_type,
         update_flag, amount AS roe, CAST(NULL AS DOUBLE) AS revenue, CAST(NULL AS DOUBLE) AS total_assets,
         o_orderkey
  FROM fr WHERE src = 'fina_indicator'
  QUALIFY row_number() OVER (PARTITION BY ts_code, end_date, ann_date
          ORDER BY CAST(update_flag = '1' AS INT) DESC, o_orderkey DESC) = 1),
st AS (
  SELECT ts_code, src AS source_table, ann_date, f_ann_date, least(ann_date, coalesce(f_ann_date, ann_date)) AS real_ann_date,
         end_date, report_type, comp_type, update_flag, CAST(NULL AS DOUBLE) AS roe,
         CASE WHEN src = 'income' THEN amount END AS revenue,
         CASE WHEN src = 'balancesheet' THEN amount END AS total_assets, o_orderkey
  FROM fr WHERE src IN ('income', 'balancesheet') AND report_type = '1'
  QUALIFY row_number() OVER (PARTITION BY src, ts_code, end_date, ann_date
          ORDER BY CAST(update_flag = '1' AS INT) DESC, CAST(f_ann_date IS NOT NULL AS INT) DESC,
                   o_orderkey DESC) = 1),
events_stream AS (SELECT * FROM fi UNION ALL SELECT * FROM st)"""


@query("financial_event_stream", with_fixtures(["fin_raw"], "SELECT * FROM events_stream", EVENTS_SQL))
def q_financial_event_stream(spark, d):
    return _event_stream(spark, d).select(*_EVENT_OUT)


# ---- point-in-time as-of joins -------------------------------------------------------------
@query("pit_asof_join", with_fixtures(["fin", "trades"], """
SELECT t.l_orderkey, t.l_linenumber, t.l_extendedprice, t.ts_code, t.trade_date,
       f.o_orderkey AS ev_o_orderkey, f.real_ann_date AS ev_real_ann_date, f.amount AS ev_amount
FROM trades t ASOF LEFT JOIN fd f ON t.ts_code = f.ts_code AND t.trade_date >= f.real_ann_date""",
       """fd AS (SELECT * FROM fin QUALIFY row_number() OVER (PARTITION BY ts_code, real_ann_date
                 ORDER BY o_orderkey DESC) = 1)"""))
def q_pit_asof_join(spark, d):
    return asof_join(fx.trades(spark, d), _fin_prepared(spark, d), by="ts_code", left_on="trade_date",
                     right_on="real_ann_date", columns=["o_orderkey", "real_ann_date", "amount"],
                     tiebreak=["o_orderkey"], prefix="ev_")


_SRCS = ("fina_indicator", "income", "balancesheet")


def _by_source_sql() -> str:
    ctes = ",\n".join(
        f"""f_{s} AS (SELECT * FROM fin WHERE src = '{s}' QUALIFY row_number() OVER
            (PARTITION BY ts_code, real_ann_date ORDER BY o_orderkey DESC) = 1)""" for s in _SRCS)
    cols = ", ".join(f"f_{s}.real_ann_date AS {s}_real_ann_date, f_{s}.o_orderkey AS {s}_o_orderkey"
                     for s in _SRCS)
    joins = " ".join(f"ASOF LEFT JOIN f_{s} ON t.ts_code = f_{s}.ts_code AND t.trade_date >= f_{s}.real_ann_date"
                     for s in _SRCS)
    return with_fixtures(["fin", "trades"], f"SELECT t.l_orderkey, t.l_linenumber, {cols} FROM trades t {joins}", ctes)


@query("pit_asof_by_source", _by_source_sql())
def q_pit_asof_by_source(spark, d):
    out = asof_join_by_group(fx.trades(spark, d), _fin_prepared(spark, d), by="ts_code", left_on="trade_date",
                             right_on="real_ann_date", group_col="src", groups=_SRCS,
                             columns=["o_orderkey"], tiebreak=["o_orderkey"])
    return out.select("l_orderkey", "l_linenumber",
                      *[c for s in _SRCS for c in (f"{s}_real_ann_date", f"{s}_o_orderkey")])


# ---- calendar and coverage -------------------------------------------------------------------
@query("calendar_between", with_fixtures(["cal"], """
SELECT cal_date FROM cal WHERE exchange = 'SSE' AND is_open = 1
AND cal_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""))
def q_calendar_between(spark, d):
    return trade_dates_between(fx.cal(spark, d), "20240105", "2024-01-20")


@query("latest_trade_date", with_fixtures(["cal"], """
SELECT t.target, (SELECT max(c.cal_date) FROM cal c WHERE c.exchange = 'SSE' AND c.is_open = 1
                  AND c.cal_date <= t.target) AS latest_open
FROM (SELECT DISTINCT CAST(ts AS DATE) AS target FROM events) t"""))
def q_latest_trade_date(spark, d):
    targets = fx.table(spark, d, "events").select(F.to_date("ts").alias("target")).distinct()
    return latest_open_for(fx.cal(spark, d), targets, "target").select("target", "latest_open")


@query("recent_trade_dates", with_fixtures(["cal"], """
SELECT cal_date FROM (SELECT cal_date FROM cal WHERE exchange = 'SSE' AND is_open = 1
                      AND cal_date <= DATE '2024-01-28' ORDER BY cal_date DESC LIMIT 5)"""))
def q_recent_trade_dates(spark, d):
    return recent_trade_dates(fx.cal(spark, d), "20240128", 5)


_COV_CTES = """exp AS (SELECT cal_date FROM cal WHERE exchange = 'SSE' AND is_open = 1
                AND cal_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'),
act AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
users AS (SELECT DISTINCT user_id FROM events),
miss AS (SELECT u.user_id, e.cal_date AS missing_date FROM users u CROSS JOIN exp e
         WHERE NOT EXISTS (SELECT 1 FROM act a WHERE a.user_id = u.user_id AND a.d = e.cal_date))"""


def _user_dates(spark, d) -> DataFrame:
    return fx.table(spark, d, "events").select("user_id", F.to_date("ts").alias("d"))


@query("coverage_missing_dates", with_fixtures(["cal"], "SELECT user_id, missing_date FROM miss", _COV_CTES))
def q_coverage_missing_dates(spark, d):
    return coverage_missing_dates(fx.cal(spark, d), _user_dates(spark, d), "d", "20240101", "20240130",
                                  group_cols=["user_id"])


@query("coverage_summary", with_fixtures(["cal"], """
SELECT u.user_id, CAST((SELECT COUNT(*) FROM exp) AS BIGINT) AS expected_dates,
       CAST((SELECT COUNT(*) FROM act a WHERE a.user_id = u.user_id) AS BIGINT) AS actual_dates,
       CAST((SELECT COUNT(*) FROM exp) - (SELECT COUNT(*) FROM miss m WHERE m.user_id = u.user_id) AS BIGINT)
         AS covered_dates,
       CAST((SELECT COUNT(*) FROM miss m WHERE m.user_id = u.user_id) AS BIGINT) AS n_missing
FROM users u""", _COV_CTES))
def q_coverage_summary(spark, d):
    s = coverage_summary(fx.cal(spark, d), _user_dates(spark, d), "d", "20240101", "20240130",
                         group_cols=["user_id"])
    return s.select("user_id", "expected_dates", "actual_dates", "covered_dates",
                    F.size("missing_dates").cast("long").alias("n_missing"))


@query("coverage_universe", with_fixtures(["cal"], """
SELECT c.c_custkey AS user_id, CAST(COUNT(e.cal_date) AS BIGINT) AS expected_dates,
       CAST((SELECT COUNT(*) FROM act a WHERE a.user_id = c.c_custkey) AS BIGINT) AS actual_dates,
       CAST(COUNT(a.d) AS BIGINT) AS covered_dates,
       coalesce(string_agg(CAST(e.cal_date AS VARCHAR), ',' ORDER BY e.cal_date) FILTER (a.d IS NULL), '') AS missing
FROM customer c CROSS JOIN exp e LEFT JOIN act a ON a.user_id = c.c_custkey AND a.d = e.cal_date
GROUP BY c.c_custkey""", _COV_CTES))
def q_coverage_universe(spark, d):
    """Every customer as a symbol: those without a row miss every open day."""
    s = coverage_summary(fx.cal(spark, d), _user_dates(spark, d), "d", "20240101", "20240130", group_cols=["user_id"],
                         universe=fx.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id")))
    return s.select("user_id", "expected_dates", "actual_dates", "covered_dates",
                    F.array_join(F.transform("missing_dates", lambda x: x.cast("string")), ",").alias("missing"))


# ---- symbols, years, batches, windows -------------------------------------------------------
@query("filter_symbols", with_fixtures(["trades"], """
SELECT l_orderkey, l_linenumber, ts_code FROM trades
WHERE ts_code IN (SELECT 'C' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')"""))
def q_filter_symbols(spark, d):
    c = fx.table(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING")
    syms = c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ts_code"))
    return filter_symbols(fx.trades(spark, d), syms).select("l_orderkey", "l_linenumber", "ts_code")


@query("symbol_universe", "SELECT DISTINCT 'C' || CAST(o_custkey AS VARCHAR) AS ts_code FROM orders")
def q_symbol_universe(spark, d):
    o = fx.table(spark, d, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ts_code"))
    return symbol_universe(o)


@query("impacted_years", with_fixtures(["trades"], """
SELECT DISTINCT CAST(year(trade_date) AS INTEGER) AS year FROM trades
UNION
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders"""))
def q_impacted_years(spark, d):
    t = fx.trades(spark, d).select(F.year("trade_date").alias("year"))
    o = fx.table(spark, d, "orders").select(F.year("o_orderdate").alias("year"))
    return t.union(o).distinct()


@query("years_between", """
SELECT o_orderkey, CAST(y AS INTEGER) AS year
FROM (SELECT o.o_orderkey,
             unnest(range(year(least(o.o_orderdate, l.ms)), year(greatest(o.o_orderdate, l.ms)) + 1)) AS y
      FROM orders o JOIN (SELECT l_orderkey, max(l_shipdate) AS ms FROM lineitem GROUP BY l_orderkey) l
        ON o.o_orderkey = l.l_orderkey)""")
def q_years_between(spark, d):
    """Years an order's date range touches, the range given reversed (last
    ship date first, order date last): bounds are swapped."""
    ship = (fx.table(spark, d, "lineitem").groupBy("l_orderkey")
            .agg(F.max("l_shipdate").alias("last_ship")))
    o = fx.table(spark, d, "orders").join(ship, F.col("o_orderkey") == F.col("l_orderkey"))
    return o.select("o_orderkey", F.explode(year_span(F.to_date("last_ship"), F.to_date("o_orderdate"))).alias("year"))


_BATCH_LOG_SQL = """batch_log AS (
  SELECT event_type AS table_name, CAST(ts AS DATE) AS batch_date, COUNT(*) AS fetched_rows,
         1 AS request_count, 1 AS success_count,
         COUNT(*) FILTER (WHERE value > 400) AS retry_count
  FROM events GROUP BY event_type, CAST(ts AS DATE))"""


@query("batch_stats", with_fixtures([], """
SELECT table_name, CAST(SUM(fetched_rows) AS BIGINT) AS fetched_rows,
       CAST(SUM(request_count) AS BIGINT) AS request_count, CAST(SUM(success_count) AS BIGINT) AS success_count,
       CAST(SUM(retry_count) AS BIGINT) AS retry_count
FROM batch_log GROUP BY table_name""", _BATCH_LOG_SQL))
def q_batch_stats(spark, d):
    e = fx.table(spark, d, "events")
    log = (e.groupBy(F.col("event_type").alias("table_name"), F.to_date("ts").alias("batch_date"))
             .agg(F.count(F.lit(1)).alias("fetched_rows"), F.lit(1).alias("request_count"),
                  F.lit(1).alias("success_count"),
                  F.count(F.when(F.col("value") > 400, 1)).alias("retry_count")))
    return batch_stats(log)


@query("date_windows", """
WITH r AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders)
SELECT CAST(ws AS DATE) AS window_start, least(CAST(ws AS DATE) + 119, e) AS window_end
FROM r, unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 120 DAY)) AS g(ws)""")
def q_date_windows(spark, d):
    o = fx.table(spark, d, "orders")
    r = o.agg(F.min(F.to_date("o_orderdate")).alias("s"), F.max(F.to_date("o_orderdate")).alias("e"))
    return r.select(F.explode(date_windows("s", "e", 120)).alias("w")).select("w.window_start", "w.window_end")


@query("symbol_batches", """
SELECT CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 100 AS BIGINT) AS batch_id, c_custkey
FROM customer""".join(["SELECT batch_id, CAST(COUNT(*) AS BIGINT) AS n, "
                        "string_agg('C' || CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS symbols "
                        "FROM (", ") GROUP BY batch_id"]))
def q_symbol_batches(spark, d):
    c = fx.table(spark, d, "customer").select("c_custkey")
    chunks = chunk_ids(c, ["c_custkey"], 100)
    return chunks.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("c_custkey")),
                                     lambda k: F.concat(F.lit("C"), k.cast("string")))).alias("symbols"))


# ---- lake: partitioned writes, pruned reads, upserts -----------------------------------------
from ..operators.calendar import calendar_from_parquet  # noqa: E402
from ..operators.quality import table_quality  # noqa: E402
from ..sources.lake import Lake  # noqa: E402
from .lakehouse import (backfill_daily, backfill_financial, daily_update, history_build,  # noqa: E402
                        process_table, rebuild_summary, rejects, write_raw)
from .quality_state import batch_state, state_report  # noqa: E402
from .query import head, query_daily_master, query_financial_events  # noqa: E402


def _new_lake(spark) -> Lake:
    return Lake(spark, scratch_path(spark, "lake"))


def _orders_lake(spark, d) -> Lake:
    lake = _new_lake(spark)
    o = fx.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"),
                                            "o_totalprice", "o_custkey")
    lake.write_years("dwd", "orders", o, "o_orderdate", sort_cols=("o_orderkey",))
    return lake


@query("scan_all_years", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, COUNT(*) AS n_rows,
       CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM orders GROUP BY 1""")
def q_scan_all_years(spark, d):
    df = _orders_lake(spark, d).scan("dwd", "orders")
    return df.groupBy(F.col("year").alias("order_year")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("total_cents"))


@query("scan_one_year", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, 1997 AS year FROM orders
WHERE year(o_orderdate) = 1997""")
def q_scan_one_year(spark, d):
    return _orders_lake(spark, d).read_year("dwd", "orders", 1997).select("o_orderkey", "o_orderdate", "year")


@query("partition_write_log", """
SELECT 'orders' AS dataset_name, CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS row_count,
       'dwd/orders/year=' || year(o_orderdate) AS directory, TRUE AS files_counted
FROM orders GROUP BY 2, 4""")
def q_partition_write_log(spark, d):
    """The log's rows and directory, and its file count against a listing."""
    lake = _orders_lake(spark, d)
    log = lake.partition_log("dwd", "orders")
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(lake.path("dwd", "orders"))
              .groupBy("year").agg(F.count(F.lit(1)).alias("n_files")))
    return log.join(listed, "year").select("dataset_name", "year", "row_count", F.regexp_extract("path", "[^/]+/[^/]+/[^/]+$", 0).alias("directory"),
                                           (F.col("file_count") == F.col("n_files")).alias("files_counted"))


@query("write_layout", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n_rows, TRUE AS many_files, TRUE AS within_bound,
       0 AS overlapping_files
FROM orders GROUP BY 1""")
def q_write_layout(spark, d):
    """Files of a year, at a low row bound: none above it, none overlapping
    another by key."""
    lake = Lake(spark, scratch_path(spark, "lake"), max_rows_per_file=100)
    o = fx.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")
    lake.write_years("dwd", "orders", o, "o_orderdate", sort_cols=("o_orderkey",))
    files = (lake.scan("dwd", "orders").groupBy("year", F.input_file_name().alias("file"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("a"), F.max("o_orderkey").alias("z")))
    earlier = F.max("z").over(Window.partitionBy("year").orderBy("a", "z").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("overlaps", (F.col("a") <= earlier).cast("int")).groupBy("year").agg(
        F.sum("n").alias("n_rows"), (F.count(F.lit(1)) > 1).alias("many_files"), (F.max("n") <= 100).alias("within_bound"),
        F.coalesce(F.sum("overlaps"), F.lit(0)).cast("int").alias("overlapping_files"))


@query("calendar_scan", with_fixtures(["cal"], "SELECT exchange, cal_date, is_open FROM cal"))
def q_calendar_scan(spark, d):
    path = scratch_path(spark, "calendar")
    c = fx.cal(spark, d).withColumn("pretrade_date", F.date_sub("cal_date", 1)).withColumn("note", F.lit("x"))
    c.write.parquet(path)
    return calendar_from_parquet(spark, path)


@query("write_partitions", with_fixtures(["trades"], """
SELECT CAST(year(trade_date) AS INTEGER) AS year, COUNT(*) AS n_rows FROM trades GROUP BY 1"""))
def q_write_partitions(spark, d):
    lake = _new_lake(spark)
    lake.write_years("dwd", "trades", fx.trades(spark, d), "trade_date", sort_cols=("ts_code", "trade_date"))
    return lake.scan("dwd", "trades").groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"))


@query("raw_partition_assign", with_fixtures(["bars_raw"], """
SELECT event_id, CAST(CASE WHEN event_id % 4 IN (0, 1) THEN CAST(substr(trade_date, 1, 4) AS INTEGER)
                          ELSE 2015 END AS INTEGER) AS year
FROM bars_raw
QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date
        ORDER BY CAST(update_flag = '1' AS INT) DESC,
                 CAST(close IS NOT NULL AS INT) + CAST(tag IS NOT NULL AS INT) DESC,
                 close DESC NULLS LAST, tag DESC NULLS LAST, update_flag DESC NULLS LAST,
                 event_id DESC NULLS LAST) = 1"""))
def q_raw_partition_assign(spark, d):
    lake = _new_lake(spark)
    write_raw(lake, "daily", fx.bars_raw(spark, d), "20150101")
    return lake.scan("ods", "daily").select("event_id", "year")


_UPSERT_SQL = BARS_TYPED_SQL + """,
scored AS (SELECT *, CAST(update_flag = '1' AS INT) AS prio,
                  CAST(close IS NOT NULL AS INT) + CAST(tag IS NOT NULL AS INT) AS score FROM bars),
base AS (SELECT *, 0 AS batch FROM scored WHERE event_id % 3 <> 0
         QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date ORDER BY prio DESC, score DESC, event_id DESC) = 1),
new AS (SELECT *, 1 AS batch FROM scored WHERE event_id % 3 = 0
        QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date ORDER BY prio DESC, score DESC, event_id DESC) = 1),
merged AS (SELECT * FROM base UNION ALL SELECT * FROM new)"""
_UPSERT_BODY = """
SELECT ts_code, trade_date, close, event_id FROM merged
QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date
        ORDER BY prio DESC, score DESC, batch DESC, close DESC NULLS LAST, tag DESC NULLS LAST,
                 update_flag DESC NULLS LAST, event_id DESC NULLS LAST) = 1"""


def _upsert_run(spark, d, repeats: int) -> DataFrame:
    lake = _new_lake(spark)
    bars = fx.bars_raw(spark, d)
    key = ("ts_code", "trade_date")
    base = clean_table("daily", bars.where(F.col("event_id") % 3 != 0), order_first=["event_id"]).frame
    batch = clean_table("daily", bars.where(F.col("event_id") % 3 == 0), order_first=["event_id"]).frame
    lake.upsert("dwd", "daily", base, key, "trade_date")
    for _ in range(repeats):
        lake.upsert("dwd", "daily", batch, key, "trade_date")
    return lake.scan("dwd", "daily").select("ts_code", "trade_date", "close", "event_id")


@query("upsert_partitions", with_fixtures(["bars_raw"], _UPSERT_BODY, _UPSERT_SQL))
def q_upsert_partitions(spark, d):
    return _upsert_run(spark, d, 1)


@query("upsert_idempotent", with_fixtures(["bars_raw"], _UPSERT_BODY, _UPSERT_SQL))
def q_upsert_idempotent(spark, d):
    return _upsert_run(spark, d, 2)


_CUTS = (1, 3, 10)


@query("upsert_batch_cuts", with_fixtures(["bars_raw"], f"""
SELECT n_batches, ts_code, trade_date, close, tag, event_id
FROM daily, (VALUES {', '.join(f'({n})' for n in _CUTS)}) AS t(n_batches)""", DAILY_SQL))
def q_upsert_batch_cuts(spark, d):
    """The same rows in 1, 3 and 10 batches that share keys give one table."""
    out = []
    for n in _CUTS:
        lake = _new_lake(spark)
        for k in range(n):
            batch = fx.bars_raw(spark, d).where(F.col("event_id") % n == k)
            frame = clean_table("daily", batch, numeric_columns=["close"], order_first=["event_id"]).frame
            lake.upsert("dwd", "daily", frame, ("ts_code", "trade_date"), "trade_date", order_first=["event_id"])
        out.append(lake.scan("dwd", "daily").select(F.lit(n).alias("n_batches"), "ts_code", "trade_date", "close", "tag", "event_id"))
    return union_aligned(out)


@query("upsert_type_drift", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
       CASE o_orderkey % 3 WHEN 1 THEN CAST(o_custkey AS VARCHAR) WHEN 2 THEN o_orderpriority END AS note,
       CASE WHEN o_orderkey % 3 = 0 THEN o_custkey ELSE o_custkey * 8589934592 END AS volume
FROM orders""")
def q_upsert_type_drift(spark, d):
    """A column that is empty, then numbers, then text, and one that outgrows
    its integer: every year keeps every value."""
    lake = _new_lake(spark)
    o = fx.table(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    key = F.col("o_custkey").cast("int")
    for k, (note, volume) in enumerate([(F.lit(None).cast("int"), key), (key, F.col("o_custkey") * 8589934592),
                                        (F.col("o_orderpriority"), F.col("o_custkey") * 8589934592)]):
        batch = o.where(F.col("o_orderkey") % 3 == k).select("o_orderkey", "o_orderdate", note.alias("note"), volume.alias("volume"))
        lake.upsert("dwd", "orders", batch, ["o_orderkey"], "o_orderdate")
    return lake.scan("dwd", "orders").select("o_orderkey", "o_orderdate", "note", "volume")


_TYPE_CUTS = (1, 2, 5)


@query("type_cut_invariance", f"""
WITH rows AS (
  SELECT 'O' || o_orderkey AS ts_code, CAST(o_orderdate AS DATE) AS trade_date,
         CASE WHEN o_orderkey % 5 = 4 THEN o_orderpriority ELSE printf('%08d', o_custkey) END AS code,
         CASE WHEN o_orderkey % 5 = 3 THEN 'n/a' ELSE '1234567890' || printf('%010d', o_orderkey) END AS serial,
         CAST(printf('%.2f', o_totalprice) AS DOUBLE) AS close
  FROM orders)
SELECT n_batches, layer, ts_code, trade_date, code, serial, close
FROM rows, (VALUES {', '.join(f'({n})' for n in _TYPE_CUTS)}) AS t(n_batches), (VALUES ('dwd'), ('dws')) AS l(layer)""")
def q_type_cut_invariance(spark, d):
    """The same landing rows in 1, 2 and 5 batches give one table in both
    layers.  Columns that are numbers in the early batches and text in a late
    one keep leading zeros and all digits; a column of numbers stays numbers."""
    o = fx.table(spark, d, "orders")
    key = F.col("o_orderkey")
    landing = o.select(
        F.concat(F.lit("O"), key.cast("string")).alias("ts_code"), F.date_format("o_orderdate", "yyyyMMdd").alias("trade_date"),
        F.when(key % 5 == 4, F.col("o_orderpriority")).otherwise(F.format_string("%08d", "o_custkey")).alias("code"),
        F.when(key % 5 == 3, F.lit("n/a")).otherwise(F.concat(F.lit("1234567890"), F.format_string("%010d", key))).alias("serial"),
        F.format_string("%.2f", "o_totalprice").alias("close"), (key % 5).alias("part"))

    def build(n: int) -> Lake:
        lake = _new_lake(spark)
        for k in range(n):
            # of two batches, the first has the parts that look like numbers throughout
            batch = landing.where(F.when(F.col("part") < 3, 0).otherwise(1) == k) if n == 2 else landing.where(F.col("part") % n == k)
            years = process_table(lake, "daily", batch.drop("part"), "20150101")
            rebuild_summary(lake, years)
        return lake

    with ThreadPoolExecutor(max_workers=len(_TYPE_CUTS)) as pool:       # lakes of their own: side by side
        lakes = dict(zip(_TYPE_CUTS, pool.map(build, _TYPE_CUTS)))
    return union_aligned([
        lake.scan(layer, name).select(F.lit(n).alias("n_batches"), F.lit(layer).alias("layer"), "ts_code", "trade_date", "code", "serial", "close")
        for n, lake in lakes.items() for layer, name in (("dwd", "daily"), ("dws", "daily_master"))])


@query("quality_report", with_fixtures(["bars_raw", "fin"], """
SELECT 'daily' AS table_name, CAST((SELECT COUNT(*) FROM bars) AS BIGINT) AS rows_before,
       CAST((SELECT COUNT(*) FROM daily) AS BIGINT) AS rows_after,
       CAST((SELECT COUNT(*) FROM bars) - (SELECT COUNT(*) FROM daily) AS BIGINT) AS pk_duplicates,
       CAST((SELECT SUM(CAST(close IS NULL AS INT) + CAST(tag IS NULL AS INT)) FROM daily) AS BIGINT) AS nulls_total
UNION ALL
SELECT 'income', CAST((SELECT COUNT(*) FROM fin) AS BIGINT), CAST((SELECT COUNT(*) FROM fclean) AS BIGINT),
       CAST((SELECT COUNT(*) FROM fin) - (SELECT COUNT(*) FROM fclean) AS BIGINT),
       CAST((SELECT SUM(CAST(f_ann_date IS NULL AS INT)) FROM fclean) AS BIGINT)""",
       DAILY_SQL + """,
fclean AS (SELECT * FROM fin QUALIFY row_number() OVER (PARTITION BY ts_code, end_date, ann_date
           ORDER BY CAST(update_flag = '1' AS INT) DESC, CAST(f_ann_date IS NOT NULL AS INT) DESC,
                    o_orderkey DESC) = 1)"""))
def q_quality_report(spark, d):
    daily = clean_table("daily", fx.bars_raw(spark, d), order_first=["event_id"])
    inc = clean_table("income", fx.fin_raw(spark, d).drop("src"), order_first=["o_orderkey"])
    return (table_quality("daily", daily.prepared, daily.frame, daily.primary_key)
            .unionByName(table_quality("income", inc.prepared, inc.frame, inc.primary_key)))


# ---- query API ---------------------------------------------------------------------------------
def _master_lake(spark, d) -> Lake:
    lake = _new_lake(spark)
    lake.write_years("dws", "daily_master", _master(spark, d), "trade_date", sort_cols=("ts_code", "trade_date"))
    return lake


@query("query_daily_master", with_fixtures(["bars_raw", "basic", "adj"], """
SELECT * FROM master WHERE year(trade_date) = 2024 AND ts_code = 'U7'
AND trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""", MASTER_SQL))
def q_query_daily_master(spark, d):
    out = query_daily_master(_master_lake(spark, d), 2024, "U7", "20240105", "2024-01-20")
    return out.select(*_MASTER_COLS)


@query("query_limit", with_fixtures(["bars_raw", "basic", "adj"], """
SELECT ts_code, trade_date, close FROM master ORDER BY ts_code, trade_date LIMIT 20""", MASTER_SQL))
def q_query_limit(spark, d):
    return head(query_daily_master(_master_lake(spark, d), 2024), 20).select("ts_code", "trade_date", "close")


@query("query_financial_events", with_fixtures(["fin_raw"], """
SELECT ts_code, source_table, ann_date, f_ann_date, real_ann_date, end_date, report_type, comp_type, update_flag
FROM events_stream WHERE ts_code = 'C7'
AND real_ann_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""", EVENTS_SQL))
def q_query_financial_events(spark, d):
    lake = _new_lake(spark)
    lake.write_years("dws", "financial_events", _event_stream(spark, d), "real_ann_date",
                     sort_cols=("ts_code", "real_ann_date"))
    return query_financial_events(lake, "C7", "1996-01-01", "20001231")


# ---- order of rows -------------------------------------------------------------------------------
def _stamped(df: DataFrame) -> DataFrame:
    """The rows as they come: ``__part`` and the place ``__at`` in it.  Written
    once, so that every later pass sees the same places."""
    path = scratch_path(df.sparkSession, "order")
    place = F.monotonically_increasing_id()
    df.withColumn("__id", place).write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.select("*", F.shiftright("__id", 33).alias("__part"), F.col("__id").bitwiseAND((1 << 33) - 1).alias("__at")).drop("__id")


@query("query_order", with_fixtures(["bars_raw", "basic", "adj"], """
SELECT CAST(row_number() OVER (ORDER BY ts_code, trade_date) AS BIGINT) AS position, ts_code, trade_date, event_id
FROM master WHERE year(trade_date) = 2024""", MASTER_SQL))
def q_query_order(spark, d):
    rows = _stamped(query_daily_master(_master_lake(spark, d), 2024).select("ts_code", "trade_date", "event_id"))
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    # one row per partition
    before = counts.select("__part", (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("before"))
    return rows.join(before, "__part").select((F.col("before") + F.col("__at") + 1).alias("position"), "ts_code", "trade_date", "event_id")


@query("event_stream_order", with_fixtures(["fin_raw"], """
SELECT source_table, COUNT(*) AS row_count, CAST(0 AS BIGINT) AS out_of_order FROM events_stream GROUP BY source_table""", EVENTS_SQL))
def q_event_stream_order(spark, d):
    rows = _stamped(_event_stream(spark, d))
    key = F.struct("ts_code", "real_ann_date", "end_date", "ann_date", "source_table")
    last = F.lag(key).over(Window.partitionBy("__part").orderBy("__at"))
    return (rows.select("source_table", (last > key).alias("wrong")).groupBy("source_table")
            .agg(F.count(F.lit(1)).alias("row_count"), F.count_if("wrong").alias("out_of_order")))


# ---- incremental windows ------------------------------------------------------------------------
_RECENT_SQL = """recent AS (SELECT cal_date FROM cal WHERE exchange = 'SSE' AND is_open = 1
                  AND cal_date <= DATE '2024-01-28' ORDER BY cal_date DESC LIMIT 5)"""


@query("backfill_daily", with_fixtures(["bars_raw", "cal"], """
SELECT ts_code, trade_date, close FROM daily WHERE trade_date IN (SELECT cal_date FROM recent)""",
       DAILY_SQL + ",\n" + _RECENT_SQL))
def q_backfill_daily(spark, d):
    recent = recent_trade_dates(fx.cal(spark, d), "20240128", 5)
    batch = backfill_daily(fx.bars_raw(spark, d), recent)
    return clean_table("daily", batch, order_first=["event_id"]).frame.select("ts_code", "trade_date", "close")


@query("backfill_financial", with_fixtures(["fin"], """
SELECT ts_code, ann_date, o_orderkey FROM fin WHERE ann_date BETWEEN DATE '2001-04-01' AND DATE '2001-06-30'"""))
def q_backfill_financial(spark, d):
    batch = backfill_financial(fx.fin_raw(spark, d), "20010630")
    return prepare_table("income", batch).select("ts_code", "ann_date", "o_orderkey")


def _trade_bars(spark, d, bump: float = 0.0) -> DataFrame:
    t = fx.trades(spark, d)
    return t.select("ts_code", F.date_format("trade_date", "yyyyMMdd").alias("trade_date"),
                    F.format_string("%.2f", F.col("l_extendedprice") + bump).alias("close"),
                    "l_orderkey", "l_linenumber")


@query("upsert_moves_year", """
SELECT o_orderkey, CAST(year(day) AS INTEGER) AS year, day, version
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 400 DAY AS DATE) ELSE CAST(o_orderdate AS DATE) END AS day,
             CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS version FROM orders)""")
def q_upsert_moves_year(spark, d):
    """Corrections that move keys to another year: each key has one row over
    all years, and the year it left no longer holds it."""
    lake = _new_lake(spark)
    o = fx.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    lake.upsert("dwd", "orders", o.withColumn("version", F.lit(0)), ["o_orderkey"], "day", across_years=True)
    moved = o.where(F.col("o_orderkey") % 3 == 0).withColumn("day", F.date_add("day", 400)).withColumn("version", F.lit(1))
    lake.upsert("dwd", "orders", moved, ["o_orderkey"], "day", across_years=True)
    return lake.scan("dwd", "orders").select("o_orderkey", "year", "day", "version")


@query("rebuild_affected_years", with_fixtures(["trades"], """
SELECT CAST(year(trade_date) AS INTEGER) AS year, COUNT(*) AS n_rows,
       CAST(SUM(CAST(round(close * 100) AS BIGINT)) AS BIGINT) AS checksum
FROM (SELECT ts_code, trade_date,
             CASE WHEN year(trade_date) = 1997 THEN max(c1) ELSE max(c0) END AS close
      FROM (SELECT ts_code, trade_date, CAST(printf('%.2f', l_extendedprice) AS DOUBLE) AS c0,
                   CAST(printf('%.2f', l_extendedprice + 1) AS DOUBLE) AS c1 FROM trades)
      GROUP BY ts_code, trade_date)
GROUP BY 1"""))
def q_rebuild_affected_years(spark, d):
    lake = _new_lake(spark)
    history_build(spark, lake.root, {"daily": _trade_bars(spark, d)})
    upd = _trade_bars(spark, d, 1.0).where(F.substring("trade_date", 1, 4) == "1997")
    years = process_table(lake, "daily", upd, "20150101")
    rebuild_summary(lake, years)
    dm = lake.scan("dws", "daily_master")
    return dm.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.sum(F.round(F.col("close") * 100).cast("long")).alias("checksum"))


# ---- whole flows ------------------------------------------------------------------------------
def _landing(spark, d) -> dict[str, DataFrame]:
    out = {"daily": fx.bars_raw(spark, d), "daily_basic": fx.basic(spark, d), "adj_factor": fx.adj(spark, d),
           "trade_cal": fx.cal_raw(spark, d), "stock_basic": _stock_raw(spark, d),
           "suspend_d": fx.suspend_raw(spark, d), "stk_limit": fx.limit_raw(spark, d)}
    out.update(_statement_slices(spark, d))
    return out


_ORDER_HINTS = ["event_id", "o_orderkey"]


_FLOW_CTES = MASTER_SQL + ",\n" + STOCK_RAW_SQL + ",\n" + EVENTS_SQL + """,
ods AS (
  SELECT 'daily' AS ds, CASE WHEN event_id % 4 IN (0, 1) THEN CAST(substr(trade_date, 1, 4) AS INTEGER) ELSE 2015 END AS year,
         ts_code AS k1, trade_date AS k2, CAST(NULL AS VARCHAR) AS k3 FROM bars_raw
  UNION ALL SELECT 'daily_basic', CAST(year(trade_date) AS INTEGER), ts_code, CAST(trade_date AS VARCHAR), NULL FROM basic
  UNION ALL SELECT 'adj_factor', CAST(year(trade_date) AS INTEGER), ts_code, CAST(trade_date AS VARCHAR), NULL FROM adj
  UNION ALL SELECT 'trade_cal', CAST(year(cal_date) AS INTEGER), exchange, CAST(cal_date AS VARCHAR), NULL FROM cal
  UNION ALL SELECT 'stock_basic', CAST(substr(list_date, 1, 4) AS INTEGER), ts_code, NULL, NULL FROM stock_raw
  UNION ALL SELECT 'suspend_d', CAST(substr(trade_date, 1, 4) AS INTEGER), ts_code, trade_date, NULL FROM suspend_raw
  UNION ALL SELECT 'stk_limit', CAST(substr(trade_date, 1, 4) AS INTEGER), ts_code, trade_date, NULL FROM limit_raw
  UNION ALL SELECT src, COALESCE(CAST(substr(ann_date, 1, 4) AS INTEGER), 2015), ts_code, end_date, ann_date FROM fin_raw),
suspend_d AS (
  SELECT *, CAST(strptime(trade_date, '%Y%m%d') AS DATE) AS day FROM suspend_raw
  QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date
          ORDER BY CAST(suspend_timing IS NOT NULL AS INT) DESC, event_id DESC) = 1),
stk_limit AS (
  SELECT *, CAST(strptime(trade_date, '%Y%m%d') AS DATE) AS day FROM limit_raw
  QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date ORDER BY event_id DESC) = 1),
dwd AS (
  SELECT 'daily' AS ds, CAST(year(trade_date) AS INTEGER) AS year, event_id + coalesce(CAST(round(close * 100) AS BIGINT), 0) AS v FROM daily
  UNION ALL SELECT 'daily_basic', CAST(year(trade_date) AS INTEGER), event_id FROM basic
  UNION ALL SELECT 'adj_factor', CAST(year(trade_date) AS INTEGER), event_id FROM adj
  UNION ALL SELECT 'trade_cal', CAST(year(cal_date) AS INTEGER), CASE WHEN exchange = 'SSE' AND day(cal_date) = 13 THEN 0 ELSE is_open END FROM cal
  UNION ALL SELECT 'stock_basic', CAST(substr(list_date, 1, 4) AS INTEGER), CAST(round(CAST(acctbal AS DOUBLE) * 100) AS BIGINT) FROM (SELECT DISTINCT ts_code, list_date, acctbal FROM stock_raw)
  UNION ALL SELECT 'suspend_d', CAST(year(day) AS INTEGER), event_id + coalesce(length(suspend_timing), 0) FROM suspend_d
  UNION ALL SELECT 'stk_limit', CAST(year(day) AS INTEGER), event_id + CAST(round(CAST(up_limit AS DOUBLE) * 100) AS BIGINT) FROM stk_limit
  UNION ALL SELECT source_table, CAST(year(real_ann_date) AS INTEGER), o_orderkey FROM events_stream),
dws AS (
  SELECT 'daily_master' AS ds, CAST(year(trade_date) AS INTEGER) AS year, event_id + coalesce(event_id_daily_basic, 0) + coalesce(event_id_adj_factor, 0) AS v FROM master
  UNION ALL SELECT 'financial_events', CAST(year(real_ann_date) AS INTEGER), o_orderkey FROM events_stream)"""

#: What the checksum of a stored dataset sums.
_CHECKED = {
    ("dwd", "daily"): "event_id + coalesce(cast(round(close * 100) AS bigint), 0)",
    ("dwd", "trade_cal"): "coalesce(is_open, 0)",
    ("dwd", "stock_basic"): "cast(round(acctbal * 100) AS bigint)",
    ("dwd", "suspend_d"): "event_id + coalesce(length(suspend_timing), 0)",
    ("dwd", "stk_limit"): "event_id + cast(round(up_limit * 100) AS bigint)",
    **{("dwd", n): "event_id" for n in ("daily_basic", "adj_factor")},
    **{("dwd", n): "o_orderkey" for n in ("fina_indicator", "income", "balancesheet")},
    ("dws", "daily_master"): "event_id + coalesce(event_id_daily_basic, 0) + coalesce(event_id_adj_factor, 0)",
    ("dws", "financial_events"): "o_orderkey",
}


@query("history_build", with_fixtures(["bars_raw", "basic", "adj", "cal", "fin_raw", "suspend_raw", "limit_raw"], """
SELECT 'ods' AS layer, ds AS dataset_name, year, COUNT(*) AS row_count, CAST(NULL AS BIGINT) AS checksum
FROM (SELECT DISTINCT ds, year, k1, k2, k3 FROM ods) GROUP BY ds, year
UNION ALL SELECT 'dwd', ds, year, COUNT(*), CAST(SUM(v) AS BIGINT) FROM dwd GROUP BY ds, year
UNION ALL SELECT 'dws', ds, year, COUNT(*), CAST(SUM(v) AS BIGINT) FROM dws GROUP BY ds, year""", _FLOW_CTES))
def q_history_build(spark, d):
    lake = _new_lake(spark)
    log = history_build(spark, lake.root, _landing(spark, d), "20150101", order_first=_ORDER_HINTS)
    sums = union_aligned([
        lake.scan(layer, name).groupBy("year").agg(F.sum(F.expr(e).cast("long")).alias("checksum"))
            .select(F.lit(layer).alias("layer"), F.lit(name).alias("dataset_name"), "year", "checksum")
        for (layer, name), e in _CHECKED.items()])
    return log.join(sums, ["layer", "dataset_name", "year"], "left").select("layer", "dataset_name", "year", "row_count", "checksum")


#: Days from a statement of ``fin_raw`` to its late copy, which falls into the
#: 90 days before the update's as-of date for the youngest orders.
_LATE_DAYS = 8220


def _late_landing(spark, d) -> dict[str, DataFrame]:
    """Ten landing tables of an update: corrected values for all days (the run
    takes the recent ones) and statements announced _LATE_DAYS later."""
    ev = fx.table(spark, d, "events").select("event_id", "value")
    bars = (fx.bars_raw(spark, d).join(ev, "event_id")
            .withColumn("close", F.when(F.col("close").isNotNull(), F.format_string("%.2f", F.col("value") + 1))).drop("value"))

    def later(c: str):
        return F.date_format(F.date_add(F.to_date(c, "yyyyMMdd"), _LATE_DAYS), "yyyyMMdd")

    statements = {n: df.withColumns({c: later(c) for c in ("ann_date", "f_ann_date") if c in df.columns}) for n, df in _statement_slices(spark, d).items()}
    return {"daily": bars, "daily_basic": fx.basic(spark, d).withColumn("turnover_rate", F.col("turnover_rate") + 1),
            "adj_factor": fx.adj(spark, d).withColumn("adj_factor", F.col("adj_factor") + 1),
            "trade_cal": fx.cal_raw(spark, d), "stock_basic": _stock_raw(spark, d).withColumn("acctbal", F.lit("0.5")),
            "suspend_d": fx.suspend_raw(spark, d).withColumn("suspend_type", F.lit("U")),
            "stk_limit": fx.limit_raw(spark, d, 20.0), **statements}


@query("daily_update", with_fixtures(["bars_raw", "basic", "adj", "cal", "fin_raw", "suspend_raw", "limit_raw"], f"""
SELECT 'daily_master' AS dataset_name, m.ts_code, m.trade_date AS day, m.event_id AS id,
       CASE WHEN m.trade_date IN (SELECT cal_date FROM recent) AND m.close IS NOT NULL
            THEN CAST(printf('%.2f', e.value + 1) AS DOUBLE) ELSE m.close END AS a,
       m.turnover_rate + CASE WHEN m.trade_date IN (SELECT cal_date FROM recent) THEN 1 ELSE 0 END AS b,
       m.adj_factor + CASE WHEN m.trade_date IN (SELECT cal_date FROM recent) THEN 1 ELSE 0 END AS c, m.tag AS t
FROM master m JOIN events e ON m.event_id = e.event_id
UNION ALL SELECT 'stk_limit', ts_code, day, event_id,
       CAST(CASE WHEN day IN (SELECT cal_date FROM recent) THEN later_limit ELSE up_limit END AS DOUBLE), CAST(down_limit AS DOUBLE), NULL, NULL
FROM stk_limit
UNION ALL SELECT 'suspend_d', ts_code, day, event_id, NULL, NULL, NULL,
       CASE WHEN day IN (SELECT cal_date FROM recent) THEN 'U' ELSE suspend_type END || coalesce(suspend_timing, '')
FROM suspend_d
UNION ALL SELECT DISTINCT 'stock_basic', ts_code, CAST(strptime(list_date, '%Y%m%d') AS DATE), CAST(NULL AS BIGINT), 0.5, NULL, NULL, name FROM stock_raw
UNION ALL SELECT 'trade_cal', exchange, cal_date, NULL,
       CASE WHEN exchange = 'SSE' AND day(cal_date) = 13 THEN NULL ELSE CAST(is_open AS DOUBLE) END, NULL, NULL, NULL FROM cal
UNION ALL SELECT 'financial_events', ts_code, real_ann_date, o_orderkey, roe, revenue, total_assets, source_table FROM events_stream
UNION ALL SELECT 'financial_events', ts_code, CAST(real_ann_date + INTERVAL {_LATE_DAYS} DAY AS DATE), o_orderkey, roe, revenue, total_assets, source_table
FROM events_stream WHERE CAST(ann_date + INTERVAL {_LATE_DAYS} DAY AS DATE) BETWEEN DATE '2023-10-30' AND DATE '2024-01-28'""",
       _FLOW_CTES + ",\n" + _RECENT_SQL))
def q_daily_update(spark, d):
    """A history of ten landing tables, then a daily update of all ten; both
    summary products and the auxiliary tables by value."""
    lake = _new_lake(spark)
    history_build(spark, lake.root, _landing(spark, d), order_first=_ORDER_HINTS)
    daily_update(spark, lake.root, _late_landing(spark, d), "20240128", order_first=_ORDER_HINTS)
    return _update_rows(lake)


def _update_rows(lake: Lake, names=None) -> DataFrame:
    rows = {
        "daily_master": ("dws", "ts_code", "trade_date", "event_id", "close", "turnover_rate", "adj_factor", "tag"),
        "stk_limit": ("dwd", "ts_code", "trade_date", "event_id", "up_limit", "down_limit", "NULL", "NULL"),
        "suspend_d": ("dwd", "ts_code", "trade_date", "event_id", "NULL", "NULL", "NULL", "suspend_type || coalesce(suspend_timing, '')"),
        "stock_basic": ("dwd", "ts_code", "list_date", "NULL", "acctbal", "NULL", "NULL", "name"),
        "trade_cal": ("dwd", "exchange", "cal_date", "NULL", "is_open", "NULL", "NULL", "NULL"),
        "financial_events": ("dws", "ts_code", "real_ann_date", "o_orderkey", "roe", "revenue", "total_assets", "source_table")}
    types = {"day": "date", "id": "bigint", "a": "double", "b": "double", "c": "double", "t": "string"}
    parts = []
    for name, (layer, code, *values) in rows.items():
        if names is None or name in names:
            parts.append(lake.scan(layer, name).select(F.lit(name).alias("dataset_name"), F.expr(code).alias("ts_code"),
                                                       *[F.expr(v).cast(t).alias(c) for v, (c, t) in zip(values, types.items())]))
    return union_aligned(parts)


@query("stream_update", with_fixtures(["bars_raw", "basic", "adj", "cal", "fin_raw"], """
SELECT 'daily_master' AS dataset_name, ts_code, trade_date AS day, event_id AS id, close AS a, turnover_rate AS b, adj_factor AS c, tag AS t FROM master
UNION ALL SELECT 'financial_events', ts_code, real_ann_date, o_orderkey, roe, revenue, total_assets, source_table
FROM events_stream""", MASTER_SQL + ",\n" + EVENTS_SQL))
def q_stream_update(spark, d):
    """Landing folders drained as streams through all three layers, the bars
    in micro-batches of one file, give what one batch build gives."""
    from ..streaming.update_stream import drain
    lake, home = _new_lake(spark), scratch_path(spark, "landing")
    sources = {"daily_basic": fx.basic(spark, d), "adj_factor": fx.adj(spark, d), **_statement_slices(spark, d), "daily": fx.bars_raw(spark, d)}
    landing = {name: (f"{home}/{name}", df.schema) for name, df in sources.items()}
    with ThreadPoolExecutor(max_workers=len(sources)) as pool:      # one task writes a file, so the folders side by side
        list(pool.map(lambda s: s[1].repartition(2 if s[0] == "daily" else 1).write.parquet(f"{home}/{s[0]}"), sources.items()))
    drain(spark, landing, lake.root, f"{home}-checkpoints", order_first=_ORDER_HINTS, max_files_per_trigger=1)
    return _update_rows(lake, ("daily_master", "financial_events"))


@query("rejected_rows", with_fixtures(["fin_raw", "cal", "bars_raw"], """
SELECT src AS table_name, CASE WHEN ann_date IS NULL THEN 'no announcement date' WHEN src <> 'fina_indicator' AND report_type <> '1' THEN 'other statement type' ELSE 'kept' END AS reason,
       COUNT(*) AS n_rows FROM fin_raw GROUP BY 1, 2
UNION ALL SELECT 'trade_cal', CASE WHEN exchange = 'SSE' AND day(cal_date) = 13 THEN 'bad integer' ELSE 'kept' END, COUNT(*) FROM cal GROUP BY 2
UNION ALL SELECT 'daily', CASE WHEN event_id % 9 = 0 THEN 'no partition year' ELSE 'kept' END, COUNT(*) FROM bars_raw GROUP BY 2"""))
def q_rejected_rows(spark, d):
    """Landing rows by reason: kept and rejected ones add up to the landed."""
    lake = _new_lake(spark)
    bars = fx.bars_raw(spark, d).withColumn("trade_date", F.when(F.col("event_id") % 9 == 0, F.lit("soon")).otherwise(F.col("trade_date")))
    landed = {**_statement_slices(spark, d), "trade_cal": fx.cal_raw(spark, d), "daily": bars}
    for name in [*landed, "trade_cal"]:              # the same batch again replaces what it left
        process_table(lake, name, landed[name], "20150101", order_first=_ORDER_HINTS, batch="first")
    counted = rejects(lake).groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
    kept = batch_state(lake).select("table_name", F.lit("kept").alias("reason"), F.col("rows_before").alias("n_rows"))
    return counted.unionByName(kept)


@query("run_quality_report", with_fixtures(["bars_raw", "fin"], """
SELECT 'daily' AS table_name, c AS column_name, CAST((SELECT COUNT(*) FROM daily) AS BIGINT) AS row_count,
       CAST(CASE c WHEN 'close' THEN (SELECT COUNT(*) FROM daily WHERE close IS NULL) WHEN 'tag' THEN (SELECT COUNT(*) FROM daily WHERE tag IS NULL) ELSE 0 END AS BIGINT) AS null_count,
       CAST((SELECT COUNT(*) FROM bars_raw) AS BIGINT) AS landed_rows, CAST(2 AS BIGINT) AS n_batches
FROM (VALUES ('ts_code'), ('trade_date'), ('close'), ('tag'), ('update_flag'), ('event_id')) AS t(c)""", DAILY_SQL))
def q_run_quality_report(spark, d):
    """A build and an update; the report is merged from the measures that the
    writes left, and equals SQL over the whole table."""
    lake = _new_lake(spark)
    bars = fx.bars_raw(spark, d)
    for k in range(2):
        process_table(lake, "daily", bars.where(F.col("event_id") % 2 == k), "20150101", order_first=_ORDER_HINTS, order_batches=True, batch=f"b{k}")
    report = state_report(lake)
    return report.select("table_name", F.explode("null_counts").alias("column_name", "null_count"), "row_count", "landed_rows", "n_batches")
