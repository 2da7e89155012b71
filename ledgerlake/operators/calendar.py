"""Trading calendar: cleaning, ranges, latest / recent open days, and
date coverage of a table against the calendar."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import parse_date_two
from ..specs import SETTINGS
from .asof import asof_join


def to_date_param(value) -> _dt.date:
    """Scalar date parameter from a date, 'yyyyMMdd' or 'yyyy-MM-dd'."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    if value is None or not str(value).strip():
        raise ValueError("a valid date is required")
    text = str(value).strip()
    fmt = "%Y-%m-%d" if "-" in text else "%Y%m%d"
    return _dt.datetime.strptime(text, fmt).date()


def clean_calendar(raw: DataFrame) -> DataFrame:
    """exchange as text, cal_date parsed (yyyyMMdd or yyyy-M-d), is_open as a
    lenient integer; rows missing any of the three are dropped."""
    out = raw.withColumns({
        "exchange": F.col("exchange").cast("string"),
        "cal_date": parse_date_two("cal_date"),
        "is_open": F.expr("try_cast(is_open AS INT)"),
    })
    return out.dropna(subset=["exchange", "cal_date", "is_open"])


def calendar_days(cal: DataFrame, exchange: str = SETTINGS.default_exchange,
                  open_only: bool = True) -> DataFrame:
    out = cal.where(F.col("exchange") == exchange)
    if open_only:
        out = out.where(F.col("is_open") == 1)
    return out


def trade_dates_between(cal: DataFrame, start, end, exchange: str = SETTINGS.default_exchange,
                        open_only: bool = True) -> DataFrame:
    """cal_date of (open) days in the closed range [start, end], ascending."""
    s, e = to_date_param(start), to_date_param(end)
    return (calendar_days(cal, exchange, open_only)
            .where(F.col("cal_date").between(F.lit(s), F.lit(e)))
            .select("cal_date").orderBy("cal_date"))


def latest_trade_date(cal: DataFrame, target, exchange: str = SETTINGS.default_exchange) -> DataFrame:
    """One row: (target, latest_open) -- the latest open day on or before
    target, null when there is none."""
    t = to_date_param(target)
    return (calendar_days(cal, exchange).where(F.col("cal_date") <= F.lit(t))
            .agg(F.max("cal_date").alias("latest_open"))
            .select(F.lit(t).alias("target"), "latest_open"))


def latest_open_for(cal: DataFrame, targets: DataFrame, target_col: str,
                    exchange: str = SETTINGS.default_exchange) -> DataFrame:
    """For every row of ``targets``, the latest open day on or before its
    ``target_col`` (an as-of join against the calendar)."""
    left = targets.withColumn("__exchange", F.lit(exchange))
    right = calendar_days(cal, exchange).select(F.col("exchange").alias("__exchange"), "cal_date")
    out = asof_join(left, right, by="__exchange", left_on=target_col, right_on="cal_date",
                    columns=["cal_date"], prefix="latest_")
    return out.drop("__exchange").withColumnRenamed("latest_cal_date", "latest_open")


def recent_trade_dates(cal: DataFrame, end, k: int, exchange: str = SETTINGS.default_exchange) -> DataFrame:
    """The last ``k`` open days on or before ``end`` (anchored at the latest
    open day), ascending.  Top-k: a TakeOrderedAndProject, not a sort."""
    if k <= 0:
        raise ValueError(f"k is the number of open days to return; got {k}")
    e = to_date_param(end)
    top = (calendar_days(cal, exchange).where(F.col("cal_date") <= F.lit(e))
           .select("cal_date").orderBy(F.col("cal_date").desc()).limit(k))
    return top.orderBy("cal_date")


def expected_dates_array(cal: DataFrame, start, end, exchange: str = SETTINGS.default_exchange):
    """Scalar-subquery column: sorted array of open days in [start, end].
    Its size is bounded by the number of days in the range."""
    s, e = to_date_param(start), to_date_param(end)
    days = calendar_days(cal, exchange).where(F.col("cal_date").between(F.lit(s), F.lit(e)))
    return days.agg(F.sort_array(F.collect_set("cal_date"))).scalar()


def day_bitmaps(df: DataFrame, date_col: str, start, end, group_cols=()) -> DataFrame:
    """(group, days): one bit per day of [start, end], set where the group has
    a row of that day.  Bitmaps of parts of the data merge by OR
    (``merge_day_bitmaps``), so a part's bitmaps can be kept and only new parts
    be read.  A range has at most MOST_DAYS days (one bitmap of 4 KB)."""
    place = _place(date_col, to_date_param(start), to_date_param(end))
    return df.groupBy(*group_cols).agg(F.bitmap_construct_agg(place).alias("days"))


def _place(date_col: str, s: _dt.date, e: _dt.date):
    """The bit of a day, null outside [s, e] (nulls set no bit)."""
    if (e - s).days >= MOST_DAYS:
        raise ValueError(f"a range of at most {MOST_DAYS} days; got {(e - s).days + 1}")
    d = F.col(date_col)
    return F.when(d.between(F.lit(s), F.lit(e)), F.datediff(d, F.lit(s)).cast("long"))


#: Bits of Spark's bitmaps.
MOST_DAYS = 32_768


def merge_day_bitmaps(df: DataFrame, group_cols=()) -> DataFrame:
    return df.groupBy(*group_cols).agg(F.bitmap_or_agg("days").alias("days"))


def _bit(days, place):
    """Whether the bit at ``place`` is set (false for no bitmap)."""
    byte = F.conv(F.hex(F.substring(days, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, F.pmod(place, F.lit(8))).bitwiseAND(1) == 1, F.lit(False))


def coverage_summary(cal: DataFrame, actual: DataFrame, date_col: str, start, end,
                     group_cols=(), exchange: str = SETTINGS.default_exchange,
                     universe: DataFrame | None = None) -> DataFrame:
    """Coverage of a table's dates against open days in [start, end].

    Per group (or one row for the whole table): expected_dates = open days in
    range; actual_dates = distinct dates present (any date, also outside the
    range); covered_dates = expected days present; missing_dates = sorted
    array of expected days absent.  A group's days are one bit each, built on
    the map side; the range bounds what the open days and a group's missing
    days can be.  ``universe`` (group columns) names the groups to report: one
    without any row has all days missing.  Groups outside of it are left out.
    """
    s, e = to_date_param(start), to_date_param(end)
    expected = expected_dates_array(cal, s, e, exchange)
    grouped = actual.groupBy(*group_cols) if group_cols else actual.groupBy()
    agg = grouped.agg(F.count_distinct(F.col(date_col)).alias("actual_dates"),
                      F.bitmap_construct_agg(_place(date_col, s, e)).alias("__days"))
    if universe is not None:
        groups = universe.select(*group_cols).distinct().withColumnsRenamed({c: f"__u_{c}" for c in group_cols})
        same = [F.col(f"__u_{c}").eqNullSafe(F.col(c)) for c in group_cols]
        agg = groups.join(agg, same, "left").select(*[F.col(f"__u_{c}").alias(c) for c in group_cols], "actual_dates", "__days")
    # the scalar subquery is referenced once, then reused as a column
    with_exp = agg.select(*group_cols, F.coalesce("actual_dates", F.lit(0)).cast("long").alias("actual_dates"), "__days", expected.alias("__exp"))
    missing = F.filter("__exp", lambda d: ~_bit(F.col("__days"), F.datediff(d, F.lit(s))))
    return with_exp.withColumn("__missing", missing).select(
        *group_cols,
        F.size("__exp").cast("long").alias("expected_dates"),
        "actual_dates",
        (F.size("__exp") - F.size("__missing")).cast("long").alias("covered_dates"),
        F.col("__missing").alias("missing_dates"),
    )


def coverage_missing_dates(cal: DataFrame, actual: DataFrame, date_col: str, start, end,
                           group_cols=(), exchange: str = SETTINGS.default_exchange,
                           universe: DataFrame | None = None) -> DataFrame:
    """One row per (group, missing open day)."""
    summary = coverage_summary(cal, actual, date_col, start, end, group_cols, exchange, universe)
    return summary.select(*group_cols, F.explode("missing_dates").alias("missing_date"))


def calendar_from_parquet(spark, path: str) -> DataFrame:
    """Read a calendar file projecting only the three calendar columns (the
    scan's ReadSchema holds just these), then clean it."""
    return clean_calendar(spark.read.parquet(path).select("exchange", "cal_date", "is_open"))
