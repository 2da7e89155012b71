"""Backward as-of join: each left row gets the latest right row of the same
key whose date is on or before the left date (point-in-time correct).

The right side is first reduced to one row per (key, date): the survivor of
that day by the tiebreak columns (``max`` of a struct, partially aggregated on
the map side).  Then one of two plans, neither of which puts a hot key's rows
in one task:

*Dates* (``_timeline``): the right side becomes one row per (key, year) with
the array of its days in that year, led by what held at the year's start; years
without a day carry on what held before.  An array has at most 367 entries,
years are bounded by the calendar.  Each left row meets exactly one such row by
an equi-join on (key, year) and takes the last entry up to its date.  The left
side is read once, moved at most once, and never sorted into a window; AQE
splits a hot (key, year), since every left row finds its match by itself.

*Timestamps and numbers* (``_carry_forward``), whose timelines can be dense:
the left side's distinct (key, order) pairs and the right rows are stacked and
scanned by windows per (key, bucket), carrying the last right row forward; what
is carried into a bucket comes from a window over the key's buckets, one row
each.  Buckets are days for timestamps and quantiles of the right side for
numbers, so outliers do not stretch them.  The matches are joined back to the
left rows, which are read a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from .dedup import require_columns


def _day_survivors(right: DataFrame, by: str, right_on: str, payload_cols, tiebreak,
                   group_col: str | None = None, groups=()):
    """Right rows with a key and a date, reduced to one struct per (key, date)
    (or per (key, date, group) value, as separate columns)."""
    r = right.where(F.col(by).isNotNull() & F.col(right_on).isNotNull())
    fields = [F.col(c).alias(f"t{i}") for i, c in enumerate(tiebreak)]
    fields += [F.col(c).alias(c) for c in payload_cols]
    payload = F.struct(*fields)
    if group_col is None:
        aggs = [F.max(payload).alias("__ev")]
    else:
        aggs = [F.max(F.when(F.col(group_col) == g, payload)).alias(f"__ev{i}")
                for i, g in enumerate(groups)]
    return r.groupBy(F.col(by).alias("__k"), F.col(right_on).alias("__d")).agg(*aggs)


#: Quantiles of the right side that "auto" cuts a numeric order column at: two
#: levels of QUANTILES each, so a row is placed by two short comparisons.
QUANTILES = 32


def _span(right: DataFrame, on: str, bucket):
    """How a numeric order column is cut, as a function of its values: the
    given width, or quantiles of the right side (one row from one aggregate,
    read by the plan itself).  ``None`` for other types."""
    if bucket is None or not isinstance(right.schema[on].dataType, T.NumericType):
        return None
    if isinstance(bucket, (int, float)):
        return lambda d: F.floor(d.cast("double") / F.lit(float(bucket)))
    n = QUANTILES * QUANTILES
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    every = F.coalesce(F.percentile_approx(F.col(on).cast("double"), shares, 10 * n), F.array().cast("array<double>"))
    steps = F.sequence(F.lit(QUANTILES - 1), F.lit(n - 2), F.lit(QUANTILES))
    cuts = (right.agg(every.alias("fine")).select(F.struct("fine", F.transform(steps, lambda i: F.get("fine", i)).alias("coarse")).alias("cuts"))
            .scalar())

    def smaller(some, v):                # of a sorted array; no lambda, which could not hold the subquery
        return F.array_position(F.sort_array(F.array_append(some, v)), v) - 1

    def place(d):
        v = d.cast("double")
        k = smaller(F.array_compact(cuts["coarse"]), v)
        return k * QUANTILES + smaller(F.slice(cuts["fine"], (k * QUANTILES + 1).cast("int"), F.lit(QUANTILES)), v)
    return place


def _bucket_of(d, dtype: T.DataType, bucket, span=None):
    """Time bucket of the order column: ``"year"`` or a ``date_trunc`` unit.
    ``"auto"``: none for dates -- a key's timeline is at most its calendar
    days, a few hundred rows a year -- and ``"day"`` for timestamps, whose
    timelines can be dense.  Numeric order columns are cut by ``span``.
    ``None`` for other types."""
    if span is not None:
        return span(d)
    if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return None
    if bucket == "auto":
        bucket = None if isinstance(dtype, T.DateType) else "day"
    if bucket is None:
        return None
    return F.year(d) if bucket == "year" else F.date_trunc(bucket, d)


def _carry_forward(left: DataFrame, day_rows: DataFrame, by: str, left_on: str, ev_cols,
                   bucket: str | None = "auto", span=None):
    keys = (left.where(F.col(by).isNotNull() & F.col(left_on).isNotNull())
                .select(F.col(by).alias("__k"), F.col(left_on).alias("__d")).distinct())
    nulls = [F.lit(None).cast(day_rows.schema[c].dataType).alias(c) for c in ev_cols]
    stacked = (day_rows.select("__k", "__d", F.lit(0).alias("__side"), *ev_cols)
               .unionByName(keys.select("__k", "__d", F.lit(1).alias("__side"), *nulls)))
    b = _bucket_of(F.col("__d"), stacked.schema["__d"].dataType, bucket, span)
    if b is None:
        w = (Window.partitionBy("__k").orderBy("__d", "__side")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        carried = stacked.select("__k", "__d", "__side",
                                 *[F.last(c, ignorenulls=True).over(w).alias(c) for c in ev_cols])
        return carried.where(F.col("__side") == 1).drop("__side")
    stacked = stacked.withColumn("__b", b)
    # inside each (key, bucket)
    w = (Window.partitionBy("__k", "__b").orderBy("__d", "__side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = (stacked.select("__k", "__b", "__d", "__side",
                             *[F.last(c, ignorenulls=True).over(w).alias(c) for c in ev_cols])
                     .where(F.col("__side") == 1).drop("__side"))
    # carried in from earlier buckets: last right row per (key, bucket), then
    # the latest of the earlier buckets (a window over a key's buckets only)
    last_rows = stacked.groupBy("__k", "__b").agg(
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(F.col("__d").alias("d"), F.col(c).alias("v"))))
          .alias(c) for c in ev_cols])
    wb = Window.partitionBy("__k").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry_in = last_rows.select("__k", "__b", *[F.last(F.col(c)["v"], ignorenulls=True).over(wb).alias(f"__in{i}")
                                                for i, c in enumerate(ev_cols)])
    out = within.join(carry_in, ["__k", "__b"], "left")
    return out.select("__k", "__d", *[F.coalesce(F.col(c), F.col(f"__in{i}")).alias(c)
                                      for i, c in enumerate(ev_cols)])


def _timeline(day_rows: DataFrame, ev_cols, last_year) -> DataFrame:
    """(key, year, days): for each key and every year from its first to
    ``last_year``, which also stands for all later ones, the sorted (date,
    values) that can match in it."""
    # what holds on each day: the last value of every column (a key's days only)
    w = Window.partitionBy("__k").orderBy("__d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = [F.last(c, ignorenulls=True).over(w).alias(c) for c in ev_cols] if len(ev_cols) > 1 else [F.col(c) for c in ev_cols]
    held = day_rows.select("__k", "__d", F.year("__d").alias("__y"), F.struct(F.col("__d").alias("d"), *state).alias("day"))
    years = held.groupBy("__k", "__y").agg(F.sort_array(F.collect_list("day")).alias("days"), F.max("day").alias("last"))
    over = Window.partitionBy("__k").orderBy("__y")
    years = years.select("__k", "__y", "days", "last", F.lag("last").over(over).alias("before"), F.lead("__y").over(over).alias("next"))
    upto = F.coalesce(F.col("next") - 1, last_year)
    filled = years.select("__k", "__y", "days", "last", "before", F.explode(F.sequence("__y", upto)).alias("year"))
    first = F.when(F.col("before").isNotNull(), F.concat(F.array("before"), F.col("days"))).otherwise(F.col("days"))
    return filled.select(F.col("__k"), F.col("year").alias("__y"),
                         F.when(F.col("year") == F.col("__y"), first).otherwise(F.array("last")).alias("days"))


def _matched(left: DataFrame, day_rows: DataFrame, right: DataFrame, by: str, left_on: str, right_on: str, ev_cols, bucket) -> DataFrame:
    """Left rows with the values that match them, as columns ``ev_cols``."""
    dates = all(isinstance(df.schema[c].dataType, T.DateType) for df, c in ((left, left_on), (right, right_on)))
    if bucket != "auto" or not dates:
        matched = _carry_forward(left, day_rows, by, left_on, ev_cols, bucket, _span(right, right_on, bucket))
        return left.join(matched, (left[by] == matched["__k"]) & (left[left_on] == matched["__d"]), "left")
    last_year = right.agg(F.max(F.year(right_on)).alias("y")).select("y").scalar()
    timeline = _timeline(day_rows, ev_cols, last_year)
    asked = left.withColumn("__ask", F.least(F.year(left[left_on]), last_year))
    out = asked.join(timeline, (asked[by] == timeline["__k"]) & (asked["__ask"] == timeline["__y"]), "left")
    found = F.try_element_at(F.filter(timeline["days"], lambda x: x["d"] <= left[left_on]), F.lit(-1))
    out = out.withColumn("__found", found)
    return out.select(*[left[c] for c in left.columns], *[F.col("__found")[c].alias(c) for c in ev_cols])


def asof_join(left: DataFrame, right: DataFrame, *, by: str, left_on: str, right_on: str,
              columns=None, tiebreak=(), prefix: str = "", bucket: str | None = "auto") -> DataFrame:
    """Backward as-of LEFT join.

    ``columns``: right columns to bring (default: all but the key); the right
    date is always included.  ``tiebreak``: right columns ordering rows of
    the same (key, date) -- the largest wins; all brought columns follow as
    a final total order.  Unmatched left rows get nulls.  ``prefix`` renames
    brought columns.  ``bucket`` splits each key's timeline into time
    buckets (``"year"`` or a ``date_trunc`` unit such as ``"hour"``, or a
    width for a numeric order column; ``None`` scans a key's whole timeline in
    one window; ``"auto"``: one lookup by (key, year) for dates, ``"day"``
    buckets for timestamps, quantiles of the right side for numbers).  Left
    rows without a key or a date match nothing.
    """
    require_columns(left, [by, left_on], "left")
    require_columns(right, [by, right_on], "right")
    cols = list(columns) if columns is not None else [c for c in right.columns if c != by]
    if right_on not in cols:
        cols = [right_on] + cols
    day_rows = _day_survivors(right, by, right_on, cols, list(tiebreak))
    out = _matched(left, day_rows, right, by, left_on, right_on, ["__ev"], bucket)
    return out.select(*[left[c] for c in left.columns],
                      *[F.col(f"__ev.{c}").alias(prefix + c) for c in cols])


def asof_join_by_group(left: DataFrame, right: DataFrame, *, by: str, left_on: str, right_on: str,
                       group_col: str, groups, columns=None, tiebreak=(),
                       bucket: str | None = "auto") -> DataFrame:
    """One as-of match per value of ``group_col`` (e.g. per source table) in
    the same single pass: brought columns are named ``<group>_<column>``."""
    require_columns(right, [by, right_on, group_col], "right")
    groups = list(groups)
    cols = list(columns) if columns is not None else [c for c in right.columns if c not in (by, group_col)]
    if right_on not in cols:
        cols = [right_on] + cols
    day_rows = _day_survivors(right, by, right_on, cols, list(tiebreak), group_col, groups)
    ev_cols = [f"__ev{i}" for i in range(len(groups))]
    out = _matched(left, day_rows, right, by, left_on, right_on, ev_cols, bucket)
    brought = [F.col(f"__ev{i}.{c}").alias(f"{g}_{c}") for i, g in enumerate(groups) for c in cols]
    return out.select(*[left[c] for c in left.columns], *brought)
