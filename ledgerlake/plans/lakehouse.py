"""Raw -> detail -> summary flows over the lake: history build, daily
update (backfill windows), and rebuild of only the affected years."""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.casting import numeric_columns_from, numeric_profile_aggs
from ..functions.dates import parse_date_two
from ..operators.calendar import clean_calendar, coverage_summary, recent_trade_dates, to_date_param
from ..operators.clean import add_source_tag, clean_table
from ..operators.dedup import require_columns
from ..operators.products import build_dws_outputs, product_inputs
from ..operators.quality import nested_report, table_quality, write_report
from ..operators.rejects import REASON, reject_reason, rejected
from ..session import checkpoint_root
from ..sources.lake import YEAR, Lake
from ..sources.landing import LandingFolder
from ..specs import DAILY_MASTER_SOURCES, FINANCIAL_EVENT_SOURCES, SETTINGS, spec as get_spec
from .quality_state import note_batch, note_years


# ---- raw layer ---------------------------------------------------------------------------
def raw_partition_date(df: DataFrame, table_name: str, fallback_date) -> F.Column:
    """Raw-layer partition date: the first spec date column present, read
    as yyyyMMdd or yyyy-M-d, else the fallback date."""
    sp = get_spec(table_name)
    fallback = F.lit(to_date_param(fallback_date))
    col = next((c for c in sp.date_columns if c in df.columns), None)
    if col is None:
        return fallback
    return F.coalesce(parse_date_two(F.col(col).cast("string")), fallback)


def write_raw(lake: Lake, table_name: str, raw: DataFrame, fallback_date, order_first=(), stage: bool = True) -> list[int]:
    """Upsert landing rows into ``ods/<table>`` by the year of the raw
    partition date; duplicates are resolved on the raw (text) key.  ``stage``
    False: ``raw`` is staged already (see ``Lake.upsert``)."""
    sp = get_spec(table_name)
    staged = add_source_tag(raw, table_name) if sp.is_financial else raw
    staged = staged.withColumn("__raw_date", raw_partition_date(staged, table_name, fallback_date))
    require_columns(staged, sp.primary_key)
    return lake.upsert("ods", table_name, staged, sp.primary_key, "__raw_date", order_first, drop_date=True, stage=stage)


# ---- detail layer --------------------------------------------------------------------------
def persist_detail(lake: Lake, table_name: str, cleaned: DataFrame, order_first=(), across_years: bool = False) -> list[int]:
    """Upsert cleaned rows into ``dwd/<table>`` by the year of the
    partition date (real_ann_date for statements).  Where a column's type has
    widened, every year was rewritten and is returned."""
    sp = get_spec(table_name)
    lake.widened.pop(("dwd", table_name), None)
    years = lake.upsert("dwd", table_name, cleaned, sp.primary_key, sp.dwd_partition_column, order_first, across_years=across_years)
    return sorted({*years, *lake.widened.get(("dwd", table_name), ())})


# ---- summary layer ---------------------------------------------------------------------------
#: Key columns of a daily table that was never written.
_NO_DAILY = "ts_code string, trade_date date"
_SUMMARY = {"daily_master": ("trade_date", ("ts_code", "trade_date")),
            "financial_events": ("real_ann_date", ("ts_code", "real_ann_date", "end_date", "ann_date", "source_table"))}


def rebuild_summary(lake: Lake, years, products=tuple(_SUMMARY)) -> dict[str, list[int]]:
    """Rebuild daily_master and financial_events for ``years`` only: one
    job per product for all years (dynamic overwrite replaces exactly the
    years that have rows; a year that has none left is emptied).  A side table
    that was never written counts as empty."""
    years = sorted({int(y) for y in years})
    if not years:
        return {}
    detail = {n: lake.read_years("dwd", n, years, refresh=False) for product in products for n in product_inputs(product)}
    detail = {n: df.drop(YEAR) for n, df in detail.items() if df is not None}
    if DAILY_MASTER_SOURCES[0] in detail:
        for n in DAILY_MASTER_SOURCES[1:]:
            detail.setdefault(n, lake.spark.createDataFrame([], _NO_DAILY))
    return {product: lake.write_years("dws", product, frame, _SUMMARY[product][0], sort_cols=_SUMMARY[product][1], within=years)
            for product, frame in build_dws_outputs(detail).items() if product in products}


# ---- flows -----------------------------------------------------------------------------------
def keep_rejects(lake: Lake, name: str, batch: str, marked: DataFrame) -> None:
    """Write the rejected rows of a marked landing batch to
    ``<root>/rejects/table_name=../batch=..``, in place of those that the same
    batch left there before."""
    (rejected(name, marked).drop("table_name").write.mode("overwrite")
        .parquet(f"{lake.root}/rejects/table_name={name}/batch={batch}"))


def rejects(lake: Lake) -> DataFrame:
    """(table_name, batch, reason, row) of all batches."""
    return (lake.spark.read.schema("reason string, row string, table_name string, batch string").parquet(f"{lake.root}/rejects")
            .select("table_name", "batch", "reason", "row"))


def stored_types(lake: Lake, name: str) -> dict[str, str] | None:
    """Column types of a stored detail dataset: they fix the types of later
    batches where their values allow."""
    schema = lake.stored_schema("dwd", name)
    return None if schema is None else {f.name: f.dataType.simpleString() for f in schema.fields}


def process_table(lake: Lake, name: str, raw: DataFrame, fallback_date, order_first=(),
                  stage_landing: bool = True, results: dict | None = None, across_years: bool = False,
                  ledger=None, order_batches: bool = False, batch: str | None = None) -> list[int]:
    """One landing table through raw -> detail.  The landing rows are read
    three times (raw write, type profile, clean).  With ``stage_landing``
    they are staged once, so a computed landing frame (joins, windows) is
    not recomputed; pass False when the landing frames are plain reads of
    landing files, which are cheaper to re-read than to copy.
    ``order_first`` hints naming columns the table lacks are skipped.
    ``results`` (a dict) receives the table's ``CleanResult`` for a report.
    ``across_years``: one row per key over all years (see ``Lake.upsert``).
    ``order_batches``: ``order_first`` ranks a key's rows before their batch
    does.  ``batch`` names the batch: rows that the detail layer does not take
    are then kept in ``<root>/rejects`` and the quality measures beside the data
    (``quality_state``) brought up to date; the same name again replaces what
    the batch had left there.  ``ledger`` (see ``streaming.update_stream``) notes the finished
    steps; one that has finished before is not run again.  Without a ledger the
    raw and the detail layer, which both read the landing rows alone, are
    written side by side."""
    known = stored_types(lake, name)
    numeric = None
    if stage_landing:
        # the numeric profile rides along the staging write: no extra pass
        cands, aggs = numeric_profile_aggs(raw, protected=get_spec(name).date_columns, known_types=known)
        profile = Observation(f"profile-{name}-{uuid.uuid4().hex[:8]}")
        # with a batch name, the same write parts kept and rejected rows
        marked = raw.withColumn(REASON, reject_reason(name, raw)) if batch is not None else raw
        staged = lake.stage(marked.observe(profile, *aggs), f"landing-{name}")
        raw = staged.drop(REASON)
        numeric = numeric_columns_from(cands, profile.get, known)
    elif batch is not None:
        staged = raw.withColumn(REASON, reject_reason(name, raw))
    hints = [o for o in order_first if not isinstance(o, str) or o in raw.columns]
    across = hints if order_batches else ()

    def to_raw() -> list[int]:
        return write_raw(lake, name, raw, fallback_date, across, stage=not stage_landing)

    def to_detail():
        taken = raw if batch is None else staged.where(F.col(REASON).isNull()).drop(REASON)
        cleaned = clean_table(name, taken, numeric_columns=numeric, order_first=hints, known_types=known, keep_spelling=True)
        return cleaned, persist_detail(lake, name, cleaned.stored, across, across_years)

    if ledger is None:
        with ThreadPoolExecutor(max_workers=1) as pool:
            landed = pool.submit(to_raw)
            res, years = to_detail()
        landed.result()
    else:
        if ledger.years("raw") is None:
            ledger.finish("raw", to_raw())
        res, years = to_detail()
    if results is not None:
        results[name] = res
    if batch is not None:
        keep_rejects(lake, name, batch, staged)
        note_batch(lake, name, batch, raw, res.prepared, res.primary_key)
        note_years(lake, "dwd", name, years)
    if ledger is not None:
        ledger.finish("detail", years)
    return years


def process_tables(lake: Lake, batches: dict[str, DataFrame], fallback_date, order_first=(),
                   stage_landing: bool = True, results: dict | None = None) -> set[int]:
    """Every landing table through raw -> detail.  Tables write disjoint
    datasets, so they run as concurrent Spark jobs (a few at a time): small
    tables fill the cluster alongside big ones instead of queueing behind
    them.  Returns the years touched in the summary products' inputs."""
    checkpoint_root(lake.spark)        # resolve the shared folder before the threads start
    workers = max(1, min(SETTINGS.concurrent_tables, len(batches)))
    touched: set[int] = set()
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(process_table, lake, name, raw, fallback_date, order_first,
                                     stage_landing, results)
                   for name, raw in batches.items()}
        for name, fut in futures.items():
            years = fut.result()
            if name in DAILY_MASTER_SOURCES or name in FINANCIAL_EVENT_SOURCES:
                touched.update(years)
    return touched


def run_report(lake: Lake, results: dict, datasets, calendar: DataFrame | None = None,
               coverage_range=None) -> DataFrame:
    """The nested quality report of a run: per table its dedup counts, null
    profile of the survivors and partition log (see ``nested_report``);
    with a calendar and a (start, end) range, also the trade-date coverage
    of every table keyed by trade_date."""
    names = sorted(results)
    if not names:
        raise ValueError("no cleaned tables to report")
    quality = reduce(DataFrame.unionByName, [
        table_quality(n, results[n].prepared, results[n].frame, results[n].primary_key) for n in names])
    nulls = reduce(DataFrame.unionByName, [results[n].null_profile() for n in names])
    coverage = None
    dated = [n for n in names if "trade_date" in results[n].primary_key]
    if calendar is not None and coverage_range is not None and dated:
        start, end = coverage_range
        coverage = reduce(DataFrame.unionByName, [
            coverage_summary(calendar, results[n].frame, "trade_date", start, end)
            .select(F.lit(n).alias("table_name"),
                    F.struct("expected_dates", "actual_dates", "covered_dates", "missing_dates").alias("coverage"))
            for n in dated])
    return nested_report(quality, nulls, lake_log(lake, datasets), coverage)


def history_build(spark: SparkSession, lake_root: str, landing: dict[str, DataFrame],
                  fallback_date="20150101", order_first=(), stage_landing: bool = True,
                  report_path: str | None = None, coverage_range=None) -> DataFrame:
    """Full build: every landing table through raw -> detail, then the
    summary products of every year the detail writes touched.  Returns the
    run's write log (see ``lake_log``); with
    ``report_path`` the run's nested quality report is written there
    (with trade-date coverage over ``coverage_range`` when given)."""
    lake = Lake(spark, lake_root)
    results: dict | None = {} if report_path else None
    touched = process_tables(lake, landing, fallback_date, order_first, stage_landing, results)
    rebuild_summary(lake, touched)
    datasets = list(landing) + ["daily_master", "financial_events"]
    if report_path:
        cal = results["trade_cal"].frame if "trade_cal" in results else lake.scan("dwd", "trade_cal")
        write_report(run_report(lake, results, datasets, cal, coverage_range), report_path)
    return lake_log(lake, datasets)


def backfill_daily(landing: DataFrame, recent_dates: DataFrame, date_col: str = "trade_date") -> DataFrame:
    """Landing rows on the recent open days (a semi join, broadcast where the
    days' measured size allows it)."""
    from ..functions.dates import parse_date_multi
    d = parse_date_multi(F.col(date_col), landing.schema[date_col].dataType)
    keys = recent_dates.select(F.col("cal_date").alias("__rd"))
    return landing.join(keys, d == F.col("__rd"), "left_semi")


def backfill_financial(landing: DataFrame, as_of, days: int = SETTINGS.financial_backfill_days,
                       date_col: str = "ann_date") -> DataFrame:
    """Statement rows announced in [as_of - days, as_of]."""
    from ..functions.dates import parse_date_multi
    e = to_date_param(as_of)
    s = e - _dt.timedelta(days=days)
    d = parse_date_multi(F.col(date_col), landing.schema[date_col].dataType)
    return landing.where(d.between(F.lit(s), F.lit(e)))


def daily_update(spark: SparkSession, lake_root: str, landing: dict[str, DataFrame | LandingFolder], as_of,
                 calendar: DataFrame | None = None, fallback_date="20150101", order_first=(),
                 stage_landing: bool = True, report_path: str | None = None) -> DataFrame:
    """Daily run: daily and auxiliary tables re-read for the last five open
    days up to ``as_of``, statements for the last 90 calendar days; each
    through raw -> detail; summary rebuilt for the touched years.  Rerunning
    with the same input changes nothing (upserts are idempotent).  A table
    given as a ``LandingFolder`` reads only the files that no finished run has
    read; they are marked as read once the summary is rebuilt, but for files
    that hold days after ``as_of``.  Returns the write log of this run."""
    lake = Lake(spark, lake_root)
    folders = {n: f for n, f in landing.items() if isinstance(f, LandingFolder)}
    landing = {n: folders[n].rows() if n in folders else f for n, f in landing.items()
               if n not in folders or folders[n].new_files()}
    cal = calendar
    if cal is None:
        cols = ["exchange", "cal_date", "is_open"]
        stored = lake.scan("dwd", "trade_cal")
        stored = stored.select(*cols) if stored is not None else None
        if "trade_cal" in landing:
            # the landing calendar is the fresh one: it wins over stored days,
            # and stored days it does not repeat are kept (a stored calendar
            # alone would age and anchor the backfill window too early)
            fresh = clean_calendar(landing["trade_cal"]).select(*cols)
            cal = fresh if stored is None else fresh.unionByName(
                stored.join(fresh, ["exchange", "cal_date"], "left_anti"))
        else:
            cal = stored
    if cal is None:
        raise ValueError("a trading calendar is required")
    # k rows, staged before any dataset (the calendar included) is rewritten
    recent = lake.stage(recent_trade_dates(cal, as_of, SETTINGS.daily_backfill_days), "recent-dates")
    # the same days as a calendar, for the coverage of the run
    recent_cal = recent.select(F.lit(SETTINGS.default_exchange).alias("exchange"), "cal_date",
                               F.lit(1).alias("is_open"))
    batches: dict[str, DataFrame] = {}
    for name, raw in landing.items():
        sp = get_spec(name)
        if name == "trade_cal" or name == "stock_basic":
            batches[name] = raw
        elif sp.is_financial:
            batches[name] = backfill_financial(raw, as_of)
        else:
            batches[name] = backfill_daily(raw, recent, sp.date_columns[0])
    results: dict | None = {} if report_path else None
    touched = process_tables(lake, batches, fallback_date, order_first, stage_landing, results) if batches else set()
    rebuild_summary(lake, touched)
    for name, folder in folders.items():
        sp = get_spec(name)
        windowed = name not in ("trade_cal", "stock_basic")
        folder.commit(("ann_date" if sp.is_financial else sp.date_columns[0]) if windowed else None, to_date_param(as_of))
    datasets = list(landing) + ["daily_master", "financial_events"]
    if report_path and results:
        # coverage over the backfill window: its first and last open day (k rows)
        bounds = recent.agg(F.min("cal_date").alias("s"), F.max("cal_date").alias("e")).first()
        window = (bounds["s"], bounds["e"]) if bounds["s"] is not None else None
        write_report(run_report(lake, results, datasets, recent_cal, window), report_path)
    return lake_log(lake, datasets)


def lake_log(lake: Lake, datasets) -> DataFrame:
    """Write log of a run: path, rows and files of every year of ``datasets``
    that was written through ``lake``; other years are not opened."""
    logs = [lake.partition_log(layer, name, lake.written[layer, name])
            for layer in SETTINGS.layers for name in datasets if lake.written.get((layer, name))]
    if not logs:
        return lake.spark.createDataFrame([], "layer string, dataset_name string, year int, path string, row_count long, file_count long")
    return reduce(DataFrame.unionByName, logs)
