"""What the flows over the lake must not do as tables grow: work in one task,
copy a batch twice, write one layer after the other."""

import datetime as dt
import threading

from pyspark.sql import functions as F

from ledgerlake.functions.dates import parse_date_multi, parse_date_two, strip_ws
from ledgerlake.plans import lakehouse
from ledgerlake.plans.lakehouse import process_table
from ledgerlake.session import scratch_path
from ledgerlake.sources.lake import Lake
from ledgerlake.streaming import update_stream as streams

BARS = "ts_code string, trade_date string, close string"


def bars(spark, n, first=0):
    return spark.range(first, first + n).select(
        F.format_string("S%05d", "id").alias("ts_code"), F.when(F.col("id") % 2 == 0, "20240102").otherwise("2023-01-03").alias("trade_date"),
        F.format_string("%.2f", F.col("id") / 4).alias("close"))


def test_rows_of_one_landing_file_are_spread_over_tasks(spark, monkeypatch):
    home, seen = scratch_path(spark, "one-file"), []
    bars(spark, 2000).coalesce(1).write.parquet(f"{home}/in")

    def spied(lake, name, batch, *rest, **options):
        seen.append([r["n"] for r in batch.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()])
        return process_table(lake, name, batch, *rest, **options)

    monkeypatch.setattr(streams, "process_table", spied)
    streams.drain(spark, {"daily": (f"{home}/in", BARS)}, f"{home}/lake", f"{home}/checkpoints", max_files_per_trigger=1)
    assert len(seen) == 1 and sum(seen[0]) == 2000
    assert len(seen[0]) == spark.sparkContext.defaultParallelism
    assert Lake(spark, f"{home}/lake").scan("dwd", "daily").count() == 2000


def test_products_are_drained_side_by_side(spark, monkeypatch):
    met = threading.Barrier(2, timeout=60)

    class Waited:
        def awaitTermination(self):
            met.wait()

    monkeypatch.setattr(streams, "update_stream", lambda *args, **options: Waited())
    streams.drain(spark, {"income": ("a", BARS), "daily": ("b", BARS)}, "lake", "checkpoints")


def test_a_batch_is_copied_once_for_each_layer_that_needs_it(spark, monkeypatch):
    lake, kinds, stage = Lake(spark, scratch_path(spark, "lake")), [], Lake.stage
    process_table(lake, "daily", bars(spark, 40), "20150101")
    monkeypatch.setattr(Lake, "stage", lambda self, df, kind="stage": (kinds.append(kind), stage(self, df, kind))[1])
    assert process_table(lake, "daily", bars(spark, 40, 20), "20150101") == [2023, 2024]
    assert sorted(kinds) == ["batch", "landing-daily"]
    assert lake.years("ods", "daily") == [2023, 2024]
    assert lake.scan("ods", "daily").count() == lake.scan("dwd", "daily").count() == 60


def test_raw_and_detail_are_written_side_by_side(spark, monkeypatch):
    met = threading.Barrier(2, timeout=60)
    real = {name: getattr(lakehouse, name) for name in ("write_raw", "persist_detail")}

    def waiting(name):
        def call(*args, **options):
            met.wait()
            return real[name](*args, **options)
        return call

    for name in real:
        monkeypatch.setattr(lakehouse, name, waiting(name))
    lake = Lake(spark, scratch_path(spark, "lake"))
    assert process_table(lake, "daily", bars(spark, 10), "20150101") == [2023, 2024]
    assert lake.scan("ods", "daily").count() == 10


def test_dates_by_their_separator(spark):
    texts = ["20240102", "2024-1-2", "2024/01/02", " 20240102 ", "\t2024-01-02\n", "2024-01/02", "20250230", "2025-02-30", "-", "/", "", "None", None,
             "-0010101", "\x8520240102", "20240102 ", " x  "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_replace("t", r"^\s+|\s+$", "")
    forms = [F.try_to_date(plain, f) for f in ("yyyyMMdd", "yyyy-M-d", "yyyy/M/d")]
    rows = df.select("t", strip_ws("t").alias("s"), plain.alias("s0"), parse_date_multi("t").alias("m"), F.coalesce(*forms).alias("m0"), parse_date_two("t").alias("w"),
                     F.coalesce(F.try_to_date("t", "yyyyMMdd"), F.try_to_date("t", "yyyy-M-d")).alias("w0")).collect()
    for r in rows:
        assert (r.s, r.m, r.w) == (r.s0, r.m0, r.w0), r.t
    assert rows[1].m == rows[4].m == dt.date(2024, 1, 2)
