"""No batch may lose a stored row or value, whatever its types or path."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans.lakehouse import process_table
from ledgerlake.session import checkpoint_root, scratch_path
from ledgerlake.sources.lake import Lake

D = dt.date
KEY = ["ts_code", "trade_date"]


def suspensions(spark, *rows):
    return spark.createDataFrame(list(rows), "ts_code string, trade_date string, suspend_timing string")


def test_text_after_an_empty_column_is_kept(spark, lake):
    process_table(lake, "suspend_d", suspensions(spark, ("A", "20240102", None)), "20200101")
    process_table(lake, "suspend_d", suspensions(spark, ("A", "20240103", "13:00-15:00"), ("B", "20250103", "09:30-10:00")), "20200101")
    got = {(r.ts_code, r.trade_date): r.suspend_timing for r in lake.scan("dwd", "suspend_d").collect()}
    assert got == {("A", D(2024, 1, 2)): None, ("A", D(2024, 1, 3)): "13:00-15:00", ("B", D(2025, 1, 3)): "09:30-10:00"}


def test_a_wider_type_widens_every_year(spark, lake):
    a = spark.createDataFrame([("A", D(2024, 1, 2), 1), ("A", D(2025, 1, 2), 2)], "ts_code string, trade_date date, v int")
    lake.upsert("dwd", "daily", a, KEY, "trade_date")
    b = spark.createDataFrame([("B", D(2025, 1, 2), "x")], "ts_code string, trade_date date, v string")
    lake.upsert("dwd", "daily", b, KEY, "trade_date")
    c = spark.createDataFrame([("C", D(2024, 1, 2), 2**40)], "ts_code string, trade_date date, v long")
    lake.upsert("dwd", "daily", c, KEY, "trade_date")
    got = sorted((r.ts_code, r.year, r.v) for r in lake.scan("dwd", "daily").collect())
    assert got == [("A", 2024, "1"), ("A", 2025, "2"), ("B", 2025, "x"), ("C", 2024, str(2**40))]


def test_an_overwritten_year_widens_the_others(spark, lake):
    lake.write_years("dws", "daily_master", spark.createDataFrame([("A", D(2023, 1, 2), 1), ("A", D(2024, 1, 2), 2)], "ts_code string, trade_date date, v int"), "trade_date")
    lake.write_years("dws", "daily_master", spark.createDataFrame([("A", D(2024, 1, 2), 2.5)], "ts_code string, trade_date date, v double"), "trade_date")
    assert sorted((r.year, r.v) for r in lake.scan("dws", "daily_master").collect()) == [(2023, 1.0), (2024, 2.5)]


def test_one_answer_for_any_size_of_batch(spark, lake):
    twice = spark.createDataFrame([("A", D(2024, 1, 2), 1.0), ("A", D(2024, 1, 2), None)], "ts_code string, trade_date date, v double")
    lake.write_years("dwd", "daily", twice, "trade_date")
    lake.upsert("dwd", "daily", spark.createDataFrame([("B", D(2024, 1, 2), 3.0)], "ts_code string, trade_date date, v double"), KEY, "trade_date")
    assert sorted((r.ts_code, r.v) for r in lake.scan("dwd", "daily").collect()) == [("A", 1.0), ("B", 3.0)]


def test_a_path_that_only_spark_reads(spark):
    root = scratch_path(spark, "mounted")
    spark.range(1).write.parquet(f"{root}/made")
    name = "lossless"
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set(f"fs.viewfs.mounttable.{name}.link./lake", root if "://" in root or root.startswith("file:") else f"file://{root}")
    lake = Lake(spark, f"viewfs://{name}/lake")
    for symbol in "AB":
        row = spark.createDataFrame([(symbol, D(2024, 1, 2), 1.0)], "ts_code string, trade_date date, v double")
        lake.upsert("dwd", "daily", row, KEY, "trade_date")
    assert sorted(r.ts_code for r in lake.scan("dwd", "daily").collect()) == ["A", "B"]
    assert lake.scan("dwd", "income") is None


def test_files_of_a_year_do_not_overlap(spark, lake):
    rows = spark.range(4000).selectExpr("concat('S', lpad(cast(id * 7919 % 4000 as string), 4, '0')) AS ts_code", "date'2024-03-01' AS trade_date", "id AS v")
    lake.write_years("dwd", "daily", rows.repartition(9), "trade_date", sort_cols=KEY)
    held = lake.scan("dwd", "daily").select(F.input_file_name().alias("f"), "ts_code")
    spans = sorted((r.a, r.z) for r in held.groupBy("f").agg(F.min("ts_code").alias("a"), F.max("ts_code").alias("z")).collect())
    assert spans and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_reads_open_no_file_of_other_years(spark, lake):
    rows = spark.createDataFrame([("A", D(y, 1, 2), float(y)) for y in (1995, 1996, 1997)], "ts_code string, trade_date date, v double")
    lake.write_years("dwd", "daily", rows, "trade_date")
    # a file that is no Parquet: opening its footer would raise
    path = lake.path("dwd", "daily")
    spark.range(1).selectExpr("'broken' AS value").write.mode("overwrite").text(f"{path}/year=1995")
    assert [r.v for r in lake.read_year("dwd", "daily", 1997).collect()] == [1997.0]
    assert [r.v for r in lake.read_years("dwd", "daily", [1996, 2050]).collect()] == [1996.0]
    assert lake.read_year("dwd", "daily", 2050).collect() == []
    lake.upsert("dwd", "daily", spark.createDataFrame([("B", D(1997, 1, 2), 1.0, "n")], "ts_code string, trade_date date, v double, note string"), KEY, "trade_date")
    got = sorted((r.ts_code, r.v, r.note) for r in lake.read_year("dwd", "daily", 1997).collect())
    assert got == [("A", 1997.0, None), ("B", 1.0, "n")]


def test_a_schema_change_that_did_not_finish_is_read_from_the_files(spark, lake):
    lake.write_years("dwd", "daily", spark.createDataFrame([("A", D(2024, 1, 2), 1)], "ts_code string, trade_date date, v int"), "trade_date")
    lake._note("dwd", "daily", 99, None)
    assert [r.v for r in lake.scan("dwd", "daily").collect()] == [1]
    lake.upsert("dwd", "daily", spark.createDataFrame([("B", D(2024, 1, 2), "x")], "ts_code string, trade_date date, v string"), KEY, "trade_date")
    assert lake._noted("dwd", "daily")[0] == 101
    assert sorted(r.v for r in lake.scan("dwd", "daily").collect()) == ["1", "x"]


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
