"""The streaming upsert (file source -> foreachBatch) gives the batch result."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.clean import clean_table
from ledgerlake.plans import fixtures as fx
from ledgerlake.session import scratch_path
from ledgerlake.streaming import upsert_stream
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("pinned", [["close"], None])
def test_stream_upsert_equals_batch_upsert(spark, lake, pinned):
    bars = fx.bars_raw(spark, SF_SMALL)
    landing = scratch_path(spark, "landing")
    ckpt = scratch_path(spark, "stream-ckpt")
    bars.where(F.col("event_id") % 2 == 0).write.parquet(landing)
    q = upsert_stream(spark, landing, bars.schema, lake.root, "daily", numeric_columns=pinned,
                      order_first=["event_id"], checkpoint=ckpt)
    q.awaitTermination(300)
    bars.where(F.col("event_id") % 2 == 1).write.mode("append").parquet(landing)
    q = upsert_stream(spark, landing, bars.schema, lake.root, "daily", numeric_columns=pinned,
                      order_first=["event_id"], checkpoint=ckpt)   # resumes: only the new files
    q.awaitTermination(300)
    streamed = sorted(tuple(r) for r in lake.scan("dwd", "daily").select("ts_code", "trade_date", "close").collect())
    batch = clean_table("daily", bars, numeric_columns=["close"], order_first=["event_id"]).frame
    expected = sorted(tuple(r) for r in batch.select("ts_code", "trade_date", "close").collect())
    assert streamed == expected


def test_stream_drains_a_backlog_in_bounded_micro_batches(spark, lake):
    bars = fx.bars_raw(spark, SF_SMALL)
    landing = scratch_path(spark, "landing")
    # a backlog of four files that share keys
    bars.repartition(4).write.parquet(landing)
    q = upsert_stream(spark, landing, bars.schema, lake.root, "daily", numeric_columns=["close"],
                      order_first=["event_id"], max_files_per_trigger=1)
    q.awaitTermination(300)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 2
    streamed = sorted(tuple(r) for r in lake.scan("dwd", "daily").select("ts_code", "trade_date", "close").collect())
    batch = clean_table("daily", bars, numeric_columns=["close"], order_first=["event_id"]).frame
    assert streamed == sorted(tuple(r) for r in batch.select("ts_code", "trade_date", "close").collect())
