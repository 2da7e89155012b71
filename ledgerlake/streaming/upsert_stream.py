"""Late and corrected data as a stream: landing files arrive in a folder;
each micro-batch is cleaned and merged into the lake with the same upsert
as the batch path (idempotent, so a replayed micro-batch changes nothing)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_table
from ..plans.lakehouse import stored_types
from ..session import scratch_path
from ..sources.lake import Lake
from ..specs import spec as get_spec


def upsert_stream(spark: SparkSession, landing_dir: str, schema: T.StructType, lake_root: str,
                  table_name: str, numeric_columns=None, order_first=(), fmt: str = "parquet",
                  checkpoint: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream over ``landing_dir`` that cleans every micro-batch as
    ``table_name`` and upserts it into ``dwd/<table_name>``.

    ``numeric_columns`` pins the typing of the dataset; without it the
    stored dataset's schema does (only columns it lacks are profiled), so
    micro-batches never flip a column type.  The stream checkpoint lives in
    the shared folder.  ``order_first`` ranks a key's rows before their batch
    does, so micro-batch boundaries pick no survivors where it tells them
    apart.  ``max_files_per_trigger`` caps the files of one
    micro-batch (``availableNow`` still drains the whole backlog).
    """
    sp = get_spec(table_name)
    lake = Lake(spark, lake_root)

    def merge(batch: DataFrame, batch_id: int) -> None:
        known = stored_types(lake, table_name) if numeric_columns is None else None
        cleaned = clean_table(table_name, batch, numeric_columns=numeric_columns,
                              order_first=order_first, known_types=known, keep_spelling=True).stored
        lake.upsert("dwd", table_name, cleaned, sp.primary_key, sp.dwd_partition_column,
                    order_first=[c for c in order_first if not isinstance(c, str) or c in cleaned.columns])

    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        # bounds each micro-batch; a backlog is drained in several batches
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.load(landing_dir)
    writer = (stream.writeStream.foreachBatch(merge)
              .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{table_name}")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
