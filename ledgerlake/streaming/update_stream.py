"""A landing folder as a stream through all three layers.

Each micro-batch goes raw -> detail -> summary like a batch run.  A ledger in
the stream's checkpoint folder holds the steps that a micro-batch has finished,
with the years it touched.  When a run dies between two layers, Spark replays
the micro-batch, and the replay goes on behind the last finished step: raw and
detail are not merged again, and the summary is rebuilt for the years that the
ledger names.  A step that died half-way runs again from its start; the upserts
are idempotent.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.lakehouse import process_table, rebuild_summary
from ..session import checkpoint_root, read_or_none, scratch_path
from ..sources.lake import Lake
from ..specs import spec as get_spec

_ROW = "batch_id long, step string, years array<int>"


class Ledger:
    """Finished steps of a stream's micro-batches, one small file a step."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def steps(self, batch_id: int) -> dict[str, list[int]]:
        """step -> years, for one micro-batch."""
        rows = read_or_none(lambda: self.spark.read.schema(_ROW).json(self.path))
        if rows is None:
            return {}
        return {r["step"]: list(r["years"] or []) for r in rows.where(F.col("batch_id") == batch_id).collect()}

    def of(self, batch_id: int) -> "BatchLedger":
        return BatchLedger(self, batch_id)


class BatchLedger:
    """The steps of one micro-batch, read once."""

    def __init__(self, ledger: Ledger, batch_id: int):
        self._ledger, self._batch = ledger, batch_id
        self._steps = ledger.steps(batch_id)

    def years(self, step: str) -> list[int] | None:
        """Years that a finished step touched, ``None`` when it has not finished."""
        return self._steps.get(step)

    def finish(self, step: str, years) -> None:
        spark = self._ledger.spark
        held = F.array(*[F.lit(int(y)) for y in sorted(years)]).cast("array<int>")
        (spark.range(1, numPartitions=1)
              .select(F.lit(self._batch).cast("long").alias("batch_id"), F.lit(step).alias("step"), held.alias("years"))
              .write.mode("append").json(self._ledger.path))
        self._steps[step] = sorted(years)


def update_stream(spark: SparkSession, landing_dir: str, schema: T.StructType | str, lake_root: str, table_name: str,
                  fallback_date="20150101", order_first=(), fmt: str = "parquet", checkpoint: str | None = None,
                  available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that takes the new files of ``landing_dir`` as
    ``table_name`` through the raw and detail layers and rebuilds the summary
    product that the table feeds, for the years touched.

    ``order_first`` ranks a key's rows before their batch does, so micro-batch
    boundaries pick no survivors where it tells them apart.  ``checkpoint``
    (default: a new folder in the shared one) holds which files were read and
    the ledger; pass it again to go on after a stop.
    """
    home = (checkpoint or scratch_path(spark, f"update-{table_name}")).rstrip("/")
    ledger = Ledger(spark, f"{home}/ledger")
    product = get_spec(table_name).dws_dataset

    def spread(batch: DataFrame) -> DataFrame:
        # a micro-batch may be one file, which one task reads: its rows go to
        # all cores before they are profiled and staged (by hash of the row,
        # so that the reading task need not sort them)
        columns = [f.name for f in batch.schema.fields if isinstance(f.dataType, T.AtomicType)]
        return batch.repartition(max(spark.sparkContext.defaultParallelism, batch.rdd.getNumPartitions()), *columns)

    def run(batch: DataFrame, batch_id: int) -> None:
        steps = ledger.of(batch_id)
        if steps.years("summary") is not None:
            return
        lake = Lake(spark, lake_root)
        years = steps.years("detail")
        if years is None:
            years = process_table(lake, table_name, spread(batch), fallback_date, order_first, ledger=steps, order_batches=True)
        if product is not None:
            rebuild_summary(lake, years, products=(product,))
        steps.finish("summary", years)

    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    writer = reader.load(landing_dir).writeStream.foreachBatch(run).option("checkpointLocation", home)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def drain(spark: SparkSession, landing: dict[str, tuple[str, T.StructType | str]], lake_root: str, checkpoints: str, **options) -> None:
    """Bring a lake up to date with several landing folders (table -> (folder,
    schema)): each one's waiting files, table by table; tables of different
    summary products, which share no dataset, side by side.  ``checkpoints`` is
    the folder of the streams' checkpoints, the same for every call."""
    lanes: dict[str | None, list[str]] = {}
    for table_name in landing:
        lanes.setdefault(get_spec(table_name).dws_dataset, []).append(table_name)

    def take(tables: list[str]) -> None:
        for table_name in tables:
            folder, schema = landing[table_name]
            update_stream(spark, folder, schema, lake_root, table_name, checkpoint=f"{checkpoints.rstrip('/')}/{table_name}", **options).awaitTermination()

    checkpoint_root(spark)             # resolve the shared folder before the threads start
    with ThreadPoolExecutor(max_workers=max(1, len(lanes))) as pool:
        for lane in [pool.submit(take, tables) for tables in lanes.values()]:
            lane.result()
