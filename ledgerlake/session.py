"""Session helpers: building a local session for tests and bench, and locating
the shared folder used to cut lineage and stage lake writes."""

from __future__ import annotations

import logging
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library expects.  The cluster may set them
# too; builder settings only apply to sessions we create ourselves.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "ledgerlake",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Create (or get) a session.  Used by tests and bench; a cluster job
    passes its own session to the library functions instead."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "16g"))
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and staged writes.

    Reads ``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) from
    the session.  When neither is set, a local master gets a private folder
    and any other master raises: executors would each write to their own disk.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            root = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{kind}-{uuid.uuid4().hex[:12]}"


#: What a read of a path that was never written raises, and who logs it.
_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
_LOGGERS = ("SQLQueryContextLogger", "DataFrameQueryContextLogger")


def read_or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame that ``read`` gives, ``None`` where its path is not there.
    That is an answer and no error, so it is kept out of the log."""
    loggers = [logging.getLogger(name) for name in _LOGGERS]
    levels = [logger.level for logger in loggers]
    for logger in loggers:
        logger.setLevel(logging.CRITICAL + 1)
    try:
        return read()
    except AnalysisException as exc:
        if exc.getCondition() not in _MISSING:
            raise
        return None
    finally:
        for logger, level in zip(loggers, levels):
            logger.setLevel(level)
