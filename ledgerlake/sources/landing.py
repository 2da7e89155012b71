"""Landing folders read once: which files a folder has brought since the last
finished run.

The files that finished runs have read are kept as a table (path, modified)
beside the lake, one append per run.  A run lists the folder (names and times
only), takes the files that the table does not hold, and reads those alone.  A
file that is written anew under its old name counts as new.  Nothing is marked
until ``commit``, so a run that dies reads its files again; the upserts behind
it are idempotent.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date_multi
from ..session import read_or_none


class LandingFolder:
    """Files of ``path`` that no finished run has read.

    ``schema`` is that of the landing files; ``state`` the folder of the table
    of files read (one per landing folder, in a place that all runs share)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, state: str, fmt: str = "parquet"):
        self.spark, self.path, self.schema, self.state, self.fmt = spark, path, schema, state, fmt
        self._new: list[tuple] | None = None

    def _listing(self) -> DataFrame:
        """(path, modified) of the landing files: a listing, no file is opened."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .load(self.path).select("path", F.col("modificationTime").alias("modified")))
        return files.where(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))

    def _seen(self) -> DataFrame | None:
        return read_or_none(lambda: self.spark.read.schema("path string, modified timestamp").parquet(self.state))

    def new_files(self) -> list[str]:
        """Paths of the files to read: as many as have arrived since."""
        if self._new is None:
            listed, seen = self._listing(), self._seen()
            fresh = listed if seen is None else listed.join(seen, ["path", "modified"], "left_anti")
            self._new = [(r["path"], r["modified"]) for r in fresh.collect()]
        return [p for p, _ in self._new]

    def rows(self) -> DataFrame:
        """The rows of the new files, no row where there are none."""
        files = self.new_files()
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).format(self.fmt).load(files)

    def commit(self, date_col: str | None = None, upto=None) -> int:
        """Mark the files of ``rows`` as read; returns how many.  With a date
        column and a last day, a file that holds later rows stays new: the run
        whose window takes those days reads it again."""
        done = self._new or []
        if done and date_col is not None and upto is not None:
            rows = self.rows()
            day = parse_date_multi(F.col(date_col), rows.schema[date_col].dataType)
            later = rows.where(day > F.lit(upto)).select(F.col("_metadata.file_path").alias("f")).distinct()
            names = {_name(r["f"]) for r in later.collect()}
            done = [(p, m) for p, m in done if _name(p) not in names]
        if done:
            (self.spark.createDataFrame(done, "path string, modified timestamp").coalesce(1)
                 .write.mode("append").parquet(self.state))
        self._new = None
        return len(done)


def _name(path: str) -> str:
    """A path without the scheme that Spark's sources spell in two ways."""
    return unquote(path.split(":", 1)[-1].lstrip("/"))
