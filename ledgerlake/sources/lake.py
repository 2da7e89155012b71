"""Year-partitioned Parquet lake: ``<root>/<layer>/<dataset>/year=YYYY/``.

Reads take a dataset's schema and years from the notes in ``<root>/schemas/``
(one small read for the whole lake) and list only the directories they need;
writes overwrite only the years present in the written frame (dynamic partition
overwrite), with bounded file size and zstd.  An upsert merges a batch with the
stored rows of the years it touches and keeps one survivor per key; Spark's
dynamic overwrite replaces partitions at commit, after every task has read its
input.

One writer per dataset at a time: two upserts of one dataset would each merge
with what the other has not seen.  Different datasets may be written at once.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.dedup import require_columns, survivorship_dedup
from ..operators.union import aligned_types, union_aligned
from ..session import read_or_none, scratch_path
from ..specs import SETTINGS, SPELLING

YEAR = SETTINGS.partition_column

_NOTE = "version long, schema string, years array<int>"


class Lake:
    def __init__(self, spark: SparkSession, root: str, max_rows_per_file: int = SETTINGS.max_rows_per_file):
        self.spark = spark
        self.max_rows_per_file = max_rows_per_file
        # (layer, dataset) -> years written through this object
        self.written: dict[tuple[str, str], set[int]] = {}
        # (layer, dataset) -> years rewritten because a column's type widened
        self.widened: dict[tuple[str, str], set[int]] = {}
        self.root = root.rstrip("/")
        # (layer, dataset) -> rows an upsert did not write for lack of a
        # partition year; observed during the writes themselves
        self.rows_without_year: dict[tuple[str, str], int] = {}
        self._notes: dict[tuple[str, str], tuple] | None = None
        self._unnoted = False            # a lake with data but without notes (written before there were any)
        self._lock = threading.RLock()

    def _count_null_years(self, layer: str, dataset: str, obs: Observation) -> None:
        n = int((obs.get or {}).get("rows_without_year") or 0)
        key = (layer, dataset)
        self.rows_without_year[key] = self.rows_without_year.get(key, 0) + n

    def null_year_report(self) -> DataFrame:
        """(layer, dataset_name, rows_without_year) for every upserted
        dataset: one row per dataset, from counts kept by the writes."""
        rows = [(l, d, n) for (l, d), n in sorted(self.rows_without_year.items())]
        return self.spark.createDataFrame(rows, "layer string, dataset_name string, rows_without_year long")

    # ---- paths and reads -------------------------------------------------
    def path(self, layer: str, dataset: str) -> str:
        if layer not in SETTINGS.layers:
            raise KeyError(f"no layer {layer!r}; the layers are {SETTINGS.layers}")
        return f"{self.root}/{layer}/{dataset}"

    def scan(self, layer: str, dataset: str, schema: T.StructType | None = None,
             merge_schema: bool = True, refresh: bool = True, spelling: bool = False) -> DataFrame | None:
        """All years of a dataset (``year`` exposed as an int column), by the
        schema noted beside the data, so planning opens no file.  A dataset
        never written gives ``None`` -- or an empty frame of ``schema`` when
        one is given.  ``refresh`` reads the notes anew (changes by other
        writers); ``spelling`` keeps the helper column of stored spellings."""
        path = self.path(layer, dataset)
        version, noted, _ = self._noted(layer, dataset, refresh)
        out = None
        if version or self._unnoted:
            reader = self.spark.read.schema(schema) if schema is not None else self._reader(noted, merge_schema)
            out = read_or_none(lambda: reader.parquet(path))
        if out is None:
            return None if schema is None else self.spark.createDataFrame([], schema)
        return out if spelling else out.drop(SPELLING)

    def _reader(self, noted: T.StructType | None, merge_schema: bool = True):
        if noted is not None:
            return self.spark.read.schema(noted)
        # no schema noted (an older lake, or a write that did not finish): the
        # union of the file schemas, which writes keep free of conflicts
        return self.spark.read.option("mergeSchema", str(merge_schema).lower())

    def read_year(self, layer: str, dataset: str, year: int, refresh: bool = True) -> DataFrame | None:
        """One year: only its directory is listed and read."""
        return self.read_years(layer, dataset, [year], refresh)

    def read_years(self, layer: str, dataset: str, years, refresh: bool = True, spelling: bool = False) -> DataFrame | None:
        """The given years, those never written giving no rows: only their
        directories are listed.  A dataset never written gives ``None``."""
        years = sorted({int(y) for y in years})
        _, noted, held = self._noted(layer, dataset, refresh)
        if noted is None:
            df = self.scan(layer, dataset, refresh=False, spelling=spelling)
            return None if df is None else df.where(F.col(YEAR).isin(years))
        path = self.path(layer, dataset)

        def read(some) -> DataFrame:
            return self._reader(noted).option("basePath", path).parquet(*[f"{path}/{YEAR}={y}" for y in some])

        if held is None:                 # a note without years
            some = [y for y in years if read_or_none(lambda: read([y])) is not None]
        else:
            some = [y for y in years if y in held]
        df = read(some) if some else self.spark.createDataFrame([], noted)
        df = df.where(F.col(YEAR).isin(years))
        return df if spelling else df.drop(SPELLING)

    def years(self, layer: str, dataset: str, refresh: bool = True) -> list[int]:
        """The years stored, from the notes (from the data where they are
        not noted)."""
        _, _, held = self._noted(layer, dataset, refresh)
        if held is not None:
            return sorted(held)
        df = self.scan(layer, dataset, merge_schema=False, refresh=False)
        return [] if df is None else sorted(r[0] for r in df.select(YEAR).distinct().collect())

    def stored_schema(self, layer: str, dataset: str, refresh: bool = True) -> T.StructType | None:
        """The schema of a stored dataset, spelling column included; ``None``
        when it was never written.  No data directory is listed where the
        schema is noted."""
        version, noted, _ = self._noted(layer, dataset, refresh)
        if noted is not None or not (version or self._unnoted):
            return noted
        df = self.scan(layer, dataset, refresh=False, spelling=True)
        return None if df is None else df.schema

    # ---- notes beside the data -------------------------------------------
    def _noted(self, layer: str, dataset: str, refresh: bool = False) -> tuple[int, T.StructType | None, set[int] | None]:
        """(version, schema, years) last noted for a dataset, version 0 when
        it has no note.  A version without a schema marks a write under way."""
        with self._lock:
            if self._notes is None or refresh:
                self._load_notes()
            return self._notes.get((layer, dataset), (0, None, None))

    def _load_notes(self) -> None:
        path = f"{self.root}/schemas"
        notes = read_or_none(lambda: self.spark.read.schema(_NOTE).option("recursiveFileLookup", "true").json(path))
        if notes is None:
            if self._notes is None:
                self._unnoted = read_or_none(lambda: self.spark.read.format("binaryFile").load(self.root)) is not None
            self._notes = {}
            return
        where = F.regexp_extract("_metadata.file_path", "/schemas/([^/]+)/([^/]+)/[^/]+$", 1), F.regexp_extract("_metadata.file_path", "/schemas/([^/]+)/([^/]+)/[^/]+$", 2)
        last = (notes.groupBy(where[0].alias("layer"), where[1].alias("dataset"))
                .agg(F.max("version").alias("version"), F.max_by(F.struct("schema", "years"), "version").alias("note")))
        # one row per dataset
        self._notes = {(r["layer"], r["dataset"]): (
            r["version"] or 0,
            T.StructType.fromJson(json.loads(r["note"]["schema"])) if r["note"] and r["note"]["schema"] else None,
            set(r["note"]["years"]) if r["note"] and r["note"]["schema"] and r["note"]["years"] is not None else None) for r in last.collect()}

    def _note(self, layer: str, dataset: str, version: int, schema: T.StructType | None, years=None) -> None:
        text = F.lit(None if schema is None else schema.json()).cast("string")
        held = F.lit(None) if years is None else F.array(*[F.lit(int(y)) for y in sorted(years)])
        (self.spark.range(1, numPartitions=1)
             .select(F.lit(version).cast("long").alias("version"), text.alias("schema"), held.cast("array<int>").alias("years"))
             .write.mode("append").json(f"{self.root}/schemas/{layer}/{dataset}"))
        with self._lock:
            self._notes[(layer, dataset)] = (version, schema, None if years is None else set(years))

    # ---- writes -----------------------------------------------------------
    def write_years(self, layer: str, dataset: str, df: DataFrame, date_col: str | None = None,
                    sort_cols=(), within=None) -> list[int]:
        """Overwrite the years present in ``df`` (other years untouched).

        ``year`` comes from ``date_col`` unless the frame has it already;
        rows without a year are not written.  Rows are dealt out by ranges of
        year and ``sort_cols`` and sorted, so a year's files do not overlap
        and their statistics prune later key lookups.  Where a column's type
        differs from the stored one, the years that stay are rewritten with
        the common type as well (text wins).  ``within`` names the years that
        the frame stands for: those without a row are emptied.  Returns the
        years written (bounded list).
        """
        out = df
        if YEAR not in out.columns:
            if date_col is None:
                raise KeyError("a date column or a year column is required")
            require_columns(out, [date_col], "partition date")
            out = out.withColumn(YEAR, F.year(date_col))
        out = out.withColumn(YEAR, F.col(YEAR).cast("int")).where(F.col(YEAR).isNotNull())
        stored = self.stored_schema(layer, dataset)
        if stored is not None and _conflicts(stored, out.schema):
            own = set(within or ()) | {r[0] for r in out.select(YEAR).distinct().collect()}
            rest = self.scan(layer, dataset, refresh=False, spelling=True).where(~F.col(YEAR).isin(sorted(own)))
            out = self.stage(union_aligned([out, _spelled(rest)]), "widened")
            self._mark_widened(layer, dataset)
        written = self._overwrite(layer, dataset, out, stored, sort_cols, within)
        if within is not None:
            self._empty(layer, dataset, {int(y) for y in within} - set(written))
        return written

    def _mark_widened(self, layer: str, dataset: str) -> None:
        self.widened.setdefault((layer, dataset), set()).update(self.years(layer, dataset, refresh=False))

    def _overwrite(self, layer: str, dataset: str, out: DataFrame, stored: T.StructType | None, sort_cols=(), within=None) -> list[int]:
        # a change of schema or years is marked before the write and noted
        # after it: a write that dies in between leaves reads by the files
        types = aligned_types([schema for schema in (stored, out.schema) if schema is not None])
        types.pop(YEAR)
        target = T.StructType([T.StructField(c, t) for c, t in types.items()] + [T.StructField(YEAR, T.IntegerType())])
        version, noted, held = self._noted(layer, dataset)
        known = noted is not None and _types(noted) == _types(target) and held is not None and within is not None and {int(y) for y in within} <= held
        if not known:
            self._note(layer, dataset, version + 1, None)
        # the years written are observed during the write itself (no pre-pass)
        obs = Observation(f"years-{dataset}-{uuid.uuid4().hex[:8]}")
        order = [YEAR, *[c for c in sort_cols if c in out.columns]]
        out = out.repartitionByRange(*order).observe(obs, F.collect_set(YEAR).alias("years"))
        # symbols are looked up over all years: a row group without one is
        # skipped by its Bloom filter where the sort order does not tell
        blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in SETTINGS.lookup_columns if c in out.columns}
        (out.sortWithinPartitions(*order)
            .write.mode("overwrite").options(**blooms)
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", self.max_rows_per_file)
            .option("compression", SETTINGS.parquet_compression)
            .partitionBy(YEAR)
            .parquet(self.path(layer, dataset)))
        years = sorted(obs.get.get("years") or [])
        self.written.setdefault((layer, dataset), set()).update(years)
        if not known and (years or stored is not None):
            # where the years before are not known, they are read from the data once
            before = held if held is not None else () if stored is None else self.years(layer, dataset, refresh=False)
            self._note(layer, dataset, version + 2, target, {*before, *years})
        return years

    def _empty(self, layer: str, dataset: str, years) -> None:
        """Years that have lost all their rows become empty."""
        version, noted, held = self._noted(layer, dataset)
        for year in sorted(set(years) & (held or set())):
            none = self.spark.createDataFrame([], T.StructType([f for f in noted.fields if f.name != YEAR]))
            none.write.mode("overwrite").parquet(f"{self.path(layer, dataset)}/{YEAR}={year}")

    def stage(self, df: DataFrame, kind: str = "stage") -> DataFrame:
        """Materialise a frame in the shared checkpoint folder and read it
        back: cuts lineage and decouples reads from a later overwrite."""
        path = scratch_path(self.spark, kind)
        df.write.mode("overwrite").option("compression", SETTINGS.parquet_compression).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def upsert(self, layer: str, dataset: str, batch: DataFrame, key, date_col: str,
               order_first=(), drop_date: bool = False, across_years: bool = False, stage: bool = True) -> list[int]:
        """Merge ``batch`` into the years it touches.

        New rows are tagged batch 1, stored rows batch 0; the survivorship
        rule ranks update flag, then completeness, then ``order_first``, then
        newer batch, then a total order over all rows of the touched years.
        Where ``order_first`` tells a key's rows apart, any cut of the same
        rows into batches gives the same table.  Only touched years
        are read and rewritten, unless a column's type has to widen: then the
        other years are rewritten with the common type, their rows as they
        are, numbers that become text spelled as they came where the frames
        carry ``SPELLING``.  A missing partition column is an error; rows with
        a null partition year are not written.  ``drop_date`` removes a helper
        partition-date column before storing.

        ``across_years``: a key has one row over all years.  A batch row whose
        key is stored under another year (its partition date has changed)
        meets that row in the merge, and the year that loses the key is
        rewritten without it.  The years are found by a semi join of the
        batch's keys with the key columns of the other years (no other column
        is read, and nothing is kept beside the data that a lost write could
        leave behind).

        ``stage`` False: the batch comes from staged rows by cheap steps, so its
        years are taken from its date column alone and it is not copied again.

        Returns the years of the batch, with those that may have lost a row.
        The years are replaced when the write commits, after every task has
        read them, so the merge needs no second copy.
        """
        key = list(key)
        require_columns(batch, [date_col], "partition date")
        require_columns(batch, key)
        new = (batch.drop(YEAR) if YEAR in batch.columns else batch)
        nulls = Observation(f"null-years-{dataset}-{uuid.uuid4().hex[:8]}")
        obs = Observation(f"batch-years-{dataset}-{uuid.uuid4().hex[:8]}")
        new = (new.withColumn(YEAR, F.year(date_col).cast("int"))
                  .observe(nulls, F.count(F.when(F.col(YEAR).isNull(), 1)).alias("rows_without_year"))
                  .where(F.col(YEAR).isNotNull()))
        if drop_date:
            new = new.drop(date_col)
        stored = self.stored_schema(layer, dataset)
        if stored is None:
            # first write of the dataset: nothing to merge, the target is not
            # read, so the survivors are written straight (years observed)
            survivors = survivorship_dedup(new.withColumn("__batch", F.lit(1)), key,
                                           order_first=[*order_first, "__batch"],
                                           score_exclude=[YEAR, "__batch"]).drop("__batch")
            written = self._overwrite(layer, dataset, survivors, None, sort_cols=key)
            self._count_null_years(layer, dataset, nulls)
            return written
        held = F.collect_set(YEAR).alias("years")
        if stage:
            # the batch is computed once and staged; its years are observed
            # while it is written (a bounded set, no extra pass)
            new = self.stage(new.observe(obs, held), "batch")
            years = sorted(obs.get.get("years") or [])
        else:
            years = sorted(new.agg(held).first()["years"])
        self._count_null_years(layer, dataset, nulls)
        if not years:
            return []
        touched = years
        if across_years:
            touched = sorted({*years, *self._years_of_keys(layer, dataset, new, key, years)})
        existing = self.read_years(layer, dataset, touched, refresh=False, spelling=True)
        widens = _conflicts(stored, new.schema)
        if widens:
            existing = _spelled(existing)
        merged = union_aligned([new.withColumn("__batch", F.lit(1)), existing.withColumn("__batch", F.lit(0))])
        survivors = survivorship_dedup(merged, key, order_first=[*order_first, "__batch"],
                                       score_exclude=[YEAR, "__batch"]).drop("__batch")
        if widens:
            rest = self.scan(layer, dataset, refresh=False, spelling=True).where(~F.col(YEAR).isin(touched))
            survivors = union_aligned([survivors, _spelled(rest)])
            self._mark_widened(layer, dataset)
        written = self._overwrite(layer, dataset, survivors, stored, sort_cols=key, within=None if widens else touched)
        self._empty(layer, dataset, set(touched) - set(written))
        return touched

    def _years_of_keys(self, layer: str, dataset: str, batch: DataFrame, key, years) -> list[int]:
        """Years other than ``years`` that hold a key of the batch."""
        others = [y for y in self.years(layer, dataset, refresh=False) if y not in years]
        if not others:
            return []
        held = self.read_years(layer, dataset, others, refresh=False).select(YEAR, *[F.col(k).alias(f"__{i}") for i, k in enumerate(key)])
        keys = batch.select(*key).distinct()
        same = [F.col(f"__{i}").eqNullSafe(F.col(k)) for i, k in enumerate(key)]
        return [r[0] for r in held.join(keys, same, "left_semi").select(YEAR).distinct().collect()]

    # ---- logs ---------------------------------------------------------------
    def partition_log(self, layer: str, dataset: str, years=None) -> DataFrame | None:
        """(layer, dataset_name, year, path, row_count, file_count) per stored
        year, or per year of ``years``."""
        # counts only: the partition column and file names
        df = self.scan(layer, dataset, merge_schema=False) if years is None else self.read_years(layer, dataset, years)
        if df is None:
            return None
        return (df.select(YEAR, F.input_file_name().alias("__file"))
                  .groupBy(YEAR)
                  .agg(F.count(F.lit(1)).alias("row_count"),
                       F.count_distinct("__file").alias("file_count"))
                  .select(F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset_name"),
                          YEAR, F.concat(F.lit(f"{self.path(layer, dataset)}/{YEAR}="), F.col(YEAR).cast("string")).alias("path"),
                          "row_count", "file_count"))


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema.fields}


def _conflicts(stored: T.StructType, new: T.StructType) -> bool:
    """Whether writing ``new`` beside ``stored`` needs a column to widen."""
    together = aligned_types([stored, new])
    held = set(stored.names)
    return any(f.dataType != together[f.name] for schema in (stored, new) for f in schema.fields if f.name in held)


def _spelled(df: DataFrame) -> DataFrame:
    """With a spelling column, for values that a wider type would respell."""
    return df if SPELLING in df.columns else df.withColumn(SPELLING, F.lit(None).cast("map<string,string>"))
