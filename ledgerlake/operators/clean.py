"""Table cleaning: parse, type, financial rules, dedup, and its measures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.casting import cast_identifiers, cast_integers, cast_numeric_like
from ..functions.dates import parse_date_multi
from ..specs import EVENT_COLUMNS, SPELLING, TableSpec, spec as get_spec
from .dedup import dedup_counts, require_columns, survivorship_dedup
from .quality import null_profile


def parse_date_columns(df: DataFrame, columns) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: parse_date_multi(c, df.schema[c].dataType) for c in present})


def add_source_tag(df: DataFrame, table_name: str) -> DataFrame:
    if "source_table" in df.columns:
        return df
    return df.withColumn("source_table", F.lit(table_name))


def complete_financial_columns(df: DataFrame) -> DataFrame:
    """Default missing financial columns: f_ann_date null date, comp_type and
    update_flag empty text."""
    add = {}
    if "f_ann_date" not in df.columns:
        add["f_ann_date"] = F.lit(None).cast("date")
    for c in ("comp_type", "update_flag"):
        if c not in df.columns:
            add[c] = F.lit("")
    return df.withColumns(add) if add else df


def visible_from(ann="ann_date", f_ann="f_ann_date"):
    """real_ann_date: the earlier of ann_date and f_ann_date (``least`` skips
    a null f_ann_date, giving ann_date)."""
    return F.least(F.col(ann), F.col(f_ann))


def prepare_financial(df: DataFrame, table_name: str) -> DataFrame:
    """Source tag, default columns, PIT guard (no ann_date -> dropped),
    statement-type filter (report_type "1" when the column exists) and the
    visible-from date."""
    out = complete_financial_columns(add_source_tag(df, table_name))
    out = out.where(F.col("ann_date").isNotNull())
    if "report_type" in out.columns:
        out = out.where(F.col("report_type").cast("string") == "1")
    return out.withColumn("real_ann_date", visible_from())


def prepare_table(table_name: str, df: DataFrame, numeric_columns=None, known_types=None,
                  keep_spelling: bool = False) -> DataFrame:
    """All typing steps before dedup.  ``numeric_columns`` pins the numeric
    decision; ``known_types`` (a stored dataset's schema) pins it for the
    columns already stored; the rest is profiled from the data in one pass.
    ``keep_spelling``: see ``cast_numeric_like``."""
    sp: TableSpec = get_spec(table_name)
    out = parse_date_columns(df, sp.date_columns)
    out = cast_identifiers(out)
    out = cast_integers(out)
    out = cast_numeric_like(out, protected=set(sp.date_columns), columns=numeric_columns,
                            known_types=known_types, keep_spelling=keep_spelling)
    if sp.is_financial:
        require_columns(out, ["ann_date"], "financial")
        out = prepare_financial(out, table_name)
    return out


@dataclass
class CleanResult:
    table_name: str
    prepared: DataFrame          # typed rows before dedup
    frame: DataFrame             # survivors, one per primary key
    primary_key: tuple[str, ...]
    stored: DataFrame | None = None      # survivors with the spelling of their numbers, for the lake

    def counts(self) -> DataFrame:
        """rows_before, rows_after, duplicate_rows in one grouping."""
        return dedup_counts(self.prepared, self.primary_key).select(
            F.lit(self.table_name).alias("table_name"), "*")

    def null_profile(self) -> DataFrame:
        return null_profile(self.frame, self.table_name)


def clean_table(table_name: str, df: DataFrame, numeric_columns=None,
                order_first=(), known_types=None, keep_spelling: bool = False) -> CleanResult:
    """Clean one landing table: parse dates, type columns, apply financial
    rules, and keep one survivor per primary key."""
    sp = get_spec(table_name)
    prepared = prepare_table(table_name, df, numeric_columns, known_types, keep_spelling)
    require_columns(prepared, sp.primary_key)
    frame = survivorship_dedup(prepared, sp.primary_key, order_first=order_first)
    return CleanResult(table_name, prepared.drop(SPELLING), frame.drop(SPELLING), sp.primary_key, frame)


def empty_table(spark: SparkSession, table_name: str, columns: dict[str, T.DataType] | None = None) -> DataFrame:
    """Typed empty table for a spec: the given columns, plus the key columns
    (text, dates as date) and, for statements, source_table / real_ann_date."""
    sp = get_spec(table_name)
    fields: dict[str, T.DataType] = dict(columns or {})
    for c in sp.primary_key:
        fields.setdefault(c, T.DateType() if c in sp.date_columns else T.StringType())
    if sp.is_financial:
        fields.setdefault("source_table", T.StringType())
        fields.setdefault("real_ann_date", T.DateType())
    schema = T.StructType([T.StructField(n, t, True) for n, t in fields.items()])
    return spark.createDataFrame([], schema)


EVENT_SCHEMA = T.StructType([
    T.StructField(c, T.DateType() if c in ("ann_date", "f_ann_date", "real_ann_date", "end_date")
                  else T.StringType(), True)
    for c in EVENT_COLUMNS
])
