"""Table registry and run settings.

A spec fixes only the primary key and the date columns of a table; every
other column passes through with whatever the landing data holds.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    name: str
    category: str                      # daily | auxiliary | financial
    primary_key: tuple[str, ...]
    date_columns: tuple[str, ...]
    dws_dataset: str | None = None

    @property
    def is_financial(self) -> bool:
        return self.category == "financial"

    @property
    def dwd_partition_column(self) -> str:
        """Date column whose year names the detail-layer partition."""
        return "real_ann_date" if self.is_financial else self.date_columns[0]


@dataclass(frozen=True)
class Settings:
    # fixed values that must equal the reference's: both backfill windows,
    # rows per file, codec, default exchange
    daily_backfill_days: int = 5          # trading days re-read by a daily update
    financial_backfill_days: int = 90     # calendar days re-read for statements
    partition_column: str = "year"
    parquet_compression: str = "zstd"
    max_rows_per_file: int = 250_000
    default_exchange: str = "SSE"
    lookup_columns: tuple[str, ...] = ("ts_code",)   # Bloom filters in the lake's files
    concurrent_tables: int = 8            # landing tables processed as concurrent Spark jobs
    layers: tuple[str, ...] = field(default=("ods", "dwd", "dws"))


SETTINGS = Settings()

# Fixed values that must equal the reference's table catalogue: table names,
# categories, primary keys and date columns.  One deliberate difference:
# suspend_d.suspend_timing holds a time range such as "13:00-15:00", so it is
# kept as text instead of being parsed (and nulled) as a date.
_FIN_KEY = ("ts_code", "end_date", "ann_date")
_FIN_DATES = ("ann_date", "f_ann_date", "end_date")
TABLE_SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        TableSpec("daily", "daily", ("ts_code", "trade_date"), ("trade_date",), "daily_master"),
        TableSpec("daily_basic", "daily", ("ts_code", "trade_date"), ("trade_date",), "daily_master"),
        TableSpec("adj_factor", "daily", ("ts_code", "trade_date"), ("trade_date",), "daily_master"),
        TableSpec("trade_cal", "auxiliary", ("exchange", "cal_date"), ("cal_date", "pretrade_date")),
        TableSpec("stock_basic", "auxiliary", ("ts_code",), ("list_date", "delist_date")),
        TableSpec("suspend_d", "auxiliary", ("ts_code", "trade_date"), ("trade_date",)),
        TableSpec("stk_limit", "auxiliary", ("ts_code", "trade_date"), ("trade_date",)),
        TableSpec("fina_indicator", "financial", _FIN_KEY, _FIN_DATES, "financial_events"),
        TableSpec("income", "financial", _FIN_KEY, _FIN_DATES, "financial_events"),
        TableSpec("balancesheet", "financial", _FIN_KEY, _FIN_DATES, "financial_events"),
    )
}

DAILY_MASTER_SOURCES: tuple[str, ...] = ("daily", "daily_basic", "adj_factor")
FINANCIAL_EVENT_SOURCES: tuple[str, ...] = ("fina_indicator", "income", "balancesheet")

# Identifier columns always kept as text, integer columns, and
# the pattern a text value must match to count as a number.
IDENTIFIER_COLUMNS = frozenset({
    "ts_code", "exchange", "symbol", "name", "industry", "market", "list_status",
    "is_hs", "curr_type", "report_type", "comp_type", "update_flag", "source_table",
    "suspend_type", "suspend_reason_type",
})
INTEGER_COLUMNS = frozenset({"is_open"})
FLOAT_PATTERN = r"^[+-]?(?:\d+(?:\.\d+)?|\.\d+)(?:[eE][+-]?\d+)?$"
NULL_DATE_TOKENS = ("", "None", "null", "NULL")

#: Helper column of stored rows: column -> text as it came, for numbers whose
#: own rendering differs ("007", "1.50").  Reads leave it out.
SPELLING = "__spelling"

# Columns of the financial event stream, in query order (fixed values).
EVENT_COLUMNS: tuple[str, ...] = (
    "ts_code", "source_table", "ann_date", "f_ann_date", "real_ann_date",
    "end_date", "report_type", "comp_type", "update_flag",
)


def spec(name: str) -> TableSpec:
    try:
        return TABLE_SPECS[name]
    except KeyError:
        raise KeyError(f"unknown table {name!r}; known: {sorted(TABLE_SPECS)}") from None
