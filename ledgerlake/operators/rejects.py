"""Landing rows that the detail layer does not take, with the reason.

The rules are those that cleaning applies: a statement without a readable
announcement date, a statement of another type, a flag that is no integer, a
row whose partition date cannot be read.  A row is rejected for the first
reason that holds, so kept and rejected rows add up to the landed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import parse_date_multi
from ..specs import INTEGER_COLUMNS, spec as get_spec

#: Column that names why a row is rejected; null for a row that is kept.
REASON = "__reason"
NO_ANNOUNCEMENT, OTHER_STATEMENT, BAD_INTEGER, NO_YEAR = "no announcement date", "other statement type", "bad integer", "no partition year"


def reject_reason(table_name: str, raw: DataFrame) -> Column:
    """The first reason to reject a landing row, null where there is none."""
    sp = get_spec(table_name)

    def day(c: str) -> Column:
        return parse_date_multi(c, raw.schema[c].dataType)

    reason = F.lit(None).cast("string")
    # the last rule first: an earlier one takes precedence
    if not sp.is_financial and sp.date_columns[0] in raw.columns:
        reason = F.when(day(sp.date_columns[0]).isNull(), F.lit(NO_YEAR)).otherwise(reason)
    for c in sorted(INTEGER_COLUMNS & set(raw.columns)):
        reason = F.when(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS INT)").isNull(), F.lit(BAD_INTEGER)).otherwise(reason)
    if sp.is_financial:
        if "report_type" in raw.columns:
            reason = F.when(~F.coalesce(F.col("report_type").cast("string") == "1", F.lit(False)), F.lit(OTHER_STATEMENT)).otherwise(reason)
        reason = F.when(day("ann_date").isNull(), F.lit(NO_ANNOUNCEMENT)).otherwise(reason)
    return reason


def rejected(table_name: str, marked: DataFrame) -> DataFrame:
    """(table_name, reason, row): the rejected rows of a frame with REASON, the
    row as it landed, as JSON text."""
    data = [c for c in marked.columns if c != REASON]
    row = F.to_json(F.struct(*data), {"ignoreNullFields": "false"})
    return marked.where(F.col(REASON).isNotNull()).select(F.lit(table_name).alias("table_name"), F.col(REASON).alias("reason"), row.alias("row"))
