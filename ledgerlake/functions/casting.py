"""Type normalisation: identifiers to text, integer flags, and the
data-dependent cast of numeric-looking text columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..specs import FLOAT_PATTERN, IDENTIFIER_COLUMNS, INTEGER_COLUMNS, SPELLING
from .dates import strip_ws


def cast_identifiers(df: DataFrame, identifiers=IDENTIFIER_COLUMNS) -> DataFrame:
    """Identifier columns that are present become text."""
    cols = [c for c in df.columns if c in identifiers
            and not isinstance(df.schema[c].dataType, T.StringType)]
    if not cols:
        return df
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def cast_integers(df: DataFrame, integers=INTEGER_COLUMNS) -> DataFrame:
    """Integer flag columns: lenient cast, bad values become null."""
    cols = [c for c in df.columns if c in integers]
    if not cols:
        return df
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS INT)") for c in cols})


def _candidate_columns(df: DataFrame, protected) -> list[str]:
    protected = set(protected or ())
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType)
            and f.name not in protected and f.name not in IDENTIFIER_COLUMNS]


def numeric_like_profile(df: DataFrame, protected=()) -> DataFrame:
    """One row per candidate text column: (column_name, all_numeric).

    ``all_numeric`` is true when every non-null, trimmed value matches the
    number pattern; a column with no values at all is vacuously numeric.
    All columns are profiled in ONE aggregate pass (partial aggregation on
    the map side, a single row reaches the final stage).
    """
    cands = _candidate_columns(df, protected)
    if not cands:
        return df.sparkSession.createDataFrame([], "column_name string, all_numeric boolean")
    aggs = [F.coalesce(F.bool_and(strip_ws(c).rlike(FLOAT_PATTERN)), F.lit(True)).alias(f"c{i}")
            for i, c in enumerate(cands)]
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', c{i}" for i, c in enumerate(cands))
    return (df.agg(*aggs)
              .select(F.expr(f"stack({len(cands)}, {pairs}) AS (column_name, all_numeric)")))


def numeric_like_columns(df: DataFrame, protected=(), known_types=None) -> dict[str, str]:
    """Columns to cast and their types.  Brings one row, a few values per
    column, to the driver (bounded by the width of the table, not its length).
    An empty batch keeps its landing types: with no values there is nothing to
    type, and a later batch decides."""
    cands = _candidate_columns(df, protected)
    aggs = _profile(cands, known_types)
    return numeric_columns_from(cands, df.agg(*aggs).first().asDict(), known_types) if len(aggs) > 1 else {}


def numeric_profile_aggs(df: DataFrame, protected=(), known_types=None):
    """The numeric profile as aggregate expressions, to ride along another
    pass over the rows (``DataFrame.observe`` on a write).  Returns the
    candidate text columns and the aggregates; integer flag columns, which
    are cast before profiling, are left out.  Decide with
    ``numeric_columns_from``."""
    cands = [c for c in _candidate_columns(df, protected) if c not in INTEGER_COLUMNS]
    return cands, _profile(cands, known_types)


def _profile(cands, known_types) -> list:
    """Row count, and for each undecided column: do all values look numeric,
    and, where numbers of a type are stored, does that type hold them all."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(_undecided(cands, known_types)):
        aggs.append(F.coalesce(F.bool_and(strip_ws(c).rlike(FLOAT_PATTERN)), F.lit(True)).alias(f"__num{i}"))
        stored = (known_types or {}).get(c)
        if stored in _INTEGRAL:
            fits = strip_ws(c).rlike(INTEGER_PATTERN) & _number(c, stored).isNotNull()
        elif stored and stored.startswith("decimal"):
            fits = F.coalesce(_number(c, stored) == _number(c, "decimal(38,18)"), F.lit(False))
        else:
            continue
        aggs.append(F.coalesce(F.bool_and(F.when(F.col(c).isNotNull(), fits)), F.lit(True)).alias(f"__fit{i}"))
    return aggs


def numeric_columns_from(cands, metrics: dict, known_types=None) -> dict[str, str]:
    """Columns to cast, with their types, given the observed profile: those
    whose values all look numeric (none when the batch had no rows).  A stored
    integer or decimal type stays where it holds every value."""
    if not metrics.get("__n"):
        return {}
    return {c: (known_types or {}).get(c, "double") if metrics.get(f"__fit{i}") else "double"
            for i, c in enumerate(_undecided(cands, known_types)) if metrics.get(f"__num{i}")}


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
INTEGER_PATTERN = r"^[+-]?\d+$"


def _undecided(cands, known_types=None) -> list[str]:
    """Text columns whose type a batch's values decide: those the stored
    dataset lacks or holds as numbers.  What is stored as text stays text."""
    known = known_types or {}
    return [c for c in cands if known.get(c, "double") in ("float", "double", *_INTEGRAL) or known[c].startswith("decimal")]


def _number(c: str, dtype: str):
    return F.expr(f"try_cast(regexp_replace(`{c}`, '^\\\\s+|\\\\s+$', '') AS {dtype})")


def cast_numeric_like(df: DataFrame, protected=(), columns=None, known_types=None, keep_spelling: bool = False) -> DataFrame:
    """Cast numeric-looking text columns to numbers.

    ``columns`` pins the decision outright (names, or names with types).  With
    ``known_types`` (column -> type name, e.g. the stored dataset's schema) a
    column stored as text stays text.  A column stored as numbers is profiled
    like a new one: values that its type holds take that type, other numbers
    become double, and where a batch holds other text it is left as it is and
    the lake widens the stored column.  ``keep_spelling`` adds the text of the
    numbers that are not written as Spark would write them (``SPELLING``), so
    that a column that later turns to text holds every value as it came.
    """
    if columns is None:
        columns = numeric_like_columns(df, protected, known_types)
    types = columns if isinstance(columns, dict) else {c: "double" for c in columns}
    types = {c: t for c, t in types.items() if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)}
    if not types:
        return df
    casts = {c: _number(c, t) for c, t in types.items()}
    if keep_spelling:
        names = F.array(*[F.lit(c) for c in casts])
        other = {c: F.coalesce(F.col(c) != n.cast("string"), F.lit(False)) for c, n in casts.items()}
        texts = F.array(*[F.when(o, F.col(c)) for c, o in other.items()])
        odd = F.map_filter(F.map_from_arrays(names, texts), lambda _, v: v.isNotNull())
        # a map is made for the rows alone that need one
        casts[SPELLING] = F.when(reduce(lambda a, b: a | b, other.values()), odd)
    return df.withColumns(casts)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN becomes null (landing data uses NaN for missing)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not cols:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None).cast(df.schema[c].dataType))
                           .otherwise(F.col(c)) for c in cols})
