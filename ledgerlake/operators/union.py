"""Union by name with missing columns and type widening."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..specs import SPELLING

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_RANK = {T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2, T.LongType: 3}


def common_type(a: T.DataType | None, b: T.DataType | None) -> T.DataType:
    """Relaxed supertype: null yields the other; equal stays; integers widen
    to the wider integer; integer/float/decimal widen to double; date and
    timestamp widen to timestamp; anything else (e.g. text with a number)
    becomes text, so no value fails a cast at run time."""
    if a is None or isinstance(a, T.NullType):
        return b if b is not None else T.NullType()
    if b is None or isinstance(b, T.NullType):
        return a
    if a == b:
        return a
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return a if _RANK[type(a)] >= _RANK[type(b)] else b
    numeric = (T.NumericType,)
    if isinstance(a, numeric) and isinstance(b, numeric):
        return T.DoubleType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        if isinstance(a, T.TimestampType) or isinstance(b, T.TimestampType):
            return T.TimestampType()
        return T.TimestampNTZType()
    return T.StringType()


def aligned_types(schemas) -> dict[str, T.DataType]:
    """Column order of first appearance -> common type."""
    out: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            out[f.name] = common_type(out.get(f.name), f.dataType)
    return out


def aligned_schema(frames) -> dict[str, T.DataType]:
    return aligned_types([df.schema for df in frames])


def union_aligned(frames) -> DataFrame:
    """Union by name; missing columns become typed nulls; types widen per
    ``common_type``.  Duplicates are kept (UNION ALL).  Where frames carry the
    spelling of their numbers (``SPELLING``), a number that becomes text is
    spelled as it came."""
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("union_aligned needs at least one frame")
    target = aligned_schema(frames)

    def conform(df: DataFrame) -> DataFrame:
        exprs = []
        for c, t in target.items():
            if isinstance(t, T.NullType):
                t = T.StringType()
            if c not in df.columns:
                e = F.lit(None).cast(t)
            elif df.schema[c].dataType == t:
                e = F.col(c)
            else:
                e = F.col(c).cast(t)
                if SPELLING in df.columns and isinstance(t, T.StringType) and isinstance(df.schema[c].dataType, T.NumericType):
                    e = F.coalesce(F.col(SPELLING)[c], e)
            exprs.append((_spelling(df, target) if c == SPELLING else e).alias(c))
        return df.select(*exprs)

    return reduce(lambda a, b: a.unionByName(b), [conform(f) for f in frames])


def _spelling(df: DataFrame, target: dict[str, T.DataType]):
    """What is still to be spelled once the columns have their target types:
    less what has become text, and with integers that a double cannot hold."""
    kind = target[SPELLING]
    old = F.col(SPELLING) if SPELLING in df.columns else F.lit(None).cast(kind)
    gone = [f.name for f in df.schema.fields if isinstance(target[f.name], T.StringType) and not isinstance(f.dataType, T.StringType)]
    long = [f.name for f in df.schema.fields if isinstance(target[f.name], T.DoubleType) and isinstance(f.dataType, T.LongType)]
    if gone and SPELLING in df.columns:
        old = F.map_filter(old, lambda k, _: ~k.isin(gone))
    if long:
        texts = F.array(*[F.when(F.col(c).cast("double").cast("decimal(38,0)") != F.col(c).cast("decimal(38,0)"), F.col(c).cast("string")) for c in long])
        lost = F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in long]), texts), lambda k, v: v.isNotNull())
        old = F.map_concat(F.map_filter(F.coalesce(old, F.create_map().cast(kind)), lambda k, _: ~k.isin(long)), lost)
    return F.when(F.size(old) > 0, old) if gone or long else old


def concat_batches(frames) -> DataFrame:
    """Concatenate landing batches: zero-width batches are dropped, the rest
    are unioned by name with widening."""
    return union_aligned([f for f in frames if f is not None and len(f.columns) > 0])
