"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from .dates import (date_text, date_windows, iso_text, parse_date_multi, parse_date_two,
                    strip_ws, year_span)
from .casting import (cast_identifiers, cast_integers, cast_numeric_like, nan_to_null,
                      numeric_like_columns, numeric_like_profile)
from .rows import completeness_score, update_priority

__all__ = [
    "date_text", "date_windows", "iso_text", "parse_date_multi", "parse_date_two", "strip_ws",
    "year_span", "cast_identifiers", "cast_integers", "cast_numeric_like", "nan_to_null",
    "numeric_like_columns", "numeric_like_profile", "completeness_score", "update_priority",
]
