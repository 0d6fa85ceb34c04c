"""Column-level functions: every function returns a JVM-side Column expression."""

from .dates import format_compact_datetime, month_of, parse_timestamps, try_date
from .formatting import capitalize, format_fixed, format_percent
from .numeric import coerce_double, falsy_coalesce, nan_to_null, safe_pct_change
from .text import (
    boolean_text_filter,
    clean_text,
    contains_keyword,
    keyword_column_name,
    keyword_flags,
    text_length,
)

__all__ = [
    "boolean_text_filter", "capitalize", "clean_text", "coerce_double",
    "contains_keyword", "falsy_coalesce", "format_compact_datetime", "format_fixed",
    "format_percent", "keyword_column_name", "keyword_flags", "month_of",
    "nan_to_null", "parse_timestamps", "safe_pct_change", "text_length", "try_date",
]
