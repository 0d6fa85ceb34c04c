"""Numeric coercion and null handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_double(c: str | Column) -> Column:
    """Coercing numeric cast: unparseable becomes NULL, NaN becomes NULL.

    Only decimal notation and infinities count as numbers; the engine's cast
    alone would also take Java's ``10d``, ``5F`` and ``0x1p3``.
    """
    text = F.trim(_col(c).cast("string"))
    number = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"
    return nan_to_null(F.when(text.rlike(number), text.try_cast("double")))


def nan_to_null(c: str | Column) -> Column:
    """NaN is a value in Spark but "missing" upstream: map it to NULL."""
    x = _col(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def safe_pct_change(current: str | Column, previous: str | Column) -> Column:
    """``(current / previous - 1) * 100``; a zero or NULL divisor gives NULL."""
    return (F.try_divide(_col(current), _col(previous)) - F.lit(1.0)) * F.lit(100.0)


def falsy_coalesce(*cols: str | Column) -> Column:
    """First argument that is neither NULL nor the empty string (``a or b``)."""
    parts = [F.nullif(_col(c), F.lit("")) for c in cols[:-1]] + [_col(cols[-1])]
    return F.coalesce(*parts)
