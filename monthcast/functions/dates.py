"""Date and timestamp expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TIMESTAMP_FORMATS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamps(c: str | Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Parse strings in any of ``formats`` (first that fits wins); offsets are
    converted to UTC and the result is a naive ``TIMESTAMP_NTZ``; anything
    unparseable is NULL. Requires session time zone UTC.
    """
    s = F.trim(_col(c))
    parsed = F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])
    return parsed.cast("timestamp_ntz")


def try_date(c: str | Column, formats: Sequence[str] = ("yyyy-MM-dd",)) -> Column:
    """Coercing date cast: bad input becomes NULL."""
    s = F.trim(_col(c).cast("string"))
    return F.coalesce(*[F.to_date(F.try_to_timestamp(s, F.lit(f))) for f in formats])


def month_of(c: str | Column) -> Column:
    """First day of the month as DATE."""
    return F.trunc(_col(c), "month")


def format_compact_datetime(c: str | Column, end_of_day: bool = False) -> Column:
    """``yyyyMMdd000000`` (or ``...235959``) request bound for a date."""
    return F.concat(F.date_format(_col(c), "yyyyMMdd"), F.lit("235959" if end_of_day else "000000"))
