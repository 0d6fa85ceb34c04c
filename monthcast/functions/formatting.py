"""Display formatting expressions (edge of the report only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


_SPLIT = 134217729.0  # 2**27 + 1: halves of a double's digits


def _halves(x: Column) -> tuple[Column, Column]:
    high = x * F.lit(_SPLIT) - (x * F.lit(_SPLIT) - x)
    return high, x - high


def _fixed(x: Column, decimals: int) -> Column:
    """Fixed-decimal text of a double's exact value, ties to even (as a
    correctly rounded conversion gives it: 0.125 -> 0.12, 2.675 -> 2.67).

    ``x * 10**decimals`` is taken with its rounding error (a two-product of
    halves), so the distance to the next tie has the right sign. From 2**40 on
    a double has at most 12 binary digits after the point, so its fraction
    times ``power`` is exact by itself; beyond 2**63 there is no fraction.
    """
    power = float(10 ** decimals)
    size = F.abs(x)
    product = size * F.lit(power)
    high, low = _halves(size)
    p_high = power * _SPLIT - (power * _SPLIT - power)
    p_low = power - p_high
    error = ((high * p_high - product) + high * p_low + low * p_high) + low * p_low
    whole = F.floor(product)
    beyond = (product - whole - F.lit(0.5)) + error
    up = (beyond > 0) | ((beyond == 0) & (whole % 2 == 1))
    units = whole + F.when(up, 1).otherwise(0)
    digits = F.lpad(units.cast("string"), 40, "0")
    text = F.concat(F.regexp_replace(F.substring(digits, 1, 40 - decimals), r"^0+(?=\d)", ""),
                    F.lit("." if decimals else ""), F.substring(digits, 41 - decimals, decimals))
    floor = F.floor(size)
    part = (size - floor) * F.lit(power)
    tie = part - F.floor(part) - F.lit(0.5)
    odd = (F.floor(part) % 2 == 1) if decimals else (floor % 2 == 1)
    parts = F.floor(part) + F.when((tie > 0) | ((tie == 0) & odd), 1).otherwise(0)
    large = F.concat((floor + F.when(parts >= int(power), 1).otherwise(0)).cast("string"), F.lit("." if decimals else ""),
                     F.lpad((parts % int(power)).cast("string"), decimals, "0") if decimals else F.lit(""))
    return (F.when(F.isnan(x), F.lit("nan")).when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when(size >= 2.0 ** 63, F.format_string(f"%.{decimals}f", x))
            .otherwise(F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), F.when(size >= 2.0 ** 40, large).otherwise(text))))


def format_fixed(c: str | Column, decimals: int = 3) -> Column:
    """Fixed-decimal text; NULL or non-numeric gives ``N/A``."""
    x = _col(c).cast("string").try_cast("double")
    return F.when(x.isNull(), F.lit("N/A")).otherwise(_fixed(x, decimals))


def format_percent(c: str | Column) -> Column:
    """Probability as ``12.34%``; NULL or non-numeric gives ``N/A``."""
    x = _col(c).cast("string").try_cast("double") * F.lit(100.0)
    return F.when(x.isNull(), F.lit("N/A")).otherwise(F.concat(_fixed(x, 2), F.lit("%")))


def capitalize(c: str | Column) -> Column:
    """First character upper, the rest lower (Python ``str.capitalize``)."""
    x = _col(c)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))
