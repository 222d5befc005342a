"""Number rules: cents, percentages, half-up rounding, forgiving parsing."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
LINE_MONEY = "decimal(18,4)"  # price x quantity keeps its full scale


def dbl(c: Column) -> Column:
    return c.cast("double")


def money(c: Column) -> Column:
    return c.cast(MONEY)


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def or_default(c: Column, default) -> Column:
    """``default`` where the value is null or zero."""
    return F.coalesce(F.nullif(c, F.lit(0)), F.lit(default))


def pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; 0 where ``whole`` is not positive."""
    return F.when(whole > 0, dbl(part) / dbl(whole) * 100).otherwise(F.lit(0.0))


def round_half_up(x: Column, digits: int = 2) -> Column:
    """Round a double half toward plus infinity: 1.005 -> 1.0, -2.5 -> -2 (0 digits)."""
    scale = float(10**digits)
    return dbl(F.floor(dbl(x) * scale + 0.5)) / scale


def hundredths(x: Column) -> Column:
    """A double with two decimals as a whole number of hundredths, half up."""
    return F.floor(dbl(x) * 100 + 0.5)


def from_units(units: Column, scale: int) -> Column:
    """A whole number of ``10**-scale`` units as an exact decimal."""
    return (units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(18,{scale})")


def cents(x: Column) -> Column:
    """A double as money, half up.  By way of whole cents, which is far cheaper than casting the double."""
    return from_units(hundredths(x), 2)


def to_fixed(x: Column, digits: int) -> Column:
    """Round on the exact binary value of the double, ties away from zero.

    A decimal tie is only possible where the value times ``2**(digits+1)`` is
    whole; elsewhere the formatter sees the exact value and never meets a tie.
    """
    x = dbl(x)
    scale = float(10**digits)
    eighths = x * float(2 ** (digits + 1))
    tie = F.signum(x) * dbl(F.floor(F.abs(x) * scale + 0.5)) / scale
    pattern = "0." + "0" * digits if digits else "0"
    text = F.call_function("format_number", x, F.lit(pattern))
    return F.when(eighths == dbl(F.floor(eighths)), tie).otherwise(dbl(text)) + 0.0


# The leading number of a text field, as decimal and as integer.
_FLOAT_PREFIX = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
_INT_PREFIX = r"^\s*([+-]?\d+)"


def parse_float(text: Column) -> Column:
    """Leading number of a text (``12abc`` -> 12); null where there is none."""
    return F.nullif(F.regexp_extract(text, _FLOAT_PREFIX, 1), F.lit("")).try_cast("double")


def parse_int(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, _INT_PREFIX, 1), F.lit("")).try_cast("long")
