"""Two-place rounding on exact integers, half away from zero, so results do not depend on float noise."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _floor_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def ratio_cents(total: Column, n: Column, scale: int = 1) -> Column:
    """``round(scale * total / n, 2) * 100`` as a bigint for non-negative operands; null when n is 0."""
    wide = total.cast("decimal(30,0)")
    denominator = F.nullif(n, F.lit(0)).cast("decimal(20,0)")
    return _floor_div(wide * F.lit(200 * scale) + denominator, denominator * F.lit(2))


def percent(part: Column, whole: Column) -> Column:
    """``round(100 * part / whole, 2)`` as a double."""
    return ratio_cents(part, whole, 100) / F.lit(100.0)


def mean(total: Column, n: Column) -> Column:
    """``round(total / n, 2)`` as a double."""
    return ratio_cents(total, n) / F.lit(100.0)


def decimal_text(value: Column) -> Column:
    """A two-place double as plain decimal text with at least one digit after the point: 0.0, 577.5, 32.87."""
    return F.regexp_replace(value.cast("decimal(20,2)").cast("string"), "0$", "")
