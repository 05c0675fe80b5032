"""Number and date formats of the result grid. Ties round half-even on the binary value, as format_number does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_round(x: Column, digits: int = 2) -> Column:
    return F.format_number(x, digits)


def format_percentage(x: Column, digits: int = 0) -> Column:
    return F.concat(F.format_number(x * 100, digits), F.lit("%"))


def format_currency(x: Column, currency: str = "$", digits: int = 2, before: bool = True, zero: str | None = None) -> Column:
    """The sign comes before the symbol; NaN and null give the empty text."""
    number = F.format_number(F.abs(x), digits)
    parts = [F.when(x < 0, "-").otherwise("")] + ([F.lit(currency), number] if before else [number, F.lit(currency)])
    shown = F.concat(*parts)
    if zero is not None:
        shown = F.when(x == 0, F.lit(zero)).otherwise(shown)
    return F.when(x.isNull() | F.isnan(x.cast("double")), "").otherwise(shown)


def format_string(x: Column, prefix: str = "", suffix: str = "") -> Column:
    return F.coalesce(F.concat(F.lit(prefix), x.cast("string"), F.lit(suffix)), F.lit(""))


def significant(x: Column, digits: int) -> Column:
    """x rounded to so many significant digits."""
    scale = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(x))))
    plain = (x == 0) | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return F.when(plain, x).otherwise(F.round(x * scale) / scale)


def precise(x: Column, digits: int) -> Column:
    """x with so many significant digits as text: plain from 1e-6 up to as many digits before the point, else with an exponent; null, NaN and infinities give null."""
    science = F.format_string(f"%.{digits - 1}e", x.cast("double"))
    parts = F.split(science, "e")
    mantissa, exponent = parts[0], parts[1].cast("int")
    shown = F.concat(mantissa, F.when(exponent < 0, "e-").otherwise("e+"), F.abs(exponent).cast("string"))
    for e in range(-6, digits):
        shown = F.when(exponent == e, F.format_string(f"%.{digits - 1 - e}f", x.cast("double"))).otherwise(shown)
    return F.when(x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")), shown)


def rescaled(x: Column, scale: int) -> Column:
    """x as a whole number of 10^-scale, for sliders that count in steps."""
    return F.floor(x * 10**scale + 0.5).cast("long")


def unscaled(n: Column, scale: int) -> Column:
    """Such a number as text with all its places."""
    return F.format_string(f"%.{scale}f", n.cast("double") / 10**scale)


def format_date(x: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(x, pattern)
