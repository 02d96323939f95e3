"""Casts that never raise, and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .nulls import ColumnOrName, as_col

# Texts read as logical values; anything else is unknown.
TRUE_TEXTS = ["T", "TRUE", "true", "True"]
FALSE_TEXTS = ["F", "FALSE", "false", "False"]


def to_int(c: ColumnOrName) -> Column:
    """Text to integer, fraction cut off, unreadable text to NULL."""
    return as_col(c).try_cast("double").try_cast("int")


def to_number(c: ColumnOrName) -> Column:
    return as_col(c).try_cast("double")


def text_to_bool(c: ColumnOrName) -> Column:
    c = as_col(c)
    return F.when(c.isin(TRUE_TEXTS), F.lit(True)).when(
        c.isin(FALSE_TEXTS), F.lit(False)
    )


def number_to_bool(c: ColumnOrName) -> Column:
    return as_col(c) != 0


def signif(c: ColumnOrName, digits: int) -> Column:
    """Round to significant digits."""
    c = as_col(c).cast("double")
    lead = F.floor(F.log10(F.abs(c)))
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - lead)
    return F.when(c == 0, F.lit(0.0)).otherwise(F.round(c * scale) / scale)


def percent_label(c: ColumnOrName, digits: int = 2) -> Column:
    """``0.1234`` as ``12%``, ``0.0123`` as ``1.2%``."""
    # a decimal, because small doubles are spelled with an exponent
    pct = F.round(signif(c, digits) * 100, 10).cast("decimal(28,10)").cast("string")
    return F.concat(F.regexp_replace(pct, r"\.?0+$", ""), F.lit("%"))


def number_text(c: ColumnOrName) -> Column:
    """Number as plain text, whole numbers without a fraction or exponent."""
    c = as_col(c).cast("double")
    whole = F.floor(c)
    return F.when(c == whole, whole.cast("string")).otherwise(c.cast("string"))
