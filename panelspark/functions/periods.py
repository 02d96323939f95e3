"""Years, half-years and months."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .nulls import ColumnOrName, as_col

# Fixed value: text form of a post's timestamp.
POST_DATE_FORMAT = "MM/dd/yyyy, HH:mm:ss"


def semester(date: ColumnOrName) -> Column:
    return F.when(F.month(as_col(date)) < 7, 1).otherwise(
        F.when(as_col(date).isNotNull(), 2)
    )


def half_year_axis(year: ColumnOrName, sem: ColumnOrName) -> Column:
    """Fractional year: 2019.0 for the first half, 2019.5 for the second."""
    return as_col(year) + (as_col(sem) - 1) / F.lit(2.0)


def half_index(year: ColumnOrName, sem: ColumnOrName) -> Column:
    """Half-years counted from year zero, so that neighbours differ by one."""
    return as_col(year) * 2 + as_col(sem) - 1


def index_year(index: ColumnOrName) -> Column:
    return F.floor(as_col(index) / 2).cast("int")


def index_semester(index: ColumnOrName) -> Column:
    return (F.pmod(as_col(index), F.lit(2)) + 1).cast("int")


def month_start(date: ColumnOrName) -> Column:
    return F.trunc(as_col(date).cast("date"), "month")


def post_date_text(ts: ColumnOrName) -> Column:
    return F.date_format(as_col(ts), POST_DATE_FORMAT)
