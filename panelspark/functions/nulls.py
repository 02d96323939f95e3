"""Aggregates that differ only in how they treat NULL.

Each returns one column expression built from Spark's own aggregates, so partial
aggregation happens before the shuffle. ``over`` turns it into a window aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.window import WindowSpec

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bind(agg: Column, over: WindowSpec | None) -> Column:
    return agg if over is None else agg.over(over)


def _has_null(c: Column, over: WindowSpec | None) -> Column:
    return _bind(F.count(F.lit(1)), over) > _bind(F.count(c), over)


def sum_strict(c: ColumnOrName, over: WindowSpec | None = None) -> Column:
    """NULL as soon as any value is NULL."""
    c = as_col(c)
    return F.when(~_has_null(c, over), _bind(F.sum(c), over))


def sum_known(c: ColumnOrName, over: WindowSpec | None = None) -> Column:
    """Sum of the known values; NULL only if there is none."""
    return _bind(F.sum(as_col(c)), over)


def sum_or_zero(c: ColumnOrName, over: WindowSpec | None = None) -> Column:
    """Sum of the known values; 0 if there is none."""
    return F.coalesce(sum_known(c, over), F.lit(0))


def any_known(c: ColumnOrName, over: WindowSpec | None = None) -> Column:
    """TRUE if any known value is; NULL only if none is known."""
    return _bind(F.bool_or(as_col(c)), over)


def any_kleene(c: ColumnOrName, over: WindowSpec | None = None) -> Column:
    """Three-valued OR: TRUE wins, then NULL, then FALSE."""
    c = as_col(c)
    return (
        F.when(_bind(F.bool_or(c), over), F.lit(True))
        .when(_has_null(c, over), F.lit(None).cast("boolean"))
        .otherwise(F.lit(False))
    )


def all_kleene(c: ColumnOrName, over: WindowSpec | None = None) -> Column:
    """Three-valued AND: FALSE wins, then NULL, then TRUE."""
    c = as_col(c)
    return (
        F.when(~_bind(F.bool_and(c), over), F.lit(False))
        .when(_has_null(c, over), F.lit(None).cast("boolean"))
        .otherwise(F.lit(True))
    )
