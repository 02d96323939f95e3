"""Status labels derived from nullable flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .nulls import ColumnOrName, as_col

# The status labels in display order.
REPORTED_PRESENT = "reported present"
PREDICTED_PRESENT = "unreported, predicted present"
REPORTED_ABSENT = "reported absent"
PREDICTED_ABSENT = "unreported, predicted absent"
NEVER = "never reported or predicted"
STATUS_LEVELS = [
    REPORTED_PRESENT,
    PREDICTED_PRESENT,
    REPORTED_ABSENT,
    PREDICTED_ABSENT,
    NEVER,
]

# Basemap categories.
NEVER_IN_COUNTRY = "Disease never in country"
CURRENT_OUTBREAK = "Current Outbreak"


def status_label(
    actual: ColumnOrName, unreported: ColumnOrName, predicted: ColumnOrName
) -> Column:
    """A report decides; without one, a prediction does if the cell is unreported."""
    actual, unreported, predicted = map(as_col, (actual, unreported, predicted))
    guess = F.when(predicted, F.lit(PREDICTED_PRESENT)).when(
        ~predicted, F.lit(PREDICTED_ABSENT)
    )
    return (
        F.when(actual, F.lit(REPORTED_PRESENT))
        .when(~actual, F.lit(REPORTED_ABSENT))
        .when(unreported, guess)
    )


def status_rank(label: ColumnOrName) -> Column:
    """1-based position in :data:`STATUS_LEVELS`, NULL for an unknown label."""
    levels = F.array(*[F.lit(s) for s in STATUS_LEVELS])
    return F.nullif(F.array_position(levels, as_col(label)).cast("int"), F.lit(0))


def three_state(flag: ColumnOrName) -> Column:
    flag = as_col(flag)
    return (
        F.when(flag.isNull(), F.lit("Missing"))
        .when(flag, F.lit("Present"))
        .otherwise(F.lit("Absent"))
    )


def outbreak_flag(*flags: ColumnOrName) -> Column:
    """Three-valued OR over columns, unknown counted as FALSE."""
    known = F.lit(False)
    for flag in flags:
        known = known | F.coalesce(as_col(flag), F.lit(False))
    return known
