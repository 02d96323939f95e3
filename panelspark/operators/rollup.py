"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.nulls import (
    all_kleene,
    any_kleene,
    any_known,
    sum_known,
    sum_or_zero,
    sum_strict,
)
from ..functions.numbers import to_int
from ..functions.status import status_label, status_rank
from ..functions.text import merge_buckets, surrogate_id

# Taxa counted together, and the veterinarian fields that count.
SMALL_RUMINANTS = ["goats", "sheep"]
SMALL_RUMINANT_BUCKET = "sheep/goats"
VETERINARIAN_FIELDS = [
    "animal health and welfare activities",
    "veterinary public health activities",
    "laboratories",
    "private clinical practice",
    "academic activities and education",
    "pharmaceutical industry",
]

# Measures of an outbreak report.
OUTBREAK_MEASURES = [
    "susceptible",
    "cases",
    "deaths",
    "killed_and_disposed_of",
    "slaughtered",
]

ANNUAL_PERIOD = "Jan-Dec"
CELL = ("country_iso3c", "disease", "report_year", "report_semester")


def taxa_population(
    df: DataFrame,
    keys: Sequence[str] = ("country_iso3c", "year"),
    taxa: str = "taxa",
    population: str = "population",
    members: Sequence[str] = SMALL_RUMINANTS,
    bucket: str = SMALL_RUMINANT_BUCKET,
) -> DataFrame:
    """Population per taxa bucket, unknown counted as zero."""
    bucketed = df.withColumn(taxa, merge_buckets(taxa, members, bucket))
    return bucketed.groupBy(*keys, taxa).agg(sum_or_zero(population).alias(population))


def veterinarian_count(
    df: DataFrame,
    keys: Sequence[str] = ("country_iso3c", "year"),
    field: str = "veterinarian_field",
    count: str = "total_count",
    fields: Sequence[str] = VETERINARIAN_FIELDS,
) -> DataFrame:
    """Veterinarians over the counted fields; text that is no number is unknown."""
    counted = df.filter(F.col(field).isin(list(fields)))
    return counted.groupBy(*keys).agg(
        sum_known(to_int(count)).alias("veterinarian_count")
    )


def rollup_cells(df: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    """Status and cases per cell over taxa and populations.

    Expects boolean ``actual_status`` and ``disease_status_unreported``.
    """
    return df.groupBy(*keys).agg(
        any_kleene(F.col("predicted_cases") > 0).alias("predicted_status"),
        any_known("actual_status").alias("actual_status"),
        sum_strict("predicted_cases").alias("predicted_cases"),
        sum_known("actual_cases").alias("actual_cases"),
        all_kleene("disease_status_unreported").alias("disease_status_unreported"),
    )


def nowcast_summary(
    predictions: DataFrame,
    diseases: Sequence[str] | None = None,
    keys: Sequence[str] = CELL,
) -> DataFrame:
    """Rolled-up predictions of the chosen diseases with their coalesced status."""
    if diseases is not None:
        predictions = predictions.filter(F.col("disease").isin(list(diseases)))
    cells = rollup_cells(
        predictions.select(
            *keys,
            "predicted_cases",
            F.col("cases").alias("actual_cases"),
            F.col("disease_status").cast("boolean").alias("actual_status"),
            F.col("disease_status_unreported").cast("boolean"),
        ),
        keys,
    )
    label = status_label("actual_status", "disease_status_unreported", "predicted_status")
    out = cells.withColumn("status_coalesced", label)
    out = out.withColumn("status_rank", status_rank("status_coalesced"))
    return out.select(surrogate_id(*keys).alias("id"), "*")


def event_totals(
    detail: DataFrame,
    keys: Sequence[str] = ("id", "species"),
    measures: Sequence[str] = OUTBREAK_MEASURES,
) -> DataFrame:
    """Calculated totals of the text measures, unknown only if nothing is known."""
    sums = [sum_known(to_int(m)).alias(m) for m in measures]
    return detail.groupBy(*keys).agg(*sums)


def period_totals(
    df: DataFrame,
    keys: Sequence[str],
    measures: dict[str, tuple[str, str]],
    period: str = "report_months",
    annual: str = ANNUAL_PERIOD,
) -> DataFrame:
    """Half-year and annual totals side by side from one pass over the table.

    ``measures`` maps a column to the names of its half-year and annual totals. A key
    found in one kind of report only has NULL totals for the other.
    """
    is_annual = F.col(period) == annual
    sums: list[Column] = []
    for measure, (half_name, annual_name) in measures.items():
        value = F.col(measure).try_cast("double")
        sums.append(F.sum(F.when(~is_annual, value)).alias(half_name))
        sums.append(F.sum(F.when(is_annual, value)).alias(annual_name))
    return df.filter(is_annual.isNotNull()).groupBy(*keys).agg(*sums)


def single_country(
    df: DataFrame, disease: str = "disease", country: str = "country_iso3c"
) -> DataFrame:
    """Per disease, whether all its rows come from one country."""
    one = F.min(country) == F.max(country)
    return df.groupBy(disease).agg(
        F.coalesce(one, F.lit(False)).alias("disease_in_single_country")
    )


def bounds(df: DataFrame, *cols: str) -> DataFrame:
    """Smallest and largest known value of each column, in one row."""
    ends = [f(c).alias(f"{p}_{c}") for c in cols for f, p in ((F.min, "min"), (F.max, "max"))]
    return df.agg(*ends)
