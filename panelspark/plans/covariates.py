"""Country and bilateral covariate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import geodesic_m
from ..operators.grid import ordered_pairs, product, spread, with_values, with_years
from ..operators.panel import pair_totals, static_panel, trade_panel, yearly_panel
from ..operators.rollup import taxa_population, veterinarian_count
from ..sources.tables import Tables

PAIR = ["country_origin", "country_destination"]
COUNTRY = ["country_iso3c"]

# First panel year and the hand-added territory.
FIRST_YEAR = 2000
EXTRA_CODES = ["HKG"]


def pair_years(countries: DataFrame, as_of: int) -> DataFrame:
    return with_years(ordered_pairs(countries), FIRST_YEAR, as_of)


def country_years(countries: DataFrame, as_of: int) -> DataFrame:
    codes = spread(countries.select(*COUNTRY).dropna().distinct(), *COUNTRY)
    return with_years(codes, FIRST_YEAR, as_of)


def bilateral_yearly(
    data: DataFrame, countries: DataFrame, var: str, source: str, as_of: int
) -> DataFrame:
    """Migration or tourism: origin, destination, year and an interpolated measure."""
    return yearly_panel(data, pair_years(countries, as_of), PAIR, var, source)


def country_yearly(
    data: DataFrame, countries: DataFrame, var: str, source: str, as_of: int
) -> DataFrame:
    """Country indicator such as GDP or population, interpolated."""
    return yearly_panel(data, country_years(countries, as_of), COUNTRY, var, source)


def taxa_yearly(
    data: DataFrame, countries: DataFrame, source: str, as_of: int
) -> DataFrame:
    """Animal population per taxa bucket; summed first, then interpolated."""
    totals = taxa_population(data)
    grid = product(country_years(countries, as_of), totals.select("taxa").distinct())
    return yearly_panel(totals, grid, [*COUNTRY, "taxa"], "population", source)


def veterinarians_yearly(
    data: DataFrame, countries: DataFrame, source: str, as_of: int
) -> DataFrame:
    counts = veterinarian_count(data)
    return country_yearly(counts, countries, "veterinarian_count", source, as_of)


def trade_tables(
    tables: Tables,
    wide: DataFrame,
    countries: DataFrame,
    lookup: DataFrame,
    name: str,
    total: str,
    source: str,
    as_of: int,
) -> tuple[DataFrame, DataFrame]:
    """Store the long trade panel and its totals; totals read the stored panel."""
    measures = [c for c in wide.columns if c not in [*PAIR, "year"]]
    panel = trade_panel(
        wide, pair_years(countries, as_of), measures, as_of, source, lookup
    )
    stored = tables.overwrite(panel, name)
    return stored, tables.overwrite(pair_totals(stored, total), f"{name}_summary")


def bilateral_static(
    data: DataFrame, countries: DataFrame, source: str | None, fill: dict | None = None
) -> DataFrame:
    """Migration routes or borders; gaps stay NULL unless ``fill`` names a default."""
    return static_panel(data, ordered_pairs(countries), PAIR, source, fill)


def country_distance(points: DataFrame) -> DataFrame:
    """Distance in metres between every ordered pair of countries.

    ``points`` has one ``country_iso3c``, ``lat``, ``lon`` row per country.
    """
    known = points.select("country_iso3c", "lat", "lon").dropna()
    pairs = ordered_pairs(known)
    for end in ("origin", "destination"):
        side = known.select(
            F.col("country_iso3c").alias(f"country_{end}"),
            F.col("lat").alias(f"__lat_{end}"),
            F.col("lon").alias(f"__lon_{end}"),
        )
        pairs = pairs.join(side, f"country_{end}")
    metres = geodesic_m(
        "__lat_origin", "__lon_origin", "__lat_destination", "__lon_destination"
    )
    return pairs.select(*PAIR, metres.alias("gc_dist_meters"))


__all__ = [
    "bilateral_static",
    "bilateral_yearly",
    "country_distance",
    "country_years",
    "country_yearly",
    "pair_years",
    "taxa_yearly",
    "trade_tables",
    "veterinarians_yearly",
    "with_values",
]
