"""Tables behind maps, plots and the prediction query."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .joins import null_safe_join
from .panel import add_missing_countries
from ..functions.nulls import all_kleene
from ..functions.numbers import number_text
from ..functions.periods import half_year_axis
from ..functions.status import NEVER, PREDICTED_ABSENT, three_state
from ..functions.text import split_list, title_case
from ..session import stored
from ..sources.pointers import Pointers

# What an absent country is filled with.
MISSING_COUNTRY_DEFAULTS = {
    "predicted_cases": 0.0,
    "predicted_status": False,
    "disease_status_unreported": True,
    "status_coalesced": PREDICTED_ABSENT,
}


def never_reported_override(df: DataFrame) -> DataFrame:
    """Relabel countries whose every period of a disease has no cases at all.

    The answer per country and disease is an aggregate joined back, so that no task
    has to hold all rows of one country.
    """
    key = ["country_iso3c", "disease"]
    silent = all_kleene(F.col("predicted_cases") == 0) & all_kleene(
        F.col("cases_coalesced") == 0
    )
    answers = df.groupBy(*key).agg(silent.alias("__silent"))
    joined = null_safe_join(df, answers, key, "left")
    # an unknown answer gives an unknown label
    label = F.when(F.col("__silent"), F.lit(NEVER)).when(
        ~F.col("__silent"), F.col("status_coalesced")
    )
    return joined.withColumn("status_coalesced", label).drop("__silent")


def nowcast_view(
    summary: DataFrame, map_countries: DataFrame, country_names: DataFrame
) -> DataFrame:
    """Summary completed to every mapped country, with names, axis and labels.

    ``country_names`` has ``country_iso3c`` and ``country_name``.
    """
    summary = stored(summary, "summary")  # a roll-up, read five times below
    full = add_missing_countries(summary, map_countries, MISSING_COUNTRY_DEFAULTS)
    reported = F.coalesce(number_text("actual_cases"), F.lit("missing"))
    predicted = F.coalesce(number_text("predicted_cases"), F.lit("NA"))
    label = F.concat(
        F.lit("Reported cases = "),
        reported,
        F.lit("<br/>Predicted cases = "),
        predicted,
    )
    named = full.join(
        country_names.select("country_iso3c", "country_name"), "country_iso3c", "left"
    )
    derived = named.withColumns(
        {
            "yr": half_year_axis("report_year", "report_semester"),
            "disease_clean": title_case("disease"),
            "cases_coalesced": F.coalesce("actual_cases", "predicted_cases"),
            "label": label,
        }
    )
    return never_reported_override(derived)


def presence_long(view: DataFrame) -> DataFrame:
    """Predicted and reported presence per cell, as Missing, Present or Absent."""
    wide = view.select(
        "disease",
        "country_iso3c",
        "yr",
        F.col("predicted_status").alias("Predicted"),
        F.col("actual_status").alias("Reported"),
    )
    long = wide.unpivot(
        ["disease", "country_iso3c", "yr"], ["Predicted", "Reported"], "type", "value"
    )
    return long.withColumn("missing", three_state("value")).drop("value")


def timeline_long(summary: DataFrame) -> DataFrame:
    """Reported and predicted cases per period with a label naming both.

    The label needs both values of a period, which are still in one row before the
    table is turned long, so no grouping is needed.
    """
    reported, predicted = F.col("actual_cases"), F.col("predicted_cases")
    label = F.concat(
        F.lit("Reported: "),
        F.when(reported.isNull(), F.lit("Unknown")).otherwise(number_text(reported)),
        F.lit("<br/>Predicted: "),
        number_text(F.coalesce(predicted, F.lit(0.0))),
    )
    keys = ["country_iso3c", "disease", "yr", "label"]
    wide = summary.select(
        "country_iso3c",
        "disease",
        half_year_axis("report_year", "report_semester").alias("yr"),
        label.alias("label"),
        reported.cast("double").alias("Reported"),
        predicted.cast("double").alias("Predicted"),
    )
    long = wide.unpivot(keys, ["Reported", "Predicted"], "type", "cases")
    state = (
        F.when(F.col("cases").isNull(), F.lit("Missing"))
        .when(F.col("cases") > 0, F.lit("Present"))
        .when(F.col("cases") == 0, F.lit("Absent"))
    )
    shown = F.col("cases").isNull() | (F.col("cases") > 0)
    return long.select(
        *keys,
        "type",
        F.coalesce("cases", F.lit(0.0)).alias("cases"),
        shown.alias("presence"),
        state.alias("missing"),
    )


def map_view(
    view: DataFrame,
    disease: str,
    year: int,
    sem: int,
    map_countries: DataFrame,
    colors: DataFrame,
) -> DataFrame:
    """One disease and half-year for the map, with fill colours by status.

    ``map_countries`` is the drawn list (``country_iso3c``, any shape columns).
    """
    chosen = view.filter(
        (F.col("disease") == disease)
        & (F.col("report_year") == year)
        & (F.col("report_semester") == sem)
    )
    shaped = chosen.join(map_countries, "country_iso3c", "left")
    return shaped.join(colors, "status_coalesced", "left")


def probability_map_view(
    predictions: DataFrame, disease: str, month, map_countries: DataFrame
) -> DataFrame:
    """One disease and month of outbreak probabilities for the map."""
    chosen = predictions.filter((F.col("disease") == disease) & (F.col("month") == month))
    return chosen.join(map_countries, "country_iso3c", "left")


def query_predictions(
    predictions: DataFrame,
    columns: str | None = None,
    years: str | None = None,
    countries: str | None = None,
    limit: int | str | None = None,
    order: Sequence[str] = ("id",),
) -> DataFrame:
    """Filtered, projected and optionally limited predictions.

    Parameters are comma lists. Filters come before the projection, so they work on
    columns that are not asked for. A limit takes the first rows in ``order``.
    """
    out = predictions
    wanted_countries, wanted_years = split_list(countries), split_list(years)
    if wanted_countries:
        out = out.filter(F.col("country_iso3c").isin(wanted_countries))
    if wanted_years:
        out = out.filter(F.col("report_year").isin([int(y) for y in wanted_years]))
    if limit is not None:
        out = out.orderBy(*order).limit(int(limit))
    wanted = split_list(columns)
    return out.select(*wanted) if wanted else out


#: How predictions are stored for :func:`query_stored`.
CLUSTERED = {"by": ["country_iso3c"], "sort": ["country_iso3c", "report_year"]}


def query_stored(tables, name: str, countries: str | None = None, **params) -> DataFrame:
    """:func:`query_predictions` over a table stored with :data:`CLUSTERED`.

    Only files of the wanted countries are opened, and in them only the parts that may
    hold the wanted years.
    """
    wanted = split_list(countries)
    if not wanted:
        return query_predictions(tables.read(name), **params)
    keys = tables.spark.createDataFrame([(c,) for c in wanted], "country_iso3c string")
    return query_predictions(tables.read_keys(name, keys), countries=countries, **params)


class QueryCache:
    """Keeps query results by their arguments and the version they were read from.

    Results are written once to ``tables``, so they outlive the driver and the loss of
    executors. ``version`` names what ``predictions`` were read from, so that results of an
    earlier version never answer for a later one; :meth:`over` takes it from a stored table.
    At most ``most`` results are kept: the one that was used least recently goes, unless it
    was used within ``grace`` seconds, in which somebody may be reading it.
    """

    PREFIX = "query-"
    USES = "_uses"

    def __init__(
        self, predictions: DataFrame, tables, most: int = 256, version: object = "", grace: float = 3600
    ):
        self._predictions, self._tables, self._most = predictions, tables, most
        self._version, self._grace = str(version), grace

    @classmethod
    def over(cls, source, name: str, tables, **options) -> QueryCache:
        """A cache of queries over the newest version of a stored table."""
        newest = source.versions(name)[-1]
        return cls(source.read(name, newest), tables, version=f"{source.root}/{name}@{newest}", **options)

    def _name(self, params: dict) -> str:
        given = {k: str(v) for k, v in params.items() if v is not None}
        known = json.dumps([self._version, given], sort_keys=True)
        return self.PREFIX + hashlib.blake2b(known.encode(), digest_size=16).hexdigest()

    def _held(self) -> list[str]:
        return [n for n in self._tables.names() if n.startswith(self.PREFIX)]

    def _uses(self) -> Pointers:
        return Pointers(self._tables.spark, f"{self._tables.root}/{self.USES}")

    def get(self, cache: bool = True, **params) -> DataFrame:
        if not cache:
            return query_predictions(self._predictions, **params)
        name, uses = self._name(params), self._uses()
        held = self._tables.read_if_exists(name)
        uses.touch(name)
        if held is None:
            held = self._tables.overwrite(query_predictions(self._predictions, **params), name)
            self._evict(name)
        return held

    def _evict(self, keep: str, most: int | None = None) -> None:
        used = self._uses().touched()
        old = sorted((n for n in self._held() if n != keep), key=lambda n: used.get(n, 0))
        many = len(old) + (keep != "") - (self._most if most is None else most)
        for name in old[: max(0, many)]:
            if used.get(name, 0) <= (time.time() - self._grace) * 1000:
                self._tables.drop(name)
                self._uses().remove(f"{self._uses().path}/{name}")

    def clear(self) -> None:
        """Drop all results but those that somebody may be reading."""
        self._evict("", 0)
