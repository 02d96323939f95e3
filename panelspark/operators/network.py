"""Monthly outbreak status, one-hop exposure and logistic scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .grid import bounded_rows
from .joins import PART_ROWS, enrich, not_matching, small_side, weighted_join
from ..functions.nulls import sum_strict
from ..functions.numbers import percent_label
from ..functions.periods import month_start
from ..functions.status import CURRENT_OUTBREAK, NEVER_IN_COUNTRY, outbreak_flag
from ..functions.text import (
    EXPOSURE_DISPLAY_NAMES,
    recode,
    surrogate_id,
    title_case,
    variable_display_name,
)

FLAGS = ("outbreak_start", "outbreak_subsequent_month", "endemic")
SUFFIX = "_from_outbreaks"
CELL = ("country_iso3c", "disease", "month")
INTERCEPT = "(Intercept)"

# Fixed value: months an outbreak is taken to go on after its last report.
OPEN_MONTHS = 12


def month_status(
    events: DataFrame,
    as_of: dt.date,
    since: dt.date | None = None,
    keys: Sequence[str] = ("country_iso3c", "disease"),
    carried: Sequence[str] = (),
) -> DataFrame:
    """Monthly status per country and disease up to the month of ``as_of``.

    An event has ``start_date``, ``last_report_date``, ``resolved_date`` and
    ``endemic``. It is active from its start month to the month it was resolved in, or
    for twelve months after the last report if it was not. Without ``since`` only
    active months are listed, with it every month of every key. Starts and ends are swept
    in order per key, so that months are expanded once per key, not once per event.
    """
    keys = [*keys, *carried]
    last = F.trunc(F.lit(as_of), "month")
    start = month_start("start_date")
    open_end = F.add_months(month_start("last_report_date"), OPEN_MONTHS)
    end = F.least(F.coalesce(month_start("resolved_date"), open_end), last)
    spans = events.select(
        *keys,
        F.coalesce("endemic", F.lit(False)).alias("endemic"),
        start.alias("__start"),
        end.alias("__end"),
    ).filter("__start <= __end")
    # an event counts from its start month to the month before its end mark; marks of one
    # month are added up, so that a key has one row per month however many events it has
    def mark(month: Column, n: int, new: int) -> Column:
        parts = {"__month": month, "__n": F.lit(n), "__new": F.lit(new),
                 "__endemic": F.lit(n) * F.col("endemic").cast("int")}
        return F.struct(*[c.alias(name) for name, c in parts.items()])

    marks = spans.select(
        *keys, F.inline(F.array(mark(F.col("__start"), 1, 1), mark(F.add_months("__end", 1), -1, 0)))
    )
    turns = marks.groupBy(*keys, "__month").agg(*[F.sum(c).alias(c) for c in ("__n", "__new", "__endemic")])
    so_far = Window.partitionBy(*keys).orderBy("__month")
    runs = turns.select(
        *keys,
        "__month",
        "__new",
        F.sum("__n").over(so_far).alias("__active"),
        F.sum("__endemic").over(so_far).alias("__endemic"),
        F.lead("__month").over(so_far).alias("__next"),
    ).filter("__active > 0")
    months = runs.withColumn(
        "month", F.explode(F.expr("sequence(__month, add_months(__next, -1), interval 1 month)"))
    )
    first = F.col("month") == F.col("__month")
    begun = F.when(first, F.col("__new")).otherwise(0)
    active = months.select(
        *keys,
        "month",
        (begun > 0).alias("outbreak_start"),
        (F.col("__active") > begun).alias("outbreak_subsequent_month"),
        (F.col("__endemic") > 0).alias("endemic"),
    )
    if since is None:
        return active
    every = F.sequence(
        F.trunc(F.lit(since), "month"), last, F.expr("interval 1 month")
    )
    cells = events.select(*keys).distinct().withColumn("month", F.explode(every))
    filled = cells.join(active, [*keys, "month"], "left")
    return filled.fillna(False, list(FLAGS))


def combine_status(status: DataFrame) -> DataFrame:
    """One row per country, disease and month: a flag is set if any row sets it."""
    return status.groupBy(*CELL).agg(*[F.bool_or(f).alias(f) for f in FLAGS])


def affected_cells(changed: DataFrame, edges: DataFrame) -> DataFrame:
    """Cells whose score depends on changed status rows: their own, and those that the
    country has an edge to in that year."""
    own = changed.select(*CELL)
    sources = changed.select(
        F.col("country_iso3c").alias("country_origin"), "disease", "month",
        F.year("month").alias("year"),
    )
    reached = sources.join(
        edges.select("country_origin", "year", "country_destination").distinct(),
        ["country_origin", "year"],
    )
    there = reached.select(F.col("country_destination").alias("country_iso3c"), "disease", "month")
    return own.unionByName(there).distinct()


def active_origins(status: DataFrame) -> DataFrame:
    """Origin, disease and month of every outbreak under way."""
    return status.filter(outbreak_flag(*FLAGS)).select(
        F.col("country_iso3c").alias("country_origin"),
        "disease",
        "month",
        F.year("month").alias("year"),
    )


def exposure(
    status: DataFrame,
    edges: DataFrame,
    weights: Sequence[str],
    aggregate_origins: bool = True,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Edge weights arriving at each destination from origins with an outbreak.

    Edges (origin, destination, year, weights) meet active origins on origin and
    year only; the joined rows are those of the by-origin table. Edges are made unique
    first, which is cheap, so that the large by-origin rows need no grouping; totals
    are combined on the map side before they are shuffled. An origin and year with more
    than ``part_rows`` disease months is dealt over tasks by their number.
    """
    on = ["country_origin", "year"]
    unique = edges.groupBy(*on, "country_destination").agg(
        *[F.sum(w).alias(w + SUFFIX) for w in weights]
    )
    active = active_origins(status)
    met = weighted_join(active, unique, on, part_rows=part_rows)
    met = met.withColumnRenamed("country_destination", "country_iso3c")
    if not aggregate_origins:
        return met.drop("year")
    return met.groupBy(*CELL).agg(*[F.sum(w + SUFFIX).alias(w + SUFFIX) for w in weights])


def augment(
    status: DataFrame,
    edges: DataFrame,
    weights: Sequence[str],
    aggregate_origins: bool = True,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Status rows with exposure columns; no active origin means zero.

    With ``aggregate_origins=False`` there is one row per contributing origin, and one
    with a NULL origin for cells without any.
    """
    arriving = exposure(status, edges, weights, aggregate_origins, part_rows)
    joined = status.join(arriving, list(CELL), "left")
    return joined.fillna(0.0, [w + SUFFIX for w in weights])


def scale(df: DataFrame, scaling: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Centre and scale each variable by the model's (variable, mean, sd) table."""
    wanted = scaling.filter(F.col("variable").isin(list(variables)))
    rows = bounded_rows(wanted.select("variable", "mean", "sd"), len(variables))
    if rows is None:
        raise ValueError("a variable has more than one scaling row")
    by_name = {r["variable"]: r for r in rows}
    return df.withColumns(
        {
            v: (F.col(v) - F.lit(by_name[v]["mean"])) / F.lit(by_name[v]["sd"])
            for v in variables
            if v in by_name
        }
    )


def _linear(df: DataFrame, coefs: DataFrame, variables: Sequence[str]) -> DataFrame:
    """``__rel`` = sum of value times coefficient, NULL if any part is missing, and
    ``__base`` = the disease's intercept.

    Coefficients are turned to one row per disease, so data rows are neither
    multiplied by the number of variables nor grouped again.
    """
    columns = {v: f"__coef_{i}" for i, v in enumerate(variables)}
    wide = coefs.groupBy("disease").agg(
        *[
            F.max(F.when(F.col("variable") == v, F.col("coef"))).alias(c)
            for v, c in {**columns, INTERCEPT: "__base"}.items()
        ]
    )
    joined = df.join(small_side(wide), "disease", "left")
    total = reduce(lambda a, b: a + b, [F.col(v) * F.col(c) for v, c in columns.items()])
    return joined.withColumn("__rel", total).drop(*columns.values())


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def score_logit(
    df: DataFrame,
    coefs: DataFrame,
    variables: Sequence[str],
    out: str = "predicted_outbreak_probability",
) -> DataFrame:
    """Outbreak probability from the disease's coefficients."""
    linear = _linear(df, coefs, variables)
    score = F.col("__rel") + F.coalesce("__base", F.lit(0.0))
    return linear.withColumn(out, logistic(score)).drop("__rel", "__base")


def coefficient_table(wide: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Long coefficients with display names from one row per disease."""
    long = wide.select("disease", *[F.col(v).cast("double") for v in variables]).unpivot(
        "disease", list(variables), "variable", "coef"
    )
    return label_coefficients(long)


def variable_importance(
    df: DataFrame,
    coefs: DataFrame,
    variables: Sequence[str],
    probability: str = "predicted_outbreak_probability",
    countries: DataFrame | None = None,
) -> DataFrame:
    """One row per cell and variable: value times coefficient, its sign, and labels.

    ``countries`` (``country_iso3c``, ``country_name``) adds the name of the country.
    """
    values = df.select(*CELL, probability, *[F.col(v).cast("double") for v in variables])
    long = values.unpivot([*CELL, probability], list(variables), "variable", "value")
    lookup = small_side(coefs.select("disease", "variable", "coef"))
    scored = long.join(lookup, ["disease", "variable"], "left")
    importance = F.col("value") * F.col("coef")
    if countries is not None:
        scored = enrich(scored, countries.select("country_iso3c", "country_name"), ["country_iso3c"])
    return scored.select(
        *CELL,
        *(["country_name"] if countries is not None else []),
        recode(title_case("variable"), EXPOSURE_DISPLAY_NAMES).alias("variable"),
        "value",
        "coef",
        importance.alias("variable_importance"),
        (importance > 0).alias("pos"),
        title_case("disease").alias("disease_name"),
        percent_label(probability).alias("probability_label"),
    )


def relative_imports(
    by_origin: DataFrame, coefs: DataFrame, variables: Sequence[str]
) -> DataFrame:
    """Strict sum over variables per destination, disease, month and origin."""
    known = by_origin.dropna(subset=["country_origin"])
    scored = _linear(known, coefs, variables)
    return scored.groupBy(*CELL, "country_origin").agg(
        sum_strict("__rel").alias("country_rel_import")
    )


def basemap_status(map_countries: DataFrame, predictions: DataFrame) -> DataFrame:
    """Mapped countries never scored or in outbreak now, with their category."""
    met = weighted_join(predictions, map_countries, ["country_iso3c"])
    alone = map_countries.join(predictions.select("country_iso3c"), "country_iso3c", "left_anti")
    cells = met.unionByName(alone, allowMissingColumns=True)
    cells = cells.select(*map_countries.columns, *[c for c in predictions.columns if c not in map_countries.columns])
    unscored = F.col("predicted_outbreak_probability").isNull()
    label = F.when(unscored, F.lit(NEVER_IN_COUNTRY)).otherwise(F.lit(CURRENT_OUTBREAK))
    flagged = cells.select(
        "*",
        unscored.alias("disease_country_combo_unreported"),
        outbreak_flag(*FLAGS).alias("reported_outbreak"),
        label.alias("cat_status"),
    )
    return flagged.filter("disease_country_combo_unreported or reported_outbreak")


def label_coefficients(coefs: DataFrame) -> DataFrame:
    """Long coefficients with the display names of disease and variable."""
    return coefs.withColumn("disease_clean", title_case("disease")).withColumn(
        "variable_clean", variable_display_name("variable")
    )


def export_weights(relative: DataFrame) -> DataFrame:
    """Contributions by origin: what each country passes on, in a total order's ranks."""
    return relative.withColumnRenamed("country_rel_import", "country_rel_export").select(
        "country_origin",
        "disease",
        "month",
        "country_iso3c",
        "country_rel_export",
        F.row_number().over(
            Window.partitionBy("country_origin", "disease", "month").orderBy(
                F.col("country_rel_export").desc_nulls_last(), "country_iso3c"
            )
        ).alias("export_rank"),
    )


def import_weights(relative: DataFrame, cells: DataFrame) -> DataFrame:
    """Relative imports of destinations that are not in outbreak already."""
    current = cells.filter(F.col("cat_status") == CURRENT_OUTBREAK).select(*CELL)
    return not_matching(relative, current.distinct(), CELL)


def top_origins(imports: DataFrame, n: int | None = None) -> DataFrame:
    """Origins with a positive contribution, ranked within each destination cell."""
    positive = imports.filter(F.col("country_rel_import") > 0)
    order = Window.partitionBy(*CELL).orderBy(
        F.col("country_rel_import").desc(), "country_origin"
    )
    ranked = positive.withColumn("import_rank", F.row_number().over(order))
    return ranked if n is None else ranked.filter(F.col("import_rank") <= n)


def predictions_by_origin(by_origin: DataFrame, predictions: DataFrame) -> DataFrame:
    """Disaggregated rows with their destination's probability."""
    known = predictions.select(*CELL, "predicted_outbreak_probability").distinct()
    joined = by_origin.join(known, list(CELL), "left")
    key = surrogate_id("country_iso3c", "country_origin", "disease", "month")
    return joined.select(key.alias("id"), "*")
