"""Panels: filling a grid, imputing gaps, carrying values forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .grid import product, spread, with_values
from .joins import not_matching, null_safe_join, small_side
from ..functions.periods import half_index, index_semester, index_year
from ..session import stored

UNREPORTED = "unreported"


def fill_grid(data: DataFrame, grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every grid cell with its data; data outside the grid is left out."""
    return grid.join(data, list(keys), "left")


def _straight_line(var: Column, pos: Column, before: Column, after: Column) -> Column:
    """Value at ``pos`` on the line between the neighbours; ends stay flat."""
    share = (pos - before["pos"]) / (after["pos"] - before["pos"])
    inside = before["val"] + (after["val"] - before["val"]) * share
    return F.coalesce(var, inside, before["val"], after["val"])


def interpolate(
    df: DataFrame, by: Sequence[str], order: str | Sequence[str], var: str
) -> DataFrame:
    """Fill gaps of ``var`` along each series, linearly by row position.

    A series without values stays NULL and unflagged, one with a single value is
    constant, and gaps at the ends take the nearest value. Series are as long as the
    panel's time axis, so one series always fits one task; use
    :func:`interpolate_long` for series without that bound.
    """
    order = [order] if isinstance(order, str) else list(order)
    series = Window.partitionBy(*by).orderBy(*order)
    value = F.col(var).cast("double")
    known = F.when(
        value.isNotNull(),
        F.struct(F.col("__pos").alias("pos"), value.alias("val")),
    )
    back = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spec = ", ".join(f"`{c}`" for c in by), ", ".join(f"`{c}`" for c in order)
    # lead with IGNORE NULLS walks each series once; a frame that reaches to the end
    # of the series would be re-read for every row
    following = F.expr(
        "lead(__known, 1) IGNORE NULLS OVER "
        f"(PARTITION BY {spec[0]} ORDER BY {spec[1]})"
    )
    rest = [c for c in df.columns if c != var]
    filled = (
        df.withColumn("__pos", F.row_number().over(series))
        .withColumn("__known", known)
        .withColumn("__before", F.last("__known", ignorenulls=True).over(back))
        .withColumn("__after", following)
    )
    out = _straight_line(value, F.col("__pos"), F.col("__before"), F.col("__after"))
    return filled.select(
        *rest,
        out.alias(var),
        (value.isNull() & out.isNotNull()).alias("imputed_value"),
    )


def interpolate_long(
    df: DataFrame, by: Sequence[str], order: str, var: str, width: int
) -> DataFrame:
    """:func:`interpolate` for series of any length with a numeric ``order`` column.

    Each series is cut into blocks ``width`` wide on ``order``. A window runs within
    blocks; a second one over the block summaries carries row counts and the nearest
    known values across blocks, so a series is never held by a single task.
    """
    value = F.col(var).cast("double")
    by = list(by)
    blocks = df.withColumn("__block", F.floor(F.col(order) / F.lit(width)))
    inner = Window.partitionBy(*by, "__block").orderBy(order)
    known = F.when(
        value.isNotNull(), F.struct(F.col("__at").alias("pos"), value.alias("val"))
    )
    local = blocks.withColumn("__at", F.row_number().over(inner).cast("long"))
    local = local.withColumn("__known", known)

    summary = local.groupBy(*by, "__block").agg(
        F.count(F.lit(1)).alias("__rows"),
        F.min("__known").alias("__first"),
        F.max("__known").alias("__last"),
    )
    outer = Window.partitionBy(*by).orderBy("__block")
    up_to_here = outer.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def moved(known_at: Column) -> Column:
        at = (known_at["pos"] + F.col("__offset")).alias("pos")
        return F.when(known_at.isNotNull(), F.struct(at, known_at["val"].alias("val")))

    keys = ", ".join(f"`{c}`" for c in by)
    summary = (
        summary.withColumn("__offset", F.sum("__rows").over(up_to_here) - F.col("__rows"))
        .withColumn("__first", moved(F.col("__first")))
        .withColumn("__last", moved(F.col("__last")))
        .withColumn(
            "__left",
            F.expr(
                "lag(__last, 1) IGNORE NULLS OVER "
                f"(PARTITION BY {keys} ORDER BY __block)"
            ),
        )
        .withColumn(
            "__right",
            F.expr(
                "lead(__first, 1) IGNORE NULLS OVER "
                f"(PARTITION BY {keys} ORDER BY __block)"
            ),
        )
        .select(*by, "__block", "__offset", "__left", "__right")
    )
    back = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nearest = local.withColumn(
        "__before", F.last("__known", ignorenulls=True).over(back)
    ).withColumn(
        "__after",
        F.expr(
            "lead(__known, 1) IGNORE NULLS OVER "
            f"(PARTITION BY {keys}, __block ORDER BY `{order}`)"
        ),
    )
    joined = null_safe_join(nearest, summary, [*by, "__block"], "left")
    pos = F.col("__at") + F.col("__offset")
    before = F.coalesce(moved(F.col("__before")), F.col("__left"))
    after = F.coalesce(moved(F.col("__after")), F.col("__right"))
    out = _straight_line(value, pos, before, after)
    rest = [c for c in df.columns if c != var]
    return joined.select(
        *rest,
        out.alias(var),
        (value.isNull() & out.isNotNull()).alias("imputed_value"),
    )


def yearly_panel(
    data: DataFrame,
    grid: DataFrame,
    by: Sequence[str],
    var: str,
    source: str | None = None,
    time: Sequence[str] = ("year",),
) -> DataFrame:
    """Complete panel of one variable, gaps interpolated, the source named if given."""
    keys = [*by, *time]
    filled = fill_grid(data.select(*keys, var), grid.select(*keys), keys)
    out = interpolate(filled, by, time, var)
    return out if source is None else out.withColumn("source", F.lit(source))


def static_panel(
    data: DataFrame,
    grid: DataFrame,
    keys: Sequence[str],
    source: str | None = None,
    fill: dict | None = None,
) -> DataFrame:
    """Complete panel without time; gaps stay NULL unless a constant is given."""
    out = fill_grid(data, grid, keys)
    if fill:
        out = out.fillna(fill)
    return out if source is None else out.withColumn("source", F.lit(source))


def carry_forward(
    df: DataFrame, by: Sequence[str], value: str, as_of: int, year: str = "year"
) -> DataFrame:
    """Repeat each series' latest row for every later year up to ``as_of``.

    Only series with a row in the last two years of the whole table take part, and a
    series that already reaches ``as_of`` adds nothing.
    """
    newest = df.agg(F.max(year)).scalar()
    latest = Window.partitionBy(*by).orderBy(
        F.col(year).desc(), F.col(value).desc_nulls_last()
    )
    # row_number() = 1 keeps one row per series and task before the shuffle
    return (
        df.filter(F.col(year) >= newest - 1)
        .withColumn("__rank", F.row_number().over(latest))
        .filter("__rank = 1")
        .drop("__rank")
        .filter(F.col(year) < as_of)
        .withColumn(year, F.explode(F.sequence(F.col(year) + 1, F.lit(as_of))))
        .withColumn("imputed_value", F.lit(True))
    )


def unpivot_values(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    name: str = "name",
    value: str = "value",
) -> DataFrame:
    """Wide measures to one (name, value) row each, as doubles."""
    wide = df.select(*keys, *[F.col(m).cast("double").alias(m) for m in measures])
    return wide.unpivot(list(keys), list(measures), name, value)


def trade_panel(
    wide: DataFrame,
    grid: DataFrame,
    measures: Sequence[str],
    as_of: int,
    source: str,
    lookup: DataFrame | None = None,
    flag: str = "final",
    pair: Sequence[str] = ("country_origin", "country_destination"),
) -> DataFrame:
    """Long pair-year-item panel, carried forward to ``as_of`` and filled with zero.

    ``flag="final"`` marks only cells for which no row existed after carrying forward;
    ``flag="origin"`` also marks missing measures and carried values.
    """
    if flag not in ("final", "origin"):
        raise ValueError(f"unknown flag mode {flag!r}")
    series = [*pair, "name"]
    long = unpivot_values(wide, [*pair, "year"], measures)
    long = long.withColumn("imputed_value", F.col("value").isNull())
    long = long.fillna(0.0, ["value"])
    rows = long.unionByName(carry_forward(long, series, "value", as_of))
    cells = with_values(grid.select(*pair, "year"), "name", measures)
    panel = fill_grid(rows, cells, [*series, "year"])
    absent = F.col("value").isNull()
    kept = absent if flag == "final" else F.coalesce("imputed_value", F.lit(True))
    panel = panel.select(
        *series,
        "year",
        F.coalesce("value", F.lit(0.0)).alias("value"),
        kept.alias("imputed_value"),
    )
    if lookup is not None:
        panel = panel.join(small_side(lookup), "name", "left")
    return panel.withColumn("source", F.lit(source))


def pair_totals(
    panel: DataFrame,
    out: str,
    value: str = "value",
    keys: Sequence[str] = ("year", "country_origin", "country_destination"),
) -> DataFrame:
    """Bilateral totals over all items."""
    return panel.groupBy(*keys).agg(F.sum(value).alias(out))


def next_half_years(
    df: DataFrame, year: str = "report_year", sem: str = "report_semester"
) -> DataFrame:
    """The two half-years after the latest one in the table."""
    last = df.agg(F.max(half_index(year, sem)).alias("__last"))
    nxt = last.filter("__last is not null").select(
        F.explode(F.array(F.col("__last") + 1, F.col("__last") + 2)).alias("__i")
    )
    return nxt.select(
        index_year("__i").alias(year), index_semester("__i").alias(sem)
    )


def append_absent(
    reports: DataFrame,
    item: Sequence[str] = ("disease", "disease_population", "taxa"),
    country: str = "country_iso3c",
    year: str = "report_year",
    sem: str = "report_semester",
    status: str = "disease_status",
) -> DataFrame:
    """Add an ``unreported`` row for every item, country and half-year without one.

    The half-years are those reported plus the next two. All axes come from the distinct
    keys, which are stored, so the reports are read once for them and once for the rows.
    Per item and half-year the set of its countries is taken from the set of all: reported
    keys are shuffled, the grid of countries never is. A set holds each country once.
    """
    keys = [*item, country, sem, year]
    known = stored(reports.select(*keys).distinct(), "report-keys")
    periods = known.select(year, sem).distinct()
    future = next_half_years(known, year, sem).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in periods.schema]
    )
    # a struct, because collected sets pass over bare nulls
    place = F.collect_set(F.struct(country))
    items = spread(known.select(*item).distinct(), *item)
    cells = product(items, periods.unionByName(future).distinct())
    here = known.groupBy(*item, sem, year).agg(place.alias("__here"))
    cells = null_safe_join(cells, here, [*item, sem, year], "left")
    cells = product(cells, known.agg(place.alias("__all")))
    none = F.array().cast(cells.schema["__all"].dataType)
    missing = F.array_except("__all", F.coalesce("__here", none))
    absent = spread(cells.select(*item, sem, year, missing.alias("__missing")), *item, sem, year)
    absent = absent.select(*item, sem, year, F.inline("__missing"))
    return reports.unionByName(
        absent.withColumn(status, F.lit(UNREPORTED)), allowMissingColumns=True
    )


def add_missing_countries(
    summary: DataFrame,
    countries: DataFrame,
    defaults: dict,
    axes: Sequence[str] = ("report_year", "report_semester", "disease"),
    code: str = "country_iso3c",
) -> DataFrame:
    """Rows with default values for listed countries the summary does not hold.

    The axes come from the stored distinct keys, so the summary is read twice.
    """
    known = stored(summary.select(code, *axes).distinct(), "summary-keys")
    wanted = countries.select(code).dropna().distinct()
    cells = not_matching(wanted, known.select(code).distinct(), [code])
    for axis in axes:
        cells = product(cells, known.select(axis).distinct())
    for name, default in defaults.items():
        cells = cells.withColumn(name, F.lit(default))
    return summary.unionByName(cells, allowMissingColumns=True)
