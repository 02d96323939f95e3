"""Grids, panels, imputation and carry-forward."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions.geo import geodesic_m, great_circle_m, raster_col, raster_row
from panelspark.operators.grid import ordered_pairs, product, spread, with_years
from panelspark.operators.joins import cell_lookup
from panelspark.operators.panel import (
    add_missing_countries,
    append_absent,
    carry_forward,
    fill_grid,
    interpolate,
    interpolate_long,
    next_half_years,
    pair_totals,
    static_panel,
    trade_panel,
    unpivot_values,
    yearly_panel,
)
from panelspark.plans.covariates import PAIR

from .base import CELLS_SQL, FLOWS_SQL, flows, predictions, query, rounded

FIRST, LAST, AS_OF = 1995, 2001, 2004

# A consignment is large if it holds at least 49 units at a discount of 9 % or more;
# pairs and years without one are the gaps of the panel.
LARGE_SQL = "CASE WHEN l_quantity >= 49 AND l_discount >= 0.09 THEN l_quantity END"


def large():
    big = (F.col("l_quantity") >= 49) & (F.col("l_discount") >= 0.09)
    return F.when(big, F.col("l_quantity"))


def nations(d):
    return d.nation.select(F.col("n_name").alias("country_iso3c"))


PAIRS_SQL = """
pairs AS (SELECT a.n_name AS country_origin, b.n_name AS country_destination
          FROM nation a JOIN nation b ON a.n_name <> b.n_name)
"""


def interpolated_sql(table: str, by: str, order: str, var: str, extra: str = "") -> str:
    """Gap imputation in SQL: nearest known value and position on either side."""
    return f"""
      SELECT {by}, {order}, {extra}
        round(coalesce(v, bv + (av - bv) * ((p - bp) / CAST(ap - bp AS DOUBLE)), bv, av), 6) AS {var},
        v IS NULL AND (bv IS NOT NULL OR av IS NOT NULL) AS imputed_value
      FROM (
        SELECT *,
          last_value(v IGNORE NULLS) OVER back AS bv,
          last_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER back AS bp,
          first_value(v IGNORE NULLS) OVER ahead AS av,
          first_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER ahead AS ap
        FROM (SELECT *, CAST({var} AS DOUBLE) AS v,
                     row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS p
              FROM {table})
        WINDOW back AS (PARTITION BY {by} ORDER BY p
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               ahead AS (PARTITION BY {by} ORDER BY p
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(
    "cx1_yearly_panel",
    f"""
    WITH {FLOWS_SQL}, {PAIRS_SQL},
    observed AS (SELECT country_origin, country_destination, year,
                        sum({LARGE_SQL}) AS n_heads
                 FROM flows GROUP BY ALL),
    panel AS (SELECT p.*, y.year, o.n_heads
              FROM pairs p CROSS JOIN (SELECT unnest(range({FIRST}, {LAST + 1}))::INTEGER AS year) y
              LEFT JOIN observed o USING (country_origin, country_destination, year))
    {interpolated_sql("panel", "country_origin, country_destination", "year", "n_heads",
                      "'shipments' AS source,")}
    """,
)
def cx1_yearly_panel(d):
    observed = flows(d).groupBy(*PAIR, "year").agg(F.sum(large()).alias("n_heads"))
    grid = with_years(ordered_pairs(nations(d)), FIRST, LAST)
    panel = yearly_panel(observed, grid, PAIR, "n_heads", "shipments")
    return panel.withColumn("n_heads", rounded("n_heads", 6))


PART_QUARTERS_SQL = f"""
cells AS (
  SELECT p_partkey, q.quarter, o.n_heads
  FROM part CROSS JOIN (SELECT unnest(range(0, {4 * (LAST - FIRST + 1)}))::INTEGER AS quarter) q
  LEFT JOIN (SELECT l_partkey AS p_partkey,
                    CAST((extract(year FROM l_shipdate) - {FIRST}) * 4
                         + extract(quarter FROM l_shipdate) - 1 AS INTEGER) AS quarter,
                    sum(l_quantity) AS n_heads
             FROM lineitem GROUP BY ALL) o USING (p_partkey, quarter))
"""


def part_quarters(d):
    quarter = (F.year("l_shipdate") - FIRST) * 4 + F.quarter("l_shipdate") - 1
    sold = d.lineitem.groupBy(
        F.col("l_partkey").alias("p_partkey"), quarter.alias("quarter")
    ).agg(F.sum("l_quantity").alias("n_heads"))
    keys = spread(d.part.select("p_partkey"), "p_partkey")
    grid = with_years(keys, 0, 4 * (LAST - FIRST + 1) - 1, "quarter")
    return fill_grid(sold, grid, ["p_partkey", "quarter"])


@query(
    "wn4_interpolate",
    f"WITH {PART_QUARTERS_SQL} {interpolated_sql('cells', 'p_partkey', 'quarter', 'n_heads')}",
)
def wn4_interpolate(d):
    out = interpolate(part_quarters(d), ["p_partkey"], ["quarter"], "n_heads")
    return out.withColumn("n_heads", rounded("n_heads", 6))


@query(
    "wn4_interpolate_long",
    f"WITH {PART_QUARTERS_SQL} {interpolated_sql('cells', 'p_partkey', 'quarter', 'n_heads')}",
)
def wn4_interpolate_long(d):
    out = interpolate_long(part_quarters(d), ["p_partkey"], "quarter", "n_heads", 8)
    return out.withColumn("n_heads", rounded("n_heads", 6))


@query(
    "jn3_fill_grid",
    f"""WITH {FLOWS_SQL}, {PAIRS_SQL}
    SELECT p.country_origin, p.country_destination, o.n_heads
    FROM pairs p LEFT JOIN (SELECT country_origin, country_destination,
                                   sum({LARGE_SQL}) AS n_heads
                            FROM flows GROUP BY ALL) o
    USING (country_origin, country_destination)""",
)
def jn3_fill_grid(d):
    observed = flows(d).groupBy(*PAIR).agg(F.sum(large()).alias("n_heads"))
    return fill_grid(observed, ordered_pairs(nations(d)), PAIR)


@query(
    "pr10_static_panel",
    f"""WITH {PAIRS_SQL},
    borders AS (SELECT a.n_name AS country_origin, b.n_name AS country_destination,
                       TRUE AS shared_border
                FROM nation a JOIN nation b
                ON a.n_regionkey = b.n_regionkey AND a.n_name <> b.n_name)
    SELECT p.*, coalesce(shared_border, FALSE) AS shared_border, 'regions' AS source
    FROM pairs p LEFT JOIN borders USING (country_origin, country_destination)""",
)
def pr10_static_panel(d):
    a = d.nation.select(F.col("n_name").alias("country_origin"), "n_regionkey")
    b = d.nation.select(F.col("n_name").alias("country_destination"), "n_regionkey")
    same = a.join(b, "n_regionkey").filter("country_origin <> country_destination")
    borders = same.select(*PAIR, F.lit(True).alias("shared_border"))
    grid = ordered_pairs(nations(d))
    return static_panel(borders, grid, PAIR, "regions", {"shared_border": False})


@query(
    "jn8_ordered_pairs",
    """SELECT a.c_mktsegment || '/' || CAST(a.c_nationkey AS VARCHAR) AS country_origin,
              b.c_mktsegment || '/' || CAST(b.c_nationkey AS VARCHAR) AS country_destination
       FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer) a
       JOIN (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer) b
       ON (a.c_mktsegment, a.c_nationkey) <> (b.c_mktsegment, b.c_nationkey)""",
)
def jn8_ordered_pairs(d):
    code = F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string"))
    return ordered_pairs(d.customer.select(code.alias("country_iso3c")))


@query(
    "jn9_cross_keys",
    """SELECT * FROM (SELECT DISTINCT o_orderpriority FROM orders)
       CROSS JOIN (SELECT DISTINCT o_orderstatus FROM orders)
       CROSS JOIN (SELECT DISTINCT p_type, p_brand FROM part)
       CROSS JOIN (SELECT DISTINCT CAST(extract(year FROM l_shipdate) AS INTEGER) AS year
                   FROM lineitem)""",
)
def jn9_cross_keys(d):
    out = d.part.select("p_type", "p_brand").distinct()
    out = product(out, d.orders.select("o_orderpriority").distinct())
    out = product(out, d.orders.select("o_orderstatus").distinct())
    return product(out, d.lineitem.select(F.year("l_shipdate").alias("year")).distinct())


@query(
    "jn9_cross_keys_long_axis",
    """SELECT * FROM (SELECT DISTINCT p_brand FROM part)
       CROSS JOIN (SELECT DISTINCT o_orderdate::DATE::VARCHAR AS o_day FROM orders)""",
)
def jn9_cross_keys_long_axis(d):
    days = d.orders.select(F.col("o_orderdate").cast("date").cast("string").alias("o_day"))
    brands = d.part.select("p_brand").distinct()
    return product(brands, days.distinct())


LONG_SQL = f"""
wide AS (SELECT country_origin, country_destination, year,
                CAST(sum({LARGE_SQL}) AS DOUBLE) AS heads_cattle,
                CAST(sum(CASE WHEN l_discount < 0.02 THEN round(l_extendedprice) END) AS DOUBLE)
                  AS heads_swine,
                CAST(sum(CASE WHEN l_quantity = 1 THEN 1 END) AS DOUBLE) AS heads_goats
         FROM flows WHERE country_origin <> country_destination GROUP BY ALL),
long AS (SELECT country_origin, country_destination, year, name, value
         FROM wide CROSS JOIN LATERAL (VALUES ('heads_cattle', heads_cattle),
              ('heads_swine', heads_swine), ('heads_goats', heads_goats)) AS v(name, value)),
zeroed AS (SELECT country_origin, country_destination, year, name,
                  coalesce(value, 0) AS value, value IS NULL AS gap FROM long),
latest AS (SELECT * FROM zeroed WHERE year >= (SELECT max(year) - 1 FROM zeroed)
           QUALIFY row_number() OVER (PARTITION BY country_origin, country_destination, name
                                      ORDER BY year DESC, value DESC) = 1),
carried AS (SELECT country_origin, country_destination,
                   CAST(unnest(range(year + 1, {AS_OF + 1})) AS INTEGER) AS year, name, value
            FROM latest)
"""

MEASURES = ["heads_cattle", "heads_swine", "heads_goats"]


def wide(d):
    """Bilateral totals; carrying forward reads them several times."""
    return d.stored("wide", lambda: wide_totals(d))


def wide_totals(d):
    dollars = F.when(F.col("l_discount") < 0.02, F.round("l_extendedprice"))
    single = F.when(F.col("l_quantity") == 1, 1)
    traded = flows(d).filter("country_origin <> country_destination")
    return traded.groupBy(*PAIR, "year").agg(
        F.sum(large()).alias("heads_cattle"),
        F.sum(dollars).alias("heads_swine"),
        F.sum(single).cast("double").alias("heads_goats"),
    )


def trade_grid(d):
    return with_years(ordered_pairs(nations(d)), FIRST, AS_OF)


def items(d):
    rows = [("heads_cattle", "Cattle"), ("heads_swine", "Swine")]
    return d.spark.createDataFrame(rows, "name string, item string")


TRADE_SQL = f"""
trade AS (
  SELECT g.country_origin, g.country_destination, g.name, g.year,
         coalesce(r.value, 0) AS value, {{flag}} AS imputed_value,
         CASE g.name WHEN 'heads_cattle' THEN 'Cattle' WHEN 'heads_swine' THEN 'Swine' END AS item,
         'ledger' AS source
  FROM (SELECT * FROM pairs
        CROSS JOIN (SELECT CAST(unnest(range({FIRST}, {AS_OF + 1})) AS INTEGER) AS year)
        CROSS JOIN (VALUES ('heads_cattle'), ('heads_swine'), ('heads_goats')) AS n(name)) g
  LEFT JOIN (SELECT country_origin, country_destination, year, name, value, gap FROM zeroed
             UNION ALL
             SELECT country_origin, country_destination, year, name, value, TRUE FROM carried) r
  USING (country_origin, country_destination, year, name))
"""


@query(
    "cx2_trade_panel",
    f"WITH {FLOWS_SQL}, {PAIRS_SQL}, {LONG_SQL}, "
    f"{TRADE_SQL.format(flag='r.value IS NULL')} SELECT * FROM trade",
)
def cx2_trade_panel(d):
    return trade_panel(wide(d), trade_grid(d), MEASURES, AS_OF, "ledger", items(d))


@query(
    "cx2_trade_panel_origin_flag",
    f"WITH {FLOWS_SQL}, {PAIRS_SQL}, {LONG_SQL}, "
    f"{TRADE_SQL.format(flag='coalesce(r.gap, TRUE)')} SELECT * FROM trade",
)
def cx2_trade_panel_origin_flag(d):
    return trade_panel(
        wide(d), trade_grid(d), MEASURES, AS_OF, "ledger", items(d), flag="origin"
    )


@query(
    "ag1_pair_totals",
    f"WITH {FLOWS_SQL}, {PAIRS_SQL}, {LONG_SQL}, {TRADE_SQL.format(flag='FALSE')} "
    "SELECT year, country_origin, country_destination, sum(value) AS fao_livestock_heads "
    "FROM trade GROUP BY ALL",
)
def ag1_pair_totals(d):
    panel = trade_panel(wide(d), trade_grid(d), MEASURES, AS_OF, "ledger")
    return pair_totals(panel, "fao_livestock_heads")


@query(
    "se3_unpivot",
    f"WITH {FLOWS_SQL}, {LONG_SQL} SELECT * FROM long",
)
def se3_unpivot(d):
    return unpivot_values(wide(d), [*PAIR, "year"], MEASURES)


@query(
    "wn5_carry_forward",
    f"""WITH {FLOWS_SQL}, {LONG_SQL}
        SELECT country_origin, country_destination, year, name, value,
               TRUE AS imputed_value FROM carried""",
)
def wn5_carry_forward(d):
    long = unpivot_values(wide(d), [*PAIR, "year"], MEASURES).fillna(0.0, ["value"])
    return carry_forward(long, [*PAIR, "name"], "value", AS_OF)


@query(
    "wn8_next_half_years",
    """WITH last AS (SELECT max(CAST(extract(year FROM o_orderdate) AS INTEGER) * 2
                       + CASE WHEN extract(month FROM o_orderdate) < 7 THEN 0 ELSE 1 END) AS i
                     FROM orders)
       SELECT CAST((i + k) // 2 AS INTEGER) AS report_year,
              CAST((i + k) % 2 + 1 AS INTEGER) AS report_semester
       FROM last CROSS JOIN (VALUES (1), (2)) AS n(k)""",
)
def wn8_next_half_years(d):
    first = F.month("o_orderdate") < 7
    periods = d.orders.select(
        F.year("o_orderdate").alias("report_year"),
        F.when(first, 1).otherwise(2).alias("report_semester"),
    )
    return next_half_years(periods)


@query(
    "se5_append_absent",
    f"""WITH {CELLS_SQL},
    future AS (SELECT CAST((i + k) // 2 AS INTEGER) AS report_year,
                      CAST((i + k) % 2 + 1 AS INTEGER) AS report_semester
               FROM (SELECT max(report_year * 2 + report_semester - 1) AS i FROM predictions)
               CROSS JOIN (VALUES (1), (2)) AS n(k)),
    grid AS (SELECT * FROM (SELECT DISTINCT disease, disease_population, taxa FROM predictions)
             CROSS JOIN (SELECT DISTINCT country_iso3c FROM predictions)
             CROSS JOIN (SELECT DISTINCT report_year, report_semester FROM predictions
                         UNION SELECT * FROM future))
    SELECT country_iso3c, disease, report_year, report_semester, taxa, disease_population, cases,
           CASE WHEN disease_status THEN 'present' WHEN NOT disease_status THEN 'absent' END
             AS disease_status
    FROM predictions
    UNION ALL
    SELECT country_iso3c, disease, report_year, report_semester, taxa, disease_population,
           NULL, 'unreported'
    FROM grid WHERE NOT EXISTS (
      SELECT 1 FROM predictions p
      WHERE p.country_iso3c = grid.country_iso3c AND p.disease = grid.disease
        AND p.report_year = grid.report_year AND p.report_semester = grid.report_semester
        AND p.taxa = grid.taxa AND p.disease_population = grid.disease_population)""",
)
def se5_append_absent(d):
    status = F.when(F.col("disease_status"), "present").when(
        ~F.col("disease_status"), "absent"
    )
    rows = predictions(d).withColumn("disease_status", status)
    return append_absent(rows.drop("predicted_cases", "disease_status_unreported"))


@query(
    "se6_add_missing_countries",
    """WITH summary AS (
      SELECT DISTINCT s_name AS country_iso3c,
             CAST(extract(year FROM l_shipdate) AS INTEGER) AS report_year,
             CAST(extract(quarter FROM l_shipdate) AS INTEGER) AS report_semester,
             l_returnflag AS disease, CAST(1 AS DOUBLE) AS predicted_cases
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0)
    SELECT *, NULL AS status_coalesced FROM summary
    UNION ALL
    SELECT * FROM (SELECT s_name FROM supplier EXCEPT SELECT country_iso3c FROM summary)
      CROSS JOIN (SELECT DISTINCT report_year FROM summary)
      CROSS JOIN (SELECT DISTINCT report_semester FROM summary)
      CROSS JOIN (SELECT DISTINCT disease FROM summary)
      CROSS JOIN (SELECT CAST(0 AS DOUBLE), 'unreported, predicted absent')""",
)
def se6_add_missing_countries(d):
    solvent = d.supplier.filter("s_acctbal > 0").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("country_iso3c")
    )
    summary = (
        d.lineitem.join(solvent, "l_suppkey")
        .select(
            "country_iso3c",
            F.year("l_shipdate").alias("report_year"),
            F.quarter("l_shipdate").alias("report_semester"),
            F.col("l_returnflag").alias("disease"),
        )
        .distinct()
        .withColumn("predicted_cases", F.lit(1.0))
        .withColumn("status_coalesced", F.lit(None).cast("string"))
    )
    everyone = d.supplier.select(F.col("s_name").alias("country_iso3c"))
    defaults = {
        "predicted_cases": 0.0,
        "status_coalesced": "unreported, predicted absent",
    }
    return add_missing_countries(summary, everyone, defaults)


# Coordinates made from keys: suppliers are spread over the globe.
POINT_SQL = "(s_suppkey * 37) % 160 - 80 + 0.25 AS lat, (s_suppkey * 101) % 350 - 175 + 0.5 AS lon"


def supplier_points(d):
    return d.supplier.select(
        "s_suppkey",
        ((F.col("s_suppkey") * 37) % 160 - 80 + F.lit(0.25)).alias("lat"),
        ((F.col("s_suppkey") * 101) % 350 - 175 + F.lit(0.5)).alias("lon"),
    )


NATION_POINT_SQL = (
    "SELECT n_name, (n_nationkey * 7) % 120 - 60 + 0.5 AS lat, "
    "(n_nationkey * 29) % 340 - 170 + 0.25 AS lon FROM nation"
)


def nation_points(d, end):
    return d.nation.select(
        F.col("n_name").alias(f"country_{end}"),
        ((F.col("n_nationkey") * 7) % 120 - 60 + F.lit(0.5)).alias(f"lat_{end}"),
        ((F.col("n_nationkey") * 29) % 340 - 170 + F.lit(0.25)).alias(f"lon_{end}"),
    )


def pair_points(d):
    pairs = ordered_pairs(nations(d))
    for end in ("origin", "destination"):
        pairs = pairs.join(nation_points(d, end), f"country_{end}")
    return pairs, ["lat_origin", "lon_origin", "lat_destination", "lon_destination"]


@query(
    "sc12_great_circle",
    f"""SELECT a.n_name AS country_origin, b.n_name AS country_destination,
      round(2 * 6371008.8 * asin(sqrt(least(1.0,
        pow(sin(radians(b.lat - a.lat) / 2), 2)
        + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))), 2)
        AS gc_dist_meters
    FROM ({NATION_POINT_SQL}) a JOIN ({NATION_POINT_SQL}) b ON a.n_name <> b.n_name""",
)
def sc12_great_circle(d):
    pairs, at = pair_points(d)
    return pairs.select(*PAIR, rounded(great_circle_m(*at), 2).alias("gc_dist_meters"))


@query(
    "sc12_geodesic",
    f"""WITH p AS (SELECT n_name, atan(tan(radians(lat)) * (1 - 1 / 298.257223563)) AS b,
                          radians(lon) AS l FROM ({NATION_POINT_SQL})),
    q AS (SELECT a.n_name AS country_origin, b.n_name AS country_destination,
                 (a.b + b.b) / 2 AS m, (b.b - a.b) / 2 AS h,
                 2 * asin(sqrt(least(1.0, pow(sin((b.b - a.b) / 2), 2)
                   + cos(a.b) * cos(b.b) * pow(sin((b.l - a.l) / 2), 2)))) AS s
          FROM p a JOIN p b ON a.n_name <> b.n_name)
    SELECT country_origin, country_destination,
      round(6378137.0 * (s - ((s - sin(s)) * pow(sin(m) * cos(h), 2) / pow(cos(s / 2), 2)
        + (s + sin(s)) * pow(cos(m) * sin(h), 2) / pow(sin(s / 2), 2))
        * (1 / 298.257223563) / 2), 2) AS gc_dist_meters
    FROM q""",
)
def sc12_geodesic(d):
    pairs, at = pair_points(d)
    return pairs.select(*PAIR, rounded(geodesic_m(*at), 2).alias("gc_dist_meters"))


@query(
    "sc3_raster_value",
    f"""WITH pts AS (SELECT s_suppkey, {POINT_SQL} FROM supplier),
    cells AS (SELECT CAST(floor((80.0 - lat) / 20.0) AS INTEGER) AS r,
                     CAST(floor((lon + 180.0) / 20.0) AS INTEGER) AS c,
                     CAST(sum(c_acctbal > 0) AS DOUBLE) AS bioclim
              FROM (SELECT c_acctbal, (c_custkey * 37) % 160 - 80 + 0.25 AS lat,
                           (c_custkey * 101) % 300 - 175 + 0.5 AS lon FROM customer)
              GROUP BY ALL)
    SELECT s_suppkey, CAST(floor((80.0 - lat) / 20.0) AS INTEGER) AS raster_row,
           CAST(floor((lon + 180.0) / 20.0) AS INTEGER) AS raster_col, bioclim
    FROM pts LEFT JOIN cells ON r = floor((80.0 - lat) / 20.0) AND c = floor((lon + 180.0) / 20.0)""",
)
def sc3_raster_value(d):
    def cell(df):
        return df.withColumn(
            "raster_row", raster_row("lat", F.lit(80.0), F.lit(20.0))
        ).withColumn("raster_col", raster_col("lon", F.lit(-180.0), F.lit(20.0)))

    on = ["raster_row", "raster_col"]
    located = d.customer.select(
        "c_acctbal",
        ((F.col("c_custkey") * 37) % 160 - 80 + F.lit(0.25)).alias("lat"),
        ((F.col("c_custkey") * 101) % 300 - 175 + F.lit(0.5)).alias("lon"),
    )
    cells = cell(located).groupBy(*on).agg(
        F.count_if(F.col("c_acctbal") > 0).cast("double").alias("bioclim")
    )
    points = cell(supplier_points(d))
    return cell_lookup(points, cells, on, "bioclim").select("s_suppkey", *on, "bioclim")
