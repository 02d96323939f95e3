"""View tables and the prediction query."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from panelspark.functions.status import STATUS_LEVELS
from panelspark.operators.joins import small_side
from panelspark.operators.rollup import nowcast_summary
from panelspark.operators.views import (
    CLUSTERED,
    QueryCache,
    map_view,
    never_reported_override,
    nowcast_view,
    presence_long,
    probability_map_view,
    query_predictions,
    query_stored,
    timeline_long,
)

from panelspark.session import stored

from .base import CELLS_SQL, predictions, query
from .rollup import ROLLUP_SQL, SUMMARY_SQL

# Nations with a key below 20 report; the map draws all of them.
REPORTING_SQL = f"""
{CELLS_SQL}, {ROLLUP_SQL}, {SUMMARY_SQL},
reporting AS (SELECT s.* FROM summary s JOIN nation ON n_name = country_iso3c
              WHERE n_regionkey <> 4),
absent AS (SELECT n_name AS country_iso3c FROM nation
           WHERE n_name NOT IN (SELECT country_iso3c FROM reporting)),
completed AS (
  SELECT country_iso3c, disease, report_year, report_semester, predicted_status, actual_status,
         predicted_cases, actual_cases, disease_status_unreported, status_coalesced
  FROM reporting
  UNION ALL
  SELECT country_iso3c, disease, report_year, report_semester, FALSE, NULL, 0, NULL, TRUE,
         'unreported, predicted absent'
  FROM absent CROSS JOIN (SELECT DISTINCT report_year FROM reporting)
  CROSS JOIN (SELECT DISTINCT report_semester FROM reporting)
  CROSS JOIN (SELECT DISTINCT disease FROM reporting)),
silence AS (
  SELECT *, report_year + (report_semester - 1) / 2.0 AS yr,
         coalesce(actual_cases, predicted_cases) AS cases_coalesced,
         CASE WHEN NOT bool_and(predicted_cases = 0) OVER w THEN FALSE
              WHEN count(*) OVER w > count(predicted_cases) OVER w THEN NULL ELSE TRUE END AS no_pred,
         CASE WHEN NOT bool_and(coalesce(actual_cases, predicted_cases) = 0) OVER w THEN FALSE
              WHEN count(*) OVER w > count(coalesce(actual_cases, predicted_cases)) OVER w THEN NULL
              ELSE TRUE END AS no_cases
  FROM completed WINDOW w AS (PARTITION BY country_iso3c, disease)),
viewed AS (
  SELECT country_iso3c, disease, report_year, report_semester, predicted_status, actual_status,
         predicted_cases, actual_cases, disease_status_unreported, CAST(yr AS DOUBLE) AS yr,
         cases_coalesced,
         CASE WHEN no_pred AND no_cases THEN 'never reported or predicted'
              WHEN NOT (no_pred AND no_cases) THEN status_coalesced END AS status_coalesced,
         upper(disease[1]) || disease[2:] AS disease_clean,
         'Name of ' || country_iso3c AS country_name,
         'Reported cases = ' || coalesce(CAST(CAST(actual_cases AS BIGINT) AS VARCHAR), 'missing')
         || '<br/>Predicted cases = '
         || coalesce(CAST(CAST(predicted_cases AS BIGINT) AS VARCHAR), 'NA') AS label
  FROM silence)
"""


def summary(d):
    return nowcast_summary(predictions(d)).drop("id", "status_rank")


def drawn(d):
    return d.nation.select(F.col("n_name").alias("country_iso3c"))


def view(d):
    reporting = d.nation.filter("n_regionkey <> 4").select(
        F.col("n_name").alias("country_iso3c")
    )
    rows = summary(d).join(reporting, "country_iso3c", "left_semi")
    names = drawn(d).withColumn(
        "country_name", F.concat(F.lit("Name of "), "country_iso3c")
    )
    return nowcast_view(rows, drawn(d), names)


@query("cx11_nowcast_view", f"WITH {REPORTING_SQL} SELECT * FROM viewed")
def cx11_nowcast_view(d):
    return view(d)


@query(
    "wn6_never_reported",
    """WITH cells AS (
      SELECT c_custkey AS country_iso3c, o_orderpriority AS disease, o_orderkey,
             CASE WHEN o_totalprice > 490000 THEN 1.0 WHEN o_totalprice > 20000 THEN 0.0 END AS predicted_cases,
             CASE WHEN o_orderstatus = 'F' THEN 0.0 END AS actual_cases,
             o_orderstatus AS status_coalesced
      FROM orders JOIN customer ON o_custkey = c_custkey),
    k AS (SELECT *, CASE WHEN NOT bool_and(predicted_cases = 0) OVER w THEN FALSE
              WHEN count(*) OVER w > count(predicted_cases) OVER w THEN NULL ELSE TRUE END AS a,
            CASE WHEN NOT bool_and(coalesce(actual_cases, predicted_cases) = 0) OVER w THEN FALSE
              WHEN count(*) OVER w > count(coalesce(actual_cases, predicted_cases)) OVER w THEN NULL
              ELSE TRUE END AS b
          FROM cells WINDOW w AS (PARTITION BY country_iso3c, disease))
    SELECT o_orderkey, CASE WHEN a AND b THEN 'never reported or predicted'
                            WHEN NOT (a AND b) THEN status_coalesced END AS status_coalesced
    FROM k""",
)
def wn6_never_reported(d):
    price = F.col("o_totalprice")
    predicted = F.when(price > 490000, 1.0).when(price > 20000, 0.0)
    actual = F.when(F.col("o_orderstatus") == "F", 0.0)
    cells = d.orders.select(
        "o_orderkey",
        F.col("o_custkey").alias("country_iso3c"),
        F.col("o_orderpriority").alias("disease"),
        predicted.alias("predicted_cases"),
        F.coalesce(actual, predicted).alias("cases_coalesced"),
        F.col("o_orderstatus").alias("status_coalesced"),
    )
    return never_reported_override(cells).select("o_orderkey", "status_coalesced")


@query(
    "cx12_presence_long",
    f"""WITH {REPORTING_SQL}
    SELECT disease, country_iso3c, yr, type,
           CASE WHEN value IS NULL THEN 'Missing' WHEN value THEN 'Present' ELSE 'Absent' END AS missing
    FROM (SELECT disease, country_iso3c, yr, unnest(['Predicted', 'Reported']) AS type,
                 unnest([predicted_status, actual_status]) AS value FROM viewed)""",
)
def cx12_presence_long(d):
    return presence_long(view(d))


@query(
    "cx12_wn7_timeline_long",
    f"""WITH {CELLS_SQL}, {ROLLUP_SQL},
    t AS (SELECT country_iso3c, disease, CAST(report_year + (report_semester - 1) / 2.0 AS DOUBLE) AS yr,
                 'Reported: ' || coalesce(CAST(CAST(actual_cases AS BIGINT) AS VARCHAR), 'Unknown')
                 || '<br/>Predicted: ' || CAST(CAST(coalesce(predicted_cases, 0) AS BIGINT) AS VARCHAR)
                   AS label,
                 unnest(['Reported', 'Predicted']) AS type,
                 unnest([actual_cases, predicted_cases]) AS c FROM rolled)
    SELECT country_iso3c, disease, yr, label, type, coalesce(c, 0) AS cases,
           c IS NULL OR c > 0 AS presence,
           CASE WHEN c IS NULL THEN 'Missing' WHEN c > 0 THEN 'Present' WHEN c = 0 THEN 'Absent' END
             AS missing
    FROM t""",
)
def cx12_wn7_timeline_long(d):
    return timeline_long(summary(d))


COLORS = ["red", "pink", "blue", "lightblue", "grey"]
COLORS_SQL = ", ".join(f"('{s}', '{c}')" for s, c in zip(STATUS_LEVELS, COLORS))


@query(
    "cx13_map_view",
    f"""WITH {REPORTING_SQL}
    SELECT v.country_iso3c, v.status_coalesced, v.label, n_regionkey AS shape_id, fill_color
    FROM viewed v LEFT JOIN nation ON n_name = v.country_iso3c
    LEFT JOIN (VALUES {COLORS_SQL}) AS c(status, fill_color) ON status = v.status_coalesced
    WHERE disease = 'machinery' AND report_year = 1999 AND report_semester = 1""",
)
def cx13_map_view(d):
    shapes = d.nation.select(
        F.col("n_name").alias("country_iso3c"), F.col("n_regionkey").alias("shape_id")
    )
    pairs = list(zip(STATUS_LEVELS, COLORS))
    colors = d.spark.createDataFrame(pairs, "status_coalesced string, fill_color string")
    out = map_view(view(d), "machinery", 1999, 1, shapes, colors)
    return out.select(
        "country_iso3c", "status_coalesced", "label", "shape_id", "fill_color"
    )


@query(
    "cx13_probability_map_view",
    """SELECT o_orderkey, o_custkey AS country_iso3c, c_nationkey AS shape_id
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey
       WHERE o_orderpriority = '2-HIGH' AND date_trunc('month', o_orderdate) = DATE '1999-03-01'""",
)
def cx13_probability_map_view(d):
    rows = d.orders.select(
        "o_orderkey",
        F.col("o_custkey").alias("country_iso3c"),
        F.col("o_orderpriority").alias("disease"),
        F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "month"), "yyyy-MM-dd").alias(
            "month"
        ),
    )
    shapes = d.customer.select(
        F.col("c_custkey").alias("country_iso3c"), F.col("c_nationkey").alias("shape_id")
    )
    out = probability_map_view(rows, "2-HIGH", "1999-03-01", shapes)
    return out.drop("disease", "month")


def order_predictions(d):
    return d.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("country_iso3c"),
        F.year("o_orderdate").alias("report_year"),
        F.col("o_totalprice").alias("predicted_cases"),
        F.col("o_orderstatus").alias("disease_status"),
    )


ORDER_PREDICTIONS_SQL = """
p AS (SELECT o_orderkey AS id, o_orderpriority AS country_iso3c,
             CAST(extract(year FROM o_orderdate) AS INTEGER) AS report_year,
             o_totalprice AS predicted_cases, o_orderstatus AS disease_status FROM orders)
"""


@query(
    "cx14_query_predictions",
    f"""WITH {ORDER_PREDICTIONS_SQL}
    SELECT predicted_cases, disease_status FROM p
    WHERE report_year IN (1998, 2000) AND country_iso3c IN ('1-URGENT', '5-LOW')""",
)
def cx14_query_predictions(d):
    return query_predictions(
        order_predictions(d),
        columns="predicted_cases,disease_status",
        years="1998,2000",
        countries="1-URGENT,5-LOW",
    )


@query(
    "cx14_query_stored",
    f"""WITH {ORDER_PREDICTIONS_SQL}
    SELECT id, predicted_cases FROM p
    WHERE report_year IN (1998, 2000) AND country_iso3c IN ('1-URGENT', '5-LOW')""",
)
def cx14_query_stored(d):
    """The same query over a copy that is clustered for it."""
    tables = d.tables()
    tables.overwrite(order_predictions(d), "predictions", **CLUSTERED)
    wanted = {"columns": "id,predicted_cases", "years": "1998,2000", "countries": "1-URGENT,5-LOW"}
    return query_stored(tables, "predictions", **wanted)


@query(
    "cx15_query_cache_version",
    f"""WITH {ORDER_PREDICTIONS_SQL}
    SELECT id, predicted_cases * 2 AS predicted_cases FROM p WHERE country_iso3c = '3-MEDIUM'""",
)
def cx15_query_cache_version(d):
    """A re-score is never answered from what was kept before it."""
    tables, kept = d.tables(), d.tables()
    wanted = {"columns": "id,predicted_cases", "countries": "3-MEDIUM"}
    tables.overwrite(order_predictions(d), "predictions")
    QueryCache.over(tables, "predictions", kept).get(**wanted)
    twice = order_predictions(d).withColumn("predicted_cases", F.col("predicted_cases") * 2)
    tables.overwrite(twice, "predictions")
    return QueryCache.over(tables, "predictions", kept).get(**wanted)


@query(
    "so2_query_limit",
    f"""WITH {ORDER_PREDICTIONS_SQL}
    SELECT id, report_year FROM p WHERE report_year = 1999 ORDER BY id LIMIT 25""",
)
def so2_query_limit(d):
    return query_predictions(
        order_predictions(d), columns="id,report_year", years="1999", limit="25"
    )


@query(
    "cx15_query_cache",
    f"""WITH {ORDER_PREDICTIONS_SQL}
    SELECT id, predicted_cases FROM p WHERE country_iso3c = '3-MEDIUM'""",
)
def cx15_query_cache(d):
    tables = d.tables()
    wanted = {"columns": "id,predicted_cases", "countries": "3-MEDIUM"}
    QueryCache(order_predictions(d), tables).get(**wanted)
    # another process, which has nothing to compute the answer from
    return QueryCache(order_predictions(d).limit(0), tables).get(**wanted)


@query(
    "so3_last_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 10",
)
def so3_last_rows(d):
    newest = d.orders.orderBy(F.col("o_orderkey").desc()).limit(10)
    return newest.select("o_orderkey", "o_totalprice")


def ranked(ordered):
    """Rows of a sorted result with their place in it, from the order they are written in."""
    part, at = F.spark_partition_id().alias("part"), F.monotonically_increasing_id()
    rows = stored(ordered.select("*", part, at.bitwiseAND((1 << 33) - 1).alias("at")), "sorted")
    sizes = rows.groupBy("part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    return rows.join(small_side(starts), "part").select(
        *ordered.columns, (F.col("start") + F.col("at") + 1).alias("place")
    )


@query(
    "so1_multi_key_sort",
    """SELECT doc_id, lang, quality,
              row_number() OVER (ORDER BY lang NULLS LAST, quality DESC NULLS LAST, doc_id) AS place
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def so1_multi_key_sort(d):
    docs = d.documents.select("doc_id", "lang", "source").join(d.labels, "doc_id", "left")
    ordered = docs.orderBy(
        F.col("lang").asc_nulls_last(), F.col("quality").desc_nulls_last(), "doc_id"
    )
    return ranked(ordered.select("doc_id", "lang", "quality"))


@query(
    "so4_random_order",
    """SELECT c_custkey, TRUE AS repeats, TRUE AS other_seed_differs, TRUE AS shuffled
       FROM customer WHERE c_acctbal > 0""",
)
def so4_random_order(d):
    """Each customer, and whether its place is the same with the same seed again; whether
    most places differ with another seed, and from the order of keys."""
    rich = d.customer.filter("c_acctbal > 0").select("c_custkey")

    def places(name, *order):
        return ranked(rich.orderBy(*order)).withColumnRenamed("place", name)

    a, b, c = (places(n, F.rand(s)) for n, s in (("a", 7), ("b", 7), ("c", 8)))
    every = stored(a.join(b, "c_custkey").join(c, "c_custkey").join(places("k", "c_custkey"), "c_custkey"), "places")
    most = every.agg(F.avg((F.col("a") != F.col("c")).cast("int")), F.avg((F.col("a") != F.col("k")).cast("int"))).first()
    return every.select(
        "c_custkey",
        (F.col("a") == F.col("b")).alias("repeats"),
        F.lit(most[0] > 0.9).alias("other_seed_differs"),
        F.lit(most[1] > 0.9).alias("shuffled"),
    )
