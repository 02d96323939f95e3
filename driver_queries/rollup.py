"""NULL-aware aggregates, roll-ups and checks on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions import nulls
from panelspark.operators.joins import null_safe_join
from panelspark.operators.qa import (
    all_missing,
    cases_by_period_check,
    field_check,
    drop_empty_cols,
    ingestion_errors,
    known_counts,
    missing_first_report,
    new_above_total,
    outbreaks_by_period_check,
    reported_vs_calculated,
    schema_table,
    unexpected_errors,
)
from panelspark.operators.rollup import (
    bounds,
    event_totals,
    nowcast_summary,
    period_totals,
    rollup_cells,
    single_country,
    taxa_population,
    veterinarian_count,
)

from .base import CELLS_SQL, predictions, query, reports

# Labels cover part of the documents, so the rest have no label.
LABELLED_SQL = """
labelled AS (SELECT lang, source, toxic, quality, toxic = 1 AS is_toxic, n_chars
             FROM documents LEFT JOIN labels USING (doc_id))
"""


def labelled(d):
    docs = d.documents.select("doc_id", "lang", "source", "n_chars")
    return docs.join(d.labels, "doc_id", "left").withColumn(
        "is_toxic", F.col("toxic") == 1
    )


@query(
    "nulls_sums",
    f"""WITH {LABELLED_SQL}
    SELECT source, lang,
           CASE WHEN count(*) = count(quality) THEN CAST(sum(quality) AS BIGINT) END AS strict,
           CAST(sum(quality) AS BIGINT) AS known,
           CAST(coalesce(sum(quality), 0) AS BIGINT) AS zero
    FROM labelled GROUP BY ALL""",
)
def nulls_sums(d):
    return labelled(d).groupBy("source", "lang").agg(
        nulls.sum_strict("quality").alias("strict"),
        nulls.sum_known("quality").alias("known"),
        nulls.sum_or_zero("quality").alias("zero"),
    )


@query(
    "nulls_any_all",
    f"""WITH {LABELLED_SQL}
    SELECT source, lang, bool_or(is_toxic) AS any_known,
           CASE WHEN bool_or(is_toxic) THEN TRUE WHEN count(*) > count(is_toxic) THEN NULL
                ELSE FALSE END AS any_kleene,
           CASE WHEN NOT bool_and(is_toxic) THEN FALSE WHEN count(*) > count(is_toxic) THEN NULL
                ELSE TRUE END AS all_kleene
    FROM labelled GROUP BY ALL""",
)
def nulls_any_all(d):
    return labelled(d).groupBy("source", "lang").agg(
        nulls.any_known("is_toxic").alias("any_known"),
        nulls.any_kleene("is_toxic").alias("any_kleene"),
        nulls.all_kleene("is_toxic").alias("all_kleene"),
    )


@query(
    "ag2_taxa_population",
    f"""WITH {LABELLED_SQL}
    SELECT source, CASE WHEN lang IN ('es', 'fr') THEN 'es/fr' ELSE lang END AS taxa,
           CAST(coalesce(sum(toxic), 0) AS BIGINT) AS population
    FROM labelled GROUP BY ALL""",
)
def ag2_taxa_population(d):
    rows = labelled(d).withColumnsRenamed({"lang": "taxa", "toxic": "population"})
    return taxa_population(rows, ["source"], members=["es", "fr"], bucket="es/fr")


@query(
    "ag3_veterinarian_count",
    """SELECT c_nationkey AS country_iso3c, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year,
              CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN trunc(o_totalprice / 1000) END) AS BIGINT)
                AS veterinarian_count
       FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL""",
)
def ag3_veterinarian_count(d):
    text = (F.col("o_totalprice") / 1000).cast("string")
    count = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(text)
    buyers = d.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = d.orders.join(buyers, "o_custkey").select(
        F.col("c_nationkey").alias("country_iso3c"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("veterinarian_field"),
        count.alias("total_count"),
    )
    return veterinarian_count(rows, fields=["1-URGENT", "2-HIGH"])


ROLLUP_SQL = """
rolled AS (
  SELECT country_iso3c, disease, report_year, report_semester,
    CASE WHEN bool_or(predicted_cases > 0) THEN TRUE
         WHEN count(*) > count(predicted_cases) THEN NULL ELSE FALSE END AS predicted_status,
    bool_or(disease_status) AS actual_status,
    CASE WHEN count(*) = count(predicted_cases) THEN sum(predicted_cases) END AS predicted_cases,
    sum(cases) AS actual_cases,
    CASE WHEN NOT bool_and(disease_status_unreported) THEN FALSE
         WHEN count(*) > count(disease_status_unreported) THEN NULL ELSE TRUE END
      AS disease_status_unreported
  FROM predictions GROUP BY ALL)
"""

LABEL_SQL = """
CASE WHEN actual_status THEN 'reported present' WHEN NOT actual_status THEN 'reported absent'
     WHEN disease_status_unreported AND predicted_status THEN 'unreported, predicted present'
     WHEN disease_status_unreported AND NOT predicted_status THEN 'unreported, predicted absent'
END
"""

SUMMARY_SQL = f"""
summary AS (
  SELECT country_iso3c || disease || CAST(report_year AS VARCHAR)
         || CAST(report_semester AS VARCHAR) AS id, *,
         CASE {LABEL_SQL} WHEN 'reported present' THEN 1 WHEN 'unreported, predicted present' THEN 2
              WHEN 'reported absent' THEN 3 WHEN 'unreported, predicted absent' THEN 4 END
           AS status_rank,
         {LABEL_SQL} AS status_coalesced
  FROM rolled)
"""


@query("ag4_rollup_cells", f"WITH {CELLS_SQL}, {ROLLUP_SQL} SELECT * FROM rolled")
def ag4_rollup_cells(d):
    rows = predictions(d).withColumnsRenamed(
        {"cases": "actual_cases", "disease_status": "actual_status"}
    )
    return rollup_cells(rows)


@query(
    "cx10_nowcast_summary",
    f"WITH {CELLS_SQL}, {ROLLUP_SQL}, {SUMMARY_SQL} SELECT * FROM summary "
    "WHERE disease IN ('building', 'furniture', 'household')",
)
def cx10_nowcast_summary(d):
    return nowcast_summary(predictions(d), ["building", "furniture", "household"])


MEASURE_SQL = "susceptible cases deaths killed_and_disposed_of slaughtered".split()


def detail(d):
    """Line items as outbreak detail; measures are text, some unreadable or missing."""
    q, flag = F.col("l_quantity"), F.col("l_returnflag")
    return d.lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.when(flag != "N", flag).alias("species"),
        q.cast("string").alias("susceptible"),
        F.when(flag == "R", q.cast("string")).otherwise("n/a").alias("cases"),
        F.when(F.col("l_discount") > 0.05, q.cast("int").cast("string")).alias("deaths"),
        (q + F.lit(0.5)).cast("string").alias("killed_and_disposed_of"),
        F.lit("*").alias("slaughtered"),
    )


DETAIL_SQL = """
totals AS (
  SELECT l_orderkey AS id, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS species,
         CAST(sum(l_quantity) AS BIGINT) AS susceptible,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS BIGINT) AS cases,
         CAST(sum(CASE WHEN l_discount > 0.05 THEN l_quantity END) AS BIGINT) AS deaths,
         CAST(sum(trunc(l_quantity + 0.5)) AS BIGINT) AS killed_and_disposed_of,
         CAST(NULL AS BIGINT) AS slaughtered
  FROM lineitem GROUP BY ALL)
"""


@query("ag5_event_totals", f"WITH {DETAIL_SQL} SELECT * FROM totals")
def ag5_event_totals(d):
    return event_totals(detail(d))


@query(
    "cx16_reported_vs_calculated",
    f"""WITH {DETAIL_SQL},
    reported AS (SELECT l_orderkey AS id,
                        CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS species,
                        sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS s
                 FROM lineitem GROUP BY ALL),
    c AS (SELECT id, species, unnest(['susceptible', 'cases', 'deaths', 'killed_and_disposed_of',
                                      'slaughtered']) AS metric,
                 unnest([susceptible, cases, deaths, killed_and_disposed_of, slaughtered])
                   AS value_calculated FROM totals)
    SELECT c.id, c.species, metric, CAST(value_calculated AS DOUBLE) AS value_calculated,
           s AS value_reported
    FROM c JOIN reported r ON c.id = r.id AND c.species IS NOT DISTINCT FROM r.species
    WHERE value_calculated <> s""",
)
def cx16_reported_vs_calculated(d):
    flag = F.col("l_returnflag")
    filled = F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")))
    reported = d.lineitem.groupBy(
        F.col("l_orderkey").alias("id"), F.when(flag != "N", flag).alias("species")
    ).agg(filled.cast("string").alias("s"))
    measures = MEASURE_SQL
    given = reported.select(
        "id", "species", *[F.col("s").alias(f"total_{m}") for m in measures]
    )
    return reported_vs_calculated(detail(d), given)


# Annual reports: finished orders report by half-year, open ones for the whole year.
ANNUAL_SQL = """
annual AS (
  SELECT n_name AS country_iso3c, CAST(extract(year FROM o_orderdate) AS INTEGER) AS report_year,
         lower(c_mktsegment) AS disease,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS serotype,
         CASE WHEN o_orderstatus = 'O' THEN 'Jan-Dec'
              WHEN extract(month FROM o_orderdate) < 7 THEN 'Jan-Jun' ELSE 'Jul-Dec' END
           AS report_months,
         CASE WHEN o_totalprice > 300000 THEN 2 WHEN o_totalprice > 100000 THEN 1 END
           AS new_outbreaks,
         CASE WHEN o_totalprice < 400000 THEN 1 END AS total_outbreaks
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def annual(d):
    price, taxa = F.col("o_totalprice"), F.col("taxa")
    half = F.when(F.col("report_semester") == 1, "Jan-Jun").otherwise("Jul-Dec")
    months = F.when(F.col("disease_population") == "O", "Jan-Dec").otherwise(half)
    return reports(d).select(
        "country_iso3c",
        "report_year",
        "disease",
        F.when(taxa != "5-LOW", taxa).alias("serotype"),
        months.alias("report_months"),
        F.when(price > 300000, 2).when(price > 100000, 1).alias("new_outbreaks"),
        F.when(price < 400000, 1).alias("total_outbreaks"),
    )


@query(
    "ag6_period_totals",
    f"""WITH {ANNUAL_SQL}
    SELECT country_iso3c, report_year, disease, serotype,
      CAST(sum(CASE WHEN report_months <> 'Jan-Dec' THEN new_outbreaks END) AS DOUBLE) AS new_half,
      CAST(sum(CASE WHEN report_months = 'Jan-Dec' THEN new_outbreaks END) AS DOUBLE) AS new_year
    FROM annual GROUP BY ALL""",
)
def ag6_period_totals(d):
    keys = ["country_iso3c", "report_year", "disease", "serotype"]
    return period_totals(annual(d), keys, {"new_outbreaks": ("new_half", "new_year")})


PERIOD_SQL = """
half AS (SELECT country_iso3c, report_year, disease, serotype,
                CAST(sum(new_outbreaks) AS DOUBLE) AS sum_new_outbreaks_sem,
                CAST(sum(total_outbreaks) AS DOUBLE) AS sum_total_outbreaks_sem
         FROM annual WHERE report_months <> 'Jan-Dec' GROUP BY ALL),
whole AS (SELECT country_iso3c, report_year, disease, serotype,
                 CAST(sum(new_outbreaks) AS DOUBLE) AS new_outbreaks_ann,
                 CAST(sum(total_outbreaks) AS DOUBLE) AS total_outbreaks_ann
          FROM annual WHERE report_months = 'Jan-Dec' GROUP BY ALL),
both_kinds AS (
  SELECT coalesce(h.country_iso3c, w.country_iso3c) AS country_iso3c,
         coalesce(h.report_year, w.report_year) AS report_year,
         coalesce(h.disease, w.disease) AS disease, coalesce(h.serotype, w.serotype) AS serotype,
         sum_new_outbreaks_sem, sum_total_outbreaks_sem, new_outbreaks_ann, total_outbreaks_ann
  FROM half h FULL JOIN whole w
    ON h.country_iso3c = w.country_iso3c AND h.report_year = w.report_year
   AND h.disease = w.disease AND h.serotype IS NOT DISTINCT FROM w.serotype)
"""


@query("jn6_full_null_safe_join", f"WITH {ANNUAL_SQL}, {PERIOD_SQL} SELECT * FROM both_kinds")
def jn6_full_null_safe_join(d):
    keys = ["country_iso3c", "report_year", "disease", "serotype"]

    def totals(df, names):
        sums = [F.sum(m).cast("double").alias(n) for m, n in names.items()]
        return df.groupBy(*keys).agg(*sums)

    whole = F.col("report_months") == "Jan-Dec"
    half = totals(
        annual(d).filter(~whole),
        {
            "new_outbreaks": "sum_new_outbreaks_sem",
            "total_outbreaks": "sum_total_outbreaks_sem",
        },
    )
    year = totals(
        annual(d).filter(whole),
        {"new_outbreaks": "new_outbreaks_ann", "total_outbreaks": "total_outbreaks_ann"},
    )
    return null_safe_join(half, year, keys, "full")


@query(
    "cx17_outbreaks_by_period",
    f"""WITH {ANNUAL_SQL}, {PERIOD_SQL}
    SELECT *, sum_total_outbreaks_sem >= total_outbreaks_ann AS total_outbreak_check,
           sum_new_outbreaks_sem = new_outbreaks_ann AS new_outbreak_check
    FROM both_kinds
    WHERE NOT (sum_total_outbreaks_sem >= total_outbreaks_ann)
       OR NOT (sum_new_outbreaks_sem = new_outbreaks_ann)""",
)
def cx17_outbreaks_by_period(d):
    return outbreaks_by_period_check(annual(d))


@query(
    "cx17_cases_by_period",
    f"""WITH {ANNUAL_SQL},
    hosts AS (SELECT country_iso3c, report_year, disease, report_months, new_outbreaks AS cases,
                     serotype AS taxa FROM annual),
    half AS (SELECT country_iso3c, report_year, disease, taxa,
                    CAST(sum(cases) AS DOUBLE) AS sum_cases_sem
             FROM hosts WHERE report_months <> 'Jan-Dec' GROUP BY ALL),
    whole AS (SELECT country_iso3c, report_year, disease, taxa,
                     CAST(sum(cases) AS DOUBLE) AS cases_ann
              FROM hosts WHERE report_months = 'Jan-Dec' GROUP BY ALL)
    SELECT h.*, cases_ann, FALSE AS cases_check
    FROM half h JOIN whole w
      ON h.country_iso3c = w.country_iso3c AND h.report_year = w.report_year
     AND h.disease = w.disease AND h.taxa IS NOT DISTINCT FROM w.taxa
    WHERE NOT (sum_cases_sem >= cases_ann)""",
)
def cx17_cases_by_period(d):
    hosts = annual(d).withColumnsRenamed({"serotype": "taxa", "new_outbreaks": "cases"})
    keys = ["country_iso3c", "report_year", "disease", "taxa"]
    return cases_by_period_check(hosts, keys)


@query(
    "cx18_new_above_total",
    f"""WITH {ANNUAL_SQL} SELECT * FROM annual
        WHERE new_outbreaks IS NOT NULL AND total_outbreaks IS NOT NULL
          AND new_outbreaks > total_outbreaks""",
)
def cx18_new_above_total(d):
    return new_above_total(annual(d))


def ingest_log(d):
    """Events as an ingest log: views failed to fetch, errors failed to parse."""
    kind = F.col("event_type")
    return d.events.select(
        F.col("event_id").alias("report"),
        F.col("user_id").alias("country_iso3c"),
        (~kind.isin("view", "error")).alias("in_database"),
        F.when(kind == "view", "failed to fetch")
        .when(kind == "error", "ingestion error: parse")
        .alias("ingest_error"),
    )


LOG_SQL = """
log AS (SELECT event_id AS report, user_id AS country_iso3c,
               event_type NOT IN ('view', 'error') AS in_database,
               CASE event_type WHEN 'view' THEN 'failed to fetch'
                               WHEN 'error' THEN 'ingestion error: parse' END AS ingest_error
        FROM events)
"""


@query(
    "cx18_unexpected_errors",
    f"""WITH {LOG_SQL} SELECT * FROM log
        WHERE NOT in_database AND ingest_error NOT LIKE '%failed to fetch%'""",
)
def cx18_unexpected_errors(d):
    return unexpected_errors(ingest_log(d))


@query(
    "cx18_ingestion_errors",
    f"WITH {LOG_SQL} SELECT * FROM log WHERE ingest_error LIKE '%ingestion error:%'",
)
def cx18_ingestion_errors(d):
    return ingestion_errors(ingest_log(d))


@query(
    "cx18_missing_first_report",
    """SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def cx18_missing_first_report(d):
    docs = d.documents.select("doc_id", "source").join(d.labels, "doc_id", "left")
    return missing_first_report(docs, "quality").select("doc_id", "source")


@query(
    "cx18_all_missing",
    f"""WITH {LOG_SQL}
    SELECT *, NULL AS reported FROM log WHERE NOT in_database
    UNION ALL
    SELECT c_custkey, c_nationkey, NULL, NULL, FALSE FROM customer WHERE c_acctbal <= 0""",
)
def cx18_all_missing(d):
    listing = d.customer.select(
        F.col("c_custkey").alias("report"),
        F.col("c_nationkey").cast("long").alias("country_iso3c"),
        (F.col("c_acctbal") > 0).alias("reported"),
    )
    return all_missing(ingest_log(d), listing)


@query(
    "ag7_distinct",
    """SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities,
              (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)) AS pairs
       FROM orders""",
)
def ag7_distinct(d):
    pairs = d.orders.select("o_custkey", "o_orderpriority").distinct()
    return pairs.agg(
        F.count_distinct("o_custkey").alias("customers"),
        F.count_distinct("o_orderpriority").alias("priorities"),
        F.count(F.lit(1)).alias("pairs"),
    )


@query(
    "ag10_bounds",
    """SELECT min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice,
              min(o_orderkey) AS min_o_orderkey, max(o_orderkey) AS max_o_orderkey FROM orders""",
)
def ag10_bounds(d):
    return bounds(d.orders, "o_totalprice", "o_orderkey")


@query(
    "ag11_single_country",
    """SELECT p_name || '/' || p_brand AS disease, count(DISTINCT s_nationkey) = 1
                AS disease_in_single_country
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
       GROUP BY ALL""",
)
def ag11_single_country(d):
    parts = d.part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws("/", "p_name", "p_brand").alias("disease"),
    )
    sellers = d.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("country_iso3c")
    )
    sold = d.lineitem.join(sellers, "l_suppkey").join(parts, "l_partkey")
    return single_country(sold)


@query(
    "sk12_schema_table",
    f"""WITH {LABELLED_SQL},
    orders_known AS (SELECT count(o_orderkey) AS o_orderkey, count(o_orderstatus) AS o_orderstatus
                     FROM orders),
    labelled_known AS (SELECT count(lang) AS lang, count(toxic) AS toxic FROM labelled)
    SELECT 'orders' AS table_name, unnest(['o_orderkey', 'o_orderstatus']) AS column_name,
           unnest([1, 2]) AS ordinal_position, unnest(['bigint', 'string']) AS data_type,
           unnest([o_orderkey, o_orderstatus]) AS n_known
    FROM orders_known
    UNION ALL
    SELECT 'labelled', unnest(['lang', 'toxic']), unnest([1, 2]), unnest(['string', 'int']),
           unnest([lang, toxic])
    FROM labelled_known""",
)
def sk12_schema_table(d):
    """Columns of two tables with the number of known values in each."""
    frames = {
        "orders": d.orders.select("o_orderkey", "o_orderstatus"),
        "labelled": labelled(d).select("lang", "toxic"),
    }
    counts = None
    for name, df in frames.items():
        long = known_counts(df).unpivot([], df.columns, "column_name", "n_known")
        long = long.withColumn("table_name", F.lit(name))
        counts = long if counts is None else counts.unionByName(long)
    out = schema_table(frames).join(counts, ["table_name", "column_name"])
    return out.drop("is_nullable")


@query(
    "sk12_drop_empty_cols",
    f"WITH {LABELLED_SQL} SELECT lang, source, toxic FROM labelled",
)
def sk12_drop_empty_cols(d):
    rows = labelled(d).select("lang", "source", "toxic")
    return drop_empty_cols(rows.withColumn("nothing", F.lit(None).cast("string")))


@query(
    "sk13_field_check",
    """SELECT * FROM (VALUES
         ('nation', 'r_name', 'in schema, not in database'),
         ('nation', 'n_name', 'in database, not in schema'),
         ('nation', 'n_nationkey', 'in database, not in schema'),
         ('nation', 'r_regionkey', 'in schema, not in database'))
       AS t(table_name, column_name, problem)""",
)
def sk13_field_check(d):
    """Columns of nations that hold a value, against those a region should have."""
    held = drop_empty_cols(d.nation.withColumn("n_comment", F.lit(None).cast("string")))
    wanted = d.region.withColumn("n_regionkey", F.lit(0))
    return field_check(
        schema_table({"nation": held}), schema_table({"nation": wanted})
    )
