"""Outbreak status, exposure, scoring and quarantine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelspark.operators.joins import lookup_right, salted_join
from panelspark.operators.network import (
    CELL,
    FLAGS,
    augment,
    basemap_status,
    coefficient_table,
    export_weights,
    import_weights,
    month_status,
    predictions_by_origin,
    relative_imports,
    scale,
    score_logit,
    top_origins,
    variable_importance,
)
from panelspark.operators.quarantine import (
    clean_disease_names,
    preprocess_events,
    split_unmodelled,
    split_unrecognized,
)
from panelspark.operators.rollup import single_country
from panelspark.plans import outbreak

from .base import FLOWS_SQL, flows, nation_of, query, reports

AS_OF = dt.date(2002, 3, 15)
SINCE = dt.date(1995, 1, 1)
WEIGHTS = ["shared_borders", "ots_trade_dollars", "fao_livestock_heads"]
VARIABLES = [f"{w}_from_outbreaks" for w in WEIGHTS]

# Orders as outbreak events of single customers: a filled order is resolved twenty days
# later, any other stays open; urgent ones are endemic.
CUSTOMER_EVENTS_SQL = """
ev AS (SELECT CAST(o_custkey AS VARCHAR) AS country_iso3c, o_orderpriority AS disease,
              o_orderdate::DATE AS start_date, o_orderdate::DATE + 40 AS last_report_date,
              CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE + 20 END AS resolved_date,
              o_orderpriority = '1-URGENT' AS endemic FROM orders)
"""

# One row per event and active month.
MONTHS_SQL = """
spans AS (SELECT *, date_trunc('month', start_date)::DATE AS s,
                 least(coalesce(date_trunc('month', resolved_date)::DATE,
                                (date_trunc('month', last_report_date) + INTERVAL 12 MONTH)::DATE),
                       DATE '2002-03-01') AS e FROM ev),
months AS (SELECT country_iso3c, disease, endemic, s,
                  unnest(generate_series(s, e, INTERVAL 1 MONTH))::DATE AS month FROM spans),
status AS (SELECT country_iso3c, disease, month, bool_or(month = s) AS outbreak_start,
                  bool_or(month <> s) AS outbreak_subsequent_month, bool_or(endemic) AS endemic
           FROM months GROUP BY ALL)
"""


def customer_events(d):
    day = F.col("o_orderdate").cast("date")
    return d.orders.select(
        F.col("o_custkey").cast("string").alias("country_iso3c"),
        F.col("o_orderpriority").alias("disease"),
        day.alias("start_date"),
        F.date_add(day, 40).alias("last_report_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(day, 20)).alias("resolved_date"),
        (F.col("o_orderpriority") == "1-URGENT").alias("endemic"),
    )


def month_text(df):
    return df.withColumn("month", F.date_format("month", "yyyy-MM-dd"))


STATUS_COLUMNS = "outbreak_start, outbreak_subsequent_month, endemic"


@query(
    "cx3_month_status",
    f"""WITH {CUSTOMER_EVENTS_SQL}, {MONTHS_SQL}
    SELECT country_iso3c, disease, CAST(month AS VARCHAR) AS month, {STATUS_COLUMNS} FROM status""",
)
def cx3_month_status(d):
    return month_text(month_status(customer_events(d), AS_OF))


# Nation-level events: one per order, closed after 0, 20 or 40 days by its state.
NATION_EVENTS_SQL = """
ev AS (SELECT n_name AS country_iso3c, lower(c_mktsegment) || '_' || substr(o_orderpriority, 1, 1) AS disease,
              o_orderdate::DATE AS start_date, o_orderdate::DATE AS last_report_date,
              o_orderdate::DATE + CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 20 ELSE 40 END
                AS resolved_date,
              o_totalprice > 499000 AS endemic
       FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey)
"""

FULL_STATUS_SQL = """
cells AS (SELECT country_iso3c, disease,
                 unnest(generate_series(DATE '1995-01-01', DATE '2002-03-01', INTERVAL 1 MONTH))::DATE
                   AS month
          FROM (SELECT DISTINCT country_iso3c, disease FROM ev)),
panel AS (SELECT c.*, coalesce(outbreak_start, FALSE) AS outbreak_start,
                 coalesce(outbreak_subsequent_month, FALSE) AS outbreak_subsequent_month,
                 coalesce(endemic, FALSE) AS endemic
          FROM cells c LEFT JOIN status USING (country_iso3c, disease, month))
"""

EDGES_SQL = """
edges AS (SELECT f.country_origin, f.country_destination, f.year,
                 max(CASE WHEN a.n_regionkey = b.n_regionkey THEN 1.0 ELSE 0.0 END)::DOUBLE
                   AS shared_borders,
                 sum(round(l_extendedprice)) AS ots_trade_dollars,
                 sum(l_quantity) AS fao_livestock_heads
          FROM flows f JOIN nation a ON a.n_name = f.country_origin
          JOIN nation b ON b.n_name = f.country_destination
          WHERE f.country_origin <> f.country_destination
          GROUP BY 1, 2, 3),
active AS (SELECT country_iso3c AS country_origin, disease, month,
                  CAST(extract(year FROM month) AS INTEGER) AS year
           FROM panel WHERE outbreak_start OR outbreak_subsequent_month OR endemic),
met AS (SELECT e.*, a.disease, a.month FROM active a JOIN edges e USING (country_origin, year)),
arriving AS (SELECT country_destination AS country_iso3c, disease, month,
                    sum(shared_borders) AS shared_borders_from_outbreaks,
                    sum(ots_trade_dollars) AS ots_trade_dollars_from_outbreaks,
                    sum(fao_livestock_heads) AS fao_livestock_heads_from_outbreaks
             FROM met GROUP BY ALL),
augmented AS (SELECT p.*, coalesce(shared_borders_from_outbreaks, 0) AS shared_borders_from_outbreaks,
                     coalesce(ots_trade_dollars_from_outbreaks, 0) AS ots_trade_dollars_from_outbreaks,
                     coalesce(fao_livestock_heads_from_outbreaks, 0)
                       AS fao_livestock_heads_from_outbreaks
              FROM panel p LEFT JOIN arriving USING (country_iso3c, disease, month))
"""

NETWORK_SQL = f"{FLOWS_SQL}, {NATION_EVENTS_SQL}, {MONTHS_SQL}, {FULL_STATUS_SQL}, {EDGES_SQL}"


def nation_events(d, *more):
    day = F.col("o_orderdate").cast("date")
    state = F.col("disease_population")
    days = F.when(state == "F", 0).when(state == "O", 20).otherwise(40)
    return reports(d).select(
        *more,
        "country_iso3c",
        F.concat("disease", F.lit("_"), F.substring("taxa", 1, 1)).alias("disease"),
        day.alias("start_date"),
        day.alias("last_report_date"),
        F.date_add(day, days).alias("resolved_date"),
        (F.col("o_totalprice") > 499000).alias("endemic"),
    )


def status_panel(d):
    """Monthly status, which origins, destinations and scores all start from."""
    return d.stored("status", lambda: month_status(nation_events(d), AS_OF, SINCE))


@query(
    "cx3_month_status_panel",
    f"""WITH {NATION_EVENTS_SQL}, {MONTHS_SQL}, {FULL_STATUS_SQL}
    SELECT country_iso3c, disease, CAST(month AS VARCHAR) AS month, {STATUS_COLUMNS} FROM panel""",
)
def cx3_month_status_panel(d):
    return month_text(status_panel(d))


def edges(d):
    """Yearly edges between nations."""
    return d.stored("edges", lambda: edge_totals(d))


def edge_totals(d):
    regions = d.nation.select("n_name", "n_regionkey")
    ends = {}
    for end in ("origin", "destination"):
        ends[end] = regions.select(
            F.col("n_name").alias(f"country_{end}"),
            F.col("n_regionkey").alias(f"region_{end}"),
        )
    same = F.col("region_origin") == F.col("region_destination")
    totals = (
        flows(d)
        .filter("country_origin <> country_destination")
        .groupBy("country_origin", "country_destination", "year")
        .agg(
            F.sum(F.round("l_extendedprice")).alias("ots_trade_dollars"),
            F.sum("l_quantity").alias("fao_livestock_heads"),
        )
    )
    return (
        totals.join(ends["origin"], "country_origin")
        .join(ends["destination"], "country_destination")
        .withColumn("shared_borders", F.when(same, 1.0).otherwise(0.0))
        .drop("region_origin", "region_destination")
    )


AUGMENTED = ", ".join(VARIABLES)


@query(
    "cx4_augment",
    f"""WITH {NETWORK_SQL}
    SELECT country_iso3c, disease, CAST(month AS VARCHAR) AS month, {STATUS_COLUMNS}, {AUGMENTED}
    FROM augmented""",
)
def cx4_augment(d):
    return month_text(augment(status_panel(d), edges(d), WEIGHTS))


BY_ORIGIN_SQL = """
by_origin AS (
  SELECT p.*, m.country_origin, coalesce(m.shared_borders, 0) AS shared_borders_from_outbreaks,
         coalesce(m.ots_trade_dollars, 0) AS ots_trade_dollars_from_outbreaks,
         coalesce(m.fao_livestock_heads, 0) AS fao_livestock_heads_from_outbreaks
  FROM panel p LEFT JOIN met m
    ON p.country_iso3c = m.country_destination AND p.disease = m.disease AND p.month = m.month)
"""


@query(
    "cx4_augment_by_origin",
    f"""WITH {NETWORK_SQL}, {BY_ORIGIN_SQL}
    SELECT country_iso3c, disease, CAST(month AS VARCHAR) AS month, country_origin, {AUGMENTED}
    FROM by_origin""",
)
def cx4_augment_by_origin(d):
    out = augment(status_panel(d), edges(d), WEIGHTS, aggregate_origins=False)
    return month_text(out.drop("outbreak_start", "outbreak_subsequent_month", "endemic"))


# A small model: three coefficients per disease, none for the household ones.
SCALING = [
    ("shared_borders_from_outbreaks", 1.5, 2.0),
    ("ots_trade_dollars_from_outbreaks", 250000.0, 500000.0),
    ("fao_livestock_heads_from_outbreaks", 200.0, 400.0),
]
SEGMENTS = {"automobile": 1, "building": 2, "furniture": 3, "machinery": 4}


def model(d):
    return d.stored("model", lambda: coefficients(d))


def coefficients(d):
    """Coefficients per disease from the segment's number and the priority's digit."""
    names = reports(d).select("disease", F.substring("taxa", 1, 1).alias("digit")).distinct()
    segment = F.lit(None).cast("int")
    for name, number in SEGMENTS.items():
        segment = F.when(F.col("disease") == name, number).otherwise(segment)
    numbered = names.withColumn("k", segment).filter("k is not null")
    digit = F.col("digit").cast("int")
    rows = F.array(
        F.struct(F.lit(VARIABLES[0]).alias("variable"), (F.col("k") / 8.0).alias("coef")),
        F.struct(F.lit(VARIABLES[1]).alias("variable"), ((3 - digit) / 4.0).alias("coef")),
        F.struct(F.lit(VARIABLES[2]).alias("variable"), (F.lit(-1) / 16.0).alias("coef")),
        F.struct(F.lit("(Intercept)").alias("variable"), F.lit(-2.0).alias("coef")),
    )
    return numbered.select(
        F.concat("disease", F.lit("_"), "digit").alias("disease"), F.inline(rows)
    )


MODEL_SQL = """
coefs AS (SELECT disease, k / 8.0 AS c1, (3 - digit) / 4.0 AS c2, -1 / 16.0 AS c3
          FROM (SELECT DISTINCT disease, CAST(right(disease, 1) AS INTEGER) AS digit,
                       CASE split_part(disease, '_', 1) WHEN 'automobile' THEN 1 WHEN 'building' THEN 2
                            WHEN 'furniture' THEN 3 WHEN 'machinery' THEN 4 END AS k FROM ev)
          WHERE k IS NOT NULL),
scored AS (SELECT a.*, round(1 / (1 + exp(-((shared_borders_from_outbreaks - 1.5) / 2.0 * c1
                    + (ots_trade_dollars_from_outbreaks - 250000.0) / 500000.0 * c2
                    + (fao_livestock_heads_from_outbreaks - 200.0) / 400.0 * c3 - 2.0))), 6)
                    AS predicted_outbreak_probability
           FROM augmented a LEFT JOIN coefs USING (disease))
"""


def scaling(d):
    return d.spark.createDataFrame(SCALING, "variable string, mean double, sd double")


def arriving(d):
    """By-origin rows, from which the totals are summed as well."""
    return d.stored(
        "arriving",
        lambda: augment(status_panel(d), edges(d), WEIGHTS, aggregate_origins=False),
    )


def scored(d, by_origin=False):
    if by_origin:
        rows = arriving(d).groupBy(*CELL, *FLAGS).agg(*[F.sum(v).alias(v) for v in VARIABLES])
    else:
        rows = augment(status_panel(d), edges(d), WEIGHTS)
    out = score_logit(scale(rows, scaling(d), VARIABLES), model(d), VARIABLES)
    return out.withColumn(
        "predicted_outbreak_probability", F.round("predicted_outbreak_probability", 6)
    )


@query(
    "cx5_scale",
    f"""WITH {NETWORK_SQL}
    SELECT country_iso3c, disease, CAST(month AS VARCHAR) AS month,
           round((shared_borders_from_outbreaks - 1.5) / 2.0, 6) AS shared_borders_from_outbreaks,
           round((ots_trade_dollars_from_outbreaks - 250000.0) / 500000.0, 6)
             AS ots_trade_dollars_from_outbreaks,
           round((fao_livestock_heads_from_outbreaks - 200.0) / 400.0, 6)
             AS fao_livestock_heads_from_outbreaks
    FROM augmented""",
)
def cx5_scale(d):
    out = scale(augment(status_panel(d), edges(d), WEIGHTS), scaling(d), VARIABLES)
    values = [F.round(v, 6).alias(v) for v in VARIABLES]
    return month_text(out.select("country_iso3c", "disease", "month", *values))


@query(
    "cx6_score_logit",
    f"""WITH {NETWORK_SQL}, {MODEL_SQL}
    SELECT country_iso3c, disease, CAST(month AS VARCHAR) AS month, predicted_outbreak_probability
    FROM scored""",
)
def cx6_score_logit(d):
    out = scored(d).select(
        "country_iso3c", "disease", "month", "predicted_outbreak_probability"
    )
    return month_text(out)


@query(
    "cx9_predictions_by_origin",
    f"""WITH {NETWORK_SQL}, {BY_ORIGIN_SQL}, {MODEL_SQL}
    SELECT b.country_iso3c || coalesce(b.country_origin, 'NA') || b.disease
             || CAST(b.month AS VARCHAR) AS id,
           b.country_iso3c, b.country_origin, b.disease, CAST(b.month AS VARCHAR) AS month,
           predicted_outbreak_probability
    FROM by_origin b LEFT JOIN scored USING (country_iso3c, disease, month)""",
)
def cx9_predictions_by_origin(d):
    out = predictions_by_origin(arriving(d), scored(d, by_origin=True)).select(
        "id",
        "country_iso3c",
        "country_origin",
        "disease",
        "month",
        "predicted_outbreak_probability",
    )
    return month_text(out)


RELATIVE_SQL = """
relative AS (SELECT country_iso3c, disease, month, country_origin,
                    round(shared_borders_from_outbreaks * c1 + ots_trade_dollars_from_outbreaks * c2
                          + fao_livestock_heads_from_outbreaks * c3, 4) AS country_rel_import
             FROM by_origin LEFT JOIN coefs USING (disease) WHERE country_origin IS NOT NULL)
"""


def relative(d):
    out = relative_imports(arriving(d), model(d), VARIABLES)
    return out.withColumn("country_rel_import", F.round("country_rel_import", 4))


@query(
    "ag8_relative_imports",
    f"""WITH {NETWORK_SQL}, {BY_ORIGIN_SQL}, {MODEL_SQL}, {RELATIVE_SQL}
    SELECT * REPLACE (CAST(month AS VARCHAR) AS month) FROM relative""",
)
def ag8_relative_imports(d):
    return month_text(relative(d))


BASEMAP_SQL = """
basemap AS (SELECT s.*, predicted_outbreak_probability IS NULL AS disease_country_combo_unreported,
                   outbreak_start OR outbreak_subsequent_month OR endemic AS reported_outbreak,
                   CASE WHEN predicted_outbreak_probability IS NULL THEN 'Disease never in country'
                        ELSE 'Current Outbreak' END AS cat_status
            FROM scored s
            WHERE predicted_outbreak_probability IS NULL OR outbreak_start
               OR outbreak_subsequent_month OR endemic)
"""


def basemap(d, by_origin=False):
    drawn = d.nation.select(F.col("n_name").alias("country_iso3c"))
    return basemap_status(drawn, scored(d, by_origin))


@query(
    "pr14_basemap_status",
    f"""WITH {NETWORK_SQL}, {MODEL_SQL}, {BASEMAP_SQL}
    SELECT country_iso3c, disease, CAST(month AS VARCHAR) AS month, cat_status,
           disease_country_combo_unreported, reported_outbreak FROM basemap""",
)
def pr14_basemap_status(d):
    out = basemap(d).select(
        "country_iso3c",
        "disease",
        "month",
        "cat_status",
        "disease_country_combo_unreported",
        "reported_outbreak",
    )
    return month_text(out)


@query(
    "cx8_import_weights",
    f"""WITH {NETWORK_SQL}, {BY_ORIGIN_SQL}, {MODEL_SQL}, {RELATIVE_SQL}, {BASEMAP_SQL}
    SELECT * REPLACE (CAST(month AS VARCHAR) AS month) FROM relative
    ANTI JOIN (SELECT * FROM basemap WHERE cat_status = 'Current Outbreak')
    USING (country_iso3c, disease, month)""",
)
def cx8_import_weights(d):
    return month_text(import_weights(relative(d), basemap(d, by_origin=True)))


@query(
    "so5_top_origins",
    f"""WITH {NETWORK_SQL}, {BY_ORIGIN_SQL}, {MODEL_SQL}, {RELATIVE_SQL}
    SELECT * REPLACE (CAST(month AS VARCHAR) AS month),
           CAST(row_number() OVER (PARTITION BY country_iso3c, disease, month
                ORDER BY country_rel_import DESC, country_origin) AS INTEGER) AS import_rank
    FROM relative WHERE country_rel_import > 0 QUALIFY import_rank <= 3""",
)
def so5_top_origins(d):
    return month_text(top_origins(relative(d), 3))


@query(
    "cx7_variable_importance",
    f"""WITH {NETWORK_SQL}, {MODEL_SQL},
    long AS (SELECT country_iso3c, disease, CAST(month AS VARCHAR) AS month, c1, c2, c3,
                    predicted_outbreak_probability AS p,
                    unnest(['Border Contact', 'Economic Trade', 'Livestock Imports']) AS variable,
                    unnest([shared_borders_from_outbreaks, ots_trade_dollars_from_outbreaks,
                            fao_livestock_heads_from_outbreaks]) AS value
             FROM scored LEFT JOIN coefs USING (disease)),
    labelled AS (SELECT *, CAST(CASE variable WHEN 'Border Contact' THEN c1 WHEN 'Economic Trade' THEN c2
                                ELSE c3 END AS DOUBLE) AS c,
                        CASE WHEN p = 0 THEN 0.0 ELSE
                          round(p * pow(10, 1 - floor(log10(p)))) / pow(10, 1 - floor(log10(p))) END AS s
                 FROM long)
    SELECT country_iso3c, lower(n_name) AS country_name, disease, month, variable,
           value, c AS coef, value * c AS variable_importance,
           value * c > 0 AS pos,
           upper(disease[1]) || split_part(disease, '_', 1)[2:] || ' ' || right(disease, 1)
             AS disease_name,
           regexp_replace(CAST(CAST(round(s * 100, 10) AS DECIMAL(28, 10)) AS VARCHAR), '\\.?0+$', '') || '%'
             AS probability_label
    FROM labelled JOIN nation ON n_name = country_iso3c""",
)
def cx7_variable_importance(d):
    names = d.nation.select(F.col("n_name").alias("country_iso3c"), F.lower("n_name").alias("country_name"))
    rows = augment(status_panel(d), edges(d), WEIGHTS)
    known = scored(d).select(*CELL, "predicted_outbreak_probability")
    rows = rows.join(known, list(CELL))
    return month_text(variable_importance(rows, model(d), VARIABLES, countries=names))


@query(
    "sc1_coefficient_table",
    """WITH w AS (SELECT lower(c_mktsegment) || '_' || CAST(c_nationkey AS VARCHAR) AS disease,
                         CAST(count(*) AS DOUBLE) AS n FROM customer GROUP BY ALL)
    SELECT disease, variable, coef,
           upper(disease[1]) || replace(disease, '_', ' ')[2:] AS disease_clean, variable_clean
    FROM (SELECT disease, n AS coef, unnest(['shared_borders_from_outbreaks',
              'fao_trade_live_animals_other', 'continentAfrica_other_x']) AS variable,
              unnest(['shared borders with country with existing outbreak', 'live animals (other)',
                      'Africa (other) x']) AS variable_clean
          FROM w)""",
)
def sc1_coefficient_table(d):
    name = F.concat(F.lower("c_mktsegment"), F.lit("_"), F.col("c_nationkey"))
    counts = d.customer.groupBy(name.alias("disease")).agg(F.count(F.lit(1)).alias("n"))
    variables = [
        "shared_borders_from_outbreaks",
        "fao_trade_live_animals_other",
        "continentAfrica_other_x",
    ]
    wide = counts.select("disease", *[F.col("n").alias(v) for v in variables])
    return coefficient_table(wide, variables)


# -- quarantine ----------------------------------------------------------------------

# Document sources as raw disease names: an unlabelled name list knows some of them, in
# other case and with blanks around.
NAMES_SQL = """
names AS (SELECT DISTINCT source AS raw, 'd' || right(source, 1) AS standard FROM documents
          WHERE source NOT LIKE '%7')
"""


def disease_names(d):
    known = d.documents.select("source").distinct().filter("source not like '%7'")
    return known.select(
        F.concat(F.lit(" "), F.upper("source"), F.lit(" ")).alias("disease_name"),
        F.concat(F.lit("d"), F.substring("source", -1, 1)).alias("disease_standard"),
    )


def document_events(d):
    return d.documents.select("doc_id", F.col("lang").alias("country_iso3c"),
                              F.col("source").alias("disease"))


@query(
    "jn10_clean_disease_names",
    f"""WITH {NAMES_SQL}
    SELECT doc_id, lang AS country_iso3c, standard AS disease, source AS disease_name_uncleaned
    FROM documents LEFT JOIN names ON source = raw""",
)
def jn10_clean_disease_names(d):
    return clean_disease_names(document_events(d), disease_names(d))


@query(
    "pr7_unrecognized",
    f"""WITH {NAMES_SQL}
    SELECT DISTINCT lang AS country_iso3c, source AS disease_name_uncleaned,
           CAST(NULL AS VARCHAR) AS disease, 'unrecognized disease' AS reason_for_exclusion
    FROM documents LEFT JOIN names ON source = raw WHERE standard IS NULL""",
)
def pr7_unrecognized(d):
    touched = document_events(d).select("country_iso3c", "disease").distinct()
    return split_unrecognized(clean_disease_names(touched, disease_names(d)))[1]


PROCESSED_SQL = f"""
{NAMES_SQL},
processed AS (SELECT doc_id, lang AS country_iso3c, source AS disease_name_uncleaned,
                     standard AS disease, quality = 1 AS disease_primary_taxa,
                     count(DISTINCT lang) OVER (PARTITION BY standard) = 1
                       AS disease_in_single_country
              FROM documents JOIN names ON source = raw LEFT JOIN labels USING (doc_id))
"""


def processed(d):
    cleaned = clean_disease_names(document_events(d), disease_names(d))
    flagged = cleaned.filter("disease is not null").join(d.labels, "doc_id", "left")
    rows = flagged.select(
        "doc_id",
        "country_iso3c",
        "disease_name_uncleaned",
        "disease",
        (F.col("quality") == 1).alias("disease_primary_taxa"),
    )
    return rows.join(single_country(rows), "disease")


def modelled(d):
    names = d.documents.select(
        F.concat(F.lit("d"), F.substring("source", -1, 1)).alias("disease")
    ).distinct()
    return names.filter("disease not in ('d3', 'd4')")


@query(
    "pr7_kept",
    f"""WITH {PROCESSED_SQL}
    SELECT doc_id, country_iso3c, disease_name_uncleaned, disease, disease_in_single_country
    FROM processed
    WHERE disease_primary_taxa AND NOT disease_in_single_country AND disease NOT IN ('d3', 'd4')""",
)
def pr7_kept(d):
    return split_unmodelled(processed(d), modelled(d), full=True)[0]


@query(
    "pr7_rejected",
    f"""WITH {PROCESSED_SQL}
    SELECT DISTINCT country_iso3c, disease_name_uncleaned, disease,
           'disease not in primary taxa' AS reason_for_exclusion
    FROM processed WHERE NOT disease_primary_taxa
    UNION ALL
    SELECT DISTINCT country_iso3c, disease_name_uncleaned, disease, 'disease in single country'
    FROM processed WHERE disease_primary_taxa AND disease_in_single_country
    UNION ALL
    SELECT DISTINCT country_iso3c, disease_name_uncleaned, disease,
           'disease not represented in model'
    FROM processed WHERE disease_primary_taxa AND NOT disease_in_single_country
      AND disease IN ('d3', 'd4')""",
)
def pr7_rejected(d):
    return split_unmodelled(processed(d), modelled(d), full=True)[1]


@query(
    "jn7_lookup_right",
    """SELECT p.doc_id, l.country_iso3c, l.disease, note
       FROM (SELECT DISTINCT lang AS country_iso3c,
                    CASE WHEN quality = 1 THEN source END AS disease, 'x' AS note
             FROM documents LEFT JOIN labels USING (doc_id)) l
       LEFT JOIN (SELECT doc_id, lang, CASE WHEN toxic = 0 THEN source END AS source
                  FROM documents LEFT JOIN labels USING (doc_id)) p
       ON l.country_iso3c = p.lang AND l.disease IS NOT DISTINCT FROM p.source""",
)
def jn7_lookup_right(d):
    docs = document_events(d).join(d.labels, "doc_id", "left")
    name = F.col("disease")
    wanted = docs.select(
        "country_iso3c", F.when(F.col("quality") == 1, name).alias("disease")
    ).distinct()
    rows = docs.select(
        "doc_id", "country_iso3c", F.when(F.col("toxic") == 0, name).alias("disease")
    )
    return lookup_right(rows, wanted.withColumn("note", F.lit("x")),
                        ["country_iso3c", "disease"])


# Events stored before June 2001 are history; later ones are new. Priority 5 has no
# standard name, priority 4 is not of primary taxa, priority 3 is not in the model.
PRIORITY_EVENTS_SQL = """
raw AS (SELECT CAST(o_custkey AS VARCHAR) AS country_iso3c, o_orderpriority AS name,
               CASE WHEN o_orderpriority <> '5-LOW' THEN 'p' || o_orderpriority[1] END AS disease,
               o_orderdate::DATE AS start_date, o_orderdate::DATE AS last_report_date,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE END AS resolved_date,
               FALSE AS endemic
        FROM orders WHERE o_totalprice > 20000),
touched AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS country_iso3c, o_orderpriority AS name
            FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01')
"""


def priority_events(d):
    day = F.col("o_orderdate").cast("date")
    return d.orders.select(
        F.col("o_orderkey").alias("report_id"),
        F.col("o_custkey").cast("string").alias("country_iso3c"),
        F.col("o_orderpriority").alias("disease"),
        day.alias("start_date"),
        day.alias("last_report_date"),
        F.when(F.col("o_orderstatus") == "F", day).alias("resolved_date"),
        F.lit(False).alias("endemic"),
        (F.col("o_totalprice") <= 20000).alias("is_aquatic"),
    )


def priority_lookups(d):
    every = d.orders.select(F.col("o_orderpriority").alias("disease_name")).distinct()
    standard = F.concat(F.lit("p"), F.substring("disease_name", 1, 1))
    names = every.filter("disease_name <> '5-LOW'").withColumn("disease_standard", standard)
    listed = names.select(F.col("disease_standard").alias("disease"))
    taxa = listed.withColumn("disease_primary_taxa", F.col("disease") != "p4")
    return names, taxa, listed.filter("disease <> 'p3'")


def preprocessed(d, full):
    rows = priority_events(d)
    recent = F.col("start_date") >= F.lit("2001-06-01").cast("date")
    names, taxa, in_model = priority_lookups(d)

    def expand(events):
        return month_status(events, AS_OF, carried=["disease_name_uncleaned"])

    return preprocess_events(
        rows.filter(recent),
        rows.filter(~recent),
        names,
        taxa,
        in_model,
        expand,
        full=full,
    )


PREPROCESSED_COLUMNS = (
    "country_iso3c, disease, name AS disease_name_uncleaned, CAST(month AS VARCHAR) AS month, "
    "outbreak_start, outbreak_subsequent_month, endemic"
)


def preprocess_sql(full: bool) -> str:
    source = "raw" if full else "raw SEMI JOIN touched USING (country_iso3c, name)"
    return f"""
    WITH {PRIORITY_EVENTS_SQL}, ev AS (SELECT * FROM {source} WHERE disease IS NOT NULL),
    {MONTHS_SQL}
    SELECT {PREPROCESSED_COLUMNS}
    FROM status JOIN (SELECT DISTINCT name, disease FROM raw) USING (disease)
    WHERE disease NOT IN ('p3', 'p4')"""


@query("cx22_preprocess_events", preprocess_sql(full=False))
def cx22_preprocess_events(d):
    return month_text(preprocessed(d, full=False)[0])


@query("cx22_preprocess_events_full", preprocess_sql(full=True))
def cx22_preprocess_events_full(d):
    return month_text(preprocessed(d, full=True)[0])


@query(
    "cx22_rejected",
    f"""WITH {PRIORITY_EVENTS_SQL},
    wanted AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS country_iso3c, o_orderpriority AS name
               FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01'),
    kept AS (SELECT DISTINCT country_iso3c, name FROM raw SEMI JOIN wanted USING (country_iso3c, name))
    SELECT country_iso3c, name AS disease_name_uncleaned, CAST(NULL AS VARCHAR) AS disease,
           'unrecognized disease' AS reason_for_exclusion
    FROM wanted WHERE name = '5-LOW'
    UNION ALL
    SELECT country_iso3c, name, 'p' || name[1],
           CASE name[1] WHEN '4' THEN 'disease not in primary taxa'
                        ELSE 'disease not represented in model' END
    FROM kept WHERE name[1] IN ('3', '4')""",
)
def cx22_rejected(d):
    return preprocessed(d, full=False)[1]


@query(
    "jn2_salted_join",
    """SELECT o_orderkey, o_orderpriority, c_mktsegment, n_name
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def jn2_salted_join(d):
    buyers = d.customer.select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"
    )
    placed = d.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    named = placed.join(buyers, "o_custkey")
    out = salted_join(named, nation_of(d, "c_nationkey", "n_name"), ["c_nationkey"], 16,
                      ["o_orderkey"])
    return out.select("o_orderkey", "o_orderpriority", "c_mktsegment", "n_name")


# -- whole scoring runs --------------------------------------------------------------

MODELLED_SQL = f"""
{NETWORK_SQL}, {MODEL_SQL},
stored AS (SELECT * FROM scored SEMI JOIN coefs USING (disease))
"""


def numbered_events(d):
    events = nation_events(d, F.col("o_orderkey").alias("report_id"))
    return events.withColumn("is_aquatic", F.lit(False))


def run_scores(d, tables, new, history, replaced=None):
    every = reports(d).select(
        F.concat("disease", F.lit("_"), F.substring("taxa", 1, 1)).alias("disease")
    ).distinct()
    return outbreak.score(
        tables,
        new,
        history,
        every.select(F.upper("disease").alias("disease_name"), F.col("disease").alias("disease_standard")),
        every.withColumn("disease_primary_taxa", F.lit(True)),
        model(d),
        scaling(d),
        edges(d),
        WEIGHTS,
        "v1",
        AS_OF,
        SINCE,
        replaced=replaced,
    )


def full_scores(d):
    tables = d.tables()
    run_scores(d, tables, None, d.stored("events", lambda: numbered_events(d)))
    return tables


def incremental_scores(d):
    """Scores after corrections of every kind, given what the reports said at first.

    Every 199th report was first known as still open, or with another disease, in another
    country, or as aquatic; some reports more turn out to be aquatic.
    """
    tables = d.tables()
    final = d.stored("events", lambda: numbered_events(d)).select(*outbreak.EVENT_COLUMNS)
    late, kind = F.col("report_id") % 199 == 0, F.floor(F.col("report_id") / 199) % 4
    ghosts = final.filter(F.col("report_id") % 199 == 1).withColumn("report_id", -F.col("report_id"))
    first = final.withColumns(
        {
            "resolved_date": F.when(~late | (kind != 0), F.col("resolved_date")),
            "disease": F.when(late & (kind == 1), F.lit("building_1")).otherwise(F.col("disease")),
            "country_iso3c": F.when(late & (kind == 2), F.lit("FRANCE")).otherwise(F.col("country_iso3c")),
            "is_aquatic": late & (kind == 3),
        }
    )
    first = tables.upsert(outbreak.EVENTS, first.unionByName(ghosts), ["report_id"], changes=True)
    run_scores(d, tables, None, first)
    new = final.filter(late).unionByName(ghosts.withColumn("is_aquatic", F.lit(True)))
    tables.upsert(outbreak.EVENTS, new, ["report_id"], changes=True)
    run_scores(d, tables, new, None, tables.before(outbreak.EVENTS))
    return tables


STORED_SQL = f"""
WITH {MODELLED_SQL}
SELECT country_iso3c || disease || CAST(month AS VARCHAR) AS id, country_iso3c, disease,
       CAST(month AS VARCHAR) AS month, {STATUS_COLUMNS}, predicted_outbreak_probability
FROM stored
"""


def stored_scores(tables):
    out = tables.read(outbreak.PREDICTIONS).select(
        "id",
        "country_iso3c",
        "disease",
        "month",
        "outbreak_start",
        "outbreak_subsequent_month",
        "endemic",
        F.round("predicted_outbreak_probability", 6).alias("predicted_outbreak_probability"),
    )
    return month_text(out)


@query("cx22_score_full", STORED_SQL)
def cx22_score_full(d):
    return stored_scores(full_scores(d))


@query("cx22_score_incremental", STORED_SQL)
def cx22_score_incremental(d):
    return stored_scores(incremental_scores(d))


STORED_RELATIVE_SQL = f"""
{NETWORK_SQL}, {BY_ORIGIN_SQL}, {MODEL_SQL}, {RELATIVE_SQL}, {BASEMAP_SQL},
known AS (SELECT * FROM relative SEMI JOIN coefs USING (disease))
"""


def stored_relative(d, tables):
    rows = relative_imports(tables.read(outbreak.BY_ORIGIN), model(d), VARIABLES)
    return rows.withColumn("country_rel_import", F.round("country_rel_import", 4))


@query(
    "cx8_import_weights_stored",
    f"""WITH {STORED_RELATIVE_SQL}
    SELECT * REPLACE (CAST(month AS VARCHAR) AS month) FROM known
    ANTI JOIN (SELECT * FROM basemap WHERE cat_status = 'Current Outbreak')
    USING (country_iso3c, disease, month)""",
)
def cx8_import_weights_stored(d):
    tables = full_scores(d)
    drawn = d.nation.select(F.col("n_name").alias("country_iso3c"))
    cells = basemap_status(drawn, tables.read(outbreak.PREDICTIONS))
    return month_text(import_weights(stored_relative(d, tables), cells))


@query(
    "cx8_export_weights",
    f"""WITH {NETWORK_SQL}, {BY_ORIGIN_SQL}, {MODEL_SQL}, {RELATIVE_SQL}
    SELECT country_origin, disease, CAST(month AS VARCHAR) AS month, country_iso3c,
           country_rel_import AS country_rel_export,
           CAST(row_number() OVER (PARTITION BY country_origin, disease, month
             ORDER BY country_rel_import DESC NULLS LAST, country_iso3c) AS INTEGER) AS export_rank
    FROM relative""",
)
def cx8_export_weights(d):
    return month_text(export_weights(relative(d)))
