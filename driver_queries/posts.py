"""Orders as news posts: a customer's nation and region as places."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators.posts import aggregate_posts, flatten_posts, post_facts
from panelspark.plans.annual import update_posts

from .base import query

URL = "https://posts.example.org/?id="


def posts(d):
    """One nested post per order; every list is made from the order's own row."""
    nations = d.nation.join(d.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    buyers = d.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_nationkey").alias("n_nationkey"),
        "c_mktsegment",
        "c_acctbal",
    )
    headed = d.orders.join(buyers, "o_custkey").join(
        nations.select("n_nationkey", "n_name", "r_name"), "n_nationkey"
    )
    priority, state = F.col("o_orderpriority"), F.col("o_orderstatus")
    segment, day = F.col("c_mktsegment"), F.col("o_orderdate").cast("timestamp")
    nothing = F.array().cast("array<string>")
    no_list = F.lit(None).cast("array<string>")
    urgent = priority == "1-URGENT"

    attributes = (
        F.when(state == "F", F.array(F.lit("case"), F.lit("confirmed")))
        .when(state == "O", F.array(F.lit("death")))
        .otherwise(nothing)
    )
    size = F.floor(F.col("o_totalprice") / 10000).cast("int")
    counts = F.array(
        F.struct(attributes.alias("attributes"), size.alias("count")),
        F.struct(F.array(F.lit("case")).alias("attributes"), F.lit(3).alias("count")),
    )
    later = F.date_add(F.col("o_orderdate").cast("date"), 200).cast("timestamp")
    dates = F.array(
        F.struct(F.array(day, later).alias("datetime_range")),
        F.struct(F.array(day, F.lit(None).cast("timestamp")).alias("datetime_range")),
        F.struct(F.lit(None).cast("array<timestamp>").alias("datetime_range")),
    )
    species = F.when(state == "F", F.array(F.lit("cattle"), F.lower(segment))).when(
        state == "O", F.array(F.lit("swine"), F.lit("cattle"))
    )
    return headed.select(
        F.col("o_orderkey").cast("string").alias("post_id"),
        F.when(~urgent, day).alias("post_date"),
        F.when(
            state != "P",
            F.struct(
                priority.alias("description"),
                F.when(urgent, segment).alias("region"),
                F.lit(None).cast("string").alias("additional_info"),
                F.array(segment).alias("disease_labels"),
            ),
        ).alias("subject"),
        F.when(priority != "3-MEDIUM", counts).alias("counts"),
        F.when((priority != "4-NOT SPECIFIED") | (state != "P"), dates).alias("dates"),
        F.when(F.col("c_acctbal") >= 0, F.array("n_name", "n_name", "r_name")).alias("geonames"),
        F.when(priority != "5-LOW", F.array(priority, segment)).alias("keywords_disease"),
        species.alias("keywords_species"),
        F.when(state != "O", F.array(segment)).alias("subject_disease_labels"),
        no_list.alias("subject_geonames"),
        no_list.alias("subject_keywords_disease"),
        species.alias("subject_keywords_species"),
    )


POSTS_SQL = """
posts AS (
  SELECT o_orderkey, o_orderdate, o_orderpriority AS priority, o_orderstatus AS state,
         c_mktsegment AS segment, CAST(floor(o_totalprice / 10000) AS INTEGER) AS size,
         CASE WHEN c_acctbal >= 0 THEN [n_name, n_name, r_name] END AS geonames,
         CASE WHEN o_orderpriority <> '5-LOW' THEN [o_orderpriority, c_mktsegment] END AS keywords,
         CASE o_orderstatus WHEN 'F' THEN ['cattle', lower(c_mktsegment)]
                            WHEN 'O' THEN ['swine', 'cattle'] END AS species,
         CASE WHEN o_orderstatus <> 'O' THEN [c_mktsegment] END AS labels
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)
"""


def brace(name: str) -> str:
    return f"""coalesce('{{"' || array_to_string({name}, '","') || '"}}', '')"""


FLAT_SQL = f"""
WITH {POSTS_SQL}
SELECT CAST(o_orderkey AS VARCHAR) AS post_id, '{URL}' || CAST(o_orderkey AS VARCHAR) AS post_url,
  CASE WHEN state <> 'P' THEN priority ELSE '' END AS subject_description,
  CASE WHEN state <> 'P' AND priority = '1-URGENT' THEN segment ELSE '' END AS subject_region,
  '' AS subject_additional_info,
  CASE WHEN state <> 'P' THEN '{{"' || segment || '"}}' ELSE '' END AS subject_disease_labels,
  '' AS subject_geonames, '' AS subject_keywords_disease,
  {brace("species")} AS subject_keywords_species,
  CASE WHEN priority <> '1-URGENT' THEN strftime(o_orderdate, '%m/%d/%Y, %H:%M:%S') ELSE '' END
    AS post_date,
  CASE WHEN priority <> '1-URGENT' THEN CAST(extract(year FROM o_orderdate) AS INTEGER) ELSE -1 END
    AS post_year,
  CASE WHEN priority = '1-URGENT' THEN -1
       WHEN extract(month FROM o_orderdate) < 7 THEN 1 ELSE 2 END AS post_semester,
  CASE WHEN priority = '3-MEDIUM' THEN '' ELSE
    '[{{"attributes":' || CASE state WHEN 'F' THEN '["case","confirmed"]' WHEN 'O' THEN '["death"]'
      ELSE '[]' END || ',"count":' || CAST(size AS VARCHAR)
    || '}},{{"attributes":["case"],"count":3}}]' END AS counts,
  {brace("keywords")} AS keywords_disease, {brace("species")} AS keywords_species,
  {brace("geonames")} AS geonames, '0.3' AS update_script_version
FROM posts
"""


@query("cx19_flatten_posts", FLAT_SQL)
def cx19_flatten_posts(d):
    return flatten_posts(posts(d), URL, "0.3")


@query("cx19_update_posts", FLAT_SQL)
def cx19_update_posts(d):
    """Posts of filled orders were stored by an older version and are rewritten; those
    of pending ones are current and skipped."""
    tables = d.tables()
    nested = posts(d)
    filled = F.col("subject_disease_labels").isNotNull()
    update_posts(tables, nested.filter(filled & F.col("subject").isNotNull()), URL, "0.2")
    update_posts(tables, nested.filter(F.col("subject").isNull()), URL, "0.3")
    return update_posts(tables, nested, URL, "0.3")


FACTS_SQL = """
facts AS (
  SELECT o_orderkey, list_distinct(coalesce(labels, []) || coalesce(keywords, [])) AS diseases,
         list_distinct(geonames) AS places,
         list_distinct([CAST(extract(year FROM o_orderdate) AS INTEGER),
                        CAST(extract(year FROM o_orderdate + INTERVAL 200 DAY) AS INTEGER)]) AS years,
         species, CAST(CASE WHEN priority = '3-MEDIUM' THEN 0 ELSE
                         3 + CASE WHEN state = 'F' THEN size ELSE 0 END END AS BIGINT) AS cases
  FROM posts
  WHERE (labels IS NOT NULL OR keywords IS NOT NULL) AND geonames IS NOT NULL
    AND (priority <> '4-NOT SPECIFIED' OR state <> 'P'))
"""


@query(
    "cx20_ag9_aggregate_posts",
    f"""WITH {POSTS_SQL}, {FACTS_SQL},
    d AS (SELECT *, unnest(diseases) AS disease_name FROM facts),
    p AS (SELECT *, unnest(places) AS disease_country FROM d),
    cells AS (SELECT *, unnest(years) AS disease_year FROM p),
    kinds AS (SELECT DISTINCT disease_name, disease_country, disease_year, kind
              FROM (SELECT *, unnest(species) AS kind FROM cells)),
    lists AS (SELECT disease_name, disease_country, disease_year,
                     string_agg(kind, ',' ORDER BY kind) AS disease_species
              FROM kinds GROUP BY ALL)
    SELECT disease_name, disease_country, disease_year, count(*) AS n_posts,
           CAST(sum(cases) AS BIGINT) AS n_cases, coalesce(any_value(disease_species), '')
             AS disease_species
    FROM cells LEFT JOIN lists USING (disease_name, disease_country, disease_year)
    GROUP BY ALL""",
)
def cx20_ag9_aggregate_posts(d):
    out = aggregate_posts(posts(d))
    return out.withColumn("disease_species", F.array_join("disease_species", ","))


@query(
    "sc13_post_facts",
    f"""WITH {POSTS_SQL}, {FACTS_SQL}
    SELECT CAST(o_orderkey AS VARCHAR) AS post_id, len(diseases) AS n_diseases,
           len(places) AS n_places, len(years) AS n_years, cases
    FROM facts""",
)
def sc13_post_facts(d):
    return post_facts(posts(d)).select(
        "post_id",
        F.size("diseases").cast("long").alias("n_diseases"),
        F.size("places").cast("long").alias("n_places"),
        F.size("years").cast("long").alias("n_years"),
        "cases",
    )
