"""Incremental ingest, duplicates, upserts and written tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions.text import surrogate_id
from panelspark.operators.dedupe import (
    drop_all_duplicates,
    drop_duplicated_reports,
    first_per_key,
    invariants,
)
from panelspark.operators.ingest import (
    any_good,
    assign_batches,
    changed_rows,
    classify_errors,
    history_for,
    parse_report_name,
    run_mode,
    status_log,
    unfetched,
    unfetched_flagged,
    version_actions,
)
from panelspark.operators.upsert import merge
from panelspark.plans import annual, outbreak, six_month
from panelspark.plans.outbreak import OUTBREAK_KEY, unique_outbreaks
from panelspark.plans.six_month import clean_detail, clean_summary, store_predictions
from panelspark.sources.files import (
    export_all,
    read_csv,
    read_documents,
    read_raw_documents,
    write_csv,
    write_partitioned,
    write_raw_documents,
)
from panelspark.sources.partitioned import PartitionedTable
from panelspark.sources.pointers import Pointers
from panelspark.streaming.ingest import stream_upsert

from .base import CELLS_SQL, predictions, query, reports

# Orders are the listing; an order that was filled (F) was fetched, one that is pending
# (P) failed, and an open one (O) was never tried.
URL = "https://reports.example.org/getReport/"


def listing(d):
    return d.orders.select(F.col("o_orderkey").alias("report_info_id"), "o_orderpriority")


def order_log(d):
    tried = d.orders.filter("o_orderstatus <> 'O'")
    return tried.select(
        F.col("o_orderkey").cast("string").alias("report_info_id"),
        (F.col("o_orderstatus") == "P").alias("ingest_error"),
    )


@query(
    "in1_unfetched",
    f"""SELECT o_orderkey AS report_info_id, o_orderpriority,
               '{URL}' || CAST(o_orderkey AS VARCHAR) AS url
        FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def in1_unfetched(d):
    return unfetched(listing(d), order_log(d), "report_info_id", url_prefix=URL)


@query(
    "in2_unfetched_flagged",
    """SELECT c_custkey AS report, c_nationkey AS country, o.y AS report_year,
              coalesce(o.flag, FALSE) AS in_database, c_acctbal > 0 AS reported,
              'year=' || CAST(c_nationkey AS VARCHAR) || '&report=' || CAST(c_custkey AS VARCHAR) AS url
       FROM customer
       LEFT JOIN (SELECT o_custkey, max(CAST(extract(year FROM o_orderdate) AS INTEGER)) AS y,
                         bool_and(o_orderstatus = 'F') AS flag
                  FROM orders GROUP BY 1) o ON c_custkey = o_custkey
       WHERE c_acctbal > 0 AND NOT coalesce(o.flag, FALSE)""",
)
def in2_unfetched_flagged(d):
    listed = d.customer.select(
        F.col("c_custkey").alias("report"),
        F.col("c_nationkey").alias("country"),
        (F.col("c_acctbal") > 0).alias("reported"),
    )
    by_customer = d.orders.groupBy(F.col("o_custkey").alias("report")).agg(
        F.max(F.year("o_orderdate")).alias("report_year"),
        F.bool_and(F.col("o_orderstatus") == "F").alias("in_database"),
    )
    out = unfetched_flagged(
        listed,
        by_customer.select("report", "in_database"),
        ["report"],
        "year=%d&report=%d",
        ["country", "report"],
    )
    return out.join(by_customer.select("report", "report_year"), "report", "left")


RESPONSE_SQL = """
responses AS (
  SELECT event_id AS report_info_id,
         CASE event_type WHEN 'error' THEN 'ingestion error: code ' || (props::JSON ->> 'k')
                         WHEN 'view' THEN NULL ELSE 'available' END AS ingest_status,
         CASE WHEN event_type = 'signup' THEN 'Endpoint request timed out after '
                    || (props::JSON ->> 'k')
              WHEN event_type = 'click' THEN 'ok' END AS message
  FROM events)
"""


def responses(d):
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    return d.events.select(
        F.col("event_id").alias("report_info_id"),
        F.when(kind == "error", F.concat(F.lit("ingestion error: code "), k))
        .when(kind == "view", F.lit(None))
        .otherwise("available")
        .alias("ingest_status"),
        F.when(kind == "signup", F.concat(F.lit("Endpoint request timed out after "), k))
        .when(kind == "click", "ok")
        .alias("message"),
    )


@query(
    "in3_classify_errors",
    f"""WITH {RESPONSE_SQL}
        SELECT event_id AS report_info_id, user_id,
               coalesce(ingest_status LIKE '%ingestion error%', FALSE)
               OR coalesce(message LIKE '%Endpoint request timed out%', FALSE) AS ingest_error
        FROM responses JOIN events ON event_id = report_info_id""",
)
def in3_classify_errors(d):
    asked = d.events.select(F.col("event_id").alias("report_info_id"), "user_id")
    return classify_errors(asked, responses(d), "report_info_id")


@query(
    "in4_status_log",
    f"""WITH {RESPONSE_SQL}
        SELECT report_info_id, message,
               coalesce(ingest_status, 'failed to fetch') = 'available' AS in_database,
               CASE WHEN coalesce(ingest_status, 'failed to fetch') <> 'available'
                    THEN coalesce(ingest_status, 'failed to fetch') END AS ingest_error
        FROM responses""",
)
def in4_status_log(d):
    return status_log(responses(d))


@query(
    "in5_assign_batches",
    """SELECT event_id, user_id,
              CAST((row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS BIGINT) AS batch
       FROM events""",
)
def in5_assign_batches(d):
    rows = d.events.select("event_id", "user_id", "ts")
    return assign_batches(rows, ["ts", "event_id"], 100).drop("ts")


@query(
    "in6_any_good",
    f"""WITH {RESPONSE_SQL}
        SELECT bool_or(NOT (coalesce(ingest_status LIKE '%ingestion error%', FALSE)
               OR coalesce(message LIKE '%Endpoint request timed out%', FALSE))) AS goes_on
        FROM responses""",
)
def in6_any_good(d):
    asked = d.events.select(F.col("event_id").alias("report_info_id"))
    log = classify_errors(asked, responses(d), "report_info_id")
    return d.spark.range(1).select(F.lit(any_good(log)).alias("goes_on"))


@query(
    "in7_run_mode",
    """SELECT * FROM (
         SELECT 'no table' AS cached, 'full' AS mode
         UNION ALL SELECT 'one tag', CASE WHEN count(DISTINCT t) = 1 AND min(t) = 'v2'
                                          THEN 'incremental' ELSE 'full' END
         FROM (SELECT CASE WHEN o_totalprice >= 0 THEN 'v2' ELSE 'v1' END AS t FROM orders)
         UNION ALL SELECT 'two tags', CASE WHEN count(DISTINCT t) = 1 AND min(t) = 'v2'
                                           THEN 'incremental' ELSE 'full' END
         FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'v2' ELSE 'v1' END AS t FROM orders))""",
)
def in7_run_mode(d):
    one = F.when(F.col("o_totalprice") >= 0, "v2").otherwise("v1")
    two = F.when(F.col("o_orderstatus") == "F", "v2").otherwise("v1")
    cached = {
        "no table": None,
        "one tag": d.orders.select(one.alias("tag")),
        "two tags": d.orders.select(two.alias("tag")),
    }
    modes = [(name, run_mode(df, "tag", "v2")) for name, df in cached.items()]
    return d.spark.createDataFrame(modes, "cached string, mode string")


HISTORY_SQL = """
ev AS (SELECT o_orderkey AS report_id, o_custkey AS country, o_orderpriority AS disease,
              o_orderdate, o_totalprice FROM orders),
new AS (SELECT * FROM ev WHERE o_orderdate >= TIMESTAMP '2001-06-01'),
hist AS (SELECT * FROM ev WHERE o_orderdate < TIMESTAMP '2001-06-01'),
touched AS (SELECT DISTINCT country, disease FROM new)
"""


def order_events(d):
    ev = d.orders.select(
        F.col("o_orderkey").alias("report_id"),
        F.col("o_custkey").alias("country"),
        F.col("o_orderpriority").alias("disease"),
        "o_orderdate",
        "o_totalprice",
    )
    recent = F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz")
    return ev.filter(recent), ev.filter(~recent)


@query(
    "in8_history_for",
    f"""WITH {HISTORY_SQL}
        SELECT report_id, country, disease, o_totalprice FROM hist
        SEMI JOIN touched USING (country, disease)
        UNION ALL SELECT report_id, country, disease, o_totalprice FROM new""",
)
def in8_history_for(d):
    new, hist = order_events(d)
    out = history_for(new, hist, ["country", "disease"])
    return out.drop("o_orderdate")


@query(
    "in9_changed_rows",
    f"""WITH {HISTORY_SQL},
        fresh AS (SELECT country, disease,
                         CAST(extract(year FROM o_orderdate) AS INTEGER) AS year,
                         CASE WHEN o_totalprice > 250000 THEN 'high' END AS level
                  FROM (SELECT * FROM hist SEMI JOIN touched USING (country, disease)
                        UNION ALL SELECT * FROM new)),
        cache AS (SELECT country, disease,
                         CAST(extract(year FROM o_orderdate) AS INTEGER) AS year,
                         CASE WHEN o_totalprice > 300000 THEN 'high' END AS level FROM hist)
        SELECT * FROM fresh
        EXCEPT SELECT * FROM cache SEMI JOIN touched USING (country, disease)""",
)
def in9_changed_rows(d):
    new, hist = order_events(d)
    keys = ["country", "disease"]

    def levels(df, above):
        high = F.when(F.col("o_totalprice") > above, "high")
        return df.select(*keys, F.year("o_orderdate").alias("year"), high.alias("level"))

    fresh = levels(history_for(new, hist, keys), 250000)
    cache = levels(hist, 300000).withColumn("note", F.lit("x"))
    return changed_rows(fresh, cache, new.select(*keys).distinct(), keys)


@query(
    "in10_version_actions",
    """SELECT doc_id, source, CASE WHEN l.doc_id IS NULL THEN 'insert'
              WHEN l.quality = 1 THEN 'skip' ELSE 'update' END AS action
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def in10_version_actions(d):
    held = d.labels.select(
        "doc_id", F.col("quality").cast("string").alias("update_script_version")
    )
    return version_actions(d.documents.select("doc_id", "source"), held, "doc_id", "1")


@query(
    "in11_invariants",
    """SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
              CAST(count(*) FILTER (n > 1) AS BIGINT) AS n_repeated
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def in11_invariants(d):
    return invariants(d.lineitem, ["l_orderkey", "l_linenumber"])


REPORT_SQL = """
rep AS (SELECT o_custkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS report_year,
               CASE WHEN extract(month FROM o_orderdate) < 7 THEN 1 ELSE 2 END AS report_semester,
               o_orderkey AS report_id, l_linenumber, l_partkey, l_quantity
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
"""


def customer_reports(d):
    lines = d.lineitem.select(
        F.col("l_orderkey").alias("report_id"), "l_linenumber", "l_partkey", "l_quantity"
    )
    first = F.month("o_orderdate") < 7
    return d.orders.select(
        F.col("o_orderkey").alias("report_id"),
        "o_custkey",
        F.year("o_orderdate").alias("report_year"),
        F.when(first, 1).otherwise(2).alias("report_semester"),
    ).join(lines, "report_id")


@query(
    "wn1_drop_duplicated_reports",
    f"""WITH {REPORT_SQL},
        numbered AS (SELECT report_id, row_number() OVER (
                       PARTITION BY o_custkey, report_year, report_semester
                       ORDER BY report_id) AS n
                     FROM (SELECT DISTINCT o_custkey, report_year, report_semester, report_id
                           FROM rep))
        SELECT * FROM rep WHERE report_id NOT IN (SELECT report_id FROM numbered WHERE n > 1)""",
)
def wn1_drop_duplicated_reports(d):
    group = ["o_custkey", "report_year", "report_semester"]
    return drop_duplicated_reports(customer_reports(d), group, "report_id")


@query(
    "wn2_first_per_key",
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem)
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                  ORDER BY l_quantity DESC, l_partkey, l_suppkey) = 1""",
)
def wn2_first_per_key(d):
    lines = d.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return first_per_key(
        lines, ["l_orderkey", "l_linenumber"], [F.col("l_quantity").desc()]
    )


@query(
    "wn3_drop_all_duplicates",
    """SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey,
              min(l_returnflag) AS l_returnflag
       FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag
             FROM lineitem)
       GROUP BY l_orderkey, l_linenumber HAVING count(*) = 1""",
)
def wn3_drop_all_duplicates(d):
    lines = d.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"
    )
    return drop_all_duplicates(lines, ["l_orderkey", "l_linenumber"])


@query(
    "pr2_outbreak_ids",
    """SELECT CAST(report_id AS VARCHAR) || CAST(outbreak_location_id AS VARCHAR) || coalesce(species_name, 'NA') AS id,
              report_id, outbreak_location_id, species_name
       FROM (SELECT DISTINCT l_orderkey AS report_id, l_linenumber AS outbreak_location_id,
                    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS species_name
             FROM lineitem)""",
)
def pr2_outbreak_ids(d):
    species = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    rows = d.lineitem.select(
        F.col("l_orderkey").alias("report_id"),
        F.col("l_linenumber").alias("outbreak_location_id"),
        species.alias("species_name"),
    )
    return unique_outbreaks(rows)


# Base: orders before 2000. Updates: orders from 1999 on, with one column more and one
# less, so that 1999 is replaced and later years are added.
MERGE_SQL = """
SELECT o_orderkey, NULL AS o_orderstatus, o_totalprice, CAST(l AS VARCHAR) AS level FROM (
  SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice > 250000 THEN 2 ELSE 1 END AS l
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice, NULL FROM orders
WHERE o_orderdate < TIMESTAMP '1999-01-01'
"""


def base_and_updates(d):
    day = F.col("o_orderdate")
    old = day < F.lit("2000-01-01").cast("timestamp_ntz")
    recent = day >= F.lit("1999-01-01").cast("timestamp_ntz")
    base = d.orders.filter(old).select("o_orderkey", "o_orderstatus", "o_totalprice")
    level = F.when(F.col("o_totalprice") > 250000, 2).otherwise(1)
    updates = d.orders.filter(recent).select(
        "o_orderkey", "o_totalprice", level.alias("level")
    )
    return base, updates


@query("sk2_merge", MERGE_SQL)
def sk2_merge(d):
    base, updates = base_and_updates(d)
    return merge(base, updates, ["o_orderkey"], fill_missing=True)


@query("sk2_upsert_table", MERGE_SQL)
def sk2_upsert_table(d):
    base, updates = base_and_updates(d)
    tables = d.tables()
    tables.upsert("orders", base, ["o_orderkey"])
    tables.upsert("orders", updates, ["o_orderkey"], fill_missing=True)
    # a second delivery changes nothing
    return tables.upsert("orders", updates, ["o_orderkey"], fill_missing=True)


@query(
    "sk2_partitioned_upsert",
    f"""SELECT m.*, CAST(extract(year FROM o.o_orderdate) AS INTEGER) AS year
        FROM ({MERGE_SQL}) m JOIN orders o USING (o_orderkey)""",
)
def sk2_partitioned_upsert(d):
    base, updates = base_and_updates(d)
    years = d.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    table = PartitionedTable(d.spark, d.scratch(), ["year", "o_orderkey"], ["year"])
    table.upsert(base.join(years, "o_orderkey"))
    return table.upsert(updates.join(years, "o_orderkey"), fill_missing=True)


@query(
    "sk1_read_table",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def sk1_read_table(d):
    """Filter and column choice reach the stored files."""
    tables = d.tables()
    if tables.read_if_exists("orders") is None:
        tables.overwrite(d.orders, "orders")
    filled = tables.read("orders").filter("o_orderstatus = 'F'")
    return filled.select("o_orderkey", "o_totalprice")


@query(
    "sk3_overwrite",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'",
)
def sk3_overwrite(d):
    base, updates = base_and_updates(d)
    tables = d.tables()
    tables.overwrite(base, "orders")
    return tables.overwrite(updates.drop("level"), "orders")


@query(
    "sk4_full_refresh",
    f"""WITH {CELLS_SQL},
    r AS (SELECT country_iso3c, disease, report_year, report_semester,
      CASE WHEN bool_or(predicted_cases > 0) THEN TRUE
           WHEN count(*) > count(predicted_cases) THEN NULL ELSE FALSE END AS predicted_status,
      bool_or(disease_status) AS actual_status,
      CASE WHEN count(*) = count(predicted_cases) THEN sum(predicted_cases) END AS predicted_cases,
      sum(cases) AS actual_cases
      FROM predictions WHERE disease IN ('building', 'machinery') GROUP BY ALL)
    SELECT country_iso3c || disease || CAST(report_year AS VARCHAR)
           || CAST(report_semester AS VARCHAR) AS id, * FROM r""",
)
def sk4_full_refresh(d):
    tables = d.tables()
    for tag in ("old", "new"):
        out = store_predictions(
            tables, predictions(d), ["building", "machinery"], {"db_cases_etag": tag}
        )
    return out.drop("disease_status_unreported", "status_coalesced", "status_rank")


CSV_SQL = "SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal FROM customer"
CSV_SCHEMA = "c_custkey bigint, c_name string, c_acctbal double"


def customers_with_gaps(d):
    known = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    return d.customer.select("c_custkey", "c_name", known.alias("c_acctbal"))


@query("sk5_sk6_csv_round_trip", CSV_SQL)
def sk5_sk6_csv_round_trip(d):
    path = d.scratch()
    write_csv(customers_with_gaps(d), path)
    return read_csv(d.spark, path, CSV_SCHEMA)


@query("sk7_export_all", CSV_SQL)
def sk7_export_all(d):
    tables = d.tables()
    tables.overwrite(customers_with_gaps(d), "customer")
    tables.overwrite(d.nation, "nation")
    targets = export_all(tables, d.scratch())
    found = next(t for t in targets if t.endswith("/customer.csv"))
    return read_csv(d.spark, found, CSV_SCHEMA)


@query("sk8_snapshot", "SELECT s_suppkey, s_name FROM supplier")
def sk8_snapshot(d):
    tables = d.tables()
    tables.publish_snapshot(d.supplier.select("s_suppkey", "s_name"), "supplier")
    try:
        empty = d.supplier.filter("s_suppkey is null").select("s_suppkey", "s_name")
        tables.publish_snapshot(empty, "supplier")
    except ValueError:
        pass  # the empty copy was refused and the table stayed as it was
    return tables.read("supplier")


@query(
    "sk8_snapshot_all",
    """SELECT c_mktsegment, count(*) AS n_orders, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_filled
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def sk8_snapshot_all(d):
    """Two tables copied to another place and shown there together.

    A run that is half done, and one in which a table is too small, are not seen.
    """
    tables, stage = d.tables(), d.tables()
    tables.upsert("orders", d.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"])
    tables.overwrite(d.customer.select("c_custkey", "c_mktsegment"), "customers")
    tables.publish_all().push(stage)
    tables.overwrite(tables.read("customers").limit(0), "customers")
    for half_done in (lambda: tables.publish_all(), lambda: tables.snapshot().push(stage, {"orders": 1 << 60})):
        try:
            half_done()
        except ValueError:
            pass  # a table was too small, so that nothing was published
    shown = stage.snapshot()
    placed = shown.read("orders").withColumnRenamed("o_custkey", "c_custkey")
    return placed.join(shown.read("customers"), "c_custkey").groupBy("c_mktsegment").agg(
        F.count("*").alias("n_orders"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("n_filled"),
    )


@query(
    "sk2_changed_rows",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
       WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'""",
)
def sk2_changed_rows(d):
    """The rows that an upsert replaced, as they were."""
    base, updates = base_and_updates(d)
    tables = d.tables()
    tables.upsert("orders", base, ["o_orderkey"])
    tables.upsert("orders", updates, ["o_orderkey"], fill_missing=True, changes=True)
    return tables.before("orders").drop("level")


@query(
    "sk9_partitioned_write",
    """SELECT lower(c_mktsegment) AS disease, n_name AS country_iso3c, c_custkey, c_acctbal
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def sk9_partitioned_write(d):
    named = d.customer.join(
        d.nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"
    ).select(
        F.lower("c_mktsegment").alias("disease"),
        F.col("n_name").alias("country_iso3c"),
        "c_custkey",
        "c_acctbal",
    )
    path = d.scratch()
    write_partitioned(named, path)
    schema = "c_custkey bigint, c_acctbal double, disease string, country_iso3c string"
    return d.spark.read.schema(schema).parquet(path)


@query(
    "sk10_raw_documents",
    """SELECT sha256(coalesce(text, '') || chr(10)) AS text_sha256, count(*) AS n, TRUE AS named
       FROM documents GROUP BY ALL""",
)
def sk10_raw_documents(d):
    """Every document's text as a file of its own, read back whole with the file's name."""
    path = d.scratch()
    line = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"))
    write_raw_documents(d.documents.select(line.alias("text")), path)
    raw = read_raw_documents(d.spark, path)
    digests = raw.select("file_name", F.sha2("value", 256).alias("text_sha256"))
    per_file = digests.groupBy("file_name").agg(F.max("text_sha256").alias("text_sha256"))
    named = F.col("file_name").rlike(r"^part-.*[.]txt$").alias("named")
    return per_file.groupBy("text_sha256", named).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sk11_nested_documents",
    """SELECT event_id, event_type, CAST(props::JSON ->> 'k' AS BIGINT) AS k FROM events""",
)
def sk11_nested_documents(d):
    path = d.scratch()
    doc = F.struct(
        "event_id",
        "event_type",
        F.from_json("props", "k bigint").alias("props"),
    )
    d.events.select(F.to_json(doc).alias("value")).write.text(path)
    schema = "event_id bigint, event_type string, props struct<k: bigint>"
    docs = read_documents(d.spark, path, schema)
    return docs.select("event_id", "event_type", F.col("props.k").alias("k"))


@query(
    "sc6_parse_report_name",
    """SELECT substr(nm, 1, 3) || '_' || substr(nm, 5, 4) || '_' || substr(nm, 13, 1) AS report,
              substr(nm, 1, 3) AS country_iso3c, CAST(substr(nm, 5, 4) AS INTEGER) AS report_year,
              CAST(substr(nm, 13, 1) AS INTEGER) AS report_semester, count(*) AS n
       FROM (SELECT substr(c_mktsegment, 1, 3) || '_' || CAST(extract(year FROM o_orderdate) AS VARCHAR)
                    || '_sem' || CASE WHEN extract(month FROM o_orderdate) < 7 THEN '1' ELSE '2' END
                    || '.html' AS nm
             FROM orders JOIN customer ON o_custkey = c_custkey)
       GROUP BY ALL""",
)
def sc6_parse_report_name(d):
    sem = F.when(F.month("o_orderdate") < 7, "1").otherwise("2")
    name = F.concat(
        F.substring("c_mktsegment", 1, 3),
        F.lit("_"),
        F.year("o_orderdate").cast("string"),
        F.lit("_sem"),
        sem,
        F.lit(".html"),
    )
    buyers = d.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    parsed = d.orders.join(buyers, "o_custkey").select(*parse_report_name(name))
    return parsed.groupBy(*parsed.columns).agg(F.count(F.lit(1)).alias("n"))


INGEST_SQL = """
SELECT l_orderkey AS report_id, l_linenumber AS outbreak_location_id,
       min(l_returnflag) AS species_name,
       CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) || min(l_returnflag) AS id
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_partkey FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F')
GROUP BY l_orderkey, l_linenumber, l_returnflag HAVING count(*) = 1
"""


@query("cx21_incremental_ingest", INGEST_SQL)
def cx21_incremental_ingest(d):
    """Unfetched orders whose response is usable to unique outbreak rows in a stored table."""
    todo = unfetched(listing(d), order_log(d), "report_info_id", url_prefix=URL)
    got = todo.select(
        "report_info_id", F.lit("available").alias("ingest_status"), F.lit(None).cast("string").alias("message")
    )
    log = classify_errors(todo, got, "report_info_id")
    if not any_good(log):
        raise ValueError("no usable response")
    todo = log.filter(~F.col("ingest_error"))
    lines = d.lineitem.select(
        F.col("l_orderkey").alias("report_id"),
        F.col("l_linenumber").alias("outbreak_location_id"),
        F.col("l_returnflag").alias("species_name"),
        "l_partkey",
    )
    wanted = todo.select(F.col("report_info_id").alias("report_id"))
    rows = unique_outbreaks(lines.join(wanted, "report_id", "left_semi"))
    tables = d.tables()
    return tables.upsert(
        "outbreaks", rows.drop("l_partkey"), OUTBREAK_KEY, fill_missing=True, nullable_keys=True
    )


@query(
    "cx21_outbreak_run",
    """WITH lines AS (
      SELECT DISTINCT l_orderkey AS report_id, l_suppkey AS outbreak_location_id,
             CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS species_name, l_quantity
      FROM lineitem),
    single AS (
      SELECT report_id, outbreak_location_id, species_name FROM lines
      GROUP BY 1, 2, 3 HAVING count(*) = 1)
    SELECT CAST(report_id AS VARCHAR) || CAST(outbreak_location_id AS VARCHAR)
             || coalesce(species_name, 'NA') AS id, * FROM single""",
)
def cx21_outbreak_run(d):
    """The daily run over all orders: every fifth fetch fails once and is repeated.

    Glued ids collide (order 1 at place 23, order 12 at place 3); no row is lost to that.
    """
    tables = d.tables()
    listing = d.orders.select(F.col("o_orderkey").alias("report_info_id"))

    def responses(asked, failing):
        bad = F.col("report_info_id") % 5 == 0 if failing else F.lit(False)
        return asked.select(
            "report_info_id",
            F.when(bad, "ingestion error: x").otherwise("available").alias("ingest_status"),
            F.lit(None).cast("string").alias("message"),
        )

    def parsed(got):
        good = got.filter("ingest_status = 'available'").select(
            F.col("report_info_id").alias("report_id")
        )
        flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
        places = d.lineitem.select(
            F.col("l_orderkey").alias("report_id"),
            F.col("l_suppkey").alias("outbreak_location_id"),
            flag.alias("species_name"),
            "l_quantity",
        )
        return {
            outbreak.EVENTS: good,
            outbreak.OUTBREAKS: places.join(good, "report_id", "left_semi"),
        }

    for failing in (True, False):
        outbreak.ingest(tables, listing, lambda asked, f=failing: responses(asked, f), parsed, URL)
    return tables.read(outbreak.OUTBREAKS).drop("l_quantity")


@query(
    "wn1_six_month_summary",
    """WITH rep AS (
      SELECT n_name AS country_iso3c, CAST(extract(year FROM o_orderdate) AS INTEGER) AS report_year,
             CASE WHEN extract(month FROM o_orderdate) < 7 THEN 1 ELSE 2 END AS report_semester,
             lower(c_mktsegment) AS disease, o_orderstatus AS disease_population,
             o_orderpriority AS taxa, CASE WHEN o_totalprice > 250000 THEN 'A' END AS serotype,
             CAST(NULL AS VARCHAR) AS control_measures, c_custkey AS report_id
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    bad AS (SELECT report_id FROM (SELECT DISTINCT country_iso3c, report_year, report_semester, report_id FROM rep)
            QUALIFY row_number() OVER (PARTITION BY country_iso3c, report_year, report_semester
                                       ORDER BY report_id) > 1)
    SELECT country_iso3c || CAST(report_year AS VARCHAR) || CAST(report_semester AS VARCHAR) || disease
           || disease_population || taxa || coalesce(serotype, 'NA') || 'NA' AS id, *
    FROM rep WHERE report_id NOT IN (SELECT report_id FROM bad)""",
)
def wn1_six_month_summary(d):
    rows = reports(d).select(
        "country_iso3c",
        "report_year",
        "report_semester",
        "disease",
        "disease_population",
        "taxa",
        F.when(F.col("o_totalprice") > 250000, "A").alias("serotype"),
        F.lit(None).cast("string").alias("control_measures"),
        F.col("o_custkey").alias("report_id"),
    )
    return clean_summary(rows)


@query(
    "wn2_six_month_detail",
    """WITH rep AS (
      SELECT o_orderpriority AS country_iso3c, o_custkey AS report_year, o_orderstatus AS report_semester,
             p_type AS disease, p_brand AS disease_population, l_returnflag AS taxa,
             l_linestatus AS serotype, CAST(NULL AS VARCHAR) AS adm, 'm' AS period,
             o_orderkey AS report_id, l_quantity AS q
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
    bad AS (SELECT report_id FROM (SELECT DISTINCT country_iso3c, report_year, report_semester, report_id FROM rep)
            QUALIFY row_number() OVER (PARTITION BY country_iso3c, report_year, report_semester
                                       ORDER BY report_id) > 1)
    SELECT country_iso3c || CAST(report_year AS VARCHAR) || report_semester || disease
           || disease_population || taxa || serotype || 'NA' || period AS id, *
    FROM rep WHERE report_id NOT IN (SELECT report_id FROM bad)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY report_id, q) = 1""",
)
def wn2_six_month_detail(d):
    lines = d.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("p_partkey"),
        "l_returnflag",
        "l_linestatus",
        "l_quantity",
    )
    parts = d.part.select("p_partkey", "p_type", "p_brand")
    joined = d.orders.join(lines, "o_orderkey").join(parts, "p_partkey")
    rows = joined.select(
        F.col("o_orderpriority").alias("country_iso3c"),
        F.col("o_custkey").alias("report_year"),
        F.col("o_orderstatus").alias("report_semester"),
        F.col("p_type").alias("disease"),
        F.col("p_brand").alias("disease_population"),
        F.col("l_returnflag").alias("taxa"),
        F.col("l_linestatus").alias("serotype"),
        F.lit(None).cast("string").alias("adm"),
        F.lit("m").alias("period"),
        F.col("o_orderkey").alias("report_id"),
        F.col("l_quantity").alias("q"),
    )
    return clean_detail(rows)


@query(
    "cx21_six_month_run",
    """WITH rep AS (
      SELECT n_name AS country_iso3c, CAST(extract(year FROM o_orderdate) AS INTEGER) AS report_year,
             CASE WHEN extract(month FROM o_orderdate) < 7 THEN 1 ELSE 2 END AS report_semester,
             lower(c_mktsegment) AS disease, o_orderstatus AS disease_population,
             o_orderpriority AS taxa, CASE WHEN o_totalprice > 250000 THEN 'A' END AS serotype,
             CAST(NULL AS VARCHAR) AS control_measures, c_custkey AS report_id, count(*) AS n_orders
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      WHERE c_custkey % 5 <> 0 GROUP BY ALL),
    bad AS (SELECT report_id FROM (SELECT DISTINCT country_iso3c, report_year, report_semester, report_id FROM rep)
            QUALIFY row_number() OVER (PARTITION BY country_iso3c, report_year, report_semester
                                       ORDER BY report_id) > 1)
    SELECT country_iso3c || CAST(report_year AS VARCHAR) || CAST(report_semester AS VARCHAR) || disease
           || disease_population || taxa || coalesce(serotype, 'NA') || 'NA' AS id, *
    FROM rep WHERE report_id NOT IN (SELECT report_id FROM bad)""",
)
def cx21_six_month_run(d):
    """The weekly run over all customers; every fifth report never arrives.

    The second run finds only those left to fetch, and changes nothing.
    """
    tables = d.tables()
    listing = d.customer.select(F.col("c_custkey").alias("report_id"))

    def responses(asked):
        failed = F.col("report_id") % 5 == 0
        return asked.select(
            "report_id",
            F.when(failed, "ingestion error: x").otherwise("available").alias("ingest_status"),
            F.lit(None).cast("string").alias("message"),
        )

    def parsed(got):
        good = got.filter("ingest_status = 'available'").select("report_id")
        rows = reports(d).select(
            "country_iso3c",
            "report_year",
            "report_semester",
            "disease",
            "disease_population",
            "taxa",
            F.when(F.col("o_totalprice") > 250000, "A").alias("serotype"),
            F.lit(None).cast("string").alias("control_measures"),
            F.col("o_custkey").alias("report_id"),
        )
        summary = rows.groupBy(*rows.columns).agg(F.count("*").alias("n_orders"))
        summary = summary.join(good, "report_id", "left_semi")
        detail = summary.drop("control_measures").withColumns({"adm": F.lit("a"), "period": F.lit("p")})
        return {six_month.SUMMARY: summary, six_month.DETAIL: detail}

    for _ in range(2):
        six_month.ingest(tables, listing, responses, parsed, URL)
    return tables.read(six_month.SUMMARY)


@query(
    "se5_preprocess_six_month",
    f"""WITH rep AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS id, n_name AS country_iso3c,
             CAST(extract(year FROM o_orderdate) AS INTEGER) AS report_year,
             CASE WHEN extract(month FROM o_orderdate) < 7 THEN 1 ELSE 2 END AS report_semester,
             lower(c_mktsegment) AS raw, o_orderstatus AS disease_population, o_orderpriority AS taxa
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      WHERE o_totalprice > 20000),
    known AS (SELECT id, country_iso3c, report_year, report_semester, 'std_' || raw AS disease,
                     disease_population, taxa, raw AS disease_name_uncleaned
              FROM rep WHERE raw <> 'furniture'),
    future AS (SELECT CAST((i + k) // 2 AS INTEGER) AS report_year,
                      CAST((i + k) % 2 + 1 AS INTEGER) AS report_semester
               FROM (SELECT max(report_year * 2 + report_semester - 1) AS i FROM known)
               CROSS JOIN (VALUES (1), (2)) AS n(k)),
    grid AS (SELECT * FROM (SELECT DISTINCT disease, disease_population, taxa FROM known)
             CROSS JOIN (SELECT DISTINCT country_iso3c FROM known)
             CROSS JOIN (SELECT DISTINCT report_year, report_semester FROM known UNION SELECT * FROM future)),
    rejected AS (SELECT DISTINCT country_iso3c, report_year, report_semester, disease_population
                 FROM rep WHERE raw = 'furniture')
    SELECT id, country_iso3c, report_year, report_semester, disease, disease_population, taxa,
           disease_name_uncleaned, NULL AS disease_status, NULL AS reason_for_exclusion FROM known
    UNION ALL
    SELECT NULL, country_iso3c, report_year, report_semester, disease, disease_population, taxa,
           NULL, 'unreported', NULL
    FROM grid ANTI JOIN known USING (disease, disease_population, taxa, country_iso3c, report_year, report_semester)
    UNION ALL
    SELECT NULL, country_iso3c, report_year, report_semester, NULL, disease_population, NULL,
           'furniture', NULL, 'unrecognized disease' FROM rejected""",
)
def se5_preprocess_six_month(d):
    """Stored reports up to 2000 and new ones after, together with what was rejected."""
    rows = reports(d).select(
        F.col("o_orderkey").cast("string").alias("id"),
        "country_iso3c",
        "report_year",
        "report_semester",
        "disease",
        "disease_population",
        "taxa",
        (F.col("o_totalprice") <= 20000).alias("is_aquatic"),
    )
    names = rows.select(F.upper("disease").alias("disease_name")).distinct()
    names = names.filter("disease_name <> 'FURNITURE'").withColumn(
        "disease_standard", F.concat(F.lit("std_"), F.lower("disease_name"))
    )
    kept, rejected = six_month.preprocess(
        rows.filter("report_year > 2000"), rows.filter("report_year <= 2000"), names
    )
    return kept.drop("is_aquatic").unionByName(rejected, allowMissingColumns=True)


@query(
    "cx21_annual_run",
    """SELECT CAST(c_custkey AS VARCHAR) AS report, n_name AS country_iso3c, 2000 AS report_year,
              c_custkey % 2 AS report_semester, c_custkey % 4 <> 0 AS in_database,
              CASE c_custkey % 4 WHEN 0 THEN 'failed to fetch' END AS ingest_error,
              CASE WHEN c_custkey % 4 <> 0 THEN coalesce(n, 0) END AS n_hosts
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey
       WHERE c_acctbal > 0""",
)
def cx21_annual_run(d):
    """The annual run, twice: every fourth report cannot be fetched, the others not again."""
    tables = d.tables()
    nation = d.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country_iso3c"))
    listed = d.customer.join(nation, "c_nationkey").select(
        F.col("c_custkey").cast("string").alias("report"),
        "country_iso3c",
        F.lit(2000).alias("report_year"),
        (F.col("c_custkey") % 2).alias("report_semester"),
        (F.col("c_acctbal") > 0).alias("reported"),
    )

    def responses(asked):
        there = F.col("report").cast("long") % 4 != 0
        return asked.filter(there).withColumn("ingest_status", F.lit("available"))

    def parsed(got):
        placed = d.orders.select(F.col("o_custkey").cast("string").alias("report"), "o_orderkey")
        return {
            "annual_reports_animal_hosts": placed.join(got.select("report"), "report", "left_semi"),
            "annual_reports_diseases_unmatched": got.select(F.lit("odd").alias("disease")).limit(1),
        }

    for _ in range(2):
        log = annual.ingest_annual(
            tables, listed, responses, parsed, "year=%d&report=%s", ["report_year", "report"]
        )
    hosts = tables.read("annual_reports_animal_hosts").groupBy("report").agg(F.count("*").alias("n"))
    n_hosts = F.when(F.col("in_database"), F.coalesce("n", F.lit(0)))
    return log.join(hosts, "report", "left").withColumn("n_hosts", n_hosts).drop("n")


def lose_last_commit(d, checkpoint):
    """What a crash after the rows were published and before the checkpoint leaves."""
    marks = Pointers(d.spark, f"{checkpoint}/commits")
    last = max(int(c) for c in marks.children(marks.path) if c.isdigit())
    marks.remove(f"{marks.path}/{last}")


@query(
    "st1_stream_upsert",
    "SELECT event_id, user_id, event_type, CAST(props::JSON ->> 'k' AS BIGINT) AS k FROM events",
)
def st1_stream_upsert(d):
    """Events delivered as files in two runs; the second run corrects the first."""
    source, tables = d.scratch(), d.tables()
    schema = "event_id bigint, user_id bigint, event_type string, k bigint"
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = d.events.select("event_id", "user_id", "event_type", k.alias("k"))
    first = rows.filter("event_type <> 'error'").withColumn(
        "k", F.when(F.col("event_type") == "view", -1).otherwise(F.col("k"))
    )
    late = rows.filter("event_type in ('error', 'view')")
    # the second checkpoint is lost once: its batch is delivered again, and passed over
    for delivery in (first, late, None):
        if delivery is None:
            lose_last_commit(d, f"{tables.root}/_checkpoint")
        else:
            delivery.write.mode("append").json(source)
        run = stream_upsert(
            d.spark,
            source,
            schema,
            tables,
            "events",
            ["event_id"],
            f"{tables.root}/_checkpoint",
            ["user_id"],
        )
        run.awaitTermination()
    return tables.read("events")


@query(
    "pr2_prediction_ids",
    f"""WITH {CELLS_SQL}
    SELECT country_iso3c || CAST(report_year AS VARCHAR) || CAST(report_semester AS VARCHAR)
           || disease || disease_population || taxa AS id, coalesce(cases, 0) AS cases
    FROM predictions""",
)
def pr2_prediction_ids(d):
    key = surrogate_id(
        "country_iso3c",
        "report_year",
        "report_semester",
        "disease",
        "disease_population",
        "taxa",
    )
    return predictions(d).select(key.alias("id"), F.coalesce("cases", F.lit(0.0)).alias("cases"))
