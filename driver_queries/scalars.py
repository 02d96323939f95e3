"""Projections, filters, joins and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions.numbers import (
    number_text,
    number_to_bool,
    percent_label,
    signif,
    text_to_bool,
    to_int,
)
from panelspark.functions.periods import (
    half_year_axis,
    month_start,
    post_date_text,
    semester,
)
from panelspark.functions.status import status_label, status_rank, three_state
from panelspark.functions.text import (
    contains,
    merge_buckets,
    recode,
    replace_first,
    split_list,
    title_case,
    variable_display_name,
)
from panelspark.operators.joins import enrich, matching, not_matching, null_safe_join

from .base import nation_of, query


def labelled(d):
    docs = d.documents.select("doc_id", "lang", "source", "n_chars")
    return docs.join(d.labels, "doc_id", "left")


LABELLED_SQL = "documents LEFT JOIN labels USING (doc_id)"


@query(
    "pr1_select_rename",
    "SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice FROM orders",
)
def pr1_select_rename(d):
    renamed = d.orders.withColumnsRenamed({"o_orderkey": "id", "o_custkey": "customer"})
    return renamed.drop("o_orderstatus", "o_orderdate", "o_orderpriority")


@query(
    "pr3_filters",
    f"""SELECT doc_id, quality, toxic FROM {LABELLED_SQL}
        WHERE NOT (quality = 1) OR quality < toxic OR toxic IS NULL""",
)
def pr3_filters(d):
    quality, toxic = F.col("quality"), F.col("toxic")
    out = labelled(d).filter(~(quality == 1) | (quality < toxic) | toxic.isNull())
    return out.select("doc_id", "quality", "toxic")


@query(
    "pr4_membership",
    "SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr') AND source IN ('src1', 'src2')",
)
def pr4_membership(d):
    chosen = F.col("lang").isin("de", "fr") & F.col("source").isin("src1", "src2")
    return d.documents.filter(chosen).select("doc_id", "lang")


@query(
    "pr5_drop_null_rows",
    f"SELECT doc_id, quality FROM {LABELLED_SQL} WHERE quality IS NOT NULL",
)
def pr5_drop_null_rows(d):
    return labelled(d).dropna(subset=["quality"]).select("doc_id", "quality")


@query(
    "pr6_status_label",
    f"""SELECT doc_id, label, CASE label WHEN 'reported present' THEN 1
              WHEN 'unreported, predicted present' THEN 2 WHEN 'reported absent' THEN 3
              WHEN 'unreported, predicted absent' THEN 4 END AS status_rank
    FROM (SELECT doc_id, CASE WHEN quality = 1 THEN 'reported present'
                 WHEN NOT (quality = 1) THEN 'reported absent'
                 WHEN lang = 'en' AND n_chars > 2000 THEN 'unreported, predicted present'
                 WHEN lang = 'en' THEN 'unreported, predicted absent' END AS label
          FROM {LABELLED_SQL})""",
)
def pr6_status_label(d):
    label = status_label(
        F.col("quality") == 1, F.col("lang") == "en", F.col("n_chars") > 2000
    )
    out = labelled(d).select("doc_id", label.alias("label"))
    return out.withColumn("status_rank", status_rank("label"))


@query(
    "pr8_recode",
    """SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'SMALL/MEDIUM' ELSE p_type END AS bucket,
              CASE p_brand WHEN 'Brand#1' THEN 'First' WHEN 'Brand#2' THEN 'Second' ELSE p_brand END AS brand
       FROM part""",
)
def pr8_recode(d):
    return d.part.select(
        "p_partkey",
        merge_buckets("p_type", ["SMALL", "MEDIUM"], "SMALL/MEDIUM").alias("bucket"),
        recode("p_brand", {"Brand#1": "First", "Brand#2": "Second"}).alias("brand"),
    )


@query(
    "pr9_three_state",
    f"""SELECT doc_id, CASE WHEN toxic IS NULL THEN 'Missing' WHEN toxic = 1 THEN 'Present'
                           ELSE 'Absent' END AS missing FROM {LABELLED_SQL}""",
)
def pr9_three_state(d):
    return labelled(d).select("doc_id", three_state(F.col("toxic") == 1).alias("missing"))


@query(
    "pr10_pr11_pr12_fill_prefer_tag",
    f"""SELECT doc_id, coalesce(quality, 0) AS filled, coalesce(toxic, n_chars) AS preferred,
               'labels' AS source FROM {LABELLED_SQL}""",
)
def pr10_pr11_pr12_fill_prefer_tag(d):
    return labelled(d).select(
        "doc_id",
        F.coalesce("quality", F.lit(0)).alias("filled"),
        F.coalesce(F.col("toxic").cast("long"), "n_chars").alias("preferred"),
        F.lit("labels").alias("source"),
    )


@query(
    "pr13_half_years",
    """SELECT o_orderkey, CASE WHEN extract(month FROM o_orderdate) < 7 THEN 1 ELSE 2 END AS semester,
              CAST(extract(year FROM o_orderdate)
                   + CASE WHEN extract(month FROM o_orderdate) < 7 THEN 0 ELSE 0.5 END AS DOUBLE) AS yr
       FROM orders""",
)
def pr13_half_years(d):
    sem = semester("o_orderdate")
    axis = half_year_axis(F.year("o_orderdate"), sem)
    return d.orders.select("o_orderkey", sem.alias("semester"), axis.alias("yr"))


@query(
    "jn1_matching",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def jn1_matching(d):
    keys = d.customer.filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey")
    )
    return matching(d.orders.select("o_orderkey", "o_custkey"), keys, ["o_custkey"])


@query(
    "jn2_enrich",
    """SELECT c_custkey, n_name, label FROM customer JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN (VALUES ('BUILDING', 'b'), ('MACHINERY', 'm')) AS l(c_mktsegment, label)
       USING (c_mktsegment)""",
)
def jn2_enrich(d):
    rows = [("BUILDING", "b"), ("MACHINERY", "m"), ("MACHINERY", "m")]
    labels = d.spark.createDataFrame(rows, "c_mktsegment string, label string")
    named = enrich(d.customer, nation_of(d, "c_nationkey", "n_name"), ["c_nationkey"])
    return enrich(named, labels, ["c_mktsegment"]).select("c_custkey", "n_name", "label")


@query(
    "jn4_jn5_not_matching",
    f"""SELECT doc_id, quality FROM {LABELLED_SQL}
        WHERE quality IS NULL OR quality = 0""",
)
def jn4_jn5_not_matching(d):
    """A missing quality is not listed, so it stays."""
    listed = d.labels.select("quality").filter("quality = 1").distinct()
    out = not_matching(labelled(d), listed, ["quality"])
    return out.select("doc_id", "quality")


@query(
    "jn6_null_safe_inner",
    f"""WITH l AS (SELECT doc_id, quality FROM {LABELLED_SQL}),
        k AS (SELECT quality, count(*) AS n FROM l GROUP BY quality)
        SELECT doc_id, l.quality, n FROM l JOIN k ON l.quality IS NOT DISTINCT FROM k.quality""",
)
def jn6_null_safe_inner(d):
    rows = labelled(d).select("doc_id", "quality")
    counts = rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    return null_safe_join(rows, counts, ["quality"])


@query(
    "se1_union_by_name",
    """SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance, NULL AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""",
)
def se1_union_by_name(d):
    left = d.customer.select(
        F.col("c_custkey").alias("k"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    right = d.supplier.select(
        F.col("s_nationkey").alias("nation"),
        F.col("s_suppkey").alias("k"),
        F.col("s_name").alias("name"),
    )
    return left.unionByName(right, allowMissingColumns=True)


@query(
    "se2_set_difference",
    """SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders
       WHERE o_orderstatus = 'F'""",
)
def se2_set_difference(d):
    bought = d.orders.filter("o_orderstatus = 'F'").select("o_custkey")
    return d.customer.select(F.col("c_custkey").alias("k")).subtract(bought)


@query(
    "se4_explode",
    """SELECT conv_id, turn, word, count(*) AS n
       FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations)
       GROUP BY ALL""",
)
def se4_explode(d):
    words = d.conversations.select(
        "conv_id", "turn", F.explode(F.split("text", " ")).alias("word")
    )
    return words.groupBy("conv_id", "turn", "word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sc1_variable_display_name",
    """SELECT p_partkey, CASE p_type
         WHEN 'SMALL' THEN 'live animals SMALL (other)' || ' x other'
         WHEN 'LARGE' THEN 'shared borders with country with existing outbreak'
         WHEN 'PROMO' THEN 'ots trade dollars from countries with existing outbreak PROMO from outbreaks'
         ELSE replace(p_type || '_' || p_brand, '_', ' ') END AS variable_clean
       FROM part""",
)
def sc1_variable_display_name(d):
    kind = F.col("p_type")
    variable = (
        F.when(kind == "SMALL", "fao_trade_live_animals_SMALL_other_x_other")
        .when(kind == "LARGE", "shared_borders_from_outbreaks")
        .when(kind == "PROMO", "ots_trade_dollars_from_outbreaks_PROMO_from_outbreaks")
        .otherwise(F.concat_ws("_", kind, "p_brand"))
    )
    return d.part.select("p_partkey", variable_display_name(variable).alias("variable_clean"))


@query(
    "sc2_title_case",
    """SELECT p_partkey, o_case FROM (SELECT p_partkey,
         array_to_string(list_transform(string_split(lower(p_type), ' '), lambda w: upper(w[1]) || w[2:]), ' ')
         || '/' || upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:]
         || '-' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS o_case
       FROM part)""",
)
def sc2_title_case(d):
    name = F.concat(F.lower("p_type"), F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("-")))
    return d.part.select("p_partkey", title_case(name).alias("o_case"))


@query(
    "sc4_contains_remove",
    """SELECT p_partkey, p_name LIKE '%red%' AS is_red,
              CASE WHEN position('i' IN p_name) > 0
                   THEN p_name[:position('i' IN p_name) - 1] || p_name[position('i' IN p_name) + 1:]
                   ELSE p_name END AS removed
       FROM part""",
)
def sc4_contains_remove(d):
    return d.part.select(
        "p_partkey",
        contains("p_name", "red").alias("is_red"),
        replace_first("p_name", "i", "").alias("removed"),
    )


@query(
    "sc5_templates",
    """SELECT s_suppkey, 'girafes/' || s_name || '_' || CAST(s_nationkey AS VARCHAR) || '.html' AS url
       FROM supplier""",
)
def sc5_templates(d):
    url = F.format_string("girafes/%s_%d.html", "s_name", "s_nationkey")
    return d.supplier.select("s_suppkey", url.alias("url"))


@query(
    "sc7_split_list",
    "SELECT p_partkey FROM part WHERE p_brand IN ('Brand#3', 'Brand#7', 'Brand#11')",
)
def sc7_split_list(d):
    wanted = split_list("Brand#3,Brand#7,Brand#11")
    return d.part.filter(F.col("p_brand").isin(wanted)).select("p_partkey")


@query(
    "sc8_casts",
    """SELECT event_id, CAST(trunc(value) AS INTEGER) AS whole,
              CASE WHEN event_type = 'click' THEN CAST(trunc(value) AS INTEGER) END AS maybe,
              CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN FALSE END AS flag,
              trunc(value) <> 0 AS nonzero
       FROM events""",
)
def sc8_casts(d):
    kind, text = F.col("event_type"), F.col("value").cast("string")
    word = F.when(kind == "click", "TRUE").when(kind == "view", "F").otherwise("maybe")
    return d.events.select(
        "event_id",
        to_int(text).alias("whole"),
        to_int(F.when(kind == "click", text).otherwise("n/a")).alias("maybe"),
        text_to_bool(word).alias("flag"),
        number_to_bool(to_int(text)).alias("nonzero"),
    )


@query(
    "sc9_dates",
    """SELECT event_id, strftime(ts, '%m/%d/%Y, %H:%M:%S') AS post_date,
              CAST(extract(year FROM ts) AS INTEGER) AS y, CAST(extract(month FROM ts) AS INTEGER) AS m,
              strftime(date_trunc('month', ts), '%Y-%m-%d') AS first_day
       FROM events""",
)
def sc9_dates(d):
    return d.events.select(
        "event_id",
        post_date_text("ts").alias("post_date"),
        F.year("ts").alias("y"),
        F.month("ts").alias("m"),
        F.date_format(month_start("ts"), "yyyy-MM-dd").alias("first_day"),
    )


@query(
    "sc10_signif",
    """SELECT event_id, round(CASE WHEN value = 0 THEN 0.0 ELSE
                round(value / 500 * pow(10, 1 - floor(log10(value / 500)))) / pow(10, 1 - floor(log10(value / 500)))
                END, 8) AS two_digits,
              value / (value + 1) AS ratio
       FROM events""",
)
def sc10_signif(d):
    value = F.col("value")
    return d.events.select(
        "event_id",
        F.round(signif(value / 500, 2), 8).alias("two_digits"),
        (value / (value + 1)).alias("ratio"),
    )


@query(
    "sc10_percent_label",
    """SELECT l_discount, CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' AS label,
              CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity, count(*) AS n
       FROM lineitem GROUP BY ALL""",
)
def sc10_percent_label(d):
    rows = d.lineitem.select(
        "l_discount",
        percent_label("l_discount").alias("label"),
        number_text("l_quantity").alias("quantity"),
    )
    return rows.groupBy("l_discount", "label", "quantity").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sc11_country_codes",
    """SELECT c_custkey, n_name AS country_name, upper(substr(r_name, 1, 2)) || CAST(n_nationkey AS VARCHAR) AS iso
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       WHERE r_name <> 'ASIA'""",
)
def sc11_country_codes(d):
    """Names without a code are dropped."""
    regions = d.region.filter("r_name <> 'ASIA'")
    named = d.nation.join(regions.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    codes = named.select(
        F.col("n_name").alias("country_name"),
        F.concat(F.substring("r_name", 1, 2), F.col("n_nationkey").cast("string")).alias("iso"),
    )
    buyers = enrich(d.customer, nation_of(d, "c_nationkey", "country_name"), ["c_nationkey"])
    coded = enrich(buyers.select("c_custkey", "country_name"), codes, ["country_name"])
    return coded.dropna(subset=["iso"])


@query(
    "sc14_nested_defaults",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN -1 ELSE CAST(props::JSON ->> 'k' AS INTEGER) END AS k,
              '' AS region FROM events""",
)
def sc14_nested_defaults(d):
    text = F.when(F.col("event_type") != "view", F.col("props"))
    nested = F.from_json(text, "k int, region string")
    return d.events.select("event_id", nested.alias("p")).select(
        "event_id",
        F.coalesce("p.k", F.lit(-1)).alias("k"),
        F.coalesce("p.region", F.lit("")).alias("region"),
    )
