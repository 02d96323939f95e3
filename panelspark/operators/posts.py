"""News posts: nested documents to flat rows and to yearly counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.periods import post_date_text, semester
from ..functions.text import array_text

POST_SCHEMA = """
    post_id string,
    post_date timestamp,
    subject struct<description: string, region: string, additional_info: string,
                   disease_labels: array<string>>,
    counts array<struct<attributes: array<string>, count: int>>,
    dates array<struct<datetime_range: array<timestamp>>>,
    geonames array<string>,
    keywords_disease array<string>,
    keywords_species array<string>,
    subject_disease_labels array<string>,
    subject_geonames array<string>,
    subject_keywords_disease array<string>,
    subject_keywords_species array<string>
"""

# The attribute that marks a case count, and the fill for missing fields.
CASE = "case"
NO_TEXT = ""
NO_NUMBER = -1


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(NO_TEXT))


def _number(c: Column) -> Column:
    return F.coalesce(c, F.lit(NO_NUMBER))


def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def flatten_posts(posts: DataFrame, url_prefix: str, version: str) -> DataFrame:
    """One flat row per post, missing fields as empty text or -1."""
    subject = F.col("subject")
    return posts.select(
        "post_id",
        F.concat(F.lit(url_prefix), F.col("post_id")).alias("post_url"),
        _text(subject["description"]).alias("subject_description"),
        _text(subject["region"]).alias("subject_region"),
        _text(subject["additional_info"]).alias("subject_additional_info"),
        _text(array_text(subject["disease_labels"])).alias("subject_disease_labels"),
        _text(array_text("subject_geonames")).alias("subject_geonames"),
        _text(array_text("subject_keywords_disease")).alias("subject_keywords_disease"),
        _text(array_text("subject_keywords_species")).alias("subject_keywords_species"),
        _text(post_date_text("post_date")).alias("post_date"),
        _number(F.year("post_date")).alias("post_year"),
        _number(semester("post_date")).alias("post_semester"),
        _text(F.to_json("counts")).alias("counts"),
        _text(array_text("keywords_disease")).alias("keywords_disease"),
        _text(array_text("keywords_species")).alias("keywords_species"),
        _text(array_text("geonames")).alias("geonames"),
        F.lit(version).alias("update_script_version"),
    )


def valid_post() -> Column:
    """A disease, a place and a date are all given."""
    named = (F.size(_list("subject_disease_labels")) > 0) | (
        F.size(_list("keywords_disease")) > 0
    )
    placed = F.size(_list("geonames")) > 0
    dated = F.coalesce(F.size("dates"), F.lit(0)) > 0
    return named & placed & dated


def post_facts(posts: DataFrame) -> DataFrame:
    """Valid posts with their distinct diseases, places and years, and case sum.

    Missing date ranges and missing dates within a range are passed over.
    """
    known = F.filter(
        F.coalesce("dates", F.array().cast(posts.schema["dates"].dataType)),
        lambda d: d["datetime_range"].isNotNull(),
    )
    ranges = F.transform(known, lambda d: F.transform(d["datetime_range"], lambda t: F.year(t)))
    years = F.filter(F.flatten(ranges), lambda y: y.isNotNull())
    cases = F.filter(
        F.coalesce("counts", F.array().cast(posts.schema["counts"].dataType)),
        lambda c: F.array_contains(c["attributes"], CASE),
    )
    total = F.aggregate(
        cases, F.lit(0).cast("long"), lambda acc, c: acc + F.coalesce(c["count"], F.lit(0))
    )
    diseases = F.concat(_list("subject_disease_labels"), _list("keywords_disease"))
    return posts.filter(valid_post()).select(
        "post_id",
        F.array_distinct(diseases).alias("diseases"),
        F.array_distinct(_list("geonames")).alias("places"),
        F.array_distinct(years).alias("years"),
        F.array_distinct(_list("keywords_species")).alias("species"),
        total.alias("cases"),
    )


def aggregate_posts(posts: DataFrame) -> DataFrame:
    """Posts, cases and species per disease, country and year.

    A post counts once for each of its diseases, places and years. Its species are
    exploded, and posts and cases are counted on the first species row only. The first
    aggregate still has species in its key, so it hashes fixed-size counters and splits
    a large group; only distinct species reach the second, which lists them.
    """
    facts = post_facts(posts)
    key = ["disease_name", "disease_country", "disease_year"]
    cells = (
        facts.select("*", F.explode("diseases").alias("disease_name"))
        .select("*", F.explode("places").alias("disease_country"))
        .select("*", F.explode("years").alias("disease_year"))
        .select(*key, "cases", F.posexplode_outer("species").alias("__pos", "__species"))
    )
    once = F.coalesce("__pos", F.lit(0)) == 0
    by_species = cells.groupBy(*key, "__species").agg(
        F.count_if(once).alias("n_posts"),
        F.sum(F.when(once, F.col("cases")).otherwise(0)).alias("n_cases"),
    )
    return by_species.groupBy(*key).agg(
        F.array_sort(F.collect_set("__species")).alias("disease_species"),
        F.sum("n_posts").alias("n_posts"),
        F.sum("n_cases").alias("n_cases"),
    )
