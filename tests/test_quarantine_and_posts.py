import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.operators import posts, quarantine

T = dt.datetime


@pytest.fixture
def names(spark):
    return spark.createDataFrame(
        [("Foot rot", "foot_rot"), ("FOOT ROT ", "foot_rot"), ("pox", "pox"), ("flu", "flu"), ("bse", "bse")],
        "disease_name string, disease_standard string",
    )


def test_names_are_cleaned_once(spark, names, rows):
    df = spark.createDataFrame([("A", " foot ROT"), ("A", "??"), ("A", None)], "country_iso3c string, disease string")
    assert rows(quarantine.clean_disease_names(df, names)) == [
        ("A", "foot_rot", " foot ROT"),
        ("A", None, "??"),
        ("A", None, None),
    ]


@pytest.fixture
def world(spark, names):
    schema = "report_id int, country_iso3c string, disease string, is_aquatic boolean"
    history = spark.createDataFrame(
        [(1, "A", "pox", False), (2, "B", "pox", False), (3, "B", "flu", False), (8, "Q", "bse", False)],
        schema,
    )
    new = spark.createDataFrame(
        [
            (4, "A", "pox", False),
            (5, "A", "??", False),
            (6, "A", "Foot rot", False),
            (7, "A", "flu", True),
            (9, "A", "bse", False),
        ],
        schema,
    )
    taxa = spark.createDataFrame(
        [("pox", True), ("foot_rot", False), ("flu", True), ("bse", True)],
        "disease string, disease_primary_taxa boolean",
    )
    model = spark.createDataFrame([("pox",), ("flu",)], "disease string")

    def expand(events):
        return events.select("country_iso3c", "disease", "disease_name_uncleaned").distinct()

    return history, new, names, taxa, model, expand


def test_incremental_run_touches_new_keys_only(spark, world, rows):
    history, new, *rest = world
    kept, rejected = quarantine.preprocess_events(new, history, *rest)
    assert rows(kept, "country_iso3c", "disease") == [("A", "pox")]
    assert rows(rejected, "disease_name_uncleaned", "reason_for_exclusion") == [
        ("??", quarantine.UNRECOGNIZED),
        ("Foot rot", quarantine.NOT_PRIMARY_TAXA),
        ("bse", quarantine.NOT_IN_MODEL),
    ]
    cache = kept.withColumn("extra", F.lit(1))
    again, _ = quarantine.preprocess_events(new, history, *rest, cache=cache)
    assert again.count() == 0


def test_full_run_also_drops_single_country_diseases(world, rows):
    history, new, *rest = world
    kept, rejected = quarantine.preprocess_events(new, history, *rest, full=True)
    assert rows(kept, "country_iso3c", "disease") == [("A", "pox"), ("B", "pox")]
    assert ("flu", quarantine.SINGLE_COUNTRY) in rows(
        rejected, "disease_name_uncleaned", "reason_for_exclusion"
    )
    only, _ = quarantine.preprocess_events(None, history, *rest, full=True)
    assert rows(only, "country_iso3c") == [("A",), ("B",)]
    with pytest.raises(ValueError):
        quarantine.preprocess_events(new, None, *rest)


def post(post_id, **given):
    empty = {
        "post_date": None, "subject": None, "counts": None, "dates": None, "geonames": None,
        "keywords_disease": None, "keywords_species": None, "subject_disease_labels": None,
        "subject_geonames": None, "subject_keywords_disease": None, "subject_keywords_species": None,
    }
    return {"post_id": post_id, **empty, **given}


@pytest.fixture
def nested(spark):
    dates = [{"datetime_range": [T(2019, 12, 31), T(2020, 1, 2)]}, {"datetime_range": [T(2020, 5, 1)]}]
    counts = [
        {"attributes": ["case", "dead"], "count": 4},
        {"attributes": ["dead"], "count": 100},
        {"attributes": None, "count": 7},
        {"attributes": ["case"], "count": None},
    ]
    data = [
        post("1", post_date=T(2020, 3, 4, 5, 6, 7), counts=counts, dates=dates, geonames=["A", "A", "B"],
             keywords_disease=["pox"], subject_disease_labels=["pox", "flu"], keywords_species=["cow", "pig"],
             subject={"description": "text", "region": None, "additional_info": None,
                      "disease_labels": ["pox"]}),
        post("2", dates=dates, geonames=["A"], keywords_disease=["pox"], keywords_species=["cow", "hen"]),
        post("3", dates=dates, geonames=["A"]),
        post("4", dates=[], geonames=["A"], keywords_disease=["pox"]),
        post("5", dates=dates, geonames=[], keywords_disease=["pox"]),
        post("6", dates=dates, geonames=["B"], keywords_disease=["rot"], counts=counts),
    ]
    return spark.createDataFrame(data, posts.POST_SCHEMA)


def test_posts_are_counted_once_per_cell(nested):
    got = {tuple(r)[:3]: tuple(r)[3:] for r in posts.aggregate_posts(nested).collect()}
    assert got[("pox", "A", 2020)] == (["cow", "hen", "pig"], 2, 4)
    assert got[("flu", "B", 2019)] == (["cow", "pig"], 1, 4)
    assert got[("rot", "B", 2020)] == ([], 1, 4)
    assert len(got) == 2 * 2 * 2 + 2


def test_flat_posts_fill_missing_fields(nested):
    flat = {r["post_id"]: r for r in posts.flatten_posts(nested, "http://x/?id=", "1").collect()}
    one, two = flat["1"], flat["2"]
    assert (one["post_url"], one["post_date"]) == ("http://x/?id=1", "03/04/2020, 05:06:07")
    assert (one["post_year"], one["post_semester"]) == (2020, 1)
    assert (one["subject_description"], one["subject_region"]) == ("text", "")
    assert one["subject_disease_labels"] == '{"pox"}'
    assert (two["post_date"], two["post_year"], two["post_semester"]) == ("", -1, -1)
    assert (two["counts"], two["subject_description"]) == ("", "")
