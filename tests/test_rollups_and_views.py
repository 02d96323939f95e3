import time

import pytest
from pyspark.sql import functions as F

from panelspark.functions.status import NEVER, PREDICTED_ABSENT
from panelspark.operators import qa, rollup, views
from panelspark.sources.tables import Tables

CELL = "country_iso3c string, disease string, report_year int, report_semester int"


def test_nowcast_summary(spark):
    df = spark.createDataFrame(
        [
            ("A", "d", 2020, 1, "x", 0.0, 3.0, 1, 0),
            ("A", "d", 2020, 1, "y", None, None, None, 1),
            ("B", "d", 2020, 1, "x", 2.0, None, None, 1),
            ("B", "d", 2020, 1, "y", None, None, None, 1),
            ("C", "d", 2020, 1, "x", 0.0, None, None, 1),
            ("D", "other", 2020, 1, "x", 0.0, None, None, 1),
        ],
        CELL + ", taxa string, predicted_cases double, cases double, "
        "disease_status int, disease_status_unreported int",
    )
    got = {r["country_iso3c"]: r for r in rollup.nowcast_summary(df, ["d"]).collect()}
    assert set(got) == {"A", "B", "C"}
    a, b, c = got["A"], got["B"], got["C"]
    assert a["id"] == "Ad20201"
    assert (a["predicted_status"], a["predicted_cases"], a["actual_cases"]) == (None, None, 3.0)
    assert (a["status_coalesced"], a["disease_status_unreported"]) == ("reported present", False)
    assert (b["predicted_status"], b["status_coalesced"]) == (True, "unreported, predicted present")
    assert (b["actual_cases"], b["predicted_cases"]) == (None, None)
    assert (c["status_coalesced"], c["status_rank"]) == (PREDICTED_ABSENT, 4)


def test_veterinarians_and_taxa(spark, rows):
    vets = spark.createDataFrame(
        [
            ("A", 2020, "laboratories", "12.7"),
            ("A", 2020, "laboratories", "x"),
            ("A", 2020, "students", "5"),
            ("B", 2020, "pharmaceutical industry", "many"),
        ],
        "country_iso3c string, year int, veterinarian_field string, total_count string",
    )
    assert rows(rollup.veterinarian_count(vets)) == [("A", 2020, 12), ("B", 2020, None)]
    taxa = spark.createDataFrame(
        [("A", 2020, "goats", 1.0), ("A", 2020, "sheep", None), ("A", 2020, "cattle", None)],
        "country_iso3c string, year int, taxa string, population double",
    )
    assert rows(rollup.taxa_population(taxa)) == [
        ("A", 2020, "cattle", 0.0),
        ("A", 2020, "sheep/goats", 1.0),
    ]


def test_single_country_and_bounds(spark, rows):
    df = spark.createDataFrame(
        [("d", "A"), ("d", "A"), ("e", "A"), ("e", "B"), ("f", None)],
        "disease string, country_iso3c string",
    )
    assert rows(rollup.single_country(df)) == [("d", True), ("e", False), ("f", False)]
    assert rows(rollup.bounds(df, "disease")) == [("d", "f")]


@pytest.fixture
def summary(spark):
    return spark.createDataFrame(
        [
            ("A", "d_x", 2020, 1, False, None, 0.0, 0.0, True, "s"),
            ("A", "d_x", 2020, 2, False, None, 0.0, None, True, "s"),
            ("B", "d_x", 2020, 1, True, True, None, 5.0, False, "t"),
            ("B", "d_x", 2020, 2, True, False, 0.0, 0.0, False, "t"),
            ("C", "d_x", 2020, 1, None, None, None, None, None, "u"),
        ],
        CELL + ", predicted_status boolean, actual_status boolean, predicted_cases double, "
        "actual_cases double, disease_status_unreported boolean, status_coalesced string",
    )


def test_nowcast_view(spark, summary):
    drawn = spark.createDataFrame([("A",), ("Z",)], "country_iso3c string")
    names = spark.createDataFrame([("A", "Aland")], "country_iso3c string, country_name string")
    got = {
        (r["country_iso3c"], r["report_semester"]): r
        for r in views.nowcast_view(summary, drawn, names).collect()
    }
    assert len(got) == 7
    assert got[("A", 1)]["status_coalesced"] == NEVER
    assert got[("B", 1)]["status_coalesced"] == "t"  # a known case decides
    assert got[("C", 1)]["status_coalesced"] is None  # unknown stays unknown
    z = got[("Z", 2)]
    assert (z["status_coalesced"], z["yr"], z["disease_clean"]) == (NEVER, 2020.5, "D X")
    assert z["disease_status_unreported"] is True and z["country_name"] is None
    assert got[("B", 1)]["label"] == "Reported cases = 5<br/>Predicted cases = NA"
    assert got[("A", 2)]["label"] == "Reported cases = missing<br/>Predicted cases = 0"


def test_long_views(summary, rows):
    view = summary.withColumn("yr", F.lit(2020.0))
    shown = views.presence_long(view)
    assert shown.count() == 10
    assert rows(shown.filter("country_iso3c = 'C'"), "type", "missing") == [
        ("Predicted", "Missing"),
        ("Reported", "Missing"),
    ]
    line = views.timeline_long(summary.filter("country_iso3c = 'B'"))
    assert rows(line, "yr", "type", "cases", "presence", "missing", "label")[1] == (
        2020.0,
        "Reported",
        5.0,
        True,
        "Present",
        "Reported: 5<br/>Predicted: 0",
    )


@pytest.fixture
def predictions(spark):
    return spark.createDataFrame(
        [(3, "A", 2019, 1.0), (1, "B", 2020, 2.0), (2, "A", 2020, 3.0)],
        "id int, country_iso3c string, report_year int, predicted_cases double",
    )


def test_query_filters_before_it_projects(predictions, rows):
    got = views.query_predictions(predictions, columns="predicted_cases", countries="A", years="2020,2018")
    assert got.columns == ["predicted_cases"] and rows(got) == [(3.0,)]
    assert rows(views.query_predictions(predictions, columns="id", limit="2")) == [(1,), (2,)]
    assert views.query_predictions(predictions).count() == 3


def test_stored_query_opens_files_of_its_countries(spark, tmp_path, rows):
    tables = Tables(spark, str(tmp_path / "t"), buckets=16)
    many = spark.range(900).selectExpr(
        "id", "concat('C', id % 30) AS country_iso3c", "CAST(2000 + id % 7 AS INT) AS report_year", "id / 2 AS predicted_cases"
    )
    tables.overwrite(many, "p", **views.CLUSTERED)
    got = views.query_stored(tables, "p", countries="C3,C4", years="2001", columns="id")
    want = views.query_predictions(many, countries="C3,C4", years="2001", columns="id")
    assert rows(got) == rows(want) != []
    assert len(got.inputFiles()) <= 2 < len(tables.read("p").inputFiles())
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "In(report_year" in text or "report_year,2001" in text
    assert views.query_stored(tables, "p", years="2001").count() == many.filter("report_year = 2001").count()


def test_cache_holds_until_cleared(predictions, tables, rows):
    cache = views.QueryCache(predictions, tables, most=2, grace=0)
    first = rows(cache.get(countries="A"))
    assert first == rows(cache.get(cache=False, countries="A")) != []
    empty = views.QueryCache(predictions.limit(0), tables, most=2, grace=0)  # another process finds it
    assert rows(empty.get(countries="B")) == [] and len(tables.names()) == 2
    time.sleep(0.01)
    assert rows(empty.get(countries="A", years=None)) == first
    cache.get(limit="1")  # the result for B is the one that was not used since
    assert len(tables.names()) == 2 and rows(empty.get(countries="A")) == first
    assert rows(views.QueryCache(predictions, tables).get(countries="B")) != []
    cache.clear()
    assert tables.names() == [] and rows(empty.get(countries="A")) == []


def test_cache_keeps_what_is_being_read(predictions, tables, rows):
    cache = views.QueryCache(predictions, tables, most=1, grace=600)
    held = [cache.get(limit=str(n)) for n in (1, 2, 3)]
    cache.clear()
    assert [h.count() for h in held] == [1, 2, 3] and len(tables.names()) == 3


def test_cache_keeps_as_many_as_it_may(predictions, tables):
    cache = views.QueryCache(predictions, tables, most=8, grace=0)
    for n in range(9):
        cache.get(limit=str(n))
    assert len(tables.names()) == 8


def test_cache_is_never_stale(predictions, tables, tmp_path, rows):
    source = Tables(predictions.sparkSession, str(tmp_path / "source"))
    source.overwrite(predictions, "p")
    old = views.QueryCache.over(source, "p", tables).get(countries="A")
    source.overwrite(predictions.withColumn("predicted_cases", F.lit(7.0)), "p")
    new = views.QueryCache.over(source, "p", tables).get(countries="A")
    assert {r["predicted_cases"] for r in new.collect()} == {7.0}
    assert {r["predicted_cases"] for r in old.collect()} != {7.0}


def test_reported_vs_calculated(spark, rows):
    detail = spark.createDataFrame(
        [(1, None, "2", "x"), (1, None, "3", None), (2, "b", "1", "1")],
        "id int, species string, cases string, deaths string",
    )
    given = spark.createDataFrame(
        [(1, None, "6", "4"), (2, "b", "1", "<1")],
        "id int, species string, total_cases string, total_deaths string",
    )
    got = qa.reported_vs_calculated(detail, given, measures=["cases", "deaths"])
    assert rows(got) == [(1, None, "cases", 5.0, 6.0)]


def test_period_checks(spark, rows):
    df = spark.createDataFrame(
        [
            ("ok", None, "Jan-Jun", 1, 2),
            ("ok", None, "Jul-Dec", 1, 2),
            ("ok", None, "Jan-Dec", 2, 3),
            ("new", None, "Jan-Jun", 1, 2),
            ("new", None, "Jan-Dec", 2, 2),
            ("total", None, "Jan-Jun", 1, 2),
            ("total", None, "Jan-Dec", 1, 3),
            ("half only", None, "Jan-Jun", 1, 2),
            ("unknown new", None, "Jan-Jun", None, 2),
            ("unknown new", None, "Jan-Dec", 1, 3),
        ],
        "disease string, serotype string, report_months string, new_outbreaks int, total_outbreaks int",
    )
    got = qa.outbreaks_by_period_check(df, ["disease", "serotype"])
    assert rows(got, "disease") == [("new",), ("total",), ("unknown new",)]
    hosts = df.withColumnRenamed("total_outbreaks", "cases")
    assert rows(qa.cases_by_period_check(hosts, ["disease"]), "disease") == [("total",), ("unknown new",)]
    assert qa.new_above_total(df.withColumn("new_outbreaks", F.lit(3))).count() == 7


def test_schema_checks(spark, rows):
    a = spark.createDataFrame([(1, None)], "x int, y string")
    assert qa.drop_empty_cols(a).columns == ["x"]
    table = qa.schema_table({"t": a})
    wanted = qa.schema_table({"t": a.withColumnRenamed("y", "z")})
    assert qa.field_check(table, table).count() == 0
    assert rows(qa.field_check(table, wanted), "column_name", "problem") == [
        ("y", "in database, not in schema"),
        ("z", "in schema, not in database"),
    ]


def test_bad_rows(spark, rows):
    log = spark.createDataFrame(
        [("a", True, None), ("b", False, "failed to fetch"), ("c", False, "ingestion error: x")],
        "report string, in_database boolean, ingest_error string",
    )
    assert rows(qa.unexpected_errors(log), "report") == [("c",)]
    assert rows(qa.ingestion_errors(log), "report") == [("c",)]
    listed = spark.createDataFrame([("d", False), ("e", True)], "report string, reported boolean")
    assert rows(qa.all_missing(log, listed), "report") == [("b",), ("c",), ("d",)]
