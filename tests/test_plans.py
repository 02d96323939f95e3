import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.plans import annual, covariates, outbreak, six_month
from panelspark.operators.posts import POST_SCHEMA
from panelspark.sources.tables import Tables

D = dt.date


def test_outbreak_run_end_to_end(spark, tables, rows):
    listing = spark.createDataFrame([(1,), (2,), (3,)], "report_info_id int")
    state = {1: ("available", None), 2: ("ingestion error: x", None), 3: (None, None)}

    def responses(asked):
        got = spark.createDataFrame(
            [(k, *v) for k, v in state.items()],
            "report_info_id int, ingest_status string, message string",
        )
        return got.join(asked.select("report_info_id"), "report_info_id", "left_semi")

    def parsed(got):
        good = got.filter("ingest_status is null or ingest_status not like '%error%'")
        day = F.lit("2020-01-05").cast("date")
        events = good.select(
            F.col("report_info_id").alias("report_id"),
            F.when(F.col("report_info_id") == 1, "A").otherwise("B").alias("country_iso3c"),
            F.lit("pox").alias("disease"),
            F.lit(False).alias("is_aquatic"),
            day.alias("start_date"),
            day.alias("last_report_date"),
            F.lit("2020-02-01").cast("date").alias("resolved_date"),
            F.lit(False).alias("endemic"),
        )
        places = good.select(
            F.col("report_info_id").alias("report_id"),
            F.explode(F.array(F.lit(1), F.lit(2))).alias("outbreak_location_id"),
            F.lit(None).cast("string").alias("species_name"),
        )
        return {
            outbreak.EVENTS: events,
            outbreak.OUTBREAKS: places,
            outbreak.UNMATCHED: spark.createDataFrame([("odd",), ("odd",)], "disease string"),
        }

    new = outbreak.ingest(tables, listing, responses, parsed, "u/")
    assert new.count() == 2
    assert rows(tables.read(outbreak.LOG), "report_info_id", "ingest_error") == [
        (1, False),
        (2, True),
        (3, False),
    ]
    assert tables.read(outbreak.OUTBREAKS).count() == 4
    assert rows(tables.read(outbreak.UNMATCHED)) == [("odd",)]

    names = spark.createDataFrame([("pox", "pox")], "disease_name string, disease_standard string")
    taxa = spark.createDataFrame([("pox", True)], "disease string, disease_primary_taxa boolean")
    coefs = spark.createDataFrame(
        [("pox", "trade_from_outbreaks", 0.5)], "disease string, variable string, coef double"
    )
    scaling = spark.createDataFrame(
        [("trade_from_outbreaks", 0.0, 1.0)], "variable string, mean double, sd double"
    )
    edges = spark.createDataFrame(
        [("A", "B", 2020, 2.0)],
        "country_origin string, country_destination string, year int, trade double",
    )

    def score(fresh, history, tag):
        return outbreak.score(
            tables, fresh, history, names, taxa, coefs, scaling, edges, ["trade"], tag, D(2020, 6, 1),
            since=D(2020, 1, 1),
        )

    first = score(None, tables.read(outbreak.EVENTS), "v1")
    # every month of every country, in outbreak or not
    assert rows(first, "country_iso3c", F.month("month")) == [(c, m) for c in "AB" for m in range(1, 7)]
    assert rows(first.filter("outbreak_start or outbreak_subsequent_month"), "country_iso3c", F.month("month")) == [
        ("A", 1), ("A", 2), ("B", 1), ("B", 2)]
    by_origin = tables.read(outbreak.BY_ORIGIN)
    assert rows(by_origin.filter("country_iso3c = 'B'"), "country_origin").count(("A",)) == 2

    # the failed report arrives next time, as a third country
    state[2] = ("available", None)
    history = tables.read(outbreak.EVENTS)
    listing = listing.filter("report_info_id = 2")
    later = outbreak.ingest(tables, listing, responses, parsed, "u/")
    later = later.withColumn("country_iso3c", F.lit("C"))
    second = score(later, history, "v1")
    assert second.count() == 18
    assert {r["model_tag"] for r in second.collect()} == {"v1"}
    assert tables.read(outbreak.CHANGED).count() == 6  # only the new country
    assert tables.read(outbreak.STATUS).count() == 18

    # nothing is left to fetch, and a new model scores everything again
    done = outbreak.ingest(tables, listing, responses, parsed, "u/")
    assert done is None
    everything = history.unionByName(later)
    assert score(None, everything, "v1").count() == 18  # the monthly run
    assert score(None, everything, "v2").filter("model_tag = 'v2'").count() == 18


def test_a_corrected_event_gives_what_a_full_run_gives(spark, tables, tmp_path, rows):
    schema = (
        "report_id int, country_iso3c string, disease string, is_aquatic boolean, start_date date,"
        " last_report_date date, resolved_date date, endemic boolean"
    )
    day = D(2020, 1, 5)
    open_, other = (1, "A", "pox", False, day, day, None, False), (2, "B", " POX", False, day, day, day, False)
    before = spark.createDataFrame([open_, other], schema)
    corrected = spark.createDataFrame([(1, "A", "pox", False, day, day, D(2020, 2, 1), False)], schema)
    after = corrected.unionByName(before.filter("report_id = 2"))
    names = spark.createDataFrame([("pox", "pox")], "disease_name string, disease_standard string")
    taxa = spark.createDataFrame([("pox", True)], "disease string, disease_primary_taxa boolean")
    coefs = spark.createDataFrame([("pox", "trade_from_outbreaks", 0.5)], "disease string, variable string, coef double")
    scaling = spark.createDataFrame([("trade_from_outbreaks", 0.0, 1.0)], "variable string, mean double, sd double")
    edges = spark.createDataFrame(
        [("A", "B", 2020, 2.0), ("B", "A", 2020, 1.0)],
        "country_origin string, country_destination string, year int, trade double",
    )

    def score(store, fresh, history):
        outbreak.score(store, fresh, history, names, taxa, coefs, scaling, edges, ["trade"], "v1",
                       D(2020, 6, 1), D(2020, 1, 1))
        return [rows(store.read(t)) for t in (outbreak.PREDICTIONS, outbreak.BY_ORIGIN)]

    score(tables, None, before)
    active = F.col("outbreak_start") | F.col("outbreak_subsequent_month")
    assert tables.read(outbreak.PREDICTIONS).filter(active & (F.col("country_iso3c") == "A")).count() == 6
    step = score(tables, corrected, before)
    whole = score(Tables(spark, str(tmp_path / "full")), None, after)
    assert step == whole
    assert tables.read(outbreak.PREDICTIONS).filter(active & (F.col("country_iso3c") == "A")).count() == 2
    # B is scored anew as well, since A sends it nothing from March on
    assert tables.read(outbreak.CELLS).filter("country_iso3c = 'B'").count() == 4
    assert "variable_clean" in tables.read(outbreak.COEFFICIENTS).columns


def test_reports_are_fetched_once(spark, tables):
    mark = f"{tables.root}-fetched"

    def responses(asked):
        @F.udf("string")
        def fetch(k):
            open(f"{mark}-{k}", "a").write("x")
            return "available"

        return asked.select("report_id", fetch("report_id").alias("ingest_status"),
                            F.lit(None).cast("string").alias("message"))

    def parsed(got):
        summary = got.select(
            *[F.lit("x").alias(c) for c in six_month.SUMMARY_KEY if c not in ("report_year", "report_semester")],
            F.lit(2020).alias("report_year"), F.lit(1).alias("report_semester"), "report_id")
        detail = summary.drop("control_measures").withColumns({"adm": F.lit("a"), "period": F.lit("p")})
        return {six_month.SUMMARY: summary, six_month.DETAIL: detail}

    six_month.ingest(tables, spark.createDataFrame([(5,)], "report_id int"), responses, parsed, "u/")
    assert open(f"{mark}-5").read() == "x"


def test_six_month_run(spark, tables, rows):
    listing = spark.createDataFrame([(10,), (11,)], "report_id int")

    def responses(asked):
        return asked.select("report_id", F.lit("available").alias("ingest_status"),
                            F.lit(None).cast("string").alias("message"))

    def parsed(got):
        summary = got.select(
            F.lit("CHE").alias("country_iso3c"),
            F.lit(2020).alias("report_year"),
            F.lit(1).alias("report_semester"),
            F.lit("pox").alias("disease"),
            F.lit("domestic").alias("disease_population"),
            F.lit("cattle").alias("taxa"),
            F.lit(None).cast("string").alias("serotype"),
            F.lit(None).cast("string").alias("control_measures"),
            "report_id",
        )
        detail = summary.drop("control_measures").withColumns(
            {"adm": F.lit("x"), "period": F.lit("m1"), "n": F.explode(F.array(F.lit(1), F.lit(2)))}
        )
        return {six_month.SUMMARY: summary, six_month.DETAIL: detail}

    stored = six_month.ingest(tables, listing, responses, parsed, "u/", "?p")
    # the second report repeats the first one's country and half-year
    assert rows(stored, "id", "report_id") == [("CHE20201poxdomesticcattleNANA", 10)]
    assert tables.read(six_month.DETAIL).count() == 1
    scored = stored.select(
        *six_month.GROUP,
        *six_month.ITEM,
        F.lit(2.0).alias("cases"),
        F.lit(1).alias("disease_status"),
        F.lit(0).alias("disease_status_unreported"),
        F.lit(1.0).alias("predicted_cases"),
    )
    rolled = six_month.store_predictions(tables, scored, ["pox"], {"db_cases_etag": "v1"})
    assert rows(rolled, "id", "status_coalesced") == [("CHEpox20201", "reported present")]
    assert tables.read(six_month.PREDICTIONS).first()["db_cases_etag"] == "v1"


def test_annual_ingest(spark, tables, rows):
    listing = spark.createDataFrame(
        [("a", "A", 2020, 1, True), ("b", "B", 2020, 1, True), ("c", "C", 2020, 1, False)],
        "report string, country_iso3c string, report_year int, report_semester int, reported boolean",
    )

    def responses(asked):
        got = asked.filter("report = 'a'")
        return got.withColumn("ingest_status", F.lit("available"))

    def parsed(got):
        many = got.select("report", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
        return {
            "annual_reports_animal_hosts": many,
            "annual_reports_diseases_unmatched": spark.createDataFrame([("odd",)], "disease string"),
        }

    for _ in range(2):
        log = annual.ingest_annual(tables, listing, responses, parsed, "y=%d&c=%s",
                                   ["report_year", "country_iso3c"])
    assert rows(log, "report", "in_database", "ingest_error") == [
        ("a", True, None),
        ("b", False, "failed to fetch"),
    ]
    assert tables.read("annual_reports_animal_hosts").count() == 2


def test_posts_are_rewritten_on_a_new_version(spark, tables, rows):
    nested = spark.createDataFrame([("1",), ("2",)], "post_id string")
    schema = spark.createDataFrame([], POST_SCHEMA).schema
    for f in schema[1:]:
        nested = nested.withColumn(f.name, F.lit(None).cast(f.dataType))
    annual.update_posts(tables, nested.filter("post_id = '1'"), "u", "1")
    both = annual.update_posts(tables, nested, "u", "2")
    assert rows(both, "post_id", "update_script_version") == [("1", "2"), ("2", "2")]
    versions = tables.versions(annual.POSTS)
    annual.update_posts(tables, nested, "u", "2")
    assert tables.versions(annual.POSTS) == versions
    assert annual.update_post_counts(tables, nested).count() == 0


@pytest.fixture
def countries(spark):
    return spark.createDataFrame([("A",), ("B",), ("C",)], "country_iso3c string")


def test_covariate_panels(spark, tables, countries, rows):
    moved = spark.createDataFrame(
        [("A", "B", 2000, 10), ("A", "B", 2004, 30)],
        "country_origin string, country_destination string, year int, n_human_migrants int",
    )
    panel = covariates.bilateral_yearly(moved, countries, "n_human_migrants", "UN", 2005)
    assert panel.count() == 6 * 6
    ab = panel.filter("country_origin = 'A' and country_destination = 'B'").orderBy("year")
    assert [r["n_human_migrants"] for r in ab.collect()] == [10.0, 15.0, 20.0, 25.0, 30.0, 30.0]

    herd = spark.createDataFrame(
        [("A", 2000, "goats", 1.0), ("A", 2000, "sheep", 2.0), ("A", 2002, "sheep", 5.0)],
        "country_iso3c string, year int, taxa string, population double",
    )
    taxa = covariates.taxa_yearly(herd, countries, "FAO", 2002)
    assert rows(taxa.filter("country_iso3c = 'A'"), "taxa", "year", "population") == [
        ("sheep/goats", 2000, 3.0),
        ("sheep/goats", 2001, 4.0),
        ("sheep/goats", 2002, 5.0),
    ]

    vets = spark.createDataFrame(
        [("A", 2001, "laboratories", "4")],
        "country_iso3c string, year int, veterinarian_field string, total_count string",
    )
    counts = covariates.veterinarians_yearly(vets, countries, "reports", 2002)
    assert counts.count() == 9 and counts.filter("imputed_value").count() == 2

    wide = moved.withColumn("x", F.lit(2.0)).drop("n_human_migrants")
    lookup = spark.createDataFrame([("x", "thing")], "name string, item string")
    stored, totals = covariates.trade_tables(
        tables, wide, countries, lookup, "trade", "dollars", "OTS", 2005
    )
    assert stored.count() == totals.count() == 36
    assert totals.filter("dollars > 0").count() == 3  # 2000, 2004 and carried to 2005


def test_static_tables(spark, countries, rows):
    borders = spark.createDataFrame(
        [("A", "B", True)],
        "country_origin string, country_destination string, shared_border boolean",
    )
    out = covariates.bilateral_static(borders, countries, None, {"shared_border": False})
    assert out.count() == 6 and out.filter("shared_border").count() == 1
    points = spark.createDataFrame(
        [("A", 0.0, 0.0), ("B", 0.0, 1.0), ("C", None, 1.0)],
        "country_iso3c string, lat double, lon double",
    )
    far = rows(covariates.country_distance(points))
    assert [r[:2] for r in far] == [("A", "B"), ("B", "A")]
    assert far[0][2] == pytest.approx(111319.49, abs=1)
