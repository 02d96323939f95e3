import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelspark.operators import network

D = dt.date
EVENT = (
    "country_iso3c string, disease string, start_date date, last_report_date date, "
    "resolved_date date, endemic boolean"
)
WEIGHTS = ["trade"]
VARIABLES = ["trade_from_outbreaks"]


def months(df):
    out = df.orderBy("month").collect()
    return [(r["month"].isoformat()[:7], r["outbreak_start"], r["outbreak_subsequent_month"]) for r in out]


def test_resolved_event_ends_in_its_month(spark):
    ev = spark.createDataFrame([("A", "d", D(2020, 1, 31), D(2020, 2, 1), D(2020, 3, 5), None)], EVENT)
    got = months(network.month_status(ev, D(2021, 1, 1)))
    assert got == [("2020-01", True, False), ("2020-02", False, True), ("2020-03", False, True)]


def test_open_event_goes_on_a_year_but_not_past_today(spark):
    ev = spark.createDataFrame([("A", "d", D(2020, 1, 5), D(2020, 2, 1), None, True)], EVENT)
    whole = network.month_status(ev, D(2030, 1, 1))
    assert whole.count() == 14 and whole.filter("endemic").count() == 14
    assert network.month_status(ev, D(2020, 3, 31)).count() == 3
    assert network.month_status(ev, D(2019, 1, 1)).count() == 0


def test_overlapping_events_share_months(spark):
    ev = spark.createDataFrame(
        [
            ("A", "d", D(2020, 1, 1), D(2020, 1, 1), D(2020, 2, 1), False),
            ("A", "d", D(2020, 2, 9), D(2020, 2, 9), D(2020, 2, 9), False),
        ],
        EVENT,
    )
    assert months(network.month_status(ev, D(2021, 1, 1))) == [
        ("2020-01", True, False),
        ("2020-02", True, True),
    ]


def test_full_panel_lists_quiet_months(spark):
    ev = spark.createDataFrame([("A", "d", D(2020, 3, 1), D(2020, 3, 1), D(2020, 3, 1), None)], EVENT)
    got = months(network.month_status(ev, D(2020, 4, 30), since=D(2020, 1, 15)))
    assert got == [
        ("2020-01", False, False),
        ("2020-02", False, False),
        ("2020-03", True, False),
        ("2020-04", False, False),
    ]


@pytest.fixture
def status(spark):
    rows = [
        ("A", "d", D(2020, 1, 1), True, False, False),
        ("B", "d", D(2020, 1, 1), False, None, True),
        ("C", "d", D(2020, 1, 1), False, False, None),
        ("A", "d", D(2021, 1, 1), True, False, False),
    ]
    return spark.createDataFrame(
        rows,
        "country_iso3c string, disease string, month date, outbreak_start boolean, "
        "outbreak_subsequent_month boolean, endemic boolean",
    )


@pytest.fixture
def edges(spark):
    return spark.createDataFrame(
        [("A", "C", 2020, 2.0), ("B", "C", 2020, 3.0), ("C", "A", 2020, 50.0), ("A", "B", 2020, 7.0)],
        "country_origin string, country_destination string, year int, trade double",
    )


def test_augment_sums_active_origins(status, edges, rows):
    got = network.augment(status, edges, WEIGHTS)
    assert rows(got, "country_iso3c", F.year("month"), "trade_from_outbreaks") == [
        ("A", 2020, 0.0),
        ("A", 2021, 0.0),
        ("B", 2020, 7.0),
        ("C", 2020, 5.0),
    ]
    assert rows(got) == rows(network.augment(status, edges, WEIGHTS, part_rows=1))


def test_augment_by_origin_adds_up(status, edges, rows):
    got = network.augment(status, edges, WEIGHTS, aggregate_origins=False)
    assert rows(got, "country_iso3c", F.year("month"), "country_origin", "trade_from_outbreaks") == [
        ("A", 2020, None, 0.0),
        ("A", 2021, None, 0.0),
        ("B", 2020, "A", 7.0),
        ("C", 2020, "A", 2.0),
        ("C", 2020, "B", 3.0),
    ]


@pytest.fixture
def coefs(spark):
    return spark.createDataFrame(
        [("d", "trade_from_outbreaks", 0.5), ("d", "(Intercept)", -1.0)],
        "disease string, variable string, coef double",
    )


def test_scale_and_score(spark, status, edges, coefs):
    scaling = spark.createDataFrame(
        [("trade_from_outbreaks", 1.0, 2.0), ("unused", 0.0, 1.0)],
        "variable string, mean double, sd double",
    )
    rows = network.scale(network.augment(status, edges, WEIGHTS), scaling, VARIABLES)
    got = network.score_logit(rows, coefs, VARIABLES).filter("country_iso3c = 'C'").first()
    assert got["trade_from_outbreaks"] == 2.0
    assert got["predicted_outbreak_probability"] == pytest.approx(1 / (1 + math.exp(0.0)))
    twice = scaling.unionByName(scaling)
    with pytest.raises(ValueError):
        network.scale(rows, twice, VARIABLES)


def test_unknown_disease_has_no_score(status, edges, coefs):
    other = network.augment(status.withColumn("disease", F.lit("e")), edges, WEIGHTS)
    got = network.score_logit(other, coefs, VARIABLES)
    assert got.filter("predicted_outbreak_probability is not null").count() == 0
    by_origin = network.augment(status, edges, WEIGHTS, False).withColumn("disease", F.lit("e"))
    relative = network.relative_imports(by_origin, coefs, VARIABLES)
    assert relative.filter("country_rel_import is not null").count() == 0


def test_imports_leave_out_countries_in_outbreak(spark, status, edges, coefs, rows):
    scored = network.score_logit(network.augment(status, edges, WEIGHTS), coefs, VARIABLES)
    drawn = spark.createDataFrame([("A",), ("B",), ("C",), ("Z",)], "country_iso3c string")
    base = network.basemap_status(drawn, scored)
    assert rows(base, "country_iso3c", "cat_status") == [
        ("A", "Current Outbreak"),
        ("A", "Current Outbreak"),
        ("B", "Current Outbreak"),
        ("Z", "Disease never in country"),
    ]
    by_origin = network.augment(status, edges, WEIGHTS, aggregate_origins=False)
    relative = network.relative_imports(by_origin, coefs, VARIABLES)
    imports = network.import_weights(relative, base)
    assert rows(imports, "country_iso3c", "country_origin", "country_rel_import") == [
        ("C", "A", 1.0),
        ("C", "B", 1.5),
    ]
    best = network.top_origins(imports, 1)
    assert rows(best, "country_origin", "import_rank") == [("B", 1)]
    named = network.predictions_by_origin(by_origin, scored)
    assert ("CAd2020-01-01",) in rows(named, "id") and ("ANAd2020-01-01",) in rows(named, "id")


def test_variable_importance(status, edges, coefs):
    scored = network.score_logit(network.augment(status, edges, WEIGHTS), coefs, VARIABLES)
    got = network.variable_importance(scored, coefs, VARIABLES).filter("country_iso3c = 'C'").first()
    assert (got["variable_importance"], got["pos"]) == (2.5, True)
    assert got["probability_label"] == "82%"


def test_months_are_expanded_once_per_key(spark):
    """100 overlapping events of twenty years: marks, not months, are shuffled."""
    import random

    r = random.Random(1)
    schema = "country_iso3c string, disease string, start_date date, last_report_date date, resolved_date date, endemic boolean"
    data = []
    for i in range(100):
        start = D(1990 + r.randrange(4), 1 + r.randrange(12), 1 + r.randrange(28))
        data.append(("A", "pox", start, start, D(2010 + r.randrange(4), 1 + r.randrange(12), 3), i == 7))
    data += [("B", "pox", D(2001, 3, 9), D(2001, 5, 9), None, None), ("B", "pox", D(2003, 1, 1), D(2003, 1, 1), D(2002, 1, 1), True), ("B", None, D(2001, 3, 9), None, D(2001, 3, 20), False)]
    ev = spark.createDataFrame(data, schema)
    got = network.month_status(ev, D(2012, 6, 1))
    want = {}
    for c, d, start, last, resolved, endemic in data:
        end = resolved or D(last.year + 1, last.month, 1)
        for m in range(start.year * 12 + start.month - 1, min(end.year * 12 + end.month, 2012 * 12 + 6)):
            flags = want.setdefault((c, d, D(m // 12, m % 12 + 1, 1)), [False, False, False])
            first = m == start.year * 12 + start.month - 1
            flags[0] |= first
            flags[1] |= not first
            flags[2] |= bool(endemic)
    assert {(r[0], r[1], r["month"]): [r["outbreak_start"], r["outbreak_subsequent_month"], r["endemic"]] for r in got.collect()} == want
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.index("Generate explode") < text.index("Exchange") < text.index("Generate inline")
