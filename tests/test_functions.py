import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.functions import geo, numbers, periods, status, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "name, shown",
    [
        ("shared_borders_from_outbreaks", "shared borders with country with existing outbreak"),
        ("fao_trade_goats_other", "goats (other)"),
        ("fao_trade_fao_trade_x", "fao trade x"),
        ("continentAsia", "Asia"),
        ("ots_trade_dollars_from_outbreaks", "ots trade dollars from countries with existing outbreak"),
    ],
)
def test_variable_display_name(spark, name, shown):
    assert one(spark, text.variable_display_name(F.lit(name))) == shown


@pytest.mark.parametrize(
    "raw, shown",
    [
        ("foot_and_mouth_disease", "Foot And Mouth Disease"),
        ("sheep/goats", "Sheep/Goats"),
        ("west-nile FEVER", "West-Nile Fever"),
    ],
)
def test_title_case(spark, raw, shown):
    assert one(spark, text.title_case(F.lit(raw))) == shown


def test_replace_first_takes_text_literally(spark):
    assert one(spark, text.replace_first(F.lit("a.b.c$"), ".", "$1")) == "a$1b.c$"


def test_recode_and_buckets(spark):
    assert one(spark, text.recode(F.lit("a"), {"a": "b", "b": "c"})) == "b"
    assert one(spark, text.merge_buckets(F.lit("goats"), ["goats"], "sg")) == "sg"
    assert one(spark, text.contains(F.lit(None).cast("string"), "x")) is False


def test_array_text(spark):
    assert one(spark, text.array_text(F.array(F.lit("a"), F.lit("b")))) == '{"a","b"}'
    assert one(spark, text.array_text(F.array().cast("array<string>"))) == "{}"


@pytest.mark.parametrize(
    "raw, parts", [(None, None), ("", None), ("a", ["a"]), ("a,b", ["a", "b"])]
)
def test_split_list(raw, parts):
    assert text.split_list(raw) == parts


@pytest.mark.parametrize(
    "raw, number", [("12.7", 12), ("-3", -3), ("x", None), (None, None), ("1e3", 1000)]
)
def test_to_int(spark, raw, number):
    assert one(spark, numbers.to_int(F.lit(raw).cast("string"))) == number


@pytest.mark.parametrize("raw, flag", [("T", True), ("false", False), ("yes", None)])
def test_text_to_bool(spark, raw, flag):
    assert one(spark, numbers.text_to_bool(F.lit(raw))) is flag


@pytest.mark.parametrize(
    "x, shown", [(0.1234, "12%"), (0.0123, "1.2%"), (0.0, "0%"), (0.29, "29%"), (1.0, "100%")]
)
def test_percent_label(spark, x, shown):
    assert one(spark, numbers.percent_label(F.lit(x))) == shown


def test_number_text(spark):
    assert one(spark, numbers.number_text(F.lit(12345678.0))) == "12345678"
    assert one(spark, numbers.number_text(F.lit(1.5))) == "1.5"


def test_periods(spark):
    day = F.lit(dt.date(2020, 7, 1))
    assert one(spark, periods.semester(day)) == 2
    assert one(spark, periods.semester(F.lit(None).cast("date"))) is None
    assert one(spark, periods.half_year_axis(F.lit(2020), F.lit(2))) == 2020.5
    index = periods.half_index(F.lit(2020), F.lit(2)) + 1
    assert one(spark, periods.index_year(index)) == 2021
    assert one(spark, periods.index_semester(index)) == 1
    stamp = F.lit("2020-03-04 05:06:07").cast("timestamp")
    assert one(spark, periods.post_date_text(stamp)) == "03/04/2020, 05:06:07"


@pytest.mark.parametrize(
    "actual, unreported, predicted, label",
    [
        (True, True, False, status.REPORTED_PRESENT),
        (False, None, True, status.REPORTED_ABSENT),
        (None, True, True, status.PREDICTED_PRESENT),
        (None, True, False, status.PREDICTED_ABSENT),
        (None, True, None, None),
        (None, False, True, None),
        (None, None, True, None),
    ],
)
def test_status_label(spark, actual, unreported, predicted, label):
    flags = [F.lit(x).cast("boolean") for x in (actual, unreported, predicted)]
    got = one(spark, status.status_label(*flags))
    assert got == label
    rank = one(spark, status.status_rank(F.lit(got).cast("string")))
    assert rank == (status.STATUS_LEVELS.index(label) + 1 if label else None)


def test_outbreak_flag_counts_unknown_as_false(spark):
    null = F.lit(None).cast("boolean")
    assert one(spark, status.outbreak_flag(null, F.lit(False))) is False
    assert one(spark, status.outbreak_flag(null, F.lit(True))) is True


def test_three_state(spark):
    states = [one(spark, status.three_state(F.lit(x).cast("boolean"))) for x in (None, True, False)]
    assert states == ["Missing", "Present", "Absent"]


@pytest.mark.parametrize(
    "a, b, metres",
    [
        # published WGS84 arc lengths along the equator and a meridian
        ((0.0, 0.0), (0.0, 1.0), 111319.491),
        ((0.0, 0.0), (1.0, 0.0), 110574.389),
        ((0.0, 0.0), (90.0, 0.0), 10001965.729),
        ((10.0, 20.0), (10.0, 20.0), 0.0),
    ],
)
def test_geodesic(spark, a, b, metres):
    at = [F.lit(x) for x in (*a, *b)]
    assert one(spark, geo.geodesic_m(*at)) == pytest.approx(metres, rel=1e-5, abs=0.01)
    assert one(spark, geo.great_circle_m(*at)) == pytest.approx(metres, rel=0.006, abs=0.01)
