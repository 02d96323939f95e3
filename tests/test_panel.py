import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from panelspark.operators import grid, panel


def expected(values):
    known = [i for i, v in enumerate(values) if v is not None]
    if not known:
        return [None] * len(values), [False] * len(values)
    filled = np.interp(range(len(values)), known, [values[i] for i in known])
    return list(filled), [v is None for v in values]


series = st.lists(
    st.one_of(st.none(), st.integers(-1000, 1000).map(float)), min_size=1, max_size=12
)


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(series, min_size=3, max_size=8), st.integers(1, 5))
def test_interpolation_matches_numpy(spark, many, width):
    data = [(k, 3 * t, v) for k, vs in enumerate(many) for t, v in enumerate(vs)]
    df = spark.createDataFrame(data, "k int, t int, v double")
    for out in (
        panel.interpolate(df, ["k"], ["t"], "v"),
        panel.interpolate_long(df, ["k"], "t", "v", width),
    ):
        got = {}
        for r in out.orderBy("k", "t").collect():
            got.setdefault(r["k"], []).append((r["v"], r["imputed_value"]))
        for k, vs in enumerate(many):
            want, flags = expected(vs)
            assert [f for _, f in got[k]] == flags
            for (v, _), w in zip(got[k], want):
                assert (v is None) == (w is None)
                assert w is None or v == pytest.approx(w)


def test_interpolation_keeps_null_series_keys(spark, rows):
    df = spark.createDataFrame(
        [(None, 1, 1.0), (None, 2, None), (None, 5, 3.0)], "k string, t int, v double"
    )
    want = [(None, 1, 1.0, False), (None, 2, 2.0, True), (None, 5, 3.0, False)]
    assert rows(panel.interpolate(df, ["k"], ["t"], "v")) == want
    assert rows(panel.interpolate_long(df, ["k"], "t", "v", 2)) == want


def test_product_is_the_same_for_short_and_long_axes(spark, rows):
    base = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    axis = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "year int, tag string")
    short = grid.product(base, axis)
    long = grid.product(base, axis, slots=64)
    assert short.count() == 6
    assert rows(short) == rows(long)


def test_pairs_drop_self_and_missing(spark, rows):
    df = spark.createDataFrame([("A",), ("B",), ("A",), (None,)], "country_iso3c string")
    df = grid.add_codes(df, ["HKG"])
    got = rows(grid.ordered_pairs(df))
    assert len(got) == 6 and ("A", "A") not in got and ("HKG", "A") in got


def test_fill_grid_drops_data_outside(spark, rows):
    cells = grid.with_years(spark.createDataFrame([("A",)], "c string"), 2000, 2001)
    data = spark.createDataFrame([("A", 2000, 1.0), ("A", 1999, 5.0)], "c string, year int, v double")
    got = rows(panel.fill_grid(data, cells, ["c", "year"]))
    assert got == [("A", 2000, 1.0), ("A", 2001, None)]


def test_carry_forward_only_recent_and_never_backwards(spark, rows):
    df = spark.createDataFrame(
        [
            ("old", 2017, 1.0),
            ("late", 2019, 2.0),
            ("late", 2018, 9.0),
            ("now", 2020, 3.0),
        ],
        "k string, year int, v double",
    )
    got = rows(panel.carry_forward(df, ["k"], "v", 2021).drop("imputed_value"))
    assert got == [("late", 2020, 2.0), ("late", 2021, 2.0), ("now", 2021, 3.0)]
    assert rows(panel.carry_forward(df, ["k"], "v", 2020).select("k")) == [("late",)]
    assert rows(panel.carry_forward(df, ["k"], "v", 2019)) == []


def test_trade_panel_flags(spark):
    wide = spark.createDataFrame(
        [("A", "B", 2019, 5.0, None), ("A", "B", 2020, 6.0, 1.0)],
        "country_origin string, country_destination string, year int, x double, y double",
    )
    cells = grid.with_years(
        grid.ordered_pairs(spark.createDataFrame([("A",), ("B",)], "country_iso3c string")),
        2018,
        2021,
    )
    out = {}
    for flag in ("final", "origin"):
        done = panel.trade_panel(wide, cells, ["x", "y"], 2021, "src", flag=flag)
        assert done.count() == 2 * 4 * 2
        assert {r["source"] for r in done.collect()} == {"src"}
        out[flag] = {
            (r["country_origin"], r["name"], r["year"]): (r["value"], r["imputed_value"])
            for r in done.collect()
        }
    assert out["final"][("A", "y", 2019)] == (0.0, False)
    assert out["origin"][("A", "y", 2019)] == (0.0, True)
    assert out["final"][("A", "x", 2021)] == (6.0, False)
    assert out["origin"][("A", "x", 2021)] == (6.0, True)
    assert out["final"][("B", "x", 2019)] == (0.0, True)
    with pytest.raises(ValueError):
        panel.trade_panel(wide, cells, ["x"], 2021, "src", flag="other")


@pytest.mark.parametrize(
    "last, following", [((2020, 2), [(2021, 1), (2021, 2)]), ((2020, 1), [(2020, 2), (2021, 1)])]
)
def test_next_half_years(spark, rows, last, following):
    df = spark.createDataFrame([(2019, 2), last], "report_year int, report_semester int")
    assert rows(panel.next_half_years(df)) == following


def test_append_absent_fills_only_missing_cells(spark):
    df = spark.createDataFrame(
        [("A", "d", "p", None, 2020, 1, "present"), ("B", "d", "p", None, 2020, 2, "absent")],
        "country_iso3c string, disease string, disease_population string, taxa string, "
        "report_year int, report_semester int, disease_status string",
    )
    out = panel.append_absent(df)
    assert out.count() == 2 * 4
    assert out.filter("disease_status = 'unreported'").count() == 6


def test_add_missing_countries(spark, rows):
    df = spark.createDataFrame(
        [("A", 2020, 1, "d", 4.0), ("A", 2021, 2, "d", 4.0)],
        "country_iso3c string, report_year int, report_semester int, disease string, predicted_cases double",
    )
    drawn = spark.createDataFrame([("A",), ("B",), (None,)], "country_iso3c string")
    out = panel.add_missing_countries(df, drawn, {"predicted_cases": 0.0, "unreported": True})
    added = out.filter("country_iso3c = 'B'")
    assert added.count() == 4 and out.count() == 6
    assert rows(added.select("predicted_cases", "unreported").distinct()) == [(0.0, True)]


def test_yearly_panel_names_its_source(spark):
    cells = grid.with_years(spark.createDataFrame([("A",)], "c string"), 2000, 2004)
    data = spark.createDataFrame([("A", 2001, 1), ("A", 2003, 3)], "c string, year int, v int")
    out = panel.yearly_panel(data, cells, ["c"], "v", "S").orderBy("year")
    assert out.columns == ["c", "year", "v", "imputed_value", "source"]
    assert [r["v"] for r in out.collect()] == [1.0, 1.0, 2.0, 3.0, 3.0]


def test_static_panel_fill(spark, rows):
    cells = spark.createDataFrame([("A", "B"), ("B", "A")], "o string, d string")
    data = spark.createDataFrame([("A", "B", True)], "o string, d string, shared boolean")
    got = rows(panel.static_panel(data, cells, ["o", "d"], fill={"shared": False}))
    assert got == [("A", "B", True), ("B", "A", False)]
    kept = panel.static_panel(data, cells, ["o", "d"], "X").filter(F.col("shared").isNull())
    assert rows(kept) == [("B", "A", None, "X")]
