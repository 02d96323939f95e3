"""One key holds a third of all rows; results must stay whole."""

import datetime as dt
from contextlib import contextmanager
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.functions.status import NEVER
from panelspark.operators import dedupe, ingest, panel, quarantine, rollup, views
from panelspark.operators import network
from panelspark.operators.joins import heavy_keys, lookup_right, salted_join, weighted_join

N = 3000


@pytest.fixture(scope="module")
def rows_of(spark):
    """(key, id, value): key 0 on every third row, else spread thinly."""
    data = [(0 if i % 3 == 0 else 1 + i % 400, i, (i * 7919) % 101) for i in range(N)]
    return data, spark.createDataFrame(data, "k int, id int, v int").repartition(6)


def grouped(data):
    out = {}
    for k, i, v in data:
        out.setdefault(k, []).append((i, v))
    return out


def test_first_per_key(rows_of):
    data, df = rows_of
    got = dedupe.first_per_key(df, ["k"], [F.col("v").desc()]).collect()
    want = {k: min(rs, key=lambda r: (-r[1], r[0])) for k, rs in grouped(data).items()}
    assert {r["k"]: (r["id"], r["v"]) for r in got} == want


def test_drop_all_duplicates(rows_of):
    data, df = rows_of
    got = dedupe.drop_all_duplicates(df.select("k", "v"), ["k"]).collect()
    values = {k: {v for _, v in rs} for k, rs in grouped(data).items()}
    assert {r["k"]: r["v"] for r in got} == {k: min(s) for k, s in values.items() if len(s) == 1}


def test_duplicated_reports(rows_of):
    data, df = rows_of
    got = dedupe.drop_duplicated_reports(df, ["k"], "id").collect()
    assert {(r["k"], r["id"]) for r in got} == {(k, min(rs)[0]) for k, rs in grouped(data).items()}


def test_positions(rows_of):
    data, df = rows_of
    got = ingest.row_positions(df, ["k", "id"], "pos", slices=16).collect()
    order = sorted((k, i) for k, i, _ in data)
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["pos"])] == order


def test_long_series(spark):
    values = [float(i) if i % 11 == 0 else None for i in range(N)]
    df = spark.createDataFrame(
        [(0, i, v) for i, v in enumerate(values)] + [(1, 5, None), (1, 6, 2.0)],
        "k int, t int, v double",
    )
    got = panel.interpolate_long(df, ["k"], "t", "v", 64).orderBy("k", "t").collect()
    known = [i for i, v in enumerate(values) if v is not None]
    want = list(np.interp(range(N), known, [values[i] for i in known])) + [2.0, 2.0]
    assert [r["v"] for r in got] == pytest.approx(want)


def test_single_country_and_names(spark, rows_of):
    _, df = rows_of
    named = df.select(
        F.concat(F.lit("d"), "k").alias("disease"), F.col("v").cast("string").alias("country_iso3c")
    )
    flags = {r[0]: r[1] for r in rollup.single_country(named).collect()}
    assert flags["d0"] is False
    names = spark.createDataFrame([("D0", "zero")], "disease_name string, disease_standard string")
    cleaned = quarantine.clean_disease_names(named, names)
    assert cleaned.count() == N
    assert cleaned.filter("disease = 'zero'").count() == N // 3


def test_override(rows_of):
    data, df = rows_of
    cells = df.select(
        F.col("k").cast("string").alias("country_iso3c"),
        F.lit("d").alias("disease"),
        "id",
        F.when(F.col("id") == 3, 1.0).otherwise(0.0).alias("predicted_cases"),
        F.lit(0.0).alias("cases_coalesced"),
        F.lit("s").alias("status_coalesced"),
    )
    out = views.never_reported_override(cells)
    assert out.count() == N
    hot = out.filter("country_iso3c = '0'")
    assert hot.filter("status_coalesced = 's'").count() == N // 3
    assert out.filter(F.col("status_coalesced") == NEVER).count() == N - N // 3


def test_salted_join(rows_of, spark):
    _, df = rows_of
    other = spark.createDataFrame([(0, "a"), (0, "b"), (7, "c")], "k int, w string")
    salted = salted_join(df, other, ["k"], 8, ["id"])
    assert salted.count() == df.join(other, "k").count()
    assert salted.exceptAll(df.join(other, "k").select(*salted.columns)).count() == 0


@contextmanager
def plain_shuffles(spark, partitions=8):
    """Shuffle joins as they are dealt, without adaptive execution's help."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": str(partitions),
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def spread(df):
    """Largest and median number of rows in a task."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts), median(counts)


HOWS = ["inner", "left", "left_semi", "left_anti"]


@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("part_rows", [1, 50, 10**6])
def test_weighted_join_is_the_join(rows_of, spark, how, part_rows):
    _, df = rows_of
    df = df.unionByName(df.limit(40).withColumn("k", F.lit(None).cast("int")))
    other = spark.createDataFrame([(0, "a"), (0, "b"), (7, "c"), (None, "n")], "k int, w string")
    got = weighted_join(df, other, ["k"], how, part_rows=part_rows)
    want = df.join(other, "k", how).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    safe = weighted_join(df, other, ["k"], how, null_safe=True, part_rows=part_rows)
    nulls = {"inner": 40, "left": 40, "left_semi": 40, "left_anti": 0}[how]
    assert safe.filter("k IS NULL").count() == nulls


def test_weighted_join_deals_the_heavy_key(rows_of, spark):
    _, df = rows_of
    other = spark.range(401).select(F.col("id").cast("int").alias("k"))
    assert [r["__parts"] for r in heavy_keys(df, ["k"], 50).collect()] == [20]
    with plain_shuffles(spark):
        most, middle = spread(weighted_join(df, other, ["k"], part_rows=50))
        assert most <= 3 * middle
        assert spread(df.join(other, "k"))[0] > 2 * most
    with pytest.raises(ValueError):
        weighted_join(df, other, ["k"], "full")


def test_exposure_of_one_origin_with_half_the_months(spark):
    """Origin 0 has half of all active months, with edges to every country."""
    month = dt.date(2020, 1, 1)
    status = [(f"c{0 if i % 2 else i % 97}", f"d{i}", month, True, False, False) for i in range(4000)]
    status = spark.createDataFrame(
        status,
        "country_iso3c string, disease string, month date, outbreak_start boolean,"
        " outbreak_subsequent_month boolean, endemic boolean",
    ).repartition(6)
    edges = [(f"c{o}", f"c{t}", 2020, float(o + t)) for o in range(97) for t in range(5)]
    edges = spark.createDataFrame(
        edges, "country_origin string, country_destination string, year int, trade double"
    )
    whole = network.exposure(status, edges, ["trade"], False).collect()
    with plain_shuffles(spark):
        dealt = network.exposure(status, edges, ["trade"], False, part_rows=60)
        most, middle = spread(dealt)
        assert most <= 3 * middle
        assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, whole))


def test_lookup_over_a_country_with_half_the_rows(spark):
    df = spark.createDataFrame(
        [("x" if i % 2 else (None if i % 10 == 0 else f"c{i % 60}"), i) for i in range(3000)],
        "country string, v int",
    ).repartition(6)
    lookup = spark.createDataFrame(
        [("x", 1), (None, 2), ("absent", 3), *[(f"c{i}", i) for i in range(60)]],
        "country string, w int",
    )
    with plain_shuffles(spark):
        got = lookup_right(df, lookup, ["country"], part_rows=50)
        matched = got.filter("v IS NOT NULL")
        most, middle = spread(matched)
        assert most <= 3 * middle and matched.count() == 3000
        alone = {r["country"] for r in got.filter("v IS NULL").collect()}
    assert "absent" in alone and None not in alone and "x" not in alone
    assert {r["w"] for r in got.filter("country IS NULL").collect()} == {2}
