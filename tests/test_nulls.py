import pytest
from pyspark.sql import Window, functions as F

from panelspark.functions import nulls

GROUPS = {
    "known": ([1, 2], [True, False]),
    "mixed": ([1, None], [True, None]),
    "mixed_false": ([0, None], [False, None]),
    "none": ([None, None], [None, None]),
    "all_true": ([1, 1], [True, True]),
    "all_false": ([0, 0], [False, False]),
}

SUMS = {
    "known": (3, 3, 3),
    "mixed": (None, 1, 1),
    "mixed_false": (None, 0, 0),
    "none": (None, None, 0),
    "all_true": (2, 2, 2),
    "all_false": (0, 0, 0),
}

LOGIC = {  # any_known, any_kleene, all_kleene
    "known": (True, True, False),
    "mixed": (True, True, None),
    "mixed_false": (False, None, False),
    "none": (None, None, None),
    "all_true": (True, True, True),
    "all_false": (False, False, False),
}


@pytest.fixture(scope="module")
def frame(spark):
    data = [(g, x, b) for g, (xs, bs) in GROUPS.items() for x, b in zip(xs, bs)]
    return spark.createDataFrame(data, "g string, x int, b boolean")


def test_sums(frame):
    got = frame.groupBy("g").agg(
        nulls.sum_strict("x"), nulls.sum_known("x"), nulls.sum_or_zero("x")
    )
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == SUMS


def test_logic(frame):
    got = frame.groupBy("g").agg(
        nulls.any_known("b"), nulls.any_kleene("b"), nulls.all_kleene("b")
    )
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == LOGIC


def test_over_a_window_equals_the_group(frame):
    w = Window.partitionBy("g")
    got = frame.select(
        "g",
        nulls.sum_strict("x", w),
        nulls.any_kleene("b", w),
        nulls.all_kleene("b", w),
    ).distinct()
    want = {g: (SUMS[g][0], LOGIC[g][1], LOGIC[g][2]) for g in GROUPS}
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


def test_surrogate_id_names_missing_parts(spark):
    from panelspark.functions.text import surrogate_id

    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert df.select(surrogate_id("x", "y", "z")).first()[0] == "aNA3"
    assert df.select(F.concat("x", "y")).first()[0] is None
