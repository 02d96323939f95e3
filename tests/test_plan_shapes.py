"""What the optimiser makes of the queries, checked on their plans."""

import re

import pytest
from pyspark.sql import DataFrameWriter

from driver_queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["cx1_yearly_panel", "cx2_trade_panel", "jn8_ordered_pairs", "jn9_cross_keys",
     "jn9_cross_keys_long_axis", "se5_append_absent", "se6_add_missing_countries",
     "cx11_nowcast_view", "jn7_lookup_right", "cx17_outbreaks_by_period"],
)
def test_no_cartesian_product(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.fixture
def written(monkeypatch):
    """Plans of everything that is written while a query runs."""
    plans = []

    def recording(write):
        def recorded(self, *args, **options):
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
            return write(self, *args, **options)

        return recorded

    for kind in ("parquet", "json", "csv", "text", "save"):
        monkeypatch.setattr(DataFrameWriter, kind, recording(getattr(DataFrameWriter, kind)))
    return plans


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_the_plans(spark, written, name):
    """Neither in the query's own plan nor in those of the tables that it writes."""
    plans = [plan(spark, name), *written]
    if name.startswith(("sk2_u", "sk2_p", "sk3", "sk7", "sk8", "st1", "cx21", "cx22_score")):
        assert len(plans) > 1
    for text in plans:
        assert "Python" not in text and "Pandas" not in text
        assert "CartesianProduct" not in text


def test_interpolation_adds_one_exchange_and_one_sort(spark):
    from pyspark.sql import functions as F

    from panelspark.operators.panel import interpolate

    df = spark.range(100).select(
        (F.col("id") % 7).alias("k"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"),
    )
    text = interpolate(df, ["k"], ["t"], "v")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and len(re.findall(r"\bSort\b", text)) == 1
    assert "unboundedfollowing" not in text


@pytest.mark.parametrize("name", ["wn2_first_per_key", "wn5_carry_forward"])
def test_ranked_rows_are_limited_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, name))


def test_query_pushes_filters_and_prunes_columns(spark):
    text = plan(spark, "cx14_query_predictions")
    assert "o_orderpriority IN" in text.replace("In(o_orderpriority", "o_orderpriority IN")
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "o_custkey" not in schema and "o_orderkey" not in schema


def test_aggregates_combine_before_the_shuffle(spark):
    assert "partial_sum" in plan(spark, "ag4_rollup_cells")
    assert "partial_min" in plan(spark, "wn3_drop_all_duplicates")


@pytest.mark.parametrize("name", ["cx1_yearly_panel", "se5_append_absent", "wn4_interpolate"])
def test_key_frames_are_spread_before_they_are_expanded(spark, name):
    text = plan(spark, name)
    # plans are printed from the top, so what is read first stands below
    expansions = [m.start() for m in re.finditer(r"Generate (inline|explode)|Join \[__slot", text)]
    assert expansions and text.index("REPARTITION_BY_NUM") > expansions[0]
