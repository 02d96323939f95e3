import pytest
from pyspark.sql import functions as F

from panelspark.operators import dedupe, ingest
from panelspark.operators.joins import lookup_right, null_safe_join, salted_join


@pytest.fixture
def listing(spark):
    return spark.createDataFrame([(1,), (2,), (3,), (4,)], "report_info_id int")


def test_unfetched(spark, listing, rows):
    log = spark.createDataFrame(
        [("1", False), ("2", True), ("3", None), ("x", False)],
        "report_info_id string, ingest_error boolean",
    )
    got = ingest.unfetched(listing, log, "report_info_id", url_prefix="u/", url_suffix="?")
    assert rows(got) == [(2, "u/2?"), (3, "u/3?"), (4, "u/4?")]
    assert ingest.unfetched(listing, None, "report_info_id").count() == 4


def test_second_run_fetches_nothing(spark, listing):
    log = listing.withColumn("ingest_error", F.lit(False))
    assert ingest.unfetched(listing, log, "report_info_id").count() == 0


def test_classify_errors(spark, rows):
    asked = spark.createDataFrame([(i,) for i in range(5)], "k int")
    got = spark.createDataFrame(
        [
            (0, "available", None),
            (1, "ingestion error: bad", None),
            (2, None, "Endpoint request timed out"),
            (3, None, None),
            (4, "x", "other"),
        ],
        "k int, ingest_status string, message string",
    )
    flags = rows(ingest.classify_errors(asked, got, "k"))
    assert flags == [(0, False), (1, True), (2, True), (3, False), (4, False)]


def test_status_log(spark, rows):
    df = spark.createDataFrame(
        [("a", "available"), ("b", None), ("c", "broken")], "report string, ingest_status string"
    )
    assert rows(ingest.status_log(df)) == [
        ("a", True, None),
        ("b", False, "failed to fetch"),
        ("c", False, "broken"),
    ]


def test_unfetched_flagged(spark, rows):
    listed = spark.createDataFrame(
        [("a", 1, True), ("b", 2, True), ("c", 3, False), ("d", 4, True)],
        "report string, n int, reported boolean",
    )
    log = spark.createDataFrame(
        [("a", 1, True), ("b", 2, None)], "report string, n int, in_database boolean"
    )
    got = ingest.unfetched_flagged(listed, log, ["report", "n"], "r=%s", ["report"], seed=1)
    assert rows(got, "report", "url") == [("b", "r=b"), ("d", "r=d")]
    assert ingest.unfetched_flagged(listed, None, ["report"]).count() == 3


@pytest.mark.parametrize("n, hot", [(0, False), (1, False), (257, False), (300, True)])
def test_positions_are_those_of_a_global_sort(spark, n, hot):
    data = [((7 if hot and i % 3 == 0 else (i * 37) % 101) or None, i) for i in range(n)]
    df = spark.createDataFrame(data, "a int, b int").repartition(5)
    out = ingest.row_positions(df, ["a", "b"], "pos", slices=9).collect()
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r["a"], r["b"]) for r in sorted(out, key=lambda r: r["pos"])] == want
    assert sorted(r["pos"] for r in out) == list(range(1, n + 1))


def test_batches(spark):
    df = spark.range(250).withColumnRenamed("id", "k")
    sizes = ingest.assign_batches(df, ["k"], 100).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in sizes} == {0: 100, 1: 100, 2: 50}


def test_run_mode(spark):
    def tags(*t):
        return spark.createDataFrame([(x,) for x in t], "tag string")

    assert ingest.run_mode(None, "tag", "v") == "full"
    assert ingest.run_mode(tags("v", "v"), "tag", "v") == "incremental"
    assert ingest.run_mode(tags("w"), "tag", "v") == "full"
    assert ingest.run_mode(tags("v", "w"), "tag", "v") == "full"
    assert ingest.run_mode(tags(), "tag", "v") == "full"


def test_any_good(spark):
    log = spark.createDataFrame([(True,), (None,)], "ingest_error boolean")
    assert not ingest.any_good(log)
    assert ingest.any_good(log.unionByName(spark.createDataFrame([(False,)], log.schema)))


def test_changed_rows_is_null_safe(spark, rows):
    new = spark.createDataFrame([("A", None), ("A", 1), ("A", 1), ("B", 2)], "k string, v int")
    cache = spark.createDataFrame([("A", None, 0), ("B", 3, 0)], "k string, v int, extra int")
    got = ingest.changed_rows(new, cache, new.select("k").distinct(), ["k"])
    assert rows(got) == [("A", 1), ("B", 2)]


def test_version_actions(spark, rows):
    docs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "post_id string")
    held = spark.createDataFrame(
        [("a", "2"), ("b", "1"), ("c", None)], "post_id string, update_script_version string"
    )
    got = rows(ingest.version_actions(docs, held, "post_id", "2"))
    assert got == [("a", "skip"), ("b", "update"), ("c", "update"), ("d", "insert")]


def test_parse_report_name(spark):
    df = spark.createDataFrame([("CHE_2020_sem2.html",)], "f string")
    got = df.select(*ingest.parse_report_name("f")).first()
    assert tuple(got) == ("CHE_2020_2", "CHE", 2020, 2)


def test_duplicated_reports_go_everywhere(spark, rows):
    df = spark.createDataFrame(
        [("A", 1, 10), ("A", 1, 11), ("A", 2, 11), ("B", 1, 11), ("B", 1, None), ("C", 1, None)],
        "c string, sem int, report int",
    )
    # 11 repeats 10 in (A, 1), so it leaves (A, 2) and (B, 1) too; a missing id after
    # 11 in (B, 1) makes missing ids duplicates as well
    got = dedupe.drop_duplicated_reports(df, ["c", "sem"], "report")
    assert rows(got) == [("A", 1, 10)]


def test_first_per_key(spark, rows):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (2, None, "z")], "k int, o int, v string")
    assert rows(dedupe.first_per_key(df, ["k"], ["o"])) == [(1, 5, "a"), (2, None, "z")]


def test_drop_all_duplicates(spark, rows):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (None, None), (3, None), (3, "x")],
        "k int, v string",
    )
    assert rows(dedupe.drop_all_duplicates(df, ["k"])) == [(1, "a"), (None, None)]
    assert dedupe.drop_all_duplicates(df.select("k"), ["k"]).count() == 4


def test_invariants(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(ValueError):
        dedupe.require_unique(df, ["k"])
    with pytest.raises(ValueError):
        dedupe.require_unique(spark.createDataFrame([(None,)], "k int"), ["k"])
    dedupe.require_unique(df.distinct(), ["k"])
    dedupe.require_row_count(df, 3)
    with pytest.raises(ValueError):
        dedupe.require_row_count(df, 2)
    with pytest.raises(ValueError):
        dedupe.require_any_new(df, df, ["k"])
    assert tuple(dedupe.invariants(df, ["k"]).first()) == (3, 2, 1)


@pytest.mark.parametrize("how, n", [("inner", 2), ("left", 3), ("right", 3), ("full", 4),
                                    ("left_anti", 1), ("left_semi", 2)])
def test_null_safe_join(spark, how, n):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, l int")
    right = spark.createDataFrame([(None, 4), ("a", 5), ("c", 6)], "k string, r int")
    out = null_safe_join(left, right, ["k"], how)
    assert out.count() == n and out.columns.count("k") == 1
    assert null_safe_join(left, left.withColumnRenamed("l", "m"), ["k"]).count() == 3


def test_lookup_right_keeps_every_key(spark, rows):
    df = spark.createDataFrame([("a", 1), ("x", 2)], "k string, v int")
    keys = spark.createDataFrame([("a", "n"), (None, "m")], "k string, note string")
    assert rows(lookup_right(df, keys, ["k"])) == [("a", 1, "n"), (None, None, "m")]


def test_salted_join_is_the_join(spark, rows):
    big = spark.range(50).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, w string")
    for how in ("inner", "left"):
        assert rows(salted_join(big, small, ["k"], 4, ["v"], how)) == rows(big.join(small, "k", how))
    with pytest.raises(ValueError):
        salted_join(big, small, ["k"], 4, ["v"], "full")


def test_small_side_is_broadcast_only_up_to_its_limit(spark, rows):
    from panelspark.operators.joins import small_side

    df = spark.createDataFrame([(1, None), (2, "b"), (2, "b")], "k int, v string")
    for limit in (1, 10):
        assert rows(small_side(df.distinct(), limit)) == [(1, None), (2, "b")]
    big = df.join(small_side(df.distinct(), 10), "k", "left_semi")
    assert "BroadcastHashJoin" in big._jdf.queryExecution().executedPlan().toString()


def test_positions_evaluate_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    df = spark.range(500).select(counted("id").alias("k"))
    got = ingest.row_positions(df, ["k"], "pos", slices=5).collect()
    assert [(r["k"], r["pos"]) for r in sorted(got)] == [(i, i + 1) for i in range(500)]
    assert seen.value == 500
