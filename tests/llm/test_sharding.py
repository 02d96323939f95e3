"""Histogram sort against a sort in one process."""

import random

import pytest
from pyspark.sql import functions as F

from panelspark.llm.sharding import find_cuts, shard

SCHEMA = "doc_id long, size long, shard string, note string"


def brute(rows, n):
    """Shard and slot of rows (key, size), keys distinct."""
    total, before, out, slots = sum(s for _, s in rows), 0, [], {}
    for k, s in sorted(rows):
        at = sum(before >= -(-total * i // n) for i in range(1, n))
        out.append((k, at, slots.setdefault(at, 0)))
        slots[at] += 1
        before += s
    return out


@pytest.mark.parametrize("spread", [1, 10**15])
def test_equals_brute_force(spark, spread):
    rng = random.Random(5)
    keys = rng.sample(range(-500, 500), 400)
    rows = [(k * spread, rng.choice([1, 5, 40, 3000])) for k in keys]
    df = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    got = shard(df, "doc_id", F.col("size"), 16).select("doc_id", "shard", "slot").collect()
    assert sorted(map(tuple, got)) == brute(rows, 16)


def test_hot_key_is_cut_by_tie(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("doc_id"),
        F.lit(10).cast("long").alias("size"),
        F.col("id").cast("string").alias("note"),
    )
    got = shard(df, "doc_id", F.col("size"), 8).groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"), F.min("slot").alias("a"), F.max("slot").alias("z")
    )
    for r in got.collect():
        assert abs(r["n"] - 900 / 8) <= 1 and r["a"] == 0 and r["z"] == r["n"] - 1


def test_a_repeated_row_is_cut_too(spark):
    """A third of the table is one row; every shard still gets its share of the bytes."""
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.lit(10).cast("long").alias("size"),
    ).repartition(5)
    got = shard(df, "doc_id", F.col("size"), 16)
    sizes = {r["shard"]: r["count"] for r in got.groupBy("shard").count().collect()}
    assert len(sizes) == 16 and all(abs(n - 900 / 16) <= 2 for n in sizes.values())
    slots = got.groupBy("shard").agg(F.countDistinct("slot").alias("n"), F.max("slot").alias("z")).collect()
    assert all(r["n"] == r["z"] + 1 == sizes[r["shard"]] for r in slots)
    assert got.filter("doc_id = 7").count() == 301


def test_text_keys(spark):
    df = spark.range(400).select(F.concat(F.lit("doc-"), "id").alias("doc_id"), F.lit(3).cast("long").alias("size"))
    df = df.unionByName(spark.createDataFrame([(None, 3)], "doc_id string, size long"))
    got = shard(df, "doc_id", F.col("size"), 8).groupBy("shard").count().collect()
    assert sum(r["count"] for r in got) == 401 and all(abs(r["count"] - 50) <= 1 for r in got)


def test_nulls_repeats_and_empty(spark):
    rows = [(None, None, "x", None), (None, 5, "x", None), (3, -7, "x", "n"), (3, 4, "x", "n")] * 3
    got = shard(spark.createDataFrame(rows, SCHEMA), "doc_id", F.col("size"), 4)
    assert got.columns == ["doc_id", "size", "note", "shard", "slot"]
    by = {}
    for r in got.collect():
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, by.values())) == 12
    assert all(sorted(s) == list(range(len(s))) and 0 <= k < 4 for k, s in by.items())
    none = spark.createDataFrame([], SCHEMA)
    assert shard(none, "doc_id", F.col("size"), 4).count() == 0


def test_tolerance_stops_early(spark):
    df = spark.range(1 << 16).select(
        F.xxhash64("id").alias("key"), F.col("id").alias("tie"), F.lit(1).cast("long").alias("size")
    )
    (cut,) = find_cuts(df, [1 << 15], tolerance=2000)
    below = df.filter(F.col("key") < cut[0]).count()
    assert abs(below - (1 << 15)) <= 2000


def test_query_slots_and_sizes(spark):
    from panelspark.llm.queries import QUERIES

    df = QUERIES["op7_sharding"](spark, "/root/testdata/sf0.001")
    rows = df.collect()
    plain = brute([(r["doc_id"], r["size"]) for r in rows], 16)
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows) == plain
    import zlib

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {d["doc_id"]: (len(d["text"].encode()) + 1, zlib.crc32(d["text"].encode())) for d in docs}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == want
