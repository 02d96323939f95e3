"""Extendible-hash index: directory, chains, labels."""

import hashlib

import pytest
from pyspark.sql import functions as F

from panelspark.llm.exact_dedup import build_directory, deduplicate, label_duplicates

SCHEMA = "doc_id long, text string, lang string, key string, bucket long, id string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "k", 1, "x") for i, t in rows], SCHEMA)


def brute(rows):
    out = []
    for i, t in rows:
        same = [j for j, u in rows if (u or "") == (t or "")]
        known = [j for j in same if j is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256((t or "").encode()).hexdigest()
        out.append((i, keep, len(same), i == keep, digest))
    return sorted(out, key=repr)


ROWS = [
    (1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "A"), (7, "a "), (8, "é" * 50_000),
    (9, "é" * 50_000), (10, "b"), (11, "b"), (12, "c"),
]


@pytest.mark.parametrize("bits", [64, 3, 1, 0])
def test_labels_equal_brute_force_even_when_keys_collide(spark, bits):
    got = label_duplicates(table(spark, ROWS), key_bits=bits, bucket_bytes=1)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert label_duplicates(table(spark, [])).count() == 0
    assert deduplicate(table(spark, [])).count() == 0
    rows = [(None, "x"), (None, "x"), (None, "y"), (3, "y"), (5, "z"), (5, "z")]
    got = sorted(map(tuple, label_duplicates(table(spark, rows)).collect()), key=repr)
    assert got == brute(rows)
    kept = deduplicate(table(spark, rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=repr) == [(3, "y"), (5, "z"), (None, "x")]


def test_deduplicate_keeps_columns_and_largest_id(spark):
    kept = deduplicate(table(spark, ROWS))
    assert kept.columns == table(spark, []).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 5, 6, 7, 9, 11, 12]


def test_directory_covers_every_key_once_and_splits_full_buckets(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"), F.lit(10).alias("bytes"))
    directory = build_directory(keys, bucket_bytes=300)
    rows = directory.buckets.collect()
    assert sum(r["keys"] for r in rows) == 5000 and max(r["bytes"] for r in rows) <= 300
    assert directory.depth > 7
    slot = F.shiftrightunsigned("key", 64 - directory.depth)
    assert keys.select(slot.alias("slot")).join(directory.slots(), "slot").count() == 5000


def test_directory_of_one_key_is_one_bucket(spark):
    keys = spark.range(1).select(F.lit(7).cast("long").alias("key"), F.lit(99).alias("bytes"))
    directory = build_directory(keys, bucket_bytes=1)
    assert directory.depth == 0 and directory.entries == 1
