"""Candidates, held-out accuracy of the forest, and odd tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from panelspark.llm.secret_scan import FEATURES, find_candidates, fit, labelled_texts, scan, with_features

SMALL = "/root/testdata/sf0.01/documents.parquet"
SCHEMA = "doc_id long, text string, source string, value string, length int, words string"
HEX = hashlib.sha1(b"x").hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(SMALL)


@pytest.fixture(scope="module")
def model(docs):
    return fit(labelled_texts(docs))


def sha(value):
    return hashlib.sha256(value.encode()).hexdigest()


def test_candidates_and_neighbours(spark):
    text = f'Set token = "{HEX}", then password=hunter2xy and mail a.b@c.de or id:4785380592391139.'
    df = spark.createDataFrame([(1, text, "p", "v", 1, "w")], SCHEMA)
    got = {r["value"]: r for r in find_candidates(df, "text", "source", ["doc_id"]).collect()}
    assert set(got) == {HEX, "hunter2xy", "4785380592391139."}
    assert got[HEX]["before"] == ["Set", "token", "="] and got[HEX]["after"][0] == "then"
    assert got["hunter2xy"]["before"][-2:] == ["password", "="] and got[HEX]["path"] == "p"


def test_features_by_hand(spark):
    df = spark.createDataFrame([(1, "api_key = aaB1xampletoken99", "docs/x", "v", 1, "w")], SCHEMA)
    r = with_features(find_candidates(df, "text", "source", ["doc_id"])).first()
    assert r["length"] == 17 and abs(r["digits"] - 3 / 17) < 1e-9 and r["assigned"] == r["named"] == 1
    assert abs(r["covered"] - 5 / 17) < 1e-9 and r["test_path"] == 1 and r["hex"] == 0
    from collections import Counter
    from math import log2

    n = Counter("aaB1xampletoken99")
    assert abs(r["entropy"] + sum(k / 17 * log2(k / 17) for k in n.values())) < 1e-9
    assert set(FEATURES) <= set(r.asDict())


def test_forest_on_findings_it_has_not_seen(docs):
    """Learn from one half of the labelled findings, score the other."""
    cases = labelled_texts(docs).withColumn("part", F.crc32("text") % 2)
    model = fit(cases.filter("part = 0"))
    found = with_features(find_candidates(cases.filter("part = 1"), "text", "path", ["label"]))
    rows = model.transform(found).select("label", "prediction").collect()
    assert len(rows) > 1500 and sum(r["label"] == r["prediction"] for r in rows) / len(rows) > 0.97


def test_forest_on_ways_of_writing_it_has_not_seen(docs):
    """Every way of writing a finding is scored by a forest that saw only other ways."""
    cases = labelled_texts(docs, n=60).cache()
    right = total = 0
    for fold in range(2):
        model = fit(cases.filter(F.col("form") % 2 != fold))
        found = with_features(find_candidates(cases.filter(F.col("form") % 2 == fold), "text", "path", ["label"]))
        for r in model.transform(found).groupBy((F.col("label") == F.col("prediction")).alias("ok")).count().collect():
            total += r["count"]
            right += r["count"] * r["ok"]
    print("accuracy on unseen ways", right, total)
    assert total > 2000 and right / total > 0.8, right / total


def test_time_follows_the_number_of_assignments(spark):
    """Numbers of words and neighbours of all candidates come from one pass over a text."""
    import time

    n = 40_000
    text = "\n".join(f'password_{i} = "x{i}yZ#k"' for i in range(n))
    df = spark.createDataFrame([(1, text, "p", "v", 1, "w")], SCHEMA)
    start = time.perf_counter()
    got = find_candidates(df, "text", "source", ["doc_id"])
    r = got.agg(F.count("*").alias("n"), F.sum("at").alias("at"), F.count_if(F.size("before") == 5).alias("full")).first()
    assert (r["n"], r["at"], r["full"]) == (n, sum(4 * i + 2 for i in range(n)), n - 1)
    assert time.perf_counter() - start < 30
    last = got.orderBy(F.desc("at")).first()
    assert last["before"][-2:] == [f"password_{n - 1}", "="]


def test_documents_tokens_are_found_and_numbers_are_not(docs, model):
    import re

    want = set()
    for d in docs.collect():
        want |= {(d["doc_id"], sha(v)) for v in re.findall(r'(?i)token = "([0-9a-f]{40})', d["text"])}
    got = scan(docs, model).collect()
    assert {(r["doc_id"], r["value_sha256"]) for r in got if r["secret"]} == want
    assert len(got) > len(want)


def test_odd_tables(spark, model):
    long = "word " * 60_000 + f'secret_key = "{HEX}"'
    rows = [(1, long, None, "v", 1, "w"), (2, None, "p", "v", 1, "w"), (3, "", "p", "v", 1, "w")]
    rows += [(4, f'token = "{HEX}"', "p", "v", 1, "w")] * 2 + [(None, f'token = "{HEX}"', "p", "v", 1, "w")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = scan(df, model).collect()
    assert sorted((r["doc_id"] or 0, r["at"]) for r in got) == [(0, 2), (1, 60_002), (4, 2), (4, 2)]
    assert all(r["secret"] and r["value_sha256"] == sha(HEX) and r["length"] == 40 for r in got)
    assert scan(df.limit(0), model).count() == 0
    assert scan(df, None).count() == 4 and scan(df, model, path_col=None).count() == 4
    assert fit(labelled_texts(df.limit(0))) is None


def test_no_python_in_the_plan(docs, model):
    plan = scan(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


#: Text, and what is assigned in it.
ASSIGNED = [
    ('DB_PASSWORD="tR7#kq!92$Lm"', "tR7#kq!92$Lm"),
    ("password: 'a<b>&(c)*9 x'", "a<b>&(c)*9 x"),
    ("export PASSWORD=tR7#kq!92$Lm next", "tR7#kq!92$Lm"),
    ("Server=h;Password=t7#kq(1);Database=y", "t7#kq(1)"),
    ("GET /x?token=tR7k*9q&user=me", "tR7k*9q"),
    ("connect(password=xK9dq2)", "xK9dq2"),
    ("pwd = xK9dq2", "xK9dq2"),
    ("password := xK9dq2", "xK9dq2"),
    ("if password == 'xK9dq2wz':", "xK9dq2wz"),
    ("'password' => 'xK9#q2wz',", "xK9#q2wz"),
    (r'{\"password\": \"tR7#kq!92\"}', "tR7#kq!92"),
    (r'password = "a\"b#c9"', r"a\"b#c9"),
    ("mysql --password tR7#kq!92$Lm -u x", "tR7#kq!92$Lm"),
    ("<password>tR7#kq!92$Lm</password>", "tR7#kq!92$Lm"),
    ("postgres://app:Xk29dlfPq1@db/x", "Xk29dlfPq1"),
    ("redis://:Xk2:9d#lfP@q1@db:6379/x", "Xk2:9d#lfP@q1"),
    ("https://token:Xk29dlfPq1@git/x", "Xk29dlfPq1"),
]


def test_assigned_values_are_whole_candidates(spark):
    rows = [(i, text, "p", "v", 1, "w") for i, (text, _) in enumerate(ASSIGNED)]
    found = find_candidates(spark.createDataFrame(rows, SCHEMA), "text", "source", ["doc_id"]).collect()
    got = {i: [r["value"] for r in found if r["doc_id"] == i] for i in range(len(ASSIGNED))}
    assert got == {i: [value] for i, (_, value) in enumerate(ASSIGNED)}


def test_places_around_assigned_values(spark):
    text = f'a b password = "x#y!z 9" c d DB_URL=pg://u:p#w@h/x token = "see {HEX} there" e'
    df = spark.createDataFrame([(1, text, "p", "v", 1, "w")], SCHEMA)
    got = {r["value"]: r for r in find_candidates(df, "text", "source", ["doc_id"]).collect()}
    assert set(got) == {"x#y!z 9", "p#w", f"see {HEX} there", HEX}
    first = got["x#y!z 9"]
    assert (first["at"], first["before"], first["after"]) == (4, ["a", "b", "password", "="], ["c", "d", "DB_URL"])
    assert got[HEX]["at"] == got[f"see {HEX} there"]["at"] + 1 and got[HEX]["after"] == ["there", "e"]


def test_assigned_secrets_are_kept_and_references_are_not(spark, model):
    no = ["password = None", "author: Smith", 'password = "${DB_PASSWORD}"', "password = os.getenv('PW')",
          "mysql://user:password@localhost/db", 'pwd = "********"']
    rows = [(i, f"some words {text} and more", "src/main", "v", 1, "w") for i, (text, _) in enumerate(ASSIGNED)]
    rows += [(100 + i, f"some words {text} and more", "src/main", "v", 1, "w") for i, text in enumerate(no)]
    got = scan(spark.createDataFrame(rows, SCHEMA), model).filter("secret").collect()
    want = {(i, sha(value)) for i, (_, value) in enumerate(ASSIGNED)}
    assert {(r["doc_id"], r["value_sha256"]) for r in got} == want
