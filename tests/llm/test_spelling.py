"""Near words by blocked products against all pairs, and groups against plain Python."""

import random

import numpy as np
import pytest

from panelspark.llm import spelling
from panelspark.llm.queries import QUERIES, SQL
from tests.compare import connect, difference, spark_table, sql_table

SMALL = "/root/testdata/sf0.01"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=10):
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def rows(df):
    got = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(got) == len({r["word"] for r in got})
    return {tuple(r) for r in got}


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)


def made_words(seed, size, letters="abé"):
    r = random.Random(seed)
    return {"".join(r.choices(letters, k=r.randint(1, 7))): 10 ** r.randint(0, 5) + r.randint(0, 1) for _ in range(size)}


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_all_pairs(spark, seed):
    words = made_words(seed, 400)
    assert rows(spelling.group_variants(frame(spark, words))) == brute(words)


def test_small_chunks_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK_WORDS", 3)
    words = made_words(5, 300, "ab")
    assert rows(spelling.group_variants(frame(spark, words), 2)) == brute(words, 2)


def test_tables_that_grow_are_not_broadcast(spark, monkeypatch):
    plans, stored = [], spelling.stored

    def recorded(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(spelling, "stored", recorded)
    words = made_words(7, 300)
    got = spelling.group_variants(frame(spark, words))
    recorded(got, "groups")
    assert {name for name, _ in plans} == {"words", "keyed", "chunks", "near", "forms", "roots", "groups"}
    # of the blocks, only those of more than one chunk are looked up
    assert {name for name, text in plans if "Broadcast" in text} <= {"chunks"}
    assert rows(got) == brute(words)


def test_blocks_equal_all_pairs():
    r = random.Random(3)
    for same, longer in ((True, 0), (False, 0), (False, 1)):
        a = sorted({"".join(r.choices("abcñ", k=5)) for _ in range(200)})
        b = a if same else sorted({"".join(r.choices("abcñ", k=5 + longer)) for _ in range(150)})
        i, j = spelling.near_rows(a, b, same)
        got = sorted(zip(i.tolist(), j.tolist()))
        want = [(x, y) for x in range(len(a)) for y in range(len(b)) if one_edit(a[x], b[y]) and (not same or x < y)]
        assert got == want


def test_every_edit_moves_to_a_compared_block():
    r = np.random.default_rng(0)
    moves = {(d, tuple(c)) for d, c in spelling._moves()}
    for _ in range(300):
        old, new = r.integers(0, spelling.CLASSES, 2)
        swap = np.zeros(spelling.CLASSES, int)
        swap[old] -= 1
        swap[new] += 1
        assert (0, tuple(swap)) in moves or (0, tuple(-swap)) in moves
        put = np.zeros(spelling.CLASSES, int)
        put[new] = 1
        assert (1, tuple(put)) in moves


def test_chain_of_forms_ties_and_long_words(spark):
    words = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "aaabbbb": 10**4, "aabbbbb": 10**5}
    words |= {"zzz": 5, "zzx": 50, "zzy": 50, "yzz": 50}
    words |= {"l" * 30000: 1, "l" * 30000 + "x": 10, "k" + "l" * 29999: 9}
    words |= {"𝒳ab": 1, "𝒴ab": 20, "ab": 20, "": 7}
    got = rows(spelling.group_variants(frame(spark, words)))
    del words[""]
    assert got == brute(words)
    assert ("aaaaaaa", "aaaaaab", "aabbbbb", 1, 1, 10) in got and ("zzz", "yzz", "yzz", 5, 3, 50) in got


def test_odd_tables(spark):
    schema = "word string, n int, length int, cut string, form string, best string"
    assert rows(spelling.group_variants(spark.createDataFrame([], schema))) == set()
    odd = [(None, 3), ("abc", 1), ("abc", 4), ("abd", 50), ("abd", None), ("q", 1)]
    got = rows(spelling.group_variants(spark.createDataFrame([(*r, 1, "x", "y", "z") for r in odd], schema)))
    assert got == brute({"abc": 5, "abd": 50, "q": 1})
    with pytest.raises(ValueError):
        spelling.group_variants(spark.createDataFrame([], schema), 1)


def test_runs(spark):
    texts = [("Straße x-Ångström ABCdefǵhij abcdef ABCDEFGÉ", ["ångström".replace("å", "Å"), "abcdefg", "abcdefgÉ"]), (None, []), ("", [])]
    got = spark.createDataFrame([(t,) for t, _ in texts], "t string").select(spelling.runs("t", 7).alias("r")).collect()
    assert [r["r"] for r in got] == [w for _, w in texts]


def test_query_equals_sql(spark):
    got = spark_table(QUERIES["op13_spelling"](spark, SMALL))
    assert difference(got, sql_table(connect(SMALL), SQL["op13_spelling"])) is None


def test_query_on_odd_documents(spark, tmp_path):
    docs = [(1, None), (2, ""), (3, "abcdefgh " * 3000), (None, "abcdefgh abcdefgh abcdefgx"), (5, "abcdefgx abcdefgx")]
    docs = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, run string, h int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["word"]: (r["n"], r["form"]) for r in QUERIES["op13_spelling"](spark, str(tmp_path)).collect()}
    assert got["abcdefgx"] == (3, "abcdefgh") and got["abcdefgh"][0] == 3002
