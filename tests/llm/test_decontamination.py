"""Suffix-array matches against a plain search."""

import random
import re

import pytest

from panelspark.llm import decontamination
from panelspark.llm.decontamination import TestSuffixes as Suffixes
from panelspark.llm.decontamination import decontaminate, find_matches, split_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item string, items int"
TESTS = "item_id long, text string, text_id int"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(text, items, window=10):
    w, hits, best = words(text), set(), {}
    for name, other in items:
        v = words(other)
        n = min(window, len(v))
        for q in range(len(v) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == v[q : q + n]:
                    hits.update(range(p, p + n))
                    m = n
                    while p + m < len(w) and q + m < len(v) and w[p + m] == v[q + m]:
                        m += 1
                    best[str(name)] = max(best.get(str(name), 0), m)
    return len(w), hits, best


def spans(hits):
    return {p for h in hits for p in range(h["first"], h["end"])}


def random_text(rng, n, vocabulary):
    return " ".join(rng.choices(vocabulary, k=n))


def case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "é", "the", "42", "x", "Ω"][: rng.randint(2, 7)]
    items = [(i, random_text(rng, rng.choice([0, 1, 3, 9, 10, 11, 14, 30]), vocabulary)) for i in range(8)]
    texts = []
    for _ in range(12):
        t = random_text(rng, rng.randint(0, 60), [*vocabulary, "zz"])
        if rng.random() < 0.6:
            t = f"{t}, {rng.choice(items)[1].upper()}! {t}"
        texts.append(t)
    return items, texts


@pytest.mark.parametrize("seed", range(40))
def test_search_equals_brute_force(seed, monkeypatch):
    monkeypatch.setattr(decontamination, "SHARD", random.Random(seed).choice([3, 50, 1 << 20]))
    monkeypatch.setattr(decontamination, "PAIRS", random.Random(seed).choice([1, 7, 1 << 20]))
    items, texts = case(seed)
    got = Suffixes([(str(i), t) for i, t in items]).search([t.encode() for t in texts])
    for text, (n, hits, found) in zip(texts, got):
        want = brute(text, items)
        assert n == want[0]
        assert {p for a, b in hits for p in range(a, b)} == want[1]
        assert {m[0] for m in found} == set(want[2])
        for name, length, at, item_at in found:
            v = words(dict(items)[int(name)])
            assert words(text)[at : at + length] == v[item_at : item_at + length]
            assert length == want[2][name]


def test_longest_match_and_place():
    item = " ".join(f"w{i}" for i in range(25))
    text = "w3 w4 " + " ".join(f"w{i}" for i in range(5, 17)) + " other " + " ".join(f"W{i}" for i in range(2, 20))
    ((_, hits, found),) = Suffixes([("7", item)]).search([text.encode()])
    assert found == [("7", 18, 15, 2)] and hits == [(0, 14), (15, 33)]


def test_a_later_place_may_be_longer():
    item = " ".join(f"w{i}" for i in range(30))
    text = " ".join(f"w{i}" for i in range(10)) + " other " + item
    ((_, hits, found),) = Suffixes([("7", item)]).search([text.encode()])
    assert found == [("7", 30, 11, 0)] and hits == [(0, 10), (11, 41)]
    # the item repeats itself, and only its second place goes on
    twice = " ".join(f"v{i}" for i in range(12))
    ((_, _, found),) = Suffixes([("8", f"{twice} x {twice} y z")]).search([f"q {twice} y z".encode()])
    assert found == [("8", 14, 1, 13)]


def test_long_runs_of_one_word():
    item, text = " ".join(["la"] * 60), " ".join(["la"] * 20_000)
    ((n, hits, found),) = Suffixes([("1", item)]).search([text.encode()])
    assert n == 20_000 and hits == [(0, 20_000)] and found == [("1", 60, 0, 0)]


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE", 7)
    text = "one two  three-four " * 50 + "x" * 9000 + " é,end"
    got = [w for part in split_words(text.encode()) for w in part]
    assert got == [w.encode() for w in words(text)]


def test_tables_blocks_nulls_and_clashes(spark):
    items, texts = case(99)
    rows = [(i, t, "n", 3) for i, t in enumerate(texts)] + [(None, None, "n", 3), (1, texts[1], "n", 3), (50, "", "", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    tests = spark.createDataFrame([(i, t, 0) for i, t in items] + [(90, None, 0), (0, items[0][1], 0)], TESTS)
    for block in (1 << 20, 40):
        got = find_matches(docs, tests, block_bytes=block).collect()
        assert len(got) == len(rows)
        for r in got:
            text = dict((x[0], x[1]) for x in rows)[r["doc_id"]]
            n, hits, best = brute(text, items)
            assert (r["n_words"], spans(r["hits"])) == (n, hits)
            assert {m["item"]: m["words"] for m in r["items"]} == best and len(r["items"]) == len(best)
    kept = decontaminate(docs, tests)
    assert kept.columns == docs.columns
    want = sorted(repr(x) for x in rows if not brute(x[1], items)[1])
    assert sorted(repr(tuple(r)) for r in kept.collect()) == want
    assert decontaminate(docs, tests.limit(0)).count() == len(rows)
    assert find_matches(docs.limit(0), tests).count() == 0
