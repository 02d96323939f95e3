"""Sketches, components and near duplicates against brute force."""

import random

import numpy as np
import pytest

from panelspark.llm import near_dedup
from panelspark.llm.components import components
from panelspark.llm.near_dedup import (
    Hashed,
    SIZE,
    drop_near_duplicates,
    label_near_duplicates,
    parity_map,
    shingle_hashes,
    shingles,
    sketch,
    sketch_bits,
    text_words,
)

SCHEMA = "doc_id long, text string, n long, class string, node int, key string"


def brute(rows):
    sets = {i: shingles(text_words((t or "").encode())) for i, t in rows}
    ids = sorted(sets)
    part = {i: i for i in ids}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                part[high] = low
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def texts(seed):
    """Groups of copies with more and more changed words, and texts with a common passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    out = []
    for _ in range(14):
        base = rng.choices(vocabulary, k=rng.choice([1, 4, 5, 9, 30, 120, 400]))
        out.append(base)
        for _ in range(rng.randint(0, 9)):
            copy = list(base if rng.random() < 0.5 else out[-1])
            for _ in range(rng.randint(0, max(1, len(copy) // 60))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(copy)
    for _ in range(40):
        out.append(passage + rng.choices(vocabulary, k=rng.randint(1, 60)))
    return [" ".join(w) for w in out]


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEADERS", 1)
    rows = list(enumerate(texts(seed)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, rows[0][1].upper()), (904, rows[0][1] + " ")]
    df = spark.createDataFrame([(i, t, 1, "c", 2, "k") for i, t in rows], SCHEMA)
    want = brute(rows)
    assert got(label_near_duplicates(df)) == want
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [w[0] for w in want if w[3]]


def test_query_equals_brute_force(spark):
    from panelspark.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    df = QUERIES["op9_near_dedup"](spark, "/root/testdata/sf0.001")
    assert got(df) == brute([(d["doc_id"], d["text"]) for d in docs])


def test_empty_null_ids_and_repeated_rows(spark):
    a = "one two three four five six seven"
    rows = [(None, a), (3, a), (3, a), (1, a + "!"), (None, "alone here"), (None, None), (7, None)]
    df = spark.createDataFrame([(i, t, 1, "c", 2, "k") for i, t in rows], SCHEMA)
    out = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in label_near_duplicates(df).collect()]
    assert sorted(out, key=repr) == sorted(
        [(None, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True), (1, 3, 1, True),
         (None, 1, None, True), (None, 0, None, True), (7, 0, 7, True)], key=repr)
    assert label_near_duplicates(df.limit(0)).count() == 0
    assert drop_near_duplicates(df.limit(0)).count() == 0


def test_an_id_with_several_texts(spark):
    """Of (1, A), (2, A near) and (2, other) the other text stays."""
    a = " ".join(f"w{i}" for i in range(60))
    near, other = a + " more", " ".join(f"u{i}" for i in range(60))
    rows = [(1, a), (2, near), (2, other), (3, other + " x"), (3, "short one"), (2, near)]
    df = spark.createDataFrame([(i, t, 1, "c", 2, "k") for i, t in rows], SCHEMA)
    out = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in label_near_duplicates(df).collect())
    assert out == [(1, 56, 1), (2, 56, 2), (2, 57, 1), (2, 57, 1), (3, 1, 3), (3, 57, 2)]
    kept = sorted((r["doc_id"], r["text"]) for r in drop_near_duplicates(df).collect())
    assert kept == [(1, a), (2, other), (3, "short one")]


def test_many_followers_of_one_leader(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LED_ROWS", 7)
    monkeypatch.setattr(near_dedup, "LARGEST", 1)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(90)] + [(200 + i, " ".join([*base[:40], f"y{i // 2}", f"z{i % 2}"])) for i in range(20)]
    df = spark.createDataFrame([(i, t, 1, "c", 2, "k") for i, t in rows], SCHEMA)
    assert got(label_near_duplicates(df)) == brute(rows)


def test_sketch_is_full_and_estimates_similarity():
    known, rng = Hashed(), random.Random(9)
    for n in (1, 2, 7, 40, 300, 5000):
        words = [b"%d" % rng.randrange(10**9) for _ in range(n + 4)]
        a = shingle_hashes(words, known)
        assert len(a) == n and (sketch(a) != np.uint64((1 << 64) - 1)).all()
    shared = np.random.default_rng(1).integers(0, 1 << 63, 7500, dtype=np.uint64)
    rest = np.random.default_rng(2).integers(0, 1 << 63, 2500, dtype=np.uint64)
    a, b = sketch(np.concatenate((shared, rest[:1250]))), sketch(np.concatenate((shared, rest[1250:])))
    assert abs((a == b).mean() - 0.75) < 0.1
    bits = np.unpackbits((sketch_bits(a) ^ sketch_bits(b)).view(np.uint8)).sum()
    assert 256 - bits >= near_dedup.LEAST_BITS
    assert SIZE >= 256


def test_sketch_equals_its_definition():
    """Round by round with plain numbers."""
    x = np.random.default_rng(3).integers(0, 1 << 63, 11, dtype=np.uint64)
    filled = {}
    for i in range(2 * SIZE):
        for e in x:
            h = near_dedup._mix(np.array([e ^ near_dedup._SEEDS[i]]))
            place = int((h[0] >> np.uint64(40)) % np.uint64(SIZE)) if i < SIZE else i - SIZE
            value = (i << 54) | int(near_dedup._mix(h)[0] >> np.uint64(10))
            filled[place] = min(filled.get(place, 1 << 64), value)
        if len(filled) == SIZE:
            break
    assert [filled[i] for i in range(SIZE)] == sketch(x).tolist()


def test_parity_maps_bound_the_difference():
    rng = np.random.default_rng(8)
    for n in (3, 60, 500, 4000):
        for k in (0, n // 10, n // 2):
            x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            y = np.concatenate((x[k:], rng.integers(0, 1 << 63, k, dtype=np.uint64)))
            apart = np.bitwise_count((parity_map(x) ^ parity_map(y)).view(np.uint64)).sum()
            assert apart <= len(np.setxor1d(x, y))


def test_components_of_chains_stars_and_none(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 130)] + [(500, i) for i in range(501, 600)] + [(7, 7)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    out = {r["node"]: r["component"] for r in components(df).collect()}
    assert out == {**{i: 100 for i in range(100, 131)}, **{i: 500 for i in range(500, 600)}}
    assert components(df.limit(0)).count() == 0
