"""String kernels against sets of n-grams, and held-out accuracy."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from panelspark.llm import language as lang
from panelspark.llm.language import drop_unknown, identify, mark, solve, train

SCHEMA = "doc_id long, text string, lang string, score string, found int"
SAMPLES = {
    "en": "the house and the garden of that old man with this thing over there is what they have",
    "de": "das haus und der garten von dem alten mann mit dieser sache die dort ist nicht schön",
    "fr": "la maison et le jardin du vieil homme avec cette chose qui est là où ils été ont",
}


def rows(n=40):
    out, i = [], 0
    for name, text in SAMPLES.items():
        words = text.split()
        for k in range(n):
            picked = [words[(k * 7 + j * (k % 5 + 1)) % len(words)] for j in range(5 + k % 9)]
            out.append((i, " ".join(picked).title() + "!", name, "s", 1))
            i += 1
    return out


def test_marks_are_ngram_presence():
    text = "Aé b9z " * 3
    row = np.zeros(lang.SLOTS, np.uint8)
    mark(row, text.lower().encode())
    b = text.lower().encode().translate(lang.TABLE)
    want = set()
    for n in range(1, lang.ORDERS + 1):
        for i in range(len(b) - n + 1):
            code = int.from_bytes(b[i : i + n], "big")
            want.add((code * int(lang._ODD[n - 1])) % (1 << 32) >> int(lang._SHIFT))
    assert set(np.flatnonzero(row).tolist()) == want


def test_long_texts_in_pieces(monkeypatch):
    whole, cut = np.zeros(lang.SLOTS, np.uint8), np.zeros(lang.SLOTS, np.uint8)
    text = "Die Häuser, und all das übrige! ".lower().encode() * 20
    mark(whole, text)
    monkeypatch.setattr(lang, "PIECE", 11)
    mark(cut, text)
    assert (whole == cut).all()


def test_landmarks_of_all_texts_give_plain_kernel_ridge():
    """With every text as a landmark the Nyström solution is the exact one."""
    data = rows(8)
    packed = []
    for _, text, *_ in data:
        row = np.zeros(lang.SLOTS, np.uint8)
        mark(row, text.lower().encode())
        packed.append(np.packbits(row))
    labels = [r[2] for r in data]
    model = solve(labels, np.array(packed), landmarks=1000)
    bits = np.unpackbits(np.array(packed), axis=1).astype(float)
    k = bits @ bits.T / np.sqrt(np.outer(bits.sum(1), bits.sum(1)))
    n, y = len(labels), np.where(np.array(labels)[:, None] == np.array(model.languages), 1.0, -1.0)
    system = np.block([[k + lang.RIDGE * n * np.eye(n), np.ones((n, 1))], [np.ones((1, n)), np.zeros((1, 1))]])
    solution = np.linalg.solve(system, np.vstack((y, np.zeros((1, y.shape[1])))))
    want = k @ solution[:-1] + solution[-1]
    got = model.scores([r[1].lower().encode() for r in data], *model.prepared())
    assert np.abs(got - want).max() < 1e-3


def test_odd_tables(spark):
    data = rows()
    odd = [(1000, None, "en", "s", 1), (1001, "", "en", "s", 1), (1002, "12 !?", "en", "s", 1),
           (1003, "x" * 300_000, None, "s", 1), (None, "das haus und der garten", None, "s", 1)]
    df = spark.createDataFrame(data + odd + odd[:2], SCHEMA)
    got = identify(df).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    assert len(got) == len(data) + 7
    assert all(by[i][0]["lang_pred"] == "und" and by[i][0]["score"] == 0 for i in (1000, 1001, 1002))
    assert by[None][0]["lang_pred"] == "de" and not by[None][0]["held_out"]
    assert by[1003][0]["lang_pred"] in SAMPLES
    right = [by[i][0]["lang_pred"] == name for i, _, name, *_ in data if by[i][0]["held_out"]]
    assert sum(right) / len(right) > 0.95
    kept = drop_unknown(df)
    assert kept.columns == df.columns and kept.count() == len(data) + 2
    assert identify(df.limit(0)).count() == 0 and drop_unknown(df.limit(0)).count() == 0
    bare = df.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert train(bare) is None
    assert {r["lang_pred"] for r in identify(bare).collect()} == {"und"}
    assert drop_unknown(bare).count() == len(data) + 2


def test_labels_of_held_out_rows_are_never_seen(spark):
    data = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else g, s, f) for i, t, g, s, f in rows()]
    got = identify(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r["lang_pred"] for r in got} == set(SAMPLES)


def test_any_number_of_labels(spark, monkeypatch):
    """More labels than landmarks and than training rows: every label is still learned."""
    monkeypatch.setattr(lang, "BLOCK", 16)
    r = random.Random(4)
    spell = {g: ["".join(r.choices("bcdfghklmnprstvz", k=3)) for _ in range(6)] for g in range(600)}
    data = [(i, " ".join(r.choices(spell[i % 600], k=40)), f"x{i % 600}", "s", 1) for i in range(2400)]
    df = spark.createDataFrame(data, SCHEMA)
    model = train(df, training=500, landmarks=100)
    assert len(model.languages) == 600 and model.landmarks.shape[0] == 100
    assert len(train(df, training=1200, landmarks=100).languages) == 600
    got = df.select("lang", lang.language(F.col("text"), train(df, training=2400, landmarks=2400)).alias("found"))
    assert got.filter("found.lang = lang").count() > 0.95 * len(data)


def test_rejects_by_prediction(spark):
    df = spark.createDataFrame([*rows(), (900, "zzzz qqqq", None, "s", 1), (901, None, None, "s", 1)], SCHEMA)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(df).collect()}

    def kept(**how):
        return {r["doc_id"] for r in drop_unknown(df, **how).collect()}

    for least in (0.0, 0.3, 0.9):
        assert kept(least=least) == {i for i, (g, s) in found.items() if g != "und" and s >= least}
    assert kept(languages=["de"], least=0) == {i for i, (g, _) in found.items() if g == "de"}
    assert 0 < len(kept(least=0.9)) < len(found)


def test_query_accuracy(spark):
    from panelspark.llm.queries import QUERIES

    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = QUERIES["op1_language"](spark, "/root/testdata/sf0.01").collect()
    right = [r["lang_pred"] == docs[r["doc_id"]] for r in got if r["held_out"]]
    assert len(got) == len(docs) and sum(right) / len(right) > 0.97
