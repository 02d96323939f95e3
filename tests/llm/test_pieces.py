"""Backtracking encoder and decoder against the sentencepiece library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from panelspark.llm.pieces import PASS, Remembered, encode_documents, model, piece_ids, piece_text

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def library_ids(lib, text):
    return [lib.bos_id(), *lib.encode(text), lib.eos_id()]


def ours(text):
    return np.frombuffer(model(FILE).encode(text.encode()), "<u4").tolist()


ODD = [
    "", " ", "   ", "a", " a", "a ", "  a  b  ", "a\nb\tc\r\n\n d", "▁a▁▁b", "<s>x</s> <unk> <0x0A>",
    "ﬁ Å Å é", "日本語テキスト", "é😀‍👩", "\x00\x01\x7f", "xyz" * 3000, "ab " * 3000,
    "the quick brown fox's 1234567890 !!!???...", "ААА ббб", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "�", "word" * 5 + "\n" * 7, "                                     x",
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(lib, text):
    ids = library_ids(lib, text)
    assert ours(text) == ids
    assert model(FILE).decode(np.array(ids, "<u4").tobytes()) == lib.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    lib = sentencepiece.SentencePieceProcessor(model_file=FILE)
    assert ours(text) == library_ids(lib, text)


def test_random_piece_strings(lib):
    """Texts of glued pieces make the longest match wrong and force backtracking."""
    rng, names = random.Random(3), list(model(FILE).ids)
    for _ in range(1500):
        text = "".join(rng.choices(names, k=rng.randint(1, 12))).replace("▁", " ")
        ids = library_ids(lib, text)
        assert ours(text) == ids, text
        assert model(FILE).decode(np.array(ids, "<u4").tobytes()) == lib.decode(ids)


def test_decode_of_any_ids(lib):
    rng = random.Random(4)
    for _ in range(1500):
        low = rng.choice([259, 32000])
        ids = [rng.randrange(low) for _ in range(rng.randint(0, 9))]
        assert model(FILE).decode(np.array(ids, "<u4").tobytes()) == lib.decode(ids), ids


def test_remembered_forgets_the_oldest():
    made = []
    r = Remembered(lambda k: made.append(k) or k, 4)
    for k in [*range(9), 8, 0]:
        assert r[k] == k
    assert len(r) <= 4 and len(r.old) <= 4 and made == [*range(9), 0]


def test_table(spark, lib):
    rows = [(1, "Hello  world", "x"), (2, None, "x"), (2, None, "x"), (None, "é" * 20_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_documents(df, FILE).collect()
    assert len(got) == 4
    for r in got:
        text = {1: "Hello  world", 2: "", None: "é" * 20_000}[r["doc_id"]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == library_ids(lib, text)
        assert r["decoded"] == text and r["n_tokens"] == len(r["ids"]) // 4
    assert encode_documents(df.limit(0), FILE).count() == 0
    one = df.filter("doc_id = 1").select(piece_ids(F.col("text"), FILE).alias("i"))
    assert one.select(piece_text(F.col("i"), FILE)).first()[0] == "Hello  world"


def test_query_equals_library(spark, lib):
    from hashlib import sha256

    from panelspark.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = set()
    for d in docs:
        ids = library_ids(lib, d["text"])
        packed = np.array(ids, "<u4").tobytes()
        text = lib.decode(ids).encode()
        want.add((d["doc_id"], len(ids), sha256(packed).hexdigest(), sha256(text).hexdigest()))
    assert set(map(tuple, QUERIES["op6_pieces"](spark, "/root/testdata/sf0.001").collect())) == want


def test_backtracking_equals_merging():
    """Few letters (many ways to cut), strange characters, and runs beyond one pass."""
    m, rng = model(FILE), random.Random(5)
    for letters in ("ab", "thein", "1230.", "sè語😀t", "\t\nab", "▁the"):
        for n in [*range(12)] * 20 + [PASS, PASS + m.widest, 700]:
            text = "".join(rng.choices(letters, k=n))
            text = text[:1] + text[1:].replace("▁", "e")
            assert m.tokens(text) == m.merge(text)


def test_merging_looks_up_pairs_once():
    """Lookups follow the length of the text, not its square."""
    m, looked = model(FILE), []

    class Counted(dict):
        def get(self, *a):
            looked.append(a)
            return super().get(*a)

    kept = m.score
    m.score = Counted(kept)
    try:
        parts = m.merge("thein" * 40)
    finally:
        m.score = kept
    assert "".join(parts) == "thein" * 40 and len(looked) <= 3 * 200
