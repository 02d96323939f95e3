"""Token counts against the tokenizers library, with small chunks to force splices."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelspark.llm.token_counts import TokenCounter, count_tokens, token_count

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


LIBS = {f: Tokenizer.from_file(f) for f in (WORDS, BYTES)}
COUNTERS = {f: TokenCounter(f, f == WORDS) for f in (WORDS, BYTES)}


@pytest.fixture(scope="module")
def libs():
    return LIBS


def sized(file, chunk, overlap):
    """A counter with chunks of another size; special strings stay shorter than overlaps."""
    c = COUNTERS[file]
    c.overlap = max(overlap, 30)
    c.chunk, c.widened = max(chunk, 2 * c.overlap), 0
    return c


def plain(lib, text):
    return len(lib.encode(text, add_special_tokens=False).ids)


ODD = [
    "", " \n\t", "a", "It's we'll they're x'llama 'S", "<|endoftext|> <|startoftext|>x<|endoftext|>",
    "Å é ́ ﬁ ΑΣ", "日本語テキスト" * 40, "한국어 한", "a b c\x1cd\x85e",
    "x" * 900, "ab1!" * 300, "🙂👍🏽" * 60, "123 4567", "\x00", "...!!!" * 100,
]


@pytest.mark.parametrize("file", [WORDS, BYTES])
@pytest.mark.parametrize("text", ODD)
def test_odd_texts(libs, file, text):
    for chunk, overlap in ((1 << 16, 1 << 10), (64, 8), (40, 4)):
        c = sized(file, chunk, overlap)
        assert c.counts([text.encode()]) == [plain(libs[file], text)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=200))
def test_any_text(text):
    lib, small = LIBS[WORDS], sized(WORDS, 60, 4)
    assert small.counts([text.encode()]) == [plain(lib, text)]
    assert small.spliced(text) == plain(lib, text)


@pytest.mark.parametrize("file", [WORDS, BYTES])
def test_mixed_texts_with_small_chunks(libs, file):
    rng = random.Random(7)
    bits = ["the", " ", "'", "ll", "Ä", "é", "é", "́", "<|endof", "text|>", "9", "\n", "!?",
            "日", "'re", "re", "un", "believable", "  ", "<|endoftext|>", "한", "ᄒ", "ᅡ", "ᆫ"]
    for _ in range(400):
        text = "".join(rng.choices(bits, k=rng.randint(1, 120)))
        c = sized(file, rng.randint(10, 90), rng.randint(1, 40))
        assert c.spliced(text) == plain(libs[file], text), repr(text)


def test_overlap_is_widened_where_nothing_aligns(libs):
    c = sized(WORDS, 64, 4)
    text = "x" * 500 + " " + "word " * 100
    assert c.spliced(text) == plain(libs[WORDS], text) and c.widened > 0


def test_table(spark, libs):
    long = "Some words, and more words. " * 9000
    rows = [(1, long, 5), (2, None, 5), (3, "", 5), (3, "", 5), (None, "É " * 2000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, count_tokens(df, WORDS, drops_space=True).collect()), key=repr)
    want = []
    for i, t, _ in rows:
        n = plain(libs[WORDS], t or "")
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=repr)
    assert count_tokens(df.limit(0), WORDS).count() == 0
    assert df.limit(1).select(token_count(F.col("text"), BYTES, chunk=5000)).first()[0] == plain(
        libs[BYTES], long
    )


def test_query_equals_library(spark, libs):
    from panelspark.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {(d["doc_id"], len(d["text"].encode()), plain(libs[WORDS], d["text"])) for d in docs}
    got = QUERIES["op5_token_counts"](spark, "/root/testdata/sf0.001").collect()
    assert {(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got} == want
