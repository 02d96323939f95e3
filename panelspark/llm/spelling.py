"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

A word is its letter counts; of two words one edit apart the counts differ by one letter
more, or by one letter exchanged for another, so their squared distance is one or two. The
distances of two blocks of words come from one matrix product. Blocks hold words of one
length and are compared with the block of the same and of the next length; length blocks
are cut further by how many letters of each of :data:`CLASSES` classes a word has, which one
edit can only move to a neighbouring cut. Edits are then verified on the pairs that are left.

Joins of tables that grow with the vocabulary are told to shuffle: Spark sizes a written
table by its packed file, and one whose rows an explode has repeated no higher, and would
send it through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .base import stored, words_text

#: Letters fall into classes by code point; a block has one count per class.
CLASSES = 5
#: Words and characters of a chunk, the part of a block that is multiplied at once.
CHUNK_WORDS, CHUNK_CHARS = 2048, 1 << 16
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- words ------------------------------------------------------------------------------


def runs(text: Column, least: int) -> Column:
    """Maximal runs of Latin letters of at least ``least`` characters, A-Z lowered."""
    found = F.regexp_extract_all(words_text(text), F.lit(f"([A-Za-zÀ-ÿ]{{{least},}})"), F.lit(1))
    return F.transform(found, lambda r: F.translate(r, *LOWER))


# -- blocks -----------------------------------------------------------------------------


def _class_counts(word: Column) -> list[Column]:
    """How many characters of a word fall into each class."""
    codes = F.transform(F.split(word, ""), lambda c: F.pmod(F.ascii(c), F.lit(CLASSES)))
    return [F.size(F.filter(codes, lambda c: c == k)) for k in range(CLASSES)]


def _chunks(words: DataFrame) -> DataFrame:
    """One row per chunk: ``length``, class counts ``cut``, ``chunk``, ``words``.

    A block is cut by a hash into as many chunks as its number of words asks for; only
    blocks of more than one chunk are looked up.
    """
    keyed = words.select(
        "word", "n", F.length("word").alias("length"), F.array(*_class_counts(F.col("word"))).alias("cut")
    )
    keyed = stored(keyed, "keyed")
    sizes = keyed.groupBy("length", "cut").agg(F.count("*").alias("size"))
    most = F.least(F.lit(CHUNK_WORDS), F.greatest(F.lit(1), F.floor(F.lit(CHUNK_CHARS) / F.col("length"))))
    sizes = sizes.select("length", "cut", F.ceil(F.col("size") / most).alias("parts")).filter("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    dealt = keyed.join(sizes, ["length", "cut"], "left").select(
        "length", "cut", F.pmod(F.xxhash64("word"), parts).alias("chunk"), "word", "n"
    )
    return dealt.groupBy("length", "cut", "chunk").agg(
        F.collect_list(F.struct("word", "n")).alias("words")
    )


def _moves() -> list[tuple[int, list[int]]]:
    """Changes of length and of the class counts by one edit, one of each pair of opposites."""
    out = [(0, [0] * CLASSES)]
    for a in range(CLASSES):
        longer = [0] * CLASSES
        longer[a] = 1
        out.append((1, longer))
        for b in range(a + 1, CLASSES):
            exchanged = [0] * CLASSES
            exchanged[a], exchanged[b] = -1, 1
            out.append((0, exchanged))
    return out


def _pairs_of_chunks(chunks: DataFrame) -> DataFrame:
    """Each two chunks that can hold words one edit apart, once: ``left``, ``right``, ``same``."""
    moves = F.array(
        *[F.struct(F.lit(d).alias("d"), F.array(*map(F.lit, c)).alias("c")) for d, c in _moves()]
    )
    left = chunks.withColumn("move", F.explode(moves)).select(
        (F.col("length") + F.col("move.d")).alias("length"),
        F.zip_with("cut", "move.c", lambda x, y: x + y).alias("cut"),
        F.forall("move.c", lambda c: c == 0).alias("own"),
        F.col("chunk").alias("left_chunk"),
        F.col("words").alias("left"),
    )
    left = left.filter(F.forall("cut", lambda c: c >= 0))
    right = chunks.select("length", "cut", "chunk", F.col("words").alias("right"))
    both = left.hint("merge").join(right, ["length", "cut"]).filter("NOT own OR left_chunk <= chunk")
    return both.select("left", "right", (F.col("own") & (F.col("left_chunk") == F.col("chunk"))).alias("same"))


# -- products ---------------------------------------------------------------------------


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _counts(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each row."""
    # products of counts reach the square of the length, which must stay exact
    exact = np.float32 if codes.shape[1] < 2048 else np.float64
    out = np.zeros((len(codes), len(letters)), exact)
    places = np.searchsorted(letters, codes)
    for column in places.T:  # a row holds a place once per column
        out[np.arange(len(codes)), column] += 1
    return out


def near_rows(left: list[str], right: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs one edit apart of two blocks, each of words of one length.

    ``right`` has the length of ``left`` or one more. ``same`` says that the blocks are one,
    whose pairs are then taken once.
    """
    a, b = _codes(left), _codes(right)
    letters = np.unique(np.concatenate((np.unique(a), np.unique(b))))
    x, y = _counts(a, letters), _counts(b, letters)
    # one product gives x.y - (x.x + y.y) / 2, minus half the squared distance
    halves = [-(m * m).sum(1, keepdims=True) / 2 for m in (x, y)]
    ones = [np.ones((len(m), 1), m.dtype) for m in (x, y)]
    gram = np.hstack((x, halves[0], ones[0])) @ np.hstack((y, ones[1], halves[1])).T
    i, j = np.divmod(np.flatnonzero(gram >= -1), len(b))
    if same:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return i, j
    if a.shape[1] == b.shape[1]:
        keep = _differences(a, b, i, j) == 1
    else:
        keep = _one_longer(a, b, i, j)
    return i[keep], j[keep]


def _differences(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.zeros(len(i), np.int32)
    for k in range(a.shape[1]):
        out += a[i, k] != b[j, k]
    return out


def _one_longer(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the longer word is the shorter one with one character put in."""
    width = a.shape[1]
    front, going = np.zeros(len(i), np.int32), np.ones(len(i), bool)
    for k in range(width):
        going &= a[i, k] == b[j, k]
        front += going
    back, going = np.zeros(len(i), np.int32), np.ones(len(i), bool)
    for k in range(width - 1, -1, -1):
        going &= a[i, k] == b[j, k + 1]
        back += going
    return front + back >= width


def near_words(words: DataFrame) -> DataFrame:
    """Both directions of every two words one inserted, deleted or replaced character apart.

    ``words`` has ``word`` (distinct, not null) and ``n``; the result ``word``, ``n``,
    ``other``, ``other_n``.
    """
    names = ["a", "a_n", "b", "b_n"]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                left, right = (batch.column(c)[row].values for c in (0, 1))
                i, j = near_rows(
                    left.field("word").to_pylist(), right.field("word").to_pylist(), batch.column(2)[row].as_py()
                )
                if len(i):
                    i, j = pa.array(i), pa.array(j)
                    columns = [left.field(c).take(i) for c in ("word", "n")]
                    columns += [right.field(c).take(j) for c in ("word", "n")]
                    yield pa.RecordBatch.from_arrays(columns, names)

    pairs = _pairs_of_chunks(stored(_chunks(words), "chunks"))
    found = stored(pairs.mapInArrow(multiply, "a string, a_n long, b string, b_n long"), "near")
    there = found.toDF("word", "n", "other", "other_n")
    back = found.select("b", "b_n", "a", "a_n").toDF("word", "n", "other", "other_n")
    return there.unionByName(back)


# -- groups -----------------------------------------------------------------------------


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """The usual spelling that each word is a variant of, and where that leads in the end.

    ``words`` has ``word`` and ``n``, how often it occurs. Per word: its ``form``, the near
    word with the largest ``n`` (ties: the smallest in code points) if that is at least
    ``ratio`` times its own, else null; ``form_n``; ``n_near``, how many near words it has;
    and ``root``, the end of the chain of forms, itself without one.

    Null and empty words are passed over; rows that repeat a word are added up; other
    columns are not read. An empty table gives no rows. Words of any length are whole. All
    words near a word meet in one group: there are no more than its places times the
    alphabet.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent")
    known = words.filter("word IS NOT NULL AND word <> ''").groupBy("word").agg(
        F.sum(F.col("n").cast("long")).alias("n")
    )
    known = stored(known, "words")
    best = near_words(known).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form"))).alias("best"),
    )
    wide = known.join(best.hint("merge"), "word", "left")
    chosen = -F.col("best.m") >= F.lit(ratio) * F.col("n")
    formed = wide.select(
        "word",
        F.when(chosen, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, -F.col("best.m")).alias("form_n"),
    )
    formed = stored(formed, "forms")
    links = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # n grows by the ratio with every step, which bounds the steps; each round doubles them
    span = formed.agg(F.max("n").alias("high"), F.min("n").alias("low")).first()
    steps = math.log(span["high"] / max(1, span["low"]), ratio) if span["high"] else 0
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = links.select(F.col("word").alias("at"), F.col("root").alias("end"))
        joined = links.join(further.hint("merge"), F.col("root") == F.col("at"), "left")
        links = stored(joined.select("word", F.coalesce("end", "root").alias("root")), "roots")
    return formed.join(links.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
