"""Language identification by string kernels.

The kernel of two texts is the number of n-grams of 1 to ``ORDERS`` bytes (lowered,
everything in ASCII but letters as a space) that occur in both, over the geometric mean
of the numbers that occur in each; n-grams are hashed to ``SLOTS`` presence bits. The
Nyström method maps a text to its kernels with a few landmark texts, whitened by the
landmarks' own kernel matrix; on that map a kernel ridge regression per language (this
language against the rest) is solved. Scores of a batch of texts are two matrix products.

The fit takes a bounded sample of labelled texts: ``TRAINING`` in all, spread evenly over
the languages (one each where there are more languages than that) and chosen by the hash of
the text, ``LANDMARKS`` of them as landmarks. The driver gets their presence bits
(``SLOTS / 8`` bytes each), not their texts, and unpacks ``BLOCK`` rows at a time; the
model has one column of ``LANDMARKS`` weights per language. Prediction reads whole texts.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from .base import stored

ORDERS, SLOTS = 4, 1 << 15
TRAINING, LANDMARKS = 2048, 192
RIDGE = 1e-4
UNKNOWN = "und"
#: Least score of a text in a known language; below it all languages reject the text.
LEAST_SCORE = 0.3
BATCH, PIECE, BLOCK = 128, 1 << 20, 64

TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_ODD = np.random.default_rng(97).integers(1 << 28, 1 << 31, ORDERS, dtype=np.uint32) * 2 + 1
_SHIFT = np.uint32(32 - (SLOTS - 1).bit_length())


def mark(row: np.ndarray, text: bytes) -> None:
    """Set the slots of the n-grams of a text (UTF-8) to 1."""
    for at in range(0, len(text), PIECE):
        piece = text[at : at + PIECE + ORDERS - 1].translate(TABLE)
        letters = np.frombuffer(piece, np.uint8).astype(np.uint32)
        code = letters
        for n in range(ORDERS):
            if n:
                if len(letters) <= n:
                    break
                code = (code[:-1] << np.uint32(8)) | letters[n:]
            row[(code * _ODD[n]) >> _SHIFT] = 1


@dataclass
class Model:
    """Landmarks as packed presence bits, and a column of weights per language."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def prepared(self) -> tuple[np.ndarray, np.ndarray]:
        bits = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        return bits, bits.sum(1)

    def scores(self, texts: list[bytes], bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """One-versus-rest scores of a batch of texts."""
        rows = np.zeros((len(texts), SLOTS), np.float32)
        for row, text in zip(rows, texts):
            mark(row, text)
        return _normed(rows, bits, sizes) @ self.weights


def _normed(rows: np.ndarray, bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    own = np.maximum(rows.sum(1), 1)
    kernel = (rows @ bits.T) / np.sqrt(np.outer(own, np.maximum(sizes, 1)))
    return np.hstack((kernel.astype(np.float64), np.ones((len(rows), 1))))


def solve(labels: list[str], packed: np.ndarray, landmarks: int = LANDMARKS) -> Model | None:
    """Fit on presence bits of labelled texts, ordered at random within each label."""
    languages = sorted(set(labels))
    if not languages:
        return None
    places = {g: [i for i, x in enumerate(labels) if x == g] for g in languages}
    each = max(1, landmarks // len(languages))
    # with more languages than landmarks, every so many languages give one
    step = max(1, -(-len(languages) // landmarks))
    chosen = [i for g in languages[::step] for i in places[g][:each]]
    bits = np.unpackbits(packed[chosen], axis=1).astype(np.float32)
    sizes = bits.sum(1)
    whole = np.vstack(
        [
            _normed(np.unpackbits(packed[at : at + BLOCK], axis=1).astype(np.float32), bits, sizes)
            for at in range(0, len(packed), BLOCK)
        ]
    )
    values, vectors = np.linalg.eigh(whole[chosen, :-1])
    good = values > 1e-6 * values.max()
    white = np.zeros((len(chosen) + 1, int(good.sum()) + 1))
    white[:-1, :-1] = vectors[:, good] / np.sqrt(values[good])
    white[-1, -1] = 1
    features = whole @ white
    # targets are 1 in the own language and -1 elsewhere
    own = np.zeros((len(languages), features.shape[1]))
    np.add.at(own, np.searchsorted(languages, labels), features)
    wanted = 2 * own.T - features.sum(0)[:, None]
    ridge = RIDGE * len(labels) * np.eye(features.shape[1])
    ridge[-1, -1] = 0
    weights = white @ np.linalg.solve(features.T @ features + ridge, wanted)
    return Model(languages, packed[chosen], weights)


def spelled(text: Column) -> Column:
    """Lowered UTF-8 bytes of a text that has a letter, else null."""
    return F.when(text.rlike(r"\p{L}"), F.lower(text).cast("binary"))


def _presence():
    @arrow_udf("binary")
    def presence(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            out = []
            for text in batch.to_pylist():
                row = np.zeros(SLOTS, np.uint8)
                mark(row, text or b"")
                out.append(np.packbits(row).tobytes())
            yield pa.array(out, pa.binary())

    return presence


def train(
    labelled: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    training: int = TRAINING,
    landmarks: int = LANDMARKS,
) -> Model | None:
    """Fit on rows with a label and a letter in the text; None if there are none.

    Equal texts count once per label. A text with several labels is used for each. Any
    number of labels is learned.
    """
    rows = labelled.select(
        F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text")
    ).filter(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = rows.select("label", F.xxhash64("text").alias("h")).distinct()
    counted = stored(hashed.groupBy("label").count(), "labels")
    labels = counted.count()
    if not labels:
        return None
    each = max(1, training // labels)
    # all but about four times the wanted rows of a label are left out by hash first, so
    # that a frequent label does not gather in one task
    part = F.pmod("h", F.lit(1 << 31))
    some = hashed.join(counted, "label").filter(
        part * F.col("count") < float((1 << 31) * 4 * each)
    )
    rank = F.row_number().over(Window.partitionBy("label").orderBy(part, "h"))
    chosen = some.withColumn("rank", rank).filter(F.col("rank") <= each).select("label", "h")
    sample = (
        rows.withColumn("h", F.xxhash64("text"))
        .join(stored(chosen, "chosen"), ["label", "h"], "left_semi")
        .groupBy("label", "h")
        .agg(F.any_value("text").alias("text"))
        .select("label", "h", _presence()(spelled(F.col("text"))).alias("bits"))
        .collect()
    )
    kept = sorted(sample, key=lambda r: (r["label"], r["h"]))
    packed = np.array([np.frombuffer(r["bits"], np.uint8) for r in kept])
    return solve([r["label"] for r in kept], packed, landmarks)


def language(text: Column, model: Model | None) -> Column:
    """``struct<lang: string, score: double>`` of a text.

    ``und`` with score 0 for a null text, one without a letter, and where nothing was
    learned. The score is the winning one-versus-rest value, from -1..1 taken to 0..1.
    """
    kind = "struct<lang: string, score: double>"
    unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if model is None:
        return unknown

    @arrow_udf(kind)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits, sizes = model.prepared()
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                texts = batch.slice(at, BATCH).to_pylist()
                scores = model.scores([t or b"" for t in texts], bits, sizes)
                best = scores.argmax(1)
                value = np.clip((scores[np.arange(len(texts)), best] + 1) / 2, 0, 1)
                blank = np.array([not t for t in texts])
                best[blank], value[blank] = len(names) - 1, 0.0
                yield pa.StructArray.from_arrays(
                    [pa.array(names[best], pa.string()), pa.array(value, pa.float64())],
                    ["lang", "score"],
                )

    return predict(spelled(text))


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by id, that is never learned from; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every document.

    Learns from the documents that are not held out. Rows with a null id are not learned
    from. Repeated rows give repeated results, an empty table none; only the text enters
    a prediction, other columns are not looked at.
    """
    known = docs.filter((F.crc32(docs["doc_id"].cast("string")) % 4) != 2)
    model = train(known, text_col, label_col)
    out = docs.select(
        docs["doc_id"].alias("doc_id"),
        held_out(docs["doc_id"]).alias("held_out"),
        language(docs[text_col], model).alias("found"),
    )
    return out.select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def drop_unknown(
    docs: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    languages: Collection[str] | None = None,
    least: float = LEAST_SCORE,
) -> DataFrame:
    """The documents predicted to be in one of ``languages``, all learned ones unless given.

    Rejected are null texts, texts without a letter, texts predicted in another language,
    and texts whose best score is under ``least``. Where nothing was learned, texts with a
    letter stay. Columns are unchanged; repeated rows have one fate, an empty table gives
    none; rows with a null id are judged but not learned from.
    """
    known = docs.filter((F.crc32(docs["doc_id"].cast("string")) % 4) != 2)
    model = train(known, text_col, label_col)
    if model is None:
        return docs.filter(docs[text_col].rlike(r"\p{L}"))
    wanted = model.languages if languages is None else sorted(languages)
    found = language(docs[text_col], model)
    return docs.filter(F.when(found["score"] >= least, found["lang"]).isin(wanted))
