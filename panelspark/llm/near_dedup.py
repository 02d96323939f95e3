"""Near duplicates by fast similarity sketching, banding and exact verification.

A sketch has ``SIZE`` coordinates. In round ``i`` every shingle of a text is put into one
bin by hashing and leaves the value ``(i, hash)`` there; a bin keeps the smallest. The
bins of the first ``SIZE`` rounds are random, those of the next ``SIZE`` rounds are the
bins in turn, so that every bin is filled whatever the text; the rounds end as soon as
all are. Coordinates of two texts agree with the probability of their Jaccard similarity.

``ROWS`` successive coordinates make a band; texts that share a band are candidates. A
pair of similarity 0.75 shares none of the ``BANDS`` bands in fewer than one of a million
cases. Within a band's bucket, members are compared with a leader, not with each other:
first with the text that shares most bands with most others. As long as a bucket holds
members in different components, more leaders are taken, until every two members are in
one component or have been compared. So a group of near copies costs a comparison per
member, and no link between different texts is lost. Before texts are compared as sets of
shingles, pairs are ruled out by their sizes, by the parity maps of their sets, which
bound the difference of two sets from below, and by bits of the sketch.

Texts with the same words form a class with one representative from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from panelspark.operators.joins import weighted_join

from .base import stored, utf8
from .components import components

SHINGLE = 5
ROWS, BANDS = 5, 52
SIZE = ROWS * BANDS
#: Agreeing ones of 256 sketch bits that a pair needs: 224 are expected at 0.75, and
#: fewer than 190 have a probability below 1e-9.
BITS, LEAST_BITS = 256, 190
#: Bits of the parity map of a set.
MAP = 1024
#: Leaders taken per bucket in the second pass, eight times as many in each further one.
LEADERS = 64
#: Followers of a leader that are compared in one task.
LED_ROWS = 1024
#: Components joined by broadcast; any other has a smaller share of the classes.
LARGEST = 1000
SLICE = 256

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_U = np.uint64
_SEEDS = np.random.default_rng(20_240_501).integers(1, 1 << 63, 2 * SIZE + 8, dtype=np.uint64)
_LEFT = _U((1 << 64) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over each other."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lowered, cut at ASCII white space."""
    return text.translate(LOWER).split()


def shingles(words: list[bytes]) -> set:
    """Distinct shingles of words; a shorter text is one shingle, an empty one has none."""
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(SHINGLE))))


class Hashed(dict):
    """64-bit hashes of words, remembered up to a number of words."""

    def __init__(self, most: int = 1 << 18):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


def shingle_hashes(words: list[bytes], known: Hashed) -> np.ndarray:
    """Hashes of the distinct shingles of a text."""
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    out = np.full(n, len(words) if len(words) < SHINGLE else SHINGLE, np.uint64)
    for j in range(min(SHINGLE, len(words))):
        out = _mix(out * _SEEDS[-1] + each[j : j + n])
    return np.unique(out)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The ``SIZE`` coordinates of a non-empty set of shingle hashes."""
    filled = np.full(SIZE, _LEFT)
    first = 0
    while first < 2 * SIZE:
        some = max(1, min(2 * SIZE - first, (4 * SIZE) // len(hashes)))
        rounds = np.arange(first, first + some)
        h = _mix(hashes[None, :] ^ _SEEDS[rounds][:, None])
        bins = ((h >> _U(40)) % _U(SIZE)).astype(np.int64)
        late = rounds >= SIZE
        bins[late] = (rounds[late] - SIZE)[:, None]
        values = (rounds.astype(np.uint64)[:, None] << _U(54)) | (_mix(h) >> _U(10))
        np.minimum.at(filled, bins.ravel(), values.ravel())
        first += some
        if (filled != _LEFT).all():
            break
    return filled


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    parts = coordinates.reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        keys = _mix(keys * _SEEDS[-2] + parts[:, j])
    return keys.view(np.int64)


def sketch_bits(coordinates: np.ndarray) -> np.ndarray:
    """One bit of each of the first ``BITS`` coordinates, as four longs."""
    ones = (_mix(coordinates[:BITS]) & _U(1)).astype(np.uint8)
    return np.packbits(ones).view(np.int64)


def parity_map(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each of ``MAP`` bits, as longs."""
    odd = np.bincount((hashes % _U(MAP)).astype(np.int64), minlength=MAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


SKETCH = (
    "struct<n: bigint, class: binary, bands: array<bigint>, bits: array<bigint>,"
    " map: array<bigint>>"
)
#: What tells whether a pair is worth comparing.
FACTS = ("n", "bits", "map")


def _sketcher():
    @arrow_udf(SKETCH)
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Hashed()
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                n, classes, bands, bits, maps = [], [], [], [], []
                for text in batch.slice(at, SLICE).to_pylist():
                    words = text_words(text or b"")
                    hashes = shingle_hashes(words, known)
                    n.append(len(hashes))
                    if not words:
                        for column in (classes, bands, bits, maps):
                            column.append(None)
                        continue
                    classes.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                    coordinates = sketch(hashes)
                    bands.append(band_keys(coordinates))
                    bits.append(sketch_bits(coordinates))
                    maps.append(parity_map(hashes))
                yield pa.StructArray.from_arrays(
                    [
                        pa.array(n, pa.int64()),
                        pa.array(classes, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(bits, pa.list_(pa.int64())),
                        pa.array(maps, pa.list_(pa.int64())),
                    ],
                    ["n", "class", "bands", "bits", "map"],
                )

    return make


def _similar():
    @arrow_udf("boolean")
    def similar(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, kept = None, set()
        for left, right in batches:
            out = []
            for i in range(len(left)):
                a = left[i].as_py()
                if a != last:
                    last, kept = a, shingles(text_words(a))
                other = shingles(text_words(right[i].as_py()))
                both = len(kept & other)
                out.append(100 * both >= 75 * (len(kept) + len(other) - both))
            yield pa.array(out, pa.bool_())

    return similar


def _differing(c: str, longs: int) -> Column:
    """Number of bits in which the longs of ``c`` and ``lead_c`` differ."""
    return sum(
        (
            F.bit_count(F.element_at(c, i).bitwiseXOR(F.element_at(f"lead_{c}", i)))
            for i in range(1, longs + 1)
        ),
        F.lit(0),
    )


def _plausible() -> Column:
    """Pairs of columns ``lead_*`` and own ones that may be similar enough.

    Of two sets that are similar enough, the smaller has 3/4 of the larger one's size,
    and at most 1/7 of all members are in one set only; each of these changes one bit of
    the parity map at most, so both tests lose nothing.
    """
    sizes = F.least("n", "lead_n") * 100 >= F.greatest("n", "lead_n") * 75
    apart = _differing("map", MAP // 64) * 7 <= F.col("n") + F.col("lead_n")
    return sizes & apart & (F.lit(BITS) - _differing("bits", BITS // 64) >= LEAST_BITS)


def _named(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"lead_{c}") for c in columns])


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose shingle sets are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    pairs = stored(pairs.select("a", "b").distinct(), "pairs")
    both = weighted_join(pairs.join(right, "b"), left, ["a"], part_rows=LED_ROWS)
    return both.filter(_similar()(F.col("left"), F.col("right"))).select("a", "b")


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """``key``, ``node``, ``component`` of the buckets with several components."""
    found = F.coalesce(F.col("component"), F.col("node")).alias("component")
    placed = buckets.join(labels, "node", "left").select("key", "node", found)
    keys = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("key")
    )
    return placed.join(keys, "key", "left_semi")


def link_classes(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node`` and ``component`` of the classes that are linked to another one.

    ``classes`` has ``node`` (a number of its own), ``doc_id`` and ``mark`` (a hash of the
    text) of one of its documents, ``bands`` and the :data:`FACTS`; ``docs`` has ``doc_id``,
    ``mark`` and ``text`` (UTF-8) and at least the rows of all classes.
    """
    bands = classes.select("node", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = stored(bands.join(shared, "key"), "buckets")
    # a text that shares many bands with many others is in the middle of its group
    middle = buckets.groupBy("node").agg(F.sum("size").alias("weight"))
    known = stored(
        classes.select("node", "doc_id", "mark", *FACTS).join(middle, "node").withColumn(
            "rank", F.struct("weight", (-F.col("node")).alias("first"))
        ),
        "bucket-nodes",
    )
    # an id may stand for several texts, and equal rows may be repeated
    texts = stored(
        docs.join(known.select("node", "doc_id", "mark"), ["doc_id", "mark"])
        .select("node", "text")
        .dropDuplicates(["node"]),
        "bucket-texts",
    )

    # First every text meets one leader, the most central one of all its buckets.
    ranked = buckets.select("key", "node").join(known.select("node", "rank"), "node")
    leaders = ranked.groupBy("key").agg(F.max("rank").alias("lead"))
    best = ranked.join(leaders, "key").groupBy("node").agg(F.max("lead").alias("lead"))
    best = best.select("node", (-F.col("lead.first")).alias("lead_node")).filter("node <> lead_node")
    pairs = (
        weighted_join(
            best.join(known, "node"),
            _named(known, "node", *FACTS),
            ["lead_node"],
            part_rows=LED_ROWS,
        )
        .filter(_plausible())
        .select(F.col("lead_node").alias("a"), F.col("node").alias("b"))
    )
    edges = stored(_linked(pairs, texts), "links")
    labels = components(edges)

    # Where a bucket still holds several components, all its members lead in turn.
    about = known.select("node", *FACTS)
    left, count = buckets.select("key", "node"), LEADERS
    while True:
        left = stored(_mixed(left, labels), "mixed-buckets")
        if left.isEmpty():
            break
        order = Window.partitionBy("key").orderBy("node")
        leads = stored(
            left.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= count),
            "leaders",
        )
        led = _named(leads.join(about, "node"), "key", "node", "component", *FACTS)
        met = (
            left.join(about, "node")
            .join(led.withColumnRenamed("lead_key", "key"), "key")
            .filter((F.col("component") != F.col("lead_component")) & _plausible())
        )
        pairs = met.select(
            F.least("node", "lead_node").alias("a"), F.greatest("node", "lead_node").alias("b")
        )
        fresh = stored(_linked(pairs, texts), "links")
        if not fresh.isEmpty():
            edges = edges.unionByName(fresh)
            labels = stored(components(edges), "labels")
        left = left.select("key", "node").join(
            leads.select("key", "node"), ["key", "node"], "left_anti"
        )
        count *= 8
    return labels


def _sketches(docs: DataFrame, text_col: str) -> DataFrame:
    """Per document its id, a hash of its text, and the facts of its set."""
    text = utf8(docs[text_col])
    return stored(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            F.xxhash64(text).alias("mark"),
            _sketcher()(text).alias("s"),
        ).select("doc_id", "mark", "s.n", "s.class", "s.bands", "s.bits", "s.map"),
        "sketches",
    )


def _least_ids(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``class`` and ``component_id``, the smallest id in the component of the class.

    A component may hold any share of the classes: the :data:`LARGEST` ones reach theirs by
    broadcast, so that every other one has less than one class in as many.
    """
    slim = classes.select("class", "node", "doc_id")
    linked = stored(slim.join(labels, "node").select("class", "doc_id", "component"), "linked")
    least = linked.groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.count("*").alias("size")
    )
    least = stored(least, "components")
    large = least.orderBy(F.desc("size"), "component").limit(LARGEST).drop("size")
    hot = linked.join(F.broadcast(large), "component")
    rest = linked.join(F.broadcast(large), "component", "left_anti")
    cold = rest.join(least.drop("size"), "component")
    alone = slim.join(labels, "node", "left_anti").withColumn("component_id", F.col("doc_id"))
    columns = ["class", "component_id"]
    return hot.select(columns).unionByName(cold.select(columns)).unionByName(alone.select(columns))


def _labelled(docs: DataFrame, text_col: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``mark``, ``n`` and ``component_id``."""
    sketched = _sketches(docs, text_col)
    one = sketched.filter("n > 0 AND doc_id IS NOT NULL").groupBy("class").agg(
        F.min(F.struct("doc_id", "mark")).alias("first"),
        F.min("n").alias("n"),
        F.min("bands").alias("bands"),
        F.min("bits").alias("bits"),
        F.min("map").alias("map"),
    )
    numbered = one.select(
        F.monotonically_increasing_id().alias("node"), "class", "first.*", "bands", *FACTS
    )
    classes = stored(numbered, "classes")
    text = utf8(docs[text_col])
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text")
    )
    labels = stored(link_classes(classes, rows), "class-labels")
    placed = _least_ids(classes, labels)
    out = sketched.select("doc_id", "mark", "n", "class").join(placed, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "mark", "n", component.alias("component_id"))


def label_near_duplicates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every document.

    Documents are linked if 100 times the common shingles are at least 75 times all
    shingles of both; ``component_id`` is the smallest id reachable, and that document is
    ``kept``. Null texts and texts without words are linked with nothing. Rows that repeat
    an id with another text are documents of their own, each in the component of its text;
    rows with a null id belong to the component of an equal text that has an id, and stand
    alone (component null, kept) if there is none. An empty table gives no rows; other
    columns are not looked at.
    """
    out = _labelled(docs, text_col).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each component, columns unchanged.

    Rows without an id stay. Of rows that share an id, only those go whose own text is near
    that of a smaller id.
    """
    gone = (
        _labelled(docs, text_col)
        .filter("doc_id IS NOT NULL AND doc_id <> component_id")
        .select(F.col("doc_id").alias("__gone"), F.col("mark").alias("__mark"))
        .distinct()
    )
    same = (docs["doc_id"].cast("long") == gone["__gone"]) & (
        F.xxhash64(utf8(docs[text_col])) == gone["__mark"]
    )
    return docs.join(gone, same, "left_anti")
