"""Benchmark decontamination with suffix arrays over the training texts.

Every task builds suffix arrays of its documents, a bounded number of words at a time (a
shard), and every suffix of every test item is looked up in each by binary search. The
documents are word ids of the test vocabulary; other words are 0 and end a match, so only
positions with enough known words behind them can match and only those are in the array.
A suffix is sorted by as many words as a window has; from there a match is followed word
by word to its end. Test items come in blocks of bounded bytes, each sent to all tasks.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .base import utf8, words_text

WINDOW = 10
#: Bytes of test text sent to the tasks at once; more text makes more passes.
BLOCK_BYTES = 8 << 20
#: Suffixes in one array, and bytes of text that become words at a time.
SHARD, PIECE = 1 << 20, 4 << 20
#: Places in texts and in items that are paired at a time.
PAIRS = 1 << 20

#: A-Z become a-z; 0-9, a-z and all bytes beyond ASCII are kept; the rest separates.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
RESULT = (
    "struct<n_words: bigint, hits: array<struct<first: bigint, end: bigint>>,"
    " items: array<struct<item: string, words: bigint, at: bigint, item_at: bigint>>>"
)
ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
        (
            "items",
            pa.list_(
                pa.struct(
                    [
                        ("item", pa.string()),
                        ("words", pa.int64()),
                        ("at", pa.int64()),
                        ("item_at", pa.int64()),
                    ]
                )
            ),
        ),
    ]
)


def split_words(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a bounded piece of it at a time."""
    at = 0
    while at < len(text):
        end = at + PIECE
        piece = text[at:end].translate(TABLE)
        while end < len(text) and not piece.endswith(b" "):
            more = text[end : end + 4096].translate(TABLE)
            cut = more.find(b" ")
            piece += more if cut < 0 else more[: cut + 1]
            end += len(more) if cut < 0 else cut + 1
        yield piece.split()
        at = end


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` (``count[i]`` numbers) one after the other."""
    if not len(first):
        return np.zeros(0, np.int64)
    steps = np.ones(count.sum(), np.int64)
    starts = np.concatenate(([0], np.cumsum(count)[:-1]))
    steps[starts] = first
    steps[starts[1:]] -= first[:-1] + count[:-1] - 1
    return np.cumsum(steps)


class TestSuffixes:
    """Distinct windows of a block of test items, and where they stand in the items."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        texts = []
        for _, text in items:
            ids: list[int] = []
            for words in split_words((text or "").encode()):
                ids.extend(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words)
            texts.append(ids)
        self.window = window
        kind = ">u2" if len(self.vocabulary) < 1 << 16 else ">u4"
        self.width = np.dtype(kind).itemsize
        self.key, self.code = f"S{window * self.width}", kind
        places: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
        for i, ids in enumerate(texts):
            n = min(window, len(ids))
            for at in range(len(ids) - n + 1 if n else 0):
                prefix = np.array(ids[at : at + n], kind).tobytes()
                places.setdefault((n, prefix), []).append((i, at))
        order = sorted(places)
        self.length = np.array([n for n, _ in order], np.int64)
        pad = window * self.width
        self.low = np.array([p.ljust(pad, b"\0") for _, p in order], self.key)
        self.high = np.array([p.ljust(pad, b"\xff") for _, p in order], self.key)
        self.least = int(self.length.min()) if order else 0
        counts = np.array([len(places[k]) for k in order], np.int64)
        self.first = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        self.item = np.array([i for k in order for i, _ in places[k]], np.int64)
        self.item_at = np.array([a for k in order for _, a in places[k]], np.int64)
        self.words = np.array([w for ids in texts for w in [*ids, 0]], np.int64)
        self.starts = np.cumsum([0, *(len(ids) + 1 for ids in texts)])[:-1].astype(np.int64)

    def ids(self, text: bytes) -> np.ndarray:
        get = self.vocabulary.get
        parts = [np.array([get(w, 0) for w in words], np.int64) for words in split_words(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def search(self, texts: list[bytes]) -> list[tuple[int, list, list]]:
        """Per text: number of words, hit spans, longest match of each item."""
        docs = [self.ids(t) for t in texts]
        sizes = np.array([len(d) for d in docs], np.int64)
        out: list = [(int(n), [], []) for n in sizes]
        if not len(self.length) or not sizes.sum():
            return out
        flat = np.zeros(sizes.sum() + len(docs) + self.window, np.int64)
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))
        for d, at in zip(docs, begin):
            flat[at : at + len(d)] = d
        at, which = self._occurrences(flat)
        if not len(at):
            return out
        doc = np.searchsorted(begin, at, "right") - 1

        edges = np.zeros(len(flat) + 1, np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + self.length[which], -1)
        hit = np.cumsum(edges) > 0
        change = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False]))))
        for a, b in zip(change[::2].tolist(), change[1::2].tolist()):
            d = int(np.searchsorted(begin, a, "right")) - 1
            out[d][1].append((a - int(begin[d]), b - int(begin[d])))

        at, doc, item, item_at, length = self._maximal(flat, at, which, doc)
        order = np.lexsort((item_at, at, -length, item, doc))
        last = None
        for k in order.tolist():
            pair = (doc[k], item[k])
            if pair != last:
                d = int(doc[k])
                out[d][2].append(
                    (self.names[item[k]], int(length[k]), int(at[k] - begin[d]), int(item_at[k]))
                )
                last = pair
        return out

    def _maximal(self, flat, at, which, doc) -> tuple[np.ndarray, ...]:
        """Every match that the word before does not make longer: where it stands in the
        text and in its item, and how many words it has.

        Windows are paired with all places of theirs in items, ``PAIRS`` pairs at a time.
        """
        many = self.first[which + 1] - self.first[which]
        groups = np.concatenate(([0], np.cumsum(many))) // PAIRS
        found = []
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(groups[:-1])) + 1):
            slot = _ranges(self.first[which[part]], many[part])
            a, d = np.repeat(at[part], many[part]), np.repeat(doc[part], many[part])
            n = np.repeat(self.length[which[part]], many[part])
            item, item_at = self.item[slot], self.item_at[slot]
            place = self.starts[item] + item_at
            # items and texts are followed by a 0, so that -1 stands for no word before
            starts = (flat[a - 1] != self.words[place - 1]) | (flat[a - 1] == 0)
            a, d, n, item, item_at, place = (x[starts] for x in (a, d, n, item, item_at, place))
            found.append((a, d, item, item_at, self._followed(flat, a, place, n)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _occurrences(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all windows: (position, window), by one suffix array per shard."""
        n = len(flat)
        ends = np.where(flat == 0, np.arange(n), n)
        run = np.minimum.accumulate(ends[::-1])[::-1] - np.arange(n)
        found_at, found = [], []
        can = np.flatnonzero(run >= self.least)
        for part in range(0, len(can), SHARD):
            at = can[part : part + SHARD]
            words = np.zeros((len(at), self.window), self.code)
            for j in range(self.window):
                words[:, j] = np.where(run[at] > j, flat[np.minimum(at + j, n - 1)], 0)
            keys = words.view(self.key).ravel()
            order = np.argsort(keys, kind="stable")
            array, keys = at[order], keys[order]
            low = np.searchsorted(keys, self.low, "left")
            high = np.searchsorted(keys, self.high, "right")
            full = self.length == self.window
            high[full] = np.searchsorted(keys, self.low[full], "right")
            some = np.flatnonzero(high > low)
            count = (high - low)[some]
            found_at.append(array[_ranges(low[some], count)])
            found.append(np.repeat(some, count))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)

    def _followed(self, flat, at, item_at, length) -> np.ndarray:
        """Matches made as long as they go on."""
        length, going = length.copy(), np.arange(len(at))
        while len(going):
            a = flat[at[going] + length[going]]
            b = self.words[np.minimum(item_at[going] + length[going], len(self.words) - 1)]
            going = going[(a == b) & (a > 0)]
            length[going] += 1
        return length


_BUILT: dict[str, TestSuffixes] = {}


def _suffixes(name: str, items) -> TestSuffixes:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = TestSuffixes(items.value)
    return _BUILT[name]


def _merged(old: list, new: list) -> list:
    out: list = []
    for a, b in sorted([*((h["first"], h["end"]) for h in old), *new]):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _longest(matches: list) -> list:
    best: dict = {}
    for m in matches:
        if m[0] not in best or m[1] > best[m[0]][1]:
            best[m[0]] = m
    return list(best.values())


def matches(text: Column, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Column:
    """Where a text repeats test items.

    A struct: ``n_words``; ``hits``, the spans of words inside any occurrence of a window
    (:data:`WINDOW` successive words of an item, or all words of a shorter one); and
    ``items``, for each item with an occurring window its id, and the words, the place
    and the item's place of the longest match (of matches of one length, the first in the
    text, then in the item). Words are counted from 0. Nulls have no words;
    an item without words matches nothing; rows that repeat an item id count as one item.
    """
    spark = benchmark.sparkSession
    tests = benchmark.select(
        F.col("item_id").cast("string").alias("name"), words_text("text").alias("text")
    )
    total = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_bytes))
    result = None
    for block in range(blocks):
        own = tests if blocks == 1 else tests.filter(
            F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block
        )
        sent = spark.sparkContext.broadcast([(r["name"], r["text"]) for r in own.collect()])
        search = _searcher(uuid.uuid4().hex, sent)
        result = search(utf8(text), F.lit(None).cast(RESULT) if result is None else result)
    return result


def _searcher(name: str, sent):
    @arrow_udf(RESULT)
    def search(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        suffixes = _suffixes(name, sent)
        for texts, before in batches:
            at, sizes = 0, pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held < PIECE):
                    held += sizes[end]
                    end += 1
                rows = texts.slice(at, end - at).to_pylist()
                found = suffixes.search([t or b"" for t in rows])
                if before.null_count < len(before):
                    old = before.slice(at, end - at).to_pylist()
                    found = [
                        (
                            n,
                            _merged(o["hits"], h),
                            _longest(
                                [(m["item"], m["words"], m["at"], m["item_at"]) for m in o["items"]]
                                + i
                            ),
                        )
                        for (n, h, i), o in zip(found, old)
                    ]
                yield pa.array(
                    [
                        {
                            "n_words": n,
                            "hits": [{"first": a, "end": b} for a, b in h],
                            "items": [
                                dict(zip(("item", "words", "at", "item_at"), m))
                                for m in _longest(i)
                            ],
                        }
                        for n, h, i in found
                    ],
                    ARROW,
                )
                at = end

    return search


def find_matches(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options
) -> DataFrame:
    """``doc_id`` and the fields of :func:`matches` for every document."""
    found = docs.select(
        docs["doc_id"].alias("doc_id"), matches(docs[text_col], benchmark, **options).alias("m")
    )
    return found.select("doc_id", "m.n_words", "m.hits", "m.items")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options
) -> DataFrame:
    """The documents in which no window of a test item occurs, columns unchanged."""
    return docs.filter(F.size(matches(docs[text_col], benchmark, **options)["items"]) == 0)
