"""Token counts; huge texts are encoded in overlapping chunks that are resynchronised.

Tokens are found in two steps: the text is cut into words by a pattern that reads from
left to right, then each word is merged on its own. Two overlapping chunks that both have
the same word, with the same tokens, at the same place agree on everything behind it: the
cutting goes on from the end of that word in both. If the left chunk also has a whole
further word behind it, its own end cannot have changed the cut, and if the next character
does not combine with the one before, neither can normalisation. Such a boundary is
stable, and the two encodings are spliced there. If the overlap has none, it is widened,
and at last the left chunk is made longer.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .base import utf8

#: Characters of a chunk and of the first overlap.
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: Counts remembered per worker, and the longest word (bytes) that is remembered.
REMEMBERED, LONGEST = 1 << 19, 256
SLICE = 256


class TokenCounter:
    """Counts the tokens that the library gives for one tokenizer file.

    ``drops_space`` says that the tokenizer's cutting pattern matches no white space and
    drops it. Then no token depends on what lies beyond a space, and counts of the parts
    between spaces are remembered, which is what makes ordinary text fast.
    """

    def __init__(self, file: str, drops_space: bool, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(file)
        self.lib.no_truncation()
        self.lib.no_padding()
        # a special string that one chunk cuts must lie whole in the next one
        special = max((len(t.content) for t in self.lib.get_added_tokens_decoder().values()), default=0)
        self.overlap = max(overlap, 2 * special)
        self.drops_space, self.chunk = drops_space, max(chunk, 2 * self.overlap)
        self.known: dict[bytes, int] = {}
        self.widened = 0

    def words(self, text: str, at: int) -> list[tuple[int, int, tuple[int, ...]]]:
        """Words of ``text`` as (start, end, token ids), places counted from ``at``."""
        got = self.lib.encode(text, add_special_tokens=False)
        out: list = []
        last = None
        for (a, b), word, token in zip(got.offsets, got.word_ids, got.ids):
            if word is not None and word == last:
                start, _, ids = out[-1]
                out[-1] = (start, at + b, (*ids, token))
            else:
                out.append((at + a, at + b, (token,)))
            last = word
        return out

    @staticmethod
    def stable(text: str, left: list, right: list) -> int | None:
        """End of the first word that proves both encodings alike behind it."""
        have = set(right[1:])  # the first word of a chunk may be cut
        for word in left[:-1]:
            if word in have:
                c = text[word[1]]
                if unicodedata.category(c)[0] != "M" and not 0x1160 <= ord(c) <= 0x11FF:
                    return word[1]
        return None

    def spliced(self, text: str) -> int:
        """Tokens of a text by overlapping chunks."""
        n, total, settled = len(text), 0, 0
        a, b, overlap = 0, min(len(text), self.chunk), self.overlap
        left = self.words(text[a:b], a)
        while b < n:
            start = max(a + 1, b - overlap)
            end = min(n, max(start + self.chunk, b + self.overlap))
            right = self.words(text[start:end], start)
            near = [w for w in left if w[0] >= start and w[1] > settled]
            cut = self.stable(text, near, right)
            if cut is not None:
                total += sum(len(w[2]) for w in left if settled < w[1] <= cut)
                settled, a, b, left, overlap = cut, start, end, right, self.overlap
                continue
            self.widened += 1
            overlap *= 2
            if overlap >= b - a:
                b = min(n, b + (b - a))
                left, overlap = self.words(text[a:b], a), self.overlap
        return total + sum(len(w[2]) for w in left if w[1] > settled)

    def one(self, text: str) -> int:
        if len(text) > self.chunk:
            return self.spliced(text)
        return len(self.lib.encode(text, add_special_tokens=False))

    def counts(self, texts: list[bytes]) -> list[int]:
        """Token counts of UTF-8 texts."""
        huge = [len(t) > self.chunk and len(t.decode("utf-8", "replace")) > self.chunk for t in texts]
        if not self.drops_space:
            return [self.one(t.decode("utf-8", "replace")) for t in texts]
        split = [[] if h else t.split() for t, h in zip(texts, huge)]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set().union(*split).difference(self.known)
        long_ = {w: self.one(w.decode("utf-8", "replace")) for w in new if len(w) > LONGEST}
        fresh = [w for w in new if w not in long_]
        got = self.lib.encode_batch_fast(
            [w.decode("utf-8", "replace") for w in fresh], add_special_tokens=False
        )
        self.known.update(zip(fresh, map(len, got)))
        self.known.update(long_)
        out = [
            self.spliced(t.decode("utf-8", "replace")) if h else sum(map(self.known.__getitem__, s))
            for t, s, h in zip(texts, split, huge)
        ]
        for w in long_:
            del self.known[w]
        return out


@lru_cache(maxsize=2)
def counter(file: str, drops_space: bool, chunk: int, overlap: int) -> TokenCounter:
    return TokenCounter(file, drops_space, chunk, overlap)


def token_count(
    text: Column, file: str, drops_space: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP
) -> Column:
    """Number of tokens of a text (null as empty), special strings as the library does."""

    @arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = counter(file, drops_space, chunk, overlap)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                texts = batch.slice(at, SLICE).to_pylist()
                yield pa.array(c.counts([t or b"" for t in texts]), pa.int64())

    return count(utf8(text))


def count_tokens(
    docs: DataFrame, file: str, limit: int = 2048, text_col: str = "text", **options
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document.

    Null and empty texts have no bytes and no tokens. Repeated rows give repeated results,
    an empty table none; other columns are not looked at.
    """
    text = docs[text_col]
    counted = docs.select(
        docs["doc_id"].alias("doc_id"),
        F.octet_length(utf8(text)).cast("long").alias("n_bytes"),
        token_count(text, file, **options).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
