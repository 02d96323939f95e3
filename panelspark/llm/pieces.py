"""SentencePiece (merge type) encoding by backtracking, and decoding.

A token sequence is what repeated merging gives exactly when every two adjacent tokens
are: merging the text of the pair gives back the pair. So a text is encoded from the left:
at each position the longest piece found by an Aho-Corasick automaton is tried first, then
shorter ones that it begins with (a table has the next one of each piece); a piece is taken if it is compatible with the token before it, which is
tested by merging the two again (results are remembered). Where no piece fits, the
position is marked in a bitfield of failed positions and the previous token is replaced.
As the encoding of a prefix is unique, a failed position is never tried again.

No piece has a space after another character, and some characters are in no piece but
their bytes; texts are cut there, and the ids of such units are remembered.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .base import utf8

SPACE = "▁"
#: Remembered units and pairs per worker, in two generations of this size.
REMEMBERED = 1 << 18
#: Rows turned into Python objects at a time.
SLICE = 512
#: Characters that the automaton reads ahead in one pass, besides the longest piece.
PASS = 256
NEVER = float("-inf")


class Remembered(dict):
    """A mapping computed on demand that keeps at most two generations of entries."""

    def __init__(self, make, size: int = REMEMBERED):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceModel:
    """Encoder and decoder of one model file; only merge-type models."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        kinds = [
            lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(len(pieces))
        ]
        if any(lib.is_unused(i) for i in range(len(pieces))):
            raise ValueError("models with unused pieces are not supported")
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if not k}
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(lib.is_byte(i) for i in self.byte_ids):
            raise ValueError("models without byte fallback are not supported")
        probes = ["", " ", " a  b ", "a\nb c", "Åﬁ", SPACE + "a"]
        for p in probes:
            plain = (SPACE + p.replace(" ", SPACE)) if p else ""
            if lib.normalize(p) != plain:
                raise ValueError("only models that keep their text are supported")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space after another character")
        self.bos, self.eos = lib.bos_id(), lib.eos_id()

        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.widest = max(map(len, self.ids))
        self.pass_chars = self.widest + PASS
        self.shorter = {i: self._shorter(p) for p, i in self.ids.items() if len(p) > 1}
        single = "".join(c for c in "\t\n\r" if not any(c in p for p in self.ids))
        cut = re.escape(single)
        self.units = re.compile(rf" +[^ {cut}]*|[{cut}]+|[^ {cut}]+".encode() if cut else rb" +[^ ]*|[^ ]+")
        self.unit_ids = Remembered(self._unit)
        self.fits = Remembered(self._fits)

        self.surface = [
            b"" if lib.is_control(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        for b, i in enumerate(self.byte_ids):
            self.surface[i] = bytes([b])
        self.surface[lib.unk_id()] = " ⁇ ".encode()
        self.spaced = np.array([p.startswith(SPACE) for p in pieces])
        self.silent = np.array([lib.is_control(i) for i in range(len(pieces))])

    def merge(self, text: str) -> list[str]:
        """Join the best-scored adjacent pair, leftmost first, until none is a piece."""
        parts, score = list(text), self.score
        joined = [score.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while joined and (best := max(joined)) > NEVER:
            at = joined.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joined[at]
            if at:
                joined[at - 1] = score.get(parts[at - 1] + parts[at], NEVER)
            if at < len(joined):
                joined[at] = score.get(parts[at] + parts[at + 1], NEVER)
        return parts

    # A number stands for a piece (its id) or, below 0, for a character that is no piece.

    def _number(self, char: str) -> int:
        return self.ids.get(char, -1 - ord(char))

    def _text(self, number: int) -> str:
        return self.pieces[number] if number >= 0 else chr(-1 - number)

    def _shorter(self, piece: str) -> tuple[int, int]:
        """The next shorter piece that a piece begins with, or its first character."""
        for end in range(len(piece) - 1, 1, -1):
            if piece[:end] in self.ids:
                return self.ids[piece[:end]], end
        return self._number(piece[0]), 1

    def _fits(self, pair: tuple[int | None, int]) -> bool:
        """If merging gives the two back; None is the begin of a text."""
        parts = [self._text(x) for x in pair if x is not None]
        return self.merge("".join(parts)) == parts

    def _longest(self, text: str, at: int, known: dict[int, tuple[int, int]]) -> tuple[int, int]:
        """The longest piece (or the character) at a place, and its length.

        One pass of the automaton gives also those that follow it end to end, up to a
        known place or as far as no match can be cut by the end of the pass.
        """
        place, stop = at, min(len(text), at + self.pass_chars)
        sure = stop if stop == len(text) else stop - self.widest
        for last, match in self.automaton.iter_long(text[at:stop]):
            begin = at + last - match[1] + 1
            while place < begin and place < sure and place not in known:  # no piece begins there
                known[place] = self._number(text[place]), 1
                place += 1
            if place >= sure or place in known:
                break
            known[place] = match
            place = at + last + 1
        else:
            while place < sure and place not in known:
                known[place] = self._number(text[place]), 1
                place += 1
        return known[at]

    def numbers(self, text: str) -> list[int]:
        """The numbers of a text (spaces as :data:`SPACE`) by backtracking."""
        n, shorter, fits = len(text), self.shorter, self.fits
        known: dict[int, tuple[int, int]] = {}
        failed = bytearray(n // 8 + 1)
        found: list[int] = []
        ends = [0]
        at, before, own = 0, None, None
        while at < n:
            if own is None:
                match = known.get(at) or self._longest(text, at, known)
            else:
                match = shorter.get(own)
            while match:
                own, size = match
                end = at + size
                if not failed[end >> 3] >> (end & 7) & 1 and fits[before, own]:
                    break
                match = shorter.get(own)
            if match:
                found.append(own)
                ends.append(end)
                at, before, own = end, own, None
            else:
                failed[at >> 3] |= 1 << (at & 7)
                ends.pop()
                at, own = ends[-1], found.pop()
                before = found[-1] if found else None
        return found

    def tokens(self, text: str) -> list[str]:
        return [self._text(x) for x in self.numbers(text)]

    def _unit(self, unit: bytes) -> bytes:
        out: list[int] = []
        for number in self.numbers(unit.decode("utf-8", "replace").replace(" ", SPACE)):
            if number >= 0:
                out.append(number)
            else:
                out.extend([self.byte_ids[b] for b in chr(-1 - number).encode()])
        return struct.pack(f"<{len(out)}I", *out)

    def encode(self, text: bytes, ends: bool = True) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        body = b""
        if text:
            spaced = b" " + text.replace(SPACE.encode(), b" ")
            body = b"".join(map(self.unit_ids.__getitem__, self.units.findall(spaced)))
        if ends:
            body = np.uint32(self.bos).tobytes() + body + np.uint32(self.eos).tobytes()
        return body

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4")
        raw = b"".join(map(self.surface.__getitem__, numbers.tolist()))
        spoken = numbers[~self.silent[numbers]][:1]
        if spoken.size and self.spaced[spoken[0]]:
            raw = raw[1:]
        return raw.decode("utf-8", "each-byte")


def _each_byte(error):
    return "�" * (error.end - error.start), error.end


@lru_cache(maxsize=2)
def model(model_file: str) -> PieceModel:
    import codecs

    codecs.register_error("each-byte", _each_byte)
    return PieceModel(model_file)


def piece_ids(text: Column, model_file: str, ends: bool = True) -> Column:
    """Ids of a text, packed as little-endian unsigned 32-bit integers (binary).

    ``ends`` adds the begin and end ids. A null text counts as empty.
    """

    @arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model(model_file)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                texts = batch.slice(at, SLICE).to_pylist()
                yield pa.array([m.encode(t or b"", ends) for t in texts], pa.binary())

    return encode(utf8(text))


def piece_text(ids: Column, model_file: str) -> Column:
    """Text of packed ids; begin and end ids are silent, broken bytes become U+FFFD."""

    @arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model(model_file)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                packed = batch.slice(at, SLICE).to_pylist()
                yield pa.array([None if p is None else m.decode(p) for p in packed], pa.string())

    return decode(ids)


def piece_round_trip(text: Column, model_file: str, ends: bool = True) -> Column:
    """``struct<ids: binary, text: string>``: packed ids and the text decoded from them."""

    @arrow_udf("struct<ids: binary, text: string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model(model_file)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                ids = [m.encode(t or b"", ends) for t in batch.slice(at, SLICE).to_pylist()]
                yield pa.StructArray.from_arrays(
                    [
                        pa.array(ids, pa.binary()),
                        pa.array([m.decode(i) for i in ids], pa.string()),
                    ],
                    ["ids", "text"],
                )

    return both(utf8(text))


def encode_documents(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id``, ``ids`` (packed), ``decoded``, ``n_tokens``.

    Null and empty texts give the begin and end ids only. Repeated rows give repeated
    results, an empty table none; other columns are not looked at. Memory follows the
    longest text, and for the search the longest run without a space.
    """
    pair = piece_round_trip(docs[text_col], model_file)
    rows = docs.select(docs["doc_id"].alias("doc_id"), pair.alias("pair"))
    return rows.select(
        "doc_id",
        F.col("pair.ids").alias("ids"),
        F.col("pair.text").alias("decoded"),
        (F.octet_length("pair.ids") / 4).cast("long").alias("n_tokens"),
    )
