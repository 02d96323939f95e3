"""Chat formatting: records of many layouts become turns, turns become one text.

A record is JSON. The nested paths of its fields, as far as a layout knows them, are hashed
to a fingerprint (``messages[].role`` for the role of every message). Each layout declares
its paths and where roles and texts come from; a record is of the first layout that has the
fingerprint among those of its forms (optional fields present or not). Fields that a layout
does not know are ignored, also where another layout knows them. Which layout a set of
paths selects is remembered, so that records alike cost one look-up.

A turn is ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. In
texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold a control
string, and removing the backslashes gives the text back. The loss mask is the spans of
the assistant's texts, in characters of the formatted text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

#: Sets of paths remembered in a task.
SEEN = 4096
START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Layout:
    """How one kind of record becomes turns.

    ``steps`` give turns in order: ``(role, path, ...)`` is one turn whose text is made
    of the non-empty fields, or no turn if the first is absent; ``("each", list, role,
    text)`` a turn per element, whose text may be a list of parts; ``("pairs", list)`` a
    user and an assistant turn per element. A record with a path that begins like one of
    ``without`` is not of this layout.
    """

    name: str
    paths: tuple[str, ...]
    steps: tuple[tuple[str, ...], ...]
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()
    without: tuple[str, ...] = ()


PARTS = ("messages[].content[]", "messages[].content[].type", "messages[].content[].text")

#: In the order in which they are preferred.
#: Field names of public data sets.
LAYOUTS = (
    Layout("messages", ("messages[]", "messages[].role", "messages[].content"), (("each", "messages", "role", "content"),), PARTS),
    Layout("messages of parts", ("messages[]", "messages[].role", PARTS[0]), (("each", "messages", "role", "content"),), PARTS[1:]),
    Layout(
        "from and value",
        ("conversations[]", "conversations[].from", "conversations[].value"),
        (("system", "system"), ("each", "conversations", "from", "value")),
        ("system",),
        (("human", "user"), ("gpt", "assistant")),
    ),
    Layout(
        "instruction with history",
        ("instruction", "output", "history[]", "history[][]"),
        (("system", "system"), ("pairs", "history"), ("user", "instruction", "input"), ("assistant", "output")),
        ("input", "system"),
    ),
    Layout(
        "instruction",
        ("instruction", "output"),
        (("system", "system"), ("user", "instruction", "input"), ("assistant", "output")),
        ("input", "system"),
    ),
    Layout(
        "instruction and response",
        ("instruction", "response"),
        (("system", "system"), ("user", "instruction", "context"), ("assistant", "response")),
        ("context", "system"),
    ),
    Layout("prompt and response", ("prompt", "response"), (("system", "system"), ("user", "prompt"), ("assistant", "response")), ("system",)),
    Layout("prompt and completion", ("prompt", "completion"), (("system", "system"), ("user", "prompt"), ("assistant", "completion")), ("system",)),
    Layout("question and answer", ("question", "answer"), (("user", "context", "question"), ("assistant", "answer")), ("context",)),
    Layout("turn", ("role", "text", "turn"), (("turn", "role", "text"),), ("conv_id",)),
    Layout("no messages", ("messages[]",), (("each", "messages", "role", "content"),), without=("messages[].",)),
)


def field_paths(value, at: str = "") -> Iterator[str]:
    if isinstance(value, dict):
        for name, inner in value.items():
            path = f"{at}.{name}" if at else name
            if not isinstance(inner, list):
                yield path
            yield from field_paths(inner, path)
    elif isinstance(value, list):
        yield f"{at}[]"
        for inner in value:
            yield from field_paths(inner, f"{at}[]")


def fingerprint(paths) -> str:
    return hashlib.blake2b("\n".join(sorted(set(paths))).encode(), digest_size=8).hexdigest()


class Layouts:
    """Layouts by the fingerprints of their forms."""

    def __init__(self, layouts: tuple[Layout, ...] = LAYOUTS):
        self.layouts = [(x, {*x.paths, *x.optional}) for x in layouts]
        self.known = {p for _, own in self.layouts for p in own}
        self.by: dict[tuple[str, str], Layout] = {}
        for x in layouts:
            for n in range(len(x.optional) + 1):
                for more in combinations(x.optional, n):
                    self.by[x.name, fingerprint((*x.paths, *more))] = x
        self.seen: dict[frozenset, tuple[str, Layout | None]] = {}

    def select(self, paths: frozenset) -> tuple[str, Layout | None]:
        """Fingerprint and layout of a set of field paths."""
        for layout, own in self.layouts:
            key = fingerprint(p for p in paths if p in own)
            odd = layout.without and any(p.startswith(layout.without) for p in paths)
            if (layout.name, key) in self.by and not odd:
                return key, layout
        return fingerprint(p for p in paths if p in self.known), None

    def turns(self, record) -> tuple[str, str | None, list | None]:
        """Fingerprint, name of the layout, and turns (order, role, text) of a record."""
        paths = frozenset(field_paths(record))
        if paths not in self.seen:
            if len(self.seen) >= SEEN:
                self.seen.clear()
            self.seen[paths] = self.select(paths)
        key, layout = self.seen[paths]
        if layout is None or not isinstance(record, dict):
            return key, None, None
        roles, out = dict(layout.roles), []

        def add(role, text):
            role = _text(role)
            out.append((len(out), roles.get(role, role), _text(text)))

        for kind, *fields in layout.steps:
            if kind == "each":
                for one in record[fields[0]] or ():
                    if isinstance(one, dict):
                        add(one.get(fields[1]), _joined(one.get(fields[2])))
            elif kind == "pairs":
                for one in record[fields[0]] or ():
                    for role, text in zip(("user", ASSISTANT), one if isinstance(one, list) else ()):
                        add(role, text)
            elif kind == "turn":
                out.append((record["turn"], _text(record["role"]), _text(record["text"])))
            elif fields[-1] in record or fields[0] in record:
                add(kind, "\n\n".join(t for t in (_text(record.get(f)) for f in fields) if t))
        return key, layout.name, out


def _joined(value):
    """A text given as a list of parts; a part without text, like an image, adds nothing."""
    if not isinstance(value, list):
        return value
    return "".join(_text(p.get("text")) if isinstance(p, dict) else _text(p) for p in value)


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


def canonical(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """``struct<fingerprint, layout, turns: array<struct<turn, role, text>>>`` of JSON text.

    A record that is null, no JSON object or of no known layout has null layout and turns.
    """

    @arrow_udf(
        "struct<fingerprint: string, layout: string,"
        " turns: array<struct<turn: bigint, role: string, text: string>>>"
    )
    def convert(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = Layouts(layouts)
        kind = pa.struct(
            [
                ("fingerprint", pa.string()),
                ("layout", pa.string()),
                ("turns", pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))),
            ]
        )
        for batch in batches:
            out = []
            for text in batch.to_pylist():
                try:
                    record = json.loads(text) if text is not None else None
                except ValueError:
                    record = None
                key, name, turns = table.turns(record)
                made = None if turns is None else [dict(zip(("turn", "role", "text"), t)) for t in turns]
                out.append({"fingerprint": key, "layout": name, "turns": made})
            yield pa.array(out, kind)

    return convert(record)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.DOTALL)


def write_turns(turns) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns, and the spans of the assistant's texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        at += len(head)
        if role == ASSISTANT:
            spans.append((at, at + len(body)))
        at += len(body) + len(END)
        parts += (head, body, END)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix(START).partition("\n")
        out.append((unescape_role(role), unescape(text)))
    return out


def format_turns(turns: Column) -> Column:
    """``struct<text, mask: array<struct<first, end>>>`` of an array of turns in order."""

    @arrow_udf("struct<text: string, mask: array<struct<first: bigint, end: bigint>>>")
    def written(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct(
            [("text", pa.string()), ("mask", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))]
        )
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text, spans = write_turns([(t["role"] or "", t["text"] or "") for t in row or ()])
                out.append({"text": text, "mask": [{"first": a, "end": b} for a, b in spans]})
            yield pa.array(out, kind)

    return written(turns)


def read_back(text: Column, mask: Column) -> Column:
    """``struct<turns: array<struct<role, text>>, loss: string>`` of a formatted text."""

    @arrow_udf("struct<turns: array<struct<role: string, text: string>>, loss: string>")
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct(
            [("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), ("loss", pa.string())]
        )
        for texts, masks in batches:
            out = []
            for one, spans in zip(texts.to_pylist(), masks.to_pylist()):
                loss = "".join(unescape(one[s["first"] : s["end"]]) for s in spans)
                out.append({"turns": [{"role": r, "text": t} for r, t in read_turns(one)], "loss": loss})
            yield pa.array(out, kind)

    return read(text, mask)


def format_records(records: DataFrame, key: str, json_col: str) -> DataFrame:
    """``key``, ``layout``, ``text`` and ``mask`` of records that hold a whole chat each.

    Records that are null, no JSON object, or of unknown layout have null layout and an
    empty text. Repeated and null keys are rows of their own, an empty table gives none, and
    other columns are not looked at, whatever their names.
    """
    found = records.select(records[key].alias(key), canonical(records[json_col]).alias("c"))
    made = found.select(key, F.col("c.layout").alias("layout"), format_turns(F.col("c.turns")).alias("f"))
    return made.select(key, "layout", F.col("f.text").alias("text"), F.col("f.mask").alias("mask"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``text`` and ``mask`` of a table with a row per turn.

    Every row goes through its layout as a record. Turns are ordered by number, then role
    and text; null numbers come first, null roles and texts are empty, rows with a null
    ``conv_id`` are one conversation, and repeated rows are repeated turns. An empty table
    gives no rows; other columns are not looked at. A conversation is one text, so its
    turns meet in one task.
    """
    turn = F.struct(*[rows[c].alias(c) for c in ("turn", "role", "text")])
    found = rows.select(
        rows["conv_id"].alias("conv_id"),
        canonical(F.to_json(turn, {"ignoreNullFields": "false"})).alias("c"),
    )
    turns = found.select("conv_id", F.element_at("c.turns", 1).alias("t"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    made = chats.select("conv_id", format_turns(F.col("turns")).alias("f"))
    return made.select("conv_id", F.col("f.text").alias("text"), F.col("f.mask").alias("mask"))
