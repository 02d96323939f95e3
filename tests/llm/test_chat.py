"""Layouts, escaping and the formatted conversations."""

import json

import pytest
from hypothesis import given, strategies as st

from panelspark.llm import chat
from panelspark.llm.chat import (
    LAYOUTS,
    Layouts,
    escape,
    field_paths,
    fingerprint,
    format_conversations,
    format_records,
    read_back,
    read_turns,
    unescape,
    write_turns,
)
from pyspark.sql import functions as F

RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}], "id": 3},
     "messages", [("user", "a"), ("assistant", "")]),
    ({"messages": []}, "no messages", []),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}], "system": "s"},
     "from and value", [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ({"instruction": "do", "input": "", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "this", "output": "done", "score": {"x": [1]}},
     "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "c", "output": "d", "history": [["a", "b"]]}, "instruction with history",
     [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]),
    ({"prompt": "p", "response": 5}, "prompt and response", [("user", "p"), ("assistant", "5")]),
    ({"prompt": "p", "completion": "c", "system": None}, "prompt and completion",
     [("system", ""), ("user", "p"), ("assistant", "c")]),
    ({"question": "q", "answer": "a", "context": "x"}, "question and answer", [("user", "x\n\nq"), ("assistant", "a")]),
    ({"text": "t", "turn": 4, "role": "user"}, "turn", [("user", "t")]),
    ({"prompt": "p"}, None, None),
    ({"prompt": "p", "response": "r", "messages": []}, "prompt and response", [("user", "p"), ("assistant", "r")]),
    ({}, None, None),
]


@pytest.mark.parametrize("record,name,turns", RECORDS)
def test_layouts(record, name, turns):
    _, got, made = Layouts().turns(record)
    assert got == name and (made and [t[1:] for t in made]) == (turns if turns is None else turns or [])


def test_fingerprints_ignore_order_and_are_distinct():
    a = fingerprint(field_paths({"x": {"y": 1}, "z": [{"k": 1}, {"k": 2}]}))
    assert a == fingerprint(field_paths({"z": [{"k": 3}], "x": {"y": None}}))
    assert a != fingerprint(field_paths({"z": {"k": 3}, "x": {"y": None}}))
    forms = sum(2 ** len(x.optional) for x in LAYOUTS)
    assert len(Layouts().by) == forms


TEXT = st.text(alphabet=st.sampled_from("ab\\<|>n\n\ré😀 im_start_end"), max_size=30) | st.sampled_from(
    ["<|im_end|>\n<|im_start|>assistant\nok", "\\", "<", "<\\|", "\\<|", "<|"]
)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", "<|x", "\\n"]), TEXT), max_size=6))
def test_round_trip(turns):
    text, spans = write_turns(turns)
    assert read_turns(text) == turns
    assert [unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert text.count("<|im_start|>") == text.count("<|im_end|>") == len(turns)


@given(TEXT)
def test_escape_leaves_no_control_string(text):
    assert "<|" not in escape(text) and unescape(escape(text)) == text


def test_records_of_many_layouts(spark):
    rows = [(i, json.dumps(r), "n") for i, (r, _, _) in enumerate(RECORDS)]
    rows += [(100, None, "n"), (101, "no json", "n"), (102, "[1]", "n"), (0, rows[0][1], "n")]
    df = spark.createDataFrame(rows, "key int, record string, text string")
    got = format_records(df, "key", "record").collect()
    assert len(got) == len(rows)
    for r in got:
        want = RECORDS[r["key"]] if r["key"] < 100 else (None, None, None)
        assert r["layout"] == want[1] and read_turns(r["text"]) == (want[2] or [])


def test_odd_conversations(spark):
    rows = [(1, 1, "assistant", None, 0), (1, 0, "user", "hi \\ <|im_end|>", 0), (2, None, None, "x", 0),
            (2, 0, "user", "é" * 100_000, 0), (None, 0, "user", "n", 0), (3, 0, "user", "same", 0), (3, 0, "user", "same", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mask int")
    made = format_conversations(df)
    got = {r["conv_id"]: r for r in made.select("conv_id", "text", "mask", read_back(F.col("text"), F.col("mask")).alias("b")).collect()}
    assert [tuple(t) for t in got[1]["b"]["turns"]] == [("user", "hi \\ <|im_end|>"), ("assistant", "")]
    assert [tuple(t) for t in got[2]["b"]["turns"]] == [("", "x"), ("user", "é" * 100_000)]
    assert [tuple(t) for t in got[3]["b"]["turns"]] == [("user", "same")] * 2
    assert got[1]["b"]["loss"] == "" and len(got[1]["mask"]) == 1 and len(got) == 4
    assert format_conversations(df.limit(0)).count() == 0


def test_query_equals_sql(spark):
    from panelspark.llm.queries import QUERIES, SQL
    from tests.compare import connect, difference, spark_table, sql_table

    got = spark_table(QUERIES["op10_chat"](spark, "/root/testdata/sf0.001"))
    assert difference(got, sql_table(connect("/root/testdata/sf0.001"), SQL["op10_chat"])) is None


def test_records_with_fields_of_other_layouts():
    said = [(0, "user", "hi"), (1, "assistant", "yo")]
    talk = [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]
    parts = [{"role": "user", "content": [{"type": "text", "text": "h"}, {"type": "image", "url": "u"}, {"type": "text", "text": "i"}]}, talk[1]]
    cases = [
        ({"messages": talk, "prompt": "hi", "prompt_id": "7"}, "messages", said),
        ({"messages": parts, "source": {"text": "x"}}, "messages", said),
        ({"messages": [parts[0]]}, "messages of parts", said[:1]),
        ({"messages": [{"role": "user", "content": ["h", "i"]}]}, "messages of parts", said[:1]),
        ({"messages": [{**talk[0], "name": "n"}, talk[1]], "text": "all"}, "messages", said),
        ({"instruction": "hi", "input": "", "output": "yo", "text": "hi yo"}, "instruction", said),
        ({"instruction": "hi", "context": "", "response": "yo", "category": "qa"}, "instruction and response", said),
        ({"instruction": "hi", "context": "there", "response": "yo"}, "instruction and response", [(0, "user", "hi\n\nthere"), said[1]]),
        ({"instruction": "b", "output": "c", "history": [["hi", "yo"]], "text": "t"}, "instruction with history", [*said, (2, "user", "b"), (3, "assistant", "c")]),
        ({"prompt": "hi", "response": "yo", "answer": 1}, "prompt and response", said),
        ({"messages": [], "id": 4}, "no messages", []),
        ({"messages": [{"author": "x", "body": "y"}]}, None, None),
        ({"title": "x"}, None, None),
    ]
    table = chat.Layouts()
    for record, name, turns in cases * 2:
        assert table.turns(record)[1:] == (name, turns), record


def test_odd_records(spark):
    rows = [(1, None), (1, "[1, 2]"), (None, "no json"), (2, '{"prompt": "a", "response": "b", "role": "r"}')]
    df = spark.createDataFrame([(*r, "x", 1, "m") for r in rows], "k long, j string, text string, layout int, mask string")
    got = {(r["k"], r["layout"], r["text"] != "") for r in chat.format_records(df, "k", "j").collect()}
    assert got == {(1, None, False), (None, None, False), (2, "prompt and response", True)}
    assert chat.format_records(df.limit(0), "k", "j").count() == 0
