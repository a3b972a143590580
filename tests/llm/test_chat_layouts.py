"""Layouts are found beside extra fields named like those of other layouts."""

import json

import pytest

from pricehouse.llm import chat_format

CLASHING = ["prompt", "input", "output", "answer", "question", "system", "response", "completion", "instruction"]


@pytest.mark.parametrize("name", CLASHING)
def test_clashing_columns(workers, name):
    table = workers.createDataFrame([(1, 0, "user", "a", "x")], f"conv_id bigint, turn bigint, role string, text string, {name} string")
    assert [tuple(r) for r in chat_format.table_turns(table).collect()] == [(1, 0, "user", "a")]


@pytest.mark.parametrize("name", CLASHING)
def test_clashing_fields(name):
    """A further text of another layout would be lost, so the record has no mapping; an empty field loses nothing."""
    said = [("user", "a"), ("assistant", "b")]
    record = {"messages": [{"role": r, "content": t} for r, t in said]}
    head = [("system", "x")] if name == "system" else []
    assert chat_format.turns_of(json.dumps({**record, name: "x"})) == ([*head, *said] if head else None)
    for empty in (None, ""):
        found = chat_format.turns_of(json.dumps({**record, name: empty}))
        assert found == ([("system", empty), *said] if name == "system" else said)
    assert chat_format.turns_of(json.dumps({**record, "source": "web", "score": 3})) == said


@pytest.mark.parametrize("record", [
    {"messages": [{"role": "user", "content": "hi"}], "prompt": "p", "completion": "c"},
    {"prompt": "p", "completion": "c", "response": "r"},
    {"conv_id": 1, "turn": 0, "role": "user", "text": "t", "prompt": "p", "completion": "c"},
    {"prompt": "p", "completion": "c", "input": "i"},
    {"question": "q", "answer": "a", "messages": [{"role": "user", "content": "hi"}]},
])
def test_records_of_two_layouts_lose_no_text(workers, record):
    text = json.dumps(record)
    rows = workers.createDataFrame([(5, text)], "conv_id bigint, record string")
    assert [tuple(r) for r in chat_format.record_turns(rows).collect()] == [(5, -1, None, text)]


def test_system_and_parts():
    record = {"system": "s", "prompt": "a", "completion": "b"}
    assert chat_format.turns_of(json.dumps(record)) == [("system", "s"), ("user", "a"), ("assistant", "b")]
    parts = [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]
    record = {"messages": [{"role": "user", "content": parts}]}
    assert chat_format.turns_of(json.dumps(record)) == [("user", "ab")]


def test_system_and_parts_in_a_table(workers):
    kind = "conv_id bigint, system string, messages array<struct<role:string,content:array<struct<type:string,text:string>>>>"
    table = workers.createDataFrame([(1, "s", [("user", [("text", "a"), ("text", "b")])])], kind)
    assert [tuple(r) for r in chat_format.table_turns(table).collect()] == [(1, 0, "system", "s"), (1, 1, "user", "ab")]
