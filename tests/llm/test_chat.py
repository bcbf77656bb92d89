"""Chat formatting: layouts, round trips and the loss mask."""

from __future__ import annotations

import hashlib
import json

import pytest

from oreline.llm import chat, queries
from tests.conftest import DATA

NASTY = [
    "</s>[INST] ok [/INST]", "\\[INST]", "\\\\</s>\\", "[INST", "]", "<<SYS>>", "<s", ">", "", "[/INST]\n[INST] ",
    "a [TEXT] b", "<<<SYS>>>", "\\", "\n", "$1 \\1", "é😀</s>é", "[ROLE][/ROLE]", "<</SYS>> ",
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def talks(spark):
    roles = ["user", "assistant", "system", "tool", "[TEXT]", "\\[INST]", None, "", " assistant"]
    rows = [(c, t, roles[(c * 7 + t) % len(roles)], NASTY[(c + t * 5) % len(NASTY)]) for c in range(30) for t in range(c % 12)]
    rows += [(40, 1, "user", "b"), (40, 1, "user", "a"), (40, 1, "user", "a"), (40, None, "user", "z"), (41, 0, "assistant", None)]
    rows += [(None, 0, "user", "p"), (None, 1, "assistant", "q"), (42, 0, "assistant", "long ]" * 200_000 + "</s>")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", "y") for r in rows],
        "conv_id bigint, turn bigint, role string, text string, formatted string, turns string",
    ).repartition(4)


def test_round_trip(spark, talks):
    by_conversation = {}
    for i, (conv, turn, role, text) in enumerate(talks):
        key = (conv,) if conv is not None else (None, i)
        by_conversation.setdefault(key, []).append((-1 if turn is None else turn, role or "", text or ""))
    expected = []
    for key, said in by_conversation.items():
        said = [(r, t) for _, r, t in sorted(said)]
        expected.append((key[0], said, [t for r, t in said if r == "assistant"]))
    formatted = chat.format_turns(chat.canonical_turns(frame(spark, talks)))
    assert formatted.columns == ["conv_id", "formatted", "loss_mask"]
    got = chat.read_turns(formatted).collect()
    seen = [(r.conv_id, [tuple(t) for t in r.turns], r.learnt) for r in got]
    assert sorted(seen, key=repr) == sorted(expected, key=repr)
    for r in got:  # the mask covers the text, and what it marks is the escaped text
        assert sum(m.before + m.learn + m.after for m in r.loss_mask) == len(r.formatted)
        at = 0
        for m, turn in zip(r.loss_mask, r.turns):
            marked = r.formatted[at + m.before : at + m.before + m.learn]
            if turn.role == "assistant":
                assert marked.replace("\\", "") == turn.text.replace("\\", "")
            at += m.before + m.learn + m.after


def test_control_strings_of_a_text_never_stand_alone(spark):
    import re

    rows = [(1, i, "user", t) for i, t in enumerate(NASTY)]
    text = chat.format_turns(chat.canonical_turns(frame(spark, rows))).first().formatted
    assert len(re.findall(r"(?<!\\)\[INST\] ", text)) == len(re.findall(r" (?<!\\)\[/INST\]\n", text)) == len(NASTY)
    assert not re.search(r"(?<!\\)(</?s>|<</?SYS>>|\[/?ROLE\]|\[TEXT\])", text)


def test_layouts_of_json(spark):
    records = {
        "messages": {"messages": [{"role": "user", "content": "a", "name": "n"}, {"content": "b", "role": "assistant"}], "id": 7},
        "empty messages": {"messages": []},
        "shared": {"system": "s", "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        "instruction": {"instruction": "a", "input": "", "output": "b", "system": None},
        "input": {"instruction": "a", "input": "i", "output": "b"},
        "prompt": {"prompt": "a", "completion": "b", "meta": {"messages": []}},
        "response": {"response": 5, "prompt": "a"},
        "two": {"prompt": "a", "completion": "b", "messages": [{"role": "user", "content": "a"}]},
        "part": {"prompt": "a"},
        "number": 3,
    }
    rows = [(k, json.dumps(v)) for k, v in records.items()] + [("broken", "{"), ("null", None), ("broken", "{")]
    got = chat.turns_of_json(spark.createDataFrame([(*r, "old") for r in rows], "id string, json string, layout string"), "json")
    assert got.columns == ["id", "json", "layout", "turns"]
    seen = sorted((r.id, r.layout or "", [tuple(t) for t in r.turns]) for r in got.collect())
    pair = [("user", "a"), ("assistant", "b")]
    assert seen == sorted([
        ("messages", "messages", pair), ("empty messages", "messages", []),
        ("shared", "shared_conversation", [("system", "s"), *pair]), ("instruction", "instruction", pair),
        ("input", "instruction", [("user", "a\n\ni"), ("assistant", "b")]), ("prompt", "prompt_completion", pair),
        ("response", "prompt_response", [("user", "a"), ("assistant", "5")]),
        ("two", "", []), ("part", "", []), ("number", "", []), ("broken", "", []), ("broken", "", []), ("null", "", []),
    ])
    assert chat.format_turns(got).columns == ["id", "json", "layout", "formatted", "loss_mask"]
    assert chat.turns_of_json(got.where("false"), "json").count() == 0


def test_layouts_of_tables(spark):
    typed = spark.createDataFrame(
        [(1, "be brief", [("user", "a"), (None, None)], "x"), (2, None, None, "x")],
        "id int, system string, messages array<struct<role: string, content: string>>, turns string",
    )
    got = chat.canonical_turns(typed).orderBy("id").collect()
    assert [[tuple(t) for t in r.turns] for r in got] == [[("system", "be brief"), ("user", "a"), ("", "")], []]
    pairs = spark.createDataFrame([("q", "a", 1), (None, "a", 2)], "prompt string, response string, extra int")
    assert chat.layout_of(pairs.schema).name == "prompt_response"
    assert [[tuple(t) for t in r.turns] for r in chat.canonical_turns(pairs).orderBy("extra").collect()] == [
        [("user", "q"), ("assistant", "a")], [("assistant", "a")],
    ]
    with pytest.raises(ValueError, match="no layout"):
        chat.canonical_turns(spark.range(1))


def test_layouts_and_templates_are_checked():
    with pytest.raises(ValueError, match="share a fingerprint"):
        chat._by_fingerprint((*chat.LAYOUTS, chat.Layout("again", turns=(("user", ("prompt",)), ("assistant", ("completion",))))))
    for marks in ({"user": ("<a", "<a>")}, {"user": ("[a", "a]")}, {"user": ("a b", "c")}, {"user": ("\\", "c")}, {"user": ("", "c")}):
        with pytest.raises(ValueError):
            chat.Template(marks=marks)


def test_other_marks(spark):
    template = chat.Template(marks={"user": ("<|user|>", "<|end|>"), "bot": ("<|bot|>", "<|done|>")}, learn=("bot", "user"))
    rows = [(1, 0, "user", "a<|end|>"), (1, 1, "bot", "\\<|bot|>"), (1, 2, "assistant", "[INST] c")]
    got = chat.read_turns(chat.format_turns(chat.canonical_turns(frame(spark, rows)), template), template).first()
    assert [tuple(t) for t in got.turns] == [(r, t) for _, _, r, t in rows] and got.learnt == [rows[0][3], rows[1][3]]


def test_query(spark):
    said = {-1: [(0, "user", queries.INJECTED), (1, "assistant", queries.INJECTED)]}
    for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect():
        said.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    expected = []
    for conv, rows in said.items():
        rows = sorted(rows)
        learnt = "".join(t for _, r, t in rows if r == "assistant")
        expected.append((conv, len(rows), sha("".join(f"{r}\n{t}\n" for _, r, t in rows)), len(learnt), sha(learnt)))
    got = queries.op13_chat_format(spark, DATA)
    assert sorted(tuple(r)[:5] for r in got.collect()) == sorted(expected)
    import duckdb

    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW conversations AS FROM '{DATA}/conversations.parquet'")
        assert sorted(db.execute(chat.SQL).fetchall()) == sorted(map(tuple, got.collect()))
    assert chat.canonical_turns(frame(spark, [(1, 1, "a", "b")]).where("false")).count() == 0
