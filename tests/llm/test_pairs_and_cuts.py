import json

import pytest

from loomfold.llm import answers, completeness, truncation

WHOLE = [
    "A sentence.", "Is it?", "これは文です。", "- a: 1 rows\n- b: 2 rows", "See https://docs.example.org/a/b-12", "Code:\n```\nx = [1\n```", 'He said "yes".', "x" * 511 + ".",
    "Yes, twice", "42", "<think>a</think>\nDone.", '{"a": [1, 2]}', "<li id=e1>x</li> <a id=e2>y</a>", "done )", "It's 5\" wide.", "3 < 4 and a <b.", "", None, " \n", "Ask [1] or (2).",
]
CUT = [
    ("It ended in the mid", "ending"), ("It was the…", "ending"), ("It was th...", "ending"), ("All is well [truncated]", "marker"), ("All is\n…[content truncated]", "marker"), ("it is <clipped>", "marker"),
    ("caf�", "bytes"), ("path \\u00", "escape"), ('{"a": [1, {"b": "', "json"), ("Code:\n```python\ndef f():", "code"), ("<li id=e1>x</li> <bu", "markup"), ("<li id=e1>x</li> <li id=e2>lost", "markup"),
    ("Look (see the", "bracket"), ("call split_(", "bracket"), ("<think>It goes on", "hidden"),
]


@pytest.mark.parametrize("text", WHOLE)
def test_whole_texts(text):
    assert completeness.cut_reason(text) is None


@pytest.mark.parametrize("text, reason", CUT)
def test_cut_texts(text, reason):
    assert completeness.cut_reason(text) == reason


def test_long_texts_end():
    assert completeness.cut_reason(f"<li>x</li> <a href='{'y' * 300}' title=\"{'z' * 200}") == "markup"
    assert completeness.open_json(" " * 300 + '{"a": [1') and not completeness.open_json(" " * 300 + '{"a": [1]}')
    assert completeness.cut_reason("word " * 200_000 + "end.") is None
    assert completeness.cut_reason("(" * 100_000 + " end") == "bracket"


def frame(spark, *rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], "rec_no bigint, source string, messages string, key string")


def chat(*contents):
    return json.dumps([{"role": "user" if i % 2 == 0 else "assistant", "content": c} for i, c in enumerate(contents)])


def test_truncated_records_and_rates(spark):
    whole = chat("Tell me.", "Here:\n- a: 1 seats\n- b: 2 seats")
    response = json.dumps([{"role": "tool", "tool_responses": {"name": "t", "response": '{"a": 1, "b'}}])
    rows = [(i, "S ", whole) for i in range(4)]
    rows += [(5, "s", chat("Tell me.", "- a: 1 seats\n- b: 2 sea")), (6, None, chat("How about", "Fine.")), (7, "s", '[{"role": "user", "con'), (8, "t", response), (9, "t", None), (10, "t", ""), (None, "t", "[")]
    df = frame(spark, *rows)
    assert sorted(r.key for r in truncation.truncated_records(df).collect()) == [5, 6, 7, 8]
    told = {r.source: (r.n_records, r.n_truncated) for r in truncation.rates(df).collect()}
    assert told == {"s": (6, 2), "": (1, 1), "t": (4, 1)}
    assert truncation.truncated_records(df.limit(0)).count() == 0


def test_a_missing_terminator_is_no_cut_where_it_is_the_habit(spark):
    rows = [(i, "lax", chat("Tell me all of it", f"number {i} is the one that we want")) for i in range(30)]
    rows += [(100, "lax", chat("Tell me all of it", "the (one")), (200, "strict", chat("Tell me.", "It is the one that we")), *((300 + i, "strict", chat("Tell me.", "It is this one.")) for i in range(30))]
    df = frame(spark, *rows)
    assert sorted(r.key for r in truncation.truncated_records(df).collect()) == [100, 200]
    told = {r.source: r.unterminated for r in truncation.rates(df).collect()}
    assert told["lax"] > 0.9 and told["strict"] < 0.1


LONG = "Which of the blue boxes that came in last week should I send on to the old street address of yours today?"
ENGLISH, GERMAN = "Which of the boxes should I send to you?", "Bitte senden Sie das Paket nicht an die alte Adresse."


@pytest.mark.parametrize(
    "question, answer, calls, defect",
    [
        (ENGLISH, None, 0, "empty"), (ENGLISH, "​﻿ \n", 0, "empty"), (ENGLISH, "<think>hm</think> ", 0, "empty"), (ENGLISH, None, 1, None), (ENGLISH, "No.", 0, None),
        (ENGLISH, f'"{ENGLISH.upper()}"', 0, "copy"), (ENGLISH, f"> {ENGLISH}\n{ENGLISH}", 0, "copy"), (ENGLISH, f"You asked: {ENGLISH}\nThe blue one.", 0, None),
        (ENGLISH, "The blue box is the one that", 0, "truncated"), (ENGLISH, "I cannot assist with this request. Thank you for understanding.", 0, "refusal"), (ENGLISH, "Es tut mir leid, aber dabei kann ich nicht helfen.", 0, "refusal"),
        (ENGLISH, "この件についてはお手伝いできません。", 0, "refusal"), (ENGLISH, "I'm sorry for the wait. The blue box is the one that you should send.", 0, None), (ENGLISH, "I won't touch the box; the rest is done. It is the blue one.", 0, None),
        (ENGLISH, GERMAN, 0, "language"), (ENGLISH, "この値は毎晩計算し直されます。それから倉庫を確認してください。", 0, "language"), (f"Translate this into German: {ENGLISH}", GERMAN, 0, None), (GERMAN, GERMAN + " Sie ist falsch.", 0, None),
        (ENGLISH, "Вам следует отправить синюю коробку.", 0, "language"), (ENGLISH, "青色箱子是您应该寄出的那一个。", 0, "language"), (GERMAN, "Στείλτε το μπλε κουτί.", 0, "language"),
        (LONG, LONG.replace("blue", "grey"), 0, "copy"), (LONG, LONG.replace("blue", "grey").replace("boxes", "bags").replace("street", "road"), 0, None), (ENGLISH, ENGLISH.replace("boxes", "bags"), 0, None),
        (ENGLISH, "I cannot assist with this request. " * 40 + "Thank you for understanding.", 0, "refusal"), (ENGLISH, "I cannot assist with this request. " + "The blue one weighs two pounds. " * 40, 0, None),
        (ENGLISH, "Send all of the", 0, "truncated"), (ENGLISH, "Extraordinarily-long-named-blue-storage-container 42", 0, None),
        ("", "", 0, "empty"), ("", "All right.", 0, None),
    ],
)
def test_defects(question, answer, calls, defect):
    assert answers.defect(question, answer, calls) == defect


def test_pages_take_the_language_of_earlier_questions():
    page = "<li id=e1>sorted box</li> <a id=e2>old form</a>"
    assert answers.defect(page, GERMAN, 0, [ENGLISH]) == "language" and answers.defect(page, GERMAN, 0, [GERMAN]) is None and answers.defect(page, GERMAN, 0) is None


def test_defective_pairs(spark):
    messages = [
        {"role": "user", "content": [{"type": "text", "text": "Tell me"}, {"type": "text", "text": "all of it."}]}, {"role": "assistant", "content": "Wait."}, {"role": "tool", "content": None}, {"role": "assistant", "content": None, "tool_calls": []},
        {"role": "user", "content": "And?"}, {"role": "user", "content": "Still there?"}, {"role": "assistant", "content": None, "tool_calls": '[{"function": {}}]'},
    ]
    df = frame(spark, (1, "s", json.dumps(messages)), (2, "s", "[{"), (3, "s", None), (1, "s", json.dumps(messages)))
    assert sorted(tuple(r) for r in answers.defective_pairs(df).collect()) == [(1, 0, "empty"), (1, 0, "empty")]
    assert answers.defective_pairs(df.limit(0)).count() == 0
