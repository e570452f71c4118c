import json

import pytest
from pyspark.sql import functions as F

from loomfold.functions import hashing, jsonx, parsers, text


def column(spark, function, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("x"))).collect()]


def test_text_columns(spark):
    assert column(spark, text.strip_cot, "<think>a</think>\n b", "a<THINK>open", "<think>x</think>", None, "") == ["b", "a", None, None, ""]
    assert column(spark, text.strip_markers, "[INST] hi</s>", "<s>", None, "") == ["hi", None, None, ""]
    assert column(spark, text.tool_name, "Market Trends API", "exa-search-web", "9lives", "!!", None, " a__") == ["Market_Trends_API", "exa_search_web", "fn_9lives", "unknown_tool", "unknown_tool", "a"]
    assert column(spark, text.normal_text, " A \n b", None) == ["a b", ""]
    assert [len(x) for x in column(spark, text.clean, "x" * 300_000)] == [200_000 + len(text.CONTENT_TAIL)]
    assert column(spark, text.observation, "OBSERVATION:\n x ", "x OBSERVATION:") == ["x", "x OBSERVATION:"]
    assert column(spark, text.final_answer, "stop [the end]", "stop []", "note x") == ["the end", "stop []", "x"]
    assert column(spark, text.cap_dom, None, "x" * 12_001)[0] == ""


@pytest.mark.parametrize(
    "inst, repo, key",
    [
        ("owner__repo-123", "o/r", "swe::owner__repo-123"), ("Owner__repo-123.abc.x", None, "swe::owner__repo-123"), ("o__r.1a2b.bug__x", None, "swe::o__r.1a2b.bug__x"),
        ("o__r_abc_bug_RUN7", None, "swe::o__r_abc_bug"), (" ", "O/R", "swe::repo::o/r"), (None, None, None), ("", "", None),
    ],
)
def test_group_key(spark, inst, repo, key):
    rows = spark.createDataFrame([(inst, None, repo)], "i string, t string, r string")
    assert rows.select(text.group_key("i", "t", "r")).first()[0] == key


def test_python_text_agrees_with_columns(spark):
    given = ["<think>a</think> [INST]b", "x", "<s>", " y\n", "a<think>"]
    assert column(spark, text.clean, *given) == [text.py_clean(x) for x in given]
    names = ["A b", "1a", "", "é", "_x_"]
    assert column(spark, text.tool_name, *names) == [text.py_tool_name(x) for x in names]


def test_tolerant_json():
    assert jsonx.loads("{'a': 1}") == {"a": 1} and jsonx.loads(" ") is None and jsonx.loads("say ...") == "say ..."
    assert jsonx.loads("[1, ...]") == "[1, ...]" and jsonx.loads("...") == "..." and jsonx.loads({"a": 1}) == {"a": 1}
    assert jsonx.encode({"b": float("nan"), "a": [..., b"x", {1}, (2,)], "é": float("inf")}) == '{"b":null,"a":[null,"x",[1],[2]],"é":null}'
    assert jsonx.arguments("[1]") == {"_args": [1]} and jsonx.arguments("3") == {"value": 3} and jsonx.arguments(None) == {} and jsonx.arguments("x") == {"value": "x"}
    assert [jsonx.value_type(v) for v in (True, 1, 1.5, [], {}, None, "x")] == ["boolean", "integer", "number", "array", "object", "string", "string"]


def test_parameters():
    assert jsonx.parameters({"a": {"type": "int, optional", "default": 3}, "b": {"type": "str", "default": "x"}, "c": {"type": "list"}, "d": 1}) == {
        "type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "string"}, "c": {"type": "array"}, "d": {"type": "string"}}, "required": ["b", "d"],
    }
    schema = jsonx.parameters({"type": "dict", "properties": {"o": {"type": "dict", "properties": {"x": {"type": "float"}}}, "p": 3}, "required": ["o"], "other": 1})
    assert schema == {"type": "object", "properties": {"o": {"type": "object", "properties": {"x": {"type": "number"}}}, "p": {"type": "string"}}, "required": ["o"]}
    assert jsonx.parameters({"type": "object"}) == {"type": "object", "properties": {}} and jsonx.parameters("x") == jsonx.parameters({})
    names = {}
    assert jsonx.tools('{"function": {"name": "A b", "arguments": {}}}', names)[0]["function"]["name"] == "A_b" and names == {"A b": "A_b"}
    assert jsonx.tools("nonsense", {}) == [] and jsonx.tools(["{}", '{"name": "x"}', 3], {})[0]["function"]["name"] == "x"


def test_observed_and_synthesized():
    assert jsonx.observed('[{"text": "a"}, {"text": "b"}]') == "a\nb" and jsonx.observed({"text": "OBSERVATION: x"}) == "x" and jsonx.observed([1]) == [1]
    calls = [jsonx.message("assistant", None, [jsonx.call("f", {"a": 1}), jsonx.call("f", {"b": True, "a": "x"})])]
    assert jsonx.synthesized(calls)[0]["function"]["parameters"]["properties"] == {"a": {"type": "integer"}, "b": {"type": "boolean"}}


def test_parsers():
    prose, calls = parsers.xml_calls('a <tool_call>{"name": "f x", "arguments": "{}"}</tool_call><tool_call>bad</tool_call>')
    assert prose == "a" and calls == [{"function": {"name": "f_x", "arguments": {}}}]
    assert parsers.xml_responses("<tool_response>[1</tool_response>") == [{"name": None, "response": "[1"}]
    assert parsers.call_list("[f(a=1), not a call]") == [] and parsers.call_list("text") == [] and parsers.call_list(None) == []
    made = parsers.call_list("[User Feed (Posts) V2(q='a, b', n=[1, 2]), g()]")
    assert [c["function"]["name"] for c in made] == ["User_Feed_Posts_V2", "g"] and made[0]["function"]["arguments"] == {"q": "a, b", "n": [1, 2]}
    assert parsers.json_array_tools("see [1] and [" * 3 + '[{"name": "f"}]', {})[0]["function"]["name"] == "f"
    assert parsers.json_array_tools("[" * 50_000, {}) == []
    assert [t["function"]["name"] for t in parsers.prose_tools('{"name": "a", "description": "x"} {"name": "b"} {"name": "c", "parameters": {"q": 1}}', {})] == ["a", "c"]
    assert parsers.before_anchor("Hi. you can invoke x") == "Hi." and parsers.before_anchor("you can invoke") is None
    assert parsers.bracket_action("click [1]\nmore") is None and parsers.bracket_action("scroll [down]")["function"]["arguments"] == {"direction": "down"}
    assert parsers.bracket_action("type [1]") is None and parsers.bracket_action("hover [1]") is None
    assert parsers.call_action('load(url="u")')["function"] == {"name": "goto", "arguments": {"url": "u"}} and parsers.call_action("x") is None
    assert parsers.call_action("weird(a=1)")["function"]["name"] == "weird"
    assert parsers.reasoned_action("I think\n**click [3]**") == "click [3]" and parsers.reasoned_action("no") is None


def test_content_hash_and_shingles(spark):
    a = [{"role": "assistant", "content": " A  b", "tool_calls": [{"function": {"name": "f", "arguments": {"x": 1, "y": 2}}}]}]
    b = [{"role": "assistant", "content": "a b", "tool_calls": [{"function": {"name": "f", "arguments": {"y": 2, "x": 1}}}]}]
    assert hashing.content_hash(a, ["q", "p"]) == hashing.content_hash(b, ["p", "q"]) != hashing.content_hash(a, [])
    assert hashing.shingles(a, []) != hashing.shingles(b, [])
    assert hashing.shingles([], []) == [] and hashing.shingles([{"role": "assistant", "content": "a b"}], []) == ["a b"]
    words = " ".join(str(i) for i in range(4_000))
    assert len(hashing.shingles([{"role": "assistant", "content": words}], [])) == 1_332
    own = column(spark, lambda x: F.to_json(hashing.text_shingles(text.normal_text(x))), "a b", "", words, "a b c d e f")
    assert json.loads(own[0]) == ["a b"] and json.loads(own[1]) == [] and len(json.loads(own[2])) == 1_332 and json.loads(own[3]) == ["a b c d e", "b c d e f"]
