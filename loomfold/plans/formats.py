"""Queries of the formats and parsers over texts built from part, each in several shapes, against what should come out.

A shape is a template of the input and one of the whole result as JSON text; ``@column@`` stands for a column of part in
both. SQL fills the template of the result, the engine works on the input; their texts are compared by md5.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfold.functions import jsonx, parsers
from loomfold.operators.normalize import normalize
from loomfold.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_FIELD = re.compile(r"@(p_\w+)@")


def _filled(template: str) -> Column:
    parts = _FIELD.split(template)
    return F.concat(*(F.col(x).cast("string") if i % 2 else F.lit(x) for i, x in enumerate(parts)))


def _filled_sql(template: str) -> str:
    parts = _FIELD.split(template)
    return "concat(" + ", ".join(x if i % 2 else "'" + x.replace("'", "''") + "'" for i, x in enumerate(parts)) + ")"


def _register(name: str, run: Callable[[DataFrame], DataFrame], shapes: list[tuple], fields: tuple[str, ...]) -> None:
    """A query over all shapes of all rows: (p_partkey, shape, md5 of each field)."""
    told = ", ".join("md5({}) AS " + f for f in fields)
    SQL[name] = " UNION ALL ".join(f"SELECT p_partkey, {i} AS shape, {told.format(*map(_filled_sql, expected))} FROM part" for i, (_, *expected) in enumerate(shapes))

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        rows = spark.read.parquet(f"{sf_dir}/part.parquet")
        given = F.explode(F.array(*(F.struct(F.lit(i).alias("shape"), _filled(given).alias("given")) for i, (given, *_) in enumerate(shapes)))).alias("x")
        return run(rows.select("p_partkey", given).select("p_partkey", "x.*"))

    query.__name__ = name
    QUERIES[name] = query


def _parser(name: str, function: Callable[[str], object], *shapes: tuple[str, str]) -> None:
    """A function of a text, its result as JSON."""
    import pyarrow as pa

    def run(rows: DataFrame) -> DataFrame:
        udf = F.arrow_udf(lambda x: pa.array([jsonx.encode(function(v)) for v in x.to_pylist()], pa.string()), "string")
        return rows.select("p_partkey", "shape", F.md5(udf("given")).alias("result"))

    _register(name, run, list(shapes), ("result",))


def _format(normalizer: str, kind: str, cfg: dict | None, *shapes: tuple[str, str, str, str]) -> None:
    """A format: rows as JSON text of a schema; messages, tools and metadata of the record."""

    def run(rows: DataFrame) -> DataFrame:
        numbered = rows.select((F.col("p_partkey") * 10 + F.col("shape")).alias("no"), F.from_json("given", kind).alias("r")).select("no", "r.*")
        made = normalize(numbered, normalizer, "made", "default", cfg, "no")
        md5 = [F.md5(c).alias(n) for c, n in (("messages_json", "messages"), ("tools_json", "tools"), ("metadata_json", "metadata"))]
        return made.select(F.floor(F.col("ord") / 10).alias("p_partkey"), (F.col("ord") % 10).cast("int").alias("shape"), *md5)

    _register(f"norm_{normalizer}", run, list(shapes), ("messages", "tools", "metadata"))


def _call(name: str, arguments: str) -> str:
    return f'{{"function":{{"name":"{name}","arguments":{arguments}}}}}'


def _message(role: str, content: str | None = None, calls: str | None = None, response: str | None = None, name: str | None = None) -> str:
    """A message as JSON text; content and response are JSON text."""
    told = f'{{"role":"{role}","content":{content or "null"}'
    if calls:
        told += f',"tool_calls":[{calls}]'
    if response:
        told += f',"tool_responses":[{{"name":{name or "null"},"response":{response}}}]'
    return told + "}"


def _messages(*told: str) -> str:
    return "[" + ",".join(told) + "]"


def _tool(name: str, description: str, parameters: str) -> str:
    return f'{{"type":"function","function":{{"name":"{name}","description":"{description}","parameters":{parameters}}}}}'


def _text(x: str) -> str:
    """A text as a value inside JSON text."""
    return jsonx.encode(x)


# -- parsers -----------------------------------------------------------------

_parser(
    "parse_xml_calls", parsers.xml_calls,
    ('Now @p_brand@.\n<tool_call>\n{"name": "buy part", "arguments": {"size": @p_size@, "part": "@p_name@"}}\n</tool_call>\n<tool_call>broken</tool_call>',
     '["Now @p_brand@.",[' + _call("buy_part", '{"size":@p_size@,"part":"@p_name@"}') + "]]"),
    ("<tool_call>{'name': 'f @p_size@', 'arguments': '{\"a\": [@p_size@, None]}'}</tool_call> and <tool_call>{\"name\": \"2x\"}</tool_call><tool_call>[1]</tool_call>",
     '["and",[' + _call("f_@p_size@", '{"a":[@p_size@,null]}') + "," + _call("fn_2x", "{}") + "]]"),
    ("<tool_call>@p_name@ never closes", '["<tool_call>@p_name@ never closes",[]]'),
)
_parser(
    "parse_function_xml", parsers.function_xml,
    ("Look at @p_name@\n<function=bash><parameter=cmd> ls @p_size@ </parameter><parameter=b>@p_brand@</parameter></function>", '["Look at @p_name@",[' + _call("bash", '{"cmd":"ls @p_size@","b":"@p_brand@"}') + "]]"),
    ("<function=a><parameter=k>1</parameter><parameter=k>@p_size@\n2</parameter></function> mid <function=b-c></function>", '["mid",[' + _call("a", '{"k":"@p_size@\\n2"}') + "," + _call("b_c", "{}") + "]]"),
    ("@p_type@ <function=>x</function>", '["@p_type@ <function=>x</function>",[]]'),
)
_parser(
    "parse_call_list", parsers.call_list,
    ("[Find Part (v2)(size=@p_size@, name='@p_name@'), Stop()]", "[" + _call("Find_Part_v2", '{"size":@p_size@,"name":"@p_name@"}') + "," + _call("Stop", "{}") + "]"),
    ("[f(a=[1, @p_size@], b=\"x, @p_brand@\", c=@p_brand@ )]", "[" + _call("f", '{"a":[1,@p_size@],"b":"x, @p_brand@","c":"@p_brand@"}') + "]"),
    ("[f(a=1), no call of @p_name@]", "[]"), ("say @p_name@ (so)", "[]"), ("[a.b(x=None, y={'k': 1, 'l': 2}, z=True)]", "[" + _call("a_b", '{"x":null,"y":"{\'k\': 1","z":true}') + "]"),
)
_parser(
    "parse_bracket_action", lambda x: (lambda a: [a, parsers.bracket_action(a)])(parsers.reasoned_action(x)),
    ("In summary, the next action I will perform is ```type [@p_size@] [@p_name@] [1]```", '["type [@p_size@] [@p_name@] [1]",' + _call("type", '{"element_id":"@p_size@","text":"@p_name@","press_enter":true}') + "]"),
    ("Hm.\n```\nclick [@p_size@]\n```\nor scroll [down]", '["click [@p_size@]",' + _call("click", '{"element_id":"@p_size@"}') + "]"),
    ("I look at @p_name@.\n**goto [@p_brand@]**", '["goto [@p_brand@]",' + _call("goto", '{"url":"@p_brand@"}') + "]"),
    ("nothing but @p_name@", "[null,null]"), ("```hover [@p_size@]```", '["hover [@p_size@]",null]'), ("the next action is type [@p_size@] [@p_name@] [0]", '["type [@p_size@] [@p_name@] [0]",' + _call("type", '{"element_id":"@p_size@","text":"@p_name@","press_enter":false}') + "]"),
)
_parser(
    "parse_call_action", parsers.call_action,
    ('text(uid="e@p_size@", value="@p_name@")', _call("type", '{"element_id":"e@p_size@","text":"@p_name@"}')), ('click(uid="@p_brand@")', _call("click", '{"element_id":"@p_brand@"}')), ("scroll(y=@p_size@)", _call("scroll", '{"x":0,"y":@p_size@}')),
    ('load(url="http://x.example/@p_size@")', _call("goto", '{"url":"http://x.example/@p_size@"}')), ("own thing", "null"), ('paste(uid="@p_size@", n=[1, 2])', _call("paste", '{"uid":"@p_size@","n":[1,2]}')),
)
_parser(
    "parse_tools_and_responses", lambda x: [parsers.prose_tools(x, {}), parsers.xml_responses(x), parsers.before_anchor(x), parsers.xml_tools(x, {})],
    ('You [may] use [{"name": "Big tool", "parameters": {}}, {"name": "b", "description": "x"}] <tool_response>{"name": "t", "content": "@p_brand@"}</tool_response>',
     "[[" + _tool("Big_tool", "", '{"type":"object","properties":{}}') + "," + _tool("b", "x", '{"type":"object","properties":{}}') + '],[{"name":"t","response":"@p_brand@"}],'
     + _text('You [may] use [{"name": "Big tool", "parameters": {}}, {"name": "b", "description": "x"}] <tool_response>{"name": "t", "content": "@p_brand@"}</tool_response>') + ",[]]"),
    ('Be kind to @p_name@. access to the following functions: you can invoke {"name": "a", "description": "@p_type@"} {"name": "no"} <tool_response>{"response": @p_size@}</tool_response><tool_response>[@p_size@</tool_response>',
     "[[" + _tool("a", "@p_type@", '{"type":"object","properties":{}}') + '],[{"name":null,"response":@p_size@},{"name":null,"response":"[@p_size@"}],"Be kind to @p_name@. access to the following functions:",[]]'),
    ('<tools>[{"name": "c", "parameters": {"q": {"type": "str"}}}]</tools><tools>[{"name": "@p_brand@"}]</tools>',
     "[[" + _tool("c", "", '{"type":"object","properties":{"q":{"type":"string"}}}') + "],[]," + _text('<tools>[{"name": "c", "parameters": {"q": {"type": "str"}}}]</tools><tools>[{"name": "@p_brand@"}]</tools>') + ",[" + _tool("c", "", '{"type":"object","properties":{"q":{"type":"string"}}}') + "]]"),
)
_parser(
    "coerce_parameters", lambda x: jsonx.parameters(jsonx.loads(x)),
    ('{"size":{"type":"int, optional","default":3,"description":"@p_type@"},"brand":{"type":"str","default":"@p_brand@"}}', '{"type":"object","properties":{"size":{"type":"integer","description":"@p_type@"},"brand":{"type":"string"}},"required":["brand"]}'),
    ('{"type":"dict","properties":{"q":{"type":"float","items":[@p_size@]},"o":{"type":["int","none"],"properties":{"x":{"type":"tuple"}}},"p":3},"required":["q"],"strict":true}',
     '{"type":"object","properties":{"q":{"type":"number","items":[@p_size@]},"o":{"type":["integer","null"],"properties":{"x":{"type":"array"}}},"p":{"type":"string"}},"required":["q"]}'),
    ('{"@p_brand@": 1, "b": {"type": "bool", "enum": [@p_size@], "items": {}, "default": "None"}, "c": {"description": null}}', '{"type":"object","properties":{"@p_brand@":{"type":"string"},"b":{"type":"boolean","enum":[@p_size@],"items":{}},"c":{"type":"string"}},"required":["@p_brand@"]}'),
    ("no object of @p_name@", '{"type":"object","properties":{}}'), ('{"type": "object"}', '{"type":"object","properties":{}}'),
)
_parser(
    "tool_definitions", lambda x: (lambda names: [jsonx.tools(x, names), names])({}),
    ('[{"type": "function", "function": {"name": "find part", "description": "@p_type@", "parameters": {}}}, "{\\"name\\": \\"x\\"}", 3, {"description": "no name"}]',
     "[[" + _tool("find_part", "@p_type@", '{"type":"object","properties":{}}') + "," + _tool("x", "", '{"type":"object","properties":{}}') + '],{"find part":"find_part"}]'),
    ("{'name': 'a', 'function': {'arguments': {'k': {'type': 'int'}}}, 'description': @p_size@}", "[[" + _tool("a", "@p_size@", '{"type":"object","properties":{"k":{"type":"integer"}}}') + "],{}]"),
    ("@p_name@", "[[],{}]"),
)
_parser(
    "tolerant_json", lambda x: [jsonx.loads(x), jsonx.arguments(x), jsonx.value_type(jsonx.loads(x)), jsonx.deep_sorted(jsonx.loads(x))],
    ('{"b": @p_size@, "a": {"d": 1.0, "c": [NaN]}}', '[{"b":@p_size@,"a":{"d":1.0,"c":[null]}},{"b":@p_size@,"a":{"d":1.0,"c":[null]}},"object",{"a":{"c":[null],"d":1.0},"b":@p_size@}]'),
    ("{'k': (1, True), 'n': None}", '[{"k":[1,true],"n":null},{"k":[1,true],"n":null},"object",{"k":[1,true],"n":null}]'), ("[@p_size@, ...]", '["[@p_size@, ...]",{"value":"[@p_size@, ...]"},"string","[@p_size@, ...]"]'),
    (" [1, @p_size@] ", '[[1,@p_size@],{"_args":[1,@p_size@]},"array",[1,@p_size@]]'), ("@p_size@", '[@p_size@,{"value":@p_size@},"integer",@p_size@]'), (" ", '[null,{},"string",null]'), ("say @p_name@", '["say @p_name@",{"value":"say @p_name@"},"string","say @p_name@"]'),
)
_parser(
    "observed", jsonx.observed,
    ("OBSERVATION:\n @p_name@ ", '"@p_name@"'), ("@p_size@", '"@p_size@"'), ('{"ok": @p_size@}', '"{\\"ok\\": @p_size@}"'), ("True", '"True"'), (" ", '""'), ('[{"text": "a"}, {"text": "@p_name@"}, 3]', '"a\\n@p_name@"'), ("{'text': 'OBSERVATION: @p_brand@'}", '"@p_brand@"'), ('[{"no": "text"}]', '"[{\\"no\\": \\"text\\"}]"'),
)

# -- formats -----------------------------------------------------------------

_FIND = '[{"name": "find part", "parameters": {"size": {"type": "int"}, "all": {"type": "bool", "default": true}}}]'
_FOUND = _tool("find_part", "", '{"type":"object","properties":{"size":{"type":"integer"},"all":{"type":"boolean"}},"required":["all"]}')
_ASK, _ARGS = '{"name": "find part", "arguments": {"size": @p_size@, "q": "@p_name@"}}', '{"size":@p_size@,"q":"@p_name@"}'
_RENAMED = '{"name_map":{"find part":"find_part"}}'
_SHARED = "tools string, prompt string, conversations array<struct<`from`:string,value:string>>"


def _row(**fields: object) -> str:
    return jsonx.encode(fields)


def _turns(*turns: tuple[str, str], keys: tuple[str, str] = ("from", "value")) -> list[dict]:
    return [dict(zip(keys, t)) for t in turns]


_format(
    "sharegpt", _SHARED, {"conv_col": "conversations", "tools_col": "tools", "system_col": "prompt", "tools_in_system": True},
    (_row(tools=_FIND, conversations=_turns(("human", "@p_type@"), ("function_call", _ASK), ("observation", '{"ok": @p_size@}'), ("gpt", "<think>x</think>@p_name@"), ("odd", "?"))),
     _messages(_message("user", '"@p_type@"'), _message("assistant", None, _call("find_part", _ARGS)), _message("tool", None, None, '{"ok":@p_size@}'), _message("assistant", '"@p_name@"')), f"[{_FOUND}]", _RENAMED),
    (_row(prompt="Be brief.", conversations=_turns(("system", f"<tools>{_FIND}</tools>"), ("tool_call", f"[{_ASK}, {{}}]"), ("tool_call", "broken"), ("tool", "@p_brand@"))),
     _messages(_message("system", '"Be brief."'), _message("system", _text(f"<tools>{_FIND}</tools>")), _message("assistant", None, _call("find_part", _ARGS)), _message("tool", None, None, '"@p_brand@"')), f"[{_FOUND}]", _RENAMED),
)
_format(
    "hermes", _SHARED, {"conv_col": "conversations", "tools_col": "tools"},
    (_row(conversations=_turns(("system", f"Use <tools>{_FIND}</tools> now"), ("human", "@p_type@"), ("gpt", f"ok <tool_call>{_ASK}</tool_call>"), ("tool", "<tool_response>@p_name@</tool_response>"))),
     _messages(_message("system", '"Use  now"'), _message("user", '"@p_type@"'), _message("assistant", '"ok"', _call("find_part", _ARGS)), _message("tool", None, None, '"@p_name@"')), f"[{_FOUND}]", _RENAMED),
    (_row(tools=_FIND, conversations=_turns(("gpt", "just @p_name@"), ("tool", "raw @p_size@"), ("tool", '<tool_response>{"name": "find part", "response": [@p_size@]}</tool_response>'))),
     _messages(_message("assistant", '"just @p_name@"'), _message("tool", None, None, '"raw @p_size@"'), _message("tool", None, None, "[@p_size@]", '"find_part"')), f"[{_FOUND}]", _RENAMED),
)
_format(
    "toolace", "system string, conversations array<struct<`from`:string,value:string>>", None,
    (_row(system=f"Be kind. Here is a list of functions in JSON format that you can invoke: {_FIND}", conversations=_turns(("user", "@p_type@"), ("assistant", "[find part(size=@p_size@, q='@p_name@')]"), ("tool", "[{'n': @p_size@}]"), ("assistant", "[@p_name@]"), ("system", "late"))),
     _messages(_message("system", '"Be kind."'), _message("user", '"@p_type@"'), _message("assistant", None, _call("find_part", _ARGS)), _message("tool", None, None, '[{"n":@p_size@}]'), _message("assistant", '"[@p_name@]"')), f"[{_FOUND}]", _RENAMED),
    (_row(system=None, conversations=_turns(("user", "@p_type@"), ("tool", "@p_brand@"))), _messages(_message("user", '"@p_type@"'), _message("tool", None, None, '"@p_brand@"')), "[]", "{}"),
)
_CHAT = "array<struct<role:string,content:string>>"
_chat = lambda *turns: _turns(*turns, keys=("role", "content"))
_format(
    "when2call", f"tools array<string>, messages {_CHAT}", None,
    (_row(tools=[_FIND[1:-1]], messages=_chat(("user", "@p_type@"), ("assistant", f"<TOOLCALL>[{_ASK}]</TOOLCALL> later"))), _messages(_message("user", '"@p_type@"'), _message("assistant", None, _call("find_part", _ARGS))), f"[{_FOUND}]", _RENAMED[:-1] + ',"no_call_expected":false}'),
    (_row(tools=None, messages=_chat(("user", "@p_type@"), ("assistant", "Which @p_brand@?"), ("tool", "?"))), _messages(_message("user", '"@p_type@"'), _message("assistant", '"Which @p_brand@?"')), "[]", '{"name_map":{},"no_call_expected":true}'),
    (_row(tools=[], messages=_chat(("assistant", "<TOOLCALL>no list of @p_name@"))), _messages(_message("assistant", '"<TOOLCALL>no list of @p_name@"')), "[]", '{"name_map":{},"no_call_expected":true}'),
)
_format(
    "toucan", "tools string, available_tools string, subset_name string, messages string", None,
    (_row(tools=_FIND, subset_name="sft", messages=jsonx.encode(_chat(("user", "@p_type@"), ("tool_call", _ASK), ("tool_response", "@p_size@"), ("assistant", "@p_name@")))),
     _messages(_message("user", '"@p_type@"'), _message("assistant", None, _call("find_part", _ARGS)), _message("tool", None, None, '"@p_size@"'), _message("assistant", '"@p_name@"')), f"[{_FOUND}]", _RENAMED[:-1] + ',"subset":"sft"}'),
    (_row(subset_name="k2", messages=jsonx.encode([{"role": "system", "content": f"Tools: {_FIND}"}, {"role": "assistant", "content": "@p_brand@", "function_call": {"name": "find part", "arguments": '{"size": @p_size@}'}}, {"role": "function", "name": "find part", "content": "@p_name@"}, {"role": "tool_call", "content": "[1]"}])),
     _messages(_message("system", _text(f"Tools: {_FIND}")), _message("assistant", '"@p_brand@"', _call("find_part", '{"size":@p_size@}')), _message("tool", None, None, '"@p_name@"', '"find_part"')), f"[{_FOUND}]", _RENAMED[:-1] + ',"subset":"k2"}'),
)
_TERMINAL = _tool("run_terminal", "Execute keystrokes in a terminal and return stdout.", '{"type":"object","properties":{"keystrokes":{"type":"string"}},"required":["keystrokes"]}')
_format(
    "nemotron_terminal", f"conversations {_CHAT}, task string", None,
    (_row(task="@p_brand@", conversations=_chat(("user", "@p_type@"), ("assistant", '<think>x</think>{"analysis": "@p_name@", "commands": [{"keystrokes": "ls @p_size@\\n"}, {"keystrokes": "pwd\\n"}]}'), ("user", "New Terminal Output:\n@p_brand@"), ("user", "New Terminal Output: more"), ("assistant", "done"))),
     _messages(_message("user", '"@p_type@"'), _message("assistant", '"@p_name@"', _call("run_terminal", '{"keystrokes":"ls @p_size@\\npwd\\n"}')), _message("tool", None, None, '"@p_brand@"', '"run_terminal"'), _message("user", '"more"'), _message("assistant", '"done"')), f"[{_TERMINAL}]", '{"task":"@p_brand@","run_id":null}'),
    (_row(conversations=_chat(("assistant", '{"analysis": "@p_name@", "commands": []}'), ("user", "@p_type@"))), _messages(_message("assistant", _text('{"analysis": "@p_name@", "commands": []}')), _message("user", '"@p_type@"')), "[]", '{"task":null,"run_id":null}'),
)
_WEB_PROMPT = _message("system", '"You are a web navigation agent. Given the page observation and the objective, issue one browser action via the available tools."')
_WEB = "[" + ",".join((
    _tool("click", "Click an element by id.", '{"type":"object","properties":{"element_id":{"type":"string"}},"required":["element_id"]}'),
    _tool("type", "Type text into an element.", '{"type":"object","properties":{"element_id":{"type":"string"},"text":{"type":"string"},"press_enter":{"type":"boolean"}},"required":["element_id","text"]}'),
    _tool("scroll", "Scroll the page.", '{"type":"object","properties":{"x":{"type":"integer"},"y":{"type":"integer"},"direction":{"type":"string"}}}'),
    _tool("goto", "Navigate to a URL.", '{"type":"object","properties":{"url":{"type":"string"}},"required":["url"]}'),
    _tool("select", "Select an option.", '{"type":"object","properties":{"element_id":{"type":"string"},"value":{"type":"string"}},"required":["element_id"]}'),
)) + "]"
_format(
    "nnetnav", f"messages {_CHAT}, output string, id string", None,
    (_row(id="e@p_size@", messages=_chat(("system", "long"), ("user", "@p_type@")), output="Let me think.\n```click [@p_size@]```"), _messages(_WEB_PROMPT, _message("user", '"@p_type@"'), _message("assistant", None, _call("click", '{"element_id":"@p_size@"}'))), _WEB, '{"dataset":null,"episode_id":"e@p_size@"}'),
    (_row(messages=None, output="So the next action is stop [@p_name@]"), _messages(_WEB_PROMPT, _message("assistant", '"@p_name@"')), _WEB, '{"dataset":null,"episode_id":null}'),
)
_format(
    "weblinx", "action string, clean_html string, candidates string, viewport string, utterances string, demo string, turn bigint", None,
    (_row(action='click(uid="@p_size@")', clean_html="@p_type@", candidates="c", viewport="1x1", utterances="@p_brand@", demo="d", turn=3),
     _messages(_WEB_PROMPT, _message("user", '"INSTRUCTION: @p_brand@\\n\\nVIEWPORT: 1x1\\nDOM:\\n@p_type@\\n\\nCANDIDATES:\\nc"'), _message("assistant", None, _call("click", '{"element_id":"@p_size@"}'))), _WEB, '{"demo":"d","turn":3}'),
    (_row(action='say(speaker="x", utterance="@p_name@")', clean_html="@p_type@", viewport="1x1", utterances="No instructor"), _messages(_WEB_PROMPT, _message("user", '"VIEWPORT: 1x1\\nDOM:\\n@p_type@\\n\\nCANDIDATES:"'), _message("assistant", '"@p_name@"')), _WEB, '{"demo":null,"turn":null}'),
)
_format(
    "mind2web", "confirmed_task string, website string, actions array<struct<operation:struct<op:string,value:string>,cleaned_html:string,pos_candidates:array<struct<backend_node_id:string>>>>", None,
    (_row(confirmed_task="@p_name@", website="w", actions=[{"operation": {"op": "TYPE", "value": "@p_type@"}, "cleaned_html": "@p_brand@", "pos_candidates": [{"backend_node_id": "@p_size@"}]}, {"operation": {"op": "select", "value": "v"}, "cleaned_html": None, "pos_candidates": []}, {"operation": None, "cleaned_html": "x"}]),
     _messages(_WEB_PROMPT, _message("user", '"OBJECTIVE: @p_name@"'), _message("user", '"DOM:\\n@p_brand@"'), _message("assistant", None, _call("type", '{"element_id":"@p_size@","text":"@p_type@"}')), _message("user", '"DOM:"'), _message("assistant", None, _call("select", '{"element_id":"None","value":"v"}')), _message("user", '"DOM:\\nx"'), _message("assistant", None, _call("click", '{"element_id":"None"}'))),
     _WEB, '{"website":"w","domain":null,"annotation_id":null}'),
)
_format(
    "smoltalk2", f"messages {_CHAT}, chat_template_kwargs struct<xml_tools:array<string>>, source string", None,
    (_row(source="s", chat_template_kwargs={"xml_tools": [_FIND[1:-1]]}, messages=_chat(("user", "@p_type@"), ("assistant", f"@p_name@ <tool_call>{_ASK}</tool_call>"), ("tool", "<tool_response>@p_brand@</tool_response>"))),
     _messages(_message("user", '"@p_type@"'), _message("assistant", '"@p_name@"', _call("find_part", _ARGS)), _message("tool", None, None, '"@p_brand@"')), f"[{_FOUND}]", _RENAMED[:-1] + ',"smoltalk_source":"s"}'),
    (_row(messages=_chat(("assistant", f"<tool_call>{_ASK}</tool_call><tool_call>" + '{"name": "find part", "arguments": {"size": 1.5, "deep": {}}}' + "</tool_call>"))), _messages(_message("assistant", None, _call("find_part", _ARGS) + "," + _call("find_part", '{"size":1.5,"deep":{}}'))),
     "[" + _tool("find_part", "", '{"type":"object","properties":{"size":{"type":"integer"},"q":{"type":"string"},"deep":{"type":"object"}}}') + "]", '{"name_map":{},"smoltalk_source":null}'),
)
