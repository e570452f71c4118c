import json
import random

import pytest
from pyspark.sql import functions as F

from loomfold.functions.hashing import band_keys, signature
from loomfold.operators import audit, dedup, enrich, quality, report, validate
from loomfold.operators.normalize import get_normalizer, normalize, register
from loomfold.schema import CANONICAL, canonical_row


def records(spark, *rows):
    return spark.createDataFrame(list(rows), CANONICAL.spark)


def row(ord_, messages, tools=(), names=None, **settings):
    base = {"content_hash": settings.pop("content_hash", str(ord_)), "bands": band_keys(signature(settings.pop("shingles", [])))}
    made = canonical_row(ord_, "s", "d/t", messages, list(tools), list(names if names is not None else [t["function"]["name"] for t in tools]), **base)
    return tuple((made | settings).get(f.name) for f in CANONICAL.spark.fields)


def said(text):
    return {"role": "assistant", "content": text}


def called(name="f", **args):
    return {"role": "assistant", "content": None, "tool_calls": [{"function": {"name": name, "arguments": args}}]}


TOOL = {"type": "function", "function": {"name": "f", "description": "", "parameters": {"type": "object", "properties": {"a": {}, "b": {}}, "required": ["a"]}}}


def test_validation_reasons(spark):
    odd = row(5, [called()])
    odd_messages = [{"role": "assistant", "content": None, "content_is_json": False, "tool_calls": [{"name": "f", "arguments": "3"}], "tool_responses": []}]
    odd = tuple(odd_messages if f.name == "messages" else v for f, v in zip(CANONICAL.spark.fields, odd))
    df = records(
        spark, row(0, []), row(1, [{"role": "bot", "content": "x"}]), row(2, [{"role": None, "content": "x"}]), row(3, [{"role": "user", "content": "x"}]),
        row(4, [called("g")], [TOOL]), odd, row(6, [said(" \n")]), row(7, [said("x")]), row(8, [called("g")]), row(9, [{"role": "assistant", "content": [1]}]),
        tuple("E" if f.name == "error" else 10 if f.name == "ord" else None for f in CANONICAL.spark.fields),
    )
    got = {r.ord: r.reason for r in validate.validated(df).select("ord", "reason").collect()}
    assert got == {
        0: "empty_messages", 1: "bad_role:['bot']", 2: "bad_role:[None]", 3: "no_assistant_turn", 4: "undeclared_tool:g", 5: "tool_call_args_not_object", 6: "empty_assistant",
        7: None, 8: None, 9: "finalize_error:AttributeError", 10: "normalizer_exception",
    }
    assert {r.reason: r.n for r in report.top_reasons(validate.validated(df), most=3).collect()} == {"empty_messages": 1, "bad_role:['bot']": 1, "bad_role:[None]": 1}


def expected_score(n_calls, n_tool, n_assistant, valid, names, resolved, reward, curated, no_call, chars, turns):
    s = 0.5
    s += 0.15 if n_calls and n_tool else 0
    s += 0.05 if n_assistant > 1 else 0
    if n_calls:
        v = valid / n_calls
        s += 0.15 * v - 0.10 * (1 - v)
    s += 0.05 if names and n_calls else 0
    s += 0.15 if resolved is True or reward >= 1 else 0
    s -= 0.05 if resolved is False else 0
    s += 0.10 if curated else 0
    s += 0.03 if no_call else 0
    s -= 0.20 if chars < 40 and not n_calls else 0
    s -= 0.10 if turns < 2 else 0
    return max(0.0, min(1.0, s))


def test_score_steps(spark):
    long = "x" * 50
    user = {"role": "user", "content": long}
    cases = [
        (row(0, [user, said("y")]), (0, 0, 1, 0, 0, None, 0, 0, 0, 51, 2)),
        (row(1, [called(a=1), {"role": "tool", "content": None}, said("y")], [TOOL]), (1, 1, 2, 1, 1, None, 0, 0, 0, 1, 3)),
        (row(2, [called(b=1)], [TOOL]), (1, 0, 1, 0, 1, None, 0, 0, 0, 0, 1)),
        (row(3, [called(a=1, z=2), called(a=1)], [TOOL], resolved=True), (2, 0, 2, 1, 1, True, 0, 0, 0, 0, 2)),
        (row(4, [user, said("y")], resolved=False, curated=True), (0, 0, 1, 0, 0, False, 0, 1, 0, 51, 2)),
        (row(5, [user, said("y")], reward=1.0, no_call_expected=True), (0, 0, 1, 0, 0, None, 1, 0, 1, 51, 2)),
        (row(6, [said("short")]), (0, 0, 1, 0, 0, None, 0, 0, 0, 5, 1)),
    ]
    got = {r.ord: r for r in quality.scored(records(spark, *(c for c, _ in cases))).collect()}
    for i, (_, settings) in enumerate(cases):
        score = expected_score(*settings)
        assert got[i].score == pytest.approx(score, abs=1e-12)
        assert got[i].tier == ("high" if score >= 0.75 else "medium" if score >= 0.5 else "low")
    told = json.loads(got[3].quality)
    assert told["curated"] and told["signals"]["valid_arg_ratio"] == 0.5 and told["signals"]["verified_success"] and "too_short" not in told["signals"]


def test_audit_defects(spark):
    def on_disk(i, messages, tools="[]", names=(), source="s"):
        return (f"id{i}", source, messages if messages is None or isinstance(messages, str) else json.dumps(messages), tools if isinstance(tools, str) else json.dumps(tools), list(names))

    ok = [{"role": "assistant", "content": "fine"}]
    bad_tools = [{"function": {"parameters": {"x": {}}}}, {"function": {"name": "t", "parameters": {"type": "object", "properties": {"type": {}, "properties": {}, "required": {}}}}}]
    leaks = [{"role": "assistant", "content": "<think> <|im_end|>"}, {"role": "user", "content": " Assistant\nx"}, {"role": "assistant", "content": "<function=a>"}]
    calls = [{"role": "assistant", "tool_calls": [{"function": {"name": "f", "arguments": {}}}] * 2 + [{"function": {"name": "g", "arguments": 3}}]}, {"role": "tool", "tool_responses": [{"name": "f", "response": "OBSERVATION: x"}]}]
    rows = [
        on_disk(0, ok), on_disk(0, "nope"), on_disk(2, ok, "nope"), on_disk(3, ok, bad_tools), on_disk(4, leaks), on_disk(5, calls, "[]", ["f"]),
        on_disk(6, [{"role": "bot", "content": "x"}]), on_disk(7, None, None, source=None), on_disk(8, [{"role": "assistant", "content": "x" * 1_000_001}]),
    ]
    df = spark.createDataFrame(rows, "id string, source string, messages string, tools string, tool_names array<string>")
    got = {r.defect: r.occurrences for r in audit.totals(df).collect()}
    assert got == {
        "messages_parse_error": 2, "tools_parse_error": 1, "tool_missing_name": 1, "tool_params_not_jsonschema": 1, "schema_keys_leaked_as_args": 1, "cot_leak": 1, "foreign_marker_leak": 1,
        "role_label_leak": 1, "raw_function_xml": 1, "args_not_object": 1, "undeclared_tool_call": 1, "observation_prefix_leak": 1, "call_response_imbalance_gt1": 1, "invalid_role": 1,
        "no_assistant_turn": 1, "oversized_row_gt_1MB": 1,
    }
    assert audit.collisions(df).first().collisions == 1
    worst = audit.worst_sources(df).collect()
    assert {r.source for r in worst} == {"s", "?"} and max(r.place for r in worst) == 3
    assert audit.totals(df.limit(0)).count() == 0 and tuple(audit.collisions(df.limit(0)).first()) == (0, 0)


def sequential(tokens):
    """The kept rows and reasons of one ordered pass."""
    seen, out = {"e": set(), "s": set(), "b": set()}, {}
    for o in sorted(tokens):
        reason = next((name for letter, name in dedup.LAYERS if any((letter, t) in tokens[o] and t in seen[letter] for t in [t for x, t in tokens[o] if x == letter])), None)
        out[o] = reason
        if reason is None:
            for letter, t in tokens[o]:
                seen[letter].add(t)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_greedy_dedup_equals_one_ordered_pass(spark, seed):
    rng = random.Random(seed)
    tokens = {o: {("e", f"e{rng.randrange(60)}"), ("s", f"s{rng.randrange(40)}"), *(("b", f"b{rng.randrange(80)}") for _ in range(2))} for o in range(50)}
    df = spark.createDataFrame([(o, letter, t) for o, ts in tokens.items() for letter, t in ts], "ord bigint, layer string, token string")
    assert {r.ord: r.reason for r in dedup.resolve(df).collect()} == sequential(tokens)


def test_hot_tokens_are_spread_without_another_outcome(spark, monkeypatch):
    rng = random.Random(7)
    tokens = {o: {("e", f"e{rng.randrange(60)}"), ("s", f"s{rng.randrange(3)}"), ("b", "all" if rng.random() < 0.4 else f"b{rng.randrange(40)}")} for o in range(60)}
    df = spark.createDataFrame([(o, letter, t) for o, ts in tokens.items() for letter, t in ts], "ord bigint, layer string, token string")
    monkeypatch.setattr(dedup, "HOT_ROWS", 5)
    monkeypatch.setattr(dedup, "SALTS", 4)
    salted = dedup._Salted(df)
    assert {"s0", "s1", "s2", "all"} <= set(salted.hot)
    assert salted.rows(df).where("token = 'all'").select("salt").distinct().count() > 1
    assert {r.ord: r.reason for r in dedup.resolve(df).collect()} == sequential(tokens)


def test_dedup_layers_and_reference(spark):
    text = [f"w{i} w{i + 1} w{i + 2} w{i + 3} w{i + 4}" for i in range(30)]
    rows = [
        row(0, [said("a")], content_hash="h0"), row(1, [said("a")], content_hash="h0"), row(2, [said("b")], instance_id="o__r-1"), row(3, [said("c")], instance_id="o__r-1.x"),
        row(4, [said("d")], shingles=text), row(5, [said("e")], shingles=text), row(6, [said("f")], content_hash="seed"), row(7, [said("g")], shingles=[]),
    ]
    against = spark.createDataFrame([("seed",)], "hash string")
    done = dedup.deduplicate(records(spark, *rows), against)
    assert {r.ord: r.dup_reason for r in done.collect()} == {0: None, 1: "exact", 2: None, 3: "swe_group", 4: None, 5: "near", 6: "exact", 7: None}
    assert dedup.stats(done).first().asDict() == {"seen": 8, "kept": 4, "exact": 2, "swe_group": 1, "near": 1}
    assert {r.ord for r in dedup.deduplicate(records(spark, *rows), near=False).where("dup_reason IS NULL").collect()} == {0, 2, 4, 5, 6, 7}
    assert dedup.deduplicate(records(spark)).count() == 0


def test_long_near_duplicates_meet_whatever_their_length(spark):
    words = [f"w{i * i % 9973}" for i in range(4_000)]
    texts = [" ".join(words), " ".join([*words[:400], "new", *words[400:]]), " ".join(reversed(words))]
    df = spark.createDataFrame([(i, [{"from": "human", "value": "q"}, {"from": "gpt", "value": t}]) for i, t in enumerate(texts)], "i int, conversations array<struct<from: string, value: string>>")
    done = dedup.deduplicate(normalize(df, "sharegpt", "src", "", {"conv_col": "conversations"}, "i"))
    assert {r.ord: r.dup_reason for r in done.select("ord", "dup_reason").collect()} == {0: None, 1: "near", 2: None}


def test_normalizer_registry_and_errors(spark):
    @register("test_only")
    def test_only(given, cfg):
        if given["x"] == 0:
            return None
        if given["x"] == 1:
            raise ValueError("bad row")
        return [{"role": "assistant", "content": cfg["say"]}], [], {"hf_id": None}

    df = spark.createDataFrame([(0, "p"), (1, "q"), (2, None)], "x int, prov string")
    got = normalize(df, "test_only", "src", "c/s", {"say": "hi"}, "x", provenance=["prov"], defaults={"license": "mit", "hf_id": "h"}).collect()
    # functions of a test module aren't on the workers' path, so the registry of the driver is shipped by value
    assert [(r.ord, r.error) for r in got] == [(1, "ValueError"), (2, None)]
    assert json.loads(got[1].metadata_json) == {"license": "mit", "hf_id": None} and got[1].source_subset == "c/s"
    with pytest.raises(KeyError, match="test_only"):
        get_normalizer("unknown")


def test_caps_and_maps(spark):
    df = spark.createDataFrame([(k, i, c) for k, c in (("a", 3), ("b", 0), (None, 2), ("d", None)) for i in range(10_000, 10_006)], "k string, i bigint, cap int")
    got = enrich.capped(df, "k", "i", "cap").groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("m")).collect()
    assert {r.k: (r.n, r.m) for r in got} == {"a": (3, 10_002), "b": (6, 10_005), None: (2, 10_001), "d": (6, 10_005)}
    caps = spark.createDataFrame([(5,), (0,), (None,)], "c int")
    assert [r[0] for r in caps.select(enrich.effective_cap(F.col("c"), 3)).collect()] == [3, 3, 3]
    assert [r[0] for r in caps.select(enrich.effective_cap(F.col("c"), 0)).collect()] == [5, None, None]
