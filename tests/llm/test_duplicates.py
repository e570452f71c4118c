import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from loomfold.llm import bloom, fusion, nearjoin
from loomfold.llm.chunkdedup import History
from loomfold.llm.texts import both, record_text, runs

KINDS = "rec_no bigint, id string, messages string, tool_names array<string>, rep string, path int"


def frame(spark, *rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], KINDS)


def said(text, role="assistant"):
    return json.dumps([{"role": "system", "content": "no part"}, {"role": role, "content": text}])


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        rng.choice([lambda: words.pop(i), lambda: words.insert(i, "new"), lambda: words.__setitem__(i, f"w{rng.randrange(10**6)}")])()
    return words


def families(seed, n_families=25, base=0):
    """Texts in families of copies and small edits, on a stock of common phrases."""
    rng = random.Random(seed)
    phrases = [[f"p{k}_{i}" for i in range(8)] for k in range(4)]
    out = []
    for f in range(n_families):
        words = phrases[f % 4] + [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([10, 30, 90]))] + phrases[(f + 1) % 4]
        for _ in range(rng.randrange(1, 5)):
            out.append(" ".join(edited(rng, words, rng.choice([0, 0, 1, 2, 4]))))
    return [(base + i + 1, f"s_{rng.randrange(16**16):016X} ", said(t), None) for i, t in enumerate(out)]


def alike(a, b, size=3, tenths=7):
    x, y = (runs(record_text(r[2], r[3]), size) for r in (a, b))
    n = both(x, y)
    return 10 * n >= tenths * (len(x) + len(y) - n)


def test_text_and_runs():
    messages = json.dumps([{"role": "user", "content": [{"type": "text", "text": "A"}, {"type": "text", "text": "b"}]}, None, {"role": "assistant", "content": ""}, {"role": "tool", "content": "no"}])
    assert record_text(messages, ["z", None, "y"]) == "A\nb y z" and record_text("[", []) is None and record_text(None, None) is None
    assert len(runs("a b c d", 3)) == 2 and len(runs("a b", 3)) == 1 and len(runs("", 3)) == 1 and (runs("A  b", 3) == runs("a b", 3)).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_near_pairs_equal_brute_force(spark, seed):
    rows = families(seed)
    rows += [(900, "x", said(""), None), (901, "x", said(None), None), (902, "x", "[{", None), (903, "x", None, ["t"]), (904, "x", said("only two"), None)]
    want = {(a[0], b[0]) for a, b in itertools.combinations([r for r in rows if r[0] not in (902, 903)], 2) if alike(a, b)}
    assert (900, 901) in want and len(want) > 20
    got = [tuple(r) for r in nearjoin.near_pairs(frame(spark, *rows), tenths=7, size=3).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_oversized_buckets_are_split_and_compared_in_blocks(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i + 1, "x", said(" ".join([*base, f"own{i}"])), None) for i in range(60)]
    df = frame(spark, *rows)
    signed = nearjoin.signatures(df, size=3).cache()
    found = nearjoin.candidates(nearjoin.classes_of(signed), 0.7, limit=8, levels=2)
    assert found.count() == 60 * 59 // 2 == nearjoin.verified(found, df, 7, size=3).count()


def test_groups_are_connected_components(spark):
    members = spark.createDataFrame([(i, i) for i in range(1, 41)] + [(99, 5)], "key bigint, rep bigint")
    chain = [(i, i + 1) for i in range(1, 20)] + [(30, 25), (25, 31)]
    links = spark.createDataFrame([(*sorted(p), 1, 1) for p in chain], "a bigint, b bigint, common int, either int")
    groups = {r.key: r.group_no for r in nearjoin.components(members, links).collect()}
    assert groups == {i: 1 if i <= 20 else 25 if i in (25, 30, 31) else i for i in range(1, 41)} | {99: 1}
    assert nearjoin.components(members, links.limit(0)).where("key = group_no").count() == 40


def test_empty_tables(spark):
    none = frame(spark, *families(1)).limit(0)
    assert nearjoin.near_pairs(none).count() == 0


def greedy(records, incoming):
    accepted, ids, rejected = [r for r in records if record_text(r[2], r[3]) is not None], {r[1].strip().lower()[-16:] for r in records if r[1] and r[1].strip()}, set()
    for r in sorted(incoming):
        tail = (r[1] or "").strip().lower()[-16:]
        text = record_text(r[2], r[3])
        if tail and tail in ids or text is not None and any(alike(r, a) for a in accepted):
            rejected.add(r[0])
            continue
        ids |= {tail} - {""}
        if text is not None:
            accepted.append(r)
    return rejected


@pytest.mark.parametrize("seed", [3, 4])
def test_history_rejects_what_a_sequential_pass_rejects(spark, seed):
    rows = families(seed, 40)
    rng = random.Random(seed)
    rng.shuffle(rows)
    rows = [(i + 1, *r[1:]) for i, r in enumerate(rows)]
    records, incoming = rows[:40], [*rows[40:]]
    incoming += [(500, f" {records[0][1].lower()}", said("quite another text of its own kind"), None), (501, None, said("a b c"), None), (502, "", said("a b c"), None), (503, records[1][1], "[{", None)]
    records += [(600, "s_00000000000000ff", "[{", None)]
    incoming += [(700, "t_00000000000000FF", said("nothing like it at all here"), None)]
    history = History(spark).start(frame(spark, *records))
    got = [r.key for r in history.admit(frame(spark, *incoming)).collect()]
    assert sorted(got) == sorted(greedy(records, incoming))
    # what was accepted is now history: the same batch is rejected but for rows that nothing identifies
    again = {r.key for r in history.admit(frame(spark, *incoming)).collect()}
    assert again == {r[0] for r in incoming}


def at_threshold(rng, words):
    """The words with long ones put in, spread evenly, as many as just leave a likeness of 0.7."""
    best, n = words, 0
    while True:
        n += 1
        at = {round((i + 1) * len(words) / (n + 1)) for i in range(n)}
        more = [x for i, w in enumerate(words) for x in ([f"{rng.randrange(16**16):016x}" * 2] if i in at else []) + [w]]
        if not alike((0, "", said(" ".join(words)), None), (0, "", said(" ".join(more)), None)):
            return best
        best = more


def test_pairs_at_the_threshold_are_rejected_in_long_texts(spark):
    rng = random.Random(11)
    texts = [[f"{rng.randrange(16**5):x}" for _ in range(rng.randrange(110, 400))] for _ in range(40)]
    records = [(i, f"r_{i:016d}", said(" ".join(t)), None) for i, t in enumerate(texts)]
    incoming = [(100 + i, f"n_{100 + i:016d}", said(" ".join(at_threshold(rng, t))), None) for i, t in enumerate(texts)]
    incoming += [(300 + i, f"n_{300 + i:016d}", said(" ".join(edited(rng, t, len(t) // 6))), None) for i, t in enumerate(texts)]
    assert min(len(r[2]) for r in records) > 600
    history = History(spark).start(frame(spark, *records))
    got = {r.key for r in history.admit(frame(spark, *incoming)).collect()}
    assert got == greedy(records, incoming) and got >= set(range(100, 140)) and len(got) < len(incoming)


def test_batches_one_after_another_equal_one_batch(spark):
    rows = families(6, 30)
    first, second, third = rows[:25], rows[25:45], rows[45:]
    whole = History(spark).start(frame(spark, *first))
    together = {r.key for r in whole.admit(frame(spark, *second, *third)).collect()}
    step = History(spark).start(frame(spark, *first))
    a = {r.key for r in step.admit(frame(spark, *second)).collect()}
    b = {r.key for r in step.admit(frame(spark, *third)).collect()} if third else set()
    assert a | b == together


def test_large_classes_are_expanded_in_blocks(spark):
    members = spark.createDataFrame([(i, 1) for i in range(1, 60)] + [(i, 100) for i in range(100, 130)] + [(200, 200)], "key bigint, rep bigint")
    links = spark.createDataFrame([(1, 100), (100, 200)], "a bigint, b bigint")
    groups = [range(1, 60), range(100, 130), [200]]
    want = {p for g in groups for p in itertools.combinations(g, 2)} | {(a, b) for x, y in ((0, 1), (1, 2)) for a in groups[x] for b in groups[y]}
    for block in (7, 1000):
        got = [tuple(r) for r in nearjoin.expanded(members, links, block).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_bloom_filter_lets_all_members_pass(spark):
    packed = bloom.build(spark.range(0, 3000, 3).toDF("k"))
    import numpy as np
    import pyarrow as pa

    passed = bloom.may_hold(packed, pa.array([*range(3000), None]))
    assert bloom.bits_for(0) == bloom.bits_for(10) == bloom.LEAST and bloom.bits_for(1 << 40) == bloom.MOST and bloom.bits_for(1_000_000) == 1 << 24
    assert not bloom.may_hold(bloom.build(spark.range(0).toDF("k")), pa.array([1, 2])).any()
    assert passed[np.arange(0, 3000, 3)].all() and passed[:3000].sum() < 1010 and not passed[3000]


SOURCES = [("good", "h/good", 5), ("mid", "h/mid", 3), ("poor", "h/poor", 1), ("copy", "h/copy", 1)]


def fused(spark, rows, **settings):
    return {(g, f): (r.rec_no, r.value) for (g, f), r in fused_rows(spark, rows, SOURCES, **settings).items()}


def fused_rows(spark, rows, sources, **settings):
    records = spark.createDataFrame([(*r, "x") for r in rows], "rec_no bigint, id string, source string, metadata string, quality string, value string")
    registry = spark.createDataFrame(sources, "source_key string, hf_id string, trust int")
    return {(r.group_no, r.field_name): r for r in fusion.fuse(records, registry, **settings).collect()}


def meta(at, **fields):
    return json.dumps({"fetched_at": at, **fields})


def test_fusion_prefers_trust_and_recency(spark):
    got = fused(spark, [
        (1, "a_00000000000000AA", "poor", meta("2025-01-01T00:00:00Z", license="x", repo="n/a"), '{"score": 0.5}'),
        (2, "b_00000000000000aa ", "Good ", meta("2025-02-01 00:00:00", license="y", repo=" "), '{"score": "unknown"}'),
        (3, "b_00000000000000aa", None, meta(1000, license="x", hf_id="h/mid", instance_id="i"), None),
        (4, "c_00000000000000bb", "good", meta(1), None), (5, None, "good", meta(2, license="z"), None), (6, "", "good", meta(2, license="z"), None),
        (7, "d_00000000000000cc", None, "broken", "{"), (8, "d_00000000000000cc", "mid", json.dumps(meta("never", license="l")), '{"score": 1}'),
        (9, "e_00000000000000dd", "good", meta(5, license="p"), None), (10, "e_00000000000000dd", "good", meta(5, license="p"), None),
    ])
    assert got[(1, "license")] == (2, "y") and got[(1, "score")] == (1, "0.5") and got[(1, "instance_id")] == (3, "i") and got[(1, "source")][0] == 2
    assert (1, "repo") not in got and got[(7, "license")] == (8, "l") and got[(7, "score")] == (8, "1") and got[(9, "license")] == (9, "p")
    assert {g for g, _ in got} == {1, 7, 9}


def test_votes_decide_between_trust_and_recency(spark):
    # the trusted row is old, the newest is poor; the third agrees with the trusted one
    got = fused(spark, [(1, "g_0000000000000001", "good", meta(10, license="x"), None), (2, "g_0000000000000001", "poor", meta(30, license="y"), None), (3, "g_0000000000000001", "mid", meta(20, license="x"), None)])
    assert got[(1, "license")] == (1, "x")


@pytest.mark.parametrize("copied", [False, True])
def test_copies_do_not_outvote_a_trusted_recent_row_but_independent_sources_do(spark, copied):
    rng = random.Random(5)
    names = [f"m{k}" for k in range(7)]
    honest = ["top", *(f"h{k}" for k in range(9))]
    sources = [*((n, f"h/{n}", 5) for n in honest), *((n, f"h/{n}", 4) for n in names)]
    rows = []
    for g in range(60):  # the sources err each by itself, or all like the first one
        wrong = g % 3 == 0
        said = dict.fromkeys(honest, "true") | {n: f"false {g if copied else rng.random()}" if (wrong if copied else rng.random() < 0.1) else "true" for n in names}
        rows += [(len(rows) + k + 1, f"g_{g:016x}", n, meta(10, license=v), None) for k, (n, v) in enumerate(said.items())]
    first = len(rows) + 1
    rows += [(first, "p_00000000000000ff", "top", meta(99, license="x"), None), *((first + 1 + k, "p_00000000000000ff", n, meta(50, license="y"), None) for k, n in enumerate(names))]
    got = fused_rows(spark, rows, sources)[(first, "license")]
    assert got.value == ("x" if copied else "y")
    exact = fused_rows(spark, rows, sources, exact=True)[(first, "license")]
    assert exact.value == "x" and (copied or exact.decided == "check")


def test_copied_votes_are_discounted():
    accuracy = {"a": 0.85, "b": 0.7, "c": 0.7}
    alone = fusion.value_votes(["a", "b", "c"], ["x", "y", "y"], accuracy, {})
    copied = fusion.value_votes(["a", "b", "c"], ["x", "y", "y"], accuracy, {("b", "c"): 0.99})
    assert alone["y"] > alone["x"] and copied["y"] < copied["x"]
    assert fusion.dependence(0, 5, 0, 0.8) > 0.95 > fusion.dependence(20, 0, 10, 0.8)
    assert sum(fusion.probabilities(alone).values()) <= 1


def test_one_group_may_hold_most_rows(spark):
    rows = [(i, "g_0000000000000009", SOURCES[i % 4][0], meta(i, license=f"v{i % 3}"), None) for i in range(1, 400)]
    got = fused(spark, rows)
    best = max(r[0] for r in rows if SOURCES[r[0] % 4][0] == "good")
    assert got[(1, "license")][0] in (best, 399)
    assert fused(spark, [(1, "x", "good", None, None)]) == {}


def test_survivors(spark):
    df = spark.createDataFrame([(1, "license", 2, "mit", 0.9)], "group_no bigint, field_name string, rec_no bigint, value string, posterior double")
    assert fusion.survivors(df).select("license", F.col("repo")).first().asDict() == {"license": "mit", "repo": None}
