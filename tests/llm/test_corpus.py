import math
import random

import numpy as np
import pytest

from loomfold.llm import leakage, mixing, splitting
from loomfold.llm.tokens import VOCABULARY, count, encoder

DOCS = "doc_id bigint, text string, source string, doc_kind string, item_id int"
ITEMS = "item_id bigint, suite string, item_text string, doc_id int"


def docs(spark, *rows):
    return spark.createDataFrame([(*r, 7) for r in rows], DOCS)


def brute_leaks(texts, items, least):
    found = {}
    for d, text in texts:
        w = leakage.words_of(text)
        for i, item in items:
            v = leakage.words_of(item)
            best = 0
            at = {}
            for p in range(len(v) - least + 1):
                at.setdefault(tuple(v[p : p + least]), []).append(p)
            for q in range(len(w) - least + 1):
                for p in at.get(tuple(w[q : q + least]), ()):
                    n = least
                    while q + n < len(w) and p + n < len(v) and w[q + n] == v[p + n]:
                        n += 1
                    best = max(best, n)
            if best:
                found[(d, i)] = best
    return found


@pytest.mark.parametrize("seed, least", [(1, 12), (2, 5), (3, 3), (4, 2)])
def test_leaks_equal_brute_force(spark, seed, least):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Ü1", "日本"]
    line = lambda n: rng.choice([" ", "-\n", ", "]).join(rng.choice(words) for _ in range(n))
    items = [(i, line(rng.randrange(1, 40))) for i in range(8)]
    items += [(50, items[0][1]), (51, None), (52, "")]
    texts = [(d, line(rng.randrange(0, 80))) for d in range(15)]
    for d in range(5):
        piece = leakage.words_of(items[d][1])
        texts.append((100 + d, f"{line(5)} zz {'_'.join(piece[: least + d]).upper()} zz {line(5)}"))
    texts += [(200, texts[-1][1]), (201, None), (202, " "), (203, "one two")]
    want = brute_leaks([t for t in texts if t[1]], [i for i in items if i[1]], least)
    found = leakage.leaks(docs(spark, *((d, t, "s", "k") for d, t in texts)), spark.createDataFrame([(i, "s", t, 1) for i, t in items], ITEMS), least)
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    assert {k: r.n_words for k, r in got.items()} == want and want
    text, item = dict(texts), dict(items)
    for (d, i), r in got.items():
        assert leakage.words_of(text[d])[r.doc_word : r.doc_word + r.n_words] == leakage.words_of(item[i])[r.item_word : r.item_word + r.n_words]


def test_blocks_shards_and_reports(spark, monkeypatch):
    passage = " ".join(f"word{i}" for i in range(20))
    rows = [(i, f"start {passage if i % 3 == 0 else 'nothing'} end", "s", "k") for i in range(9)]
    items = spark.createDataFrame([(1, "s", passage, 1), (2, "s", passage + " more", 1)], ITEMS)
    monkeypatch.setattr(leakage, "ITEM_WORDS", 20)
    found = leakage.leaks(docs(spark, *rows), items).cache()
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(d, i) for d in (0, 3, 6) for i in (1, 2)}
    assert {r.item_id: (r.n_docs, r.longest) for r in leakage.report(found).collect()} == {1: (3, 20), 2: (3, 20)}
    assert leakage.without_leaks(docs(spark, *rows), found).count() == 6
    assert leakage.leaks(docs(spark, *rows).limit(0), items).count() == 0 and leakage.leaks(docs(spark, *rows), items.limit(0)).count() == 0


def test_passages_in_many_places_go_in_parts():
    words = [f"w{i}" for i in range(14)]
    items = leakage.Items([(i, " ".join([*words, f"own{i}"])) for i in range(20)])
    line = [items.vocabulary[w] for w in words]
    shard = np.array([*(line + [0]) * 50], np.int64)
    whole = [np.concatenate(x) for x in zip(*leakage.search_shard(shard, items, 12))]
    parts = list(leakage.search_shard(shard, items, 12, at_once=37))
    assert len(parts) > 20 and max(len(p[0]) for p in parts) <= 2 * 37 * 3 and len(whole[0]) == 50 * 20 * 3
    assert sorted(zip(*map(np.ndarray.tolist, map(np.concatenate, zip(*parts))))) == sorted(zip(*map(np.ndarray.tolist, whole)))


def test_temperature():
    natural = {"a": 0.7, "b": 0.2, "c": 0.1}
    assert mixing.entropy(mixing.at_entropy(natural, 1.0)) == pytest.approx(1.0, abs=1e-6)
    assert mixing.at_entropy(natural, math.log(3)) == pytest.approx({k: 1 / 3 for k in natural}, abs=1e-3)
    weights, budget, exponent = mixing.plan({"a": 1, "b": 1, "c": 0}, {"a": 100, "b": 10, "c": 5}, {"a": 1, "b": 3, "c": 1})
    assert weights == {"a": 0.5, "b": 0.5} and budget == 60 and exponent == 1
    weights, budget, exponent = mixing.plan({"a": 1, "b": 1}, {"a": 100, "b": 10}, {"a": 1, "b": 3}, budget=100)
    assert 0 < exponent < 1 and weights["b"] * budget == pytest.approx(30, rel=1e-6)
    assert mixing.plan({"a": 1}, {"a": 0}, {}) == ({}, 0.0, 1.0)
    assert mixing.plan({"a": 1, "b": 1}, {"a": 10, "b": 10}, {"a": 1, "b": 2}, budget=1000)[1] == 30


def test_mix_meets_weights_and_limits(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for source, size in (("big", 600), ("mid", 200), ("Small ", 30), ("untargeted", 50), ("zero", 20)):
        for _ in range(size):
            n += 1
            rows.append((n, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randrange(5, 60))), source, "k"))
    rows += [(None, "text", "big", "k"), (n + 1, None, "big", "k"), (n + 2, "", "mid", "k")]
    targets = spark.createDataFrame([("big", 2.0, 1), ("mid", 1.0, 2), ("small", 1.0, 4), ("zero", 0.0, 1), ("none", None, 1), ("ghost", 1.0, 1)], "source string, weight double, max_repeats int")
    draws, shares = mixing.mix(docs(spark, *rows), targets)
    got, told = draws.collect(), {r.source: r for r in shares.collect()}
    assert len({r.doc_id for r in got}) == len(got)
    assert {s: max(r.repeats for r in got if r.source == s) for s in ("big", "mid", "small")} == {"big": 1, "mid": 1, "small": 4}
    assert told["big"].actual_share == pytest.approx(0.5, abs=0.01) and told["small"].actual_share == pytest.approx(0.25, abs=0.01)
    assert told["zero"].actual_share == told["none"].actual_share == told["ghost"].actual_share == 0 and "untargeted" not in told
    for s in ("big", "mid", "small"):
        assert told[s].n_tokens == sum(r.n_tokens * r.repeats for r in got if r.source == s)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs(spark, *reversed(rows)), targets)[0].collect()))
    # more than the repeats allow of the targets: the exponent bends the weights to the limits of the small source
    draws, shares = mixing.mix(docs(spark, *rows), targets, share=0.9)
    bent = {r.source: r for r in shares.collect()}
    assert bent["small"].actual_share < 0.2 and bent["small"].most_repeats == 4 and bent["big"].actual_share > 0.5 and bent["big"].most_repeats == 1
    assert all(abs(r.actual_share - r.planned_share) < 0.02 for r in bent.values())
    assert sum(r.n_tokens for r in bent.values()) == pytest.approx(0.9 * sum(count(t) for _, t, s, _ in rows if t and s.strip().lower() in ("big", "mid", "small")), rel=0.03)
    even = {r.source: r for r in mixing.mix(docs(spark, *rows), targets, target_entropy=1.0)[1].collect()}
    assert mixing.entropy({k: r.planned_share for k, r in even.items()}) == pytest.approx(1.0, abs=1e-3) and all(abs(r.actual_share - r.planned_share) < 0.02 for r in even.values())
    assert mixing.mix(docs(spark, *rows).limit(0), targets)[0].count() == 0 and mixing.mix(docs(spark, *rows), targets.limit(0))[0].count() == 0


def check_pieces(text, pieces, limit, overlap):
    assert pieces[0].start_char == 0 and pieces[-1].end_char == len(text)
    for p in pieces:
        assert text[p.start_char : p.end_char] == p.text and p.n_tokens == count(p.text) <= limit
    for a, b in zip(pieces, pieces[1:]):
        assert a.start_char < b.start_char <= a.end_char < b.end_char
        if overlap == 0:
            assert b.start_char == a.end_char


LIMITS = [("a", 40, 8), ("b", 25, 0), ("c", 1, 5), ("d", None, 1), ("e", 30, None)]


def texts(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["plain", "words", "naïve", "日本語", "12345", "x_y", "don't", "…"])
    sentence = lambda: " ".join(word() for _ in range(rng.randrange(3, 15))) + rng.choice([".", "!", "?", ""])
    return [rng.choice(["\n\n", " ", "\n", "\r\n\r\n", "  \n   "]).join(sentence() for _ in range(rng.randrange(1, 60))) for _ in range(12)]


def corpus():
    rows = [(i, t, "s", "abe"[i % 3]) for i, t in enumerate(texts(3))]
    rows += [(50, "x" * 3000, "s", "a"), (51, "日本" * 400, "s", "b"), (52, " " * 500, "s", "a"), (53, None, "s", "a"), (54, "", "s", "a"), (55, "many words here " * 300, "s", "d"), (56, "many words here " * 300, "s", "none"), (57, "😀" * 200, "s", "a")]
    code = "".join(f"\n{' ' * (i % 9)}if x{i}:  \t return ({i})\u3000# {'=' * (i % 40)}" for i in range(120))
    rows += [(58, code, "s", "a"), (58, code, "s", "a"), (58, code, "s", "b"), (59, "one line of words without any end " * 40 + "y" * 900 + " and more words " * 40, "s", "a")]
    return rows


def test_pieces_keep_limit_order_and_text(spark):
    rows = corpus()
    limits = spark.createDataFrame(LIMITS, "doc_kind string, max_tokens int, overlap_tokens int")
    pieces = {size: sorted(map(tuple, splitting.split(docs(spark, *rows), limits, size=size).collect())) for size in (splitting.RANGE, 256, 70)}
    # how texts are divided into ranges makes no difference, to blank and repeated ones neither
    assert pieces[256] == pieces[splitting.RANGE] == pieces[70]
    found = splitting.split(docs(spark, *rows), limits, size=256).collect()
    by_doc = {}
    for p in found:
        by_doc.setdefault((p.doc_id, p.doc_kind), []).append(p)
    limit_of = {k: (m, o or 0) for k, m, o in LIMITS if m}
    over = {(d, k) for d, t, _, k in rows if t and not t.isspace() and k in limit_of and count(t) > limit_of[k][0]}
    assert set(by_doc) == over and len(over) > 10
    for (d, kind), own in by_doc.items():
        text = next(t for i, t, _, k in rows if i == d and k == kind)
        copies = sum((i, k) == (d, kind) for i, _, _, k in rows)
        own = sorted(own, key=lambda p: p.piece_no)
        assert [p.piece_no for p in own] == sorted(list(range(len(own) // copies)) * copies)
        check_pieces(text, own[::copies], *limit_of[kind])


def test_files_are_split_by_byte_ranges_like_texts(spark, tmp_path):
    told = {f"f {i}.txt": t for i, (_, t, _, _) in enumerate(corpus()) if t}
    for name, text in told.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    limits = spark.createDataFrame([("a", 40, 8)], "doc_kind string, max_tokens int, overlap_tokens int")
    whole = splitting.split(docs(spark, *((i, t, "s", "a") for i, t in enumerate(told.values()))), limits).collect()
    want = sorted((list(told)[p.doc_id], p.piece_no, p.n_tokens, p.text) for p in whole)
    for size, halo in ((200, 16), (1 << 20, 64)):
        got = splitting.split_files(spark, f"{tmp_path}/*.txt", 40, 8, size=size, halo=halo).collect()
        names = {p.path: p.path.rsplit("/", 1)[-1].replace("%20", " ") for p in got}
        assert sorted((names[p.path], p.piece_no, p.n_tokens, p.text) for p in got) == want
        for p in got:
            assert told[names[p.path]].encode()[p.start_byte : p.end_byte].decode() == p.text


def test_ranges_and_whole_texts_agree_on_tokens():
    text = "\n\n".join(texts(9))
    whole = splitting.boundary_table(text)
    assert whole[1][-1] == count(text)
    encoding, lengths = encoder(VOCABULARY)
    assert lengths[np.array(encoding.encode_ordinary(text))].sum() == len(text.encode())


def test_natural_boundaries_are_preferred(spark):
    text = "\n\n".join("This is a sentence of words. " * 3 for _ in range(8)).strip()
    limits = spark.createDataFrame([("a", 40, 0)], "doc_kind string, max_tokens int, overlap_tokens int")
    pieces = sorted(splitting.split(docs(spark, (1, text, "s", "a")), limits).collect(), key=lambda p: p.piece_no)
    assert all(p.text.endswith("\n\n") for p in pieces[:-1])
    assert splitting.split(docs(spark, (1, text, "s", "a")).limit(0), limits).count() == 0
