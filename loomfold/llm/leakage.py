"""Evaluation passages in training text by suffix arrays of the training shards.

Each worker takes whole documents until a shard holds ``SHARD`` words, numbers the words and builds the suffix array of
the shard by prefix doubling. Every suffix of every test item is looked up by binary search: the suffixes that share
its first ``least`` words are one range of the array, and the longest match is told with its places in both texts. A
suffix whose first two words no test item has in a row can't match and is left out of the array beforehand, likewise
one too near to a break, so the array of ordinary text is small.

The corpus is read once, in one narrow stage without a shuffle; only the matches are shuffled (one row per document
and item). Items are the side that is shipped to all workers: their words are counted, and beyond ``ITEM_WORDS`` they
go in blocks over the corpus. A document longer than a shard is a shard of its own: texts are never cut.

Defined results. Words are the longest runs of letters and digits, lower-cased. Null or blank texts have none; items
shorter than ``least`` words can't leak; equal items leak together; repeated documents are told each by its id, rows
without an id not at all. Empty tables give no matches. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfold.functions.decode import rows_of
from loomfold.session import ship, spread, written

SHARD, ITEM_WORDS = 1_000_000, 4_000_000
#: Matches that are followed up at a time: a passage that stands in many places and items is never held as all pairs.
AT_ONCE = 2_000_000
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Items:
    """Test items as one array of word numbers; every item ends with a break (0), as every document does."""

    def __init__(self, items: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        numbers, owner, place = [], [], []
        for item, text in items:
            words = words_of(text)
            numbers += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words] + [0]
            owner += [item] * (len(words) + 1)
            place += range(len(words) + 1)
        self.numbers = np.array(numbers, np.int64)
        self.owner, self.place = np.array(owner, np.int64), np.array(place, np.int64)
        self.width = np.int64(len(self.vocabulary) + 1)
        two = self.numbers[:-1] * self.width + self.numbers[1:] if len(numbers) else self.numbers
        inside = (self.numbers[:-1] > 0) & (self.numbers[1:] > 0) if len(numbers) else np.array([], bool)
        self.twos = np.unique(two[inside])


def _ranks(numbers: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """Ranks of the suffixes at ``starts`` by their first ``least`` words, by prefix doubling.

    Words behind the end count as breaks. Ranks of places that aren't starts are found where doubling needs them.
    """
    size = len(numbers)
    padded = np.r_[numbers, np.zeros(least + 1, np.int64)]
    at = np.unique((starts[:, None] + np.arange(least)[None, :]).ravel()) if len(starts) else starts
    at = at[at < size + least]
    rank = np.full(len(padded), 0, np.int64)
    rank[at] = padded[at]
    ranked, done = {1: rank}, 1
    while done * 2 <= least:
        before = ranked[done]
        behind = np.where(at + done < len(padded), before[np.minimum(at + done, len(padded) - 1)], 0)
        pair = before[at] * np.int64(len(padded) + numbers.max(initial=0) + 2) + behind
        now = np.zeros(len(padded), np.int64)
        now[at] = np.unique(pair, return_inverse=True)[1] + 1
        done *= 2
        ranked[done] = now
    # the rest of the length from smaller doublings
    key, covered = ranked[done][starts], done
    for part in sorted(ranked, reverse=True):
        while covered + part <= least:
            behind = ranked[part][np.minimum(starts + covered, len(padded) - 1)]
            key = np.unique(key * np.int64(len(padded) + numbers.max(initial=0) + 2) + behind, return_inverse=True)[1]
            covered += part
    return key


def search_shard(numbers: np.ndarray, items: Items, least: int, at_once: int = AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place in the shard, place in the items, matched words) of all matches of at least ``least`` words, the longest per start.

    They come in parts of about ``at_once`` matches.
    """
    if len(numbers) < least or len(items.twos) == 0:
        return
    two = numbers[:-1] * items.width + numbers[1:]
    at = np.searchsorted(items.twos, two)
    at[at == len(items.twos)] = 0
    known = (items.twos[at] == two).astype(np.int32)
    # starts of at least ``least`` words whose neighbours all occur as neighbours in some item
    total = np.r_[0, np.cumsum(known)]
    starts = np.flatnonzero(total[least - 1 :] - total[: len(total) - least + 1] == least - 1)
    if len(starts) == 0:
        return
    # pack the parts of the shard around the starts, then the items: one array, ranked together
    needed = np.zeros(len(numbers) + 1, np.int32)
    np.add.at(needed, starts, 1)
    np.add.at(needed, np.minimum(starts + least, len(numbers)), -1)
    kept = np.flatnonzero(np.cumsum(needed[:-1]) > 0)
    breaks = np.flatnonzero(np.diff(kept) > 1) + 1
    packed_at = np.arange(len(kept)) + np.searchsorted(breaks, np.arange(len(kept)), side="right")
    packed = np.zeros(packed_at[-1] + 2, np.int64)
    packed[packed_at] = numbers[kept]
    own = packed_at[np.searchsorted(kept, starts)]
    tests = np.flatnonzero(items.numbers > 0)
    joint = np.r_[packed, items.numbers]
    rank = _ranks(joint, np.r_[own, tests + len(packed)], least)
    mine, theirs = rank[: len(starts)], rank[len(starts) :]
    order = np.argsort(mine, kind="stable")  # the suffix array of the shard
    sorted_ranks = mine[order]
    low, high = np.searchsorted(sorted_ranks, theirs, "left"), np.searchsorted(sorted_ranks, theirs, "right")
    hits = high - low
    held = np.flatnonzero(hits)
    places = starts[order]
    for part in np.split(held, np.flatnonzero(np.diff(np.cumsum(hits[held]) // at_once)) + 1):
        for first in range(0, int(hits[part].max(initial=0)), at_once):  # one passage in very many places goes in parts itself
            own = np.clip(hits[part] - first, 0, at_once)
            test = np.repeat(tests[part], own)
            within = np.arange(len(test)) - np.repeat(np.cumsum(own) - own, own)
            place = places[np.repeat(low[part] + first, own) + within]
            yield _followed(numbers, items, place, test, least)


def _followed(numbers: np.ndarray, items: Items, place: np.ndarray, test: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches with their lengths, word by word behind the shared beginning."""
    length = np.full(len(place), least, np.int64)
    alive = np.arange(len(place))
    while len(alive):
        a, b = place[alive] + length[alive], test[alive] + length[alive]
        inside = (a < len(numbers)) & (b < len(items.numbers))
        alive, a, b = alive[inside], a[inside], b[inside]
        same = (numbers[a] == items.numbers[b]) & (numbers[a] > 0)
        alive = alive[same]
        length[alive] += 1
    clean = _without_breaks(numbers, place, least)
    return place[clean], test[clean], length[clean]


def _without_breaks(numbers: np.ndarray, place: np.ndarray, least: int) -> np.ndarray:
    """Which matches hold no break in their first words."""
    zero = np.r_[0, np.cumsum(numbers == 0)]
    return zero[place + least] == zero[place]


def _matches(documents: DataFrame, items: Items, least: int) -> DataFrame:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = items.vocabulary.get
        pieces: list[np.ndarray] = []
        docs: list[int] = []
        ends: list[int] = []
        held = 0

        def search() -> pa.RecordBatch:
            shard = np.concatenate(pieces) if pieces else np.array([], np.int64)
            bounds = np.array(ends, np.int64)
            begin = np.r_[0, bounds[:-1]] if len(bounds) else bounds
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for place, test, length in search_shard(shard, items, least):
                doc = np.searchsorted(bounds, place, side="right")
                for d, p, t, n in zip(doc.tolist(), place.tolist(), test.tolist(), length.tolist()):
                    key, found = (docs[d], int(items.owner[t])), (n, -(p - int(begin[d])), -int(items.place[t]))
                    if key not in best or found > best[key]:
                        best[key] = found
            columns = [[k[0] for k in best], [k[1] for k in best], [v[0] for v in best.values()], [-v[1] for v in best.values()], [-v[2] for v in best.values()]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "n_words", "doc_word", "item_word"])

        for doc, text in rows_of(batches):
            if doc is None or not text:
                continue
            words = words_of(text)
            line = np.fromiter((number(w, 0) for w in words), np.int64, len(words))
            pieces.append(np.r_[line, 0])
            held += len(words) + 1
            docs.append(doc)
            ends.append(held)
            if held >= SHARD:
                yield search()
                pieces, docs, ends, held = [], [], [], 0
        yield search()

    rows = spread(documents.select(F.col("doc_id").cast("bigint"), "text"))
    return rows.mapInArrow(look, "doc_id bigint, item_id bigint, n_words bigint, doc_word bigint, item_word bigint")


def _blocks(items: DataFrame) -> Iterator[Items]:
    """The items in blocks of about ``ITEM_WORDS`` words; the driver holds one partition of rows and a block or two."""
    rows = items.where("item_id IS NOT NULL AND item_text IS NOT NULL").select(F.col("item_id").cast("bigint"), "item_text")
    block, words, any_block = [], 0, False
    for row in rows.orderBy("item_id").toLocalIterator():
        block.append(tuple(row))
        words += len(words_of(row[1]))
        if words >= ITEM_WORDS:
            yield Items(block)
            block, words, any_block = [], 0, True
    if block or not any_block:
        yield Items(block)


def leaks(documents: DataFrame, items: DataFrame, least: int = 12) -> DataFrame:
    """(doc_id, item_id, n_words, doc_word, item_word): the longest passage of at least ``least`` words per document and item.

    doc_word and item_word are the numbers of its first word in either text.
    """
    ship(documents.sparkSession)
    found, before = None, None
    for block in _blocks(items):
        if before is not None:  # one block of items at a time: its matches are written before the next is made
            table = written(_matches(documents, before, least), "matches")
            found = table if found is None else found.unionByName(table)
        before = block
    last = _matches(documents, before, least)
    found = last if found is None else found.unionByName(last)
    order = F.struct("n_words", -F.col("doc_word"), -F.col("item_word"))
    best = found.groupBy("doc_id", "item_id").agg(F.max(order).alias("b"))
    return best.select("doc_id", "item_id", "b.n_words", (-F.col("b.col2")).alias("doc_word"), (-F.col("b.col3")).alias("item_word"))


def report(found: DataFrame) -> DataFrame:
    """(item_id, n_docs, longest): how many documents hold a passage of an item."""
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("n_words").alias("longest"))


def without_leaks(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that hold no passage of any item."""
    return documents.join(found.select("doc_id").distinct(), "doc_id", "left_anti")
