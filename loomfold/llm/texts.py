"""Texts of records as words and word runs, shared by the near-duplicate operators."""

from __future__ import annotations

import numpy as np
import xxhash

from loomfold.functions.decode import content_text, inner, messages_of

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_WORDS: dict[str, int] = {}


def record_text(messages: str | None, tool_names: list | None) -> str | None:
    """Contents of user and assistant messages in order, then the sorted tool names, joined by single spaces.

    None where the messages cannot be decoded. Null or empty contents and null names are left out.
    """
    decoded = messages_of(messages)
    if decoded is None:
        return None
    parts = []
    for m in decoded:
        if isinstance(m := inner(m), dict) and m.get("role") in ("user", "assistant"):
            text = content_text(m.get("content"))
            if text:
                parts.append(text)
    return " ".join([*parts, *sorted(n for n in tool_names or () if n is not None)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words; a table of the words met so far saves most of the work and is emptied when it grows."""
    if len(_WORDS) > 500_000:
        _WORDS.clear()
    known = _WORDS.get
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = known(w)
        if h is None:
            h = _WORDS[w] = xxhash.xxh64_intdigest(w)
        out[i] = h
    return out


def runs(text: str, size: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words of the lower-cased text; a shorter text is one run."""
    h = word_hashes(text.lower().split())
    if len(h) < size:
        return np.array([xxhash.xxh64_intdigest(h.tobytes(), 7)], np.uint64)
    n = len(h) - size + 1
    acc = np.zeros(n, np.uint64)
    for k in range(size):
        acc = mixed(acc * _M1 + h[k : k + n] + _M2)
    return np.unique(acc)


def both(a: np.ndarray, b: np.ndarray) -> int:
    """Number of common elements of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
