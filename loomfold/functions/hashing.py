"""Content hashes, word shingles and minwise bands."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfold.functions.jsonx import deep_sorted, encode
from loomfold.session import ship

SHINGLE, MOST_SHINGLES = 5, 1_500
PERMUTATIONS, BANDS, BAND_ROWS = 64, 4, 15
PRIME = 2**31 - 1


def normal(value) -> str:
    """Text in lower case with single spaces; other values as JSON, null as empty text."""
    if value is None:
        return ""
    return re.sub(r"\s+", " ", value if isinstance(value, str) else encode(value)).strip().lower()


def content_hash(messages: list[dict], tool_names: list[str]) -> str:
    """16 hex characters of the content: roles, normal contents, calls with sorted arguments, responses, sorted names."""
    parts: list[str] = []
    for m in messages:
        parts += [m.get("role") or "", normal(m.get("content"))]
        for c in m.get("tool_calls") or ():
            parts += [c["function"].get("name") or "", encode(deep_sorted(c["function"].get("arguments")))]
        parts += [normal(r.get("response")) for r in m.get("tool_responses") or ()]
    return xxhash.xxh64_hexdigest("".join([*parts, *sorted(tool_names)]).encode("utf-8", "replace"))


def shingles(messages: list[dict], tool_names: list[str], size: int = SHINGLE, most: int | None = MOST_SHINGLES) -> list[str]:
    """Distinct runs of words of what the assistant said and called, and of the tool names.

    More than ``most`` are thinned evenly by position, so that an edit moves all that follow off the stride; None keeps all.
    """
    said: list[str] = []
    for m in messages:
        if m.get("role") == "assistant":
            said.append(normal(m.get("content")))
            for c in m.get("tool_calls") or ():
                said += [c["function"].get("name") or "", normal(c["function"].get("arguments"))]
    words = " ".join(filter(None, [*said, *sorted(tool_names)])).split()
    if len(words) < size:
        return [" ".join(words)] if words else []
    count = len(words) - size + 1
    step = 1 if most is None or count <= most else count // most + 1
    return list(dict.fromkeys(" ".join(words[i : i + size]) for i in range(0, count, step)))


def text_shingles(text: Column, size: int = SHINGLE, most: int | None = MOST_SHINGLES) -> Column:
    """Shingles of normal text as a column; most as above."""

    def cut(words: Column) -> Column:
        count = F.size(words) - size + 1
        step = F.lit(1) if most is None else F.when(count <= most, F.lit(1)).otherwise(F.floor(count / most).cast("int") + 1)
        at = F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)), step)
        many = F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", *(F.get(words, i + k) for k in range(size)))))
        few = F.when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
        return F.when(count >= 1, many).otherwise(few)

    # the words are bound once, as the only element of an array: they would be split anew for each shingle otherwise
    return F.get(F.transform(F.array(F.filter(F.split(text, " "), lambda w: w != "")), cut), F.lit(0))


def multipliers(permutations: int = PERMUTATIONS) -> list[tuple[int, int]]:
    """(a, b) of the permutations h -> (a h + b) mod PRIME, by a rule."""
    return [((i * 48_271 + 11) * 16_807 % (PRIME - 1) + 1, (i * 69_621 + 7) * 30_269 % PRIME) for i in range(1, permutations + 1)]


@lru_cache
def _permutations(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.array(multipliers(permutations), np.int64).T
    return a[:, None], b[:, None]


def signature(shingles: list[str], permutations: int = PERMUTATIONS) -> np.ndarray | None:
    """The minwise values of shingles; None where there are none. A shingle counts by 31 bits of its md5, as SQL has it."""
    if not shingles:
        return None
    base = np.array([int(hashlib.md5(x.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) for x in shingles], np.int64) % PRIME
    a, b = _permutations(permutations)
    low = np.full(permutations, PRIME, np.int64)
    for at in range(0, len(base), 8192):  # products stay below 2 ** 62
        low = np.minimum(low, ((base[at : at + 8192] * a + b) % PRIME).min(axis=1))
    return low


def band_keys(values: np.ndarray | None, count: int = BANDS, rows: int = BAND_ROWS) -> list[str]:
    """One key per band of a signature; rows that agree in one are candidates. Without a signature there are none."""
    parts = [] if values is None else values[: count * rows].reshape(count, rows).tolist()
    return [hashlib.md5(",".join(map(str, part)).encode()).hexdigest() for part in parts]


@lru_cache
def banding(threshold: float, permutations: int = PERMUTATIONS) -> tuple[int, int]:
    """(bands, rows a band) whose chance to meet comes nearest to a step at the threshold, both kinds of error weighed alike.

    The area of wrong meetings below the threshold and of missed ones above it is smallest over all divisions of the
    permutations.
    """
    s = (np.arange(1_000) + 0.5) / 1_000
    below = s < threshold

    def wrong(bands: int, rows: int) -> float:
        meet = 1 - (1 - s**rows) ** bands
        return float(meet[below].sum() + (1 - meet[~below]).sum())

    return min(((b, r) for b in range(1, permutations + 1) for r in range(1, permutations // b + 1)), key=lambda x: wrong(*x))


def minhash(rows: DataFrame, key: str, shingles: str = "shingles", permutations: int = PERMUTATIONS) -> DataFrame:
    """(key, m0 .. mN): minwise values of the shingles of each row, in one narrow pass; rows without shingles have none."""

    given = rows.select(key, shingles)
    names = [f"m{i}" for i in range(permutations)]
    schema = given.select(key, *(F.lit(0).cast("bigint").alias(n) for n in names)).schema

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signature(x or [], permutations) for x in batch.column(1).to_pylist()]
            kept = [i for i, x in enumerate(found) if x is not None]
            values = np.stack([found[i] for i in kept], axis=1) if kept else np.empty((permutations, 0), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), *map(pa.array, values)], [key, *names])

    ship(rows.sparkSession)
    return given.mapInArrow(sign, schema)


def bands(signatures: DataFrame, key: str, count: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(key, band, band_key): one row per band; rows that agree in one are candidates."""
    keys = F.array(*(F.md5(F.concat_ws(",", *(f"m{b * rows + r}" for r in range(rows)))) for b in range(count)))
    return signatures.select(key, F.posexplode(keys).alias("band", "band_key"))
