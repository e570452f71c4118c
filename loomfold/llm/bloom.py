"""A Bloom filter of bounded size: keeps rows that surely aren't wanted out of a shuffle.

The filter has 16 bits a key, in powers of two between ``LEAST`` and ``MOST``, so what is collected and shipped is at
most 16 MiB. With far more keys than that it lets more pass: more is shuffled then, and the result stays the same. It
is built from the distinct places of the keys, about 2 bytes each, not from whole filters of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomfold.llm.texts import mixed

LEAST, MOST, _CHUNK = 1 << 20, 1 << 27, 1 << 15
_HELD = 4_000_000  # places that a task holds before it hands them out


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    h = mixed(keys.astype(np.int64).view(np.uint64) + np.uint64(1))
    return np.concatenate([h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)]).astype(np.int64)


def bits_for(keys: int) -> int:
    """Bits of a filter for so many keys."""
    return min(MOST, max(LEAST, 1 << (16 * keys - 1).bit_length())) if keys > 0 else LEAST


def build(keys: DataFrame, bits: int | None = None) -> np.ndarray:
    """The filter of a column of integers, as one bit per place; bits is a power of two of at most 2 ** 32, by default as many as the keys ask for."""
    bits = bits_for(keys.count()) if bits is None else bits

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(np.unique(_places(batch.column(0).drop_null().to_numpy(), bits)))
            size += len(held[-1])
            if size > _HELD:
                held = [np.unique(np.concatenate(held))]
                size = len(held[0])
                if size > _HELD // 2:
                    yield _packed(held[0])
                    held, size = [], 0
        yield _packed(np.unique(np.concatenate([*held, np.array([], np.int64)])))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, places in zip(batch.column("chunk").to_pylist(), batch.column("places").to_pylist()):
                total.setdefault(chunk, np.zeros(_CHUNK, bool))[np.frombuffer(places, np.uint16)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([np.packbits(x).tobytes() for x in total.values()], pa.binary())], ["chunk", "bits"])

    packed = np.zeros((bits // _CHUNK, _CHUNK // 8), np.uint8)
    for chunk, part in keys.mapInArrow(place, "chunk int, places binary").repartition("chunk").mapInArrow(merge, "chunk int, bits binary").collect():
        packed[chunk] = np.frombuffer(part, np.uint8)
    return packed.ravel()


def _packed(places: np.ndarray) -> pa.RecordBatch:
    """Sorted distinct places as (chunk, places in it), two bytes a place."""
    chunks = places // _CHUNK
    starts = np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1]]) if len(places) else np.array([], np.int64)
    ends = (2 * np.r_[starts, len(places)]).astype(np.int32)
    data = pa.py_buffer((places % _CHUNK).astype(np.uint16).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(chunks[starts].astype(np.int32)), pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.tobytes()), data])], ["chunk", "places"])


def may_hold(packed: np.ndarray, keys: pa.Array) -> np.ndarray:
    """Which keys may be in the filter; nulls are not."""
    places = _places(keys.fill_null(0).to_numpy(), len(packed) * 8)
    hit = (packed[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1
    return hit.reshape(2, -1).all(axis=0) & keys.is_valid().to_numpy(zero_copy_only=False)
