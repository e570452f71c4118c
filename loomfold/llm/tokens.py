"""Token counts by a public byte-level BPE vocabulary; its file is a parameter and is read by each worker once."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfold.session import ship, spread

#: Where the vocabulary of ranks lies unless another path is given.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published pattern that splits text before the merges of this vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, tuple] = {}


def encoder(path: str = VOCABULARY):
    """(encoding, bytes of each token) of a vocabulary file of ranks. Special tokens don't exist: their text is text."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        _LOADED[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths
    return _LOADED[path]


def count(text: str | None, path: str = VOCABULARY) -> int:
    return len(encoder(path)[0].encode_ordinary(text)) if text else 0


def counted(documents: DataFrame, columns: tuple[str, ...], path: str = VOCABULARY) -> DataFrame:
    """The columns of documents and n_tokens of text; a null text has none."""
    ship(documents.sparkSession)
    rows = documents.select(*columns, "text")
    schema = rows.drop("text").withColumn("n_tokens", F.lit(0).cast("bigint")).schema

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pa.array([count(t, path) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), n], [*columns, "n_tokens"])

    return spread(rows).mapInArrow(tell, schema)
