"""Sizes of texts in tokens of a public byte-pair tokenizer. The vocabulary file is a parameter and is only read."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's own rule for cutting text into words. Fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(vocabulary: str = VOCABULARY):
    """One encoder per worker process and file."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str, vocabulary: str = VOCABULARY) -> int:
    try:
        return len(encoder(vocabulary).encode_ordinary(text))
    except UnicodeEncodeError:  # a lone surrogate has no UTF-8 form
        return len(encoder(vocabulary).encode_ordinary(text.encode("utf-8", "replace").decode()))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), vocabulary: str = VOCABULARY) -> DataFrame:
    """``id_col``, ``keep`` columns and ``tokens``; whole texts are encoded, null and empty ones have 0 tokens."""
    columns = [id_col, *keep]
    schema = docs.select(*columns).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [count_tokens(t, vocabulary) if t else 0 for t in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], [*columns, "tokens"])

    return docs.select(*columns, text_col).mapInArrow(run, ddl)
