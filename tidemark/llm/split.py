"""Splitting oversized items at natural boundaries.

The cuts of a text are chosen together: dynamic programming over its boundary positions minimises the sum of the cut
penalties (paragraph < line < sentence < clause < word < inside a word) and of the squared deviations of the piece
lengths from an even length, under the constraint that no piece, its overlap included, exceeds the limit.

Defined results
---------------
* null text: no piece.  Empty text: one empty piece.  A text of at most ``max_len``: one piece, unchanged.
* ``[start, end)`` are code-point offsets; consecutive pieces overlap by at most ``overlap``; pieces minus their
  overlaps concatenate to the text exactly.
* a text without any boundary (one long word) is cut hard, never between CR and LF or before a combining mark.
* repeated rows give repeated pieces; ``split_items(..., distinct=True)`` returns every piece once.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LEN = 3200
OVERLAP = 400

#: Penalties of a cut, by the kind of boundary before it. Fixed values of this operator.
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, HARD = 0.0, 0.15, 0.3, 1.0, 2.0, 8.0
#: Weight of the squared relative deviation from an even piece length.
BALANCE = 1.5

_BREAKS = re.compile(
    r"(?P<p>(?:\r\n|\n|\r|\u2028|\u0085)[ \t]*(?:\r\n|\n|\r|\u2028|\u0085)\s*|\u2029\s*)"
    r"|(?P<l>\r\n|\n|\r|\u2028|\u0085)"
    r"|(?P<s>[.!?…]+[\"'”’)\]]*\s+|[。！？][」』）]*|[؟۔।]\s*)"
)
_CLAUSES = re.compile(r"[,;:]\s+|[、，；،]")
_WORDS = re.compile(r"\s+|[‐-―-]")


def boundaries(text: str, dense: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where ``text`` may be cut, ascending, with penalties; finer kinds fill gaps longer than ``dense``."""
    at: dict[int, float] = {}
    for m in _BREAKS.finditer(text):
        at[m.end()] = PARAGRAPH if m.lastgroup == "p" else LINE if m.lastgroup == "l" else SENTENCE
    n = len(text)
    at.pop(0, None)
    at.pop(n, None)
    for pattern, cost in ((_CLAUSES, CLAUSE), (_WORDS, WORD), (None, HARD)):
        stops = [0, *sorted(at), n]
        for a, b in zip(stops, stops[1:]):
            if b - a <= dense:
                continue
            if pattern is not None:
                for m in pattern.finditer(text, a, b):
                    if a < m.end() < b:
                        at.setdefault(m.end(), cost)
            else:
                for k in range(a + dense // 2, b, dense // 2):
                    while k < b and (unicodedata.combining(text[k]) or text[k - 1 : k + 1] == "\r\n"):
                        k += 1
                    if k < b:
                        at.setdefault(k, cost)
    pos = np.array(sorted(at), dtype=np.int64)
    return pos, np.array([at[p] for p in pos.tolist()])


def cut(text: str, max_len: int = MAX_LEN, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Spans ``[start, end)`` of the pieces of ``text``."""
    n = len(text)
    if n <= max_len:
        return [(0, n)]
    step = max_len - overlap
    pos, penalty = boundaries(text, max(2, step // 8))
    ends = np.concatenate([[0], pos, [n]])
    penalty = np.concatenate([[0.0], penalty, [0.0]])
    even = n / (1 + -(-(n - max_len) // step))
    best = np.full(len(ends), np.inf)
    before = np.zeros(len(ends), dtype=np.int64)
    best[0] = 0.0
    # A first piece may use the whole limit, a later one must leave room for its overlap.
    low = np.searchsorted(ends, ends - step)
    last_from_start = int(np.searchsorted(ends, max_len, side="right"))
    for j in range(1, len(ends)):
        i = low[j]
        if i < j:
            cost = best[i:j] + BALANCE * ((ends[j] - ends[i:j]) / even - 1.0) ** 2
            k = int(np.argmin(cost))
            best[j], before[j] = cost[k] + penalty[j], i + k
        if j < last_from_start:
            cost0 = BALANCE * (ends[j] / even - 1.0) ** 2 + penalty[j]
            if cost0 < best[j]:
                best[j], before[j] = cost0, 0
    if not np.isfinite(best[-1]):  # boundaries too sparse for the limit cannot occur: HARD fills every gap
        return [(s, min(n, s + max_len)) for s in range(0, max(1, n - overlap), step)]
    cuts, j = [], len(ends) - 1
    while j > 0:
        cuts.append(int(j))
        j = int(before[j])
    cuts.append(0)
    cuts.reverse()
    spans = []
    for a, b in zip(cuts, cuts[1:]):
        start, end = int(ends[a]), int(ends[b])
        if a:
            # The overlap starts at the best boundary of the last `overlap` characters, the earliest among equals.
            lo = int(np.searchsorted(ends, max(start - overlap, end - max_len)))
            if lo < a:
                start = int(ends[lo + int(np.argmin(penalty[lo:a]))])
        spans.append((start, end))
    return spans


def sections_of(document: str | None) -> list[tuple[str, str]]:
    """(name, text) of a JSON object of texts; anything unreadable has no sections."""
    if not document or not document.strip():
        return []
    try:
        got = json.loads(document)
    except ValueError:
        return []
    return [(k, v) for k, v in got.items() if isinstance(v, str)] if isinstance(got, dict) else []


def split_items(items: DataFrame, max_len: int = MAX_LEN, overlap: int = OVERLAP, with_text: bool = True, distinct: bool = False) -> DataFrame:
    """Pieces of ``items(field, item_id, kind, body)``; kind 'json' means that body is an object of section texts.

    Returns ``field, item_id, section, piece, pieces, start, end, n_chars`` and, unless ``with_text`` is off,
    ``text``.  Everything happens inside the scan's own tasks: no shuffle, a batch of rows in memory at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in names}
            size = 0
            for field, item, kind, body in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if body is None:
                    continue
                for section, text in sections_of(body) if kind == "json" else [("", body)]:
                    spans = cut(text, max_len, overlap)
                    for k, (a, b) in enumerate(spans, 1):
                        row = (field, item, section, k, len(spans), a, b, len(text), text[a:b])
                        for name, value in zip(names, row):
                            out[name].append(value)
                        size += b - a
                if size > 4_000_000:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)
                    out, size = {k: [] for k in names}, 0
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    fields = [
        ("field", pa.string()), ("item_id", pa.string()), ("section", pa.string()), ("piece", pa.int32()),
        ("pieces", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("n_chars", pa.int32()),
    ]
    if with_text:
        fields.append(("text", pa.string()))
    schema = pa.schema(fields)
    names = schema.names
    ddl = "field string, item_id string, section string, piece int, pieces int, start int, end int, n_chars int" + ", text string" * with_text
    got = items.select("field", F.col("item_id").cast("string"), "kind", "body").mapInArrow(run, ddl)
    return got.distinct() if distinct else got


def wiki_items(wiki_text: DataFrame, wiki_chunks: DataFrame) -> DataFrame:
    """Everything of the wiki tables that may have to be cut, one row per stored text or section object."""

    def part(df: DataFrame, field: str, key: str, column: str, kind: str) -> DataFrame:
        return df.select(F.lit(field).alias("field"), F.col(key).alias("item_id"), F.lit(kind).alias("kind"), F.col(column).alias("body"))

    return (
        part(wiki_text, "full_text", "page_id", "full_text", "text")
        .unionByName(part(wiki_text, "sections", "page_id", "sections", "json"))
        .unionByName(part(wiki_chunks, "chunk_text", "chunk_id", "chunk_text", "text"))
    )


def oversized(pieces: DataFrame) -> DataFrame:
    """Items that had to be cut, each once."""
    return pieces.filter((F.col("pieces") > 1) & (F.col("piece") == 1)).select("field", "item_id", "section").distinct()
