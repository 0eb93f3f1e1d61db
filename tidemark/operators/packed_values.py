"""Several values packed in one field: one row per value, position kept.

Segmentation is guided by a dictionary of whole values that contain delimiters ("Nets, Hooks and Sails Guild").  A
multi-pattern automaton (Aho-Corasick) finds all of them in a field in one pass; dynamic programming over the field's
delimiter positions then picks the cheapest cover of the field by known whole values and by pieces without delimiters.
A delimiter inside quotation marks, balanced parentheses or a digit group never separates.

The dictionary is learned from all rows: a value that somewhere stands in quotation marks is a whole value; a table of
known values can be added.  A dictionary of at most ``MOST`` values and ``MOST_CHARS`` characters is one automaton that
every task gets.  A larger one is parted by the hash of the values' heads (the text up to the first delimiter), with one
automaton per part; a text goes to the parts of its own pieces' heads, once each, so every row is read once, whatever the
size of the dictionary.  A part is spread over ``SPREAD`` tasks, as one head may stand in a third of all texts.

Defined results: null or blank fields give no row; empty values are left out of the count; a quotation mark or a
parenthesis that never closes is an ordinary character; equal rows give equal values again; other columns of the input
may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Bounds of a dictionary that is sent to every task; beyond either it is parted.
MOST, MOST_CHARS = 100_000, 5_000_000
#: Values per part, and tasks that share a part.
SHARD, SPREAD = 50_000, 8
#: Cost of a known whole value and of an unknown piece in a cover.
KNOWN, UNKNOWN = 0.5, 1.0

_OPEN, _CLOSE = "(（", ")）"
_QUOTES = {'"': '"', "“": "”"}
#: White space before a mark is taken from its start, so a long run of it is read once.
_MARK = re.compile(r"(?<!\s)\s*\[\d+\]")
_REMARK = re.compile(r"(?<!\s)\s*[（(][^()（）]*(?:[（(][^()（）]*[)）][^()（）]*)*[)）]\s*$")


def _closing_quote(text: str, at: int) -> int:
    """Index of the mark that closes the one at ``at``, or -1; a doubled mark is a literal one."""
    close = _QUOTES[text[at]]
    k = text.find(close, at + 1)
    while k >= 0 and close == '"' and text[k + 1 : k + 2] == '"':
        k = text.find(close, k + 2)
    return k


def _closings(text: str) -> dict[int, int]:
    """Index of the closing mark of every parenthesis that is closed."""
    out, open_ = {}, []
    for m in re.finditer(r"[(（)）]", text):
        if m.group() in _OPEN:
            open_.append(m.start())
        elif open_:
            out[open_.pop()] = m.start()
    return out


def delimiters(text: str) -> list[tuple[int, int]]:
    """Spans of the delimiters that may separate values."""
    out, k, fresh, closed = [], 0, True, _closings(text)
    last = {q: text.rfind(close) for q, close in _QUOTES.items()}
    while k < len(text):
        c = text[k]
        if c in _QUOTES and fresh and last[c] > k and (end := _closing_quote(text, k)) > 0:
            k, fresh = end + 1, False
            continue
        if c in _OPEN and (end := closed.get(k, 0)) > 0:
            k, fresh = end + 1, False
            continue
        grouped = c == "," and k and text[k - 1].isdigit() and text[k + 1 : k + 4].isdigit() and len(text[k + 1 : k + 4]) == 3 and not text[k + 4 : k + 5].isdigit()
        slash = c in "/／" and not (text[k - 1 : k].isspace() or text[k + 1 : k + 2].isspace() or k in (0, len(text) - 1))
        if c in ";,|•、；\n\r/／，｜" and not grouped and not slash:
            out.append((k, k + 1))
            fresh = True
        elif not c.isspace():
            fresh = False
        k += 1
    return out


def clean(piece: str) -> str:
    """The value as written: no outer white space, reference marks or enclosing quotation marks."""
    piece = _MARK.sub("", piece).strip()
    if len(piece) > 1 and piece[0] in _QUOTES and _closing_quote(piece, 0) == len(piece) - 1:
        piece = piece[1:-1].replace('""', '"').strip()
    return piece


def quoted_values(text: str) -> list[str]:
    """Whole values that stand in quotation marks and hold something that looks like a delimiter; remarks removed."""
    stops = delimiters(text)
    out = []
    for a, b in zip([0, *[e for _, e in stops]], [*[s for s, _ in stops], len(text)]):
        raw = _MARK.sub("", text[a:b]).strip()
        if len(raw) > 2 and raw[0] in _QUOTES:
            value = clean(raw)
            while (cut := _REMARK.sub("", value)) != value and cut:
                value = cut
            if value and delimiters(value):
                out.append(value)
    return out


def cover(text: str, known: list[tuple[int, int]]) -> list[str]:
    """Values of ``text``; ``known`` holds the spans of dictionary values found in it."""
    stops = delimiters(text)
    if not stops:
        v = clean(text)
        return [v] if v else []
    starts, ends = [0, *[e for _, e in stops]], [*[s for s, _ in stops], len(text)]
    first = {a + len(text[a:b]) - len(text[a:b].lstrip()): i for i, (a, b) in enumerate(zip(starts, ends))}
    jumps: dict[int, set[int]] = {}
    for a, b in known:
        if a in first:
            i = first[a]
            # The piece in which the known value ends must hold nothing else but remarks.
            for j in range(i + 1, len(ends)):
                if starts[j] < b <= ends[j]:
                    rest = _MARK.sub("", text[b : ends[j]])
                    while (cut := _REMARK.sub("", rest)) != rest:
                        rest = cut
                    if not rest.strip():
                        jumps.setdefault(i, set()).add(j)
    best, back = [0.0, *[float("inf")] * len(starts)], [0] * (len(starts) + 1)
    for i in range(len(starts)):
        for j, cost in [(i, UNKNOWN), *[(j, KNOWN) for j in jumps.get(i, ())]]:
            if best[i] + cost < best[j + 1]:
                best[j + 1], back[j + 1] = best[i] + cost, i
    pieces, at = [], len(starts)
    while at:
        pieces.append(text[starts[back[at]] : ends[at - 1]])
        at = back[at]
    return [v for v in map(clean, reversed(pieces)) if v]


def whole_values(fields: DataFrame) -> DataFrame:
    """Distinct dictionary values of ``fields(text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {v for t in batch.column(0).to_pylist() for v in quoted_values(t)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["value"])

    return fields.filter(F.col("text").rlike('["“]')).select("text").mapInArrow(run, "value string").distinct()


def unpack(fields: DataFrame, dictionary: DataFrame | None = None, most: int = MOST, shard: int = SHARD) -> DataFrame:
    """``field, rec_id, pos, item, n_items`` for ``fields(field, rec_id, text)``; ``dictionary(value)`` adds known values."""
    fields = fields.select("field", F.col("rec_id").cast("long"), "text").filter(F.col("text").isNotNull())
    values = whole_values(fields)
    if dictionary is not None:
        values = values.unionByName(dictionary.select("value").filter(F.trim("value") != "")).distinct()
    values = materialize(values, "dictionary")
    n, chars = values.agg(F.count("*"), F.coalesce(F.sum(F.length("value")), F.lit(0))).first()
    if n <= most and chars <= MOST_CHARS:
        words = fields.sparkSession.sparkContext.broadcast(sorted(r["value"] for r in values.collect()))
        return fields.mapInArrow(_cover_with(lambda: _automaton(words.value)), _OUT)
    spans = _spans(fields.select("text").distinct(), values, max(1, -(-n // shard)))
    # A text that many rows bear: its spans meet them on several tasks.
    spread = F.pmod(F.xxhash64("rec_id"), F.lit(SPREAD)).cast("int")
    known = spans.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return fields.withColumn("_s", spread).join(known, ["text", "_s"], "left").select("field", "rec_id", "text", "known").mapInArrow(_cover_with(None), _OUT)


_OUT = "field string, rec_id long, pos int, item string, n_items int"


def _automaton(words: list[str]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for w in words:
        automaton.add_word(w, len(w))
    if words:
        automaton.make_automaton()
    return automaton if words else None


def _found(automaton, text: str) -> list[tuple[int, int]]:
    return [(end + 1 - n, end + 1) for end, n in automaton.iter(text)] if automaton is not None else []


def _cover_with(automaton):
    """Covers of (field, rec_id, text); known spans come from the automaton, or else from a fourth column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = automaton() if automaton else None
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            given = None if automaton else batch.column(3).to_pylist()
            for k, (field, rec, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                items = cover(text, _found(search, text) if automaton else [(x["a"], x["b"]) for x in given[k] or ()])
                for pos, item in enumerate(items, 1):
                    for o, v in zip(out, (field, rec, pos, item, len(items))):
                        o.append(v)
            types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], ["field", "rec_id", "pos", "item", "n_items"])

    return run


def heads(text: str) -> list[str]:
    """The pieces between delimiters, without outer white space."""
    stops = delimiters(text)
    return [text[a:b].strip() for a, b in zip([0, *[e for _, e in stops]], [*[s for s, _ in stops], len(text)])]


def _spans(texts: DataFrame, values: DataFrame, parts: int) -> DataFrame:
    """``text, known``: where values of a dictionary in ``parts`` parts stand in the distinct ``texts(text)``."""

    def keyed(pick):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                whole = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pick(t) for t in whole], pa.list_(pa.string()))], ["word", "heads"])

        return run

    part = F.pmod(F.xxhash64("head"), F.lit(parts)).cast("int").alias("part")
    mine = F.pmod(F.xxhash64("word"), F.lit(SPREAD)).cast("int").alias("spread")
    rows = texts.select("text").mapInArrow(keyed(lambda t: sorted(set(heads(t)))), "word string, heads array<string>")
    rows = rows.select("word", F.explode("heads").alias("head")).select(part, mine, F.lit(1).alias("kind"), "word").distinct()
    dictionary = values.mapInArrow(keyed(lambda t: heads(t)[:1]), "word string, heads array<string>")
    dictionary = dictionary.select("word", F.explode("heads").alias("head")).select(part, F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("spread"), F.lit(0).alias("kind"), "word")
    sent = dictionary.unionByName(rows).repartition("part", "spread").sortWithinPartitions("part", "spread", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, words, automaton = None, [], None
        for batch in batches:
            texts_, known = [], []
            for p, s, kind, word in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if (p, s) != at:
                    at, words, automaton = (p, s), [], None
                if not kind:
                    words.append(word)
                    continue
                if words:
                    automaton, words = _automaton(words), []
                found = _found(automaton, word)
                if found:
                    texts_.append(word)
                    known.append([{"a": a, "b": b} for a, b in found])
            yield pa.RecordBatch.from_arrays([pa.array(texts_, pa.string()), pa.array(known, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], ["text", "known"])

    got = sent.mapInArrow(run, "text string, known array<struct<a: int, b: int>>")
    return got.groupBy("text").agg(F.flatten(F.collect_list("known")).alias("known"))


def packed_fields(detail: DataFrame, affiliation: DataFrame) -> DataFrame:
    """The packed fields of the raw records and of the parsed affiliation rows."""
    part = lambda df, field, key, col: df.select(F.lit(field).alias("field"), F.col(key).cast("long").alias("rec_id"), F.col(col).alias("text"))
    return (
        part(detail, "affiliation", "rec_id", "affiliation")
        .unionByName(part(detail, "occupation", "rec_id", "occupation"))
        .unionByName(part(affiliation, "group_name", "aff_id", "group_name"))
    )
