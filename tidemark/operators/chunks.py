"""Page chunks by fixed windows, and entity names found in texts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merging import read_sections
from tidemark.session import materialize

MAX_LEN, STEP, SHORT = 3200, 2800, 50
#: Names and their characters up to which one automaton goes to every task; tasks that share the names of a word.
MOST, MOST_CHARS, SPREAD = 100_000, 5_000_000, 8


def fixed_windows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col, part, chunk``: windows of ``MAX_LEN`` every ``STEP`` characters; null and empty texts have none."""
    text = F.col(text_col)
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - (MAX_LEN - STEP)) / STEP) - 1).cast("int")
    got = df.filter(F.coalesce(text, F.lit("")) != "").select(id_col, text_col, F.explode(F.sequence(F.lit(0), last)).alias("part"))
    return got.select(id_col, "part", text.substr(F.col("part") * STEP + 1, F.lit(MAX_LEN)).alias("chunk"))


def fold_sections(sections: list[tuple[str, str]], short: int = SHORT) -> list[tuple[str, str]]:
    """Sections in order; one that is shorter than ``short`` runs on into the next and gives it its name."""
    out, name, held = [], None, ""
    for title, text in sections:
        text = text.strip()
        if not text:
            continue
        name = title if name is None else name
        held = f"{held}\n{text}" if held else text
        if len(held) >= short:
            out.append((name, held))
            name, held = None, ""
    if held:
        out.append((name, held))
    return out


def page_chunks(pages: DataFrame) -> DataFrame:
    """``chunk_id, page_id, section_name, chunk_text`` of ``pages(page_id, sections)`` in either shape; unreadable JSON has
    no chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for page, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for name, text in fold_sections(read_sections(raw)):
                    n = max(1, -(-(len(text) - (MAX_LEN - STEP)) // STEP))
                    for i in range(n):
                        ident = f"{page}::{name}" + (f"::part_{i + 1}" if n > 1 else "")
                        for o, v in zip(out, (ident, page, name, text[i * STEP : i * STEP + MAX_LEN])):
                            o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.string()) for o in out], ["chunk_id", "page_id", "section_name", "chunk_text"])

    return pages.select("page_id", "sections").mapInArrow(run, "chunk_id string, page_id string, section_name string, chunk_text string")


def link_names(texts: DataFrame, names: DataFrame, most: int = MOST) -> DataFrame:
    """``doc_id, id``: which of ``names(id, name)`` stand in ``texts(doc_id, text)`` as whole words, case aside.

    An id may have several names and a name several ids; each counts, also where names overlap.  Up to ``most`` names
    (and ``MOST_CHARS`` characters) are one automaton that every task gets.  More are met by words: a name is looked for
    only in texts that hold its longest word, so the texts are read once, however many names there are; names without
    any letter or digit, which have no word, are looked for everywhere, in automata of at most ``most``.
    """
    folded = names.select("id", F.lower(F.trim("name")).alias("name")).filter(F.length("name") >= 2).distinct()
    texts = texts.select("doc_id", "text").filter(F.col("text").isNotNull())
    n, chars = folded.agg(F.count("*"), F.coalesce(F.sum(F.length("name")), F.lit(0))).first()
    if n <= most and chars <= MOST_CHARS:
        return _everywhere(texts, folded, 1).distinct()
    keyed = folded.mapInArrow(_longest_word, "id int, name string, word string")
    keyed = materialize(keyed, "names")
    bare = keyed.filter(F.col("word").isNull()).select("id", "name")
    out = _everywhere(texts, bare, max(1, -(-bare.count() // max(1, most))))
    # A word that very many texts hold meets its names on several tasks.
    words = texts.mapInArrow(_words, "doc_id long, words array<string>").select("doc_id", F.explode("words").alias("word"), F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)).cast("int").alias("s"))
    wanted = keyed.filter(F.col("word").isNotNull()).select("word", "name").distinct().withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    met = materialize(words.join(wanted, ["word", "s"]).select("doc_id", "word", "name"), "met")
    alone = met.filter(F.col("word") == F.col("name")).select("doc_id", "name")
    asked = met.filter(F.col("word") != F.col("name")).groupBy("doc_id").agg(F.collect_set("name").alias("names"))
    seen = texts.join(asked, "doc_id").mapInArrow(_verify, "doc_id long, name string")
    hits = alone.unionByName(seen).distinct()
    return out.unionByName(hits.join(folded, "name").select("doc_id", "id")).distinct()


def _everywhere(texts: DataFrame, names: DataFrame, shards: int) -> DataFrame:
    sc = texts.sparkSession.sparkContext
    parts = []
    for s in range(shards):
        rows = names.filter(F.pmod(F.xxhash64("name", "id"), F.lit(shards)) == s).toArrow().to_pydict()
        parts.append(texts.mapInArrow(_find(sc.broadcast(list(zip(rows["name"], rows["id"])))), "doc_id long, id int"))
    return reduce(lambda a, b: a.unionByName(b), parts)


_WORD = re.compile(r"\w+")


def _longest_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [max(_WORD.findall(n), key=len, default=None) for n in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(words, pa.string())], ["id", "name", "word"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [sorted(set(_WORD.findall(t.lower()))) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["doc_id", "words"])


def _stands(name: str, low: str) -> bool:
    """Whether ``name`` stands in ``low`` with no word character at either side."""
    at = low.find(name)
    while at >= 0:
        end = at + len(name)
        if not (at and _WORD.match(low[at - 1])) and not (end < len(low) and _WORD.match(low[end])):
            return True
        at = low.find(name, at + 1)
    return False


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, found = [], []
        for doc, text, names in zip(*(batch.column(c).to_pylist() for c in range(3))):
            low = text.lower()
            got = [n for n in names if _stands(n, low)]
            docs += [doc] * len(got)
            found += got
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(found, pa.string())], ["doc_id", "name"])


def _find(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        owners: dict[str, list[int]] = {}
        for name, ident in words.value:
            owners.setdefault(name, []).append(ident)
        automaton = ahocorasick.Automaton()
        for name, idents in owners.items():
            automaton.add_word(name, (len(name), idents))
        if owners:
            automaton.make_automaton()
        edge = re.compile(r"\w")
        for batch in batches:
            docs, ids = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low, found = text.lower(), set()
                for end, (n, idents) in automaton.iter(low) if owners else ():
                    a = end + 1 - n
                    if (a and edge.match(low[a - 1])) or (end + 1 < len(low) and edge.match(low[end + 1])):
                        continue
                    found.update(idents)
                docs.extend([doc] * len(found))
                ids.extend(found)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ids, pa.int32())], ["doc_id", "id"])

    return run
