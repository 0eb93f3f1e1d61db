"""Scans of scraped files: JSON arrays with loose element types, CSV lists, stored pages, small configuration files.

Readers are lazy and schema-first. Rows that break a rule are not dropped silently: each loader returns valid rows, and
``rejected`` gives the others.
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.functions.wikitext import info_box_udf, sections_udf
from tidemark.operators import scoring
from tidemark.operators.merging import latest, resolve_aliases

_CHAPTER = "chapter_number string, title string, japanese_title string, volume string, pages string, release_date string, jump_info string, characters array<string>"
_ARC = "arc_id string, saga_id string, title string, japanese_title string, romanized_title string, start_chapter int, end_chapter int, description string"
_MEMBER = "name string, url string, note string, full_text string"


def json_array(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A JSON array file with the given schema; nested values of loose type are read as JSON text."""
    return spark.read.schema(ddl).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def chapters(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(chapter rows, appearance rows). An element of ``characters`` is an object with name and note, or a plain name.

    Chapters without a readable number are left out; a bad volume is null.
    """
    raw = json_array(spark, path, _CHAPTER).withColumn("number", F.col("chapter_number").try_cast("int")).filter(F.col("number").isNotNull())
    rows = raw.select("number", F.col("volume").try_cast("int").alias("volume"), "title", scalars.page_count(F.col("pages")).alias("num_page"), scalars.long_date(F.col("release_date")).alias("date"), F.col("jump_info").alias("jump"))
    each = raw.select(F.col("number").alias("chapter"), F.explode("characters").alias("c"))
    obj = F.when(F.col("c").startswith("{"), F.from_json("c", _MEMBER))
    name = F.coalesce(obj["name"], F.when(~F.col("c").startswith("{"), F.col("c")))
    cast_ = each.select("chapter", scalars.to_id(name).alias("character"), F.nullif(obj["note"], F.lit("")).alias("note")).filter(~scalars.blank(F.col("character")))
    return rows, cast_


def volumes(spark: SparkSession, path: str) -> DataFrame:
    """Volume rows; an element without a readable number is left out."""
    raw = json_array(spark, path, "volume_number string, english_title string, japanese_title string")
    return raw.select(F.col("volume_number").try_cast("int").alias("number"), F.col("english_title").alias("title"), "japanese_title").filter(F.col("number").isNotNull())


_RECORD = "id string, name string, ename string, origin string, status string, birth string, `blood type` string, blood_type string, bounty string, age string, occupation string, is_likely_character boolean"


def character_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the list of persons, every field normalized; a value may be a text or a list of texts.

    Of a list the first text counts for a plain field; money, ages and blood types read its texts as lines. A record is a
    person unless it says otherwise, and it is 'success' if it states anything besides its id.
    """
    raw = json_array(spark, path, _RECORD)
    listed = lambda c: F.from_json(F.when(F.col(c).startswith("["), F.col(c)), "array<string>")
    first = lambda c: F.coalesce(scalars.first_of(listed(c)), F.when(~F.col(c).startswith("["), F.col(c)))
    lines = lambda c: F.coalesce(F.array_join(listed(c), "\n"), F.col(c))
    raw = raw.withColumn("_blood", F.coalesce(lines("`blood type`"), lines("blood_type")))
    stated = ["name", "origin", "status", "birth", "_blood", "bounty", "age"]
    fields = {c: first(c) for c in ("origin", "status", "birth", "occupation")}
    some = reduce(lambda a, b: a | b, [~scalars.blank(F.col(c)) for c in stated])
    return raw.select(
        "id", scalars.name_of(first("name"), first("ename"), F.col("id")).alias("name"), *[v.alias(c) for c, v in fields.items() if c != "occupation"],
        scalars.blood_types(F.col("_blood")).alias("blood_type"), scalars.blood_group(F.col("_blood")).alias("blood_type_group"),
        scalars.money_text(lines("bounty")).alias("bounties"), scalars.first_money(lines("bounty"), F.col("id")).alias("bounty"), scalars.highest_age(lines("age")).alias("age"), fields["occupation"].alias("occupation"),
        F.coalesce("is_likely_character", F.lit(True)).alias("is_likely_character"), F.when(some, "success").otherwise("failed_unknown").alias("scraping_status"),
    )


def covers(spark: SparkSession, path: str) -> DataFrame:
    """Cover rows of a volume file: the slug if there is one, else the name; blank ones are left out, repeats stay."""
    v = json_array(spark, path, "volume_number int, english_title string, japanese_title string, cover_characters array<struct<name: string, slug: string>>")
    c = v.select(F.col("volume_number").alias("volume"), F.explode("cover_characters").alias("c"))
    return c.select("volume", F.coalesce(F.when(~scalars.blank(F.col("c.slug")), F.col("c.slug")), scalars.to_id(F.col("c.name"))).alias("character")).filter(~scalars.blank(F.col("character")))


def _fine_range() -> Column:
    return (F.col("start_chapter") > 0) & (F.col("end_chapter") >= F.col("start_chapter")) & ~scalars.blank(F.col("title"))


def story_ranges(spark: SparkSession, path: str, chapter: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) arcs or sagas; with ``chapter(number)`` both ends must exist there."""
    raw = json_array(spark, path, _ARC)
    ok = raw.withColumn("_ok", F.coalesce(_fine_range(), F.lit(False)))
    if chapter is not None:
        for c in ("start_chapter", "end_chapter"):
            have = chapter.select(F.col("number").alias(c)).distinct().withColumn(f"_{c}", F.lit(True))
            ok = ok.join(have, c, "left").withColumn("_ok", F.col("_ok") & F.coalesce(f"_{c}", F.lit(False))).drop(f"_{c}")
    return ok.filter("_ok").drop("_ok").select(*raw.columns), ok.filter("not _ok").drop("_ok").select(*raw.columns)


def character_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, name string, url string").option("header", True).csv(path)


def unwrap_objects(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """``[{id: {...}}, ...]`` as rows of id and fields."""
    text = spark.read.text(path, wholetext=True)
    items = text.select(F.explode(F.from_json("value", "array<map<string, string>>")).alias("m")).select(F.explode("m").alias("id", "body"))
    return items.select("id", F.from_json("body", ddl).alias("b")).select("id", "b.*")


def alias_map(path: str) -> dict[str, str]:
    """A flat JSON object; a missing file is an empty map."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def weights(path: str) -> tuple[dict[str, float], float]:
    """Signal weights and the arc threshold from a flat 'name: number' file, checked."""
    got, threshold = {}, 0.5
    with open(path, encoding="utf-8") as f:
        for line in f:
            m = re.match(r"\s*([A-Za-z_]+)\s*:\s*([0-9.]+)\s*(?:#.*)?$", line)
            if m and m.group(1).endswith("threshold"):
                threshold = float(m.group(2))
            elif m:
                got[m.group(1)] = float(m.group(2))
    scoring.check_weights(got, threshold)
    return got, threshold


def info_boxes(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row per page and field of its info box."""
    return pages.select(id_col, F.explode(info_box_udf(html_col)).alias("field", "value"))


_ROW = re.compile(r"<tr[^>]*>(.*?)</tr>", re.S)


def volume_tables(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """``id_col, volume, title, japanese_title, cover``: tables named Volume_N, titles in rows 2 and 3, covers as list."""
    from tidemark.functions.wikitext import clean

    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for ident, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for m in re.finditer(r'<table[^>]*id="Volume_(\d+)"[^>]*>(.*?)</table>', page or "", re.S):
                    rows = _ROW.findall(m.group(2))
                    text = [" ".join(clean(r).split()) for r in rows]
                    cover = [clean(x) for x in re.findall(r"<li[^>]*>(.*?)</li>", m.group(2), re.S)]
                    values = (ident, int(m.group(1)), text[1] if len(text) > 1 else None, text[2] if len(text) > 2 else None, cover)
                    for o, v in zip(out, values):
                        o.append(v)
            types = (batch.schema.field(0).type, pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], [id_col, "volume", "title", "japanese_title", "cover"])

    return pages.select(id_col, html_col).mapInArrow(run, f"`{id_col}` {kind}, volume int, title string, japanese_title string, cover array<string>")


def arc_list(pages: DataFrame, id_col: str, html_col: str, last_chapter: int) -> DataFrame:
    """``id_col, arc_id, title, start, end`` of h4 headings that a list item with chapters follows."""
    blocks = F.regexp_extract_all(html_col, F.lit(r"(?s)<h4[^>]*>.*?(?=<h4|$)"), 0)
    b = pages.select(id_col, F.explode(blocks).alias("b"))
    title = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("b", r"(?s)<h4[^>]*>(.*?)</h4>", 1), r"<[^>]+>", ""), r"\[edit\]|\s+Arc$", ""))
    item = F.regexp_replace(F.regexp_extract("b", r"(?is)<li[^>]*>([^<]*(?:<[^/][^>]*>)?\s*chapters.*?)</li>", 1), r"<[^>]+>", "")
    start, end = scalars.chapter_range(item, last_chapter)
    return b.select(id_col, scalars.slug(title).alias("arc_id"), title.alias("title"), start.alias("start"), end.alias("end")).filter(F.col("start").isNotNull())


def fetch_pages(titles: DataFrame, fetch, batch: int = 50, streams: int = 4) -> DataFrame:
    """``title, text`` through ``fetch(list of titles) -> dict``, up to ``batch`` titles a call, ``streams`` at a time.

    The engine itself opens no connection; the caller brings ``fetch`` with its own pacing and retries.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column(0).to_pylist()
            for k in range(0, len(names), batch):
                got = fetch(names[k : k + batch])
                yield pa.RecordBatch.from_arrays([pa.array(names[k : k + batch]), pa.array([got.get(n) for n in names[k : k + batch]], pa.string())], ["title", "text"])

    return titles.select("title").repartition(streams).mapInArrow(run, "title string, text string")


def dated_csv(spark: SparkSession, path: str, ddl: str, dates: dict[str, str]) -> DataFrame:
    """A CSV with header and the columns of ``ddl``; ``dates`` gives the pattern of each date column. "NA" stays a text,
    only an empty field is null, and a date that cannot be read is null."""
    raw = spark.read.option("header", True).option("nullValue", "").schema(ddl).csv(path)
    return raw.withColumns({c: F.to_date(F.try_to_timestamp(F.col(c), F.lit(p))) for c, p in dates.items()})


#: Fields of a chapter page's information box, by the names that the page gives them.
CHAPTER_FIELDS = {"vol": "volume", "chapter": "chapter_display", "page": "pages", "date2": "release_date", "jump": "jump_info"}


def chapter_facts(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the fields of a chapter page's information box in place of the column ``html``."""
    got = pages.withColumn("_box", info_box_udf(html))
    fields = [F.trim(F.regexp_replace(F.col("_box")[k], r"\[ref\]", "")).alias(v) for k, v in CHAPTER_FIELDS.items()]
    return got.select(*[c for c in pages.columns if c != html], *fields)


def typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header whose column types are found from its values."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def paced(fetch, per_second: float = 1.0, tries: int = 3, wait: float = 1.0, sleep=time.sleep, clock=time.monotonic):
    """``fetch`` at most ``per_second`` times a second, tried again up to ``tries`` times in all when it fails; the wait
    doubles from try to try. The last failure is raised. Each task that gets the function keeps its own pace."""
    last = [-float("inf")]

    def call(*arguments):
        for k in range(tries):
            ahead = last[0] + 1 / per_second - clock()
            if ahead > 0:
                sleep(ahead)
            last[0] = clock()
            try:
                return fetch(*arguments)
            except Exception:
                if k == tries - 1:
                    raise
                sleep(wait * 2**k)

    return call


def follow(get, most: int = 10_000):
    """Answers of ``get(token)`` from the first (token None) on, as long as each names a next one under 'continue'.

    A token that comes again ends it, and so do ``most`` answers.
    """
    token, met = None, set()
    for _ in range(most):
        answer = get(token)
        yield answer
        token = answer.get("continue")
        if token is None or token in met:
            return
        met.add(token)


def category_members(get) -> dict[str, set[str]]:
    """Names by category over all answers of ``get(token) -> {'members': [(category, name)], 'redirects': {from: to},
    'continue': token}``; names are followed through redirects, whose cycles end at their least name."""
    members: list[tuple[str, str]] = []
    moved: dict[str, str] = {}
    for answer in follow(get):
        members += answer.get("members", [])
        moved |= answer.get("redirects", {})
    ends = resolve_aliases(moved)
    out: dict[str, set[str]] = {}
    for category, name in members:
        out.setdefault(category, set()).add(ends.get(name, name))
    return out


def crawl(titles: DataFrame, fetch, batch: int = 50, streams: int = 4) -> DataFrame:
    """``page_id, intro_text, full_text, sections`` of the pages of ``titles(title)``, fetched, cleaned and cut into
    sections (a JSON object of name and text); pages that are not there are left out."""
    got = fetch_pages(titles, fetch, batch, streams).filter(F.col("text").isNotNull())
    cut = got.select(F.col("title").alias("page_id"), sections_udf("text").alias("s"))
    pairs = F.filter("s", lambda x: x["name"] != "intro")
    intro = F.get(F.transform(F.filter("s", lambda x: x["name"] == "intro"), lambda x: x["text"]), F.lit(0))
    whole = F.array_join(F.transform("s", lambda x: x["text"]), "\n\n")
    sections = F.to_json(F.map_from_entries(F.transform(pairs, lambda x: F.struct(x["name"], x["text"]))))
    return cut.select("page_id", intro.alias("intro_text"), whole.alias("full_text"), sections.alias("sections"))


def unique_members(cast: DataFrame, key: str, order: list[Column], name: str) -> DataFrame:
    """One row per ``key``, the last by ``order``, sorted by ``name``: the list of all that a set of chapters names."""
    return latest(cast.filter(~scalars.blank(F.col(key))), [key], order).orderBy(name, key)
