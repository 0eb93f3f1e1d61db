"""Keyed state: upserts, insert-if-absent, alias merges and versioned snapshots over immutable tables."""

from __future__ import annotations

import difflib
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import discard, materialize


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``. Spark limits each map task to one row per key before the shuffle."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") == 1).drop("_r")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key. Null keys match nothing."""
    return old.join(new.select(*keys), keys, "left_anti").select(*old.columns).unionByName(new, allowMissingColumns=True)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``old`` are added; of equal keys in ``new`` one stays."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def resolve_aliases(mapping: dict[str, str]) -> dict[str, str]:
    """Chains of a small mapping followed to their end; a name in a cycle goes to the least name of the cycle."""
    out = {}
    for alias in mapping:
        seen, at = [alias], mapping[alias]
        while at in mapping and at not in seen:
            seen.append(at)
            at = mapping[at]
        out[alias] = min(seen[seen.index(at) :]) if at in seen else at
    return {a: c for a, c in out.items() if a != c}


def resolve_chains(aliases: DataFrame) -> DataFrame:
    """``alias, canonical`` with chains of ``aliases(alias, canonical)`` followed to their end, as a table.

    Each round doubles the step and is written to the shared folder, so there are at most log n of them.  Of several
    targets of an alias the least counts; an alias in a cycle, or that leads into one, goes to the least name of the
    cycle.  Nulls and loops lead nowhere.
    """
    stated = aliases.filter(F.col("alias").isNotNull() & F.col("canonical").isNotNull() & (F.col("alias") != F.col("canonical")))
    edges = stated.groupBy("alias").agg(F.min("canonical").alias("to"))
    at = materialize(edges.withColumn("least", F.col("to")), "chains")
    for _ in range(at.count().bit_length()):
        far = at.select(F.col("alias").alias("to"), F.col("to").alias("_to"), F.col("least").alias("_least"))
        step = at.join(far, "to", "left").select("alias", F.coalesce("_to", "to").alias("to"), F.least("least", F.coalesce("_least", "least")).alias("least"))
        step = materialize(step, "chains")
        discard(at)
        at = step
    # What still points to an alias has come to a cycle, all of which the alias it points to has seen.
    on = at.select(F.col("alias").alias("to"), F.col("least").alias("_cycle"))
    return at.join(on, "to", "left").select("alias", F.coalesce("_cycle", "to").alias("canonical")).filter(F.col("alias") != F.col("canonical"))


def merge_aliases(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """``df`` with ``column`` mapped through ``aliases(alias, canonical)``; rows that become equal collapse."""
    a = aliases.select(F.col("alias").alias("_a"), F.col("canonical").alias("_c"))
    return df.join(a, F.col(column) == F.col("_a"), "left").withColumn(column, F.coalesce("_c", column)).select(*df.columns).distinct()


def set_column(df: DataFrame, column: str, values: DataFrame, key: str, only_null: bool = False) -> DataFrame:
    """``df`` with ``column`` set from ``values(key, column)``, one row per key; the column is added if it is missing.

    Rows without a value keep what they have; with ``only_null`` only rows whose column is null are set.
    """
    new = values.select(F.col(key).alias("_key"), F.col(column).alias("_new"))
    got = df.join(new, F.col(key) == F.col("_key"), "left")
    if column not in df.columns:
        return got.withColumn(column, F.col("_new")).select(*df.columns, column)
    order = (F.col(column), F.col("_new")) if only_null else (F.col("_new"), F.col(column))
    return got.withColumn(column, F.coalesce(*order)).select(*df.columns)


def classify_changes(old: DataFrame, new: DataFrame, keys: list[str], text: str, hash_: str, similar: Column | None = None) -> DataFrame:
    """Each key of either side with what happens to it.

    'inserted' (new key), 'touched' (same hash, or ``similar`` over columns old_text and new_text), 'superseded' (the old
    version closes, a new one opens), 'untouched' (key not delivered; its version stays open).
    """
    o = old.select(*keys, F.col(text).alias("old_text"), F.col(hash_).alias("old_hash"))
    n = new.select(*keys, F.col(text).alias("new_text"), F.col(hash_).alias("new_hash"))
    alike = F.col("old_hash") == F.col("new_hash")
    if similar is not None:
        alike = alike | similar
    what = F.when(F.col("old_hash").isNull(), "inserted").when(F.col("new_hash").isNull(), "untouched").when(alike, "touched").otherwise("superseded")
    return o.join(n, keys, "full").withColumn("change", what)


def apply_changes(open_versions: DataFrame, changes: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """Versions after a delivery: ``first_seen, last_seen, superseded_at`` move as the change says."""
    c = changes.select(*keys, "change", "new_text", "new_hash")
    old = open_versions.join(c.select(*keys, "change"), keys, "left")
    old = old.withColumn("last_seen", F.when(F.col("change") == "touched", now).otherwise(F.col("last_seen")))
    old = old.withColumn("superseded_at", F.when(F.col("change") == "superseded", now).otherwise(F.col("superseded_at"))).drop("change")
    fresh = c.filter(F.col("change").isin("inserted", "superseded")).select(*keys, F.col("new_text").alias("text"), F.col("new_hash").alias("hash"), now.alias("first_seen"), now.alias("last_seen"), F.lit(None).cast("timestamp").alias("superseded_at"))
    return old.unionByName(fresh)


def membership_flags(df: DataFrame, key: str, members: dict[str, DataFrame]) -> DataFrame:
    """``df`` with a boolean column per named list: whether ``key`` is among the ids (column ``id``) of that list."""
    for name, ids in members.items():
        flag = ids.select(F.col("id").alias("_id")).distinct().withColumn("_in", F.lit(True))
        df = df.join(flag, F.col(key) == F.col("_id"), "left").withColumn(name, F.coalesce("_in", F.lit(False))).drop("_id", "_in")
    return df


def ratio(a: str | None, b: str | None, least: float = 0.95, lengths: float = 0.8) -> float:
    """Matching-blocks similarity of two texts; cheap upper bounds first, 0 as soon as one is below ``least``."""
    if not a or not b:
        return float(a == b)
    if a == b:
        return 1.0
    if min(len(a), len(b)) < lengths * max(len(a), len(b)):
        return 0.0
    m = difflib.SequenceMatcher(None, a, b, autojunk=False)
    return m.ratio() if m.quick_ratio() >= least else 0.0


def ratio_udf(least: float = 0.95):
    """Column form of ``ratio``; call it on the few pairs whose hashes differ."""
    @F.pandas_udf(T.DoubleType())
    def udf(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([ratio(x, y, least) for x, y in zip(a, b)])

    return udf


def read_sections(raw: str | None) -> list[tuple[str, str]]:
    """Non-blank sections of a JSON object: name to text, or ``intro`` and a list ``sections`` of titles and texts."""
    try:
        got = json.loads(raw)
    except (TypeError, ValueError):
        return []
    if not isinstance(got, dict):
        return []
    if isinstance(got.get("sections"), list):
        parts = [s for s in got["sections"] if isinstance(s, dict)]
        found = [("intro", got.get("intro")), *((s.get("title") or s.get("name") or "", s.get("text") or s.get("content") or "") for s in parts)]
    else:
        found = list(got.items())
    return [(k or "(untitled)", v) for k, v in found if isinstance(k, str) and isinstance(v, str) and v.strip()]


def section_changes(pages: DataFrame, shortest: int = 50, least: float = 0.95) -> DataFrame:
    """``page_id, scraped_at, section, change``: what each scrape of ``pages(page_id, scraped_at, sections)`` does.

    Every section of at least ``shortest`` characters is compared with its open version: 'inserted' (none is open),
    'touched' (equal after normalization, or ``least`` similar; the open text stays), 'superseded' (it becomes the open
    text). 'untouched' are open sections that a scrape lacks. Scrapes without readable sections and rows without page
    open nothing that a later row could meet. A task holds the open texts of one page at a time.
    """

    def plain(text: str) -> str:
        return re.sub(r"\s+", " ", re.sub(r"\[\d+\]", "", text)).strip().lower()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, open_ = None, {}
        for batch in batches:
            at, names, what = [], [], []
            for i, (ident, raw) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                if ident is None or ident != page:
                    page, open_ = ident, {}
                found = read_sections(raw)
                kept = [(k, v) for k, v in found if len(v) >= shortest]
                got = [(k, "untouched") for k in open_ if k not in dict(kept)] if found else []
                for k, v in kept:
                    if k not in open_:
                        change = "inserted"
                    elif plain(open_[k]) == plain(v) or ratio(open_[k], v, least) >= least:
                        change = "touched"
                    else:
                        change = "superseded"
                    if change != "touched":
                        open_[k] = v
                    got.append((k, change))
                at += [i] * len(got)
                names += [k for k, _ in got]
                what += [c for _, c in got]
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(names, pa.string()), pa.array(what, pa.string())], ["page_id", "scraped_at", "section", "change"])

    rows = pages.filter(F.col("sections").isNotNull()).select("page_id", "scraped_at", "sections")
    by_page = rows.repartition("page_id").sortWithinPartitions("page_id", "scraped_at", F.md5("sections"))
    return by_page.mapInArrow(run, f"page_id string, scraped_at {rows.schema['scraped_at'].dataType.simpleString()}, section string, change string")


def link_members(members: DataFrame, groups: DataFrame, key: str, group: str, listed: str) -> DataFrame:
    """``members`` with column ``group`` from the lists ``listed`` of ``groups(group, listed)``; what a list says wins over
    what the member says, and of several lists the one of the least group."""
    named = groups.select(F.col(group).alias("_g"), F.explode(listed).alias("_k")).groupBy("_k").agg(F.min("_g").alias("_g"))
    return set_column(members, group, named.select(F.col("_k").alias(key), F.col("_g").alias(group)), key)


def pending(sources: DataFrame, done: DataFrame, key: str, version: str | None = None, force: bool = False, least: Column | None = None) -> DataFrame:
    """``sources`` that have no result yet in ``done(key, version)``, for one ``version`` if given.

    ``force`` takes all of them; ``least`` is a further condition on the sources. Null keys have no result.
    """
    sources = sources if least is None else sources.filter(least)
    if force:
        return sources
    had = done if version is None else done.filter(F.col("version") == version)
    return sources.join(had.select(key).distinct(), key, "left_anti")
