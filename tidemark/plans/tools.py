"""Guarded ad-hoc SQL and the small tools that answer questions about the story."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import search
from tidemark.sources.tables import register, table

_MUTATION = re.compile(r"\b(?:insert|update|delete|drop|alter|create|truncate|merge|grant|revoke|copy|call|set|reset|refresh|cache|load|add|use)\b", re.I)


class NotReadOnly(ValueError):
    """The statement is not a single query."""


def check_read_only(sql: str, strict: bool = False) -> str:
    """The statement without its closing ';', if it is one query; else NotReadOnly.

    ``strict`` also refuses words of mutating statements anywhere outside string literals.
    """
    text = sql.strip().rstrip(";").strip()
    bare = re.sub(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/", " ", text, flags=re.S)
    if ";" in bare:
        raise NotReadOnly("only one statement is allowed")
    if not re.match(r"\s*(?:select|with|values|from)\b", bare, re.I):
        raise NotReadOnly("only SELECT statements are allowed")
    if strict and _MUTATION.search(bare):
        raise NotReadOnly("the statement names a change")
    if re.match(r"\s*(?:with|from)\b", bare, re.I) and re.search(r"\binsert\s+(?:into|overwrite)\b", bare, re.I):
        raise NotReadOnly("the statement writes")
    return text


def run_sql(spark: SparkSession, sql: str, folder: str | None = None, strict: bool = False) -> DataFrame:
    """A guarded query over the tables of ``folder``; lazy, planned by Catalyst."""
    text = check_read_only(sql, strict)
    if folder:
        register(spark, folder)
    return spark.sql(text)


def sql_text(spark: SparkSession, sql: str, folder: str | None = None, rows: int = 50) -> str:
    """At most ``rows`` rows as text, and whether there were more; errors come back as text."""
    try:
        got = run_sql(spark, sql, folder).limit(rows + 1).toPandas()
    except Exception as e:  # noqa: BLE001 - a tool answers with the error
        return f"Error: {str(e).splitlines()[0]}"
    return got.head(rows).to_string(index=False) + ("\n..." if len(got) > rows else "")


def search_wiki(spark: SparkSession, folder: str, query: str, limit: int = 5) -> DataFrame:
    """Pages for keywords; 1 to 10 rows with a snippet of 500 characters."""
    pages = table(spark, folder, "wiki_text")
    hits = search.full_text(pages.filter(F.col("full_text").isNotNull()), "page_id", "full_text", query, max(1, min(10, limit)))
    best = pages.groupBy("page_id").agg(F.max_by("full_text", "scraped_at").alias("t"), F.max_by("title", "scraped_at").alias("title"))
    return hits.join(best, "page_id").select("page_id", "title", "score", F.substring("t", 1, 500).alias("snippet"))


def profile(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Up to five persons whose name holds ``name``, exact matches first, with the lead of their page."""
    n = name.strip().lower()
    people = table(spark, folder, "characters").filter(F.lower("name").contains(n)).withColumn("exact", F.lower(F.trim("name")) == n)
    top = people.orderBy(F.desc("exact"), "id").limit(5)
    intro = table(spark, folder, "wiki_text").groupBy(F.col("page_id").alias("id")).agg(F.max_by("intro_text", "scraped_at").alias("i"))
    return top.join(intro, "id", "left").select("id", "name", "origin", "status", "birth", "bounty", "age", "occupation", F.substring("i", 1, 1000).alias("intro"))


def status(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Row counts of tables; one that does not exist has 0."""
    rows = []
    for name in names:
        try:
            rows.append(table(spark, folder, name).agg(F.lit(name).alias("name"), F.count("*").alias("rows")))
        except Exception:  # noqa: BLE001 - a missing table counts as empty
            rows.append(spark.createDataFrame([(name, 0)], "name string, rows long"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def sql_json(spark: SparkSession, sql: str, folder: str | None = None, rows: int = 1000) -> str:
    """At most ``rows`` rows of a guarded query as one JSON array of objects, null fields included."""
    got = run_sql(spark, sql, folder, strict=True).limit(rows)
    out = got.agg(F.to_json(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in got.columns])), {"ignoreNullFields": "false"}).alias("j")).first()["j"]
    return out or "[]"


def call(spark: SparkSession, folder: str, name: str, arguments: dict) -> str:
    """The answer of the tool ``name`` as text; an unknown name or a failing tool is answered as such."""
    table_text = lambda df: df.toPandas().to_string(index=False)
    tools = {
        "query_database": lambda a: sql_text(spark, a["sql"], folder),
        "search_wiki": lambda a: table_text(search_wiki(spark, folder, a["query"], int(a.get("limit", 5)))),
        "profile": lambda a: table_text(profile(spark, folder, a["name"])),
    }
    if name not in tools:
        return f"Error: there is no tool {name}"
    try:
        return tools[name](arguments)
    except Exception as e:  # noqa: BLE001 - a tool answers with the error
        return f"Error: {str(e).splitlines()[0] if str(e) else type(e).__name__}"
