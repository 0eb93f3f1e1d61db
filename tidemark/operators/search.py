"""Exact cosine top-k for a query vector, and keyword search over an inverted index."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Scripts written without spaces, and the sign for long vowels, which belongs to no script. All are above U+0E00, which
#: is asked first as scripts are looked up slowly.
_SCRIPTS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\x{30FC}\x{FF70}"
_UNSPACED = rf"[\x{{E00}}-\x{{10FFFF}}&&[{_SCRIPTS}]]"
_WORD = rf"[[\p{{L}}\p{{M}}\p{{N}}&&[\x{{0}}-\x{{DFF}}]][\p{{L}}\p{{M}}\p{{N}}&&[^{_SCRIPTS}]]]+"
#: Pairs overlap, so the pair is looked at and one character taken; a character alone is its own term.
_PAIR = rf"(?=({_UNSPACED}{{2}}|(?<!{_UNSPACED}){_UNSPACED}(?!{_UNSPACED}))){_UNSPACED}"



def cosine(vector: Column, query: list[float]) -> Column:
    """Cosine in doubles; null for null, other length or zero vectors."""
    q = F.array(*[F.lit(float(x)) for x in query])
    norm = sum(float(x) * float(x) for x in query) ** 0.5
    dot = F.aggregate(F.zip_with(vector, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    own = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when((F.size(vector) == len(query)) & (own > 0) & F.lit(norm > 0), dot / (own * F.lit(norm)))


def nearest(df: DataFrame, id_col: str, vec_col: str, query: list[float], k: int = 5, where: Column | None = None) -> DataFrame:
    """The ``k`` most similar rows, ties by id; one heap of k rows per task, nothing is shuffled but those."""
    df = df if where is None else df.filter(where)
    return df.select(id_col, cosine(F.col(vec_col), query).alias("similarity")).filter(F.col("similarity").isNotNull()).orderBy(F.desc("similarity"), id_col).limit(k)


def parse_query(text: str) -> dict[str, list]:
    """Web-search syntax: words must occur, -words must not, "phrases" must occur as such, or joins alternatives."""
    phrases = [p.lower() for p in re.findall(r'(?<!-)"([^"]+)"', text)]
    rest = re.sub(r'-?"[^"]*"', " ", text).lower().split()
    must, bad, k = [], [w[1:] for w in rest if w.startswith("-") and len(w) > 1], 0
    words = [w for w in rest if not w.startswith("-")]
    while k < len(words):
        alternatives = [words[k]]
        while k + 2 < len(words) and words[k + 1] == "or":
            alternatives.append(words[k + 2])
            k += 2
        if alternatives != ["or"]:
            must.append(alternatives)
        k += 1
    return {"must": must, "not": bad, "phrases": phrases}


def terms(text: Column) -> Column:
    """Lower-case words of letters, marks and digits; scripts written without spaces give pairs of neighbouring characters."""
    low = F.lower(text)
    every = F.concat(F.regexp_extract_all(low, F.lit(_WORD), 0), F.regexp_extract_all(low, F.lit(_PAIR), 1))
    return F.when(F.octet_length(low) == F.length(low), ascii_terms(text)).otherwise(every)


def ascii_terms(text: Column) -> Column:
    """Runs of ASCII letters and digits only; every other character parts them."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+"), 0)


def inverted_index(df: DataFrame, id_col: str, text_col: str, words: Callable[[Column], Column] = terms) -> DataFrame:
    """``term, id, tf``; counted inside the scan's tasks first. Cluster or bucket it by term when it is stored."""
    return df.select(F.col(id_col).alias("id"), F.explode(words(F.col(text_col))).alias("term")).groupBy("term", "id").agg(F.count("*").alias("tf"))


def full_text(df: DataFrame, id_col: str, text_col: str, query: str, k: int = 5) -> DataFrame:
    """``id_col, score`` of matching rows: the summed counts of the wanted words, ties by id.

    A word of several terms must also stand in the text as it is written.
    """
    q = parse_query(query)
    d = df.select(id_col, F.lower(text_col).alias("_t"), terms(F.col(text_col)).alias("_w"))

    def has(word: str) -> Column:
        t = terms(F.lit(word))
        return (F.size(t) > 0) & (F.size(F.array_except(t, F.col("_w"))) == 0) & ((F.size(t) == 1) | F.col("_t").contains(word))

    for alternatives in q["must"]:
        d = d.filter(reduce(or_, map(has, alternatives)))
    for w in q["not"]:
        d = d.filter(~has(w))
    for p in q["phrases"]:
        d = d.filter(F.col("_t").contains(p))
    wanted = [w for a in q["must"] for w in a] + q["phrases"]
    score = F.size(F.filter("_w", lambda w: F.array_contains(terms(F.lit(" ".join(wanted))), w))) if wanted else F.lit(0)
    return d.select(id_col, score.alias("score")).orderBy(F.desc("score"), id_col).limit(k)


_STORED: dict[tuple[str, str], DataFrame] = {}


def stored_index(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """The inverted index of ``df``, written once a session for each ``name`` and sorted by term in every file, so that a
    search reads only the row groups of its words.

    One shuffle, by term and an eighth of the ids, brings equal terms together and counts them there; the uses of a term
    that stands in every text are spread over eight tasks.
    """
    key = (df.sparkSession.sparkContext.applicationId, name)
    if key not in _STORED:
        uses = df.select(F.col(id_col).alias("id"), F.explode(terms(F.col(text_col))).alias("term"))
        uses = uses.withColumn("eighth", F.pmod(F.xxhash64("id"), F.lit(8)).cast("int")).repartition("term", "eighth")
        index = uses.groupBy("term", "eighth", "id").agg(F.count("*").alias("tf")).drop("eighth")
        _STORED[key] = materialize(index.sortWithinPartitions("term", "id"), "index")
    return _STORED[key]


def search_index(index: DataFrame, df: DataFrame, id_col: str, text_col: str, query: str, k: int = 5) -> DataFrame:
    """``full_text`` over ``index(term, id, tf)``; texts are read only of rows that hold the words, and only for phrases
    and words of several terms."""
    q = parse_query(query)
    spark = df.sparkSession
    of = {w: r for w, r in _terms_of(spark, sorted({w for a in q["must"] for w in a} | set(q["not"]) | set(q["phrases"]))).items()}
    wanted = sorted({t for w in [w for a in q["must"] for w in a] + q["phrases"] for t in of[w]})
    if not wanted:
        return full_text(df, id_col, text_col, query, k)
    asked = sorted({*wanted, *(t for w in q["not"] for t in of[w])})
    rows = index.filter(F.col("term").isin(asked)).groupBy("id").agg(F.collect_set("term").alias("_w"), F.sum(F.when(F.col("term").isin(wanted), F.col("tf")).otherwise(0)).cast("int").alias("score"))
    held = lambda w: F.size(F.array_except(F.array(*map(F.lit, of[w])), F.col("_w"))) == 0 if of[w] else F.lit(False)
    exact = [w for w in {w for a in q["must"] for w in a} | set(q["not"]) if len(of[w]) > 1]
    if q["phrases"] or exact:
        texts = df.select(F.col(id_col).alias("id"), F.lower(text_col).alias("_t"))
        rows = rows.join(texts, "id")
    has = lambda w: held(w) & F.col("_t").contains(w) if w in exact else held(w)
    for alternatives in q["must"]:
        rows = rows.filter(reduce(or_, map(has, alternatives)))
    for w in q["not"]:
        rows = rows.filter(~has(w))
    for p in q["phrases"]:
        rows = rows.filter(F.col("_t").contains(p))
    return rows.select(F.col("id").alias(id_col), "score").orderBy(F.desc("score"), id_col).limit(k)


def _terms_of(spark, words: list[str]) -> dict[str, list[str]]:
    """Distinct terms of each of a query's words."""
    if not words:
        return {}
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.array_distinct(terms(F.col("w"))).alias("t")).collect()
    return {r["w"]: list(r["t"]) for r in rows}
