"""Queries of the training-data operators over the catalogue's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import cooccur, mix, names, pack, similar, spans, split, tokens
from tidemark.session import materialize
from tidemark.sources.tables import table


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return names.records(table(spark, folder, "graph_nodes"), table(spark, folder, "characters"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    recs = _records(spark, folder)
    return names.same_entity_pairs(recs, names.link(recs))


def p1_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Every record with the entity that it belongs to."""
    return names.link(_records(spark, folder))


def p3_pairs(spark: SparkSession, folder: str) -> DataFrame:
    n = table(spark, folder, "chapter").agg(F.count("*").alias("n_groups"))
    return cooccur.together(table(spark, folder, "coc"), "chapter", "character", n, min_shared=8, min_lift=3.0)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_pairs(spark, folder).select(F.col("item_a").alias("char_a"), F.col("item_b").alias("char_b"))


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return split.wiki_items(table(spark, folder, "wiki_text"), table(spark, folder, "wiki_chunks"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return split.oversized(split.split_items(_items(spark, folder), with_text=False))


def p5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_items(_items(spark, folder), distinct=True)


def _nearest(spark: SparkSession, folder: str, min_similarity: float = -1.0) -> DataFrame:
    """One setting of the index for both results."""
    return similar.knn(table(spark, folder, "wiki_chunks"), "chunk_id", "embedding", k=5, min_similarity=min_similarity)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    near = _nearest(spark, folder, 0.80)
    return near.select(F.least("id", "neighbour").alias("chunk_a"), F.greatest("id", "neighbour").alias("chunk_b")).distinct()


def p6_knn(spark: SparkSession, folder: str) -> DataFrame:
    near = _nearest(spark, folder)
    return near.select(F.col("id").alias("chunk_id"), "neighbour", F.round("similarity", 2).alias("similarity"), "rank")


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(tokens.sized(table(spark, folder, "documents"), keep=("source",)), "sized")


def p7_packs(spark: SparkSession, folder: str) -> DataFrame:
    return pack.pack(_sized(spark, folder), table(spark, folder, "pack_limits"))


def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    return pack.fill(p7_packs(spark, folder), table(spark, folder, "pack_limits"))


def _whole_plan(items: DataFrame, targets: DataFrame) -> tuple[float, dict]:
    whole = items.agg(F.sum("tokens")).first()[0]
    return mix.plan_of(items, targets, total=float(whole or 0))


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """For a total as large as the corpus, where small sources end at their allowed repeats."""
    items, targets = _sized(spark, folder), table(spark, folder, "mix_targets")
    return mix.mix(items, targets, plan=_whole_plan(items, targets))


def p8_mix_balanced(spark: SparkSession, folder: str) -> DataFrame:
    """For the largest total at which every source present reaches its share."""
    return mix.mix(_sized(spark, folder), table(spark, folder, "mix_targets"))


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares that ``p8_mix`` reaches."""
    items, targets = _sized(spark, folder), table(spark, folder, "mix_targets")
    plan = _whole_plan(items, targets)
    return mix.shares(mix.mix(items, targets, plan=plan), items, targets, plan)


def p8_shares_balanced(spark: SparkSession, folder: str) -> DataFrame:
    items, targets = _sized(spark, folder), table(spark, folder, "mix_targets")
    plan = mix.plan_of(items, targets)
    return mix.shares(mix.mix(items, targets, plan=plan), items, targets, plan)


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return spans.Parsed(table(spark, folder, "documents")).links()


def p9_spans(spark: SparkSession, folder: str) -> DataFrame:
    return spans.Parsed(table(spark, folder, "documents")).spans()


def p9_shared(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_fraction(table(spark, folder, "documents"))


def p9_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: the class of its text, the copies of it, and the other texts that it shares a run with."""
    return spans.text_classes(table(spark, folder, "documents"))


_P3 = """
WITH seen AS (SELECT DISTINCT chapter, character FROM coc WHERE chapter IS NOT NULL AND trim(character) <> ''),
n AS (SELECT character, COUNT(*) AS n FROM seen GROUP BY character),
pairs AS (SELECT a.character AS item_a, b.character AS item_b, COUNT(*) AS shared FROM seen a JOIN seen b
  ON a.chapter = b.chapter AND a.character < b.character GROUP BY 1, 2 HAVING COUNT(*) >= 8)
SELECT item_a, item_b, shared, x.n AS n_a, y.n AS n_b, t.n AS n_groups,
  shared * 1.0::DOUBLE * t.n / (x.n * y.n)::DOUBLE AS lift,
  ((shared + 0.5::DOUBLE) * (t.n - x.n - y.n + shared + 0.5::DOUBLE)) / ((x.n - shared + 0.5::DOUBLE) * (y.n - shared + 0.5::DOUBLE)) AS odds_ratio
FROM pairs JOIN n x ON x.character = item_a JOIN n y ON y.character = item_b, (SELECT COUNT(*) AS n FROM chapter) t
WHERE shared * t.n >= 3 * x.n * y.n"""


_P5 = r"""SELECT DISTINCT 'full_text' AS field, page_id AS item_id, '' AS section FROM wiki_text WHERE length(full_text) > 3200
UNION SELECT 'chunk_text', chunk_id, '' FROM wiki_chunks WHERE length(chunk_text) > 3200
UNION SELECT 'sections', page_id, k FROM (SELECT page_id, sections, UNNEST(json_keys(sections)) AS k FROM wiki_text WHERE json_valid(sections) AND json_type(sections) = 'OBJECT')
WHERE length(json_extract_string(sections, '$."' || replace(k, '"', '\"') || '"')) > 3200"""

_P6 = """WITH v AS (SELECT chunk_id, embedding::DOUBLE[] AS e FROM wiki_chunks WHERE len(embedding) = 384 AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
s AS (SELECT a.chunk_id AS a, b.chunk_id AS b, list_cosine_similarity(a.e, b.e) AS c FROM v a JOIN v b ON a.chunk_id <> b.chunk_id),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY a ORDER BY c DESC, b) AS r FROM s)
SELECT DISTINCT least(a, b) AS chunk_a, greatest(a, b) AS chunk_b FROM r WHERE r <= 5 AND c >= 0.8"""

_P9 = """WITH w AS (SELECT DISTINCT doc_id, md5(substr(text, i, 200)) AS h FROM (SELECT doc_id, text, UNNEST(generate_series(1, length(text) - 199)) AS i FROM documents WHERE length(text) >= 200)),
k AS (SELECT h FROM w GROUP BY h HAVING COUNT(*) > 1), x AS (SELECT w.* FROM w JOIN k USING (h))
SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id"""


def queries() -> dict:
    return {"p1_found": p1_found, "p1_entities": p1_entities, "p3_found": p3_found, "p3_pairs": p3_pairs, "p5_found": p5_found, "p5_pieces": p5_pieces, "p6_found": p6_found, "p6_knn": p6_knn, "p7_packs": p7_packs, "p7_fill": p7_fill, "p8_mix": p8_mix, "p8_mix_balanced": p8_mix_balanced, "p8_shares": p8_shares, "p8_shares_balanced": p8_shares_balanced, "p9_found": p9_found, "p9_spans": p9_spans, "p9_shared": p9_shared, "p9_classes": p9_classes}


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": f"SELECT item_a AS char_a, item_b AS char_b FROM ({_P3})",
        "p3_pairs": _P3,
        "p5_found": _P5,
        "p6_found": _P6,
        "p9_found": _P9,
    }
