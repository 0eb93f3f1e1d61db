"""Graphs as tables: co-appearance edges, degrees, bounded traversal, entity lookup, evidence-backed edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize


#: Rows of a part of the items that meets another part in one task, and pairs that a task counts at a time.
BLOCK, AT_ONCE = 500_000, 1_000_000
#: Parts that even few rows are cut into, so that all cores have work, and rows from which a part pays.
LEAST_PARTS, LEAST_ROWS = 8, 10_000


def pair_edges(member: DataFrame, group: str, item: str, min_weight: int = 1, distinct: bool = True, block: int = BLOCK, span: int = 1) -> DataFrame:
    """``source < target, weight``: groups shared by two items; with ``distinct`` off repeated rows count again.

    With ``span`` groups are whole numbers, and a row also stands in the ``span`` - 1 groups before its own, from 1 on.

    Items are cut into parts by hash, and each two parts meet in a task of their own that has all their rows, so it
    counts the groups of its pairs to the end: rows are shuffled, pairs never are.
    """
    m = member.select(F.col(group).alias("g"), F.col(item).alias("v")).filter(F.col("g").isNotNull() & F.col("v").isNotNull())
    m = m.distinct().withColumn("n", F.lit(1).cast("long")) if distinct else m.groupBy("g", "v").agg(F.count("*").alias("n"))
    m = materialize(m.sortWithinPartitions("v"), "members")
    rows = m.count()
    parts = max(1, -(-rows // block), min(LEAST_PARTS, rows // LEAST_ROWS))
    part, other = F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    m = m.withColumn("p", part).withColumn("o", other)
    high = F.greatest("p", "o")
    task = (high * (high + 1) / 2).cast("int") + F.least("p", "o")
    # Rows of the lower part are left, rows of the other one right; a part that meets itself is neither.
    m = m.select("g", "v", "n", F.signum(F.col("p") - F.col("o")).cast("int").alias("side"), task.alias("task"))
    kind = m.schema["v"].dataType.simpleString()
    met = m.repartitionById(parts * (parts + 1) // 2, F.col("task")).select("g", "v", "n", "side")
    return met.mapInArrow(_counted(min_weight, distinct, span), f"source {kind}, target {kind}, weight long")


def _counted(min_weight: int, distinct: bool, span: int):
    """Edges of the one pair of parts that a task gets as rows (g, v, n, side)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        names, v = _ranks(t["v"])
        g = t["g"].to_numpy().astype(np.int64) if span > 1 else _ranks(t["g"])[1]
        n, side = t["n"].to_numpy(), t["side"].to_numpy()
        del t, held
        left, right = (_rows(g[s], v[s], n[s], span) for s in (side <= 0, side >= 0))
        same = bool((side == 0).any())
        for code, weight in _pairs(left, right, len(names), same, distinct):
            enough = np.flatnonzero(weight >= min_weight)
            for k in range(0, len(enough), 1 << 17):
                at = enough[k : k + (1 << 17)]
                a, b = np.divmod(code[at], len(names))
                yield pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), pa.array(weight[at], pa.int64())], ["source", "target", "weight"])

    return run


def _ranks(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The different values in their order (text by its bytes), and the place of each row's value among them."""
    coded = column.combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]


def _rows(g: np.ndarray, v: np.ndarray, n: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (g, v, n) in the order of v; with ``span`` each also in the groups before its own, once."""
    if span > 1 and len(g):
        g, v = np.concatenate([g - k for k in range(span)]), np.tile(v, span)
        kept = g >= 1
        g, v = g[kept], v[kept]
        order = np.lexsort((g, v))
        g, v = g[order], v[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
        return g[new], v[new], np.ones(int(new.sum()), np.int64)
    order = np.argsort(v, kind="stable")
    return g[order], v[order], n[order]


def _pairs(left: tuple, right: tuple, names: int, same: bool, distinct: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(low rank * ``names`` + high rank, weight) of the pairs of a left and a right row of one group, some items of the
    left at a time."""
    (g, v, n), (rg, rv, rn) = left, right
    if not len(g) or not len(rg):
        return
    order = np.argsort(rg, kind="stable")
    rv, rn = rv[order], rn[order]
    groups, first, size = np.unique(rg[order], return_index=True, return_counts=True)
    at = np.minimum(np.searchsorted(groups, g), len(groups) - 1)
    found = groups[at] == g
    at, v, n = at[found], v[found], n[found]
    if not len(v):
        return
    first, size = first[at], size[at]
    ends = np.append(np.flatnonzero(np.diff(v)) + 1, len(v))  # where the rows of an item end
    total = np.cumsum(size)
    s = 0
    while s < len(v):
        most = (total[s - 1] if s else 0) + AT_ONCE
        e = ends[max(np.searchsorted(total[ends - 1], most, side="right") - 1, np.searchsorted(ends, s, side="right"))]
        each = size[s:e]
        into = np.repeat(first[s:e] - np.cumsum(each) + each, each) + np.arange(each.sum())
        a, b = np.repeat(v[s:e], each), rv[into]
        w = None if distinct else np.repeat(n[s:e], each) * rn[into]
        s = e
        if same:  # each pair comes from both of its items
            kept = a < b
            a, b, w = a[kept], b[kept], None if w is None else w[kept]
        code = np.minimum(a, b) * names + np.maximum(a, b)
        if not len(code):
            continue
        if w is None:
            code.sort()
        else:
            order = np.argsort(code, kind="stable")
            code, w = code[order], w[order]
        starts = np.append(0, np.flatnonzero(np.diff(code)) + 1)
        yield code[starts], np.diff(starts, append=len(code)) if w is None else np.add.reduceat(w, starts)


def degrees(edges: DataFrame) -> DataFrame:
    """``node, degree, weighted_degree``."""
    both = edges.select(F.col("source").alias("node"), "weight").unionByName(edges.select(F.col("target").alias("node"), "weight"))
    return both.groupBy("node").agg(F.count("*").alias("degree"), F.sum("weight").alias("weighted_degree"))


def within_hops(edges: DataFrame, focus: DataFrame, hops: int) -> DataFrame:
    """``node, hop``: nodes within ``hops`` steps of ``focus(node)`` over undirected edges, with the fewest steps."""
    both = edges.select(F.col("source").alias("a"), F.col("target").alias("b")).unionByName(edges.select(F.col("target").alias("a"), F.col("source").alias("b"))).distinct()
    seen = focus.select("node").distinct().withColumn("hop", F.lit(0))
    for k in range(1, hops + 1):
        front = seen.filter(F.col("hop") == k - 1).select(F.col("node").alias("a"))
        step = both.join(front, "a", "left_semi").select(F.col("b").alias("node")).distinct().join(seen.select("node"), "node", "left_anti")
        seen = materialize(seen.unionByName(step.withColumn("hop", F.lit(k))), "hops") if k < hops else seen.unionByName(step.withColumn("hop", F.lit(k)))
    return seen


def hop_edges(edges: DataFrame, focus: DataFrame, hops: int, most: int | None = None) -> DataFrame:
    """``edges(source, target, ...)`` met within ``hops`` steps of ``focus``, with the ``hop`` at which each is met.

    With ``most`` only the first so many, nearer ones first and then by source and target, so the cut is the same in
    every run; each task keeps at most that many rows.
    """
    reached = within_hops(edges, focus, max(0, hops - 1))
    at = lambda c, h: reached.select(F.col("node").alias(c), F.col("hop").alias(h))
    met = edges.join(at("source", "_s"), "source", "left").join(at("target", "_t"), "target", "left")
    met = met.withColumn("hop", F.least("_s", "_t") + 1).filter(F.col("hop").isNotNull()).select(*edges.columns, "hop")
    return met if most is None else met.orderBy("hop", "source", "target").limit(most)


def unlinked(triples: DataFrame, known: DataFrame, most: int | None = None) -> DataFrame:
    """``side, name, n``: how often names of ``triples(subject, object)`` are not in ``known(name)``, the commonest first."""
    side = lambda c: triples.select(F.lit(c).alias("side"), F.col(c).alias("name"), F.lower(F.trim(c)).alias("_k"))
    rows = side("subject").unionByName(side("object")).filter(F.col("name").isNotNull())
    rows = rows.join(known.select(F.col("name").alias("_k")), "_k", "left_anti").groupBy("side", "name").agg(F.count("*").alias("n"))
    return rows if most is None else rows.orderBy(F.desc("n"), "side", "name").limit(most)


#: Quotes that say nothing, and the fewest words of one that does.
EMPTY_QUOTES, LEAST_WORDS = ("", "none", "n/a", "na", "null"), 5


def valid_triple(relations: tuple[str, ...], least: float = 0.6) -> Column:
    """Whether a row (subject, relation, object, quote, confidence as text) may be kept: known relation, two different
    names, a quote of at least five words, and a confidence that is a number of at least ``least``."""
    quote = F.lower(F.regexp_replace(F.trim("quote"), "^['\"]+|['\"]+$", ""))
    words = F.size(F.filter(F.split(F.trim("quote"), r"\s+"), lambda w: w != ""))
    sure = F.coalesce(F.col("confidence").try_cast("double") >= least, F.lit(False))
    got = F.col("relation").isin(*relations) & (F.col("subject") != F.col("object")) & ~quote.isin(*EMPTY_QUOTES) & (words >= LEAST_WORDS) & sure
    return F.coalesce(got, F.lit(False))


def name_index(nodes: DataFrame) -> DataFrame:
    """``name, id``: folded canonical names and aliases; of several claims on a name the first node's wins."""
    names = F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = nodes.select("id", F.posexplode(names).alias("pos", "raw")).select(F.lower(F.trim("raw")).alias("name"), "id", "pos").filter(F.col("name") != "")
    return rows.groupBy("name").agg(F.min_by("id", F.struct((F.col("pos") > 0).alias("alias"), "id")).alias("id"))


def evidence_edges(triples: DataFrame, relations: tuple[str, ...], least: float = 0.6, quotes: int = 3, longest: int = 500) -> DataFrame:
    """Edges of ``triples(subject, relation, object, confidence, chapter, quote)``.

    Unknown relations, low or null confidence and loops go. Per edge the surest row gives the confidence and the chapter,
    or where it has none the surest row that has one; up to ``quotes`` different quotes are joined, surest first.
    """
    good = triples.filter(F.col("relation").isin(*relations) & (F.col("confidence") >= least) & (F.col("subject") != F.col("object")))
    key = ["subject", "relation", "object"]
    each = good.filter(F.trim("quote") != "").groupBy(*key, "quote").agg(F.max("confidence").alias("confidence"))
    ranked = each.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("confidence"), "quote"))).filter(F.col("r") <= quotes)
    text = ranked.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "quote"))), lambda s: s["quote"]), " | ").alias("evidence"))
    surest = F.min_by("chapter", F.when(F.col("chapter").isNotNull(), F.struct((-F.col("confidence")).alias("c"), "chapter")))
    top = good.groupBy(*key).agg(F.max("confidence").alias("confidence"), surest.alias("chapter"))
    return top.join(text, key, "left").select(*key, "confidence", "chapter", F.substring(F.coalesce("evidence", F.lit("")), 1, longest).alias("evidence"))


def keep_edges(edges: DataFrame, relations: list[str] | None = None, least: float | None = None, nodes: DataFrame | None = None, weight: int | None = None) -> DataFrame:
    """Optional filters, each skipped when not given: relations, least confidence, both ends among ``nodes(node)``, and
    least weight."""
    conditions: list[Column] = []
    if relations is not None:
        conditions.append(F.col("relation").isin(relations))
    if least is not None:
        conditions.append(F.col("confidence") >= least)
    if weight is not None:
        conditions.append(F.col("weight") >= weight)
    for c in conditions:
        edges = edges.filter(c)
    if nodes is not None:
        source, target = ("subject", "object") if "subject" in edges.columns else ("source", "target")
        for end in (source, target):
            edges = edges.join(nodes.select(F.col("node").alias("_n")), F.col(end) == F.col("_n"), "left_semi")
    return edges
