"""The k most similar vectors for every vector: balanced posting lists.

Fit.     A documented, bounded sample (``SAMPLE`` vectors, chosen by the hash of the id) is split by recursive k-means
         until every leaf stands for about ``list_size`` vectors; leaves are the centroids, at most ``MAX_LISTS``.
Graph.   Centroids are searched through an in-memory graph: each has edges to the ``DEGREE`` centroids nearest to it.  A
         search enters at the best of sqrt(K) entry centroids and walks from neighbour to neighbour: it expands the best
         centroids not yet expanded, as long as they are among the best ``WIDTH`` met so far.  The graph is at most
         ``MAX_LISTS * dim`` floats (25 MB at 384 dimensions), so shipping it to the executors is bounded.
Index.   Every row is indexed.  A vector near the border of several lists is replicated: it is posted to each of its
         ``postings`` nearest lists whose centroid distance is within ``ratio`` times the nearest one.
Search.  The same distance ratio prunes the lists that a vector looks into, up to ``probes``.  As queries and postings
         are the same vectors, a row travels once to each list that it probes and carries a flag for posting.
         Scores inside a list are one matrix product.
Growth.  A list that has more than ``block`` postings (more vectors than the bounded graph can tell apart) gets lists of
         its own: k-means on a bounded sample of it, and every row of the list goes on to the sub-lists near it, by the
         same rules.  Only a sub-list that cannot be told apart further (near-equal vectors) is cut into blocks by hash,
         and its queries visit each block, so no task holds more than one block.
Copies.  Equal vectors are searched once.  Each copy gets up to k other copies (all are equally near) and then the
         neighbours of the group, so a group of copies of any size costs k rows per member.  Equality goes by a 64-bit
         hash of the code; a second hash tells whether it ever met two codes, and then the first is salted anew.

Vectors travel as 16-bit (exact search, error about 1e-6) or 8-bit integers (error about 5e-4).

Defined results: vectors that are null, of another length, not finite or all zero take no part; ties are broken by id;
a null id takes no part; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

SAMPLE = 65536
MAX_LISTS = 16384
LIST_SIZE = 1024
BLOCK = 8192
#: Groups of copies up to which the table of them is sent to every task.
MAX_SENT = 500_000
#: Sampled vectors per list of too many vectors, and the most sub-lists that it gets.
SUB_SAMPLE, MAX_SUB = 2048, 128
#: Edges per centroid; the best centroids met so far among which a search goes on, and those expanded at a time.
DEGREE, WIDTH, BEAM = 32, 32, 8


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids and the nearest centroid of each row."""
    c = x[rng.choice(len(x), k, replace=False)].copy()
    near = np.zeros(len(x), dtype=np.int64)
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        order = np.argsort(near, kind="stable")
        starts = np.searchsorted(near[order], np.arange(k))
        size = np.bincount(near, minlength=k)
        full = size > 0
        c[full] = np.add.reduceat(x[order], starts[full], axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c, np.argmax(x @ c.T, axis=1)


def balanced_centroids(x: np.ndarray, leaf: int, limit: int, seed: int = 7) -> np.ndarray:
    """Centroids of the leaves of a recursive split of ``x`` into parts of at most about ``leaf`` rows."""
    rng = np.random.default_rng(seed)
    todo, leaves = [x], []
    while todo:
        part = todo.pop()
        k = min(16, math.ceil(len(part) / leaf), max(1, limit - len(leaves) - len(todo)))
        mean = part.mean(axis=0)
        if k < 2:
            leaves.append(mean / max(float(np.linalg.norm(mean)), 1e-12))
            continue
        _, near = kmeans(part, k, 6, rng)
        kinds = np.unique(near)
        if len(kinds) < 2:  # equal vectors cannot be split
            leaves.append(mean / max(float(np.linalg.norm(mean)), 1e-12))
        else:
            todo += [part[near == c] for c in kinds]
    return np.array(leaves, dtype=np.float32)


class CentroidGraph:
    """Nearest-neighbour graph over centroids; ``nearest`` walks it."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids, k = centroids, len(centroids)
        degree, p = min(DEGREE, k - 1), max(1, math.isqrt(k))
        edges = []
        for at in range(0, k, 1024):
            near = centroids[at : at + 1024] @ centroids.T
            near[np.arange(len(near)), np.arange(at, at + len(near))] = -2.0
            edges.append(np.argpartition(-near, max(0, degree - 1), axis=1)[:, :degree])
        self.edges = np.concatenate(edges)
        pivots = kmeans(centroids, p, 5, np.random.default_rng(3))[0] if p > 1 else centroids[:1]
        self.entries = np.unique(np.argmax(pivots @ centroids.T, axis=1))

    def nearest(self, x: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``m`` best centroids of each row, best first, with their cosines."""
        k = len(self.centroids)
        m, width = min(m, k), min(max(m, WIDTH), k)
        score = np.full((len(x), k), -2.0, dtype=np.float32)
        fresh = np.ones((len(x), k), dtype=bool)
        score[:, self.entries] = x @ self.centroids[self.entries].T
        going = np.arange(len(x))
        while len(going) and self.edges.shape[1]:
            open_ = np.where(fresh[going], score[going], -2.0)
            pick = np.argpartition(-open_, min(BEAM, k) - 1, axis=1)[:, :BEAM]
            value = np.take_along_axis(open_, pick, 1)
            floor = -np.partition(-score[going], width - 1, axis=1)[:, width - 1 : width]
            good = (value > -2.0) & (value >= floor)
            rows, nodes = going[np.nonzero(good)[0]], pick[good]
            order = np.argsort(nodes, kind="stable")
            rows, nodes = rows[order], nodes[order]
            fresh[rows, nodes] = False
            edge = np.concatenate([[0], np.nonzero(np.diff(nodes))[0] + 1, [len(nodes)]]) if len(nodes) else [0]
            for a, b in zip(edge[:-1], edge[1:]):
                to, who = self.edges[nodes[a]], rows[a:b]
                score[who[:, None], to[None, :]] = x[who] @ self.centroids[to].T
            going = going[good.any(axis=1)]
        top = np.argpartition(-score, m - 1, axis=1)[:, :m]
        cos = np.take_along_axis(score, top, 1)
        order = np.argsort(-cos, axis=1, kind="stable")
        return np.take_along_axis(top, order, 1), np.take_along_axis(cos, order, 1)


def _near(cos: np.ndarray, ratio: float) -> np.ndarray:
    """Which of the lists, best first, lie within ``ratio`` times the distance of the best."""
    far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cos))
    keep = (far <= np.maximum(far[:, :1], 1e-6) * ratio) & (cos > -1.5)
    keep[:, 0] = True
    return keep


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)


def _unit(vectors: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    v = F.col(vec_col)
    ok = F.col(id_col).isNotNull() & (F.size(v) == dim)
    return vectors.filter(ok).filter(~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists(v, lambda e: e != 0)).select(F.col(id_col).alias("id"), v.alias("vec"))


def knn(vectors: DataFrame, id_col: str, vec_col: str, dim: int = 384, k: int = 5, min_similarity: float = -1.0, probes: int = 5, postings: int = 2, ratio: float = 1.15, bits: int = 16, list_size: int = LIST_SIZE, block: int = BLOCK) -> DataFrame:
    """``id, neighbour, similarity, rank``: for every vector its ``k`` most similar others of at least ``min_similarity``."""
    spark = vectors.sparkSession
    unit = _unit(vectors, id_col, vec_col, dim)
    n = unit.count()
    take = max(1, math.ceil(n / SAMPLE))
    rows = unit.filter(F.pmod(F.xxhash64("id"), F.lit(take)) == 0).toArrow() if n else None
    if not rows or not rows.num_rows:
        rows = unit.limit(SAMPLE).toArrow()
    if rows.num_rows:
        x = _matrix(rows["vec"].combine_chunks(), dim)[np.argsort(np.array(rows["id"].to_pylist(), dtype=object), kind="stable")]
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        leaf = max(8, round(list_size / take))
        graph = CentroidGraph(balanced_centroids(x, leaf, MAX_LISTS))
        del x
    else:
        graph = CentroidGraph(np.eye(1, dim, dtype=np.float32))
    del rows
    shared = spark.sparkContext.broadcast(graph)
    kind, top = (np.int16, 32767) if bits == 16 else (np.int8, 127)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = _matrix(part.column(1), dim)
                norm = np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
                fine = np.isfinite(norm[:, 0]) & (norm[:, 0] > 0)
                part, x = part.filter(pa.array(fine)), (x[fine] / norm[fine]).astype(np.float32)
                if not len(x):
                    continue
                lists, cos = g.nearest(x, probes)
                keep = _near(cos, ratio)
                scale = np.abs(x).max(axis=1, keepdims=True) / top
                code = np.rint(x / scale).astype(kind)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale[:, 0].astype(np.float32)), pa.array([r[m].astype(np.int32) for r, m in zip(lists, keep)], pa.list_(pa.int32()))],
                    ["id", "code", "scale", "lists"],
                )

    id_type = unit.schema["id"].dataType.simpleString()
    placed = unit.mapInArrow(place, f"id {id_type}, code binary, scale float, lists array<int>")
    placed = materialize(placed.withColumn("h", F.xxhash64("code", "scale")).withColumn("h2", F.hash("code")), "vectors")
    salt = 0
    while True:
        groups = placed.groupBy("h").agg(F.min("id").alias("first"), F.count("*").alias("n"), F.min("h2").alias("lo"), F.max("h2").alias("hi")).filter(F.col("n") > 1)
        groups = materialize(groups, "copies")
        if groups.filter(F.col("lo") < F.col("hi")).isEmpty():
            break
        salt += 1
        placed = placed.withColumn("h", F.xxhash64("code", "scale", F.lit(salt)))
    firsts_ = groups.select("h", "first")
    if groups.count() <= MAX_SENT:  # so the vectors need not be shuffled to find the copies
        firsts_ = F.broadcast(firsts_)
    single = placed.join(firsts_, "h", "left").filter(F.col("first").isNull() | (F.col("first") == F.col("id"))).drop("first")

    # Postings per list: at most MAX_LISTS rows.
    sizes = single.select(F.explode(F.slice("lists", 1, postings)).alias("list")).groupBy("list").agg(F.count("*").alias("n")).collect()
    of_list = F.broadcast(spark.createDataFrame([(r["list"], r["n"]) for r in sizes] or [(0, 0)], "list int, n long"))
    rows_ = single.select("h", "code", "scale", F.posexplode("lists").alias("at", "list")).join(of_list, "list")
    rows_ = rows_.select("list", F.lit(0).alias("sub"), (F.col("at") < postings).alias("posted"), "h", "scale", "code", "n")
    if any(r["n"] > block for r in sizes):
        large = F.col("n") > block
        parted = _sub_lists(rows_.filter(large).drop("sub"), dim, kind, list_size, probes, postings, ratio)
        parted = materialize(parted, "parted")
        of_sub = parted.filter("posted").groupBy("list", "sub").agg(F.count("*").alias("n"))
        rows_ = rows_.filter(~large).unionByName(parted.join(of_sub, ["list", "sub"]).select("list", "sub", "posted", "h", "scale", "code", "n"))
    nb = F.ceil(F.col("n") / F.lit(block)).cast("int")
    rows_ = rows_.withColumn("nb", nb).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    mine = F.pmod(F.hash("h"), F.col("nb")) == F.col("part")
    rows_ = rows_.select(F.struct("list", "sub", "part").alias("l"), (F.col("posted") & mine).alias("posted"), "h", "scale", "code")
    rows_ = rows_.select(F.xxhash64("l.list", "l.sub").alias("list"), "l.part", "posted", "h", "scale", "code")
    sent = rows_.repartition(F.col("list"), F.col("part")).sortWithinPartitions("list", "part", F.col("posted").desc())

    def decode(batch: pa.RecordBatch) -> np.ndarray:
        flat = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype=kind).reshape(-1, dim)
        return flat.astype(np.float32) * batch.column(4).to_numpy()[:, None]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, data, ids, held, held_ids = None, [], [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edge = np.concatenate([[0], np.nonzero((np.diff(lists) != 0) | (np.diff(parts) != 0))[0] + 1, [batch.num_rows]])
            for a, b in zip(edge[:-1], edge[1:]):
                now = (int(lists[a]), int(parts[a]))
                if now != key:
                    # The queries of a list that are postings too wait until all its postings are there.
                    if data:
                        yield from _top(np.concatenate(data), np.concatenate(ids), np.concatenate(data), np.concatenate(ids))
                    key, data, ids, held, held_ids = now, [], [], None, None
                rows = batch.slice(a, b - a)
                posted = rows.column(2).to_numpy(zero_copy_only=False)
                x, h = decode(rows), rows.column(3).to_numpy()
                m = int(posted.sum())
                if m:
                    data.append(x[:m])
                    ids.append(h[:m])
                if m < len(x):
                    if data:
                        held, held_ids = np.concatenate(data), np.concatenate(ids)
                        yield from _top(held, held_ids, held, held_ids)
                        data, ids = [], []
                    if held is not None:
                        yield from _top(x[m:], h[m:], held, held_ids)
        if data:
            yield from _top(np.concatenate(data), np.concatenate(ids), np.concatenate(data), np.concatenate(ids))

    def _top(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(q), 1024):
            sim = q[at : at + 1024] @ x.T
            own = q_ids[at : at + 1024]
            sim[own[:, None] == x_ids[None, :]] = -2.0
            if sim.shape[1] > k:
                best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            else:
                best = np.tile(np.arange(sim.shape[1]), (len(own), 1))
            s = np.take_along_axis(sim, best, 1)
            i, j = np.nonzero((s >= min_similarity) & (s > -1.5))
            yield pa.RecordBatch.from_arrays([pa.array(own[i]), pa.array(x_ids[best[i, j]]), pa.array(s[i, j].astype(np.float64))], ["a", "b", "similarity"])

    found = sent.mapInArrow(score, "a long, b long, similarity double")
    best = found.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b"))).filter(F.col("r") <= k).drop("r")
    # From groups of equal vectors back to ids. Only the first k + 1 copies of a group can be anyone's neighbours.
    firsts = placed.select("h", "id").withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("id"))).filter(F.col("r") <= k + 1)
    same = groups.select(F.col("h").alias("a"), F.col("h").alias("b"), F.lit(1.0).alias("similarity"))
    near = best.unionByName(same).join(firsts.select(F.col("h").alias("b"), F.col("id").alias("neighbour")), "b")
    out = placed.select(F.col("h").alias("a"), "id").join(near, "a").filter(F.col("id") != F.col("neighbour"))
    w = Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour")
    return out.select("id", "neighbour", "similarity", F.row_number().over(w).alias("rank")).filter(F.col("rank") <= k)


def _sub_lists(rows: DataFrame, dim: int, kind, list_size: int, probes: int, postings: int, ratio: float) -> DataFrame:
    """``list, sub, posted, h, scale, code``: rows(list, posted, h, scale, code, n) of large lists by the sub-lists they
    are near.

    The centroids of a list's sub-lists are fitted on a bounded sample of it, in one task; they reach the list's rows,
    which are spread over tasks by hash, ahead of them in the sorted stream.
    """

    def vectors(code: pa.Array, scale: pa.Array) -> np.ndarray:
        flat = np.frombuffer(b"".join(code.to_pylist()), dtype=kind).reshape(-1, dim)
        return flat.astype(np.float32) * scale.to_numpy()[:, None]

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("h").slice(0, 2 * SUB_SAMPLE)
        x = vectors(table["code"].combine_chunks(), table["scale"].combine_chunks())
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        k = min(MAX_SUB, math.ceil(table["n"][0].as_py() / list_size))
        c = balanced_centroids(x, max(1, math.ceil(len(x) / k)), MAX_SUB)
        return pa.table({"list": pa.array([table["list"][0].as_py()], pa.int32()), "code": pa.array([c.astype(np.float32).tobytes()], pa.binary())})

    drawn = rows.filter(F.col("posted") & (F.pmod(F.xxhash64("h"), F.ceil(F.col("n") / F.lit(SUB_SAMPLE))) == 0))
    fitted = drawn.select("list", "h", "scale", "code", "n").groupBy("list").applyInArrow(fit, "list int, code binary")
    spread = F.ceil(F.col("n") / F.lit(8 * BLOCK)).cast("int")
    many = rows.select("list", spread.alias("tasks")).distinct()
    heads = fitted.join(many, "list").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    heads = heads.select("list", "task", F.lit(0).alias("head"), F.lit(False).alias("posted"), F.lit(0).cast("long").alias("h"), F.lit(0.0).cast("float").alias("scale"), "code")
    body = rows.select("list", F.pmod(F.xxhash64("h"), spread).cast("int").alias("task"), F.lit(1).alias("head"), "posted", "h", "scale", "code")
    sent = heads.unionByName(body).repartition("list", "task").sortWithinPartitions("list", "task", "head")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centroids = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, tasks, heads_ = (batch.column(c).to_numpy() for c in range(3))
            edge = np.concatenate([[0], np.nonzero((np.diff(lists) != 0) | (np.diff(tasks) != 0) | (np.diff(heads_) != 0))[0] + 1, [len(lists)]])
            for a, b in zip(edge[:-1], edge[1:]):
                part = batch.slice(a, b - a)
                if heads_[a] == 0:
                    at, centroids = lists[a], np.frombuffer(part.column(6)[0].as_py(), np.float32).reshape(-1, dim)
                    continue
                x = vectors(part.column(6), part.column(5))
                cos = x @ centroids.T
                m = min(probes, len(centroids))
                top = np.argsort(-cos, axis=1, kind="stable")[:, :m]
                keep = _near(np.take_along_axis(cos, top, 1), ratio)
                i, j = np.nonzero(keep)
                took = part.take(pa.array(i))
                posted = took.column(3).to_numpy(zero_copy_only=False) & (j < postings)
                yield pa.RecordBatch.from_arrays([took.column(0), pa.array(top[i, j].astype(np.int32)), pa.array(posted), took.column(4), took.column(5), took.column(6)], ["list", "sub", "posted", "h", "scale", "code"])

    return sent.mapInArrow(assign, "list int, sub int, posted boolean, h long, scale float, code binary")
