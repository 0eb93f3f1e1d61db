"""Filling fixed-capacity containers: optimal length buckets, and token-budget batches drawn from them.

1. The lengths of all items form one histogram per capacity, at most ``capacity`` numbers, which is all the driver sees.
2. Dynamic programming over the whole histogram chooses the ``buckets`` upper bounds with the least total padding; divide
   and conquer makes a layer of it m log m steps for m different lengths.
3. Token-budget batches: a batch of the largest bucket left takes as many of its items as the budget holds; what budget
   remains goes to the largest smaller bucket that fits, and so on.  A batch form repeats as long as its buckets last,
   so a few hundred forms describe any number of containers.  Without the second step a bucket of items of 0.4
   capacities would leave a fifth of each container empty.
4. An item's place in its bucket (offset of its partition plus its place in the partition, no sort, no global window)
   tells its container.

An item over the capacity is divided into full pieces and a rest; no other item is divided.

Defined results: null and empty texts have no tokens and are in no container; equal rows are separate items; a null id is
kept; capacities that are null or below 1 are skipped; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

BUCKETS = 160


def _layer(before: np.ndarray, padding) -> tuple[np.ndarray, np.ndarray]:
    """Least ``before[i - 1] + padding(i, j)`` over i <= j for every j, and the i that gives it.

    The padding is a Monge cost, so the best i never falls as j rises: the middle j is settled first, and the search for
    those on either side ends at its i.  One level of this division is one pass over at most m + 2**level candidates.
    """
    m = len(before)
    best, back = np.full(m, np.inf), np.zeros(m, dtype=np.int32)
    first, last, low, high = np.array([0]), np.array([m - 1]), np.array([0]), np.array([m - 1])
    shifted = np.concatenate([[np.inf], before[:-1]])
    while len(first):
        mid = (first + last) // 2
        end = np.minimum(high, mid)
        n = end - low + 1
        start = np.cumsum(n) - n
        i = np.arange(n.sum()) - np.repeat(start - low, n)
        cost = shifted[i] + padding(i, np.repeat(mid, n))
        least = np.minimum.reduceat(cost, start)
        hit = np.nonzero(cost == np.repeat(least, n))[0]
        pick = i[hit[np.searchsorted(hit, start)]]
        best[mid], back[mid] = least, pick
        left, right = first < mid, mid < last
        first, last = np.concatenate([first[left], mid[right] + 1]), np.concatenate([mid[left] - 1, last[right]])
        low, high = np.concatenate([low[left], pick[right]]), np.concatenate([pick[left], high[right]])
    return best, back


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Ascending upper bounds of at most ``buckets`` buckets with the least sum of (bound - length); ``lengths`` ascend."""
    m = len(lengths)
    if m <= buckets:
        return lengths.astype(np.int64)
    bounds = lengths.astype(np.int64)
    n = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
    s = np.concatenate([[0], np.cumsum(counts.astype(np.int64) * bounds)])
    padding = lambda i, j: (bounds[j] * (n[j + 1] - n[i]) - (s[j + 1] - s[i])).astype(np.float64)
    every = np.arange(m)
    best, backs = padding(np.zeros(m, dtype=np.int64), every), []
    for _ in range(1, buckets):
        best, back = _layer(best, padding)
        backs.append(back)
    out, j = [], m - 1
    for back in [*reversed(backs), None]:
        if j >= 0:
            out.append(bounds[j])
            j = int(back[j]) - 1 if back is not None else -1
    return np.array(out[::-1])


def batch_forms(bounds: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(containers, [(bucket, items per container)]) until every item has a place."""
    left, forms = counts.astype(np.int64).copy(), []
    while left.any():
        room, form = capacity, []
        b = int(np.nonzero(left)[0][-1])
        while b >= 0:
            take = min(int(left[b]), room // int(bounds[b]))
            if take:
                form.append((b, take))
                room -= take * int(bounds[b])
            fits = np.nonzero((bounds[:b] <= room) & (left[:b] > 0))[0]
            b = int(fits[-1]) if len(fits) else -1
        times = min(int(left[b]) // k for b, k in form)
        forms.append((times, form))
        for b, k in form:
            left[b] -= times * k
    return forms


class Plan:
    """Where the items of each bucket go: segments of places with a first container and items per container."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, capacity: int, buckets: int = BUCKETS) -> None:
        self.bounds = bucket_bounds(lengths, counts, buckets)
        per = np.bincount(np.searchsorted(self.bounds, lengths), weights=counts, minlength=len(self.bounds)) if len(lengths) else np.empty(0)
        segments: list[list[tuple[int, int, int]]] = [[] for _ in self.bounds]
        used = np.zeros(len(self.bounds), dtype=np.int64)
        self.containers = 0
        for times, form in batch_forms(self.bounds, per, capacity):
            for b, k in form:
                segments[b].append((int(used[b]), self.containers, k))
                used[b] += times * k
            self.containers += times
        self.segments = [np.array(s, dtype=np.int64).reshape(-1, 3) for s in segments]

    def container(self, bucket: np.ndarray, place: np.ndarray) -> np.ndarray:
        out = np.zeros(len(place), dtype=np.int64)
        for b in np.unique(bucket):
            rows = bucket == b
            start, first, k = self.segments[b][np.searchsorted(self.segments[b][:, 0], place[rows], side="right") - 1].T
            out[rows] = first + (place[rows] - start) // k
        return out


def pack(items: DataFrame, limits: DataFrame, id_col: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """``pack_name, container, id_col, piece, start_token, end_token, tokens`` for ``items(id_col, tokens)``.

    ``limits(pack_name, capacity_tokens)`` is a configuration table of a few rows.
    """
    caps = {r["pack_name"]: int(r["capacity_tokens"]) for r in limits.filter(F.col("capacity_tokens") >= 1).collect()}
    spark = items.sparkSession
    base = items.select(F.col(id_col).alias("id"), "tokens").filter(F.col("tokens") > 0)
    kinds = F.array(*[F.struct(F.lit(name).alias("pack_name"), F.lit(cap).alias("capacity")) for name, cap in (caps or {"": 1}).items()])
    piece = F.col("piece")
    every = (base if caps else base.limit(0)).select("id", "tokens", F.inline(kinds)).withColumn("piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col("tokens") / F.col("capacity")).cast("int") - 1)))
    every = every.select("pack_name", "id", piece, (piece * F.col("capacity")).cast("long").alias("start_token"), F.least("tokens", (piece + 1) * F.col("capacity")).cast("long").alias("end_token"))
    every = every.withColumn("size", (F.col("end_token") - F.col("start_token")).cast("int"))
    hist = every.groupBy("pack_name", "size").agg(F.count("*").alias("n")).toArrow().to_pydict()
    plans = {}
    for name, cap in caps.items():
        mine = [(s, n) for p, s, n in zip(hist["pack_name"], hist["size"], hist["n"]) if p == name]
        lengths, counts = (np.array(x, dtype=np.int64) for x in zip(*sorted(mine))) if mine else (np.empty(0, np.int64),) * 2
        plans[name] = Plan(lengths, counts, cap, buckets)
    shared = spark.sparkContext.broadcast(plans)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], int] = {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            size, names = batch.column(5).to_numpy(), np.array(batch.column(0).to_pylist(), dtype=object)
            bucket, place = np.zeros(len(size), np.int32), np.zeros(len(size), np.int64)
            for name, plan in shared.value.items():
                rows = np.nonzero(names == name)[0]
                if not len(rows):
                    continue
                mine = np.searchsorted(plan.bounds, size[rows]).astype(np.int32)
                order = np.argsort(mine, kind="stable")
                kinds, first, n = np.unique(mine[order], return_index=True, return_counts=True)
                local = np.arange(len(rows)) - np.repeat(first, n)
                for b, f, m in zip(kinds.tolist(), first.tolist(), n.tolist()):
                    local[f : f + m] += seen.get((name, b), 0)
                    seen[name, b] = seen.get((name, b), 0) + m
                bucket[rows] = mine
                place[rows[order]] = local
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket), pa.array(place), pa.array(np.full(len(size), part, np.int32))], [*batch.schema.names, "bucket", "place", "part"])

    id_type = base.schema["id"].dataType.simpleString()
    ddl = f"pack_name string, id {id_type}, piece int, start_token long, end_token long, size int"
    numbered = materialize(every.mapInArrow(number, ddl + ", bucket int, place long, part int"), "numbered")
    before = Window.partitionBy("pack_name", "bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = numbered.groupBy("pack_name", "bucket", "part").agg(F.count("*").alias("n"))
    sums = sums.select("pack_name", "bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = numbered.join(sums, ["pack_name", "bucket", "part"]).select("pack_name", "id", "piece", "start_token", "end_token", "size", "bucket", (F.col("place") + F.col("offset")).alias("place"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            bucket, place = batch.column(6).to_numpy(), batch.column(7).to_numpy()
            out = np.zeros(len(place), dtype=np.int64)
            for name, plan in shared.value.items():
                rows = names == name
                out[rows] = plan.container(bucket[rows], place[rows])
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(out)], [*batch.schema.names[:6], "container"])

    got = placed.mapInArrow(assign, ddl + ", container long")
    return got.select("pack_name", "container", F.col("id").alias(id_col), "piece", "start_token", "end_token", F.col("size").alias("tokens"))


def fill(packed: DataFrame, limits: DataFrame) -> DataFrame:
    """One row per capacity: how many containers, and which share of their room is used."""
    per = packed.groupBy("pack_name", "container").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("items"))
    got = per.groupBy("pack_name").agg(F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"))
    return got.join(F.broadcast(limits), "pack_name").withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
