"""Items that appear together: exact pair counts by sorting packed pair codes.

1. Items get dense 32-bit ids in name order, so that a pair is one 64-bit code ``low id << 32 | high id``.
2. Every group of records becomes codes inside one task; equal codes of a task are counted before they leave it.
3. Codes are hash-partitioned and sorted in each partition: Spark's external sorter spills sorted runs and merges them.
   A run-length pass over the merged stream adds up the counts; it holds one code at a time.
4. Lift, and the odds ratio with 0.5 added to each cell (Haldane-Anscombe), follow from the counts.

Pruning is exact: an item in fewer than ``min_shared`` groups, or in more than ``n_groups / min_lift`` groups, cannot be
in a pair that passes both bounds (``shared <= min(n_a, n_b)`` implies ``lift <= n_groups / max(n_a, n_b)``).

A group with more than ``block`` members is cut into blocks of members and every pair of blocks is a task of its own, so
no group is ever gathered whole.

Defined results: null or blank items and null groups take no part; repeated rows count once; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

BLOCK = 1024


def dense_ids(df: DataFrame, column: str) -> DataFrame:
    """``df`` plus ``id``: 0, 1, ... in the order of ``column`` (unique).  Only one number per partition is collected."""
    sorted_ = df.repartitionByRange(column).sortWithinPartitions(column).withColumn("_m", F.monotonically_increasing_id())
    kept = materialize(sorted_, "ids")
    part = F.shiftright("_m", 33)
    sizes = {r["p"]: r["n"] for r in kept.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    start, offsets = 0, []
    for p in sorted(sizes):
        offsets.append((p, start))
        start += sizes[p]
    base = kept.sparkSession.createDataFrame(offsets or [(0, 0)], "p long, base long")
    return kept.join(F.broadcast(base), part == F.col("p")).withColumn("id", F.col("base") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m", "p", "base")


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of the pairs of each (left, right) row of sorted id lists, counted within a few million at a time."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        code, n = np.unique(np.concatenate(held) if held else np.empty(0, np.int64), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n.astype(np.int64))], ["code", "n"])

    for batch in batches:
        for left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a = np.sort(np.array(left, dtype=np.int64))
            if right is None:
                i, j = np.triu_indices(len(a), 1)
                low, high = a[i], a[j]
            else:
                b = np.array(right, dtype=np.int64)
                low, high = np.repeat(a, len(b)), np.tile(b, len(a))
                low, high = np.minimum(low, high), np.maximum(low, high)
            held.append(low << 32 | high)
            size += len(low)
            if size > 2_000_000:
                yield flush()
                held, size = [], 0
    yield flush()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run-length sums over codes that arrive sorted; the last code of a batch waits for the next batch."""
    code_held, n_held = None, 0

    def out(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["code", "shared"])

    for batch in batches:
        if not batch.num_rows:
            continue
        code, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        starts = np.concatenate([[0], np.nonzero(np.diff(code))[0] + 1])
        sums, firsts = np.add.reduceat(n, starts), code[starts]
        if code_held is not None:
            if firsts[0] == code_held:
                sums[0] += n_held
            else:
                firsts, sums = np.concatenate([[code_held], firsts]), np.concatenate([[n_held], sums])
        code_held, n_held = int(firsts[-1]), int(sums[-1])
        yield out(firsts[:-1], sums[:-1])
    if code_held is not None:
        yield out(np.array([code_held]), np.array([n_held]))


def together(pairs: DataFrame, group: str, item: str, n_groups: DataFrame, min_shared: int = 1, min_lift: float = 0.0, block: int = BLOCK) -> DataFrame:
    """``item_a, item_b, shared, n_a, n_b, n_groups, lift, odds_ratio`` of items that share groups.

    ``n_groups``: a one-row frame with a column ``n_groups``.
    """
    seen = pairs.select(F.col(group).alias("g"), F.col(item).alias("item")).filter(F.col("g").isNotNull() & (F.trim(F.col("item")) != "")).distinct()
    total = F.broadcast(n_groups.select("n_groups"))
    counts = seen.groupBy("item").agg(F.count("*").alias("n")).filter(F.col("n") >= min_shared)
    if min_lift > 0:
        counts = counts.join(total).filter(F.col("n") * F.lit(min_lift) <= F.col("n_groups")).drop("n_groups")
    ids = materialize(dense_ids(counts, "item"), "items")
    member = seen.join(ids.select("item", "id"), "item").select("g", "id")
    sizes = member.groupBy("g").agg(F.count("*").alias("m")).filter(F.col("m") > 1)
    blocks = F.ceil(F.col("m") / F.lit(block)).cast("int")
    placed = member.join(sizes, "g").withColumn("k", blocks).withColumn("b", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    placed = placed.select("g", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "id")
    lists = placed.groupBy("g", "i", "j").agg(
        F.collect_list(F.when(F.col("b") == F.col("i"), F.col("id"))).alias("left"),
        F.collect_list(F.when(F.col("b") != F.col("i"), F.col("id"))).alias("right"),
    )
    lists = lists.select("left", F.when(F.col("i") != F.col("j"), F.col("right")).alias("right"))
    codes = lists.mapInArrow(_codes, "code long, n long")
    runs = codes.repartition(F.col("code")).sortWithinPartitions("code").mapInArrow(_runs, "code long, shared long")
    runs = runs.filter(F.col("shared") >= min_shared)
    low, high = F.shiftright("code", 32), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF))
    a = ids.select(F.col("id").alias("ia"), F.col("item").alias("item_a"), F.col("n").alias("n_a"))
    b = ids.select(F.col("id").alias("ib"), F.col("item").alias("item_b"), F.col("n").alias("n_b"))
    got = runs.withColumn("ia", low).withColumn("ib", high).join(a, "ia").join(b, "ib").join(total)
    s, na, nb, n = (F.col(c).cast("double") for c in ("shared", "n_a", "n_b", "n_groups"))
    lift = s * n / (na * nb)
    odds = ((s + 0.5) * (n - na - nb + s + 0.5)) / ((na - s + 0.5) * (nb - s + 0.5))
    got = got.select("item_a", "item_b", "shared", "n_a", "n_b", "n_groups", lift.alias("lift"), odds.alias("odds_ratio"))
    # In whole numbers, so that a lift of exactly the bound stays.
    return got.filter(F.col("shared") * F.col("n_groups") >= F.lit(min_lift) * F.col("n_a") * F.col("n_b")) if min_lift > 0 else got
