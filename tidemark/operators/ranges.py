"""Joins of points or intervals with intervals, without nested loops.

Intervals are cut into buckets of a fixed width; a point then meets only the intervals of its bucket through a hash or
sort-merge join, and a residual predicate decides.  Intervals far longer than the width cost length / width rows each.
Null ends or points match nothing; an interval whose end lies before its start is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize


def _bucket(value: Column, width: int) -> Column:
    return F.floor(value / F.lit(width))


def point_in_interval(points: DataFrame, at: str, intervals: DataFrame, start: str, end: str, width: int, how: str = "inner") -> DataFrame:
    """Rows of ``points`` with each interval that holds ``at``, ends included."""
    cut = intervals.filter(F.col(start) <= F.col(end)).withColumn("_b", F.explode(F.sequence(_bucket(F.col(start), width), _bucket(F.col(end), width))))
    keyed = points.withColumn("_b", _bucket(F.col(at), width))
    return keyed.alias("p").join(cut.alias("i"), (F.col("p._b") == F.col("i._b")) & F.col(at).between(F.col(start), F.col(end)), how).drop("_b")


def overlapping(a: DataFrame, a_start: str, a_end: str, b: DataFrame, b_start: str, b_end: str, width: int) -> DataFrame:
    """Pairs of overlapping intervals, each once: the bucket where the later one of the starts lies decides."""
    cut = lambda df, s, e: df.filter(F.col(s) <= F.col(e)).withColumn("_b", F.explode(F.sequence(_bucket(F.col(s), width), _bucket(F.col(e), width))))
    x, y = cut(a, a_start, a_end).alias("x"), cut(b, b_start, b_end).alias("y")
    on = (F.col("x._b") == F.col("y._b")) & (F.col(a_start) <= F.col(b_end)) & (F.col(b_start) <= F.col(a_end)) & (F.col("x._b") == _bucket(F.greatest(a_start, b_start), width))
    return x.join(y, on).drop("_b")


def first_container(inner: DataFrame, start: str, end: str, outer: DataFrame, outer_start: str, outer_end: str, order: str, keep: str, width: int) -> DataFrame:
    """``inner`` with ``keep`` of the first interval of ``outer`` (by ``order``) that contains it, else null."""
    hit = point_in_interval(inner, start, outer.select(F.col(outer_start).alias("_s"), F.col(outer_end).alias("_e"), F.col(order).alias("_o"), F.col(keep).alias("_k")), "_s", "_e", width).filter(F.col(end) <= F.col("_e"))
    best = hit.groupBy(*inner.columns).agg(F.min_by("_k", "_o").alias(keep))
    left, right = inner.alias("l"), best.select(*[F.col(c).alias(f"_{c}") for c in inner.columns], keep)
    return left.join(right, [F.col(f"l.{c}").eqNullSafe(F.col(f"_{c}")) for c in inner.columns], "left").select(*[F.col(f"l.{c}") for c in inner.columns], keep)


def equal_ranges(points: DataFrame, at: str, width: int, name: str) -> DataFrame:
    """``name, start, end``: consecutive ranges of ``width`` from 1 up to the greatest ``at``."""
    top = points.agg(F.max(at).alias("top"))
    k = top.select(F.explode(F.sequence(F.lit(0), F.floor((F.col("top") - 1) / width).cast("int"))).alias("k"))
    return k.select((F.col("k") + 1).alias(name), (F.col("k") * width + 1).alias("start"), ((F.col("k") + 1) * width).alias("end"))


def following(df: DataFrame, order: str, value: str, name: str, parts: int | None = None) -> DataFrame:
    """``df`` with column ``name``: the ``value`` of the next row by ``order``, a column without nulls or repeats.

    Rows are ranged by ``order``; each range looks ahead on its own, and its last row takes the first value of the next
    range that has rows. Only that one row a range meets in one task.
    """
    ranged = df.repartitionByRange(parts, order) if parts else df.repartitionByRange(order)
    local = materialize(ranged.withColumn("_part", F.spark_partition_id()), "following")
    first = local.groupBy("_part").agg(F.min_by(value, order).alias("_first"), F.max(order).alias("_last"))
    border = first.select("_part", "_last", F.lead("_first").over(Window.orderBy("_part")).alias("_next"))
    ahead = F.lead(value).over(Window.partitionBy("_part").orderBy(order))
    got = local.withColumn(name, ahead).join(F.broadcast(border), "_part")
    return got.withColumn(name, F.when(F.col(order) == F.col("_last"), F.col("_next")).otherwise(F.col(name))).select(*df.columns, name)


def numbered(df: DataFrame, order: list[Column], name: str, parts: int | None = None) -> DataFrame:
    """``df`` with column ``name``: its place by ``order`` from 1, ranged and sorted; no task numbers the whole table.

    Only the number of rows of each range meets in one task. Rows that are equal in ``order`` have any order.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    local = materialize(ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_id", 33)
    sizes = local.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = sizes.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    place = F.col("_base") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return local.withColumn("_part", part).join(F.broadcast(before), "_part").select(*df.columns, place.alias(name))
