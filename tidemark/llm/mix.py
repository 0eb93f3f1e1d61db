"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1]: its share times ``1 + tilt * (2 t - 1)``.  The
integral of the schedule is the source's cumulative token demand; a record whose tokens lie around cumulative token c of
its source is trained at the time when the demand reaches c, which is the schedule's integral inverted in closed form.
Records are then range-sorted by that position.  Tilts are centred so that the weights add up to 1 at every t.

Total.  By default the largest total at which every source present reaches its share within its allowed repeats (shares
are scaled to the sources present, as a listed source need not occur).  A given ``total`` may be larger: a source then
contributes what its repeats allow, the rest keep their part, and the reached shares are reported with what is missing
and why.

Sizes.  A record with more tokens than its source's whole demand is passed over, and the records that fit repeat in its
stead, up to the cap.  Which records fit depends on the demand and the default total on what fits, so both are settled by
repeated aggregation; the driver sees one row per source.

Cumulative tokens come from a range partitioning by (source, hash of id) with one offset per partition and source; no
source, however large, is sorted in one task.

Defined results: records with null source, of a source without target, or without tokens are not selected; a source with
share 0, null share or ``max_repeats`` below 1 contributes nothing; equal rows are separate records; a source listed
twice counts with its larger share.  The last record of a source is taken when its middle lies within the demand, so a
share is off by at most half a record that fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize


def demands(sources: list[dict], total: float | None = None) -> tuple[float, dict[str, dict]]:
    """The total, and per source its wanted tokens and its demand.

    ``sources``: source, share, repeats, tokens, and ``fit``, the tokens of the records that are not larger than the
    demand (all tokens where it is missing).
    """
    live = [s for s in sources if s["tokens"] and (s["share"] or 0) > 0 and (s["repeats"] or 0) >= 1]
    weight = sum(s["share"] for s in live)
    if not live:
        return 0.0, {}
    for s in live:
        s["part"], s["cap"] = s["share"] / weight, float(s.get("fit", s["tokens"])) * s["repeats"]
    if total is None:
        total = min((s["cap"] / s["part"] for s in live if s["cap"]), default=0.0)
    return total, {s["source"]: s | {"wanted": s["part"] * total, "demand": min(s["part"] * total, s["cap"])} for s in live}


def plan_of(items: DataFrame, targets: DataFrame, total: float | None = None) -> tuple[float, dict[str, dict]]:
    """``demands`` of ``items(source, tokens)``, settled with the records that fit."""
    spark = items.sparkSession
    listed = _listed(targets)
    base = items.filter((F.col("tokens") > 0) & F.col("source").isNotNull()).select("source", "tokens").join(F.broadcast(listed.select("source")), "source", "left_semi")
    have = {r["source"]: int(r["n"]) for r in base.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}  # one row per target
    sources = [{"source": r["source"], "share": r["share"], "repeats": r["repeats"], "tokens": have.get(r["source"], 0)} for r in listed.collect()]
    got, plan = demands(sources, total)
    while plan:
        bound = F.broadcast(spark.createDataFrame([(s, float(p["wanted"])) for s, p in plan.items()], "source string, wanted double"))
        fit = base.join(bound, "source").filter(F.col("tokens") <= F.col("wanted")).groupBy("source").agg(F.sum("tokens").alias("n"))
        fits = {r["source"]: int(r["n"]) for r in fit.collect()}
        if all(fits.get(s, 0) == p.get("fit", p["tokens"]) for s, p in plan.items()):
            break
        for s in sources:
            s["fit"] = fits.get(s["source"], 0)
        # The total only falls, so this ends; a source none of whose records fits does not hold the others back.
        got, plan = demands(sources, min(got, demands([dict(s) for s in sources])[0]) if total is None else total)
    return got, plan


def _listed(targets: DataFrame) -> DataFrame:
    top = targets.filter(F.col("source").isNotNull()).groupBy("source").agg(F.max(F.struct(F.col("target_share").alias("share"), F.col("max_repeats").alias("repeats"))).alias("t"))
    return top.select("source", "t.share", "t.repeats")


def tilts(plan: dict[str, dict], strength: float) -> dict[str, float]:
    """Small sources come later: tilts rise with falling share, centred so that weights always add up to the same."""
    names = sorted(plan, key=lambda s: (-plan[s]["demand"], s))
    if len(names) < 2:
        return dict.fromkeys(names, 0.0)
    raw = {s: strength * (2 * i / (len(names) - 1) - 1) for i, s in enumerate(names)}
    whole = sum(plan[s]["demand"] for s in names)
    mean = sum(plan[s]["demand"] * raw[s] for s in names) / whole
    shifted = {s: raw[s] - mean for s in names}
    most = max(abs(v) for v in shifted.values())
    return {s: v / max(1.0, most / 0.95) for s, v in shifted.items()}


def mix(items: DataFrame, targets: DataFrame, id_col: str = "doc_id", total: float | None = None, strength: float = 0.5, plan: tuple[float, dict[str, dict]] | None = None) -> DataFrame:
    """``position, id_col, source, epoch, tokens, t`` in training order, for ``items(id_col, source, tokens)``.

    ``targets(source, target_share, max_repeats)`` is a configuration table; ``position`` is the record's place on the
    axis of the total's tokens.  ``plan``: the result of ``plan_of`` if it is known already.
    """
    spark = items.sparkSession
    total, sources = plan or plan_of(items, targets, total)
    tilt = tilts(sources, strength)
    rows = [(s, float(p["demand"]), float(p["wanted"]), int(p.get("fit", p["tokens"])), int(p["repeats"]), tilt[s]) for s, p in sources.items() if p["demand"] > 0]
    schedule = F.broadcast(spark.createDataFrame(rows or [("", 0.0, 0.0, 1, 0, 0.0)], "source string, demand double, wanted double, available long, repeats int, tilt double"))
    base = items.select(F.col(id_col).alias("id"), "source", "tokens").filter((F.col("tokens") > 0) & F.col("source").isNotNull())
    chosen = base.join(schedule.select("source", "wanted"), "source").filter(F.col("tokens") <= F.col("wanted")).withColumn("key", F.xxhash64("id"))
    ranged = chosen.select("source", "key", "id", "tokens").repartitionByRange("source", "key", "id").sortWithinPartitions("source", "key", "id")
    id_type = base.schema["id"].dataType.simpleString()

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            names, tokens = batch.column(0).to_pylist(), batch.column(3).to_numpy()
            start = np.zeros(len(tokens), dtype=np.int64)
            edge = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)] if names else [0]
            for a, b in zip(edge, edge[1:]):
                c = np.cumsum(tokens[a:b])
                start[a:b] = held.get(names[a], 0) + c - tokens[a:b]
                held[names[a]] = held.get(names[a], 0) + int(c[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(start), pa.array(np.full(len(tokens), part, np.int32))], ["source", "id", "tokens", "start", "part"])

    local = materialize(ranged.mapInArrow(running, f"source string, id {id_type}, tokens long, start long, part int"), "mix")
    sums = local.groupBy("source", "part").agg(F.sum("tokens").alias("sum"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    doc = local.join(offsets, ["source", "part"]).join(schedule, "source")
    middle = F.col("start") + F.col("offset") + F.col("tokens") / 2
    copies = F.least(F.ceil((F.col("demand") - middle) / F.col("available")).cast("int"), F.col("repeats"))
    doc = doc.withColumn("middle", middle).withColumn("copies", copies).filter(F.col("copies") > 0)
    doc = doc.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    u = F.least(F.lit(1.0), (F.col("middle") + F.col("epoch") * F.col("available")) / F.col("demand"))
    a = F.col("tilt")
    t = F.when(F.abs(a) < 1e-9, u).otherwise((F.sqrt((1 - a) * (1 - a) + 4 * a * u) - (1 - a)) / (2 * a))
    out = doc.select(F.floor(t * F.lit(float(total))).alias("position"), F.col("id").alias(id_col), "source", "epoch", "tokens", t.alias("t"))
    return out.repartitionByRange("t", id_col, "epoch").sortWithinPartitions("t", id_col, "epoch")


def shares(mixed: DataFrame, items: DataFrame, targets: DataFrame, plan: tuple[float, dict[str, dict]]) -> DataFrame:
    """One row per listed source: wanted and reached tokens and shares, how often its records are used at most, the
    records passed over as larger than the demand, and what is missing, with the reason.

    ``plan``: the result of ``plan_of`` that ``mixed`` was made by.
    """
    spark = items.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(s, float(p["wanted"]), float(p["demand"])) for s, p in plan[1].items()] or [("", 0.0, 0.0)], "source string, wanted double, demand double"))
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("selected_tokens"), (F.max("epoch") + 1).alias("most_uses"), F.count("*").alias("records"))
    have = items.select("source", "tokens").filter(F.col("tokens") > 0).join(wanted.select("source", "wanted"), "source", "left")
    have = have.groupBy("source").agg(F.sum("tokens").alias("available_tokens"), F.count(F.when(F.col("tokens") > F.col("wanted"), 1)).alias("passed_over"))
    whole = got.agg(F.sum("selected_tokens").alias("total_tokens"))
    listed = _listed(targets).withColumnsRenamed({"share": "target_share", "repeats": "max_repeats"})
    out = listed.join(got, "source", "left").join(have, "source", "left").join(wanted, "source", "left").join(F.broadcast(whole))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    share = F.coalesce(F.col("selected_tokens") / F.col("total_tokens"), F.lit(0.0)).alias("reached_share")
    missing = F.greatest(F.lit(0), F.ceil(F.coalesce("wanted", F.lit(0.0)) - F.coalesce("selected_tokens", F.lit(0)))).cast("long").alias("missing_tokens")
    reason = (
        F.when(F.coalesce("available_tokens", F.lit(0)) == 0, "source does not occur")
        .when(F.col("wanted").isNull(), "no share or no use allowed")
        .when(F.col("demand") >= F.col("wanted"), "")
        .when(F.coalesce("selected_tokens", F.lit(0)) == 0, "every record is larger than the demand")
        .when(F.col("passed_over") > 0, "repeats used up by the records that fit")
        .otherwise("repeats used up")
    )
    wants = F.round(F.coalesce("wanted", F.lit(0.0))).cast("long").alias("wanted_tokens")
    return out.select("source", "target_share", "max_repeats", zero("available_tokens"), wants, zero("selected_tokens"), zero("records"), zero("most_uses"), zero("passed_over"), share, missing, reason.alias("reason"))
