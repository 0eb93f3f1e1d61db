"""Weighted importance scores from normalised signals, and tiers from nearest-rank cut points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import any_of

#: Weights of the signals (they sum to 1) and the shares of the tiers' cut points.
WEIGHTS = {"appearance": 0.25, "breadth": 0.20, "bounty": 0.15, "affiliation": 0.15, "cover": 0.10, "arc_main": 0.05, "conqueror": 0.05, "power": 0.03, "bio": 0.02}
CUTS = (("S", 0.99), ("A", 0.95), ("B", 0.80), ("C", 0.50))
#: Ordered keyword tiers of groups and ranks; the first tier masks the two lower ranks that contain its word.
AFFILIATION_TIERS = (
    (1.00, ("yonko", "four emperors", "emperors of the sea", "gorosei", "five elders", "first twenty", "holy knights", "king of the world", "celestial dragon", "world nobles",
            "fleet admiral", "commander-in-chief", "supreme commander", "admiral", "pirate king", "roger pirates")),
    (0.75, ("vice admiral", "shichibukai", "seven warlords", "warlord of the sea", "sword", "revolutionary army", "revolutionary commander", "cipher pol", "straw hat pirates", "straw hat grand fleet")),
    (0.50, ("rear admiral", "supernova", "worst generation", "whitebeard pirates", "big mom pirates", "beasts pirates", "red hair pirates", "blackbeard pirates", "donquixote pirates",
            "baroque works officer agents", "tobiroppo", "flying six", "all-stars")),
    (0.30, ("pirates", "marines", "kingdom", "samurai", "fishman", "giant", "kuja")),
)


def check_weights(weights: dict[str, float], threshold: float = 0.5) -> None:
    if set(weights) != set(WEIGHTS):
        raise ValueError(f"weights must be given for exactly {sorted(WEIGHTS)}")
    if abs(sum(weights.values()) - 1) > 1e-6 or min(weights.values()) < 0:
        raise ValueError("weights must be non-negative and sum to 1")
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")


def log_norm(value: Column, most: Column) -> Column:
    """log(1 + x) against the greatest; 0 for null or non-positive."""
    return F.when((value > 0) & (most > 0), F.log1p(value.cast("double")) / F.log1p(most.cast("double"))).otherwise(0.0)


def affiliation_score(text: Column) -> Column:
    low = F.lower(text)
    masked = F.regexp_replace(low, "vice admiral|rear admiral", "")
    got = F.when(any_of(masked, AFFILIATION_TIERS[0][1]), 1.0)
    for value, words in AFFILIATION_TIERS[1:]:
        got = got.when(any_of(low, words), value)
    return got.otherwise(0.0)


def weighted(signals: dict[str, Column], weights: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for name, w in weights.items():
        if name in signals:
            total = total + F.lit(w) * signals[name]
    return total


def cut_points(scores: DataFrame, score: str) -> DataFrame:
    """One row: the values at index round(p * (n - 1)) of the ascending scores, per tier.

    The indices are looked up in a histogram of the distinct values with running counts, range-partitioned by value, so
    no task sorts all scores.
    """
    from pyspark.sql import Window

    hist = scores.groupBy(F.col(score).alias("v")).agg(F.count("*").alias("n")).repartitionByRange("v").sortWithinPartitions("v")
    hist = hist.withColumn("p", F.spark_partition_id())
    sums = hist.groupBy("p").agg(F.sum("n").alias("s"))
    before = sums.select("p", F.coalesce(F.sum("s").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    run = hist.join(F.broadcast(before), "p").withColumn("upto", F.col("base") + F.sum("n").over(Window.partitionBy("p").orderBy("v")))
    n = F.broadcast(scores.agg(F.count("*").alias("total")))
    at = run.join(n)
    picks = [F.min(F.when(F.col("upto") > F.rint(F.lit(p) * (F.col("total") - 1)), F.col("v"))).alias(t) for t, p in CUTS]
    return at.agg(*picks)


def tier(score: Column) -> Column:
    """Tier of a score, given the columns S, A, B and C of the cut points."""
    got = F.when(score >= F.col("S"), "S")
    for t, _ in CUTS[1:]:
        got = got.when(score >= F.col(t), t)
    return got.otherwise("D")
