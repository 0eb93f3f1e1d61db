import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import cooccur


def brute(rows, n, min_shared, min_lift):
    groups = defaultdict(set)
    for g, i in rows:
        if g is not None and i is not None and i.strip():
            groups[g].add(i)
    count = Counter(i for s in groups.values() for i in s)
    pairs = Counter(p for s in groups.values() for p in itertools.combinations(sorted(s, key=lambda x: x.encode()), 2))
    return sorted((a, b, c, count[a], count[b]) for (a, b), c in pairs.items() if c >= min_shared and c * n >= min_lift * count[a] * count[b])


@pytest.mark.parametrize("block", [2, 3, 1000])
@pytest.mark.parametrize("min_shared,min_lift", [(1, 0), (2, 1.2), (3, 0)])
def test_against_brute_force(spark, block, min_shared, min_lift):
    r = random.Random(block)
    names = ["a", "B", "é", "zz", "hot", "😀", "�", *map(str, range(12))]
    rows = [(r.randrange(30), r.choice(names)) for _ in range(300)] + [(g, "hot") for g in range(30)] + [(None, "a"), (3, None), (3, "  "), (3, "")]
    df = spark.createDataFrame(rows, "chapter int, character string").withColumn("item", F.lit("x")).withColumn("g", F.lit(0))
    n = spark.createDataFrame([(30,)], "n_groups long")
    got = cooccur.together(df, "chapter", "character", n, min_shared, min_lift, block)
    assert sorted((x["item_a"], x["item_b"], x["shared"], x["n_a"], x["n_b"]) for x in got.collect()) == brute(rows, 30, min_shared, min_lift)


def test_measures(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (4, "c")], "g int, i string")
    x = cooccur.together(df, "g", "i", spark.createDataFrame([(4,)], "n_groups long")).first()
    assert x["lift"] == pytest.approx(2 * 4 / (3 * 2)) and x["odds_ratio"] == pytest.approx((2.5 * 1.5) / (1.5 * 0.5))


def test_empty(spark):
    df = spark.createDataFrame([], "g int, i string")
    assert cooccur.together(df, "g", "i", spark.createDataFrame([(0,)], "n_groups long"), 1, 2.0).count() == 0
