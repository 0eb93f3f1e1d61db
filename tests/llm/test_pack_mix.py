import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mix, pack, tokens


def test_bounds_are_optimal():
    r = random.Random(2)
    for _ in range(10):
        lengths = np.array(sorted(r.sample(range(1, 60), 9)))
        counts = np.array([r.randrange(1, 30) for _ in lengths])
        got = pack.bucket_bounds(lengths, counts, 3)
        waste = lambda b: sum(c * (min(x for x in b if x >= n) - n) for n, c in zip(lengths, counts))
        best = min(waste((*pick, lengths[-1])) for k in range(3) for pick in itertools.combinations(lengths[:-1], k))
        assert waste(got) == best


def test_containers(spark):
    r = random.Random(4)
    rows = [(k, r.choice([1, 5, 40, 60, 99, 100, 101, 250, 1000])) for k in range(800)] + [(k, 40) for k in range(2000, 2600)] + [(9000, 0), (9001, None), (None, 10)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long").repartition(7).withColumn("id", F.lit(1)).withColumn("piece", F.lit(1)).withColumn("bucket", F.lit("b"))
    limits = spark.createDataFrame([("s", 100), ("l", 700), ("none", None), ("zero", 0)], "pack_name string, capacity_tokens int")
    got = pack.pack(df, limits)
    out = [x.asDict() for x in got.collect()]
    for name, cap in (("s", 100), ("l", 700)):
        mine = [x for x in out if x["pack_name"] == name]
        load = {}
        for x in mine:
            load[x["container"]] = load.get(x["container"], 0) + x["tokens"]
        assert max(load.values()) <= cap
        parts = {}
        for x in mine:
            parts.setdefault(x["doc_id"], []).append((x["start_token"], x["end_token"]))
        for doc, n in rows:
            if n:
                ends = sorted(parts[doc])
                assert ends[0][0] == 0 and ends[-1][1] == n and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
                assert len(ends) == -(-n // cap)
        assert sum(load.values()) / (len(load) * cap) > 0.9
        assert sorted(load) == list(range(len(load)))
    assert {x["pack_name"] for x in out} == {"s", "l"}
    assert pack.fill(got, limits).count() == 2
    assert pack.pack(df.limit(0), limits).count() == 0
    assert pack.pack(df, limits.limit(0)).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, ""), (3, None), (4, "日本 é 😀" * 50), (5, "a" * 20000)], "doc_id long, text string")
    got = {r["doc_id"]: r["tokens"] for r in tokens.sized(df).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 50 and got[5] > 1000


def test_demands():
    src = [{"source": "a", "share": 0.5, "repeats": 1, "tokens": 1000}, {"source": "b", "share": 0.5, "repeats": 3, "tokens": 100}, {"source": "gone", "share": 0.2, "repeats": 3, "tokens": 0}, {"source": "off", "share": None, "repeats": 3, "tokens": 9}]
    total, plan = mix.demands([dict(s) for s in src])
    assert total == 600 and {s: p["demand"] for s, p in plan.items()} == {"a": 300, "b": 300}
    total, plan = mix.demands([dict(s) for s in src], 1600)
    assert {s: p["demand"] for s, p in plan.items()} == {"a": 800, "b": 300}
    t = mix.tilts(plan, 0.5)
    assert sum(t[s] * p["demand"] for s, p in plan.items()) == pytest.approx(0) and max(map(abs, t.values())) <= 0.95


def test_mix(spark):
    r = random.Random(8)
    rows = [(k, s, r.randrange(1, 50)) for k, s in enumerate(["a"] * 900 + ["b"] * 60 + ["c"] * 20 + ["x"] * 30)] + [(5000, None, 9), (5001, "a", 0)]
    items = spark.createDataFrame(rows, "doc_id long, source string, tokens long").withColumn("epoch", F.lit(1)).withColumn("t", F.lit("q"))
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 4), ("c", 0.1, 5), ("absent", 0.2, 3)], "source string, target_share double, max_repeats int")
    got = mix.mix(items, targets)
    out = got.collect()
    assert {x["source"] for x in out} == {"a", "b", "c"}
    whole = sum(x["tokens"] for x in out)
    for s, share in (("a", 0.6), ("b", 0.3), ("c", 0.1)):
        assert sum(x["tokens"] for x in out if x["source"] == s) / whole == pytest.approx(share, abs=0.02)
    uses = {}
    for x in out:
        uses[x["doc_id"]] = uses.get(x["doc_id"], 0) + 1
        assert 0 <= x["t"] <= 1
    most = {s: max(n for d, n in uses.items() if dict((k, q) for k, q, _ in rows)[d] == s) for s in "abc"}
    assert most["a"] == 1 and most["b"] <= 4 and most["c"] <= 5
    assert len({(x["doc_id"], x["epoch"]) for x in out}) == len(out)
    plan = mix.plan_of(items, targets)
    report = {x["source"]: x for x in mix.shares(got, items, targets, plan).collect()}
    assert report["absent"]["reached_share"] == 0 and report["b"]["most_uses"] == most["b"]
    plan = mix.plan_of(items, targets, 1e9)
    capped = mix.shares(mix.mix(items, targets, plan=plan), items, targets, plan)
    assert {x["source"]: x["most_uses"] for x in capped.collect()} == {"a": 1, "b": 4, "c": 5, "absent": 0}
    assert mix.mix(items.limit(0), targets).count() == 0


def test_mix_of_skewed_sizes(spark):
    rows = [(1, "plaque", 24541), (2, "plaque", 195), (3, "plaque", 125), (4, "plaque", 59), (5, "plaque", 58)] + [(100 + k, "main", 400 + k) for k in range(300)] + [(900, "vast", 50_000)]
    items = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("plaque", 0.03, 6), ("main", 0.96, 1), ("vast", 0.01, 2), ("absent", 0.1, 1), ("main", None, 9), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    total = 170_000.0
    plan = mix.plan_of(items, targets, total)
    got = mix.mix(items, targets, plan=plan)
    out = got.collect()
    assert sum(x["tokens"] for x in out if x["source"] == "plaque") == 6 * (195 + 125 + 59 + 58)
    assert abs(sum(x["tokens"] for x in out if x["source"] == "main") - min(0.96 * total, sum(n for _, s, n in rows if s == "main"))) <= 700
    r = {x["source"]: x for x in mix.shares(got, items, targets, plan).collect()}
    assert set(r) == {"plaque", "main", "vast", "absent"}
    assert r["plaque"]["reason"] == "repeats used up by the records that fit" and r["plaque"]["passed_over"] == 1 and r["plaque"]["missing_tokens"] == round(0.03 * total) - 2622
    assert r["vast"]["reason"] == "every record is larger than the demand" and r["vast"]["selected_tokens"] == 0
    assert r["absent"]["reason"] == "source does not occur"
    # The default total lets every source that can do so reach its share with the records that fit.
    total, plan = mix.plan_of(items, targets)
    assert 0 < total <= 2622 / 0.03 + 1e-6
    balanced = mix.mix(items, targets).collect()
    assert sum(x["tokens"] for x in balanced if x["source"] == "plaque") == pytest.approx(0.03 * total, abs=100)


def test_bounds_equal_the_plain_recurrence():
    r = random.Random(3)
    for _ in range(12):
        lengths = np.array(sorted(r.sample(range(1, 3000), 45)))
        counts = np.array([r.choice([1, 1, 5, 100]) for _ in lengths])
        n, s = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, counts * lengths))
        best = [lengths[j] * n[j + 1] - s[j + 1] for j in range(45)]
        for k in range(2, 12):
            best = [min([best[j], *(best[i - 1] + lengths[j] * (n[j + 1] - n[i]) - (s[j + 1] - s[i]) for i in range(1, j + 1))]) for j in range(45)]
            bounds = pack.bucket_bounds(lengths, counts, k)
            assert len(bounds) <= k and sum(c * (bounds[np.searchsorted(bounds, x)] - x) for x, c in zip(lengths, counts)) == best[-1]
