import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import similar

DIM = 24


def vectors(n=700, seed=5):
    rng = np.random.default_rng(seed)
    topics = rng.normal(size=(12, DIM))
    x = topics[rng.integers(0, 12, n)] + 0.5 * rng.normal(size=(n, DIM))
    x[: n // 3] = topics[0] + 0.3 * rng.normal(size=(n // 3, DIM))  # a crowded topic
    return x.astype(np.float32) * rng.uniform(0.2, 5, (n, 1)).astype(np.float32)


def exact(x, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return np.argsort(-s, axis=1)[:, :k], s


@pytest.mark.parametrize("block", [64, 8192])
def test_recall(spark, block):
    x = vectors()
    df = spark.createDataFrame([(f"v{i}", v.tolist()) for i, v in enumerate(x)], "vid string, e array<float>").withColumn("id", F.lit(0)).withColumn("code", F.lit("c"))
    top, s = exact(x, 5)
    got = similar.knn(df, "vid", "e", dim=DIM, list_size=40, probes=8, postings=2, bits=16, block=block).collect()
    mine = {}
    for r in got:
        mine.setdefault(int(r["id"][1:]), set()).add(int(r["neighbour"][1:]))
        assert r["similarity"] == pytest.approx(s[int(r["id"][1:]), int(r["neighbour"][1:])], abs=1e-3)
    recall = np.mean([len(mine[i] & set(top[i])) / 5 for i in range(len(x))])
    assert recall >= 0.9


def test_copies_and_dirt(spark):
    v = [1.0] + [0.0] * (DIM - 1)
    w = [0.9, 0.1] + [0.0] * (DIM - 2)
    rows = [(f"c{k:03d}", v) for k in range(50)] + [("w", w), ("zero", [0.0] * DIM), ("short", [1.0]), ("null", None), ("nan", [float("nan")] * DIM), ("hole", [None] + [1.0] * (DIM - 1)), (None, v), ("inf", [float("inf")] + [0.0] * (DIM - 1))]
    got = similar.knn(spark.createDataFrame(rows, "i string, e array<float>"), "i", "e", dim=DIM, min_similarity=0.5, bits=16).collect()
    per = {}
    for r in got:
        per.setdefault(r["id"], []).append(r["neighbour"])
    assert set(per) == {f"c{k:03d}" for k in range(50)} | {"w"}
    assert all(len(n) == 5 and len(set(n)) == 5 for n in per.values())
    assert per["c000"] == ["c001", "c002", "c003", "c004", "c005"] and per["w"] == ["c000", "c001", "c002", "c003", "c004"]


def test_few_rows(spark):
    schema = "i string, e array<float>"
    assert similar.knn(spark.createDataFrame([], schema), "i", "e", dim=DIM).count() == 0
    assert similar.knn(spark.createDataFrame([("a", [1.0] * DIM)], schema), "i", "e", dim=DIM).count() == 0
    two = similar.knn(spark.createDataFrame([("a", [1.0] * DIM), ("b", [2.0] * (DIM - 1) + [1.0])], schema), "i", "e", dim=DIM)
    assert sorted((r["id"], r["neighbour"]) for r in two.collect()) == [("a", "b"), ("b", "a")]


def test_lists_are_balanced():
    x = vectors(3000)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = similar.balanced_centroids(u, 40, 4096)
    sizes = np.bincount(np.argmax(u @ c.T, axis=1), minlength=len(c))
    assert sizes.max() < 10 * 40 and len(c) >= 3000 / 40


def test_the_walk_finds_the_nearest_centroids():
    v = vectors(3400, seed=9)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    order = np.random.default_rng(1).permutation(len(v))
    c, x = v[order[:3000]], v[order[3000:]]
    top, cos = similar.CentroidGraph(c).nearest(x, 5)
    want = np.argsort(-(x @ c.T), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(top, want)]) >= 0.95
    assert (np.diff(cos, axis=1) <= 1e-6).all()
    one, _ = similar.CentroidGraph(c[:1]).nearest(x, 5)
    assert one.shape == (400, 1)


def test_lists_that_outgrow_the_graph(spark, monkeypatch):
    """Six lists for 3,000 vectors: each is parted again, and the result stays as good."""
    monkeypatch.setattr(similar, "MAX_LISTS", 6)
    monkeypatch.setattr(similar, "SUB_SAMPLE", 100)
    x = vectors(3000)
    df = spark.createDataFrame([(f"v{i}", v.tolist()) for i, v in enumerate(x)], "vid string, e array<float>")
    top, _ = exact(x, 5)
    mine = {}
    for r in similar.knn(df, "vid", "e", dim=DIM, list_size=100, block=200).collect():
        mine.setdefault(int(r["id"][1:]), set()).add(int(r["neighbour"][1:]))
    assert all(len(n) == 5 for n in mine.values()) and len(mine) == 3000
    assert np.mean([len(mine[i] & set(top[i])) / 5 for i in range(len(x))]) >= 0.9
