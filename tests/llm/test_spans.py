import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import spans

N = 200


def brute(docs):
    where = defaultdict(set)
    for i, t in docs:
        for p in range(len(t or "") - N + 1):
            where[t[p : p + N]].add(i)
    links = {(a, b) for s in where.values() for a in s for b in s if a < b}
    covered = {}
    for i, t in docs:
        marks = [False] * len(t or "")
        for p in range(len(t or "") - N + 1):
            if len(where[t[p : p + N]]) > 1:
                marks[p : p + N] = [True] * N
        covered[i] = sum(marks)
    return links, covered


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé日😀 ") for _ in range(r.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    notice, passage, frame = text(40)[:190], text(200), text(60)[:199]
    docs = [(k, text(r.randrange(5, 150))) for k in range(20)]
    docs += [(100 + k, text(20) + notice + text(20)) for k in range(90)]  # a notice under the length in many texts
    for k in range(30):
        n = r.choice([199, 200, 201, 260, 700])
        a = r.randrange(len(passage) - n)
        docs.append((300 + k, text(r.randrange(0, 20)) + passage[a : a + n] + text(r.randrange(0, 20))))
    docs += [(400, passage), (401, passage), (402, None), (403, ""), (404, "a" * 900), (405, "b" + "a" * 450), (406, "ab" * 300), (407, frame), (408, frame + "x"), (409, "y" + frame + "x"), (410, passage[:250] + "|" + passage[:250])]
    dash = lambda n, t="-": (t * n)[:n]
    docs += [(600, text(20) + dash(1500) + text(20)), (601, text(10) + dash(300) + text(5)), (602, dash(199) + text(3)), (603, text(2) + dash(200)), (604, dash(700, "ab") + text(4)), (605, text(4) + dash(230, "ba") + text(4)), (606, dash(900, "=-~") + text(3))]
    docs += [(610, dash(900, "=-~.") + text(9)), (611, text(9)[:60] + dash(160) + "end"), (612, "q" + dash(160) + "end of the line" + passage[:60]), (613, dash(800, "0123456789" * 4 + "x")), (614, text(6) + dash(330, "0123456789" * 4 + "x")), (615, dash(850, "0123456789" * 3))]
    docs += [(620 + k, passage[:400] + dash(600) + passage[400:]) for k in range(3)] + [(630, dash(2000)), (631, dash(2000))]
    docs += [(500 + k, text(3) + "Q" * (k % 3) + notice + text(1)[:4] + "tail of the notice goes on" + str(k % 2)) for k in range(80)]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("direct", [1, 64])
def test_against_brute_force(spark, seed, direct):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("pos", F.lit(1)).withColumn("h", F.lit("x"))
    parsed = spans.Parsed(df, direct=direct)
    links, covered = brute(docs)
    assert {(r["doc_a"], r["doc_b"]) for r in parsed.links().collect()} == links
    got = defaultdict(int)
    for r in parsed.spans().collect():
        got[r["doc_id"]] += r["end"] - r["start"]
    assert {i: got[i] for i in covered} == covered


def test_periodic_text_has_few_anchors():
    hasher = spans.Hasher()
    for unit in ("a", "ab", "abc ", "0123456789" * 4):
        at, h, fill = spans.anchors_of((unit * 1_000_000)[:1_000_000], hasher)
        assert len(at) == len(h) <= 250 and fill.max() > 900_000


def test_pairs_are_made_once(spark, monkeypatch):
    """A copied passage is paired at its start, a text that many documents bear once, in lists of any size."""
    monkeypatch.setattr(spans, "CHUNK", 3)
    r = random.Random(4)
    passage = "".join(r.choice("abcdefgh ") for _ in range(4000))
    docs = [(k, f"{k} one " + passage[: 3000 + k]) for k in range(12)] + [(50 + k, passage) for k in range(9)] + [(70, passage)] * 2
    parsed = spans.Parsed(spark.createDataFrame(docs, "doc_id long, text string"))
    links, _ = brute(sorted(set(docs)))
    got = [(x["doc_a"], x["doc_b"]) for x in parsed.links().collect()]
    assert len(got) == len(set(got)) and set(got) == links
    rows = {x["doc_id"]: x for x in spans.text_classes(spark.createDataFrame(docs + [(99, None)], "doc_id long, text string")).collect()}
    assert len(rows) == 23 and rows[70]["class_id"] == 50 and rows[70]["copies"] == 10 and rows[3]["links"] == 12 and rows[55]["links"] == 12 and rows[99]["links"] == 0


def test_one_row_per_document(spark):
    docs = [(1, "x" * 250), (2, "x" * 250), (3, None), (4, "")]
    got = {r["doc_id"]: r for r in spans.shared_fraction(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1]["shared_fraction"] == got[2]["shared_fraction"] == 1.0 and got[3]["shared_chars"] == got[4]["shared_chars"] == 0
    assert spans.shared_fraction(spark.createDataFrame([], "doc_id long, text string")).count() == 0
