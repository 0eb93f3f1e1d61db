import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import split


def check(text, max_len, overlap):
    spans = split.cut(text, max_len, overlap)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    rebuilt = text[: spans[0][1]]
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert c <= b < d and b - c <= overlap
        rebuilt += text[b:d]
    assert rebuilt == text
    assert all(b - a <= max_len for a, b in spans)
    return spans


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .\n\r、。́é,", max_size=900), st.integers(40, 120), st.integers(0, 15))
def test_pieces_rebuild_the_text(text, max_len, overlap):
    check(text, max_len, overlap)


def test_cuts_at_paragraphs():
    text = ("word " * 500 + "\n\n") * 4
    spans = check(text, 3200, 400)
    assert all(text[:b].endswith("\n\n") for _, b in spans)


@pytest.mark.parametrize("text", ["x" * 100_000, "́" * 9000, "\r\n" * 5000, " " * 7000])
def test_no_boundaries(text):
    check(text, 3200, 400)


def test_optimal_against_brute_force():
    """The chosen cuts cost no more than any other choice from the same boundaries."""
    r = random.Random(3)
    for _ in range(15):
        text = "".join(r.choice(["aa ", "bb. ", "cc\n", "d, "]) for _ in range(40))
        max_len, overlap = 60, 10
        pos, penalty = split.boundaries(text, max(2, (max_len - overlap) // 8))
        ends, cost = [0, *pos.tolist(), len(text)], [0.0, *penalty.tolist(), 0.0]
        even = len(text) / (1 + -(-(len(text) - max_len) // (max_len - overlap)))

        def price(cuts):
            return sum(split.BALANCE * ((b - a) / even - 1) ** 2 for a, b in zip([0, *cuts], [*cuts, len(text)])) + sum(cost[ends.index(c)] for c in cuts)

        best = {0: (0.0, [])}
        for j in range(1, len(ends)):
            options = []
            for i in range(j):
                if i in best and ends[j] - ends[i] <= (max_len if i == 0 else max_len - overlap):
                    options.append((best[i][0] + split.BALANCE * ((ends[j] - ends[i]) / even - 1) ** 2 + cost[j], best[i][1] + [ends[j]]))
            if options:
                best[j] = min(options)
        chosen = [b for _, b in split.cut(text, max_len, overlap)][:-1]
        assert price(chosen) == pytest.approx(best[len(ends) - 1][0])


def test_items(spark):
    long = "Sentence one. " * 400
    wiki = spark.createDataFrame(
        [("p", long, json.dumps({"A": long, "B": "short", "C": 3}), 1), ("p", long, json.dumps({"A": long}), 2), ("q", None, "{broken", 3), ("r", "", None, 4), (None, "tiny", " ", 5)],
        "page_id string, full_text string, sections string, field int",
    )
    chunks = spark.createDataFrame([("c", "x" * 3200, 0), ("d", "x" * 3201, 0)], "chunk_id string, chunk_text string, piece int")
    items = split.wiki_items(wiki, chunks)
    pieces = split.split_items(items)
    assert sorted(map(tuple, split.oversized(pieces).collect())) == [("chunk_text", "d", ""), ("full_text", "p", ""), ("sections", "p", "A")]
    assert pieces.filter("field = 'full_text' and item_id = 'r'").first()["text"] == ""
    assert pieces.filter("length(text) > 3200").count() == 0
    once = split.split_items(items, distinct=True)
    assert once.count() == pieces.distinct().count() < pieces.count()
    assert split.split_items(items.limit(0)).count() == 0


def test_unreadable_sections():
    assert split.sections_of(None) == split.sections_of(" ") == split.sections_of("[1]") == split.sections_of("{x") == []
    assert split.sections_of('{"a": "b", "n": null}') == [("a", "b")]
