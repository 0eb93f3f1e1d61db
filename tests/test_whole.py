"""Queries that keep every row of their job, on small tables written for each test."""

import datetime
import json
from collections import Counter

from tidemark.operators import chunks, network, ranges, search
from tidemark.plans import story, texts


def write(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_networks_keep_rare_characters_and_light_edges(spark, tmp_path):
    coc = [(1, "a"), (1, "b"), (2, "b"), (2, "b"), (2, "c"), (4, "d"), (None, "a"), (1, " "), (2, None)]
    d = write(spark, tmp_path, coc=(coc, "chapter int, character string"), chapter=([(k,) for k in range(1, 5)], "number int"))
    run = lambda name: rows(story.queries()[name](spark, d))
    assert run("coappear_chapter") == [("a", "b", 1), ("b", "c", 2)]
    every = [(a, b, 1) for a, b in ("ab", "ac", "ad", "bc", "bd", "cd")]
    assert run("coappear_arc") == every and run("coappear_saga") == every
    assert run("coappear_consec_2") == [("a", "b", 1), ("a", "c", 1), ("b", "c", 2)]
    assert run("coappear_consec_3") == [("a", "b", 1), ("a", "c", 1), ("b", "c", 2), ("b", "d", 1), ("c", "d", 1)]
    assert run("network_degree") == [("a", 1, 1), ("b", 2, 2), ("c", 1, 1), ("d", 0, 0)]
    assert run("network_report") == [(2, 1, 4)]


def test_gaps_follow_chapter_order(spark, tmp_path):
    day = lambda k: datetime.date(2020, 1, 1) + datetime.timedelta(k)
    chapters = [(1, day(0), "x"), (2, day(7), "y"), (3, None, "x"), (4, day(22), None), (5, day(29), "x"), (6, day(60), "y")]
    d = write(spark, tmp_path, chapter=(chapters, "number int, date date, jump string"))
    want = [(1, day(0), 7, "none"), (2, day(7), 15, "break"), (4, day(22), 7, "none"), (5, day(29), 31, "long")]
    assert rows(story.queries()["gap_days"](spark, d)) == want


def test_following_crosses_empty_ranges(spark):
    df = spark.createDataFrame([(k, k * k) for k in (9, 1, 5, 3, 7)], "n int, v int")
    for parts in (1, 3, 5, 12):
        assert rows(ranges.following(df, "n", "v", "next", parts)) == [(1, 1, 9), (3, 9, 25), (5, 25, 49), (7, 49, 81), (9, 81, None)]


def test_entity_link_takes_aliases_and_every_node(spark, tmp_path):
    nodes = [(1, "Straw Hat", ["the Boss", None, "x"]), (2, "Straw Hat Fleet", None), (3, "Tall Ann", ["THE BOSS "]), (4, "Hat Fleet Yard", []), (5, None, ["Ōka"]), (6, "Straw Hat", ["Raw"])]
    documents = [(10, "The boss left."), (11, "straw hat fleet yard"), (12, "Met Ōka; bosses, tall Annie, x."), (13, None)]
    d = write(spark, tmp_path, graph_nodes=(nodes, "id int, canonical_name string, aliases array<string>"), documents=(documents, "doc_id long, text string"))
    want = [(10, 1), (10, 3), (11, 1), (11, 2), (11, 4), (11, 6), (12, 5)]
    assert rows(texts.queries()["entity_link"](spark, d)) == want
    names = spark.createDataFrame([(i, n) for i, c, al in nodes for n in [c, *(al or [])]], "id int, name string")
    assert rows(chunks.link_names(spark.createDataFrame(documents, "doc_id long, text string"), names, most=2)) == want
    odd = spark.createDataFrame([(1, "★★"), (2, "a.b"), (3, "(the sea)"), (4, "sea"), (5, "deep sea dog")], "id int, name string")
    papers = spark.createDataFrame([(1, "x★★y A.B! (The Sea)"), (2, "a.bc ★ seaside"), (3, "Deep  sea; deep sea dog"), (4, "")], "doc_id long, text string")
    assert rows(chunks.link_names(papers, odd)) == rows(chunks.link_names(papers, odd, most=0)) == [(1, 2), (1, 3), (1, 4), (3, 4), (3, 5)]


def test_every_section_of_every_scrape_meets_the_open_version(spark, tmp_path):
    a, b = "The tide turned at noon and the fleet left. " * 3, "Nobody kept the log of that winter, it says. " * 3
    drift = [a[:-k] + "#" * k for k in (4, 9)]  # each near the one before, the last not near the first
    scrapes = [
        ("p", 1, json.dumps({"A": a, "B": b, "C": "short"})), ("p", 2, json.dumps({"A": drift[0], "B": a, "C": b})), ("p", 3, None), ("p", 4, "{broken"),
        ("p", 5, json.dumps({"A": drift[1], "B": "  " + a.upper().replace(" ", " \n") + "[12]", "C": "short"})), ("q", 9, json.dumps({"intro": a, "sections": [{"title": "A", "text": b}]})),
    ]
    d = write(spark, tmp_path, wiki_text=([(p, datetime.datetime(2020, 1, k), s, a, a) for p, k, s in scrapes], "page_id string, scraped_at timestamp_ntz, sections string, intro_text string, full_text string"))
    got = sorted((r["page_id"], r["scraped_at"].day, r["section"], r["change"]) for r in texts.queries()["source_change_similar"](spark, d).collect())
    assert got == [
        ("p", 1, "A", "inserted"), ("p", 1, "B", "inserted"), ("p", 2, "A", "touched"), ("p", 2, "B", "superseded"), ("p", 2, "C", "inserted"),
        ("p", 5, "A", "superseded"), ("p", 5, "B", "touched"), ("p", 5, "C", "untouched"), ("q", 9, "A", "inserted"), ("q", 9, "intro", "inserted"),
    ]


def test_terms_of_every_script(spark, tmp_path):
    documents = [(1, "L'Équipage, naïve; ÉQUIPAGE"), (2, "第2928話でSegikは海賊"), (3, "quipage x1"), (4, None), (5, "海の賊海")]
    d = write(spark, tmp_path, documents=(documents, "doc_id long, text string"))
    got = {r["term"]: (r["docs"], r["uses"]) for r in texts.queries()["term_index"](spark, d).collect()}
    one = dict.fromkeys(["l", "naïve", "第", "2928", "話で", "segik", "は海", "海賊", "quipage", "x1", "海の", "の賊", "賊海"], (1, 1))
    assert got == one | {"équipage": (1, 2)}
    df = spark.read.parquet(f"{d}/documents.parquet")
    find = lambda q: [tuple(r) for r in search.full_text(df, "doc_id", "text", q).collect()]
    assert find("équipage") == [(1, 2)] and find("quipage") == [(3, 1)] and find("海賊") == [(2, 1)]
    assert find("は海賊 -équipage") == [(2, 2)] and find("l'équipage") == [(1, 3)] and find("segik or naïve") == [(1, 1), (2, 1)]


def test_lists_keep_every_element(spark, tmp_path):
    coc = [(2, "a", None), (1, "a", "silhouette"), (1, "a", "silhouette"), (60, "a", "silhouette"), (1000, "a", None), (60, "a", None), (3, "b", None), (None, "b", None)]
    chapters = [(1, 1), (2, 1), (3, None), (60, 12), (1000, 1001)]
    d = write(spark, tmp_path, coc=(coc, "chapter int, character string, note string"), chapter=(chapters, "number int, volume int"))
    run = lambda name: rows(story.queries()[name](spark, d))
    assert run("volume_lists") == [("a", 0, "1,12"), ("a", 1, "1001")] and run("cover_lists") == [("a", 0, "1,1,12")]
    assert run("arc_lists") == [("a", 0, "1,2,20"), ("b", 0, "1")] and run("saga_lists") == [("a", 0, "1,5"), ("b", 0, "1")]


def test_weeks_of_iso_years(spark, tmp_path):
    chapters = [(datetime.date(2020, 12, 28), 10), (datetime.date(2021, 1, 3), 20), (datetime.date(2021, 1, 4), 7), (None, 9)]
    d = write(spark, tmp_path, chapter=(chapters, "date date, num_page int"))
    got = [{k: v for k, v in r.asDict().items() if v is not None} for r in story.queries()["pivot_year_week"](spark, d).orderBy("year").collect()]
    assert got == [{"year": 2020, "w53": 15.0}, {"year": 2021, "w01": 7.0}]


def test_windows_unfold_where_their_pairs_are_counted(spark, tmp_path, monkeypatch):
    coc = [(k * k % 31, c) for k in range(40) for c in "abcdef"[k % 3 :: 2 + k % 2]] + [(0, "z"), (3, "z"), (3, "z"), (-2, "y"), (4, "y"), (2**31 - 1, "a"), (2**31 - 2, "z")]
    d = write(spark, tmp_path, coc=(coc, "chapter int, character string"))
    seen = []
    monkeypatch.setattr(network, "materialize", lambda df, name="t": seen.append(df.count()) or df)
    for n in (2, 7):
        member = {(g, c) for k, c in coc for g in range(k - n + 1, k + 1) if g >= 1}
        want = Counter((a, b) for g, a in member for h, b in member if g == h and a < b)
        assert rows(story.queries()[f"coappear_consec_{n}"](spark, d)) == sorted((a, b, w) for (a, b), w in want.items())
    assert seen == [len(set(coc))] * 2  # rows meet as they are, not once for each window
