"""Small tables whose rows tell the right reading of a job from near ones."""

import itertools
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import grammars, scalars
from tidemark.operators import chunks, merging, network, ranges, search
from tidemark.plans import entities, story, texts
from test_whole import rows, write


def test_entities_without_status_and_origin_go(spark, tmp_path):
    people = [("stated", "Alive", None, None), ("placed", None, "East", None), ("born", " ", "", "May 1st"), ("nothing", None, None, None), ("ship", "Active", "East", "May 1st"), ("Pandaman", None, None, None)]
    coc = [(1, p[0]) for p in people] + [(2, "unknown"), (2, None)]
    d = write(spark, tmp_path, characters=(people, "id string, status string, origin string, birth string"), coc=(coc, "chapter int, character string"))
    assert [c for _, c in rows(story.queries()["filter_non_entities"](spark, d))] == ["Pandaman", "placed", "stated"]


def test_scope_has_a_branch_for_late_and_repeated_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(story, "SCOPE_TOP", 1)
    people = [("a", "Ann", 0), ("b", "Bo", 200_000_000), ("c", "Cy", 100_000_000), ("d", "Di", None), ("e", "Ed", None)]
    coc = [(k, "a") for k in range(1, 9)] + [(1100, "d"), (1099, "d"), (3, "d"), (1200, "e"), (7, "e"), (5, "c"), (6, "c"), (7, "c")]
    pages = [("p1", "Ann", "character", "x"), ("p2", "Bo", "character", "x"), ("p3", "Cy", "character", "x"), ("p4", "Di", "character", "x"), ("p5", "Ed", "character", "x"), ("p6", "Long", "character", "x" * 99), ("p7", "Arc", "arc", None), ("p8", "Bo", "place", "y" * 500), ("p4", "Di", "character", "x")]
    d = write(spark, tmp_path, characters=(people, "id string, name string, bounty long"), coc=(coc, "chapter int, character string"), wiki_text=(pages, "page_id string, title string, page_type string, full_text string"))
    assert rows(story.scope_union(spark, d, 1100)) == [("p1", 1), ("p2", 1), ("p4", 2), ("p6", 1), ("p7", 1)]


@pytest.mark.parametrize(
    "raw,ident,want",
    [
        ("Captain (acting) ; Admiral (promoted) ; Spy (clandestine)", None, [("Captain", "acting"), ("Admiral", "promoted"), ("Spy", "clandestine")]),
        ("Cook (temporary, retired)", None, [("Cook", "retired")]), ("Marine (formerly) (Non-Canon) ≠", None, [("Marine", "former")]), ("Net Mender (科学戦士, Kagaku Senshi)", None, [("Net Mender", "current")]),
        ("War God ( 農務 , Nomu ( old ) ? , VIZ: \"Godhead\" ) ; Smith", None, [("War God", "current"), ("Smith", "current")]), ("Smith, Cook (former), Spy", None, [("Smith", "current"), ("Cook", "former"), ("Spy", "current")]),
        ("Thief (former), Dancer (former), Judge ; Clerk", None, [("Thief", "former"), ("Dancer", "former"), ("Judge", "current"), ("Clerk", "current")]), ("Keeper of nets, ropes and sails ; Cook", None, [("Keeper of nets, ropes and sails", "current"), ("Cook", "current")]),
        ("anything", "Vito", [("Pirate", "current"), ("Advisor", "current")]), ("King (of Hearts)", None, [("King", "current")]), (";;", None, []), ("", None, []), (None, None, []), ("(former)", None, []), ("Odd ) end", None, [("Odd ) end", "current")]),
    ],
)
def test_occupations(raw, ident, want):
    assert grammars.occupations(raw, ident) == want


def test_first_role_of_a_person_stays(spark, tmp_path):
    detail = [(1, "a", "Cook (former) ; Spy"), (2, "a", "Cook ; Smith"), (3, "b", "Cook"), (4, None, None), (5, None, "Cook")]
    d = write(spark, tmp_path, characters_detail=(detail, "rec_id long, id string, occupation string"))
    got = entities.queries()["occupation_split"](spark, d).select("rec_id", "id", "pos", "role", "status")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([(1, "a", 1, "Cook", "former"), (1, "a", 2, "Spy", "current"), (2, "a", 2, "Smith", "current"), (3, "b", 1, "Cook", "current"), (5, None, 1, "Cook", "current")], key=str)


def test_powers_of_the_list():
    for (name, kind, english), want in entities.POWERS:
        assert grammars.powers([(name, kind, english), (None, None, None)]) == [want]


def test_all_signals_reach_a_score_of_one(spark, tmp_path):
    top = {"id": "a", "name": "Ann", "origin": "East", "status": "Alive", "birth": "May 1st", "blood_type": "X", "bounty": 5, "age": 3, "occupation": "Fleet Admiral", "has_conqueror": True}
    low = {"id": "b", "name": "Bo", "origin": None, "status": None, "birth": "soon", "blood_type": None, "bounty": 0, "age": None, "occupation": None, "has_conqueror": None}
    ddl = "id string, name string, origin string, status string, birth string, blood_type string, bounty long, age int, occupation string, has_conqueror boolean"
    coc = [(k, "a", "silhouette") for k in range(1, 201)] + [(None, "a", "silhouette"), (3, "b", None)]
    d = write(spark, tmp_path, characters=([tuple(x.values()) for x in (top, low)], ddl), coc=(coc, "chapter int, character string, note string"), chapter=([(k,) for k in range(1, 201)], "number int"),
              character_affiliation=([("a", "Navy")], "character_id string, group_name string"), characters_detail=([(1, "a", "Aka no Mi")], "rec_id long, id string, devil_fruit_name string"))
    got = {r["id"]: r["score"] for r in entities.scores(spark, d).collect()}
    assert got["a"] == pytest.approx(1.0) and 0 < got["b"] < 0.3
    # Tables without the two columns give the same but for these signals.
    d = write(spark, tmp_path / "narrow", characters=([tuple(x.values())[:-1] for x in (top, low)], ddl.rsplit(",", 1)[0]), coc=(coc, "chapter int, character string, note string"), chapter=([(k,) for k in range(1, 201)], "number int"),
              character_affiliation=([("a", "Navy")], "character_id string, group_name string"), characters_detail=([(1, "a")], "rec_id long, id string"))
    assert {r["id"]: r["score"] for r in entities.scores(spark, d).collect()}["a"] == pytest.approx(1 - 0.05 - 0.03)


def test_an_edge_takes_the_first_known_chapter(spark):
    t = [("a", "fought", "b", 0.9, None, "q1"), ("a", "fought", "b", 0.7, 5, "q2"), ("a", "fought", "b", 0.8, 9, "q3"), ("a", "fought", "b", 0.6, 1, "q4"), ("a", "fought", "c", 0.7, None, None), ("a", "fought", "a", 0.9, 1, "x"), ("a", "likes", "b", 0.9, 1, "x"), ("a", "fought", "d", None, 1, "x")]
    got = {r["object"]: r for r in network.evidence_edges(spark.createDataFrame(t, "subject string, relation string, object string, confidence double, chapter int, quote string"), ("fought",)).collect()}
    assert set(got) == {"b", "c"} and (got["b"]["confidence"], got["b"]["chapter"], got["b"]["evidence"]) == (0.9, 9, "q1 | q3 | q2") and got["c"]["chapter"] is None and got["c"]["evidence"] == ""


def test_valid_triples(spark):
    t = [("a", "fought", "b", "a quote of five words", "0.6"), ("a", "fought", "b", "only four words here", "0.9"), ("a", "fought", "b", "\"N/A\"", "1"), ("a", "fought", "a", "a quote of five words", "1"), ("a", "likes", "b", "a quote of five words", "1"), ("a", "fought", "b", "a quote of five words", "sure"), ("a", "fought", None, "a quote of five words", "1"), ("a", "fought", "b", None, "1"), ("a", "fought", "b", "a quote of five words", None)]
    df = spark.createDataFrame(t, "subject string, relation string, object string, quote string, confidence string")
    assert [r[0] for r in df.select(network.valid_triple(("fought",))).collect()] == [True] + [False] * 8


def test_hot_groups_are_cut(spark):
    member = [(1, f"v{k:02d}") for k in range(30)] + [(2, "v00"), (2, "v01"), (2, "v01"), (3, "v05"), (None, "v01"), (2, None)]
    df = spark.createDataFrame(member, "g int, v string")
    for distinct in (True, False):
        assert rows(network.pair_edges(df, "g", "v", distinct=distinct)) == rows(network.pair_edges(df, "g", "v", distinct=distinct, block=4))
    assert network.pair_edges(df, "g", "v", block=4).count() == 30 * 29 // 2


def test_edges_within_hops_are_cut_in_order(spark):
    e = spark.createDataFrame([("a", "b", 1), ("b", "c", 2), ("c", "d", 3), ("d", "e", 4), ("x", "y", 5)], "source string, target string, w int")
    focus = spark.createDataFrame([("b",)], "node string")
    assert rows(network.hop_edges(e, focus, 2)) == [("a", "b", 1, 1), ("b", "c", 2, 1), ("c", "d", 3, 2)]
    assert rows(network.hop_edges(e, focus, 3, 2)) == [("a", "b", 1, 1), ("b", "c", 2, 1)]


def test_unlinked_names(spark):
    t = spark.createDataFrame([("Ann ", "Bo"), ("Cy", "Bo"), ("Cy", None), (None, "cy")], "subject string, object string")
    assert [tuple(r) for r in network.unlinked(t, spark.createDataFrame([("ann",), ("cy",)], "name string")).collect()] == [("object", "Bo", 2)]


def test_chains_are_followed(spark):
    links = [("a", "b"), ("b", "c"), ("c", "d"), ("p", "q"), ("q", "p"), ("t", "q"), ("self", "self"), (None, "x"), ("y", None), ("m", "o"), ("m", "n"), ("aa", "z1"), ("z1", "z2"), ("z2", "z1")] + [(f"k{k:02d}", f"k{k + 1:02d}") for k in range(37)]
    got = dict(rows(merging.resolve_chains(spark.createDataFrame(links, "alias string, canonical string"))))
    assert got["a"] == got["b"] == got["c"] == "d" and got["q"] == got["t"] == "p" and "p" not in got and "self" not in got and got["m"] == "n" and got["aa"] == got["z2"] == "z1" and got["k00"] == got["k36"] == "k37"
    assert merging.resolve_chains(spark.createDataFrame([], "alias string, canonical string")).count() == 0


def test_a_column_is_added_or_set(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "y"), (9, "z")], "id int, v string")
    assert rows(merging.set_column(df, "v", new, "id")) == [(1, "a"), (2, "x"), (3, "y")] and rows(merging.set_column(df, "v", new, "id", only_null=True)) == [(1, "a"), (2, "x"), (3, "c")]
    added = merging.set_column(df.select("id"), "v", new, "id")
    assert added.columns == ["id", "v"] and sorted(rows(added.fillna("-"))) == [(1, "-"), (2, "x"), (3, "y")]


def test_numbers_follow_the_order_over_ranges(spark):
    df = spark.createDataFrame([(k * 7 % 23,) for k in range(23)], "v int")
    for parts in (1, 4, 30):
        assert rows(ranges.numbered(df, [F.desc("v")], "n", parts)) == sorted((v, 23 - v) for v in range(23))


@pytest.mark.parametrize("query", ["rope sail", "rope or tar -oil", '"tar and" rope', "-oil rope", "équipage", "海賊", "nothing", "-oil", '"', "rope 海賊 or oil", "no-one"])
def test_the_stored_index_gives_what_the_texts_give(spark, query):
    docs = [(1, "Rope and sail"), (2, "rope, tar and rope"), (3, "oil on rope; Sail"), (4, "l'équipage 海賊 rope"), (5, None), (6, ""), (7, "no-one had tar and rope"), (8, "no one; one no"), (9, "海の賊 oil rope")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    index = search.stored_index(df, "doc_id", "text", "test")
    assert [tuple(r) for r in search.search_index(index, df, "doc_id", "text", query, 9).collect()] == [tuple(r) for r in search.full_text(df, "doc_id", "text", query, 9).collect()]


def test_chunks_of_either_shape(spark):
    pages = [("flat", '{"a": "' + "x" * 60 + '", "b": " ", "c": "short", "d": "' + "y" * 50 + '"}'), ("list", '{"intro": "i", "sections": [{"title": "t", "text": "' + "z" * 3300 + '"}, {"name": "", "content": "tail of the page"}, 7]}'), ("broken", "{"), ("none", None), ("other", "[1]"), ("empty", "{}")]
    got = [(r["chunk_id"], len(r["chunk_text"])) for r in chunks.page_chunks(spark.createDataFrame(pages, "page_id string, sections string")).collect()]
    assert got == [("flat::a", 60), ("flat::c", 56), ("list::intro::part_1", 3200), ("list::intro::part_2", 502), ("list::(untitled)", 16)]


def test_sentences_of_a_lead(spark):
    leads = [
        ("Ann , the cook [ 3 ]( アン , An ? ) 's friend , sails . She left. Third.", "Ann, the cook's friend, sails. She left."), ("Monkey D. Luffy sails. He eats. He sleeps.", "Monkey D. Luffy sails. He eats."), ("Statistics Japanese Name: x. y. z.", None), ("海賊", None), (" ", None), (None, None),
        ("A half -giant cook. End", "A half-giant cook. End"),
    ]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(leads)], "k int, t string").select(scalars.first_sentences(F.col("t")))
    assert [r[0] for r in df.collect()] == [w for _, w in leads]


def test_small_readers(spark):
    one = lambda f, v, ddl="x string": spark.createDataFrame([(v,)], ddl).select(f(F.col("x")).alias("y")).first()["y"]
    assert one(lambda c: scalars.title_number(c, "Chapter"), "chapter  12 (x)") == 12 and one(lambda c: scalars.title_number(c, "Volume"), "Chapter 1") is None
    assert [one(scalars.valid_chapter, v, "x int") for v in (1, 2000, 0, 2001, None)] == [True, True, False, False, False]
    assert [one(scalars.valid_url, v) for v in ("https://a.b/c?d", "ftp://x", "http://", "a.b", "http://a b", None)] == [True, True, False, False, False, False]
    assert one(scalars.first_of, [" ", None, "b"], "x array<string>") == "b" and one(scalars.first_of, [], "x array<string>") is None
    assert one(lambda c: scalars.name_of(c, F.lit("e"), F.lit("i")), " ") == "e" and one(lambda c: scalars.name_of(c, F.lit(None).cast("string"), F.lit(None).cast("string")), None) == ""
    assert one(scalars.plain_cell, "'''[[Navy|The Navy]]''' (former) [12] ") == "The Navy"
    assert one(scalars.cell_values, "<li>A (x)</li><li>B</li>C<br/>D; [1]") == ["A", "B", "C", "D"]
    df = spark.createDataFrame([(1,)], "a int")
    assert df.select(scalars.optional(df, "a", "int"), scalars.optional(df, "b", "boolean", False)).first()[:] == (1, False)


def test_versions_are_compared_after_normalization(spark, tmp_path):
    pages = [("p", 1, "One  text"), ("p", 2, "one text [4]"), ("p", 3, "Two"), ("p", 4, "one text"), ("q", 1, None), ("q", 2, "x"), (None, 1, "y")]
    d = write(spark, tmp_path, wiki_text=(pages, "page_id string, scraped_at int, full_text string"))
    assert rows(texts.queries()["source_change_class"](spark, d)) == [("p", 1, "inserted"), ("p", 2, "touched"), ("p", 3, "superseded"), ("p", 4, "superseded"), ("q", 1, "inserted")]


def test_pending_sources(spark):
    sources = spark.createDataFrame([(1, 5), (2, 1), (3, 9), (None, 9)], "id int, n int")
    done = spark.createDataFrame([(1, "v1"), (1, "v1"), (3, "v2"), (None, "v1")], "id int, version string")
    ids = lambda df: sorted((r["id"] for r in df.collect()), key=str)
    assert ids(merging.pending(sources, done, "id")) == [2, None] and ids(merging.pending(sources, done, "id", "v1")) == [2, 3, None]
    assert ids(merging.pending(sources, done, "id", "v1", least=F.col("n") >= 2)) == [3, None] and len(ids(merging.pending(sources, done, "id", force=True))) == 4


def test_paced_calls_are_tried_again():
    from tidemark.sources import loaders

    now, slept, calls = [0.0], [], []

    def sleep(s):
        slept.append(round(s, 3))
        now[0] += s

    def fetch(x):
        calls.append(now[0])
        if len(calls) < 3:
            raise OSError("busy")
        return x + 1

    call = loaders.paced(fetch, per_second=2, tries=3, wait=1.0, sleep=sleep, clock=lambda: now[0])
    assert call(1) == 2 and slept == [1.0, 2.0] and call(5) == 6 and slept[-1] == 0.5
    with pytest.raises(OSError):
        loaders.paced(lambda: (_ for _ in ()).throw(OSError()), tries=2, sleep=lambda s: None)()


def test_pairs_are_counted_where_they_are_made(spark, monkeypatch):
    draw = random.Random(3)
    member = [(draw.randrange(40), f"{draw.choice('aéZ😀')}{draw.randrange(25)}") for _ in range(600)]
    df = spark.createDataFrame(member, "g int, v string")
    edges = network.pair_edges(df, "g", "v", block=100)
    made, _, before = edges._jdf.queryExecution().executedPlan().toString().partition("MapInArrow")
    assert before and "Exchange" not in made and "Join" not in before  # no pair is shuffled
    for distinct in (True, False):
        n = Counter(member)
        want = Counter()
        for (g, a), (h, b) in itertools.product(n, n):
            if g == h and a.encode() < b.encode():
                want[a, b] += 1 if distinct else n[g, a] * n[h, b]
        got = rows(network.pair_edges(df, "g", "v", distinct=distinct, block=100))
        assert got == sorted((a, b, w) for (a, b), w in want.items())
        assert rows(network.pair_edges(df, "g", "v", min_weight=3, distinct=distinct, block=100)) == [r for r in got if r[2] >= 3]
        batch = pa.RecordBatch.from_pydict({"g": [g for g, _ in n], "v": [v for _, v in n], "n": [1 if distinct else k for k in n.values()], "side": [0] * len(n)})
        for most in (1, 50, 10**6):
            monkeypatch.setattr(network, "AT_ONCE", most)
            assert sorted(tuple(r.values()) for b in network._counted(1, distinct, 1)([batch]) for r in b.to_pylist()) == got
