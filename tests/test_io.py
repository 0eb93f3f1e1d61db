import json

import pytest
from pyspark.sql import functions as F

from tidemark.plans import tools
from tidemark.sources import loaders, sinks
from tidemark.streaming import jobs


def write(path, value):
    path.write_text(json.dumps(value), encoding="utf-8")
    return str(path)


def test_chapters(spark, tmp_path):
    path = write(
        tmp_path / "c.json",
        [
            {"chapter_number": "1", "title": "A", "volume": "x", "pages": "19 (c)", "release_date": "July 22, 1997", "characters": [{"name": "Ann Lee", "note": "cover"}, "Bo", {"name": " "}]},
            {"chapter_number": "none", "title": "B"},
            {},
        ],
    )
    rows, cast_ = loaders.chapters(spark, path)
    assert [(r["number"], r["volume"], r["num_page"], str(r["date"])) for r in rows.collect()] == [(1, None, 19, "1997-07-22")]
    assert sorted((r["character"], r["note"]) for r in cast_.collect()) == [("Ann_Lee", "cover"), ("Bo", None)]


def test_story_ranges(spark, tmp_path):
    path = write(tmp_path / "a.json", [{"arc_id": "a", "title": "A", "start_chapter": 1, "end_chapter": 3}, {"arc_id": "b", "title": " ", "start_chapter": 1, "end_chapter": 3}, {"arc_id": "c", "title": "C", "start_chapter": 1, "end_chapter": 9}])
    chapter = spark.createDataFrame([(1,), (3,)], "number int")
    good, bad = loaders.story_ranges(spark, path, chapter)
    assert [r["arc_id"] for r in good.collect()] == ["a"] and sorted(r["arc_id"] for r in bad.collect()) == ["b", "c"]


def test_small_files(spark, tmp_path):
    assert loaders.alias_map(str(tmp_path / "no.json")) == {}
    rows = [f"{k}: {v}" for k, v in loaders.scoring.WEIGHTS.items()]
    (tmp_path / "w.yaml").write_text("arc_main_threshold: 0.4\n" + "\n".join(rows))
    assert loaders.weights(str(tmp_path / "w.yaml"))[1] == 0.4
    path = write(tmp_path / "v.json", [{"volume_number": 1, "cover_characters": [{"name": "Ann Lee", "slug": ""}, {"name": "x", "slug": "Bo"}, {"name": "", "slug": None}]}])
    assert sorted(r["character"] for r in loaders.covers(spark, path).collect()) == ["Ann_Lee", "Bo"]


def test_html(spark):
    page = '<table id="Volume_3"><tr><td>h</td></tr><tr><td>One</td></tr><tr><td>Ichi</td></tr><tr><td><ul><li>Ann</li><li>Bo</li></ul></td></tr></table><h4>Long Arc</h4><ul><li>Chapters: 3 (4-6)</li></ul><h4>Open</h4><li>Chapters: 2 (7-)</li>'
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")
    assert [tuple(r) for r in loaders.volume_tables(df, "page_id", "html").collect()] == [(1, 3, "One", "Ichi", ["Ann", "Bo"])]
    assert [(r["arc_id"], r["start"], r["end"]) for r in loaders.arc_list(df, "page_id", "html", 9).collect()] == [("long", 4, 6), ("open", 7, 9)]
    got = loaders.fetch_pages(df.select(F.col("page_id").cast("string").alias("title")), lambda names: {n: "t" + n for n in names if n != "2"}).collect()
    assert sorted((r["title"], r["text"]) for r in got) == [("1", "t1"), ("2", None), ("3", "t3")]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"]), (2, None)], "k int, v array<string>")
    assert sinks.export_tables(spark, {"t": df}, str(tmp_path), incremental=True) == {"t": "written"}
    assert sinks.export_tables(spark, {"t": df}, str(tmp_path), incremental=True) == {"t": "in sync"}
    sinks.export_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    assert sinks.ddl(df, "t", ["k"]) == 'CREATE TABLE "t" ("k" INTEGER, "v" TEXT[], PRIMARY KEY ("k"))'


@pytest.mark.parametrize("sql", ["DROP TABLE x", "select 1; drop table x", "INSERT INTO x SELECT 1", "with a as (select 1) insert into x select * from a", ""])
def test_guard_refuses(sql):
    with pytest.raises(tools.NotReadOnly):
        tools.check_read_only(sql)


def test_guard_allows(spark):
    assert tools.check_read_only(" select 'a; drop' as x ; ") == "select 'a; drop' as x"
    assert tools.run_sql(spark, "WITH a AS (SELECT 1 AS x) SELECT * FROM a").first()["x"] == 1
    with pytest.raises(tools.NotReadOnly):
        tools.check_read_only("select * from x where update > 1", strict=True)
    assert tools.sql_text(spark, "select broken from").startswith("Error")


def test_stream_keeps_versions(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    # A key that a batch lacks keeps its open version, also where its part is touched by others.
    batches = [[(k, f"t{k}") for k in range(40)], [(1, "t1"), (2, "new"), (99, "x")], [(2, "newer")]]
    for rows in batches:
        spark.createDataFrame(rows, "k int, body string").coalesce(1).write.mode("append").parquet(str(src))
        stream = spark.readStream.schema("k int, body string").parquet(str(src))
        jobs.keep_versions(stream, ["k"], "body", str(out), str(tmp_path / "cp"), parts=4).awaitTermination()
    got = jobs.versions(spark, str(out))
    assert got.columns == ["k", "text", "hash", "first_seen", "last_seen", "superseded_at"]
    rows = got.collect()
    assert sorted((r["k"], r["text"]) for r in rows if r["superseded_at"] is None) == sorted([(k, f"t{k}") for k in range(40) if k != 2] + [(2, "newer"), (99, "x")])
    assert sorted((r["k"], r["text"]) for r in rows if r["superseded_at"]) == [(2, "new"), (2, "t2")]
    one = next(r for r in rows if r["k"] == 1)
    assert one["last_seen"] > one["first_seen"]


def test_tables_are_replaced_together(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert sinks.replace_tables({a: spark.range(3), b: spark.range(2)}) == {a: 3, b: 2}
    assert sinks.replace_table(spark.range(9), a, dry_run=True) == 9 and spark.read.parquet(a).count() == 3
    bad = spark.range(5).selectExpr("assert_true(id < 4) as x", "id")
    with pytest.raises(Exception):
        sinks.replace_tables({a: spark.range(7), b: bad})
    assert spark.read.parquet(a).count() == 3 and spark.read.parquet(b).count() == 2
    # A table may be replaced by one that reads it.
    assert sinks.replace_table(spark.read.parquet(a).union(spark.range(1)), a) == 4
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]
    assert sinks.in_order(["z", "b", "a"], ("b", "c", "z")) == ["b", "z", "a"]


def test_graph_file_and_ranked_csv(spark, tmp_path):
    nodes = spark.createDataFrame([(1, "Ann", None), (2, "Bo", ["x"])], "id int, name string, aliases array<string>")
    sinks.graph_json(nodes, spark.createDataFrame([], "source int, target int"), str(tmp_path / "g.json"))
    assert json.load(open(tmp_path / "g.json")) == {"nodes": [{"id": 1, "name": "Ann", "aliases": None}, {"id": 2, "name": "Bo", "aliases": ["x"]}], "edges": []}
    sinks.ranked_csv(spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.98765)], "id string, score double"), str(tmp_path / "r"))
    got = [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "r")).orderBy("rank").collect()]
    assert got == [("1", "c", "0.9877"), ("2", "a", "0.5000"), ("3", "b", "0.5000")]


def test_dated_csv_and_chapter_facts(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,name,day\n1,NA,\"July 22, 1997\"\n2,,soon\n")
    got = loaders.dated_csv(spark, str(tmp_path / "c.csv"), "id int, name string, day string", {"day": "MMMM d, yyyy"}).collect()
    assert [(r["id"], r["name"], str(r["day"])) for r in got] == [(1, "NA", "1997-07-22"), (2, None, "None")]
    page = '<aside><div data-source="vol"><h3>Vol</h3><div class="pi-data-value">3 [ref]</div></div><div data-source="page"><h3>P</h3><div class="pi-data-value">19</div></div></aside>'
    facts = loaders.chapter_facts(spark.createDataFrame([(7, page), (8, None)], "number int, html string")).collect()
    assert facts[0].asDict() == {"number": 7, "volume": "3", "chapter_display": None, "pages": "19", "release_date": None, "jump_info": None} and facts[1]["volume"] is None


def test_tools_answer(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, None)], "k int, v string").coalesce(1).write.parquet(f"{tmp_path}/region.parquet")
    assert json.loads(tools.sql_json(spark, "SELECT 1 AS k, CAST(NULL AS STRING) AS v")) == [{"k": 1, "v": None}]
    assert tools.sql_json(spark, "SELECT 1 AS k WHERE false") == "[]"
    assert tools.call(spark, str(tmp_path), "nothing", {}).startswith("Error") and tools.call(spark, str(tmp_path), "query_database", {}).startswith("Error")
    assert "7" in tools.call(spark, str(tmp_path), "query_database", {"sql": "SELECT 7 AS x"})


def test_records_with_texts_or_lists(spark, tmp_path):
    path = write(tmp_path / "p.json", [
        {"id": "a", "name": ["Ann", "Anna"], "birth": "May 1st", "blood_type": "X\nF", "bounty": ["¥5,000", "¥7"], "age": ["17 (debut)", "19"], "occupation": ["Cook", "Spy"], "is_likely_character": False},
        {"id": "b", "ename": "Bo", "blood type": ["S (RH-)"], "bounty": "Unknown;30", "age": "Over 100"}, {"id": "c", "name": " ", "age": []}, {"id": "Buggy", "bounty": "¥1"},
    ])
    got = {r["id"]: r.asDict() for r in loaders.character_records(spark, path).collect()}
    assert {k: got["a"][k] for k in ("name", "birth", "blood_type", "blood_type_group", "bounties", "bounty", "age", "occupation", "is_likely_character", "scraping_status")} == {"name": "Ann", "birth": "May 1st", "blood_type": "X, F", "blood_type_group": "mixed", "bounties": "¥5,000;¥7", "bounty": 5000, "age": 19, "occupation": "Cook", "is_likely_character": False, "scraping_status": "success"}
    assert (got["b"]["name"], got["b"]["blood_type"], got["b"]["blood_type_group"], got["b"]["bounty"], got["b"]["age"], got["b"]["is_likely_character"]) == ("Bo", "S (RH-)", "S", 30, 100, True)
    assert got["c"]["name"] == "c" and got["c"]["age"] is None and got["Buggy"]["bounty"] == 3189000000
    books = write(tmp_path / "v.json", [{"volume_number": 3, "english_title": "One"}, {"volume_number": "x"}, {}])
    assert [tuple(r) for r in loaders.volumes(spark, books).collect()] == [(3, "One", None)]


def test_rows_are_sent_in_batches(spark, tmp_path):
    import sqlite3

    path = str(tmp_path / "x.db")

    def run(statement, rows=None):
        con = sqlite3.connect(path, timeout=60)
        with con:
            con.executemany(statement, rows) if rows is not None else con.execute(statement)
        con.close()

    def connect(name, statement):
        return lambda: lambda rows: run(statement, rows)

    df = spark.range(1203).selectExpr("id", "cast(id % 7 as string) as v")
    assert sinks.export_database({"t": (df, ["id"])}, run, connect, size=100) == {"t": 1203}
    sinks.send_batches(spark.createDataFrame([(5, "new"), (9999, "x")], "id long, v string"), connect("t", sinks.upsert_statement("t", ["id", "v"], ["id"])))
    con = sqlite3.connect(path)
    assert list(con.execute("select count(*), max(case when id = 5 then v end) from t")) == [(1204, "new")]
    assert sinks.upsert_statement("t", ["id"], ["id"], "%s") == 'INSERT INTO "t" ("id") VALUES (%s) ON CONFLICT ("id") DO NOTHING'
    status = str(tmp_path / "status.json")
    sinks.save_status(status, {"t": 1203}, "2024-01-01")
    assert sinks.load_status(status)["t"]["rows"] == 1203 and sinks.load_status(str(tmp_path / "none.json")) == {}
    report = {r["name"]: (r["ours"], r["exported"], r["in_sync"]) for r in sinks.status_report(spark, {"t": df, "u": df.limit(1)}, status).collect()}
    assert report == {"t": (1203, 1203, True), "u": (1, None, False)}


def test_crawls(spark, tmp_path):
    answers = {None: {"members": [("brave", "A"), ("brave", "B")], "redirects": {"A": "Ann", "B": "C"}, "continue": "x"}, "x": {"members": [("calm", "D")], "redirects": {"C": "B"}, "continue": "y"}, "y": {"members": [("calm", "Ann")], "continue": "x"}}
    assert loaders.category_members(answers.get) == {"brave": {"Ann", "B"}, "calm": {"D", "Ann"}}
    pages = loaders.crawl(spark.createDataFrame([("p",), ("gone",)], "title string"), lambda names: {"p": "Lead [[x|y]].\n== One ==\nText\n== One ==\nMore"} if "p" in names else {}).collect()
    assert [(r["page_id"], r["intro_text"], r["full_text"], json.loads(r["sections"])) for r in pages] == [("p", "Lead y.", "Lead y.\n\nText\n\nMore", {"One": "Text", "One_2": "More"})]
    cast = spark.createDataFrame([(1, "a", "Zed"), (2, "a", "Ann"), (1, "b", "Bo"), (3, " ", "x")], "chapter int, id string, name string")
    assert [(r["id"], r["name"]) for r in loaders.unique_members(cast, "id", [F.desc("chapter")], "name").collect()] == [("a", "Ann"), ("b", "Bo")]
    (tmp_path / "t.csv").write_text("id,w\n1,2.5\n2,3\n")
    assert dict(loaders.typed_csv(spark, str(tmp_path / "t.csv")).dtypes) == {"id": "int", "w": "double"}


def test_templates():
    from tidemark.functions import wikitext

    text = 'x {{chapter box|title = [[A|b]]|ename=The {{nihongo|One|1}} end|vol=3}} {| class="CharTable"\n*[[Ann]] (first)\n*[[Bo (cook)|Bo]]\n|} {{open'
    assert wikitext.chapter_box(text) == {"title": "b", "english_title": "The end", "vol": "3"} and wikitext.chapter_box("none {{Chapter Box") is None
    assert wikitext.cast_table(text) == [("Ann", "/wiki/Ann", "first"), ("Bo", "/wiki/Bo_(cook)", "")]


def test_edges_and_members(spark):
    from tidemark.operators import merging, network

    e = spark.createDataFrame([("a", "b", 3), ("a", "c", 1), ("c", "d", 9)], "source string, target string, weight int")
    assert sorted(r[:2] for r in network.keep_edges(e, weight=2).collect()) == [("a", "b"), ("c", "d")]
    assert [r[:2] for r in network.keep_edges(e, nodes=spark.createDataFrame([("a",), ("b",), ("c",)], "node string"), weight=2).collect()] == [("a", "b")]
    arcs = spark.createDataFrame([("x", "old"), ("y", None), ("z", "z1")], "arc string, saga string")
    sagas = spark.createDataFrame([("s2", ["x"]), ("s1", ["x", "y"])], "saga string, arcs array<string>")
    assert sorted(tuple(r) for r in merging.link_members(arcs, sagas, "arc", "saga", "arcs").collect()) == [("x", "s1"), ("y", "s1"), ("z", "z1")]
