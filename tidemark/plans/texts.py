"""Queries over wiki pages, documents, vectors, the story graph and events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scalars, wikitext
from tidemark.operators import chunks, merging, network, search
from tidemark.plans import entities
from tidemark.sources.tables import TABLES, table

Q: dict = {}
SQL: dict[str, str] = {}
#: Relations of the story graph.
RELATIONS = ("member_of_crew", "captain_of", "ally_of", "enemy_of", "fought", "defeated_by", "mentor_of", "family_of", "ate_devil_fruit", "affiliated_with", "has_bounty_of", "originates_from")


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("""SELECT doc_id, i::INT AS part, substr(text, (i * 2800 + 1)::BIGINT, 3200) AS chunk FROM documents, LATERAL (SELECT UNNEST(generate_series(0, greatest(0, CAST(ceil((length(text) - 400) / 2800.0) AS BIGINT) - 1))) AS i) WHERE text IS NOT NULL AND text <> ''""")
def chunk_documents(spark, d):
    """Fixed windows of 3,200 characters with a step of 2,800."""
    return chunks.fixed_windows(table(spark, d, "documents"), "doc_id", "text")


@query()
def chunk_pages(spark, d):
    """Chunks of page sections: short sections join the next one, long ones are cut into windows."""
    return chunks.page_chunks(table(spark, d, "wiki_text"))


@query()
def wiki_sections(spark, d):
    return table(spark, d, "wiki_text").filter(F.col("full_text").isNotNull()).select("page_id", "scraped_at", F.explode(wikitext.sections_udf("full_text")).alias("s")).select("page_id", "scraped_at", "s.pos", "s.name", "s.text")


@query(r"""SELECT doc_id, sha256(lower(trim(regexp_replace(regexp_replace(text, '\[\d+\]', '', 'g'), '\s+', ' ', 'g')))) AS hash FROM documents""")
def doc_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", scalars.text_hash(F.col("text")).alias("hash"))


_WIDE = r"\x{3000}-\x{9FFF}\x{FF00}-\x{FFEF}・"
_LEAD = "intro_text"
for _pattern, _by in (
    (r"\[\s*\d+\s*\]", ""), (rf"\(\s*[{_WIDE}][^)]*\)", ""), (rf"[{_WIDE}]+", ""), (r"\s+", " "), (r"^ +| +$", ""), (r"\s+([,.;:!?])", r"\1"), (r"\s+([''\x{2019}])(\w)", r"\1\2"), (r"\s+-(\w)", r"-\1"),
    (r"\b([A-Z])\.\s+([A-Z])", r"\1\x01 \2"), (r"([.!?])\s+", r"\1\x02"),
):
    _LEAD = f"regexp_replace({_LEAD}, '{_pattern}', " + "'" + _by.replace(r"\x01", "' || chr(1) || '").replace(r"\x02", "' || chr(2) || '") + "', 'g')"


@query(rf"""SELECT page_id, scraped_at, CASE WHEN l <> '' AND NOT regexp_matches(intro_text, 'Statistics\s+Japanese Name:|Romanized Name:') THEN replace(trim(array_to_string(string_split(l, chr(2))[1:2], ' ')), chr(1), '.') END AS bio FROM (SELECT *, {_LEAD} AS l FROM wiki_text)""")
def bio_first_sentences(spark, d):
    return table(spark, d, "wiki_text").select("page_id", "scraped_at", scalars.first_sentences(F.col("intro_text")).alias("bio"))


@query("""SELECT page_type, COUNT(*)::BIGINT AS rows, COUNT(DISTINCT page_id)::BIGINT AS pages, CAST(SUM(length(full_text)) AS BIGINT) AS chars FROM wiki_text GROUP BY page_type""")
def wiki_stats(spark, d):
    w = table(spark, d, "wiki_text").groupBy("page_type", "page_id").agg(F.count("*").alias("n"), F.sum(F.length("full_text")).alias("c"))
    return w.groupBy("page_type").agg(F.sum("n").alias("rows"), F.count("page_id").alias("pages"), F.sum("c").alias("chars"))


_NORMAL = r"lower(trim(regexp_replace(regexp_replace(full_text, '\[\d+\]', '', 'g'), '\s+', ' ', 'g')))"


@query(rf"""WITH v AS (SELECT page_id, {_NORMAL} AS t, ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY scraped_at, md5(full_text)) AS v FROM wiki_text WHERE page_id IS NOT NULL AND full_text IS NOT NULL)
SELECT page_id, v, CASE WHEN v = 1 THEN 'inserted' WHEN t = LAG(t) OVER (PARTITION BY page_id ORDER BY v) THEN 'touched' ELSE 'superseded' END AS change FROM v""")
def source_change_class(spark, d):
    """What each scrape of a page does to the version before it; texts are compared after normalization."""
    w = Window.partitionBy("page_id").orderBy("scraped_at", F.md5("full_text"))
    v = table(spark, d, "wiki_text").filter(F.col("page_id").isNotNull() & F.col("full_text").isNotNull())
    v = v.select("page_id", F.row_number().over(w).cast("long").alias("v"), scalars.text_hash(F.col("full_text")).alias("hash"), F.lag(scalars.text_hash(F.col("full_text"))).over(w).alias("old"))
    return v.select("page_id", "v", F.when(F.col("v") == 1, "inserted").when(F.col("hash") == F.col("old"), "touched").otherwise("superseded").alias("change"))


@query()
def source_change_similar(spark, d):
    """What each scrape of a page does to every section's open version; near-equal texts count as touched."""
    return merging.section_changes(table(spark, d, "wiki_text"))


_QV = "(SELECT embedding AS q FROM embeddings WHERE vec_id = (SELECT MIN(vec_id) FROM embeddings))"


def _query_vector(spark, d) -> list[float]:
    return [float(x) for x in table(spark, d, "embeddings").orderBy("vec_id").select("embedding").first()[0]]


@query(f"SELECT vec_id, ROUND(list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]), 5) AS similarity FROM embeddings, {_QV} ORDER BY list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]) DESC, vec_id LIMIT 10")
def cosine_topk(spark, d):
    got = search.nearest(table(spark, d, "embeddings"), "vec_id", "embedding", _query_vector(spark, d), 10)
    return got.select("vec_id", F.round("similarity", 5).alias("similarity"))


@query(f"SELECT vec_id, ROUND(list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]), 5) AS similarity FROM embeddings, {_QV} WHERE label = 3 ORDER BY list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]) DESC, vec_id LIMIT 5")
def cosine_topk_filtered(spark, d):
    got = search.nearest(table(spark, d, "embeddings"), "vec_id", "embedding", _query_vector(spark, d), 5, F.col("label") == 3)
    return got.select("vec_id", F.round("similarity", 5).alias("similarity"))


@query("""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents)
SELECT doc_id, len([x FOR x IN w IF x IN ('harpoon', 'chapter', 'ledger')])::BIGINT AS score FROM w WHERE list_contains(w, 'harpoon') AND (list_contains(w, 'chapter') OR list_contains(w, 'ledger')) AND NOT list_contains(w, 'oil') ORDER BY score DESC, doc_id LIMIT 20""")
def fts_search(spark, d):
    got = search.full_text(table(spark, d, "documents"), "doc_id", "text", _FTS, 20)
    return got.select("doc_id", F.col("score").cast("long").alias("score"))


_UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\x{30FC}\x{FF70}]"


@query(rf"""WITH w AS (SELECT doc_id, UNNEST(regexp_extract_all(regexp_replace(lower(text), '({_UNSPACED}+)', ' \1 ', 'g'), '[\p{{L}}\p{{M}}\p{{N}}]+')) AS w FROM documents),
t AS (SELECT doc_id, UNNEST(CASE WHEN length(w) > 1 AND regexp_matches(w, '^{_UNSPACED}') THEN [substr(w, i, 2) FOR i IN range(1, length(w))] ELSE [w] END) AS term FROM w)
SELECT term, COUNT(DISTINCT doc_id)::BIGINT AS docs, COUNT(*)::BIGINT AS uses FROM t GROUP BY term""")
def term_index(spark, d):
    """Terms of every script, with the documents that hold them and their uses."""
    return search.inverted_index(table(spark, d, "documents"), "doc_id", "text").groupBy("term").agg(F.count("*").alias("docs"), F.sum("tf").alias("uses"))


_FTS = "harpoon chapter or ledger -oil"


@query("""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents)
SELECT doc_id, len([x FOR x IN w IF x IN ('harpoon', 'chapter', 'ledger')])::BIGINT AS score FROM w WHERE list_contains(w, 'harpoon') AND (list_contains(w, 'chapter') OR list_contains(w, 'ledger')) AND NOT list_contains(w, 'oil') ORDER BY score DESC, doc_id LIMIT 20""")
def fts_indexed(spark, d):
    """The same search over a stored inverted index, of which only the postings of the query's words are read."""
    docs = table(spark, d, "documents")
    index = search.stored_index(docs, "doc_id", "text", f"{d}#documents")
    return search.search_index(index, docs, "doc_id", "text", _FTS, 20).select("doc_id", F.col("score").cast("long").alias("score"))


@query()
def entity_link(spark, d):
    """Nodes whose name or alias stands in a document as whole words: an automaton over shards of names, no theta join."""
    names = F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    nodes = table(spark, d, "graph_nodes").select("id", F.explode(names).alias("name"))
    return chunks.link_names(table(spark, d, "documents").select("doc_id", "text"), nodes)


_T = """(SELECT 'u' || (user_id % 40)::VARCHAR AS subject, CASE event_type WHEN 'view' THEN 'ally_of' WHEN 'click' THEN 'fought' WHEN 'purchase' THEN 'captain_of' WHEN 'signup' THEN 'mentor_of' ELSE 'unknown' END AS relation,
'u' || (user_id % 7)::VARCHAR AS object, ROUND(value - floor(value), 2) AS confidence, CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 1000 AS INT) END AS chapter, 'event ' || (event_id % 50)::VARCHAR AS quote FROM events)"""


@query(f"""WITH t AS (SELECT * FROM {_T} WHERE relation <> 'unknown' AND confidence >= 0.6 AND subject <> object),
q AS (SELECT subject, relation, object, quote, MAX(confidence) AS c FROM t GROUP BY ALL), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY subject, relation, object ORDER BY c DESC, quote) AS r FROM q),
e AS (SELECT subject, relation, object, string_agg(quote, ' | ' ORDER BY r) AS evidence FROM r WHERE r <= 3 GROUP BY ALL),
top AS (SELECT subject, relation, object, MAX(confidence) AS confidence, FIRST(chapter ORDER BY confidence DESC, chapter) FILTER (WHERE chapter IS NOT NULL) AS chapter FROM t GROUP BY ALL)
SELECT top.subject, top.relation, top.object, top.confidence, top.chapter, e.evidence FROM top JOIN e USING (subject, relation, object)""")
def triples_to_edges(spark, d):
    return network.evidence_edges(_triples(spark, d), RELATIONS)


def _triples(spark, d):
    e = table(spark, d, "events")
    relation = F.when(F.col("event_type") == "view", "ally_of").when(F.col("event_type") == "click", "fought").when(F.col("event_type") == "purchase", "captain_of").when(F.col("event_type") == "signup", "mentor_of").otherwise("unknown")
    user = lambda k: F.concat(F.lit("u"), (F.col("user_id") % k).cast("string"))
    return e.select(user(40).alias("subject"), relation.alias("relation"), user(7).alias("object"), F.round(F.col("value") - F.floor("value"), 2).alias("confidence"), F.when(F.col("event_id") % 3 == 0, (F.col("event_id") % 1000).cast("int")).alias("chapter"), F.concat(F.lit("event "), (F.col("event_id") % 50).cast("string")).alias("quote"))


_QUOTE = "CASE event_id % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN 'too few words' WHEN 2 THEN '  ' ELSE 'event ' || event_id || ' was seen by many' END"
_CONFIDENCE = "CASE WHEN event_id % 5 = 0 THEN 'high' ELSE (event_id % 10 / 10.0)::VARCHAR END"


@query(f"""WITH t AS (SELECT event_id, 'u' || (user_id % 40)::VARCHAR AS subject, CASE event_type WHEN 'view' THEN 'ally_of' WHEN 'click' THEN 'fought' ELSE 'unknown' END AS relation, CASE WHEN user_id % 9 > 0 THEN 'u' || (user_id % 7)::VARCHAR END AS object,
  {_QUOTE} AS quote, {_CONFIDENCE} AS confidence FROM events)
SELECT event_id FROM t WHERE relation <> 'unknown' AND subject <> object AND quote LIKE 'event%' AND TRY_CAST(confidence AS DOUBLE) >= 0.6""")
def valid_triples(spark, d):
    """Extracted rows that may be kept: known relation, two names, a telling quote, and a confidence that is a number."""
    e = table(spark, d, "events")
    user = lambda k: F.concat(F.lit("u"), (F.col("user_id") % k).cast("string"))
    k = F.col("event_id") % 4
    quote = F.when(k == 0, "N/A").when(k == 1, "too few words").when(k == 2, "  ").otherwise(F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(" was seen by many")))
    relation = F.when(F.col("event_type") == "view", "ally_of").when(F.col("event_type") == "click", "fought").otherwise("unknown")
    confidence = F.when(F.col("event_id") % 5 == 0, "high").otherwise((F.col("event_id") % 10 / 10).cast("string"))
    t = e.select("event_id", user(40).alias("subject"), relation.alias("relation"), F.when(F.col("user_id") % 9 > 0, user(7)).alias("object"), quote.alias("quote"), confidence.alias("confidence"))
    return t.filter(network.valid_triple(RELATIONS)).select("event_id")


@query(f"""WITH t AS (SELECT * FROM {_T}), k AS (SELECT 'u' || n_nationkey AS name FROM nation WHERE n_nationkey > 3)
SELECT side, name, COUNT(*)::BIGINT AS n FROM (SELECT 'subject' AS side, subject AS name FROM t UNION ALL SELECT 'object', object FROM t) WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM k) GROUP BY 1, 2 ORDER BY n DESC, side, name LIMIT 20""")
def unlinked_names(spark, d):
    """Names of extracted rows that are no node, the commonest twenty."""
    known = table(spark, d, "nation").filter("n_nationkey > 3").select(F.concat(F.lit("u"), F.col("n_nationkey").cast("string")).alias("name"))
    return network.unlinked(_triples(spark, d), known, 20)


@query("SELECT event_type, COUNT(*)::BIGINT AS calls, SUM(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS input_units, ROUND(SUM(value), 2) AS cost FROM events GROUP BY event_type")
def usage_totals(spark, d):
    """Sums of what calls took and cost, by kind."""
    e = table(spark, d, "events").withColumn("k", F.from_json("props", "k long")["k"])
    return e.groupBy("event_type").agg(F.count("*").alias("calls"), F.sum("k").alias("input_units"), F.round(F.sum("value"), 2).alias("cost"))


_E = "(SELECT 'c' || c_custkey AS a, 'n' || c_nationkey AS b FROM customer UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation)"


@query(f"""WITH RECURSIVE e AS (SELECT a, b FROM {_E} UNION SELECT b, a FROM {_E}), w(node, hop) AS (SELECT 'n3', 0 UNION SELECT e.b, hop + 1 FROM w JOIN e ON e.a = w.node WHERE hop < 2)
SELECT node, MIN(hop)::INT AS hop FROM w GROUP BY node""")
def graph_bfs_khop(spark, d):
    return network.within_hops(_network(spark, d), spark.createDataFrame([("n3",)], "node string"), 2)


def _network(spark, d):
    c, s, n = table(spark, d, "customer"), table(spark, d, "supplier"), table(spark, d, "nation")
    name = lambda letter, col: F.concat(F.lit(letter), F.col(col).cast("string"))
    e = c.select(name("c", "c_custkey").alias("source"), name("n", "c_nationkey").alias("target"))
    e = e.unionByName(s.select(name("s", "s_suppkey").alias("source"), name("n", "s_nationkey").alias("target"))).unionByName(n.select(name("n", "n_nationkey").alias("source"), name("r", "n_regionkey").alias("target")))
    return e


@query(f"""WITH RECURSIVE e AS (SELECT a, b FROM {_E} UNION SELECT b, a FROM {_E}), w(node, hop) AS (SELECT 'n3', 0 UNION SELECT e.b, hop + 1 FROM w JOIN e ON e.a = w.node WHERE hop < 1),
m AS (SELECT node, MIN(hop) AS hop FROM w GROUP BY node)
SELECT x.a AS source, x.b AS target, (least(s.hop, t.hop) + 1)::INT AS hop FROM {_E} x LEFT JOIN m s ON s.node = x.a LEFT JOIN m t ON t.node = x.b WHERE least(s.hop, t.hop) IS NOT NULL ORDER BY 3, 1, 2 LIMIT 40""")
def graph_bfs_edges(spark, d):
    """The first forty edges within two steps of a node, nearer ones first."""
    return network.hop_edges(_network(spark, d), spark.createDataFrame([("n3",)], "node string"), 2, 40)


@query("""WITH x AS (SELECT id, lower(trim(canonical_name)) AS name, FALSE AS al FROM graph_nodes UNION ALL SELECT id, lower(trim(a)), TRUE FROM (SELECT id, UNNEST(aliases) AS a FROM graph_nodes))
SELECT name, id FROM (SELECT name, id, ROW_NUMBER() OVER (PARTITION BY name ORDER BY al, id) AS r FROM x WHERE name <> '') WHERE r = 1""")
def node_names(spark, d):
    return network.name_index(table(spark, d, "graph_nodes"))


@query("""SELECT type, COUNT(*)::BIGINT AS n, COUNT(source_id)::BIGINT AS with_source FROM graph_nodes GROUP BY type""")
def node_types(spark, d):
    return table(spark, d, "graph_nodes").groupBy("type").agg(F.count("*").alias("n"), F.count("source_id").alias("with_source"))


_GROUP_NODES = """SELECT DISTINCT CASE WHEN contains(lower(group_name), 'pirates') OR contains(lower(group_name), 'crew') OR contains(lower(group_name), 'fleet') THEN 'crew' ELSE 'organization' END AS type, group_name AS canonical_name FROM character_affiliation WHERE COALESCE(trim(group_name), '') <> ''"""
_PERSON_NODES = "SELECT 'character' AS type, name AS canonical_name, MIN(id) AS source_id FROM characters WHERE is_likely_character AND COALESCE(trim(name), '') <> '' GROUP BY name"
_POWER_NODES = f"SELECT 'power' AS type, name AS canonical_name, MIN(english) AS english FROM ({entities._POWER_ROWS}) WHERE COALESCE(trim(name), '') <> '' GROUP BY name"


def _power_nodes(spark, d):
    p = entities._power_rows(spark, d).filter(~scalars.blank(F.col("name")))
    return p.groupBy("name").agg(F.min("english").alias("english")).select(F.lit("power").alias("type"), F.col("name").alias("canonical_name"), "english")


@query(f"SELECT type, canonical_name, english FROM ({_POWER_NODES})")
def graph_init_powers(spark, d):
    """One node per power; of several English names the least counts."""
    return _power_nodes(spark, d)


@query(f"""WITH g AS ({_GROUP_NODES}), p AS ({_PERSON_NODES}), f AS ({_POWER_NODES})
SELECT type, canonical_name, canonical_name AS aliases, 'characters' AS source_table, source_id FROM p UNION ALL SELECT type, canonical_name, canonical_name, 'character_affiliation', NULL FROM g
UNION ALL SELECT type, canonical_name, CASE WHEN english IS NOT NULL AND english <> canonical_name THEN canonical_name || '|' || english ELSE canonical_name END, 'powers', NULL FROM f""")
def graph_init_nodes(spark, d):
    """Nodes of persons, groups (crews by keyword) and powers with their aliases; of equal type and name one."""
    null = F.lit(None).cast("string")
    people = table(spark, d, "characters").filter(F.col("is_likely_character") & ~scalars.blank(F.col("name"))).groupBy(F.col("name").alias("canonical_name")).agg(F.min("id").alias("source_id"))
    people = people.select(F.lit("character").alias("type"), "canonical_name", F.array("canonical_name").alias("aliases"), F.lit("characters").alias("source_table"), "source_id")
    groups = _group_nodes(spark, d).select("type", "canonical_name", F.array("canonical_name").alias("aliases"), F.lit("character_affiliation").alias("source_table"), null.alias("source_id"))
    both = F.when(F.col("english").isNotNull() & (F.col("english") != F.col("canonical_name")), F.array("canonical_name", "english")).otherwise(F.array("canonical_name"))
    powers = _power_nodes(spark, d).select("type", "canonical_name", both.alias("aliases"), F.lit("powers").alias("source_table"), null.alias("source_id"))
    return people.unionByName(groups).unionByName(powers).withColumn("aliases", F.array_join("aliases", "|"))


def _group_nodes(spark, d):
    g = table(spark, d, "character_affiliation").filter(~scalars.blank(F.col("group_name")))
    return g.select(F.when(scalars.any_of(F.lower("group_name"), ("pirates", "crew", "fleet")), "crew").otherwise("organization").alias("type"), F.col("group_name").alias("canonical_name")).distinct()


@query(_GROUP_NODES)
def graph_init_groups(spark, d):
    """Group nodes from affiliations; crews by keyword."""
    return _group_nodes(spark, d)


@query("SELECT volume, MIN(number) AS first_chapter FROM chapter WHERE volume IS NOT NULL GROUP BY volume ORDER BY first_chapter")
def volumes_in_order(spark, d):
    """Distinct volumes in the order of their first chapter."""
    return table(spark, d, "chapter").filter(F.col("volume").isNotNull()).groupBy("volume").agg(F.min("number").alias("first_chapter")).orderBy("first_chapter")


@query("SELECT number, title FROM chapter ORDER BY number LIMIT 50 OFFSET 100")
def chapter_page(spark, d):
    """The third page of fifty chapters; pages follow a total order, so none overlap."""
    return table(spark, d, "chapter").select("number", "title").orderBy("number").offset(100).limit(50)


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_props_extract(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("""SELECT time_bucket(INTERVAL '1 day', ts) AS start, event_type, COUNT(*)::BIGINT AS n, ROUND(SUM(value), 2) AS total FROM events GROUP BY 1, 2""")
def events_tumbling(spark, d):
    e = table(spark, d, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return e.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


@query("""SELECT (date_trunc('day', ts) - k * INTERVAL '1 day') AS start, COUNT(*)::BIGINT AS n FROM events, (SELECT UNNEST(generate_series(0, 2)) AS k) GROUP BY 1""")
def events_sliding(spark, d):
    e = table(spark, d, "events").groupBy(F.window("ts", "3 days", "1 day").alias("w")).agg(F.count("*").alias("n"))
    return e.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts < LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '6 hours' THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, SUM(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, MIN(ts) AS start, MAX(ts) + INTERVAL '6 hours' AS end, COUNT(*)::BIGINT AS n FROM s GROUP BY user_id, s""")
def events_session(spark, d):
    e = table(spark, d, "events").groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return e.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("end"), "n")


def _stream(spark, d):
    from tidemark.streaming import jobs

    return jobs.event_stream(spark, f"{d}/events.parque[t]", table(spark, d, "events").schema).withColumn("ts", F.col("ts").cast("timestamp"))


@query("""SELECT time_bucket(INTERVAL '1 day', ts) AS start, event_type, COUNT(*)::BIGINT AS n FROM events GROUP BY 1, 2""")
def stream_tumbling(spark, d):
    """The daily windows as a stream over the event files."""
    from tidemark.streaming import jobs

    return jobs.settled(jobs.tumbling(_stream(spark, d)), spark).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""SELECT (date_trunc('day', ts) - k * INTERVAL '1 day') AS start, COUNT(*)::BIGINT AS n FROM events, (SELECT UNNEST(generate_series(0, 2)) AS k) GROUP BY 1""")
def stream_sliding(spark, d):
    from tidemark.streaming import jobs

    return jobs.settled(jobs.sliding(_stream(spark, d)), spark).select(F.col("start").cast("timestamp_ntz").alias("start"), "n")


_COPIES = " UNION ALL ".join(f"SELECT '{t}' AS name, (SELECT COUNT(*) FROM {t})::BIGINT AS ours, (SELECT COUNT(*) FROM {t}{' WHERE r_regionkey <> 2' if t == 'region' else ''})::BIGINT AS theirs, {'FALSE' if t == 'region' else 'TRUE'} AS in_sync" for t in TABLES)


@query(_COPIES)
def export_diff(spark, d):
    """Row counts and contents of every table and of a copy, in which one table lacks a row."""
    from tidemark.sources.sinks import difference

    copy = lambda name, df: df.filter("r_regionkey <> 2") if name == "region" else df
    parts = [difference(name, df, copy(name, df)) for name in TABLES for df in [table(spark, d, name)]]
    return reduce(lambda a, b: a.unionByName(b), parts).select("name", "ours", "theirs", "in_sync")


@query("SELECT id, len(aliases)::BIGINT AS n FROM graph_nodes WHERE len(aliases) >= 2")
def many_aliases(spark, d):
    return table(spark, d, "graph_nodes").filter(F.size("aliases") >= 2).select("id", F.size("aliases").cast("long").alias("n"))


@query("""SELECT l_returnflag, l_linestatus, ROUND(SUM(l_quantity), 2) AS sum_qty, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, ROUND(AVG(l_discount), 6) AS avg_disc, COUNT(*)::BIGINT AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, d):
    li = table(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(net), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("""SELECT l_suppkey, COUNT(DISTINCT l_orderkey)::BIGINT AS orders, MIN(l_orderkey) AS first_order, MAX(l_orderkey) AS last_order, COUNT(*)::BIGINT AS lines FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def supplier_rollup(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    per = li.groupBy("l_suppkey", "l_orderkey").agg(F.count("*").alias("c"))
    return per.groupBy("l_suppkey").agg(F.count("*").alias("orders"), F.min("l_orderkey").alias("first_order"), F.max("l_orderkey").alias("last_order"), F.sum("c").alias("lines"))


def queries() -> dict:
    return Q


def oracle_sql() -> dict[str, str]:
    return SQL
