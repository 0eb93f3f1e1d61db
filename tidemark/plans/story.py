"""Queries over chapters, appearances and story ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import merging, network, ranges
from tidemark.sources.tables import table

ARC, SAGA = 50, 200
#: The reports named gt10 leave out characters of at most so many chapters.
RARE = 10
#: Which pages are in scope for extraction.
SCOPE_TOP, SCOPE_BOUNTY, SCOPE_RECENT_FROM, SCOPE_RECENT_LEAST = 500, 100_000_000, 1100, 3
#: Persons that are kept although nothing is stated about them; a thing's status still removes them.
KEPT = ("Brownbeard", "Charlos", "Gallant_Hippo", "Goa_King", "Lami", "Octopus_Mash", "Pandaman", "Rosward", "Shalria", "Sig", "Sphinx", "Ukkari")

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def seen(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (chapter, character) with known chapter and non-blank character."""
    coc = table(spark, d, "coc").select("chapter", "character")
    return coc.filter(F.col("chapter").isNotNull() & (F.trim("character") != "")).distinct()


_SEEN = "SELECT DISTINCT chapter, character FROM coc WHERE chapter IS NOT NULL AND trim(character) <> ''"
_BUSY = f"SELECT s.* FROM ({_SEEN}) s JOIN (SELECT character FROM ({_SEEN}) GROUP BY character HAVING COUNT(*) > {RARE}) b USING (character)"


def busy(spark: SparkSession, d: str) -> DataFrame:
    s = seen(spark, d)
    return s.join(s.groupBy("character").agg(F.count("*").alias("n")).filter(F.col("n") > RARE).select("character"), "character", "left_semi")


@query(f"""SELECT character, COUNT(*)::BIGINT AS chapters, COUNT(DISTINCT volume)::BIGINT AS volumes, MIN(chapter) AS first_chapter, MAX(chapter) AS last_chapter
FROM ({_SEEN}) s JOIN chapter c ON c.number = s.chapter GROUP BY character""")
def appearance_rollup(spark, d):
    chapters = table(spark, d, "chapter").select("number", "volume")
    got = seen(spark, d).join(chapters, F.col("chapter") == F.col("number"))
    by_volume = got.groupBy("character", "volume").agg(F.count("*").alias("n"), F.min("chapter").alias("lo"), F.max("chapter").alias("hi"))
    return by_volume.groupBy("character").agg(F.sum("n").alias("chapters"), F.count("volume").alias("volumes"), F.min("lo").alias("first_chapter"), F.max("hi").alias("last_chapter"))


@query(f"""SELECT character, CAST(floor((chapter - 1) / 1000.0) AS BIGINT) AS block, string_agg(chapter::VARCHAR, ',' ORDER BY chapter) AS chapters FROM ({_SEEN}) GROUP BY 1, 2""")
def appearance_lists(spark, d):
    """Sorted distinct chapter lists in blocks of 1,000 chapters, so that no list grows with the data."""
    s = seen(spark, d).withColumn("block", F.floor((F.col("chapter") - 1) / 1000))
    return s.groupBy("character", "block").agg(F.array_join(F.array_sort(F.collect_list("chapter")).cast("array<string>"), ",").alias("chapters"))


@query("""SELECT character, COUNT(volume)::BIGINT AS volume_rows, MIN(volume) AS first_volume, MAX(volume) AS last_volume FROM coc JOIN chapter ON number = chapter
WHERE note = 'silhouette' AND trim(character) <> '' GROUP BY character""")
def cover_rollup(spark, d):
    """Non-distinct volume rows per character, as cover lists keep duplicates."""
    coc = table(spark, d, "coc").filter((F.col("note") == "silhouette") & (F.trim("character") != ""))
    got = coc.join(table(spark, d, "chapter").select("number", "volume"), F.col("chapter") == F.col("number"))
    return got.groupBy("character").agg(F.count("volume").alias("volume_rows"), F.min("volume").alias("first_volume"), F.max("volume").alias("last_volume"))


_SAGAS = f"(SELECT k + 1 AS saga, k * {SAGA} + 1 AS s, (k + 1) * {SAGA} AS e FROM (SELECT UNNEST(generate_series(0, (SELECT (MAX(number) - 1) // {SAGA} FROM chapter))) AS k))"
_ARCS = f"(SELECT k + 1 AS arc, k * {ARC} + 1 AS s, (k + 1) * {ARC} AS e FROM (SELECT UNNEST(generate_series(0, (SELECT (MAX(number) - 1) // {ARC} FROM chapter))) AS k))"


def _in_ranges(spark, d, points, width, name):
    r = ranges.equal_ranges(table(spark, d, "chapter"), "number", width, name)
    return ranges.point_in_interval(points, "chapter", r, "start", "end", width)


@query(f"""SELECT character, COUNT(DISTINCT saga)::BIGINT AS sagas, MIN(saga)::BIGINT AS first_saga, MAX(saga)::BIGINT AS last_saga FROM ({_SEEN}) x JOIN {_SAGAS} r ON chapter BETWEEN s AND e GROUP BY character""")
def story_ranges_per_entity(spark, d):
    got = _in_ranges(spark, d, seen(spark, d), SAGA, "saga").select("character", "saga").distinct()
    return got.groupBy("character").agg(F.count("*").alias("sagas"), F.min("saga").cast("long").alias("first_saga"), F.max("saga").cast("long").alias("last_saga"))


@query(f"SELECT saga::BIGINT AS saga, COUNT(number)::BIGINT AS chapters, SUM(num_page)::BIGINT AS pages FROM {_SAGAS} r LEFT JOIN chapter ON number BETWEEN s AND e GROUP BY saga")
def chapters_per_saga(spark, d):
    c = table(spark, d, "chapter").select(F.col("number").alias("chapter"), "num_page")
    got = _in_ranges(spark, d, c, SAGA, "saga").groupBy("saga").agg(F.count("*").alias("chapters"), F.sum("num_page").alias("pages"))
    every = ranges.equal_ranges(table(spark, d, "chapter"), "number", SAGA, "saga").select("saga")
    return every.join(got, "saga", "left").select(F.col("saga").cast("long").alias("saga"), F.coalesce("chapters", F.lit(0)).alias("chapters"), "pages")


@query("SELECT volume, COUNT(*)::BIGINT AS chapters, SUM(num_page)::BIGINT AS pages, MIN(date) AS first_date, MAX(date) AS last_date FROM chapter GROUP BY volume")
def chapters_per_volume(spark, d):
    return table(spark, d, "chapter").groupBy("volume").agg(F.count("*").alias("chapters"), F.sum("num_page").alias("pages"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query(f"""WITH hits AS (SELECT character, arc, COUNT(*) AS n FROM ({_SEEN}) x JOIN {_ARCS} r ON chapter BETWEEN s AND e GROUP BY 1, 2),
main AS (SELECT character, COUNT(*) AS m FROM hits WHERE n >= 0.5 * {ARC} GROUP BY character)
SELECT character, m::BIGINT AS main_arcs FROM main""")
def arc_main_counts(spark, d):
    """Arcs in at least half of whose chapters the character appears."""
    hits = _in_ranges(spark, d, seen(spark, d), ARC, "arc").groupBy("character", "arc").agg(F.count("*").alias("n"))
    return hits.filter(F.col("n") >= 0.5 * ARC).groupBy("character").agg(F.count("*").alias("main_arcs"))


def _blocks(df: DataFrame, item: str, name: str) -> DataFrame:
    """Sorted lists of ``item`` per character in blocks of 1,000 numbers; repeats stay."""
    b = df.filter(F.col(item).isNotNull()).withColumn("block", F.floor((F.col(item) - 1) / 1000))
    return b.groupBy("character", "block").agg(F.array_join(F.array_sort(F.collect_list(item)).cast("array<string>"), ",").alias(name))


def _blocks_sql(rows: str, item: str, name: str) -> str:
    return f"SELECT character, CAST(floor(({item} - 1) / 1000.0) AS BIGINT) AS block, string_agg({item}::VARCHAR, ',' ORDER BY {item}) AS {name} FROM ({rows}) WHERE {item} IS NOT NULL GROUP BY 1, 2"


@query(_blocks_sql(f"SELECT DISTINCT character, volume FROM ({_SEEN}) x JOIN chapter ON number = chapter", "volume", "volumes"))
def volume_lists(spark, d):
    chapters = table(spark, d, "chapter").select("number", "volume")
    return _blocks(seen(spark, d).join(chapters, F.col("chapter") == F.col("number")).select("character", "volume").distinct(), "volume", "volumes")


@query(_blocks_sql("SELECT character, volume FROM coc JOIN chapter ON number = chapter WHERE note = 'silhouette' AND trim(character) <> ''", "volume", "volumes"))
def cover_lists(spark, d):
    """Repeated volumes stay, as in ``cover_rollup``."""
    coc = table(spark, d, "coc").filter((F.col("note") == "silhouette") & (F.trim("character") != ""))
    return _blocks(coc.join(table(spark, d, "chapter").select("number", "volume"), F.col("chapter") == F.col("number")), "volume", "volumes")


@query(_blocks_sql(f"SELECT DISTINCT character, arc FROM ({_SEEN}) x JOIN {_ARCS} r ON chapter BETWEEN s AND e", "arc", "arcs"))
def arc_lists(spark, d):
    """Arcs are numbered by their start."""
    return _blocks(_in_ranges(spark, d, seen(spark, d), ARC, "arc").select("character", "arc").distinct(), "arc", "arcs")


@query(_blocks_sql(f"SELECT DISTINCT character, saga FROM ({_SEEN}) x JOIN {_SAGAS} r ON chapter BETWEEN s AND e", "saga", "sagas"))
def saga_lists(spark, d):
    return _blocks(_in_ranges(spark, d, seen(spark, d), SAGA, "saga").select("character", "saga").distinct(), "saga", "sagas")


def _pairs(member: str) -> str:
    return f"WITH m AS ({member}) SELECT a.v AS source, b.v AS target, COUNT(*)::BIGINT AS weight FROM m a JOIN m b ON a.g = b.g AND a.v < b.v GROUP BY 1, 2"


@query("""WITH m AS (SELECT chapter AS g, character AS v, COUNT(*) AS n FROM coc WHERE chapter IS NOT NULL AND trim(character) <> '' GROUP BY 1, 2)
SELECT a.v AS source, b.v AS target, SUM(a.n * b.n)::BIGINT AS weight FROM m a JOIN m b ON a.g = b.g AND a.v < b.v GROUP BY 1, 2""")
def coappear_chapter(spark, d):
    """Raw rows: repeated appearance rows multiply the weight."""
    coc = table(spark, d, "coc").filter(F.trim("character") != "")
    return network.pair_edges(coc, "chapter", "character", distinct=False)


@query(_pairs(f"SELECT DISTINCT arc AS g, character AS v FROM ({_SEEN}) x JOIN {_ARCS} r ON chapter BETWEEN s AND e"))
def coappear_arc(spark, d):
    return network.pair_edges(_in_ranges(spark, d, seen(spark, d), ARC, "arc"), "arc", "character")


@query(_pairs(f"SELECT DISTINCT saga AS g, character AS v FROM ({_SEEN}) x JOIN {_SAGAS} r ON chapter BETWEEN s AND e"))
def coappear_saga(spark, d):
    return network.pair_edges(_in_ranges(spark, d, seen(spark, d), SAGA, "saga"), "saga", "character")


def _consecutive(n: int):
    def run(spark, d):
        return network.pair_edges(seen(spark, d), "chapter", "character", span=n)

    run.__name__ = f"coappear_consec_{n}"
    return query(_pairs(f"SELECT DISTINCT chapter - k AS g, character AS v FROM ({_SEEN}) x, (SELECT UNNEST(generate_series(0, {n - 1})) AS k) WHERE chapter - k >= 1"))(run)


for _n in (2, 3, 4, 5, 7):
    _consecutive(_n)

_EDGES = _pairs(f"SELECT chapter AS g, character AS v FROM ({_SEEN})")
_EDGES_GT10 = _pairs(f"SELECT chapter AS g, character AS v FROM ({_BUSY})")


def _edges(spark, d):
    return network.pair_edges(seen(spark, d), "chapter", "character")


@query(f"""WITH e AS ({_EDGES}), n AS (SELECT DISTINCT character AS node FROM ({_SEEN}))
SELECT n.node, COUNT(weight)::BIGINT AS degree, COALESCE(SUM(weight), 0)::BIGINT AS weighted_degree FROM n LEFT JOIN (SELECT source AS node, weight FROM e UNION ALL SELECT target, weight FROM e) x ON x.node = n.node GROUP BY n.node""")
def network_degree(spark, d):
    """Characters that always appear alone have degree 0."""
    nodes = seen(spark, d).select(F.col("character").alias("node")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return nodes.join(network.degrees(_edges(spark, d)), "node", "left").select("node", zero("degree"), zero("weighted_degree"))


@query(f"SELECT source, target, weight FROM ({_EDGES}) ORDER BY weight DESC, source, target LIMIT 20")
def network_top_pairs(spark, d):
    return _edges(spark, d).orderBy(F.desc("weight"), "source", "target").limit(20)


def _report_sql(edges: str, nodes: str) -> str:
    return f"WITH e AS ({edges}) SELECT COUNT(*)::BIGINT AS edges, MAX(weight)::BIGINT AS max_weight, (SELECT COUNT(DISTINCT character) FROM ({nodes}))::BIGINT AS nodes FROM e"


def _report(member: DataFrame) -> DataFrame:
    nodes = member.select("character").distinct().agg(F.count("*").alias("nodes"))
    e = network.pair_edges(member, "chapter", "character")
    return e.agg(F.count("*").alias("edges"), F.max("weight").alias("max_weight")).join(F.broadcast(nodes))


@query(_report_sql(_EDGES, _SEEN))
def network_report(spark, d):
    return _report(seen(spark, d))


@query(_report_sql(_EDGES_GT10, _BUSY))
def network_report_gt10(spark, d):
    """The report over characters of more than ten chapters only."""
    return _report(busy(spark, d))


_MOST_SEEN = f"(SELECT character FROM ({_SEEN}) GROUP BY 1 ORDER BY COUNT(*) DESC, character LIMIT 1)"


@query(f"SELECT arc::BIGINT AS arc FROM {_ARCS} r WHERE EXISTS (SELECT 1 FROM ({_SEEN}) x WHERE x.character = {_MOST_SEEN} AND x.chapter BETWEEN r.s AND r.e)")
def arcs_of_most_seen(spark, d):
    """Arcs in any chapter of which the most seen character appears."""
    s = seen(spark, d)
    top = s.groupBy("character").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "character").limit(1).select("character")
    hits = _in_ranges(spark, d, s.join(F.broadcast(top), "character", "left_semi"), ARC, "arc").select("arc").distinct()
    return ranges.equal_ranges(table(spark, d, "chapter"), "number", ARC, "arc").join(hits, "arc", "left_semi").select(F.col("arc").cast("long").alias("arc"))


@query("SELECT number, title, volume, date FROM chapter ORDER BY number DESC LIMIT 1")
def entity_latest(spark, d):
    return table(spark, d, "chapter").select("number", "title", "volume", "date").orderBy(F.desc("number")).limit(1)


@query("""SELECT c.chapter, c.character, x.name, x.status FROM coc c LEFT JOIN characters x ON x.id = c.character WHERE c.chapter = (SELECT MAX(number) FROM chapter)""")
def entity_cast(spark, d):
    """Cast of the latest chapter, unknown characters kept."""
    last = table(spark, d, "chapter").agg(F.max("number").alias("last"))
    cast_ = table(spark, d, "coc").join(F.broadcast(last), F.col("chapter") == F.col("last"))
    return cast_.join(table(spark, d, "characters").select("id", "name", "status"), F.col("character") == F.col("id"), "left").select("chapter", "character", "name", "status")


@query(r"SELECT trim(array_to_string(list_sort(string_split(regexp_replace(lower(name), '[^\p{L}\p{N}]+', ' ', 'g'), ' ')), ' ')) AS name, COUNT(*)::BIGINT AS n FROM characters WHERE name IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1")
def dup_names(spark, d):
    """Names that several persons bear, case, separators and the order of the parts aside."""
    parts = F.split(F.regexp_replace(F.lower("name"), r"[^\p{L}\p{N}]+", " "), " ")
    folded = F.trim(F.array_join(F.array_sort(parts), " "))
    return table(spark, d, "characters").filter(F.col("name").isNotNull()).groupBy(folded.alias("name")).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


_ALIASES = "(SELECT id AS alias, canonical FROM characters JOIN (SELECT lower(trim(name)) AS k, MIN(id) AS canonical FROM characters WHERE name IS NOT NULL GROUP BY 1) ON lower(trim(name)) = k WHERE id <> canonical)"


@query(f"SELECT DISTINCT chapter, COALESCE(canonical, character) AS character, note FROM coc LEFT JOIN {_ALIASES} ON alias = character")
def merge_aliases(spark, d):
    """Ids whose folded names are equal collapse to the least id; rows that become equal collapse."""
    people = table(spark, d, "characters").filter(F.col("name").isNotNull()).select("id", F.lower(F.trim("name")).alias("k"))
    least = people.groupBy("k").agg(F.min("id").alias("canonical"))
    aliases = people.join(least, "k").filter(F.col("id") != F.col("canonical")).select(F.col("id").alias("alias"), "canonical")
    return merging.merge_aliases(table(spark, d, "coc").select("chapter", "character", "note"), "character", aliases)


@query("SELECT COUNT(*)::BIGINT AS raw_rows, COUNT(DISTINCT (chapter, character, note))::BIGINT AS kept_rows FROM coc")
def merge_dedup(spark, d):
    rows = table(spark, d, "coc").groupBy("chapter", "character", "note").agg(F.count("*").alias("n"))
    return rows.agg(F.sum("n").alias("raw_rows"), F.count("*").alias("kept_rows"))


@query("SELECT c.chapter, c.character FROM coc c WHERE EXISTS (SELECT 1 FROM characters x WHERE x.id = c.character AND NOT (COALESCE(x.status IN ('Active', 'Destroyed'), FALSE) OR (COALESCE(trim(x.status), '') = '' AND COALESCE(trim(x.origin), '') = '' AND x.id NOT IN (" + ", ".join(f"'{k}'" for k in KEPT) + "))))")
def filter_non_entities(spark, d):
    """Appearances of entities that are persons: not of a thing's status, and with a status or an origin."""
    from tidemark.functions.scalars import THING_STATUSES, blank

    x = table(spark, d, "characters")
    person = x.filter(~(F.coalesce(F.col("status").isin(*THING_STATUSES), F.lit(False)) | (blank(F.col("status")) & blank(F.col("origin")) & ~F.col("id").isin(*KEPT)))).select("id")
    return table(spark, d, "coc").join(person, F.col("character") == F.col("id"), "left_semi").select("chapter", "character")


@query("SELECT page_id, COUNT(*)::BIGINT AS pages FROM wiki_text w WHERE NOT EXISTS (SELECT 1 FROM wiki_chunks c WHERE c.page_id = w.page_id) GROUP BY page_id")
def anti_cached(spark, d):
    """Pages without any stored chunk."""
    return table(spark, d, "wiki_text").join(table(spark, d, "wiki_chunks").select("page_id"), "page_id", "left_anti").groupBy("page_id").agg(F.count("*").alias("pages"))


_COUNTED = f"(SELECT x.id, x.name, x.bounty, s.n, s.last FROM characters x LEFT JOIN (SELECT character, COUNT(*) AS n, MAX(chapter) AS last FROM ({_SEEN}) GROUP BY 1) s ON s.character = x.id)"


def scope_sql(recent_from: int) -> str:
    return f"""WITH c AS {_COUNTED}, w AS (SELECT page_id, title, length(full_text) AS l FROM wiki_text WHERE page_type = 'character')
SELECT page_id, COUNT(*)::BIGINT AS n FROM wiki_text WHERE page_id IN (
  SELECT page_id FROM wiki_text WHERE page_type IN ('arc', 'saga')
  UNION SELECT page_id FROM w JOIN (SELECT name FROM c WHERE n IS NOT NULL ORDER BY n DESC, id LIMIT {SCOPE_TOP}) t ON t.name = w.title
  UNION SELECT page_id FROM (SELECT page_id, MAX(l) AS l FROM w GROUP BY 1 ORDER BY l DESC NULLS LAST, page_id LIMIT {SCOPE_TOP})
  UNION SELECT page_id FROM w JOIN c ON c.name = w.title WHERE c.bounty > {SCOPE_BOUNTY}
  UNION SELECT page_id FROM w JOIN c ON c.name = w.title WHERE c.last >= {recent_from} AND c.n >= {SCOPE_RECENT_LEAST}) GROUP BY page_id"""


def scope_union(spark, d, recent_from: int) -> DataFrame:
    w = table(spark, d, "wiki_text")
    people = w.filter(F.col("page_type") == "character")
    counts = seen(spark, d).groupBy("character").agg(F.count("*").alias("n"), F.max("chapter").alias("last")).withColumnRenamed("character", "id")
    c = table(spark, d, "characters").select("id", "name", "bounty").join(counts, "id", "left")
    top = c.filter(F.col("n").isNotNull()).orderBy(F.desc("n"), "id").limit(SCOPE_TOP).select("name")
    rich = c.filter(F.col("bounty") > SCOPE_BOUNTY).select("name")
    recent = c.filter((F.col("last") >= recent_from) & (F.col("n") >= SCOPE_RECENT_LEAST)).select("name")
    named = top.union(rich).union(recent).distinct().withColumnRenamed("name", "title")
    long = people.groupBy("page_id").agg(F.max(F.length("full_text")).alias("l")).orderBy(F.desc_nulls_last("l"), "page_id").limit(SCOPE_TOP).select("page_id")
    story = w.filter(F.col("page_type").isin("arc", "saga")).select("page_id")
    scope = story.union(people.join(named, "title", "left_semi").select("page_id")).union(long).distinct()
    return w.join(scope, "page_id", "left_semi").groupBy("page_id").agg(F.count("*").alias("n"))


@query(scope_sql(SCOPE_RECENT_FROM))
def semi_scope_union(spark, d):
    """Pages in scope: story pages, and pages of persons most seen, longest, of high reward, or lately and repeatedly seen."""
    return scope_union(spark, d, SCOPE_RECENT_FROM)


@query(scope_sql(100))
def semi_scope_union_early(spark, d):
    """The same with the fifth branch from chapter 100 on, which small tables reach."""
    return scope_union(spark, d, 100)


@query(f"""SELECT t.character, x.name, t.n::BIGINT AS chapters FROM (SELECT character, COUNT(*) AS n FROM ({_SEEN}) GROUP BY 1 ORDER BY n DESC, character LIMIT 25) t LEFT JOIN characters x ON x.id = t.character""")
def topn_join(spark, d):
    top = seen(spark, d).groupBy("character").agg(F.count("*").alias("chapters")).orderBy(F.desc("chapters"), "character").limit(25)
    return top.join(table(spark, d, "characters").select("id", "name"), F.col("character") == F.col("id"), "left").select("character", "name", "chapters")


@query("""SELECT number, date, days, CASE WHEN days > 21 THEN 'long' WHEN days > 14 THEN 'break' ELSE 'none' END AS gap FROM
(SELECT number, date, CAST(LEAD(date) OVER (ORDER BY number) - date AS BIGINT) AS days FROM chapter WHERE date IS NOT NULL AND number IS NOT NULL) WHERE days IS NOT NULL""")
def gap_days(spark, d):
    """Days until the next dated chapter, over all chapters in order; the last one has none."""
    c = table(spark, d, "chapter").select("number", "date").filter(F.col("date").isNotNull() & F.col("number").isNotNull())
    got = ranges.following(c, "number", "date", "next").select("number", "date", F.datediff("next", "date").cast("long").alias("days"))
    return got.filter(F.col("days").isNotNull()).withColumn("gap", F.when(F.col("days") > 21, "long").when(F.col("days") > 14, "break").otherwise("none"))


@query("SELECT number, title, date FROM chapter ORDER BY number DESC LIMIT 10")
def last_chapters(spark, d):
    """The last ten rows, in order."""
    return table(spark, d, "chapter").select("number", "title", "date").orderBy(F.desc("number")).limit(10).orderBy("number")


@query(f"SELECT DISTINCT character FROM ({_SEEN}) EXCEPT SELECT id FROM characters")
def unlisted_characters(spark, d):
    """Characters that appear but are not on the list."""
    return seen(spark, d).select("character").subtract(table(spark, d, "characters").select("id"))


@query("SELECT jump, COUNT(*)::BIGINT AS n, COUNT(num_page)::BIGINT AS stated, ROUND(AVG(num_page), 6) AS mean, ROUND(STDDEV_SAMP(num_page), 6) AS sd, MIN(num_page) AS least, MAX(num_page) AS most FROM chapter GROUP BY jump")
def page_summary(spark, d):
    p = F.col("num_page")
    return table(spark, d, "chapter").groupBy("jump").agg(F.count("*").alias("n"), F.count(p).alias("stated"), F.round(F.avg(p), 6).alias("mean"), F.round(F.stddev_samp(p), 6).alias("sd"), F.min(p).alias("least"), F.max(p).alias("most"))


@query("""SELECT ((number - 1) // 100)::BIGINT AS century, MIN(date) AS start_date, MAX(date) AS end_date, CAST(MAX(date) - MIN(date) AS BIGINT) AS days FROM chapter GROUP BY 1 HAVING COUNT(*) = 100""")
def century_windows(spark, d):
    """Tumbling windows of 100 chapters; an incomplete window is left out."""
    c = table(spark, d, "chapter").groupBy(F.floor((F.col("number") - 1) / 100).alias("century")).agg(F.count("*").alias("n"), F.min("date").alias("start_date"), F.max("date").alias("end_date"))
    return c.filter(F.col("n") == 100).select("century", "start_date", "end_date", F.datediff("end_date", "start_date").cast("long").alias("days"))


@query("""SELECT year(date)::BIGINT AS year, """ + ", ".join(f"ROUND(AVG(CASE WHEN month(date) = {m} THEN num_page END), 4) AS m{m:02d}" for m in range(1, 13)) + " FROM chapter WHERE date IS NOT NULL GROUP BY 1")
def pivot_year_month(spark, d):
    c = table(spark, d, "chapter").filter(F.col("date").isNotNull()).select(F.year("date").cast("long").alias("year"), F.month("date").alias("m"), "num_page")
    got = c.groupBy("year").pivot("m", list(range(1, 13))).agg(F.avg("num_page"))
    return got.select("year", *[F.round(F.col(str(m)), 4).alias(f"m{m:02d}") for m in range(1, 13)])


@query("""SELECT isoyear(date)::BIGINT AS year, """ + ", ".join(f"ROUND(AVG(CASE WHEN week(date) = {k} THEN num_page END), 4) AS w{k:02d}" for k in range(1, 54)) + " FROM chapter WHERE date IS NOT NULL GROUP BY 1")
def pivot_year_week(spark, d):
    """ISO weeks in ISO years, which differ from calendar years around New Year."""
    c = table(spark, d, "chapter").filter(F.col("date").isNotNull())
    c = c.select(F.extract(F.lit("YEAROFWEEK"), "date").cast("long").alias("year"), F.weekofyear("date").alias("w"), "num_page")
    got = c.groupBy("year").pivot("w", list(range(1, 54))).agg(F.avg("num_page"))
    return got.select("year", *[F.round(F.col(str(k)), 4).alias(f"w{k:02d}") for k in range(1, 54)])


@query("""SELECT ROUND(SUM(num_page) / ((CAST(MAX(date) - MIN(date) AS BIGINT) * 5) // 7)::DOUBLE, 6) AS pages_per_working_day FROM chapter""")
def pages_per_day(spark, d):
    c = table(spark, d, "chapter").agg(F.sum("num_page").alias("p"), F.datediff(F.max("date"), F.min("date")).alias("days"))
    return c.select(F.round(F.col("p") / F.floor(F.col("days") * 5 / 7).cast("double"), 6).alias("pages_per_working_day"))


@query("""SELECT number, title, COUNT(*) OVER (PARTITION BY year(date), week(date)) > 1 AS same_week FROM chapter WHERE date IS NOT NULL""")
def duplicate_weeks(spark, d):
    c = table(spark, d, "chapter").filter(F.col("date").isNotNull())
    n = F.count("*").over(Window.partitionBy(F.year("date"), F.weekofyear("date")))
    return c.select("number", "title", (n > 1).alias("same_week"))


@query(f"""SELECT arc::BIGINT AS arc, (SELECT MIN(saga) FROM {_SAGAS} g WHERE g.s <= a.s AND a.e <= g.e)::BIGINT AS saga FROM {_ARCS} a""")
def arcs_in_sagas(spark, d):
    """First saga that contains each arc."""
    c = table(spark, d, "chapter")
    arcs, sagas = ranges.equal_ranges(c, "number", ARC, "arc"), ranges.equal_ranges(c, "number", SAGA, "saga")
    got = ranges.first_container(arcs, "start", "end", sagas.withColumn("ord", F.col("saga")), "start", "end", "ord", "saga", SAGA)
    return got.select(F.col("arc").cast("long").alias("arc"), F.col("saga").cast("long").alias("saga"))


@query(f"""SELECT p.id, a.arc::BIGINT AS arc FROM (SELECT character AS id, MIN(chapter) AS lo, MAX(chapter) AS hi FROM ({_SEEN}) GROUP BY 1 HAVING COUNT(*) > {RARE}) p JOIN {_ARCS} a ON p.lo <= a.e AND a.s <= p.hi""")
def active_arcs(spark, d):
    """Interval overlap: arcs between the first and last appearance."""
    span = seen(spark, d).groupBy(F.col("character").alias("id")).agg(F.min("chapter").alias("lo"), F.max("chapter").alias("hi"), F.count("*").alias("n")).filter(F.col("n") > RARE).drop("n")
    arcs = ranges.equal_ranges(table(spark, d, "chapter"), "number", ARC, "arc")
    return ranges.overlapping(span, "lo", "hi", arcs, "start", "end", ARC * 20).select("id", F.col("arc").cast("long").alias("arc"))


@query("""SELECT c.chunk_id, w.title FROM wiki_chunks c JOIN (SELECT page_id, title FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY scraped_at DESC NULLS LAST, md5(COALESCE(full_text, '')) DESC) AS r FROM wiki_text WHERE page_id IS NOT NULL) WHERE r = 1) w USING (page_id)""")
def active_chunks(spark, d):
    """Chunks with the title of the page's open version."""
    pages = table(spark, d, "wiki_text").filter(F.col("page_id").isNotNull()).withColumn("_h", F.md5(F.coalesce("full_text", F.lit(""))))
    newest = merging.latest(pages.select("page_id", "title", "scraped_at", "_h"), ["page_id"], [F.desc_nulls_last("scraped_at"), F.desc("_h")]).select("page_id", "title")
    return table(spark, d, "wiki_chunks").select("chunk_id", "page_id").join(newest, "page_id").select("chunk_id", "title")


def queries() -> dict:
    return Q


def oracle_sql() -> dict[str, str]:
    return SQL
