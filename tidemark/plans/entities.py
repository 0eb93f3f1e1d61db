"""Queries over persons, raw records and groups: field readers, scores, tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import grammars, scalars, wikitext
from tidemark.operators import packed_values, scoring
from tidemark.plans import story
from tidemark.session import materialize
from tidemark.sources.tables import table

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


#: Origins that meet every branch of the ladder; record k is read with the k-th of them.
ORIGINS = (
    "East Blue (Dawn Village)", " West Blue", "North Blue; Flevance", "south blue", "Grand Line (Skypiea)", "Grand Line", "Jaya", "Calm Belt (Rusukaina)", "Red Line (Mary Geoise)", "Grand Line (Fish-Man Island)",
    "Grand Line (Wano Country)", "New World", "Sky Island (Birka)", "Somewhere else", "  ", None,
)
_ORIGINS = "[" + ", ".join("NULL" if o is None else f"'{o}'" for o in ORIGINS) + "]"
_O = "lower(trim(origin))"
_REGIONS = f"""SELECT rec_id, CASE WHEN COALESCE(trim(origin), '') = '' THEN NULL WHEN {_any(_O, scalars.RED_LINE)} THEN 'Red Line' WHEN {_any(_O, scalars.UNDERWATER)} THEN 'Underwater'
WHEN {_any(_O, scalars.SKY)} THEN 'Sky Island' {" ".join(f"WHEN starts_with({_O}, '{s}') THEN '{s.title()}'" for s in scalars.SEAS)}
WHEN {_any(_O, scalars.NEW_WORLD)} THEN 'New World' WHEN starts_with({_O}, 'calm belt') THEN 'Calm Belt' WHEN starts_with({_O}, 'grand line') OR {_O} = 'jaya' THEN 'Grand Line' ELSE 'Unknown Region' END AS region
FROM (SELECT rec_id, CASE WHEN rec_id % 17 = 16 THEN origin ELSE {_ORIGINS}[rec_id % 17 + 1] END AS origin FROM characters_detail)"""


def _regions(spark, d) -> DataFrame:
    k = (F.col("rec_id") % 17).cast("int")
    origin = F.when(k == 16, F.col("origin")).otherwise(F.get(F.array(*map(F.lit, ORIGINS)), k))
    return table(spark, d, "characters_detail").select("rec_id", scalars.region(origin).alias("region"))


@query(_REGIONS)
def region_classify(spark, d):
    """Regions of the records; all but every 17th are read with an origin of the list, so that every branch is met."""
    return _regions(spark, d)


@query(f"SELECT region, COUNT(*)::BIGINT AS n FROM ({_REGIONS}) GROUP BY region")
def region_tally(spark, d):
    return _regions(spark, d).groupBy("region").agg(F.count("*").alias("n"))


@query("SELECT COUNT(*)::BIGINT AS n, COUNT(DISTINCT origin)::BIGINT AS origins, COUNT(CASE WHEN COALESCE(trim(origin), '') = '' THEN 1 END)::BIGINT AS blank FROM characters")
def origin_counts(spark, d):
    per = table(spark, d, "characters").groupBy("origin").agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("n"), F.count("origin").alias("origins"), F.coalesce(F.sum(F.when(scalars.blank(F.col("origin")), F.col("n"))), F.lit(0)).alias("blank"))


_MONTHS = " ".join(f"WHEN '{m}' THEN {k}" for k, m in enumerate(scalars.MONTH_DAYS, 1))
_DAYS = " ".join(f"WHEN '{m}' THEN {n}" for m, n in scalars.MONTH_DAYS.items())
_BIRTH = r"^([A-Za-z]+)\s+(\d{1,2})(st|nd|rd|th)(\s*\([^)]*\))?$"
_BIRTHS = f"""(SELECT id, CASE lower(regexp_extract(trim(birth), '{_BIRTH}', 1)) {_MONTHS} END AS m, CASE lower(regexp_extract(trim(birth), '{_BIRTH}', 1)) {_DAYS} END AS most,
TRY_CAST(regexp_extract(trim(birth), '{_BIRTH}', 2) AS INT) AS dd FROM characters)"""


@query(f"""SELECT id, CASE WHEN dd BETWEEN 1 AND most THEN lpad(m::VARCHAR, 2, '0') || '-' || lpad(dd::VARCHAR, 2, '0') END AS month_day FROM {_BIRTHS}""")
def birth_parse(spark, d):
    return table(spark, d, "characters").select("id", scalars.month_day(F.col("birth")).alias("month_day"))


@query(f"SELECT m::BIGINT AS month, COUNT(*)::BIGINT AS n FROM {_BIRTHS} WHERE dd BETWEEN 1 AND most GROUP BY m")
def birth_months(spark, d):
    md = table(spark, d, "characters").select(scalars.month_day(F.col("birth")).alias("md")).filter(F.col("md").isNotNull())
    return md.groupBy(F.substring("md", 1, 2).cast("long").alias("month")).agg(F.count("*").alias("n"))


@query("SELECT number, date FROM chapter")
def date_parse(spark, d):
    """Dates written out in long form and read back."""
    text = F.date_format("date", "MMMM d, yyyy")
    odd = F.when(F.col("number") % 2 == 0, F.regexp_replace(text, ", ", ",")).otherwise(text)
    return table(spark, d, "chapter").select("number", scalars.long_date(odd).alias("date"))


@query("SELECT number, CASE WHEN number % 7 = 0 THEN 19 ELSE num_page END AS pages FROM chapter")
def page_parse(spark, d):
    text = F.when(F.col("number") % 7 == 0, "1917 (Volume)").otherwise(F.concat(F.col("num_page").cast("string"), F.lit(" (without cover)*")))
    return table(spark, d, "chapter").select("number", scalars.page_count(text).alias("pages"))


_NO_MONEY = ", ".join(f"'{w}'" for w in scalars.NO_MONEY)


@query(rf"""WITH x AS (SELECT id, bounties, CASE WHEN contains(bounties, chr(10)) THEN array_to_string([trim(l) FOR l IN string_split(bounties, chr(10)) IF trim(l) NOT IN ('', '[', ']') AND NOT regexp_matches(trim(l), '^\d+$')], ';') ELSE trim(bounties) END AS line FROM characters),
y AS (SELECT *, [TRY_CAST(replace(regexp_extract(p, '[\d,]+'), ',', '') AS BIGINT) FOR p IN [trim(replace(q, '¥', '')) FOR q IN string_split(line, ';')] IF p NOT IN ({_NO_MONEY}) AND NOT starts_with(p, 'bounty') AND regexp_replace(p, '[★ ]', '', 'g') <> ''] AS l FROM x)
SELECT id, NULLIF(line, '') AS bounties, CASE WHEN id = 'Buggy' AND COALESCE(bounties, '') <> '' THEN 3189000000 ELSE [n FOR n IN l IF n IS NOT NULL AND n > 0 AND n <= {scalars.MOST_MONEY}][1] END AS amount FROM y""")
def bounty_parse(spark, d):
    """The loader's own first-number reading; converted amounts are in p4_found."""
    b = F.col("bounties")
    return table(spark, d, "characters").select("id", scalars.money_text(b).alias("bounties"), scalars.first_money(b, F.col("id")).alias("amount"))


@query(r"""WITH x AS (SELECT rec_id, COALESCE(CASE WHEN rec_id % 3 = 0 AND amount IS NULL THEN 7 END, amount) AS amount FROM (SELECT d.rec_id, c.bounty AS amount FROM characters_detail d LEFT JOIN characters c ON c.id = d.id)) SELECT rec_id, amount FROM x""")
def bounty_repair(spark, d):
    """Amounts that are null are set from a second reading, others stay."""
    from tidemark.operators.merging import set_column

    records = table(spark, d, "characters_detail").select("rec_id", "id")
    people = table(spark, d, "characters").select("id", F.col("bounty").alias("amount"))
    repaired = records.select("rec_id", F.when(F.col("rec_id") % 3 == 0, F.lit(7).cast("bigint")).alias("amount"))
    return set_column(records.join(people, "id", "left").select("rec_id", "amount"), "amount", repaired, "rec_id", only_null=True)


#: Ages that meet every rule; record k is read with the k-th of them.
AGES = ("17 (debut)\n19 (after)", "Over 100", "At least 40", "Roughly old", "20–30", "41-43 (now)", "biologically 28)", "Bas: 30\nAnd: 33\nKerville: 31", "[1]\n15", "unknown", "At", "12\nunknown", "", None, "3\n\n  8 ")
_AGES = "[" + ", ".join("NULL" if a is None else "'" + a.replace("\n", "' || chr(10) || '") + "'" for a in AGES) + "]"
_AGE_WORDS = ", ".join(f"'{w}'" for w in scalars.AGE_WORDS)
_WHOLE = "TRY_CAST(CASE WHEN regexp_matches({0}, '^[+-]?\\d+$') THEN {0} END AS INT)"


@query(f"""WITH x AS (SELECT rec_id, CASE WHEN rec_id % 16 = 15 THEN age ELSE {_AGES}[rec_id % 16 + 1] END AS age FROM characters_detail),
l AS (SELECT rec_id, string_split(trim(line), ' ') AS w FROM (SELECT rec_id, UNNEST(string_split(age, chr(10))) AS line FROM x) WHERE trim(line) <> '' AND NOT starts_with(trim(line), '[')),
v AS (SELECT rec_id, w, CASE WHEN w[1] IN ({_AGE_WORDS}) THEN {_WHOLE.format("w[2]")} WHEN w[1] = 'At' AND w[2] = 'least' THEN {_WHOLE.format("w[3]")} WHEN contains(w[1], '–') THEN {_WHOLE.format("string_split(w[1], '–')[2]")}
  WHEN contains(w[1], '-') THEN {_WHOLE.format("string_split(w[1], '-')[2]")} WHEN contains(w[1], 'biologically') THEN {_WHOLE.format("string_split(w[2], ')')[1]")} ELSE {_WHOLE.format("w[1]")} END AS v FROM l),
m AS (SELECT rec_id, MAX(v) AS age, COALESCE(BOOL_OR(v IS NULL AND (w[1] IN ({_AGE_WORDS}) OR (w[1] = 'At' AND COALESCE(w[2], 'least') = 'least') OR regexp_matches(w[1], '[–-]|biologically'))), FALSE) AS bad FROM v GROUP BY rec_id)
SELECT x.rec_id, CASE WHEN NOT m.bad THEN m.age END AS age FROM x LEFT JOIN m USING (rec_id)""")
def age_parse(spark, d):
    """Ages of the records; all but every 16th are read with an age of the list, so that every rule is met."""
    k = (F.col("rec_id") % 16).cast("int")
    age = F.when(k == 15, F.col("age")).otherwise(F.get(F.array(*map(F.lit, AGES)), k))
    return table(spark, d, "characters_detail").select("rec_id", scalars.highest_age(age).alias("age"))


@query(r"""WITH x AS (SELECT rec_id, [trim(p) FOR p IN string_split(CASE WHEN rec_id % 4 = 1 THEN blood_type || chr(10) || '[' || chr(10) || '3' || chr(10) || ']' WHEN rec_id % 4 = 2 THEN blood_type || chr(10) || 'S (RH-)' ELSE blood_type END, chr(10)) IF trim(p) NOT IN ('', '[', ']') AND NOT regexp_matches(trim(p), '^\d+$')] AS l FROM characters_detail)
SELECT rec_id, NULLIF(array_to_string(l, ', '), '') AS blood_type, CASE WHEN len(l) > 1 THEN 'mixed' ELSE string_split(l[1], ' ')[1] END AS blood FROM x""")
def blood_parse(spark, d):
    """Blood types of the records; to some a reference mark or a second type is added."""
    b, k = F.col("blood_type"), F.col("rec_id") % 4
    text = F.when(k == 1, F.concat(b, F.lit("\n[\n3\n]"))).when(k == 2, F.concat(b, F.lit("\nS (RH-)"))).otherwise(b)
    return table(spark, d, "characters_detail").select("rec_id", scalars.blood_types(text).alias("blood_type"), scalars.blood_group(text).alias("blood"))


@query("SELECT id, replace(trim(name), ' ', '_') AS as_id, replace(id, '_', ' ') AS as_name FROM characters")
def id_names(spark, d):
    return table(spark, d, "characters").select("id", scalars.to_id(F.col("name")).alias("as_id"), scalars.to_name(F.col("id")).alias("as_name"))


@query(r"SELECT number, lower(regexp_replace(regexp_replace(title, '[^a-zA-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS slug FROM chapter")
def title_slugs(spark, d):
    return table(spark, d, "chapter").select("number", scalars.slug(F.col("title")).alias("slug"))


@query("""SELECT rec_id, id, source FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY scraped_at DESC NULLS LAST, rec_id DESC) AS r FROM characters_detail) WHERE r = 1""")
def latest_records(spark, d):
    """Newest raw record per id."""
    from tidemark.operators.merging import latest

    return latest(table(spark, d, "characters_detail").select("rec_id", "id", "source", "scraped_at"), ["id"], [F.desc_nulls_last("scraped_at"), F.desc("rec_id")]).select("rec_id", "id", "source")


@query("""SELECT character_id, group_name, status FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY character_id, group_name ORDER BY aff_id) AS r FROM character_affiliation) WHERE r = 1""")
def affiliation_first(spark, d):
    """First row per person and group in input order."""
    from tidemark.operators.merging import latest

    return latest(table(spark, d, "character_affiliation"), ["character_id", "group_name"], [F.asc("aff_id")]).select("character_id", "group_name", "status")


@query()
def affiliation_split(spark, d):
    """Group, sub-group and status of every value of the affiliation fields."""
    return _split(spark, d, "affiliation")


@query()
def occupation_split(spark, d):
    """Role and status of every value of the occupation fields; of equal roles of a person the first stays."""
    from tidemark.operators.merging import latest

    detail = table(spark, d, "characters_detail").filter(F.col("occupation").isNotNull())
    got = detail.select("rec_id", "id", F.posexplode(grammars.occupations_udf("occupation", "id")).alias("pos", "o")).select("rec_id", "id", (F.col("pos") + 1).alias("pos"), "o.role", "o.status")
    return latest(got, ["id", "role"], [F.asc("rec_id"), F.asc("pos")])


def _split(spark, d, field: str) -> DataFrame:
    detail, aff = table(spark, d, "characters_detail"), table(spark, d, "character_affiliation")
    fields = packed_values.packed_fields(detail, aff).filter(F.col("field") == field)
    return packed_values.unpack(fields).withColumn("a", grammars.affiliation_udf("item")).select("rec_id", "pos", "a.group", "a.sub_group", "a.status")


@query("""SELECT c.id, r.occupation FROM characters c LEFT JOIN (SELECT id, occupation FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY scraped_at DESC NULLS LAST, rec_id DESC) AS r FROM characters_detail WHERE COALESCE(trim(occupation), '') <> '') WHERE r = 1) r USING (id)""")
def occupation_column(spark, d):
    """The list of persons with the occupation of their newest record that states one; the column is added if missing."""
    from tidemark.operators.merging import latest, set_column

    stated = table(spark, d, "characters_detail").filter(~scalars.blank(F.col("occupation")))
    newest = latest(stated.select("id", "occupation", "scraped_at", "rec_id"), ["id"], [F.desc_nulls_last("scraped_at"), F.desc("rec_id")])
    return set_column(table(spark, d, "characters").select("id"), "occupation", newest, "id")


#: Powers that meet every rule of their grammar: name, type and English name as written, and what is read of them.
POWERS = (
    (("Aka Aka no Mi", "Paramecia", "Red-Red Fruit"), ("Aka Aka no Mi", None, "Red-Red Fruit", "Paramecia", None, False)),
    (("Kumo Kumo no Mi [3]", "Logia [4]", None), ("Kumo Kumo no Mi", None, None, "Logia", None, False)),
    (("Ushi Ushi no Mi, Model: Yak", "Ancient Zoan", "Ox-Ox Fruit [2]"), ("Ushi Ushi no Mi", "Yak", "Ox-Ox Fruit", "Zoan", "Ancient", False)),
    (("Ushi Ushi no Mi, Model: Yak (Artificial)", "Zoan", None), ("Ushi Ushi no Mi", "Yak", None, "Zoan", None, True)),
    (("Tori Tori no Mi (Artifical)", "Artificial Zoan", None), ("Tori Tori no Mi", None, None, "Zoan", None, True)),
    (("Nori Nori no Mi(Umi Umi no Mi, Model: Sea)", "Paramecia(Mythical Zoan)", "Glue Fruit"), ("Umi Umi no Mi", "Sea", "Glue Fruit", "Zoan", "Mythical", False)),
)


def _power_values() -> str:
    text = lambda v: "NULL" if v is None else str(v).upper() if isinstance(v, bool) else f"'{v}'"
    return ", ".join("(" + ", ".join([str(k), *map(text, want)]) + ")" for k, (_, want) in enumerate(POWERS))


_POWER_ROWS = f"""SELECT d.rec_id, v.name, v.model, v.english, v.kind, v.refined, v.made FROM characters_detail d JOIN (VALUES {_power_values()}) v(k, name, model, english, kind, refined, made) ON v.k = d.rec_id % 7
UNION ALL SELECT d.rec_id, v.name, v.model, v.english, v.kind, v.refined, v.made FROM characters_detail d JOIN (VALUES {_power_values()}) v(k, name, model, english, kind, refined, made) ON d.rec_id % 7 < 6 AND d.rec_id % 3 = 0 AND v.k = (d.rec_id + 2) % 6"""


def _power_rows(spark, d) -> DataFrame:
    raw = lambda at, k: F.get(F.array(*[F.lit(r[0][at]) for r in POWERS]), k.cast("int"))
    first, second = F.col("rec_id") % 7, (F.col("rec_id") + 2) % 6
    two = lambda at: F.when((first < 6) & (F.col("rec_id") % 3 == 0), raw(at, second))
    got = table(spark, d, "characters_detail").select("rec_id", F.explode(grammars.powers_udf(raw(0, first), raw(1, first), raw(2, first), two(0), two(1), two(2))).alias("p"))
    return got.select("rec_id", "p.name", "p.model", "p.english", "p.kind", "p.refined", "p.made")


@query(_POWER_ROWS)
def fruit_parse(spark, d):
    """Powers of up to two slots a record; the tables have no such columns, so record k is read with the k-th of the list."""
    return _power_rows(spark, d)


@query("SELECT status, COUNT(*)::BIGINT AS n, COUNT(DISTINCT group_name)::BIGINT AS groups FROM character_affiliation GROUP BY status")
def status_tally(spark, d):
    per = table(spark, d, "character_affiliation").groupBy("status", "group_name").agg(F.count("*").alias("n"))
    return per.groupBy("status").agg(F.sum("n").alias("n"), F.count("group_name").alias("groups"))


@query()
def key_names(spark, d):
    """Storage keys: names without accents and control characters."""
    return table(spark, d, "characters").select("id", wikitext.sanitize_udf("name").alias("key"))


@query(r"""SELECT id, NOT (COALESCE(regexp_matches(lower(name), '\b(?:pirates?|marines?|animals?|country|village|town|island|bounty hunters?|crew|kingdom|army)\b'), FALSE) AND age IS NULL AND COALESCE(trim(birth), '') = '') AS likely FROM characters""")
def likely_persons(spark, d):
    return table(spark, d, "characters").select("id", scalars.likely_person(F.col("name"), F.col("age"), F.col("birth")).alias("likely"))


#: Addresses that meet every outcome; record k is read with the k-th of them.
ADDRESSES = (None, "http://wiki/Video_Games/x", "http://elsewhere/x", "http://wiki/x", " ")
_ADDRESSES = "[" + ", ".join("NULL" if u is None else f"'{u}'" for u in ADDRESSES) + "]"


@query(f"""WITH x AS (SELECT rec_id, {_ADDRESSES}[rec_id % 5 + 1] AS url, rec_id % 2 = 0 AND (COALESCE(trim(name), '') <> '' OR COALESCE(trim(origin), '') <> '' OR COALESCE(trim(birth), '') <> '' OR COALESCE(trim(age), '') <> '') AS stated FROM characters_detail)
SELECT CASE WHEN stated THEN 'success' WHEN COALESCE(trim(url), '') = '' THEN 'failed_no_url' WHEN contains(url, 'Video_Games') THEN 'failed_video_game' WHEN NOT contains(url, 'wiki') THEN 'failed_external_url' ELSE 'failed_unknown' END AS outcome, COUNT(*)::BIGINT AS n FROM x GROUP BY 1""")
def scrape_outcomes(spark, d):
    """Outcomes over the records; those with an odd id are read as if nothing were stated in them."""
    detail = table(spark, d, "characters_detail")
    fields = [F.when(F.col("rec_id") % 2 == 0, F.col(c)) for c in ("name", "origin", "birth", "age")]
    url = F.get(F.array(*map(F.lit, ADDRESSES)), (F.col("rec_id") % 5).cast("int"))
    return detail.groupBy(scalars.scrape_outcome(fields, url, "wiki").alias("outcome")).agg(F.count("*").alias("n"))


@query("""SELECT c.id, EXISTS (SELECT 1 FROM character_affiliation a WHERE a.character_id = c.id AND contains(lower(a.group_name), 'navy')) AS navy, EXISTS (SELECT 1 FROM coc WHERE character = c.id AND note = 'silhouette') AS cover FROM characters c""")
def membership_flags(spark, d):
    """Boolean columns for membership in lists of ids."""
    from tidemark.operators.merging import membership_flags as flags

    navy = table(spark, d, "character_affiliation").filter(F.lower("group_name").contains("navy")).select(F.col("character_id").alias("id"))
    cover = table(spark, d, "coc").filter(F.col("note") == "silhouette").select(F.col("character").alias("id"))
    return flags(table(spark, d, "characters").select("id"), "id", {"navy": navy, "cover": cover})


@query("""SELECT COUNT(*)::BIGINT AS n, COUNT(name)::BIGINT AS names, COUNT(origin)::BIGINT AS origins, COUNT(birth)::BIGINT AS births, COUNT(bounty)::BIGINT AS bounties, COUNT(age)::BIGINT AS ages FROM characters""")
def availability(spark, d):
    c = F.count
    return table(spark, d, "characters").agg(c("*").alias("n"), c("name").alias("names"), c("origin").alias("origins"), c("birth").alias("births"), c("bounty").alias("bounties"), c("age").alias("ages"))


_TEXT = "lower(COALESCE(g.groups, '') || ' ' || COALESCE(c.occupation, ''))"
_MASK = "regexp_replace(t, 'vice admiral|rear admiral', '', 'g')"
_BIO = " + ".join(f"CASE WHEN COALESCE(trim({x}::VARCHAR), '') NOT IN ('', '0') THEN 1 ELSE 0 END" for x in ("c.origin", "c.status", "c.birth", "c.blood_type", "c.bounty", "c.age"))
_BIO += " + CASE WHEN dated.dd BETWEEN 1 AND dated.most THEN 1 ELSE 0 END"
_SIGNALS = f"""WITH seen AS ({story._SEEN}),
n AS (SELECT character, COUNT(*) AS n, COUNT(DISTINCT (chapter - 1) // {story.SAGA}) AS sagas FROM seen GROUP BY 1),
mains AS (SELECT character, COUNT(*) AS m FROM (SELECT character, (chapter - 1) // {story.ARC} AS a FROM seen GROUP BY 1, 2 HAVING COUNT(*) >= 0.5 * {story.ARC}) GROUP BY 1),
g AS (SELECT character_id, string_agg(group_name, ' ' ORDER BY group_name) AS groups FROM (SELECT DISTINCT character_id, group_name FROM character_affiliation) GROUP BY 1),
cover AS (SELECT character, COUNT(*) AS v FROM coc WHERE note = 'silhouette' GROUP BY 1),
top AS (SELECT (SELECT MAX(n) FROM n) AS n, (SELECT MAX((number - 1) // {story.SAGA}) + 1 FROM chapter) AS sagas, (SELECT MAX(m) FROM mains) AS m, (SELECT MAX(v) FROM cover JOIN characters ON id = character) AS v, (SELECT MAX(bounty) FROM characters) AS b),
x AS (SELECT c.id, n.n, n.sagas, mains.m, cover.v, c.bounty AS b, {_TEXT} AS t, ({_BIO}) AS filled FROM characters c LEFT JOIN n ON n.character = c.id LEFT JOIN mains ON mains.character = c.id LEFT JOIN g ON g.character_id = c.id LEFT JOIN cover ON cover.character = c.id LEFT JOIN {_BIRTHS} dated ON dated.id = c.id)
SELECT x.id, """ + ", ".join(f"CASE WHEN COALESCE(x.{c}, 0) > 0 AND COALESCE(top.{c}, 0) > 0 THEN ln(1 + x.{c}::DOUBLE) / ln(1 + top.{c}::DOUBLE) ELSE 0.0 END AS {s}" for c, s in (("n", "appearance"), ("m", "arc_main"), ("v", "cover"), ("b", "bounty"))) + f""",
least(1.0, COALESCE(x.sagas, 0)::DOUBLE / greatest(top.sagas, 1)) AS breadth, filled::DOUBLE / 7 AS bio,
CASE WHEN {_any(_MASK, scoring.AFFILIATION_TIERS[0][1])} THEN 1.0 {" ".join(f"WHEN {_any('t', w)} THEN {v}" for v, w in scoring.AFFILIATION_TIERS[1:])} ELSE 0.0 END::DOUBLE AS affiliation FROM x, top"""
_SCORE = f"SELECT id, ROUND({' + '.join(f'{scoring.WEIGHTS[s]} * {s}' for s in ('appearance', 'breadth', 'bounty', 'affiliation', 'cover', 'arc_main', 'bio'))}, 6) AS score FROM ({_SIGNALS})"


def scores(spark, d) -> DataFrame:
    """Importance of every person from the nine signals.

    The two signals that only wider tables have (a flag ``has_conqueror`` of the person, a power name in the raw records)
    are read if the columns are there, and are 0 else.  Appearances are aggregated once, by person and arc; arcs lie
    inside sagas.
    """
    chapters = table(spark, d, "coc").filter(F.trim("character") != "").groupBy("character", "chapter").agg(F.count(F.when(F.col("note") == "silhouette", 1)).alias("v"))
    arc = F.floor((F.col("chapter") - 1) / story.ARC).alias("arc")
    arcs = chapters.groupBy("character", arc).agg(F.count("chapter").alias("n"), F.sum("v").alias("v"))
    saga = F.when(F.col("n") > 0, F.floor(F.col("arc") * story.ARC / story.SAGA))
    per = arcs.groupBy("character").agg(F.sum("n").alias("n"), F.count_distinct(saga).alias("sagas"), F.count(F.when(F.col("n") >= 0.5 * story.ARC, 1)).alias("m"), F.sum("v").alias("v"))
    per = materialize(per, "appearances")
    groups = table(spark, d, "character_affiliation").select("character_id", "group_name").distinct()
    groups = groups.groupBy(F.col("character_id").alias("character")).agg(F.array_join(F.array_sort(F.collect_list("group_name")), " ").alias("groups"))
    people = table(spark, d, "characters").withColumnRenamed("id", "character")
    people = people.select("*", scalars.optional(people, "has_conqueror", "boolean", False).alias("_conqueror"))
    for part in (per, groups):
        people = people.join(part, "character", "left")
    detail = table(spark, d, "characters_detail")
    slots = [c for c in ("devil_fruit_name", "devil_fruit_name_2") if c in detail.columns]
    if slots:
        bears = detail.filter(~scalars.blank(F.concat_ws("", *slots))).select(F.col("id").alias("character")).distinct().withColumn("_power", F.lit(True))
        people = people.join(bears, "character", "left")
    n_sagas = table(spark, d, "chapter").agg((F.floor((F.max("number") - 1) / story.SAGA) + 1).alias("top_sagas"))
    listed = per.join(table(spark, d, "characters").select(F.col("id").alias("character")), "character", "left_semi")
    tops = per.agg(F.max("n").alias("top_n")).join(listed.agg(F.max("m").alias("top_m"), F.max("v").alias("top_v"))).join(table(spark, d, "characters").agg(F.max("bounty").alias("top_b")))
    x = people.join(F.broadcast(tops)).join(F.broadcast(n_sagas))
    text = F.concat_ws(" ", F.coalesce("groups", F.lit("")), F.coalesce("occupation", F.lit("")))
    filled = sum((F.when(~F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).isin("", "0"), 1).otherwise(0) for c in ("origin", "status", "birth", "blood_type", "bounty", "age")), F.lit(0))
    filled = filled + F.when(scalars.month_day(F.col("birth")).isNotNull(), 1).otherwise(0)
    yes = lambda c: F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0)
    signals = {
        "appearance": scoring.log_norm(F.col("n"), F.col("top_n")), "breadth": F.least(F.lit(1.0), F.coalesce("sagas", F.lit(0)) / F.greatest("top_sagas", F.lit(1))),
        "bounty": scoring.log_norm(F.col("bounty"), F.col("top_b")), "affiliation": scoring.affiliation_score(text), "cover": scoring.log_norm(F.col("v"), F.col("top_v")),
        "arc_main": scoring.log_norm(F.col("m"), F.col("top_m")), "conqueror": yes(F.col("_conqueror")), "power": yes(F.col("_power") if slots else F.lit(False)), "bio": filled / 7,
    }
    return x.select(F.col("character").alias("id"), F.round(scoring.weighted(signals, scoring.WEIGHTS), 6).alias("score"))


@query(_SCORE)
def importance_scores(spark, d):
    return scores(spark, d)


_CUT = ", ".join(f"list_sort(list(score))[CAST(round_even({p} * (COUNT(*) - 1), 0) AS BIGINT) + 1] AS c{t}" for t, p in scoring.CUTS)


@query(f"""WITH s AS ({_SCORE}), c AS (SELECT {_CUT} FROM s) SELECT id, score, CASE WHEN score >= cS THEN 'S' WHEN score >= cA THEN 'A' WHEN score >= cB THEN 'B' WHEN score >= cC THEN 'C' ELSE 'D' END AS tier FROM s, c""")
def importance_tiers(spark, d):
    s = materialize(scores(spark, d), "scores")  # read for the histogram and for the result
    return s.join(F.broadcast(scoring.cut_points(s, "score"))).select("id", "score", scoring.tier(F.col("score")).alias("tier"))


@query(f"""WITH s AS ({_SCORE}), c AS (SELECT {_CUT} FROM s) SELECT CASE WHEN score >= cS THEN 'S' WHEN score >= cA THEN 'A' WHEN score >= cB THEN 'B' WHEN score >= cC THEN 'C' ELSE 'D' END AS tier, COUNT(*)::BIGINT AS n FROM s, c GROUP BY 1""")
def tier_tally(spark, d):
    return importance_tiers(spark, d).groupBy("tier").agg(F.count("*").alias("n"))


@query(f"SELECT ROW_NUMBER() OVER (ORDER BY score DESC, id) AS rank, id, score FROM ({_SCORE}) ORDER BY score DESC, id LIMIT 100")
def importance_ranked(spark, d):
    from pyspark.sql import Window

    top = scores(spark, d).orderBy(F.desc("score"), "id").limit(100)
    return top.select(F.row_number().over(Window.orderBy(F.desc("score"), "id")).cast("long").alias("rank"), "id", "score")


def queries() -> dict:
    return Q


def oracle_sql() -> dict[str, str]:
    return SQL
