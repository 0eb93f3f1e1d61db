import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import chunks, merging, network, packed_values, ranges, scoring, search, units

FACTORS = [
    ("millimetre", "height", "millimetre", "mm", 1, 1), ("centimetre", "height", "millimetre", "cm", 10, 1), ("metre", "height", "millimetre", "m", 1000, 1), ("inch", "height", "millimetre", "in", 254, 10),
    ("foot", "height", "millimetre", "ft", 3048, 10), ("fathom", "height", "millimetre", "fath", 18288, 10), ("hand", "height", "millimetre", "hh", 1016, 10), ("berry", "bounty", "berry", "¥", 1, 1),
    ("thousand berry", "bounty", "berry", None, 1000, 1), ("tidecrown", "bounty", "berry", "Tc", 2500, 1), ("shell", "bounty", "berry", "Sh", 40, 1),
]
ROWS = [dict(zip(("unit", "quantity", "base_unit", "symbol", "factor_num", "factor_den"), f)) for f in FACTORS]


@pytest.mark.parametrize(
    "text,want",
    [
        ("Navy", ["Navy"]), ("A ; B, C\nD", ["A", "B", "C", "D"]), ('"Nets, Hooks and Sails Guild", B', ["Nets, Hooks and Sails Guild", "B"]), ("League of 1,000 Wakes, B", ["League of 1,000 Wakes", "B"]),
        ('"The ""Unsunk"" Society (former)"[3]; B (x, y)', ['The "Unsunk" Society (former)', "B (x, y)"]), ("A; ;B;", ["A", "B"]), ("and/or / B", ["and/or", "B"]), ('odd " quote, B', ['odd " quote', "B"]),
        ("open (paren, B", ["open (paren", "B"]), ("", []), (" , ; ", []), ("A（B、C）、D", ["A（B、C）", "D"]),
    ],
)
def test_cover(text, want):
    assert packed_values.cover(text, []) == want


def test_dictionary_protects_delimiters(spark):
    rows = [("f", 1, 'X, "Tide; Tally Company"'), ("f", 2, "Tide; Tally Company (old); B"), ("f", 3, "Tide; Tally Companyx"), ("f", 4, None), ("f", 5, ""), ("f", 2, "Tide; Tally Company (old); B")]
    df = spark.createDataFrame(rows, "field string, rec_id long, text string").withColumn("item", F.lit(1)).withColumn("pos", F.lit("x"))
    got = sorted(tuple(r) for r in packed_values.unpack(df).collect())
    # The dictionary parted over tasks, as one that outgrows the bound is.
    assert got == sorted(tuple(r) for r in packed_values.unpack(df, most=0, shard=1).collect())
    assert got == sorted([("f", 1, 1, "X", 2), ("f", 1, 2, "Tide; Tally Company", 2), *[("f", 2, 1, "Tide; Tally Company (old)", 2), ("f", 2, 2, "B", 2)] * 2, ("f", 3, 1, "Tide", 2), ("f", 3, 2, "Tally Companyx", 2)])
    assert packed_values.unpack(df.limit(0)).count() == 0 and packed_values.unpack(df.limit(0), most=0).count() == 0


def test_parted_dictionary_equals_one_automaton(spark):
    words = [f"Rope{k}, Sail and Tar {j}" for k in range(6) for j in range(4)] + ["Rope1; Nets, Hooks", "Tar / Pitch; Co", "Rope1"]
    rows = [("f", k, "; ".join(words[(k * i) % len(words)] for i in range(1, 4)) + (" (former), B" if k % 3 else "[2] / C")) for k in range(200)]
    df = spark.createDataFrame(rows, "field string, rec_id long, text string")
    known = spark.createDataFrame([(w,) for w in words] + [(None,), (" ",)], "value string")
    one = sorted(tuple(r) for r in packed_values.unpack(df, known).collect())
    assert one == sorted(tuple(r) for r in packed_values.unpack(df, known, most=3, shard=5).collect())
    assert ("f", 1, 1, "Rope0, Sail and Tar 1") in {r[:4] for r in one}


@pytest.mark.parametrize(
    "text,default,want",
    [
        ("138 cm", None, [1380]), ("2 m 50 cm", None, [2500]), ("7' 10'' (debut)\n39 centimetres", None, [2388, 390]), ("37m07", None, [37070]), ("2,21 m", None, [2210]), ("1,245 mm", None, [1245]), ("４０ CM [3]", None, [400]),
        ("1 metres and 31 centimetres", None, [1310]), ("taller than a mast", None, []), ("about 6.7", "foot", [2042]), ("6.7", None, []), ("12 buckets", "foot", []), (None, None, []), ("", None, []), ("1.2 fath.", None, [2195]), ("5′8″", None, [1727]),
    ],
)
def test_heights(text, default, want):
    u = units.Units("height", ROWS)
    assert units.amounts(text, u, default and (u.factor[default], default)) == want


@pytest.mark.parametrize(
    "text,default,want",
    [
        ("¥1,52 bn", None, [1520000000]), ("143.75M Sh", None, [5750000000]), ("3億8900万 berries", None, [389000000]), ("Tc 21,240", None, [53100000]), ("28.2 million B", None, [28200000]), ("8.190.000.000 B (former)", None, [8190000000]),
        ("87 300 000 berries", None, [87300000]), ("50200 thousand", None, [50200000]), ("7,350 ; ? ; 50", "thousand berry", [7350000, 50000]), ("★ 16.52 million shells", None, [660800000]), ("1050万ベリー", None, [10500000]), ("94,500k berries", None, [94500000]),
    ],
)
def test_bounties(text, default, want):
    u = units.Units("bounty", ROWS)
    assert units.amounts(text, u, default and (u.factor[default], default)) == want


def test_half_is_rounded_up():
    assert units.amounts("0.05 cm", units.Units("height", ROWS), None) == [1]


def test_exponents_and_the_dimension_of_the_field():
    length, area, volume = units.Units("height", ROWS), units.Units("height", ROWS, exponent=2), units.Units("height", ROWS, exponent=3)
    assert length.decompose("m²") is length.decompose("square metre") is length.decompose("cm^3") is None
    assert area.decompose("cm²") == (100, "centimetre") and area.decompose("sq m") == area.decompose("square metres") == area.decompose("m^2") == (10**6, "metre")
    assert area.decompose("km2")[0] == area.decompose("square kilometre")[0] == 10**12 and volume.decompose("cubic millimetre")[0] == 1
    assert volume.decompose("dm³") == (100**3, "metre") and area.decompose("metre") is None
    assert units.amounts("3 m² ; 170 cm ; 2 m³", length, None) == [1700]


def test_units_frame(spark):
    factors = spark.createDataFrame(FACTORS, "unit string, quantity string, base_unit string, symbol string, factor_num long, factor_den long")
    sources = spark.createDataFrame([("s", "height", "foot")], "source string, quantity string, default_unit string")
    df = spark.createDataFrame([("height", 1, "5 cm", "s"), ("height", 1, "5 cm", "s"), ("height", 2, "2", "s"), ("height", 3, "2", None), ("weight", 4, "5 kg", "s"), ("height", 5, None, "s")], "field string, rec_id long, text string, source string").withColumn("pos", F.lit(9))
    assert sorted(tuple(r) for r in units.to_base(df, factors, sources).collect()) == [("height", 1, 1, 50), ("height", 1, 1, 50), ("height", 2, 1, 610)]
    assert units.to_base(df.limit(0), factors, sources).count() == 0


def test_range_joins(spark):
    r = random.Random(1)
    points = [(r.randrange(200),) for _ in range(60)] + [(None,)]
    spans = [(k, a, a + r.randrange(60)) for k, a in enumerate(r.randrange(200) for _ in range(40))] + [(99, 9, 5), (98, None, 3)]
    p, s = spark.createDataFrame(points, "x int"), spark.createDataFrame(spans, "k int, a int, b int")
    got = sorted((q["x"], q["k"]) for q in ranges.point_in_interval(p, "x", s, "a", "b", 7).collect())
    fine = [(k, a, b) for k, a, b in spans if a is not None and a <= b]
    assert got == sorted((x, k) for (x,) in points if x is not None for k, a, b in fine if a <= x <= b)
    s2 = s.toDF("k2", "a2", "b2")
    got = sorted((q["k"], q["k2"]) for q in ranges.overlapping(s, "a", "b", s2, "a2", "b2", 7).collect())
    assert got == sorted((k, j) for k, a, b in fine for j, c, d in fine if a <= d and c <= b)


def test_aliases_and_upserts(spark):
    assert merging.resolve_aliases({"a": "b", "b": "c", "x": "y", "y": "x"}) == {"a": "c", "b": "c", "y": "x"}
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, merging.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, merging.insert_absent(old, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "d")]


def test_versions_have_one_open_row_per_key(spark):
    none = spark.createDataFrame([], "k int, text string, hash string, first_seen timestamp, last_seen timestamp, superseded_at timestamp")
    versions = none
    for rows in ([(1, "a", "ha"), (2, "b", "hb")], [(1, "a", "ha"), (2, "c", "hc"), (3, "d", "hd")], []):
        new = spark.createDataFrame(rows, "k int, text string, hash string")
        open_ = versions.filter("superseded_at is null")
        changes = merging.classify_changes(open_, new, ["k"], "text", "hash")
        versions = merging.apply_changes(open_, changes, ["k"], F.current_timestamp()).unionByName(versions.filter("superseded_at is not null"))
    got = [(r["k"], r["text"]) for r in versions.filter("superseded_at is null").collect()]
    assert sorted(got) == [(1, "a"), (2, "c"), (3, "d")] and versions.count() == 4


def test_network(spark):
    m = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "a"), (2, "b"), (2, "c"), (None, "a"), (3, None)], "g int, v string")
    assert sorted(map(tuple, network.pair_edges(m, "g", "v").collect())) == [("a", "b", 2), ("a", "c", 1), ("b", "c", 1)]
    assert dict((r["source"] + r["target"], r["weight"]) for r in network.pair_edges(m, "g", "v", distinct=False).collect())["ab"] == 3
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"), ("d", "e")], "source string, target string")
    assert sorted(map(tuple, network.within_hops(e, spark.createDataFrame([("a",)], "node string"), 2).collect())) == [("a", 0), ("b", 1), ("c", 2), ("d", 1), ("e", 2)]


def test_cut_points_are_nearest_rank(spark):
    for n in (1, 2, 7, 101):
        values = [random.Random(n).randrange(50) / 10 for _ in range(n)]
        got = scoring.cut_points(spark.createDataFrame([(v,) for v in values], "s double"), "s").first()
        assert [got[t] for t, _ in scoring.CUTS] == [sorted(values)[round(p * (n - 1))] for _, p in scoring.CUTS]


def test_weights():
    scoring.check_weights(dict(scoring.WEIGHTS))
    with pytest.raises(ValueError):
        scoring.check_weights(dict(scoring.WEIGHTS, bio=0.5))
    with pytest.raises(ValueError):
        scoring.check_weights(dict(scoring.WEIGHTS), 0)


def test_search(spark):
    assert search.parse_query('red or blue "two words" -oil boat') == {"must": [["red", "blue"], ["boat"]], "not": ["oil"], "phrases": ["two words"]}
    d = spark.createDataFrame([(1, "red boat boat"), (2, "Blue boat"), (3, "red boat oil"), (4, None), (5, "boat")], "i int, t string")
    assert [(r["i"], r["score"]) for r in search.full_text(d, "i", "t", "red or blue boat -oil").collect()] == [(1, 3), (2, 2)]
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 1.0]), (5, [1.0])], "i int, v array<float>")
    assert [r["i"] for r in search.nearest(v, "i", "v", [1.0, 0.0]).collect()] == [1, 4]


def test_chunks(spark):
    assert chunks.fold_sections([("a", "x" * 20), ("b", ""), ("c", "y" * 40), ("d", "z" * 60), ("e", "w")]) == [("a", "x" * 20 + "\n" + "y" * 40), ("d", "z" * 60), ("e", "w")]
    d = spark.createDataFrame([(1, "a" * 6001), (2, ""), (3, None), (4, "b")], "i int, t string")
    assert sorted((r["i"], r["part"], len(r["chunk"])) for r in chunks.fixed_windows(d, "i", "t").collect()) == [(1, 0, 3200), (1, 1, 3200), (1, 2, 401), (4, 0, 1)]
    names = spark.createDataFrame([(1, "Ann Lee"), (2, "Lee"), (3, None), (4, "x")], "id int, name string")
    texts = spark.createDataFrame([(7, "ann lee met LEE."), (8, "Leeward"), (9, None)], "doc_id long, text string")
    assert sorted(map(tuple, chunks.link_names(texts, names, most=1).collect())) == [(7, 1), (7, 2)]
