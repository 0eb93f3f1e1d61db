import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import grammars, scalars, wikitext


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text,want", [("July 22, 1997", datetime.date(1997, 7, 22)), ("July 2,1997", datetime.date(1997, 7, 2)), ("soon", None), (None, None)])
def test_long_date(spark, text, want):
    assert one(spark, scalars.long_date, text) == want


@pytest.mark.parametrize("text,want", [("March 9th", "03-09"), ("april 1st (a feast)", "04-01"), ("February 29th", "02-29"), ("February 30th", None), ("March 9", None), ("", None), (None, None)])
def test_month_day(spark, text, want):
    assert one(spark, scalars.month_day, text) == want


@pytest.mark.parametrize("text,want", [("19 (without cover)*", 19), ("1917 (Volume)", 19), ("about", None), (None, None)])
def test_page_count(spark, text, want):
    assert one(spark, scalars.page_count, text) == want


@pytest.mark.parametrize("text,want", [("¥1,500,000;20", 1500000), ("Unknown\n30,000", 30000), ("At least\n[\n7\n]\n★ 50", 50), ("bounty 3;, ;8", 8), ("0;7", 7), ("99999999999", None), (None, None)])
def test_first_money(spark, text, want):
    assert one(spark, scalars.first_money, text) == want


@pytest.mark.parametrize("text,want", [("17 (debut)\n19 (now)", 19), ("20–30", 30), ("Over 100", 100), ("At least 40", 40), ("Over many\n12", None), ("about 12\n9", 9), ("31-", None), ("biologically 28)", 28), ("[5]\n4", 4), ("none", None), (None, None)])
def test_highest_age(spark, text, want):
    assert one(spark, scalars.highest_age, text) == want


@pytest.mark.parametrize("text,want", [("X", ("X", "X")), ("X\nF", ("X, F", "mixed")), ("S (RH-)\n[\n12\n]", ("S (RH-)", "S")), ("\n", (None, None)), (None, (None, None))])
def test_blood(spark, text, want):
    assert (one(spark, scalars.blood_types, text), one(spark, scalars.blood_group, text)) == want


@pytest.mark.parametrize("text,want", [(" East Blue (Town)", "East Blue"), ("Grand Line (Skypiea)", "Sky Island"), ("Grand Line (Wano Country)", "New World"), ("Jaya", "Grand Line"), ("Somewhere", "Unknown Region"), (" ", None), (None, None)])
def test_region(spark, text, want):
    assert one(spark, scalars.region, text) == want


@pytest.mark.parametrize("text,want", [("Chapters: 7 (1-7)", (1, 7)), ("Chapters: 9 (12-)", (12, 50)), ("chapters: 1 (4)", (4, 4)), ("(3-9)", (3, 9)), ("none", (None, None))])
def test_chapter_range(spark, text, want):
    assert (one(spark, lambda c: scalars.chapter_range(c, 50)[0], text), one(spark, lambda c: scalars.chapter_range(c, 50)[1], text)) == want


def test_sentences_and_sizes(spark):
    assert one(spark, scalars.first_sentences, "One. [3] Two!  Three?") == "One. Two!"
    assert one(spark, scalars.first_sentences, "  ") is None
    assert one(spark, lambda c: scalars.file_size(c.cast("double")), "1536") == "1.5 KB"
    assert one(spark, scalars.slug, "The  Long-Ring, Island") == "the_long_ring_island"


def test_wikitext():
    raw = "Lead {{a|{{b}}}}[[Link|text]].<ref>x</ref>\n== One ==\nA '''bold''' word\n=== One ===\n{| t |}end [[Category:X]]\n== Empty ==\n"
    assert wikitext.sections(raw) == [("intro", "Lead text."), ("One", "A bold word"), ("One_2", "end")]
    assert wikitext.clean("{{open text") == "{{open text"
    assert wikitext.template_parameters("Box|a = 1|b={{x|y}}|plain") == {"a": "1", "b": "{{x|y}}", "1": "plain"}
    assert wikitext.sanitize("Gāzā\u0007") == "Gaza"
    assert wikitext.info_box('<aside><div data-source="age"><h3>Age</h3><div>17<br/>19 [1]</div></div></aside>') == {"age": "17\n19"}


@pytest.mark.parametrize(
    "text,want",
    [("Navy", ("Navy", None, "current")), ("Navy (East; former)", ("Navy", "East", "former")), ("Crew (East (West, secret))", ("Crew", "East, West", "secret")), ("A (B) (formerly)", ("A", "B", "former")), ("A（B、retired）?", ("A", "B", "retired")), ("(odd)", ("(odd)", None, "current"))],
)
def test_affiliation(text, want):
    assert grammars.affiliation(text) == want


def test_power():
    assert grammars.power("Zo no Mi, Model: Ox [2]") == ("Zo no Mi", "Ox", False)
    assert grammars.power("Zo no Mi (Artificial)") == ("Zo no Mi", None, True)


def test_power_slots():
    assert grammars.powers([("Go no Mi(Hi no Mi, Model: Ni) [2]", "Paramecia(Mythical Zoan)", "Gum(Human)"), (" ", None, None)]) == [("Hi no Mi", "Ni", "Gum(Human)", "Zoan", "Mythical", False)]
    assert grammars.powers([("Zo no Mi (Artificial)", "Artificial Zoan", None)]) == [("Zo no Mi", None, None, "Zoan", None, True)]
    assert grammars.identity("A(b)") == "A(b)"


def test_likely_person(spark):
    df = spark.createDataFrame([("Red Pirates", None, None), ("Red Pirates", 3, None), ("Ann", None, None), (None, None, None), ("Island Ann", None, "March 1st")], "n string, a int, b string")
    assert [r[0] for r in df.select(scalars.likely_person(F.col("n"), F.col("a"), F.col("b"))).collect()] == [False, True, True, True, True]


def test_outcome_and_birthday(spark):
    df = spark.createDataFrame([("x", None), (None, None), (" ", "http://wiki/Video_Games"), (None, "http://else/x"), (None, "http://wiki/x")], "n string, u string")
    assert [r[0] for r in df.select(scalars.scrape_outcome([F.col("n")], F.col("u"), "wiki")).collect()] == ["success", "failed_no_url", "failed_video_game", "failed_external_url", "failed_unknown"]
    assert str(one(spark, scalars.plain_month_day, "February 29")) == "2000-02-29" and one(spark, scalars.plain_month_day, "May 40") is None


def test_ratio():
    from tidemark.operators.merging import ratio

    assert ratio("a", "a") == 1.0 and ratio(None, "a") == 0.0 and ratio(None, None) == 1.0 and ratio("aaaa", "aaaabbbbb") == 0.0
    assert ratio("x" * 99 + "y", "x" * 99 + "z") == 0.99 and ratio("abcd", "wxyz") == 0.0
