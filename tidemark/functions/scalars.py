"""Column expressions that read one field: dates, pages, ages, money, blood types, regions, identifiers.

Every function takes a Column and returns a Column; null in gives null out unless said otherwise, and text that cannot be
read gives null, never an error (ANSI casts are tried).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keywords of the regions, in the order in which they are tried.
RED_LINE = ("red line", "mary geoise", "marijoa")
UNDERWATER = ("ryugu kingdom", "fish-man island", "fishman island")
SKY = ("skypiea", "birka", "sky island", "sky islands")
SEAS = ("east blue", "north blue", "west blue", "south blue")
NEW_WORLD = (
    "new world", "wano country", "totto land", "whole cake island", "dressrosa", "punk hazard", "onigashima", "egghead", "mokomo dukedom", "elbaph", "green bit", "waford", "sphinx",
)
#: Most days of each month, and the bounds of a credible reward.
MONTH_DAYS = dict(zip("january february march april may june july august september october november december".split(), (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)))
MOST_MONEY = 10_000_000_000
#: Statuses that only things have, not persons.
THING_STATUSES = ("Active", "Destroyed")


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Null, not '', without a match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == ""


def long_date(text: Column) -> Column:
    """'July 22, 1997' (the blank after the comma may be missing)."""
    text = F.regexp_replace(text, r",\s*", ", ")
    return F.to_date(F.try_to_timestamp(text, F.lit("MMMM d, yyyy")))


def page_count(text: Column) -> Column:
    """Leading number of a page field; a volume form that begins with 1917 states 19 pages."""
    t = F.trim(text)
    return F.when(t.contains("Volume") & t.startswith("1917"), 19).otherwise(first_group(t, r"^(\d+)").try_cast("int"))


def month_day(text: Column) -> Column:
    """'March 9th' as '03-09'; a remark in parentheses may follow; impossible days give null."""
    pattern = r"(?i)^([a-z]+)\s+(\d{1,2})(?:st|nd|rd|th)(?:\s*\([^)]*\))?$"
    t = F.trim(text)
    month, day = F.lower(F.regexp_extract(t, pattern, 1)), F.regexp_extract(t, pattern, 2).try_cast("int")
    got = F.lit(None).cast("string")
    for k, (name, most) in enumerate(MONTH_DAYS.items(), 1):
        got = F.when((month == name) & day.between(1, most), F.concat(F.lit(f"{k:02d}-"), F.lpad(day.cast("string"), 2, "0"))).otherwise(got)
    return got


#: Parts of a reward field that are no amount, and a reward that is stated wrongly everywhere.
NO_MONEY = ("At least", "Unknown", "Over", "★", "(", ")")
MONEY_OVERRIDES = {"Buggy": 3189000000}


def money_text(text: Column) -> Column:
    """The field as one line: lines joined by ';' without blank ones, brackets and bare reference numbers."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda v: F.trim(v)), lambda p: ~p.isin("", "[", "]") & ~p.rlike(r"^\d+$"))
    return F.nullif(F.when(text.contains("\n"), F.array_join(lines, ";")).otherwise(F.trim(text)), F.lit(""))


def first_money(text: Column, identifier: Column | None = None) -> Column:
    """First credible number of a list of amounts (lines or ';'), digit groups joined; words that are no amount are
    passed over."""
    parts = F.transform(F.split(money_text(text), ";"), lambda p: F.trim(F.regexp_replace(p, "¥", "")))
    parts = F.filter(parts, lambda p: ~p.isin(*NO_MONEY) & ~p.startswith("bounty") & (F.regexp_replace(p, "[★ ]", "") != ""))
    numbers = F.transform(parts, lambda p: F.regexp_replace(F.regexp_extract(p, r"[\d,]+", 0), ",", "").try_cast("bigint"))
    got = F.get(F.filter(numbers, lambda n: n.isNotNull() & (n > 0) & (n <= MOST_MONEY)), F.lit(0))
    for name, amount in MONEY_OVERRIDES.items() if identifier is not None else ():
        got = F.when((identifier == name) & (F.coalesce(text, F.lit("")) != ""), F.lit(amount).cast("bigint")).otherwise(got)
    return got


#: Words before an age.
AGE_WORDS = ("Over", "Under", "Roughly", "Bas:", "And:", "Kerville:")


def highest_age(text: Column) -> Column:
    """Highest age over all lines; after some words the next word counts, of a range the end.

    A line that begins like such a form but has no number makes the whole field unreadable (null); other lines without a
    leading number are passed over.
    """
    lines = F.filter(F.transform(F.split(text, "\n"), lambda v: F.trim(v)), lambda p: (p != "") & ~p.startswith("["))

    def whole(word: Column) -> Column:
        return F.when(word.rlike(r"^[+-]?\d+$"), word.try_cast("int"))

    def read(line: Column) -> Column:
        w = F.split(line, " ")
        word = lambda k: F.get(w, F.lit(k))
        marked = word(0).isin(*AGE_WORDS) | ((word(0) == "At") & (word(1).isNull() | (word(1) == "least"))) | word(0).rlike("[–-]|biologically")
        value = (
            F.when(word(0).isin(*AGE_WORDS), whole(word(1))).when((word(0) == "At") & (word(1) == "least"), whole(word(2)))
            .when(word(0).contains("–"), whole(F.get(F.split(word(0), "–"), F.lit(1)))).when(word(0).contains("-"), whole(F.get(F.split(word(0), "-"), F.lit(1))))
            .when(word(0).contains("biologically"), whole(F.get(F.split(word(1), r"\)"), F.lit(0)))).otherwise(whole(word(0)))
        )
        return F.struct(value.alias("v"), (F.coalesce(marked, F.lit(False)) & value.isNull()).alias("bad"))

    ages = F.transform(lines, read)
    return F.when(~F.exists(ages, lambda a: a["bad"]), F.array_max(F.filter(F.transform(ages, lambda a: a["v"]), lambda v: v.isNotNull())))


def _blood_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), lambda v: F.trim(v)), lambda p: ~p.isin("", "[", "]") & ~p.rlike(r"^\d+$"))


def blood_types(text: Column) -> Column:
    """The types of a field joined by ', '; lines that are blank, numbers or brackets do not count."""
    lines = _blood_lines(text)
    return F.when(F.size(lines) > 0, F.array_join(lines, ", "))


def blood_group(text: Column) -> Column:
    """First word of the single type of a field, 'mixed' for several."""
    lines = _blood_lines(text)
    return F.when(F.size(lines) > 1, "mixed").otherwise(F.get(F.split(F.get(lines, F.lit(0)), " "), F.lit(0)))


def region(origin: Column) -> Column:
    """Broad region of an origin text; keywords are tried in a fixed order, blank text has no region."""
    o = F.lower(F.trim(origin))
    ladder = F.when(blank(origin), None).when(any_of(o, RED_LINE), "Red Line").when(any_of(o, UNDERWATER), "Underwater").when(any_of(o, SKY), "Sky Island")
    for sea in SEAS:
        ladder = ladder.when(o.startswith(sea), sea.title())
    ladder = ladder.when(any_of(o, NEW_WORLD), "New World").when(o.startswith("calm belt"), "Calm Belt")
    return ladder.when(o.startswith("grand line") | (o == "jaya"), "Grand Line").otherwise("Unknown Region")


def to_id(name: Column) -> Column:
    return F.replace(F.trim(name), F.lit(" "), F.lit("_"))


def to_name(identifier: Column) -> Column:
    return F.replace(identifier, F.lit("_"), F.lit(" "))


def slug(title: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(title, r"[^a-zA-Z0-9]+", "_"), r"^_+|_+$", ""))


def normalized(text: Column) -> Column:
    """Reference marks removed, white space collapsed, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(text, r"\[\d+\]", ""), r"\s+", " ")))


def text_hash(text: Column) -> Column:
    return F.sha2(normalized(text), 256)


def chapter_range(text: Column, last: int | None = None) -> tuple[Column, Column]:
    """(start, end) of 'Chapters: 7 (1-7)', '(1-7)' or '(7)'; an open range ends at ``last``."""
    full = r"(?i)chapters:\s*\d+\s*\((\d+)(?:(-)(\d*))?\)"
    start = F.coalesce(first_group(text, full, 1), first_group(text, r"\((\d+)-\d+\)"), first_group(text, r"\((\d+)\)")).try_cast("int")
    open_ = F.regexp_extract(text, full, 2) == "-"
    end = F.coalesce(first_group(text, full, 3), F.when(open_, F.lit(last).cast("string")), F.when(~open_, first_group(text, r"\(\d+-(\d+)\)")), F.when(~open_, first_group(text, r"\((\d+)\)"))).try_cast("int")
    return start, end


def file_size(size: Column) -> Column:
    """'1.5 KB'; units step by 1,024."""
    got = F.concat(F.format_string("%.1f", size / F.lit(1024.0**4)), F.lit(" TB"))
    for k, unit in reversed(list(enumerate(("B", "KB", "MB", "GB")))):
        got = F.when(size < 1024.0 ** (k + 1), F.concat(F.format_string("%.1f", size / F.lit(1024.0**k)), F.lit(f" {unit}"))).otherwise(got)
    return got


def one_or_list(values: Column) -> Column:
    """An empty list is null, a list of one its element, others are joined."""
    return F.when(F.size(values) > 0, F.array_join(values, "; "))


#: Characters of the scripts that a lead gives names in besides the Latin one.
_WIDE = r"\x{3000}-\x{9FFF}\x{FF00}-\x{FFEF}・"


def first_sentences(text: Column, n: int = 2) -> Column:
    """The first ``n`` sentences of a lead, null for blank text and for a dump of an information box.

    Reference marks, readings in parentheses and characters of wide scripts go, white space is collapsed, also before
    marks of punctuation; an initial ("D.") ends no sentence.
    """
    clean = F.regexp_replace(text, r"\[\s*\d+\s*\]", "")
    clean = F.regexp_replace(clean, rf"\(\s*[{_WIDE}][^)]*\)", "")
    clean = F.trim(F.regexp_replace(F.regexp_replace(clean, rf"[{_WIDE}]+", ""), r"\s+", " "))
    clean = F.regexp_replace(clean, r"\s+([,.;:!?])", "$1")
    clean = F.regexp_replace(F.regexp_replace(clean, r"\s+(['\x{2019}])(\w)", "$1$2"), r"\s+-(\w)", "-$1")
    parts = F.split(F.regexp_replace(clean, r"\b([A-Z])\.\s+([A-Z])", "$1\x01 $2"), r"(?<=[.!?])\s+")
    got = F.regexp_replace(F.trim(F.array_join(F.slice(parts, 1, n), " ")), "\x01", ".")
    dump = text.rlike(r"Statistics\s+Japanese Name:|Romanized Name:")
    return F.when(~blank(clean) & ~dump, got)


#: Words in names of groups and places.
GROUP_WORDS = r"\b(?:pirates?|marines?|animals?|country|village|town|island|bounty hunters?|crew|kingdom|army)\b"


def likely_person(name: Column, age: Column, birth: Column) -> Column:
    """False for a name with a word of groups or places and neither age nor birthday."""
    return ~(F.coalesce(F.lower(name).rlike(GROUP_WORDS), F.lit(False)) & blank(age.cast("string")) & blank(birth))


def scrape_outcome(stated: list[Column], url: Column, host: str) -> Column:
    """'success' if any of the fields is stated, else why a record is empty, read off its address."""
    some = reduce(lambda a, b: a | b, [~blank(c.cast("string")) for c in stated])
    empty = F.when(blank(url), "failed_no_url").when(url.contains("Video_Games"), "failed_video_game").when(~url.contains(host), "failed_external_url")
    return F.when(some, "success").otherwise(empty.otherwise("failed_unknown"))


def plain_month_day(text: Column) -> Column:
    """'March 9' as a date of the year 2000."""
    return F.to_date(F.try_to_timestamp(F.concat(F.trim(text), F.lit(" 2000")), F.lit("MMMM d yyyy")))


def title_number(title: Column, word: str) -> Column:
    """The number after ``word`` in a page title ("Chapter 12"), case aside."""
    return first_group(title, rf"(?i){word}\s+(\d+)").try_cast("int")


def valid_chapter(number: Column, most: int = 2000) -> Column:
    return F.coalesce(number.between(1, most), F.lit(False))


def valid_url(text: Column) -> Column:
    """An address with a scheme and a host."""
    return F.coalesce(text.rlike(r"^(?i)(?:https?|ftp)://[^\s/?#.]+[^\s/?#]*(?:[/?#]\S*)?$"), F.lit(False))


def first_of(values: Column) -> Column:
    """The first element of a list that is neither null nor blank."""
    return F.get(F.filter(values, lambda v: ~blank(v)), F.lit(0))


def name_of(name: Column, other: Column, identifier: Column) -> Column:
    """The name, else the other name, else the id, else an empty text."""
    stated = lambda c: F.when(~blank(c), c)
    return F.coalesce(stated(name), stated(other), stated(identifier), F.lit(""))


def plain_cell(text: Column) -> Column:
    """A table cell without footnotes [..], notes (..) and markup of links and emphasis."""
    cell = F.regexp_replace(F.regexp_replace(text, r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1"), r"'{2,}", "")
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(cell, r"\[[^\]]*\]", ""), r"\([^()]*\)", ""), r"\s+", " "))


def cell_values(text: Column) -> Column:
    """The values of a cell, which are parted by ';', line breaks (also <br>) or list items."""
    parts = F.split(text, r"(?i);|\n|<br\s*/?>|</?li>")
    return F.filter(F.transform(parts, plain_cell), lambda p: p != "")


def optional(df, name: str, kind: str = "string", otherwise=None) -> Column:
    """The column ``name`` of ``df`` if it has one, else ``otherwise`` as ``kind``."""
    return F.col(name) if name in df.columns else F.lit(otherwise).cast(kind)
