"""Core queries without SQL, recomputed plainly over the smallest tables."""

import difflib
import json
import os
import re
import unicodedata
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

from tidemark.plans import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
# Fixtures of their own: occupation_split in test_readings.py.
HERE = {"affiliation_split", "occupation_split", "key_names", "chunk_pages", "wiki_sections", "source_change_similar", "entity_link", "p2_found", "p2_values", "p4_found"}


def read(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


def run(spark, name):
    return [r.asDict() for r in catalog.queries()[name](spark, DATA).collect()]


def test_every_query_without_sql_is_tested():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == HERE


def sections(raw):
    try:
        got = json.loads(raw)
    except (TypeError, ValueError):
        return []
    if not isinstance(got, dict):
        return []
    if isinstance(got.get("sections"), list):
        got = {"intro": got.get("intro")} | {s.get("title") or s.get("name") or "(untitled)": s.get("text") or s.get("content") for s in got["sections"]}
    return [(k or "(untitled)", v) for k, v in got.items() if isinstance(v, str) and v.strip()]


def test_key_names(spark):
    want = {r["id"]: None if r["name"] is None else "".join(c for c in unicodedata.normalize("NFKD", r["name"]) if not unicodedata.combining(c) and not unicodedata.category(c).startswith("C")) for r in read("characters")}
    assert {r["id"]: r["key"] for r in run(spark, "key_names")} == want


def test_entity_link(spark):
    names = {(r["id"], n.strip().lower()) for r in read("graph_nodes") for n in [r["canonical_name"], *(r["aliases"] or [])] if n and len(n.strip()) >= 2}
    docs = [(r["doc_id"], r["text"].lower()) for r in read("documents") if r["text"]]
    want = {(d, i) for i, n in names for d, t in docs if n in t and re.search(rf"(?<!\w){re.escape(n)}(?!\w)", t)}
    got = [(r["doc_id"], r["id"]) for r in run(spark, "entity_link")]
    assert set(got) == want and len(got) == len(want) > 0


def test_chunk_pages(spark):
    want = []
    for r in read("wiki_text"):
        name, held = None, ""
        folded = []
        for title, text in sections(r["sections"]):
            name, held = name or title, "\n".join(x for x in (held, text.strip()) if x)
            if len(held) >= 50:
                folded.append((name, held))
                name, held = None, ""
        for title, text in folded + ([(name, held)] if held else []):
            starts = [0]
            while starts[-1] + 3200 < len(text):
                starts.append(starts[-1] + 2800)
            want += [(r["page_id"], title, text[a : a + 3200]) for a in starts]
    assert sorted((str(r["page_id"]), r["section_name"], r["chunk_text"]) for r in run(spark, "chunk_pages")) == sorted((str(p), t, c) for p, t, c in want)


def test_wiki_sections(spark):
    pages = defaultdict(list)
    for r in run(spark, "wiki_sections"):
        pages[r["page_id"], r["scraped_at"]].append(r)
    for r in read("wiki_text"):
        mine = pages.get((r["page_id"], r["scraped_at"]), [])
        heads = re.findall(r"^={2,3}\s*(.+?)\s*={2,3}\s*$", r["full_text"] or "", re.M)
        assert {re.sub(r"_\d+$", "", x["name"]) for x in mine} <= {"intro", *heads} | {re.sub(r"_\d+$", "", h) for h in heads}
        if not heads and (r["full_text"] or "").strip():
            assert [x["name"] for x in mine][:1] == ["intro"]
        assert all(x["text"].strip() and "==" not in x["text"].split("\n")[0][:2] for x in mine)


def test_source_change_similar(spark):
    def near(a, b):
        a_, b_ = (re.sub(r"\s+", " ", re.sub(r"\[\d+\]", "", x)).strip().lower() for x in (a, b))
        if a_ == b_:
            return True
        return min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.95

    scrapes = defaultdict(list)
    for r in read("wiki_text"):
        if r["sections"] is not None:
            scrapes[r["page_id"]].append((r["scraped_at"], r["sections"]))
    want = []
    for page, rows in scrapes.items():
        if page is None or len({t for t, _ in rows}) < len(rows):
            continue  # scrapes of one moment may come in any order
        open_ = {}
        for at, raw in sorted(rows):
            found = sections(raw)
            kept = {k: v for k, v in found if len(v) >= 50}
            want += [(page, at, k, "untouched") for k in open_ if found and k not in kept]
            for k, v in kept.items():
                change = "inserted" if k not in open_ else "touched" if near(open_[k], v) else "superseded"
                open_[k] = open_[k] if change == "touched" else v
                want.append((page, at, k, change))
    got = [(r["page_id"], r["scraped_at"], r["section"], r["change"]) for r in run(spark, "source_change_similar")]
    pages = {p for p, *_ in want}
    assert sorted(x for x in got if x[0] in pages) == sorted(want) and want


def test_packed_values(spark):
    """Fields without quotation marks, parentheses and numbers are cut at every delimiter, but for known whole values."""
    fields = {("affiliation", r["rec_id"]): r["affiliation"] for r in read("characters_detail")} | {("occupation", r["rec_id"]): r["occupation"] for r in read("characters_detail")} | {("group_name", r["aff_id"]): r["group_name"] for r in read("character_affiliation")}
    got = defaultdict(list)
    for r in run(spark, "p2_values"):
        got[r["field"], r["rec_id"]].append((r["pos"], r["item"], r["n_items"]))
    quoted = {m for t in fields.values() if t for m in re.findall(r'["“]([^"“”]{3,})["”]', t)}
    plain = 0
    for key, text in fields.items():
        mine = sorted(got.get(key, []))
        assert [p for p, _, _ in mine] == list(range(1, len(mine) + 1)) and all(n == len(mine) and i == i.strip() != "" for _, i, n in mine)
        if text and not re.search(r'["“(（\d]', text) and not any(q.split(",")[0].split(";")[0].strip() in text for q in quoted):
            want = [x.strip() for x in re.split(r"[;,|•、；\n\r，｜]|(?<=\s)[/／]|[/／](?=\s)|(?<=^)[/／]", text) if x.strip()]
            plain += 1
            assert [i for _, i, _ in mine] == want
    assert plain > 10
    found = {(r["field"], r["rec_id"], r["pos"], r["item"]) for r in run(spark, "p2_found")}
    assert found == {(*k, p, i) for k, rows in got.items() for p, i, n in rows if n >= 2}


def test_affiliation_split(spark):
    values = {(r["rec_id"], r["pos"]): r["item"] for r in run(spark, "p2_values") if r["field"] == "affiliation"}
    got = {(r["rec_id"], r["pos"]): r for r in run(spark, "affiliation_split")}
    assert set(got) == set(values)
    for key, item in values.items():
        if not re.search(r"[()（）?≠]", item):
            assert (got[key]["group"], got[key]["sub_group"], got[key]["status"]) == (item, None, "current")


def test_plain_amounts(spark):
    """Fields of one amount in metric units or marked berries, without marks in the number."""
    got = defaultdict(list)
    for r in run(spark, "p4_found"):
        got[r["field"], r["rec_id"]].append(r["base_value"])
    factor, n = {"mm": 1, "cm": 10, "m": 1000}, 0
    for r in read("characters_detail"):
        if m := re.fullmatch(r"\s*(\d+) ?(mm|cm|m)\s*", r["height"] or ""):
            n += 1
            assert got["height", r["rec_id"]] == [int(m.group(1)) * factor[m.group(2)]]
        if m := re.fullmatch(r"\s*¥(\d+)\s*", r["bounty"] or ""):
            assert got["bounty", r["rec_id"]] == [int(m.group(1))]
        if not re.search(r"\d|[０-９]", r["height"] or ""):
            assert ("height", r["rec_id"]) not in got
    assert n > 0


LONG = ["(" * 100_000, "“;" * 50_000, " " * 100_000, "(a)" * 33_000, "k" * 100_000, "1 " + "word " * 20_000, "b" * 100_000 + " x 5", "[[" * 50_000, "<ref>" * 20_000, "; (" * 33_000, " [1" * 33_000, "{{" * 50_000]


@pytest.mark.parametrize("text", LONG, ids=[t[:4].strip() or "blank" for t in LONG])
def test_very_long_texts_take_linear_time(text):
    import time

    from tidemark.functions import grammars, wikitext
    from tidemark.operators import packed_values, units

    factors = [{"unit": "metre", "quantity": q, "symbol": "m", "factor_num": 1, "factor_den": 1} for q in ("height", "bounty")]
    began = time.process_time()
    packed_values.cover(text, [])
    packed_values.quoted_values(text)
    for q in ("height", "bounty"):
        units.amounts(text, units.Units(q, factors), None)
    grammars.affiliation(text)
    grammars.occupations(text)
    wikitext.clean(text)
    assert time.process_time() - began < 20
