"""Wiki markup and stored HTML: cleaning, sections, template parameters, info boxes.

Templates and tables nest, which regular expressions cannot follow, so these run as Arrow UDFs over batches.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HEAD = re.compile(r"^={2,3}\s*(.+?)\s*={2,3}\s*$", re.M)


def drop_nested(text: str, opening: str, closing: str) -> str:
    """``text`` without what stands between balanced marks; an unbalanced mark stays."""
    out, starts, k = [], [], 0
    while k < len(text):
        if text.startswith(opening, k):
            starts.append(len(out))
            out.append(opening)
            k += len(opening)
        elif starts and text.startswith(closing, k):
            del out[starts.pop() :]
            k += len(closing)
        else:
            out.append(text[k])
            k += 1
    return "".join(out)


def _sub(pattern: str, by, text: str, closing: str, flags: int = 0) -> str:
    """``re.sub`` up to the last ``closing`` mark, which every match ends with; nothing is looked for behind it."""
    k = text.rfind(closing) + len(closing) if closing in text else 0
    return re.sub(pattern, by, text[:k], flags=flags) + text[k:]


def clean(text: str) -> str:
    text = _sub(r"<!--.*?-->", "", text, "-->", re.S)
    text = drop_nested(drop_nested(text, "{{", "}}"), "{|", "|}")
    text = _sub(r"<ref[^>]*>.*?</ref>", "", _sub(r"<ref[^>/]*/>", "", text, "/>"), "</ref>", re.S)
    text = _sub(r"\[\[(?:Category|File|Image):[^\[\]]*(?:\[\[[^\]]*\]\][^\[\]]*)*\]\]", "", text, "]]")
    text = _sub(r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", r"\1", text, "]]")
    text = _sub(r"\[https?://\S+\s+([^\]]*)\]|\[https?://\S+\]", lambda m: m.group(1) or "", text, "]")
    text = html.unescape(_sub(r"<[^>]+>", "", re.sub(r"'{2,}", "", text), ">"))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text)).strip()


def sections(text: str) -> list[tuple[str, str]]:
    """(name, text) in order; the lead is 'intro'; a repeated name gets _2, _3, ..."""
    heads = list(_HEAD.finditer(text))
    cuts = [("intro", 0, heads[0].start() if heads else len(text))]
    cuts += [(m.group(1), m.end(), n.start() if n else len(text)) for m, n in zip(heads, [*heads[1:], None])]
    seen: dict[str, int] = {}
    out = []
    for name, a, b in cuts:
        seen[name] = seen.get(name, 0) + 1
        out.append((name if seen[name] == 1 else f"{name}_{seen[name]}", clean(text[a:b])))
    return [s for s in out if s[1]]


def template_parameters(text: str) -> dict[str, str]:
    """Parameters of a template's inside, cut at '|' outside braces and brackets; unnamed ones are numbered."""
    parts, depth, start, k = [], 0, 0, 0
    while k < len(text):
        two = text[k : k + 2]
        if two in ("{{", "[["):
            depth, k = depth + 1, k + 2
            continue
        if two in ("}}", "]]"):
            depth, k = max(0, depth - 1), k + 2
            continue
        if text[k] == "|" and not depth:
            parts.append(text[start:k])
            start = k + 1
        k += 1
    parts.append(text[start:])
    out, n = {}, 0
    for p in parts[1:]:
        key, eq, value = p.partition("=")
        if not eq:
            n += 1
            key, value = str(n), p
        out[key.strip()] = value.strip()
    return out


def find_template(text: str, name: str) -> dict[str, str] | None:
    """Parameters of the first template whose name begins with ``name``, case aside; None if there is none or it never
    closes."""
    start = re.search(r"\{\{\s*" + re.escape(name), text, re.I)
    if not start:
        return None
    depth, k = 0, start.start()
    while k < len(text):
        if text.startswith("{{", k):
            depth, k = depth + 1, k + 2
        elif text.startswith("}}", k):
            depth, k = depth - 1, k + 2
            if not depth:
                return template_parameters(text[start.start() + 2 : k - 2])
        else:
            k += 1
    return None


#: Fields of a chapter template by the names it gives them.
CHAPTER_BOX = {"title": "title", "ename": "english_title", "jname": "japanese_title", "vol": "vol", "chapter": "chapter", "page": "page", "date2": "date2", "jump": "jump"}


def chapter_box(text: str) -> dict[str, str] | None:
    """Cleaned fields of a chapter page's template."""
    got = find_template(text, "Chapter Box")
    return None if got is None else {name: clean(got[key]) for key, name in CHAPTER_BOX.items() if key in got}


def cast_table(text: str) -> list[tuple[str, str, str]]:
    """(name, address, note) of the links in tables of class CharTable; a note is the next parenthesis within the
    hundred characters after its link."""
    out = []
    for table in re.findall(r'\{\|\s*class="CharTable"(.*?)\|\}', text, re.S | re.I):
        for m in re.finditer(r"\[\[([^\]|]+)(?:\|([^\]]+))?\]\]", table):
            note = re.search(r"\(([^)]+)\)", table[m.end() : m.end() + 100])
            out.append(((m.group(2) or m.group(1)).strip(), "/wiki/" + m.group(1).replace(" ", "_"), note.group(1).strip() if note else ""))
    return out


def info_box(page: str) -> dict[str, str]:
    """``data-source`` fields of an info box; values of several lines keep the lines, reference marks go."""
    out = {}
    for m in re.finditer(r'data-source="([^"]+)"[^>]*>(.*?)(?=data-source="|</aside>|\Z)', page, re.S):
        body = re.sub(r"<h3[^>]*>.*?</h3>", "", m.group(2), flags=re.S)
        body = re.sub(r"<[^>]*\Z", "", body)  # the tag in which the next field is named
        body = html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"<br\s*/?>|</li>", "\n", body)))
        lines = [" ".join(x.split()) for x in re.sub(r"\[\s*\d+\s*\]", "", body).split("\n")]
        value = "\n".join(x for x in lines if x)
        if value:
            out.setdefault(m.group(1), value)
    return out


def sanitize(name: str) -> str:
    """Compatibility form without combining marks and control characters."""
    return "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c) and unicodedata.category(c)[0] != "C")


def _mapped(f, kind):
    @F.pandas_udf(kind)
    def udf(column: pd.Series) -> pd.Series:
        return column.map(lambda v: None if v is None else f(v))

    return udf


clean_udf = _mapped(clean, T.StringType())
sanitize_udf = _mapped(sanitize, T.StringType())
sections_udf = _mapped(lambda t: [{"pos": k, "name": n, "text": x} for k, (n, x) in enumerate(sections(t), 1)], T.ArrayType(T.StructType().add("pos", "integer").add("name", "string").add("text", "string")))
parameters_udf = _mapped(template_parameters, T.MapType(T.StringType(), T.StringType()))
info_box_udf = _mapped(info_box, T.MapType(T.StringType(), T.StringType()))


chapter_box_udf = _mapped(chapter_box, T.MapType(T.StringType(), T.StringType()))
cast_table_udf = _mapped(lambda t: [dict(zip(("name", "url", "note"), c)) for c in cast_table(t)], T.ArrayType(T.StructType().add("name", "string").add("url", "string").add("note", "string")))
