"""Quantities recorded in different units: every stated amount in base units.

A unit string ("million B", "cm", "mil. berries", "K Sh", "sq m") is segmented by dynamic programming over tries of
scales and metric prefixes, unit roots, plurals and exponents.  A decomposition is a path power? prefix* root? plural?
exponent? that covers the string; ambiguous ones ("M" is metre or million, "m" metre or milli, "B" berry or billion) are
scored with the prior of each morpheme in the field's dimension, and the likeliest wins.  An exponent raises the unit
with its prefix, and counts against the dimension of the field: a height in square metres is no height.

Defined results: null or blank fields, and fields without a number outside remarks, give no amount; equal rows give equal
amounts again; a number followed by an unknown unit is no amount; amounts without unit in a record whose source has no
default are left out; conversions are exact fractions, halves are rounded up.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How records write scales, metric prefixes, units (besides names and symbols of the table) and endings.
SCALES = {
    "thousand": 10**3, "k": 10**3, "K": 10**3, "million": 10**6, "mil": 10**6, "mill": 10**6, "mio": 10**6, "M": 10**6, "m": 10**6,
    "billion": 10**9, "bn": 10**9, "bil": 10**9, "b": 10**9, "trillion": 10**12, "tn": 10**12, "千": 10**3, "万": 10**4, "億": 10**8, "兆": 10**12,
}
PREFIXES = {"milli": Fraction(1, 1000), "centi": Fraction(1, 100), "deci": Fraction(1, 10), "kilo": Fraction(1000), "m": Fraction(1, 1000), "c": Fraction(1, 100), "d": Fraction(1, 10), "k": Fraction(1000)}
WRITINGS = {
    "meter": "metre", "M": "metre", "millimeter": "millimetre", "centimeter": "centimetre", "kilometer": "kilometre", "CM": "centimetre", "MM": "millimetre", "KM": "kilometre",
    "inches": "inch", '"': "inch", "″": "inch", "''": "inch", "′′": "inch", "”": "inch", "feet": "foot", "'": "foot", "′": "foot", "’": "foot",
    "B": "berry", "berries": "berry", "belly": "berry", "bellies": "berry", "ベリー": "berry", "￥": "berry", "センチ": "centimetre", "メートル": "metre",
}
PLURALS = ("s", "es")
EXPONENTS = {"²": 2, "³": 3, "^2": 2, "^3": 3, "**2": 2, "**3": 3, "2": 2, "3": 3}
POWERS = {"square": 2, "sq": 2, "cubic": 3, "cu": 3}
#: Log-priors by field. What is not listed has 0; a scale cannot stand in a height.
PRIORS = {
    "height": {("scale", "*"): -20.0, ("root", "M"): -0.5, ("prefix", "m"): -0.5, ("prefix", "c"): -0.2},
    "bounty": {("scale", "b"): -3.0, ("scale", "m"): -1.0, ("prefix", "*"): -20.0, ("root", "M"): -20.0},
}
#: A metric root that is written with a prefix of its own is a length in one piece: fewer morphemes are likelier.
PER_MORPHEME = -1.0
#: What a unit of another dimension than the field's costs, and the score that a decomposition must exceed.
OTHER_DIMENSION, LEAST_SCORE = -20.0, -15.0


#: Most letters and words of a unit string; what is longer is none.
LONGEST, MOST_WORDS = 64, 8


class Trie:
    def __init__(self, words) -> None:
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def matches(self, text: str, at: int) -> Iterator[str]:
        node = self.root
        while True:
            if "" in node:
                yield node[""]
            if at >= len(text) or text[at] not in node:
                return
            node = node[text[at]]
            at += 1


class Units:
    """Decomposes unit strings of one quantity."""

    def __init__(self, quantity: str, factors: list[dict], exponent: int = 1) -> None:
        """``exponent``: the dimension of the field, 1 for lengths and money, 2 for an area stated in units of length."""
        own = [f for f in factors if f["quantity"] == quantity and f["factor_den"]]
        self.quantity, self.exponent = quantity, exponent
        self.factor = {f["unit"]: Fraction(f["factor_num"], f["factor_den"]) for f in own}
        roots = {f["unit"]: f["unit"] for f in own if " " not in f["unit"]} | {f["symbol"]: f["unit"] for f in own if f["symbol"]}
        roots |= {w: u for w, u in WRITINGS.items() if u in self.factor}
        self.roots = roots | {w.capitalize(): u for w, u in roots.items() if len(w) > 2 and w.isascii()}
        self.scales = SCALES if quantity == "bounty" else {}
        self.prefixes = PREFIXES if "metre" in self.factor else {}
        scales = self.scales | {w.capitalize(): v for w, v in self.scales.items() if len(w) > 2}
        self.tries = {"root": Trie(self.roots), "scale": Trie(scales), "prefix": Trie(self.prefixes), "plural": Trie(PLURALS), "exponent": Trie(EXPONENTS), "power": Trie(POWERS)}
        self.seen: dict[str, tuple[Fraction, str | None] | None] = {}

    def _prior(self, kind: str, word: str) -> float:
        p = PRIORS.get(self.quantity, {})
        return p.get((kind, word), p.get((kind, "*"), 0.0)) + PER_MORPHEME

    def decompose(self, text: str) -> tuple[Fraction, str | None] | None:
        """(factor, unit or None if only a scale) of the likeliest decomposition, or None."""
        text = re.sub(r"[\s.]+", "", text)
        if len(text) > LONGEST:
            return None
        if text not in self.seen:
            self.seen[text] = self._search(text) or self._search(text.lower())
        return self.seen[text]

    def _search(self, text: str) -> tuple[Fraction, str | None] | None:
        # Stages at a position: 0 start or scales, 1 a power word, 2 a metric prefix, 3 the root, 4 a plural, 5 an exponent.
        # The exponent is part of the state, as are the scale (never raised) and the unit with its prefix (raised at the end).
        best: dict[tuple[int, int, int], tuple[float, Fraction, Fraction, str | None]] = {(0, 0, 1): (0.0, Fraction(1), Fraction(1), None)}
        for at in range(len(text)):
            for (_, stage, power), (score, scale, factor, unit) in [x for x in best.items() if x[0][0] == at]:
                steps = []
                if stage == 0:
                    steps += [("scale", w, 0, 1, scale * self.scales.get(w, self.scales.get(w.lower(), 1)), factor, unit) for w in self.tries["scale"].matches(text, at)]
                    steps += [("power", w, 1, POWERS[w], scale, factor, unit) for w in self.tries["power"].matches(text, at)]
                if stage < 2:
                    steps += [("prefix", w, 2, power, scale, self.prefixes[w], unit) for w in self.tries["prefix"].matches(text, at)]
                if stage < 3:
                    roots = [(w, self.roots[w]) for w in self.tries["root"].matches(text, at)]
                    steps += [("root", w, 3, power, scale, factor * self.factor[u], u) for w, u in roots if stage < 2 or u == "metre"]
                if stage == 3:
                    steps += [("plural", w, 4, power, scale, factor, unit) for w in self.tries["plural"].matches(text, at)]
                if stage in (3, 4) and power == 1:
                    steps += [("exponent", w, 5, EXPONENTS[w], scale, factor, unit) for w in self.tries["exponent"].matches(text, at)]
                for kind, w, to, raised, by, f, u in steps:
                    got = (score + self._prior(kind, w), by, f, u)
                    key = (at + len(w), to, raised)
                    if key not in best or got[0] > best[key][0]:
                        best[key] = got
        ends = []
        for (at, stage, power), (score, scale, factor, unit) in best.items():
            if at == len(text) and stage in (0, 3, 4, 5):
                fits = unit is None or power == self.exponent
                ends.append((score + (0.0 if fits else OTHER_DIMENSION), scale * factor**power, unit))
        if not text or not ends:
            return None
        top = max(ends, key=lambda e: e[0])
        return (top[1], top[2]) if top[0] > LEAST_SCORE else None


_REMARKS = re.compile(r"[(（][^()（）]*[)）]|\[[^\]]*\]")
_NUMBER = re.compile(r"\d{1,3}(?:[ \u00a0\u2009\u202f]\d{3})+(?!\d)|\d+(?:[.,]\d+)*")


def number(text: str, quantity: str, scaled: bool) -> Fraction:
    """The value of a written number; marks are read as digit groups where they can only be that."""
    text = re.sub(r"\s", "", text)
    marks = re.findall(r"[.,]", text)
    groups = re.split(r"[.,]", text)
    if not marks:
        return Fraction(text)
    threes = all(len(g) == 3 for g in groups[1:]) and 1 <= len(groups[0]) <= 3 and groups[0] != "0"
    if len(set(marks)) == 2:  # the last mark is the decimal one
        return Fraction("".join(groups[:-1]) + "." + groups[-1])
    if len(marks) > 1:
        return Fraction("".join(groups)) if threes else Fraction("".join(groups[:-1]) + "." + groups[-1])
    if threes and (marks[0] == "," or quantity == "bounty" and not scaled):
        return Fraction("".join(groups))
    return Fraction(groups[0] + "." + groups[1])


def amounts(text: str | None, units: Units, default: tuple[Fraction, str | None] | None) -> list[int]:
    """Base values of the amounts stated in ``text``, in order."""
    out = []
    if not text:
        return out
    for part in re.split(r"[;；\n\r]+", text):
        # No remark ends after the last closing mark, so nothing is looked for there.
        closed = max(map(part.rfind, ")）]")) + 1
        part = _REMARKS.sub(" ", part[:closed]) + part[closed:]
        # Prime marks and raised digits are kept from the compatibility form, which writes them as others.
        part = "".join(c if c in "\u2032\u2033²³" else unicodedata.normalize("NFKC", c) for c in part)
        numbers = list(_NUMBER.finditer(part))
        if not numbers:
            continue
        lead = re.match(r"\s*([^\s\d]+)", part[: numbers[0].start()][::-1])
        before = units.decompose(lead.group(1)[::-1].lstrip("~★")) if lead and units.quantity == "bounty" else None
        if before and before[1] is None:
            before = None
        total, last, good = Fraction(0), None, True
        for k, m in enumerate(numbers):
            gap = part[m.end() : numbers[k + 1].start() if k + 1 < len(numbers) else len(part)]
            words = re.sub(r"\band\b|[,&+]|~", " ", gap).split()
            unit, used = None, min(len(words), MOST_WORDS)
            while used and unit is None:
                unit = units.decompose("".join(words[:used]))
                used -= unit is None
            if words and unit is None:
                good = False
                break
            factor, name = unit or (Fraction(1), None)
            value = number(m.group(), units.quantity, unit is not None and (name is None or factor != units.factor[name]))
            if name is None and before:
                factor, name = factor * before[0], before[1]
            elif name is None and last and not unit:
                # 5'9 and 1m75: the second number counts the next smaller unit
                factor = {"foot": units.factor.get("inch"), "metre": units.factor.get("centimetre")}.get(last, None)
                if factor is None:
                    good = False
                    break
            elif name is None and unit is None:
                if default is None:
                    good = False
                    break
                factor, name = default
            total += value * factor
            last = name or last
        if good:
            out.append(math.floor(total + Fraction(1, 2)))
    return out


def to_base(fields: DataFrame, unit_factors: DataFrame, source_units: DataFrame) -> DataFrame:
    """``field, rec_id, pos, base_value`` for ``fields(field, rec_id, text, source)``.

    Both tables are configuration (one row per unit, one per source and quantity); rows of ``fields`` never leave their
    task.
    """
    factors = [r.asDict() for r in unit_factors.collect()]
    defaults = [r.asDict() for r in source_units.collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: dict[str, Units] = {}
        base: dict[tuple[str, str], tuple[Fraction, str]] = {}
        for quantity in {f["quantity"] for f in factors}:
            units[quantity] = Units(quantity, factors)
            for d in defaults:
                if d["quantity"] == quantity and d["default_unit"] in units[quantity].factor:
                    base[d["source"], quantity] = (units[quantity].factor[d["default_unit"]], d["default_unit"])
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for field, rec, text, source in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if field not in units:
                    continue
                for pos, value in enumerate(amounts(text, units[field], base.get((source, field))), 1):
                    for o, v in zip(out, (field, rec, pos, value)):
                        o.append(v)
            types = (pa.string(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], ["field", "rec_id", "pos", "base_value"])

    fields = fields.select("field", F.col("rec_id").cast("long"), "text", "source").filter(F.col("text").rlike("[0-9０-９]"))
    return fields.mapInArrow(run, "field string, rec_id long, pos int, base_value long")


def quantity_fields(detail: DataFrame) -> DataFrame:
    part = lambda c: detail.select(F.lit(c).alias("field"), "rec_id", F.col(c).alias("text"), "source")
    return part("height").unionByName(part("bounty"))
