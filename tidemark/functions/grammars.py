"""Small grammars over one entry: affiliation with sub-group and status, occupation with status, power names."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that state the relation to a group, and their rank when several are stated.
STATUSES = (
    "defected", "former", "disbanded", "dissolved", "revoked", "resigned", "temporary", "secret", "double agent", "undercover", "ruse", "espionage",
    "semi-retired", "retired", "post mortem", "descended", "illegitimate", "filler", "movie", "anime only", "non-canon", "unknown status",
)
SAME = {"formerly": "former", "temporarily": "temporary"}
_RANK = {s: k for k, s in enumerate(STATUSES)}


def _tail(entry: str) -> tuple[str, str] | None:
    """(rest, inside) of a parenthesis that ends the entry."""
    entry = entry.rstrip()
    if not entry.endswith((")", "）")):
        return None
    depth = 0
    for k in range(len(entry) - 1, -1, -1):
        depth += (entry[k] in ")）") - (entry[k] in "(（")
        if not depth:
            return entry[:k].rstrip(), entry[k + 1 : -1].strip()
    return None


def affiliation(entry: str) -> tuple[str, str | None, str]:
    """(group, sub-group, status); remarks are read from the right, nested ones inside out."""
    entry = entry.strip().rstrip("?≠").strip()
    subs, found = [], []
    while (cut := _tail(entry)) and cut[0]:
        entry, inside = cut
        plain = []
        for w in re.split(r"[,;/、（(]", inside):
            w = w.strip().rstrip(")）").strip()
            key = SAME.get(w.lower(), w.lower())
            if key in _RANK:
                found.append(key)
            elif w and key != "current":
                plain.append(w)
        subs = plain + subs
    return entry, ", ".join(subs) or None, min(found, key=_RANK.get) if found else "current"


#: Words that state the standing of an occupation, in their rank when several are stated.
ROLE_STATUSES = (
    "defected", "former", "resigned", "retired", "disbanded", "dissolved", "revoked", "post mortem", "acting", "promoted", "temporary", "secret", "double agent", "undercover", "clandestine",
    "ruse", "espionage", "semi-retired", "descended", "illegitimate", "unknown status", "filler", "movie", "anime only", "non-canon",
)
#: Occupation fields whose source lost the delimiters, by id.
ROLE_OVERRIDES = {
    "Z": "Neo Marines Supreme Commander ; Marine Instructor (former) ; Marine Admiral (former)",
    "Camie": "Fashion designing apprentice ; Takoyaki seller ; Waitress at Mermaid Cafe",
    "Rebecca": "Lady-in-waiting ; Gladiator (former) ; Princess Of Dressrosa (former)",
    "Gild_Tesoro": "Proprietor (former) ; Pirate (former) ; Slave (former)",
    "Vito": "Pirate ; Advisor",
}
#: What marks a parenthesis as a translation.
FOOTNOTES = ("viz:", "english versions:", "english version:", "4kids:")
_RANK_OF_ROLE = {s: k for k, s in enumerate(ROLE_STATUSES)}
_WIDE = re.compile("[\u3000-\u9fff\uff00-\uffef]")


def _groups(text: str) -> list[tuple[int, int]]:
    """Spans of the outermost parentheses; one that never closes reaches to the end."""
    out, depth, start = [], 0, 0
    for k, c in enumerate(text):
        if c == "(":
            start = start if depth else k
            depth += 1
        elif c == ")" and depth:
            depth -= 1
            if not depth:
                out.append((start, k + 1))
    return out + [(start, len(text))] if depth else out


def _outside(text: str, mark: str) -> list[str]:
    """Pieces between ``mark`` outside parentheses, blank ones left out."""
    held = set().union(*(range(a, b) for a, b in _groups(text)))
    cuts = [k for k, c in enumerate(text) if c == mark and k not in held]
    return [p for a, b in zip([-1, *cuts], [*cuts, len(text)]) if (p := text[a + 1 : b].strip())]


def _without_readings(text: str) -> str:
    """The text without parentheses that hold a reading in a wide script or a translator's remark."""
    at, kept = 0, []
    for a, b in _groups(text):
        inside = text[a:b].lower()
        kept.append(text[at:a] if _WIDE.search(inside) or any(f in inside for f in FOOTNOTES) else text[at:b])
        at = b
    return re.sub(r"\s{2,}", " ", "".join([*kept, text[at:]])).strip()


def _role(entry: str) -> tuple[str, str] | None:
    """(role, status): parentheses at the end are peeled off, of the known words in them the first by rank counts."""
    found, end = [], len(entry.rstrip(" \t\n?≠"))
    for a, b in reversed(_groups(entry[:end])):
        if b != end or entry[b - 1] != ")":
            break
        words = [w.strip().lower() for w in entry[a + 1 : b - 1].split(",")]
        found += [k for w in words if (k := SAME.get(w, w)) in _RANK_OF_ROLE]
        while a and (entry[a - 1].isspace() or entry[a - 1] in "?≠"):
            a -= 1
        end = a
    entry = entry[:end].strip()
    return (entry, min(found, key=_RANK_OF_ROLE.get) if found else "current") if entry else None


def _ends_in_parenthesis(part: str) -> bool:
    """Whether the part ends with a parenthesis that holds something and no other one's end."""
    part = part.rstrip()
    at = part.find("(", part.rfind(")", 0, -1) + 1) if part.endswith(")") else -1
    return 0 <= at < len(part) - 2


def occupations(raw: str | None, identifier: str | None = None) -> list[tuple[str, str]]:
    """(role, status) of every role of an occupation field, in order.

    Roles are parted by ';', or by commas outside parentheses if there is no ';'.  An entry like "a (status), b (status)"
    holds several roles.  A null or blank field has none.
    """
    raw = _without_readings(ROLE_OVERRIDES.get(identifier or "", raw or ""))
    entries = [p for p in map(str.strip, raw.split(";")) if p] if ";" in raw else _outside(raw, ",")
    out = []
    for entry in entries:
        parts = _outside(entry, ",") if "(" in entry else [entry]
        stated = sum(map(_ends_in_parenthesis, parts))
        for part in parts if len(parts) > 1 and stated >= len(parts) - 1 else [entry]:
            if got := _role(part):
                out.append(got)
    return out


def power(name: str) -> tuple[str, str | None, bool]:
    """(name, model, made by hand) of a power's name."""
    name = re.sub(r"\[\d+\]", "", name).strip()
    made = bool(re.search(r"\(\s*Artifici?al\s*\)|^Artificial\b|SMILE", name))
    name = re.sub(r"\s*\(\s*Artifici?al\s*\)|^Artificial\s+", "", name).strip()
    base, _, model = name.partition(", Model:")
    return base.strip(), model.strip() or None, made


#: Type names that mark a second identity, and the words that refine a type.
TYPES = ("Paramecia", "Zoan", "Logia", "Mythical Zoan", "Ancient Zoan", "Special Paramecia")
REFINED = ("Mythical", "Ancient", "Special")


def identity(text: str) -> str:
    """Of ``cover(true)`` the true name, if the inside is a power's name or a type; else the text."""
    cut = _tail(text)
    return cut[1] if cut and cut[0] and ("no Mi" in cut[1] or cut[1] in TYPES) else text


def power_entry(name: str | None, kind: str | None, english: str | None) -> tuple | None:
    """(name, model, English name, type, refinement, made by hand) of one slot; None without a name."""
    if not (name or "").strip():
        return None
    shown, hidden, made_name = power(name)
    whole = f"{shown}, Model: {hidden}" if hidden and "(" not in shown else re.sub(r"\[\d+\]|\s*\(\s*Artifici?al\s*\)", "", name).strip()
    base, model, _ = power(identity(whole))
    kind, _, made_kind = power(kind or "")
    kind = identity(kind)
    refined = next((r for r in REFINED if kind.startswith(r + " ")), None)
    return base, model, identity(re.sub(r"\[\d+\]", "", english or "").strip()) or None, kind.removeprefix(f"{refined} ") or None, refined, made_name or made_kind


def powers(slots: list[tuple]) -> list[tuple]:
    """Entries of up to two slots (name, type, English name) of a record."""
    return [e for s in slots if (e := power_entry(*s))]


@F.pandas_udf(T.StructType().add("group", "string").add("sub_group", "string").add("status", "string"))
def affiliation_udf(entry: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([affiliation(e or "") for e in entry], columns=["group", "sub_group", "status"])


@F.pandas_udf(T.StructType().add("base", "string").add("model", "string").add("made", "boolean"))
def power_udf(name: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([power(e or "") for e in name], columns=["base", "model", "made"])


@F.pandas_udf(T.ArrayType(T.StructType().add("role", "string").add("status", "string")))
def occupations_udf(raw: pd.Series, identifier: pd.Series) -> pd.Series:
    return pd.Series([[{"role": r, "status": s} for r, s in occupations(t, i)] for t, i in zip(raw, identifier)])


_POWER = T.StructType().add("name", "string").add("model", "string").add("english", "string").add("kind", "string").add("refined", "string").add("made", "boolean")


@F.pandas_udf(T.ArrayType(_POWER))
def powers_udf(name: pd.Series, kind: pd.Series, english: pd.Series, name2: pd.Series, kind2: pd.Series, english2: pd.Series) -> pd.Series:
    """Powers of two slots of a record."""
    slots = zip(name, kind, english, name2, kind2, english2)
    return pd.Series([[dict(zip(_POWER.names, e)) for e in powers([s[:3], s[3:]])] for s in slots])
