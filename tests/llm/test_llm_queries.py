"""Every query of the subpackage on the smallest tables: against SQL, or recomputed plainly where SQL cannot say it."""

import json
import os
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import queries, tokens

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
COLUMNS = {"p1_found": ["rec_a", "rec_b"], "p3_found": ["char_a", "char_b"], "p5_found": ["field", "item_id", "section"], "p6_found": ["chunk_a", "chunk_b"], "p9_found": ["doc_a", "doc_b"]}


def read(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


def run(spark, name):
    return [r.asDict() for r in queries.queries()[name](spark, DATA).collect()]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        if f.endswith(".parquet"):
            con.sql(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    got = queries.queries()[name](spark, DATA)
    assert got.columns == COLUMNS.get(name, got.columns)
    rows, want = got.toPandas(), con.sql(queries.oracle_sql()[name]).df()
    key = sorted(rows.columns)
    assert sorted(map(tuple, rows[key].round(6).astype(str).values)) == sorted(map(tuple, want[key].round(6).astype(str).values))


def test_every_query_is_tested_here():
    assert set(queries.queries()) - set(queries.oracle_sql()) == {"p1_found", "p1_entities", "p5_pieces", "p6_knn", "p7_packs", "p7_fill", "p8_mix", "p8_mix_balanced", "p8_shares", "p8_shares_balanced", "p9_spans", "p9_shared", "p9_classes"}


def test_p1(spark):
    named = {f"node:{r['id']}": r["canonical_name"] for r in read("graph_nodes")} | {f"char:{r['id']}": r["name"] for r in read("characters")}
    entity = {r["rec"]: r["entity"] for r in run(spark, "p1_entities")}
    assert set(entity) == set(named)
    groups = defaultdict(list)
    for rec, e in entity.items():
        groups[e].append(rec)
    want = {tuple(sorted(p)) for g in groups.values() for p in combinations(g, 2) if named[p[0]] and named[p[1]] and named[p[0]] != named[p[1]]}
    found = [(r["rec_a"], r["rec_b"]) for r in run(spark, "p1_found")]
    assert set(found) == want and len(found) == len(want) > 0
    # Equal names are one entity.
    same = defaultdict(set)
    for rec, name in named.items():
        same[name].add(entity[rec])
    assert all(len(e) == 1 for name, e in same.items() if name and name.strip())


def test_p5_pieces_put_the_texts_together(spark):
    texts = defaultdict(set)
    for r in read("wiki_text"):
        if r["full_text"] is not None:
            texts["full_text", r["page_id"], ""].add(r["full_text"])
        try:
            sections = json.loads(r["sections"])
        except (TypeError, ValueError):
            continue
        for k, v in sections.items() if isinstance(sections, dict) else ():
            if isinstance(v, str):
                texts["sections", r["page_id"], k].add(v)
    for r in read("wiki_chunks"):
        if r["chunk_text"] is not None:
            texts["chunk_text", r["chunk_id"], ""].add(r["chunk_text"])
    pieces = defaultdict(list)
    for r in run(spark, "p5_pieces"):
        assert len(r["text"]) == r["end"] - r["start"] <= 3200
        pieces[r["field"], r["item_id"], r["section"]].append(r)
    assert set(pieces) == set(texts)
    for key, rows in pieces.items():
        for text in texts[key]:
            mine = {r["piece"]: r for r in rows if r["n_chars"] == len(text) and text[r["start"] : r["end"]] == r["text"]}
            n = next(iter(mine.values()))["pieces"]
            assert sorted(mine) == list(range(1, n + 1)) and mine[1]["start"] == 0 and mine[n]["end"] == len(text)
            assert all(0 <= mine[k]["end"] - mine[k + 1]["start"] <= 400 and mine[k]["start"] < mine[k + 1]["start"] for k in range(1, n))


def test_p6_knn_against_all_pairs(spark):
    rows = [(r["chunk_id"], np.array(r["embedding"], dtype=np.float64)) for r in read("wiki_chunks") if r["embedding"] is not None and len(r["embedding"]) == 384 and any(r["embedding"])]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    k = min(5, len(rows) - 1)
    at = {i: n for n, (i, _) in enumerate(rows)}
    got = defaultdict(list)
    for r in run(spark, "p6_knn"):
        got[r["chunk_id"]].append(r)
    assert set(got) == set(at) and all(sorted(r["rank"] for r in g) == list(range(1, k + 1)) for g in got.values())
    fifth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
    hits = sum(s[at[i], at[r["neighbour"]]] >= fifth[at[i]] - 1e-5 for i, g in got.items() for r in g)
    assert hits / (k * len(rows)) >= 0.95


def sizes(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return {r["doc_id"]: (r["source"], r["tokens"]) for r in tokens.sized(docs, keep=("source",)).collect()}


def test_p7_packs_hold_every_token_once(spark):
    have = sizes(spark)
    caps = {r["pack_name"]: r["capacity_tokens"] for r in read("pack_limits")}
    load, parts = defaultdict(int), defaultdict(list)
    for r in run(spark, "p7_packs"):
        load[r["pack_name"], r["container"]] += r["tokens"]
        parts[r["pack_name"], r["doc_id"]].append((r["start_token"], r["end_token"]))
        assert r["tokens"] == r["end_token"] - r["start_token"]
    for name, cap in caps.items():
        mine = {c: n for (p, c), n in load.items() if p == name}
        assert max(mine.values()) <= cap and sorted(mine) == list(range(len(mine)))
        for doc, (_, n) in have.items():
            spans = sorted(parts.get((name, doc), []))
            assert len(spans) == -(-n // cap) and (not n or spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:])))
    for r in run(spark, "p7_fill"):
        mine = [n for (p, _), n in load.items() if p == r["pack_name"]]
        assert (r["containers"], r["tokens"]) == (len(mine), sum(mine)) and r["fill"] == pytest.approx(sum(mine) / len(mine) / caps[r["pack_name"]])


@pytest.mark.parametrize("kind", ["", "_balanced"])
def test_p8_shares_are_those_of_the_mix(spark, kind):
    have, targets = sizes(spark), {r["source"]: r for r in read("mix_targets")}
    chosen, last = defaultdict(list), (-1, -1)
    for r in run(spark, "p8_mix" + kind):
        assert have[r["doc_id"]] == (r["source"], r["tokens"]) and r["t"] >= last[0]
        chosen[r["source"]].append(r)
        last = (r["t"], r["doc_id"])
    whole = sum(r["tokens"] for rows in chosen.values() for r in rows)
    report = {r["source"]: r for r in run(spark, "p8_shares" + kind)}
    assert set(report) == set(targets)
    for source, r in report.items():
        uses = defaultdict(int)
        for x in chosen[source]:
            uses[x["doc_id"]] += 1
        assert (r["selected_tokens"], r["records"], r["most_uses"]) == (sum(x["tokens"] for x in chosen[source]), len(chosen[source]), max(uses.values(), default=0))
        assert r["most_uses"] <= targets[source]["max_repeats"] and r["reached_share"] == pytest.approx(r["selected_tokens"] / whole if whole else 0)
        sized = [n for s, n in have.values() if s == source and n]
        assert r["available_tokens"] == sum(sized) and r["passed_over"] == sum(n > r["wanted_tokens"] + 1 for n in sized)
        fit = [n for n in sized if n <= r["wanted_tokens"] + 1]
        if fit and not r["reason"]:
            assert abs(r["selected_tokens"] - r["wanted_tokens"]) <= max(fit) / 2 + 1
        if r["reason"].startswith("repeats used up"):
            assert r["selected_tokens"] == sum(fit) * targets[source]["max_repeats"]


def test_p9_spans_shares_and_classes(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in read("documents")}
    where = defaultdict(set)
    for i, t in docs.items():
        for p in range(len(t) - 199):
            where[hash(t[p : p + 200])].add(i)
    covered, links = {}, defaultdict(set)
    for i, t in docs.items():
        marks = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - 199):
            others = where[hash(t[p : p + 200])]
            if len(others) > 1:
                marks[p : p + 200] = True
                links[i] |= others - {i}
        covered[i] = marks
    got = {i: np.zeros(len(t), dtype=bool) for i, t in docs.items()}
    for r in run(spark, "p9_spans"):
        assert r["end"] - r["start"] >= 200 and not got[r["doc_id"]][r["start"] : r["end"]].any()
        got[r["doc_id"]][r["start"] : r["end"]] = True
    assert all((got[i] == covered[i]).all() for i in docs)
    for r in run(spark, "p9_shared"):
        assert r["shared_chars"] == covered[r["doc_id"]].sum() and r["n_chars"] == len(docs[r["doc_id"]])
    rows = {r["doc_id"]: r for r in run(spark, "p9_classes")}
    assert set(rows) == set(docs)
    for i, r in rows.items():
        same = [j for j in docs if docs[j] == docs[i]] if len(docs[i]) >= 200 else [i]
        assert (r["class_id"], r["copies"], r["links"]) == (min(same), len(same), len({docs[j] for j in links[i]} - {docs[i]}))
