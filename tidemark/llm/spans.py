"""Long exact spans shared between records, by parsing every text relative to indexed reference blocks.

Copies.  Equal texts are one text; only its first document is parsed, and the others share all of it.
Index.   Winnowing picks anchors: the ``SEED``-character windows whose hash is the least among ``WINDOW`` neighbours.
         As SEED + WINDOW - 1 = 200 = ``min_len``, every run of 200 characters holds an anchor, and two equal runs hold
         equal anchors at equal places.  A reference block is an anchor with up to WINDOW - 1 characters on either side,
         and equal blocks are one entry of the index.  Blocks whose anchor occurs in one text only are dropped by their
         hash, before any text moves.  In a periodic stretch (a rule of dashes) only the anchors near its two ends are
         kept; they stand for those between them, whose blocks are all the same.
Parse.   Every document is read from left to right as a sequence of index entries.  A factor of one document relative to
         another goes on as long as both have the same entries; inside it nothing is compared and no pair is emitted
         again.  At a factor's boundary, where the entries of one anchor differ, the longest verbatim match that contains
         the anchor is taken character by character; it counts when it is at least ``min_len`` long.  A run of
         ``min_len`` characters around an anchor never leaves the block, so this is exact.  Factors that touch or overlap
         at their boundaries are joined to spans; the joined spans are the exact set of characters shared elsewhere,
         because a run of any length is covered by the blocks of its anchors.

Hot blocks (a notice that stands in a third of all documents).  Members of an index entry that also share the entry
before it met there already, so a copied passage is paired once, at its start.  Pairs of members are made between lists
of at most ``CHUNK`` documents, each pair of lists a row of its own.  An anchor with at most ``DIRECT`` different blocks
is compared block against block.  One with more is never gathered: each block is cut into its WINDOW windows of
``min_len`` characters around the anchor, and blocks meet by equal windows, which is the same condition, spread over the
cluster by the window's hash.

Departures from a textbook Lempel-Ziv parse: the index is a distributed hash table of blocks, not a suffix array, as no
task could hold one over all records; and the parse runs over block entries, with characters compared at boundaries only.

Defined results: null texts and texts under ``min_len`` share nothing; lengths are code points; copies count as sharing
their whole text (if long enough); text repeated only within one document is not shared; row order never matters; rows
with a null id take no part, and a repeated row is one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

MIN_LEN = 200
#: Length of an anchor; the winnowing window follows from it.
SEED = 120
#: Largest number of different blocks of one anchor that are compared one by one.
DIRECT = 64
#: Documents per list when pairs are made.
CHUNK = 512

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Hasher:
    """Hashes of all windows of a text: differences of a prefix polynomial modulo 2**64, then mixed."""

    def __init__(self) -> None:
        x = np.arange(1 << 16, dtype=np.uint64) + np.uint64(0x1234567)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        self.code = x ^ (x >> np.uint64(31))
        self.up = self.down = np.empty(0, np.uint64)

    def windows(self, chars: np.ndarray, size: int) -> np.ndarray:
        n = len(chars)
        if n + 1 > len(self.up):
            self.up = np.cumprod(np.full(2 * n + 2, _BASE))
            self.down = np.cumprod(np.full(2 * n + 2, _INVERSE))
        value = self.code[chars & 0xFFFF]
        if n and chars.max() > 0xFFFF:
            value = value + (chars >> np.uint32(16)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        prefix = np.empty(n + 1, np.uint64)
        prefix[0] = 0
        np.cumsum(value * self.up[:n], out=prefix[1:])
        h = (prefix[size:] - prefix[:-size]) * self.down[: n - size + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h


def _slide(x: np.ndarray, size: int, f) -> np.ndarray:
    """f over every window of ``size`` elements, by doubling."""
    done = 1
    while done * 2 <= size:
        x = f(x[:-done], x[done:])
        done *= 2
    return f(x[: len(x) - (size - done)], x[size - done :]) if done < size else x


def chars_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def anchors_of(text: str, hasher: Hasher, min_len: int = MIN_LEN, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of ``text``, and up to where an anchor stands for those left out after it."""
    if len(text) < min_len:
        return (np.empty(0, np.int64),) * 3
    h = hasher.windows(chars_of(text), seed)
    size = min_len - seed + 1
    least = _slide(h, size, np.minimum)
    edge = np.zeros(size - 1, np.uint64)
    at = np.nonzero(_slide(np.concatenate([edge, least, edge]), size, np.maximum) == h)[0]
    return thinned(at, h[at].view(np.int64), min_len, seed)


def thinned(at: np.ndarray, h: np.ndarray, min_len: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors without the inner ones of periodic stretches: equal hashes at equal distances of at most a third of a seed.

    Those within a block's side and one period of either end stay.  The last one kept before a gap has a block that lies
    wholly inside the stretch, as have all that are left out.
    """
    fill = at.copy()
    if len(at) < 3:
        return at, h, fill
    gap = np.diff(at)
    step = np.where((np.diff(h) == 0) & (gap <= seed // 3), gap, 0)
    # Links of equal step belong to one stretch.
    start = np.concatenate([[True], step[1:] != step[:-1]]) | (step == 0)
    first = np.nonzero(start)[0]
    last = np.concatenate([first[1:], [len(step)]])
    keep_within = min_len - seed + seed // 3
    keep = np.ones(len(at), dtype=bool)
    for a, b in zip(first.tolist(), last.tolist()):  # anchors a .. b
        if step[a] and at[b] - at[a] > 2 * keep_within + step[a]:
            left = int(np.searchsorted(at[a : b + 1], at[a] + keep_within, side="right")) + a - 1
            right = int(np.searchsorted(at[a : b + 1], at[b] - keep_within)) + a
            if right - left > 1:
                keep[left + 1 : right] = False
                fill[left] = at[right]
    return at[keep], h[keep], fill[keep]


def long_texts(docs: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """``doc_id, text, t, t2``: texts that may share something, with two hashes that tell copies."""
    long = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & (F.length("text") >= min_len))
    return long.withColumn("t", F.xxhash64("text")).withColumn("t2", F.hash("text"))


def anchors(texts: DataFrame, min_len: int = MIN_LEN, seed: int = SEED) -> DataFrame:
    """``h, doc_id, pos, fill`` of every anchor of ``texts(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            at, hs, fills, counts = [], [], [], []
            for text in batch.column(1).to_pylist():
                pos, h, fill = anchors_of(text, hasher, min_len, seed)
                counts.append(len(pos))
                for o, v in zip((at, hs, fills), (pos, h, fill)):
                    o.append(v)
            if counts:
                ids = np.repeat(batch.column(0).to_numpy(), counts)
                at, fills = (np.concatenate(x).astype(np.int32) for x in (at, fills))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs), pa.int64()), pa.array(ids), pa.array(at), pa.array(fills)], ["h", "doc_id", "pos", "fill"])

    return texts.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "h long, doc_id long, pos int, fill int")


def _in_several(places: DataFrame) -> DataFrame:
    """Rows of ``places(h, doc_id, ...)`` whose anchor stands in more than one document."""
    index = places.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter(F.col("lo") < F.col("hi"))
    return places.join(index.select("h"), "h", "left_semi")


def shared_blocks(texts: DataFrame, copies: DataFrame, min_len: int = MIN_LEN, seed: int = SEED) -> DataFrame:
    """``h, doc_id, pos, fill, left, right, g`` of each place whose anchor also occurs in another text.

    ``left`` is reversed, so that both sides grow away from the anchor.  Of ``copies(doc_id, rep)`` only ``rep`` has
    places: anchors that stand in one document go first, which are most, then the copies, then what only they shared.
    """
    every = materialize(anchors(texts, min_len, seed), "anchors")
    others = copies.filter(F.col("doc_id") != F.col("rep")).select("doc_id")
    shared = materialize(_in_several(every).join(others, "doc_id", "left_anti"), "shared")
    places = _in_several(shared).groupBy("doc_id").agg(F.collect_list(F.struct("pos", "fill", "h")).alias("places"))
    side = min_len - seed
    joined = texts.select("doc_id", "text").join(places, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, found in zip(*(batch.column(k).to_pylist() for k in range(3))):
                for p in found:
                    a, b = p["pos"], p["pos"] + seed
                    rows.append((p["h"], doc, a, p["fill"], text[max(0, a - side) : a][::-1], text[b : b + side], text[a:b]))
            if rows:
                h, d, at, fill, left, right, body = zip(*rows)
                # A second, independent hash over the anchor's characters guards against equal hashes of different text.
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((h, d, at, fill, left, right, body), types)], ["h", "doc_id", "pos", "fill", "left", "right", "body"])

    got = joined.mapInArrow(run, "h long, doc_id long, pos int, fill int, left string, right string, body string")
    return got.withColumn("g", F.xxhash64("body")).drop("body")


def lists_of(rows: DataFrame, keys: list[str], item: str, chunk: int | None = None) -> DataFrame:
    """``keys, items``: the items of each key in lists of about ``chunk``."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(chunk or CHUNK)).cast("int").alias("_parts"))
    placed = rows.select(*keys, item).join(sizes, keys).withColumn("_s", F.pmod(F.xxhash64(item), F.col("_parts")).cast("int"))
    return placed.groupBy(*keys, "_s").agg(F.collect_list(item).alias("items")).drop("_s")


def spread_out(pairs_of_lists: DataFrame) -> DataFrame:
    """``x, y`` of rows with lists ``a`` and ``b``; the rows are dealt out to all tasks before they unfold.

    The number of partitions is given, as small lists would else be put together although they unfold to many pairs.
    """
    tasks = int(pairs_of_lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs_of_lists.repartition(tasks, F.xxhash64("a", "b"))
    return dealt.withColumn("x", F.explode("a")).withColumn("y", F.explode("b")).drop("a", "b")


def pairs_within(rows: DataFrame, keys: list[str], item: str, chunk: int | None = None) -> DataFrame:
    """``keys, x < y``: pairs of different items of a key, for distinct ``rows(keys, item)``.

    The items of a key are in lists of about ``chunk``; each list meets itself and every other one in a row of its own.
    """
    many = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    placed = rows.select(*keys, item).join(many.select(*keys, F.ceil(F.col("_n") / F.lit(chunk or CHUNK)).cast("int").alias("_parts")), keys)
    placed = placed.withColumn("_s", F.pmod(F.xxhash64(item), F.col("_parts")).cast("int")).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    placed = placed.withColumn("_i", F.least("_s", "_o")).withColumn("_j", F.greatest("_s", "_o"))
    first = F.col("_s") == F.col("_i")
    met = placed.groupBy(*keys, "_i", "_j").agg(F.collect_list(F.when(first, F.col(item))).alias("a"), F.collect_list(F.when(~first, F.col(item))).alias("b"))
    same = F.col("_i") == F.col("_j")
    met = met.select(*keys, same.alias("_same"), "a", F.when(same, F.col("a")).otherwise(F.col("b")).alias("b"))
    got = spread_out(met).filter(~F.col("_same") | (F.col("x") < F.col("y")))
    return got.select(*keys, F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while lo < hi:  # longest equal prefix
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _factor(need: int):
    """Per anchor: which blocks match which, over at least ``need`` characters besides the anchor, and how far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_, b_, back, on = [], [], [], []
            for blocks in batch.column(0).to_pylist():
                for x in range(len(blocks)):
                    p = blocks[x]
                    for y in range(x):
                        q = blocks[y]
                        if p["lo"] == p["hi"] == q["lo"] == q["hi"]:
                            continue  # both only in one document, the same
                        left = _common(p["left"], q["left"])
                        right = _common(p["right"], q["right"])
                        if left + right >= need:
                            a_.append(p["block"])
                            b_.append(q["block"])
                            back.append(left)
                            on.append(right)
            yield pa.RecordBatch.from_arrays([pa.array(a_, pa.int64()), pa.array(b_, pa.int64()), pa.array(back, pa.int32()), pa.array(on, pa.int32())], ["x", "y", "back", "on"])

    return run


class Parsed:
    """Copies, blocks with their members, and matches between blocks; all results are read off these tables."""

    def __init__(self, docs: DataFrame, min_len: int = MIN_LEN, seed: int = SEED, direct: int = DIRECT) -> None:
        self.min_len, self.seed = min_len, seed
        need = min_len - seed
        texts = long_texts(docs, min_len)
        classes = texts.groupBy("t", "t2").agg(F.min("doc_id").cast("long").alias("rep"), F.max("doc_id").alias("hi")).filter(F.col("rep") < F.col("hi"))
        member = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "t", "t2", F.length("text").alias("n")).join(classes.select("t", "t2", "rep"), ["t", "t2"])
        self.copies = materialize(member.select("doc_id", "rep", "n").distinct(), "copies")
        places = shared_blocks(texts, self.copies, min_len, seed).withColumn("block", F.xxhash64("h", "g", "left", "right")).distinct()
        self.places = materialize(places, "places")
        blocks = self.places.groupBy("block", "h", "g", "left", "right").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        self.blocks = blocks = materialize(blocks, "blocks")
        sizes = blocks.groupBy("h", "g").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        few = blocks.join(sizes.filter(F.col("n") <= direct), ["h", "g"])
        lists = few.groupBy("h", "g").agg(F.collect_list(F.struct("block", "lo", "hi", "left", "right")).alias("blocks")).select("blocks")
        direct_ = lists.mapInArrow(_factor(need), "x long, y long, back int, on int")
        # Hot anchors: meet by equal windows of min_len characters, never in one place.
        many = blocks.join(sizes.filter(F.col("n") > direct), ["h", "g"]).select("block", "lo", "hi", "h", "g", "left", "right")
        cuts = many.withColumn("back", F.explode(F.sequence(F.lit(0), F.lit(need)))).withColumn("on", F.lit(need) - F.col("back"))
        cuts = cuts.filter((F.length("left") >= F.col("back")) & (F.length("right") >= F.col("on")))
        side = lambda c, n: F.col(c).substr(F.lit(1), F.col(n))
        self.windows = cuts.select("block", "lo", "hi", "back", "on", F.xxhash64("h", "g", "back", side("left", "back"), side("right", "on")).alias("w1"), F.hash("back", side("right", "on"), side("left", "back")).alias("w2"))
        self.matches = materialize(direct_, "matches")
        self.hot = materialize(self.windows, "windows")

    def _met(self) -> DataFrame:
        """Windows of hot blocks that stand in more than one document."""
        shared = self.hot.groupBy("w1", "w2").agg(F.min("lo").alias("a"), F.max("hi").alias("b")).filter(F.col("a") < F.col("b"))
        return self.hot.join(shared.select("w1", "w2"), ["w1", "w2"], "left_semi")

    def text_links(self) -> DataFrame:
        """``doc_a < doc_b`` for different texts that share a run, by their first documents, each pair once."""
        at = self.places.groupBy("doc_id", "block").agg(F.min("pos").alias("pos"))
        common = self.blocks.filter(F.col("lo") < F.col("hi")).select("block")
        before = F.lag("block").over(Window.partitionBy("doc_id").orderBy("pos", "block"))
        # The entry before it in the same document, 0 at the first: members that agree in it met there already.
        chained = at.join(common, "block", "left_semi").select("block", F.coalesce(before, F.lit(0)).alias("prev"), "doc_id")
        chained = materialize(chained, "chained")
        opening = chained.filter(F.col("prev") == 0).select("block", "doc_id")
        starts = pairs_within(opening, ["block"], "doc_id").select("x", "y")
        ways = chained.select("block", "prev").distinct()
        forks = pairs_within(ways, ["block"], "prev").select("block", F.col("x").alias("p"), F.col("y").alias("q"))
        by_way = lists_of(chained, ["block", "prev"], "doc_id")
        side = lambda key, name: by_way.select("block", F.col("prev").alias(key), F.col("items").alias(name))
        turned = spread_out(forks.join(side("p", "a"), ["block", "p"]).join(side("q", "b"), ["block", "q"]).select("a", "b"))
        edges = self.matches.select("x", "y")
        if not self.hot.isEmpty():
            hot = pairs_within(self._met().select("w1", "w2", "block").distinct(), ["w1", "w2"], "block")
            edges = edges.unionByName(hot.select("x", "y"))
        edges = edges.distinct()
        of_block = lists_of(at.select("block", "doc_id"), ["block"], "doc_id")
        end = lambda key, name: of_block.select(F.col("block").alias(key), F.col("items").alias(name))
        crossed = spread_out(edges.join(end("x", "a"), "x").join(end("y", "b"), "y").select("a", "b")).filter(F.col("x") != F.col("y"))
        pairs = starts.unionByName(turned).unionByName(crossed)
        return pairs.select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b")).distinct()

    def links(self) -> DataFrame:
        """``doc_a < doc_b`` for all documents that share a run, each once, copies included."""
        between = self.text_links()
        lists = lists_of(self.copies.select("rep", "doc_id"), ["rep"], "doc_id")
        side = lambda key, name: lists.select(F.col("rep").alias(key), F.col("items").alias(name))
        wide = between.join(side("doc_a", "a"), "doc_a", "left").join(side("doc_b", "b"), "doc_b", "left")
        wide = wide.select(F.coalesce("a", F.array("doc_a")).alias("a"), F.coalesce("b", F.array("doc_b")).alias("b"))
        every = spread_out(wide).unionByName(pairs_within(self.copies.select("rep", "doc_id"), ["rep"], "doc_id").select("x", "y"))
        return every.select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b"))

    def factors(self) -> DataFrame:
        """``doc_id, start, end``: a factor of at least ``min_len`` characters for every block that holds shared text."""
        m = self.matches
        reach = m.select(F.col("x").alias("block"), "back", "on").unionByName(m.select(F.col("y").alias("block"), "back", "on"))
        full = self.blocks.filter(F.col("lo") < F.col("hi")).select("block", F.length("left").alias("back"), F.length("right").alias("on"))
        reach = reach.unionByName(full).unionByName(self._met().select("block", "back", "on")).distinct()
        end = F.greatest(F.col("pos") + F.col("on"), F.when(F.col("fill") > F.col("pos"), F.col("fill")).otherwise(0)) + self.seed
        own = self.places.join(reach, "block").select("doc_id", (F.col("pos") - F.col("back")).alias("start"), end.alias("end"))
        return own.unionByName(self.copies.select("doc_id", F.lit(0).alias("start"), F.col("n").alias("end"))).distinct()

    def spans(self) -> DataFrame:
        """``doc_id, start, end``: factors joined where they touch or overlap; maximal and disjoint."""
        w = Window.partitionBy("doc_id").orderBy("start", "end")
        f = self.factors().withColumn("reach", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        f = f.withColumn("new", F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach")), 1).otherwise(0))
        f = f.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return f.groupBy("doc_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def shared_fraction(docs: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """One row per document: ``doc_id, n_chars, shared_chars, n_spans, shared_fraction``."""
    spans = Parsed(docs, min_len).spans().groupBy("doc_id").agg(F.sum(F.col("end") - F.col("start")).alias("shared_chars"), F.count("*").alias("n_spans"))
    out = docs.select("doc_id", F.length("text").alias("n_chars")).join(spans, "doc_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast(T.LongType()).alias(c)
    share = F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0)
    return out.select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("n_chars"), zero("shared_chars"), zero("n_spans")).withColumn("shared_fraction", share)


def text_classes(docs: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """One row per document: ``doc_id, class_id`` (the first document with the same text), ``copies`` of that text, and
    ``links``, the number of different texts that share a run with it."""
    parsed = Parsed(docs, min_len)
    pairs = parsed.text_links()
    ends = pairs.select(F.col("doc_a").alias("class_id")).unionAll(pairs.select("doc_b")).groupBy("class_id").agg(F.count("*").alias("links"))
    of = parsed.copies.select("doc_id", F.col("rep").alias("class_id"))
    size = of.groupBy("class_id").agg(F.count("*").alias("copies"))
    ids = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    out = ids.join(of, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id")).join(size, "class_id", "left").join(ends, "class_id", "left")
    return out.select("doc_id", "class_id", F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("links", F.lit(0)).alias("links"))
