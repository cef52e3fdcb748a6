"""Exact Jaccard self-join of texts on word n-grams by a blocked sparse matrix product.

Rows of the matrix are the distinct n-gram sets (documents with equal sets are one row), columns
are n-grams. Two sets with similarity t have sizes within t of each other and share c of the first
``n - ceil(t n) + c`` n-grams of each in any common order (c is ``meet``, a ``share``-th of long sets, or
less for tiny sets; of two sizes that of the less counts);
the order used puts n-grams that many texts share last, so these first columns are nearly empty
unless texts are alike. A row with fewer than c columns that another row has too can reach t with
none and is left out before, which may leave others with too few: this is done ``peels`` times. In columns
with at most ``narrow`` rows the pairs are counted. A pair meets in no more wider columns than either of its
rows has, so it must be counted c times less that number; pairs counted less or whose sizes are too unlike are
discarded. Only where both rows have c wide columns or more nothing can be concluded from the count: a wide
column joins those of its rows to the least of them. (Were all its rows joined, n-grams that long texts
share by chance, more of them the larger the input, would make one group of unlike texts that grows faster than
the input.) The connected groups of these joins hold every pair that can reach t. Within such a group the product of the full incidence matrix is taken by
blocks of rows: one row times the block's columns accumulates its overlaps with all others, and
pairs below the size-derived overlap are discarded. A row already joined to the block's main
component need not be multiplied, since every link it has outward is found from the other side.
A group of any size is cut into blocks, and each pair of blocks is a task.

Defined cases: words as in :mod:`words`; fewer words than the n-gram size make one n-gram; a text
without words (or null) has an empty set and is linked with nothing; a row without an id takes
part through its set alone; repeated rows share a set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import dropped, fresh, likely, staged
from tidemark.llm.words import _coefficients, distinct, grams, hash_words, mix, pieces


@dataclass(frozen=True)
class Settings:
    """``percent``: least similarity. ``frequent_bound``: most n-grams known as frequent (they are
    broadcast, 9 bytes each; they only order the columns, results do not depend on them).
    ``peels``: how often rows that meet others in too few columns are left out; results do not
    depend on it. ``deals``: in so many parts the columns are shuffled, one after the other. Two sets must meet in ``meet`` columns or a ``share``-th of their n-grams. ``overlaps``: about so many overlaps of one row are counted at a time.
    ``block_rows`` and ``block_cells`` bound the rows and n-grams of one block."""

    size: int = 5
    percent: int = 80
    meet: int = 8
    share: int = 50
    narrow: int = 8
    frequent_bound: int = 1 << 21
    frequent_from: int = 1
    peels: int = 2
    deals: int = 2
    slice_bytes: int = 12 << 20
    block_rows: int = 2_000
    block_cells: int = 3_000_000
    overlaps: int = 500_000


def _sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """58-bit numbers of all n-grams of every text, in text order, with offsets."""
    words, offsets = hash_words(texts)
    h, owner = grams(words, offsets, size)
    lengths = np.diff(offsets)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        c = _coefficients(2048)[1536:]
        extra = np.array([(words[offsets[k]:offsets[k + 1]] * c[:lengths[k]]).sum() ^ c[16 + lengths[k]] for k in short], dtype=np.uint64)
        h, owner = np.concatenate([h, mix(extra)]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        h, owner = h[order], owner[order]
    return h >> np.uint64(6), np.searchsorted(owner, np.arange(len(lengths) + 1))


def _distinct_per_text(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids = ids.copy()
    for k in range(len(offsets) - 1):
        ids[offsets[k]:offsets[k + 1]].sort()
    new = np.ones(len(ids), dtype=bool)
    new[1:] = ids[1:] != ids[:-1]
    heads = offsets[:-1]
    new[heads[heads < len(ids)]] = True
    return ids[new], np.concatenate([[0], np.cumsum(new)])[offsets]


def frequent(docs: DataFrame, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, bit length of its number of texts), ascending, of the most frequent n-grams.

    Counted per slice of the input, where only n-grams met twice are kept, then summed. If they
    are more than ``frequent_bound``, the least frequent classes are left unknown.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", s.slice_bytes):
            ids, _ = _distinct_per_text(*_sets(batch.column("text"), s.size))
            ids = np.sort(ids)
            heads = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, dtype=int)
            n = np.diff(np.append(heads, len(ids)))
            many = n > 1
            yield pa.RecordBatch.from_arrays([pa.array(ids[heads[many]].astype(np.int64)), pa.array(n[many].astype(np.int64))], names=["id", "n"])

    counted = docs.select("text").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counted = staged(counted.select("id", F.floor(F.log2("n")).cast("int").alias("bits")), "frequent-ngrams")
    per = {r["bits"]: r["count"] for r in counted.groupBy("bits").count().collect()}
    least = s.frequent_from
    while sum(c for b, c in per.items() if b >= least) > s.frequent_bound:
        least += 1
    table = counted.filter(F.col("bits") >= least).toArrow()
    dropped(counted)
    ids, bits = table["id"].to_numpy().astype(np.uint64), table["bits"].to_numpy().astype(np.uint64)
    order = np.argsort(ids)
    return ids[order], bits[order]


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, sig, n, first): set number, set size and the columns that must meet."""
    known, bits = frequent(docs, s)
    shared = docs.sparkSession.sparkContext.broadcast((known, bits))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = shared.value
        seen = np.zeros(1 << 20, dtype=bool)
        seen[(known >> np.uint64(38)).astype(np.int64)] = True
        for batch in pieces(batches, "text"):
            ids, offsets = _sets(batch.column("text"), s.size)
            if len(known):
                maybe = np.flatnonzero(seen[(ids >> np.uint64(38)).astype(np.int64)])
                at = np.minimum(np.searchsorted(known, ids[maybe]), len(known) - 1)
                hit = known[at] == ids[maybe]
                ids[maybe[hit]] |= bits[at[hit]] << np.uint64(58)
            ids, offsets = _distinct_per_text(ids, offsets)
            n = np.diff(offsets)
            total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(ids & np.uint64((1 << 58) - 1)))])
            sig = mix((total[offsets[1:]] - total[offsets[:-1]]) ^ (n.astype(np.uint64) << np.uint64(32))).view(np.int64)
            least = (s.percent * n + 99) // 100
            length = np.where(n > 0, n - least + np.minimum(np.maximum(s.meet, n // s.share), least), 0)
            ends = np.concatenate([[0], np.cumsum(length)])
            take = np.arange(ends[-1]) - np.repeat(ends[:-1], length) + np.repeat(offsets[:-1], length)
            first = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids[take].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sig), pa.array(n.astype(np.int64)), first], names=["doc_id", "sig", "n", "first"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(describe, f"doc_id {kind}, sig long, n long, first array<long>")


class _Forest:
    def __init__(self, n: int) -> None:
        self.parent, self.size = list(range(n)), [1] * n

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> int:
        x, y = self.find(x), self.find(y)
        if x != y:
            if self.size[x] < self.size[y]:
                x, y = y, x
            self.parent[y] = x
            self.size[x] += self.size[y]
        return x


def link_block(sizes: np.ndarray, sets: list[np.ndarray], percent: int, most: int = Settings.overlaps) -> list[tuple[int, int]]:
    """Edges of a forest that spans the links among the rows of one block (or pair of blocks)."""
    m = len(sets)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable").astype(np.int32)
    flat = flat[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    del flat
    column = np.empty(len(order), dtype=np.int32)
    column[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    starts = np.append(np.flatnonzero(new), len(order))
    members, width = np.repeat(np.arange(m, dtype=np.int32), [len(x) for x in sets])[order], np.diff(starts)
    del order, new
    ends = np.cumsum([0] + [len(x) for x in sets])
    forest, done, edges = _Forest(m), np.zeros(m, dtype=bool), []
    main, waiting = 0, list(range(m - 1, -1, -1))
    while waiting:
        x = waiting.pop()
        if done[x]:
            continue
        if done.any() and forest.find(x) == forest.find(main):
            continue
        done[x] = True
        own = column[ends[x]:ends[x + 1]]
        own = own[width[own] > 1]
        overlap, some, upto = np.zeros(m, dtype=np.int64), 0, np.cumsum(width[own])
        while some < len(own):
            end = max(some + 1, int(np.searchsorted(upto, (upto[some - 1] if some else 0) + most, side="right")))
            w = width[own[some:end]]
            places = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(starts[own[some:end]], w)
            overlap += np.bincount(members[places], minlength=m)
            some = end
        hit = np.flatnonzero((100 * np.minimum(sizes, sizes[x]) >= percent * np.maximum(sizes, sizes[x])) & (overlap > 0))
        both = sizes[hit] + sizes[x] - overlap[hit]
        for y in hit[100 * overlap[hit] >= percent * both].tolist():
            if forest.find(x) != forest.find(y):
                edges.append((x, y))
                forest.join(x, y)
        best = forest.find(x)
        if best != forest.find(main) and forest.size[best] > forest.size[forest.find(main)]:
            main, waiting = best, [y for y in range(m) if not done[y]]  # the former main rows now count as outside
    return edges


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of each (cell, lo, hi), which arrive together."""
    key, rows = None, []
    for batch in batches:
        cells, lo, hi = (batch.column(c).to_pylist() for c in ("cell", "lo", "hi"))
        for k, now in enumerate(zip(cells, lo, hi, strict=True)):
            if now != key and rows:
                yield rows
                rows = []
            key = now
            rows.append((batch.column("sig")[k].as_py(), batch.column("ids")[k].as_py()))
    if rows:
        yield rows


def must_meet(n: Column, s: Settings) -> Column:
    """Columns in which a set of ``n`` n-grams meets any larger set that it is linked with."""
    return F.least(F.greatest(F.lit(s.meet), F.floor(n / s.share)), F.ceil(n * s.percent / 100))


def enough(times: Column, s: Settings) -> Column:
    """Whether ``times`` columns suffice for some link of a row: its least partner has ``percent`` of its size."""
    return times >= must_meet(F.ceil(F.col("n") * s.percent / 100), s)


def peeled(met: DataFrame, s: Settings) -> DataFrame:
    """``met`` (id, sig, n) without rows that meet others in fewer columns than any link of theirs
    needs, then without columns of one row."""
    per = lambda key: F.count(F.lit(1)).over(Window.partitionBy(key))
    rows = met.withColumn("times", per("sig")).filter(enough(F.col("times"), s)).drop("times")
    return rows.withColumn("width", per("id")).filter("width > 1").drop("width")


def links(docs: DataFrame, whole: DataFrame, sets: DataFrame, s: Settings, made: list[DataFrame]) -> DataFrame:
    """(a, b): edges between set numbers that span all links, from :func:`signatures` stored in ``whole``, which goes once it
    is read, and its numbers in ``sets``. The stored tables that the edges are made from are added to ``made``."""
    columns = whole.filter("n > 0").select(F.explode("first").alias("id"), "sig", "n")
    rows_of, parts = Window.partitionBy("id"), []
    for part in range(s.deals):
        some = columns.filter(F.pmod("id", F.lit(s.deals)) == part)
        # one shuffle: a join with the columns of several rows would take the columns twice
        several = some.withColumns({"low": F.min("sig").over(rows_of), "high": F.max("sig").over(rows_of)}).filter("low < high")
        parts.append(staged(several.select("id", "sig", "n").distinct(), "shared-columns"))
    met = reduce(DataFrame.unionByName, parts)
    dropped(whole)
    for _ in range(s.peels):
        before, met = met, staged(peeled(met, s), "shared-columns")
        dropped(before)
    wide = F.col("width") > s.narrow
    before, met = met, staged(met.withColumn("width", F.count(F.lit(1)).over(rows_of)).withColumn(
        "wides", F.count_if(wide).over(Window.partitionBy("sig"))), "shared-columns")
    dropped(before)
    rows = F.sort_array(F.collect_list(F.struct("sig", "n", "wides")))
    pair = F.flatten(F.transform("rows", lambda x, i: F.transform(
        F.filter("rows", lambda y: y["sig"] > x["sig"]), lambda y: F.struct(
            x["sig"].alias("a"), x["n"].alias("na"), y["sig"].alias("b"), y["n"].alias("nb"), F.least(x["wides"], y["wides"]).alias("wides")))))
    near = met.filter(~wide).groupBy("id").agg(rows.alias("rows")).select(F.explode(pair).alias("p")).select("p.*").filter(
        100 * F.least("na", "nb") >= s.percent * F.greatest("na", "nb"))
    needed = must_meet(F.least("na", "nb"), s)
    counted = near.groupBy("a", "b", "na", "nb", "wides").agg(F.count(F.lit(1)).alias("times")).filter(
        F.col("times") >= needed - F.when(F.col("wides") < needed, F.col("wides")).otherwise(0)).select("a", "b")
    heavy = met.filter(wide & enough(F.col("wides"), s)).withColumn("low", F.min("sig").over(rows_of))
    alike = counted.unionByName(heavy.filter("sig <> low").select(F.col("sig").alias("a"), F.col("low").alias("b")))
    cells = components(alike, "alike")
    dropped(met)
    chosen = sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("doc_id")).join(
        cells.withColumnRenamed("node", "sig"), "sig").select("doc_id", F.col("sig").alias("want"), F.col("root").alias("cell"))
    chosen = staged(chosen, "alike-sets")
    made.append(chosen)

    # sets that only rows without an id hold take part by one such row each
    nameless = sets.filter("n > 0").groupBy("sig").agg(F.count("doc_id").alias("named")).filter("named = 0").join(
        cells.withColumnRenamed("node", "sig"), "sig").select("sig", F.col("root").alias("cell"))

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            ids, offsets = _distinct_per_text(*_sets(batch.column("text"), s.size))
            n = np.diff(offsets)
            data = pa.py_buffer(np.ascontiguousarray(ids).tobytes())
            packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((offsets * 8).astype(np.int32).tobytes()), data])
            total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(ids))])
            sig = mix((total[offsets[1:]] - total[offsets[:-1]]) ^ (n.astype(np.uint64) << np.uint64(32))).view(np.int64)
            want = batch.column("want")
            same = pa.array((sig == want.fill_null(0).to_numpy(zero_copy_only=False)) | want.is_null().to_numpy(zero_copy_only=False))
            made = pa.RecordBatch.from_arrays([batch.column("cell"), pa.array(sig), pa.array(n.astype(np.int64)), packed], names=["cell", "sig", "n", "ids"])
            yield made.filter(same)

    schema = "cell long, sig long, n long, ids binary"
    rows = likely(docs.select("doc_id", "text"), chosen, "doc_id").join(chosen, "doc_id").mapInArrow(full, schema)
    none = docs.filter("doc_id IS NULL").select("doc_id", "text", F.lit(None).cast("long").alias("want"), F.lit(None).cast("long").alias("cell"))
    others = none.mapInArrow(full, schema).drop("cell").groupBy("sig").agg(F.first("n").alias("n"), F.first("ids").alias("ids")).join(nameless, "sig").select("cell", "sig", "n", "ids")
    rows = staged(rows.unionByName(others), "alike-rows")
    made.append(rows)
    # groups of several blocks are few; written, so that the planner knows that and need not shuffle the rows for them
    large = staged(rows.groupBy("cell").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / s.block_rows), F.ceil(F.sum("n") / s.block_cells)).cast("int").alias("blocks")).filter("blocks > 1").coalesce(1), "large-groups")
    made.append(large)
    cut = rows.join(large, "cell", "left").fillna(1, "blocks").withColumn("own", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("cell", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "sig", "n", "ids")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            found = {sig: np.frombuffer(ids, dtype=np.uint64) for sig, ids in group}  # a repeated row counts once
            sigs, values = list(found), list(found.values())
            if len(sigs) > 1:
                edges = link_block(np.array([len(v) for v in values]), values, s.percent, s.overlaps)
                if edges:
                    yield pa.RecordBatch.from_arrays([pa.array([sigs[x] for x, _ in edges], pa.int64()), pa.array([sigs[y] for _, y in edges], pa.int64())], names=["a", "b"])

    placed = cut.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi", "sig").select("cell", "lo", "hi", "sig", "ids")
    return placed.mapInArrow(multiply, "a long, b long")


def join_similar(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; the id of a component is its least doc_id."""
    whole = staged(signatures(docs, settings), "ngram-sets")
    sets = staged(whole.select("doc_id", "sig", "n"), "set-numbers")
    made: list[DataFrame] = []
    roots = components(links(docs, whole, sets, settings, made), "similar")
    dropped(*made)
    own = sets.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
    own = own.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    least = own.groupBy("root").agg(F.min("least").alias("component"))
    component = own.join(least, "root").select("sig", "component")
    return sets.select("doc_id", "sig", "n").join(component, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one_per_group(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Of each component the document with the least id; of rows with one id, one (the least text).

    Rows without an id stay. The columns are those of ``docs``.
    """
    kept = join_similar(docs.select("doc_id", "text"), settings).filter("doc_id = component_id").select("doc_id").distinct()
    order = fresh(docs.columns, "nth")
    rows = docs.join(kept, "doc_id", "left_semi").withColumn(order, F.row_number().over(Window.partitionBy("doc_id").orderBy("text")))
    return rows.filter(F.col(order) == 1).drop(order).unionByName(docs.filter("doc_id IS NULL")).select(*[F.col(f"`{c}`") for c in docs.columns])
