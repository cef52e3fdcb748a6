"""Spelling variants: numbered trie nodes, and integer pairs (prefix node, suffix node).

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased. The nodes of the trie of all
words and those of the trie of the reversed words get integers: words are range-partitioned in
order, each task numbers the nodes that its own words open, and the few nodes on the path between
two neighbouring partitions are given the number of the earlier one. A word of length L then is
L pairs that skip one position and L + 1 pairs that skip none. Two words differ by one replaced
character when they share a skipping pair; by one inserted character when a skipping pair of the
longer is a full pair of the shorter. A pair is held by at most one word per character that can
stand in the gap, and one without it, so no group grows with the input and no candidate is false.

Defined cases: a null text has no words, a null id counts as an empty one; rows count each time
they occur; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import staged
from tidemark.llm.words import buffers, owners, pieces

SHORTEST, LEAST, RATIO, EVERY = 6, 5, 5, 199


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def continued_crc(seeds: np.ndarray, raw: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """crc32 of each byte range, continued from the crc32 in ``seeds``; all ranges at once."""
    order = np.argsort(-lens, kind="stable")
    starts, lens = starts[order], lens[order]
    state = seeds[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    long = int((lens > 256).sum())
    for k in range(long):
        at = int(starts[k])
        state[k] = zlib.crc32(raw[at:at + int(lens[k])].tobytes(), int(state[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for j in range(int(lens[long]) if long < len(lens) else 0):
        on = slice(long, int(np.searchsorted(-lens, -j, side="left")))
        state[on] = _CRC[(state[on] ^ raw[starts[on] + j]) & np.uint32(255)] ^ (state[on] >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def read_runs(ids: list[str], texts: pa.Array) -> pa.Array:
    """All words of at least ``SHORTEST`` code points, after the deletions that the checksums ask for."""
    raw, bounds = buffers(texts)
    if not len(raw):
        return pa.array([], pa.string())
    lead = raw == 0xC3
    follow = np.concatenate([[False], lead[:-1]])
    solid = (((raw | np.uint8(32)) - np.uint8(97)) < 26) | lead | follow
    heads = bounds[:-1][bounds[:-1] < len(raw)]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[heads] = solid[heads]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    tails = heads[heads > 0] - 1
    last[tails] = solid[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    wide = np.concatenate([[0], np.cumsum(follow)])
    points = ends - starts - (wide[ends] - wide[starts])
    on = points >= SHORTEST
    starts, lens, points = starts[on], (ends - starts)[on], points[on]
    if not len(starts):
        return pa.array([], pa.string())
    lower = raw + (((raw - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))
    owner = np.searchsorted(bounds, starts, side="right") - 1
    seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], dtype=np.uint32)
    crc = continued_crc(seeds[owner], lower, starts, lens)
    hit = crc % np.uint32(EVERY) == 0
    changed = []
    for at, n, size, h in zip(*(x[hit].tolist() for x in (starts, lens, points, crc)), strict=True):
        if size > SHORTEST:
            word = lower[at:at + n].tobytes().decode()
            changed.append(word[:h % size] + word[h % size + 1:])
    starts, lens = starts[~hit], lens[~hit]
    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
    body = lower[np.repeat(starts - offsets[:-1], lens) + np.arange(offsets[-1])]
    plain = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return pa.concat_arrays([plain, pa.array(changed, pa.large_string())])


def count_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n) with at least ``LEAST`` occurrences."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            counts = pc.value_counts(read_runs(batch.column("id").to_pylist(), batch.column("text")))
            yield pa.RecordBatch.from_arrays([counts.field(0).cast(pa.string()), counts.field(1)], names=["word", "n"])

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)


def _shared(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def number_nodes(words: DataFrame, key: str) -> DataFrame:
    """All columns, ``_rank`` (integers in the order of ``key``) and ``_nodes`` (root to leaf).

    ``key`` holds distinct texts. The boundary paths are one text per partition and the next,
    the only thing that is gathered.
    """
    made = T.StructType([*words.schema.fields, T.StructField("_part", T.LongType()), T.StructField("_rank", T.LongType()), T.StructField("_nodes", T.ArrayType(T.LongType()))])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        base = (part + 1) << 40
        before, path, opened, row = "", [0], 0, 0
        for batch in batches:
            nodes = []
            for word in batch.column(key).to_pylist():
                same = _shared(before, word)
                new = len(word) - same
                path = path[:same + 1] + list(range(base + opened, base + opened + new))
                opened += new
                before = word
                nodes.append(path)
            ranks = pa.array(np.arange(base + row, base + row + batch.num_rows), pa.int64())
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int64()), ranks, pa.array(nodes, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "_part", "_rank", "_nodes"])

    spark = words.sparkSession
    numbered = staged(words.repartitionByRange(key).sortWithinPartitions(key).mapInArrow(walk, made), "trie")
    edge = F.struct(F.col(key).alias("word"), F.col("_nodes").alias("nodes"))
    edges = numbered.groupBy("_part").agg(F.min(edge).alias("low"), F.max(edge).alias("high")).orderBy("_part").collect()
    fixed, before, canonical = [], "", [0]
    for e in edges:
        same = _shared(before, e["low"]["word"])
        old, new = list(e["low"]["nodes"][:same + 1]), canonical[:same + 1]
        if same:
            fixed.append((e["_part"], old, new))
        before = e["high"]["word"]
        canonical = [new[j] if j <= same and x == old[j] else x for j, x in enumerate(e["high"]["nodes"])]
    if not fixed:
        return numbered.drop("_part")
    # one row a partition at most
    paths = F.broadcast(spark.createDataFrame(fixed, "_part long, _old array<long>, _new array<long>"))
    renamed = F.transform("_nodes", lambda x, j: F.when((j < F.size("_old")) & (x == F.get("_old", j)), F.get("_new", j)).otherwise(x))
    return numbered.join(paths, "_part", "left").withColumn("_nodes", F.when(F.col("_old").isNull(), F.col("_nodes")).otherwise(renamed)).drop("_part", "_old", "_new")


def near_words(words: DataFrame) -> DataFrame:
    """(rank, word, n, n_near, best struct(n, -rank)) for (word, n); best is null without a near word."""
    ahead = staged(number_nodes(words, "word").select(F.col("_rank").alias("rank"), "word", "n", F.col("_nodes").alias("ahead")), "ahead")
    back = number_nodes(ahead.select("rank", F.reverse("word").alias("drow")), "drow").select("rank", F.col("_nodes").alias("back"))
    both = ahead.withColumn("letters", F.split("word", "")).join(back, "rank")
    size = F.size("ahead") - 1
    gaps = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("ahead", i).alias("p"), F.get("back", size - i - 1).alias("s"), F.lit(True).alias("gap"),
        # of equal neighbouring characters only the first is left out, so that a pair meets once
        ((i == 0) | (F.get("letters", i) != F.get("letters", i - 1))).alias("head")))
    full = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("ahead", i).alias("p"), F.get("back", size - i).alias("s"), F.lit(False).alias("gap"), F.lit(False).alias("head")))
    pairs = both.select("rank", "n", F.inline(F.concat(gaps, full)))
    me = F.struct("n", (-F.col("rank")).alias("by"))
    group = Window.partitionBy("p", "s")
    ordered = group.orderBy(F.col("gap").desc(), F.col("n").desc(), F.col("rank")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gap, head = F.col("gap"), F.col("head")
    pairs = pairs.withColumns({
        "gaps": F.count_if(gap).over(group), "heads": F.count_if(head).over(group), "first": F.nth_value(me, 1).over(ordered), "second": F.nth_value(me, 2).over(ordered),
        "top_head": F.max(F.when(head, me)).over(group), "whole": F.max(F.when(~gap, me)).over(group),
    })
    others = F.when(F.col("gaps") > 1, F.when(F.col("first.by") == -F.col("rank"), F.col("second")).otherwise(F.col("first")))
    met = pairs.select(
        "rank", F.when(gap, F.col("gaps") - 1 + F.when(head & F.col("whole").isNotNull(), 1).otherwise(0)).otherwise(F.col("heads")).alias("met"),
        F.when(gap, F.greatest(others, F.when(head, F.col("whole")))).otherwise(F.col("top_head")).alias("best"),
    ).groupBy("rank").agg(F.sum("met").alias("n_near"), F.max("best").alias("best"))
    return ahead.select("rank", "word", "n").join(met, "rank")


def group_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the documents."""
    near = staged(near_words(staged(count_words(docs, text, doc_id), "vocabulary")), "near")
    is_form = F.col("best.n") >= RATIO * F.col("n")
    links = near.filter(is_form).select("rank", (-F.col("best.by")).alias("root"))
    most = near.agg(F.max("n")).first()[0] or 1
    # each step to a form multiplies n by RATIO at least; a round doubles the steps
    steps = max(1, math.floor(math.log(max(most / LEAST, 1), RATIO)) + 1)
    roots = links
    for _ in range(math.ceil(math.log2(steps))):
        roots = roots.join(roots.select(F.col("rank").alias("root"), F.col("root").alias("beyond")), "root", "left").select("rank", F.coalesce("beyond", "root").alias("root"))
    names = near.select("rank", "word")
    out = near.select("rank", "word", "n", "n_near", F.when(is_form, -F.col("best.by")).alias("form_rank"), F.when(is_form, F.col("best.n")).alias("form_n"))
    out = out.join(names.select(F.col("rank").alias("form_rank"), F.col("word").alias("form")), "form_rank", "left").join(roots, "rank", "left")
    out = out.join(names.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
