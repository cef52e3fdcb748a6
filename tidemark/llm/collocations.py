"""Phrase collocations: multikey three-way quicksort of suffix pointers, routed by leading words.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at spaces and
tabs into words. Every word starts a suffix of at most four words of its piece. Suffixes travel
packed to a route that their leading pair names; each route sorts pointers to its suffixes word
by word with a three-way partition. The size of an "equal" part is the count of its phrase, and
a part lighter than the least count is left at once, together with all that lies under it.

A pair (or a triple) that holds a large share of all suffixes is routed by one word more, so no
route grows with it; its own count is then the sum over routes. Those heavy pairs are found from
what each slice of texts sees as heavy: at most ``Settings.heavy`` of them exist whatever the input.
Routes are as many as the counted words ask for; results do not depend on their number.

Defined cases: a null text is empty, a null lang is ``und``; rows count each time they occur,
ids and other columns are not read; an empty table gives an empty result. Two words share a
64-bit number with a chance near 2**-56; numbers are taken as words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import staged
from tidemark.llm.words import buffers, hash_words, mix, owners, pieces

LONGEST = 4  # words of a phrase
SLICE = 8 << 20  # bytes of text that one packed row set is made of


@dataclass(frozen=True)
class Settings:
    """``top`` rows a language are reported; ``per_route`` suffixes are sorted by one task; a prefix
    with more than twice ``1 / heavy`` of all suffixes is routed by one word more."""

    least: int = 30
    inside: int = 80
    top: int = 2000
    per_route: int = 1 << 20
    heavy: int = 1024


_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True


def read_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of every word, whether the next one continues its piece, its first byte, all bytes in lower case)."""
    raw, bounds = buffers(texts)
    cut = _BREAK[raw]
    plain = np.where(cut, np.uint8(10), raw)
    same = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(plain)])
    numbers, offsets = hash_words(same)
    solid = ((plain - np.uint8(9)) > 4) & (plain != 32)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = bounds[:-1][bounds[:-1] < len(raw)]
    first[heads] = solid[heads]
    starts = np.flatnonzero(first)
    piece = np.cumsum(cut)[starts] if len(starts) else starts
    owner = owners(offsets)
    joined = np.zeros(len(starts), dtype=bool)
    joined[:-1] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
    lower = plain + (((plain - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))
    return numbers, joined, starts, np.append(lower, np.uint8(32))


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Slices of texts of one language each."""
    for batch in pieces(batches, "text", SLICE):
        langs = batch.column("lang").dictionary_encode()
        codes = langs.indices.to_numpy(zero_copy_only=False)
        for code, name in enumerate(langs.dictionary.to_pylist()):
            yield name, batch.column("text").filter(pa.array(codes == code))


def suffixes(numbers: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """(n, 4) word numbers of every suffix of two words or more; 0 stands after the end of a piece."""
    n = len(numbers)
    words, goes_on = np.append(numbers, np.zeros(LONGEST, dtype=np.uint64)), np.append(joined, np.zeros(LONGEST, dtype=bool))
    out, inside = [numbers], np.ones(n, dtype=bool)
    for k in range(1, LONGEST):
        inside = inside & goes_on[k - 1:k - 1 + n]
        out.append(np.where(inside, words[k:k + n], np.uint64(0)))
    rows = np.stack(out, axis=1)
    return rows[rows[:, 1] != 0]


def prefix_numbers(rows: np.ndarray, size: int) -> np.ndarray:
    """One number for the first ``size`` words of each row."""
    h = rows[:, 0].copy()
    for k in range(1, size):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return h


def grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values, place of one of each, counts)."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(values) else np.zeros(0, dtype=np.int64)
    return ordered[at], order[at], np.diff(np.append(at, len(values)))


def vocabulary(texts: DataFrame) -> DataFrame:
    """(lang, word number, word, n) of all words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, column in by_language(batches):
            numbers, _, starts, lower = read_words(column)
            known, place, n = grouped(numbers)
            body = lower.tobytes()
            words = []
            for at in starts[place].tolist():
                end = at + 1
                while not (9 <= body[end] <= 13 or body[end] == 32):
                    end += 1
                words.append(body[at:end].decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(known), pa.string()), pa.array(known.view(np.int64)), pa.array(words, pa.string()), pa.array(n.astype(np.int64))],
                names=["lang", "number", "word", "n"])

    found = texts.mapInArrow(count, "lang string, number long, word string, n long")
    return found.groupBy("lang", "number").agg(F.min("word").alias("word"), F.sum("n").alias("n"))


def heavy_prefixes(texts: DataFrame, most: int) -> DataFrame:
    """(size, lang, prefix number, n) of pairs and triples that are heavy in some slice, and the
    number of all suffixes as size 0. Each slice reports at most ``most`` of either size."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, column in by_language(batches):
            numbers, joined, *_ = read_words(column)
            rows = suffixes(numbers, joined)
            sizes, keys, counts = [0], [0], [len(rows)]
            for size in (2, 3):
                known, _, n = grouped(prefix_numbers(rows[rows[:, size - 1] != 0], size))
                large = n * most > len(rows)
                large &= n > 1
                sizes += [size] * int(large.sum())
                keys += known[large].view(np.int64).tolist()
                counts += n[large].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes, pa.int32()), pa.array([lang] * len(sizes), pa.string()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())],
                names=["size", "lang", "prefix", "n"])

    found = texts.mapInArrow(find, "size int, lang string, prefix long, n long")
    return found.groupBy("size", "lang", "prefix").agg(F.sum("n").alias("n"))


def _route(rows: np.ndarray, heavy: dict[int, np.ndarray], routes: int) -> tuple[np.ndarray, np.ndarray]:
    """(route, number of leading words that named it) of every suffix."""
    key, depth = prefix_numbers(rows, 2), np.full(len(rows), 2, dtype=np.uint8)
    for size in (2, 3):
        on = np.isin(prefix_numbers(rows, size), heavy[size]) & (depth == size) & (rows[:, size - 1] != 0)
        key[on] = prefix_numbers(rows[on], size + 1)
        depth[on] = size + 1
    return (mix(key) % np.uint64(routes)).astype(np.int64), depth


def _pack(rows: np.ndarray, weights: np.ndarray, depth: np.ndarray) -> tuple[bytes, bytes, int]:
    """Distinct words of the rows, and compressed columns of their places there, weights and depths."""
    known, places = np.unique(rows, return_inverse=True)
    body = b"".join([places.reshape(rows.shape).T.astype(np.uint32).tobytes(), weights.astype(np.int64).tobytes(), depth.tobytes()])
    return known.tobytes(), pa.compress(body, codec="zstd", asbytes=True), len(rows)


def _unpack(words: bytes, body: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = pa.decompress(body, decompressed_size=n * (4 * LONGEST + 9), codec="zstd", asbytes=True)
    places = np.frombuffer(raw, dtype=np.uint32, count=LONGEST * n).reshape(LONGEST, n).T
    weights = np.frombuffer(raw, dtype=np.int64, count=n, offset=4 * LONGEST * n)
    return np.frombuffer(words, dtype=np.uint64)[places], weights, np.frombuffer(raw, dtype=np.uint8, offset=n * (4 * LONGEST + 8))


def routed(texts: DataFrame, heavy: dict[str, dict[int, np.ndarray]], routes: int) -> DataFrame:
    """Packed suffixes (lang, route, words, body, n); equal suffixes of a slice are one with a weight."""
    none = {2: np.zeros(0, dtype=np.uint64), 3: np.zeros(0, dtype=np.uint64)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, column in by_language(batches):
            numbers, joined, *_ = read_words(column)
            rows = suffixes(numbers, joined)
            if not len(rows):
                continue
            known, places = np.unique(rows, return_inverse=True)
            places = places.reshape(rows.shape).astype(np.uint64)
            high, low = places[:, 0] << np.uint64(32) | places[:, 1], places[:, 2] << np.uint64(32) | places[:, 3]
            order = np.lexsort((low, high))
            high, low = high[order], low[order]
            at = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
            weights = np.diff(np.append(at, len(order)))
            rows = known[places[order[at]].astype(np.int64)]
            route, depth = _route(rows, heavy.get(lang, none), routes)
            order = np.argsort(route, kind="stable")
            ends = np.flatnonzero(np.append(route[order][1:] != route[order][:-1], True)) + 1
            made, start = [], 0
            for end in ends.tolist():
                own = order[start:end]
                made.append((int(route[own[0]]), *_pack(rows[own], weights[own], depth[own])))
                start = end
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(made), pa.string()), *[pa.array(list(c), t) for c, t in zip(zip(*made), (pa.int64(), pa.binary(), pa.binary(), pa.int64()))]],
                names=["lang", "route", "words", "body", "n"])

    return texts.mapInArrow(deal, "lang string, route long, words binary, body binary, n long")


def frequent_prefixes(words: np.ndarray, weights: np.ndarray, least: list[int]) -> list[tuple[tuple[int, ...], int]]:
    """Prefixes of two words or more with their weights, by multikey quicksort of row pointers.

    ``words``: (n, 4) integers, 0 after the end. A part at depth d is left when it weighs less
    than ``least[d]``.
    """
    found: list[tuple[tuple[int, ...], int]] = []
    parts = [(np.arange(len(words)), 0, ())]
    columns = [np.ascontiguousarray(words[:, k]) for k in range(words.shape[1])]
    while parts:
        pointers, depth, prefix = parts.pop()
        if not len(pointers) or (least[depth] > 1 and int(weights[pointers].sum()) < least[depth]):
            continue
        keys = columns[depth][pointers]
        pivot = sorted((int(keys[0]), int(keys[len(keys) // 2]), int(keys[-1])))[1]
        below = keys < pivot
        equal = keys == pivot
        if not equal.all():
            parts.append((pointers[below], depth, prefix))
            parts.append((pointers[~(below | equal)], depth, prefix))
            pointers = pointers[equal]
        weight = int(weights[pointers].sum())
        if pivot == 0 or weight < least[depth]:
            continue
        if depth:
            found.append(((*prefix, pivot), weight))
        if depth + 1 < len(columns):
            parts.append((pointers, depth + 1, (*prefix, pivot)))
    return found


def phrase_counts(chunks: DataFrame, least: int) -> DataFrame:
    """(lang, words array of numbers, a) of all phrases of two to four words met ``least`` times."""
    def count(table: pa.Table) -> pa.Table:
        parts = [_unpack(*r) for r in zip(*[table[c].to_pylist() for c in ("words", "body", "n")])]
        rows, weights, depth = (np.concatenate([p[k] for p in parts]) for k in range(3))
        known, places = np.unique(rows, return_inverse=True)
        places = places.reshape(rows.shape) + (0 if len(known) and known[0] == 0 else 1)
        names = known if len(known) and known[0] == 0 else np.concatenate([np.zeros(1, dtype=np.uint64), known])
        found = []
        for size in (2, 3, 4):
            on = depth == size
            if on.any():
                # a prefix shorter than the one that named the route is counted in parts
                found += frequent_prefixes(places[on], weights[on], [1 if k + 1 < size and size > 2 else least for k in range(LONGEST)])
        signed = names.view(np.int64)
        lang = table["lang"][0].as_py()
        return pa.table({
            "lang": pa.array([lang] * len(found), pa.string()),
            "words": pa.array([signed[list(p)].tolist() for p, _ in found], pa.list_(pa.int64())),
            "a": pa.array([a for _, a in found], pa.int64()),
        })

    counted = chunks.groupBy("lang", "route").applyInArrow(count, "lang string, words array<long>, a long")
    return counted.groupBy("lang", "words").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    texts = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    known = staged(vocabulary(texts), "words")
    seen = heavy_prefixes(texts, settings.heavy).withColumn("all", F.sum(F.when(F.col("size") == 0, F.col("n"))).over(Window.partitionBy()))
    heavy, total = {}, 0
    # at most ``heavy`` pairs and as many triples pass, and one row a language with its suffixes
    for r in seen.filter((F.col("size") == 0) | (F.col("n") * settings.heavy > F.col("all"))).collect():
        if r["size"] == 0:
            total += r["n"]
        else:
            heavy.setdefault(r["lang"], {2: [], 3: []})[r["size"]].append(r["prefix"])
    sets = {k: {size: np.array(v[size], dtype=np.int64).view(np.uint64) for size in (2, 3)} for k, v in heavy.items()}
    chunks = routed(texts, sets, max(1, -(-total // settings.per_route)))
    return rank_phrases(staged(phrase_counts(chunks, settings.least), "phrases"), known, settings)


def exact_floor(factor: int, a: Column, below: Column) -> Column:
    """floor(factor * a / below) in 38-digit decimals."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(a) * F.lit(factor).cast("decimal(10,0)"), wide(below))


def rank_phrases(phrases: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """Weakest cuts, phrases hidden in longer ones, and the order of each language."""
    counts = phrases.select("lang", "words", F.col("a").alias("f")).unionByName(known.select("lang", F.array("number").alias("words"), F.col("n").alias("f")))
    size = F.size("words")
    cuts = phrases.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).withColumns(
        {"left": F.slice("words", 1, F.col("k")), "right": F.slice("words", F.col("k") + 1, F.lit(LONGEST))})
    cuts = cuts.join(counts.select("lang", F.col("words").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("words").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    scored = cuts.withColumn("score", exact_floor(2_000_000, F.col("a"), F.col("l") + F.col("r"))).groupBy("lang", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = F.filter(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda at: F.slice("words", at, m)))), lambda s: F.size(s) > 1)
    longer = phrases.filter(size > 2).select("lang", F.explode(spans).alias("words"), "a").groupBy("lang", "words").agg(F.max("a").alias("longest"))
    kept = scored.join(longer, ["lang", "words"], "left").filter(
        ~F.coalesce(F.lit(100).cast("decimal(10,0)") * F.col("longest").cast("decimal(20,0)") >= F.lit(settings.inside).cast("decimal(10,0)") * F.col("a").cast("decimal(20,0)"), F.lit(False)))
    spelled = kept.select("lang", "words", "a", "cut", F.posexplode("words").alias("at", "number")).join(
        known.select("lang", "number", "word"), ["lang", "number"]).groupBy("lang", "words", "a", "cut").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = spelled.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.top)
    totals = known.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").cast("long").alias("score"))
