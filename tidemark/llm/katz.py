"""Katz back-off language model over words, counted and evaluated by Spark.

An n-gram's probability is its Good-Turing discounted relative frequency where it was met in
training, if only once, and otherwise the back-off weight of its context times the probability of
the n-gram without its first word. Weights are normalised exactly: what a context's kept words leave, over what the
lower order leaves. Words not met in training share the mass that the discounted words leave.

Because an n-gram is met only if its shorter forms are, the recursion adds up along a text: for
every token and order, ``log p(n-gram) - log weight(context) - log p(shorter form)`` if it was
met, and the weight of every context met. The table holds that sum per n-gram, keyed by its 64-bit
number and dealt to partitions by it. A text's n-grams go to the partitions in packed blocks, are
looked up there, and only sums per text return; no list of n-grams or texts is gathered.

Defined cases: null or empty text has one token, the end; tokens of repeated rows count each time;
without training rows every word is unknown; where counts of counts are unusable (zero or not
falling), the discount of count r is (r - 1/2) / r; a context that would leave nothing is counted
once more. ``doc_id`` is an integer; a null one is kept, and the row is scored and not held out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import held_out, staged
from tidemark.llm.words import _coefficients, distinct, hash_words, mix, pieces

BEGIN, END = np.uint64(0x1B873593CC9E2D51), np.uint64(0x85EBCA6BC2B2AE35)


@dataclass(frozen=True)
class Settings:
    order: int = 2
    discounted: int = 7
    floor: float = 0.1


def _pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Compressed bytes; ascending numbers as differences, by byte position."""
    if ascending:
        values = np.diff(values, prepend=values[:0].dtype.type(0))
    raw = np.ascontiguousarray(values)
    raw = raw.view(np.uint8).reshape(len(raw), raw.dtype.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpack(data: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.zeros(0, dtype=kind)
    raw = np.frombuffer(pa.Codec("zstd").decompress(data[8:], size, asbytes=True), dtype=np.uint8)
    width = np.dtype(kind).itemsize
    values = np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).reshape(-1)
    return np.cumsum(values, dtype=kind) if ascending else values


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, text): a begin mark, the words and an end mark of every text."""
    words, offsets = hash_words(texts)
    n = np.diff(offsets)
    text = np.repeat(np.arange(len(n)), n + 2)
    out = np.full(len(words) + 2 * len(n), END, dtype=np.uint64)
    first = np.cumsum(n + 2) - (n + 2)
    out[first] = BEGIN
    out[np.arange(len(words)) + 2 * np.repeat(np.arange(len(n)), n) + 1] = words
    return out, text


def _ngrams(tokens: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, places of the first token) of all ``size``-grams; tokens are their own 1-grams."""
    if size == 1:
        return tokens, np.arange(len(tokens))
    n = max(0, len(tokens) - size + 1)
    h = np.full(n, size, dtype=np.uint64)
    for k, c in enumerate(_coefficients(4096)[2048 + 16 * size:2048 + 17 * size]):
        h += tokens[k:k + n] * c
    at = np.flatnonzero(text[:n] == text[size - 1:])
    return mix(h[at]), at


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)


def count_ngrams(docs: DataFrame, s: Settings, parts: int) -> DataFrame:
    """level, key, context, suffix, c of every n-gram; rows with level < 0 hold the number of
    n-grams (``context``) and occurrences (``suffix``) of count ``c`` (at most ``discounted`` + 2)."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            tokens, text = _tokens(batch.column("text"))
            rows = []
            for size in range(1, s.order + 1):
                keys, at = _ngrams(tokens, text, size)
                order = np.argsort(keys, kind="stable")
                keys, at = keys[order], at[order]
                head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
                n = np.diff(np.append(head, len(keys))).astype(np.int32)
                keys, at = keys[head], at[head]
                part = _part(keys, parts)
                if size > 1:
                    shorter = np.zeros(len(tokens), dtype=np.uint64)
                    lower, places = _ngrams(tokens, text, size - 1)
                    shorter[places] = lower
                    context, suffix = shorter[at], shorter[at + 1]
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                for p in np.flatnonzero(np.diff(cuts)):
                    own = order[cuts[p]:cuts[p + 1]]
                    rows.append((int(p), size, _pack(keys[own], True), _pack(context[own]) if size > 1 else None, _pack(suffix[own]) if size > 1 else None, _pack(n[own])))
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "level", "keys", "contexts", "suffixes", "counts"])

    def total(table: pa.Table) -> pa.Table:
        level = table["level"][0].as_py()
        keys = np.concatenate([_unpack(b, np.uint64, True) for b in table["keys"].to_pylist()])
        counts = np.concatenate([_unpack(b, np.int32) for b in table["counts"].to_pylist()]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        head = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
        c = np.add.reduceat(counts[order], head)
        first = order[head]
        real = keys[first] != BEGIN if level == 1 else np.ones(len(first), dtype=bool)
        few = np.minimum(c[real], s.discounted + 2)
        sums, times = np.bincount(few, weights=c[real]).astype(np.int64), np.bincount(few)
        some = np.flatnonzero(times)
        zero = np.zeros(len(first), dtype=np.int64)
        named = lambda c: np.concatenate([_unpack(b, np.uint64) for b in table[c].to_pylist()])[first].view(np.int64) if level > 1 else zero
        return pa.table({
            "level": pa.array(np.concatenate([np.full(len(first), level), np.full(len(some), -level)]), pa.int32()),
            "key": pa.array(np.concatenate([keys[first].view(np.int64), np.zeros(len(some), dtype=np.int64)])),
            "context": pa.array(np.concatenate([named("contexts"), times[some]])),
            "suffix": pa.array(np.concatenate([named("suffixes"), sums[some]])),
            "c": pa.array(np.concatenate([c, some])),
        })

    train = docs.filter("NOT held_out").select("text").mapInArrow(blocks, "part int, level int, keys binary, contexts binary, suffixes binary, counts binary")
    return train.groupBy("part", "level").applyInArrow(total, "level int, key long, context long, suffix long, c long")


def discounts(times: dict[int, int], s: Settings) -> dict[int, float]:
    """Katz's Good-Turing discount of every count from 1 to ``discounted``."""
    k = s.discounted
    usable = all(times.get(r, 0) > 0 for r in range(1, k + 2))
    rest = (k + 1) * times.get(k + 1, 0) / times[1] if usable else 1.0
    out = {}
    for r in range(1, k + 1):
        d = ((r + 1) * times[r + 1] / (r * times[r]) - rest) / (1 - rest) if usable and rest < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


@dataclass(frozen=True)
class Model:
    """``table``: key, value, base, known, stored; the rest are whole-corpus numbers."""

    table: DataFrame
    parts: int
    tokens: int
    words: int
    unknown: float
    unknown_base: float


def train_katz(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Model of the rows (doc_id, text, held_out) that are not held out."""
    s = settings
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = staged(count_ngrams(docs, s, parts), "ngram-counts")
    few: dict[int, dict[int, tuple[int, int]]] = {}
    for r in counted.filter("level < 0").groupBy("level", "c").agg(F.sum("context").alias("n"), F.sum("suffix").alias("sum")).collect():
        few.setdefault(-r["level"], {})[r["c"]] = (r["n"], r["sum"])
    tokens, words = sum(v for _, v in few.get(1, {}).values()), sum(n for n, _ in few.get(1, {}).values())
    cut = {k: discounts({r: few.get(k, {}).get(r, (0, 0))[0] for r in range(1, s.discounted + 2)}, s) for k in range(1, s.order + 1)}

    def discounted(level: int):
        d = F.lit(1.0)
        for r, value in cut[level].items():
            d = F.when(F.col("c") == r, value).otherwise(d)
        return d * F.col("c")

    begin, end = int(BEGIN.astype(np.int64)), int(END.astype(np.int64))
    scale = 1.0
    left = sum(n * r * (1 - cut[1][r]) for r, (n, _) in few.get(1, {}).items() if r in cut[1])
    if tokens and left <= 0:  # no word is rare: count once more
        left, scale = 1.0, tokens / (tokens + 1.0)
    unknown = math.log10(left / (tokens + (1.0 if scale < 1 else 0.0))) if tokens else 0.0
    base0 = math.log10(s.floor / (tokens + s.floor * (words + 1)))
    base = F.log10((F.col("c") + s.floor) / (tokens + s.floor * (words + 1)))
    level = counted.filter("level = 1").select("key", "c", F.when(F.col("key") == begin, 1.0).otherwise(discounted(1) / max(1, tokens) * scale).alias("p"))
    values = level.select("key", (F.log10("p")).alias("own"), F.when(F.col("key") != begin, base).otherwise(0.0).alias("base"),
                          F.when(F.col("key") != begin, 1).otherwise(0).alias("known"))
    weights = None
    for k in range(2, s.order + 1):
        above = level.select(F.col("key").alias("context"), F.col("c").alias("total"))
        below = level.select(F.col("key").alias("suffix"), F.col("p").alias("shorter"))
        rows = counted.filter(F.col("level") == k).select("key", "context", "suffix", "c").join(above, "context").join(below, "suffix").select(
            "key", "context", "c", "total", "shorter", (discounted(k) / F.col("total")).alias("p"))
        rows = staged(rows, "ngram-probabilities")
        left = rows.groupBy("context").agg(F.sum("p").alias("kept"), F.sum("shorter").alias("lower"), F.first("total").alias("total")).withColumn(
            "scale", F.when(F.col("kept") > 1 - 1e-9, F.col("total") / (F.col("total") + 1)).otherwise(1.0))
        weight = left.select("context", "scale", F.log10((1 - F.col("kept") * F.col("scale")) / F.greatest(1 - F.col("lower"), F.lit(1e-12))).alias("weight"))
        rows = rows.join(weight, "context")
        level = staged(rows.select("key", "c", (F.col("p") * F.col("scale")).alias("p"), (F.log10(F.col("p") * F.col("scale")) - F.col("weight") - F.log10("shorter")).alias("own")), "ngram-level")
        ends = weight.select(F.col("context").alias("key"), F.col("weight").alias("own"))
        weights = ends if weights is None else weights.unionByName(ends)
        values = values.unionByName(level.select("key", "own", F.lit(0.0).alias("base"), F.lit(0).alias("known")))
    if weights is not None:
        values = values.unionByName(weights.filter(F.col("key") != end).select("key", "own", F.lit(0.0).alias("base"), F.lit(0).alias("known")))
    part = F.pmod(F.shiftrightunsigned("key", 32), F.lit(parts)).cast("int")
    table = values.groupBy("key").agg(F.sum("own").alias("value"), F.sum("base").alias("base"), F.sum("known").cast("long").alias("known")).withColumn("part", part)
    return Model(staged(table, "katz-table"), parts, tokens, words, unknown, base0)


def score_katz(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    s, parts = settings, model.parts

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), 0
        for batch in pieces(batches, "text"):
            tokens, text = _tokens(batch.column("text"))
            keys, owner = [], []
            for size in range(1, s.order + 1):
                k, at = _ngrams(tokens, text, size)
                keys.append(k)
                owner.append(text[at])
            keys, owner = np.concatenate(keys), np.concatenate(owner).astype(np.int32)
            order = np.argsort(keys, kind="stable")  # texts ascend within an order, not across orders
            keys, owner = keys[order], owner[order]
            new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]))
            times = np.diff(np.append(new, len(keys))).astype(np.int32)
            keys, owner = keys[new], owner[new]
            part = _part(keys, parts)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            first = (task << 33) + seen
            seen += batch.num_rows
            rows = []
            for p in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[p]:cuts[p + 1]]
                rows.append((int(p), first, _pack(keys[own], True), _pack(owner[own]), _pack(times[own])))
            n = batch.num_rows
            names = ["part", "first", "keys", "texts", "times", "doc_id", "held_out", "n_tokens"]
            listed = lambda values: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), values)
            about = [listed(batch.column("doc_id")), listed(batch.column("held_out")), listed(pa.array(np.bincount(text, minlength=n) - 1, pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array([first % parts], pa.int32()), pa.array([first], pa.int64()), *(pa.nulls(1, pa.binary()) for _ in range(3)), *about], names=names)
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), *(pa.nulls(len(rows), c.type) for c in about)], names=names)

    def answer(blocks: pa.Table, table: pa.Table) -> pa.Table:
        """Sums per text of every block, packed; the rows about the texts pass through."""
        key = table["key"].to_numpy().view(np.uint64)
        order = np.argsort(key)
        key = key[order]
        value, base, known = (table[c].to_numpy()[order] for c in ("value", "base", "known"))
        some, sums = [], []
        for k, t, n in zip(*(blocks[c].to_pylist() for c in ("keys", "texts", "times")), strict=True):
            if k is None:
                some.append(None)
                sums.append((None, None, None))
                continue
            k = _unpack(k, np.uint64, True)
            at = np.minimum(np.searchsorted(key, k), max(0, len(key) - 1))
            hit = np.flatnonzero(key[at] == k) if len(key) else np.zeros(0, dtype=np.int64)
            text, times, at = _unpack(t, np.int32)[hit], _unpack(n, np.int32)[hit], at[hit]
            own = distinct(text)
            place = np.searchsorted(own, text)
            some.append(_pack(own))
            sums.append(tuple(_pack(np.bincount(place, weights=times * v[at], minlength=len(own)).astype(np.float64)) for v in (value, base, known)))
        packed = [pa.array(c, pa.binary()) for c in (some, *zip(*sums, strict=True))] if some else [pa.nulls(0, pa.binary())] * 4
        return pa.table([blocks["first"], *packed, blocks["doc_id"], blocks["held_out"], blocks["n_tokens"]],
                        names=["first", "texts", "value", "base", "known", "doc_id", "held_out", "n_tokens"])

    def total(table: pa.Table) -> pa.Table:
        """The texts of one slice of the input with the sums of all their blocks."""
        about = table.filter(table["texts"].is_null())
        doc, held, tokens = (about[c].combine_chunks().flatten() for c in ("doc_id", "held_out", "n_tokens"))
        sums = np.zeros((3, len(tokens)))
        for t, *parts in zip(*(table[c].to_pylist() for c in ("texts", "value", "base", "known")), strict=True):
            if t is not None:
                text = _unpack(t, np.int32)
                for row, packed in zip(sums, parts, strict=True):
                    row[text] += _unpack(packed, np.float64)
        known = np.rint(sums[2]).astype(np.int64)
        return pa.table({"doc_id": doc, "held_out": held, "n_tokens": tokens, "n_known": pa.array(known), "value": pa.array(sums[0]), "base": pa.array(sums[1])})

    about = "doc_id array<long>, held_out array<boolean>, n_tokens array<long>"
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text").mapInArrow(
        ask, f"part int, first long, keys binary, texts binary, times binary, {about}")
    answered = asked.groupBy("part").cogroup(model.table.groupBy("part")).applyInArrow(
        answer, f"first long, texts binary, value binary, base binary, known binary, {about}")
    rows = answered.groupBy("first").applyInArrow(total, "doc_id long, held_out boolean, n_tokens long, n_known long, value double, base double")
    strange = F.col("n_tokens") - F.col("n_known")
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                       (F.col("base") + strange * model.unknown_base).alias("base_score"), (F.col("value") + strange * model.unknown).alias("score"))


def with_held_out(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", held_out("doc_id", 10, 0).alias("held_out"))
