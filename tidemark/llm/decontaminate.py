"""Benchmark decontamination by latent semantic retrieval.

1. Inverse frequencies of hashed words over all passages (``block`` words each) of all documents.
2. The benchmark items are cut into equal passages of two blocks at most; a randomised range
   finder with power iterations, whose products with the passage matrix are summed over Spark
   tasks, gives the leading right singular vectors of their TF-IDF matrix, as many as there are
   passages, so no part of a passage is lost. Items go in blocks of ``rank``
   passages at most (a longer item is alone), and the basis (words of the block x passages) is
   broadcast.
3. Every window of ``window`` blocks of every document is folded in. A word counts once per window
   and weighs the root of its inverse frequency, so the product of window and passage is the
   weight of the words they share: no less than that of their common subsequence, whatever else
   the window holds. Pairs sharing ``loose`` of the passage's weight are candidates. An item whose
   share is ``loose`` has a passage whose share is; if its words lie within ``window - 1`` blocks
   they are in one window, so no candidate is lost. Windows without any of the rarest words that
   a passage cannot do without are left out before any product; that bound is exact.
4. Around each candidate, in stretches of three times the item's length (item and two blocks more
   than twice for long ones), the longest common subsequence with the item's words, weighted by
   their inverse frequencies, is taken: a share of ``direct`` decides alone; a paraphrase (``loose``)
   also needs the item's answer, its ``answer`` column or else its last quarter, to be found.

Defined cases: words as in :mod:`words`; null or empty texts and items match nothing; a document
without an id is searched and reported with a null id; a repeated document is reported once per
row, a repeated item (same item_id) once; an empty benchmark or corpus gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import distinct, hash_words, pieces


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    block: int = 16
    window: int = 4
    rank: int = 256
    power: int = 2
    direct: float = 0.75
    loose: float = 0.55
    answer: float = 0.6


def _blocks(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, text) of every block of ``size`` words; the last of a text may be shorter."""
    n = np.diff(offsets)
    count = -(-n // size)
    text = np.repeat(np.arange(len(n)), count)
    within = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return offsets[:-1][text] + within * size, text


def inverse_frequencies(docs: DataFrame, s: Settings) -> np.ndarray:
    """ln((1 + passages) / (1 + passages with the word's bin)) for every bin."""
    shift = np.uint64(64 - s.bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(1 << s.bits, dtype=np.int64), 0
        for batch in pieces(batches, "text"):
            words, offsets = hash_words(batch.column("text"))
            starts, _ = _blocks(offsets, s.block)
            if len(starts):
                number = np.repeat(np.arange(len(starts), dtype=np.uint64), np.diff(np.append(starts, len(words))))
                pairs = distinct((number << np.uint64(s.bits)) | (words >> shift))
                seen += np.bincount((pairs & np.uint64((1 << s.bits) - 1)).astype(np.int64), minlength=1 << s.bits)
                total += len(starts)
        bins = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(bins, -1)), pa.array(np.append(seen[bins], total))], names=["bin", "n"])

    table = docs.select("text").mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    bins, n = table["bin"].to_numpy(), table["n"].to_numpy()
    passages = int(n[bins < 0].sum())
    found = np.zeros(1 << s.bits)
    found[bins[bins >= 0]] = n[bins >= 0]
    return np.log((1.0 + passages) / (1.0 + found)).astype(np.float32)


def _item_passages(words: np.ndarray, s: Settings) -> list[np.ndarray]:
    """An item's words in equal parts of two blocks at most: one has no less than the item's share."""
    count = -(-len(words) // (2 * s.block))
    return np.array_split(words, count) if count else []


def _weights(idf: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return idf[bins].astype(np.float64) + 1e-6


def latent_index(items: DataFrame, idf: np.ndarray, s: Settings) -> dict | None:
    """Basis and passages of one block of items (item_id, text, answer)."""
    shift = np.uint64(64 - s.bits)
    rows = items.toArrow()
    words, offsets = hash_words(rows["text"])
    answers, answer_offsets = hash_words(rows["answer"])
    found = [words[offsets[k]:offsets[k + 1]] for k in range(rows.num_rows)]
    if not len(words):
        return None
    vocabulary = distinct(words >> shift).astype(np.int64)
    width = min(len(vocabulary), sum(len(_item_passages(w, s)) for w in found))
    spark = items.sparkSession
    place = np.full(1 << s.bits, -1, dtype=np.int32)
    place[vocabulary] = np.arange(len(vocabulary))

    def row_vectors(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        w, o = hash_words(texts)
        for k in range(len(texts)):
            for passage in _item_passages(w[o[k]:o[k + 1]], s):
                bins, count = np.unique((passage >> shift).astype(np.int64), return_counts=True)
                weight = _weights(idf, bins)
                yield place[bins], count * np.sqrt(weight) / (count * weight).sum()

    def product(basis: np.ndarray) -> np.ndarray:
        """(A'A) basis, with the passages A spread over Spark's tasks and the sums made there."""
        shared, step = spark.sparkContext.broadcast(basis), 256

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(shared.value)
            for batch in batches:
                for where, weight in row_vectors(batch.column("text")):
                    np.add.at(total, where, weight[:, None] * (weight @ shared.value[where])[None, :])
            for k in range(0, len(total), step):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([total[k:k + step].tobytes()])], names=["k", "v"])

        def add(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(v, dtype=np.float64) for v in table["v"].to_pylist())
            return pa.table({"k": table["k"].slice(0, 1), "v": pa.array([total.tobytes()])})

        made = items.select("text").mapInArrow(part, "k long, v binary").groupBy("k").applyInArrow(add, "k long, v binary").toArrow()
        order = np.argsort(made["k"].to_numpy())
        values = made["v"].to_pylist()
        return np.concatenate([np.frombuffer(values[k], dtype=np.float64) for k in order]).reshape(basis.shape)

    basis = np.linalg.qr(np.random.Generator(np.random.PCG64(7)).standard_normal((len(vocabulary), width)))[0]
    for _ in range(s.power):
        basis = np.linalg.qr(product(basis))[0]
    owner, queries, norms = [], [], []
    root = np.sqrt(_weights(idf, vocabulary))
    needed = np.zeros(len(vocabulary), dtype=bool)
    for k in range(rows.num_rows):
        for where, weight in row_vectors(pa.array([rows["text"][k].as_py()], pa.string())):
            owner.append(k)
            queries.append(weight @ basis[where])
            norms.append(np.sqrt((weight**2).sum()))
            rare = where[np.argsort(-root[where], kind="stable")]
            part = np.zeros(len(vocabulary))
            part[where] = weight * root[where]
            rest = 1 - np.cumsum(part[rare])
            needed[rare[:int(np.argmax(rest < s.loose * 0.99)) + 1]] = True  # the words after these alone are too few
    shared = (basis * root[:, None]) @ np.array(queries).T
    return {
        "place": place, "shared": shared.astype(np.float32), "needed": needed, "owner": np.array(owner), "norm": np.array(norms),
        "ids": np.array(rows["item_id"].to_pylist(), dtype=np.int64), "words": found,
        "answers": [answers[answer_offsets[k]:answer_offsets[k + 1]] if answer_offsets[k + 1] > answer_offsets[k] else w[-max(1, len(w) // 4):] for k, w in enumerate(found)],
    }


def common_weight(item: np.ndarray, weight: np.ndarray, region: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of an item's words and a region's words."""
    best = np.zeros(len(region) + 1, dtype=np.float64)
    for word, w in zip(item, weight, strict=True):
        taken = best.copy()
        taken[1:] = np.maximum(best[1:], (best[:-1] + w) * (region == word))
        best = np.maximum.accumulate(taken)
    return float(best[-1])


def _share(item: np.ndarray, weight: np.ndarray, region: np.ndarray, s: Settings) -> tuple[float, np.ndarray]:
    """Largest share of an item's weight in any stretch of a region, and that stretch."""
    total = weight.sum()
    size, step = min(2 * s.block, len(item)) + 2 * len(item), min(s.block, len(item))
    share = common_weight(item, weight, region) / total
    if share < s.loose or len(region) <= size:
        return share, region
    best = (0.0, region)
    for k in [*range(0, len(region) - size, step), len(region) - size]:
        share = common_weight(item, weight, region[k:k + size]) / total
        if share > best[0]:
            best = (share, region[k:k + size])
    return best


def _matches(texts: pa.Array, idf: np.ndarray, index: dict, s: Settings) -> list[tuple[int, int, float, float, float]]:
    """(text, item, cosine, share, answer share) of every contaminated text and item."""
    words, offsets = hash_words(texts)
    if not len(words):
        return []
    bins = (words >> np.uint64(64 - s.bits)).astype(np.int64)
    where = index["place"][bins]
    starts, text = _blocks(offsets, s.block)
    ends = np.append(starts[1:], len(words))
    last = np.searchsorted(text, text, side="right") - 1  # last block of the same text
    first = np.ones(len(starts), dtype=bool)
    first[1:] = text[1:] != text[:-1]
    window = np.flatnonzero(first | (np.arange(len(starts)) + s.window - 1 <= last))  # shorter ones lie inside another
    begins, stops = starts[window], ends[np.minimum(window + s.window - 1, last[window])]
    needed = np.concatenate([[0], np.cumsum((where >= 0) & index["needed"][where])])
    live = np.flatnonzero(needed[stops] > needed[begins])
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    for k in range(0, len(live), 512):
        some = live[k:k + 512]
        begin, end = begins[some], stops[some]
        length = end - begin
        tokens = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begin, length)
        row = np.repeat(np.arange(len(some)), length)
        known = where[tokens] >= 0
        once = distinct((row[known] << s.bits) | where[tokens[known]])  # a word counts once per window
        row, own = once >> s.bits, once & ((1 << s.bits) - 1)
        heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))  # every live window has a word
        shared = np.add.reduceat(index["shared"][own], heads, axis=0)
        at, query = np.nonzero(shared >= s.loose * 0.99)
        pairs: dict[tuple[int, int], float] = {}
        for a, q in zip(at.tolist(), query.tolist(), strict=True):
            key = (a, int(index["owner"][q]))
            pairs[key] = max(pairs.get(key, 0.0), float(shared[a, q] / index["norm"][q]))
        for (a, item), value in pairs.items():
            owner = int(text[window[some[a]]])
            if (owner, item) in found:
                continue
            item_words = index["words"][item]
            reach = len(item_words)
            region = words[max(offsets[owner], begin[a] - reach):min(offsets[owner + 1], end[a] + reach)]
            w = _weights(idf, (item_words >> np.uint64(64 - s.bits)).astype(np.int64))
            share, stretch = _share(item_words, w, region, s)
            if share < s.loose:
                continue
            answer = index["answers"][item]
            v = _weights(idf, (answer >> np.uint64(64 - s.bits)).astype(np.int64))
            answered = common_weight(answer, v, stretch) / v.sum()
            if share >= s.direct or answered >= s.answer:
                norm = np.sqrt(_weights(idf, distinct(bins[begin[a]:end[a]])).sum())
                found[owner, item] = (share, answered, min(1.0, value / norm))
    return [(t, i, v, share, answered) for (t, i), (share, answered, v) in sorted(found.items())]


def indexes(docs: DataFrame, benchmark: DataFrame, s: Settings) -> tuple[np.ndarray, list[dict]]:
    """Inverse frequencies, and an index for every block of items."""
    idf = inverse_frequencies(docs, s)
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"), answer.alias("answer")).filter(
        "item_id IS NOT NULL").groupBy("item_id").agg(F.max("text").alias("text"), F.max("answer").alias("answer"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            _, offsets = hash_words(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(-(-np.diff(offsets) // (2 * s.block)))], names=["item_id", "passages"])

    sizes = items.select("item_id", "text").mapInArrow(count, "item_id long, passages long").filter("passages > 0").toArrow().sort_by("item_id")
    blocks, room = [], 0  # first and last item_id
    for item, passages in zip(sizes["item_id"].to_pylist(), sizes["passages"].to_pylist(), strict=True):
        if passages > room:
            blocks.append([item, item])
            room = s.rank
        blocks[-1][1] = item
        room -= passages
    made = [latent_index(items.filter(F.col("item_id").between(*ends)), idf, s) for ends in blocks]
    return idf, [m for m in made if m]


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, cosine, share, answer_share) of every contaminated document and item."""
    s = settings
    idf, made = indexes(docs, benchmark, s)
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, t) for n, t in (
        ("item_id", T.LongType()), ("cosine", T.DoubleType()), ("share", T.DoubleType()), ("answer_share", T.DoubleType())))])
    out = None
    for index in made:
        shared = docs.sparkSession.sparkContext.broadcast((idf, index))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            weights, index = shared.value
            for batch in pieces(batches, "text"):
                rows = _matches(batch.column("text"), weights, index, s)
                if rows:
                    t, i, *values = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(t)), pa.array(index["ids"][list(i)]), *(pa.array(v, pa.float64()) for v in values)], names=schema.names)

        part = docs.select("doc_id", "text").mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with their columns as they were."""
    s = settings
    idf, made = indexes(docs, benchmark, s)
    for index in made:
        shared = docs.sparkSession.sparkContext.broadcast((idf, index))

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            weights, index = shared.value
            for batch in pieces(batches, "text"):
                dirty = {t for t, *_ in _matches(batch.column("text"), weights, index, s)}
                yield batch.filter(pa.array([k not in dirty for k in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
