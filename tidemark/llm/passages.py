"""Quality by attention-based multiple-instance learning over passages.

A document is a bag of passages of ``words`` words. Every passage is encoded: shares of character
classes, length, distinct and repeated words, and a random sign projection of its words. Gated
attention, ``softmax(w . (tanh(V h) * sigmoid(U h)))`` over the passages of a document, weights
the passages; the score is the logistic of a linear function of the weighted sum. All parameters
are learned together from document labels by gradient steps on a bounded sample of labelled rows.

Defined cases: a null or empty text is a bag of one passage of zeros; without labelled rows every
score is 0.5; repeated rows are each scored; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import fresh, held_out, labelled_sample, with_text_columns
from tidemark.llm.words import buffers, distinct, hash_words, pieces


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled documents that are learned from."""

    words: int = 64
    projected: int = 8
    hidden: int = 16
    sample_rows: int = 8_000
    epochs: int = 25
    batch: int = 64
    rate: float = 0.01


_CLASS = np.full(256, 9, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 8
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 3, 4
for _k, _chars in enumerate(("!?", "|", "#*$%&<>@", ".,;:'\"-")):
    for _c in _chars:
        _CLASS[ord(_c)] = (5, 6, 7, 10)[_k]
_CLASSES = 11


def width(s: Settings) -> int:
    return _CLASSES + 5 + s.projected


def encode_passages(texts: pa.Array, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(passages x width, offsets): the encoded passages of every text, at least one each."""
    words, offsets = hash_words(texts)
    raw, bounds = buffers(texts)
    n = np.diff(offsets)
    per = np.maximum(1, -(-n // s.words))
    ends = np.concatenate([[0], np.cumsum(per)])
    text_of = np.repeat(np.arange(len(n)), n)
    passage = ends[text_of] + (np.arange(len(words)) - offsets[text_of]) // s.words
    out = np.zeros((ends[-1], width(s)))
    if not len(words):
        return out, ends
    solid = ((raw - np.uint8(9)) > 4) & (raw != 32)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = bounds[:-1][bounds[:-1] < len(raw)]
    first[heads] = solid[heads]
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, len(raw)))  # white space after a word belongs to it
    own = raw[begin[0]:]
    counts = np.bincount(np.repeat(passage * _CLASSES, length) + _CLASS[own], minlength=ends[-1] * _CLASSES).reshape(-1, _CLASSES)
    after = np.append(begin[1:], len(raw))
    for k in np.flatnonzero(after > bounds[text_of + 1]).tolist():  # white space that opens the texts after it
        counts[passage[k]] -= np.bincount(_CLASS[raw[bounds[text_of[k] + 1]:after[k]]], minlength=_CLASSES)
    out[:, :_CLASSES] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
    size = np.bincount(passage, minlength=ends[-1])
    some = np.maximum(1, size)
    kinds = distinct((passage.astype(np.uint64) << np.uint64(36)) | (words >> np.uint64(28)))
    out[:, _CLASSES] = size / s.words
    out[:, _CLASSES + 1] = np.bincount((kinds >> np.uint64(36)).astype(np.int64), minlength=ends[-1]) / some
    for k in (1, 2):
        again = np.flatnonzero((words[k:] == words[:-k]) & (passage[k:] == passage[:-k])) if len(words) > k else np.zeros(0, dtype=int)
        out[:, _CLASSES + 1 + k] = np.bincount(passage[again], minlength=ends[-1]) / some
    out[:, _CLASSES + 4] = counts.sum(axis=1) / some / 10
    for k in range(s.projected):
        sign = ((words >> np.uint64(k)) & np.uint64(1)).astype(np.float64) * 2 - 1
        out[:, _CLASSES + 5 + k] = np.bincount(passage, weights=sign, minlength=ends[-1]) / some
    return out, ends


def _forward(p: dict, x: np.ndarray, ends: np.ndarray):
    t, g = np.tanh(x @ p["V"]), 1 / (1 + np.exp(-np.clip(x @ p["U"], -30, 30)))
    e = (t * g) @ p["w"]
    bag = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    a = np.exp(e - np.maximum.reduceat(e, ends[:-1])[bag])
    a /= np.add.reduceat(a, ends[:-1])[bag]
    z = np.add.reduceat(a[:, None] * x, ends[:-1], axis=0)
    score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"][0], -30, 30)))
    return t, g, a, bag, z, score


def _gradients(p: dict, x: np.ndarray, ends: np.ndarray, y: np.ndarray) -> dict:
    t, g, a, bag, z, score = _forward(p, x, ends)
    d = (score - y) / len(y)
    da = (x @ p["c"]) * d[bag]
    de = a * (da - np.add.reduceat(a * da, ends[:-1])[bag])
    inner = de[:, None] * p["w"]
    return {"c": z.T @ d + 1e-5 * p["c"], "b": np.array([d.sum()]), "w": (t * g).T @ de, "V": x.T @ (inner * g * (1 - t * t)), "U": x.T @ (inner * t * g * (1 - g))}


def fit_quality(sample: DataFrame, settings: Settings = Settings()) -> dict | None:
    """Parameters from the rows (doc_id, text, label) of a bounded sample; None without rows.

    Passages are encoded in tasks; the encoded bags, bounded by the sample, come to the driver in
    the order of a hash of the id.
    """
    s = settings

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            x, ends = encode_passages(batch.column("text"), s)
            packed = [x[a:b].astype(np.float32).tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("label"), pa.array(packed, pa.binary())], names=["order", "label", "bag"])

    bags = sample.select(F.xxhash64("doc_id").alias("order"), "label", "text").mapInArrow(encode, "order long, label int, bag binary").toArrow().sort_by("order")
    if not bags.num_rows:
        return None
    xs = [np.frombuffer(b, dtype=np.float32).reshape(-1, width(s)).astype(np.float64) for b in bags["bag"].to_pylist()]
    y = bags["label"].to_numpy().astype(np.float64)
    together = np.concatenate(xs)
    mean, scale = together.mean(axis=0), together.std(axis=0) + 1e-3
    xs = [(x - mean) / scale for x in xs]
    r = np.random.Generator(np.random.PCG64(11))
    p = {"V": r.normal(0, 0.2, (width(s), s.hidden)), "U": r.normal(0, 0.2, (width(s), s.hidden)), "w": r.normal(0, 0.2, s.hidden),
         "c": np.zeros(width(s)), "b": np.zeros(1)}
    m, v, step = {k: np.zeros_like(q) for k, q in p.items()}, {k: np.zeros_like(q) for k, q in p.items()}, 0
    for _ in range(s.epochs):
        order = r.permutation(len(xs))
        for k in range(0, len(order), s.batch):
            some = order[k:k + s.batch]
            ends = np.concatenate([[0], np.cumsum([len(xs[i]) for i in some])])
            step += 1
            for name, g in _gradients(p, np.concatenate([xs[i] for i in some]), ends, y[some]).items():
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                p[name] -= s.rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
    return p | {"mean": mean, "scale": scale}


def score_quality(docs: DataFrame, model: dict | None, text: str = "text", name: str = "score", settings: Settings = Settings()) -> DataFrame:
    """``docs`` and a double column ``name`` from 0 to 1 (with underscores before it where ``docs`` has one of that name)."""
    name = fresh(docs.columns, name)
    if model is None:
        return docs.withColumn(name, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> list[pa.Array]:
        p = shared.value
        x, ends = encode_passages(texts, settings)
        return [pa.array(_forward(p, (x - p["mean"]) / p["scale"], ends)[-1], pa.float64())]

    return with_text_columns(docs, text, [T.StructField(name, T.DoubleType())], score)


def train_on(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> dict | None:
    """Parameters from labelled documents whose crc32 remainder by 5 is not 0."""
    return fit_quality(labelled_sample(docs, labels, "quality", ~held_out("doc_id", 5, 0), settings.sample_rows), settings)
