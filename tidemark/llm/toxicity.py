"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once: its words, the first bytes of its words (inflected
forms of one insult share them), pairs of neighbouring words, and pairs with one word between
them, all hashed into ``2**bits`` bins. Weights are learned by the follow-the-regularised-leader
rule with a learning rate per coordinate; its L1 term leaves most weights at exactly zero, so
what is sent to the tasks is at most ``2**bits`` numbers and in practice a few thousand.

Defined cases: a null or empty text has no feature and gets the score of the bias alone; without
any labelled row every score is 0; repeated rows are each scored; other columns pass through.
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
from tidemark.llm.words import distinct, hash_words, mix, owners, pieces


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled documents that are learned from; features are made of
    about ``slice_bytes`` of text at a time, each taking some 50 times as much memory."""

    bits: int = 20
    prefix: int = 4
    sample_rows: int = 12_000
    epochs: int = 3
    alpha: float = 0.08
    beta: float = 1.0
    l1: float = 1.5
    l2: float = 1.0
    slice_bytes: int = 1 << 18


def features(texts: pa.Array, bits: int, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """(bins, offsets): the distinct bins of every text, ascending."""
    words, stems, offsets = hash_words(texts, prefix=prefix)
    owner = owners(offsets)
    shift = np.uint64(64 - bits)

    def pairs(gap: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
        n = max(0, len(words) - gap)
        inside = owner[:n] == owner[gap:]
        return mix((words[:n][inside] * np.uint64(salt)) ^ words[gap:][inside]), owner[:n][inside]

    near, near_owner = pairs(1, 0x9E3779B97F4A7C15)
    far, far_owner = pairs(2, 0xD6E8FEB86659FD93)
    hashes = np.concatenate([words, mix(stems ^ np.uint64(0x5851F42D4C957F2D)), near, far])
    owner = np.concatenate([owner, owner, near_owner, far_owner])
    keys = distinct((owner.astype(np.uint64) << np.uint64(bits)) | (hashes >> shift))
    bins = (keys & np.uint64((1 << bits) - 1)).astype(np.int64)
    counts = np.bincount((keys >> np.uint64(bits)).astype(np.int64), minlength=len(texts))
    return bins, np.concatenate([[0], np.cumsum(counts)])


def _learn(rows: list[tuple[np.ndarray, int]], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the non-zero weights; the bias is the last coordinate."""
    size = (1 << s.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2)
        w[np.abs(z[i]) <= s.l1] = 0.0
        return w

    for _ in range(s.epochs):
        for bins, label in rows:
            i = np.append(bins, size - 1)
            w = weights(i)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / s.alpha * w
            n[i] = grown
    w = weights(np.arange(size))
    kept = np.flatnonzero(w)
    return kept, w[kept]


def fit_toxicity(sample: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights from the rows (doc_id, text, label) of a bounded sample, learned in one task.

    None without rows. The order of learning is that of a hash of the id, so that the result
    does not depend on how the rows were stored.
    """
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in pieces(batches, "text", settings.slice_bytes):
            bins, offsets = features(batch.column("text"), settings.bits, settings.prefix)
            bins = bins.astype(np.int32)
            rows += [(bins[offsets[k]:offsets[k + 1]].copy(), y) for k, y in enumerate(batch.column("label").to_pylist())]
        if rows:
            kept, values = _learn(rows, settings)
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(values, pa.float64())], names=["bin", "weight"])

    ordered = sample.select("doc_id", "text", "label").coalesce(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    table = ordered.mapInArrow(learn, "bin long, weight double").toArrow()
    return (table["bin"].to_numpy(), table["weight"].to_numpy()) if table.num_rows else None


def score_toxicity(docs: DataFrame, model, text: str = "text", name: str = "score", settings: Settings = Settings()) -> DataFrame:
    """``docs`` and a double column ``name`` from 0 to 1 (with underscores before it where ``docs`` has one of that name)."""
    name = fresh(docs.columns, name)
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bits, prefix = settings.bits, settings.prefix
    dense = []  # filled once in a task

    def score(texts: pa.Array) -> list[pa.Array]:
        if not dense:
            kept, values = shared.value
            dense.append(np.zeros((1 << bits) + 1))
            dense[0][kept] = values
        w = dense[0]
        bins, offsets = features(texts, bits, prefix)
        total = np.concatenate([[0.0], np.cumsum(w[bins])])
        margin = total[offsets[1:]] - total[offsets[:-1]] + w[-1]
        return [pa.array(1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35))), pa.float64())]

    return with_text_columns(docs, text, [T.StructField(name, T.DoubleType())], score, settings.slice_bytes)


def train_on(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()):
    """Weights from the labelled documents whose crc32 remainder by 4 is not 2."""
    return fit_toxicity(labelled_sample(docs, labels, "toxic", ~held_out("doc_id", 4, 2), settings.sample_rows), settings)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``, with their columns as they were."""
    name = fresh(docs.columns, "score")
    return score_toxicity(docs, train_on(docs, labels), name=name).filter(F.col(name) < threshold).drop(name)
