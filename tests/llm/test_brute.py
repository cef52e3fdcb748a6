"""Passage encoding, attention and the toxicity learner against plain Python."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import passages, toxicity
from tidemark.llm.words import hash_words

TEXTS = [
    "One two two  three! Four & five", None, "", " \t\n", "  leading space\nand a second line a b a b", "naïve Zürich 42 | 43 #tag",
    " ".join(f"w{k % 7}" for k in range(200)) + " \n ", "\n\nlast",
]
CLASSES = {**{c: 5 for c in b"!?"}, **{c: 6 for c in b"|"}, **{c: 7 for c in b"#*$%&<>@"}, **{c: 10 for c in b".,;:'\"-"}, **{c: 3 for c in (9, 11, 12, 13, 32)}, 10: 4}


def character_class(c):
    if c in CLASSES:
        return CLASSES[c]
    return 0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 8 if c >= 128 else 9


def passages_of(text, size):
    """(words, bytes) of each passage; white space belongs to the word before it."""
    raw = (text or "").encode()
    at = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    cuts = list(range(0, len(words), size)) or [0]
    for k in cuts:
        end = at[k + size] if k + size < len(at) else len(raw)
        yield [w.lower() for w in words[k:k + size]], raw[at[k]:end] if words else b""


def test_encoded_passages_equal_plain_python():
    s = passages.Settings(words=16)
    x, ends = passages.encode_passages(pa.array(TEXTS, pa.string()), s)
    rows = [list(passages_of(t, s.words)) for t in TEXTS]
    assert np.diff(ends).tolist() == [len(r) for r in rows]
    for got, (words, raw) in zip(x, [p for r in rows for p in r], strict=True):
        counts = [0] * 11
        for c in raw:
            counts[character_class(c)] += 1
        n, some = len(words), max(1, len(words))
        want = [math.sqrt(k / max(1, len(raw))) for k in counts] + [
            n / s.words, len(set(words)) / some, sum(a == b for a, b in zip(words, words[1:], strict=False)) / some,
            sum(a == b for a, b in zip(words, words[2:], strict=False)) / some, len(raw) / some / 10]
        assert got[:16] == pytest.approx(want, abs=1e-12)


def test_a_text_is_encoded_alike_beside_any_other():
    s = passages.Settings(words=16)
    together, ends = passages.encode_passages(pa.array(TEXTS, pa.string()), s)
    for k, text in enumerate(TEXTS):
        alone, _ = passages.encode_passages(pa.array([text], pa.string()), s)
        assert (together[ends[k]:ends[k + 1]] == alone).all()


def test_attention_score_equals_plain_python():
    r, ends = np.random.default_rng(3), np.array([0, 1, 4, 9])
    x = r.normal(size=(9, 5))
    p = {"V": r.normal(size=(5, 3)), "U": r.normal(size=(5, 3)), "w": r.normal(size=3), "c": r.normal(size=5), "b": np.array([0.2])}
    for k, got in enumerate(passages._forward(p, x, ends)[-1]):
        bag = x[ends[k]:ends[k + 1]].tolist()
        dot = lambda v, m, j: sum(a * m[i][j] for i, a in enumerate(v))
        e = [sum(p["w"][j] * math.tanh(dot(v, p["V"], j)) / (1 + math.exp(-dot(v, p["U"], j))) for j in range(3)) for v in bag]
        weight = [math.exp(a) / sum(map(math.exp, e)) for a in e]
        z = [sum(a * v[i] for a, v in zip(weight, bag, strict=True)) for i in range(5)]
        assert got == pytest.approx(1 / (1 + math.exp(-sum(a * c for a, c in zip(z, p["c"], strict=True)) - 0.2)), rel=1e-9)


def test_toxicity_features_are_words_stems_pairs_and_skips():
    bits, prefix = 48, 4  # wide enough that no two features meet
    bins, offsets = toxicity.features(pa.array(TEXTS, pa.string()), bits, prefix)
    for k, text in enumerate(TEXTS):
        words = [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        want = {("w", w) for w in words} | {("s", w.encode()[:prefix]) for w in words}
        want |= {("n", *p) for p in zip(words, words[1:], strict=False)} | {("f", *p) for p in zip(words, words[2:], strict=False)}
        assert offsets[k + 1] - offsets[k] == len(want)
        alone, _ = toxicity.features(pa.array([text], pa.string()), bits, prefix)
        assert alone.tolist() == bins[offsets[k]:offsets[k + 1]].tolist()
    assert len(hash_words(pa.array(["A a"]))[0]) == 2 and len(set(hash_words(pa.array(["A a"]))[0].tolist())) == 1


def test_learned_weights_equal_plain_ftrl():
    s = toxicity.Settings(bits=5, epochs=2, alpha=0.3, l1=0.1)
    r = np.random.default_rng(5)
    rows = [(np.sort(r.choice(32, size=r.integers(0, 9), replace=False)), int(r.integers(0, 2))) for _ in range(40)]
    z, n = [0.0] * 33, [0.0] * 33

    def weight(i):
        return 0.0 if abs(z[i]) <= s.l1 else -(z[i] - math.copysign(s.l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for bins, label in rows:
            on = [*bins.tolist(), 32]
            w = [weight(i) for i in on]
            g = 1 / (1 + math.exp(-sum(w))) - label
            for i, v in zip(on, w, strict=True):
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / s.alpha * v
                n[i] += g * g
    kept, values = toxicity._learn(rows, s)
    assert kept.tolist() == [i for i in range(33) if weight(i) != 0.0]
    assert values == pytest.approx([weight(i) for i in kept.tolist()], rel=1e-12)
