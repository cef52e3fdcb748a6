"""Words of whole texts as 64-bit numbers, straight from Arrow buffers.

A word is a maximal run of characters other than space, tab, line feed, vertical tab, form
feed and carriage return; A-Z are lower-cased. Two different words share a number with a
chance near 2**-56, so equal numbers are taken as equal words throughout this package.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 17

_known = np.zeros(0, dtype=np.uint64)


def _coefficients(n: int) -> np.ndarray:
    """The first ``n`` of a fixed sequence of odd 64-bit numbers."""
    global _known
    if len(_known) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        _known = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, size=size, dtype=np.uint64) | np.uint64(1)
    return _known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of each number over all bits of the result."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` from each start to the next, modulo 2**64."""
    total = np.concatenate([np.cumsum(values)[starts[1:] - 1], [values.sum()]])
    total[1:] -= total[:-1].copy()
    return total


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of the texts (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, offsets - offsets[0]


def hash_words(texts: pa.Array, prefix: int = 0, lower: bool = True) -> tuple[np.ndarray, np.ndarray] | tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of every word, offsets of each text's words); with ``prefix`` also a number
    for the first ``prefix`` bytes of every word, placed before the offsets."""
    raw, bounds = buffers(texts)
    solid = ((raw - np.uint8(9)) > 4) & (raw != 32)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = bounds[:-1][bounds[:-1] < len(raw)]
    first[heads] = solid[heads]
    words, stems = [], []
    at = 0
    while at < len(raw):
        end = min(at + SLICE_BYTES, len(raw))
        while end < len(raw) and solid[end] and not first[end]:
            step = ~solid[end:end + 65536] | first[end:end + 65536]
            end += int(step.argmax()) if step.any() else len(step)
        starts = np.flatnonzero(first[at:end]).astype(np.int32)
        if len(starts):
            own = slice(at + int(starts[0]), end)
            byte = raw[own]
            if lower:
                byte = byte + (((byte - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))
            byte = (byte + np.uint8(1)) * solid[own].view(np.uint8)
            starts -= starts[0]
            place = np.arange(len(byte), dtype=np.int32) - np.repeat(starts, np.diff(np.append(starts, len(byte))))
            place *= solid[own]
            value = byte.astype(np.uint64) * _coefficients(int(place.max()) + 1).take(place)
            words.append(mix(_sums(value, starts)))
            if prefix:
                value[place >= prefix] = 0
                stems.append(mix(_sums(value, starts)))
        at = end
    total = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
    offsets = np.concatenate([[0], np.cumsum(first, dtype=np.int64)])[bounds]
    if prefix:
        return total, np.concatenate(stems) if stems else np.zeros(0, dtype=np.uint64), offsets
    return total, offsets


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct numbers, ascending (a sort is much faster here than ``numpy.unique``)."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def owners(offsets: np.ndarray) -> np.ndarray:
    """Position of the text that each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def grams(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all ``size``-word sequences that lie within one text, and their text's position."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    owner = owners(offsets)
    inside = owner[:n] == owner[size - 1:]
    h = np.zeros(n, dtype=np.uint64)
    for k, c in enumerate(_coefficients(1024 + size)[1024:]):
        h += words[k:k + n] * c
    return mix(h[inside]), owner[:n][inside]


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text at most (a longer text is alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end
