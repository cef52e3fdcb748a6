"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions that adds spans.

The patterns give emails, addresses, cards and phone numbers with their checks. A bidirectional
LSTM over character classes with a linear-chain CRF on top learns from those spans in a bounded
sample of windows: each window as it stands, and with its spans written in the ways that the
patterns miss (`` at `` for ``@``, a phone number without ``+``, card digits parted by dots). Only
the spans are labelled, so that digits that fail a check stay unlabelled. Every text is cut into
overlapping windows; each window is decoded by itself, a span that a window's edge cuts is united
with what the next window saw of it, and of all spans of a text the non-overlapping set of the
largest summed margin is kept, pattern spans first.

Defined cases: a null text is empty and has no spans; repeated rows are each searched; without a
labelled span nothing is added; other columns pass through, a clash of names is refused by name.
Positions are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import dropped, staged
from tidemark.llm.words import pieces

KINDS = ("email", "ip", "card", "phone")

# ---- patterns

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the longest run of local characters before each ``@``."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        # characters before this sign cannot start a match once it has failed
        free = m.end() if m else at + 1
        if m:
            out.append((start, m.end()))
        at = text.find("@", free)
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, by kind, then start; a failed match is not tried again."""
    out = [(0, a, b) for a, b in emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return out


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


# ---- the network

#: Character classes: the printable ASCII characters, line ends and tabs, Latin letters, all others.
CLASSES = 98
TAGS = 1 + 2 * len(KINDS)  # outside, then first and further characters of each kind


def char_classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.full(len(points), 97, dtype=np.uint8)
    ascii_ = (points >= 32) & (points < 127)
    out[ascii_] = points[ascii_] - 32
    out[(points >= 9) & (points <= 13)] = 95
    out[(points >= 0xC0) & (points < 0x250)] = 96
    return out


@dataclass(frozen=True)
class Settings:
    """``sample_windows`` windows with a span and twice as many without are learned from, at most."""

    sample_windows: int = 1_500
    width: int = 96  # characters of a learned window
    hidden: int = 8
    updates: int = 420
    batch: int = 64
    rate: float = 0.02
    window: int = 448  # characters of a decoded window
    overlap: int = 64  # shared with the next one
    lanes: int = 1_024  # windows decoded together
    margin: float = 8.0  # least log odds of a span against its absence


def transitions_allowed() -> np.ndarray:
    """(from, to) tags; a further character needs one of its kind before it."""
    ok = np.ones((TAGS, TAGS), dtype=bool)
    for tag in range(2, TAGS, 2):
        ok[:, tag] = False
        ok[[tag - 1, tag], tag] = True
    return ok


def new_weights(s: Settings, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    h = s.hidden
    w = {"out": rng.normal(0, 0.3, (2 * h, TAGS)), "bias": np.zeros(TAGS), "step": np.zeros((TAGS, TAGS))}
    w["bias"][0] = 2.0
    for side in ("f", "b"):
        w[f"in_{side}"] = rng.normal(0, 0.5, (CLASSES, 4 * h))
        w[f"in_{side}"][:, h:2 * h] += 1.0  # remember by default
        w[f"rec_{side}"] = rng.normal(0, 0.4 / np.sqrt(h), (h, 4 * h))
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def lstm(chars: np.ndarray, w_in: np.ndarray, rec: np.ndarray, keep: bool = False):
    """Hidden states (steps, lanes, h) over ``chars`` (steps, lanes); with ``keep`` what the gradient needs.

    Gates are in the order input, forget, output, candidate; one tanh serves all four, since a
    sigmoid is a tanh of half its argument.
    """
    steps, lanes = chars.shape
    h = rec.shape[0]
    half = np.ones(4 * h, dtype=w_in.dtype)
    half[:3 * h] = 0.5
    table, inner = w_in * half, np.ascontiguousarray(rec * half)
    states = np.empty((steps, lanes, h), dtype=w_in.dtype)
    hidden, cell = np.zeros((lanes, h), dtype=w_in.dtype), np.zeros((lanes, h), dtype=w_in.dtype)
    kept = []
    gates = np.empty((lanes, 4 * h), dtype=w_in.dtype)
    for t in range(steps):
        np.matmul(hidden, inner, out=gates)
        gates += table[chars[t]]
        np.tanh(gates, out=gates)
        opened = gates[:, :3 * h]
        opened *= 0.5
        opened += 0.5
        before = cell
        cell = gates[:, h:2 * h] * before
        cell += gates[:, :h] * gates[:, 3 * h:]
        shaped = np.tanh(cell)
        hidden = np.multiply(gates[:, 2 * h:3 * h], shaped, out=states[t])
        if keep:
            kept.append((gates.copy(), before, shaped))
    return (states, kept) if keep else states


def states_of(chars: np.ndarray, w_in: np.ndarray, rec: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The states of :func:`lstm` times ``out`` as (steps, columns of ``out``, lanes); rows are features, so that every gate is contiguous."""
    steps, lanes = chars.shape
    h = rec.shape[0]
    half = np.ones(4 * h, dtype=np.float32)
    half[:3 * h] = 0.5
    table, inner, outer = np.ascontiguousarray((w_in * half).astype(np.float32).T), np.ascontiguousarray((rec * half).astype(np.float32).T), np.ascontiguousarray(out.T.astype(np.float32))
    made = np.empty((steps, out.shape[1], lanes), dtype=np.float32)
    hidden, cell, shaped = (np.zeros((h, lanes), dtype=np.float32) for _ in range(3))
    gates, read = np.empty((4 * h, lanes), dtype=np.float32), np.empty((4 * h, lanes), dtype=np.float32)
    into, keep, show, offer, sigmoids = gates[:h], gates[h:2 * h], gates[2 * h:3 * h], gates[3 * h:], gates[:3 * h]
    for t in range(steps):
        np.matmul(inner, hidden, out=gates)
        np.take(table, chars[t], axis=1, out=read, mode="clip")
        np.add(gates, read, out=gates)
        np.tanh(gates, out=gates)
        np.multiply(sigmoids, np.float32(0.5), out=sigmoids)
        np.add(sigmoids, np.float32(0.5), out=sigmoids)
        np.multiply(cell, keep, out=cell)
        np.multiply(into, offer, out=into)
        np.add(cell, into, out=cell)
        np.tanh(cell, out=shaped)
        np.multiply(show, shaped, out=hidden)
        np.matmul(outer, hidden, out=made[t])
    return made


def lstm_gradient(chars, w_in, rec, states, kept, above):
    """Gradients of ``w_in`` and ``rec`` for the gradient ``above`` of the states."""
    h = rec.shape[0]
    g_in, g_rec = np.zeros_like(w_in), np.zeros_like(rec)
    d_hidden, d_cell = np.zeros_like(states[0]), np.zeros_like(states[0])
    for t in range(len(chars) - 1, -1, -1):
        gates, before, shaped = kept[t]
        i, f, o, c = (gates[:, k * h:(k + 1) * h] for k in range(4))
        d_hidden = d_hidden + above[t]
        d_cell = d_cell + d_hidden * o * (1 - shaped**2)
        d = np.concatenate([d_cell * c * i * (1 - i), d_cell * before * f * (1 - f), d_hidden * shaped * o * (1 - o), d_cell * i * (1 - c**2)], axis=1)
        np.add.at(g_in, chars[t], d)
        if t:
            g_rec += states[t - 1].T @ d
        d_hidden, d_cell = d @ rec.T, d_cell * f
    return g_in, g_rec


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_loss(scores: np.ndarray, step: np.ndarray, tags: np.ndarray):
    """(mean negative log likelihood, gradient of scores, gradient of steps) of (steps, lanes, TAGS)."""
    ok = transitions_allowed()
    moves = np.where(ok, step, -1e9)
    n, lanes, _ = scores.shape
    ahead, back = np.empty_like(scores), np.empty_like(scores)
    ahead[0] = scores[0] + np.where(ok[0], 0.0, -1e9)
    for t in range(1, n):
        ahead[t] = scores[t] + _logsumexp(ahead[t - 1][:, :, None] + moves, 1)
    back[-1] = 0
    for t in range(n - 2, -1, -1):
        back[t] = _logsumexp(moves + (scores[t + 1] + back[t + 1])[:, None, :], 2)
    total = _logsumexp(ahead[-1], 1)
    lane = np.arange(lanes)
    gold = sum(scores[t, lane, tags[t]] for t in range(n)) + sum(step[tags[t - 1], tags[t]] for t in range(1, n))
    g_scores = np.exp(ahead + back - total[:, None])
    g_step = np.zeros_like(step)
    for t in range(1, n):
        g_step += np.exp(ahead[t - 1][:, :, None] + moves + (scores[t] + back[t])[:, None, :] - total[:, None, None]).sum(axis=0)
        np.add.at(g_step, (tags[t - 1], tags[t]), -1.0)
    for t in range(n):
        g_scores[t, lane, tags[t]] -= 1.0
    return float((total - gold).mean()), g_scores / lanes, np.where(ok, g_step, 0.0) / lanes


def loss_and_gradient(w: dict[str, np.ndarray], chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Both for windows as columns of ``chars`` and ``tags`` (steps, lanes)."""
    h = w["rec_f"].shape[0]
    ahead, kept_f = lstm(chars, w["in_f"], w["rec_f"], keep=True)
    turned, kept_b = lstm(chars[::-1], w["in_b"], w["rec_b"], keep=True)
    both = np.concatenate([ahead, turned[::-1]], axis=2)
    loss, g_scores, g_step = crf_loss(both @ w["out"] + w["bias"], w["step"], tags)
    g = {"step": g_step, "bias": g_scores.sum(axis=(0, 1)), "out": np.einsum("tlh,tlk->hk", both, g_scores)}
    down = g_scores @ w["out"].T
    g["in_f"], g["rec_f"] = lstm_gradient(chars, w["in_f"], w["rec_f"], ahead, kept_f, down[:, :, :h])
    g["in_b"], g["rec_b"] = lstm_gradient(chars[::-1], w["in_b"], w["rec_b"], turned, kept_b, down[::-1, :, h:])
    return loss, g


def learn(windows: list[tuple[str, list[tuple[int, int, int]]]], s: Settings) -> dict[str, np.ndarray]:
    """Weights by Adam from (text, spans) of ``s.width`` characters at most; shorter ones are padded with line ends."""
    chars = np.full((s.width, len(windows)), 95, dtype=np.int64)
    tags = np.zeros((s.width, len(windows)), dtype=np.int64)
    for k, (text, spans) in enumerate(windows):
        chars[:len(text), k] = char_classes(text)
        for kind, a, b in spans:
            tags[a:b, k] = 2 * kind + 2
            tags[a, k] = 2 * kind + 1
    w = new_weights(s)
    mean, square, rng, turn = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, np.random.default_rng(11), 0
    order = np.zeros(0, dtype=np.int64)
    while turn < s.updates:
        if not len(order):
            order = rng.permutation(len(windows))
        own, order = order[:s.batch], order[s.batch:]
        _, g = loss_and_gradient(w, chars[:, own], tags[:, own])
        size = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
        turn += 1
        rate = s.rate * (1 - 0.9 * turn / s.updates)
        for k, v in g.items():
            v = v * min(1.0, 5.0 / max(size, 1e-9))
            mean[k] = 0.9 * mean[k] + 0.1 * v
            square[k] = 0.99 * square[k] + 0.01 * v**2
            w[k] -= rate * (mean[k] / (1 - 0.9**turn)) / (np.sqrt(square[k] / (1 - 0.99**turn)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in w.items()}


# ---- the labelled sample

def other_spelling(kind: int, found: str, turn: int) -> str:
    """``found`` written in a way that its pattern does not see, or as it is."""
    turn %= 4
    if kind == 0 and turn:
        local, _, host = found.partition("@")
        sign, dot = ((" at ", " dot "), (" @ ", "."), ("[at]", "[dot]"))[turn - 1]
        return local + sign + host.replace(".", dot)
    if kind == 2 and turn > 1:
        digits = found.replace(" ", "").replace("-", "")
        return (" . " if turn == 3 else ".").join(digits[k:k + 4] for k in range(0, len(digits), 4))
    if kind == 3 and turn > 1:
        bare = found[1:].lstrip("0123456789").strip() if turn == 3 else found[1:]
        return bare if sum(c.isdigit() for c in bare) > 6 else found
    return found


def labelled_windows(text: str, width: int, turn: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Windows of a text around its pattern spans, and one without a span from its middle."""
    spans = sorted((a, b, k) for k, a, b in base_spans(text))
    out, used = [], 0
    for n, (a, b, kind) in enumerate(spans):
        if a < used or b - a > width // 2 or (n + 1 < len(spans) and spans[n + 1][0] < b):
            continue
        lead = (turn * 31 + n * 17) % (width // 3)
        found = other_spelling(kind, text[a:b], turn + n)
        left = max(used, a - lead)
        right = min(len(text), b + width - (a - left) - len(found), spans[n + 1][0] if n + 1 < len(spans) else len(text))
        window = (text[left:a] + found + text[b:right])[:width]
        if a - left + len(found) <= len(window):
            out.append((window, [(kind, a - left, a - left + len(found))]))
        used = b
    middle = len(text) * (1 + turn % 7) // 8
    clear = text[middle:middle + width]
    if clear and not any(a < middle + width and b > middle for a, b, _ in spans):
        out.append((clear, []))
    return out


def training_windows(docs: DataFrame, s: Settings, text: str = "text") -> DataFrame:
    """(window, kinds, starts, ends): at most ``sample_windows`` with a span and twice as many without, by a hash of the window."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows = []
            for value in batch.column("text").to_pylist():
                if value:
                    turn = int.from_bytes(hashlib.blake2b(value[:4096].encode("utf-8", "replace"), digest_size=4).digest(), "big")
                    rows += [(w, [x[0] for x in sp], [x[1] for x in sp], [x[2] for x in sp]) for w, sp in labelled_windows(value, s.width, turn)]
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else ([],) * 4, (pa.string(), lists, lists, lists), strict=True)],
                                             names=["window", "kinds", "starts", "ends"])

    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(cut, "window string, kinds array<int>, starts array<int>, ends array<int>")
    found = staged(found, "labelled-windows")  # texts are searched once for both kinds
    order = [F.xxhash64("window"), F.col("window")]
    some = lambda on, n: found.filter(on).dropDuplicates(["window"]).orderBy(*order).limit(n)
    return some(F.size("kinds") > 0, s.sample_windows).unionByName(some(F.size("kinds") == 0, 2 * s.sample_windows))


def fit(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> dict[str, np.ndarray] | None:
    """Weights learned in one task from the bounded sample; None without a span."""
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["window"], list(zip(r["kinds"], r["starts"], r["ends"], strict=True))) for b in batches for r in b.to_pylist())
        if any(spans for _, spans in rows):
            w = learn(rows, settings)
            yield pa.RecordBatch.from_arrays([pa.array(list(w)), pa.array([list(v.shape) for v in w.values()], pa.list_(pa.int32())), pa.array([v.tobytes() for v in w.values()])],
                                             names=["name", "shape", "body"])

    windows = training_windows(docs, settings, text)
    made = windows.coalesce(1).mapInArrow(train, "name string, shape array<int>, body binary").collect()
    dropped(windows)
    return {r["name"]: np.frombuffer(r["body"], dtype=np.float32).reshape(r["shape"]) for r in made} or None


# ---- decoding

def decode(chars: np.ndarray, w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lanes, best tags, scores of all tags) of windows as columns (steps, lanes).

    Windows in which no span can beat its absence are all outside on their best path and left out.
    """
    h = w["rec_f"].shape[0]
    scores = states_of(chars, w["in_f"], w["rec_f"], w["out"][:h])
    scores += states_of(chars[::-1], w["in_b"], w["rec_b"], w["out"][h:])[::-1]
    scores += w["bias"][:, None]
    lanes = np.flatnonzero(best_single_span(scores, w["step"]) > 0)
    scores = np.ascontiguousarray(scores[:, :, lanes].transpose(0, 2, 1))
    return lanes, viterbi(scores, np.where(transitions_allowed(), w["step"], np.float32(-1e9)).astype(np.float32)), scores


def best_single_span(scores: np.ndarray, step: np.ndarray) -> np.ndarray:
    """For each lane, an upper bound of what one span anywhere adds to the path that is all outside.

    A path is a row of spans, each entered from and left to the tags that favour it most; where no
    single span can gain, no path can. ``scores``: (steps, TAGS, lanes).
    """
    steps, _, lanes = scores.shape
    first, more = np.arange(1, TAGS, 2), np.arange(2, TAGS, 2)
    gain = scores[:, 1:] - scores[:, :1]
    base = step[0, 0]
    column = lambda x: x.astype(np.float32)[:, None]
    enter, go, stay = column(step[:, first].max(axis=0) - base), column(step[first, more] - base), column(step[more, more] - base)
    leave = column(np.maximum(0, np.maximum(step[first, 0], step[more, 0]) - base))
    opened, running = gain[0, 0::2], np.full((len(KINDS), lanes), -1e9, dtype=np.float32)
    best = opened.copy()
    for t in range(1, steps):
        running = np.maximum(opened + go, running + stay) + gain[t, 1::2]
        opened = enter + gain[t, 0::2]
        np.maximum(best, running, out=best)
        np.maximum(best, opened, out=best)
    return (best + leave).max(axis=0)


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tags (steps, lanes) of scores (steps, lanes, TAGS)."""
    steps, lanes, _ = scores.shape
    came = np.empty((steps, lanes, TAGS), dtype=np.int8)
    best = scores[0] + np.where(transitions_allowed()[0], np.float32(0), np.float32(-1e9))
    for t in range(1, steps):
        tried = best[:, :, None] + moves
        at = tried.argmax(axis=1)
        came[t] = at
        best = np.take_along_axis(tried, at[:, None, :], 1)[:, 0] + scores[t]
    tags = np.empty((steps, lanes), dtype=np.int8)
    tags[-1] = best.argmax(axis=1)
    lane = np.arange(lanes)
    for t in range(steps - 1, 0, -1):
        tags[t - 1] = came[t, lane, tags[t]]
    return tags


def window_spans(tags: np.ndarray, scores: np.ndarray, w: dict[str, np.ndarray], lens: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """(lane, kind, start, end, margin) of every decoded span; the margin is its score above that of no span."""
    out = []
    for start, lane in zip(*np.nonzero(tags % 2 == 1)):
        if start >= lens[lane]:
            continue
        tag = int(tags[start, lane])
        end = start + 1
        while end < lens[lane] and tags[end, lane] == tag + 1:
            end += 1
        own = scores[start:end, lane]
        margin = own[0, tag] + own[1:, tag + 1].sum() - own[:, 0].sum()
        inner = end - start - 1
        margin += w["step"][0, tag] - w["step"][0, 0] + (w["step"][tag, tag + 1] + (inner - 1) * w["step"][tag + 1, tag + 1] - inner * w["step"][0, 0] if inner else 0)
        out.append((int(lane), tag // 2, int(start), int(end), float(margin)))
    return out


def plausible(kind: int, found: str) -> bool:
    """Whether an added span passes the check of its kind: digits that fail one are not personal data."""
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == 0:
        return any(x in found for x in ("@", "at")) and any(x in found for x in (".", "dot"))
    if kind == 1:
        parts = re.findall("[0-9]+", found)
        return len(parts) == 4 and all(len(p) < 4 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def reconcile(text: str, found: list[tuple[int, int, int, float, bool, bool]], base: list[tuple[int, int, int]], margin: float) -> list[tuple[int, int, int]]:
    """All spans of a text by kind and start: ``base`` and the best non-overlapping set of the found ones.

    ``found``: (kind, start, end, margin, cut at its left, cut at its right). Cut spans of one
    kind that meet are united; equal spans of two windows count once with the larger margin.
    """
    parts = sorted(found, key=lambda x: (x[0], x[1], x[2]))
    united: list[list] = []
    for x in parts:
        last = united[-1] if united else None
        if last and last[0] == x[0] and x[1] < last[2] and (last[5] or x[4] or (last[1], last[2]) == (x[1], x[2])):
            last[5] = x[5] if x[2] >= last[2] else last[5]
            last[2], last[3] = max(last[2], x[2]), max(last[3], x[3])
        else:
            united.append(list(x))
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach, top = [], 0
    for _, b in taken:
        top = max(top, b)
        reach.append(top)

    def free(a: int, b: int) -> bool:
        k = bisect_left(starts, b)
        return k == 0 or reach[k - 1] <= a

    open_ = sorted((x for x in united if x[3] >= margin and free(x[1], x[2]) and plausible(x[0], text[x[1]:x[2]])), key=lambda x: (x[2], x[1], x[0]))
    ends, best = [x[2] for x in open_], [(0.0, -1, False)]
    for k, x in enumerate(open_):
        before = bisect_left(ends, x[1] + 1, 0, k)
        gain = best[before][0] + x[3]
        best.append((gain, before, True) if gain > best[k][0] else (best[k][0], k, False))
    chosen, k = [], len(open_)
    while k > 0:
        _, before, used = best[k]
        if used:
            chosen.append((open_[k - 1][0], open_[k - 1][1], open_[k - 1][2]))
        k = before
    return sorted([*base, *chosen])


def add_spans(texts: list[str], w: dict[str, np.ndarray] | None, s: Settings) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, all spans) of every text."""
    base = [base_spans(t) for t in texts]
    if w is None:
        return [(b, b) for b in base]
    stride = s.window - s.overlap
    found: list[list] = [[] for _ in texts]
    where = [(k, at) for k, t in enumerate(texts) for at in range(0, max(1, len(t) - s.overlap), stride) if t]
    classes = {}
    where.sort(key=lambda x: -min(s.window, len(texts[x[0]]) - x[1]))  # windows of like length together
    for i in range(0, len(where), s.lanes):
        group = where[i:i + s.lanes]
        lens = np.array([min(s.window, len(texts[k]) - at) for k, at in group])
        chars = np.full((int(lens.max()), len(group)), 95, dtype=np.intp)
        for lane, (k, at) in enumerate(group):
            if k not in classes:
                classes[k] = char_classes(texts[k])
            chars[:lens[lane], lane] = classes[k][at:at + lens[lane]]
        lanes, tags, scores = decode(chars, w)
        for lane, kind, a, b, gain in window_spans(tags, scores, w, lens[lanes]):
            k, at = group[int(lanes[lane])]
            found[k].append((kind, at + a, at + b, gain, a == 0 and at > 0, at + b < len(texts[k]) and b == s.window))
    return [(b, reconcile(t, f, b, s.margin)) for t, f, b in zip(texts, found, base, strict=True)]


COLUMNS = [*[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]


def find_private(docs: DataFrame, model: dict[str, np.ndarray] | None, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the counts and digest of its pattern spans and the list of all spans."""
    taken = {c.lower() for c in docs.columns} & {f.name for f in COLUMNS}
    if taken:
        raise ValueError(f"columns {sorted(taken)} would be overwritten")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, 1 << 20):
            both = add_spans([t or "" for t in batch.column(text).to_pylist()], shared.value, settings)
            counts = [pa.array([sum(x[0] == k for x in b) for b, _ in both], pa.int64()) for k in range(len(KINDS))]
            made = [*counts, pa.array([hashlib.sha256(spelled(b).encode()).hexdigest() for b, _ in both]), pa.array([spelled(a) for _, a in both], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *[f.name for f in COLUMNS]])

    return docs.mapInArrow(search, T.StructType([*docs.schema.fields, *COLUMNS]))
