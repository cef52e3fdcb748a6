"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

A text is normalised as the model file says (a space before it, spaces written as the word mark)
and cut into vocabulary pieces so that the sum of piece weights is largest. Weights are whole
numbers, so sums are exact in any order. No piece has a word mark after another character, which
makes the start of every word a cut that no piece crosses: words are solved once per distinct
word and batch, words of usual characters many at a time, one column of an array each.

A document over ``chunk`` characters is spread over tasks. A chunk's boundary state is the number
of its first characters that a piece from the chunk before covers. Each chunk gives a max-plus
matrix from entry to exit state; matrices are combined associatively, per block of ``fan`` chunks
and then over a document's blocks; every chunk then knows its states on the best path and is traced
back alone.

The public SentencePiece file has merge ranks instead of probabilities. The weight of a piece is
the logarithm of a Zipf law over its rank; characters outside the vocabulary weigh 10 less than
the least piece and become byte pieces, as SentencePiece itself does.

Defined cases: null or empty text gives no ids; a word mark that stands in a text itself becomes
byte pieces, so that decoding returns every text exactly; repeated rows are each encoded.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import fresh, staged
from tidemark.llm.words import pieces

MARK, LITERAL = "▁", "\udb81"
_LOWEST = -(1 << 60)
_WORD = re.compile(f"{MARK}*[^{MARK}]*")


@dataclass(frozen=True)
class Settings:
    chunk: int = 20_000
    fan: int = 256
    cached_words: int = 400_000
    together: int = 16


class Model:
    """Pieces, weights and byte pieces of a SentencePiece file; small, so it is broadcast."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        file = sentencepiece.SentencePieceProcessor(model_file=path)
        size = file.get_piece_size()
        usual = [i for i in range(size) if not (file.is_unknown(i) or file.is_control(i) or file.is_unused(i) or file.is_byte(i))]
        scale = -math.log(sum(1 / (k + 1) for k in range(len(usual))))
        self.weights = {i: round((scale - math.log(k + 1)) * (1 << 20)) for k, i in enumerate(usual)}
        self.unknown = min(self.weights.values()) - (10 << 20)
        self.longest = max(len(file.id_to_piece(i)) for i in usual)
        self.bytes_at = {int(file.id_to_piece(i)[3:5], 16): i for i in range(size) if file.is_byte(i)}
        if len(self.bytes_at) != 256:
            raise ValueError("the model needs byte pieces")
        self.table: dict[str, tuple[int, int] | None] = {}
        for i in usual:
            piece = file.id_to_piece(i)
            if MARK in piece.lstrip(MARK):
                raise ValueError("a piece crosses the start of a word")
            for k in range(1, len(piece)):
                self.table.setdefault(piece[:k], None)
            self.table[piece] = (self.weights[i], i)
        self.spelled = [b""] * size
        for i in usual:
            self.spelled[i] = file.id_to_piece(i).replace(MARK, " ").encode()
        for b, i in self.bytes_at.items():
            self.spelled[i] = bytes([b])
        self._tables()

    def _tables(self) -> None:
        """``table`` as arrays, for words of characters under U+0100 that are pieces themselves: ``kinds``
        numbers the characters from 1, ``after`` holds the prefix that follows a prefix (0: none, 1: the
        empty one), ``worth`` and ``named`` the weight and id of the prefix as a piece."""
        usual = sorted(c for c in self.table if len(c) == 1 and self.table[c] and (ord(c) < 256 or c == MARK))
        kind = {c: k + 1 for k, c in enumerate(usual)}
        self.kinds, self.mark = np.zeros(257, dtype=np.int64), kind.get(MARK, 0)
        self.kinds[[ord(c) for c in usual if c != MARK]] = [k for c, k in kind.items() if c != MARK]
        prefixes = ["", *sorted(p for p in self.table if all(c in kind for c in p))]
        number = {p: k + 1 for k, p in enumerate(prefixes)}
        self.after = np.zeros((len(prefixes) + 1, len(usual) + 1), dtype=np.min_scalar_type(len(prefixes)))
        self.worth, self.named = np.full(len(prefixes) + 1, 2 * _LOWEST, dtype=np.int64), np.zeros(len(prefixes) + 1, dtype=np.int32)
        for p in prefixes[1:]:
            self.after[number[p[:-1]], kind[p[-1]]] = number[p]
            if self.table[p]:
                self.worth[number[p]], self.named[number[p]] = self.table[p]

    def words(self, kinds: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, number of ids, weights) of many words at once: column k of ``kinds`` has the characters of
        word k, then zeros. The steps are those of :meth:`lattice`, in its order."""
        size, n = kinds.shape
        score = np.full((size + 1, n), _LOWEST, dtype=np.int64)
        start, piece = np.zeros((size + 1, n), dtype=np.int32), np.zeros((size + 1, n), dtype=np.int32)
        score[0] = 0
        for i in range(size):
            at = np.flatnonzero(lengths > i)
            prefix = np.ones(len(at), dtype=self.after.dtype)
            for j in range(i + 1, min(size, i + self.longest) + 1):
                prefix = self.after[prefix, kinds[j - 1, at]]
                on = np.flatnonzero(prefix)
                if not len(on):
                    break
                prefix, at = prefix[on], at[on]
                total = score[i, at] + self.worth[prefix]
                better = total > score[j, at]
                own = at[better]
                score[j, own], start[j, own], piece[j, own] = total[better], i, self.named[prefix[better]]
        every, at = np.arange(n), lengths.astype(np.int64)
        steps, taken = [], []
        while at.any():
            taken.append(at > 0)
            steps.append(piece[at, every])
            at = np.where(at > 0, start[at, every], 0)
        if not steps:
            return np.zeros(0, dtype=np.int32), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        steps, taken = np.array(steps[::-1]).T, np.array(taken[::-1]).T
        return steps[taken], taken.sum(axis=1), score[lengths, every]

    def lattice(self, text: str, start: int, stop: int, last: int) -> tuple[list[int], list[tuple[int, object]]]:
        """Best weights and last pieces to every place from ``start``; pieces begin before ``stop``
        and end by ``last``."""
        score, back = [_LOWEST] * (last - start + 1), [(0, None)] * (last - start + 1)
        score[0] = 0
        get, missing = self.table.get, ()
        for i in range(start, stop):
            base = score[i - start]
            if base == _LOWEST:
                continue
            single = False
            for j in range(i + 1, min(last, i + self.longest) + 1):
                found = get(text[i:j], missing)
                if found is missing:
                    break
                if found is not None:
                    single = single or j == i + 1
                    if base + found[0] > score[j - start]:
                        score[j - start], back[j - start] = base + found[0], (i, found[1])
            if not single and i < last and base + self.unknown > score[i + 1 - start]:
                score[i + 1 - start], back[i + 1 - start] = base + self.unknown, (i, None)
        return score, back

    def path(self, text: str, start: int, stop: int, end: int) -> list[int]:
        """Ids of the best pieces from ``start`` to ``end``."""
        _, back = self.lattice(text, start, stop, end)
        out, at = [], end
        while at > start:
            before, piece = back[at - start]
            if piece is None:
                out.extend(self.bytes_at[b] for b in reversed((MARK if text[before] == LITERAL else text[before]).encode()))
            else:
                out.append(piece)
            at = before
        return out[::-1]


def normalised(text: str) -> str:
    return MARK + text.replace(MARK, LITERAL).replace(" ", MARK) if text else ""


def _cuts(text: str, upto: int) -> list[int]:
    """Places after 0 and up to ``upto`` where a word starts."""
    return [m.start() for m in re.finditer(f"(?<=[^{MARK}]){MARK}", text) if m.start() <= upto]


def _body(ids: list[int] | np.ndarray) -> bytes:
    return np.asarray(ids, dtype=np.int32).tobytes()


def _ids(body: bytes) -> np.ndarray:
    return np.frombuffer(body, dtype=np.int32)


class Encoder:
    """Encodes words, remembering a bounded number of them; ids are kept as the bytes of 32-bit numbers."""

    slice_words = 8_192

    def __init__(self, model: Model, most: int) -> None:
        self.model, self.most, self.known, self.weights = model, most, {}, {}

    def word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = _body(self.model.path(word, 0, len(word), len(word)))
            if len(self.known) >= self.most:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = ids
        return ids

    def weight(self, word: str) -> int:
        """Weight of the word's best path."""
        found = self.weights.get(word)
        if found is None:
            found = self.model.lattice(word, 0, len(word), len(word))[0][-1]
            if len(self.weights) >= self.most:
                self.weights.clear()
            if len(word) <= 64:
                self.weights[word] = found
        return found

    def many(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(places in ``words``, ids, number of ids, weights) of slices of the words that :meth:`Model.words`
        can take, of about one length; they have a word mark at the front and nowhere else."""
        model = self.model
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kinds = model.kinds[np.minimum(points, 256)]
        first = np.cumsum(lengths) - lengths
        kinds[first] = model.mark
        strange = np.concatenate([[0], np.cumsum(kinds == 0)])
        fit = np.flatnonzero((lengths <= 64) & (strange[first + lengths] == strange[first]))
        fit = fit[np.argsort(lengths[fit], kind="stable")]
        for k in range(0, len(fit), self.slice_words):
            own = fit[k:k + self.slice_words]
            size = int(lengths[own].max())
            place = np.arange(size)[:, None]
            inside = place < lengths[own]
            yield own, *model.words(np.where(inside, kinds[np.where(inside, first[own] + place, 0)], 0), lengths[own])

    def learn(self, texts: list[str], weights: bool) -> None:
        """Remembers the words of a few texts, with their ids or their weights."""
        known = self.weights if weights else self.known
        new = list({w for t in texts for w in _WORD.findall(t) if 1 < len(w) <= 64 and w[0] == MARK and w[1] != MARK} - known.keys())
        if not new:
            return
        if len(known) + len(new) > self.most:
            known.clear()
        for own, ids, n, values in self.many(new):
            if not weights:
                ids, ends = _body(ids), (4 * np.cumsum(n)).tolist()
                values = [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            known.update(zip([new[k] for k in own.tolist()], values if isinstance(values, list) else values.tolist(), strict=True))

    def text(self, text: str) -> list[int]:
        return _ids(b"".join(self.word(w) for w in _WORD.findall(normalised(text)) if w)).tolist()

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets). Texts whose spaces all stand alone go by their distinct words."""
        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")), pc.match_substring(texts, MARK)).to_numpy(zero_copy_only=False)
        usual = np.flatnonzero(~odd & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0))
        lists = pc.split_pattern(texts.take(pa.array(usual)), " ")
        coded = lists.flatten().dictionary_encode()
        words = [MARK + w for w in coded.dictionary.to_pylist()]
        length, order, made = np.full(len(words), -1, dtype=np.int64), [], []
        for own, some, n, _ in self.many(words):
            length[own] = n
            order.append(own)
            made.append(some)
        for k in np.flatnonzero(length < 0).tolist():
            made.append(_ids(self.word(words[k])))
            order.append(np.array([k]))
            length[k] = len(made[-1])
        flat, order = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (made, order))
        first = np.zeros(len(words), dtype=np.int64)  # in ``flat``, which has the words as they were made
        first[order] = np.cumsum(length[order]) - length[order]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        per = length[codes]
        before = np.concatenate([[0], np.cumsum(per)])
        ids = flat[np.arange(before[-1]) - np.repeat(before[:-1], per) + np.repeat(first[codes], per)] if len(codes) else flat
        words = np.zeros(len(texts), dtype=np.int64)
        words[usual] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        offsets = before[np.concatenate([[0], np.cumsum(words)])]
        strange = np.flatnonzero(odd)
        if len(strange):
            rows = [ids[offsets[k]:offsets[k + 1]] for k in range(len(texts))]
            for k in strange.tolist():
                rows[k] = np.array(self.text(texts[k].as_py()), dtype=np.int32)
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
            ids = np.concatenate(rows)
        return ids.astype(np.int32), offsets


def transfer(model: Model, encoder: Encoder, text: str, ahead: str) -> np.ndarray:
    """Max-plus matrix of a chunk from entry state to exit state; ``ahead`` begins the next chunk."""
    size, n, full = model.longest, len(text), text + ahead[:model.longest - 1]
    out = np.full((size, size), _LOWEST, dtype=np.int64)
    cuts = _cuts(full, n)
    if cuts:
        first, last = cuts[0], cuts[-1]
        middle = sum(encoder.weight(full[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))
        tail = model.lattice(full, last, n, len(full))[0] if last < n else [0]
        tail = np.array((tail[n - last:] + [_LOWEST] * size)[:size])
        for s in range(min(size, first + 1)):
            head = model.lattice(full, s, first, first)[0][-1]
            if head > _LOWEST:
                out[s] = np.where(tail > _LOWEST, tail + head + middle, _LOWEST)
    else:
        for s in range(min(size, n + 1)):
            scores = model.lattice(full, s, n, len(full))[0][n - s:]
            out[s, :len(scores)] = scores[:size]
    return out


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product: the transfer of two neighbouring stretches."""
    out = (a[:, :, None] + b[None, :, :]).max(axis=1)
    out[out < _LOWEST // 2] = _LOWEST
    return out


def chunk_ids(model: Model, encoder: Encoder, text: str, ahead: str, entry: int, exit: int) -> np.ndarray:
    n, full = len(text), text + ahead[:model.longest - 1]
    cuts = _cuts(full, n)
    if not cuts:
        return _ids(_body(model.path(full, entry, n, n + exit)))
    out = [_body(model.path(full, entry, cuts[0], cuts[0]))]
    out += [encoder.word(full[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    return _ids(b"".join([*out, _body(model.path(full, cuts[-1], n, n + exit) if cuts[-1] < n else [])]))


def _states(matrices: list[np.ndarray], entry: int, exit: int) -> list[int]:
    """States between neighbours on a best path from ``entry`` to ``exit``, both included."""
    ahead, vector = [], np.full(len(matrices[0]), _LOWEST, dtype=np.int64)
    vector[entry] = 0
    for m in matrices:
        ahead.append(vector)
        vector = combine(vector[None, :], m)[0]
    out = [exit]
    for m, v in zip(reversed(matrices), reversed(ahead), strict=True):
        out.append(int(np.argmax(v + m[:, out[-1]])))
    return out[::-1]


def _pack(m: np.ndarray) -> bytes:
    return m.astype(np.int64).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    m = np.frombuffer(b, dtype=np.int64)
    return m.reshape(int(math.isqrt(len(m))), -1)


def few(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows, ``rows`` at a time at most."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _decoded(ids: pa.Array, spelled: pa.Array) -> list[str]:
    """The text of every list of ids."""
    flat = spelled.take(ids.flatten())
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    ends = np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset:flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, dtype=np.int64)
    at = ends[np.concatenate([[0], np.cumsum(counts)])]
    raw = memoryview(flat.buffers()[2]) if len(flat) else memoryview(b"")
    return [str(raw[a + 1:b], "utf-8") if b > a else "" for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _giants(docs: DataFrame, shared, s: Settings) -> DataFrame:
    """Ids of the documents over one chunk: doc_id, text_hash, n_chunks, ids."""
    longest = shared.value.longest
    id_kind = docs.schema["doc_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text = normalised(batch.column("text")[k].as_py()).encode("utf-8", "surrogatepass").decode("utf-8", "surrogatepass")
                starts = range(0, len(text), s.chunk)
                rows = [(text[a:a + s.chunk].encode("utf-8", "surrogatepass"), text[a + s.chunk:a + s.chunk + longest - 1].encode("utf-8", "surrogatepass")) for a in starts]
                n = len(rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").slice(k, 1).take(pa.array([0] * n)), batch.column("doc_id").slice(k, 1).take(pa.array([0] * n)),
                    batch.column("text_hash").slice(k, 1).take(pa.array([0] * n)), pa.array(range(n), pa.int32()), pa.array([n] * n, pa.int32()),
                    pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
                    names=["key", "doc_id", "text_hash", "chunk", "chunks", "part", "ahead"])

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text_hash", "text").filter(F.length("text") > s.chunk)
    parts = keyed.mapInArrow(split, f"key long, doc_id {id_kind}, text_hash long, chunk int, chunks int, part binary, ahead binary")
    parts = staged(parts.repartition("key", "chunk"), "giant-chunks")  # the keys are fixed from here on
    plain = lambda b: b.decode("utf-8", "surrogatepass")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, s.cached_words)
        for batch in few(batches, s.together):
            rows = [(plain(p), plain(a)) for p, a in zip(*(batch.column(c).to_pylist() for c in ("part", "ahead")), strict=True)]
            encoder.learn([p for p, _ in rows], weights=True)
            made = [_pack(transfer(shared.value, encoder, p, a)) for p, a in rows]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "block", "chunk")), pa.array(made, pa.binary())], names=["key", "block", "chunk", "m"])

    blocks = parts.withColumn("block", F.floor(F.col("chunk") / s.fan).cast("int"))
    each = staged(blocks.select("key", "block", "chunk", "part", "ahead").mapInArrow(matrices, "key long, block int, chunk int, m binary"), "giant-matrices")

    def product(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        total = None
        for m in map(_unpack, table["m"].to_pylist()):
            total = m if total is None else combine(total, m)
        return pa.table({"key": table["key"].slice(0, 1), "block": table["block"].slice(0, 1), "m": pa.array([_pack(total)], pa.binary())})

    def across(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        states = _states([_unpack(b) for b in table["m"].to_pylist()], 0, 0)
        return pa.table({"key": table["key"], "block": table["block"], "enter": pa.array(states[:-1], pa.int32()), "leave": pa.array(states[1:], pa.int32())})

    def within(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        states = _states([_unpack(b) for b in table["m"].to_pylist()], table["enter"][0].as_py(), table["leave"][0].as_py())
        return pa.table({"key": table["key"], "chunk": table["chunk"], "enter": pa.array(states[:-1], pa.int32()), "leave": pa.array(states[1:], pa.int32())})

    at_blocks = each.groupBy("key", "block").applyInArrow(product, "key long, block int, m binary").groupBy("key").applyInArrow(
        across, "key long, block int, enter int, leave int")
    at_chunks = each.join(at_blocks, ["key", "block"]).groupBy("key", "block").applyInArrow(within, "key long, chunk int, enter int, leave int")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, s.cached_words)
        for batch in few(batches, s.together):
            rows = [(plain(p), plain(a), i, o) for p, a, i, o in zip(*(batch.column(c).to_pylist() for c in ("part", "ahead", "enter", "leave")), strict=True)]
            encoder.learn([r[0] for r in rows], weights=False)
            made = [chunk_ids(shared.value, encoder, *r) for r in rows]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "doc_id", "text_hash", "chunk", "chunks")), pa.array(made, pa.list_(pa.int32()))],
                                             names=["key", "doc_id", "text_hash", "chunk", "chunks", "ids"])

    traced = parts.join(at_chunks, ["key", "chunk"]).select("key", "doc_id", "text_hash", "chunk", "chunks", "part", "ahead", "enter", "leave").mapInArrow(
        trace, f"key long, doc_id {id_kind}, text_hash long, chunk int, chunks int, ids array<int>")
    joined = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"]))
    return traced.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("chunks").alias("n_chunks"), joined.alias("ids")).select(
        "doc_id", "text_hash", "n_chunks", "ids")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, path: str | None = None, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, text_hash, n_chunks, n_tokens, ids) of every row of ``docs``."""
    s = settings
    shared = docs.sparkSession.sparkContext.broadcast(Model(path or default_path()))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, s.cached_words)
        for batch in pieces(batches, "text", 2 << 20):
            ids, offsets = encoder.batch(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(np.ones(len(lists), dtype=np.int32)), lists],
                                             names=["doc_id", "text_hash", "n_chunks", "ids"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("n_chunks", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    usual = docs.filter(F.length("text") <= s.chunk).select("doc_id", "text_hash", "text").mapInArrow(encode, schema)
    both = usual.unionByName(_giants(docs, shared, s))
    return both.select("doc_id", "text_hash", "n_chunks", F.size("ids").cast("long").alias("n_tokens"), "ids")


def decode_documents(encoded: DataFrame, path: str | None = None, name: str = "text", most: int = 1 << 18) -> DataFrame:
    """``encoded`` and the text that its ``ids`` spell, as ``name`` (with underscores before it where that is taken).

    About ``most`` ids are spelled at a time."""
    name = fresh(encoded.columns, name)
    shared = encoded.sparkSession.sparkContext.broadcast(Model(path or default_path()).spelled)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            ids = batch.column("ids")
            ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            k = 0
            while k < batch.num_rows:  # a longer text is alone
                end = max(k + 1, min(k + 512, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + most, side="right"))))
                texts = pa.array(_decoded(ids.slice(k, end - k), spelled), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.slice(k, end - k).columns, texts], names=[*batch.schema.names, name])
                k = end

    return encoded.mapInArrow(decode, T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())]))
