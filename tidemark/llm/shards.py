"""Token shards in training order.

Documents are tokenised and cut into sequences of ``length`` ids. All sequences get consecutive
numbers; a keyed Feistel permutation over the next power of four, walked until it falls inside the
range, gives each its slot in the training order without a table or a sort. Slots are dealt to
shards by range, one task writes one shard of fixed-stride records (``length`` unsigned 16-bit
ids, little endian, padded with the end id), so slot s is at byte ``(s % per_shard) * stride`` of
shard ``s // per_shard`` and reading can resume at any slot.

A shard is written under a name of its own attempt and moved into place, with equal bytes each
time, so repeated or lost tasks leave one whole file. Sequence numbers follow the order in which
the documents were read: ids are written once with task and number in the task, and the totals of
the tasks come from that table, so a task run again meets the same numbers. Shards are written in
``passes`` ranges one after the other, so only one range's records are in the shuffle at a time.

Defined cases: null or empty text has no sequence; repeated rows are sequences each; an empty table
gives no shard.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import discard, staged
from tidemark.llm.words import buffers, mix, pieces
from tidemark.session import scratch_table

END_ID = 50_256


@dataclass(frozen=True)
class Settings:
    length: int = 256
    per_shard: int = 16_384
    key: int = 0x5EED
    rounds: int = 6
    cached_words: int = 400_000
    passes: int = 2


def slots(index: np.ndarray, total: int, key: int, rounds: int) -> np.ndarray:
    """A permutation of 0 .. total - 1, by the key."""
    half = max(1, (max(1, total - 1).bit_length() + 1) // 2)
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        return (left << shift) | right

    out = once(index.astype(np.uint64))
    outside = out >= total
    while outside.any():
        out[outside] = once(out[outside])
        outside = out >= total
    return out.astype(np.int64)


class Tokenizer:
    """Byte-pair ids; a text whose spaces all stand alone is encoded by its distinct words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.most, self.known = most, {}
        self.opens = np.zeros(1 + max(ranks.values(), default=0), dtype=bool)
        self.opens[[i for b, i in ranks.items() if b[:1] == b" "]] = True

    def word(self, word: str) -> list[int]:
        ids = self.known.get(word)
        if ids is None:
            ids = self.encoding.encode_ordinary(word)
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[word] = ids
        return ids

    def spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of all words, each with a space before it. They are encoded as one text, cut again
        at the ids that begin with a space; words that begin or end with white space go alone."""
        alone = [k for k, w in enumerate(words) if w.strip() != w]
        odd = [words[k] for k in alone]
        for k in alone:
            words[k] = "a"
        ids = np.asarray(self.encoding.encode_to_numpy(" " + " ".join(words), disallowed_special=()), dtype=np.uint16) if words else np.zeros(0, dtype=np.uint16)
        first = np.flatnonzero(self.opens[ids])
        length = np.diff(np.append(first, len(ids)))
        if odd:
            rows = np.split(ids, first[1:])
            for k, w in zip(alone, odd, strict=True):
                rows[k] = np.array(self.word(" " + w), dtype=np.uint16)
            ids, length = np.concatenate(rows), np.array([len(r) for r in rows], dtype=np.int64)
        return ids, length

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of all texts. A space between two other characters starts a new pre-token,
        so the words may be encoded apart; texts with more white space around spaces go whole."""
        texts = pc.fill_null(texts, "")
        odd = np.zeros(len(texts), dtype=bool)
        for pair in ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r "):
            odd |= pc.match_substring(texts, pair).to_numpy(zero_copy_only=False)
        odd |= pc.starts_with(texts, " ").to_numpy(zero_copy_only=False) | pc.ends_with(texts, " ").to_numpy(zero_copy_only=False)
        raw, bounds = buffers(texts)
        rare = np.flatnonzero((raw == 11) | (raw == 12) | ((raw >= 28) & (raw <= 31)) | (raw == 194) | ((raw >= 225) & (raw <= 227)))  # other white space may follow
        odd[np.searchsorted(bounds, rare, side="right") - 1] = True
        usual = np.flatnonzero(~odd & (np.diff(bounds) > 0))
        lists = pc.split_pattern(texts.take(pa.array(usual)), " ")
        counts = np.zeros(len(texts), dtype=np.int64)
        counts[usual] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(counts)])
        heads = ends[:-1][counts > 0]
        plain, at_head = np.unique(codes[heads], return_inverse=True) if len(heads) else (heads, heads)
        made = [self.word(words[c]) for c in plain.tolist()]  # the first word has no space
        codes[heads] = len(words) + at_head
        flat, length = self.spaced(words)
        length = np.concatenate([length, np.fromiter(map(len, made), dtype=np.int64, count=len(made))])
        flat = np.concatenate([flat, np.fromiter(chain.from_iterable(made), dtype=np.uint16)])
        per = length[codes] if len(codes) else codes
        before = np.concatenate([[0], np.cumsum(per)]).astype(np.int64)
        first = np.cumsum(length) - length
        ids = flat[np.arange(before[-1]) - np.repeat(before[:-1], per) + np.repeat(first[codes], per)] if len(codes) else flat
        offsets = before[ends]
        strange = np.flatnonzero(odd)
        if len(strange):
            rows = [ids[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
            for k in strange.tolist():
                rows[k] = np.array(self.encoding.encode_ordinary(texts[k].as_py()), dtype=np.uint16)
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
            ids = np.concatenate(rows)
        return ids, offsets


_kept: dict[str, Tokenizer] = {}


def _tokenizer(shared, name: str, most: int) -> Tokenizer:
    """The worker's tokenizer; a worker that Spark uses again has its words at hand."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = Tokenizer(*shared.value, most)
    return _kept[name]


def _ranks(path: str | None) -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken")) as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}, public_tokenizers.PATTERN


def materialise(docs: DataFrame, folder: str, encoded: str, path: str | None = None, settings: Settings = Settings()) -> DataFrame:
    """Write the shards under ``folder``; returns doc_id, part, n_tokens, slot, shard, offset, stored.

    ``stored`` tells whether the record read back from the shard has the bytes that were to be written.
    The ids are kept in a table at ``encoded`` until the shards are written: texts are tokenised once.
    Every pass reads that table and deals the records of its own shards; its rows are a stored table.
    """
    s = settings
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_ranks(path))
    docs = docs.select("doc_id", "text")

    kind = docs.schema["doc_id"].dataType.simpleString()
    name = f"{path}-{uuid.uuid4().hex}"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidemark.llm.shards import _tokenizer

        tokenizer, task, at = _tokenizer(shared, name, s.cached_words), TaskContext.get().partitionId(), 0
        for batch in pieces(batches, "text", 4 << 20):
            ids, offsets = tokenizer.batch(batch.column("text"))
            n = -(-np.diff(offsets) // s.length)
            first = at + np.cumsum(n) - n
            at += int(n.sum())
            some = np.flatnonzero(n > 0)
            raw = memoryview(ids.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(some)), pa.array(np.full(len(some), task, dtype=np.int32)), pa.array(first[some]), pa.array(n[some]),
                pa.array([raw[2 * a:2 * b] for a, b in zip(offsets[some].tolist(), offsets[some + 1].tolist(), strict=True)], pa.binary())],
                names=["doc_id", "task", "first", "sequences", "ids"])

    schema = f"doc_id {kind}, task int, first long, sequences long, ids binary"
    docs.mapInArrow(encode, schema).write.option("compression", "zstd").parquet(encoded)
    coded = spark.read.schema(schema).parquet(encoded)
    counted = coded.groupBy("task").agg(F.sum("sequences").alias("n")).toArrow().to_pydict()  # one row a task
    found = dict(zip(counted["task"], counted["n"], strict=True))
    before, total = {}, 0
    for task in sorted(found):
        before[task] = total
        total += found[task]
    places = spark.sparkContext.broadcast(before)

    def place(batches: Iterator[pa.RecordBatch], low: int, high: int) -> Iterator[pa.RecordBatch]:
        before = places.value
        for batch in pieces(batches, "ids", 1 << 20):
            raw, bounds = buffers(batch.column("ids"))
            ids, sizes_of = np.ascontiguousarray(raw[bounds[0]:bounds[-1]]).view("<u2"), np.diff(bounds) // 2
            n = batch.column("sequences").to_numpy(zero_copy_only=False)
            rows = int(n.sum())
            start = np.cumsum(n) - n  # first sequence of each text
            data = np.full(rows * s.length, END_ID, dtype="<u2")
            place, size = (start * s.length).tolist(), sizes_of.tolist()
            at = 0
            for k, own in zip(place, size, strict=True):
                data[k:k + own] = ids[at:at + own]
                at += own
            data = data.reshape(rows, s.length)
            sizes = np.full(rows, s.length, dtype=np.int32)
            sizes[start + n - 1] = sizes_of - (n - 1) * s.length
            head = np.fromiter((before[t] for t in batch.column("task").to_pylist()), dtype=np.int64, count=len(n)) + batch.column("first").to_numpy(zero_copy_only=False)
            part = np.arange(rows) - np.repeat(start, n)
            slot = slots(np.repeat(head, n) + part, total, s.key, s.rounds)
            shard = slot // s.per_shard
            own = np.flatnonzero((shard >= low) & (shard < high))
            ends = pa.py_buffer(np.arange(len(own) + 1, dtype=np.int32) * (2 * s.length))
            records = pa.Array.from_buffers(pa.binary(), len(own), [None, ends, pa.py_buffer(data[own])])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(n)), n)[own])), pa.array(part[own].astype(np.int32)), pa.array(sizes[own]),
                pa.array(slot[own]), pa.array(shard[own].astype(np.int32)), records],
                names=["doc_id", "part", "n_tokens", "slot", "shard", "record"])

    stride = 2 * s.length

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        system.create_dir(root, recursive=True)
        stream, shard, name, kept = None, None, None, []

        def close() -> Iterator[pa.RecordBatch]:
            stream.close()
            final = f"{root}/shard-{shard:08d}.bin"
            system.move(name, final)
            with system.open_input_file(final) as back:
                there = np.frombuffer(back.read(), dtype=np.uint8)
            there = there[:len(there) // stride * stride].reshape(-1, stride)
            for meta, records in kept:
                place = meta.column("slot").to_numpy() % s.per_shard
                ok = place < len(there)
                ok[ok] = (there[place[ok]] == records[ok]).all(axis=1)
                yield pa.RecordBatch.from_arrays([*meta.columns, pa.array(place * stride, pa.int64()), pa.array(ok, pa.bool_())], names=[*meta.schema.names, "offset", "stored"])
            kept.clear()

        for batch in batches:
            own = batch.column("shard").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if shard != own[a]:
                    if stream is not None:
                        yield from close()
                    shard, name = int(own[a]), f"{root}/.{uuid.uuid4().hex}"
                    stream = system.open_output_stream(name)
                rows = batch.slice(a, b - a)
                raw, bounds = buffers(rows.column("record"))
                records = raw[bounds[0]:bounds[-1]].reshape(-1, stride).copy()
                stream.write(records)
                kept.append((rows.select(["doc_id", "part", "n_tokens", "slot", "shard"]), records))
        if stream is not None:
            yield from close()

    shards = max(1, -(-total // s.per_shard))
    passes = min(s.passes, shards)
    cuts = [shards * k // passes for k in range(passes + 1)]

    def written(low: int, high: int) -> DataFrame:
        placed = coded.mapInArrow(lambda batches: place(batches, low, high), f"doc_id {kind}, part int, n_tokens int, slot long, shard int, record binary")
        dealt = placed.repartitionById(high - low, F.col("shard") - low).sortWithinPartitions("slot")
        return staged(dealt.mapInArrow(write, f"doc_id {kind}, part int, n_tokens int, slot long, shard int, offset long, stored boolean"), "token-manifest")

    return reduce(DataFrame.unionByName, [written(low, high) for low, high in zip(cuts, cuts[1:], strict=False)])


def read_from(folder: str, slot: int, settings: Settings = Settings()) -> Iterator[np.ndarray]:
    """Sequences in training order from ``slot`` on, without reading what comes before it."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    stride, shard = 2 * settings.length, slot // settings.per_shard
    while system.get_file_info(f"{root}/shard-{shard:08d}.bin").type == fs.FileType.File:
        with system.open_input_file(f"{root}/shard-{shard:08d}.bin") as data:
            at = (slot % settings.per_shard) * stride
            while record := data.read_at(stride, at):
                yield np.frombuffer(record, dtype="<u2")
                at += stride
                slot += 1
        shard += 1


def training_order(docs: DataFrame, folder: str | None = None, path: str | None = None, settings: Settings = Settings()) -> DataFrame:
    """The shards of ``docs`` written in the shared folder, and their manifest as a stored table."""
    spark = docs.sparkSession
    encoded = scratch_table(spark, "token-ids")
    manifest = materialise(docs, folder or scratch_table(spark, "token-shards"), encoded, path, settings)
    discard(spark, encoded)
    return manifest
