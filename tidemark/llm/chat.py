"""Chat formatting with typed content parts.

A visitor (one function per kind of part) flattens the parts of a turn, in order, into text and
placeholders, and records each attachment with its reference and the number of tokens that its
placeholder will be expanded to. A turn is written as::

    <|im_start|>ROLE
    CONTENT<|im_end|>

Inside texts and roles a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold a
control string, and one pattern undoes it. Turns stay one row each, so a conversation of any length
is never gathered; the digest of a conversation is fed turn by turn from sorted rows.

Defined cases: null text and null role count as empty; turns with equal numbers follow their role,
then their text; a null conversation id is a conversation of its own; repeated rows are turns each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<kind:string,text:string,ref:string,units:bigint>"

#: Units that one token stands for: pixels of an image, milliseconds of audio, characters of a document.
UNITS_PER_TOKEN = {"image": 28 * 28, "audio": 40, "document": 4}


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<|line|>"))


def _unrole(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|line|>"), F.lit("\n")))


def _text(part: Column) -> Column:
    return escape(F.coalesce(part["text"], F.lit("")))


def _attachment(part: Column) -> Column:
    return F.concat(F.lit("<|"), part["kind"], F.lit("|>"))


#: The visitor: how each kind of part is written. Other kinds are refused.
VISIT: dict[str, Callable[[Column], Column]] = {"text": _text, **{kind: _attachment for kind in UNITS_PER_TOKEN}}


def flatten_parts(parts: Column) -> tuple[Column, Column]:
    """(content, attachments): the written parts, and an ordered array of (ordinal, kind, ref, tokens)."""
    def write(part: Column) -> Column:
        out = F.raise_error(F.concat(F.lit("unknown kind of part: "), F.coalesce(part["kind"], F.lit("null")))).cast("string")
        for kind, visit in VISIT.items():
            out = F.when(part["kind"] == kind, visit(part)).otherwise(out)
        return out

    def tokens(part: Column) -> Column:
        out = F.lit(0)
        for kind, units in UNITS_PER_TOKEN.items():
            out = F.when(part["kind"] == kind, F.greatest(F.lit(1), F.ceil(F.coalesce(part["units"], F.lit(0)) / units))).otherwise(out)
        return out.cast("long")

    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    attached = F.transform(F.filter(parts, lambda p: p["kind"] != "text"), lambda p, i: F.struct(
        (i + 1).alias("ordinal"), p["kind"].alias("kind"), p["ref"].alias("ref"), tokens(p).alias("tokens")))
    return F.array_join(F.transform(parts, write), ""), attached


def text_part(text: Column) -> Column:
    """A plain text as a list of one part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units")))


def format_turns(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """One row per turn: conv_id, turn, formatted, loss_start and loss_length (code points of
    ``formatted`` that are learned: the content of an assistant's turn), attachments."""
    content, attached = flatten_parts(F.col(parts))
    role = F.coalesce("role", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), content.alias("content"), attached.alias("attachments"))
    head = F.concat(F.lit(START), _role(F.col("role")), F.lit("\n"))
    return rows.select(
        "conv_id", "turn", F.concat(head, "content", F.lit(f"{END}\n")).alias("formatted"),
        F.length(head).cast("long").alias("loss_start"), F.when(F.col("role") == "assistant", F.length("content")).otherwise(0).cast("long").alias("loss_length"),
        "attachments",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, loss_text and formatted_chars, parsed from the formatted turns."""
    whole = r"(?s)^<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n$"
    loss = F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_length"))
    return formatted.select(
        "conv_id", "turn", _unrole(F.regexp_extract("formatted", whole, 1)).alias("role"), unescape(F.regexp_extract("formatted", whole, 2)).alias("text"),
        unescape(loss).alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Rows of a conversation arrive in order and are hashed one by one; nothing is kept but the state.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        current, state, out = None, None, []

        def close() -> None:
            key, n, whole, chars, loss, size = state
            out.append((key, n, whole.hexdigest(), chars, loss.hexdigest(), size))

        def emit() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], pa.int64()), pa.array(columns[2]), pa.array(columns[3], pa.int64()),
                                               pa.array(columns[4]), pa.array(columns[5], pa.int64())], names=names)

        kind = None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for key, role, text, loss, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss_text", "formatted_chars")), strict=True):
                if state is None or key != current:
                    if state is not None:
                        close()
                    current, state = key, [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += size
            if len(out) > 5000:
                yield emit()
        if state is not None:
            close()
        if out:
            yield emit()

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text", "loss_text", "formatted_chars")
    schema = T.StructType([turns.schema["conv_id"], *(T.StructField(n, t) for n, t in (
        ("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType())))])
    return ordered.mapInArrow(digest, schema)
