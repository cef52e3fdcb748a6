"""Helpers on DataFrames shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import pieces
from tidemark.session import discard, dropped, freed_shuffles, scratch_table  # noqa: F401

def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under ``spark.checkpoint.dir`` and read back; its shuffle files go."""
    spark = df.sparkSession
    path = scratch_table(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def likely(df: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among those of ``chosen``: all that are, and few others.

    The keys are marked in 2^24 bits (2 MB at most, whatever the input), so that a join on
    ``key`` need not shuffle rows that have no partner.
    """
    spot = F.pmod(F.xxhash64(key), F.lit(1 << 24))
    block, place = F.shiftright(spot, 15), spot.bitwiseAND(F.lit(32_767))
    marks = chosen.select(block.alias("_block"), place.alias("_place")).groupBy("_block").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    marked = df.withColumn("_block", block).withColumn("_place", place.cast("int")).join(F.broadcast(marks), "_block")
    byte = F.conv(F.hex(F.expr("substring(_bits, _place DIV 8 + 1, 1)")), 16, 10).cast("int")
    return marked.withColumn("_byte", byte).filter("(shiftright(_byte, _place % 8) & 1) = 1").select(*df.columns)


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores before it until no column is called so (letter case aside)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def with_text_columns(df: DataFrame, text: str, fields: list[T.StructField], function: Callable[[pa.Array], list[pa.Array]], most: int = 4 << 20) -> DataFrame:
    """All columns of ``df`` and the columns that ``function`` makes of about ``most`` bytes of its texts at a time."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, most):
            made = function(batch.column(text))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *names])

    names = [f.name for f in fields]
    return df.mapInArrow(add, T.StructType([*df.schema.fields, *fields]))


def held_out(doc_id: str | Column, of: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder`` when divided by ``of``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % of == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents, chosen by a hash of the id.

    ``keep`` is a condition on the label's ``doc_id``. Rows without an id or label are left
    out; a document labelled twice counts with the larger label. The chosen ids are broadcast:
    ``rows`` is their bound.
    """
    chosen = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna().filter(keep).groupBy("doc_id").agg(
        F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text")).select(
        "doc_id", "text", "label")
