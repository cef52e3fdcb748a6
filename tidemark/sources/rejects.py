"""Malformed records of landed files, kept apart instead of read as partial rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["Rejects", "read_delimited", "read_documents"]

CORRUPT = "_corrupt_record"
REJECT_SCHEMA = "reader string, source_file string, record string, fields_read int"


class Rejects:
    """Collects what readers could not parse; readers given none drop nothing and mark nothing."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.frames: list[DataFrame] = []

    def add(self, reader: str, raw: DataFrame) -> None:
        read = [F.col(f"`{c}`").isNotNull() for c in raw.columns if c != CORRUPT]
        # Spark asks for a data column in the scan beside the record; this test keeps them all
        scanned = F.concat_ws(",", *[c.cast("string") for c in read]) != ""
        fields = [c.cast("int") for c in read]
        self.frames.append(raw.filter(F.col(CORRUPT).isNotNull() & scanned).select(
            F.lit(reader).alias("reader"), F.input_file_name().alias("source_file"), F.col(CORRUPT).alias("record"), sum(fields[1:], fields[0]).alias("fields_read")))

    def frame(self) -> DataFrame:
        """(reader, source_file, record, fields_read) of every malformed record."""
        out = self.spark.createDataFrame([], REJECT_SCHEMA)
        for frame in self.frames:
            out = out.unionByName(frame)
        return out


def _schema(schema: T.StructType | str | Sequence[str]) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    if isinstance(schema, str):
        return T.StructType.fromDDL(schema)
    return T.StructType([T.StructField(c, T.StringType()) for c in schema])


def _read(reader, kind: str, path: str, schema, name: str, rejects: Rejects | None) -> DataFrame:
    wanted = _schema(schema)
    if rejects is None:
        return getattr(reader.schema(wanted), kind)(path)
    raw = getattr(
        reader.schema(wanted.add(CORRUPT, T.StringType()) if CORRUPT not in wanted.fieldNames() else wanted)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT), kind)(path)
    rejects.add(name, raw)
    return raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str, name: str, rejects: Rejects | None = None) -> DataFrame:
    """Text columns of a delimited file with a header; with ``rejects`` lines of another width go there."""
    # a line's width is only seen when all of its columns are parsed
    reader = spark.read.option("sep", sep).option("header", True).option("enforceSchema", False).option("columnPruning", rejects is None)
    return _read(reader, "csv", path, list(columns), name, rejects)


def read_documents(spark: SparkSession, path: str, schema: str | Sequence[str], name: str, rejects: Rejects | None = None, lines: bool = False) -> DataFrame:
    """JSON documents, one or an array per file, or one per line; with ``rejects`` malformed ones go there."""
    return _read(spark.read.option("multiLine", not lines), "json", path, schema, name, rejects)
