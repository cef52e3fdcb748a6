"""Contract-checked writers (SNK-01 .. SNK-05)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import PRICES, SPLITS, TableContract
from tidemark.operators.quality import contract_rules, duplicate_keys, holds
from tidemark.session import scratch_table

__all__ = [
    "ContractViolation", "conform", "publish", "write_contract", "write_prices", "write_splits", "write_csv_report",
    "write_read_model", "write_metrics_json",
]


class ContractViolation(RuntimeError):
    """A table does not meet its contract; nothing was published. ``broken``: violations by rule."""

    def __init__(self, message: str, broken: Mapping[str, int] | None = None) -> None:
        super().__init__(message)
        self.broken = dict(broken or {})


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Exactly the contract's columns and types, in order; extra columns are an error."""
    extra = sorted(set(df.columns) - set(contract.columns))
    missing = sorted(set(contract.columns) - set(df.columns))
    if extra or missing:
        raise ContractViolation(f"{contract.name}: extra columns {extra}, missing columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.schema.fields])


def _folder(spark: SparkSession, path: str):
    """(file system, Hadoop path) of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that this module has written."""
    files, at = _folder(spark, path)
    files.delete(at, True)


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Put the finished folder ``written`` in the place of ``path``; both on one file system.

    Readers see the old table or the new one. Where a rename is refused, the old table is put back.
    """
    files, new = _folder(spark, written)
    _, place = _folder(spark, path)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.replaced-{uuid.uuid4().hex}")
    replaced = files.exists(place)
    if replaced and not files.rename(place, old):
        raise OSError(f"{path} cannot be replaced")
    if not files.rename(new, place):
        if replaced:
            files.rename(old, place)
        raise OSError(f"{written} cannot be published as {path}")
    if replaced:
        files.delete(old, True)


def write_contract(
    df: DataFrame, contract: TableContract, path: str, *, order: Sequence[str] | None = None,
    partition_by: Sequence[str] = (), checked: bool = True,
) -> DataFrame:
    """SNK-01. Check keys and values, write sorted by key with ZSTD, return the table read back.

    The plan of ``df`` runs once, into a scratch table; the row rules are counted while it is
    written and repeated keys are found among its key columns. Only then is the table sorted
    (range partitions over the key spread a hot leading column; readers skip row groups by key
    range), written beside ``path`` and published by renames. A refused table is never visible.
    """
    spark = df.sparkSession
    rows, scratch = conform(df, contract), scratch_table(spark, contract.name)
    rules = contract_rules(contract) if checked else {}
    counted = Observation()
    rows.observe(counted, F.count(F.lit(1)).alias("rows"), *[F.count_if(holds(r)).alias(name) for name, r in rules.items()]).write.parquet(scratch)
    written = spark.read.schema(contract.schema).parquet(scratch)
    try:
        if checked:
            broken = {name: counted.get[name] for name in rules if counted.get[name]}
            repeated = duplicate_keys(written, contract.key).agg(F.sum(F.col("key_rows") - 1)).first()[0]
            if repeated:
                broken["DUPLICATE_KEY"] = repeated
            if broken:
                raise ContractViolation(f"{contract.name}: {broken}", broken)
        by = list(order or contract.key)
        writer = written.repartitionByRange(*by).sortWithinPartitions(*by).write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        beside = f"{path.rstrip('/')}.written-{uuid.uuid4().hex}"
        writer.parquet(beside)
    finally:
        discard(spark, scratch)
    publish(spark, beside, path)
    return spark.read.schema(contract.schema).parquet(path)


def write_prices(df: DataFrame, path: str, **options: object) -> DataFrame:
    """SNK-02. Bars by (ticker, session_date)."""
    return write_contract(df, PRICES, path, order=("ticker", "session_date"), **options)


def write_splits(df: DataFrame, path: str, **options: object) -> DataFrame:
    """SNK-02. Splits by (ticker, event_date)."""
    return write_contract(df, SPLITS, path, order=("ticker", "event_date"), **options)


def write_csv_report(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """SNK-03. An ordered CSV report; range partitions keep the order across files."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def write_read_model(tables: Mapping[str, DataFrame], directory: str, keys: Mapping[str, Sequence[str]]) -> None:
    """SNK-04. One directory per table, clustered by the table's lookup key."""
    for name, table in tables.items():
        by = keys.get(name)
        rows = table.repartitionByRange(*by).sortWithinPartitions(*by) if by else table
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{directory.rstrip('/')}/{name}")


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """SNK-05. Metric rows as JSON lines (the frames are aggregates of a few rows)."""
    metrics.select(F.to_json(F.struct(*metrics.columns)).alias("value")).write.mode("overwrite").text(path)
