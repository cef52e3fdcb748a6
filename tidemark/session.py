"""Session settings the transforms rely on."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tidemark", master: str | None = None, **conf: object) -> SparkSession:
    """A session with UTC timestamps and adaptive execution (skew joins, coalescing)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Every rule that reads a clock is written for UTC session time."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only where the setting is absent on one machine (tests) a temporary folder is used; on a
    cluster that would leave parts of a table on every executor, so it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.environ.get("TIDEMARK_LOCAL_DIR") or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        os.environ["TIDEMARK_LOCAL_DIR"] = configured
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table under :func:`shared_dir`."""
    import uuid

    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of the jobs inside are removed when each job ends."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stage(df, name: str):
    """Write ``df`` once to the shared folder and read it back; its shuffle files go.

    Cuts the lineage of a table that later steps read more than once; the written files
    outlive any executor.
    """
    path = scratch_table(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a table of our own under ``spark.checkpoint.dir`` that no later step reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def dropped(*tables) -> None:
    """Removes the files of tables that :func:`stage` made and no later step reads."""
    for df in tables:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            discard(df.sparkSession, folder)


def values_table(spark: SparkSession, columns: str, rows: list[tuple]):
    """A fixed list of rows as a local relation, so its size is known to the planner.

    ``columns`` is a DDL list; values are text, numbers, booleans, None or tuples of text.
    """
    def literal(value: object) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, (int, float)):
            return repr(value)
        if isinstance(value, tuple):
            return f"array({', '.join(literal(v) for v in value)})"
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    pairs = [part.split() for part in columns.split(",")]
    body = ", ".join(f"({', '.join(literal(v) for v in row)})" for row in rows)
    casts = ", ".join(f"cast({name} AS {kind}) AS {name}" for name, kind in pairs)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({', '.join(name for name, _ in pairs)})")
