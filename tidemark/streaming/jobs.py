"""Streaming operators; each ``foreachBatch`` writer may be replayed for a batch id."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions import QuotePolicy, quote_block_reasons
from tidemark.operators.keys import latest_per_key
from tidemark.session import stage


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything available now and stop; raises what the query raised."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def gate_quotes_stream(
    quotes: DataFrame, status: DataFrame, broker: DataFrame, policy: QuotePolicy = QuotePolicy(), *,
    key: str = "security_id", delay: str = "10 seconds",
) -> DataFrame:
    """STR-01. Quotes gated by the newest status and broker record near their cutoff.

    ``quotes``: key, cutoff_utc, generated_at_utc, requested_at_utc, received_at_utc,
    quote struct. ``status`` and ``broker``: key and the struct ``market_status`` /
    ``broker_eligibility`` with observed_at_utc. The three are one stream of records; each
    security keeps its open quotes and the records that may still serve one. A quote is
    answered once, when the watermark has passed the last record it may use, so no row is
    multiplied by status or broker records. Rows older than the watermark are not considered.
    """
    base = [key, "cutoff_utc", "generated_at_utc", "requested_at_utc", "received_at_utc", "quote"]
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}

    def records(df: DataFrame, kind: str, at: str, body: Column) -> DataFrame:
        rows = df.select(F.col(key), F.lit(kind).alias("kind"), F.col(at).alias("at"), F.to_json(body, exact).alias("body"))
        return rows.withWatermark("at", delay)

    every = records(quotes.select(*base), "quote", "cutoff_utc", F.struct(*base[1:])).unionByName(
        records(status, "status", "market_status.observed_at_utc", F.struct("market_status"))).unionByName(
        records(broker, "broker", "broker_eligibility.observed_at_utc", F.struct("broker_eligibility")))
    answered = every.groupBy(key).applyInPandasWithState(
        newest_records(key, {"status": policy.status_age, "broker": policy.broker_age}, policy.clock_skew),
        T.StructType([every.schema[key], *[T.StructField(n, T.StringType()) for n in ("quote", "status", "broker")]]),
        "kept binary", "append", GroupStateTimeout.EventTimeTimeout,
    )
    shape = lambda df, names: T.StructType([df.schema[n] for n in names])
    rows = answered.select(
        key, F.from_json("quote", shape(quotes, base[1:]), exact).alias("q"), F.from_json("status", shape(status, ["market_status"]), exact).alias("s"),
        F.from_json("broker", shape(broker, ["broker_eligibility"]), exact).alias("b"),
    ).select(key, "q.*", "s.market_status", "b.broker_eligibility")
    reasons = quote_block_reasons(policy=policy)
    return rows.select(
        key, "cutoff_utc", reasons.alias("block_reasons"),
        F.when(F.size(reasons) == 0, "READY").otherwise("BLOCKED").alias("status"),
    )


def newest_records(key: str, ages: dict[str, int], skew: int) -> Callable:
    """State function of one key: its open quotes, and the status and broker records a quote may still use.

    ``ages``: seconds that a record of each kind may precede a cutoff; ``skew``: seconds it may
    follow one. The state is one row a key; a timeout at the end of the next open quote or of the
    newest record answers and trims it, so a key without traffic keeps nothing. The row is compressed: the
    records of a key repeat their field names, and a whole micro-batch waits for the watermark.
    """
    kinds, reach, second = ("quote", *ages), max(ages.values()), 1_000_000

    def step(key_values: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = json.loads(zlib.decompress(state.get[0])) if state.exists else {kind: [] for kind in kinds}
        for frame in [] if state.hasTimedOut else frames:
            micros = frame["at"].astype("datetime64[us]").astype("int64")
            for kind, at, body in zip(frame["kind"], micros.tolist(), frame["body"], strict=True):
                kept[kind].append([at, body])
        now = 1000 * state.getCurrentWatermarkMs()
        answers = []
        for at, body in [r for r in kept["quote"] if r[0] + skew * second < now]:
            near = [[r for r in kept[kind] if at - ages[kind] * second <= r[0] <= at + skew * second] for kind in ages]
            answers.append((*key_values, body, *[max(rows)[1] if rows else None for rows in near]))
        kept["quote"] = [r for r in kept["quote"] if r[0] + skew * second >= now]
        for kind in ages:
            # no open or later quote looks further back than this
            kept[kind] = [r for r in kept[kind] if r[0] >= now - (skew + ages[kind]) * second]
        ends = [r[0] // 1000 + 1000 * skew + 1 for r in kept["quote"]] or [max(r[0] for k in ages for r in kept[k]) // 1000 + 1000 * (skew + reach) + 1 for _ in "1" if any(kept[k] for k in ages)]
        if ends:
            state.update((zlib.compress(json.dumps(kept, separators=(",", ":")).encode(), 1),))
            state.setTimeoutTimestamp(max(min(ends), now // 1000 + 1))
        elif state.exists:
            state.remove()
        if answers:
            yield pd.DataFrame(answers, columns=[key, "quote", *ages])

    return step


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``path``, or None before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def upsert_batches(
    path: str, keys: Sequence[str], partition: str, order: Sequence[Column], *, late_path: str | None = None,
    time: str | None = None, delay: str = "0 seconds",
) -> Callable[[DataFrame, int], None]:
    """STR-02. ``foreachBatch`` writer that keeps the first row by ``order`` of each key, whatever
    batch it came in, in a table partitioned by ``partition``; among equals the later batch wins,
    so a row delivered twice changes nothing.

    ``partition`` must be a function of ``keys``. Only the partitions a batch touches are
    read, merged, staged and replaced, so the cost follows the delta; a large partition is
    rewritten by several tasks. With ``time`` and ``late_path`` rows more than ``delay`` before
    the newest time of all earlier batches are kept apart under ``late_path``, batch by batch;
    that time is one row a batch in ``late_path``_marks, so a replayed batch decides alike.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if time is not None and late_path is not None:
            batch = stage(batch, "batch")  # read for the mark, the late rows and the rest
            marks = _table(spark, f"{late_path}_marks", T.StructType([T.StructField("newest", batch.schema[time].dataType), T.StructField("batch_id", T.LongType())]))
            mark = marks.filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0] if marks is not None else None
            batch.agg(F.max(time).alias("newest")).withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{late_path}_marks")
            is_late = F.lit(False) if mark is None else F.coalesce(F.col(time) < F.lit(mark) - F.expr(f"interval {delay}"), F.lit(False))
            batch.filter(is_late).write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
            batch = batch.filter(~is_late)
        newest = latest_per_key(batch, keys, order)
        known = _table(spark, path, batch.schema)
        merged = newest
        if known is not None:
            parts = newest.select(F.col(partition).alias("_part")).distinct()
            touched = known.join(parts, F.col(partition).eqNullSafe(F.col("_part")), "left_semi").select(*newest.columns)
            both = touched.withColumn("_delta", F.lit(0)).unionByName(newest.withColumn("_delta", F.lit(1)))
            merged = latest_per_key(both, keys, [*order, F.col("_delta").desc()]).drop("_delta")
        staged = stage(merged, "upsert")
        # rebalancing gathers small partitions and deals a large one to several tasks
        (
            staged.hint("rebalance", F.col(partition)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition).parquet(path)
        )

    return write


def session_stream(events: DataFrame, keys: Sequence[str], time: str, value: str, *, gap: str, delay: str) -> DataFrame:
    """STR-03 with the gap rule only: one row per closed session of a key."""
    return events.withWatermark(time, delay).groupBy(*keys, F.session_window(time, gap).alias("_w")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_at"), F.max(time).alias("last_at"), F.sum(value).alias("total")
    ).drop("_w")


def segment_stream(events: DataFrame, keys: Sequence[str], time: str, price: str, *, gap_seconds: float, ratio: float, expire_seconds: int | None = None, delay: str = "0 seconds", ties: Sequence[str] = ()) -> DataFrame:
    """STR-03 with gap and ratio: the rows with ``segment_break_reason``, ``segment_id`` and ``late``.

    One state row per key, its last time, price and segment, read and written only when the key
    has rows in a batch. A row at or before its key's last time is late: it gets no segment and
    changes nothing; ``ties`` order the rows of one time in a batch. With ``expire_seconds`` a key's state is dropped once the watermark
    (``delay`` behind the newest time) is so far past its last row; the key then starts anew, and
    rows behind the watermark are left out.
    """
    if expire_seconds is not None:
        events = events.withWatermark(time, delay)
    made = [T.StructField("segment_break_reason", T.StringType()), T.StructField("segment_id", T.LongType()), T.StructField("late", T.BooleanType())]
    return events.groupBy(*keys).applyInPandasWithState(
        last_row(time, price, gap_seconds, ratio, expire_seconds, ties), T.StructType([*events.schema.fields, *made]), "at long, price double, segment long", "append",
        GroupStateTimeout.NoTimeout if expire_seconds is None else GroupStateTimeout.EventTimeTimeout,
    )


def last_row(time: str, price: str, gap_seconds: float, ratio: float, expire_seconds: int | None, ties: Sequence[str] = ()) -> Callable:
    """State function of one key for :func:`segment_stream`."""
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known = state.get if state.exists else None
        if known and expire_seconds is not None and known[0] // 1000 + 1000 * expire_seconds <= state.getCurrentWatermarkMs():
            known = None  # rows came with the batch that would have dropped it
        frame = pd.concat(list(frames), ignore_index=True).sort_values([time, *ties], kind="stable", ignore_index=True)
        at = frame[time].astype("datetime64[us]").astype("int64").to_numpy()
        lowest = known[0] if known else np.iinfo(np.int64).min
        late = at <= np.maximum(np.concatenate([[lowest], at[:-1]]), lowest)
        times, prices = at[~late], frame[price].to_numpy(dtype=np.float64)[~late]
        reason, segment = np.full(len(times), None, dtype=object), np.zeros(0, dtype=np.int64)
        if len(times):
            earlier = np.concatenate([[known[0] if known else times[0]], times[:-1]])
            previous = np.concatenate([[known[1] if known and known[1] is not None else np.nan], prices[:-1]])
            with np.errstate(invalid="ignore", divide="ignore"):
                jump = (previous > 0) & (prices > 0) & (np.maximum(prices / previous, previous / prices) >= ratio)
            reason[jump] = "INVALID_PRICE_DISCONTINUITY"
            reason[times - earlier > gap_seconds * 1_000_000] = "SESSION_GAP"
            segment = (known[2] if known else 0) + np.cumsum(reason != None)  # noqa: E711
            state.update((int(times[-1]), float(prices[-1]), int(segment[-1])))
            if expire_seconds is not None:
                state.setTimeoutTimestamp(max(int(times[-1]) // 1000 + 1000 * expire_seconds, state.getCurrentWatermarkMs() + 1))
        frame["segment_break_reason"], frame["segment_id"], frame["late"] = None, pd.array([None] * len(frame), dtype="Int64"), late
        frame.loc[~late, "segment_break_reason"] = reason
        frame.loc[~late, "segment_id"] = segment
        yield frame

    return step


@contextmanager
def state_session(spark: SparkSession, partitions: int | None = None, on_disk: bool = False) -> Iterator[SparkSession]:
    """A session of its own for a stream, in UTC and, where given, with so many state partitions;
    settings of ``spark`` stay as they are. ``on_disk`` keeps the state in RocksDB, with bounded memory,
    for streams whose state grows with a micro-batch."""
    own = spark.newSession()
    if on_disk:
        own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.session.timeZone", "UTC")
    if partitions is not None:
        own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    yield own
