"""Streaming operators over the event table as a file stream of several micro-batches.

Each run lands the events in a private folder under the shared checkpoint folder, in four
batches by time; every ``every``-th event of the first batch comes with the last one, late.
Streams run in sessions of their own, so settings of the caller's session stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import Tables, listed, naive, query
from tidemark.catalog.gates import every_quote_rule, quotes
from tidemark.functions import QuotePolicy
from tidemark.session import scratch_table
from tidemark.streaming import gate_quotes_stream, run_available, segment_stream, session_stream, state_session, upsert_batches

BATCHES, LATE = 4, 50

# batch that an event arrives with, and whether it belongs to an earlier one
ARRIVAL = f"""arrival AS (SELECT e.*, part, CASE WHEN part = 0 AND event_id % {LATE} = 0 THEN {BATCHES - 1} ELSE part END AS batch FROM (
  SELECT *, (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * {BATCHES} // ((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) FROM events) + 1) AS part FROM events) e)"""


def arrivals(t: Tables) -> DataFrame:
    """The events with ``part`` (quarter of the time span) and ``batch`` (arrival)."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = t.events.agg(F.min(micros), F.max(micros)).first()
    part = F.call_function("div", (micros - F.lit(lo or 0)) * BATCHES, F.lit((hi or 0) - (lo or 0) + 1))
    return t.events.withColumn("part", part).withColumn("batch", F.when((F.col("part") == 0) & (F.col("event_id") % LATE == 0), BATCHES - 1).otherwise(F.col("part")))


def land(t: Tables, name: str) -> str:
    """Folder with the events, one set of files a batch, in order of arrival."""
    path, rows = scratch_table(t.spark, name), arrivals(t)
    for k in range(BATCHES):
        rows.filter(F.col("batch") == k).drop("part", "batch").coalesce(1).write.mode("append").parquet(path)
    return path


def event_batches(t: Tables, spark: SparkSession | None = None) -> DataFrame:
    """The events as a stream of ``BATCHES`` micro-batches."""
    path = land(t, "events-in")
    schema = t.spark.read.parquet(path).schema
    return (spark or t.spark).readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def cores(t: Tables) -> int:
    """State stores are written per shuffle partition: one per core serves these streams."""
    return min(int(t.spark.conf.get("spark.sql.shuffle.partitions")), t.spark.sparkContext.defaultParallelism)


_KEPT = f"""{ARRIVAL}, marks AS (SELECT *, (SELECT max(ts) FROM arrival b WHERE b.batch < a.batch) AS mark FROM arrival a),
judged AS (SELECT *, coalesce(ts < mark - INTERVAL 1 DAY, false) AS late FROM marks)"""


def _upserted(t: Tables) -> tuple[str, str]:
    out, late, log = (scratch_table(t.spark, n) for n in ("upsert-table", "upsert-late", "upsert-log"))
    with state_session(t.spark, cores(t)) as own:
        delta = event_batches(t, own).select("user_id", F.to_date("ts").alias("session_date"), "event_id", "value", "ts")
        # every row is delivered twice
        twice = delta.unionByName(delta)
        writer = upsert_batches(out, ["user_id", "session_date"], "session_date", [F.col("event_id").desc()], late_path=late, time="ts", delay="1 day")
        run_available(twice.writeStream.foreachBatch(writer), log)
    return out, late


@query("streaming_upsert", f"""WITH {_KEPT} SELECT user_id, CAST(ts AS DATE) AS session_date, event_id, value FROM judged WHERE NOT late
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) = 1""")
def streaming_upsert(t: Tables) -> DataFrame:
    """STR-02: the last event of each (user, day) kept in a table partitioned by day; late rows are kept apart."""
    return t.spark.read.parquet(_upserted(t)[0]).select("user_id", "session_date", "event_id", "value")


@query("streaming_late_rows", f"WITH {_KEPT} SELECT event_id, user_id, value, CAST(count(*) * 2 AS BIGINT) AS deliveries FROM judged WHERE late GROUP BY ALL")
def streaming_late_rows(t: Tables) -> DataFrame:
    """STR-02: the late-rows sink of :func:`streaming_upsert`."""
    return t.spark.read.parquet(_upserted(t)[1]).groupBy("event_id", "user_id", "value").agg(F.count(F.lit(1)).alias("deliveries"))


@query("streaming_segments", f"""WITH {ARRIVAL}, r AS (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY batch, ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM arrival),
late AS (SELECT event_id FROM r WHERE ts <= seen), kept AS (SELECT * FROM arrival WHERE event_id NOT IN (FROM late)),
p AS (SELECT *, lag(ts) OVER w AS pt, lag(value) OVER w AS pv FROM kept WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
b AS (SELECT *, CASE WHEN pt IS NOT NULL AND epoch_us(ts) - epoch_us(pt) > 86400000000 THEN 'SESSION_GAP' WHEN value > 0 AND pv > 0 AND greatest(value / pv, pv / value) >= 50 THEN 'INVALID_PRICE_DISCONTINUITY' END AS segment_break_reason FROM p)
SELECT event_id, user_id, segment_break_reason, CAST(sum(CASE WHEN segment_break_reason IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id, false AS late FROM b
UNION ALL SELECT event_id, user_id, NULL, NULL, true FROM arrival WHERE event_id IN (FROM late)""")
def streaming_segments(t: Tables) -> DataFrame:
    """STR-03 with gap and ratio, late rows marked; of rows of one time the smallest event is kept."""
    out, log = scratch_table(t.spark, "segments-out"), scratch_table(t.spark, "segments-log")
    with state_session(t.spark, cores(t)) as own:
        rows = event_batches(t, own).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
        cut = segment_stream(rows, ["user_id"], "ts", "value", gap_seconds=86_400, ratio=50.0, ties=["event_id"])
        run_available(cut.writeStream.format("parquet").option("path", out).outputMode("append"), log)
    return t.spark.read.parquet(out).select("event_id", "user_id", "segment_break_reason", "segment_id", "late")


@query("streaming_sessions", f"""WITH {ARRIVAL}, kept AS (SELECT * FROM arrival WHERE part = batch), p AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS pt FROM kept),
s AS (SELECT *, sum(CASE WHEN pt IS NULL OR epoch_us(ts) - epoch_us(pt) >= 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM p)
SELECT user_id, count(*) AS rows, min(ts) AS first_at, max(ts) AS last_at, round(sum(value), 4) AS total FROM s GROUP BY user_id, sid
HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def streaming_sessions(t: Tables) -> DataFrame:
    """STR-03 with the gap rule: sessions the watermark has closed; rows behind it are left out."""
    out, log = scratch_table(t.spark, "sessions-out"), scratch_table(t.spark, "sessions-log")
    with state_session(t.spark, cores(t)) as own:
        rows = event_batches(t, own).select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
        closed = session_stream(rows, ["user_id"], "ts", "value", gap="6 hours", delay="1 hour")
        run_available(closed.writeStream.format("parquet").option("path", out).outputMode("append"), log)
    return t.spark.read.parquet(out).select("user_id", "rows", naive("first_at"), naive("last_at"), F.round("total", 4).alias("total"))


_GATED = ARRIVAL + """, q AS (SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, ts FROM arrival WHERE part = batch),
st AS (SELECT q.event_id, arg_max(s.k, s.at) AS sk FROM q JOIN (SELECT user_id, k, ts - CASE WHEN k = 54 THEN INTERVAL 7 SECOND ELSE INTERVAL 0 SECOND END AS at FROM q) s ON s.user_id = q.user_id AND s.at BETWEEN q.ts - INTERVAL 5 SECOND AND q.ts + INTERVAL 2 SECOND GROUP BY 1),
br AS (SELECT q.event_id, arg_max(b.k, b.at) AS bk, max(b.at) AS bat FROM q JOIN (SELECT user_id, k, ts - CASE WHEN k = 58 THEN INTERVAL 400 SECOND ELSE INTERVAL 0 SECOND END AS at FROM q) b ON b.user_id = q.user_id AND b.at BETWEEN q.ts - INTERVAL 300 SECOND AND q.ts + INTERVAL 2 SECOND GROUP BY 1),
f AS (SELECT q.*, list_sort(list_filter([
  CASE WHEN event_type = 'error' THEN 'UNACCEPTABLE_QUOTE_FEED' END, CASE WHEN event_type = 'signup' THEN 'QUOTE_UNAVAILABLE' END, CASE WHEN event_type <> 'signup' AND k = 7 THEN 'UNKNOWN_MARKET_SESSION' END,
  CASE WHEN event_type <> 'signup' AND k < 10 THEN 'CROSSED_MARKET' END, CASE WHEN event_type <> 'signup' AND ((value * (1 + (k - 10) / 1000)) - value) / (((value * (1 + (k - 10) / 1000)) + value) / 2) * 10000 > 500 THEN 'SPREAD_TOO_WIDE' END,
  CASE WHEN event_type <> 'signup' AND k - 3 < 0 THEN 'NEGATIVE_BID_SIZE' END, CASE WHEN event_type <> 'signup' AND k > 90 THEN 'STALE_QUOTE' END, CASE WHEN event_type <> 'signup' AND k = 90 THEN 'QUOTE_AFTER_CUTOFF' END,
  CASE WHEN event_type <> 'signup' AND k = 90 THEN 'QUOTE_AFTER_SNAPSHOT' END, CASE WHEN sk = 50 THEN 'SECURITY_HALTED' END, CASE WHEN sk = 51 OR sk IS NULL THEN 'HALT_STATUS_UNKNOWN' END, CASE WHEN sk = 52 THEN 'LULD_PAUSED' END,
  CASE WHEN sk = 53 OR sk IS NULL THEN 'LULD_STATUS_UNKNOWN' END, CASE WHEN sk IS NULL THEN 'STALE_MARKET_STATUS' END, CASE WHEN sk = 55 THEN 'INVALID_LULD_BANDS' END, CASE WHEN bk = 56 OR bk IS NULL THEN 'BROKER_INELIGIBLE_OR_UNKNOWN' END,
  CASE WHEN bk = 57 OR bk IS NULL THEN 'INVALID_BROKER_REASON_CODES' END, CASE WHEN bk IS NULL THEN 'STALE_BROKER_ELIGIBILITY' END, CASE WHEN bat > ts + INTERVAL 1 SECOND THEN 'BROKER_STATUS_AFTER_SNAPSHOT' END,
  CASE WHEN k = 59 THEN 'RESPONSE_PRECEDES_REQUEST' END, CASE WHEN k = 60 THEN 'RESPONSE_AFTER_SNAPSHOT' END], lambda x: x IS NOT NULL)) AS reasons FROM q LEFT JOIN st USING (event_id) LEFT JOIN br USING (event_id))"""


@query("streaming_quotes", f"WITH {every_quote_rule(_GATED)} SELECT user_id AS security_id, ts AS cutoff_utc, array_to_string(reasons, '|') AS block_reasons, CASE WHEN len(reasons) = 0 THEN 'READY' ELSE 'BLOCKED' END AS status FROM f WHERE ts <= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTE")
def streaming_quotes(t: Tables) -> DataFrame:
    """STR-01: quotes, status and broker records as three streams; records behind the watermark are left out.

    Quotes within fifteen minutes of the newest event are still open behind the watermark.
    """
    out, log = scratch_table(t.spark, "quotes-out"), scratch_table(t.spark, "quotes-log")
    with state_session(t.spark, cores(t), on_disk=True) as own:
        class Streamed(Tables):
            events = event_batches(t, own)

        rows = quotes(Streamed(own, t.directory))
        gated = gate_quotes_stream(
            rows.select("security_id", "cutoff_utc", "generated_at_utc", "requested_at_utc", "received_at_utc", "quote"),
            rows.select("security_id", "market_status"), rows.select("security_id", "broker_eligibility"), QuotePolicy(spread_bps=500.0),
        )
        run_available(gated.writeStream.format("parquet").option("path", out).outputMode("append"), log)
    newest = t.events.agg(F.max(F.col("ts").cast("timestamp")).alias("newest")).first()["newest"]
    closed = t.spark.read.parquet(out).filter(F.col("cutoff_utc") <= F.lit(newest) - F.expr("interval 15 minutes"))
    return closed.select("security_id", naive("cutoff_utc"), listed("block_reasons").alias("block_reasons"), "status")
