"""Streaming writers over several micro-batches against the batch operators."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.test_gates import quote_frame, quote_row
from tidemark.catalog.streams import event_batches
from tidemark.operators.segments import segment_history
from tidemark.streaming import gate_quotes_stream, run_available, segment_stream, upsert_batches


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def write_batches(df, path, column, batches):
    for b in batches:
        df.filter(F.col(column) == b).drop(column).coalesce(1).write.mode("append").parquet(path)


def test_upsert_batches(spark, tmp_path, rows):
    t0 = datetime(2026, 7, 1)
    data = [(1, "a", "d1", 1.0, 1, 0), (1, "b", "d1", 2.0, 2, 5), (2, "a", "d1", 9.0, 3, 4), (2, "a", "d2", 3.0, 4, 9), (2, "b", "d1", 7.0, 3, 1), (3, "b", "d1", 0.5, 9, 6), (3, "c", "d3", 7.0, 5, 8), (3, "c", "d3", 8.0, 6, 7)]
    df = spark.createDataFrame([(*r[:5], t0 + timedelta(hours=r[5])) for r in data], "batch int, key string, day string, value double, version int, at timestamp")
    src, out, late = (str(tmp_path / n) for n in ("in", "table", "late"))
    write_batches(df, src, "batch", [1, 2, 3])
    once = stream(spark, src, df.drop("batch").schema)
    writer = upsert_batches(out, ["key", "day"], "day", [F.col("version").desc()], late_path=late, time="at", delay="2 hours")
    run_available(once.unionByName(once).writeStream.foreachBatch(writer), str(tmp_path / "log"))
    # hours 1 and 6 come after hours 5 and 9 were seen, more than two hours late; delivered twice, kept twice
    assert rows(spark.read.parquet(out).select("key", "day", "value")) == [("a", "d1", 9.0), ("a", "d2", 3.0), ("b", "d1", 2.0), ("c", "d3", 8.0)]
    assert rows(spark.read.parquet(late).select("key", "value")) == [("b", 0.5), ("b", 0.5), ("b", 7.0), ("b", 7.0)]
    before = rows(spark.read.parquet(out))
    writer(df.filter("batch = 3").drop("batch"), 2)  # a replayed batch decides alike
    assert rows(spark.read.parquet(out)) == before and spark.read.parquet(late).filter("batch_id = 2").count() == 1


def test_upsert_batches_keep_the_newest_row_of_all_batches(spark, tmp_path, rows):
    data = [(1, "a", "d1", 5.0, 5), (1, "n", None, 1.0, 1), (2, "a", "d1", 3.0, 3), (2, "m", None, 2.0, 2), (2, "b", "d1", 1.0, 1), (3, "b", "d1", 2.0, 2), (4, "b", "d1", 9.0, 2), (4, "a", "d1", 4.0, 4)]
    df = spark.createDataFrame(data, "batch int, key string, day string, value double, version int")
    src, out = (str(tmp_path / n) for n in ("in", "table"))
    write_batches(df, src, "batch", [1, 2, 3, 4])
    writer = upsert_batches(out, ["key", "day"], "day", [F.col("version").desc()])
    run_available(stream(spark, src, df.drop("batch").schema).writeStream.foreachBatch(writer), str(tmp_path / "log"))
    assert rows(spark.read.parquet(out).select("key", "day", "value")) == [("a", "d1", 5.0), ("b", "d1", 9.0), ("m", None, 2.0), ("n", None, 1.0)]


def test_the_upsert_query_runs_several_batches(spark, tables, tmp_path):
    seen = []
    run_available(event_batches(tables).writeStream.foreachBatch(lambda batch, k: seen.append(batch.count())), str(tmp_path / "log"))
    assert len(seen) == 4 and all(seen) and sum(seen) == tables.events.count()  # noqa: PT018


def test_the_state_of_open_quotes_is_small_and_on_disk(spark):
    import json

    import pandas as pd

    from tidemark.streaming import state_session
    from tidemark.streaming.jobs import newest_records

    class State:
        exists = hasTimedOut = False

        def getCurrentWatermarkMs(self):
            return 0

        def update(self, row):
            self.get, self.exists = row, True

        def setTimeoutTimestamp(self, at):
            self.ends = at

        def remove(self):
            self.exists = False

    t0 = datetime(2026, 7, 1)
    body = [json.dumps({"bid": 100.0 + k, "ask": 101.0 + k, "feed_type": "SIP_NBBO", "session": "REGULAR", "received_at_utc": str(t0 + timedelta(minutes=k))}) for k in range(200)]
    frame = pd.DataFrame({"kind": ["quote"] * 200, "at": [t0 + timedelta(minutes=k) for k in range(200)], "body": body})
    step, state = newest_records("k", {"status": 5, "broker": 300}, 2), State()
    assert list(step((1,), iter([frame]), state)) == []
    assert len(state.get[0]) < sum(map(len, body)) / 5  # a fifth over the bodies before
    state.getCurrentWatermarkMs = lambda: 1000 * int(t0.timestamp() + 10**7)
    assert sum(len(f) for f in step((1,), iter([]), state)) == 200
    with state_session(spark, on_disk=True) as own:
        assert "RocksDB" in own.conf.get("spark.sql.streaming.stateStore.providerClass")
    with state_session(spark) as own:
        assert "RocksDB" not in own.conf.get("spark.sql.streaming.stateStore.providerClass", "")


def test_segment_stream_equals_the_batch_operator(spark, tmp_path, rows):
    t0 = datetime(2026, 7, 1)
    data, at = [], t0
    for i in range(120):
        at += timedelta(hours=30 if i % 17 == 0 else 2)
        data.append((i // 30, i % 3, at, 100.0 * (9 if i % 23 == 0 else 1) + i, i))
    df = spark.createDataFrame(data, "batch int, k int, ts timestamp, v double, n int")
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_batches(df, src, "batch", [0, 1, 2, 3])
    late = spark.createDataFrame([(0, t0, 1.0, 999), (7, t0, 1.0, 1000), (7, t0, 2.0, 1001)], "k int, ts timestamp, v double, n int")
    late.coalesce(1).write.mode("append").parquet(src)
    cut = segment_stream(stream(spark, src, df.drop("batch").schema), ["k"], "ts", "v", gap_seconds=86_400, ratio=5.0)
    run_available(cut.writeStream.format("parquet").option("path", out).outputMode("append"), str(tmp_path / "log"))
    want = segment_history(df.drop("batch"), ["k"], "ts", "v", gap=F.unix_micros("ts") - F.unix_micros("previous_session") > 86_400_000_000, ratio=5.0)
    assert want.filter("segment_id > 3").count() > 0
    got = spark.read.parquet(out)
    assert rows(got.filter("not late and k < 3").select("k", "n", "segment_break_reason", "segment_id")) == rows(want.select("k", "n", "segment_break_reason", "segment_id"))
    assert rows(got.filter("late").select("n", "segment_id", "segment_break_reason")) == [(1001, None, None), (999, None, None)]
    assert rows(got.filter("k = 7 and not late").select("n", "segment_id")) == [(1000, 0)]


def test_segment_state_expires(spark, tmp_path, rows):
    t0 = datetime(2026, 7, 1)
    df = spark.createDataFrame([(b, k, t0 + timedelta(hours=h), v) for b, k, h, v in ((0, 1, 0, 1.0), (0, 2, 0, 1.0), (1, 2, 30, 1.0), (2, 2, 60, 1.0), (3, 1, 61, 1.0), (3, 2, 62, 9.0))], "batch int, k int, ts timestamp, v double")
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_batches(df, src, "batch", [0, 1, 2, 3])
    cut = segment_stream(stream(spark, src, df.drop("batch").schema), ["k"], "ts", "v", gap_seconds=40 * 3600, ratio=5.0, expire_seconds=40 * 3600, delay="1 hour")
    run_available(cut.writeStream.format("parquet").option("path", out).outputMode("append"), str(tmp_path / "log"))
    got = rows(spark.read.parquet(out).select("k", F.hour("ts").alias("h"), "segment_break_reason", "segment_id"))
    # key 1 was silent for 61 hours: its state is gone, so it starts anew instead of breaking at a gap
    assert got == [(1, 0, None, 0), (1, 13, None, 0), (2, 0, None, 0), (2, 12, None, 0), (2, 14, "INVALID_PRICE_DISCONTINUITY", 1), (2, 6, None, 0)]


def test_quote_stream(spark, tmp_path):
    t0 = datetime(2026, 7, 6, 14)
    at = lambda s: t0 + timedelta(seconds=s)
    rows_ = [(1, quote_row()), (2, quote_row(halt="HALTED")), (3, quote_row(eligible=False)), (4, quote_row(status_at=at(-60)))]
    rows_ += [(9, quote_row(cutoff=at(3600), generated=at(3610), requested=at(3598), received=at(3599), quote_at=at(3598), status_at=at(3598), broker_at=at(3598)))]
    later = quote_frame(spark, [(9, quote_row(cutoff=at(7200), generated=at(7210), quote_at=at(7200), status_at=at(7200), broker_at=at(7200), requested=at(7200), received=at(7200)))])
    full = quote_frame(spark, rows_)
    parts = {}
    for name, columns in (("q", ["security_id", "cutoff_utc", "generated_at_utc", "requested_at_utc", "received_at_utc", "quote"]), ("s", ["security_id", "market_status"]), ("b", ["security_id", "broker_eligibility"])):
        path = str(tmp_path / name)
        full.select(*columns).coalesce(1).write.parquet(path)
        later.select(*columns).coalesce(1).write.mode("append").parquet(path)
        parts[name] = stream(spark, path, full.select(*columns).schema)
    out = str(tmp_path / "out")
    gated = gate_quotes_stream(parts["q"], parts["s"], parts["b"])
    run_available(gated.writeStream.format("parquet").option("path", out).outputMode("append"), str(tmp_path / "log"))
    got = {(r["security_id"], r["cutoff_utc"]): (r["status"], r["block_reasons"]) for r in spark.read.parquet(out).collect()}
    assert got[(1, t0)] == ("READY", [])
    assert got[(2, t0)] == ("BLOCKED", ["SECURITY_HALTED"]) and got[(3, t0)] == ("BLOCKED", ["BROKER_INELIGIBLE_OR_UNKNOWN"])
    assert set(got[(4, t0)][1]) == {"HALT_STATUS_UNKNOWN", "LULD_STATUS_UNKNOWN", "STALE_MARKET_STATUS"}  # no status near the cutoff
    assert (9, at(7200)) not in got  # still open behind the watermark
