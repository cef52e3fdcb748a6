"""The prefix scan over chunks gives the same rows as plain windows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.catalog import benchmark as cat_benchmark
from tidemark.catalog import history as cat_history
from tidemark.functions import is_invalid_ohlcv
from tidemark.operators import keys, segments
from tidemark.operators.skew import OrderedKeys
from tidemark.plans import benchmark, filings


def skewed(spark, n=6000):
    """One key with two thirds of the rows, the rest over forty keys, some NULL keys."""
    i = F.col("id")
    key = F.when(i % 3 != 0, F.lit(7)).when(i % 11 == 0, F.lit(None)).otherwise(i % 40)
    value = F.when(i % 13 == 0, F.lit(None)).otherwise((F.hash("id") % 1000) / 10 + 101.0)
    return spark.range(n).select(key.cast("int").alias("k"), (i * 7 % 100003).alias("t"), value.alias("v"), i.alias("n"))


def running(ordered):
    return ordered.running(
        sums={"s": F.col("v").cast("decimal(20,4)"), "c": F.lit(1)}, maxima={"m": F.col("v")}, maxima_before={"b": F.struct("t", "v")}, products={"p": 1 + F.col("v") / 10000},
    ).result().select("n", "s", "c", "m", "b", F.round(F.log("p"), 9).alias("p"))


def test_running_values_match_windows(spark, rows):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("t")
    to_now, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select(
        "n", F.sum(F.col("v").cast("decimal(20,4)")).over(to_now).alias("s"), F.count(F.lit(1)).over(to_now).alias("c"), F.max("v").over(to_now).alias("m"),
        F.max(F.struct("t", "v")).over(before).alias("b"), F.round(F.log(F.product(1 + F.col("v") / 10000).over(to_now)), 9).alias("p"),
    )
    whole, chunked = OrderedKeys(df, ["k"], ["t"]), OrderedKeys(df, ["k"], ["t"], chunk_rows=100)
    assert not whole.split  # no key has a chunk's rows
    assert chunked.split and chunked.df.filter("k = 7").select("_chunk").distinct().count() >= 25
    # the NULL key is cut like any other, short keys are not
    assert chunked.df.filter("k is null and _long").count() > 0 and chunked.df.filter("k = 3 and _long").count() == 0
    assert rows(running(chunked)) == rows(running(whole)) == rows(want)


def test_chunks_follow_the_order_of_a_dominant_key(spark, rows):
    # nine rows of ten have one key, and runs of equal first order values are cut inside
    i = F.col("id")
    df = spark.range(8000).select(F.when(i % 10 == 0, i % 5).otherwise(9).alias("k"), F.floor(i / 1000).alias("day"), F.hash("id").alias("o"), i.alias("n"))
    cut = OrderedKeys(df, ["k"], ["day", "o"], chunk_rows=160)
    spans = cut.df.filter("k = 9").groupBy("_chunk").agg(F.min(F.struct("day", "o")).alias("lo"), F.max(F.struct("day", "o")).alias("hi"), F.count(F.lit(1)).alias("rows")).orderBy("_chunk").collect()
    assert len(spans) > 20 and all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:])) and max(r["rows"] for r in spans) < 480
    w = Window.partitionBy("k").orderBy("day", "o")
    want = df.select("n", F.sum("n").over(w).alias("s"), F.lag("n").over(w).alias("p"))
    got = cut.running(sums={"s": F.col("n")}, maxima_before={"b": F.struct("day", "o", "n")}).running(maxima={"again": F.col("s")}).result()
    assert rows(got.select("n", "s", F.col("b.n").alias("p"))) == rows(want) and got.filter("again <> s").count() == 0


def test_bounds_do_not_depend_on_partitions(spark, rows):
    df = skewed(spark)
    cut = lambda d: rows(OrderedKeys(d, ["k"], ["t"], chunk_rows=100).df.select("n", "_chunk"))
    assert cut(df.repartition(7)) == cut(df.coalesce(1))


def test_empty_input(spark):
    df = skewed(spark).limit(0)
    assert running(OrderedKeys(df, ["k"], ["t"], chunk_rows=10)).count() == 0


def test_previous_value(spark, rows):
    df = skewed(spark).withColumn("w", F.col("n") * 2)
    want = df.select("n", F.lag("v").over(Window.partitionBy("k").orderBy("t")).alias("pv"), F.lag("t").over(Window.partitionBy("k").orderBy("t")).alias("pt"))
    got = keys.previous_value(df, ["k"], "t", {"pv": "v", "pt": "t"}, chunk_rows=100).select("n", "pv", "pt")
    assert rows(got) == rows(want)


def test_segments_with_actions(spark, rows):
    df = skewed(spark).filter("v is not null")
    actions = df.filter("n % 17 = 0").select("k", (F.col("t") - 1).alias("event_date"))
    options = dict(gap=F.col("t") - F.col("previous_session") > 90, ratio=1.6, actions=actions)
    plain = segments.segment_history(df, ["k"], "t", "v", **options)
    chunked = segments.segment_history(df, ["k"], "t", "v", chunk_rows=100, **options)
    assert plain.filter("segment_break_reason = 'SESSION_GAP'").count() > 50
    assert plain.filter("segment_break_reason = 'INVALID_PRICE_DISCONTINUITY'").count() > 50
    assert rows(chunked) == rows(plain)
    latest = lambda cut: segments.latest_segment(cut, ["k"], "t", F.col("v") > 110, 9).select("k", "t", "history_rank")
    assert rows(latest(chunked)) == rows(latest(plain))


def test_event_between(spark, rows):
    df = skewed(spark).filter("k is not null").select("k", "t", (F.col("t") + 40).alias("until"), "n")
    events = skewed(spark).filter("n % 29 = 0").select("k", (F.col("t") + 3).alias("e"))
    want = df.alias("d").join(events.alias("e"), F.expr("d.k = e.k and e.e > d.t and e.e <= d.until"), "left_anti")
    got = keys.without_event_between(df, events, ["k"], "t", "until", "e", chunk_rows=64)
    assert 0 < want.count() < df.count()
    assert rows(got) == rows(want)


def test_market_build_is_the_same_with_hot_securities(spark, tables, rows):
    plain, chunked = cat_history.market_build(tables), cat_history.market_build(tables, chunk_rows=16)
    assert rows(chunked.prices) == rows(plain.prices)
    assert rows(chunked.truncations) == rows(plain.truncations)
    assert rows(chunked.invalid_rows) == rows(plain.invalid_rows)


def test_benchmark_scans(spark, tables, rows):
    r = cat_benchmark.returns(tables)
    index = lambda hot: benchmark.compound_index(r, ["ticker"], "session_date", "total_return", chunk_rows=hot).select(
        "ticker", "session_date", F.round("total_return_index", 4)
    )
    assert rows(index(50)) == rows(index(None))
    _, cash, _ = cat_benchmark.sources(tables)
    lineage = lambda hot: benchmark.lineage_hash(
        r.select("ticker", "session_date"), cash, ["ticker"], "session_date", "event_date", ["event_id", "event_date"], "h", hot
    )
    assert rows(lineage(50)) == rows(lineage(None))


def test_override_overlaps(spark, tables, rows):
    from tidemark.catalog.identity import periods

    p = periods(tables)
    assert rows(filings.override_overlaps(p, chunk_rows=5)) == rows(filings.override_overlaps(p))


def test_latest_segment_of_bars(spark, tables, rows):
    from tidemark.catalog.base import bars

    b = bars(tables)
    cut = lambda hot: segments.segment_history(
        b, ["security_id"], "session_date", "close", gap=F.datediff("session_date", "previous_session") > 3, ratio=8.0, chunk_rows=hot
    )
    last = lambda hot: segments.latest_segment(cut(hot), ["security_id"], "session_date", ~is_invalid_ohlcv(), 20)
    columns = ("security_id", "session_date", "segment_id", "valid_segment_start_date", "previous_segment_latest_date", "history_rank")
    assert rows(last(10), *columns) == rows(last(None), *columns)


def test_maximum_of_the_whole_key(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"), F.xxhash64("id").alias("v")).unionByName(
        spark.range(3).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("t"), F.col("id").alias("v")))
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.max("v").alias("m")).collect()}
    for chunk_rows in (None, 32):
        got = OrderedKeys(df, ["k"], ["t"], chunk_rows).maximum("m", F.col("v")).result()
        assert got.count() == 3003 and {(r["k"], r["m"]) for r in got.select("k", "m").distinct().collect()} == set(want.items())
