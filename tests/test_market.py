"""Price scan, conflicts, segmentation, active set and gates on small literal inputs."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark import sources
from tidemark.operators import keys
from tidemark.plans import market

# LUMO: two spellings, a repeated row, a stray row decades before, one after the cutoff. KAR-C: plain.
# VYX: twelvefold overnight. TWIN: a split explains its fall. OLDY: stopped trading. STRAY: no security.
PRICES = [
    ("LUMO", "2004-06-01", 0.0, 3.2, 2.9, 3.1, 40.0), ("lumo ", "2031-03-11", 41.0, 42.5, 40.2, 42.0, 740.5), ("LUMO", "2031-03-12", 42.0, 43.0, 41.1, 41.5, 810.0),
    ("LUMO", "2031-03-13", 41.5, 44.0, 41.0, 43.7, 905.0), ("LUMO", "2031-03-13", 41.5, 44.0, 41.0, 43.7, 905.0), ("LUMO", "2031-03-14", 43.7, 45.0, 43.0, 44.4, 990.0),
    ("LUMO", "2031-03-17", 44.4, 46.0, 44.0, 45.1, 700.0),
    ("KAR-C", "2031-03-12", 7.1, 7.4, 7.0, 7.3, 64.0), ("KAR-C", "2031-03-14", 7.3, 7.5, 7.2, 7.4, 61.0),
    ("VYX", "2031-03-10", 9.0, 9.4, 8.8, 9.1, 12.0), ("VYX", "2031-03-12", 108.0, 113.0, 107.0, 110.0, 15.0), ("VYX", "2031-03-13", 110.0, 112.0, 109.0, 111.0, 18.0),
    ("VYX", "2031-03-14", 111.0, 114.0, 110.0, 113.0, 11.0),
    ("TWIN", "2031-03-11", 90.0, 91.5, 89.0, 90.6, 30.0), ("TWIN", "2031-03-14", 9.0, 9.3, 8.9, 9.1, 300.0),
    ("OLDY", "2031-01-20", 5.0, 5.2, 4.9, 5.1, 8.0), ("STRAY", "2031-03-14", 2.0, 2.0, 2.0, 2.0, 2.0),
]
SECURITIES = [("X:LUMO", "LUMO"), ("Y:KAR.C", "KAR.C"), ("X:VYX", "VYX"), ("X:TWIN", "TWIN"), ("X:OLDY", "OLDY"), ("X:VOID", "VOID")]
CUTOFF, WEEK_BEFORE = "2031-03-14", "2031-03-07"


def day(text):
    return F.lit(text).cast("date")


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed"))
    spark.createDataFrame(PRICES, "symbol string, report_date string, open double, high double, low double, close double, volume double").write.parquet(f"{path}/p")
    spark.createDataFrame([("TWIN", "2031-03-13", "10:1"), ("twin", "2031-03-13", "10:1"), ("LUMO", "2027-05-05", ""), ("KAR-C", None, "3:2")],
                          "symbol string, report_date string, split_factor string").write.parquet(f"{path}/s")
    aliases = sources.alias_table(spark.createDataFrame(SECURITIES, "security_id string, ticker string"))
    options = dict(dataset="SNAPSHOT", revision="r1", observed_at="2031-03-14T22:00:00Z")
    prices = sources.scan_prices(spark, f"{path}/p", aliases, day(CUTOFF), **options)
    splits, bad = sources.scan_splits(spark, f"{path}/s", aliases, day(CUTOFF), **options)
    return prices, splits, bad, aliases


@pytest.fixture(scope="module")
def history(feed):
    prices, splits, _, aliases = feed
    return market.build_market_history(prices, splits, aliases, expected=day(CUTOFF), oldest_active=day(WEEK_BEFORE))


def test_scan(feed, rows):
    prices, splits, bad, aliases = feed
    assert prices.count() == 15  # unknown symbols and rows after the cutoff are gone
    assert prices.filter("source_symbol = 'LUMO' and session_date = '2031-03-11'").first()["volume"] == 740  # ties to even
    assert splits.count() == 2
    assert sorted(r["reject_reasons"][0] for r in bad.collect()) == ["BAD_DATE", "BLANK_FACTOR"]
    assert rows(aliases.filter("ticker = 'KAR.C'"), "source_symbol", "priority") == [("KAR-C", 1), ("KAR.C", 0)]


def test_conflicts_and_duplicates(feed, spark):
    prices = feed[0]
    values = ["open", "high", "low", "close", "volume"]
    assert keys.conflicting_groups(prices, ["source_symbol", "session_date"], values).count() == 0
    assert keys.identical_duplicates(prices, ["source_symbol", "session_date", *values]).first()[0] == 1
    wrong = prices.unionByName(prices.filter("source_symbol = 'KAR-C'").withColumn("close", F.col("close") + 1))
    assert keys.conflicting_groups(wrong, ["source_symbol", "session_date"], values).count() == 2


def test_aliases(spark, rows):
    a = sources.alias_table(spark.createDataFrame([("1", " a.b/c "), ("2", "A-B/C")], "security_id string, ticker string"))
    assert rows(a, "security_id", "source_symbol", "priority") == [("1", "A-B/C", 1), ("1", "A.B-C", 2), ("1", "A.B/C", 0), ("2", "A-B-C", 1), ("2", "A-B/C", 0)]
    assert [r["source_symbol"] for r in sources.ambiguous_aliases(a).collect()] == ["A-B/C"]


def test_history(history, rows):
    assert rows(history.prices.groupBy("security_id").count()) == [("X:LUMO", 4), ("X:TWIN", 2), ("X:VYX", 3), ("Y:KAR.C", 2)]
    truncated = {r["security_id"]: (r["previous_latest"], r["segment_start"], r["reason"]) for r in history.truncations.collect()}
    assert truncated == {
        "X:VYX": (date(2031, 3, 10), date(2031, 3, 12), "INVALID_PRICE_DISCONTINUITY"),
        "X:LUMO": (date(2004, 6, 1), date(2031, 3, 11), "SESSION_GAP"),
    }
    assert rows(history.unmatched, "security_id", "reason") == [
        ("X:OLDY", "SOURCE_HISTORY_STALE:latest_session=2031-01-20"), ("X:VOID", "NO_SOURCE_SYMBOL_MATCH")
    ]
    assert rows(history.splits, "security_id", "event_date", "split_factor") == [("X:TWIN", date(2031, 3, 13), "10:1")]


def test_metrics_and_gate(history, feed):
    metrics = market.market_metrics(history, feed[3], expected=day(CUTOFF), cutoff=day(CUTOFF), benchmark="lumo", minimum_history=2)
    row = market.market_gate(metrics, expected=day(CUTOFF), minimum_coverage=0.5).first()
    assert (row["rows"], row["securities"], row["admitted"], row["duplicate_rows"], row["after_cutoff"]) == (11, 4, 6, 0, 0)
    assert (row["valid_securities"], row["active_securities"], row["latest_session_coverage"], row["benchmark_valid"]) == (4, 4, 1.0, True)
    assert (row["state"], row["errors"]) == ("READY_NEW", [])
    assert row["warnings"] == ["HISTORIES_TRUNCATED", "STALE_HISTORIES_EXCLUDED"]
    late = market.market_gate(metrics, expected=day("2031-03-17"), minimum_coverage=0.9).first()
    assert late["state"] == "QUARANTINED" and "SESSIONS_BEHIND" in late["errors"] and "MATCHED_COVERAGE_BELOW_MINIMUM" in late["errors"]


def test_coverage_98_percent_is_ready_with_exclusions(spark):
    bars = [(f"S{i:03d}", CUTOFF, 10.0, 11.0, 9.0, 0.0 if i < 2 else 10.0 + i / 100, 5 + i) for i in range(100)]
    bars += [(f"S{i:03d}", "2031-03-13", 10.0, 11.0, 9.0, 10.0, 5 + i) for i in range(100)]
    raw = spark.createDataFrame(bars, "symbol string, report_date string, open double, high double, low double, close double, volume int")
    aliases = sources.alias_table(spark.createDataFrame([(s, s) for s in {b[0] for b in bars}], "security_id string, ticker string"))
    prices = sources.normalize_prices(raw, aliases, day(CUTOFF), dataset="SNAPSHOT", revision="r", observed_at="t")
    none = spark.createDataFrame([], "source_symbol string, event_date date, split_factor string, source_dataset string, source_revision string, observed_at_utc string")
    h = market.build_market_history(prices, none, aliases, expected=day(CUTOFF), oldest_active=day(WEEK_BEFORE))
    m = market.market_metrics(h, aliases, expected=day(CUTOFF), cutoff=day(CUTOFF), benchmark="S005", minimum_history=1)
    row = market.market_gate(m, expected=day(CUTOFF)).first()
    assert row["latest_session_coverage"] == pytest.approx(0.98) and row["state"] == "READY_WITH_EXCLUSIONS"
    assert sorted(r["security_id"] for r in h.invalid_rows.collect()) == ["S000", "S001"]


def test_common_mode_session_is_an_error(spark):
    same = [(f"S{i:03d}", CUTOFF, 10.0, 11.0, 9.0, 10.0 if i < 40 else 9.5 + i / 100, 100 if i < 40 else i) for i in range(120)]
    raw = spark.createDataFrame(same, "symbol string, report_date string, open double, high double, low double, close double, volume int")
    aliases = sources.alias_table(spark.createDataFrame([(b[0], b[0]) for b in same], "security_id string, ticker string"))
    prices = sources.normalize_prices(raw, aliases, day(CUTOFF), dataset="SNAPSHOT", revision="r", observed_at="t")
    none = spark.createDataFrame([], "source_symbol string, event_date date, split_factor string, source_dataset string, source_revision string, observed_at_utc string")
    h = market.build_market_history(prices, none, aliases, expected=day(CUTOFF), oldest_active=day(WEEK_BEFORE))
    bad = h.common_mode.first()
    assert (bad["common_mode_rows"], bad["total_rows"]) == (40, 120)
    assert h.prices.count() == 120  # reported, not removed
    m = market.market_metrics(h, aliases, expected=day(CUTOFF), cutoff=day(CUTOFF), benchmark="S005", minimum_history=1)
    assert market.market_gate(m, expected=day(CUTOFF)).first()["errors"] == ["COMMON_MODE_SESSION"]


def test_refresh_lane_wins_and_previous_lane_is_carried(spark, rows):
    schema = "source_symbol string, session_date string, close double, source_dataset string"
    base = spark.createDataFrame([("A", "d1", 1.0, "SNAPSHOT"), ("A", "d1", 2.0, "CHART_REFRESH"), ("A", "d2", 3.0, "CHART_REFRESH")], schema)
    delta = spark.createDataFrame([("A", "d1", 9.0, "CHART_REFRESH")], schema)
    merged = keys.upsert(base, delta, ["source_symbol", "session_date"], lane=("source_dataset", "CHART_REFRESH"))
    assert rows(merged, "session_date", "close") == [("d1", 1.0), ("d1", 9.0), ("d2", 3.0)]
    previous = spark.createDataFrame([("A", "d0", 5.0, "CHART_REFRESH"), ("B", "d0", 6.0, "CHART_REFRESH"), ("C", "d0", 7.0, "SNAPSHOT")], schema)
    carried = keys.carry_forward_absent(merged, previous, "source_symbol", ("source_dataset", "CHART_REFRESH"))
    assert carried.count() == 4 and carried.filter("source_symbol = 'B'").count() == 1


@pytest.mark.parametrize("chunk_rows", [None, 16])
def test_only_last_segments_leave_the_ordered_pass(feed, spark, monkeypatch, chunk_rows):
    prices, splits, _, aliases = feed
    staged = {}

    def keep(df, name):
        staged[name] = spark.createDataFrame(df.collect(), df.schema)
        return staged[name]

    monkeypatch.setattr(market, "stage", keep)
    market.build_market_history(prices, splits, aliases, expected=day(CUTOFF), oldest_active=day(WEEK_BEFORE), chunk_rows=chunk_rows)
    last = staged["segmented"].groupBy("security_id").agg(F.countDistinct("segment_id").alias("n"), F.max("session_date").alias("newest"))
    newest = staged["best_alias"].groupBy("security_id").agg(F.max("session_date").alias("newest"))
    assert last.filter("n <> 1").count() == 0
    assert sorted(map(tuple, last.select("security_id", "newest").collect())) == sorted(map(tuple, newest.collect()))


def test_tables_of_the_build_go_and_hold_what_is_read(spark, tables, monkeypatch):
    import os

    from tidemark.catalog import history

    made, stage = {}, market.stage
    monkeypatch.setattr(market, "stage", lambda df, name: made.setdefault(name, stage(df, name)))
    metrics = history.market_metrics(tables)
    assert set(made["best_alias"].columns) == {"security_id", "session_date", "priority", "open", "high", "low", "close", "volume", "ticker"}
    stored = {name: [f for f in df.inputFiles() if os.path.exists(f.removeprefix("file://").removeprefix("file:"))] for name, df in made.items()}
    assert stored["candidates"] and not stored["best_alias"] and not stored["segmented"]
    assert metrics.count() == 1


def test_shuffle_files_of_a_stored_table_go(spark):
    from tidemark.session import stage

    kept = lambda: sum(1 for b in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in b)
    before = kept()
    rows = stage(spark.range(1000).selectExpr("id % 7 AS k", "id").repartition(5, "k"), "rows")
    assert kept() <= before and rows.count() == 1000
