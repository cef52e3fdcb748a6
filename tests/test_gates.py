"""Functions, gates, composition, sinks and the calendar on literal inputs."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import functions as fn
from tidemark import sources
from tidemark.contracts import CONTRACTS, PRICES, TableContract
from tidemark.operators import calendar, quality
from tidemark.plans import coverage, gates
from tidemark.plans.identity import reconcile_cascade
from tidemark.sources.sinks import ContractViolation, write_contract


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_scalar_rules(spark):
    lit = F.lit
    assert one(spark, fn.cik10(lit("CIK 320193"))) == "0000320193" and one(spark, fn.cik10(lit("none"))) is None
    assert one(spark, fn.cik10_strict(lit("12345678901"))) is None and one(spark, fn.cik10(lit("12345678901"))) == "12345678901"
    assert one(spark, fn.normalize_name(lit(" Acme,  Inc. "))) == "ACME INC" and one(spark, fn.normalize_name(lit(None).cast("string"))) == ""
    assert one(spark, fn.parse_source_date(lit("8-JAN-2024"))) == date(2024, 1, 8) and one(spark, fn.parse_source_date(lit("08-january-2024"))) == date(2024, 1, 8)
    assert one(spark, fn.parse_source_date(lit("2024-13-01"))) is None and one(spark, fn.source_date_unparsed(lit("2024-13-01")))
    assert one(spark, fn.parse_utc(lit("2024-01-08T12:00:00+02:00"))) == datetime(2024, 1, 8, 10) and one(spark, fn.parse_utc(lit("2024-01-08T12:00:00"))) is None
    assert one(spark, fn.bool_value(lit("Yes"))) is True and one(spark, fn.bool_value(lit("maybe"))) is None
    assert one(spark, fn.finite_number(lit("NaN"))) is None and one(spark, fn.finite_number(lit(" 1e3 "))) == 1000.0
    assert not one(spark, fn.accession_ok(lit("0000000001-24-000001\n"))) and one(spark, fn.accession_ok(lit("0000000001-24-000001")))
    assert one(spark, fn.round_half_even_long(lit("2.5"))) == 2 and one(spark, fn.round_half_even_long(lit(3.5))) == 4
    assert one(spark, fn.safe_divide(lit(1.0), lit(0.0))) is None and one(spark, fn.growth(lit(3.0), lit(2.0))) == 0.5


def test_available_date_and_time_class(spark):
    at = lambda t: F.lit(t).cast("timestamp")
    none = F.lit(None).cast("timestamp")
    filed = F.lit("2026-01-05").cast("date")
    assert one(spark, fn.available_date(filed, at("2026-01-05 21:00:00"))) == date(2026, 1, 5)  # 16:00:00 winter
    assert one(spark, fn.available_date(filed, at("2026-01-05 21:00:01"))) == date(2026, 1, 6)
    assert one(spark, fn.available_date(filed, at("2026-07-06 20:00:00"))) == date(2026, 7, 6)  # 16:00:00 summer
    assert one(spark, fn.available_date(filed, none)) == date(2026, 1, 6)
    assert [one(spark, fn.market_time_class(x)) for x in (at("2026-07-06 13:29:59"), at("2026-07-06 20:00:00"), at("2026-07-06 20:00:01"), none)] == [
        "BEFORE_MARKET", "DURING_MARKET", "AFTER_MARKET", "TIME_UNKNOWN"]


def quote_row(**changes):
    base = dict(cutoff=datetime(2026, 7, 6, 14), generated=datetime(2026, 7, 6, 14, 0, 10), requested=datetime(2026, 7, 6, 13, 59, 58), received=datetime(2026, 7, 6, 13, 59, 59),
                feed="SIP_NBBO", state="AVAILABLE", bid=100.0, ask=100.1, session="REGULAR", quote_at=datetime(2026, 7, 6, 13, 59, 57), halt="NOT_HALTED", luld="NORMAL",
                lower=None, upper=None, status_at=datetime(2026, 7, 6, 13, 59, 57), eligible=True, codes=["OK"], broker_at=datetime(2026, 7, 6, 13, 58))
    return {**base, **changes}


CASES = [
    ({}, []), ({"bid": 101.0}, ["CROSSED_MARKET"]), ({"ask": 103.0}, ["SPREAD_TOO_WIDE"]), ({"feed": "DELAYED"}, ["UNACCEPTABLE_QUOTE_FEED"]),
    ({"state": "NONE", "bid": None}, ["QUOTE_UNAVAILABLE"]), ({"quote_at": datetime(2026, 7, 6, 13, 59, 54)}, ["STALE_QUOTE"]),
    ({"quote_at": datetime(2026, 7, 6, 14, 0, 3)}, ["QUOTE_AFTER_CUTOFF"]), ({"halt": "HALTED", "luld": None}, ["LULD_STATUS_UNKNOWN", "SECURITY_HALTED"]),
    ({"lower": 5.0}, ["INVALID_LULD_BANDS"]), ({"eligible": None, "codes": [""]}, ["BROKER_INELIGIBLE_OR_UNKNOWN", "INVALID_BROKER_REASON_CODES"]),
    ({"broker_at": datetime(2026, 7, 6, 13, 50)}, ["STALE_BROKER_ELIGIBILITY"]), ({"requested": datetime(2026, 7, 6, 14)}, ["RESPONSE_PRECEDES_REQUEST"]),
    ({"status_at": datetime(2026, 7, 6, 13, 59, 50)}, ["STALE_MARKET_STATUS"]), ({"bid": None}, ["INVALID_QUOTE_VALUE"]), ({"session": "?"}, ["UNKNOWN_MARKET_SESSION"]),
]


def quote_frame(spark, rows):
    schema = ("k int, cutoff timestamp, generated timestamp, requested timestamp, received timestamp, feed string, state string, bid double, ask double, session string, quote_at timestamp, "
              "halt string, luld string, lower double, upper double, status_at timestamp, eligible boolean, codes array<string>, broker_at timestamp")
    raw = spark.createDataFrame([(k, *r.values()) for k, r in rows], schema)
    return raw.select(
        F.col("k").alias("security_id"), F.col("cutoff").alias("cutoff_utc"), F.col("generated").alias("generated_at_utc"), F.col("requested").alias("requested_at_utc"), F.col("received").alias("received_at_utc"),
        F.struct(F.col("feed").alias("feed_type"), "state", "bid", "ask", F.lit(None).cast("double").alias("last"), F.lit(1.0).alias("bid_size"), F.lit(1.0).alias("ask_size"), "session", F.col("quote_at").alias("quote_at_utc")).alias("quote"),
        F.struct(F.col("halt").alias("halt_status"), F.col("luld").alias("luld_status"), F.col("lower").alias("lower_band"), F.col("upper").alias("upper_band"), F.col("status_at").alias("observed_at_utc")).alias("market_status"),
        F.struct("eligible", F.col("codes").alias("reason_codes"), F.col("broker_at").alias("observed_at_utc")).alias("broker_eligibility"),
    )


def test_quote_reasons(spark):
    df = quote_frame(spark, [(i, quote_row(**c)) for i, (c, _) in enumerate(CASES)]).withColumn("block_reasons", fn.quote_block_reasons())
    got = {r["security_id"]: r["block_reasons"] for r in df.collect()}
    assert [got[i] for i in range(len(CASES))] == [want for _, want in CASES]
    status = gates.snapshot_status(df.withColumn("snapshot_id", F.lit(1))).first()
    assert (status["securities"], status["blocked"], status["status"]) == (len(CASES), len(CASES) - 1, "BLOCKED")


def test_provider_problems(spark):
    schema = "role string, feed_type string, observed_at_utc timestamp, maximum_age_seconds int"
    t = lambda s: datetime(2026, 7, 6, 14, 0, s)
    rows = spark.createDataFrame([("quote", "SIP_NBBO", t(0), 5), ("quote", "EXCHANGE_STATUS", t(0), 5), ("market_status", "SIP_STATUS", datetime(2026, 7, 6, 13, 59, 50), 5), ("broker_eligibility", "BROKER_ELIGIBILITY", t(4), 300)], schema)
    got = gates.provider_problems(rows.withColumns({"cutoff_utc": F.lit(t(0)), "generated_at_utc": F.lit(t(10))})).collect()
    assert [(r["role"], r["problem"]) for r in got] == [
        ("quote", "UNACCEPTABLE_PROVIDER_FEED"), ("market_status", "STALE_PROVIDER_OBSERVATION"), ("broker_eligibility", "FUTURE_PROVIDER_OBSERVATION")]


def test_reconcile(spark):
    dim = spark.createDataFrame([("XNYS:TSM", "TSM", "XNYS", "0001046179"), ("BATS:MAGS", "MAGS", "BATS", ""), ("XNAS:MAGS", "MAGS", "XNAS", None)], "security_id string, ticker string, exchange_mic string, cik string")
    dim = dim.withColumns({"cusip": F.lit(None).cast("string"), "isin": F.lit("")})
    positions = spark.createDataFrame([(1, None, "0001046179", "TSM", None), (2, "bats:mags", None, None, None), (3, None, None, "MAGS", None), (4, None, "", "mags", "xnas"), (5, None, None, "?", None)],
                                      "n int, security_id string, cik string, ticker string, exchange_mic string").withColumns({"cusip": F.lit(""), "isin": F.lit(None).cast("string")})
    got = {r["n"]: (r["matched_id"], r["match_level"], r["match_status"]) for r in reconcile_cascade(positions, dim, "security_id").collect()}
    assert got == {1: ("XNYS:TSM", "cik", "MATCHED"), 2: ("BATS:MAGS", "security_id", "MATCHED"), 3: (None, "ticker", "AMBIGUOUS"), 4: ("XNAS:MAGS", "ticker_exchange", "MATCHED"), 5: (None, None, "UNMATCHED")}


def test_freshness_thresholds_and_reuse(spark):
    at = datetime(2026, 7, 20)
    hours = [("identity", 24), ("market", 24 * 8), ("short_interest", 24 * 8 + 1), ("insiders", 24 * 14 + 1)]
    rows = spark.createDataFrame([(g, datetime.fromtimestamp(at.timestamp() - h * 3600)) for g, h in hours], "group_id string, source_retrieved_at_utc timestamp")
    got = {r["group_id"]: (r["lag_hours"], r["freshness_state"]) for r in gates.group_freshness(rows, F.lit(at)).collect()}
    assert got == {"identity": (24, "READY"), "market": (192, "READY"), "short_interest": (193, "REUSED_WITH_PENALTY"), "insiders": (337, "DISABLED")}
    states = [(g, one(spark, gates.reuse_state(F.lit(g), F.lit(h), F.lit(s)))) for g, h, s in (("identity", 72, None), ("identity", 73, None), ("market", None, 2), ("market", None, 3), ("insiders", None, 0))]
    assert [s for _, s in states] == ["READY_REUSED", "STALE_DISABLED", "READY_REUSED", "STALE_DISABLED", "STALE_DISABLED"]


def test_group_rules(spark):
    schema = "group_id string, state string, lag_sessions int, coverage double, exclusions int, validation_errors int, benchmark_valid boolean"
    rows = spark.createDataFrame([("market", "READY_NEW", 0, 0.98, 0, 0, True), ("market", "READY_WITH_EXCLUSIONS", 0, 0.98, 3, 0, True), ("market", "READY_REUSED", 3, 0.9, 0, 0, None),
                                  ("insiders", "READY_NEW", None, None, 0, 2, None), ("identity", "STALE_DISABLED", None, None, 0, 0, None)], schema)
    got = sorted((r["group_id"], r["violation"]) for r in gates.group_rule_violations(rows).collect())
    assert got == [("identity", "CORE_GROUP_NOT_USABLE"), ("insiders", "USABLE_WITH_ERRORS"), ("market", "READY_NEW_THRESHOLD"), ("market", "READY_REUSED_COVERAGE"), ("market", "READY_REUSED_TOO_STALE")]


def price_table(spark, ids, close=10.0):
    return spark.createDataFrame([(i, i, i, date(2026, 7, 6), 10.0, 11.0, 9.0, close, 5, "D", "r", "t") for i in ids], PRICES.schema)


def test_composition_falls_back_and_drops_orphans(spark):
    pit = (None, None, None, None, datetime(2026, 7, 6))
    master = spark.createDataFrame([(i, i, "X", None, None, None, "UNMAPPED_SEC_CIK", None, "r", *pit) for i in ("A", "B")], CONTRACTS["security_master"].schema)
    universe = spark.createDataFrame([tuple("A" for _ in CONTRACTS["security_universe"].columns)], CONTRACTS["security_universe"].schema)
    splits = spark.createDataFrame([("Z", "Z", "Z", date(2026, 7, 1), "2:1", "D", "r", "t")], CONTRACTS["splits"].schema)
    identity = {"security_universe": universe, "security_master": master}
    good, broken = price_table(spark, ["A", "B", "C"]), price_table(spark, ["A", "A"])
    out = gates.compose_groups({**identity, "prices": broken, "splits": splits}, {**identity, "prices": good, "splits": splits}, gates.contract_validator)
    assert out["identity"].state == "READY_NEW" and out["market"].state == "READY_WITH_EXCLUSIONS"
    assert out["market"].exclusions == {"prices": 1, "splits": 1} and out["market"].diagnostics == ["prices: 1 DUPLICATE_KEY"]
    assert sorted(r["security_id"] for r in out["market"].tables["prices"].collect()) == ["A", "B"]
    fresh = gates.compose_groups({**identity, "prices": good, "splits": splits}, {}, gates.contract_validator)
    assert fresh["market"].state == "READY_NEW" and fresh["market"].tables["prices"].count() == 3
    with pytest.raises(gates.CompositionError):
        gates.compose_groups({**identity, "prices": broken, "splits": splits}, {**identity, "prices": broken, "splits": splits}, gates.contract_validator)


SMALL = TableContract("small", T.StructType([
    T.StructField("id", T.StringType()), T.StructField("event_date", T.DateType()), T.StructField("value", T.DoubleType()), T.StructField("quantity", T.LongType()),
    T.StructField("enabled", T.BooleanType()), T.StructField("description", T.StringType()), T.StructField("optional", T.StringType()), T.StructField("observed_at", T.TimestampType()),
]), ("id",), point_in_time=False)


def test_typed_writer_round_trip(spark, tmp_path, rows):
    data = [("b", date(2026, 1, 1), 1.5, 2, True, 'say "hi"\nand, bye', "", datetime(2026, 1, 1, 1)), ("a", None, None, None, None, "", None, None)]
    out = write_contract(spark.createDataFrame(data, SMALL.schema), SMALL, str(tmp_path / "t"))
    assert rows(out) == sorted(data) and out.schema == SMALL.schema
    empty = write_contract(spark.createDataFrame([], SMALL.schema), SMALL, str(tmp_path / "e"))
    assert empty.schema == SMALL.schema and quality.is_empty(empty)


@pytest.mark.parametrize("data, rule", [
    ([("a", None, 1.0), ("a", None, 2.0)], "DUPLICATE_KEY"), ([("a", None, float("nan"))], "NON_FINITE_VALUE"), ([("a", None, float("inf"))], "NON_FINITE_VALUE"), ([(None, None, 1.0)], "NULL_KEY")])
def test_typed_writer_refuses(spark, tmp_path, data, rule):
    rows_ = [(*d, None, None, None, None, None) for d in data]
    with pytest.raises(ContractViolation, match=rule):
        write_contract(spark.createDataFrame(rows_, SMALL.schema), SMALL, str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()


def test_typed_writer_refuses_other_columns(spark, tmp_path):
    with pytest.raises(ContractViolation, match="extra columns"):
        write_contract(spark.createDataFrame([], SMALL.schema).withColumn("more", F.lit(1)), SMALL, str(tmp_path / "t"))
    assert quality.schema_differences(spark.createDataFrame([], SMALL.schema).drop("id"), SMALL.schema)


def test_read_model_and_reports(spark, tmp_path, rows):
    table = price_table(spark, ["B", "A"])
    sources.write_read_model({"prices": table}, str(tmp_path / "rm"), {"prices": ("security_id",)})
    assert rows(spark.read.parquet(str(tmp_path / "rm" / "prices")), "security_id") == [("A",), ("B",)]
    sources.write_csv_report(table.select("security_id", "close"), str(tmp_path / "csv"), ["security_id"])
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    sources.write_metrics_json(table.agg(F.count("*").alias("n")), str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m")).first()[0] == '{"n":2}'


def test_coverage_of_two_securities(spark):
    universe = spark.createDataFrame([("A", "XNAS", "COMMON"), ("B", "XNYS", "COMMON"), ("C", "XNYS", ""), ("D", "XNYS", "ETF")], "security_id string, exchange_mic string, security_type string")
    expected = F.lit("2026-07-06").cast("date")
    bars = price_table(spark, ["A", "X"]).unionByName(price_table(spark, ["C"]).withColumn("session_date", F.lit("2026-07-02").cast("date")))
    failed = spark.createDataFrame([("B",)], "security_id string")
    states = coverage.coverage_states(universe, bars, key="security_id", date="session_date", expected=expected, valid=~fn.is_invalid_ohlcv(), failures=failed)
    got = {r["security_id"]: (r["state"], r["rejection_code"]) for r in states.collect()}
    assert got == {"A": ("VALID", None), "B": ("MISSING", "PROVIDER_RETRIES_EXHAUSTED"), "C": ("STALE", "STALE_SOURCE_MAX_SESSION_2026-07-02"), "D": ("MISSING", "MISSING_CURRENT_SESSION_ROW")}
    counts = coverage.coverage_diagnostic(states, ["exchange_mic", "security_type"])
    total = counts.filter("grouping = 'total'").first()
    assert (total["securities"], total["valid_securities"]) == (4, 1)
    assert counts.filter("grouping = 'security_type+state' and security_type = 'UNKNOWN'").first()["securities"] == 1
    quarantined = coverage.coverage_states(universe, bars, key="security_id", date="session_date", expected=expected, valid=~fn.is_invalid_ohlcv(), quarantined=bars.select("session_date").distinct())
    assert {r["state"] for r in quarantined.collect()} == {"VALID", "QUARANTINED"}


def test_sessions_early_close_and_lag(spark):
    days = spark.createDataFrame([(d,) for d in ("2026-11-25", "2026-11-27", "2026-11-30", "2026-12-01")], "session_date string")
    early = spark.createDataFrame([(date(2026, 11, 27), "13:00:00")], "session_date date, close_at string")
    sessions = calendar.session_dimension(days, early_closes=early)
    close = {str(r["session_date"]): r["close_utc"].hour for r in sessions.collect()}
    assert close == {"2026-11-25": 21, "2026-11-27": 18, "2026-11-30": 21, "2026-12-01": 21}
    rows_ = spark.createDataFrame([(date(2026, 11, 26), date(2026, 12, 1)), (date(2026, 11, 29), date(2026, 11, 30)), (date(2026, 12, 1), date(2026, 12, 1)), (date(2026, 1, 1), date(2026, 12, 1))], "a date, b date")
    lags = {str(r["a"]): r["lag_sessions"] for r in calendar.session_lag(rows_, "a", "b", sessions).collect()}
    assert lags == {"2026-11-26": 3, "2026-11-29": 1, "2026-12-01": 0, "2026-01-01": None}
    assert calendar.session_offset(sessions, F.lit("2026-11-30").cast("date"), 2).first()[0] == date(2026, 11, 25)
    windows = {(str(r["session_date"]), r["window_id"]): r for r in gates.phase_windows(sessions).collect()}
    assert windows[("2026-11-27", "TERMINAL_REVIEW")]["decision_cutoff_utc"] == datetime(2026, 11, 27, 18, 20)
    assert windows[("2026-11-27", "PRE_OPEN")]["decision_cutoff_utc"] == datetime(2026, 11, 30, 13, 10)
    assert windows[("2026-11-25", "SUNDAY")]["expires_at_utc"] == datetime(2026, 11, 30, 12, 45) and ("2026-12-01", "PRE_OPEN") not in windows


def test_domain_warnings(spark):
    master = spark.createDataFrame([("A", None, "UNRESOLVED_CIK_IDENTITY_CONFLICT", "6022"), ("B", "1", "X", None), ("C", "2", "X", "abc")], "security_id string, cik string, mapping_status string, sic string")
    row = coverage.domain_warnings(
        master, spark.createDataFrame([("PARTIAL",), ("COMPLETE",)], "normalization_status string"), spark.createDataFrame([("UNIQUE_SEC_ISSUER_NAME",)], "security_mapping_method string"),
        spark.createDataFrame([("us-gaap",), ("ifrs-full",)], "taxonomy string")).first().asDict()
    assert row == {"unmapped_ciks": 1, "unresolved_collisions": 1, "financial_issuers": 1, "partial_quarters": 1, "name_mapped_positions": 1, "has_ifrs": True}
