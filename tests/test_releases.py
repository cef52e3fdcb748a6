"""Clocks, target sessions, live snapshots, composition and published markets on literal rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendar, stats
from tidemark.plans import clocks, composition, gates, live, market, short_interest

D = date


@pytest.fixture(scope="module")
def sessions(spark):
    days = [(D(2031, 3, d),) for d in (3, 4, 5, 6, 7, 10, 11)]  # two weeks, one weekend
    return calendar.session_dimension(spark.createDataFrame(days, "session_date date"))


def judged(spark, sessions, rows):
    frame = spark.createDataFrame(rows, "group_id string, observed_session date, retrieved_at timestamp, certified boolean")
    out = clocks.judge_clocks(
        frame, clocks.clock_dimension(spark), sessions, target=F.lit("2031-03-10").cast("date"), as_of=F.lit("2031-03-10 22:00:00").cast("timestamp")
    )
    return {r["group_id"]: r for r in out.collect()}


def test_each_group_has_its_own_clock(spark, sessions):
    late = datetime(2031, 3, 10, 21)
    out = judged(spark, sessions, [
        ("market", D(2031, 3, 6), late, True), ("total_returns", D(2031, 3, 7), late, True),
        ("identity", D(2031, 3, 10), datetime(2031, 3, 8, 22), True), ("fundamentals", None, datetime(2031, 2, 20), True),
        ("insiders", None, None, None), ("weather", D(2031, 3, 10), late, True),
    ])
    assert (out["market"]["lag_sessions"], out["market"]["state"]) == (2, "READY")  # Friday and Monday, not the weekend
    assert (out["total_returns"]["state"], out["total_returns"]["reason"]) == ("STALE", "observed=2031-03-07, required=2031-03-10, sessions behind=1")
    assert (out["identity"]["state"], out["identity"]["lag_hours"]) == ("REUSED_WITH_PENALTY", 48.0)
    assert out["fundamentals"]["state"] == "DISABLED" and out["insiders"]["state"] == "UNKNOWN"
    assert (out["weather"]["state"], out["weather"]["reason"]) == ("UNKNOWN", "group has no clock")


def test_a_group_is_as_old_as_its_oldest_table(spark, sessions):
    now = datetime(2031, 3, 10, 21)
    out = judged(spark, sessions, [
        ("market", D(2031, 3, 10), now, True), ("market", D(2031, 3, 4), now, True),
        ("total_returns", D(2031, 3, 10), now, True), ("total_returns", D(2031, 3, 10), now, None),
    ])
    assert out["market"]["state"] == "STALE" and out["market"]["lag_sessions"] == 4
    assert out["total_returns"]["reason"] == "lane is not certified"
    ahead = judged(spark, sessions, [("market", D(2031, 3, 11), now, True)])["market"]
    assert ahead["state"] == "STALE" and ahead["reason"].endswith("after the target")


def test_target_sessions_make_capabilities_stale_per_phase(spark):
    caps = spark.createDataFrame([(c[0], "READY", None) for c in gates.CAPABILITIES], "capability_id string, state string, reason string")
    targets = spark.createDataFrame([(p[0], D(2031, 3, 10)) for p in gates.PHASES], "phase_id string, reference_session date")
    lanes = spark.createDataFrame([("market", D(2031, 3, 10)), ("benchmark", D(2031, 3, 7))], "lane string, observed_session date")
    out = clocks.target_session_gates(caps, gates.phase_dimension(spark), targets, lanes, clocks.target_dimension(spark))
    stale = {(r["phase_id"], r["capability_id"]) for r in out.filter("state = 'STALE'").collect()}
    assert stale == {(p, c) for p in clocks.BENCHMARK_PHASES for c in clocks.BENCHMARK_TARGETS}
    status = {r["phase_id"]: r["status"] for r in gates.phase_states(out, gates.phase_dimension(spark)).collect()}
    assert status["accounting"] == status["sunday"] == "BLOCKED" and status["pre_open"] == "READY"
    none = clocks.target_session_gates(caps, gates.phase_dimension(spark), targets, lanes.limit(0), clocks.target_dimension(spark))
    row = none.filter("phase_id = 'saturday_replay' and capability_id = 'canonical_replay'").first()
    assert (row["state"], row["reason"]) == ("STALE", "market lane: observed=none, required=2031-03-10")


CUT = datetime(2031, 3, 10, 15)
IDENTITY = "symbol string, exchange_mic string, currency string"
RECORD = (
    f"snapshot_id long, security_id string, {IDENTITY}, quote struct<feed_type:string,state:string,bid:double,ask:double,last:double,bid_size:double,ask_size:double,"
    "session:string,quote_at_utc:timestamp,symbol:string,exchange_mic:string,currency:string>, market_status struct<halt_status:string,luld_status:string,lower_band:double,"
    "upper_band:double,observed_at_utc:timestamp,symbol:string,exchange_mic:string>, broker_eligibility struct<eligible:boolean,reason_codes:array<string>,observed_at_utc:timestamp,"
    "symbol:string,exchange_mic:string,currency:string>, requested_at_utc timestamp, received_at_utc timestamp, status string, block_reasons array<string>"
)


def record(snapshot, security, *, symbol="AB", quote_symbol="AB", mic="XNAS", currency="USD", feed="SIP_NBBO", status="READY", why=(), halt="NOT_HALTED"):
    return (
        snapshot, security, symbol, "XNAS", "USD", (feed, "AVAILABLE", 10.0, 10.01, None, 1.0, 1.0, "REGULAR", CUT, quote_symbol, "XNAS", "USD"),
        (halt, "NORMAL", None, None, CUT, "AB", mic), (True, [], CUT, "AB", "XNAS", currency), CUT, CUT, status, list(why),
    )


def verdicts(spark, records, status="READY", generated=CUT, roles=None):
    ids = sorted({r[0] for r in records if r[0] is not None} | {1})
    headers = spark.createDataFrame([(i, status, CUT, generated) for i in ids if i != 99], "snapshot_id long, status string, actual_cutoff_utc timestamp, generated_at_utc timestamp")
    roles = roles or [("quote", "SIP_NBBO"), ("market_status", "SIP_STATUS"), ("broker_eligibility", "BROKER_ELIGIBILITY")]
    providers = spark.createDataFrame(
        [(i, r, f, "p", "e", "q", "a", CUT) for i in ids for r, f in roles],
        "snapshot_id long, role string, feed_type string, provider_id string, entitlement_scope string, request_id string, provider_response_id string, observed_at_utc timestamp",
    )
    out = live.snapshot_verdicts(headers, providers, spark.createDataFrame(records, RECORD))
    return {r["snapshot_id"]: r for r in out.collect()}


def test_a_blocked_snapshot_may_be_valid(spark):
    halted = record(1, "b", halt="HALTED", status="BLOCKED", why=["SECURITY_HALTED"])
    row = verdicts(spark, [record(1, "a"), halted], status="BLOCKED")[1]
    assert (row["verdict"], row["snapshot_status"], row["securities"], row["blocked"], row["errors"]) == ("VALID", "BLOCKED", 2, 1, [])


@pytest.mark.parametrize("records, errors", [
    ([record(1, "a"), record(1, "a")], ["DUPLICATE_SECURITY_ID"]), ([record(1, None), record(1, None)], ["INVALID_SECURITY_ID"]), ([record(1, " ")], ["INVALID_SECURITY_ID"]),
    ([record(1, "a", quote_symbol="ZZ")], ["QUOTE_IDENTITY"]), ([record(1, "a", mic="XNYS")], ["MARKET_STATUS_IDENTITY"]), ([record(1, "a", currency=None)], ["BROKER_IDENTITY"]),
    ([record(1, "a", feed="DIRECT_NBBO")], ["QUOTE_FEED_MISMATCH"]), ([record(1, "a", status="BLOCKED")], ["WRONG_STATUS"]), ([record(1, "a", why=["SECURITY_HALTED"])], ["WRONG_BLOCK_REASONS"]),
    ([], ["NO_SECURITIES"]),
])
def test_record_errors(spark, records, errors):
    row = verdicts(spark, records)[1]
    assert (row["verdict"], row["errors"]) == ("INVALID", errors)


def test_header_and_provider_errors(spark):
    ok = [record(1, "a")]
    assert verdicts(spark, ok, status="BLOCKED")[1]["errors"] == ["WRONG_SNAPSHOT_STATUS"]
    assert verdicts(spark, ok, generated=datetime(2031, 3, 10, 15, 1, 1))[1]["errors"] == ["GENERATED_TOO_LATE"]
    assert verdicts(spark, ok, roles=[("quote", "SIP_NBBO"), ("quote", "SIP_NBBO"), ("market_status", "SIP_STATUS")])[1]["errors"] == ["PROVIDER_ROLES"]
    assert verdicts(spark, ok, roles=[("quote", "SIP_NBBO"), ("market_status", "SIP_NBBO"), ("broker_eligibility", "BROKER_ELIGIBILITY")])[1]["errors"] == ["PROVIDER_FEED"]
    out = verdicts(spark, [*ok, record(99, "a")])
    assert "NO_HEADER" in out[99]["errors"] and out[1]["verdict"] == "VALID"


VERSIONS = "release_id long, group_id string, version int, valid boolean, candidate_state string, lag_hours double, lag_sessions int"


def composed(spark, versions, market_rows, master):
    out = composition.compose_versions(
        spark.createDataFrame(versions, VERSIONS), spark.createDataFrame(market_rows, "release_id long, version int, security_id string, session_date date"),
        spark.createDataFrame(master, "release_id long, version int, security_id string"),
    )
    return out, {(r["release_id"], r["group_id"]): r for r in out.collect()}


def group(release, name, version, valid=True, hours=0.0, sessions=0, state="READY_NEW"):
    return (release, name, version, valid, state, hours, sessions)


def test_three_groups_one_fallback_too_old(spark):
    day = D(2031, 3, 10)
    versions = [
        group(1, "identity", 0), group(1, "market", 0, False), group(1, "market", 1, True, 20.0, 2),
        group(1, "filings_events", 0, False), group(1, "filings_events", 1, True, 337.0), group(1, "insiders", 0),
        group(2, "identity", 0, False), group(2, "identity", 1, True, 73.0), group(2, "market", 0),
        group(3, "identity", 0), group(3, "market", 0, False),
    ]
    rows = [(1, 1, s, day) for s in ("a", "b", "gone", "gone", None)] + [(1, 0, "c", day)] + [(2, 0, "a", day)]
    out, got = composed(spark, versions, rows, [(1, 0, "a"), (1, 0, "b"), (2, 1, "a"), (3, 0, "a")])
    market_row = got[1, "market"]
    assert (market_row["version"], market_row["state"], market_row["exclusions"], market_row["coverage"]) == (1, "READY_WITH_EXCLUSIONS", 3, 1.0)
    assert got[1, "filings_events"]["state"] == "STALE_DISABLED" and got[1, "insiders"]["state"] == "DISABLED_DEPENDENCY"
    assert got[2, "identity"]["state"] == "STALE_DISABLED" and got[2, "market"]["state"] == "DISABLED_DEPENDENCY"
    assert (got[3, "market"]["version"], got[3, "market"]["state"]) == (None, "MISSING")
    verdict = {r["release_id"]: r for r in composition.release_verdicts(out).collect()}
    assert verdict[1]["status"] == "READY" and verdict[1]["unusable_groups"] == 2
    assert verdict[2]["problems"] == ["IDENTITY_STALE_DISABLED", "MARKET_DISABLED_DEPENDENCY"] and verdict[3]["problems"] == ["MARKET_MISSING"]
    composition.require_composed(composition.release_verdicts(out).filter("release_id = 1"))
    with pytest.raises(gates.CompositionError):
        composition.require_composed(composition.release_verdicts(out))


def test_readiness_is_measured_after_orphans_went(spark):
    old, new = D(2031, 3, 7), D(2031, 3, 10)
    versions = [group(1, "identity", 0), group(1, "market", 0, False), group(1, "market", 1, True, 1.0, 1), group(2, "identity", 0), group(2, "market", 0),
                group(3, "identity", 0), group(3, "market", 0, False), group(3, "market", 1, True, 1.0, 3)]
    rows = [(1, 1, "gone", new), (1, 1, "a", old), (1, 1, "b", D(2031, 3, 6)), (2, 0, "a", new), (2, 0, "x", new), (3, 1, "a", new)]
    _, got = composed(spark, versions, rows, [(1, 0, "a"), (1, 0, "b"), (2, 0, "a"), (3, 0, "a")])
    assert (got[1, "market"]["state"], got[1, "market"]["coverage"]) == ("QUARANTINED", 0.5)  # the orphan alone had the last session
    assert got[2, "market"]["state"] == "UNKNOWN_SECURITY_ID"
    assert got[3, "market"]["state"] == "STALE_DISABLED"  # three sessions behind
    empty, none = composed(spark, [group(1, "identity", 0), group(1, "market", 0)], [], [])
    assert none[1, "market"]["state"] == "QUARANTINED" and none[1, "market"]["exclusions"] == 0


def test_published_rows_are_judged_as_they_are(spark):
    day = D(2031, 3, 10)
    bars = "security_id string, session_date date, open double, high double, low double, close double, volume long"
    prices = spark.createDataFrame([
        ("a", day, 1.0, 1.0, 1.0, 1.0, 1), ("a", day, 1.0, 1.0, 1.0, 1.0, 1), ("b", day, 1.0, 1.0, 1.0, 0.0, 1), ("b", None, 1.0, 1.0, 1.0, 1.0, 1),
        ("c", D(2031, 3, 11), 1.0, 1.0, 1.0, None, 1)], bars)
    fields = ", ".join(f"{c} {'date' if c == 'event_date' else 'string'}" for c in market.SPLIT_FIELDS)
    split = lambda s, factor: (s, "T", "S", day, factor, "D", "1", "-")
    splits = spark.createDataFrame([split("a", "2:1"), split("a", "3:1"), split("b", ""), split("c", None)], fields)
    row = market.published_metrics(prices, splits, cutoff=F.lit(day), n=1).first().asDict()
    assert row == {"published_rows": 5, "invalid_rows": 3, "duplicate_rows": 1, "after_cutoff": 1, "histories_over_limit": 2, "split_duplicate_rows": 1, "split_invalid_rows": 2}
    none = market.published_metrics(prices.limit(0), splits.limit(0), cutoff=F.lit(day)).first().asDict()
    assert set(none.values()) == {0}
    assert market.collapsed_rows(prices).first()[0] == 1


def test_one_invalid_distribution_takes_the_lane_down(spark):
    day = D(2031, 3, 10)
    base = spark.createDataFrame([("X", 200, 40, day, 0), ("Y", 200, 40, day, 0)], "ticker string, sessions long, weekly_observations long, maximum_session date, uncertified_rows long")
    cash = spark.createDataFrame([(0.5, "USD", "CASH_DISTRIBUTION", CUT), (0.5, "USD", "CASH_DISTRIBUTION", None)],
                                 "cash_amount double, currency string, distribution_type string, source_retrieved_at_utc timestamp")
    state = lambda rows: stats.lane_status(base, "ticker", ["X", "Y"], F.lit(day), distributions=rows).first()
    assert state(cash.limit(1))["state"] == "READY" and state(cash.limit(0))["state"] == "READY"
    assert (state(cash)["state"], state(cash)["market_state"], state(cash)["invalid_distributions"]) == ("INVALID", "READY", 1)


def test_short_interest_that_can_not_be_placed(spark):
    day = D(2031, 3, 14)
    records = spark.createDataFrame([("A-B", day, 1), ("CC", day, 2), (None, day, 3), ("DD", day, 4), ("DD", D(2031, 3, 15), 5)], "symbol string, settlement_date date, shares long")
    universe = spark.createDataFrame([("A.B", "1"), ("A-B", "2"), ("DD", "3")], "ticker string, security_id string")
    schedule = spark.createDataFrame([(day,)], "settlement_date date")
    out = short_interest.unplaced_short_interest(records, schedule, universe)
    assert {(r["shares"], r["reason"]) for r in out.collect()} == {
        (1, "TICKER_IDENTITY_CONFLICT"), (2, "NO_SECURITY"), (3, "NO_SECURITY"), (5, "UNSCHEDULED_SETTLEMENT_DATE")}
