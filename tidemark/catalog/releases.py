"""Release gates over many releases at once: suppliers stand for releases, line numbers for dataset groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import FEED, VALID, Tables, day, listed, price_feed, query, r6, securities, split_feed
from tidemark.catalog.gates import capabilities, _STATE
from tidemark.functions import QuotePolicy
from tidemark.operators import calendar
from tidemark.operators import stats as st
from tidemark.plans import clocks, composition, gates, live, market, short_interest

# ---- group clocks: a line is one retrieval of a table (status, flag) of the group of its line number
_GROUP_OF = dict(enumerate(("identity", "market", "total_returns", "fundamentals", "filings_events", "short_interest", "news"), 1))
_GROUP_CASE = "CASE l_linenumber " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _GROUP_OF.items()) + " END"
_TARGET, _NOW = "1998-06-15", "1998-06-15 21:30:00"


def _sql(value: object) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, (bool, int)) else f"'{value}'"


def _clock_rows() -> str:
    rows = []
    for group, _, _ in gates.GROUPS:
        lag = clocks.SESSION_CLOCKS.get(group)
        hours = clocks.IDENTITY_HOURS if group == "identity" else clocks.OTHER_HOURS
        rows.append((group, "SESSIONS", None, None, *lag) if lag else (group, "HOURS", *hours, None, False))
    return ", ".join("(" + ", ".join(map(_sql, r)) + ")" for r in rows)


def _group() -> Column:
    return F.element_at(F.create_map(*[x for k, v in _GROUP_OF.items() for x in (F.lit(k), F.lit(v))]), F.col("l_linenumber"))


def _observed(t: Tables) -> DataFrame:
    """Newest state of each table of each group, as far as it was known at the target."""
    lines = t.lineitem.filter(F.to_date("l_shipdate") <= day(_TARGET))
    return lines.groupBy(F.col("l_suppkey").alias("release_id"), _group().alias("group_id"), (F.col("l_quantity") > 25).alias("table")).agg(
        F.max(F.to_date("l_shipdate")).alias("observed_session"),
        F.max(F.timestamp_micros(F.unix_micros(F.col("l_shipdate").cast("timestamp")) + F.col("l_orderkey") % 24 * 3_600_000_000)).alias("retrieved_at"),
        (F.max("l_tax") >= 0.05).alias("certified"),
    )


_SESSIONS = "sess AS (SELECT d, row_number() OVER (ORDER BY d) AS o FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE isodow(l_shipdate) < 6))"


def _sessions(t: Tables) -> DataFrame:
    return calendar.session_dimension(t.lineitem.select(F.to_date("l_shipdate").alias("session_date")).filter(F.weekday("session_date") < 5))


@query("group_clocks", f"""WITH {_SESSIONS}, clk AS (SELECT * FROM (VALUES {_clock_rows()}) v(group_id, clock, ready_hours, disabled_hours, most, lane)),
tab AS (SELECT l_suppkey AS release_id, {_GROUP_CASE} AS group_id, l_quantity > 25 AS t, max(CAST(l_shipdate AS DATE)) AS s, max(l_shipdate + to_hours(CAST(l_orderkey % 24 AS INT))) AS r, max(l_tax) >= 0.05 AS c FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '{_TARGET}' GROUP BY ALL),
old AS (SELECT release_id, group_id, min(s) AS s, min(r) AS r, bool_and(c) AS c FROM tab GROUP BY 1, 2),
due AS (SELECT *, DATE '{_TARGET}' AS need FROM old LEFT JOIN clk USING (group_id)),
j AS (SELECT due.*, b.o - a.o AS lag, greatest(0.0, (epoch_us(TIMESTAMP '{_NOW}') - epoch_us(r)) / 3600000000.0) AS hours
  FROM due ASOF LEFT JOIN sess a ON s >= a.d ASOF LEFT JOIN sess b ON need >= b.d),
w AS (SELECT *, CASE WHEN lag IS NULL THEN 'observed=' || s || ', required=' || need || ', outside the calendar' WHEN lane AND NOT c THEN 'lane is not certified' WHEN lag > most THEN 'observed=' || s || ', required=' || need || ', sessions behind=' || lag END AS behind FROM j)
SELECT release_id, group_id, clock, s AS observed_session, need AS required_session, CASE WHEN clock = 'SESSIONS' THEN lag END AS lag_sessions, CASE WHEN clock = 'HOURS' THEN round(hours, 6) END AS lag_hours,
  CASE WHEN clock IS NULL THEN 'UNKNOWN' WHEN clock = 'SESSIONS' THEN CASE WHEN behind IS NULL THEN 'READY' ELSE 'STALE' END WHEN hours <= ready_hours THEN 'READY' WHEN hours <= disabled_hours THEN 'REUSED_WITH_PENALTY' ELSE 'DISABLED' END AS state,
  CASE WHEN clock IS NULL THEN 'group has no clock' WHEN clock = 'SESSIONS' THEN behind WHEN hours > ready_hours THEN 'retrieved ' || CAST(floor(hours) AS BIGINT) || ' hours ago, limit ' || ready_hours END AS reason FROM w""")
def group_clocks(t: Tables) -> DataFrame:
    out = clocks.judge_clocks(
        _observed(t), clocks.clock_dimension(t.spark), _sessions(t), target=day(_TARGET), as_of=F.lit(_NOW).cast("timestamp"), keys=["release_id"]
    )
    return out.withColumn("lag_hours", r6("lag_hours"))


_RULES = ", ".join(
    f"('{p}', '{c}', '{lane}')" for p, c, lane in [
        *((p, "broad_market_current", "market") for p, required, _, _ in gates.PHASES if "broad_market_current" in required),
        *((p, c, "benchmark") for p in clocks.BENCHMARK_PHASES for c in clocks.BENCHMARK_TARGETS), ("saturday_replay", "canonical_replay", "market"),
    ]
)


@query("target_session_gates", f"""WITH {_STATE}, rul AS (SELECT * FROM (VALUES {_RULES}) v(phase_id, capability_id, lane_id)),
seen AS (SELECT l_suppkey AS release_id, CASE WHEN l_linenumber < 4 THEN 'market' ELSE 'benchmark' END AS lane_id, max(CAST(l_shipdate AS DATE)) AS observed FROM lineitem WHERE l_linenumber < 7 GROUP BY 1, 2),
tgt AS (SELECT l_suppkey AS release_id, max(CAST(l_shipdate AS DATE)) AS need FROM lineitem GROUP BY 1),
x AS (SELECT tgt.release_id, ph.phase_id, ph.capability_id, role, cs.state, reason, need, lane_id, observed, lane_id IS NOT NULL AND observed IS DISTINCT FROM need AS misses
  FROM tgt CROSS JOIN ph JOIN cs USING (capability_id) LEFT JOIN rul ON rul.phase_id = ph.phase_id AND rul.capability_id = ph.capability_id LEFT JOIN seen USING (release_id, lane_id))
SELECT release_id, phase_id, capability_id, role, CASE WHEN misses THEN 'STALE' ELSE state END AS state, CASE WHEN misses THEN lane_id || ' lane: observed=' || coalesce(CAST(observed AS VARCHAR), 'none') || ', required=' || need ELSE reason END AS reason FROM x""")
def target_session_gates(t: Tables) -> DataFrame:
    """Each release targets its last ship date, in every phase."""
    shipped = t.lineitem.select(F.col("l_suppkey").alias("release_id"), "l_linenumber", F.to_date("l_shipdate").alias("d"))
    lanes = shipped.filter("l_linenumber < 7").groupBy("release_id", F.when(F.col("l_linenumber") < 4, "market").otherwise("benchmark").alias("lane")).agg(
        F.max("d").alias("observed_session")
    )
    every = F.explode(F.array(*[F.lit(p) for p, *_ in gates.PHASES])).alias("phase_id")
    targets = shipped.groupBy("release_id").agg(F.max("d").alias("reference_session")).select("release_id", every, "reference_session")
    return clocks.target_session_gates(
        capabilities(t), gates.phase_dimension(t.spark), targets, lanes, clocks.target_dimension(t.spark), ["release_id"]
    )


# ---- snapshots of twenty events; k of an event and the number of its snapshot plant the faults
_CUT = "2024-03-04 15:00:00"
_LIVE_POLICY = QuotePolicy()


def _snapshots(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    base = F.lit(_CUT).cast("timestamp")
    after = lambda s: F.timestamp_micros(F.unix_micros(base) + (s * 1_000_000).cast("bigint"))
    snap = F.floor(F.col("event_id") / 20).cast("bigint")
    e = t.events.select("user_id", snap.alias("snapshot_id"), F.from_json("props", "k int")["k"].alias("k"))
    k, kind = F.col("k"), F.col("snapshot_id") % 12
    why = F.when(k == 7, "UNKNOWN_MARKET_SESSION").when(k == 50, "SECURITY_HALTED").when(k == 56, "BROKER_INELIGIBLE_OR_UNKNOWN")
    ids = lambda bad, field, currency: [
        F.when((k == bad) & F.lit(field == "symbol"), "?").otherwise("S").alias("symbol"), F.when((k == bad) & F.lit(field == "mic"), "?").otherwise("XNYS").alias("exchange_mic"),
        *([F.when((k == bad) & F.lit(field == "currency"), "EUR").otherwise("USD").alias("currency")] if currency else []),
    ]
    records = e.select(
        "snapshot_id", F.when(k != 8, F.col("user_id")).alias("security_id"), F.lit("S").alias("symbol"), F.lit("XNYS").alias("exchange_mic"), F.lit("USD").alias("currency"),
        F.struct(
            F.lit("SIP_NBBO").alias("feed_type"), F.lit("AVAILABLE").alias("state"), F.lit(100.0).alias("bid"), F.lit(100.1).alias("ask"), F.lit(None).cast("double").alias("last"),
            F.lit(1.0).alias("bid_size"), F.lit(1.0).alias("ask_size"), F.when(k == 7, "CLOSED").otherwise("REGULAR").alias("session"), after(F.lit(-2)).alias("quote_at_utc"), *ids(1, "symbol", True),
        ).alias("quote"),
        F.struct(
            F.when(k == 50, "HALTED").otherwise("NOT_HALTED").alias("halt_status"), F.lit("NORMAL").alias("luld_status"), F.lit(None).cast("double").alias("lower_band"),
            F.lit(None).cast("double").alias("upper_band"), after(F.lit(-2)).alias("observed_at_utc"), *ids(2, "mic", False),
        ).alias("market_status"),
        F.struct((k != 56).alias("eligible"), F.array(F.lit("OK")).alias("reason_codes"), after(F.lit(-2)).alias("observed_at_utc"), *ids(3, "currency", True)).alias("broker_eligibility"),
        after(F.lit(-3)).alias("requested_at_utc"), after(F.lit(-2)).alias("received_at_utc"),
        F.when(why.isNull() | (k == 4), "READY").otherwise("BLOCKED").alias("status"),
        F.when(k == 5, F.array(F.lit("CROSSED_MARKET"))).otherwise(F.array_compact(F.array(why))).alias("block_reasons"), why.isNotNull().alias("down"),
    )
    generated = F.when(kind == 7, 61).when(kind == 8, -1).otherwise(1)
    headers = records.filter("snapshot_id % 50 <> 0").groupBy("snapshot_id").agg(F.count_if("down").alias("n")).select(
        "snapshot_id", F.when((F.col("n") == 0) != (kind == 10), "READY").otherwise("BLOCKED").alias("status"), base.alias("actual_cutoff_utc"), after(generated).alias("generated_at_utc"),
    )
    role = F.explode(F.array(*[F.lit(r) for r in live.ROLE_FEEDS])).alias("role")
    providers = headers.select("snapshot_id", role).filter(~((kind == 3) & (F.col("role") == "market_status"))).select(
        "snapshot_id", "role",
        F.when(F.col("role") == "quote", F.when(kind == 6, "DIRECT_NBBO").otherwise("SIP_NBBO")).when(F.col("role") == "market_status", "EXCHANGE_STATUS")
        .otherwise(F.when(kind == 11, "SIP_NBBO").otherwise("BROKER_ELIGIBILITY")).alias("feed_type"),
        F.when((kind == 9) & (F.col("role") == "quote"), " ").otherwise("p").alias("provider_id"), *[F.lit("x").alias(f) for f in ("entitlement_scope", "request_id", "provider_response_id")],
        after(F.when(kind == 4, -6).when(kind == 5, 3).otherwise(-2)).alias("observed_at_utc"),
    )
    return headers, providers, records.drop("down")


def _planted(code: str, test: str) -> str:
    return f"CASE WHEN {test} THEN '{code}' END"


@query("snapshot_verdicts", f"""WITH e AS (SELECT event_id // 20 AS snapshot_id, user_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events),
u AS (SELECT *, count(*) OVER (PARTITION BY snapshot_id, CASE WHEN k <> 8 THEN user_id END) AS same FROM e),
s AS (SELECT snapshot_id, snapshot_id % 12 AS kind, snapshot_id % 50 <> 0 AS known, count(*) AS securities, count(*) FILTER (WHERE k IN (7, 50, 56)) AS blocked,
  bool_or(k = 1) AS k1, bool_or(k = 2) AS k2, bool_or(k = 3) AS k3, bool_or(k = 5) AS k5, bool_or(k = 8) AS k8, bool_or(k <> 8 AND same > 1) AS twice FROM u GROUP BY 1),
x AS (SELECT *, list_filter([{_planted('NO_HEADER', 'NOT known')}, {_planted('GENERATED_BEFORE_CUTOFF', 'known AND kind = 8')}, {_planted('GENERATED_TOO_LATE', 'known AND kind = 7')},
  {_planted('PROVIDER_ROLES', 'known AND kind = 3')}, {_planted('PROVIDER_IDENTITY', 'known AND kind = 9')}, {_planted('PROVIDER_FEED', 'known AND kind = 11')},
  {_planted('STALE_PROVIDER', 'known AND kind = 4')}, {_planted('FUTURE_PROVIDER', 'known AND kind = 5')}, {_planted('INVALID_SECURITY_ID', 'k8')}, {_planted('DUPLICATE_SECURITY_ID', 'twice')},
  {_planted('QUOTE_IDENTITY', 'k1')}, {_planted('MARKET_STATUS_IDENTITY', 'k2')}, {_planted('BROKER_IDENTITY', 'k3')}, {_planted('QUOTE_FEED_MISMATCH', 'known AND kind = 6')},
  {_planted('WRONG_BLOCK_REASONS', 'known AND k5')}, {_planted('WRONG_SNAPSHOT_STATUS', 'known AND kind = 10')}], lambda c: c IS NOT NULL) AS found FROM s)
SELECT snapshot_id, securities, blocked, CASE WHEN blocked = 0 THEN 'READY' ELSE 'BLOCKED' END AS snapshot_status, array_to_string(found, '|') AS errors, CASE WHEN len(found) = 0 THEN 'VALID' ELSE 'INVALID' END AS verdict FROM x
WHERE known""")
def snapshot_verdicts(t: Tables) -> DataFrame:
    """Records without a header have no clock to be judged by; their snapshots are shown by the tests."""
    out = live.snapshot_verdicts(*_snapshots(t), policy=_LIVE_POLICY)
    return out.withColumn("errors", listed("errors")).filter(~F.col("errors").contains("NO_HEADER"))


# ---- composition: lines of both statuses are the market of a candidate and of an older release
_VERSIONS = """vers AS (SELECT s.l_suppkey AS release_id, g.group_id, v.version,
  CASE g.group_id WHEN 'identity' THEN l_suppkey % 5 <> v.version WHEN 'market' THEN v.version = 1 OR l_suppkey % 2 = 0 WHEN 'filings_events' THEN v.version = 1 OR l_suppkey % 4 <> 2 ELSE l_suppkey % 7 <> 6 END AS valid,
  l_suppkey % 10 * 40.0 * v.version AS lag_hours, CAST(l_suppkey % 4 AS INT) AS lag_sessions
  FROM (SELECT DISTINCT l_suppkey FROM lineitem) s CROSS JOIN (VALUES ('identity'), ('market'), ('filings_events'), ('insiders')) g(group_id) CROSS JOIN (VALUES (0), (1)) v(version))"""


def _versions(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    s, v = F.col("release_id"), F.col("version")
    lines = t.lineitem.select(
        F.col("l_suppkey").alias("release_id"), F.when(F.col("l_linestatus") == "O", 0).otherwise(1).alias("version"), (F.col("l_partkey") % 40).alias("security_id"),
        F.to_date(F.date_trunc("year", "l_shipdate")).alias("session_date"),
    )
    both = F.explode(F.array(F.lit(0), F.lit(1))).alias("version")
    named = F.explode(F.array(*[F.lit(g) for g in ("identity", "market", "filings_events", "insiders")])).alias("group_id")
    g = F.col("group_id")
    valid = (
        F.when(g == "identity", s % 5 != v).when(g == "market", (v == 1) | (s % 2 == 0)).when(g == "filings_events", (v == 1) | (s % 4 != 2)).otherwise(s % 7 != 6)
    )
    versions = lines.select("release_id").distinct().select("release_id", both).select("*", named).select(
        "release_id", "group_id", "version", valid.alias("valid"), F.lit("READY_NEW").alias("candidate_state"), (s % 10 * 40.0 * v).alias("lag_hours"), (s % 4).cast("int").alias("lag_sessions")
    )
    odd = (s % 3 == 0) & (F.col("security_id") == s % 40)
    master = lines.filter(~odd).select("release_id", "security_id").distinct().select("release_id", both, "security_id")
    return versions, lines, master


_COMPOSED = f"""{_VERSIONS}, chosen AS (SELECT release_id, group_id, min(version) FILTER (WHERE valid) AS version FROM vers GROUP BY 1, 2),
c AS (SELECT chosen.*, lag_hours, lag_sessions FROM chosen LEFT JOIN vers USING (release_id, group_id, version)),
mk AS (SELECT l_suppkey AS release_id, CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END AS version, l_partkey % 40 AS security_id, CAST(date_trunc('year', l_shipdate) AS DATE) AS d FROM lineitem),
adm AS (SELECT DISTINCT release_id, security_id FROM mk SEMI JOIN (SELECT release_id FROM c WHERE group_id = 'identity' AND version IS NOT NULL) USING (release_id) WHERE NOT (release_id % 3 = 0 AND security_id = release_id % 40)),
mine AS (SELECT mk.release_id, mk.security_id, d, adm.security_id IS NOT NULL AS ok FROM mk JOIN (SELECT release_id, version FROM c WHERE group_id = 'market') USING (release_id, version) LEFT JOIN adm USING (release_id, security_id)),
fin AS (SELECT release_id, max(d) FILTER (WHERE ok) AS hi, count(*) FILTER (WHERE NOT ok) AS excl FROM mine GROUP BY 1),
ms AS (SELECT r.release_id, coalesce(excl, 0) AS excl, coalesce((SELECT count(DISTINCT security_id) FROM mine m WHERE m.release_id = r.release_id AND ok AND d = hi) / nullif((SELECT count(*) FROM adm a WHERE a.release_id = r.release_id), 0), 0.0) AS cov
  FROM (SELECT DISTINCT release_id FROM c) r LEFT JOIN fin USING (release_id)),
own AS (SELECT c.*, excl, cov, CASE WHEN version IS NULL THEN 'MISSING' WHEN version = 0 THEN 'READY_NEW' WHEN CASE WHEN group_id = 'market' THEN lag_sessions <= 2 ELSE lag_hours <= CASE WHEN group_id = 'identity' THEN 72 ELSE 336 END END THEN 'READY_REUSED' ELSE 'STALE_DISABLED' END AS o FROM c JOIN ms USING (release_id)),
own2 AS (SELECT *, CASE WHEN group_id <> 'market' OR o NOT LIKE 'READY%' THEN o WHEN excl > 0 AND version = 0 THEN 'UNKNOWN_SECURITY_ID' WHEN cov < 0.95 THEN 'QUARANTINED' WHEN excl > 0 THEN 'READY_WITH_EXCLUSIONS' ELSE o END AS s FROM own),
dp AS (SELECT release_id, bool_or(group_id = 'identity' AND s LIKE 'READY%') AS idok, bool_or(group_id = 'filings_events' AND s LIKE 'READY%') AS feok FROM own2 GROUP BY 1),
composed AS (SELECT release_id, group_id, version, CASE WHEN s LIKE 'READY%' AND ((group_id <> 'identity' AND NOT idok) OR (group_id = 'insiders' AND NOT feok)) THEN 'DISABLED_DEPENDENCY' ELSE s END AS state,
  CASE WHEN group_id = 'market' THEN excl END AS exclusions, CASE WHEN group_id = 'market' THEN round(cov, 6) END AS coverage FROM own2 JOIN dp USING (release_id))"""


@query("composed_releases", f"WITH {_COMPOSED} SELECT * FROM composed")
def composed_releases(t: Tables) -> DataFrame:
    return composition.compose_versions(*_versions(t)).withColumn("coverage", r6("coverage"))


@query("release_verdicts", f"""WITH {_COMPOSED}, v AS (SELECT release_id, max(state) FILTER (WHERE group_id = 'identity') AS i, max(state) FILTER (WHERE group_id = 'market') AS m, count(*) FILTER (WHERE state NOT LIKE 'READY%') AS unusable_groups FROM composed GROUP BY 1)
SELECT release_id, CASE WHEN i LIKE 'READY%' AND m LIKE 'READY%' THEN 'READY' ELSE 'REFUSED' END AS status, concat_ws('|', CASE WHEN i NOT LIKE 'READY%' THEN 'IDENTITY_' || i END, CASE WHEN m NOT LIKE 'READY%' THEN 'MARKET_' || m END) AS problems, unusable_groups FROM v""")
def release_verdicts(t: Tables) -> DataFrame:
    return composition.release_verdicts(composition.compose_versions(*_versions(t))).withColumn("problems", listed("problems"))


# ---- the raw feed published as it is, with its invalid and repeated rows
@query("published_market_check", f"""WITH {FEED}, p AS (SELECT security_id, feed.* FROM feed JOIN aliases USING (source_symbol)), q AS (SELECT a.security_id, s.event_date, CASE WHEN s.source_dataset = 'SNAPSHOT' THEN '' ELSE split_factor END AS f FROM splits s JOIN aliases a USING (source_symbol))
SELECT (SELECT count(*) FROM p) AS published_rows, (SELECT count(*) FROM p WHERE NOT {VALID}) AS invalid_rows, (SELECT count(*) - count(DISTINCT (security_id, session_date)) FROM p) AS duplicate_rows,
  (SELECT count(*) FROM p WHERE session_date > DATE '1998-06-15') AS after_cutoff, (SELECT count(*) FROM (SELECT security_id FROM p GROUP BY 1 HAVING count(*) > 30)) AS histories_over_limit,
  (SELECT count(*) - count(DISTINCT (security_id, event_date)) FROM q) AS split_duplicate_rows, (SELECT count(*) FROM q WHERE f = '') AS split_invalid_rows,
  (SELECT count(*) FROM feed) - (SELECT count(*) FROM (SELECT DISTINCT * FROM feed)) AS collapsed_rows""")
def published_market_check(t: Tables) -> DataFrame:
    from tidemark.sources import alias_table

    names = alias_table(securities(t))
    splits = split_feed(t).join(names, "source_symbol").withColumn("split_factor", F.when(F.col("source_dataset") == "SNAPSHOT", "").otherwise(F.col("split_factor")))
    feed = price_feed(t)
    checked = market.published_metrics(feed.join(names, "source_symbol"), splits, cutoff=day("1998-06-15"), n=30)
    return st.side_by_side(checked, market.collapsed_rows(feed))


# ---- short interest: lines report on parts by a spelling that names two securities for one part in ten
_SHORT = """rec AS (SELECT 'P-' || l_partkey AS symbol, last_day(l_shipdate) AS settlement_date, sum(CAST(l_quantity AS BIGINT)) AS shares FROM lineitem GROUP BY 1, 2),
uni AS (SELECT 'P.' || p_partkey AS ticker, p_partkey AS security_id FROM part WHERE p_partkey % 10 <> 7 UNION ALL SELECT 'P-' || p_partkey, -p_partkey FROM part WHERE p_partkey % 10 = 3),
sch AS (SELECT DISTINCT last_day(o_orderdate) AS settlement_date FROM orders WHERE month(o_orderdate) <> 2)"""


@query("short_interest_unplaced", f"""WITH {_SHORT}, v AS (SELECT ticker, security_id FROM uni),
n AS (SELECT symbol, (SELECT count(DISTINCT security_id) FROM v WHERE ticker IN (symbol, replace(symbol, '-', '.'))) AS named FROM (SELECT DISTINCT symbol FROM rec))
SELECT symbol, settlement_date, shares, CASE WHEN named > 1 THEN 'TICKER_IDENTITY_CONFLICT' WHEN named = 0 THEN 'NO_SECURITY' ELSE 'UNSCHEDULED_SETTLEMENT_DATE' END AS reason
FROM (SELECT rec.* REPLACE (CAST(shares AS BIGINT) AS shares), named, sch.settlement_date IS NOT NULL AS due FROM rec JOIN n USING (symbol) LEFT JOIN sch ON sch.settlement_date = rec.settlement_date) WHERE named <> 1 OR NOT due""")
def short_interest_unplaced(t: Tables) -> DataFrame:
    symbol = lambda mark, key: F.concat(F.lit(f"P{mark}"), key)
    rec = t.lineitem.groupBy(symbol("-", "l_partkey").alias("symbol"), F.last_day("l_shipdate").alias("settlement_date")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("shares")
    )
    p = F.col("p_partkey")
    universe = t.part.filter(p % 10 != 7).select(symbol(".", p).alias("ticker"), p.alias("security_id")).unionByName(
        t.part.filter(p % 10 == 3).select(symbol("-", p).alias("ticker"), (-p).alias("security_id"))
    )
    schedule = t.orders.filter(F.month("o_orderdate") != 2).select(F.last_day("o_orderdate").alias("settlement_date")).distinct()
    return short_interest.unplaced_short_interest(rec, schedule, universe)
