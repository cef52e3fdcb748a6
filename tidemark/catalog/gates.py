"""Coverage, freshness, capability and phase gates; quotes; sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import BARS, VALID, Tables, bars, day, listed, naive, query, r6
from tidemark.functions import QuotePolicy, is_invalid_ohlcv, ohlcv_invalid_reason, quote_block_reasons
from tidemark.operators import calendar
from tidemark.plans import coverage as cov
from tidemark.plans import gates as g

# ---- coverage of customers by daily bars
_STATES = f"""seen AS (SELECT security_id, max(session_date) AS latest, bool_or(session_date = DATE '2024-01-30' AND {VALID}) AS ok,
  min(CASE WHEN session_date = DATE '2024-01-30' AND NOT {VALID} THEN CASE WHEN open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 THEN 'NON_POSITIVE_OHLC' ELSE 'INVALID_OHLC_BOUNDS' END END) AS why FROM bars GROUP BY 1),
states AS (SELECT c_mktsegment, CAST(c_nationkey AS VARCHAR) AS nation, CASE WHEN ok THEN 'VALID' WHEN why IS NOT NULL THEN 'INVALID' WHEN latest < DATE '2024-01-30' THEN 'STALE' ELSE 'MISSING' END AS state,
  CASE WHEN ok THEN NULL WHEN why IS NOT NULL THEN why WHEN latest < DATE '2024-01-30' THEN 'STALE_SOURCE_MAX_SESSION_' || latest WHEN c_acctbal < 0 THEN 'PROVIDER_RETRIES_EXHAUSTED' ELSE 'MISSING_CURRENT_SESSION_ROW' END AS code
  FROM customer LEFT JOIN seen ON security_id = c_custkey)"""


def _states(t: Tables) -> DataFrame:
    universe = t.customer.select(F.col("c_custkey").alias("security_id"), "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"))
    b = bars(t)
    expected = day("2024-01-30")
    invalid = b.filter((F.col("session_date") == expected) & is_invalid_ohlcv()).select("security_id", ohlcv_invalid_reason().alias("reason"))
    failures = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("security_id"))
    return cov.coverage_states(
        universe, b, key="security_id", date="session_date", expected=expected, valid=~is_invalid_ohlcv(), invalid=invalid, failures=failures,
    )


@query("coverage_diagnostic", f"""WITH {BARS}, {_STATES} SELECT CASE grouping(c_mktsegment, nation, state, code) WHEN 15 THEN 'total' WHEN 13 THEN 'state' WHEN 14 THEN 'rejection_code' WHEN 5 THEN 'c_mktsegment+state' ELSE 'nation+state' END AS grouping,
  c_mktsegment, nation, state, code AS rejection_code, count(*) AS securities, count(*) FILTER (WHERE state = 'VALID') AS valid_securities FROM (SELECT c_mktsegment, nation, state, coalesce(code, '-') AS code, state AS s2 FROM states)
GROUP BY GROUPING SETS ((), (state), (code), (c_mktsegment, state), (nation, state)) HAVING NOT (grouping(code) = 0 AND code = '-')""".replace("count(*) FILTER (WHERE state = 'VALID')", "count(*) FILTER (WHERE s2 = 'VALID')"))
def coverage_diagnostic(t: Tables) -> DataFrame:
    return cov.coverage_diagnostic(_states(t), ["c_mktsegment", "nation"])


# ---- groups: event types stand for dataset groups
_GROUPS = {"click": "identity", "error": "market", "purchase": "filings_events", "signup": "total_returns", "view": "fundamentals"}
_GROUP_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _GROUPS.items()) + " END"
_AS_OF = "TIMESTAMP '2024-01-02 06:00:00'"
_FRESH = f"""obs AS (SELECT {_GROUP_SQL} AS group_id, min(ts) AS observed_at FROM events GROUP BY 1),
fresh AS (SELECT *, greatest(0.0, (epoch_us({_AS_OF}) - epoch_us(observed_at)) / 3600000000.0) AS lag_hours FROM obs),
grp AS (SELECT *, CASE WHEN lag_hours <= CASE WHEN group_id = 'identity' THEN 24 ELSE 192 END THEN 'READY' WHEN lag_hours <= CASE WHEN group_id = 'identity' THEN 72 ELSE 336 END THEN 'REUSED_WITH_PENALTY' ELSE 'DISABLED' END AS freshness_state FROM fresh)"""


def _as_of():
    return F.lit("2024-01-02 06:00:00").cast("timestamp")


def freshness(t: Tables) -> DataFrame:
    group = F.element_at(F.create_map(*[F.lit(x) for kv in _GROUPS.items() for x in kv]), F.col("event_type"))
    rows = t.events.select(group.alias("group_id"), F.col("ts").cast("timestamp").alias("source_retrieved_at_utc"))
    return g.group_freshness(rows, _as_of())


@query("group_freshness", f"WITH {_FRESH} SELECT group_id, observed_at, round(lag_hours, 6) AS lag_hours, CAST(floor(lag_hours / 24) AS BIGINT) AS lag_days, freshness_state FROM grp")
def group_freshness(t: Tables) -> DataFrame:
    return freshness(t).select("group_id", naive("observed_at"), r6("lag_hours").alias("lag_hours"), "lag_days", "freshness_state")


def _sql(value: object) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else f"'{value}'"


_CAPS = f"""caps AS (SELECT * FROM (VALUES {', '.join('(' + ', '.join(_sql(v) for v in c) + ')' for c in g.CAPABILITIES)}) c(capability_id, source_group, maximum_age_seconds, rule)),
ph AS (SELECT * FROM (VALUES {', '.join(f"('{p}', '{c}', '{role}')" for p, a, b, e in g.PHASES for role, cs in (('REQUIRED', a), ('OPTIONAL', b), ('EXTERNAL', e)) for c in cs)}) p(phase_id, capability_id, role))"""
_STATE = f"""{_FRESH}, {_CAPS}, lane AS (SELECT CASE WHEN count(*) >= 3 THEN 'READY' ELSE 'INVALID' END AS state, 'READY' AS identity_state, CASE WHEN max(ts) > TIMESTAMP '2024-01-30' THEN 'READY' ELSE 'STALE' END AS market_state,
  min(ts) AS identity_at, TIMESTAMP '2024-01-02 05:30:00' AS lane_at FROM events WHERE event_type = 'signup'),
cs0 AS (SELECT rule, freshness_state, CASE capability_id WHEN 'benchmark_identity' THEN identity_state WHEN 'benchmark_market_current' THEN market_state ELSE lane.state END AS lane_state,
  capability_id, source_group, maximum_age_seconds, CASE WHEN rule = 'LANE' THEN CASE WHEN capability_id = 'benchmark_identity' THEN identity_at ELSE lane_at END WHEN rule NOT IN ('EXTERNAL', 'ABSENT') THEN grp.observed_at END AS observed_at,
  CASE rule WHEN 'EXTERNAL' THEN 'CONSUMER_REQUIRED' WHEN 'ABSENT' THEN 'NOT_CONFIGURED'
  WHEN 'LANE' THEN CASE WHEN (CASE capability_id WHEN 'benchmark_identity' THEN identity_state WHEN 'benchmark_market_current' THEN market_state ELSE state END) <> 'READY' THEN (CASE capability_id WHEN 'benchmark_identity' THEN identity_state WHEN 'benchmark_market_current' THEN market_state ELSE state END)
     WHEN freshness_state IS NULL THEN 'NOT_CONFIGURED' WHEN freshness_state = 'DISABLED' THEN 'STALE_DISABLED'
     WHEN epoch_us({_AS_OF}) - epoch_us(CASE WHEN capability_id = 'benchmark_identity' THEN identity_at ELSE lane_at END) > maximum_age_seconds * 1000000.0 THEN 'STALE' ELSE 'READY' END
  ELSE CASE WHEN freshness_state IS NULL THEN 'NOT_CONFIGURED' WHEN freshness_state = 'DISABLED' THEN 'STALE_DISABLED' WHEN rule = 'LAG' AND source_group <> 'market' THEN 'STALE'
     WHEN maximum_age_seconds IS NOT NULL AND lag_hours * 3600 > maximum_age_seconds THEN 'STALE' ELSE 'READY' END END AS state
  FROM caps LEFT JOIN grp ON grp.group_id = caps.source_group CROSS JOIN lane),
cs AS (SELECT capability_id, source_group, maximum_age_seconds, observed_at, state, CASE WHEN rule = 'EXTERNAL' THEN 'supplied by the consumer' WHEN rule = 'ABSENT' THEN 'lane is not configured' WHEN state = 'READY' THEN NULL
  WHEN rule = 'LANE' AND lane_state <> 'READY' THEN 'benchmark lane is ' || lane_state WHEN freshness_state IS NULL THEN 'source group is absent' WHEN freshness_state = 'DISABLED' THEN 'source group is STALE_DISABLED'
  WHEN rule = 'LAG' THEN 'market is behind its expected session' WHEN state = 'STALE' THEN 'source is older than ' || maximum_age_seconds || ' seconds' END AS reason FROM cs0),
pr AS (SELECT ph.*, coalesce(cs.state, 'NOT_CONFIGURED') AS state FROM ph LEFT JOIN cs USING (capability_id)),
ps AS (SELECT phase_id, count(*) FILTER (WHERE role = 'REQUIRED' AND state <> 'READY') AS rd, count(*) FILTER (WHERE role = 'OPTIONAL' AND state <> 'READY') AS od, count(*) FILTER (WHERE role = 'EXTERNAL') AS ext,
  coalesce(string_agg(DISTINCT CASE WHEN role <> 'EXTERNAL' AND state <> 'READY' THEN 'CAPABILITY_' || upper(capability_id) || '_' || state END, '|' ORDER BY CASE WHEN role <> 'EXTERNAL' AND state <> 'READY' THEN 'CAPABILITY_' || upper(capability_id) || '_' || state END), '') AS codes,
  count(*) FILTER (WHERE role = 'REQUIRED' AND state = 'READY' AND capability_id IN ('benchmark_identity', 'benchmark_market_current', 'certified_total_returns', 'funded_benchmark_inputs')) AS bench FROM pr GROUP BY 1),
pstate AS (SELECT *, CASE WHEN rd > 0 THEN 'BLOCKED' WHEN od > 0 THEN 'DEGRADED' ELSE 'READY' END AS status FROM ps)"""


def capabilities(t: Tables) -> DataFrame:
    fresh = freshness(t)
    state = F.when(F.col("freshness_state") == "DISABLED", "STALE_DISABLED").otherwise("READY_NEW")
    groups = fresh.select("group_id", state.alias("state"), F.when(F.col("group_id") == "market", 0).alias("lag_sessions"), "lag_hours", "observed_at")
    lane = t.events.filter("event_type = 'signup'").agg(
        F.when(F.count(F.lit(1)) >= 3, "READY").otherwise("INVALID").alias("state"), F.lit("READY").alias("identity_state"),
        F.when(F.max("ts") > F.lit("2024-01-30").cast("timestamp_ntz"), "READY").otherwise("STALE").alias("market_state"),
        F.min(F.col("ts").cast("timestamp")).alias("identity_observed_at"), F.lit("2024-01-02 05:30:00").cast("timestamp").alias("observed_at"),
    )
    return g.capability_states(groups, g.capability_dimension(t.spark), lane, _as_of())


@query("capability_states", f"WITH {_STATE} SELECT capability_id, state, source_group, observed_at, maximum_age_seconds, reason FROM cs")
def capability_states(t: Tables) -> DataFrame:
    return capabilities(t).withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))


@query("phase_states", f"""WITH {_STATE} SELECT phase_id, status, codes AS rejection_codes, concat_ws('|', 'ARTIFACT_VALID', CASE WHEN phase_id IN ('sunday', 'accounting') AND bench = 4 THEN 'BENCHMARK_ONLY_SAFE' END, CASE WHEN phase_id <> 'accounting' AND rd = 0 AND od = 0 THEN 'CHALLENGER_RESEARCH_READY' END,
  CASE WHEN ext > 0 THEN 'LIVE_SNAPSHOT_REQUIRED' END, CASE WHEN rd > 0 OR od > 0 THEN 'CHALLENGER_BLOCKED' END) AS operating_modes, ext > 0 AS live_snapshot_required FROM pstate""")
def phase_states(t: Tables) -> DataFrame:
    out = g.phase_states(capabilities(t), g.phase_dimension(t.spark))
    return out.select("phase_id", "status", listed("rejection_codes").alias("rejection_codes"), listed("operating_modes").alias("operating_modes"), "live_snapshot_required")


_TORONTO = "timezone('UTC', timezone('America/Toronto', CAST({d} || ' {t}' AS TIMESTAMP)))"


def _window_sql() -> str:
    """Eight windows per event day, written out as SQL."""
    nxt, sat, sun = "n", "sat", "sun"
    at = lambda d, t: _TORONTO.format(d=f"CAST({d} AS VARCHAR)", t=t)
    plus = lambda m: f"close_utc + INTERVAL {m} MINUTE"
    rows = [
        ("pre_open", "PRE_OPEN", at(nxt, "08:10:00"), at(nxt, "08:05:00"), at(nxt, "09:30:00")),
        ("execution_research", "EXECUTION_RESEARCH", at(nxt, "09:38:00"), at(nxt, "09:30:00"), at(nxt, "09:45:00")),
        ("exception_monitoring", "OPEN_EXCEPTION", at(nxt, "09:55:00"), at(nxt, "09:50:00"), at(nxt, "10:05:00")),
        ("exception_monitoring", "CLOSE_EXCEPTION", at(nxt, "15:25:00"), at(nxt, "15:20:00"), at(nxt, "15:35:00")),
        ("terminal_review", "TERMINAL_REVIEW", plus(20), plus(15), plus(45)), ("accounting", "ACCOUNTING", plus(45), plus(40), at(nxt, "07:45:00")),
        ("saturday_replay", "SATURDAY_REPLAY", at(sat, "08:30:00"), at(sat, "08:00:00"), at("(sat + 1)", "17:15:00")),
        ("sunday", "SUNDAY", at(sun, "17:30:00"), at(sun, "17:15:00"), at("post", "07:45:00")),
    ]
    union = " UNION ALL ".join(f"SELECT d, '{p}' AS phase_id, '{w}' AS window_id, {c} AS decision_cutoff_utc, {a} AS not_before_utc, {e} AS expires_at_utc FROM s3" for p, w, c, a, e in rows)
    return f"""s1 AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
s2 AS (SELECT d, lead(d) OVER (ORDER BY d) AS n, timezone('UTC', timezone('America/New_York', CAST(CAST(d AS VARCHAR) || ' 16:00:00' AS TIMESTAMP))) AS close_utc,
  d + CAST(CASE WHEN isodow(d) = 6 THEN 7 ELSE (6 - isodow(d) + 7) % 7 END AS INT) AS sat, d + CAST(CASE WHEN isodow(d) = 7 THEN 7 ELSE 7 - isodow(d) END AS INT) AS sun FROM s1),
s3 AS (SELECT *, (SELECT min(x.d) FROM s1 x WHERE x.d >= s2.sun) AS post FROM s2), windows AS ({union})"""


def sessions(t: Tables) -> DataFrame:
    return calendar.session_dimension(t.orders.select(F.to_date("o_orderdate").alias("session_date")))


@query("phase_windows", f"WITH {_window_sql()} SELECT d AS session_date, phase_id, window_id, decision_cutoff_utc, not_before_utc, expires_at_utc FROM windows WHERE decision_cutoff_utc IS NOT NULL AND not_before_utc IS NOT NULL AND expires_at_utc IS NOT NULL")
def phase_windows(t: Tables) -> DataFrame:
    clocks = ("decision_cutoff_utc", "not_before_utc", "expires_at_utc")
    return g.phase_windows(sessions(t)).select("session_date", "phase_id", "window_id", *[naive(c) for c in clocks])


@query("phase_usable_at", f"""WITH {_STATE}, {_window_sql()}, act AS (SELECT phase_id, arg_min(window_id, not_before_utc) AS active_window_id FROM windows WHERE decision_cutoff_utc IS NOT NULL AND TIMESTAMP '1998-06-15 13:56:00' BETWEEN not_before_utc AND expires_at_utc GROUP BY 1),
late AS (SELECT ph.phase_id, string_agg('CAPABILITY_' || upper(capability_id) || CASE WHEN TIMESTAMP '1998-06-15 13:56:00' < observed_at THEN '_NOT_KNOWN_AT_AS_OF' ELSE '_STALE_AT_AS_OF' END, '|') AS fresh FROM ph JOIN cs USING (capability_id)
  WHERE role = 'REQUIRED' AND state = 'READY' AND maximum_age_seconds IS NOT NULL AND observed_at IS NOT NULL AND (TIMESTAMP '1998-06-15 13:56:00' < observed_at OR epoch_us(TIMESTAMP '1998-06-15 13:56:00') - epoch_us(observed_at) > maximum_age_seconds * 1000000.0) GROUP BY 1),
codes AS (SELECT phase_id, unnest(string_split(concat_ws('|', nullif(codes, ''), fresh, CASE WHEN active_window_id IS NULL THEN 'PHASE_WINDOW_NOT_ACTIVE' END, CASE WHEN ext > 0 THEN 'CONSUMER_LIVE_SNAPSHOT_REQUIRED' END), '|')) AS code FROM pstate LEFT JOIN act USING (phase_id) LEFT JOIN late USING (phase_id))
SELECT phase_id, CASE WHEN active_window_id IS NOT NULL AND ext = 0 AND fresh IS NULL AND status IN ('READY', 'DEGRADED') THEN 'USABLE' ELSE 'BLOCKED' END AS usability, active_window_id,
  coalesce((SELECT string_agg(DISTINCT code, '|' ORDER BY code) FROM codes c WHERE c.phase_id = p.phase_id AND code <> ''), '') AS rejection_codes FROM pstate p LEFT JOIN act USING (phase_id) LEFT JOIN late USING (phase_id)""")
def phase_usable_at(t: Tables) -> DataFrame:
    caps, phases = capabilities(t), g.phase_dimension(t.spark)
    out = g.phase_usable_at(
        g.phase_states(caps, phases), phases, caps, g.phase_windows(sessions(t)), F.lit("1998-06-15 13:56:00").cast("timestamp"), allow_degraded=True
    )
    return out.withColumn("rejection_codes", listed("rejection_codes"))


@query("dependency_closure", f"""WITH {_FRESH}, dep AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{d}')" for a, ds, _ in g.GROUPS for d in ds)}) v(dependent, dependency))
SELECT dependent, dependency, CASE WHEN b.group_id IS NULL OR b.freshness_state = 'DISABLED' OR b.freshness_state = 'REUSED_WITH_PENALTY' THEN 'DISABLED_DEPENDENCY' ELSE 'DEPENDENCY_IDENTITY_MISMATCH' END AS problem
FROM dep JOIN grp a ON a.group_id = dependent LEFT JOIN grp b ON b.group_id = dependency WHERE a.freshness_state = 'READY' AND (b.group_id IS NULL OR b.freshness_state <> 'READY' OR a.lag_hours > b.lag_hours)""")
def dependency_closure(t: Tables) -> DataFrame:
    """A dependent built before its dependency was refreshed carries an old identity."""
    fresh = freshness(t).withColumn("state", F.when(F.col("freshness_state") == "READY", "READY_NEW").otherwise("STALE_DISABLED"))
    names = g.group_dimension(t.spark).select(F.col("group_id").alias("dependent"), F.explode("dependencies").alias("group_id"))
    pairs = names.join(fresh.select(F.col("group_id").alias("dependent"), F.col("lag_hours").alias("mine")), "dependent").join(
        fresh.select("group_id", F.col("lag_hours").alias("theirs")), "group_id", "left"
    )
    expected = F.when(F.col("mine") > F.col("theirs"), F.lit("old")).otherwise(F.col("group_id"))
    needs = pairs.groupBy(F.col("dependent").alias("group_id")).agg(  # at most two dependencies per group
        F.collect_list(F.struct("group_id", expected.alias("identity"))).alias("dependencies")
    )
    groups = fresh.select("group_id", "state", F.col("group_id").alias("identity")).join(needs, "group_id", "left")
    return g.dependency_problems(groups)


@query("group_rules", f"""WITH {BARS}, m AS (SELECT CAST(session_date AS VARCHAR) AS group_day, count(*) AS n, count(*) FILTER (WHERE {VALID}) AS ok, count(*) FILTER (WHERE NOT {VALID}) AS bad FROM bars GROUP BY 1),
s AS (SELECT *, ok / n AS cov, CASE WHEN bad = 0 THEN 'READY_NEW' WHEN bad < 60 THEN 'READY_WITH_EXCLUSIONS' ELSE 'READY_REUSED' END AS state FROM m)
SELECT group_day, violation FROM (SELECT group_day, unnest([CASE WHEN state = 'READY_WITH_EXCLUSIONS' AND NOT (cov >= 0.95 AND bad > 0) THEN 'READY_WITH_EXCLUSIONS_THRESHOLD' END, CASE WHEN state = 'READY_REUSED' AND NOT cov >= 0.95 THEN 'READY_REUSED_COVERAGE' END]) AS violation FROM s) WHERE violation IS NOT NULL""")
def group_rules(t: Tables) -> DataFrame:
    """Each day's bars judged as a market group."""
    m = bars(t).groupBy(F.col("session_date").cast("string").alias("group_day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~is_invalid_ohlcv()).alias("ok"), F.count_if(is_invalid_ohlcv()).cast("int").alias("exclusions")
    )
    bad = F.col("exclusions")
    groups = m.select(
        "group_day", F.lit("market").alias("group_id"), F.when(bad == 0, "READY_NEW").when(bad < 60, "READY_WITH_EXCLUSIONS").otherwise("READY_REUSED").alias("state"),
        F.lit(0).alias("lag_sessions"), (F.col("ok") / F.col("n")).alias("coverage"), "exclusions", F.lit(0).alias("validation_errors"), F.lit(True).alias("benchmark_valid"),
    )
    named = g.group_rule_violations(groups.withColumn("group_id", F.concat_ws("/", "group_id", "group_day")), market=F.col("group_id").startswith("market/"))
    return named.select(F.substring_index("group_id", "/", -1).alias("group_day"), "violation")


@query("session_lag", """WITH s AS (SELECT d, row_number() OVER (ORDER BY d) AS o FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE isodow(o_orderdate) < 6))
SELECT l_orderkey, l_linenumber, b.o - a.o AS lag_sessions FROM lineitem ASOF JOIN s a ON CAST(l_shipdate AS DATE) >= a.d ASOF JOIN s b ON last_day(l_shipdate) >= b.d""")
def session_lag(t: Tables) -> DataFrame:
    """Sessions from the ship date to the end of its month."""
    days = calendar.session_dimension(t.orders.select(F.to_date("o_orderdate").alias("session_date")).filter(F.weekday("session_date") < 5))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("observed"), F.last_day("l_shipdate").alias("expected"))
    out = calendar.session_lag(rows, "observed", "expected", days, until=day("2001-12-31"))
    return out.filter("lag_sessions is not null").select("l_orderkey", "l_linenumber", "lag_sessions")


# ---- quotes: events with a spread, status and broker flags taken from type and time
_QUOTES = """q AS (SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, ts FROM events),
f AS (SELECT event_id, user_id, list_sort(list_filter([
  CASE WHEN event_type = 'error' THEN 'UNACCEPTABLE_QUOTE_FEED' END, CASE WHEN event_type = 'signup' THEN 'QUOTE_UNAVAILABLE' END,
  CASE WHEN event_type <> 'signup' AND k = 7 THEN 'UNKNOWN_MARKET_SESSION' END, CASE WHEN event_type <> 'signup' AND k < 10 THEN 'CROSSED_MARKET' END,
  CASE WHEN event_type <> 'signup' AND ((value * (1 + (k - 10) / 1000)) - value) / (((value * (1 + (k - 10) / 1000)) + value) / 2) * 10000 > 500 THEN 'SPREAD_TOO_WIDE' END,
  CASE WHEN event_type <> 'signup' AND k - 3 < 0 THEN 'NEGATIVE_BID_SIZE' END, CASE WHEN event_type <> 'signup' AND k > 90 THEN 'STALE_QUOTE' END, CASE WHEN event_type <> 'signup' AND k = 90 THEN 'QUOTE_AFTER_CUTOFF' END,
  CASE WHEN event_type <> 'signup' AND k = 90 THEN 'QUOTE_AFTER_SNAPSHOT' END, CASE WHEN k = 50 THEN 'SECURITY_HALTED' END, CASE WHEN k = 51 THEN 'HALT_STATUS_UNKNOWN' END, CASE WHEN k = 52 THEN 'LULD_PAUSED' END,
  CASE WHEN k = 53 THEN 'LULD_STATUS_UNKNOWN' END, CASE WHEN k = 54 THEN 'STALE_MARKET_STATUS' END, CASE WHEN k = 55 THEN 'INVALID_LULD_BANDS' END, CASE WHEN k = 56 THEN 'BROKER_INELIGIBLE_OR_UNKNOWN' END,
  CASE WHEN k = 57 THEN 'INVALID_BROKER_REASON_CODES' END, CASE WHEN k = 58 THEN 'STALE_BROKER_ELIGIBILITY' END, CASE WHEN k = 59 THEN 'RESPONSE_PRECEDES_REQUEST' END, CASE WHEN k = 60 THEN 'RESPONSE_AFTER_SNAPSHOT' END], lambda x: x IS NOT NULL)) AS reasons FROM q)"""


def every_quote_rule(sql: str) -> str:
    """``sql`` with the rule on prices that are not positive; a quote of two prices of 0 is not crossed and has no spread."""
    sessions = "CASE WHEN event_type <> 'signup' AND k = 7 "
    prices = "CASE WHEN event_type <> 'signup' AND NOT coalesce(value > 0 AND value * (1 + (k - 10) / 1000) > 0 AND isfinite(value) AND isfinite(k), false) THEN 'INVALID_QUOTE_VALUE' END, "
    middle = "(((value * (1 + (k - 10) / 1000)) + value) / 2)"
    crossed = "k < 10 THEN 'CROSSED_MARKET'"
    return sql.replace(sessions, prices + sessions).replace(middle, f"nullif({middle}, 0)").replace(crossed, f"value <> 0 AND {crossed}")


def quotes(t: Tables) -> DataFrame:
    k = F.from_json("props", "k double")["k"]
    ts = F.col("ts").cast("timestamp")
    ago = lambda s: F.timestamp_micros(F.unix_micros(ts) - (s * 1_000_000).cast("bigint"))
    lag = lambda test, s: ago(F.when(test, s).otherwise(0))
    kind, bid = F.col("event_type"), F.col("value")
    return t.events.withColumn("k", k).select(
        "event_id", F.col("user_id").alias("security_id"), ts.alias("cutoff_utc"), ago(F.lit(-1)).alias("generated_at_utc"),
        lag(F.col("k") == 59, -1).alias("requested_at_utc"), lag(F.col("k") == 60, -2).alias("received_at_utc"),
        F.struct(
            F.when(kind == "error", "OTHER").otherwise("SIP_NBBO").alias("feed_type"), F.when(kind == "signup", "NONE").otherwise("AVAILABLE").alias("state"),
            bid.alias("bid"), (bid * (1 + (F.col("k") - 10) / 1000)).alias("ask"), F.lit(None).cast("double").alias("last"), (F.col("k") - 3).alias("bid_size"),
            F.lit(1.0).alias("ask_size"), F.when(F.col("k") == 7, "CLOSED").otherwise("REGULAR").alias("session"),
            ago(F.when(F.col("k") > 90, 6).when(F.col("k") == 90, -3).otherwise(0)).alias("quote_at_utc"),
        ).alias("quote"),
        F.struct(
            F.when(F.col("k") == 50, "HALTED").when(F.col("k") == 51, "?").otherwise("NOT_HALTED").alias("halt_status"),
            F.when(F.col("k") == 52, "PAUSED").when(F.col("k") == 53, "?").otherwise("NORMAL").alias("luld_status"),
            F.when(F.col("k") == 55, 2.0).alias("lower_band"), F.when(F.col("k") == 55, 1.0).alias("upper_band"), lag(F.col("k") == 54, 7).alias("observed_at_utc"),
        ).alias("market_status"),
        F.struct(
            (F.col("k") != 56).alias("eligible"), F.when(F.col("k") == 57, F.array(F.lit(""))).otherwise(F.array(F.lit("OK"))).alias("reason_codes"),
            lag(F.col("k") == 58, 400).alias("observed_at_utc"),
        ).alias("broker_eligibility"),
    )


_POLICY = QuotePolicy(spread_bps=500.0)


@query("quote_reasons", f"WITH {every_quote_rule(_QUOTES)} SELECT event_id, array_to_string(reasons, '|') AS block_reasons, CASE WHEN len(reasons) = 0 THEN 'READY' ELSE 'BLOCKED' END AS status FROM f")
def quote_reasons(t: Tables) -> DataFrame:
    rows = quotes(t).withColumn("reasons", quote_block_reasons(policy=_POLICY))
    return rows.select("event_id", listed("reasons").alias("block_reasons"), F.when(F.size("reasons") == 0, "READY").otherwise("BLOCKED").alias("status"))


@query("snapshot_status", f"WITH {_QUOTES} SELECT user_id AS security_id, count(*) AS securities, count(*) FILTER (WHERE len(reasons) > 0) AS blocked, CASE WHEN count(*) FILTER (WHERE len(reasons) > 0) = 0 THEN 'READY' ELSE 'BLOCKED' END AS status FROM f GROUP BY 1")
def snapshot_status(t: Tables) -> DataFrame:
    rows = quotes(t).withColumn("block_reasons", quote_block_reasons(policy=_POLICY))
    return g.snapshot_status(rows, key="security_id")
