"""Group, capability and phase states (AGG-19, JOI-24, PIP-18 .. PIP-22).

The contract tables are fixed lists of a few dozen rows; the states they are joined with
come from the data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import values_table

USABLE_STATES = ("READY_NEW", "READY_REUSED", "READY_WITH_EXCLUSIONS")
CORE_GROUPS = ("identity", "market")
MAX_LAG_SESSIONS = 2
TASK_ZONE = "America/Toronto"

# Dataset groups, their dependencies, and whether they may be absent.
GROUPS = (
    ("identity", (), False), ("market", ("identity",), False), ("fundamentals", ("identity",), False),
    ("filings_events", ("identity",), False), ("insiders", ("identity", "filings_events"), False),
    ("institutional", ("identity",), False), ("short_interest", ("identity",), False),
    ("analyst_estimates", ("identity",), True), ("total_returns", (), True),
)
# Tables of each group.
GROUP_TABLES = {
    "identity": ("security_universe", "security_master"), "market": ("prices", "splits"),
    "fundamentals": ("company_facts", "fundamentals_quarterly", "fundamental_factors"),
    "filings_events": ("filings", "corporate_events", "earnings_events"),
    "insiders": ("insider_transactions", "insider_signals"), "institutional": ("institutional_holdings", "ownership_signals"),
    "short_interest": ("short_interest",), "analyst_estimates": ("analyst_estimates",),
    "total_returns": ("benchmark_distributions", "benchmark_returns"),
}
# Capability, source group, maximum age in seconds, rule.
CAPABILITIES = (
    ("identity", "identity", 86400, "AGE"), ("historical_market", "market", None, "LAG"),
    ("broad_market_current", "market", None, "LAG"), ("benchmark_identity", "total_returns", 86400, "LANE"),
    ("benchmark_market_current", "total_returns", 3600, "LANE"), ("current_catalysts", "filings_events", 1200, "AGE"),
    ("point_in_time_expectations", "analyst_estimates", 1500, "AGE"), ("rapid_event_news", "news_events", 1200, "ABSENT"),
    ("macro_industry", "macro_industry", 86400, "ABSENT"), ("etf_exposure", "etf_exposure", 86400, "ABSENT"),
    ("certified_total_returns", "total_returns", 3600, "LANE"), ("funded_benchmark_inputs", "total_returns", 3600, "LANE"),
    ("canonical_replay", "market", None, "STATE"), ("survivorship_history", "survivorship_history", None, "ABSENT"),
    ("execution_snapshot", None, None, "EXTERNAL"), ("primary_evidence", "filings_events", 1200, "AGE"),
    ("candidate_funnel", "candidate_funnel", 900, "ABSENT"),
)
_BENCHMARK = ("benchmark_identity", "benchmark_market_current", "certified_total_returns", "funded_benchmark_inputs")
# Phase, required, optional and external capabilities.
PHASES = (
    ("sunday", _BENCHMARK,
     ("broad_market_current", "current_catalysts", "point_in_time_expectations", "macro_industry", "etf_exposure", "candidate_funnel"), ()),
    ("pre_open",
     ("identity", "broad_market_current", "current_catalysts", "point_in_time_expectations", "rapid_event_news", "primary_evidence"),
     ("macro_industry", "etf_exposure", "candidate_funnel"), ()),
    ("execution_research",
     ("identity", "broad_market_current", "current_catalysts", "point_in_time_expectations", "primary_evidence"),
     ("rapid_event_news", "macro_industry", "etf_exposure", "candidate_funnel"), ("execution_snapshot",)),
    ("exception_monitoring", ("identity", "current_catalysts", "rapid_event_news", "primary_evidence"),
     ("point_in_time_expectations", "candidate_funnel"), ("execution_snapshot",)),
    ("terminal_review", ("identity", "broad_market_current", "current_catalysts", "primary_evidence"),
     ("point_in_time_expectations", "rapid_event_news", "candidate_funnel"), ()),
    ("accounting", _BENCHMARK, (), ()),
    ("saturday_replay", ("identity", "canonical_replay", "survivorship_history"), (), ()),
)


def group_dimension(spark: SparkSession) -> DataFrame:
    return values_table(
        spark, "group_id string, dependencies array<string>, optional boolean", list(GROUPS)
    )


def capability_dimension(spark: SparkSession) -> DataFrame:
    return values_table(
        spark, "capability_id string, source_group string, maximum_age_seconds int, rule string", list(CAPABILITIES)
    )


def phase_dimension(spark: SparkSession) -> DataFrame:
    """(phase_id, capability_id, role)."""
    rows = [(p, c, role) for p, req, opt, ext in PHASES for role, cs in (("REQUIRED", req), ("OPTIONAL", opt), ("EXTERNAL", ext)) for c in cs]
    return values_table(spark, "phase_id string, capability_id string, role string", rows)


def hours_since(at: Column, as_of: Column) -> Column:
    """Hours from ``at`` to ``as_of``, 0 for later times and NULL without one."""
    hours = (F.unix_micros(as_of) - F.unix_micros(at.cast("timestamp"))) / F.lit(3.6e9)
    return F.when(hours < 0, 0.0).otherwise(hours)


def group_freshness(observed: DataFrame, as_of: Column, *, group: str = "group_id", at: str = "source_retrieved_at_utc") -> DataFrame:
    """AGG-19. Lag in hours from the oldest retrieval time and its state.

    READY within 24 h (identity) or 8 days, REUSED_WITH_PENALTY within 3 or 14 days,
    DISABLED beyond, UNKNOWN without a time.
    """
    oldest = observed.groupBy(group).agg(F.min(at).alias("observed_at"))
    hours = hours_since(F.col("observed_at"), as_of)
    identity = F.col(group) == "identity"
    ready, disabled = F.when(identity, 24).otherwise(8 * 24), F.when(identity, 3 * 24).otherwise(14 * 24)
    return oldest.withColumn("lag_hours", hours).withColumn("lag_days", F.floor(F.col("lag_hours") / 24)).withColumn(
        "freshness_state",
        F.when(F.col("lag_hours").isNull(), "UNKNOWN").when(F.col("lag_hours") <= ready, "READY")
        .when(F.col("lag_hours") <= disabled, "REUSED_WITH_PENALTY").otherwise("DISABLED"),
    )


def reuse_state(group: Column, lag_hours: Column, lag_sessions: Column, max_lag: int = MAX_LAG_SESSIONS) -> Column:
    """State of a group carried over from the previous release."""
    hours = F.when(group == "identity", 72).otherwise(336)
    ok = F.when(group == "market", lag_sessions <= max_lag).otherwise(lag_hours <= hours)
    return F.when(F.coalesce(ok, F.lit(False)), "READY_REUSED").otherwise("STALE_DISABLED")


def group_rule_violations(groups: DataFrame, max_lag: int = MAX_LAG_SESSIONS, market: Column | None = None) -> DataFrame:
    """DQ-12. (group_id, violation) for states that their metrics do not allow.

    ``market`` tells which rows follow the market rules when group ids are qualified.
    """
    c = F.col
    market = c("group_id") == "market" if market is None else market
    state, lag, cov = c("state"), c("lag_sessions"), c("coverage")
    no = lambda t: ~F.coalesce(t, F.lit(False))
    rules = {
        "READY_NEW_THRESHOLD": market & (state == "READY_NEW") & no((lag == 0) & (cov >= 0.99)),
        "READY_WITH_EXCLUSIONS_THRESHOLD": market & (state == "READY_WITH_EXCLUSIONS") & no((lag == 0) & (cov >= 0.95) & (c("exclusions") > 0)),
        "READY_REUSED_TOO_STALE": market & (state == "READY_REUSED") & no(lag <= max_lag),
        "READY_REUSED_COVERAGE": market & (state == "READY_REUSED") & no(cov >= 0.95),
        "BENCHMARK_INVALID": market & state.isin("READY_NEW", "READY_WITH_EXCLUSIONS") & no(c("benchmark_valid")),
        "USABLE_WITH_ERRORS": state.isin(*USABLE_STATES) & (c("validation_errors") > 0),
        "CORE_GROUP_NOT_USABLE": c("group_id").isin(*CORE_GROUPS) & ~state.isin(*USABLE_STATES),
    }
    codes = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in rules.items()]))
    return groups.select("group_id", F.explode(codes).alias("violation"))


def dependency_problems(groups: DataFrame) -> DataFrame:
    """JOI-24. Usable groups whose dependency is unusable or has another identity.

    ``groups``: group_id, state, identity, dependencies array of struct(group_id, identity).
    """
    need = groups.filter(F.col("state").isin(*USABLE_STATES)).select(
        F.col("group_id").alias("dependent"), F.explode("dependencies").alias("_d")
    ).select("dependent", F.col("_d.group_id").alias("group_id"), F.col("_d.identity").alias("expected_identity"))
    joined = need.join(groups.select("group_id", "state", "identity"), "group_id", "left")
    problem = (
        F.when(~F.coalesce(F.col("state").isin(*USABLE_STATES), F.lit(False)), "DISABLED_DEPENDENCY")
        .when(~F.col("identity").eqNullSafe(F.col("expected_identity")), "DEPENDENCY_IDENTITY_MISMATCH")
    )
    return joined.select("dependent", F.col("group_id").alias("dependency"), problem.alias("problem")).filter("problem is not null")


def capability_states(groups: DataFrame, capabilities: DataFrame, lane: DataFrame, as_of: Column) -> DataFrame:
    """PIP-19. State and reason of each capability.

    ``groups``: group_id, state, lag_sessions, lag_hours, observed_at. ``lane``: one row of
    the benchmark lane with state, identity_state, market_state, identity_observed_at,
    observed_at (or no row when the lane is absent).
    """
    g = groups.select(
        F.col("group_id").alias("source_group"), F.col("state").alias("_group_state"), "lag_sessions", "lag_hours",
        F.col("observed_at").alias("_observed"),
    )
    l = lane.select(
        F.lit("LANE").alias("rule"),
        F.col("state").alias("_l_state"), F.col("identity_state").alias("_l_identity"), F.col("market_state").alias("_l_market"),
        F.col("identity_observed_at").alias("_l_identity_at"), F.col("observed_at").alias("_l_at"),
    )
    rows = capabilities.join(g, "source_group", "left").join(l, "rule", "left")  # at most one lane row
    usable = F.coalesce(F.col("_group_state").isin(*USABLE_STATES), F.lit(False))
    age_limit = F.col("maximum_age_seconds")
    hours = F.col("lag_hours")
    plain = (
        F.when(F.col("_group_state").isNull(), F.lit("NOT_CONFIGURED"))
        .when(~usable, F.col("_group_state"))
        .when((F.col("rule") == "LAG") & ~F.coalesce(F.col("lag_sessions") == 0, F.lit(False)), F.lit("STALE"))
        .when(age_limit.isNotNull() & hours.isNull(), F.lit("UNKNOWN_FRESHNESS"))
        .when(age_limit.isNotNull() & (hours * 3600 > age_limit), F.lit("STALE"))
        .otherwise(F.lit("READY"))
    )
    lane_state = (
        F.when(F.col("capability_id") == "benchmark_identity", F.col("_l_identity"))
        .when(F.col("capability_id") == "benchmark_market_current", F.col("_l_market"))
        .otherwise(F.col("_l_state"))
    )
    lane_at = F.when(F.col("capability_id") == "benchmark_identity", F.col("_l_identity_at")).otherwise(F.col("_l_at"))
    age = (F.unix_micros(as_of) - F.unix_micros(lane_at.cast("timestamp"))) / F.lit(1e6)
    benchmark = (
        F.when(lane_state.isNull(), F.lit("NOT_CONFIGURED")).when(lane_state != "READY", lane_state)
        .when(~usable, F.coalesce(F.col("_group_state"), F.lit("NOT_CONFIGURED")))
        .when(lane_at.isNull(), F.lit("UNKNOWN_FRESHNESS")).when(age < 0, F.lit("INVALID"))
        .when(age > age_limit, F.lit("STALE")).otherwise(F.lit("READY"))
    )
    rule = F.col("rule")
    state = (
        F.when(rule == "EXTERNAL", F.lit("CONSUMER_REQUIRED")).when(rule == "ABSENT", F.lit("NOT_CONFIGURED"))
        .when(rule == "LANE", benchmark).otherwise(plain)
    )
    observed = F.when(rule == "LANE", lane_at).when(~rule.isin("EXTERNAL", "ABSENT"), F.col("_observed"))
    found = F.coalesce(F.col("_group_state"), F.lit("absent"))
    lane_reason = (
        F.when(lane_state.isNull(), "benchmark lane is absent")
        .when(lane_state != "READY", F.concat(F.lit("benchmark lane is "), lane_state))
        .when(~usable, F.concat(F.lit("source group is "), found))
    )
    group_reason = F.when(~usable, F.concat(F.lit("source group is "), found)).when(
        plain.isin("STALE", "UNKNOWN_FRESHNESS") & (rule == "LAG"), "market is behind its expected session"
    )
    by_age = F.when(state == "STALE", F.concat(F.lit("source is older than "), age_limit.cast("string"), F.lit(" seconds"))).when(
        state == "UNKNOWN_FRESHNESS", "source has no retrieval time").when(state == "INVALID", "source lies after the cutoff")
    reason = (
        F.when(rule == "EXTERNAL", "supplied by the consumer").when(rule == "ABSENT", "lane is not configured")
        .when(state == "READY", F.lit(None).cast("string"))
        .otherwise(F.coalesce(F.when(rule == "LANE", lane_reason).otherwise(group_reason), by_age))
    )
    return rows.select(
        "capability_id", state.alias("state"), "source_group", observed.alias("observed_at"), "maximum_age_seconds", reason.alias("reason")
    )


def phase_states(capabilities: DataFrame, phases: DataFrame) -> DataFrame:
    """PIP-20. BLOCKED, DEGRADED or READY with rejection codes and operating modes.

    ``capabilities`` may be told per phase (``phase_id``), as the target session gates do.
    """
    on = [c for c in ("phase_id", "capability_id") if c in capabilities.columns]
    rows = phases.join(capabilities.select(*on, "state"), on, "left").withColumn(
        "state", F.coalesce("state", F.lit("NOT_CONFIGURED"))
    )
    down = F.col("state") != "READY"
    required, optional = F.col("role") == "REQUIRED", F.col("role") == "OPTIONAL"
    code = F.concat(F.lit("CAPABILITY_"), F.upper("capability_id"), F.lit("_"), "state")
    # at most seventeen capabilities per phase
    out = rows.groupBy("phase_id").agg(
        F.count_if(required & down).alias("required_down"), F.count_if(optional & down).alias("optional_down"),
        F.count_if(F.col("role") == "EXTERNAL").alias("externals"),
        F.array_sort(F.collect_set(F.when((required | optional) & down, code))).alias("rejection_codes"),
        F.count_if(required & ~down & F.col("capability_id").isin(*_BENCHMARK)).alias("_bench"),
    )
    status = F.when(F.col("required_down") > 0, "BLOCKED").when(F.col("optional_down") > 0, "DEGRADED").otherwise("READY")
    nothing_down = (F.col("required_down") == 0) & (F.col("optional_down") == 0)
    safe = F.col("phase_id").isin("sunday", "accounting") & (F.col("_bench") == len(_BENCHMARK))
    modes = F.array_compact(F.array(
        F.lit("ARTIFACT_VALID"), F.when(safe, F.lit("BENCHMARK_ONLY_SAFE")),
        F.when((F.col("phase_id") != "accounting") & nothing_down, F.lit("CHALLENGER_RESEARCH_READY")),
        F.when(F.col("externals") > 0, F.lit("LIVE_SNAPSHOT_REQUIRED")), F.when(~nothing_down, F.lit("CHALLENGER_BLOCKED")),
    ))
    return out.select(
        "phase_id", status.alias("status"), "rejection_codes", modes.alias("operating_modes"),
        F.element_at(modes, -1).alias("decision_mode"), (F.col("externals") > 0).alias("live_snapshot_required"),
    )


def phase_usable_at(
    states: DataFrame, phases: DataFrame, capabilities: DataFrame, windows: DataFrame, as_of: Column, *,
    allow_degraded: bool = False, live_snapshot_ready: bool = False,
) -> DataFrame:
    """PIP-21. USABLE or BLOCKED per phase at one instant, with rejection codes."""
    active = windows.filter((F.col("not_before_utc") <= as_of) & (as_of <= F.col("expires_at_utc"))).groupBy("phase_id").agg(
        F.min_by("window_id", "not_before_utc").alias("active_window_id")
    )
    ready = phases.filter(F.col("role") == "REQUIRED").join(
        capabilities.filter((F.col("state") == "READY") & F.col("maximum_age_seconds").isNotNull() & F.col("observed_at").isNotNull()),
        "capability_id",
    )
    age = (F.unix_micros(as_of) - F.unix_micros(F.col("observed_at").cast("timestamp"))) / F.lit(1e6)
    verdict = F.when(age < 0, "NOT_KNOWN_AT_AS_OF").when(age > F.col("maximum_age_seconds"), "STALE_AT_AS_OF")
    stale = ready.withColumn("_v", verdict).filter("_v is not null").groupBy("phase_id").agg(
        F.collect_set(F.concat(F.lit("CAPABILITY_"), F.upper("capability_id"), F.lit("_"), "_v")).alias("_fresh")
    )
    rows = states.join(active, "phase_id", "left").join(stale, "phase_id", "left")
    none = F.array().cast("array<string>")
    snapshot_missing = F.col("live_snapshot_required") & F.lit(not live_snapshot_ready)
    degraded_blocked = (F.col("status") == "DEGRADED") & F.lit(not allow_degraded)
    codes = F.array_sort(F.array_distinct(F.array_compact(F.concat(
        "rejection_codes", F.coalesce("_fresh", none),
        F.array(
            F.when(F.col("active_window_id").isNull(), F.lit("PHASE_WINDOW_NOT_ACTIVE")),
            F.when(degraded_blocked, F.lit("DEGRADED_NOT_ALLOWED")), F.when(snapshot_missing, F.lit("CONSUMER_LIVE_SNAPSHOT_REQUIRED")),
        ),
    ))))
    usable = (
        F.col("active_window_id").isNotNull() & ~snapshot_missing & F.col("_fresh").isNull()
        & ((F.col("status") == "READY") | ((F.col("status") == "DEGRADED") & F.lit(allow_degraded)))
    )
    return rows.select(
        "phase_id", F.when(usable, "USABLE").otherwise("BLOCKED").alias("usability"), "active_window_id", codes.alias("rejection_codes")
    )


def phase_windows(sessions: DataFrame, zone: str = TASK_ZONE) -> DataFrame:
    """PIP-22. Eight decision windows per session in task-zone time or relative to the close.

    Sessions without a following session give no row for windows that need it.
    """
    day, nxt = F.col("session_date"), F.col("next_session")
    local = lambda d, t: F.to_utc_timestamp(F.concat(d.cast("string"), F.lit(f" {t}")), zone)
    after = lambda m: F.col("close_utc") + F.make_dt_interval(mins=F.lit(m))
    weekday = F.weekday(day)  # Monday 0
    ahead = lambda target: F.when(weekday == target, 7).otherwise(F.pmod(F.lit(target) - weekday, F.lit(7)))
    saturday, sunday = F.date_add(day, ahead(5)), F.date_add(day, ahead(6))
    # Phase, window, decision cutoff, opening and expiry.
    specs = (
        ("pre_open", "PRE_OPEN", local(nxt, "08:10:00"), local(nxt, "08:05:00"), local(nxt, "09:30:00")),
        ("execution_research", "EXECUTION_RESEARCH", local(nxt, "09:38:00"), local(nxt, "09:30:00"), local(nxt, "09:45:00")),
        ("exception_monitoring", "OPEN_EXCEPTION", local(nxt, "09:55:00"), local(nxt, "09:50:00"), local(nxt, "10:05:00")),
        ("exception_monitoring", "CLOSE_EXCEPTION", local(nxt, "15:25:00"), local(nxt, "15:20:00"), local(nxt, "15:35:00")),
        ("terminal_review", "TERMINAL_REVIEW", after(20), after(15), after(45)),
        ("accounting", "ACCOUNTING", after(45), after(40), local(nxt, "07:45:00")),
        ("saturday_replay", "SATURDAY_REPLAY", local(saturday, "08:30:00"), local(saturday, "08:00:00"), local(F.date_add(saturday, 1), "17:15:00")),
        ("sunday", "SUNDAY", local(sunday, "17:30:00"), local(sunday, "17:15:00"), local(F.col("_after_sunday"), "07:45:00")),
    )
    keyed = sessions.select("session_date", "close_utc", "next_session").withColumn("_sunday", sunday)
    w = Window.partitionBy("_sunday")
    # at most seven sessions share their next Sunday; the last of them leads to the first session from that day on
    keyed = keyed.withColumn("_after_sunday", F.min(F.when(nxt >= F.col("_sunday"), nxt)).over(w))
    structs = F.array(*[
        F.struct(F.lit(p).alias("phase_id"), F.lit(w_).alias("window_id"), d.alias("decision_cutoff_utc"), n.alias("not_before_utc"), e.alias("expires_at_utc"))
        for p, w_, d, n, e in specs
    ])
    return keyed.select("session_date", F.inline(structs)).filter(
        "decision_cutoff_utc is not null and not_before_utc is not null and expires_at_utc is not null"
    )


@dataclass(frozen=True)
class ComposedGroup:
    """Outcome of :func:`compose_group`."""

    tables: dict[str, DataFrame]
    state: str
    diagnostics: list[str]
    exclusions: dict[str, int]


class CompositionError(RuntimeError):
    """A core group has neither a valid candidate nor a valid fallback."""


def compose_group(
    group: str, candidate: Mapping[str, DataFrame], previous: Mapping[str, DataFrame],
    validate: Callable[[str, Mapping[str, DataFrame]], Sequence[str]], *,
    master: DataFrame | None = None, key: str = "security_id", candidate_state: str = "READY_NEW",
) -> ComposedGroup:
    """PIP-18 for one group: the candidate when valid, else the previous tables.

    ``validate`` returns diagnostics from aggregated counts. Reused market tables lose the
    rows whose identity the master lacks.
    """
    from tidemark.operators.keys import drop_orphans, orphan_counts

    diagnostics = list(validate(group, candidate))
    if not diagnostics:
        state = candidate_state if candidate_state in ("READY_NEW", "READY_WITH_EXCLUSIONS") else "READY_NEW"
        return ComposedGroup(dict(candidate), state, [], {})
    broken = list(validate(group, previous))
    if broken:
        raise CompositionError(f"group {group} has no valid candidate or fallback: {broken}")
    tables, exclusions = dict(previous), {}
    if group == "market" and master is not None:
        exclusions = {r["table"]: r["orphan_rows"] for r in orphan_counts(tables, master, key).collect() if r["orphan_rows"]}
        tables = {n: drop_orphans(t, master, key) if n in exclusions else t for n, t in tables.items()}
    return ComposedGroup(tables, "READY_WITH_EXCLUSIONS" if exclusions else "READY_REUSED", diagnostics, exclusions)


def compose_groups(
    candidate: Mapping[str, DataFrame], previous: Mapping[str, DataFrame],
    validate: Callable[[str, Mapping[str, DataFrame]], Sequence[str]], candidate_states: Mapping[str, str] | None = None,
) -> dict[str, ComposedGroup]:
    """PIP-18 over all groups present; identity is chosen first and filters the market."""
    out: dict[str, ComposedGroup] = {}
    for group, _, optional in GROUPS:
        names = GROUP_TABLES[group]
        mine = {n: candidate[n] for n in names if n in candidate}
        theirs = {n: previous[n] for n in names if n in previous}
        if not mine and not theirs:
            if group in CORE_GROUPS:
                raise CompositionError(f"core group {group} is absent")
            continue
        identity = out.get("identity")
        out[group] = compose_group(
            group, mine, theirs, validate, master=identity.tables.get("security_master") if identity else None,
            candidate_state=(candidate_states or {}).get(group, "READY_NEW"),
        )
    return out


def contract_validator(group: str, tables: Mapping[str, DataFrame]) -> list[str]:
    """Default validator: schema, keys, values and provenance of each table of a group."""
    from tidemark.contracts import CONTRACTS
    from tidemark.operators.quality import contract_violations, schema_differences

    found: list[str] = []
    for name in GROUP_TABLES[group]:
        if name not in tables:
            found.append(f"missing table {name}")
            continue
        differences = schema_differences(tables[name], CONTRACTS[name].schema)
        if differences:
            found.append(f"{name}: {differences[0]}")
            continue
        broken = contract_violations(tables[name], CONTRACTS[name]).filter("violations > 0").collect()
        found += [f"{name}: {r['violations']} {r['rule']}" for r in broken]
    return found


def snapshot_status(records: DataFrame, key: str = "snapshot_id", reasons: str = "block_reasons") -> DataFrame:
    """EXP-27. READY iff no record of the snapshot is blocked."""
    return records.groupBy(key).agg(
        F.count(F.lit(1)).alias("securities"), F.count_if(F.size(reasons) > 0).alias("blocked")
    ).withColumn("status", F.when(F.col("blocked") == 0, "READY").otherwise("BLOCKED"))


def provider_problems(providers: DataFrame, *, cutoff: str = "cutoff_utc", generated: str = "generated_at_utc", skew: int = 2) -> DataFrame:
    """EXP-27. Providers with a wrong feed, a stale or a future observation.

    ``providers``: role, feed_type, observed_at_utc, maximum_age_seconds, cutoff, generated.
    """
    from tidemark.functions.clock import seconds_between
    from tidemark.functions.quotes import BROKER_FEEDS, QUOTE_FEEDS, STATUS_FEEDS

    allowed = F.lit(False)
    for role, feeds in (("quote", QUOTE_FEEDS), ("market_status", STATUS_FEEDS), ("broker_eligibility", BROKER_FEEDS)):
        allowed = allowed | ((F.col("role") == role) & F.col("feed_type").isin(*feeds))
    age = seconds_between(cutoff, "observed_at_utc")
    problem = (
        F.when(~F.coalesce(allowed, F.lit(False)), "UNACCEPTABLE_PROVIDER_FEED")
        .when(~F.coalesce(age <= F.col("maximum_age_seconds"), F.lit(False)), "STALE_PROVIDER_OBSERVATION")
        .when((age < -skew) | (F.col("observed_at_utc") > F.col(generated)), "FUTURE_PROVIDER_OBSERVATION")
    )
    return providers.withColumn("problem", problem).filter("problem is not null")
