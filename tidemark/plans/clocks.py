"""Freshness of dataset groups by their own clocks, as of a target session (AGG-19, PIP-19).

Every group has one row in a rule table: hours since its oldest retrieval, or sessions behind the
target, with or without a certified lane. Observations join that table; nothing depends on which
groups there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.calendar import session_lag
from tidemark.plans.gates import GROUPS, MAX_LAG_SESSIONS, PHASES, hours_since
from tidemark.session import values_table

# Hours until a group is reused with penalty and until it is disabled.
IDENTITY_HOURS, OTHER_HOURS = (24, 72), (192, 336)
# Groups on the session clock, sessions they may lag, whether their lane must be certified.
SESSION_CLOCKS = {"market": (MAX_LAG_SESSIONS, False), "total_returns": (0, True)}
# Capabilities of the benchmark lane that must reach the target session, and their phases.
BENCHMARK_TARGETS = ("benchmark_market_current", "certified_total_returns", "funded_benchmark_inputs")
BENCHMARK_PHASES = ("accounting", "sunday")


def clock_dimension(spark: SparkSession) -> DataFrame:
    """(group_id, clock, ready_hours, disabled_hours, maximum_lag_sessions, certified_lane)."""
    rows = []
    for group, _, _ in GROUPS:
        if group in SESSION_CLOCKS:
            rows.append((group, "SESSIONS", None, None, *SESSION_CLOCKS[group]))
        else:
            rows.append((group, "HOURS", *(IDENTITY_HOURS if group == "identity" else OTHER_HOURS), None, False))
    return values_table(
        spark, "group_id string, clock string, ready_hours int, disabled_hours int, maximum_lag_sessions int, certified_lane boolean", rows
    )


def target_dimension(spark: SparkSession) -> DataFrame:
    """(phase_id, capability_id, lane): the lane whose last session a phase compares with its target."""
    rows = [(phase, "broad_market_current", "market") for phase, required, _, _ in PHASES if "broad_market_current" in required]
    rows += [(phase, capability, "benchmark") for phase in BENCHMARK_PHASES for capability in BENCHMARK_TARGETS]
    rows.append(("saturday_replay", "canonical_replay", "market"))
    return values_table(spark, "phase_id string, capability_id string, lane string", rows)


def judge_clocks(
    observed: DataFrame, clocks: DataFrame, sessions: DataFrame, *, target: Column, as_of: Column, keys: Sequence[str] = (),
) -> DataFrame:
    """AGG-19. State and reason of each group; a group is as old as the oldest of its tables.

    ``observed``: keys, group_id, observed_session, retrieved_at, certified, one row a table (more
    are folded). READY has no reason. A session after the target, outside the calendar or missing,
    an uncertified lane and a group without a clock are never READY.
    """
    c = F.col
    oldest = observed.groupBy(*keys, "group_id").agg(
        F.min("observed_session").alias("observed_session"), F.min("retrieved_at").alias("retrieved_at"),
        F.bool_and(F.coalesce("certified", F.lit(False))).alias("certified"),
    )
    rows = session_lag(
        oldest.join(clocks, "group_id", "left").withColumn("required_session", target), "observed_session", "required_session", sessions, until=target
    )
    rows = rows.withColumn("lag_hours", hours_since(c("retrieved_at"), as_of))
    day = lambda name: c(name).cast("string")
    seen = F.concat(F.lit("observed="), day("observed_session"), F.lit(", required="), day("required_session"))
    behind = (
        F.when(c("observed_session").isNull(), "no session observed")
        .when(c("observed_session") > c("required_session"), F.concat(seen, F.lit(", after the target")))
        .when(c("lag_sessions").isNull(), F.concat(seen, F.lit(", outside the calendar")))
        .when(c("certified_lane") & ~c("certified"), "lane is not certified")
        .when(c("certified_lane") & c("retrieved_at").isNull(), "no retrieval time")
        .when(c("lag_sessions") > c("maximum_lag_sessions"), F.concat(seen, F.lit(", sessions behind="), c("lag_sessions").cast("string")))
    )
    aged = F.when(c("lag_hours").isNull(), "no retrieval time").when(
        c("lag_hours") > c("ready_hours"),
        F.concat(F.lit("retrieved "), F.floor("lag_hours").cast("string"), F.lit(" hours ago, limit "), c("ready_hours").cast("string")),
    )
    reason = F.when(c("clock").isNull(), "group has no clock").when(c("clock") == "SESSIONS", behind).otherwise(aged)
    state = (
        F.when(c("clock").isNull(), "UNKNOWN")
        .when(c("clock") == "SESSIONS", F.when(behind.isNull(), "READY").otherwise("STALE"))
        .when(c("lag_hours").isNull(), "UNKNOWN").when(c("lag_hours") <= c("ready_hours"), "READY")
        .when(c("lag_hours") <= c("disabled_hours"), "REUSED_WITH_PENALTY").otherwise("DISABLED")
    )
    on_sessions = c("clock") == "SESSIONS"
    return rows.select(
        *keys, "group_id", "clock", "observed_session", "required_session", F.when(on_sessions, c("lag_sessions")).alias("lag_sessions"),
        F.when(~on_sessions, c("lag_hours")).alias("lag_hours"), state.alias("state"), reason.alias("reason"),
    )


def target_session_gates(
    capabilities: DataFrame, phases: DataFrame, targets: DataFrame, lanes: DataFrame, rules: DataFrame, keys: Sequence[str] = (),
) -> DataFrame:
    """PIP-19. Capabilities of each phase, STALE where their lane does not end at the phase's target.

    ``capabilities``: capability_id, state, reason. ``phases``: phase_id, capability_id, role.
    ``targets``: keys, phase_id, reference_session. ``lanes``: keys, lane, observed_session (a lane
    that is missing has no session). The result feeds :func:`gates.phase_states`.
    """
    rows = phases.join(capabilities.select("capability_id", "state", "reason"), "capability_id").join(
        rules, ["phase_id", "capability_id"], "left"
    )
    rows = targets.join(rows, "phase_id").join(lanes, [*keys, "lane"], "left")
    misses = F.col("lane").isNotNull() & ~F.col("observed_session").eqNullSafe(F.col("reference_session"))
    told = F.concat(
        F.col("lane"), F.lit(" lane: observed="), F.coalesce(F.col("observed_session").cast("string"), F.lit("none")),
        F.lit(", required="), F.coalesce(F.col("reference_session").cast("string"), F.lit("none")),
    )
    return rows.select(
        *keys, "phase_id", "capability_id", "role", F.when(misses, "STALE").otherwise(F.col("state")).alias("state"),
        F.when(misses, told).otherwise(F.col("reason")).alias("reason"),
    )
