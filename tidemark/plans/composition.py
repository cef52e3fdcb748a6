"""Releases composed of dataset groups in the newest version that is valid (PIP-18).

Version 0 of a group is the candidate, higher versions are older releases. Identity is chosen
first; rows of a reused market without an admitted identity go, and readiness is measured on what
stays. A group is usable only if all it depends on is: the groups are listed dependencies first,
so one walk over the list is the fixed point. All releases of a table are composed at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.gates import CORE_GROUPS, GROUPS, MAX_LAG_SESSIONS, USABLE_STATES, CompositionError, reuse_state

# Fixed value: least share of admitted securities on the last session of the market.
MINIMUM_COVERAGE = 0.95


def choose_versions(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per (keys, group_id) the least valid version with its lags; a NULL version if none is valid.

    ``versions``: keys, group_id, version, valid, candidate_state, lag_hours, lag_sessions.
    """
    least = versions.groupBy(*keys, "group_id").agg(F.min(F.when(F.col("valid"), F.col("version"))).alias("version"))
    facts = versions.select(*keys, "group_id", "version", "candidate_state", "lag_hours", "lag_sessions")
    return least.join(facts, [*keys, "group_id", "version"], "left")


def market_readiness(market: DataFrame, master: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, exclusions, coverage) of the chosen market under the chosen identities.

    ``market``: keys, version, security_id, session_date. ``master``: keys, version, security_id.
    Coverage is the share of admitted securities that have a row on the last session left. A row
    without a security is an exclusion.
    """
    c, keys = F.col, list(keys)
    version = lambda group: chosen.filter((c("group_id") == group) & c("version").isNotNull()).select(*keys, "version")
    admitted = master.join(version("identity"), [*keys, "version"], "left_semi").select(*keys, "security_id").dropna(subset=["security_id"]).distinct()
    last = market.join(version("market"), [*keys, "version"], "left_semi").groupBy(*keys, "security_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("session_date").alias("last")
    )
    marked = last.join(admitted.withColumn("_ok", F.lit(True)), [*keys, "security_id"], "left")
    sessions = marked.groupBy(*keys, "last").agg(
        F.count_if("_ok").alias("securities"), F.sum(F.when(c("_ok").isNull(), c("n")).otherwise(0)).alias("orphans")
    )
    kept = c("securities") > 0
    reached = sessions.groupBy(*keys).agg(
        F.sum("orphans").cast("bigint").alias("exclusions"), F.max_by(F.when(kept, c("securities")), F.when(kept, c("last"))).alias("_covered")
    )
    total = admitted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_admitted"))
    return reached.join(total, keys, "full").select(
        *keys, F.coalesce("exclusions", F.lit(0)).cast("bigint").alias("exclusions"),
        F.coalesce(F.try_divide(F.col("_covered"), F.col("_admitted")), F.lit(0.0)).alias("coverage"),
    )


def compose_versions(
    versions: DataFrame, market: DataFrame, master: DataFrame, *, keys: Sequence[str] = ("release_id",), max_lag: int = MAX_LAG_SESSIONS,
) -> DataFrame:
    """PIP-18. (keys, group_id, version, state, exclusions, coverage) of every group of every release.

    States: a candidate keeps its own; a reused group READY_REUSED or, too old, STALE_DISABLED;
    MISSING without a valid version. The market is READY_WITH_EXCLUSIONS after rows went,
    UNKNOWN_SECURITY_ID when a candidate has such rows, QUARANTINED below the least coverage. Usable
    groups over unusable ones become DISABLED_DEPENDENCY. Groups that no version names are left out.
    """
    c, keys = F.col, list(keys)
    chosen = choose_versions(versions, keys)
    measured = market_readiness(market, master, chosen, keys)
    is_market = c("group_id") == "market"
    rows = chosen.join(measured, keys, "left").withColumns({
        "exclusions": F.when(is_market, F.coalesce("exclusions", F.lit(0))).cast("bigint"),
        "coverage": F.when(is_market, F.coalesce("coverage", F.lit(0.0))),
    })
    fresh = F.when(c("candidate_state") == "READY_WITH_EXCLUSIONS", c("candidate_state")).otherwise("READY_NEW")
    aged = reuse_state(c("group_id"), c("lag_hours"), c("lag_sessions"), max_lag)
    own = F.when(c("version").isNull(), "MISSING").when(c("version") == 0, fresh).otherwise(aged)
    filtered = (
        F.when(~own.isin(*USABLE_STATES), own)
        .when((c("exclusions") > 0) & (c("version") == 0), "UNKNOWN_SECURITY_ID")
        .when(c("coverage") < MINIMUM_COVERAGE, "QUARANTINED")
        .when(c("exclusions") > 0, "READY_WITH_EXCLUSIONS").otherwise(own)
    )
    rows = rows.withColumn("state", F.when(is_market, filtered).otherwise(own))
    # at most one entry for each contract group
    wide = rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("group_id", F.struct("version", "state", "exclusions", "coverage")))).alias("_g"))
    for group, dependencies, _ in GROUPS:
        state = F.element_at("_g", F.lit(group))["state"]
        held = F.lit(True)
        for other in dependencies:
            held = held & F.coalesce(c(f"_{other}").isin(*USABLE_STATES), F.lit(False))
        wide = wide.withColumn(f"_{group}", F.when(state.isin(*USABLE_STATES) & ~held, "DISABLED_DEPENDENCY").otherwise(state))
    cells = F.array(*[
        F.struct(
            F.lit(group).alias("group_id"), F.element_at("_g", F.lit(group))["version"].alias("version"), c(f"_{group}").alias("state"),
            F.element_at("_g", F.lit(group))["exclusions"].alias("exclusions"), F.element_at("_g", F.lit(group))["coverage"].alias("coverage"),
        )
        for group, _, _ in GROUPS
    ])
    return wide.select(*keys, F.inline(cells)).filter("state is not null")


def release_verdicts(composed: DataFrame, keys: Sequence[str] = ("release_id",)) -> DataFrame:
    """(keys, status, problems): REFUSED when a core group is absent or not usable."""
    down = ~F.col("state").isin(*USABLE_STATES)
    found = {g: F.max(F.when(F.col("group_id") == g, F.col("state"))) for g in CORE_GROUPS}
    out = composed.groupBy(*keys).agg(*[s.alias(f"_{g}") for g, s in found.items()], F.count_if(down).alias("unusable_groups"))
    problems = F.array_compact(F.array(*[
        F.when(~F.coalesce(F.col(f"_{g}").isin(*USABLE_STATES), F.lit(False)), F.concat(F.lit(f"{g.upper()}_"), F.coalesce(f"_{g}", F.lit("ABSENT"))))
        for g in CORE_GROUPS
    ]))
    return out.select(*keys, F.when(F.size(problems) == 0, "READY").otherwise("REFUSED").alias("status"), problems.alias("problems"), "unusable_groups")


def require_composed(verdicts: DataFrame) -> None:
    """Raises on the first release whose core groups can not be composed."""
    refused = verdicts.filter("status = 'REFUSED'").limit(1).collect()
    if refused:
        raise CompositionError(f"no valid release: {refused[0].asDict()}")
