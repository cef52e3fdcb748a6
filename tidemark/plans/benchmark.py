"""Distribution-adjusted benchmark returns (PIP-15, PIP-16, WIN-14 .. WIN-16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import hash_id
from tidemark.operators.keys import previous_value, recent_n
from tidemark.operators.skew import OrderedKeys
from tidemark.operators.stats import daily_cash

TOLERANCE = 1e-4
MAXIMUM_SESSIONS, MINIMUM_SESSIONS, MINIMUM_WEEKS = 320, 140, 26
# Required members and their roles.
BENCHMARK_ROLES = {"VTI": "FUNDED_EQUITY_BENCHMARK", "SPY": "US_EQUITY_REFERENCE", "BIL": "CASH_REFERENCE"}


def compound_index(df: DataFrame, keys: Sequence[str], order: str, rate: str, base: float = 100.0, out: str = "total_return_index", chunk_rows: int | None = None, bounded: bool = False) -> DataFrame:
    """WIN-14. base x running product of (1 + rate)."""
    ordered = OrderedKeys(df, keys, [order], chunk_rows, bounded).running(products={out: F.lit(1.0) + F.col(rate)})
    return ordered.with_columns({out: F.col(out) * base}).result()


def verify_compounding(df: DataFrame, keys: Sequence[str], order: str = "session_date", tolerance: float = 1e-10, chunk_rows: int | None = None) -> DataFrame:
    """WIN-15. Rows whose index, price return or cash return does not follow from the previous row."""
    rows = previous_value(df, keys, order, {"_index": "total_return_index", "_close": "raw_close"}, chunk_rows)
    off = lambda e: F.coalesce(F.abs(e) > tolerance, F.lit(False))
    c = F.col
    wrong = (
        off(F.try_divide(c("total_return_index"), c("_index")) - 1 - c("total_return"))
        | off(c("price_return") - (F.try_divide(c("raw_close") * c("split_factor"), c("_close")) - 1))
        | off(c("distribution_return") - F.try_divide(c("cash_distribution"), c("_close")))
    )
    return rows.filter(c("_index").isNotNull() & wrong).drop("_index", "_close")


def lineage_hash(sessions: DataFrame, events: DataFrame, keys: Sequence[str], session: str, event_date: str, content: Sequence[str], out: str, chunk_rows: int | None = None, bounded: bool = False) -> DataFrame:
    """WIN-16. Per session, one hash of all events up to it.

    The running sum of 60-bit event digests and the running count identify the set of
    events, so no list of events is carried along.
    """
    digest = F.conv(F.substring(hash_id(*content), 1, 15), 16, 10).cast("decimal(38,0)")
    per_day = events.groupBy(*keys, F.col(event_date).alias(session)).agg(
        F.sum(digest).alias("_d"), F.count(F.lit(1)).alias("_n")
    )
    joined = sessions.join(per_day, [*keys, session], "left")
    zero = F.lit(0).cast("decimal(38,0)")
    ordered = OrderedKeys(joined, keys, [session], chunk_rows, bounded).running(
        sums={"_ds": F.coalesce("_d", zero), "_ns": F.coalesce("_n", F.lit(0))}
    )
    return ordered.with_columns({out: F.sha2(F.concat_ws("|", F.col("_ns").cast("string"), F.col("_ds").cast("string")), 256)}).result().drop(
        "_d", "_n", "_ds", "_ns"
    )


def benchmark_returns(
    prices: DataFrame, dividends: DataFrame, splits: DataFrame, *, key: str = "ticker", target: Column | None = None, tolerance: float = TOLERANCE,
    sessions: int = MAXIMUM_SESSIONS,
) -> DataFrame:
    """PIP-15 rows. Price, distribution and total return of the newest sessions.

    ``prices`` has key, session_date, close, adjusted_close; events have key, event_date
    and cash_amount / split_factor. ``row_ok`` tells whether the row reconciles.
    """
    rows = prices if target is None else prices.filter(F.col("session_date") <= target)
    # one row more than kept, so that the first kept row has a predecessor
    newest = recent_n(rows, [key], [F.col("session_date").desc()], sessions + 1)
    prior = previous_value(newest, [key], "session_date", {"_close": "close", "_adjusted": "adjusted_close"}, bounded=True)
    day = lambda df: df.withColumnRenamed("event_date", "session_date")
    cash = daily_cash(day(dividends), [key, "session_date"], "cash_amount")
    factor = day(splits).groupBy(key, "session_date").agg(F.max("split_factor").alias("split_factor"))
    c = F.col
    out = (
        prior.filter("_close is not null").join(cash, [key, "session_date"], "left").join(factor, [key, "session_date"], "left")
        .withColumns({"cash_distribution": F.coalesce("cash_amount", F.lit(0.0)), "split_factor": F.coalesce("split_factor", F.lit(1.0))})
        .withColumns({
            "price_return": F.try_divide(c("close") * c("split_factor"), c("_close")) - 1,
            "distribution_return": F.try_divide(c("cash_distribution"), c("_close")),
            "total_return": F.try_divide(c("adjusted_close"), c("_adjusted")) - 1,
        })
        .withColumn("reconciliation_error", F.abs(c("total_return") - c("price_return") - c("distribution_return")))
        .withColumn("row_ok", F.coalesce(
            (c("reconciliation_error") <= tolerance) & (c("price_return") > -1) & (c("total_return") > -1), F.lit(False)
        ))
    )
    return out.select(
        key, "session_date", c("close").alias("raw_close"), "split_factor", "cash_distribution", "price_return",
        "distribution_return", "total_return", "reconciliation_error", "row_ok",
    )


def lane_summary(
    rows: DataFrame, dividends: DataFrame, splits: DataFrame, *, key: str = "ticker", target: Column,
    min_sessions: int = MINIMUM_SESSIONS, min_weeks: int = MINIMUM_WEEKS,
) -> DataFrame:
    """PIP-15 gate. One row per member with counts, errors and ``certified``.

    An event inside the member's window that falls on no session fails the member.
    """
    from tidemark.operators.stats import lane_stats

    base = lane_stats(rows, key, "session_date", ~F.col("row_ok"))
    span = rows.groupBy(key).agg(F.min("session_date").alias("minimum_session"), F.max("reconciliation_error").alias("maximum_error"))
    events = dividends.select(key, "event_date").unionByName(splits.select(key, "event_date"))
    lost = (
        events.join(span.select(key, "minimum_session"), key)
        .filter((F.col("event_date") >= F.col("minimum_session")) & (F.col("event_date") <= target))
        .join(rows.select(key, F.col("session_date").alias("event_date")), [key, "event_date"], "left_anti")
        .groupBy(key).agg(F.count(F.lit(1)).alias("orphan_events"))
    )
    joined = base.join(span, key).join(lost, key, "left").withColumn("orphan_events", F.coalesce("orphan_events", F.lit(0)))
    ok = (
        (F.col("maximum_session") == target) & (F.col("sessions") >= min_sessions) & (F.col("weekly_observations") >= min_weeks)
        & (F.col("uncertified_rows") == 0) & (F.col("orphan_events") == 0)
    )
    return joined.withColumn("certified", F.coalesce(ok, F.lit(False)))


def certify_lane(rows: DataFrame, summary: DataFrame, members: int, key: str = "ticker") -> DataFrame:
    """All or none: the rows only when every one of ``members`` is certified."""
    # the summary has one row per member
    whole = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    verdict = summary.withColumn("_n", F.count_if("certified").over(whole)).filter(F.col("_n") == members)
    return rows.join(verdict.select(key), key, "left_semi")


def build_distributions(
    dividends: DataFrame, rows: DataFrame, *, key: str = "ticker", locator: str, revision: str, retrieved_at: Column, certified_at: Column,
) -> DataFrame:
    """PIP-16. One row per cash event inside the member's sessions, with a stable id."""
    span = rows.groupBy(key).agg(F.min("session_date").alias("_lo"), F.max("session_date").alias("_hi"))
    inside = dividends.join(span, key).filter(F.col("event_date").between(F.col("_lo"), F.col("_hi")))
    return inside.select(
        "security_id", key, F.col("event_date").alias("ex_date"), "cash_amount", F.lit("USD").alias("currency"),
        F.lit("CASH_DISTRIBUTION").alias("distribution_type"),
        hash_id("security_id", "event_date", "cash_amount", "event_id").alias("distribution_id"),
        F.lit(locator).alias("source_locator"), F.lit(revision).alias("source_revision"),
        retrieved_at.alias("source_retrieved_at_utc"), retrieved_at.alias("known_at_utc"), certified_at.alias("certified_at_utc"),
    )


def build_benchmark_lane(
    rows: DataFrame, dividends: DataFrame, splits: DataFrame, identity: DataFrame, *, benchmark_id: str, locator: str,
    revision: str, retrieved_at: Column, certified_at: Column,
) -> DataFrame:
    """PIP-15 table under its contract, from certified rows and (ticker, security_id)."""
    from tidemark.contracts import BENCHMARK_RETURNS

    # certified rows are limited per member
    indexed = compound_index(rows, ["ticker"], "session_date", "total_return", bounded=True)
    with_cash = lineage_hash(indexed, dividends, ["ticker"], "session_date", "event_date", ["event_id", "event_date", "cash_amount"], "distribution_lineage_sha256", bounded=True)
    full = lineage_hash(with_cash, splits, ["ticker"], "session_date", "event_date", ["event_id", "event_date", "split_factor"], "corporate_action_lineage_sha256", bounded=True)
    role = F.element_at(F.create_map(*[F.lit(x) for kv in BENCHMARK_ROLES.items() for x in kv]), F.col("ticker"))
    return full.join(identity.select("ticker", "security_id"), "ticker").withColumns({
        "benchmark_id": F.lit(benchmark_id), "benchmark_role": role, "currency": F.lit("USD"),
        "certification_status": F.lit("CERTIFIED"), "source_locator": F.lit(locator), "source_revision": F.lit(revision),
        "source_retrieved_at_utc": retrieved_at, "known_at_utc": retrieved_at, "certified_at_utc": certified_at,
    }).select(*BENCHMARK_RETURNS.columns)
