"""Coverage and history statistics (AGG-04 .. AGG-10, AGG-14, AGG-16 .. AGG-18)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import recent_n


def common_mode_sessions(
    df: DataFrame, session: str, pattern: Sequence[str], *,
    min_rows: int = 100, mode_rows: int = 25, mode_rate: float = 0.25,
) -> DataFrame:
    """AGG-04. Sessions where one full pattern repeats implausibly often."""
    patterns = df.groupBy(session, *pattern).agg(F.count(F.lit(1)).alias("_n"))
    quality = patterns.groupBy(session).agg(
        F.max("_n").alias("common_mode_rows"), F.sum("_n").alias("total_rows")
    )
    rate = F.col("common_mode_rows").cast("double") / F.col("total_rows")
    return quality.withColumn("common_mode_rate", rate).filter(
        (F.col("total_rows") >= min_rows) & (F.col("common_mode_rows") >= mode_rows)
        & (F.col("common_mode_rate") >= mode_rate)
    )


def dataset_stats(df: DataFrame, key: str, date: str, invalid: Column, cutoff: Column) -> DataFrame:
    """AGG-05. One row of table statistics.

    Exact distinct counts come from nested grouping (key and date, then key, then all),
    so no row is expanded and every level combines before its shuffle.
    """
    cells = df.groupBy(key, date).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(invalid).alias("bad"),
        F.count_if(F.col(date) > cutoff).alias("late"),
    )
    ids = cells.groupBy(key).agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("late").alias("late"),
        F.count(F.lit(1)).alias("cells"), F.min(date).alias("lo"), F.max(date).alias("hi"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return ids.agg(
        total("n").alias("rows"), F.count(key).alias("securities"),
        F.min("lo").alias("min_date"), F.max("hi").alias("max_date"),
        total("bad").alias("invalid_rows"),
        (total("n") - total("cells")).alias("duplicate_rows"),
        total("late").alias("after_cutoff"),
    )


def history_depth(df: DataFrame, key: str) -> DataFrame:
    """AGG-06. Sessions per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("sessions"))


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """One-row frames with different columns put into one row, by union and maximum."""
    names = [c for df in one_row for c in df.columns]
    stacked = one_row[0]
    for df in one_row[1:]:
        stacked = stacked.unionByName(df, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in names])


def depth_coverage(depth: DataFrame, admitted: DataFrame, key: str, minimum: int) -> DataFrame:
    """AGG-06. Matched coverage of the admitted keys and share with enough history."""
    matched = depth.agg(
        F.count(F.lit(1)).alias("matched"), F.count_if(F.col("sessions") >= minimum).alias("adequate")
    )
    total = admitted.select(key).distinct().agg(F.count(F.lit(1)).alias("admitted"))
    return side_by_side(matched, total).select(
        "admitted", "matched", "adequate",
        F.coalesce(F.try_divide(F.col("matched"), F.col("admitted")), F.lit(0.0)).alias("coverage"),
        F.coalesce(F.try_divide(F.col("adequate"), F.col("matched")), F.lit(0.0)).alias("adequate_coverage"),
    )


def history_distribution(depth: DataFrame, edges: Sequence[int] = (30, 252, 320)) -> DataFrame:
    """AGG-07. Minimum, lower median, maximum and bucket counts of sessions."""
    s = F.col("sessions")
    lows = [0, *edges]
    buckets = [
        F.count_if((s >= low) & (s < high)).alias(f"from_{low}_below_{high}")
        for low, high in zip(lows, edges)
    ]
    return depth.agg(
        F.min(s).alias("minimum"),
        F.expr("percentile_disc(0.5) within group (order by sessions)").cast("bigint").alias("median"),
        F.max(s).alias("maximum"), *buckets, F.count_if(s >= edges[-1]).alias(f"from_{edges[-1]}"),
    )


def session_coverage(df: DataFrame, active: DataFrame, key: str, date: str, expected: Column, valid: Column) -> DataFrame:
    """AGG-08. Active keys with a valid row on the expected session."""
    flags = df.filter(F.col(date) == expected).filter(valid).select(key).distinct().withColumn("_ok", F.lit(1))
    return active.select(key).distinct().join(flags, key, "left").agg(
        F.count("_ok").alias("valid_securities"), F.count(F.lit(1)).alias("active_securities")
    ).withColumn(
        "coverage", F.coalesce(F.try_divide(F.col("valid_securities"), F.col("active_securities")), F.lit(0.0))
    )


def market_state(metrics: DataFrame, *, errors: dict[str, Column], warnings: dict[str, Column], coverage: str = "coverage") -> DataFrame:
    """AGG-09. READY_NEW at 99 % coverage, READY_WITH_EXCLUSIONS at 95 %, else QUARANTINED.

    ``errors`` and ``warnings`` add further codes with the Column that raises them.
    """
    low, high = F.col(coverage) < 0.95, F.col(coverage) < 0.99
    all_errors = {"COVERAGE_BELOW_MINIMUM": low, **errors}
    all_warnings = {"COVERAGE_BELOW_READY_NEW": ~low & high, **warnings}

    def codes(tests: dict[str, Column]) -> Column:
        return F.array_sort(F.array_compact(F.array(*[F.when(t, F.lit(c)) for c, t in tests.items()])))

    return metrics.withColumn("errors", codes(all_errors)).withColumn("warnings", codes(all_warnings)).withColumn(
        "state",
        F.when(F.size("errors") > 0, F.lit("QUARANTINED"))
        .when(high, F.lit("READY_WITH_EXCLUSIONS")).otherwise(F.lit("READY_NEW")),
    )


def universe_counts(universe: DataFrame) -> DataFrame:
    """AGG-10. Counts per admission status and per security type."""
    dims = F.array(
        F.struct(F.lit("status").alias("dimension"), F.col("universe_admission_status").alias("value")),
        F.struct(F.lit("type").alias("dimension"), F.col("security_type").alias("value")),
    )
    return universe.select(F.inline(dims)).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("securities"))


def admitted_drift(current: DataFrame, previous: DataFrame, maximum: float) -> DataFrame:
    """AGG-10. abs(new - old) / old of the admitted counts against a maximum."""
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return side_by_side(one(current, "admitted"), one(previous, "previous_admitted")).withColumn(
        "drift", F.try_divide(F.abs(F.col("admitted") - F.col("previous_admitted")), F.col("previous_admitted"))
    ).withColumn("within_limit", F.coalesce(F.col("drift") <= maximum, F.lit(False)))


def date_range(df: DataFrame, column: str) -> DataFrame:
    """AGG-14."""
    return df.agg(F.min(column).alias("minimum"), F.max(column).alias("maximum"))


def lane_stats(df: DataFrame, lane: str, date: str, uncertified: Column) -> DataFrame:
    """AGG-16. Rows, distinct weeks, last session and uncertified rows per lane."""
    weeks = df.groupBy(lane, F.to_date(F.date_trunc("week", F.col(date))).alias("_week")).agg(
        F.count(F.lit(1)).alias("n"), F.max(date).alias("hi"), F.count_if(uncertified).alias("bad")
    )
    return weeks.groupBy(lane).agg(
        F.sum("n").cast("bigint").alias("sessions"), F.count(F.lit(1)).alias("weekly_observations"),
        F.max("hi").alias("maximum_session"), F.sum("bad").cast("bigint").alias("uncertified_rows"),
    )


def lane_status(stats: DataFrame, lane: str, required: Sequence[str], expected: Column, *, min_sessions: int = 140, min_weeks: int = 26,
                distributions: DataFrame | None = None) -> DataFrame:
    """AGG-16. One row: the lane is READY only when every required member is.

    With ``distributions`` (see :func:`invalid_distributions`) not one of them may be invalid.
    """
    current = F.coalesce(F.count_if(F.col("maximum_session") == expected) == len(required), F.lit(False))
    complete = (F.count(F.lit(1)) == len(required)) & (F.count_if(F.col(lane).isin(*required)) == len(required))
    valid = (
        current & complete & (F.sum("uncertified_rows") == 0)
        & (F.min("sessions") >= min_sessions) & (F.min("weekly_observations") >= min_weeks)
    )
    out = stats.agg(
        F.when(F.coalesce(valid, F.lit(False)), "READY").otherwise("INVALID").alias("state"),
        F.when(F.coalesce(current & complete, F.lit(False)), "READY").otherwise("STALE").alias("market_state"),
        F.coalesce(F.min("sessions"), F.lit(0)).alias("sessions"),
        F.coalesce(F.min("weekly_observations"), F.lit(0)).alias("weekly_observations"),
        F.count(F.lit(1)).alias("securities"),
        (F.count(F.lit(1)) / F.lit(len(required))).alias("coverage"),
    )
    if distributions is None:
        return out
    return side_by_side(out, invalid_distributions(distributions)).withColumn(
        "state", F.when(F.col("invalid_distributions") > 0, "INVALID").otherwise(F.col("state"))
    )


def invalid_distributions(distributions: DataFrame) -> DataFrame:
    """AGG-16. (invalid_distributions): rows without positive USD cash of the cash type and a retrieval time."""
    c = F.col
    good = (c("cash_amount") > 0) & (c("currency") == "USD") & (c("distribution_type") == "CASH_DISTRIBUTION") & c("source_retrieved_at_utc").isNotNull()
    return distributions.agg(F.count_if(~F.coalesce(good, F.lit(False))).alias("invalid_distributions"))


def rejections_by_reason(rejected: DataFrame, reason: str, sample: str, samples: int = 20) -> DataFrame:
    """AGG-17. Count per reason and its first distinct sample values.

    Samples are cut to the limit before they are collected.
    """
    counts = rejected.groupBy(reason).agg(F.count(F.lit(1)).alias("rejected_rows"))
    values = recent_n(rejected.select(reason, sample).distinct(), [reason], [F.col(sample).asc_nulls_last()], samples)
    listed = values.groupBy(reason).agg(F.array_sort(F.collect_list(sample)).alias("samples"))
    return counts.join(listed, reason, "left")


def daily_cash(events: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """AGG-18."""
    return events.groupBy(*keys).agg(F.sum(amount).alias("cash_amount"))


def cash_differences(rows: DataFrame, events: DataFrame, keys: Sequence[str], claimed: str, amount: str, tolerance: float = 1e-10) -> DataFrame:
    """JOI-22. Rows whose claimed cash differs from the summed events."""
    actual = F.coalesce(F.col("cash_amount"), F.lit(0.0))
    return rows.join(daily_cash(events, keys, amount), list(keys), "left").withColumn(
        "cash_amount", actual
    ).filter(F.abs(F.col(claimed) - F.col("cash_amount")) > tolerance)


def top_share(df: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str], n: int = 10) -> DataFrame:
    """SRT-02. Share of the ``n`` largest values in the key's sum."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    top = recent_n(df, keys, [F.col(value).desc_nulls_last(), *tie], n).groupBy(*keys).agg(F.sum(value).alias("_top"))
    return totals.join(top, list(keys)).select(
        *keys, F.try_divide(F.col("_top"), F.nullif(F.col("_total"), F.lit(0.0))).alias("top_share")
    )
