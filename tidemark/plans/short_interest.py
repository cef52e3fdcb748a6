"""Short interest with publication dates and changes (PIP-14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import SHORT_INTEREST
from tidemark.functions import growth, pit_columns
from tidemark.plans.filings import resolve_tickers


def lagged_growth(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, growths: dict[str, tuple[str, int]], differences: dict[str, tuple[str, int]],
) -> DataFrame:
    """WIN-09. Growth and difference against k observations back.

    For series that hold one row per published period, so a key has few rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({
        **{name: growth(F.col(c), F.lag(c, k).over(w)) for name, (c, k) in growths.items()},
        **{name: F.col(c) - F.lag(c, k).over(w) for name, (c, k) in differences.items()},
    })


def unplaced_short_interest(records: DataFrame, schedule: DataFrame, universe: DataFrame) -> DataFrame:
    """Records that :func:`build_short_interest` can not place, with all columns and a reason.

    TICKER_IDENTITY_CONFLICT (spellings that name two securities; a release stops on these), NO_SECURITY or
    UNSCHEDULED_SETTLEMENT_DATE, in this order; a record has one reason, a null symbol has no security.
    """
    symbols, clashing = resolve_tickers(records.select("symbol").distinct(), universe, "symbol", [])
    verdicts = symbols.select("symbol", F.when(F.col("security_id").isNull(), "NO_SECURITY").alias("_why")).unionByName(
        clashing.select("symbol", F.lit("TICKER_IDENTITY_CONFLICT").alias("_why"))
    )
    dates = schedule.select("settlement_date").distinct().withColumn("_due", F.lit(True))
    why = F.when(F.col("symbol").isNull(), "NO_SECURITY").otherwise(F.col("_why"))
    return records.join(verdicts, "symbol", "left").join(dates, "settlement_date", "left").withColumn(
        "reason", F.coalesce(why, F.when(F.col("_due").isNull(), "UNSCHEDULED_SETTLEMENT_DATE"))
    ).drop("_why", "_due").filter("reason is not null")


def build_short_interest(records: DataFrame, schedule: DataFrame, universe: DataFrame, *, retrieved_at: Column) -> DataFrame:
    """PIP-14 from normalized records; only scheduled settlement dates are kept (JOI-13).

    What is left out is in :func:`unplaced_short_interest`.
    """
    published = records.join(schedule.select("settlement_date", "publication_date"), "settlement_date")
    symbols, _ = resolve_tickers(records.select("symbol").distinct(), universe, "symbol", [])
    rows = published.join(symbols.filter("security_id is not null"), "symbol")
    changed = lagged_growth(
        rows, ["security_id"], ["settlement_date", "symbol"],
        growths={"short_interest_change_1m": ("current_short_shares", 2), "short_interest_change_3m": ("current_short_shares", 6)},
        differences={"days_to_cover_change": ("days_to_cover", 1)},
    )
    names = [c for c in SHORT_INTEREST.columns if not c.startswith("source_")]
    return changed.withColumns({
        "short_interest_percent_float": F.lit(None).cast("double"),
        "short_interest_percent_float_quality": F.lit("DENOMINATOR_NOT_CONFIGURED"),
    }).select(*names, *pit_columns(F.col("settlement_date"), None, None, F.col("publication_date"), retrieved_at))
