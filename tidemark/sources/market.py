"""Raw price and split tables, chart documents (SRC-01, SRC-02, SRC-10, SRC-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clean_symbol, round_half_even_long
from tidemark.sources.rejects import Rejects, read_documents

__all__ = [
    "normalize_prices", "scan_prices", "normalize_splits", "scan_splits", "alias_table",
    "ambiguous_aliases", "read_charts", "explode_chart_prices", "explode_chart_events", "CHART_SCHEMA",
]


def alias_table(securities: DataFrame) -> DataFrame:
    """EXP-06. (security_id, ticker, source_symbol, priority)."""
    from tidemark.functions import symbol_aliases

    return securities.select(
        "security_id", "ticker", F.posexplode(symbol_aliases("ticker")).alias("priority", "source_symbol")
    ).select("security_id", "ticker", "source_symbol", "priority")


def ambiguous_aliases(aliases: DataFrame) -> DataFrame:
    """Source spellings owned by more than one security."""
    return aliases.groupBy("source_symbol").agg(
        F.min("security_id").alias("first_owner"), F.max("security_id").alias("last_owner")
    ).filter("first_owner <> last_owner")


def _provenance(dataset: str, revision: str, observed_at: str) -> list[Column]:
    return [
        F.lit(dataset).alias("source_dataset"), F.lit(revision).alias("source_revision"),
        F.lit(observed_at).alias("observed_at_utc"),
    ]


def normalize_prices(
    raw: DataFrame, aliases: DataFrame | None, cutoff: Column, *, dataset: str, revision: str, observed_at: str
) -> DataFrame:
    """SRC-01. Typed price rows of known symbols up to the cutoff, with provenance."""
    rows = raw.select(
        clean_symbol("symbol").alias("source_symbol"),
        F.col("report_date").try_cast("date").alias("session_date"),
        *[F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close")],
        round_half_even_long("volume").alias("volume"),
        *_provenance(dataset, revision, observed_at),
    ).filter(F.col("session_date") <= cutoff)
    if aliases is None:
        return rows
    return rows.join(aliases.select("source_symbol"), "source_symbol", "left_semi")


def scan_prices(spark: SparkSession, path: str, aliases: DataFrame | None, cutoff: Column, **provenance: str) -> DataFrame:
    """SRC-01 from Parquet with columns symbol, report_date, open..close, volume."""
    return normalize_prices(
        spark.read.parquet(path).select("symbol", "report_date", "open", "high", "low", "close", "volume"),
        aliases, cutoff, **provenance,
    )


def normalize_splits(
    raw: DataFrame, aliases: DataFrame | None, cutoff: Column, *, dataset: str, revision: str, observed_at: str
) -> tuple[DataFrame, DataFrame]:
    """SRC-02. (good, bad) split rows; bad ones have a NULL or blank field."""
    from tidemark.operators.quality import quarantine

    rows = raw.select(
        clean_symbol("symbol").alias("source_symbol"),
        F.col("report_date").try_cast("date").alias("event_date"),
        F.trim(F.col("split_factor").cast("string")).alias("split_factor"),
        *_provenance(dataset, revision, observed_at),
    ).filter(F.col("event_date").isNull() | (F.col("event_date") <= cutoff))
    if aliases is not None:
        rows = rows.join(aliases.select("source_symbol"), "source_symbol", "left_semi")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return quarantine(rows, {
        "BLANK_SYMBOL": blank("source_symbol"), "BAD_DATE": F.col("event_date").isNull(),
        "BLANK_FACTOR": blank("split_factor"),
    })


def scan_splits(spark: SparkSession, path: str, aliases: DataFrame | None, cutoff: Column, **provenance: str):
    """SRC-02 from Parquet with columns symbol, report_date, split_factor."""
    return normalize_splits(
        spark.read.parquet(path).select("symbol", "report_date", "split_factor"), aliases, cutoff, **provenance
    )


# Layout of one chart document.
CHART_SCHEMA = (
    """chart struct<error: string, result: array<struct<
      meta: struct<symbol: string, currency: string>,
      timestamp: array<bigint>,
      indicators: struct<
        quote: array<struct<open: array<double>, high: array<double>, low: array<double>,
                            close: array<double>, volume: array<double>>>,
        adjclose: array<struct<adjclose: array<double>>>>,
      events: struct<
        dividends: map<string, struct<amount: double, date: bigint>>,
        splits: map<string, struct<date: bigint, numerator: double, denominator: double>>>>>>"""
    .replace("\n", " ")
)


def read_charts(spark: SparkSession, path: str, rejects: Rejects | None = None, lines: bool = False) -> DataFrame:
    """One row per chart document: symbol, currency, timestamp, quote arrays, event maps.

    Documents without a result keep a NULL symbol so that the caller can reject them.
    """
    doc = read_documents(spark, path, CHART_SCHEMA, "charts", rejects, lines)
    r = F.get("chart.result", 0)
    q = F.get(r["indicators"]["quote"], 0)
    return doc.select(
        F.upper(r["meta"]["symbol"]).alias("symbol"), r["meta"]["currency"].alias("currency"),
        r["timestamp"].alias("timestamp"),
        *[q[c].alias(c) for c in ("open", "high", "low", "close", "volume")],
        F.get(r["indicators"]["adjclose"], 0)["adjclose"].alias("adjusted_close"),
        r["events"]["dividends"].alias("dividends"), r["events"]["splits"].alias("splits"),
    )


def explode_chart_prices(df: DataFrame, cutoff: Column, keys: list[str] = ["symbol"]) -> DataFrame:  # noqa: B006
    """SRC-10. Parallel arrays to daily rows; bars with a missing value are skipped."""
    fields = [c for c in ("open", "high", "low", "close", "volume", "adjusted_close") if c in df.columns]
    rows = df.select(*keys, F.explode(F.arrays_zip("timestamp", *fields)).alias("_b")).select(
        *keys, F.to_date(F.timestamp_seconds("_b.timestamp")).alias("session_date"),
        *[F.col(f"_b.{c}").alias(c) for c in fields],
    )
    present = F.lit(True)
    for c in fields:
        present = present & F.col(c).isNotNull()
    return rows.filter(present & (F.col("session_date") <= cutoff))


def explode_chart_events(df: DataFrame, kind: str, keys: list[str] = ["symbol"]) -> DataFrame:  # noqa: B006
    """SRC-11. ``dividends`` to cash amounts, ``splits`` to factors (text and number).

    Rows with a non-positive or missing amount carry ``is_valid`` = false.
    """
    rows = df.select(*keys, F.explode(kind).alias("event_id", "_e"))
    day = F.to_date(F.timestamp_seconds("_e.date"))
    if kind == "dividends":
        amount = F.col("_e.amount")
        return rows.select(
            *keys, "event_id", day.alias("event_date"), amount.alias("cash_amount"),
            F.coalesce((amount > 0) & ~F.isnan(amount) & day.isNotNull(), F.lit(False)).alias("is_valid"),
        )
    up, down = F.col("_e.numerator"), F.col("_e.denominator")
    factor = F.try_divide(up, down)
    whole = lambda c: F.regexp_replace(c.cast("string"), r"\.0\z", "")
    return rows.select(
        *keys, "event_id", day.alias("event_date"), factor.alias("split_factor"),
        F.concat(whole(up), F.lit(":"), whole(down)).alias("split_text"),
        F.coalesce((factor > 0) & day.isNotNull(), F.lit(False)).alias("is_valid"),
    )
