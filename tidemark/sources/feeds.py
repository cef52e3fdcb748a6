"""Listing feeds, universes and reviewed registries (SRC-03..05, SRC-08, SRC-09, SRC-12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import EXCHANGE_ZONE, finite_number, first_not_blank, parse_source_date
from tidemark.operators.quality import quarantine
from tidemark.sources.rejects import Rejects, read_delimited, read_documents

__all__ = [
    "NASDAQ_FEED_COLUMNS", "OTHER_FEED_COLUMNS", "read_directory_feed", "read_universe", "read_registry",
    "read_tsv_table", "read_short_interest", "normalize_short_interest", "read_publication_schedule",
    "SHORT_INTEREST_FIELDS",
]

# Header order of the two listing directories.
NASDAQ_FEED_COLUMNS = (
    "Symbol", "Security Name", "Market Category", "Test Issue", "Financial Status", "Round Lot Size", "ETF",
    "NextShares",
)
OTHER_FEED_COLUMNS = (
    "ACT Symbol", "Security Name", "Exchange", "CQS Symbol", "ETF", "Round Lot Size", "Test Issue", "NASDAQ Symbol",
)
_TRAILER = "File Creation Time:"


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _trimmed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in columns])


def read_directory_feed(spark: SparkSession, path: str, columns: Sequence[str], rejects: Rejects | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-03. (listing rows, one-row creation time in UTC) of a pipe-separated feed.

    The trailer line carries the creation time in exchange-local time.
    """
    lines = read_delimited(spark, path, columns, "|", "directory_feed", rejects)
    first = F.trim(F.col(f"`{columns[0]}`"))
    is_trailer = F.coalesce(first.startswith(_TRAILER), F.lit(False))
    rows = _trimmed(lines.filter(~is_trailer), columns)
    stamp = F.trim(F.replace(first, F.lit(_TRAILER), F.lit("")))
    created = lines.filter(is_trailer).select(
        F.to_utc_timestamp(F.try_to_timestamp(stamp, F.lit("MMddyyyyHH:mm")), EXCHANGE_ZONE).alias("created_at_utc")
    )
    return rows, created.agg(F.max("created_at_utc").alias("created_at_utc"))


def read_universe(spark: SparkSession, path: str, columns: Sequence[str], rejects: Rejects | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-04. (admitted rows, rejected rows with reasons) of a universe CSV."""
    raw = _trimmed(read_delimited(spark, path, columns, ",", "universe", rejects), columns)
    admitted = raw.filter(F.upper("universe_admission_status").isin("ADMITTED", "ADMITTED_ETF"))
    required = [c for c in ("security_id", "ticker", "exchange_mic") if c in columns]
    rules = {f"BLANK_{c.upper()}": F.col(c) == "" for c in required}
    counts = admitted.groupBy("security_id").agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    marked = admitted.join(counts, "security_id", "left")
    good, bad = quarantine(marked, {**rules, "DUPLICATE_SECURITY_ID": F.col("_repeated")})
    return good.drop("_repeated"), bad.drop("_repeated")


def read_registry(
    spark: SparkSession, path: str, fields: Sequence[str], key: Sequence[str], *,
    required: Sequence[str] = (), upper: Sequence[str] = (), rejects: Rejects | None = None,
) -> tuple[DataFrame, DataFrame]:
    """SRC-05. (good, bad) rows of a reviewed CSV whose header must be exactly ``fields``.

    Blank rows are skipped; blank key parts, blank required fields and repeated keys are
    rejected.
    """
    raw = _trimmed(read_delimited(spark, path, fields, ",", "registry", rejects), fields)
    rows = raw.withColumns({c: F.upper(c) for c in {*key, *upper}})
    rows = rows.filter(F.concat(*[F.col(f) for f in fields]) != "")
    repeated = rows.groupBy(*key).agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    rules = {f"BLANK_{c.upper()}": F.col(c) == "" for c in dict.fromkeys([*key, *required])}
    good, bad = quarantine(rows.join(repeated, list(key), "left"), {**rules, "DUPLICATE_KEY": F.col("_repeated")})
    return good.select(*fields), bad.select(*fields, "reject_reasons")


def read_tsv_table(spark: SparkSession, directory: str, name: str, columns: Sequence[str], rejects: Rejects | None = None) -> DataFrame:
    """SRC-08. A tab-separated table of an extracted archive, read by column name; NULL becomes ''.

    Archives carry more columns than asked for, in any order; a missing one is an error.
    """
    path = f"{directory.rstrip('/')}/{name}"
    first = spark.read.text(path).limit(1).collect()
    header = [c.strip().lstrip("\ufeff") for c in first[0][0].split("\t")] if first else list(columns)
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    raw = read_delimited(spark, path, header, "\t", "tsv_table", rejects)
    return _trimmed(raw.select(*[F.col(f"`{c}`") for c in columns]), columns)


# Output column, current field name, older field name.
SHORT_INTEREST_FIELDS = (
    ("symbol", "symbolCode", "issueSymbolIdentifier"),
    ("issue_name", "issueName", None),
    ("market", "marketClassCode", "marketCategoryDescription"),
    ("settlement_text", "settlementDate", None),
    ("current_short_shares", "currentShortPositionQuantity", "currentShortShareNumber"),
    ("previous_short_shares", "previousShortPositionQuantity", "previousShortShareNumber"),
    ("reported_change", "changePreviousNumber", None),
    ("short_change_percent", "changePercent", None),
    ("average_daily_volume", "averageDailyVolumeQuantity", "averageShortShareNumber"),
    ("days_to_cover", "daysToCoverQuantity", "daysToCoverNumber"),
    ("revision_flag", "revisionFlag", None),
)
_NUMERIC = {
    "current_short_shares", "previous_short_shares", "reported_change", "short_change_percent",
    "average_daily_volume", "days_to_cover",
}


def normalize_short_interest(raw: DataFrame) -> DataFrame:
    """SRC-09. Old and new field names coalesced, values typed."""
    columns = []
    for name, new, old in SHORT_INTEREST_FIELDS:
        present = [F.col(c) for c in (new, old) if c and c in raw.columns]
        value = first_not_blank(*present) if present else F.lit(None)
        value = finite_number(value) if name in _NUMERIC else F.nullif(F.trim(value.cast("string")), F.lit(""))
        columns.append(value.alias(name))
    rows = raw.select(*columns)
    return rows.select(
        F.upper("symbol").alias("symbol"), "issue_name", "market",
        parse_source_date("settlement_text").alias("settlement_date"),
        "current_short_shares", "previous_short_shares",
        F.coalesce("reported_change", F.col("current_short_shares") - F.col("previous_short_shares")).alias("short_change"),
        "short_change_percent", "average_daily_volume", "days_to_cover", "revision_flag",
    )


def read_short_interest(spark: SparkSession, path: str, layout: str = "array", rejects: Rejects | None = None) -> DataFrame:
    """SRC-09 from JSON records: one ``array`` per file, or one object per line (``lines``, splittable).

    A malformed record stops the read, or goes to ``rejects`` where given.
    """
    if layout not in ("array", "lines"):
        raise ValueError("layout is 'array' or 'lines'")
    schema = _text_schema([c for _, new, old in SHORT_INTEREST_FIELDS for c in (new, old) if c])
    if rejects is not None:
        return normalize_short_interest(read_documents(spark, path, schema, "short_interest", rejects, lines=layout == "lines"))
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", layout == "array")
    return normalize_short_interest(reader.json(path))


def read_publication_schedule(spark: SparkSession, path: str, cutoff: Column, rejects: Rejects | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-12. (published settlement dates, rows published before their settlement)."""
    raw = _trimmed(
        read_delimited(spark, path, ["settlement_date", "publication_date", "source_url"], ",", "publication_schedule", rejects),
        ["settlement_date", "publication_date"],
    ).select(
        parse_source_date("settlement_date").alias("settlement_date"),
        parse_source_date("publication_date").alias("publication_date"),
    ).filter(F.col("settlement_date").isNotNull() & (F.col("publication_date") <= cutoff))
    good, bad = quarantine(raw, {"PUBLICATION_BEFORE_SETTLEMENT": F.col("publication_date") < F.col("settlement_date")})
    return good, bad
