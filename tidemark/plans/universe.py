"""Security universe from listing feeds and reviewed registries (PIP-01)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import UNIVERSE_COLUMNS
from tidemark.functions import admission, classify_security, reviewed_type, utc_text
from tidemark.operators.quality import duplicate_keys

# Venue codes of the second feed; other codes are dropped.
VENUES = {"N": "XNYS", "P": "ARCX", "Z": "BATS", "C": "CBOE"}
ADMITTED = ("ADMITTED", "ADMITTED_ETF")
# Values of a listing without reviewed metadata.
METADATA_DEFAULTS = {
    "cik": "", "cusip": "", "isin": "", "adr_status": "NOT_ADR", "adr_ratio": "", "home_exchange": "",
    "home_country": "", "fund_provider": "", "index_tracked": "", "expense_ratio": "", "asset_class": "",
    "leveraged": "false", "inverse": "false", "currency": "USD", "listing_status": "ACTIVE",
    "exchange_country": "USA",
}
METADATA_FIELDS = ("exchange_mic", "source_symbol", *METADATA_DEFAULTS)
OVERRIDE_FIELDS = ("exchange_mic", "source_symbol", "action", "security_id", "canonical_ticker", "security_type", "reason")


@dataclass(frozen=True)
class Universe:
    rows: DataFrame
    problems: DataFrame


def listings(nasdaq: DataFrame, other: DataFrame) -> DataFrame:
    """Both feeds in one shape; listings of unmapped venues are dropped."""
    flag = lambda c: F.col(f"`{c}`") == "Y"
    first = nasdaq.select(
        F.upper(F.trim("Symbol")).alias("ticker"), F.col("`Security Name`").alias("legal_name"),
        F.lit("XNAS").alias("exchange_mic"), (F.col("`Test Issue`") != "N").alias("is_test"),
        flag("ETF").alias("is_etf"), flag("NextShares").alias("is_nextshares"),
        F.col("`Financial Status`").alias("financial_status"), F.lit("nasdaqlisted.txt").alias("source_file"),
    )
    venue = F.element_at(F.create_map(*[F.lit(x) for kv in VENUES.items() for x in kv]), F.upper("Exchange"))
    second = other.select(
        F.upper(F.trim("`ACT Symbol`")).alias("ticker"), F.col("`Security Name`").alias("legal_name"),
        venue.alias("exchange_mic"), (F.col("`Test Issue`") != "N").alias("is_test"),
        flag("ETF").alias("is_etf"), F.lit(False).alias("is_nextshares"),
        F.lit(None).cast("string").alias("financial_status"), F.lit("otherlisted.txt").alias("source_file"),
    ).filter("exchange_mic is not null")
    return first.unionByName(second)


def with_metadata(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """JOI-16. Reviewed values over the defaults, by (venue, symbol)."""
    lower = {"leveraged", "inverse"}
    upper = {"currency", "listing_status", "exchange_country", "adr_status"}

    def reviewed(name: str) -> Column:
        value = F.col(name)
        if name in lower:
            value = F.coalesce(F.nullif(F.lower(value), F.lit("")), F.lit("false"))
        elif name in upper:
            value = F.upper(value)
        return value.alias(f"_m_{name}")

    known = metadata.select("exchange_mic", F.col("source_symbol").alias("ticker"), *[reviewed(c) for c in METADATA_DEFAULTS])
    joined = rows.join(known, ["exchange_mic", "ticker"], "left")
    return joined.select(
        *rows.columns, *[F.coalesce(f"_m_{c}", F.lit(d)).alias(c) for c, d in METADATA_DEFAULTS.items()]
    )


def apply_overrides(rows: DataFrame, overrides: DataFrame) -> DataFrame:
    """JOI-16. Reviewed admissions and exclusions replace identity, type and status."""
    o = overrides.select(
        "exchange_mic", "source_symbol", F.upper("action").alias("_action"),
        *[F.nullif(c, F.lit("")).alias(f"_o_{c}") for c in ("security_id", "canonical_ticker", "security_type")],
        F.col("reason").alias("_reason"),
    )
    kind = F.coalesce("_o_security_type", "security_type")
    hit = F.col("_action").isNotNull()
    status = (
        F.when((F.col("_action") == "ADMIT") & (kind == "ETF"), F.lit("ADMITTED_ETF"))
        .when(F.col("_action") == "ADMIT", F.lit("ADMITTED"))
        .otherwise(F.lit("REJECTED_UNKNOWN_SECURITY_TYPE"))
    )
    changed = {
        "security_id": F.coalesce("_o_security_id", "security_id"),
        "ticker": F.upper(F.coalesce("_o_canonical_ticker", "ticker")),
        "security_type": kind,
        "universe_admission_status": F.when(hit, status).otherwise(F.col("universe_admission_status")),
        "admission_reason": F.when(hit, F.concat(F.lit("OVERRIDE_"), "_action", F.lit(":"), "_reason")).otherwise(
            F.col("admission_reason")
        ),
    }
    joined = rows.join(o, ["exchange_mic", "source_symbol"], "left")
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in rows.columns])


def identifier_problems(rows: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(problem, key): repeated listings, ids on two listings, admitted tickers on two ids."""
    listing = duplicate_keys(rows, ["exchange_mic", "source_symbol"]).select(
        F.lit("DUPLICATE_LISTING").alias("problem"), F.concat_ws(":", "exchange_mic", "source_symbol").alias("key")
    )
    ids = rows.groupBy("security_id").agg(
        F.min(F.struct("exchange_mic", "source_symbol")).alias("a"), F.max(F.struct("exchange_mic", "source_symbol")).alias("b")
    ).filter("a <> b").select(F.lit("SECURITY_ID_COLLISION").alias("problem"), F.col("security_id").alias("key"))
    tickers = rows.filter(F.col("universe_admission_status").isin(*ADMITTED)).groupBy("ticker").agg(
        F.min("security_id").alias("a"), F.max("security_id").alias("b")
    ).filter("a <> b").select(F.lit("AMBIGUOUS_ADMITTED_TICKER").alias("problem"), F.col("ticker").alias("key"))
    blank = rows.filter(F.col("ticker") == "").select(F.lit("BLANK_TICKER").alias("problem"), F.col("exchange_mic").alias("key"))
    out = listing.unionByName(ids).unionByName(tickers).unionByName(blank)
    if overrides is not None:
        lost = overrides.join(rows, ["exchange_mic", "source_symbol"], "left_anti").select(
            F.lit("OVERRIDE_WITHOUT_LISTING").alias("problem"), F.concat_ws(":", "exchange_mic", "source_symbol").alias("key")
        )
        out = out.unionByName(lost)
    return out


def classify_listings(rows: DataFrame, *, created: dict[str, Column], digests: dict[str, str], generated_at: Column) -> DataFrame:
    """EXP-03..05 over listings with metadata; ``created`` and ``digests`` by source file."""
    named = classify_security("legal_name", F.col("is_etf"), F.col("is_nextshares"))
    typed = rows.withColumn("security_type", reviewed_type("adr_status", named))
    verdict = admission(
        "security_type", F.col("is_test"), F.col("financial_status"), "exchange_country", "currency",
        "listing_status", "leveraged", "inverse", "cik",
    )
    stamp = digest = F.lit("")
    for name in created:
        here = F.col("source_file") == name
        stamp = F.when(here, utc_text(created[name])).otherwise(stamp)
        digest = F.when(here, F.lit(digests.get(name, ""))).otherwise(digest)
    values = {
        "security_id": F.concat_ws(":", "exchange_mic", "ticker"), "source_symbol": F.col("ticker"),
        "legal_name": F.trim("legal_name"), "universe_admission_status": F.col("_v.status"),
        "admission_reason": F.col("_v.reason"), "source_file_created_at_utc": stamp,
        "source_file_sha256": digest, "generated_at_utc": utc_text(generated_at),
    }
    return typed.withColumn("_v", verdict).select(
        *[values[c].alias(c) if c in values else F.col(c) for c in UNIVERSE_COLUMNS]
    )


def build_universe(
    nasdaq: DataFrame, other: DataFrame, metadata: DataFrame, overrides: DataFrame, *,
    created: dict[str, Column], digests: dict[str, str], generated_at: Column,
) -> Universe:
    """PIP-01."""
    rows = classify_listings(
        with_metadata(listings(nasdaq, other), metadata), created=created, digests=digests, generated_at=generated_at
    )
    final = apply_overrides(rows, overrides)
    return Universe(final, identifier_problems(final, overrides))


def source_age_problems(created: DataFrame, generated_at: Column, max_hours: float) -> DataFrame:
    """Feed age gate: (source_file, age_hours, problem) for feeds from the future or too old."""
    age = (F.unix_micros(generated_at) - F.unix_micros("created_at_utc")) / 3.6e9
    problem = F.when(age < -1, F.lit("SOURCE_IN_FUTURE")).when(age > max_hours, F.lit("SOURCE_TOO_OLD"))
    return created.withColumn("age_hours", age).withColumn("problem", problem).filter("problem is not null")
