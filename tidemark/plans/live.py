"""Verdicts on live snapshots: their header, providers and records (EXP-26, EXP-27).

Errors are bits of one number, so records fold into securities and securities into snapshots by
``bit_or`` with partial aggregation, however many records a snapshot has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import QuotePolicy, quote_block_reasons
from tidemark.functions.clock import seconds_between
from tidemark.functions.quotes import BROKER_FEEDS, QUOTE_FEEDS, STATUS_FEEDS

# Provider roles and their acceptable feeds; seconds from cutoff to generation.
ROLE_FEEDS = {"quote": QUOTE_FEEDS, "market_status": STATUS_FEEDS, "broker_eligibility": BROKER_FEEDS}
GENERATION_SECONDS = 60

ERRORS = (
    "NO_HEADER", "GENERATED_BEFORE_CUTOFF", "GENERATED_TOO_LATE", "PROVIDER_ROLES", "PROVIDER_IDENTITY", "PROVIDER_FEED",
    "STALE_PROVIDER", "FUTURE_PROVIDER", "NO_SECURITIES", "INVALID_SECURITY_ID", "DUPLICATE_SECURITY_ID", "MISSING_IDENTITY",
    "QUOTE_IDENTITY", "MARKET_STATUS_IDENTITY", "BROKER_IDENTITY", "QUOTE_FEED_MISMATCH", "WRONG_STATUS", "WRONG_BLOCK_REASONS",
    "WRONG_SNAPSHOT_STATUS",
)


def _bits(tests: dict[str, Column]) -> Column:
    """The number with the bit of every code whose test is TRUE."""
    total = F.lit(0).cast("bigint")
    for code, test in tests.items():
        total = total + F.when(test, F.lit(1 << ERRORS.index(code))).otherwise(0).cast("bigint")
    return total


def error_codes(mask: Column) -> Column:
    """Codes of the bits, in the order of :data:`ERRORS`."""
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.lit(code)) for i, code in enumerate(ERRORS)]))


def _no(test: Column) -> Column:
    return ~F.coalesce(test, F.lit(False))


def provider_verdicts(providers: DataFrame, headers: DataFrame, policy: QuotePolicy = QuotePolicy(), key: str = "snapshot_id") -> DataFrame:
    """(key, provider_errors, quote_feed): every role exactly once, named, on a fitting feed and fresh."""
    c = F.col
    ages = {"quote": policy.quote_age, "market_status": policy.status_age, "broker_eligibility": policy.broker_age}
    allowed, limit = F.lit(False), F.lit(None).cast("int")
    for role, feeds in ROLE_FEEDS.items():
        allowed = allowed | ((c("role") == role) & c("feed_type").isin(*feeds))
        limit = F.when(c("role") == role, ages[role]).otherwise(limit)
    age = seconds_between("actual_cutoff_utc", "observed_at_utc")
    named = F.lit(True)
    for field in ("provider_id", "entitlement_scope", "request_id", "provider_response_id"):
        named = named & (F.trim(c(field)) != "")
    future = (age < -policy.clock_skew) | (c("observed_at_utc") > c("generated_at_utc"))
    rows = providers.join(headers.select(key, "actual_cutoff_utc", "generated_at_utc"), key).select(
        key, "role", "feed_type",
        _bits({
            "PROVIDER_IDENTITY": _no(named), "PROVIDER_FEED": _no(allowed), "STALE_PROVIDER": _no(age <= limit), "FUTURE_PROVIDER": future,
        }).alias("_bits"),
    )
    once = F.lit(True)
    for role in ROLE_FEEDS:
        once = once & (F.count_if(c("role") == role) == 1)
    exact = once & (F.count(F.lit(1)) == len(ROLE_FEEDS))
    return rows.groupBy(key).agg(
        F.bit_or("_bits").alias("_seen"), exact.alias("_exact"), F.max(F.when(c("role") == "quote", c("feed_type"))).alias("quote_feed")
    ).select(key, (c("_seen") + _bits({"PROVIDER_ROLES": ~c("_exact")})).alias("provider_errors"), "quote_feed")


def _identity_differs(part: str, currency: bool) -> Column:
    same = F.lit(True)
    for field in ("symbol", "exchange_mic", *(["currency"] if currency else [])):
        same = same & F.col(f"{part}.{field}").eqNullSafe(F.col(field))
    return ~same


def snapshot_verdicts(
    headers: DataFrame, providers: DataFrame, records: DataFrame, policy: QuotePolicy = QuotePolicy(), key: str = "snapshot_id",
) -> DataFrame:
    """EXP-27. (key, securities, blocked, snapshot_status, errors, verdict), one row a snapshot.

    ``headers``: key, status, actual_cutoff_utc, generated_at_utc. ``records``: key, security_id,
    symbol, exchange_mic, currency, quote, market_status, broker_eligibility (with their own
    identity), requested_at_utc, received_at_utc, status, block_reasons as claimed. VALID means that
    all claims hold; a valid snapshot may be BLOCKED. Records without a header, headers without
    records, null ids and repeated ids are errors of their snapshot.
    """
    c = F.col
    head = headers.select(key, c("status").alias("_claimed"), "actual_cutoff_utc", "generated_at_utc").join(
        provider_verdicts(providers, headers, policy, key), key, "left"
    ).withColumn("_known", F.lit(True))
    judged = records.join(
        head.select(key, "actual_cutoff_utc", "generated_at_utc", c("quote_feed").alias("_feed"), "_known"), key, "left"
    ).withColumn("_why", quote_block_reasons(cutoff="actual_cutoff_utc", generated="generated_at_utc", policy=policy))
    status = F.when(F.size("_why") == 0, "READY").otherwise("BLOCKED")
    known = c("_known").isNotNull()
    filled = F.lit(True)
    for field in ("symbol", "exchange_mic", "currency"):
        filled = filled & (F.trim(c(field)) != "")
    text_id = F.trim(c("security_id").cast("string"))
    bits = _bits({
        "INVALID_SECURITY_ID": _no(text_id != ""), "MISSING_IDENTITY": _no(filled),
        "QUOTE_IDENTITY": _identity_differs("quote", True), "MARKET_STATUS_IDENTITY": _identity_differs("market_status", False),
        "BROKER_IDENTITY": _identity_differs("broker_eligibility", True),
        "QUOTE_FEED_MISMATCH": known & ~c("quote.feed_type").eqNullSafe(c("_feed")),
        "WRONG_STATUS": known & ~c("status").eqNullSafe(status), "WRONG_BLOCK_REASONS": known & ~c("block_reasons").eqNullSafe(c("_why")),
    })
    securities = judged.select(key, "security_id", bits.alias("_bits"), (status == "BLOCKED").alias("_down")).groupBy(key, "security_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("_down").alias("_blocked"), F.bit_or("_bits").alias("_bits")
    )
    twice = _bits({"DUPLICATE_SECURITY_ID": (c("_n") > 1) & c("security_id").isNotNull()})
    folded = securities.groupBy(key).agg(
        F.sum("_n").alias("securities"), F.sum("_blocked").alias("blocked"), F.bit_or(c("_bits").bitwiseOR(twice)).alias("_bits")
    )
    whole = head.join(folded, key, "full").withColumns({n: F.coalesce(n, F.lit(0)).cast("bigint") for n in ("securities", "blocked", "_bits")})
    expected = F.when(c("blocked") == 0, "READY").otherwise("BLOCKED")
    here = c("_known").isNotNull()
    late = seconds_between("generated_at_utc", "actual_cutoff_utc")
    mask = c("_bits").bitwiseOR(F.coalesce("provider_errors", F.lit(0)).cast("bigint")).bitwiseOR(_bits({
        "NO_HEADER": ~here, "GENERATED_BEFORE_CUTOFF": here & _no(late >= 0), "GENERATED_TOO_LATE": late > GENERATION_SECONDS,
        "PROVIDER_ROLES": here & c("provider_errors").isNull(), "NO_SECURITIES": c("securities") == 0,
        "WRONG_SNAPSHOT_STATUS": here & ~c("_claimed").eqNullSafe(expected),
    }))
    return whole.select(
        key, "securities", "blocked", expected.alias("snapshot_status"), error_codes(mask).alias("errors"),
        F.when(mask == 0, "VALID").otherwise("INVALID").alias("verdict"),
    )
