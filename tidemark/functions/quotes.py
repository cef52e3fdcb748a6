"""Quote gating rules (EXP-26)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.clock import seconds_between
from tidemark.functions.numbers import col

__all__ = ["QuotePolicy", "quote_block_reasons", "QUOTE_FEEDS", "STATUS_FEEDS", "BROKER_FEEDS"]

# Acceptable feeds per provider role.
QUOTE_FEEDS = ("SIP_NBBO", "DIRECT_NBBO")
STATUS_FEEDS = ("EXCHANGE_STATUS", "SIP_STATUS")
BROKER_FEEDS = ("BROKER_ELIGIBILITY",)


@dataclass(frozen=True)
class QuotePolicy:
    """Age limits in seconds and spread limits."""

    quote_age: int = 5
    status_age: int = 5
    broker_age: int = 300
    clock_skew: int = 2
    spread_bps: float = 100.0
    spread_absolute: float | None = None
    block_on_crossed: bool = True


def quote_block_reasons(
    quote: str = "quote", status: str = "market_status", broker: str = "broker_eligibility",
    cutoff: Column | str = "cutoff_utc", generated: Column | str = "generated_at_utc",
    requested: Column | str = "requested_at_utc", received: Column | str = "received_at_utc",
    policy: QuotePolicy = QuotePolicy(),
) -> Column:
    """EXP-26. Sorted distinct reason codes; the quote is READY when it is empty.

    ``quote``, ``status`` and ``broker`` name struct columns. Values the rules need but
    do not find give ``INVALID_QUOTE_VALUE`` / ``INVALID_LULD_BANDS`` instead of an error.
    """
    q, s, b = (lambda f, n=n: F.col(f"{n}.{f}") for n in (quote, status, broker))
    cut, gen = col(cutoff), col(generated)
    available = F.coalesce(q("state") == "AVAILABLE", F.lit(False))
    bid, ask = q("bid"), q("ask")
    spread = ask - bid
    bps = F.try_divide(spread, (ask + bid) / 2) * 10_000
    quote_age = seconds_between(cut, q("quote_at_utc"))
    status_age = seconds_between(cut, s("observed_at_utc"))
    broker_age = seconds_between(cut, b("observed_at_utc"))
    finite = lambda c: ~F.isnan(c) & (F.abs(c) < float("inf"))
    positive = (
        (bid > 0) & (ask > 0) & finite(bid) & finite(ask) & (q("last").isNull() | ((q("last") > 0) & finite(q("last"))))
        & finite(q("bid_size").cast("double")) & finite(q("ask_size").cast("double"))
    )
    bands_given = s("lower_band").isNotNull() | s("upper_band").isNotNull()
    bands_ok = (s("lower_band") > 0) & (s("upper_band") > 0) & (s("lower_band") < s("upper_band")) & finite(s("lower_band")) & finite(s("upper_band"))
    codes_ok = b("reason_codes").isNotNull() & ~F.exists(
        b("reason_codes"), lambda c: F.coalesce(c, F.lit("")) == ""
    )
    too_wide = bps > policy.spread_bps
    if policy.spread_absolute is not None:
        too_wide = too_wide | (spread > policy.spread_absolute)
    no = lambda test: ~F.coalesce(test, F.lit(False))  # noqa: E731  TRUE unless known to hold
    # Reason codes and the rule behind each.
    rules = {
        "UNACCEPTABLE_QUOTE_FEED": no(q("feed_type").isin(*QUOTE_FEEDS)),
        "QUOTE_UNAVAILABLE": ~available,
        "INVALID_QUOTE_VALUE": available & no(positive),
        "UNKNOWN_MARKET_SESSION": available & no(q("session").isin("PRE_MARKET", "REGULAR", "POST_MARKET")),
        "CROSSED_MARKET": available & (bid > ask) & F.lit(policy.block_on_crossed),
        "SPREAD_TOO_WIDE": available & too_wide,
        "NEGATIVE_BID_SIZE": available & (q("bid_size") < 0),
        "NEGATIVE_ASK_SIZE": available & (q("ask_size") < 0),
        "STALE_QUOTE": available & no(quote_age <= policy.quote_age),
        "QUOTE_AFTER_CUTOFF": available & (quote_age < -policy.clock_skew),
        "QUOTE_AFTER_SNAPSHOT": available & (q("quote_at_utc") > gen),
        "SECURITY_HALTED": s("halt_status") == "HALTED",
        "HALT_STATUS_UNKNOWN": no(s("halt_status").isin("HALTED", "NOT_HALTED")),
        "LULD_PAUSED": s("luld_status") == "PAUSED",
        "LULD_STATUS_UNKNOWN": no(s("luld_status").isin("PAUSED", "NORMAL")),
        "STALE_MARKET_STATUS": no(status_age <= policy.status_age),
        "MARKET_STATUS_AFTER_CUTOFF": status_age < -policy.clock_skew,
        "INVALID_LULD_BANDS": bands_given & no(bands_ok),
        "BROKER_INELIGIBLE_OR_UNKNOWN": no(b("eligible")),
        "INVALID_BROKER_REASON_CODES": no(codes_ok),
        "STALE_BROKER_ELIGIBILITY": no(broker_age <= policy.broker_age),
        "BROKER_STATUS_AFTER_CUTOFF": broker_age < -policy.clock_skew,
        "BROKER_STATUS_AFTER_SNAPSHOT": b("observed_at_utc") > gen,
        "RESPONSE_PRECEDES_REQUEST": col(requested) > col(received),
        "RESPONSE_AFTER_SNAPSHOT": col(received) > gen,
    }
    return F.array_sort(F.array_compact(F.array(*[F.when(test, F.lit(code)) for code, test in rules.items()])))
