"""Dates, UTC instants and exchange-local time rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.contracts import POINT_IN_TIME_COLUMNS
from tidemark.functions.numbers import col

__all__ = [
    "parse_source_date", "source_date_unparsed", "parse_utc", "utc_text", "local_time",
    "available_date", "market_time_class", "event_window", "fact_is_knowable",
    "pit_columns", "seconds_between", "EXCHANGE_ZONE",
]

EXCHANGE_ZONE = "America/New_York"
_CLOSE_SECONDS = 16 * 3600
_OPEN_SECONDS = 9 * 3600 + 30 * 60


def parse_source_date(value: Column | str) -> Column:
    """EXP-10. ISO, ``08-JAN-2024`` and ``08-JANUARY-2024``; anything else is NULL."""
    text = F.trim(col(value).cast("string"))
    title = F.initcap(F.lower(F.replace(text, F.lit("-"), F.lit(" "))))
    day_first = F.when(
        text.rlike(r"\A[0-9]{1,2}-[A-Za-z]+-[0-9]{4}\z"),
        F.coalesce(
            F.try_to_timestamp(title, F.lit("d MMM yyyy")).cast("date"),
            F.try_to_timestamp(title, F.lit("d MMMM yyyy")).cast("date"),
        ),
    )
    iso = F.when(
        text.rlike(r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), text.try_cast("date")
    )
    return F.coalesce(iso, day_first)


def source_date_unparsed(value: Column | str) -> Column:
    """Text that is present but is no date: belongs in quarantine."""
    text = F.trim(F.coalesce(col(value).cast("string"), F.lit("")))
    return (text != "") & parse_source_date(value).isNull()


def parse_utc(value: Column | str) -> Column:
    """EXP-11. RFC 3339 with a mandatory zone to a UTC instant; else NULL."""
    text = F.trim(col(value).cast("string"))
    zoned = text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9:.]+(?:Z|[+-][0-9]{2}:?[0-9]{2})\z")
    return F.when(zoned, F.try_to_timestamp(text))


def utc_text(value: Column | str) -> Column:
    return F.date_format(col(value), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def local_time(instant: Column | str, zone: str = EXCHANGE_ZONE) -> Column:
    """Wall-clock timestamp in ``zone`` of a UTC instant (session zone UTC)."""
    return F.from_utc_timestamp(col(instant), zone)


def _micros_of_day(local: Column) -> Column:
    return F.unix_micros(local) - F.unix_micros(F.date_trunc("day", local))


def available_date(filing_date: Column | str, acceptance: Column | str, zone: str = EXCHANGE_ZONE) -> Column:
    """EXP-14. Local acceptance day up to 16:00:00 inclusive, else the next day."""
    local = local_time(acceptance, zone)
    day = F.to_date(local)
    on_time = _micros_of_day(local) <= _CLOSE_SECONDS * 1_000_000
    return F.when(
        col(acceptance).isNotNull(), F.when(on_time, day).otherwise(F.date_add(day, 1))
    ).otherwise(F.date_add(col(filing_date), 1))


def market_time_class(acceptance: Column | str, zone: str = EXCHANGE_ZONE) -> Column:
    """EXP-15. 16:00:00 exactly is still DURING_MARKET."""
    micros = _micros_of_day(local_time(acceptance, zone))
    return (
        F.when(col(acceptance).isNull(), F.lit("TIME_UNKNOWN"))
        .when(micros < _OPEN_SECONDS * 1_000_000, F.lit("BEFORE_MARKET"))
        .when(micros <= _CLOSE_SECONDS * 1_000_000, F.lit("DURING_MARKET"))
        .otherwise(F.lit("AFTER_MARKET"))
    )


def event_window(
    cutoff: Column, *dates: Column | str, back: int = 180, ahead: int = 365
) -> Column:
    """EXP-24. First known date lies within the window around the cutoff."""
    known = F.coalesce(*[col(d) for d in dates])
    return known.between(F.date_sub(cutoff, back), F.date_add(cutoff, ahead))


def fact_is_knowable(filed: Column | str, period_end: Column | str) -> Column:
    """EXP-20. A fact whose period ends after it was filed cannot be known then."""
    return col(period_end).isNull() | (col(filed) >= col(period_end))


def pit_columns(
    event_date: Column | None = None, filing_date: Column | None = None,
    acceptance: Column | None = None, publication_date: Column | None = None,
    retrieved_at: Column | None = None,
) -> list[Column]:
    """EXP-18. The five provenance columns, typed and in order."""
    values = (event_date, filing_date, acceptance, publication_date, retrieved_at)
    kinds = ("date", "date", "timestamp", "date", "timestamp")
    return [
        (F.lit(None) if value is None else value).cast(kind).alias(name)
        for value, kind, name in zip(values, kinds, POINT_IN_TIME_COLUMNS)
    ]


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    return (
        F.unix_micros(col(later).cast("timestamp")) - F.unix_micros(col(earlier).cast("timestamp"))
    ) / F.lit(1_000_000.0)
