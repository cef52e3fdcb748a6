"""Compact read model (PIP-17, SET-01)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import ANALYST_ESTIMATES, BENCHMARK_RETURNS, CANDIDATE_FUNNEL, DISTRIBUTIONS, EVIDENCE
from tidemark.functions import event_window
from tidemark.operators.keys import full_outer_master, latest_per_key, recent_n
from tidemark.plans.market import market_snapshot

RECENT_SESSIONS = 64
# Table name and its lookup key.
READ_MODEL_KEYS = {
    "metadata": ("key",), "dataset_health": ("group_id",), "capability_health": ("capability_id",),
    "security": ("security_id",), "market_snapshot": ("security_id",),
    "market_history_recent": ("security_id", "session_date"), "fundamental_factors_latest": ("security_id",),
    "corporate_events": ("effective_date", "security_id", "event_id"),
    "earnings_events": ("event_date", "security_id", "event_id"), "insider_signals_latest": ("security_id",),
    "institutional_signals_latest": ("security_id",), "short_interest_latest": ("security_id",),
    "analyst_estimates_latest": ("security_id", "fiscal_period", "metric", "provider"),
    "distributions": ("security_id", "ex_date"), "benchmark_total_returns": ("security_id", "session_date"),
    "primary_filings_latest": ("security_id", "form"), "evidence": ("evidence_id",),
    "candidate_funnel": ("candidate_id",), "actionability_matrix": ("phase_id", "security_id"),
}


def _newest(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def security_table(universe: DataFrame, master: DataFrame) -> DataFrame:
    """JOI-17. All current and historical ids, universe values first."""
    current = universe.select("security_id", "ticker", "exchange_mic", "security_type", "universe_admission_status")
    known = master.select("security_id", "ticker", "exchange_mic", "cik", "registrant_name", "sic", "mapping_status")
    both = full_outer_master(
        current, known, "security_id", ["ticker", "exchange_mic", "security_type", "universe_admission_status"]
    )
    return both.withColumn("ticker", F.coalesce("ticker", F.lit(""))).withColumn("is_current", F.col("is_current").cast("int"))


def evidence_part(
    df: DataFrame, *, prefix: str, kind: str, revision: str, known: Sequence[str], event: Sequence[str], locator: str,
    headline: Column, summary: str, order: Sequence[Column], window: Column | None = None,
) -> DataFrame:
    """One branch of SET-01, deduplicated per (security, revision) before the union.

    Rows equal in ``order`` are told apart by what is shown of them.
    """
    rows = df.filter(
        F.col(revision).isNotNull() & F.col("security_id").isNotNull() & F.col(locator).isNotNull()
        & F.coalesce(*known).isNotNull()
    )
    if window is not None:
        rows = rows.filter(window)
    ties = [F.col(locator), headline, F.col(summary), F.coalesce(*known), F.coalesce(*event)]
    one = latest_per_key(rows, ["security_id", revision], [*order, *[c.asc_nulls_last() for c in ties]])
    return one.select(
        F.concat(F.lit(f"{prefix}:"), "security_id", F.lit(":"), revision).alias("evidence_id"), "security_id",
        F.lit(kind).alias("evidence_kind"), F.coalesce(*known).alias("known_at_utc"), F.col(revision).alias("revision"),
        F.coalesce(*event).alias("source_event_at"), F.col(locator).alias("source_locator"),
        headline.alias("headline"), F.col(summary).alias("summary"),
    )


def build_evidence(filings: DataFrame, events: DataFrame, earnings: DataFrame, cutoff: Column) -> DataFrame:
    """SET-01. Filings, corporate events and earnings events in one index."""
    accepted, retrieved = "source_acceptance_datetime_utc", "source_retrieved_at_utc"
    dates = ("source_event_date", "source_filing_date")
    parts = [
        evidence_part(
            filings, prefix="sec-filing", kind="SEC_FILING", revision="accession_number",
            known=["acceptance_datetime_utc", accepted, retrieved], event=["acceptance_datetime_utc", accepted],
            locator="primary_document_url", headline=F.concat("form", F.lit(" filing")), summary="primary_document",
            order=_newest("acceptance_datetime_utc", retrieved),
        ),
        evidence_part(
            events, prefix="corporate-event", kind="CORPORATE_EVENT", revision="event_id",
            known=["announcement_datetime_utc", accepted, retrieved], event=["announcement_datetime_utc", accepted],
            locator="source_document_url", headline=F.col("headline"), summary="summary",
            order=_newest(retrieved, "announcement_datetime_utc"), window=event_window(cutoff, "effective_date", *dates),
        ),
        evidence_part(
            earnings, prefix="earnings-event", kind="EARNINGS_EVENT", revision="event_id",
            known=["event_datetime_utc", accepted, retrieved], event=["event_datetime_utc", accepted],
            locator="source_document_url",
            headline=F.concat("event_type", F.lit(" "), F.coalesce("fiscal_period", F.lit(""))), summary="guidance_direction",
            order=_newest(retrieved, "event_datetime_utc"), window=event_window(cutoff, "event_date", *dates),
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(*EVIDENCE.columns)


def build_read_model(tables: Mapping[str, DataFrame], *, cutoff: Column, health: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """PIP-17. The read-model tables from the stored ones.

    ``tables`` is keyed by contract name and may lack the optional lanes; ``health`` gives
    ``metadata``, ``dataset_health``, ``capability_health`` and ``actionability_matrix``.
    """
    spark = tables["prices"].sparkSession

    def optional(contract) -> DataFrame:
        found = tables.get(contract.name)
        return spark.createDataFrame([], contract.schema) if found is None else found

    prices = tables["prices"]
    retrieved = "source_retrieved_at_utc"
    latest = lambda name, column: latest_per_key(tables[name], ["security_id"], _newest(column, retrieved))
    dates = ("source_event_date", "source_filing_date")
    return {
        **health,
        "security": security_table(tables["security_universe"], tables["security_master"]),
        "market_snapshot": market_snapshot(prices, extra=("ticker", "source_dataset", "source_revision", "observed_at_utc")),
        "market_history_recent": recent_n(prices, ["security_id"], [F.col("session_date").desc()], RECENT_SESSIONS).select(
            "security_id", "session_date", "open", "high", "low", "close", "volume", "source_revision", "observed_at_utc"
        ),
        "fundamental_factors_latest": latest("fundamental_factors", "factor_as_of_date"),
        "insider_signals_latest": latest("insider_signals", "signal_as_of_date"),
        "institutional_signals_latest": latest("ownership_signals", "report_period"),
        "short_interest_latest": latest("short_interest", "settlement_date"),
        "corporate_events": tables["corporate_events"].filter(event_window(cutoff, "effective_date", *dates)),
        "earnings_events": tables["earnings_events"].filter(event_window(cutoff, "event_date", *dates)),
        "primary_filings_latest": latest_per_key(
            tables["filings"], ["security_id", "form"],
            [*_newest("acceptance_datetime_utc", retrieved), F.col("accession_number").desc()],
        ),
        "analyst_estimates_latest": latest_per_key(
            optional(ANALYST_ESTIMATES), ["security_id", "fiscal_period", "metric", "provider"],
            _newest("estimate_as_of_utc", retrieved),
        ),
        "distributions": optional(DISTRIBUTIONS), "benchmark_total_returns": optional(BENCHMARK_RETURNS),
        "evidence": build_evidence(tables["filings"], tables["corporate_events"], tables["earnings_events"], cutoff),
        "candidate_funnel": spark.createDataFrame([], CANDIDATE_FUNNEL.schema),
    }
