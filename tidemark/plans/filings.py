"""Security master, filings, corporate and earnings events (PIP-03, PIP-04, PIP-08, PIP-09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    accession_ok, available_date, filing_attribution, filing_url, hash_id, market_time_class, pit_columns,
    ticker_variants,
)
from tidemark.operators.skew import OrderedKeys
from tidemark.session import stage

PARSER_VERSION = "sec-events-1.0.0"


def resolve_tickers(df: DataFrame, universe: DataFrame, symbol: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """EXP-07. (rows with security_id or NULL, rows whose spellings name two securities).

    Each row tries at most three spellings and is folded back to one row per row id.
    """
    names = universe.select(F.upper("ticker").alias("_variant"), "security_id")
    keyed = df.select(*keep, symbol, F.explode_outer(ticker_variants(symbol)).alias("_variant"))
    matched = keyed.join(names, "_variant", "left").groupBy(*dict.fromkeys([*keep, symbol])).agg(
        F.min("security_id").alias("security_id"), F.max("security_id").alias("_other")
    )
    clash = F.col("security_id") != F.col("_other")
    return (
        matched.filter(~F.coalesce(clash, F.lit(False))).drop("_other"),
        matched.filter(F.coalesce(clash, F.lit(False))).drop("_other"),
    )


def active_overrides(overrides: DataFrame, cutoff: Column) -> DataFrame:
    """JOI-15. The (security_id, cik) in force at the cutoff; an open end is NULL."""
    return overrides.filter(
        (F.col("effective_from") <= cutoff) & (F.col("effective_to").isNull() | (cutoff <= F.col("effective_to")))
    ).select("security_id", F.col("cik").alias("override_cik"))


def override_overlaps(overrides: DataFrame, key: str = "security_id", chunk_rows: int | None = None) -> DataFrame:
    """WIN-18. Periods starting on or before the end of the previous one of the key."""
    ends = overrides.withColumn("_end", F.coalesce("effective_to", F.lit("9999-12-31").cast("date")))
    ordered = OrderedKeys(ends, [key], ["effective_from", "_end"], chunk_rows).running(
        maxima_before={"_prev": F.struct("effective_from", "_end")}
    )
    return ordered.with_columns({"previous_to": F.col("_prev._end")}).result().filter(
        F.col("effective_from") <= F.col("previous_to")
    ).drop("_prev", "_end")


def build_security_master(
    registrants: DataFrame, universe: DataFrame, overrides: DataFrame, *, revision: str, retrieved_at: Column,
) -> tuple[DataFrame, DataFrame]:
    """PIP-03 / JOI-14. (master, overrides naming a CIK that is no candidate).

    ``registrants`` has cik, registrant_name, sic, ticker, ticker_position; ``overrides``
    the (security_id, override_cik) in force. A security claimed by several CIKs without
    an override stays unresolved; the first ticker of a CIK is its primary class.
    """
    resolved, _ = resolve_tickers(
        registrants, universe, "ticker", ["cik", "registrant_name", "sic", "ticker_position"]
    )
    claims = resolved.filter("security_id is not null").groupBy("cik", "security_id").agg(
        F.min("ticker_position").alias("position"),
        F.max(F.struct("registrant_name", "sic")).alias("_r"),
    )
    per_security = claims.groupBy("security_id").agg(F.min("cik").alias("_lo"), F.max("cik").alias("_hi"))
    choice = per_security.join(overrides, "security_id", "left").select(
        "security_id", (F.col("_lo") != F.col("_hi")).alias("collision"), "override_cik",
        F.coalesce("override_cik", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo"))).alias("cik"),
    )
    chosen = claims.join(choice.filter("cik is not null"), ["security_id", "cik"])
    bad_overrides = choice.filter("override_cik is not null").join(claims, ["security_id", "cik"], "left_anti").select(
        "security_id", "override_cik"
    )
    first = chosen.groupBy("cik").agg(F.min(F.struct("position", "security_id")).alias("_first")).select(
        "cik", F.col("_first.security_id").alias("primary_id")
    )
    named = chosen.join(first, "cik").select(
        "security_id", "cik", F.col("_r.registrant_name").alias("registrant_name"), F.col("_r.sic").alias("sic"),
        F.when(F.col("collision"), F.lit("REVIEWED_EFFECTIVE_DATED_OVERRIDE"))
        .when(F.col("security_id") == F.col("primary_id"), F.lit("EXACT_SEC_PRIMARY_TICKER"))
        .otherwise(F.lit("EXACT_SEC_ADDITIONAL_CLASS")).alias("_status"),
        (F.col("security_id") == F.col("primary_id")).alias("is_primary"),
    )
    unresolved = choice.filter("cik is null").select("security_id", F.lit(True).alias("_conflict"))
    master = (
        universe.select("security_id", "ticker", "exchange_mic")
        .join(named, "security_id", "left").join(unresolved, "security_id", "left")
        .select(
            "security_id", "ticker", "exchange_mic", "cik", "registrant_name", "sic",
            F.coalesce(
                "_status",
                F.when(F.col("_conflict"), F.lit("UNRESOLVED_CIK_IDENTITY_CONFLICT")), F.lit("UNMAPPED_SEC_CIK"),
            ).alias("mapping_status"),
            F.when(F.col("cik").isNotNull(), F.concat(F.lit("https://data.sec.gov/submissions/CIK"), "cik", F.lit(".json"))).alias("source_url"),
            F.lit(revision).alias("source_revision"), *pit_columns(retrieved_at=retrieved_at),
            F.coalesce("is_primary", F.lit(False)).alias("is_primary"),
        )
    )
    return master, bad_overrides


def primary_securities(master: DataFrame) -> DataFrame:
    """(cik, security_id) of the class that carries a registrant's filings."""
    return master.filter("is_primary").select("cik", "security_id")


def build_filings(rows: DataFrame, primary: DataFrame, *, cutoff: Column, retrieved_at: Column) -> tuple[DataFrame, DataFrame]:
    """PIP-04. (all attributed filings, rejected rows with reasons).

    ``rows`` comes from :func:`tidemark.sources.explode_filings`. The emitted table is
    ``filings.filter(form_emitted("form"))``; facts and insiders join the full one.
    """
    from tidemark.operators.quality import quarantine

    known = rows.filter(F.col("filing_date") <= cutoff)
    base_form = F.regexp_replace("form", r"/A\z", "")
    good, bad = quarantine(known, {
        "BAD_ACCESSION": ~accession_ok("accession_number"),
        "FILED_BEFORE_PERIOD": base_form.isin("10-K", "10-Q", "20-F", "40-F") & (F.col("filing_date") < F.col("report_date")),
    })
    joined = good.filter(filing_attribution("form", "cik", "accession_number")).join(primary, "cik")
    event = F.coalesce("report_date", "filing_date")
    filings = joined.select(
        "security_id", "cik", "accession_number", "form", "filing_date", "acceptance_datetime_utc", "report_date",
        "primary_document", filing_url("cik", "accession_number", "primary_document").alias("primary_document_url"),
        F.col("form").endswith("/A").alias("is_amendment"), "items", "file_number", "film_number",
        *pit_columns(event, F.col("filing_date"), F.col("acceptance_datetime_utc"),
                     available_date("filing_date", "acceptance_datetime_utc"), retrieved_at),
    ).distinct()
    filings = stage(filings, "filings")
    conflicts = conflicting_filings(filings)
    rejected = bad.unionByName(
        filings.join(conflicts, ["cik", "accession_number"], "left_semi").withColumn(
            "reject_reasons", F.array(F.lit("CONFLICTING_METADATA"))
        ).select(*bad.columns)
    )
    return filings.join(conflicts, ["cik", "accession_number"], "left_anti").select(*filings.columns), rejected


def conflicting_filings(filings: DataFrame) -> DataFrame:
    """Keys whose distinct rows differ in any column."""
    return filings.groupBy("cik", "accession_number").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")


# Form, event type, subtype, confidence, materiality.
FORM_EVENTS = (
    ("SC 13D", "ACTIVIST_13D", "INITIAL", "HIGH", 0.9),
    ("SC 13D/A", "ACTIVIST_13D", "AMENDMENT", "HIGH", 0.8),
    ("SC 13G", "PASSIVE_13G", "INITIAL", "HIGH", 0.7),
    ("SC 13G/A", "PASSIVE_13G", "AMENDMENT", "HIGH", 0.6),
    ("SCHEDULE 13D", "ACTIVIST_13D", "INITIAL", "HIGH", 0.9),
    ("SCHEDULE 13D/A", "ACTIVIST_13D", "AMENDMENT", "HIGH", 0.8),
    ("SCHEDULE 13G", "PASSIVE_13G", "INITIAL", "HIGH", 0.7),
    ("SCHEDULE 13G/A", "PASSIVE_13G", "AMENDMENT", "HIGH", 0.6),
    ("SC TO", "TENDER_OFFER", "SCHEDULE_TO", "HIGH", 0.9),
    ("SC TO-I", "TENDER_OFFER", "ISSUER_TENDER", "HIGH", 0.9),
    ("SC TO-T", "TENDER_OFFER", "THIRD_PARTY_TENDER", "HIGH", 0.9),
    ("S-1", "EQUITY_ISSUANCE", "REGISTRATION", "MEDIUM", 0.5),
    ("S-3", "EQUITY_ISSUANCE", "SHELF_REGISTRATION", "MEDIUM", 0.4),
)
# Item of a current report, event type, subtype, materiality.
ITEM_EVENTS = (
    ("2.01", "ASSET_SALE", "ACQUISITION_OR_DISPOSITION_COMPLETED", 0.7),
    ("2.02", "EARNINGS_RELEASE", "RESULTS_OF_OPERATIONS", 0.8),
    ("2.05", "STRATEGIC_REVIEW", "EXIT_OR_DISPOSAL_ACTIVITY", 0.6),
    ("3.02", "EQUITY_ISSUANCE", "UNREGISTERED_EQUITY_SALE", 0.7),
    ("5.02", "MANAGEMENT_CHANGE", "DIRECTOR_OR_OFFICER_CHANGE", 0.7),
    ("1.05", "CYBERSECURITY_INCIDENT", "MATERIAL_CYBERSECURITY_INCIDENT", 0.9),
)
PROSPECTUS_EVENT = ("EQUITY_ISSUANCE", "PROSPECTUS", "MEDIUM", 0.5)
CURRENT_REPORTS = ("8-K", "8-K/A")
_SPEC = "struct<event_type:string,event_subtype:string,event_confidence:string,materiality_score:double>"


def report_items(items: str) -> Column:
    """Trimmed, non-blank items of a comma-separated list."""
    parts = F.transform(F.split(F.coalesce(F.col(items), F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def filing_event_specs(form: str, items: str, form_events=FORM_EVENTS, item_events=ITEM_EVENTS) -> Column:
    """PIP-08. Array of event specs a filing gives rise to, by form, prefix and item.

    The spec tables are small fixed lists, so they are literals in the expression and
    need no join.
    """
    def spec(kind: str, subtype: str, confidence: str, score: float) -> Column:
        return F.struct(F.lit(kind).alias("event_type"), F.lit(subtype).alias("event_subtype"),
                        F.lit(confidence).alias("event_confidence"), F.lit(score).alias("materiality_score"))

    f = F.col(form)
    forms = {name: (kind, subtype, conf, score) for name, kind, subtype, conf, score in form_events}
    by_form = F.element_at(
        F.create_map(*[x for name, s in forms.items() for x in (F.lit(name), spec(*s))]), f
    )
    by_prefix = F.when(f.startswith("424B"), spec(*PROSPECTUS_EVENT))
    item_map = F.create_map(*[
        x for item, kind, subtype, score in item_events
        for x in (F.lit(item), spec(kind, f"8-K_ITEM_{item}:{subtype}", "HIGH", score))
    ])
    by_item = F.when(
        f.isin(*CURRENT_REPORTS), F.transform(report_items(items), lambda i: F.element_at(item_map, i))
    ).otherwise(F.array().cast(f"array<{_SPEC}>"))
    return F.array_compact(F.concat(F.array(by_form, by_prefix), by_item))


def build_corporate_events(filings: DataFrame, *, retrieved_at: Column) -> DataFrame:
    """PIP-08."""
    rows = filings.withColumn("_s", F.explode(filing_event_specs("form", "items"))).select("*", "_s.*")
    effective = F.coalesce("report_date", "filing_date")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return rows.select(
        hash_id("security_id", "accession_number", "event_type", "event_subtype").alias("event_id"), "security_id", "cik",
        "event_type", "event_subtype", F.col("acceptance_datetime_utc").alias("announcement_datetime_utc"),
        effective.alias("effective_date"), none("date", "expiration_date"), F.col("form").alias("filing_form"),
        "accession_number", F.col("primary_document_url").alias("source_document_url"),
        F.concat(F.lit("SEC "), "form", F.lit(" filing: "), "event_subtype").alias("headline"),
        F.lit("Deterministic event classification from SEC form and item metadata.").alias("summary"),
        none("string", "counterparty"), none("double", "cash_value"), none("double", "share_value"),
        none("double", "exchange_ratio"), none("double", "ownership_percentage"), none("bigint", "board_seats_requested"),
        F.lit("FILED").alias("event_status"), "event_confidence", "materiality_score",
        F.lit(PARSER_VERSION).alias("parser_version"),
        *pit_columns(effective, F.col("filing_date"), F.col("acceptance_datetime_utc"), F.col("source_publication_date"), retrieved_at),
    )


def build_earnings_events(filings: DataFrame, *, retrieved_at: Column) -> DataFrame:
    """PIP-09. The event date is the UTC date of acceptance."""
    rows = filings.filter(F.col("form").isin(*CURRENT_REPORTS) & F.array_contains(report_items("items"), "2.02"))
    day = F.coalesce(F.to_date("acceptance_datetime_utc"), "filing_date")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return rows.select(
        hash_id("accession_number", F.lit("EARNINGS")).alias("event_id"), "security_id",
        F.col("acceptance_datetime_utc").alias("event_datetime_utc"), day.alias("event_date"),
        market_time_class("acceptance_datetime_utc").alias("event_time_classification"),
        F.lit("EARNINGS_RELEASE").alias("event_type"), none("string", "fiscal_period"),
        *[none("double", c) for c in ("revenue_reported", "eps_reported", "revenue_guidance_low",
                                      "revenue_guidance_high", "eps_guidance_low", "eps_guidance_high")],
        none("string", "guidance_direction"), F.lit("SEC_8_K_ITEM_2_02").alias("source_type"),
        F.col("accession_number").alias("filing_accession_number"),
        F.col("primary_document_url").alias("source_document_url"),
        *pit_columns(day, F.col("filing_date"), F.col("acceptance_datetime_utc"), F.col("source_publication_date"), retrieved_at),
    )
