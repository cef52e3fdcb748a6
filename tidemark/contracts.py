"""Versioned table contracts: ordered columns, key, and point-in-time columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableContract:
    """Name, ordered schema and key of one stored table."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    null_key_allowed: bool = False
    point_in_time: bool = True

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def double_columns(self) -> list[str]:
        return [f.name for f in self.schema.fields if isinstance(f.dataType, T.DoubleType)]


# The five provenance columns closing every enrichment row.
POINT_IN_TIME_DDL = (
    "source_event_date date, source_filing_date date, "
    "source_acceptance_datetime_utc timestamp, source_publication_date date, "
    "source_retrieved_at_utc timestamp"
)
POINT_IN_TIME_COLUMNS = tuple(
    part.strip().split(" ")[0] for part in POINT_IN_TIME_DDL.split(",")
)


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
}


def _schema(ddl: str, point_in_time: bool) -> T.StructType:
    text = f"{ddl}, {POINT_IN_TIME_DDL}" if point_in_time else ddl
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _contract(
    name: str,
    ddl: str,
    key: str,
    *,
    null_key_allowed: bool = False,
    point_in_time: bool = True,
) -> TableContract:
    return TableContract(
        name, _schema(ddl, point_in_time), tuple(key.split()), null_key_allowed, point_in_time
    )


# Table schemas and keys.
SECURITY_MASTER = _contract(
    "security_master",
    """security_id string, ticker string, exchange_mic string, cik string,
    registrant_name string, sic string, mapping_status string, source_url string,
    source_revision string""",
    "security_id",
)
COMPANY_FACTS = _contract(
    "company_facts",
    """security_id string, cik string, taxonomy string, concept string, label string,
    description string, unit string, unit_status string, value double,
    fiscal_year bigint, fiscal_period string, form string, filed_date date,
    period_start date, period_end date, frame string, accession_number string,
    source_url string, source_revision string""",
    "cik taxonomy concept unit accession_number period_start period_end fiscal_year fiscal_period",
    null_key_allowed=True,
)
FUNDAMENTALS = _contract(
    "fundamentals_quarterly",
    """security_id string, cik string, fiscal_year bigint, fiscal_period string,
    period_start date, period_end date, filing_date date, filing_available_date date,
    accession_number string, currency string, revenue double, gross_profit double,
    operating_income double, ebit double, pretax_income double, net_income double,
    operating_cash_flow double, capital_expenditure double, free_cash_flow double,
    cash_and_equivalents double, current_assets double, current_liabilities double,
    total_assets double, total_liabilities double, total_debt double,
    short_term_debt double, long_term_debt double, stockholders_equity double,
    tangible_book_value double, shares_basic double, shares_diluted double,
    stock_based_compensation double, interest_expense double,
    accounts_receivable double, inventory double, source_concept_map_version string,
    normalization_status string, missing_required_fields string""",
    "security_id fiscal_year fiscal_period",
)
FACTORS = _contract(
    "fundamental_factors",
    """security_id string, factor_as_of_date date, latest_filing_date date,
    filing_available_date date, trailing_revenue double,
    trailing_operating_income double, trailing_net_income double,
    trailing_operating_cash_flow double, trailing_capex double,
    trailing_free_cash_flow double, net_debt double, market_cap double,
    enterprise_value double, earnings_yield double, free_cash_flow_yield double,
    ev_to_ebit double, price_to_tangible_book double, current_ratio double,
    interest_coverage double, debt_to_ebitda double, gross_margin double,
    operating_margin double, free_cash_flow_margin double, cash_conversion double,
    roic double, incremental_roic double, reinvestment_rate double,
    revenue_growth_yoy double, revenue_growth_cagr_3y double,
    earnings_growth_yoy double, free_cash_flow_growth_yoy double,
    share_count_change_yoy double, gross_margin_stability_3y double,
    free_cash_flow_consistency_3y double, factor_quality_status string,
    factor_missing_fields string, model_version string""",
    "security_id factor_as_of_date",
)
FILINGS = _contract(
    "filings",
    """security_id string, cik string, accession_number string, form string,
    filing_date date, acceptance_datetime_utc timestamp, report_date date,
    primary_document string, primary_document_url string, is_amendment boolean,
    items string, file_number string, film_number string""",
    "cik accession_number",
)
CORPORATE_EVENTS = _contract(
    "corporate_events",
    """event_id string, security_id string, cik string, event_type string,
    event_subtype string, announcement_datetime_utc timestamp, effective_date date,
    expiration_date date, filing_form string, accession_number string,
    source_document_url string, headline string, summary string,
    counterparty string, cash_value double, share_value double,
    exchange_ratio double, ownership_percentage double,
    board_seats_requested bigint, event_status string, event_confidence string,
    materiality_score double, parser_version string""",
    "event_id",
)
EARNINGS_EVENTS = _contract(
    "earnings_events",
    """event_id string, security_id string, event_datetime_utc timestamp,
    event_date date, event_time_classification string, event_type string,
    fiscal_period string, revenue_reported double, eps_reported double,
    revenue_guidance_low double, revenue_guidance_high double,
    eps_guidance_low double, eps_guidance_high double, guidance_direction string,
    source_type string, filing_accession_number string, source_document_url string""",
    "event_id",
)
INSIDER_TRANSACTIONS = _contract(
    "insider_transactions",
    """security_id string, issuer_cik string, reporting_owner_cik string,
    reporting_owner_name string, is_director boolean, is_officer boolean,
    is_ten_percent_owner boolean, officer_title string, filing_date date,
    transaction_date date, form string, accession_number string,
    transaction_id string, security_title string, transaction_code string,
    acquired_disposed string, shares double, price_per_share double,
    ownership_nature string, shares_owned_after double, is_derivative boolean,
    exercise_price double, expiration_date date, is_10b5_1 boolean""",
    "accession_number reporting_owner_cik transaction_id",
)
INSIDER_SIGNALS = _contract(
    "insider_signals",
    """security_id string, signal_as_of_date date,
    open_market_purchase_value_30d double, open_market_purchase_value_90d double,
    open_market_sale_value_30d double, open_market_sale_value_90d double,
    unique_buyers_90d bigint, unique_sellers_90d bigint, cluster_buy_flag boolean,
    director_purchase_flag boolean, ceo_purchase_flag boolean,
    cfo_purchase_flag boolean, insider_signal_score double,
    signal_quality_status string""",
    "security_id signal_as_of_date",
)
HOLDINGS = _contract(
    "institutional_holdings",
    """manager_cik string, manager_name string, report_period date,
    filing_date date, accession_number string, cusip string, security_id string,
    security_mapping_method string, issuer_name string, class_title string,
    market_value_thousands double, shares_or_principal double, share_type string,
    put_call string, investment_discretion string, voting_authority_sole double,
    voting_authority_shared double, voting_authority_none double""",
    "manager_cik security_id report_period accession_number",
)
OWNERSHIP_SIGNALS = _contract(
    "ownership_signals",
    """security_id string, report_period date, known_13f_shares double,
    manager_count bigint, new_position_manager_count bigint,
    closed_position_manager_count bigint, increased_position_manager_count bigint,
    decreased_position_manager_count bigint, net_share_change double,
    net_manager_breadth bigint, top_10_manager_concentration double,
    ownership_signal_score double, publication_lag_days bigint,
    signal_quality_status string""",
    "security_id report_period",
)
SHORT_INTEREST = _contract(
    "short_interest",
    """security_id string, symbol string, issue_name string, market string,
    settlement_date date, publication_date date, current_short_shares double,
    previous_short_shares double, short_change double,
    short_change_percent double, average_daily_volume double,
    days_to_cover double, revision_flag string, short_interest_change_1m double,
    short_interest_change_3m double, days_to_cover_change double,
    short_interest_percent_float double,
    short_interest_percent_float_quality string""",
    "security_id settlement_date",
)
ANALYST_ESTIMATES = _contract(
    "analyst_estimates",
    """security_id string, estimate_as_of_utc timestamp, fiscal_period string,
    metric string, consensus_value double, estimate_count bigint,
    high_estimate double, low_estimate double, median_estimate double,
    revision_up_count_7d bigint, revision_down_count_7d bigint,
    revision_up_count_30d bigint, revision_down_count_30d bigint,
    prior_consensus_7d double, prior_consensus_30d double, provider string,
    provider_license string""",
    "security_id estimate_as_of_utc fiscal_period metric provider",
)
PRICES = _contract(
    "prices",
    """security_id string, ticker string, source_symbol string, session_date date,
    open double, high double, low double, close double, volume bigint,
    source_dataset string, source_revision string, observed_at_utc string""",
    "security_id session_date",
    point_in_time=False,
)
SPLITS = _contract(
    "splits",
    """security_id string, ticker string, source_symbol string, event_date date,
    split_factor string, source_dataset string, source_revision string,
    observed_at_utc string""",
    "security_id event_date split_factor",
    point_in_time=False,
)
BENCHMARK_RETURNS = _contract(
    "benchmark_returns",
    """security_id string, ticker string, benchmark_id string,
    benchmark_role string, session_date date, raw_close double,
    split_factor double, cash_distribution double, price_return double,
    distribution_return double, total_return double, total_return_index double,
    currency string, certification_status string,
    distribution_lineage_sha256 string, corporate_action_lineage_sha256 string,
    source_locator string, source_revision string,
    source_retrieved_at_utc timestamp, known_at_utc timestamp,
    certified_at_utc timestamp""",
    "security_id session_date",
    point_in_time=False,
)
DISTRIBUTIONS = _contract(
    "benchmark_distributions",
    """security_id string, ticker string, ex_date date, cash_amount double,
    currency string, distribution_type string, distribution_id string,
    source_locator string, source_revision string,
    source_retrieved_at_utc timestamp, known_at_utc timestamp,
    certified_at_utc timestamp""",
    "distribution_id",
    point_in_time=False,
)
# The text columns of the security universe, in order.
UNIVERSE_COLUMNS = (
    "security_id ticker source_symbol legal_name exchange_mic security_type "
    "exchange_country currency listing_status cik cusip isin adr_status adr_ratio "
    "home_exchange home_country fund_provider index_tracked expense_ratio asset_class "
    "leveraged inverse universe_admission_status admission_reason source_file "
    "source_file_created_at_utc source_file_sha256 generated_at_utc"
).split()
UNIVERSE = TableContract(
    "security_universe",
    T.StructType([T.StructField(name, T.StringType()) for name in UNIVERSE_COLUMNS]),
    ("security_id",),
    point_in_time=False,
)
EVIDENCE = _contract(
    "evidence",
    """evidence_id string, security_id string, evidence_kind string,
    known_at_utc timestamp, revision string, source_event_at timestamp,
    source_locator string, headline string, summary string""",
    "evidence_id",
    point_in_time=False,
)
CANDIDATE_FUNNEL = _contract(
    "candidate_funnel",
    """candidate_id string, security_id string, phase_id string,
    funnel_state string, candidate_rank bigint, rejection_codes_json string,
    evidence_ids_json string, known_at_utc timestamp, revision string,
    source_retrieved_at_utc timestamp""",
    "candidate_id",
    point_in_time=False,
)

CONTRACTS = {
    contract.name: contract
    for contract in (
        SECURITY_MASTER, COMPANY_FACTS, FUNDAMENTALS, FACTORS, FILINGS, CORPORATE_EVENTS,
        EARNINGS_EVENTS, INSIDER_TRANSACTIONS, INSIDER_SIGNALS, HOLDINGS,
        OWNERSHIP_SIGNALS, SHORT_INTEREST, ANALYST_ESTIMATES, PRICES, SPLITS,
        BENCHMARK_RETURNS, DISTRIBUTIONS, UNIVERSE, EVIDENCE, CANDIDATE_FUNNEL,
    )
}
