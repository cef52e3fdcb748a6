"""Company facts, discrete quarterly fundamentals and factors (PIP-05 .. PIP-07)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import COMPANY_FACTS, FACTORS, FUNDAMENTALS
from tidemark.functions import (
    accession_ok, available_date, fact_is_knowable, growth, pit_columns, safe_divide, unit_status,
)
from tidemark.operators.keys import recent_n
from tidemark.operators.quality import quarantine
from tidemark.plans.concepts import (
    CONCEPT_MAP_VERSION, CORE_FIELDS, DERIVABLE_FIELDS, DURATION_DAYS, FLOW_FIELDS, SHARE_FIELDS, YTD_DAYS,
)

FACTOR_MODEL_VERSION = "fundamental-factors-1.0.0"


def build_company_facts(
    rows: DataFrame, primary: DataFrame, filings: DataFrame, *, cutoff: Column, revision: str, retrieved_at: Column,
) -> tuple[DataFrame, DataFrame]:
    """PIP-05. (facts, rejected). ``rows`` are exploded facts, ``primary`` maps CIKs.

    The acceptance time comes from the filing with the same (cik, accession).
    """
    known = rows.filter((F.col("accession_number") != "") & (F.col("filed_date") <= cutoff))
    good, bad = quarantine(known, {"BAD_ACCESSION": ~accession_ok("accession_number")})
    times = filings.select("cik", "accession_number", F.col("acceptance_datetime_utc").alias("_acceptance"))
    facts = (
        good.filter(fact_is_knowable("filed_date", "period_end")).join(primary, "cik")
        .join(times, ["cik", "accession_number"], "left")
        .withColumn("unit_status", unit_status("unit"))
        .withColumn("source_url", F.concat(F.lit("https://data.sec.gov/api/xbrl/companyfacts/CIK"), "cik", F.lit(".json")))
        .withColumn("source_revision", F.lit(revision))
    )
    names = [c for c in COMPANY_FACTS.columns if not c.startswith("source_") or c in ("source_url", "source_revision")]
    return facts.select(
        *names,
        *pit_columns(F.col("period_end"), F.col("filed_date"), F.col("_acceptance"),
                     available_date("filed_date", "_acceptance"), retrieved_at),
    ), bad


def normalization_facts(facts: DataFrame, concepts: DataFrame, cutoff: Column, years: int = 5) -> DataFrame:
    """Facts of mapped concepts from recent fiscal years, the input of normalization."""
    return facts.filter(F.col("fiscal_year") >= F.year(cutoff) - years).join(
        F.broadcast(concepts.select("concept").distinct()), "concept", "left_semi"  # the reviewed map, about fifty rows
    )


def choose_facts(
    facts: DataFrame, concepts: DataFrame, taxonomies: DataFrame, group: Sequence[str], targets: Sequence[str],
) -> DataFrame:
    """SRT-04 / SRT-05. One row per ``group`` with the chosen value and duration per target.

    Nested aggregations narrow (target, concept, taxonomy) step by step, each combining
    before its shuffle, so neither a hot issuer nor a hot filing is ever gathered. Within
    a concept the first taxonomy that has a row with the right unit decides, and only
    then usable rows are told apart: the least (taxonomy, unusable, closeness, ...) tuple
    is exactly that rule. The first concept with a usable row wins, and last the newest
    filing of the group.
    """
    days = F.datediff("period_end", "period_start")
    is_flow = F.col("target").isin(*FLOW_FIELDS)
    unit_ok = (F.col("unit") == F.when(F.col("target").isin(*SHARE_FIELDS), F.lit("shares")).otherwise(F.lit("USD"))) & (
        F.col("unit_status") == "SUPPORTED"
    ) & F.col("taxonomy_rank").isNotNull()
    in_range, closeness = F.lit(False), F.lit(None).cast("int")
    for period, (low, high, ideal) in DURATION_DAYS.items():
        here = F.col("fiscal_period") == period
        in_range = F.when(here, days.between(low, high)).otherwise(in_range)
        closeness = F.when(here, F.abs(days - ideal)).otherwise(closeness)
    newest = -F.unix_date("filed_date")
    unusable = F.when(~is_flow | F.coalesce(in_range, F.lit(False)), 0).otherwise(1)
    # flows: closest duration, newest filing; stocks: NULL end first, newest end, newest filing
    first = F.when(is_flow, closeness).when(F.col("period_end").isNull(), 0).otherwise(1)
    second = F.when(is_flow, newest).otherwise(F.coalesce(-F.unix_date("period_end"), F.lit(0)))
    third = F.when(is_flow, 0).otherwise(newest)
    candidate = F.when(unit_ok, F.struct(
        "taxonomy_rank", unusable.alias("unusable"), first.alias("a"), second.alias("b"), third.alias("c"), "value", days.alias("days")
    ))

    filing = [*group, "accession_number"]
    carried = {
        "filed_date": "max", "period_start": "min", "period_end": "max", "source_acceptance_datetime_utc": "max",
        "source_retrieved_at_utc": "max", "cik": "min",
    }
    keep = [F.expr(f"{fn}({c}) AS {c}") for c, fn in carried.items()]

    # both are the reviewed map, a few dozen rows
    mapped = facts.join(F.broadcast(concepts), "concept").join(F.broadcast(taxonomies), "taxonomy", "left")
    dated = mapped.groupBy(*filing).agg(F.max("filed_date").alias("_filed"))
    newest_filing = dated.groupBy(*group).agg(F.max(F.struct("_filed", "accession_number")).alias("_f")).select(
        *group, F.col("_f.accession_number").alias("accession_number"))
    mapped = mapped.join(newest_filing, filing, "left_semi")
    per_concept = mapped.groupBy(*filing, "target", "concept_rank").agg(F.min(candidate).alias("_c"), *keep)
    usable = F.when(F.col("_c.unusable") == 0, F.struct("concept_rank", F.col("_c.value").alias("value"), F.col("_c.days").alias("days")))
    per_target = per_concept.groupBy(*filing, "target").agg(F.min(usable).alias("_best"), *keep)
    of = lambda t, f, name: F.expr(f"max(CASE WHEN target = '{t}' THEN _best.{f} END) AS {name}")
    return per_target.groupBy(*filing).agg(
        *[of(t, "value", t) for t in targets], *[of(t, "days", f"_days_{t}") for t in targets if t in DERIVABLE_FIELDS], *keep,
    )


def _missing(source: str) -> Column:
    """Sorted names of the core fields that are NULL."""
    return F.array_compact(F.array(*[F.when(F.col(f"{source}{c}").isNull(), F.lit(c)) for c in CORE_FIELDS]))


def derive_report_fields(chosen: DataFrame) -> DataFrame:
    """Signed, summed and status fields of one report, before quarters are made discrete."""
    c = F.col
    return chosen.withColumns({
        "capital_expenditure": F.abs("capital_expenditure"),
        "total_debt": F.coalesce("total_debt", c("short_term_debt") + c("long_term_debt")),
        "tangible_book_value": c("stockholders_equity") - c("goodwill") - c("intangible_assets"),
        "ebit": c("operating_income"),
        "filing_available_date": available_date("filed_date", "source_acceptance_datetime_utc"),
    })


def ytd_to_discrete(
    reports: DataFrame, keys: Sequence[str], period: str, fields: Sequence[str], *,
    days: dict[str, str] | None = None, threshold: int = YTD_DAYS, end: str | None = None, start: str | None = None,
) -> DataFrame:
    """WIN-10. Cumulative Q2/Q3 reports and the annual one turned into discrete quarters.

    One row per (keys, period in Q1, Q2, Q3, FY). A quarter longer than ``threshold`` days
    (``days`` maps field to its duration column; every later quarter is cumulative when it
    is not given) has the discrete earlier quarters present subtracted, NULL if one of
    them is NULL. Q4 needs all three. The four reports of a year are put side by side.
    """
    columns = [c for c in reports.columns if c not in {*keys, period}]
    fields = list(fields)
    listed = ", ".join(columns)
    wide = reports.groupBy(*keys).agg(*[
        F.expr(f"max(CASE WHEN {period} = '{p}' THEN struct({listed}) END) AS {p}") for p in ("Q1", "Q2", "Q3", "FY")
    ])

    def earlier(f: str, done: Sequence[str]) -> tuple[str, str]:
        """SQL of the sum of the discrete quarters so far and of "none present is NULL"."""
        total = " + ".join(f"coalesce({p}_{f}, 0D)" for p in done)
        known = " AND ".join(f"({p} IS NULL OR {p}_{f} IS NOT NULL)" for p in done)
        return total, known

    # Q3 and Q4 refer to the discrete values of earlier quarters, hence one step each.
    wide = wide.select("*", *[F.expr(f"Q1.{f} AS Q1_{f}") for f in fields])
    for p, done in (("Q2", ["Q1"]), ("Q3", ["Q1", "Q2"])):
        steps = []
        for f in fields:
            total, known = earlier(f, done)
            discrete = f"CASE WHEN {known} THEN {p}.{f} - ({total}) END"
            steps.append(F.expr(f"CASE WHEN {p}.{days[f]} > {threshold} THEN {discrete} ELSE {p}.{f} END AS {p}_{f}" if days else f"{discrete} AS {p}_{f}"))
        wide = wide.select("*", *steps)
    last = []
    for f in fields:
        total, known = earlier(f, ["Q1", "Q2", "Q3"])
        last.append(F.expr(
            f"CASE WHEN Q1 IS NOT NULL AND Q2 IS NOT NULL AND Q3 IS NOT NULL AND {known} THEN FY.{f} - ({total}) END AS Q4_{f}"
        ))
    wide = wide.select("*", *last)

    def quarter(p: str) -> str:
        source = "FY" if p == "Q4" else p
        parts = []
        for c in columns:
            value = f"{p}_{c}" if c in fields else f"{source}.{c}"
            if p == "Q4" and c == start and end:
                # the end of the last quarter present, even when that end is NULL
                before = f"CASE WHEN Q3 IS NOT NULL THEN Q3.{end} WHEN Q2 IS NOT NULL THEN Q2.{end} ELSE Q1.{end} END"
                value = f"coalesce(date_add({before}, 1), FY.{c})"
            parts.append(f"'{c}', {value}")
        return f"CASE WHEN {source} IS NOT NULL THEN named_struct('{period}', '{p}', {', '.join(parts)}) END"

    quarters = ", ".join(quarter(p) for p in ("Q1", "Q2", "Q3", "Q4"))
    return wide.select(*keys, F.expr(f"inline(array_compact(array({quarters})))"))


def normalize_fundamentals(
    facts: DataFrame, concepts: DataFrame, taxonomies: DataFrame, targets: Sequence[str], *,
    version: str = CONCEPT_MAP_VERSION,
) -> DataFrame:
    """PIP-06. Discrete quarters per (security, fiscal year)."""
    group = ["security_id", "fiscal_year", "fiscal_period"]
    usable = facts.filter(F.col("fiscal_year").isNotNull() & F.col("fiscal_period").isin("Q1", "Q2", "Q3", "FY"))
    chosen = choose_facts(usable, concepts, taxonomies, group, targets)
    absent = [c for c in (*FLOW_FIELDS, *FUNDAMENTALS.double_columns, "goodwill", "intangible_assets") if c not in chosen.columns]
    chosen = chosen.withColumns({c: F.lit(None).cast("double") for c in absent if c not in ("ebit", "free_cash_flow", "tangible_book_value")})
    chosen = chosen.withColumns({f"_days_{c}": F.lit(None).cast("int") for c in DERIVABLE_FIELDS if f"_days_{c}" not in chosen.columns})
    discrete = ytd_to_discrete(
        derive_report_fields(chosen), ["security_id", "fiscal_year"], "fiscal_period", DERIVABLE_FIELDS,
        days={f: f"_days_{f}" for f in DERIVABLE_FIELDS}, end="period_end", start="period_start",
    )
    missing = _missing("")
    final = discrete.withColumns({
        "free_cash_flow": F.col("operating_cash_flow") - F.col("capital_expenditure"),
        "filing_date": F.col("filed_date"), "currency": F.lit("USD"), "source_concept_map_version": F.lit(version),
        "normalization_status": F.when(F.size(missing) == 0, F.lit("COMPLETE")).otherwise(F.lit("PARTIAL")),
        "missing_required_fields": F.to_json(missing),
    })
    names = [c for c in FUNDAMENTALS.columns if not c.startswith("source_") or c == "source_concept_map_version"]
    return final.select(
        *names,
        *pit_columns(F.col("period_end"), F.col("filing_date"), F.col("source_acceptance_datetime_utc"),
                     F.col("filing_available_date"), F.col("source_retrieved_at_utc")),
    )


def latest_prices(prices: DataFrame, cutoff: Column, key: str = "security_id", date: str = "session_date") -> DataFrame:
    """JOI-21. Last close on or before the cutoff."""
    return prices.filter(F.col(date) <= cutoff).groupBy(key).agg(F.max_by("close", date).alias("last_close"))


# Input flow and its trailing-sum column.
TRAILING = {
    "revenue": "trailing_revenue", "operating_income": "trailing_operating_income", "net_income": "trailing_net_income",
    "operating_cash_flow": "trailing_operating_cash_flow", "capital_expenditure": "trailing_capex",
    "free_cash_flow": "trailing_free_cash_flow",
}
FACTOR_VALUES = tuple(FACTORS.columns[4:34])


def quarter_window(quarters: DataFrame, key: str, order: Sequence[Column], n: int = 13) -> DataFrame:
    """The newest ``n`` quarters per key with their rank ``_rn`` (1 = latest)."""
    return recent_n(quarters, [key], order, n, rank="_rn")


def trailing(value: str, first: int = 1, last: int = 4) -> Column:
    """WIN-11 as an aggregate over ranks: NULL unless all rows exist and none is NULL."""
    here = f"_rn BETWEEN {first} AND {last}"
    n = last - first + 1
    return F.expr(
        f"CASE WHEN count_if({here}) = {n} AND count(CASE WHEN {here} THEN {value} END) = {n} THEN sum(CASE WHEN {here} THEN {value} END) END"
    )


def at_rank(value: Column | str, rank: int) -> Column:
    """WIN-12 as an aggregate: the value ``rank - 1`` rows back."""
    if isinstance(value, str):
        return F.expr(f"max(CASE WHEN _rn = {rank} THEN {value} END)")
    return F.max(F.when(F.col("_rn") == rank, value))


def factor_inputs(quarters: DataFrame, key: str = "security_id") -> DataFrame:
    """Ranked quarters reduced to one row per key.

    The rank limit runs before the shuffle and the aggregation after it reuses the
    partitioning, so there is a single exchange.
    """
    order = [F.col(c).desc_nulls_last() for c in ("period_end", "filing_date", "fiscal_year", "fiscal_period")]
    ranked = quarter_window(quarters, key, order)
    margin = safe_divide("gross_profit", "revenue")
    recent = F.col("_rn") <= 12
    latest = (
        "filing_date", "filing_available_date", "period_end", "source_acceptance_datetime_utc", "revenue", "net_income",
        "free_cash_flow", "total_debt", "cash_and_equivalents", "current_assets", "current_liabilities",
        "stockholders_equity", "tangible_book_value",
    )
    shares = "coalesce(shares_diluted, shares_basic)"
    return ranked.groupBy(key).agg(
        F.max("_rn").alias("n"),
        *[trailing(c).alias(name) for c, name in TRAILING.items()],
        trailing("interest_expense").alias("t_interest"), trailing("gross_profit").alias("t_gross"), trailing("pretax_income").alias("t_pretax"),
        *[trailing(c, 5, 8).alias(f"p_{c}") for c in ("operating_income", "pretax_income", "net_income")],
        *[at_rank(c, 1).alias(f"l_{c}") for c in latest], at_rank(shares, 1).alias("l_shares"),
        *[at_rank(c, 5).alias(f"y_{c}") for c in ("revenue", "net_income", "free_cash_flow", "total_debt", "cash_and_equivalents", "stockholders_equity")],
        at_rank(shares, 5).alias("y_shares"), at_rank("revenue", 13).alias("y3_revenue"),
        F.when(F.count(F.when(recent, margin)) >= 8, F.stddev_pop(F.when(recent, margin))).alias("gross_margin_stability_3y"),
        F.when(
            F.count_if(recent) >= 8,
            F.count_if(recent & (F.col("free_cash_flow") > 0)) / F.count_if(recent),
        ).alias("free_cash_flow_consistency_3y"),
    )


def _tax_rate(net_income: Column, pretax: Column) -> Column:
    rate = F.lit(1.0) - F.try_divide(net_income, pretax)
    return F.when(rate.isNotNull(), F.least(F.lit(0.40), F.greatest(F.lit(0.0), rate)))


def factor_columns(cutoff: Column) -> dict[str, Column]:
    """The factor values over :func:`factor_inputs` joined with ``last_close``."""
    c = F.col
    net_debt = c("l_total_debt") - c("l_cash_and_equivalents")
    cap = c("last_close") * c("l_shares")
    ev = cap + net_debt
    nopat = c("trailing_operating_income") * (1 - _tax_rate(c("trailing_net_income"), c("t_pretax")))
    capital = c("l_stockholders_equity") + net_debt
    p_nopat = c("p_operating_income") * (1 - _tax_rate(c("p_net_income"), c("p_pretax_income")))
    p_capital = F.when(c("n") >= 8, c("y_stockholders_equity") + (c("y_total_debt") - c("y_cash_and_equivalents")))
    fcf = c("trailing_free_cash_flow")
    both = (c("l_revenue") > 0) & (c("y3_revenue") > 0)
    return {
        **{name: c(name) for name in TRAILING.values()},
        "net_debt": net_debt, "market_cap": cap, "enterprise_value": ev,
        "earnings_yield": safe_divide(c("trailing_net_income"), cap), "free_cash_flow_yield": safe_divide(fcf, cap),
        "ev_to_ebit": safe_divide(ev, c("trailing_operating_income")),
        "price_to_tangible_book": safe_divide(cap, c("l_tangible_book_value")),
        "current_ratio": safe_divide(c("l_current_assets"), c("l_current_liabilities")),
        "interest_coverage": safe_divide(c("trailing_operating_income"), c("t_interest")),
        "debt_to_ebitda": F.lit(None).cast("double"),
        "gross_margin": safe_divide(c("t_gross"), c("trailing_revenue")),
        "operating_margin": safe_divide(c("trailing_operating_income"), c("trailing_revenue")),
        "free_cash_flow_margin": safe_divide(fcf, c("trailing_revenue")),
        "cash_conversion": safe_divide(fcf, c("trailing_net_income")),
        "roic": safe_divide(nopat, capital), "incremental_roic": safe_divide(nopat - p_nopat, capital - p_capital),
        "reinvestment_rate": safe_divide(nopat - fcf, nopat),
        "revenue_growth_yoy": growth(c("l_revenue"), c("y_revenue")),
        "revenue_growth_cagr_3y": F.when(both, F.pow(F.try_divide(c("l_revenue"), c("y3_revenue")), F.lit(1 / 3)) - 1),
        "earnings_growth_yoy": growth(c("l_net_income"), c("y_net_income")),
        "free_cash_flow_growth_yoy": growth(c("l_free_cash_flow"), c("y_free_cash_flow")),
        "share_count_change_yoy": growth(c("l_shares"), c("y_shares")),
        "gross_margin_stability_3y": c("gross_margin_stability_3y"),
        "free_cash_flow_consistency_3y": c("free_cash_flow_consistency_3y"),
    }


def build_factors(quarters: DataFrame, prices: DataFrame, *, cutoff: Column, retrieved_at: Column) -> DataFrame:
    """PIP-07. Factors per security as of the cutoff, from filings available by then."""
    known = quarters.filter(F.col("filing_available_date") <= cutoff)
    joined = factor_inputs(known).join(latest_prices(prices, cutoff), "security_id", "left")
    values = joined.select(
        "security_id", cutoff.cast("date").alias("factor_as_of_date"), F.col("l_filing_date").alias("latest_filing_date"),
        F.col("l_filing_available_date").alias("filing_available_date"), "l_period_end", "l_source_acceptance_datetime_utc",
        *[e.cast("double").alias(name) for name, e in factor_columns(cutoff).items()],
    )
    missing = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in sorted(FACTOR_VALUES)]))
    return values.select(
        "security_id", "factor_as_of_date", "latest_filing_date", "filing_available_date", *FACTOR_VALUES,
        F.when(F.size(missing) <= 6, F.lit("READY")).otherwise(F.lit("PARTIAL")).alias("factor_quality_status"),
        F.to_json(missing).alias("factor_missing_fields"), F.lit(FACTOR_MODEL_VERSION).alias("model_version"),
        *pit_columns(F.col("l_period_end"), F.col("latest_filing_date"), F.col("l_source_acceptance_datetime_utc"),
                     F.col("filing_available_date"), retrieved_at),
    )
