"""Line items as reported facts: choice of facts, discrete quarters, factors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import Tables, day, query, r6
from tidemark.functions import growth, safe_divide
from tidemark.plans import fundamentals as fu
from tidemark.plans.concepts import CONCEPTS, CORE_FIELDS, default_concept_map

# line number -> concept; two of them compete for revenue
_LINES = {
    1: "RevenueFromContractWithCustomerExcludingAssessedTax", 2: "Revenues", 3: "OperatingIncomeLoss", 4: "NetIncomeLoss",
    5: "NetCashProvidedByUsedInOperatingActivities", 6: "Assets", 7: "StockholdersEquity",
}
_TARGET = {1: ("revenue", 0), 2: ("revenue", 1), 3: ("operating_income", 0), 4: ("net_income", 0), 5: ("operating_cash_flow", 0), 6: ("total_assets", 0), 7: ("stockholders_equity", 0)}
_TARGET_SQL = ", ".join(f"({n}, '{t}', {r})" for n, (t, r) in _TARGET.items())

FACTS = f"""facts AS (
  SELECT 'S' || l_suppkey AS security_id, year(l_shipdate) AS fiscal_year, CASE quarter(l_shipdate) WHEN 1 THEN 'Q1' WHEN 2 THEN 'Q2' WHEN 3 THEN 'Q3' ELSE 'FY' END AS fiscal_period,
    lpad(CAST(l_suppkey AS VARCHAR), 10, '0') || '-' || strftime(l_shipdate, '%y') || '-' || lpad(CAST(month(l_shipdate) AS VARCHAR), 6, '0') AS accession,
    t.target, t.concept_rank, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS taxonomy_rank, l_discount <> 0.1 AS unit_ok, l_extendedprice AS value,
    CAST(l_shipdate AS DATE) AS pe, CASE WHEN l_tax = 0.08 THEN NULL ELSE CAST(l_shipdate AS DATE) - CAST(l_quantity * 7 + 30 AS INT) END AS ps, CAST(l_shipdate AS DATE) + CAST(round(l_tax * 1000) AS INT) AS filed
  FROM lineitem JOIN (VALUES {_TARGET_SQL}) t(line, target, concept_rank) ON t.line = l_linenumber),
dur AS (SELECT *, pe - ps AS days FROM facts),
cand AS (SELECT *, target IN ('total_assets', 'stockholders_equity') OR CASE fiscal_period WHEN 'FY' THEN days BETWEEN 250 AND 430 WHEN 'Q1' THEN days BETWEEN 45 AND 130 WHEN 'Q2' THEN days BETWEEN 45 AND 220 ELSE days BETWEEN 45 AND 310 END AS usable FROM dur),
tax AS (SELECT *, min(taxonomy_rank) OVER (PARTITION BY security_id, fiscal_year, fiscal_period, accession, target, concept_rank) AS first_tax FROM cand WHERE unit_ok),
pick AS (SELECT * FROM tax WHERE taxonomy_rank = first_tax AND coalesce(usable, false)
  QUALIFY row_number() OVER (PARTITION BY security_id, fiscal_year, fiscal_period, accession, target ORDER BY concept_rank,
    CASE WHEN target IN ('total_assets', 'stockholders_equity') THEN 0 ELSE abs(days - CASE fiscal_period WHEN 'FY' THEN 365 ELSE 91 END) END,
    CASE WHEN target IN ('total_assets', 'stockholders_equity') THEN pe END DESC, filed DESC, value, days NULLS FIRST) = 1),
newest AS (SELECT security_id, fiscal_year, fiscal_period, accession, max(filed) AS filed, min(ps) AS ps, max(pe) AS pe FROM facts GROUP BY security_id, fiscal_year, fiscal_period, accession
  QUALIFY row_number() OVER (PARTITION BY security_id, fiscal_year, fiscal_period ORDER BY max(filed) DESC, accession DESC) = 1),
chosen AS (SELECT n.*, {', '.join(f"max(CASE WHEN p.target = '{t}' THEN p.value END) AS {t}, max(CASE WHEN p.target = '{t}' THEN p.days END) AS days_{t}" for t in dict.fromkeys(t for t, _ in _TARGET.values()))}
  FROM newest n LEFT JOIN pick p USING (security_id, fiscal_year, fiscal_period, accession) GROUP BY ALL)"""

_FLOWS = ("revenue", "operating_income", "net_income", "operating_cash_flow")


def _discrete_sql() -> str:
    """Quarter expressions over the chosen reports of one year side by side."""
    cte = "wide AS (SELECT security_id, fiscal_year, " + ", ".join(
        f"max(CASE WHEN fiscal_period = '{p}' THEN {c} END) AS {p}_{c}"
        for p in ("Q1", "Q2", "Q3", "FY") for c in ("accession", "filed", "ps", "pe", *_FLOWS, *[f"days_{f}" for f in _FLOWS], "total_assets", "stockholders_equity")
    ) + " FROM chosen GROUP BY 1, 2)"
    q1 = ", ".join(f"Q1_{f} AS d1_{f}" for f in _FLOWS)
    one = "(Q1_accession IS NULL OR Q1_{f} IS NOT NULL)"
    q2 = ", ".join(
        f"CASE WHEN Q2_days_{f} > 130 THEN CASE WHEN {one.format(f=f)} THEN Q2_{f} - coalesce(Q1_{f}, 0) END ELSE Q2_{f} END AS d2_{f}" for f in _FLOWS
    )
    two = "(Q1_accession IS NULL OR d1_{f} IS NOT NULL) AND (Q2_accession IS NULL OR d2_{f} IS NOT NULL)"
    q3 = ", ".join(
        f"CASE WHEN Q3_days_{f} > 130 THEN CASE WHEN {two.format(f=f)} THEN Q3_{f} - (coalesce(d1_{f}, 0) + coalesce(d2_{f}, 0)) END ELSE Q3_{f} END AS d3_{f}" for f in _FLOWS
    )
    q4 = ", ".join(
        f"CASE WHEN Q1_accession IS NOT NULL AND Q2_accession IS NOT NULL AND Q3_accession IS NOT NULL THEN FY_{f} - (d1_{f} + d2_{f} + d3_{f}) END AS d4_{f}" for f in _FLOWS
    )

    def quarter(n: int) -> str:
        p = "FY" if n == 4 else f"Q{n}"
        start = "coalesce(coalesce(Q3_pe, Q2_pe, Q1_pe) + 1, FY_ps)" if n == 4 else f"{p}_ps"
        return (
            f"SELECT security_id, fiscal_year, 'Q{n}' AS fiscal_period, {p}_accession AS accession, {p}_filed AS filed, {start} AS ps, {p}_pe AS pe, "
            + ", ".join(f"d{n}_{f} AS {f}" for f in _FLOWS) + f", {p}_operating_income AS ebit, {p}_total_assets AS total_assets, {p}_stockholders_equity AS stockholders_equity FROM d4 WHERE {p}_accession IS NOT NULL"
        )

    return (
        f"{cte}, d1 AS (SELECT *, {q1} FROM wide), d2 AS (SELECT *, {q2} FROM d1), d3 AS (SELECT *, {q3} FROM d2), d4 AS (SELECT *, {q4} FROM d3), "
        f"quarters AS ({' UNION ALL '.join(quarter(n) for n in (1, 2, 3, 4))})"
    )


QUARTERS = f"{FACTS}, {_discrete_sql()}"


def facts(t: Tables) -> DataFrame:
    """Line items in the shape of reported facts."""
    ship, month = F.to_date("l_shipdate"), F.month("l_shipdate")
    line = F.element_at(F.create_map(*[F.lit(x) for kv in _LINES.items() for x in kv]), F.col("l_linenumber"))
    quarter = F.quarter("l_shipdate")
    key = F.lpad(F.col("l_suppkey").cast("string"), 10, "0")
    return t.lineitem.select(
        F.concat(F.lit("S"), "l_suppkey").alias("security_id"), key.alias("cik"), F.year("l_shipdate").cast("bigint").alias("fiscal_year"),
        F.when(quarter == 4, "FY").otherwise(F.concat(F.lit("Q"), quarter)).alias("fiscal_period"),
        F.concat_ws("-", key, F.date_format("l_shipdate", "yy"), F.lpad(month.cast("string"), 6, "0")).alias("accession_number"),
        line.alias("concept"), F.when(F.col("l_linestatus") == "O", "ifrs-full").otherwise("us-gaap").alias("taxonomy"),
        F.when(F.col("l_discount") == 0.1, "EUR").otherwise("USD").alias("unit"), F.when(F.col("l_discount") == 0.1, "UNSUPPORTED").otherwise("SUPPORTED").alias("unit_status"),
        F.col("l_extendedprice").alias("value"), ship.alias("period_end"),
        F.when(F.col("l_tax") != 0.08, F.date_sub(ship, (F.col("l_quantity") * 7 + 30).cast("int"))).alias("period_start"),
        F.date_add(ship, F.round(F.col("l_tax") * 1000).cast("int")).alias("filed_date"),
        F.lit(None).cast("timestamp").alias("source_acceptance_datetime_utc"), F.lit("2002-01-01").cast("timestamp").alias("source_retrieved_at_utc"),
    )


def quarters(t: Tables) -> DataFrame:
    concepts, taxonomies = default_concept_map(t.spark)
    return fu.normalize_fundamentals(facts(t), concepts, taxonomies, list(CONCEPTS))


@query("fact_choice", f"WITH {FACTS} SELECT security_id, fiscal_year, fiscal_period, accession AS accession_number, revenue, days_revenue, operating_income, net_income, operating_cash_flow, total_assets, stockholders_equity FROM chosen")
def fact_choice(t: Tables) -> DataFrame:
    concepts, taxonomies = default_concept_map(t.spark)
    out = fu.choose_facts(facts(t), concepts, taxonomies, ["security_id", "fiscal_year", "fiscal_period"], list(CONCEPTS))
    return out.select(
        "security_id", "fiscal_year", "fiscal_period", "accession_number", "revenue", F.col("_days_revenue").cast("bigint").alias("days_revenue"), "operating_income", "net_income",
        "operating_cash_flow", "total_assets", "stockholders_equity",
    )


_MISSING_SQL = "'[' || concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '\"{c}\"' END" for c in CORE_FIELDS) + ") || ']'"


@query("fundamentals", f"""WITH {QUARTERS} SELECT security_id, fiscal_year, fiscal_period, accession AS accession_number, filed AS filing_date, filed + 1 AS filing_available_date, ps AS period_start, pe AS period_end,
  round(revenue, 4) AS revenue, round(operating_income, 4) AS operating_income, ebit, round(net_income, 4) AS net_income, round(operating_cash_flow, 4) AS operating_cash_flow, total_assets, stockholders_equity,
  {_MISSING_SQL} AS missing_required_fields FROM quarters""")
def normalized(t: Tables) -> DataFrame:
    flows = {c: F.round(c, 4) for c in _FLOWS}
    return quarters(t).withColumns(flows).select(
        "security_id", "fiscal_year", "fiscal_period", "accession_number", "filing_date", "filing_available_date", "period_start", "period_end", *_FLOWS[:2],
        "ebit", *_FLOWS[2:], "total_assets", "stockholders_equity", "missing_required_fields",
    )


_RANKED = """known AS (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY pe DESC NULLS LAST, filed DESC, fiscal_year DESC, fiscal_period DESC) AS rn FROM quarters WHERE filed + 1 <= DATE '2001-06-30')"""


def _trail(c: str, lo: int = 1, hi: int = 4) -> str:
    return f"CASE WHEN count(*) FILTER (WHERE rn BETWEEN {lo} AND {hi}) = 4 AND count({c}) FILTER (WHERE rn BETWEEN {lo} AND {hi}) = 4 THEN sum({c}) FILTER (WHERE rn BETWEEN {lo} AND {hi}) END"


@query("factors", f"""WITH {QUARTERS}, {_RANKED}, px AS (SELECT 'S' || l_suppkey AS security_id, arg_max(l_extendedprice, l_shipdate) AS last_close FROM (SELECT l_suppkey, l_shipdate, max(l_extendedprice) AS l_extendedprice FROM lineitem WHERE l_shipdate <= DATE '2001-06-30' GROUP BY 1, 2) GROUP BY 1),
agg AS (SELECT security_id, {', '.join(f'{_trail(c)} AS t_{c}' for c in _FLOWS)}, max(CASE WHEN rn = 1 THEN filed END) AS filed,
  {', '.join(f'max(CASE WHEN rn = {k} THEN {c} END) AS {p}_{c}' for k, p in ((1, 'l'), (5, 'y'), (13, 'z')) for c in ('revenue', 'net_income'))} FROM known GROUP BY 1)
SELECT security_id, filed AS latest_filing_date, round(t_revenue, 4) AS trailing_revenue, round(t_operating_income, 4) AS trailing_operating_income, round(t_net_income, 4) AS trailing_net_income,
  round(t_operating_income / nullif(t_revenue, 0), 6) AS operating_margin, round(l_revenue / nullif(y_revenue, 0) - 1, 6) AS revenue_growth_yoy, round(l_net_income / nullif(y_net_income, 0) - 1, 6) AS earnings_growth_yoy,
  round(CASE WHEN l_revenue > 0 AND z_revenue > 0 THEN pow(l_revenue / z_revenue, 1.0 / 3) - 1 END, 6) AS revenue_growth_cagr_3y, 'PARTIAL' AS factor_quality_status, last_close FROM agg LEFT JOIN px USING (security_id)""")
def factors(t: Tables) -> DataFrame:
    prices = t.lineitem.groupBy(F.concat(F.lit("S"), "l_suppkey").alias("security_id"), F.to_date("l_shipdate").alias("session_date")).agg(F.max("l_extendedprice").alias("close"))
    cutoff = day("2001-06-30")
    out = fu.build_factors(quarters(t), prices, cutoff=cutoff, retrieved_at=F.lit("2002-01-01").cast("timestamp"))
    closes = fu.latest_prices(prices, cutoff)
    return out.join(closes, "security_id", "left").select(
        "security_id", "latest_filing_date", *[F.round(c, 4).alias(c) for c in ("trailing_revenue", "trailing_operating_income", "trailing_net_income")],
        *[r6(c).alias(c) for c in ("operating_margin", "revenue_growth_yoy", "earnings_growth_yoy", "revenue_growth_cagr_3y")], "factor_quality_status", "last_close",
    )


_CUMULATIVE = """per AS (SELECT c_nationkey AS nation, year(o_orderdate) AS y, quarter(o_orderdate) AS q, round(sum(o_totalprice), 2) AS rev, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3)"""


@query("ytd_to_discrete", f"""WITH {_CUMULATIVE}, ok AS (SELECT *, count(*) OVER (PARTITION BY nation, y) AS qs, sum(CASE WHEN n >= 3 THEN 0 ELSE 1 END) OVER (PARTITION BY nation, y ORDER BY q) AS thin,
  sum(CASE WHEN n >= 3 THEN 0 ELSE 1 END) OVER (PARTITION BY nation, y ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS thin_before, list(q) OVER (PARTITION BY nation, y) AS seen FROM per)
SELECT nation, y, 'Q' || q AS period, CASE WHEN n < 3 THEN NULL WHEN q < 4 AND coalesce(thin_before, 0) > 0 THEN NULL WHEN q = 4 AND (qs < 4 OR thin > 0) THEN NULL ELSE round(rev, 2) END AS revenue FROM ok""")
def ytd_to_discrete(t: Tables) -> DataFrame:
    """Quarterly revenue per nation is made cumulative and then discrete again."""
    o = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    per = o.groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").cast("bigint").alias("y"), F.quarter("o_orderdate").alias("q")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("rev"), F.count(F.lit(1)).alias("n")
    )
    # at most four rows per (nation, year) and four values summed
    later = per.select("nation", "y", F.col("rev"), F.explode(F.sequence("q", F.lit(4))).alias("q"))
    cumulative = later.groupBy("nation", "y", "q").agg(F.sum("rev").alias("ytd")).join(per.select("nation", "y", "q", "n"), ["nation", "y", "q"])
    reports = cumulative.select(
        "nation", "y", F.when(F.col("q") == 4, "FY").otherwise(F.concat(F.lit("Q"), "q")).alias("period"), F.when(F.col("n") >= 3, F.col("ytd")).alias("revenue")
    )
    return fu.ytd_to_discrete(reports, ["nation", "y"], "period", ["revenue"]).withColumn("revenue", F.round("revenue", 2))


_QUARTERLY = """qr AS (SELECT c_nationkey AS nation, year(o_orderdate) * 4 + quarter(o_orderdate) AS q, round(sum(o_totalprice), 2) AS rev, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS done FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY q DESC) AS rn FROM qr)"""


@query("trailing_four", f"""WITH {_QUARTERLY} SELECT nation, round({_trail('rev')}, 4) AS trailing_rev, round({_trail('done')}, 4) AS trailing_done, round({_trail('rev', 5, 8)}, 4) AS prior_rev,
  round(max(CASE WHEN rn = 1 THEN rev END) / nullif(max(CASE WHEN rn = 5 THEN rev END), 0) - 1, 6) AS growth_yoy, round(max(CASE WHEN rn = 13 THEN rev END), 4) AS three_years_back,
  round(CASE WHEN count(done / nullif(rev, 0)) FILTER (WHERE rn <= 12) >= 8 THEN stddev_pop(done / nullif(rev, 0)) FILTER (WHERE rn <= 12) END, 6) AS stability,
  round(CASE WHEN count(*) FILTER (WHERE rn <= 12) >= 8 THEN count(*) FILTER (WHERE rn <= 12 AND done > 0) / count(*) FILTER (WHERE rn <= 12) END, 6) AS consistency FROM rk GROUP BY 1""")
def trailing_four(t: Tables) -> DataFrame:
    o = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    per = o.groupBy(F.col("c_nationkey").alias("nation"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate")).alias("q")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("rev"), F.round(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), 2).alias("done")
    )
    ranked = fu.quarter_window(per, "nation", [F.col("q").desc()])
    recent = F.col("_rn") <= 12
    margin = safe_divide("done", "rev")
    return ranked.groupBy("nation").agg(
        F.round(fu.trailing("rev"), 4).alias("trailing_rev"), F.round(fu.trailing("done"), 4).alias("trailing_done"), F.round(fu.trailing("rev", 5, 8), 4).alias("prior_rev"),
        r6(growth(fu.at_rank("rev", 1), fu.at_rank("rev", 5))).alias("growth_yoy"), F.round(fu.at_rank("rev", 13), 4).alias("three_years_back"),
        r6(F.when(F.count(F.when(recent, margin)) >= 8, F.stddev_pop(F.when(recent, margin)))).alias("stability"),
        r6(F.when(F.count_if(recent) >= 8, F.count_if(recent & (F.col("done") > 0)) / F.count_if(recent))).alias("consistency"),
    )
