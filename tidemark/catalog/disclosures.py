"""Disclosure tables built whole from raw text tables: insider trades, holdings, short interest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import Tables, day, query
from tidemark.plans import ownership, short_interest
from tidemark.sources.feeds import normalize_short_interest

def _at():
    return F.lit("2002-01-01").cast("timestamp")


def text_of(column: str):
    return F.col(column).cast("string")


# ---- insider trades: an order is a submission of its customer, line items are its transactions, odd lines derivative
_ISSUERS = """issuers AS (SELECT DISTINCT c_custkey AS k, 'C' || c_custkey AS security_id FROM customer WHERE c_custkey % 11 <> 0),
line AS (SELECT l_orderkey AS o, printf('%010d-98-%06d', l_orderkey, l_orderkey % 7) AS accession_number, CASE WHEN l_linenumber % 2 = 1 THEN 'D:' ELSE 'N:' END || l_orderkey || '-' || l_linenumber AS transaction_id,
  CAST(l_shipdate AS DATE) AS transaction_date, l_quantity AS shares, CASE WHEN l_discount <> 0.1 THEN l_extendedprice END AS price, l_linenumber % 2 = 1 AS is_derivative FROM lineitem),
sub AS (SELECT o_orderkey AS o, o_custkey AS k, CAST(o_orderdate AS DATE) AS filing_date, o_orderstatus = 'F' AS planned FROM orders WHERE o_orderstatus <> 'P')"""


def _insiders(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    accession = lambda c: F.format_string("%010d-98-%06d", F.col(c), F.col(c) % 7)
    submissions = t.orders.filter("o_orderstatus <> 'P'").select(
        accession("o_orderkey").alias("ACCESSION_NUMBER"), F.upper(F.date_format(F.to_date("o_orderdate"), "dd-MMM-yyyy")).alias("FILING_DATE"), F.lit("4").alias("DOCUMENT_TYPE"),
        text_of("o_custkey").alias("ISSUERCIK"), F.concat(F.lit("T"), text_of("o_custkey")).alias("ISSUERTRADINGSYMBOL"), F.when(F.col("o_orderstatus") == "F", "yes").otherwise("0").alias("AFF10B5ONE"))
    owner = lambda shift, rel: t.orders.filter("o_orderkey % 19 <> 0").select(
        accession("o_orderkey").alias("ACCESSION_NUMBER"), (F.col("o_custkey") * 10 + shift).cast("string").alias("RPTOWNERCIK"), F.lit(" ").alias("RPTOWNERNAME"),
        F.lit(rel).alias("RPTOWNER_RELATIONSHIP"), text_of("o_orderpriority").alias("RPTOWNER_TITLE"))
    owners = owner(1, "Director,Officer").unionByName(owner(2, "TenPercentOwner").filter("ACCESSION_NUMBER LIKE '%3'"))

    def lines(odd: int, key: str) -> DataFrame:
        return t.lineitem.filter(F.col("l_linenumber") % 2 == odd).select(
            accession("l_orderkey").alias("ACCESSION_NUMBER"), F.concat(text_of("l_orderkey"), F.lit("-"), text_of("l_linenumber")).alias(key),
            F.date_format(F.to_date("l_shipdate"), "yyyy-MM-dd").alias("TRANS_DATE"), F.lit("5").alias("TRANS_FORM_TYPE"), text_of("l_quantity").alias("TRANS_SHARES"),
            F.when(F.col("l_discount") != 0.1, text_of("l_extendedprice")).otherwise("NaN").alias("TRANS_PRICEPERSHARE"))

    master = t.customer.filter("c_custkey % 11 <> 0").select(F.concat(F.lit("C"), text_of("c_custkey")).alias("security_id"), F.lpad(text_of("c_custkey"), 10, "0").alias("cik"))
    universe = master.select("security_id", F.concat(F.lit("T"), F.substring("security_id", 2, 20)).alias("ticker"))
    filings = t.orders.filter("o_orderkey % 2 = 0").select(F.lpad(text_of("o_custkey"), 10, "0").alias("cik"), accession("o_orderkey").alias("accession_number"), (F.to_date("o_orderdate").cast("timestamp") + F.expr("INTERVAL 23 HOURS")).alias("acceptance_datetime_utc"))
    return ownership.build_insider_transactions(submissions, owners, lines(0, "NONDERIV_TRANS_SK"), lines(1, "DERIV_TRANS_SK"), master=master, universe=universe, filings=filings, cutoff=day("1998-06-15"), retrieved_at=_at())


_TRADES = f"""{_ISSUERS}, owner AS (SELECT o_orderkey AS o, o_custkey * 10 + n AS person, n FROM orders, (VALUES (1), (2)) v(n) WHERE o_orderkey % 19 <> 0 AND (n = 1 OR o_orderkey % 7 = 3)),
trade AS (SELECT DISTINCT security_id, printf('%010d', person) AS reporting_owner_cik, n = 1 AS is_officer, n = 2 AS is_ten_percent_owner, filing_date, transaction_date, accession_number, transaction_id, shares, price AS price_per_share, is_derivative, planned AS is_10b5_1,
  o % 2 = 0 AS accepted FROM line JOIN sub USING (o) JOIN issuers USING (k) JOIN owner USING (o) WHERE filing_date <= DATE '1998-06-15'),
twice AS (SELECT accession_number, reporting_owner_cik, transaction_id FROM trade GROUP BY ALL HAVING count(*) > 1)"""


@query("insider_transactions", f"WITH {_TRADES} SELECT trade.* FROM trade ANTI JOIN twice USING (accession_number, reporting_owner_cik, transaction_id)")
def insider_transactions(t: Tables) -> DataFrame:
    """PIP-10 / JOI-09."""
    return _insiders(t)[0].select(
        "security_id", "reporting_owner_cik", "is_officer", "is_ten_percent_owner", "filing_date", "transaction_date", "accession_number", "transaction_id", "shares", "price_per_share",
        "is_derivative", "is_10b5_1", F.col("source_acceptance_datetime_utc").isNotNull().alias("accepted"))


@query("insider_rejects", f"""WITH {_TRADES}, known AS (SELECT * FROM line JOIN sub USING (o) WHERE filing_date <= DATE '1998-06-15')
SELECT accession_number, transaction_id, 'UNKNOWN_ISSUER_CIK' AS reason FROM known WHERE k NOT IN (SELECT k FROM issuers)
UNION ALL SELECT accession_number, transaction_id, 'NO_FILING_PROVENANCE' FROM line WHERE o NOT IN (SELECT o FROM sub)
UNION ALL SELECT accession_number, transaction_id, 'NO_REPORTING_OWNER' FROM known JOIN issuers USING (k) WHERE o % 19 = 0
UNION ALL SELECT accession_number, transaction_id, 'CONFLICTING_TRANSACTION' FROM twice""")
def insider_rejects(t: Tables) -> DataFrame:
    """Transactions refused for identity, those without submission or owner, and ids that name unlike trades."""
    _, rejected, broken = _insiders(t)
    return rejected.select("accession_number", "transaction_id", F.col("reject_reason").alias("reason")).unionByName(broken)


# ---- holdings: a supplier reports its parts per quarter; some have no value, some no report
_HELD = """pos AS (SELECT l_suppkey AS m, l_partkey AS p, (date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS q, l_extendedprice AS v, CASE WHEN l_discount = 0.1 THEN NULL ELSE l_quantity END AS s, CASE WHEN l_tax <> 0.08 THEN l_quantity END AS vote FROM lineitem),
acc AS (SELECT *, printf('%010d-%02d-%06d', m, year(q) % 100, month(q)) AS accession_number, q + 40 AS filing_date FROM pos)"""


def _holdings(t: Tables) -> tuple[DataFrame, DataFrame]:
    quarter = F.date_sub(F.add_months(F.trunc(F.to_date("l_shipdate"), "quarter"), 3), 1)
    lines = t.lineitem.withColumn("q", quarter).withColumn("acc", F.format_string("%010d-%s-%06d", "l_suppkey", F.date_format("q", "yy"), F.month("q")))
    reports = lines.filter("l_suppkey % 9 <> 0").select("acc", "q", "l_suppkey").distinct()
    submissions = reports.select(F.col("acc").alias("ACCESSION_NUMBER"), F.date_format(F.date_add("q", 40), "yyyy-MM-dd").alias("FILING_DATE"), F.date_format("q", "yyyy-MM-dd").alias("PERIODOFREPORT"), text_of("l_suppkey").alias("CIK"))
    covers = reports.select(F.col("acc").alias("ACCESSION_NUMBER"), F.concat(F.lit("manager "), text_of("l_suppkey")).alias("FILINGMANAGER_NAME"))
    name = F.concat(F.lit("Part, no. "), (F.col("l_partkey") - F.col("l_partkey") % 2).cast("string"))
    positions = lines.select(
        F.col("acc").alias("ACCESSION_NUMBER"), F.concat(F.lit("p"), text_of("l_partkey")).alias("CUSIP"), name.alias("NAMEOFISSUER"), F.lit("COM").alias("TITLEOFCLASS"), text_of("l_extendedprice").alias("VALUE"),
        F.when(F.col("l_discount") != 0.1, text_of("l_quantity")).otherwise("").alias("SSHPRNAMT"), F.lit("SH").alias("SSHPRNAMTTYPE"), F.lit("").alias("PUTCALL"), F.lit("SOLE").alias("INVESTMENTDISCRETION"),
        F.when(F.col("l_tax") != 0.08, text_of("l_quantity")).alias("VOTING_AUTH_SOLE"), F.lit("0").alias("VOTING_AUTH_SHARED"), F.lit("0").alias("VOTING_AUTH_NONE"))
    # an even part has a reviewed code if its key ends in 0; names are known for keys that end in 2 or 4, the latter twice
    overrides = t.part.filter("p_partkey % 10 = 0").select(F.concat(F.lit("P"), text_of("p_partkey")).alias("cusip"), F.concat(F.lit("S"), text_of("p_partkey")).alias("security_id"))
    named = t.part.filter("p_partkey % 10 IN (2, 4)").select(F.concat(F.lit("PART NO "), text_of("p_partkey")).alias("registrant_name"), F.concat(F.lit("S"), text_of("p_partkey")).alias("security_id"), "p_partkey")
    master = named.drop("p_partkey").unionByName(named.filter("p_partkey % 10 = 4").select("registrant_name", F.concat("security_id", F.lit("-B")).alias("security_id")))
    return ownership.build_holdings(submissions, covers, positions, master=master, overrides=overrides, cutoff=day("1998-06-15"), retrieved_at=_at())


_MAPPED = f"""{_HELD}, good AS (SELECT acc.*, CASE WHEN p % 10 = 0 THEN 'S' || p WHEN (p - p % 2) % 10 = 2 AND p - p % 2 IN (SELECT p_partkey FROM part) THEN 'S' || (p - p % 2) END AS security_id,
  CASE WHEN p % 10 = 0 THEN 'REVIEWED_CUSIP_OVERRIDE' ELSE 'UNIQUE_SEC_ISSUER_NAME' END AS method FROM acc WHERE m % 9 <> 0 AND filing_date <= DATE '1998-06-15')"""


@query("institutional_holdings", f"""WITH {_MAPPED} SELECT 'manager ' || m AS manager_name, q AS report_period, filing_date, accession_number, security_id, min('P' || p) AS cusip, min(method) AS security_mapping_method,
  round(sum(v), 4) AS market_value_thousands, sum(s) AS shares_or_principal, CASE WHEN bool_and(vote IS NOT NULL) THEN sum(vote) END AS voting_authority_sole FROM good WHERE security_id IS NOT NULL AND s IS NOT NULL GROUP BY m, q, filing_date, accession_number, security_id""")
def institutional_holdings(t: Tables) -> DataFrame:
    """PIP-12 / JOI-11."""
    return _holdings(t)[0].select(
        "manager_name", "report_period", "filing_date", "accession_number", "security_id", "cusip", "security_mapping_method", F.round("market_value_thousands", 4).alias("market_value_thousands"),
        "shares_or_principal", "voting_authority_sole")


@query("holdings_rejects", f"""WITH {_MAPPED} SELECT accession_number, 'P' || p AS cusip, 'NO_FILING_PROVENANCE' AS reason FROM acc WHERE m % 9 = 0
UNION ALL SELECT accession_number, 'P' || p, 'NO_VALUE_OR_SHARES' FROM good WHERE security_id IS NOT NULL AND s IS NULL""")
def holdings_rejects(t: Tables) -> DataFrame:
    return _holdings(t)[1].select("accession_number", "cusip", F.array_join("reject_reasons", "|").alias("reason"))


# ---- short interest: one record per part and month, published nine days later except for February
_CHANGES = """rec AS (SELECT 'P-' || l_partkey AS symbol, last_day(l_shipdate) AS settlement_date, CAST(sum(l_quantity) AS DOUBLE) AS shares FROM lineitem WHERE l_partkey % 10 <> 7 GROUP BY l_partkey, 2),
due AS (SELECT DISTINCT last_day(o_orderdate) AS settlement_date FROM orders WHERE month(o_orderdate) <> 2),
known AS (SELECT 'S' || substr(symbol, 3) AS security_id, settlement_date, settlement_date + 9 AS published, shares, lag(shares, 2) OVER w AS two, lag(shares, 6) OVER w AS six, lag(shares) OVER w AS one FROM rec JOIN due USING (settlement_date) WINDOW w AS (PARTITION BY symbol ORDER BY settlement_date))"""


@query("short_interest_table", f"""WITH {_CHANGES} SELECT security_id, settlement_date, published AS source_publication_date, shares AS current_short_shares, round(shares / two - 1, 6) AS short_interest_change_1m, round(shares / six - 1, 6) AS short_interest_change_3m,
  shares / 10 - one / 10 AS days_to_cover_change FROM known""")
def short_interest_table(t: Tables) -> DataFrame:
    """PIP-14 / JOI-13."""
    month = F.last_day(F.to_date("l_shipdate"))
    shares = t.lineitem.groupBy(F.concat(F.lit("P-"), text_of("l_partkey")).alias("symbolCode"), F.date_format(month, "yyyy-MM-dd").alias("settlementDate")).agg(F.sum("l_quantity").cast("double").alias("n"))
    records = normalize_short_interest(shares.select("symbolCode", "settlementDate", text_of("n").alias("currentShortPositionQuantity"), (F.col("n") / 10).cast("string").alias("daysToCoverQuantity")))
    schedule = t.orders.filter(F.month(F.to_date("o_orderdate")) != 2).select(F.last_day(F.to_date("o_orderdate")).alias("settlement_date")).distinct().withColumn("publication_date", F.date_add("settlement_date", 9))
    universe = t.part.filter("p_partkey % 10 <> 7").select(F.concat(F.lit("P."), text_of("p_partkey")).alias("ticker"), F.concat(F.lit("S"), text_of("p_partkey")).alias("security_id"))
    out = short_interest.build_short_interest(records, schedule, universe, retrieved_at=_at())
    return out.select("security_id", "settlement_date", "source_publication_date", "current_short_shares", F.round("short_interest_change_1m", 6).alias("short_interest_change_1m"),
                      F.round("short_interest_change_3m", 6).alias("short_interest_change_3m"), "days_to_cover_change")
