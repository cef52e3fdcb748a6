"""Orders as filing documents: exploding nested inputs, filings, events, clocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import AGENT_ACCESSION, AGENT_FILINGS, FILINGS, RETRIEVED, Tables, agent_accession, day, filings, naive, query, r6, raw_filings
from tidemark.functions import (
    available_date, cik10, cik10_strict, filing_attribution, form_emitted, hash_id, market_time_class, normalize_name, parse_source_date,
    parse_utc, source_date_unparsed, unit_status,
)
from tidemark.plans import filings as f
from tidemark.plans.fundamentals import build_company_facts
from tidemark.sources import (
    explode_chart_events, explode_chart_prices, explode_company_facts, explode_filings, normalize_short_interest,
)



def _at():
    return F.lit(RETRIEVED).cast("timestamp")


_LOCAL = "timezone('America/New_York', timezone('UTC', {0}))"


@query("available_date", f"""SELECT event_id, CASE WHEN event_type = 'error' THEN CAST(ts AS DATE) + 1 WHEN CAST({_LOCAL.format('ts')} AS TIME) <= TIME '16:00:00' THEN CAST({_LOCAL.format('ts')} AS DATE) ELSE CAST({_LOCAL.format('ts')} AS DATE) + 1 END AS available FROM events""")
def available(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", F.to_date("ts").alias("filed"), F.when(F.col("event_type") != "error", F.col("ts").cast("timestamp")).alias("accepted"))
    return rows.select("event_id", available_date("filed", "accepted").alias("available"))


@query("time_class", f"""SELECT event_type, class, count(*) AS n, min(event_id) AS first_id FROM (SELECT event_type, event_id, CASE WHEN event_type = 'error' THEN 'TIME_UNKNOWN' WHEN CAST({_LOCAL.format('ts')} AS TIME) < TIME '09:30:00' THEN 'BEFORE_MARKET'
  WHEN CAST({_LOCAL.format('ts')} AS TIME) <= TIME '16:00:00' THEN 'DURING_MARKET' ELSE 'AFTER_MARKET' END AS class FROM events) GROUP BY 1, 2""")
def time_class(t: Tables) -> DataFrame:
    rows = t.events.select("event_type", "event_id", F.when(F.col("event_type") != "error", F.col("ts").cast("timestamp")).alias("accepted"))
    return rows.groupBy("event_type", market_time_class("accepted").alias("class")).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


@query("parse_dates", """SELECT p, u, bad, count(*) AS n, count(DISTINCT o_orderkey) AS orders FROM (SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS p,
  CASE o_orderstatus WHEN 'F' THEN o_orderdate + INTERVAL 5 HOUR WHEN 'P' THEN o_orderdate END AS u,
  o_orderstatus = 'O' AND o_orderpriority = '5-LOW' AS bad FROM orders) GROUP BY 1, 2, 3""")
def parse_dates(t: Tables) -> DataFrame:
    status, d = F.col("o_orderstatus"), F.col("o_orderdate")
    text = (
        F.when((status == "O") & (F.col("o_orderpriority") == "5-LOW"), "soon").when(status == "F", F.upper(F.date_format(d, "dd-MMM-yyyy")))
        .when(status == "P", F.date_format(d, "dd-MMMM-yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd"))
    )
    zoned = F.when(status == "F", F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'-05:00'")).when(status == "P", F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).otherwise(
        F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")
    )
    rows = t.orders.select("o_orderkey", text.alias("x"), zoned.alias("z"))
    return rows.groupBy(
        parse_source_date("x").alias("p"), parse_utc("z").cast("timestamp_ntz").alias("u"), source_date_unparsed("x").alias("bad")
    ).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("orders"))


@query("normalize_identifiers", r"""SELECT c_custkey, trim(regexp_replace(upper(c_name || ' & Co., ' || c_mktsegment), '[^A-Z0-9]+', ' ', 'g')) AS name,
  lpad(regexp_replace(c_name, '[^0-9]', '', 'g'), 10, '0') AS cik, CASE WHEN c_acctbal < 0 THEN NULL ELSE lpad(regexp_replace(c_name, '[^0-9]', '', 'g'), 10, '0') END AS strict_cik,
  sha256(concat_ws('|', CAST(c_custkey AS VARCHAR), coalesce(CASE WHEN c_acctbal >= 0 THEN c_mktsegment END, ''), c_name)) AS id FROM customer""")
def normalize_identifiers(t: Tables) -> DataFrame:
    long = F.when(F.col("c_acctbal") < 0, F.concat("c_name", F.lit("-123"))).otherwise(F.col("c_name"))
    return t.customer.select(
        "c_custkey", normalize_name(F.concat("c_name", F.lit(" & Co., "), "c_mktsegment")).alias("name"), cik10("c_name").alias("cik"),
        cik10_strict(long).alias("strict_cik"), hash_id("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")), "c_name").alias("id"),
    )


@query("explode_parallel", """SELECT cik, accession_number, form, filing_date, report_date, items FROM (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, 'A' || o_orderkey AS accession_number, o_orderpriority AS form, CAST(o_orderdate AS DATE) AS filing_date, CAST(o_orderdate AS DATE) - 9 AS report_date, o_orderstatus AS items FROM orders
  UNION ALL SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0'), 'B' || o_orderkey, 'S-1', CAST(o_orderdate AS DATE) + 1, NULL, NULL FROM orders
  UNION ALL SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0'), 'C' || o_orderkey, 'S-3', NULL, NULL, NULL FROM orders)""")
def explode_parallel(t: Tables) -> DataFrame:
    """One document per order: three accessions, shorter date, report and item arrays."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    d = F.to_date("o_orderdate")
    documents = t.orders.select(F.col("o_custkey").cast("string").alias("cik"), F.struct(F.struct(
        F.array(*[F.concat(F.lit(x), "o_orderkey") for x in "ABC"]).alias("accessionNumber"), F.array(text(d), text(F.date_add(d, 1))).alias("filingDate"),
        F.array(text(F.date_sub(d, 9))).alias("reportDate"), F.array().cast("array<string>").alias("acceptanceDateTime"),
        F.array("o_orderpriority", F.lit("S-1"), F.lit("S-3")).alias("form"), F.array(F.lit("x.htm")).alias("primaryDocument"),
        F.array("o_orderstatus", F.lit(" ")).alias("items"), F.lit(None).cast("array<string>").alias("fileNumber"), F.array().cast("array<string>").alias("filmNumber"),
    ).alias("recent")).alias("filings"))
    return explode_filings(documents).select("cik", "accession_number", "form", "filing_date", "report_date", "items")


@query("explode_chart_prices", """SELECT o_orderkey AS symbol, CAST(o_orderdate AS DATE) AS session_date, o_totalprice AS close, CAST(o_custkey AS BIGINT) AS volume FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '2001-06-30'
UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1, o_totalprice * 2, CAST(1 AS BIGINT) FROM orders WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) + 1 <= DATE '2001-06-30'""")
def chart_prices(t: Tables) -> DataFrame:
    """One chart per order: two bars, the second without a close for pending orders."""
    seconds = F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400 + 51_000
    p = F.col("o_totalprice")
    two = lambda a, b: F.array(a, b)
    charts = t.orders.select(
        F.col("o_orderkey").alias("symbol"), two(seconds, seconds + 86400).alias("timestamp"), two(p, p).alias("open"), two(p, p).alias("high"),
        two(p, p).alias("low"), two(p, F.when(F.col("o_orderstatus") != "P", p * 2)).alias("close"),
        two(F.col("o_custkey").cast("double"), F.lit(1.0)).alias("volume"),
    )
    return explode_chart_prices(charts, day("2001-06-30")).select("symbol", "session_date", "close", F.col("volume").cast("bigint").alias("volume"))


@query("explode_chart_events", """SELECT o_orderkey AS symbol, 'd' || o_orderkey AS event_id, CAST(o_orderdate AS DATE) AS event_date, round(o_totalprice - 100000, 2) AS amount, NULL AS split_text, o_totalprice - 100000 > 0 AS is_valid FROM orders
UNION ALL SELECT o_orderkey, 's', CAST(o_orderdate AS DATE), CASE WHEN o_orderstatus <> 'P' THEN round(CAST(o_orderkey AS DOUBLE) / 4, 6) END, o_orderkey || ':' || CASE o_orderstatus WHEN 'P' THEN '0' ELSE '4' END, o_orderstatus <> 'P' AND o_orderkey > 0 FROM orders""")
def chart_events(t: Tables) -> DataFrame:
    seconds = F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400
    charts = t.orders.select(
        F.col("o_orderkey").alias("symbol"),
        F.create_map(F.concat(F.lit("d"), "o_orderkey"), F.struct((F.col("o_totalprice") - 100000).alias("amount"), seconds.alias("date"))).alias("dividends"),
        F.create_map(F.lit("s"), F.struct(
            seconds.alias("date"), F.col("o_orderkey").cast("double").alias("numerator"),
            F.when(F.col("o_orderstatus") == "P", 0.0).otherwise(4.0).alias("denominator"))).alias("splits"),
    )
    cash = explode_chart_events(charts, "dividends").select(
        "symbol", "event_id", "event_date", F.round("cash_amount", 2).alias("amount"), F.lit(None).cast("string").alias("split_text"), "is_valid"
    )
    cuts = explode_chart_events(charts, "splits").select("symbol", "event_id", "event_date", r6("split_factor").alias("amount"), "split_text", "is_valid")
    plain = F.regexp_replace("split_text", r"\A.*:", "")
    return cash.unionByName(cuts.withColumn("split_text", F.concat(F.col("symbol").cast("string"), F.lit(":"), plain)))


@query("json_records", """SELECT upper(event_type) AS symbol, CAST(ts AS DATE) AS settlement_date, count(*) AS n, round(sum(k), 6) AS current_short, round(sum(CASE WHEN event_type = 'error' THEN k - value ELSE 5 END), 4) AS changed
FROM (SELECT *, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events) GROUP BY 1, 2""")
def json_records(t: Tables) -> DataFrame:
    """Event properties parsed as short-interest records with old and new field names."""
    k = F.from_json("props", "k string")["k"]
    old = F.col("event_type") == "error"
    raw = t.events.select(
        F.when(old, F.lit(" ")).otherwise(F.col("event_type")).alias("symbolCode"), F.col("event_type").alias("issueSymbolIdentifier"),
        F.date_format("ts", "yyyy-MM-dd").alias("settlementDate"), F.when(~old, k).alias("currentShortPositionQuantity"), F.when(old, k).alias("currentShortShareNumber"),
        F.col("value").cast("string").alias("previousShortPositionQuantity"), F.when(~old, "5").alias("changePreviousNumber"),
    )
    return normalize_short_interest(raw).groupBy("symbol", "settlement_date").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("current_short_shares")).alias("current_short"), F.round(F.sum("short_change"), 4).alias("changed")
    )


_FACT_ROWS = """rows AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, 'Revenues' AS concept, 'USD' AS unit, o_totalprice AS value, CAST(o_orderdate AS DATE) - 91 AS ps, CAST(o_orderdate AS DATE) - 1 AS pe, CAST(o_orderdate AS DATE) AS filed FROM orders
  UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus, 'Revenues', 'USD', o_totalprice / 2, CAST(o_orderdate AS DATE) - 182, CAST(o_orderdate AS DATE) + CASE o_orderstatus WHEN 'P' THEN 5 ELSE -92 END, CAST(o_orderdate AS DATE) FROM orders
  UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus, 'Assets', 'EUR', o_totalprice * 3, NULL, NULL, CAST(o_orderdate AS DATE) FROM orders)"""


@query("company_facts", f"""WITH {AGENT_FILINGS}, {_FACT_ROWS}
SELECT r.o_orderkey AS order_key, 'C' || r.o_custkey AS security_id, concept, unit, CASE WHEN unit = 'USD' THEN 'SUPPORTED' ELSE 'UNSUPPORTED' END AS unit_status, value, year(filed) AS fiscal_year, pe AS period_end,
  f.acceptance_datetime_utc AS accepted, f.available AS published FROM rows r JOIN filed f ON f.accession_number = {AGENT_ACCESSION.replace('o_orderdate', 'filed')}
WHERE pe IS NULL OR filed >= pe""")
def company_facts(t: Tables) -> DataFrame:
    """One nested fact document per order, exploded and joined with its filing."""
    d = F.to_date("o_orderdate")
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    cik = F.lpad(F.col("o_custkey").cast("string"), 10, "0")
    accession = agent_accession()

    def fact(value, start, end):
        return F.struct(
            start.alias("start"), end.alias("end"), value.cast("string").alias("val"), accession.alias("accn"), F.year(d).cast("bigint").alias("fy"),
            F.lit("Q1").alias("fp"), F.lit("10-Q").alias("form"), text(d).alias("filed"), F.lit(None).cast("string").alias("frame"),
        )

    none = F.lit(None).cast("string")
    p = F.col("o_totalprice")
    revenue = F.array(
        fact(p, text(F.date_sub(d, 91)), text(F.date_sub(d, 1))),
        fact(p / 2, text(F.date_sub(d, 182)), text(F.date_add(d, F.when(F.col("o_orderstatus") == "P", 5).otherwise(-92)))),
    )
    detail = lambda unit, rows: F.struct(F.lit("x").alias("label"), F.lit(" ").alias("description"), F.create_map(F.lit(unit), rows).alias("units"))
    documents = t.orders.select(cik.alias("cik"), F.create_map(F.lit("us-gaap"), F.create_map(
        F.lit("Revenues"), detail("USD", revenue), F.lit("Assets"), detail("EUR", F.array(fact(p * 3, none, none)))
    )).alias("facts"))
    primary = t.orders.select(cik.alias("cik"), F.concat(F.lit("C"), "o_custkey").alias("security_id")).distinct()
    facts, _ = build_company_facts(
        explode_company_facts(documents), primary, filings(t, accession), cutoff=day("2002-01-01"), revision="r", retrieved_at=_at()
    )
    return facts.select(
        (F.substring("accession_number", 1, 10).cast("bigint") * 1_000_000 + F.substring("accession_number", 15, 6).cast("bigint")).alias("order_key"), "security_id", "concept", "unit", "unit_status", "value",
        "fiscal_year", "period_end", F.col("source_acceptance_datetime_utc").cast("timestamp_ntz").alias("accepted"), F.col("source_publication_date").alias("published"),
    )


@query("filings", f"""WITH {FILINGS} SELECT security_id, accession_number, form, filing_date, acceptance_datetime_utc, report_date, primary_document_url, available AS source_publication_date,
  coalesce(report_date, filing_date) AS source_event_date FROM (SELECT DISTINCT * FROM filed WHERE filing_date <= DATE '2000-12-31' AND form <> 'SC 13D') QUALIFY count(*) OVER (PARTITION BY cik, accession_number) = 1""")
def filing_table(t: Tables) -> DataFrame:
    """PIP-04: a filer's own filings; accession numbers with conflicting rows are left out."""
    raw = raw_filings(t)
    primary = raw.select("cik", "security_id").distinct()
    rows = raw.drop("security_id").withColumns({"file_number": F.lit(None).cast("string"), "film_number": F.lit(None).cast("string")})
    out, _ = f.build_filings(rows, primary, cutoff=day("2000-12-31"), retrieved_at=_at())
    return out.filter(form_emitted("form")).select(
        "security_id", "accession_number", "form", "filing_date", naive("acceptance_datetime_utc"), "report_date", "primary_document_url",
        "source_publication_date", "source_event_date",
    )


@query("filing_attribution", """SELECT form, unit, kept, count(*) AS n FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'SC 13G/A' WHEN '2-HIGH' THEN '4/A' WHEN '3-MEDIUM' THEN '424B3' ELSE '10-K' END AS form,
  CASE WHEN o_orderstatus = 'F' THEN 'UNSUPPORTED' ELSE 'SUPPORTED' END AS unit, (o_orderstatus = 'O') = (o_orderpriority >= '3') AS kept FROM orders) GROUP BY 1, 2, 3""")
def attribution(t: Tables) -> DataFrame:
    pr = F.col("o_orderpriority")
    form = F.when(pr == "1-URGENT", "SC 13G/A").when(pr == "2-HIGH", "4/A").when(pr == "3-MEDIUM", "424B3").otherwise("10-K")
    rows = t.orders.select(
        form.alias("form"), F.when(F.col("o_orderstatus") == "F", "GBP").otherwise("USD/shares").alias("u"), F.lit("0000000007").alias("cik"),
        F.when(F.col("o_orderstatus") == "O", "0000000007-01-000001").otherwise("0000000008-01-000001").alias("accession"),
    )
    return rows.groupBy("form", unit_status("u").alias("unit"), filing_attribution("form", "cik", "accession").alias("kept")).agg(F.count(F.lit(1)).alias("n"))


EVENTS = f"""{FILINGS}, specs AS (
  SELECT f.*, s.kind, s.subtype, s.confidence, s.score FROM filed f JOIN (VALUES ('SC 13D', 'ACTIVIST_13D', 'INITIAL', 'HIGH', 0.9), ('424B5', 'EQUITY_ISSUANCE', 'PROSPECTUS', 'MEDIUM', 0.5), ('S-3', 'EQUITY_ISSUANCE', 'SHELF_REGISTRATION', 'MEDIUM', 0.4)) s(form, kind, subtype, confidence, score) ON s.form = f.form
  UNION ALL SELECT f.*, s.kind, '8-K_ITEM_' || s.item || ':' || s.subtype, 'HIGH', s.score FROM filed f JOIN (VALUES ('2.01', 'ASSET_SALE', 'ACQUISITION_OR_DISPOSITION_COMPLETED', 0.7), ('2.02', 'EARNINGS_RELEASE', 'RESULTS_OF_OPERATIONS', 0.8),
    ('5.02', 'MANAGEMENT_CHANGE', 'DIRECTOR_OR_OFFICER_CHANGE', 0.7), ('1.05', 'CYBERSECURITY_INCIDENT', 'MATERIAL_CYBERSECURITY_INCIDENT', 0.9)) s(item, kind, subtype, score) ON contains(f.items, s.item) WHERE f.form = '8-K'),
corporate AS (SELECT *, sha256(concat_ws('|', security_id, accession_number, kind, subtype)) AS event_id FROM specs),
earnings AS (SELECT *, sha256(accession_number || '|EARNINGS') AS event_id, coalesce(CAST(acceptance_datetime_utc AS DATE), filing_date) AS event_date,
  CASE WHEN acceptance_datetime_utc IS NULL THEN 'TIME_UNKNOWN' WHEN CAST({_LOCAL.format('acceptance_datetime_utc')} AS TIME) < TIME '09:30:00' THEN 'BEFORE_MARKET' WHEN CAST({_LOCAL.format('acceptance_datetime_utc')} AS TIME) <= TIME '16:00:00' THEN 'DURING_MARKET' ELSE 'AFTER_MARKET' END AS class
  FROM filed WHERE form = '8-K' AND contains(items, '2.02'))"""


def corporate_events(t: Tables) -> DataFrame:
    return f.build_corporate_events(filings(t), retrieved_at=_at())


def earnings_events(t: Tables) -> DataFrame:
    return f.build_earnings_events(filings(t), retrieved_at=_at())


@query("corporate_events", f"""WITH {EVENTS} SELECT event_id, security_id, kind AS event_type, subtype AS event_subtype, confidence AS event_confidence, CAST(score AS DOUBLE) AS materiality_score, coalesce(report_date, filing_date) AS effective_date,
  acceptance_datetime_utc AS announcement_datetime_utc, 'SEC ' || form || ' filing: ' || subtype AS headline FROM corporate""")
def corporate(t: Tables) -> DataFrame:
    return corporate_events(t).select(
        "event_id", "security_id", "event_type", "event_subtype", "event_confidence", "materiality_score", "effective_date",
        naive("announcement_datetime_utc"), "headline",
    )


@query("earnings_events", f"WITH {EVENTS} SELECT event_id, security_id, event_date, class AS event_time_classification, accession_number AS filing_accession_number FROM earnings")
def earnings(t: Tables) -> DataFrame:
    return earnings_events(t).select("event_id", "security_id", "event_date", "event_time_classification", "filing_accession_number")
