"""Read-model tables over bars, filings and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import BARS, FILINGS, Tables, bars, day, filings, naive, query
from tidemark.catalog.documents import EVENTS, corporate_events, earnings_events
from tidemark.catalog.fundamentals import QUARTERS, quarters
from tidemark.functions import event_window
from tidemark.operators import keys
from tidemark.plans import read_model as rm
from tidemark.plans.coverage import domain_coverage as coverage_by_domain

_WINDOW = "BETWEEN DATE '2000-06-30' - 180 AND DATE '2000-06-30' + 365"


@query("evidence_union", f"""WITH {EVENTS}
SELECT 'sec-filing:' || security_id || ':' || accession_number AS evidence_id, 'SEC_FILING' AS evidence_kind, coalesce(acceptance_datetime_utc, retrieved) AS known_at_utc, acceptance_datetime_utc AS source_event_at, primary_document_url AS source_locator, form || ' filing' AS headline, primary_document AS summary FROM (FROM filed QUALIFY row_number() OVER (PARTITION BY security_id, accession_number ORDER BY acceptance_datetime_utc DESC NULLS LAST, primary_document_url, form, primary_document NULLS LAST) = 1)
UNION ALL SELECT 'corporate-event:' || security_id || ':' || event_id, 'CORPORATE_EVENT', coalesce(acceptance_datetime_utc, retrieved), acceptance_datetime_utc, primary_document_url, 'SEC ' || form || ' filing: ' || subtype, 'Deterministic event classification from SEC form and item metadata.' FROM (FROM corporate WHERE coalesce(report_date, filing_date) {_WINDOW} QUALIFY row_number() OVER (PARTITION BY security_id, event_id ORDER BY acceptance_datetime_utc DESC NULLS LAST, primary_document_url, form, subtype) = 1)
UNION ALL SELECT 'earnings-event:' || security_id || ':' || event_id, 'EARNINGS_EVENT', coalesce(acceptance_datetime_utc, retrieved), acceptance_datetime_utc, primary_document_url, 'EARNINGS_RELEASE ', NULL FROM (FROM earnings WHERE event_date {_WINDOW} QUALIFY row_number() OVER (PARTITION BY security_id, event_id ORDER BY acceptance_datetime_utc DESC NULLS LAST, primary_document_url) = 1)""")
def evidence_union(t: Tables) -> DataFrame:
    """SET-01: one row a filing or event of a security, the newest; equally new ones by source, headline and summary."""
    out = rm.build_evidence(filings(t), corporate_events(t), earnings_events(t), day("2000-06-30"))
    return out.select("evidence_id", "evidence_kind", naive("known_at_utc"), naive("source_event_at"), "source_locator", "headline", "summary")


@query("event_window", f"WITH {EVENTS} SELECT event_id, kind AS event_type FROM corporate WHERE coalesce(report_date, filing_date) {_WINDOW}")
def windowed_events(t: Tables) -> DataFrame:
    rows = corporate_events(t).filter(event_window(day("2000-06-30"), "effective_date", "source_event_date", "source_filing_date"))
    return rows.select("event_id", "event_type")


@query("primary_filings_latest", f"""WITH {FILINGS} SELECT security_id, form, accession_number FROM filed
QUALIFY row_number() OVER (PARTITION BY security_id, form ORDER BY acceptance_datetime_utc DESC NULLS LAST, accession_number DESC) = 1""")
def primary_filings_latest(t: Tables) -> DataFrame:
    order = [F.col("acceptance_datetime_utc").desc_nulls_last(), F.col("accession_number").desc()]
    return keys.latest_per_key(filings(t), ["security_id", "form"], order).select("security_id", "form", "accession_number")


@query("market_history_recent", f"WITH {BARS} SELECT security_id, session_date, close FROM bars QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY session_date DESC) <= 7")
def market_history_recent(t: Tables) -> DataFrame:
    return keys.recent_n(bars(t), ["security_id"], [F.col("session_date").desc()], 7).select("security_id", "session_date", "close")


@query("security_table", """WITH u AS (SELECT 'C' || c_custkey AS id, CASE WHEN c_acctbal > 0 THEN c_name ELSE '' END AS ticker, c_mktsegment AS seg FROM customer WHERE c_acctbal > -500),
m AS (SELECT 'C' || o_custkey AS id, max(o_orderpriority) AS ticker, min(o_orderstatus) AS cik FROM orders GROUP BY 1)
SELECT coalesce(u.id, m.id) AS security_id, coalesce(nullif(u.ticker, ''), m.ticker, '') AS ticker, seg AS security_type, cik, CAST(u.id IS NOT NULL AS INT) AS is_current FROM u FULL JOIN m ON u.id = m.id""")
def security_table(t: Tables) -> DataFrame:
    universe = t.customer.filter("c_acctbal > -500").select(
        F.concat(F.lit("C"), "c_custkey").alias("security_id"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise("").alias("ticker"), F.lit("X").alias("exchange_mic"),
        F.col("c_mktsegment").alias("security_type"), F.lit("ADMITTED").alias("universe_admission_status"),
    )
    none = lambda c: F.lit(None).cast("string").alias(c)
    master = t.orders.groupBy(F.concat(F.lit("C"), "o_custkey").alias("security_id")).agg(F.max("o_orderpriority").alias("ticker"), F.min("o_orderstatus").alias("cik")).select(
        "security_id", "ticker", none("exchange_mic"), "cik", none("registrant_name"), none("sic"), none("mapping_status")
    )
    return rm.security_table(universe, master).select("security_id", "ticker", "security_type", "cik", "is_current")


@query("domain_coverage", f"""WITH {FILINGS}, {QUARTERS}, trades AS (SELECT 'S' || l_suppkey AS sid, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_returnflag = 'A'), held AS (SELECT 'S' || l_suppkey AS sid, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_returnflag = 'N'), shorts AS (SELECT 'S' || l_suppkey AS sid, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_quantity > 1000)
SELECT 'fundamentals' AS domain, 'READY' AS status, count(*) AS rows, count(DISTINCT security_id) AS securities, max(filed) AS latest FROM quarters
UNION ALL SELECT 'filings_and_events', 'READY', count(*), count(DISTINCT security_id), max(filing_date) FROM filed
UNION ALL SELECT 'insider_transactions', 'READY', count(*), count(DISTINCT sid), max(d) FROM trades UNION ALL SELECT 'institutional_ownership', 'READY', count(*), count(DISTINCT sid), max(d) FROM held
UNION ALL SELECT 'short_interest', 'VALIDATION_FAILED', count(*), count(DISTINCT sid), max(d) FROM shorts UNION ALL SELECT 'security_master', 'READY', count(*), count(DISTINCT s_suppkey), NULL FROM supplier""")
def domain_coverage(t: Tables) -> DataFrame:
    def part(test: str, date: str) -> DataFrame:
        return t.lineitem.filter(test).select(F.concat(F.lit("S"), "l_suppkey").alias("security_id"), F.to_date("l_shipdate").alias(date))

    return coverage_by_domain({
        "fundamentals_quarterly": quarters(t), "filings": filings(t), "insider_transactions": part("l_returnflag = 'A'", "filing_date"),
        "institutional_holdings": part("l_returnflag = 'N'", "report_period"), "short_interest": part("l_quantity > 1000", "settlement_date"),
        "security_master": t.supplier.select(F.col("s_suppkey").cast("string").alias("security_id")),
    })


@query("latest_estimates", """SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_estimates(t: Tables) -> DataFrame:
    """Newest estimate per (security, metric): the multi-column key form of WIN-01."""
    return keys.latest_per_key(t.events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()]).select("user_id", "event_type", "event_id", "value")


@query("flagship", f"""WITH {BARS}, ok AS (SELECT * FROM bars WHERE open > 0 AND high > 0 AND low > 0 AND close > 0),
prev AS (SELECT *, lag(session_date) OVER w AS ps, lag(close) OVER w AS pc FROM ok WINDOW w AS (PARTITION BY security_id ORDER BY session_date)),
seg AS (SELECT *, sum(CASE WHEN (ps IS NOT NULL AND session_date - ps > 5) OR greatest(close / pc, pc / close) >= 40 THEN 1 ELSE 0 END) OVER (PARTITION BY security_id ORDER BY session_date ROWS UNBOUNDED PRECEDING) AS sid FROM prev),
lat AS (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY session_date DESC) AS rn FROM seg QUALIFY sid = max(sid) OVER (PARTITION BY security_id))
SELECT security_id, max(CASE WHEN rn = 1 THEN session_date END) AS session_date, max(CASE WHEN rn = 1 THEN close END) AS close, round(max(CASE WHEN rn = 1 THEN close END) / max(CASE WHEN rn = 2 THEN close END) - 1, 6) AS price_return_1d,
  round(max(CASE WHEN rn = 1 THEN close END) / max(CASE WHEN rn = 6 THEN close END) - 1, 6) AS price_return_5d FROM lat WHERE rn <= 20 GROUP BY 1""")
def flagship(t: Tables) -> DataFrame:
    """Validate, segment, keep the latest segment, and take the snapshot."""
    from tidemark.functions import is_invalid_ohlcv
    from tidemark.operators import quality, segments
    from tidemark.plans.market import market_snapshot

    good, _ = quality.quarantine(bars(t), {"INVALID_BAR": is_invalid_ohlcv()})
    cut = segments.segment_history(
        good, ["security_id"], "session_date", "close", gap=F.datediff("session_date", "previous_session") > 5, ratio=40.0
    )
    rows = segments.latest_segment(cut, ["security_id"], "session_date", F.lit(True), 20)
    return market_snapshot(rows).select(
        "security_id", "session_date", "close", F.round("price_return_1d", 6).alias("price_return_1d"), F.round("price_return_5d", 6).alias("price_return_5d")
    )




@query("missing_provenance", f"WITH {FILINGS} SELECT accession_number, form FROM filed WHERE acceptance_datetime_utc IS NULL")
def missing_provenance(t: Tables) -> DataFrame:
    from tidemark.operators.quality import missing_provenance as without

    return without(filings(t), "acceptance_datetime_utc").select("accession_number", "form")


@query("evidence_rules", f"""WITH {EVENTS}, e AS (SELECT accession_number AS id, security_id, acceptance_datetime_utc AS known, primary_document AS locator FROM filed)
SELECT rule, violations FROM (SELECT 'KNOWN_AT_UTC' AS rule, count(*) FILTER (WHERE known IS NULL) AS violations FROM e UNION ALL SELECT 'SOURCE_LOCATOR', count(*) FILTER (WHERE locator IS NULL) FROM e
UNION ALL SELECT 'EVIDENCE_ID', 0 UNION ALL SELECT 'SECURITY_ID', 0 UNION ALL SELECT 'EVIDENCE_KIND', 0 UNION ALL SELECT 'REVISION', 0)""")
def evidence_rules(t: Tables) -> DataFrame:
    """DQ-11 on unchecked filings, where acceptance and document may be missing."""
    from tidemark.operators import quality

    rows = filings(t).select(
        F.col("accession_number").alias("evidence_id"), "security_id", F.lit("SEC_FILING").alias("evidence_kind"), F.col("acceptance_datetime_utc").alias("known_at_utc"),
        F.col("accession_number").alias("revision"), F.col("primary_document").alias("source_locator"),
    )
    return quality.rule_counts(rows, quality.evidence_rules())


@query("distribution_row_rules", """WITH d AS (SELECT CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS cash, o_orderpriority AS p FROM orders)
SELECT rule, violations FROM (SELECT 'CASH' AS rule, count(*) FILTER (WHERE NOT cash > 0) AS violations FROM d UNION ALL SELECT 'CURRENCY', count(*) FILTER (WHERE p <> '5-LOW') FROM d UNION ALL SELECT 'IDENTITY', 0 UNION ALL SELECT 'TYPE', count(*) FILTER (WHERE p = '1-URGENT') FROM d)""")
def distribution_row_rules(t: Tables) -> DataFrame:
    from tidemark.operators import quality

    rows = t.orders.select(
        F.col("o_custkey").alias("security_id"), F.lit("T").alias("ticker"), F.to_date("o_orderdate").alias("ex_date"),
        F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("cash_amount"),
        F.when(F.col("o_orderpriority") == "5-LOW", "USD").alias("currency"), F.when(F.col("o_orderpriority") != "1-URGENT", "CASH_DISTRIBUTION").otherwise("?").alias("distribution_type"),
    )
    return quality.rule_counts(rows, {n: r for n, r in quality.distribution_row_rules().items() if n != "PROVENANCE"})


@query("as_of_filter", f"WITH {FILINGS} SELECT accession_number, form FROM filed WHERE available <= DATE '1999-12-31'")
def as_of_filter(t: Tables) -> DataFrame:
    return keys.as_of_filter(filings(t), "source_publication_date", day("1999-12-31")).select("accession_number", "form")
