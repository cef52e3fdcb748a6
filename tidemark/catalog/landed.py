"""Driver tables landed as files, read back through every reader and published by the writers.

Some lines and documents are broken on purpose, a fixed share of the keys of each table; they
must come out as rejects and nowhere else.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import sources
from tidemark.catalog.base import FEED, Tables, day, dealt_aliases, price_feed, query, securities, split_feed
from tidemark.contracts import PRICES, SPLITS
from tidemark.plans import market
from tidemark.session import scratch_table

LISTED, FILED, SUPPLIED, SHORTED, SCHEDULED = 37, 41, 13, 29, 17  # every such key is broken


def raw_csv(t: Tables, df: DataFrame, name: str, sep: str) -> str:
    """Delimited files, each with a header, whose values are written as they are, separators included."""
    path, header = scratch_table(t.spark, name), sep.join(df.columns)

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = [header]
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(head, pa.string()), batch.column(0).cast(pa.string())])], names=["value"])
                head = []

    df.select(F.concat_ws(sep, *[F.col(f"`{c}`") for c in df.columns]).alias("value")).mapInArrow(with_header, "value string").write.text(path)
    return path


def documents(t: Tables, df: DataFrame, name: str, document: Column, broken: Column) -> str:
    """One JSON document per line; the broken ones are cut short."""
    path = scratch_table(t.spark, name)
    text = F.to_json(document)
    df.select(F.when(broken, F.substring(text, F.lit(1), F.length(text) - 3)).otherwise(text).alias("value")).write.text(path)
    return path


def hit(column: str, every: int) -> Column:
    return F.col(column) % every == 0


def text_of(column: str) -> Column:
    return F.col(column).cast("string")


# ---- readers

def directory_feed(t: Tables, rejects: sources.Rejects) -> DataFrame:
    name = F.when(hit("c_custkey", LISTED), F.concat("c_name", F.lit("|x"))).otherwise(F.col("c_name"))
    fields = {"Symbol": F.concat(F.lit("C"), text_of("c_custkey")), "Security Name": name, "Market Category": F.lit("Q"), "Test Issue": F.when(F.col("c_nationkey") == 3, "Y").otherwise("N"),
              "Financial Status": F.lit("N"), "Round Lot Size": F.lit("100"), "ETF": F.lit("N"), "NextShares": F.lit("N")}
    path = raw_csv(t, t.customer.select(*[c.alias(n) for n, c in fields.items()]), "directory", "|")
    return sources.read_directory_feed(t.spark, path, sources.NASDAQ_FEED_COLUMNS, rejects)[0].select(
        F.col("Symbol").alias("symbol"), F.col("`Security Name`").alias("name"), F.col("`Test Issue`").alias("test_issue"))


def tab_table(t: Tables, rejects: sources.Rejects) -> DataFrame:
    status = F.when(hit("o_orderkey", FILED), F.concat("o_orderstatus", F.lit("\tx"))).otherwise(F.col("o_orderstatus"))
    rows = t.orders.select(text_of("o_custkey").alias("CUSTOMER"), text_of("o_orderkey").alias("ORDER_ID"), status.alias("STATUS"), F.lit("-").alias("UNUSED"))
    path = raw_csv(t, rows, "tsv", "\t")
    directory, name = path.rsplit("/", 1)
    return sources.read_tsv_table(t.spark, directory, name, ["ORDER_ID", "CUSTOMER", "STATUS"], rejects)


def registry(t: Tables, rejects: sources.Rejects) -> tuple[DataFrame, DataFrame]:
    """Names by supplier; suppliers of nation 7 lack a name, those of nation 9 share one key."""
    name = F.when(hit("s_suppkey", SUPPLIED), "a,b").when(F.col("s_nationkey") == 7, "").otherwise(F.lower("s_name"))
    key = F.when(F.col("s_nationkey") == 9, "shared").otherwise(F.concat(F.lit("s"), text_of("s_suppkey")))
    path = raw_csv(t, t.supplier.select(key.alias("cusip"), name.alias("security_id"), text_of("s_suppkey").alias("note")), "registry", ",")
    return sources.read_registry(t.spark, path, ["cusip", "security_id", "note"], ["cusip"], required=["security_id"], rejects=rejects)


def short_interest(t: Tables, rejects: sources.Rejects) -> DataFrame:
    record = F.struct(F.concat(F.lit("p"), text_of("p_partkey")).alias("symbolCode"), F.lit("2026-01-15").alias("settlementDate"),
                      F.col("p_size").alias("currentShortPositionQuantity"), F.lit("10").alias("previousShortShareNumber"))
    path = documents(t, t.part, "short", record, hit("p_partkey", SHORTED))
    return sources.read_short_interest(t.spark, path, "lines", rejects)


def schedule(t: Tables, rejects: sources.Rejects) -> tuple[DataFrame, DataFrame]:
    """Dates of orders by key; every eleventh is published before its settlement."""
    settled = F.to_date("o_orderdate")
    published = F.when(hit("o_orderkey", 11), F.date_sub(settled, 1)).otherwise(F.date_add(settled, 9))
    url = F.when(hit("o_orderkey", SCHEDULED), "u,v").otherwise(text_of("o_orderkey"))
    path = raw_csv(t, t.orders.select(F.date_format(settled, "yyyy-MM-dd").alias("settlement_date"), F.date_format(published, "dd-MMM-yyyy").alias("publication_date"), url.alias("source_url")), "schedule", ",")
    return sources.read_publication_schedule(t.spark, path, day("2001-09-30"), rejects)


def submissions(t: Tables, rejects: sources.Rejects) -> DataFrame:
    k = text_of("c_custkey")
    recent = F.struct(F.array(F.concat(F.lit("A-"), k), F.concat(F.lit("B-"), k)).alias("accessionNumber"), F.array(F.lit("1998-01-05"), F.lit("06-FEB-1998")).alias("filingDate"),
                      F.array(F.lit(" 10-K "), F.lit("8-K")).alias("form"), F.array(F.lit("a.htm")).alias("primaryDocument"))
    document = F.struct(k.alias("cik"), F.col("c_name").alias("name"), F.array(F.concat(F.lit("t"), k)).alias("tickers"), F.struct(recent.alias("recent")).alias("filings"))
    path = documents(t, t.customer, "submissions", document, hit("c_custkey", LISTED))
    return sources.explode_filings(sources.read_submissions(t.spark, path, rejects, lines=True))


def company_facts(t: Tables, rejects: sources.Rejects) -> DataFrame:
    fact = lambda value, filed: F.struct(value.alias("val"), F.lit("1997-12-31").alias("end"), F.lit(1997).alias("fy"), F.lit("FY").alias("fp"), F.lit(filed).alias("filed"), F.concat(F.lit("A-"), text_of("c_custkey")).alias("accn"))
    units = F.create_map(F.lit("USD"), F.array(fact(F.col("c_acctbal"), "1998-01-05"), fact(F.col("c_acctbal") * 2, "1998-02-06")))
    facts = F.create_map(F.lit("us-gaap"), F.create_map(F.lit("Assets"), F.struct(F.lit("Assets").alias("label"), units.alias("units"))))
    path = documents(t, t.customer, "facts", F.struct(text_of("c_custkey").alias("cik"), facts.alias("facts")), hit("c_custkey", LISTED))
    return sources.explode_company_facts(sources.read_company_facts(t.spark, path, rejects, lines=True))


def charts(t: Tables, rejects: sources.Rejects) -> DataFrame:
    p = F.col("p_retailprice")
    bar = F.struct(*[F.array(p, p + 1, F.lit(None)).alias(c) for c in ("open", "high", "low", "close")], F.array(F.lit(5.0), F.lit(6.0), F.lit(7.0)).alias("volume"))
    result = F.struct(F.struct(F.concat(F.lit("p"), text_of("p_partkey")).alias("symbol"), F.lit("USD").alias("currency")).alias("meta"),
                      F.array(F.lit(86_400 * 10_000), F.lit(86_400 * 10_001), F.lit(86_400 * 10_002)).alias("timestamp"),
                      F.struct(F.array(bar).alias("quote"), F.array(F.struct(F.array(p, p, p).alias("adjclose"))).alias("adjclose")).alias("indicators"))
    path = documents(t, t.part, "charts", F.struct(F.struct(F.array(result).alias("result")).alias("chart")), hit("p_partkey", SHORTED))
    return sources.explode_chart_prices(sources.read_charts(t.spark, path, rejects, lines=True), day("2030-01-01"))


@query("landed_directory_feed", f"SELECT 'C' || c_custkey AS symbol, c_name AS name, CASE c_nationkey WHEN 3 THEN 'Y' ELSE 'N' END AS test_issue FROM customer WHERE c_custkey % {LISTED} <> 0")
def landed_directory_feed(t: Tables) -> DataFrame:
    """SRC-03 over landed lines."""
    return directory_feed(t, sources.Rejects(t.spark))


@query("landed_tab_table", f"SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_ID, CAST(o_custkey AS VARCHAR) AS CUSTOMER, o_orderstatus AS STATUS FROM orders WHERE o_orderkey % {FILED} <> 0")
def landed_tab_table(t: Tables) -> DataFrame:
    """SRC-08 over landed lines, columns by name."""
    return tab_table(t, sources.Rejects(t.spark))


_REGISTRY = f"""WITH r AS (SELECT CASE s_nationkey WHEN 9 THEN 'SHARED' ELSE 'S' || s_suppkey END AS cusip, CASE s_nationkey WHEN 7 THEN '' ELSE lower(s_name) END AS security_id, CAST(s_suppkey AS VARCHAR) AS note
  FROM supplier WHERE s_suppkey % {SUPPLIED} <> 0), n AS (SELECT *, count(*) OVER (PARTITION BY cusip) > 1 AS repeated FROM r)"""


@query("landed_registry", f"{_REGISTRY} SELECT cusip, security_id, note FROM n WHERE security_id <> '' AND NOT repeated")
def landed_registry(t: Tables) -> DataFrame:
    """SRC-05 over landed lines: the good rows."""
    return registry(t, sources.Rejects(t.spark))[0]


@query("landed_registry_rejects", f"{_REGISTRY} SELECT cusip, note, CASE WHEN security_id = '' THEN 'BLANK_SECURITY_ID' ELSE '' END || CASE WHEN repeated THEN 'DUPLICATE_KEY' ELSE '' END AS reasons FROM n WHERE security_id = '' OR repeated")
def landed_registry_rejects(t: Tables) -> DataFrame:
    """SRC-05 over landed lines: rows that break a rule."""
    return registry(t, sources.Rejects(t.spark))[1].select("cusip", "note", F.array_join("reject_reasons", "").alias("reasons"))


@query("landed_short_interest", f"SELECT 'P' || p_partkey AS symbol, DATE '2026-01-15' AS settlement_date, CAST(p_size AS DOUBLE) AS current_short_shares, 10.0::DOUBLE AS previous_short_shares, CAST(p_size - 10 AS DOUBLE) AS short_change FROM part WHERE p_partkey % {SHORTED} <> 0")
def landed_short_interest(t: Tables) -> DataFrame:
    """SRC-09 over landed documents with old and new field names."""
    return short_interest(t, sources.Rejects(t.spark)).select("symbol", "settlement_date", "current_short_shares", "previous_short_shares", "short_change")


@query("landed_schedule", f"""WITH s AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS settlement_date, CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE 9 END AS publication_date FROM orders WHERE o_orderkey % {SCHEDULED} <> 0)
SELECT settlement_date, publication_date, publication_date < settlement_date AS early, count(*) AS rows FROM s WHERE publication_date <= DATE '2001-09-30' GROUP BY ALL""")
def landed_schedule(t: Tables) -> DataFrame:
    """SRC-12 over landed lines in two date spellings: good rows, and those published early."""
    good, early = schedule(t, sources.Rejects(t.spark))
    rows = good.withColumn("early", F.lit(False)).unionByName(early.drop("reject_reasons").withColumn("early", F.lit(True)))
    return rows.groupBy("settlement_date", "publication_date", "early").agg(F.count(F.lit(1)).alias("rows"))


@query("landed_submissions", f"""SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, a || c_custkey AS accession_number, d AS filing_date, form, doc AS primary_document
FROM customer, (VALUES ('A-', DATE '1998-01-05', '10-K', 'a.htm'), ('B-', DATE '1998-02-06', '8-K', NULL)) v(a, d, form, doc) WHERE c_custkey % {LISTED} <> 0""")
def landed_submissions(t: Tables) -> DataFrame:
    """SRC-06 over landed documents with arrays of unequal length."""
    return submissions(t, sources.Rejects(t.spark)).select("cik", "accession_number", "filing_date", "form", "primary_document")


@query("landed_company_facts", f"""SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, 'us-gaap' AS taxonomy, 'Assets' AS concept, 'USD' AS unit, round(c_acctbal * m, 4) AS value, d AS filed_date
FROM customer, (VALUES (1, DATE '1998-01-05'), (2, DATE '1998-02-06')) v(m, d) WHERE c_custkey % {LISTED} <> 0""")
def landed_company_facts(t: Tables) -> DataFrame:
    """SRC-07 over landed documents."""
    return company_facts(t, sources.Rejects(t.spark)).select("cik", "taxonomy", "concept", "unit", F.round("value", 4).alias("value"), "filed_date")


@query("landed_charts", f"""SELECT 'P' || p_partkey AS symbol, DATE '1970-01-01' + 10000 + k AS session_date, round(p_retailprice + k, 4) AS close, CAST(5 + k AS DOUBLE) AS volume
FROM part, (VALUES (0), (1)) v(k) WHERE p_partkey % {SHORTED} <> 0""")
def landed_charts(t: Tables) -> DataFrame:
    """SRC-10 over landed documents; bars with a missing value are skipped."""
    return charts(t, sources.Rejects(t.spark)).select("symbol", "session_date", F.round("close", 4).alias("close"), "volume")


_BROKEN = {"directory_feed": f"customer WHERE c_custkey % {LISTED} = 0", "tsv_table": f"orders WHERE o_orderkey % {FILED} = 0", "registry": f"supplier WHERE s_suppkey % {SUPPLIED} = 0",
           "short_interest": f"part WHERE p_partkey % {SHORTED} = 0", "publication_schedule": f"orders WHERE o_orderkey % {SCHEDULED} = 0", "submissions": f"customer WHERE c_custkey % {LISTED} = 0",
           "company_facts": f"customer WHERE c_custkey % {LISTED} = 0", "charts": f"part WHERE p_partkey % {SHORTED} = 0"}


@query("landed_rejects", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{r}' AS reader, count(*) AS records FROM {rows}" for r, rows in _BROKEN.items()) + ") WHERE records > 0")
def landed_rejects(t: Tables) -> DataFrame:
    """Malformed records of all readers in one reject table."""
    rejects = sources.Rejects(t.spark)
    for reader in (directory_feed, tab_table, registry, short_interest, schedule, submissions, company_facts, charts):
        reader(t, rejects)
    return rejects.frame().groupBy("reader").agg(F.count(F.lit(1)).alias("records"))


# ---- writers

def landed_feed(t: Tables) -> DataFrame:
    """The price feed landed as Parquet and scanned."""
    path = scratch_table(t.spark, "feed")
    feed = price_feed(t).withColumnRenamed("source_symbol", "symbol").withColumn("report_date", F.date_format("session_date", "yyyy-MM-dd"))
    feed.select("symbol", "report_date", "open", "high", "low", "close", "volume").write.parquet(path)
    aliases = dealt_aliases(t)
    return sources.scan_prices(t.spark, path, aliases, day("2001-09-30"), dataset="SNAPSHOT", revision="1", observed_at="-")


@query("published_prices", f"""WITH {FEED}, best AS (SELECT security_id, ticker, session_date, min(priority) AS p FROM feed JOIN aliases USING (source_symbol) WHERE session_date <= DATE '2001-09-30' GROUP BY ALL)
SELECT b.security_id, ticker, a.source_symbol, b.session_date, count(*) AS candidates FROM best b JOIN aliases a USING (security_id, ticker) JOIN feed f ON f.source_symbol = a.source_symbol AND f.session_date = b.session_date WHERE a.priority = b.p GROUP BY ALL""")
def published_prices(t: Tables) -> DataFrame:
    """SRC-01, JOI-02, SNK-01/02: landed prices, one row per security and session, published and read back twice."""
    aliases, scanned, out = dealt_aliases(t), landed_feed(t), scratch_table(t.spark, "prices")
    chosen = market.best_alias(scanned, aliases)
    sources.write_prices(chosen.select(*PRICES.columns).withColumn("security_id", F.col("security_id").cast("string")), out)
    read = sources.write_prices(t.spark.read.parquet(out), out)  # a published table is replaced by its next version
    offered = scanned.groupBy("source_symbol", "session_date").agg(F.count(F.lit(1)).alias("candidates"))
    return read.join(offered, ["source_symbol", "session_date"]).select(F.col("security_id").cast("bigint").alias("security_id"), "ticker", "source_symbol", "session_date", "candidates")


@query("published_splits", f"""WITH {FEED}, best AS (SELECT DISTINCT ON (security_id, event_date) security_id, ticker, a.source_symbol, event_date, split_factor FROM splits s JOIN aliases a USING (source_symbol) ORDER BY security_id, event_date, priority, a.source_symbol)
SELECT security_id, ticker, source_symbol, event_date, split_factor FROM best""")
def published_splits(t: Tables) -> DataFrame:
    """SRC-02, SNK-01/02: landed splits published and read back."""
    path, out, aliases = scratch_table(t.spark, "splits-in"), scratch_table(t.spark, "splits-out"), dealt_aliases(t)
    split_feed(t).select(F.col("source_symbol").alias("symbol"), F.col("event_date").alias("report_date"), "split_factor").write.parquet(path)
    good, _ = sources.scan_splits(t.spark, path, aliases, day("2030-01-01"), dataset="SNAPSHOT", revision="1", observed_at="-")
    best = market.best_alias(good, aliases, "event_date").withColumn("security_id", F.col("security_id").cast("string"))
    read = sources.write_splits(best.select(*SPLITS.columns), out)
    return read.select(F.col("security_id").cast("bigint").alias("security_id"), "ticker", "source_symbol", "event_date", "split_factor")


@query("refused_prices", f"""WITH {FEED}, r AS (SELECT security_id, session_date, close FROM feed JOIN aliases USING (source_symbol))
SELECT * FROM (SELECT 'DUPLICATE_KEY' AS rule, CAST(count(*) - count(DISTINCT (security_id, session_date)) AS BIGINT) AS violations, false AS visible FROM r
UNION ALL SELECT 'NON_FINITE_CLOSE', count(*) FILTER (close = 0), false FROM r) WHERE violations > 0""")
def refused_prices(t: Tables) -> DataFrame:
    """SNK-01: a feed with repeated keys and infinite closes is refused and never visible."""
    out = scratch_table(t.spark, "refused")
    rows = price_feed(t).join(sources.alias_table(securities(t)), "source_symbol").withColumn("close", F.when(F.col("close") == 0, F.lit(float("inf"))).otherwise(F.col("close")))
    broken = {}
    try:
        sources.write_prices(rows.select(*PRICES.columns).withColumn("security_id", F.col("security_id").cast("string")), out)
    except sources.ContractViolation as refused:
        broken = refused.broken
    files = t.spark._jvm.org.apache.hadoop.fs.Path(out)
    visible = files.getFileSystem(t.spark._jsc.hadoopConfiguration()).exists(files)
    return t.spark.createDataFrame([(rule, n, visible) for rule, n in broken.items()], "rule string, violations long, visible boolean")
