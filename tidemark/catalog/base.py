"""Registration and the stand-in views shared by the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import pin_utc

ENTRIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Driver tables of one directory, read lazily."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark, self.directory = pin_utc(spark), directory

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``function(tables)`` under ``name`` with its equivalent SQL."""
    def register(function: Callable[[Tables], DataFrame]):
        ENTRIES[name] = lambda spark, directory: function(Tables(spark, directory))
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def r6(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def listed(column: str) -> Column:
    return F.array_join(F.col(column), "|")


# ---- one bar per (user, day): error events carry a negated value, so some bars are invalid
BARS = """bars AS (
  SELECT user_id AS security_id, CAST(ts AS DATE) AS session_date, arg_min(v, event_id) AS open, max(v) AS high,
         min(v) AS low, arg_max(v, event_id) AS close, count(*) AS volume
  FROM (SELECT *, CASE WHEN event_type = 'error' THEN -value ELSE value END AS v FROM events) GROUP BY ALL)"""


def bars(t: Tables) -> DataFrame:
    signed = F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value"))
    return t.events.select("user_id", "ts", "event_id", signed.alias("v")).groupBy(
        F.col("user_id").alias("security_id"), F.to_date("ts").alias("session_date")
    ).agg(
        F.min_by("v", "event_id").alias("open"), F.max("v").alias("high"), F.min("v").alias("low"),
        F.max_by("v", "event_id").alias("close"), F.count(F.lit(1)).alias("volume"),
    )


VALID = "(open > 0 AND high > 0 AND low > 0 AND close > 0 AND volume >= 0 AND low <= high AND low <= least(open, close) AND high >= greatest(open, close))"

# ---- raw price feed: parts under three spellings, one bar per line item
FEED = """aliases AS (
  SELECT p_partkey AS security_id, 'P.' || p_partkey || '/A' AS ticker, u.source_symbol, u.priority
  FROM part, LATERAL (VALUES ('P.' || p_partkey || '/A', 0), ('P-' || p_partkey || '/A', 1), ('P.' || p_partkey || '-A', 2)) u(source_symbol, priority)),
feed AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'P.' || l_partkey || '/A' WHEN 'N' THEN 'P-' || l_partkey || '/A' ELSE 'P.' || l_partkey || '-A' END AS source_symbol,
         CAST(l_shipdate AS DATE) AS session_date, l_extendedprice AS open, l_extendedprice * (1 + l_tax) AS high,
         l_extendedprice * (1 - l_discount) AS low, CASE WHEN l_discount = 0.1 THEN 0.0 ELSE l_extendedprice END AS close,
         CAST(l_quantity AS BIGINT) AS volume,
         CASE l_linestatus WHEN 'O' THEN 'CHART_REFRESH' ELSE 'SNAPSHOT' END AS source_dataset,
         CAST(l_linenumber AS VARCHAR) AS source_revision, lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS observed_at_utc
  FROM lineitem),
splits AS (
  SELECT DISTINCT source_symbol, session_date AS event_date, '2:1' AS split_factor, source_dataset, '1' AS source_revision, '-' AS observed_at_utc
  FROM feed WHERE volume >= 45)"""


def securities(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("security_id"), F.concat(F.lit("P."), "p_partkey", F.lit("/A")).alias("ticker")
    )


def dealt_aliases(t: Tables) -> DataFrame:
    """Aliases dealt by symbol in joins: three rows of text a security, made of one pruned number.

    The planner judges them by the file's size and broadcasts a table a hundred times as large.
    """
    from tidemark.sources import alias_table

    return alias_table(securities(t)).hint("shuffle_hash")


def price_feed(t: Tables) -> DataFrame:
    k = F.col("l_partkey").cast("string")
    symbol = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("P."), k, F.lit("/A")))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("P-"), k, F.lit("/A")))
        .otherwise(F.concat(F.lit("P."), k, F.lit("-A")))
    )
    p = F.col("l_extendedprice")
    return t.lineitem.select(
        symbol.alias("source_symbol"), F.to_date("l_shipdate").alias("session_date"), p.alias("open"),
        (p * (1 + F.col("l_tax"))).alias("high"), (p * (1 - F.col("l_discount"))).alias("low"),
        F.when(F.col("l_discount") == 0.1, 0.0).otherwise(p).alias("close"), F.col("l_quantity").cast("bigint").alias("volume"),
        F.when(F.col("l_linestatus") == "O", "CHART_REFRESH").otherwise("SNAPSHOT").alias("source_dataset"),
        F.col("l_linenumber").cast("string").alias("source_revision"),
        F.lpad(F.col("l_orderkey").cast("string"), 12, "0").alias("observed_at_utc"),
    )


def split_feed(t: Tables) -> DataFrame:
    return price_feed(t).filter("volume >= 45").select(
        "source_symbol", F.col("session_date").alias("event_date"), F.lit("2:1").alias("split_factor"), "source_dataset",
        F.lit("1").alias("source_revision"), F.lit("-").alias("observed_at_utc"),
    ).distinct()


# ---- orders as filings
FILINGS = """filings AS (
  SELECT 'C' || o_custkey AS security_id, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
         lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '-' || strftime(o_orderdate, '%y') || '-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS accession_number,
         CASE o_orderpriority WHEN '1-URGENT' THEN '8-K' WHEN '2-HIGH' THEN 'SC 13D' WHEN '3-MEDIUM' THEN '424B5' WHEN '4-NOT SPECIFIED' THEN 'S-3' ELSE '10-Q' END AS form,
         CAST(o_orderdate AS DATE) AS filing_date,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate + to_seconds(CAST(floor(o_totalprice / 7) AS BIGINT)) END AS acceptance_datetime_utc,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) - 40 END AS report_date,
         CASE o_orderstatus WHEN 'F' THEN '2.02, 5.02' WHEN 'O' THEN '2.01,9.99,,1.05' ELSE '2.02' END AS items,
         CASE WHEN o_orderstatus <> 'O' THEN 'doc' || o_orderkey || '.htm' END AS primary_document,
         TIMESTAMP '2002-01-01 00:00:00' AS retrieved
  FROM orders),
filed AS (
  SELECT *, 'https://www.sec.gov/Archives/edgar/data/' || CAST(cik AS BIGINT) || '/' || replace(accession_number, '-', '') || '/' || coalesce(primary_document, '') AS primary_document_url,
         CASE WHEN acceptance_datetime_utc IS NULL THEN filing_date + 1
              WHEN CAST(timezone('America/New_York', timezone('UTC', acceptance_datetime_utc)) AS TIME) <= TIME '16:00:00'
                THEN CAST(timezone('America/New_York', timezone('UTC', acceptance_datetime_utc)) AS DATE)
              ELSE CAST(timezone('America/New_York', timezone('UTC', acceptance_datetime_utc)) AS DATE) + 1 END AS available
  FROM filings)"""


#: accession number that stays apart for any order: the millions of its key as the filing agent
AGENT_ACCESSION = "lpad(CAST(o_orderkey // 1000000 AS VARCHAR), 10, '0') || '-' || strftime(o_orderdate, '%y') || '-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0')"

AGENT_FILINGS = FILINGS.replace("lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '-' || strftime(o_orderdate, '%y') || '-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0')", AGENT_ACCESSION)


def agent_accession() -> Column:
    """:data:`AGENT_ACCESSION` of an order."""
    return F.concat_ws("-", F.lpad(F.expr("cast(o_orderkey div 1000000 as string)"), 10, "0"), F.date_format("o_orderdate", "yy"),
                       F.lpad((F.col("o_orderkey") % 1_000_000).cast("string"), 6, "0"))


def raw_filings(t: Tables, accession: Column | None = None) -> DataFrame:
    """``accession`` replaces the number made of customer, year and order."""
    o = t.orders
    status, cust = F.col("o_orderstatus"), F.lpad(F.col("o_custkey").cast("string"), 10, "0")
    forms = {"1-URGENT": "8-K", "2-HIGH": "SC 13D", "3-MEDIUM": "424B5", "4-NOT SPECIFIED": "S-3"}
    form = F.lit("10-Q")
    for priority, name in forms.items():
        form = F.when(F.col("o_orderpriority") == priority, name).otherwise(form)
    filed = F.to_date("o_orderdate")
    accepted = F.timestamp_seconds(F.unix_date(filed).cast("bigint") * 86400 + F.floor(F.col("o_totalprice") / 7))
    return o.select(
        F.concat(F.lit("C"), "o_custkey").alias("security_id"), cust.alias("cik"),
        (F.concat_ws("-", cust, F.date_format("o_orderdate", "yy"), F.lpad(F.col("o_orderkey").cast("string"), 6, "0")) if accession is None else accession).alias("accession_number"),
        form.alias("form"), filed.alias("filing_date"),
        F.when(~((status == "P") & (F.col("o_orderpriority") == "1-URGENT")), accepted).alias("acceptance_datetime_utc"),
        F.when(status == "F", F.date_sub(filed, 40)).alias("report_date"),
        F.when(status == "F", "2.02, 5.02").when(status == "O", "2.01,9.99,,1.05").otherwise("2.02").alias("items"),
        F.when(status != "O", F.concat(F.lit("doc"), "o_orderkey", F.lit(".htm"))).alias("primary_document"),
    )


RETRIEVED = "2002-01-01 00:00:00"


def filings(t: Tables, accession: Column | None = None) -> DataFrame:
    """Contract-shaped filings; attribution is by the filer, so every form is kept here."""
    from tidemark.functions import available_date, filing_url, pit_columns

    return raw_filings(t, accession).select(
        "*", filing_url("cik", "accession_number", "primary_document").alias("primary_document_url"),
        F.col("form").endswith("/A").alias("is_amendment"), F.lit(None).cast("string").alias("file_number"),
        F.lit(None).cast("string").alias("film_number"),
        *pit_columns(F.coalesce("report_date", "filing_date"), F.col("filing_date"), F.col("acceptance_datetime_utc"),
                     available_date("filing_date", "acceptance_datetime_utc"), F.lit(RETRIEVED).cast("timestamp")),
    )


def naive(column: str) -> Column:
    """UTC wall clock without a zone, as the SQL side has it."""
    return F.col(column).cast("timestamp_ntz").alias(column)
