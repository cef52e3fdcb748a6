"""Registrant submissions, company facts and the concept map (SRC-06, SRC-07, SRC-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import blank_to_null, cik10, finite_number, parse_source_date, parse_utc
from tidemark.sources.rejects import Rejects, read_documents

__all__ = [
    "read_submissions", "explode_registrants", "explode_filings", "read_company_facts", "explode_company_facts",
    "read_concept_map", "SUBMISSIONS_SCHEMA", "FACTS_SCHEMA",
]

# Layout of the registrant and fact documents.
SUBMISSIONS_SCHEMA = (
    "cik string, name string, sic string, tickers array<string>, filings struct<recent: struct<"
    "accessionNumber: array<string>, filingDate: array<string>, reportDate: array<string>, "
    "acceptanceDateTime: array<string>, form: array<string>, primaryDocument: array<string>, "
    "items: array<string>, fileNumber: array<string>, filmNumber: array<string>>>"
)
FACTS_SCHEMA = (
    "cik string, entityName string, facts map<string, map<string, struct<label: string, description: string, "
    "units: map<string, array<struct<`start`: string, `end`: string, val: string, accn: string, fy: bigint, "
    "fp: string, form: string, filed: string, frame: string>>>>>>"
)
_FILING_ARRAYS = (
    ("accessionNumber", "accession_number"), ("filingDate", "filing_date"), ("reportDate", "report_date"),
    ("acceptanceDateTime", "acceptance"), ("form", "form"), ("primaryDocument", "primary_document"),
    ("items", "items"), ("fileNumber", "file_number"), ("filmNumber", "film_number"),
)


def read_submissions(spark: SparkSession, path: str, rejects: Rejects | None = None, lines: bool = False) -> DataFrame:
    """SRC-06. One row per registrant document; ``lines``: one document per line, splittable."""
    return read_documents(spark, path, SUBMISSIONS_SCHEMA, "submissions", rejects, lines)


def explode_registrants(documents: DataFrame) -> DataFrame:
    """(cik, registrant_name, sic, ticker, ticker_position), one row per listed ticker."""
    return documents.select(
        cik10("cik").alias("cik"), F.trim(F.coalesce("name", F.lit(""))).alias("registrant_name"),
        blank_to_null("sic").alias("sic"), F.posexplode("tickers").alias("ticker_position", "ticker"),
    ).select("cik", "registrant_name", "sic", F.upper(F.trim("ticker")).alias("ticker"), "ticker_position")


def explode_filings(documents: DataFrame) -> DataFrame:
    """SRC-06. Parallel arrays to filing rows; the accession array sets the length."""
    recent = F.col("filings.recent")
    padded = F.slice(
        F.arrays_zip(*[F.coalesce(recent[a], F.array().cast("array<string>")).alias(a) for a, _ in _FILING_ARRAYS]), 1, F.size(recent["accessionNumber"])
    )
    rows = documents.filter(recent["accessionNumber"].isNotNull()).select(
        cik10("cik").alias("cik"), F.explode(padded).alias("_f")
    )
    text = lambda a: blank_to_null(F.col(f"_f.{a}"))
    return rows.select(
        "cik", F.trim(F.col("_f.accessionNumber")).alias("accession_number"),
        parse_source_date("_f.filingDate").alias("filing_date"), parse_source_date("_f.reportDate").alias("report_date"),
        parse_utc("_f.acceptanceDateTime").alias("acceptance_datetime_utc"),
        F.trim(F.coalesce("_f.form", F.lit(""))).alias("form"), text("primaryDocument").alias("primary_document"),
        text("items").alias("items"), text("fileNumber").alias("file_number"), text("filmNumber").alias("film_number"),
    )


def read_company_facts(spark: SparkSession, path: str, rejects: Rejects | None = None, lines: bool = False) -> DataFrame:
    """SRC-07. One row per document, facts still nested; ``lines``: one document per line, splittable."""
    return read_documents(spark, path, FACTS_SCHEMA, "company_facts", rejects, lines)


def explode_company_facts(documents: DataFrame) -> DataFrame:
    """SRC-07. Nested facts to long rows (taxonomy, concept, unit, observation)."""
    concepts = documents.select(cik10("cik").alias("cik"), F.explode("facts").alias("taxonomy", "_c"))
    details = concepts.select("cik", "taxonomy", F.explode("_c").alias("concept", "_d"))
    units = details.select(
        "cik", "taxonomy", "concept", blank_to_null("_d.label").alias("label"),
        blank_to_null("_d.description").alias("description"), F.explode("_d.units").alias("unit", "_u"),
    )
    o = units.select("cik", "taxonomy", "concept", "label", "description", "unit", F.explode("_u").alias("_o"))
    return o.select(
        "cik", "taxonomy", "concept", "label", "description", "unit", finite_number("_o.val").alias("value"),
        F.col("_o.fy").alias("fiscal_year"), blank_to_null("_o.fp").alias("fiscal_period"),
        blank_to_null("_o.form").alias("form"), parse_source_date("_o.filed").alias("filed_date"),
        parse_source_date("_o.start").alias("period_start"), parse_source_date("_o.end").alias("period_end"),
        blank_to_null("_o.frame").alias("frame"), F.trim(F.coalesce("_o.accn", F.lit(""))).alias("accession_number"),
    )


def read_concept_map(spark: SparkSession, path: str, rejects: Rejects | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-13. (target, concept, concept_rank) and (taxonomy, taxonomy_rank)."""
    schema = "version string, taxonomy_precedence array<string>, concepts map<string, array<string>>"
    doc = read_documents(spark, path, schema, "concept_map", rejects)
    concepts = doc.select("version", F.explode("concepts").alias("target", "_l")).select(
        "version", "target", F.posexplode("_l").alias("concept_rank", "concept")
    )
    taxonomies = doc.select(F.posexplode("taxonomy_precedence").alias("taxonomy_rank", "taxonomy"))
    return concepts, taxonomies
