"""Coverage of the eligible universe and of the enrichment domains (AGG-11, AGG-15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.stats import side_by_side


def coverage_states(
    universe: DataFrame, observed: DataFrame, *, key: str, date: str, expected: Column, valid: Column,
    invalid: DataFrame | None = None, failures: DataFrame | None = None, quarantined: DataFrame | None = None,
) -> DataFrame:
    """AGG-11. Each eligible key in exactly one state with its reason.

    ``observed`` holds bars; ``invalid`` (key, reason) rejected rows of the session,
    ``failures`` (key) exhausted requests, ``quarantined`` (date) bad sessions.
    Bars are reduced to one row per key before the join.
    """
    facts = observed.groupBy(key).agg(
        F.max(date).alias("_latest"), F.bool_or((F.col(date) == expected) & valid).alias("_valid")
    )
    out = universe.join(facts, key, "left")
    if invalid is not None:
        out = out.join(invalid.groupBy(key).agg(F.min("reason").alias("_invalid")), key, "left")
    else:
        out = out.withColumn("_invalid", F.lit(None).cast("string"))
    if failures is not None:
        out = out.join(failures.select(key).distinct().withColumn("_failed", F.lit(True)), key, "left")
    else:
        out = out.withColumn("_failed", F.lit(None).cast("boolean"))
    if quarantined is not None:
        bad = quarantined.filter(F.col(date) == expected).agg((F.count(F.lit(1)) > 0).alias("_bad"))
        out = out.withColumn("_quarantined", bad.scalar())  # one value, computed once beside the plan
    else:
        out = out.withColumn("_quarantined", F.lit(False))
    ok = F.coalesce(F.col("_valid"), F.lit(False))
    stale = F.col("_latest") < expected
    state = (
        F.when(ok, "VALID").when(F.col("_invalid").isNotNull(), "INVALID").when(F.col("_quarantined"), "QUARANTINED")
        .when(stale, "STALE").otherwise("MISSING")
    )
    reason = (
        F.when(ok, F.lit(None).cast("string")).when(F.col("_invalid").isNotNull(), F.col("_invalid"))
        .when(F.col("_quarantined"), F.lit("QUARANTINED_COMMON_MODE_SESSION"))
        .when(stale, F.concat(F.lit("STALE_SOURCE_MAX_SESSION_"), F.col("_latest").cast("string")))
        .when(F.coalesce("_failed", F.lit(False)), F.lit("PROVIDER_RETRIES_EXHAUSTED"))
        .otherwise(F.lit("MISSING_CURRENT_SESSION_ROW"))
    )
    return out.select(*universe.columns, state.alias("state"), reason.alias("rejection_code"))


def coverage_diagnostic(states: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """AGG-11. Counts over (), (dimension, state) for each dimension, (state) and (reason).

    One grouping-sets aggregation; ``grouping`` names the set of each row.
    """
    named = [F.coalesce(F.nullif(F.col(d), F.lit("")), F.lit("UNKNOWN")).alias(d) for d in dimensions]
    rows = states.select(*named, "state", "rejection_code")
    columns = [*dimensions, "state", "rejection_code"]
    sets = [[], ["state"], ["rejection_code"], *[[d, "state"] for d in dimensions]]
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id(*[F.col(c) for c in columns]).alias("_gid"), F.count(F.lit(1)).alias("securities"),
        F.count_if(F.col("state") == "VALID").alias("valid_securities"),
    )
    full = (1 << len(columns)) - 1
    label = F.lit("total")
    for s in sets[1:]:
        gid = full - sum(1 << (len(columns) - 1 - columns.index(c)) for c in s)
        label = F.when(F.col("_gid") == gid, F.lit("+".join(s))).otherwise(label)
    return out.withColumn("grouping", label).filter(
        (F.col("grouping") != "rejection_code") | F.col("rejection_code").isNotNull()
    ).select("grouping", *columns, "securities", "valid_securities")


def domain_coverage(tables: dict[str, DataFrame], *, ids: str = "security_id") -> DataFrame:
    """AGG-15. (domain, status, rows, securities, latest) with one aggregation per table."""
    # Domain, its table and the date that shows how recent it is.
    domains = (
        ("fundamentals", "fundamentals_quarterly", "filing_date"), ("filings_and_events", "filings", "filing_date"),
        ("insider_transactions", "insider_transactions", "filing_date"),
        ("institutional_ownership", "institutional_holdings", "report_period"),
        ("short_interest", "short_interest", "settlement_date"), ("security_master", "security_master", None),
    )
    out = None
    for domain, table, date in domains:
        df = tables[table]
        by_id = df.groupBy(ids).agg(F.count(F.lit(1)).alias("n"), (F.max(date) if date else F.lit(None).cast("date")).alias("d"))
        row = by_id.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"), F.count(ids).alias("securities"), F.max("d").alias("latest")
        ).select(
            F.lit(domain).alias("domain"),
            F.when((F.col("rows") > 0) | F.lit(domain == "security_master"), "READY").otherwise("VALIDATION_FAILED").alias("status"),
            "rows", "securities", "latest",
        )
        out = row if out is None else out.unionByName(row)
    return out


def domain_warnings(master: DataFrame, quarters: DataFrame, holdings: DataFrame, facts: DataFrame) -> DataFrame:
    """AGG-15. One row of warning counts."""
    sic = F.when(F.col("sic").rlike(r"\A[0-9]+\z"), F.col("sic").cast("int"))
    parts = [
        master.agg(
            F.count_if(F.col("cik").isNull()).alias("unmapped_ciks"),
            F.count_if(F.col("mapping_status") == "UNRESOLVED_CIK_IDENTITY_CONFLICT").alias("unresolved_collisions"),
            F.count_if(sic.between(6000, 6799)).alias("financial_issuers"),
        ),
        quarters.agg(F.count_if(F.col("normalization_status") != "COMPLETE").alias("partial_quarters")),
        holdings.agg(F.count_if(F.col("security_mapping_method") == "UNIQUE_SEC_ISSUER_NAME").alias("name_mapped_positions")),
        facts.agg((F.count_if(F.col("taxonomy") == "ifrs-full") > 0).alias("has_ifrs")),
    ]
    return side_by_side(*parts)
