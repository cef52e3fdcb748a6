"""Row-level gates (DQ-01 .. DQ-14): counts, quarantine splits, fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import TableContract
from tidemark.functions import is_finite


def holds(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-01. Key groups with more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")).filter("key_rows > 1")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-02. Rows with a NULL key part."""
    test = F.lit(False)
    for k in keys:
        test = test | F.col(k).isNull()
    return df.filter(test)


def nonfinite_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """DQ-03. One row with a count of NaN/infinite values per double column."""
    names = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)])
    return df.agg(*[F.count_if(~is_finite(n)).alias(n) for n in names])


def schema_differences(df: DataFrame, schema: T.StructType) -> list[str]:
    """DQ-04. Exact ordered names and types; empty when equal."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if have == want:
        return []
    return [f"expected {w}, found {h}" for w, h in zip(want, have) if w != h] + [
        f"missing {w}" for w in want[len(have):]
    ] + [f"unexpected {h}" for h in have[len(want):]]


def is_empty(df: DataFrame) -> bool:
    """DQ-05."""
    return df.isEmpty()


def missing_provenance(df: DataFrame, column: str = "source_retrieved_at_utc") -> DataFrame:
    """DQ-06."""
    return df.filter(F.col(column).isNull())


# Date-order rules by table; each is TRUE for a violating row.
DATE_RULES = {
    "company_facts": {"FILED_BEFORE_PERIOD_END": "filed_date < period_end"},
    "fundamental_factors": {"FACTOR_USES_UNAVAILABLE_FILING": "filing_available_date > factor_as_of_date"},
    "short_interest": {
        "PUBLICATION_BEFORE_SETTLEMENT": "publication_date < settlement_date or source_publication_date < settlement_date"
    },
    "institutional_holdings": {"PUBLIC_BEFORE_FILING": "source_publication_date < filing_date"},
    "insider_transactions": {"NO_FILING_PROVENANCE": "filing_date is null or accession_number is null"},
}


def rule_counts(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """DQ-07/08/09. (rule, violations), all rules in one pass."""
    exprs = {name: F.expr(r) if isinstance(r, str) else r for name, r in rules.items()}
    one = df.agg(*[F.count_if(holds(r)).alias(name) for name, r in exprs.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in exprs])
    return one.select(F.inline(pairs))


def benchmark_row_rules() -> dict[str, Column]:
    """DQ-09. Violations of a benchmark return row."""
    c = F.col
    bad = lambda ok: ~holds(ok)
    return {
        "NOT_CERTIFIED": bad(c("certification_status") == "CERTIFIED"),
        "IDENTITY": c("ticker").isNull() | c("benchmark_role").isNull(),
        "RAW_CLOSE": bad(is_finite("raw_close") & (c("raw_close") > 0)),
        "SPLIT_FACTOR": bad(is_finite("split_factor") & (c("split_factor") > 0)),
        "CASH": bad(is_finite("cash_distribution") & (c("cash_distribution") >= 0)),
        "CURRENCY": bad(c("currency") == "USD"),
        "PRICE_RETURN": bad(is_finite("price_return")),
        "DISTRIBUTION_RETURN": bad(is_finite("distribution_return")),
        "TOTAL_RETURN": bad(is_finite("total_return") & (c("total_return") > -1)),
        "RECONCILIATION": bad(F.abs(c("total_return") - c("price_return") - c("distribution_return")) <= 0.0001),
        "INDEX": bad(is_finite("total_return_index") & (c("total_return_index") > 0)),
        "LINEAGE": bad(c("distribution_lineage_sha256").rlike(r"\A[0-9a-f]{64}\z"))
        | bad(c("corporate_action_lineage_sha256").rlike(r"\A[0-9a-f]{64}\z")),
        "PROVENANCE": c("source_locator").isNull() | c("source_revision").isNull()
        | c("source_retrieved_at_utc").isNull() | c("known_at_utc").isNull() | c("certified_at_utc").isNull(),
    }


def distribution_row_rules() -> dict[str, Column]:
    """DQ-09. Violations of a distribution row."""
    c = F.col
    bad = lambda ok: ~holds(ok)
    return {
        "IDENTITY": c("security_id").isNull() | c("ticker").isNull() | c("ex_date").isNull(),
        "CASH": bad(is_finite("cash_amount") & (c("cash_amount") > 0)),
        "CURRENCY": bad(c("currency") == "USD"),
        "TYPE": bad(c("distribution_type") == "CASH_DISTRIBUTION"),
        "PROVENANCE": c("distribution_id").isNull() | c("source_locator").isNull() | c("source_revision").isNull()
        | c("source_retrieved_at_utc").isNull() | c("known_at_utc").isNull() | c("certified_at_utc").isNull(),
    }


def history_over_limit(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """DQ-10. Keys with more than ``n`` rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > n)


def evidence_rules() -> dict[str, Column]:
    """DQ-11. Evidence fields that must be present."""
    fields = ("evidence_id", "security_id", "evidence_kind", "known_at_utc", "revision", "source_locator")
    return {f.upper(): F.col(f).isNull() | (F.col(f).cast("string") == "") for f in fields}


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """DQ-13. (good, bad); bad rows carry ``reject_reasons``."""
    reasons = F.array_compact(F.array(*[F.when(holds(r), F.lit(name)) for name, r in rules.items()]))
    marked = df.withColumn("reject_reasons", reasons)
    good = marked.filter(F.size("reject_reasons") == 0).drop("reject_reasons")
    return good, marked.filter(F.size("reject_reasons") > 0)


def contract_rules(contract: TableContract) -> dict[str, Column]:
    """DQ-02, DQ-03, DQ-06: the row rules of one table, true where a row breaks one."""
    key_null = F.lit(False)
    for k in contract.key:
        key_null = key_null | F.col(k).isNull()
    rules: dict[str, Column] = {f"NON_FINITE_{n.upper()}": ~is_finite(n) for n in contract.double_columns}
    if not contract.null_key_allowed:
        rules["NULL_KEY"] = key_null
    if contract.point_in_time:
        rules["MISSING_PROVENANCE"] = F.col("source_retrieved_at_utc").isNull()
    return rules


def contract_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """DQ-01..03, DQ-06 for one table: (rule, violations)."""
    rules = contract_rules(contract)
    rows = rule_counts(df, rules) if rules else None
    duplicates = duplicate_keys(df, contract.key).agg(
        F.coalesce(F.sum(F.col("key_rows") - 1), F.lit(0)).cast("bigint").alias("violations")
    ).select(F.lit("DUPLICATE_KEY").alias("rule"), "violations")
    return duplicates if rows is None else rows.unionByName(duplicates)


def metrics_disagreements(claimed: DataFrame, actual: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """DQ-14. Long rows (key, metric, claimed, actual) where a claim is wrong."""
    a = claimed.select(F.col(key), *[F.col(c).cast("string").alias(f"_c_{c}") for c in columns])
    b = actual.select(F.col(key), *[F.col(c).cast("string").alias(f"_a_{c}") for c in columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(f"_c_{c}").alias("claimed"), F.col(f"_a_{c}").alias("actual"))
        for c in columns
    ])
    return a.join(b, key, "full").select(key, F.inline(pairs)).filter(~F.col("claimed").eqNullSafe(F.col("actual")))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """AGG-20. Order-independent identity: rows, schema text, xor and sum of row hashes."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in df.columns]
    text = F.concat_ws("\x1f", *parts)
    digest = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")
    return df.select(digest.alias("_h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor("_h"), F.lit(0)).cast("bigint").alias("hash_xor"),
        F.coalesce(F.sum(F.col("_h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
    ).withColumn("schema", F.lit(df.schema.simpleString()))
