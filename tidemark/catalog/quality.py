"""Row checks, duplicates, statistics over whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import BARS, VALID, Tables, bars, day, listed, query, r6
from tidemark.functions import accession_ok, hex64_ok, is_invalid_ohlcv, ohlcv_invalid_reason
from tidemark.operators import keys, quality, stats

_OHLCV = """ohlcv AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN l_extendedprice * (1 + 2 * l_tax) ELSE l_extendedprice END AS open,
         l_extendedprice * (1 + nullif(l_tax, 0.03)) AS high, l_extendedprice * (1 - l_discount * 10) AS low,
         CASE WHEN l_linenumber = 7 THEN CAST('infinity' AS DOUBLE) ELSE l_extendedprice END AS close, l_quantity - 5 AS volume
  FROM lineitem),
checked AS (
  SELECT *, CASE
      WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL THEN 'NULL_OHLC'
      WHEN NOT isfinite(open) OR NOT isfinite(high) OR NOT isfinite(low) OR NOT isfinite(close) THEN 'NON_FINITE_OHLC'
      WHEN open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 THEN 'NON_POSITIVE_OHLC'
      WHEN volume IS NULL OR volume < 0 THEN 'INVALID_VOLUME'
      WHEN low > high OR low > least(open, close) OR high < greatest(open, close) THEN 'INVALID_OHLC_BOUNDS' END AS reason
  FROM ohlcv)"""


def ohlcv(t: Tables) -> DataFrame:
    p, tax = F.col("l_extendedprice"), F.col("l_tax")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linestatus") == "F", p * (1 + 2 * tax)).otherwise(p).alias("open"),
        (p * (1 + F.nullif(tax, F.lit(0.03)))).alias("high"), (p * (1 - F.col("l_discount") * 10)).alias("low"),
        F.when(F.col("l_linenumber") == 7, float("inf")).otherwise(p).alias("close"), (F.col("l_quantity") - 5).alias("volume"),
    )


@query("validity_reasons", f"WITH {_OHLCV} SELECT coalesce(reason, 'VALID') AS reason, count(*) AS n, count(*) FILTER (WHERE reason IS NOT NULL) AS invalid FROM checked GROUP BY 1")
def validity_reasons(t: Tables) -> DataFrame:
    rows = ohlcv(t).select(F.coalesce(ohlcv_invalid_reason(), F.lit("VALID")).alias("reason"), is_invalid_ohlcv().alias("bad"))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("invalid"))


@query("rejections_by_reason", f"""WITH {_OHLCV}, picked AS (
  SELECT reason, l_orderkey, row_number() OVER (PARTITION BY reason ORDER BY l_orderkey) AS rn FROM (SELECT DISTINCT reason, l_orderkey FROM checked WHERE reason IS NOT NULL))
SELECT c.reason, c.rejected_rows, s.samples FROM (SELECT reason, count(*) AS rejected_rows FROM checked WHERE reason IS NOT NULL GROUP BY 1) c
JOIN (SELECT reason, string_agg(CAST(l_orderkey AS VARCHAR), '|' ORDER BY l_orderkey) AS samples FROM picked WHERE rn <= 20 GROUP BY 1) s USING (reason)""")
def rejections_by_reason(t: Tables) -> DataFrame:
    rejected = ohlcv(t).withColumn("reason", ohlcv_invalid_reason()).filter("reason is not null")
    return stats.rejections_by_reason(rejected, "reason", "l_orderkey").withColumn("samples", listed("samples"))


@query("conflicting_groups", """SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_day FROM orders GROUP BY 1, 2
HAVING count(DISTINCT o_totalprice) > 1 OR count(DISTINCT o_orderstatus) > 1""")
def conflicting_groups(t: Tables) -> DataFrame:
    return keys.conflicting_groups(
        t.orders.withColumn("order_day", F.to_date("o_orderdate")), ["o_custkey", "order_day"], ["o_totalprice", "o_orderstatus"]
    )


@query("identical_duplicates", """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS identical_duplicates
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey, l_quantity)""")
def identical_duplicates(t: Tables) -> DataFrame:
    return keys.identical_duplicates(t.lineitem, ["l_partkey", "l_suppkey", "l_quantity"])


@query("collapse_identical", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_quantity FROM lineitem")
def collapse_identical(t: Tables) -> DataFrame:
    return keys.collapse_identical(t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus", "l_quantity"))


@query("dataset_stats", """SELECT count(*) AS rows, count(DISTINCT l_partkey) AS securities, CAST(min(l_shipdate) AS DATE) AS min_date,
  CAST(max(l_shipdate) AS DATE) AS max_date, count(*) FILTER (WHERE l_discount > 0.09) AS invalid_rows,
  count(*) - count(DISTINCT (l_partkey, CAST(l_shipdate AS DATE))) AS duplicate_rows,
  count(*) FILTER (WHERE CAST(l_shipdate AS DATE) > DATE '2001-06-30') AS after_cutoff FROM lineitem""")
def dataset_stats(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_partkey", F.to_date("l_shipdate").alias("d"), "l_discount")
    return stats.dataset_stats(rows, "l_partkey", "d", F.col("l_discount") > 0.09, day("2001-06-30"))


@query("duplicate_keys", "SELECT l_partkey, l_suppkey, count(*) AS key_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.lineitem, ["l_partkey", "l_suppkey"])


@query("null_keys", """SELECT o_orderkey, o_custkey, c_custkey FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c
ON o_custkey = c_custkey WHERE c_custkey IS NULL""")
def null_keys(t: Tables) -> DataFrame:
    funded = t.customer.filter("c_acctbal > 0").select("c_custkey")
    joined = t.orders.join(funded, F.col("o_custkey") == F.col("c_custkey"), "left")
    return quality.null_keys(joined.select("o_orderkey", "o_custkey", "c_custkey"), ["o_orderkey", "c_custkey"])


@query("nonfinite", """SELECT count(*) FILTER (WHERE NOT isfinite(a)) AS a, count(*) FILTER (WHERE NOT isfinite(b)) AS b FROM (
  SELECT CASE WHEN l_discount = 0 THEN CAST('infinity' AS DOUBLE) ELSE l_tax END AS a, CASE WHEN l_tax = 0 THEN CAST('nan' AS DOUBLE) ELSE nullif(l_discount, 0.05) END AS b FROM lineitem)""")
def nonfinite(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.when(F.col("l_discount") == 0, float("inf")).otherwise(F.col("l_tax")).alias("a"),
        F.when(F.col("l_tax") == 0, float("nan")).otherwise(F.nullif("l_discount", F.lit(0.05))).alias("b"),
    )
    return quality.nonfinite_counts(rows)


@query("date_rules", """WITH j AS (SELECT CAST(l_shipdate AS DATE) AS shipped, CAST(o_orderdate AS DATE) AS ordered, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'SHIPPED_BEFORE_ORDER' AS rule, count(*) FILTER (WHERE shipped < ordered) AS violations FROM j
UNION ALL SELECT 'SHIPPED_LATE', count(*) FILTER (WHERE shipped > ordered + 60) FROM j
UNION ALL SELECT 'OPEN_AT_END', count(*) FILTER (WHERE o_orderstatus = 'O' AND ordered > DATE '2001-07-01') FROM j""")
def date_rules(t: Tables) -> DataFrame:
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.to_date("l_shipdate").alias("shipped"), F.to_date("o_orderdate").alias("ordered"), "o_orderstatus"
    )
    return quality.rule_counts(j, {
        "SHIPPED_BEFORE_ORDER": "shipped < ordered", "SHIPPED_LATE": "shipped > date_add(ordered, 60)",
        "OPEN_AT_END": "o_orderstatus = 'O' and ordered > date'2001-07-01'",
    })


@query("accession_format", r"""SELECT regexp_full_match(a, '[0-9]{10}-[0-9]{2}-[0-9]{6}') AS well_formed, count(*) AS n, count(*) FILTER (WHERE regexp_full_match(sha256(a), '[0-9a-f]{64}')) AS hashed FROM (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') || CASE o_orderstatus WHEN 'P' THEN '' ELSE '-' END || strftime(o_orderdate, '%y') || '-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') || CASE o_orderpriority WHEN '5-LOW' THEN chr(10) ELSE '' END AS a FROM orders) GROUP BY 1""")
def accession_format(t: Tables) -> DataFrame:
    a = F.concat(
        F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.when(F.col("o_orderstatus") == "P", "").otherwise("-"),
        F.date_format("o_orderdate", "yy"), F.lit("-"), F.lpad(F.col("o_orderkey").cast("string"), 6, "0"),
        F.when(F.col("o_orderpriority") == "5-LOW", "\n").otherwise(""),
    )
    rows = t.orders.select(accession_ok(a).alias("well_formed"), hex64_ok(F.sha2(a, 256)).alias("h"))
    return rows.groupBy("well_formed").agg(F.count(F.lit(1)).alias("n"), F.count_if("h").alias("hashed"))


@query("quarantine", """SELECT reasons, count(*) AS n, round(sum(l_quantity), 6) AS quantity FROM (
  SELECT l_quantity, concat_ws('|', CASE WHEN l_discount > 0.08 THEN 'DISCOUNT' END, CASE WHEN l_tax > 0.07 THEN 'TAX' END, CASE WHEN l_quantity < 3 THEN 'SMALL' END) AS reasons FROM lineitem)
GROUP BY 1""")
def quarantine(t: Tables) -> DataFrame:
    good, bad = quality.quarantine(t.lineitem.select("l_quantity", "l_discount", "l_tax"), {
        "DISCOUNT": F.col("l_discount") > 0.08, "TAX": F.col("l_tax") > 0.07, "SMALL": F.col("l_quantity") < 3
    })
    both = good.withColumn("reasons", F.lit("")).unionByName(bad.withColumn("reasons", listed("reject_reasons")).drop("reject_reasons"))
    return both.groupBy("reasons").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("l_quantity")).alias("quantity"))


@query("history_over_limit", "SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 12")
def history_over_limit(t: Tables) -> DataFrame:
    return quality.history_over_limit(t.orders, ["o_custkey"], 12)


@query("table_fingerprint", """SELECT count(*) AS rows, coalesce(bit_xor(h), 0) AS hash_xor, CAST(coalesce(sum(CAST(h AS HUGEINT)), 0) AS VARCHAR) AS hash_sum FROM (
  SELECT CAST('0x' || substr(sha256(concat_ws(chr(31), CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority)), 1, 15) AS BIGINT) AS h FROM orders)""")
def table_fingerprint(t: Tables) -> DataFrame:
    return quality.table_fingerprint(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")).drop("schema")


@query("metrics_agree", """WITH claimed AS (SELECT lang, CAST(count(*) AS VARCHAR) AS docs, CAST(sum(n_chars) AS VARCHAR) AS chars FROM documents GROUP BY 1),
actual AS (SELECT lang, CAST(count(*) AS VARCHAR) AS docs, CAST(sum(strlen(text)) AS VARCHAR) AS chars FROM documents GROUP BY 1)
SELECT lang, 'chars' AS metric, c.chars AS claimed, a.chars AS actual FROM claimed c JOIN actual a USING (lang) WHERE c.chars <> a.chars
UNION ALL SELECT lang, 'docs', c.docs, a.docs FROM claimed c JOIN actual a USING (lang) WHERE c.docs <> a.docs""")
def metrics_agree(t: Tables) -> DataFrame:
    claimed = t.documents.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars"))
    actual = t.documents.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length("text")).alias("chars"))
    return quality.metrics_disagreements(claimed, actual, "lang", ["docs", "chars"])


@query("common_mode", """WITH p AS (SELECT CAST(l_shipdate AS DATE) AS session, l_quantity, l_discount, count(*) AS n FROM lineitem GROUP BY ALL),
q AS (SELECT session, max(n) AS common_mode_rows, CAST(sum(n) AS BIGINT) AS total_rows FROM p GROUP BY 1)
SELECT session, common_mode_rows, total_rows, round(CAST(common_mode_rows AS DOUBLE) / total_rows, 6) AS common_mode_rate FROM q
WHERE total_rows >= 2 AND common_mode_rows >= 2 AND CAST(common_mode_rows AS DOUBLE) / total_rows >= 0.02""")
def common_mode(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.to_date("l_shipdate").alias("session"), "l_quantity", "l_discount")
    out = stats.common_mode_sessions(rows, "session", ["l_quantity", "l_discount"], min_rows=2, mode_rows=2, mode_rate=0.02)
    return out.withColumn("common_mode_rate", r6("common_mode_rate"))


@query("history_depth", f"""WITH {BARS}, d AS (SELECT security_id, count(*) AS sessions FROM bars WHERE {VALID} GROUP BY 1)
SELECT (SELECT count(*) FROM customer) AS admitted, count(*) AS matched, count(*) FILTER (WHERE sessions >= 10) AS adequate,
  round(count(*) / (SELECT count(*) FROM customer), 6) AS coverage, round(count(*) FILTER (WHERE sessions >= 10) / count(*), 6) AS adequate_coverage FROM d""")
def history_depth(t: Tables) -> DataFrame:
    depth = stats.history_depth(bars(t).filter(~is_invalid_ohlcv()), "security_id")
    out = stats.depth_coverage(depth, t.customer.select(F.col("c_custkey").alias("security_id")), "security_id", 10)
    return out.withColumns({c: r6(c) for c in ("coverage", "adequate_coverage")})


@query("history_distribution", f"""WITH {BARS}, d AS (SELECT security_id, count(*) AS sessions FROM bars GROUP BY 1)
SELECT min(sessions) AS minimum, quantile_disc(sessions, 0.5) AS median, max(sessions) AS maximum, count(*) FILTER (WHERE sessions < 10) AS from_0_below_10,
  count(*) FILTER (WHERE sessions >= 10 AND sessions < 25) AS from_10_below_25, count(*) FILTER (WHERE sessions >= 25) AS from_25 FROM d""")
def history_distribution(t: Tables) -> DataFrame:
    return stats.history_distribution(stats.history_depth(bars(t), "security_id"), edges=(10, 25))


_COVERAGE = f"""active AS (SELECT security_id FROM bars GROUP BY 1 HAVING max(session_date) >= DATE '2024-01-25'),
cov AS (SELECT count(*) FILTER (WHERE security_id IN (SELECT security_id FROM bars WHERE session_date = DATE '2024-01-30' AND {VALID})) AS valid_securities,
  count(*) AS active_securities FROM active)"""


def _session_coverage(t: Tables) -> DataFrame:
    b = bars(t)
    active = b.groupBy("security_id").agg(F.max("session_date").alias("m")).filter(F.col("m") >= day("2024-01-25"))
    return stats.session_coverage(b, active, "security_id", "session_date", day("2024-01-30"), ~is_invalid_ohlcv())


@query("session_coverage", f"WITH {BARS}, {_COVERAGE} SELECT *, round(valid_securities / active_securities, 6) AS coverage FROM cov")
def session_coverage(t: Tables) -> DataFrame:
    return _session_coverage(t).withColumn("coverage", r6("coverage"))


@query("market_state", f"""WITH {BARS}, {_COVERAGE} SELECT valid_securities,
  CASE WHEN valid_securities / active_securities < 0.95 OR active_securities < 50 THEN 'QUARANTINED' WHEN valid_securities / active_securities < 0.99 THEN 'READY_WITH_EXCLUSIONS' ELSE 'READY_NEW' END AS state,
  concat_ws('|', CASE WHEN valid_securities / active_securities < 0.95 THEN 'COVERAGE_BELOW_MINIMUM' END, CASE WHEN active_securities < 50 THEN 'FEW_SECURITIES' END) AS errors,
  concat_ws('|', CASE WHEN valid_securities / active_securities >= 0.95 AND valid_securities / active_securities < 0.99 THEN 'COVERAGE_BELOW_READY_NEW' END, CASE WHEN valid_securities < active_securities THEN 'SOME_INVALID' END) AS warnings FROM cov""")
def market_state(t: Tables) -> DataFrame:
    out = stats.market_state(
        _session_coverage(t), errors={"FEW_SECURITIES": F.col("active_securities") < 50},
        warnings={"SOME_INVALID": F.col("valid_securities") < F.col("active_securities")},
    )
    return out.select("valid_securities", "state", listed("errors").alias("errors"), listed("warnings").alias("warnings"))


@query("date_range", "SELECT CAST(min(o_orderdate) AS DATE) AS minimum, CAST(max(o_orderdate) AS DATE) AS maximum FROM orders")
def date_range(t: Tables) -> DataFrame:
    return stats.date_range(t.orders.select(F.to_date("o_orderdate").alias("d")), "d")
