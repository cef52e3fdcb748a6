"""Daily order totals of three market segments as benchmark prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import Tables, day, query, r6
from tidemark.operators import stats
from tidemark.plans import benchmark as b

_PRICES = """px AS (SELECT c_mktsegment AS ticker, CAST(o_orderdate AS DATE) AS session_date, round(sum(o_totalprice), 2) AS close FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') GROUP BY 1, 2),
dv AS (SELECT c_mktsegment AS ticker, CAST(o_orderdate AS DATE) AS event_date, 'd' || o_orderkey AS event_id, round(o_totalprice / 1000, 2) AS cash_amount FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')),
sp AS (SELECT c_mktsegment AS ticker, CAST(o_orderdate AS DATE) + 1 AS event_date, 's' || o_orderkey AS event_id, 2.0 AS split_factor FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 495000 AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'))"""
_RETURNS = f"""{_PRICES}, newest AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY session_date DESC) AS rn FROM px WHERE session_date <= DATE '2001-06-30'),
lagged AS (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY session_date) AS pc FROM newest WHERE rn <= 321),
cash AS (SELECT ticker, event_date, sum(cash_amount) AS cash FROM dv GROUP BY 1, 2), fac AS (SELECT DISTINCT ticker, event_date, split_factor FROM sp),
ret AS (SELECT l.ticker, l.session_date, close AS raw_close, coalesce(CAST(split_factor AS DOUBLE), 1.0) AS split_factor, coalesce(cash, 0.0) AS cash_distribution, close * coalesce(CAST(split_factor AS DOUBLE), 1.0) / pc - 1 AS price_return,
  coalesce(cash, 0.0) / pc AS distribution_return, close / pc - 1 AS total_return FROM lagged l LEFT JOIN cash c ON c.ticker = l.ticker AND c.event_date = l.session_date LEFT JOIN fac f ON f.ticker = l.ticker AND f.event_date = l.session_date WHERE pc IS NOT NULL),
returns AS (SELECT *, abs(total_return - price_return - distribution_return) AS err, abs(total_return - price_return - distribution_return) <= 0.0001 AND price_return > -1 AND total_return > -1 AS row_ok FROM ret)"""


def sources(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    o = t.orders.join(t.customer.filter("c_mktsegment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"), F.col("c_custkey") == F.col("o_custkey")).withColumns(
        {"ticker": F.col("c_mktsegment"), "d": F.to_date("o_orderdate")}
    )
    prices = o.groupBy("ticker", F.col("d").alias("session_date")).agg(F.round(F.sum("o_totalprice"), 2).alias("close")).withColumn("adjusted_close", F.col("close"))
    cash = o.filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'").select(
        "ticker", F.col("d").alias("event_date"), F.concat(F.lit("d"), "o_orderkey").alias("event_id"), F.round(F.col("o_totalprice") / 1000, 2).alias("cash_amount")
    )
    splits = o.filter("o_totalprice > 495000").select("ticker", F.date_add("d", 1).alias("event_date"), F.concat(F.lit("s"), "o_orderkey").alias("event_id"), F.lit(2.0).alias("split_factor"))
    return prices, cash, splits


def returns(t: Tables) -> DataFrame:
    return b.benchmark_returns(*sources(t), target=day("2001-06-30"))


@query("benchmark_returns", f"""WITH {_RETURNS} SELECT ticker, session_date, raw_close, split_factor, round(cash_distribution, 4) AS cash_distribution, round(price_return, 6) AS price_return, round(distribution_return, 6) AS distribution_return,
  round(total_return, 6) AS total_return, row_ok FROM returns""")
def benchmark_returns(t: Tables) -> DataFrame:
    rates = ("price_return", "distribution_return", "total_return")
    return returns(t).withColumns({c: r6(c) for c in rates}).withColumn("cash_distribution", F.round("cash_distribution", 4)).select(
        "ticker", "session_date", "raw_close", "split_factor", "cash_distribution", *rates, "row_ok"
    )


@query("compound_index", f"WITH {_RETURNS} SELECT ticker, session_date, round(100 * product(1 + total_return) OVER (PARTITION BY ticker ORDER BY session_date ROWS UNBOUNDED PRECEDING), 4) AS total_return_index FROM returns")
def compound_index(t: Tables) -> DataFrame:
    out = b.compound_index(returns(t), ["ticker"], "session_date", "total_return")
    return out.select("ticker", "session_date", F.round("total_return_index", 4).alias("total_return_index"))


@query("verify_compounding", f"""WITH {_RETURNS}, ix AS (SELECT *, 100 * product(1 + total_return) OVER (PARTITION BY ticker ORDER BY session_date ROWS UNBOUNDED PRECEDING) * CASE WHEN month(session_date) = 1 AND day(session_date) < 5 THEN 2 ELSE 1 END AS total_return_index FROM returns),
o AS (SELECT *, lag(total_return_index) OVER w AS pi, lag(raw_close) OVER w AS pc FROM ix WINDOW w AS (PARTITION BY ticker ORDER BY session_date))
SELECT ticker, session_date FROM o WHERE pi IS NOT NULL AND (abs(total_return_index / pi - 1 - total_return) > 1e-8 OR abs(price_return - (raw_close * split_factor / pc - 1)) > 1e-8 OR abs(distribution_return - cash_distribution / pc) > 1e-8)""")
def verify_compounding(t: Tables) -> DataFrame:
    rows = b.compound_index(returns(t), ["ticker"], "session_date", "total_return")
    doubled = (F.month("session_date") == 1) & (F.dayofmonth("session_date") < 5)
    rows = rows.withColumn("total_return_index", F.col("total_return_index") * F.when(doubled, 2).otherwise(1))
    return b.verify_compounding(rows, ["ticker"], tolerance=1e-8).select("ticker", "session_date")


@query("lineage_hash", f"""WITH {_RETURNS}, dig AS (SELECT ticker, event_date, sum(CAST('0x' || substr(sha256(event_id || '|' || CAST(event_date AS VARCHAR)), 1, 15) AS HUGEINT)) AS d, count(*) AS n FROM dv GROUP BY 1, 2),
j AS (SELECT r.ticker, r.session_date, sum(coalesce(d, 0)) OVER w AS ds, sum(coalesce(n, 0)) OVER w AS ns FROM returns r LEFT JOIN dig ON dig.ticker = r.ticker AND dig.event_date = r.session_date WINDOW w AS (PARTITION BY r.ticker ORDER BY r.session_date ROWS UNBOUNDED PRECEDING))
SELECT ticker, session_date, sha256(CAST(ns AS VARCHAR) || '|' || CAST(ds AS VARCHAR)) AS lineage FROM j""")
def lineage_hash(t: Tables) -> DataFrame:
    _, cash, _ = sources(t)
    return b.lineage_hash(returns(t).select("ticker", "session_date"), cash, ["ticker"], "session_date", "event_date", ["event_id", "event_date"], "lineage")


@query("lane_summary", f"""WITH {_RETURNS}, base AS (SELECT ticker, count(*) AS sessions, count(DISTINCT date_trunc('week', session_date)) AS weekly_observations, min(session_date) AS minimum_session, max(session_date) AS maximum_session, count(*) FILTER (WHERE NOT row_ok) AS uncertified_rows FROM returns GROUP BY 1),
ev AS (SELECT ticker, event_date FROM dv UNION ALL SELECT ticker, event_date FROM sp),
lost AS (SELECT e.ticker, count(*) AS n FROM ev e JOIN base USING (ticker) WHERE e.event_date BETWEEN minimum_session AND DATE '2001-06-30' AND NOT EXISTS (SELECT 1 FROM returns r WHERE r.ticker = e.ticker AND r.session_date = e.event_date) GROUP BY 1)
SELECT ticker, sessions, weekly_observations, minimum_session, maximum_session, uncertified_rows, coalesce(n, 0) AS orphan_events, maximum_session = DATE '2001-06-30' AND sessions >= 140 AND weekly_observations >= 26 AND uncertified_rows = 0 AND coalesce(n, 0) = 0 AS certified FROM base LEFT JOIN lost USING (ticker)""")
def lane_summary(t: Tables) -> DataFrame:
    _, cash, splits = sources(t)
    out = b.lane_summary(returns(t), cash, splits, target=day("2001-06-30"))
    return out.select("ticker", "sessions", "weekly_observations", "minimum_session", "maximum_session", "uncertified_rows", "orphan_events", "certified")


@query("lane_status", f"""WITH {_RETURNS}, base AS (SELECT ticker, count(*) AS sessions, count(DISTINCT date_trunc('week', session_date)) AS weeks, max(session_date) AS hi, count(*) FILTER (WHERE NOT row_ok) AS bad FROM returns GROUP BY 1)
SELECT CASE WHEN count(*) = 3 AND count(*) FILTER (WHERE hi = (SELECT max(hi) FROM base)) = 3 AND sum(bad) = 0 AND min(sessions) >= 140 AND min(weeks) >= 26 THEN 'READY' ELSE 'INVALID' END AS state,
  CASE WHEN count(*) = 3 AND count(*) FILTER (WHERE hi = DATE '2001-06-30') = 3 THEN 'READY' ELSE 'STALE' END AS market_state, min(sessions) AS sessions, min(weeks) AS weekly_observations, count(*) AS securities, count(*) / 3 AS coverage FROM base""")
def lane_status(t: Tables) -> DataFrame:
    base = stats.lane_stats(returns(t), "ticker", "session_date", ~F.col("row_ok"))
    return stats.lane_status(base, "ticker", ["BUILDING", "MACHINERY", "HOUSEHOLD"], day("2001-06-30"))


@query("benchmark_row_rules", f"""WITH {_RETURNS} SELECT rule, violations FROM (SELECT 'RECONCILIATION' AS rule, count(*) FILTER (WHERE NOT err <= 0.0001) AS violations FROM returns UNION ALL SELECT 'RAW_CLOSE', count(*) FILTER (WHERE NOT raw_close > 0) FROM returns
UNION ALL SELECT 'CASH', count(*) FILTER (WHERE NOT cash_distribution >= 0) FROM returns UNION ALL SELECT 'TOTAL_RETURN', count(*) FILTER (WHERE NOT total_return > -1) FROM returns UNION ALL SELECT 'SPLIT_FACTOR', count(*) FILTER (WHERE NOT split_factor > 0) FROM returns)""")
def benchmark_row_rules(t: Tables) -> DataFrame:
    from tidemark.operators.quality import benchmark_row_rules as rules
    from tidemark.operators.quality import rule_counts

    chosen = ("RECONCILIATION", "RAW_CLOSE", "CASH", "TOTAL_RETURN", "SPLIT_FACTOR")
    rows = returns(t).withColumns({c: F.lit(None).cast("string") for c in (
        "certification_status", "benchmark_role", "currency", "distribution_lineage_sha256", "corporate_action_lineage_sha256")})
    return rule_counts(rows, {n: r for n, r in rules().items() if n in chosen})


@query("distributions", f"""WITH {_RETURNS}, span AS (SELECT ticker, min(session_date) AS lo, max(session_date) AS hi FROM returns GROUP BY 1)
SELECT ticker, ticker AS security_id, event_date AS ex_date, cash_amount, 'CASH_DISTRIBUTION' AS distribution_type, 'USD' AS currency FROM dv JOIN span USING (ticker) WHERE event_date BETWEEN lo AND hi""")
def distributions(t: Tables) -> DataFrame:
    _, cash, _ = sources(t)
    at = F.lit("2002-01-01").cast("timestamp")
    out = b.build_distributions(cash.withColumn("security_id", F.col("ticker")), returns(t), locator="l", revision="r", retrieved_at=at, certified_at=at)
    return out.select("ticker", "security_id", "ex_date", "cash_amount", "distribution_type", "currency")


@query("cash_reconcile", """WITH e AS (SELECT l_orderkey, sum(l_extendedprice) AS cash FROM lineitem GROUP BY 1)
SELECT o_orderkey, round(o_totalprice, 4) AS claimed, round(coalesce(cash, 0.0), 4) AS cash_amount FROM orders LEFT JOIN e ON l_orderkey = o_orderkey WHERE abs(o_totalprice - coalesce(cash, 0.0)) > 150000""")
def cash_reconcile(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    items = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    out = stats.cash_differences(rows, items, ["o_orderkey"], "o_totalprice", "l_extendedprice", tolerance=150000.0)
    return out.select("o_orderkey", F.round("o_totalprice", 4).alias("claimed"), F.round("cash_amount", 4).alias("cash_amount"))


@query("daily_cash", "SELECT l_suppkey, CAST(l_shipdate AS DATE) AS ex_date, round(sum(l_extendedprice * l_discount), 4) AS cash_amount FROM lineitem GROUP BY 1, 2")
def daily_cash(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("ex_date"), (F.col("l_extendedprice") * F.col("l_discount")).alias("c"))
    return stats.daily_cash(rows, ["l_suppkey", "ex_date"], "c").withColumn("cash_amount", F.round("cash_amount", 4))
