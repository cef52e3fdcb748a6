"""Line items as trades and positions: signals, changes, concentration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import Tables, day, query, r6
from tidemark.operators import stats
from tidemark.plans import ownership as ow
from tidemark.plans.short_interest import lagged_growth

_SUM = "CASE WHEN count(*) FILTER (WHERE {w}) = count(v) FILTER (WHERE {w}) THEN coalesce(sum(v) FILTER (WHERE {w}), 0.0) END"
_WINDOWS = {
    "b30": "l_returnflag = 'A' AND l_linestatus = 'F' AND d BETWEEN DATE '2001-05-31' AND DATE '2001-06-30'", "b90": "l_returnflag = 'A' AND l_linestatus = 'F' AND d BETWEEN DATE '2001-04-01' AND DATE '2001-06-30'",
    "s30": "l_returnflag = 'R' AND l_linestatus = 'O' AND d BETWEEN DATE '2001-05-31' AND DATE '2001-06-30'", "s90": "l_returnflag = 'R' AND l_linestatus = 'O' AND d BETWEEN DATE '2001-04-01' AND DATE '2001-06-30'",
}


@query("insider_signals", f"""WITH r AS (SELECT l_suppkey, l_partkey, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS d, CASE WHEN l_tax <> 0.08 THEN l_extendedprice END AS v FROM lineitem),
a AS (SELECT l_suppkey, {', '.join(f"{_SUM.format(w=w)} AS {n}" for n, w in _WINDOWS.items())}, count(DISTINCT l_partkey) FILTER (WHERE {_WINDOWS['b90']}) AS buyers, count(DISTINCT l_partkey) FILTER (WHERE {_WINDOWS['s90']}) AS sellers FROM r GROUP BY 1)
SELECT l_suppkey, round(b30, 4) AS buy_30, round(b90, 4) AS buy_90, round(s30, 4) AS sale_30, round(s90, 4) AS sale_90, buyers AS unique_buyers_90d, sellers AS unique_sellers_90d, buyers >= 3 AS cluster_buy_flag,
  round(CASE WHEN b90 IS NOT NULL AND s90 IS NOT NULL THEN greatest(-1.0, least(1.0, least(1.0, ln(1 + b90) / 20 + buyers * 0.1) - least(0.5, ln(1 + s90) / 40))) END, 6) AS insider_signal_score,
  CASE WHEN b90 IS NULL OR s90 IS NULL THEN 'PARTIAL_MISSING_TRANSACTION_VALUE' WHEN buyers > 0 OR sellers > 0 THEN 'READY' ELSE 'NO_OPEN_MARKET_ACTIVITY' END AS signal_quality_status FROM a""")
def insider_signals(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("d"), F.when(F.col("l_tax") != 0.08, F.col("l_extendedprice")).alias("v")
    )
    out = ow.insider_signals(
        rows, day("2001-06-30"), key="l_suppkey", owner="l_partkey", code="l_returnflag", side="l_linestatus", date="d", amount=F.col("v"), buy=("A", "F"), sell=("R", "O")
    )
    return out.select(
        "l_suppkey", *[F.round(f"open_market_{long}_value_{n}d", 4).alias(f"{short}_{n}") for short, long in (("buy", "purchase"), ("sale", "sale")) for n in (30, 90)],
        "unique_buyers_90d", "unique_sellers_90d", "cluster_buy_flag", r6("insider_signal_score").alias("insider_signal_score"), "signal_quality_status",
    )


@query("positions", """SELECT l_suppkey AS manager, l_partkey AS security, year(l_shipdate) AS period, round(sum(l_extendedprice), 4) AS value, round(sum(l_quantity), 4) AS shares,
  round(CASE WHEN count(*) = count(nullif(l_tax, 0.08)) THEN sum(nullif(l_tax, 0.08)) END, 6) AS voting, arg_min(l_returnflag, l_orderkey * 10 + l_linenumber) AS share_type, arg_min(l_linestatus, l_orderkey * 10 + l_linenumber) AS put_call FROM lineitem GROUP BY 1, 2, 3""")
def positions(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("manager"), F.col("l_partkey").alias("security"), F.year("l_shipdate").cast("bigint").alias("period"), F.col("l_extendedprice").alias("value"),
        F.col("l_quantity").alias("shares"), F.nullif("l_tax", F.lit(0.08)).alias("voting"), F.col("l_returnflag").alias("share_type"), F.col("l_linestatus").alias("put_call"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"),
    )
    out = ow.aggregate_positions(rows, ["manager", "security", "period"], ["value", "shares"], ["voting"], ["share_type", "put_call"], ["line"])
    return out.withColumns({"value": F.round("value", 4), "shares": F.round("shares", 4), "voting": r6("voting")})


HOLDINGS = """holdings AS (SELECT p_brand AS security, l_suppkey AS manager, year(l_shipdate) * 10 + quarter(l_shipdate) AS period, sum(l_quantity) AS shares, round(sum(l_extendedprice), 2) AS value
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'A' GROUP BY 1, 2, 3)"""


def holdings(t: Tables) -> DataFrame:
    rows = t.lineitem.filter("l_returnflag = 'A'").join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    return rows.groupBy(
        F.col("p_brand").alias("security"), F.col("l_suppkey").alias("manager"), (F.year("l_shipdate") * 10 + F.quarter("l_shipdate")).cast("bigint").alias("period")
    ).agg(F.sum("l_quantity").alias("shares"), F.round(F.sum("l_extendedprice"), 2).alias("value"))


@query("ownership_change", f"""WITH {HOLDINGS}, per AS (SELECT security, period, lag(period) OVER (PARTITION BY security ORDER BY period) AS prev FROM (SELECT DISTINCT security, period FROM holdings)),
pairs AS (SELECT p.security, p.period, h.manager, h.shares AS now, NULL AS before FROM per p JOIN holdings h ON h.security = p.security AND h.period = p.period
  UNION ALL SELECT p.security, p.period, h.manager, NULL, h.shares FROM per p JOIN holdings h ON h.security = p.security AND h.period = p.prev),
m AS (SELECT security, period, manager, max(now) AS now, max(before) AS before FROM pairs GROUP BY 1, 2, 3)
SELECT security, period, sum(now) AS known_shares, count(now) AS manager_count, count(*) FILTER (WHERE before IS NULL) AS new_count, count(*) FILTER (WHERE now IS NULL) AS closed_count,
  count(*) FILTER (WHERE now > before) AS increased_count, count(*) FILTER (WHERE now < before) AS decreased_count, CASE WHEN count(before) > 0 THEN sum(now) - sum(before) END AS net_share_change,
  count(*) FILTER (WHERE before IS NULL) + count(*) FILTER (WHERE now > before) - count(*) FILTER (WHERE now IS NULL) - count(*) FILTER (WHERE now < before) AS net_breadth FROM m GROUP BY 1, 2""")
def ownership_change(t: Tables) -> DataFrame:
    return ow.period_over_period(holdings(t), "security", "period", "manager", "shares")


@query("top10_share", f"""WITH {HOLDINGS}, r AS (SELECT *, row_number() OVER (PARTITION BY security, period ORDER BY value DESC, manager) AS rn FROM holdings)
SELECT security, period, round(sum(value) FILTER (WHERE rn <= 10) / nullif(sum(value), 0), 6) AS top_share FROM r GROUP BY 1, 2""")
def top10_share(t: Tables) -> DataFrame:
    return stats.top_share(holdings(t), ["security", "period"], "value", ["manager"]).withColumn("top_share", r6("top_share"))


_TABLE = f"""filed AS (SELECT p_brand AS security, l_suppkey AS manager, last_day(l_shipdate) AS period, sum(l_quantity) AS shares, round(sum(l_extendedprice), 2) AS value, max(CAST(l_shipdate AS DATE)) + 45 AS filing_date,
  bool_and(l_linestatus = 'O') AS reviewed, CAST(l_linestatus AS VARCHAR) AS accession FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'A' GROUP BY 1, 2, 3, l_linestatus),
one AS (SELECT * FROM filed QUALIFY row_number() OVER (PARTITION BY security, period, manager ORDER BY filing_date DESC, accession DESC) = 1),
per AS (SELECT security, period, lag(period) OVER (PARTITION BY security ORDER BY period) AS prev FROM (SELECT DISTINCT security, period FROM one)),
pairs AS (SELECT p.security, p.period, h.manager, h.shares AS now, NULL AS before FROM per p JOIN one h ON h.security = p.security AND h.period = p.period
  UNION ALL SELECT p.security, p.period, h.manager, NULL, h.shares FROM per p JOIN one h ON h.security = p.security AND h.period = p.prev),
m AS (SELECT security, period, manager, max(now) AS now, max(before) AS before FROM pairs GROUP BY 1, 2, 3),
s AS (SELECT security, period, sum(now) AS known_13f_shares, count(now) AS manager_count, count(*) FILTER (WHERE before IS NULL) + count(*) FILTER (WHERE now > before) - count(*) FILTER (WHERE now IS NULL) - count(*) FILTER (WHERE now < before) AS breadth FROM m GROUP BY 1, 2),
c AS (SELECT security, period, sum(value) FILTER (WHERE rn <= 10) / nullif(sum(value), 0) AS top, max(filing_date) AS filing, bool_and(reviewed) AS reviewed FROM (SELECT *, row_number() OVER (PARTITION BY security, period ORDER BY value DESC, manager) AS rn FROM one) GROUP BY 1, 2)"""


@query("ownership_signals", f"""WITH {_TABLE} SELECT security AS security_id, period AS report_period, known_13f_shares, manager_count, breadth AS net_manager_breadth, round(top, 6) AS top_10_manager_concentration,
  round(tanh(breadth / 10.0), 6) AS ownership_signal_score, filing - period AS publication_lag_days, CASE WHEN reviewed THEN 'READY' ELSE 'PARTIAL_NAME_MAPPED' END AS signal_quality_status FROM s JOIN c USING (security, period)""")
def ownership_signals(t: Tables) -> DataFrame:
    rows = t.lineitem.filter("l_returnflag = 'A'").join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    filed = rows.groupBy(
        F.col("p_brand").alias("security_id"), F.col("l_suppkey").alias("manager_cik"), F.last_day("l_shipdate").alias("report_period"), F.col("l_linestatus").alias("accession_number")
    ).agg(
        F.sum("l_quantity").alias("shares_or_principal"), F.round(F.sum("l_extendedprice"), 2).alias("market_value_thousands"), F.date_add(F.max(F.to_date("l_shipdate")), 45).alias("filing_date"),
    ).withColumn("security_mapping_method", F.when(F.col("accession_number") == "O", "REVIEWED_CUSIP_OVERRIDE").otherwise("UNIQUE_SEC_ISSUER_NAME"))
    out = ow.build_ownership_signals(filed, retrieved_at=F.lit("2002-01-01").cast("timestamp"))
    return out.select(
        "security_id", "report_period", "known_13f_shares", "manager_count", "net_manager_breadth", r6("top_10_manager_concentration").alias("top_10_manager_concentration"),
        r6("ownership_signal_score").alias("ownership_signal_score"), "publication_lag_days", "signal_quality_status",
    )


@query("short_interest_changes", """WITH m AS (SELECT o_orderpriority AS symbol, CAST(date_trunc('month', o_orderdate) AS DATE) AS settlement, round(sum(o_totalprice), 2) AS shares, count(*) AS dtc FROM orders GROUP BY 1, 2)
SELECT symbol, settlement, shares, round(shares / nullif(lag(shares, 2) OVER w, 0) - 1, 6) AS change_1m, round(shares / nullif(lag(shares, 6) OVER w, 0) - 1, 6) AS change_3m, dtc - lag(dtc) OVER w AS dtc_change FROM m WINDOW w AS (PARTITION BY symbol ORDER BY settlement)""")
def short_interest_changes(t: Tables) -> DataFrame:
    monthly = t.orders.groupBy(F.col("o_orderpriority").alias("symbol"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("settlement")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("shares"), F.count(F.lit(1)).alias("dtc")
    )
    out = lagged_growth(
        monthly, ["symbol"], ["settlement"], growths={"change_1m": ("shares", 2), "change_3m": ("shares", 6)}, differences={"dtc_change": ("dtc", 1)}
    )
    return out.select("symbol", "settlement", "shares", r6("change_1m").alias("change_1m"), r6("change_3m").alias("change_3m"), "dtc_change")
