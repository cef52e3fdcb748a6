"""Resolving, mapping and checking identities across orders, customers and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.base import Tables, day, query
from tidemark.operators import keys
from tidemark.plans import filings as f
from tidemark.plans.identity import reconcile_cascade
from tidemark.plans.ownership import identity_conflicts as find_conflicts
from tidemark.plans.ownership import issuer_decisions, map_by_override_then_unique_name

_MASTER = """master AS (SELECT c_custkey AS security_id, CASE WHEN c_acctbal >= 0 THEN lpad(CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR), 10, '0') END AS cik FROM customer)"""


def master(t: Tables) -> DataFrame:
    balance = F.floor("c_acctbal").cast("bigint")
    return t.customer.select(
        F.col("c_custkey").alias("security_id"), F.when(F.col("c_acctbal") >= 0, F.lpad(balance.cast("string"), 10, "0")).alias("cik"), "c_name",
    )


def tickers(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("security_id"), F.concat(F.lit("C."), "c_custkey").alias("ticker"))


_REQUESTS = f"""{_MASTER}, requests AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN coalesce(m.cik, '0000000001') ELSE lpad(CAST(CAST(floor(o_totalprice / 50) AS BIGINT) AS VARCHAR), 10, '0') END AS issuer_cik,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE 'c-' || o_custkey END AS issuer_symbol, o_custkey FROM orders JOIN master m ON m.security_id = o_custkey)"""


def requests(t: Tables) -> DataFrame:
    m = master(t)
    price = F.lpad(F.floor(F.col("o_totalprice") / 50).cast("string"), 10, "0")
    return t.orders.join(m, F.col("security_id") == F.col("o_custkey")).select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", F.coalesce("cik", F.lit("0000000001"))).otherwise(price).alias("issuer_cik"),
        F.when(F.col("o_orderpriority") == "5-LOW", "none").otherwise(F.concat(F.lit("c-"), "o_custkey")).alias("issuer_symbol"), "o_custkey",
    )


@query("resolve_issuer", f"""WITH {_REQUESTS}, classes AS (SELECT cik, count(*) AS n, min(security_id) AS only_id FROM master WHERE cik IS NOT NULL GROUP BY 1),
pairs AS (SELECT DISTINCT issuer_cik, issuer_symbol, CASE WHEN issuer_symbol = 'none' THEN NULL ELSE o_custkey END AS ticker_id FROM requests),
j AS (SELECT p.*, m.cik AS ticker_cik, coalesce(n, 0) AS n, only_id FROM pairs p LEFT JOIN master m ON m.security_id = p.ticker_id LEFT JOIN classes c ON c.cik = p.issuer_cik),
d AS (SELECT *, CASE WHEN n = 1 THEN only_id WHEN n > 1 AND ticker_cik = issuer_cik THEN ticker_id END AS security_id FROM j)
SELECT issuer_cik, issuer_symbol, security_id, CASE WHEN security_id IS NOT NULL THEN NULL WHEN ticker_id IS NOT NULL AND ticker_cik IS NULL THEN 'MISSING_CANONICAL_CIK'
  WHEN ticker_id IS NOT NULL THEN 'TICKER_CIK_CONFLICT' WHEN n > 1 THEN 'AMBIGUOUS_SHARE_CLASS' ELSE 'UNKNOWN_ISSUER_CIK' END AS reject_reason FROM d""")
def resolve_issuer(t: Tables) -> DataFrame:
    return issuer_decisions(requests(t), master(t), tickers(t))


@query("identity_conflicts", f"""WITH {_MASTER}, known AS (SELECT m.security_id, CASE WHEN m.cik < '0000000100' THEN ltrim(m.cik, '0') ELSE m.cik END AS cik FROM master m JOIN customer ON c_custkey = m.security_id WHERE c_mktsegment <> 'BUILDING'),
r AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN lpad(CAST(CAST(floor(o_totalprice / 50) AS BIGINT) AS VARCHAR), 10, '0') ELSE m.cik END AS issuer_cik FROM orders JOIN master m ON m.security_id = o_custkey),
j AS (SELECT r.*, k.security_id AS hit, k.cik FROM r LEFT JOIN known k ON k.security_id = r.o_custkey)
SELECT o_orderkey, conflict FROM (SELECT o_orderkey, CASE WHEN hit IS NULL THEN 'UNKNOWN_SECURITY' WHEN cik IS NULL THEN 'NULL_CANONICAL_CIK' WHEN NOT regexp_full_match(cik, '[0-9]{{10}}') THEN 'MALFORMED_CANONICAL_CIK' WHEN issuer_cik <> cik THEN 'CIK_CONFLICT' END AS conflict FROM j) WHERE conflict IS NOT NULL""")
def identity_conflicts(t: Tables) -> DataFrame:
    m = master(t)
    segment = t.customer.filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("security_id"))
    known = m.join(segment, "security_id", "left_semi").withColumn(
        "cik", F.when(F.col("cik") < "0000000100", F.ltrim("cik", F.lit("0"))).otherwise(F.col("cik"))
    )
    price = F.lpad(F.floor(F.col("o_totalprice") / 50).cast("string"), 10, "0")
    rows = t.orders.withColumn("security_id", F.col("o_custkey")).join(m, "security_id").select(
        "o_orderkey", "security_id", F.when(F.col("o_orderstatus") == "F", price).otherwise(F.col("cik")).alias("issuer_cik")
    )
    return find_conflicts(rows, known).select("o_orderkey", "conflict")


@query("unique_name_map", r"""WITH names AS (SELECT c_mktsegment || ' ' || CAST(floor(c_acctbal) AS BIGINT) AS nm, c_custkey FROM customer),
uniq AS (SELECT trim(regexp_replace(upper(nm), '[^A-Z0-9]+', ' ', 'g')) AS nm, min(c_custkey) AS id FROM names GROUP BY 1 HAVING min(c_custkey) = max(c_custkey)),
rows AS (SELECT o_orderkey, upper('p-' || CAST(o_orderdate AS DATE)) AS cusip, trim(regexp_replace(upper(lower(c_mktsegment) || ' # ' || CAST(floor(c_acctbal) AS BIGINT) || '.'), '[^A-Z0-9]+', ' ', 'g')) AS nm FROM orders JOIN customer ON c_custkey = o_custkey),
rev AS (SELECT upper('p-' || CAST(l_shipdate AS DATE)) AS cusip, max(l_suppkey) AS id FROM lineitem WHERE l_quantity = 50 GROUP BY 1)
SELECT o_orderkey, coalesce(rev.id, uniq.id) AS security_id, CASE WHEN rev.id IS NOT NULL THEN 'REVIEWED_CUSIP_OVERRIDE' ELSE 'UNIQUE_SEC_ISSUER_NAME' END AS security_mapping_method
FROM rows LEFT JOIN rev USING (cusip) LEFT JOIN uniq USING (nm) WHERE coalesce(rev.id, uniq.id) IS NOT NULL""")
def unique_name_map(t: Tables) -> DataFrame:
    balance = F.floor("c_acctbal").cast("bigint")
    names = t.customer.select(F.concat_ws(" ", "c_mktsegment", balance).alias("issuer_name"), F.col("c_custkey").alias("security_id"))
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", F.concat(F.lit("p-"), F.to_date("o_orderdate").cast("string")).alias("cusip"),
        F.concat(F.lower("c_mktsegment"), F.lit(" # "), balance.cast("string"), F.lit(".")).alias("issuer_name"),
    )
    reviewed = t.lineitem.filter("l_quantity = 50").groupBy(
        F.concat(F.lit("P-"), F.to_date("l_shipdate").cast("string")).alias("cusip")
    ).agg(F.max("l_suppkey").alias("security_id"))
    return map_by_override_then_unique_name(rows, reviewed, names).select("o_orderkey", "security_id", "security_mapping_method")


_PERIODS = """periods AS (SELECT security_id, cik, effective_from, CASE WHEN s = 'P' THEN nxt + 30 ELSE nxt - 1 END AS effective_to FROM (
  SELECT o_custkey AS security_id, CAST(o_orderkey AS VARCHAR) AS cik, CAST(o_orderdate AS DATE) AS effective_from, o_orderstatus AS s,
    lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt FROM orders))"""


def periods(t: Tables) -> DataFrame:
    """Order dates as period starts; the next order of the customer ends the period."""
    rows = t.orders.select(
        F.col("o_custkey").alias("security_id"), F.col("o_orderkey").cast("string").alias("cik"), F.to_date("o_orderdate").alias("effective_from"),
        "o_orderstatus", F.col("o_orderkey"),
    ).withColumns({"_back": -F.unix_date("effective_from"), "_key": -F.col("o_orderkey")})
    from tidemark.operators.skew import OrderedKeys

    later = OrderedKeys(rows, ["security_id"], ["_back", "_key"]).running(maxima_before={"_n": F.struct("_back", "_key", "effective_from")}).result()
    nxt = F.col("_n.effective_from")
    return later.select(
        "security_id", "cik", "effective_from",
        F.when(F.col("o_orderstatus") == "P", F.date_add(nxt, 30)).otherwise(F.date_sub(nxt, 1)).alias("effective_to"),
    )


@query("effective_dated", f"WITH {_PERIODS} SELECT security_id, cik AS override_cik FROM periods WHERE effective_from <= DATE '1998-06-30' AND (effective_to IS NULL OR DATE '1998-06-30' <= effective_to)")
def effective_dated(t: Tables) -> DataFrame:
    return f.active_overrides(periods(t), day("1998-06-30"))


@query("override_overlap", f"""WITH {_PERIODS}, l AS (SELECT *, lag(coalesce(effective_to, DATE '9999-12-31')) OVER (PARTITION BY security_id ORDER BY effective_from, coalesce(effective_to, DATE '9999-12-31')) AS previous_to FROM periods)
SELECT security_id, effective_from, previous_to FROM l WHERE effective_from <= previous_to""")
def override_overlap(t: Tables) -> DataFrame:
    return f.override_overlaps(periods(t)).select("security_id", "effective_from", "previous_to")


@query("orphans", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'))")
def orphans(t: Tables) -> DataFrame:
    dim = t.customer.filter("c_mktsegment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD')").select(F.col("c_custkey").alias("o_custkey"))
    return keys.orphans(t.orders, dim, "o_custkey").select("o_orderkey", "o_custkey")


@query("drop_orphans", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'))")
def drop_orphans(t: Tables) -> DataFrame:
    dim = t.customer.filter("c_mktsegment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD')").select(F.col("c_custkey").alias("o_custkey"))
    return keys.drop_orphans(t.orders, dim, "o_custkey").select("o_orderkey", "o_custkey")


@query("orphan_counts", """WITH dim AS (SELECT c_custkey FROM customer WHERE c_acctbal > 2000)
SELECT 'orders' AS table, count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM dim)) AS orphan_rows FROM orders
UNION ALL SELECT 'events', count(*) FILTER (WHERE user_id NOT IN (SELECT c_custkey FROM dim)) FROM events""")
def orphan_counts(t: Tables) -> DataFrame:
    dim = t.customer.filter("c_acctbal > 2000").select(F.col("c_custkey").alias("security_id"))
    tables = {
        "orders": t.orders.select(F.col("o_custkey").alias("security_id")), "events": t.events.select(F.col("user_id").alias("security_id")), "nation": t.nation,
    }
    return keys.orphan_counts(tables, dim, "security_id")


_DIM = "dim AS (SELECT 'C' || c_custkey AS security_id, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS cik, c_name AS ticker, upper(c_mktsegment) AS exchange_mic FROM customer)"


@query("reconcile_cascade", f"""WITH {_DIM}, pos AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'c' || o_custkey END AS security_id, CASE WHEN o_orderpriority < '3' THEN CAST(CAST(floor(o_totalprice / 50) AS BIGINT) AS VARCHAR) ELSE ' ' END AS cik,
    CASE WHEN o_orderpriority <> '5-LOW' THEN c_name END AS ticker, c_mktsegment AS exchange_mic FROM orders JOIN customer ON c_custkey = o_custkey),
p AS (SELECT o_orderkey, nullif(upper(trim(security_id)), '') AS a, nullif(upper(trim(cik)), '') AS b, upper(ticker) AS d, exchange_mic AS e FROM pos),
k1 AS (SELECT security_id AS k, count(*) AS n, min(security_id) AS id FROM dim GROUP BY 1), k2 AS (SELECT cik AS k, count(*) AS n, min(security_id) AS id FROM dim GROUP BY 1),
k3 AS (SELECT upper(ticker) AS k, exchange_mic AS x, count(*) AS n, min(security_id) AS id FROM dim GROUP BY 1, 2),
j AS (SELECT p.*, k1.n AS n1, k1.id AS i1, k2.n AS n2, k2.id AS i2, k3.n AS n3, k3.id AS i3 FROM p LEFT JOIN k1 ON k1.k = a LEFT JOIN k2 ON k2.k = b LEFT JOIN k3 ON k3.k = d AND k3.x = e)
SELECT o_orderkey, CASE WHEN coalesce(n1, n2, n3) = 1 THEN coalesce(CASE WHEN n1 >= 1 THEN i1 END, CASE WHEN n2 >= 1 THEN i2 END, i3) END AS matched_id,
  CASE WHEN n1 >= 1 THEN 'security_id' WHEN n2 >= 1 THEN 'cik' WHEN n3 >= 1 THEN 'ticker_exchange' END AS match_level,
  CASE WHEN coalesce(n1, n2, n3) = 1 THEN 'MATCHED' WHEN coalesce(n1, n2, n3) > 1 THEN 'AMBIGUOUS' ELSE 'UNMATCHED' END AS match_status FROM j""")
def reconcile(t: Tables) -> DataFrame:
    balance = F.floor("c_acctbal").cast("bigint").cast("string")
    dim = t.customer.select(
        F.concat(F.lit("C"), "c_custkey").alias("security_id"), balance.alias("cik"), F.col("c_name").alias("ticker"), F.col("c_mktsegment").alias("exchange_mic")
    )
    positions = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("c"), "o_custkey")).alias("security_id"),
        F.when(F.col("o_orderpriority") < "3", F.floor(F.col("o_totalprice") / 50).cast("string")).otherwise(" ").alias("cik"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("c_name")).alias("ticker"), F.col("c_mktsegment").alias("exchange_mic"),
    )
    levels = (("security_id", ("security_id",)), ("cik", ("cik",)), ("ticker_exchange", ("ticker", "exchange_mic")))
    return reconcile_cascade(positions, dim, "security_id", levels).select("o_orderkey", "matched_id", "match_level", "match_status")


@query("extend_dimension", """WITH m AS (SELECT c_custkey, c_name, c_nationkey, 'MAPPED' AS mapping_status FROM customer WHERE c_acctbal > 1000)
SELECT * FROM m UNION ALL SELECT c_custkey, c_name, NULL, 'UNMAPPED_DAILY_ADMISSION' FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM m)""")
def extend_dimension(t: Tables) -> DataFrame:
    known = t.customer.filter("c_acctbal > 1000").select("c_custkey", "c_name", "c_nationkey", F.lit("MAPPED").alias("mapping_status"))
    return keys.extend_master(known, t.customer.select("c_custkey", "c_name"), "c_custkey", {"mapping_status": F.lit("UNMAPPED_DAILY_ADMISSION")})


@query("full_outer_master", """WITH a AS (SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN '' ELSE lower(c_name) END AS name, c_mktsegment AS segment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
b AS (SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation FROM customer WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD'))
SELECT coalesce(a.k, b.k) AS k, coalesce(nullif(a.name, ''), b.name) AS name, segment, nation, a.k IS NOT NULL AS is_current FROM a FULL JOIN b ON a.k = b.k""")
def full_outer_master(t: Tables) -> DataFrame:
    c = t.customer
    a = c.filter("c_mktsegment in ('BUILDING', 'MACHINERY')").select(
        F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") < 0, "").otherwise(F.lower("c_name")).alias("name"), F.col("c_mktsegment").alias("segment")
    )
    b = c.filter("c_mktsegment in ('MACHINERY', 'HOUSEHOLD')").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    return keys.full_outer_master(a, b, "k", ["name"])


@query("security_master", f"""WITH docs AS (SELECT lpad(CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR), 10, '0') AS cik, 'N' || CAST(floor(c_acctbal) AS BIGINT) AS nm, c_nationkey AS sid, c_custkey AS pos FROM customer WHERE c_acctbal >= 9000
  UNION ALL SELECT lpad(CAST(s_suppkey + 100000 AS VARCHAR), 10, '0'), 'S' || s_suppkey, 100 + s_suppkey, s_suppkey FROM supplier),
u AS (SELECT n_nationkey AS sid, 'N.' || n_nationkey AS ticker FROM nation UNION ALL SELECT 100 + s_suppkey, 'S' || s_suppkey FROM supplier),
claims AS (SELECT cik, sid, min(pos) AS pos, max(nm) AS nm FROM docs GROUP BY 1, 2),
per AS (SELECT sid, min(cik) AS lo, max(cik) AS hi FROM claims GROUP BY 1),
ovr AS (SELECT c_nationkey AS sid, min(lpad(CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR), 10, '0')) AS ocik FROM customer WHERE c_acctbal >= 9000 AND c_nationkey < 10 GROUP BY 1),
choice AS (SELECT p.sid, lo <> hi AS collision, coalesce(ocik, CASE WHEN lo = hi THEN lo END) AS cik FROM per p LEFT JOIN ovr USING (sid)),
chosen AS (SELECT c.sid, c.cik, c.collision, cl.pos, cl.nm, row_number() OVER (PARTITION BY c.cik ORDER BY cl.pos, c.sid) AS rk FROM choice c JOIN claims cl ON cl.sid = c.sid AND cl.cik = c.cik)
SELECT u.sid AS security_id, u.ticker, ch.cik, ch.nm AS registrant_name, CASE WHEN ch.sid IS NOT NULL AND ch.collision THEN 'REVIEWED_EFFECTIVE_DATED_OVERRIDE' WHEN ch.rk = 1 THEN 'EXACT_SEC_PRIMARY_TICKER' WHEN ch.rk > 1 THEN 'EXACT_SEC_ADDITIONAL_CLASS'
  WHEN c.sid IS NOT NULL THEN 'UNRESOLVED_CIK_IDENTITY_CONFLICT' ELSE 'UNMAPPED_SEC_CIK' END AS mapping_status FROM u LEFT JOIN chosen ch ON ch.sid = u.sid LEFT JOIN choice c ON c.sid = u.sid AND c.cik IS NULL""")
def security_master(t: Tables) -> DataFrame:
    """Rich customers register their nation's ticker, suppliers their own."""
    balance = F.floor("c_acctbal").cast("bigint").cast("string")
    rich = t.customer.filter("c_acctbal >= 9000")
    registrants = rich.select(
        F.lpad(balance, 10, "0").alias("cik"), F.concat(F.lit("N"), balance).alias("registrant_name"), F.lit(None).cast("string").alias("sic"),
        F.concat(F.lit("n-"), "c_nationkey").alias("ticker"), F.col("c_custkey").alias("ticker_position"),
    ).unionByName(t.supplier.select(
        F.lpad((F.col("s_suppkey") + 100000).cast("string"), 10, "0").alias("cik"), F.concat(F.lit("S"), "s_suppkey").alias("registrant_name"),
        F.lit(None).cast("string").alias("sic"), F.concat(F.lit("S"), "s_suppkey").alias("ticker"), F.col("s_suppkey").alias("ticker_position"),
    ))
    universe = t.nation.select(
        F.col("n_nationkey").cast("bigint").alias("security_id"), F.concat(F.lit("N."), "n_nationkey").alias("ticker"), F.lit("XNAS").alias("exchange_mic")
    ).unionByName(t.supplier.select(
        (F.col("s_suppkey") + 100).alias("security_id"), F.concat(F.lit("S"), "s_suppkey").alias("ticker"), F.lit("XNYS").alias("exchange_mic")
    ))
    reviewed = rich.filter("c_nationkey < 10").groupBy(F.col("c_nationkey").cast("bigint").alias("security_id")).agg(F.min(F.lpad(balance, 10, "0")).alias("override_cik"))
    out, _ = f.build_security_master(registrants, universe, reviewed, revision="r1", retrieved_at=F.lit("2024-01-01").cast("timestamp"))
    return out.select("security_id", "ticker", "cik", "registrant_name", "mapping_status")
