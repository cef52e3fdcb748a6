"""Queries against their SQL on rows that the small tables lack: keys over six digits, prices of 0, ties, many managers."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tests.oracle import TABLES, compare, duck

QUERIES, SQL = entry.queries(), entry.oracle_sql()
CHANGED = {
    # pairs of orders of one customer and day whose keys share six digits, and single ones
    "orders": """SELECT * REPLACE (2 * o_orderkey + 1000000 AS o_orderkey) FROM t WHERE o_orderkey < 60
        UNION ALL SELECT * REPLACE (2 * o_orderkey + 1000001 AS o_orderkey, o_totalprice + 70 AS o_totalprice) FROM t WHERE o_orderkey < 40
        UNION ALL SELECT * REPLACE (o_orderkey + 2000000 AS o_orderkey) FROM t WHERE o_orderkey < 40""",
    # prices of 0; every row of some users twice at one time
    "events": """SELECT * REPLACE (CASE WHEN event_id % 17 = 0 THEN 0.0 ELSE value END AS value) FROM t
        UNION ALL SELECT * REPLACE (event_id + 1000000 AS event_id, value + 1 AS value) FROM t WHERE user_id % 5 = 0""",
    # one brand held by 4,000 managers in a quarter of its own
    "lineitem": """FROM t UNION ALL SELECT l_orderkey, l_partkey, i AS l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, 'A', 'O', TIMESTAMP '2010-03-01 00:00:00'
        FROM (FROM t LIMIT 1) CROSS JOIN (SELECT unnest(range(4000)) AS i)""",
}


@pytest.fixture(scope="module")
def wide(tmp_path_factory):
    out = tmp_path_factory.mktemp("wide")
    con = duckdb.connect()
    for table in TABLES:
        source = f"{SF}/{table}.parquet"
        if table in CHANGED:
            con.execute(f"CREATE OR REPLACE VIEW t AS FROM read_parquet('{source}')")
            con.execute(f"COPY ({CHANGED[table]}) TO '{out}/{table}.parquet' (FORMAT parquet)")
        elif os.path.exists(source):
            os.symlink(source, f"{out}/{table}.parquet")
    return str(out)


@pytest.mark.parametrize("name", [
    "company_facts", "evidence_union", "filings", "ownership_signals", "quote_reasons", "streaming_quotes", "streaming_segments",
])
def test_query_equals_sql(spark, wide, name):
    problems, rows, _ = compare(spark, duck(wide), name, QUERIES[name], SQL[name], wide)
    assert rows and not problems


def test_facts_keep_the_whole_order_key(spark, wide):
    got = {r[0] for r in QUERIES["company_facts"](spark, wide).select("order_key").collect()}
    assert got == {r[0] for r in spark.read.parquet(f"{wide}/orders.parquet").select("o_orderkey").collect()}
