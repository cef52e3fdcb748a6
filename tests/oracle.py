"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def duck(directory: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{directory}/{table}.parquet')")
    return con


def cell(value):
    if value is None:
        return "\0"
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value + 0.0:.12g}"
    return str(value)


def rows_of(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in data)


def compare(spark, con, name, query, sql, directory):
    """(problems, rows, spark seconds)."""
    started = time.time()
    df = query(spark, directory)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    if sql is None:
        return [], len(got), seconds
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} <> {sorted(names)}"], len(got), seconds
    kinds = {n: str(k) for n, k in zip(names, [d[1] for d in con.execute(f"DESCRIBE {sql}").fetchall()])}
    for field in df.schema.fields:
        if KINDS.get(kinds[field.name], kinds[field.name]) != field.dataType.simpleString():
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} <> {kinds[field.name]}")
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} <> {len(b)}")
    if a != b:
        left, right = [r for r in a if r not in set(b)][:3], [r for r in b if r not in set(a)][:3]
        problems.append(f"values differ: spark {left} duckdb {right}")
    return problems, len(got), seconds


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidemark.session import build_session

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(directory)
    bad = 0
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            problems, rows, seconds = compare(spark, con, name, query, sqls.get(name), directory)
        except Exception as error:  # noqa: BLE001
            problems, rows, seconds = [f"{type(error).__name__}: {str(error)[:900]}"], -1, 0.0
        bad += bool(problems)
        print(f"\n{'FAIL' if problems else 'ok  ' if name in sqls else 'rows'} {name} rows={rows} {seconds:.2f}s", *problems, sep="\n     ", flush=True)
    print("failed:", bad)
    spark.stop()
