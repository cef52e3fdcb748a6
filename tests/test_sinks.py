"""Contract writers publish whole tables or nothing, and readers keep malformed records apart."""

from __future__ import annotations

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark import sources
from tidemark.contracts import PRICES


def bars(spark, closes):
    rows = [(f"s{k % 3}", f"T{k % 3}", f"T{k % 3}", date(2031, 1, 1 + k // 3), 1.0, 2.0, 0.5, c, 10, "D", "r", "t") for k, c in enumerate(closes)]
    return spark.createDataFrame(rows, PRICES.schema)


def test_a_table_is_published_and_replaced(spark, tmp_path, rows):
    out = str(tmp_path / "prices")
    first = sources.write_prices(bars(spark, [1.0, 2.0, 3.0, 4.0]), out)
    assert first.schema == PRICES.schema and rows(first, "close") == [(1.0,), (2.0,), (3.0,), (4.0,)]
    second = sources.write_prices(spark.read.parquet(out).withColumn("close", F.col("close") + 1), out)
    assert rows(second, "close") == [(2.0,), (3.0,), (4.0,), (5.0,)]
    assert os.listdir(tmp_path) == ["prices"]  # neither the old version nor a half-written one stays


def test_the_plan_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    sources.write_prices(bars(spark, [1.0] * 9).mapInArrow(count, PRICES.schema), str(tmp_path / "p"))
    assert seen.value == 9


@pytest.mark.parametrize(("spoil", "rule", "n"), [
    (lambda d: d.unionByName(d.limit(2)), "DUPLICATE_KEY", 2),
    (lambda d: d.withColumn("open", F.when(F.col("close") == 2, F.lit(float("nan"))).otherwise(F.col("open"))), "NON_FINITE_OPEN", 1),
    (lambda d: d.withColumn("security_id", F.when(F.col("close") > 1, F.col("security_id"))), "NULL_KEY", 1),
])
def test_a_refused_table_leaves_the_old_one(spark, tmp_path, rows, spoil, rule, n):
    out = str(tmp_path / "prices")
    sources.write_prices(bars(spark, [7.0]), out)
    with pytest.raises(sources.ContractViolation) as refused:
        sources.write_prices(spoil(bars(spark, [1.0, 2.0, 3.0])), out)
    assert refused.value.broken == {rule: n}
    assert rows(spark.read.parquet(out), "close") == [(7.0,)] and os.listdir(tmp_path) == ["prices"]
    with pytest.raises(sources.ContractViolation, match="extra"):
        sources.write_prices(bars(spark, [1.0]).withColumn("x", F.lit(1)), out)


def test_malformed_records_are_kept_apart(spark, tmp_path, rows):
    (tmp_path / "r.csv").write_text("cusip,security_id\na1,S1\na2,S2,extra\na3\n,S4\n")
    (tmp_path / "s.json").write_text('{"symbolCode": "q"}\n{"symbolCode": \n{"symbolCode": "r"}\n')
    (tmp_path / "c.json").write_text(json.dumps({"version": "1", "taxonomy_precedence": ["x"], "concepts": {"a": ["b"]}}))
    rejects = sources.Rejects(spark)
    good, bad = sources.read_registry(spark, str(tmp_path / "r.csv"), ["cusip", "security_id"], ["cusip"], rejects=rejects)
    short = sources.read_short_interest(spark, str(tmp_path / "s.json"), "lines", rejects)
    concepts, _ = sources.read_concept_map(spark, str(tmp_path / "c.json"), rejects)
    assert rows(good) == [("A1", "S1")] and bad.count() == 1 and rows(short, "symbol") == [("Q",), ("R",)] and concepts.count() == 1
    got = rejects.frame()
    assert rows(got, "reader", "record") == [("registry", "a2,S2,extra"), ("registry", "a3"), ("short_interest", '{"symbolCode": ')]
    assert all(r["source_file"].endswith((".csv", ".json")) for r in got.collect())
    assert sources.Rejects(spark).frame().count() == 0
