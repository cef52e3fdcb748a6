"""No task of the alias choice sorts its whole split or holds all aliases."""

from __future__ import annotations

import pytest

from tidemark import catalog

from tests.conftest import SF


@pytest.mark.parametrize("name", ["best_alias"])
def test_rows_are_dealt_by_key_before_they_are_ranked(spark, name):
    plan = catalog.ENTRIES[name](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    lines = plan.splitlines()
    dealt = next(i for i, line in enumerate(lines) if "Exchange" in line and "REPARTITION_BY_COL" in line)
    assert not any("WindowGroupLimit" in line for line in lines[dealt:])
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan


def test_aliases_are_not_broadcast(spark):
    from pyspark.sql import functions as F

    from tidemark import sources
    from tidemark.catalog.base import Tables, dealt_aliases

    symbols = spark.range(100).select(F.concat(F.lit("P."), "id", F.lit("/A")).alias("symbol"), F.lit("2001-01-01").alias("report_date"), F.lit("2:1").alias("split_factor"))
    good, _ = sources.market.normalize_splits(symbols, dealt_aliases(Tables(spark, SF)), F.lit("2030-01-01").cast("date"), dataset="S", revision="1", observed_at="-")
    assert "Broadcast" not in good._jdf.queryExecution().sparkPlan().toString()
