"""Landed files with odd layouts, and issuer requests with missing parts."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark import sources
from tidemark.functions.quotes import quote_block_reasons
from tidemark.plans import ownership
from tidemark.sources.market import read_charts


def test_tab_separated_columns_go_by_name(spark, tmp_path, rows):
    (tmp_path / "W.tsv").write_text("A\tB\tC\n1\t2\t3\n4\t5\t6\n")
    assert rows(sources.read_tsv_table(spark, str(tmp_path), "W.tsv", ["C", "A"])) == [("3", "1"), ("6", "4")]
    with pytest.raises(ValueError, match="no column D"):
        sources.read_tsv_table(spark, str(tmp_path), "W.tsv", ["A", "D"])


def test_short_interest_layouts(spark, tmp_path):
    records = [{"symbolCode": s, "settlementDate": "2031-03-14"} for s in ("QA", "QB", "QC")]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, records)))
    (tmp_path / "array.json").write_text(json.dumps(records))
    assert sources.read_short_interest(spark, str(tmp_path / "lines.json"), "lines").count() == 3
    assert sources.read_short_interest(spark, str(tmp_path / "array.json")).count() == 3
    (tmp_path / "bad.json").write_text('{"symbolCode": "QA"}\n{"symbolCode": \n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        sources.read_short_interest(spark, str(tmp_path / "bad.json"), "lines").collect()


def test_charts_without_results(spark, tmp_path):
    quote = {"indicators": {"quote": [], "adjclose": []}, "meta": {"symbol": "qa"}, "timestamp": [1]}
    for k, result in enumerate(([], None, [quote])):
        (tmp_path / f"{k}.json").write_text(json.dumps({"chart": {"result": result}}))
    got = read_charts(spark, str(tmp_path)).collect()
    assert sorted((r["symbol"] or "", r["open"]) for r in got) == [("", None), ("", None), ("QA", None)]


def test_quotes_need_finite_numbers(spark):
    nan, inf = float("nan"), float("inf")
    cases = [(1.0, 5.0, 6.0, 9.0), (nan, 5.0, 6.0, 9.0), (inf, 5.0, 6.0, 9.0), (1.0, nan, 6.0, 9.0), (1.0, 5.0, inf, 9.0), (1.0, 5.0, 6.0, nan)]
    at = "timestamp '2031-03-14 15:00:00'"
    df = spark.createDataFrame(cases, "last double, bs double, asz double, upper double").selectExpr(
        f"named_struct('state', 'AVAILABLE', 'bid', 10.0d, 'ask', 10.01d, 'last', last, 'bid_size', bs, 'ask_size', asz, 'session', 'REGULAR', 'feed_type', 'SIP', 'quote_at_utc', {at}) as quote",
        f"named_struct('halt_status', 'NOT_HALTED', 'luld_status', 'NORMAL', 'lower_band', 8.0d, 'upper_band', upper, 'observed_at_utc', {at}) as market_status",
        f"named_struct('eligible', true, 'reason_codes', cast(array() as array<string>), 'observed_at_utc', {at}) as broker_eligibility",
        *(f"{at} as {c}" for c in ("cutoff_utc", "generated_at_utc", "requested_at_utc", "received_at_utc")))
    got = [set(r[0]) & {"INVALID_QUOTE_VALUE", "INVALID_LULD_BANDS"} for r in df.select(quote_block_reasons()).collect()]
    assert got == [set()] + [{"INVALID_QUOTE_VALUE"}] * 4 + [{"INVALID_LULD_BANDS"}]


def test_issuer_requests_with_missing_parts(spark):
    master = spark.createDataFrame([("S1", "0000000001"), ("S2", "0000000002"), ("S3", "0000000002"), ("S4", "0000000004")], "security_id string, cik string")
    universe = spark.createDataFrame([("S1", "QA"), ("S2", "QB"), ("S3", "QC"), ("S1", "QD"), ("S4", "QD")], "security_id string, ticker string")
    asked = spark.createDataFrame([("0000000001", None), (None, "QA"), ("0000000002", "QD"), ("0000000002", None), ("0000000002", "QB"), (None, None)], "issuer_cik string, issuer_symbol string")
    good, bad = ownership.resolve_issuer(asked, master, universe)
    assert sorted((r["issuer_cik"], r["issuer_symbol"] or "", r["security_id"]) for r in good.collect()) == [("0000000001", "", "S1"), ("0000000002", "QB", "S2")]
    reasons = {(r["issuer_cik"], r["issuer_symbol"]): r["reject_reason"] for r in bad.collect()}
    assert reasons == {(None, "QA"): "TICKER_CIK_CONFLICT", ("0000000002", "QD"): "AMBIGUOUS_TICKER", ("0000000002", None): "AMBIGUOUS_SHARE_CLASS", (None, None): "UNKNOWN_ISSUER_CIK"}
