"""Listing feeds, registries and the universe from files."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import sources
from tidemark.plans import universe as u

LISTED = [
    ("ACME", "Acme Inc. - Common Stock", "N", "N", "N", "N"), ("SADR", "Sample SA - American Depositary Shares", "N", "N", "N", "N"),
    ("LATE", "Late Filer Corp. - Common Stock", "N", "D", "N", "N"), ("BOND", "Sample Holdings - 5.00% Senior Notes due 2030", "N", "N", "N", "N"),
    ("FUND", "Sample Equity ETF", "N", "N", "Y", "N"), ("PTNR", "Sample Partners - Common Units", "N", "N", "N", "N"),
    ("NXTS", "Sample NextShares Fund", "N", "N", "N", "Y"), ("ORDI", "Sample PLC - Ordinary   Shares", "N", "N", "N", "N"),
    ("PADS", "Sample Bank - American Depositary Shares representing Preferred Stock", "N", "N", "N", "N"),
    ("DEPO", "Sample Bank - Depositary Shares", "N", "N", "N", "N"), ("TRST", "Sample Trust - Shares of Beneficial Interest", "N", "N", "N", "N"),
    ("RGHT", "Sample Acquisition Corp. - Rights", "N", "N", "N", "N"), ("TSTI", "Test Issue - Common Stock", "Y", "N", "N", "N"),
    ("UNIT", "Sample Acquisition Corp. - Units", "N", "N", "N", "N"), ("WARR", "Sample Partners - Warrants to purchase Common Units", "N", "N", "N", "N"),
    ("UNKN", "Sample Structured Instrument", "N", "N", "N", "N"),
]
EXPECTED = {
    "ACME": ("COMMON", "ADMITTED"), "SADR": ("ADR", "REJECTED_IDENTITY_CONFLICT"), "LATE": ("COMMON", "REJECTED_INACTIVE"),
    "BOND": ("OTHER", "REJECTED_UNKNOWN_SECURITY_TYPE"), "FUND": ("ETF", "ADMITTED_ETF"), "PTNR": ("MLP", "REJECTED_UNKNOWN_SECURITY_TYPE"),
    "NXTS": ("OTHER", "REJECTED_UNKNOWN_SECURITY_TYPE"), "ORDI": ("COMMON", "ADMITTED"), "PADS": ("PREFERRED", "REJECTED_UNKNOWN_SECURITY_TYPE"),
    "DEPO": ("PREFERRED", "REJECTED_UNKNOWN_SECURITY_TYPE"), "TRST": ("REIT", "REJECTED_UNKNOWN_SECURITY_TYPE"), "RGHT": ("RIGHT", "REJECTED_RIGHT"),
    "TSTI": ("COMMON", "REJECTED_INACTIVE"), "UNIT": ("UNIT", "REJECTED_UNIT"), "WARR": ("WARRANT", "REJECTED_WARRANT"),
    "UNKN": ("OTHER", "REJECTED_UNKNOWN_SECURITY_TYPE"), "BRK.B": ("COMMON", "ADMITTED"), "TADR": ("ADR", "ADMITTED"), "MAGN": ("ETF", "ADMITTED_ETF"),
}


@pytest.fixture
def files(tmp_path):
    first = ["|".join(sources.NASDAQ_FEED_COLUMNS)] + [f"{s}|{n}|Q|{test}|{fin}|100|{etf}|{nxt}" for s, n, test, fin, etf, nxt in LISTED]
    second = ["|".join(sources.OTHER_FEED_COLUMNS)] + [
        "SKIP|Ignored Venue - Common Stock|A|SKIP|N|100|N|SKIP", "BRK.B|Sample Class B - Common Stock|N|BRK.B|N|100|N|BRK-B",
        "TADR|Far East Semiconductor - Common Stock|N|TADR|N|100|N|TADR", "MAGN|Seven ETF|Z|MAGN|Y|100|N|MAGN",
    ]
    trailer = "File Creation Time: 0716202621:31|||||||"
    (tmp_path / "a.txt").write_text("\n".join([*first, trailer]) + "\n")
    (tmp_path / "b.txt").write_text("\n".join([*second, trailer]) + "\n")
    fields = ",".join(u.METADATA_FIELDS)
    row = {"exchange_mic": "xnys", "source_symbol": "tadr", "cik": "0001046179", "adr_status": "adr", "currency": "usd", "listing_status": "active", "exchange_country": "usa"}
    (tmp_path / "meta.csv").write_text(fields + "\n" + ",".join(row.get(f, "") for f in u.METADATA_FIELDS) + "\n" + "," * (len(u.METADATA_FIELDS) - 1) + "\n")
    (tmp_path / "over.csv").write_text(",".join(u.OVERRIDE_FIELDS) + "\n")
    return tmp_path


def build(spark, files, overrides=None):
    nasdaq, created = sources.read_directory_feed(spark, str(files / "a.txt"), sources.NASDAQ_FEED_COLUMNS)
    other, _ = sources.read_directory_feed(spark, str(files / "b.txt"), sources.OTHER_FEED_COLUMNS)
    metadata, bad = sources.read_registry(spark, str(files / "meta.csv"), u.METADATA_FIELDS, ["exchange_mic", "source_symbol"])
    assert bad.count() == 0 and metadata.count() == 1
    registry, rejected = sources.read_registry(spark, str(files / "over.csv"), u.OVERRIDE_FIELDS, ["exchange_mic", "source_symbol"], required=["reason"])
    stamp = F.lit(created.first()[0])
    return u.build_universe(
        nasdaq, other, metadata, registry, created={"nasdaqlisted.txt": stamp, "otherlisted.txt": stamp},
        digests={"nasdaqlisted.txt": "a" * 64}, generated_at=F.lit(datetime(2026, 7, 17, 2)),
    ), rejected


def test_feed_trailer_is_exchange_local_time(spark, files):
    rows, created = sources.read_directory_feed(spark, str(files / "a.txt"), sources.NASDAQ_FEED_COLUMNS)
    assert rows.count() == len(LISTED)
    assert created.select(F.date_format("created_at_utc", "yyyy-MM-dd HH:mm")).first()[0] == "2026-07-17 01:31"


def test_types_and_admission(spark, files):
    built, _ = build(spark, files)
    got = {r["ticker"]: r for r in built.rows.collect()}
    assert {k: (v["security_type"], v["universe_admission_status"]) for k, v in got.items()} == EXPECTED
    assert got["BRK.B"]["security_id"] == "XNYS:BRK.B" and got["MAGN"]["exchange_mic"] == "BATS"
    assert got["TADR"]["cik"] == "0001046179" and got["MAGN"]["leveraged"] == "false"
    assert got["TSTI"]["admission_reason"] == "TEST_ISSUE" and got["LATE"]["admission_reason"] == "NASDAQ_FINANCIAL_STATUS_D"
    assert got["ACME"]["source_file_created_at_utc"] == "2026-07-17T01:31:00Z"
    assert built.problems.count() == 0


def test_overrides_and_problems(spark, files):
    with (files / "over.csv").open("a") as f:
        f.write("XNAS,UNKN,admit,,,ETF,looked at\nXNAS,ACME,EXCLUDE,,,,fraud\nXNAS,GONE,EXCLUDE,,,,left\nXNAS,GONE2,EXCLUDE,,,,\nXNAS,ORDI,ADMIT,XNYS:BRK.B,BRK.B,COMMON,same id\n")
    built, rejected = build(spark, files)
    got = {r["source_symbol"]: r for r in built.rows.collect()}
    assert (got["UNKN"]["universe_admission_status"], got["UNKN"]["admission_reason"]) == ("ADMITTED_ETF", "OVERRIDE_ADMIT:looked at")
    assert got["ACME"]["universe_admission_status"] == "REJECTED_UNKNOWN_SECURITY_TYPE"
    assert [r["source_symbol"] for r in rejected.collect()] == ["GONE2"]
    problems = {(r["problem"], r["key"]) for r in built.problems.collect()}
    assert problems == {("OVERRIDE_WITHOUT_LISTING", "XNAS:GONE"), ("SECURITY_ID_COLLISION", "XNYS:BRK.B")}


def test_feed_age(spark, files):
    rows = spark.createDataFrame([("a", datetime(2026, 7, 1)), ("b", datetime(2026, 7, 3, 3)), ("c", datetime(2026, 7, 2))], "source_file string, created_at_utc timestamp")
    got = u.source_age_problems(rows, F.lit(datetime(2026, 7, 3)), 36).collect()
    assert {(r["source_file"], r["problem"]) for r in got} == {("a", "SOURCE_TOO_OLD"), ("b", "SOURCE_IN_FUTURE")}


def test_universe_reader_rejects_bad_identity(spark, tmp_path):
    (tmp_path / "u.csv").write_text(
        "security_id,ticker,exchange_mic,universe_admission_status\nX:A,A,X,ADMITTED\nX:B,,X,ADMITTED_ETF\nX:C,C,X,REJECTED_UNIT\nX:D,D,X,ADMITTED\nX:D,E,X,ADMITTED\n"
    )
    good, bad = sources.read_universe(spark, str(tmp_path / "u.csv"), ["security_id", "ticker", "exchange_mic", "universe_admission_status"])
    assert [r["security_id"] for r in good.collect()] == ["X:A"]
    assert sorted((r["security_id"], *r["reject_reasons"]) for r in bad.collect()) == [
        ("X:B", "BLANK_TICKER"), ("X:D", "DUPLICATE_SECURITY_ID"), ("X:D", "DUPLICATE_SECURITY_ID")
    ]


def test_publication_schedule(spark, tmp_path):
    (tmp_path / "s.csv").write_text("settlement_date,publication_date,source_url\n2026-01-15,2026-01-27,u\n2026-01-30,2026-01-20,u\n2026-02-13,2026-02-25,u\n")
    good, bad = sources.read_publication_schedule(spark, str(tmp_path / "s.csv"), F.lit("2026-02-01").cast("date"))
    assert [str(r["settlement_date"]) for r in good.collect()] == ["2026-01-15"]
    assert [str(r["settlement_date"]) for r in bad.collect()] == ["2026-01-30"]
