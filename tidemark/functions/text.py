"""Identifiers, names, symbols and classification by text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import col

__all__ = [
    "clean_symbol", "symbol_aliases", "ticker_variants", "cik10", "cik10_strict",
    "normalize_name", "collapse_spaces", "classify_security", "admission",
    "reviewed_type", "hash_id", "filing_url", "accession_ok", "cik_ok", "hex64_ok",
    "form_emitted", "filing_attribution", "unit_status", "blank_to_null",
    "FILING_FORMS", "SUPPORTED_UNITS",
]

# Filing forms kept as rows; prospectus forms add the prefix 424B.
FILING_FORMS = (
    "10-K", "10-K/A", "10-Q", "10-Q/A", "8-K", "8-K/A", "6-K", "20-F", "40-F",
    "S-1", "S-3", "DEF 14A", "DEFA14A", "SC 13D", "SC 13D/A", "SC 13G", "SC 13G/A",
    "SCHEDULE 13D", "SCHEDULE 13D/A", "SCHEDULE 13G", "SCHEDULE 13G/A",
    "SC TO", "SC TO-I", "SC TO-T", "PREM14A", "DEFM14A",
)
SUPPORTED_UNITS = ("USD", "shares", "USD/shares", "pure")


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(F.trim(col(value).cast("string")), F.lit(""))


def clean_symbol(value: Column | str) -> Column:
    return F.upper(F.trim(col(value)))


def symbol_aliases(ticker: Column | str) -> Column:
    """EXP-06. Distinct source spellings; the array index is the priority."""
    t = clean_symbol(ticker)
    spellings = F.array(t, F.replace(t, F.lit("."), F.lit("-")), F.replace(t, F.lit("/"), F.lit("-")))
    return F.filter(F.array_distinct(spellings), lambda s: s != "")


def ticker_variants(symbol: Column | str) -> Column:
    """EXP-07. Spellings tried when a source symbol is looked up as a ticker."""
    s = clean_symbol(symbol)
    return F.array_distinct(
        F.array(s, F.replace(s, F.lit("-"), F.lit(".")), F.replace(s, F.lit("/"), F.lit(".")))
    )


def _digits(value: Column | str) -> Column:
    return F.regexp_replace(col(value).cast("string"), r"[^0-9]", "")


def cik10(value: Column | str) -> Column:
    """EXP-08. Digits left-padded to ten; longer text is kept, no digits give NULL."""
    d = _digits(value)
    return F.when(F.length(d) == 0, F.lit(None)).when(F.length(d) < 10, F.lpad(d, 10, "0")).otherwise(d)


def cik10_strict(value: Column | str) -> Column:
    """EXP-08. As :func:`cik10` but more than ten digits give NULL."""
    return F.when(F.length(_digits(value)) <= 10, cik10(value))


def normalize_name(value: Column | str) -> Column:
    """EXP-09. Upper case, every non-alphanumeric run one space."""
    return F.trim(F.regexp_replace(F.upper(F.coalesce(col(value), F.lit(""))), "[^A-Z0-9]+", " "))


def collapse_spaces(value: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.upper(F.coalesce(col(value), F.lit(""))), r"\s+", " "))


# Ordered name rules of the security classifier, first match wins.
# (label, pattern that must match, pattern that must not match)
NAME_RULES = (
    ("WARRANT", r"\bWARRANTS?\b", None),
    ("RIGHT", r"\bRIGHTS?\b", None),
    ("PREFERRED", r"\bPREFERRED\b|\bPREFERENCE\b", None),
    ("PREFERRED", r"\bDEPOSITARY SHARES?\b", r"\bAMERICAN DEPOSIT(?:A|O)RY SHARES?\b"),
    ("OTHER", r"\bNOTES?\b|\bBONDS?\b|\bDEBENTURES?\b", None),
    ("ADR", r"\bAMERICAN DEPOSIT(?:A|O)RY SHARES?\b|\bADRS?\b|\bADS\b", None),
    ("REIT", r"SHARES OF BENEFICIAL INTEREST", None),
    ("MLP", r"\b(?:COMMON|LIMITED PARTNERSHIP) UNITS?\b", None),
    ("UNIT", r"\bUNITS?\b", None),
    ("COMMON", r"\bORDINARY SHARES?\b", None),
    ("COMMON", r"\bCOMMON STOCK\b|\bCOMMON SHARES?\b", None),
)


def classify_security(
    name: Column | str, is_etf: Column, is_nextshares: Column, rules=NAME_RULES
) -> Column:
    """EXP-03. Ordered cascade over the listing name."""
    text = collapse_spaces(name)
    label = F.when(is_etf, F.lit("ETF")).when(is_nextshares, F.lit("OTHER"))
    for kind, wanted, unwanted in rules:
        test = text.rlike(wanted)
        if unwanted:
            test = test & ~text.rlike(unwanted)
        label = label.when(test, F.lit(kind))
    return label.otherwise(F.lit("OTHER"))


def reviewed_type(adr_status: Column | str, named_type: Column | str) -> Column:
    """EXP-05. Reviewed depositary status wins over the name."""
    return F.when(col(adr_status) == "ADR", F.lit("ADR")).otherwise(col(named_type))


def admission(
    security_type: Column | str, is_test: Column, financial_status: Column,
    exchange_country: Column | str, currency: Column | str, listing_status: Column | str,
    leveraged: Column | str, inverse: Column | str, cik: Column | str,
) -> Column:
    """EXP-04. struct(status, reason); a NULL financial status is not tested."""
    kind = col(security_type)

    def pair(status: str, reason: Column | str) -> Column:
        reason = F.lit(reason) if isinstance(reason, str) else reason
        return F.struct(F.lit(status).alias("status"), reason.alias("reason"))

    out = F.when(is_test, pair("REJECTED_INACTIVE", "TEST_ISSUE"))
    out = out.when(col(exchange_country) != "USA", pair("REJECTED_NON_US", "EXCHANGE_COUNTRY_NOT_USA"))
    out = out.when(col(currency) != "USD", pair("REJECTED_NON_USD", "CURRENCY_NOT_USD"))
    out = out.when(col(listing_status) != "ACTIVE", pair("REJECTED_INACTIVE", "LISTING_NOT_ACTIVE"))
    status_code = F.when(financial_status == "", F.lit("MISSING")).otherwise(financial_status)
    out = out.when(
        financial_status.isNotNull() & (financial_status != "N"),
        pair("REJECTED_INACTIVE", F.concat(F.lit("NASDAQ_FINANCIAL_STATUS_"), status_code)),
    )
    etf = kind == "ETF"
    out = out.when(etf & (col(leveraged) == "true"), pair("REJECTED_LEVERAGED_ETF", "LEVERAGED_ETF"))
    out = out.when(etf & (col(inverse) == "true"), pair("REJECTED_INVERSE_ETF", "INVERSE_ETF"))
    out = out.when(etf, pair("ADMITTED_ETF", "ADMITTED_ELIGIBLE_ETF"))
    adr = kind == "ADR"
    out = out.when(adr & (F.coalesce(col(cik), F.lit("")) == ""), pair("REJECTED_IDENTITY_CONFLICT", "ADR_CIK_MISSING"))
    out = out.when(adr, pair("ADMITTED", "ADMITTED_ADR"))
    out = out.when(kind == "COMMON", pair("ADMITTED", "ADMITTED_COMMON"))
    for excluded in ("WARRANT", "RIGHT", "UNIT"):
        out = out.when(kind == excluded, pair(f"REJECTED_{excluded}", excluded))
    return out.otherwise(pair("REJECTED_UNKNOWN_SECURITY_TYPE", kind))


def hash_id(*values: Column | str) -> Column:
    """EXP-16. sha256 of the values joined by '|', NULL as empty text."""
    parts = [F.coalesce(col(v).cast("string"), F.lit("")) for v in values]
    return F.sha2(F.concat_ws("|", *parts), 256)


def filing_url(cik: Column | str, accession: Column | str, document: Column | str) -> Column:
    """EXP-17. Document address; the directory when there is no document."""
    return F.concat(
        F.lit("https://www.sec.gov/Archives/edgar/data/"),
        col(cik).try_cast("bigint").cast("string"), F.lit("/"),
        F.replace(col(accession), F.lit("-"), F.lit("")), F.lit("/"),
        F.coalesce(F.trim(col(document)), F.lit("")),
    )


def accession_ok(value: Column | str) -> Column:
    """EXP-25. The whole text, so a trailing line break fails."""
    return F.coalesce(col(value).rlike(r"\A[0-9]{10}-[0-9]{2}-[0-9]{6}\z"), F.lit(False))


def cik_ok(value: Column | str) -> Column:
    return F.coalesce(col(value).rlike(r"\A[0-9]{10}\z"), F.lit(False))


def hex64_ok(value: Column | str) -> Column:
    return F.coalesce(col(value).rlike(r"\A[0-9a-f]{64}\z"), F.lit(False))


def form_emitted(form: Column | str) -> Column:
    """EXP-22."""
    return col(form).isin(*FILING_FORMS) | col(form).startswith("424B")


def filing_attribution(form: Column | str, cik: Column | str, accession: Column | str) -> Column:
    """EXP-21. Ownership forms belong to the subject, all others to the filer."""
    f = col(form)
    base = F.regexp_replace(f, r"/A\z", "")
    subject_form = f.contains("13D") | f.contains("13G") | base.isin("3", "4", "5")
    is_filer = col(cik) == F.substring(col(accession), 1, 10)
    return F.when(subject_form, ~is_filer).otherwise(is_filer)


def unit_status(unit: Column | str) -> Column:
    """EXP-23."""
    return F.when(col(unit).isin(*SUPPORTED_UNITS), F.lit("SUPPORTED")).otherwise(F.lit("UNSUPPORTED"))
