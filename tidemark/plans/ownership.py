"""Insider transactions, institutional holdings and their signals (PIP-10 .. PIP-13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    accession_ok, available_date, blank_to_null, bool_value, cik10, finite_number, normalize_name, null_poisoned_sum,
    parse_source_date, pit_columns,
)
from tidemark.operators.keys import latest_per_key
from tidemark.operators.quality import quarantine
from tidemark.session import stage
from tidemark.operators.stats import top_share
from tidemark.plans.filings import resolve_tickers


def issuer_decisions(requests: DataFrame, master: DataFrame, universe: DataFrame) -> DataFrame:
    """JOI-10. (issuer_cik, issuer_symbol, security_id, reject_reason) per distinct request.

    The CIK decides; several classes of one CIK need a ticker that belongs to it. Only
    counts and minima per CIK are kept, never its list of classes.
    """
    pairs = requests.select("issuer_cik", "issuer_symbol").distinct()
    classes = master.filter("cik is not null and cik <> ''").groupBy(cik10("cik").alias("issuer_cik")).agg(
        F.count(F.lit(1)).alias("_classes"), F.min("security_id").alias("_only")
    )
    named = pairs.filter("issuer_symbol IS NOT NULL").select("issuer_symbol").distinct()
    resolved, clashing = resolve_tickers(named, universe, "issuer_symbol", [])
    tickers = resolved.select("issuer_symbol", F.col("security_id").alias("_ticker_id"), F.lit(False).alias("_clash")).filter("_ticker_id IS NOT NULL").unionByName(
        clashing.select("issuer_symbol", F.lit(None).cast("string").alias("_ticker_id"), F.lit(True).alias("_clash")).distinct())
    by_ticker = pairs.join(tickers, "issuer_symbol", "left")
    owner = master.select(F.col("security_id").alias("_ticker_id"), cik10("cik").alias("_ticker_cik"))
    joined = by_ticker.join(owner, "_ticker_id", "left").join(classes, "issuer_cik", "left")
    n, ticker = F.coalesce("_classes", F.lit(0)), F.col("_ticker_id")
    in_class = ticker.isNotNull() & (F.col("_ticker_cik") == F.col("issuer_cik"))
    chosen = F.when(n == 1, F.col("_only")).when((n > 1) & in_class, ticker)
    reason = (
        F.when(chosen.isNotNull(), F.lit(None).cast("string"))
        .when(F.col("_clash"), F.lit("AMBIGUOUS_TICKER"))
        .when(ticker.isNotNull() & F.col("_ticker_cik").isNull(), F.lit("MISSING_CANONICAL_CIK"))
        .when(ticker.isNotNull(), F.lit("TICKER_CIK_CONFLICT"))
        .when(n > 1, F.lit("AMBIGUOUS_SHARE_CLASS"))
        .otherwise(F.lit("UNKNOWN_ISSUER_CIK"))
    )
    return joined.select("issuer_cik", "issuer_symbol", chosen.alias("security_id"), reason.alias("reject_reason"))


def resolve_issuer(rows: DataFrame, master: DataFrame, universe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JOI-10 applied: (rows with security_id, rejected rows with reject_reason)."""
    decisions = issuer_decisions(rows, master, universe).withColumnsRenamed({"issuer_cik": "_cik", "issuer_symbol": "_symbol"})
    same = F.col("issuer_cik").eqNullSafe(F.col("_cik")) & F.col("issuer_symbol").eqNullSafe(F.col("_symbol"))
    decided = rows.join(decisions, same, "left").drop("_cik", "_symbol")
    return (
        decided.filter("security_id is not null").drop("reject_reason"),
        decided.filter("security_id is null").drop("security_id"),
    )


def identity_conflicts(rows: DataFrame, master: DataFrame, cik: str = "issuer_cik") -> DataFrame:
    """JOI-19. Rows whose security is unknown, has no proper CIK, or has another CIK."""
    from tidemark.functions import cik_ok

    known = master.select("security_id", F.col("cik").alias("_master_cik"), F.lit(True).alias("_known"))
    joined = rows.join(known, "security_id", "left")
    reason = (
        F.when(F.col("_known").isNull(), F.lit("UNKNOWN_SECURITY"))
        .when(F.col("_master_cik").isNull(), F.lit("NULL_CANONICAL_CIK"))
        .when(~cik_ok("_master_cik"), F.lit("MALFORMED_CANONICAL_CIK"))
        .when(F.coalesce(cik10(cik) != F.col("_master_cik"), F.lit(False)), F.lit("CIK_CONFLICT"))
    )
    return joined.withColumn("conflict", reason).filter("conflict is not null").drop("_known", "_master_cik")


def insider_rows(
    submissions: DataFrame, nonderivative: DataFrame, derivative: DataFrame, master: DataFrame, universe: DataFrame, cutoff: Column,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """JOI-09. Both transaction tables with their submission and its issuer: (rows of a known
    security, rows rejected for identity, rows without a submission).

    Issuers are decided per submission, and the joined rows are parsed once and written.
    """
    def shaped(df: DataFrame, key: str, is_derivative: bool) -> DataFrame:
        # a derivative table may lack columns of the other one
        text = lambda c: blank_to_null(c) if c in df.columns else F.lit(None).cast("string")
        number = lambda c: finite_number(text(c))
        return df.select(
            F.col("ACCESSION_NUMBER").alias("accession_number"),
            F.concat(F.lit("D:" if is_derivative else "N:"), F.col(key)).alias("transaction_id"),
            parse_source_date("TRANS_DATE").alias("transaction_date"), text("TRANS_FORM_TYPE").alias("_form"),
            text("SECURITY_TITLE").alias("security_title"), text("TRANS_CODE").alias("transaction_code"),
            text("TRANS_ACQUIRED_DISP_CD").alias("acquired_disposed"),
            number("TRANS_SHARES").alias("shares"), number("TRANS_PRICEPERSHARE").alias("price_per_share"),
            F.coalesce(text("NATURE_OF_OWNERSHIP"), text("DIRECT_INDIRECT_OWNERSHIP")).alias("ownership_nature"),
            number("SHRS_OWND_FOLWNG_TRANS").alias("shares_owned_after"), F.lit(is_derivative).alias("is_derivative"),
            (number("CONV_EXERCISE_PRICE") if is_derivative else F.lit(None).cast("double")).alias("exercise_price"),
            (parse_source_date(text("EXPIRATION_DATE")) if is_derivative else F.lit(None).cast("date")).alias("expiration_date"),
        )

    rows = shaped(nonderivative, "NONDERIV_TRANS_SK", False).unionByName(shaped(derivative, "DERIV_TRANS_SK", True))
    parents = submissions.select(
        F.col("ACCESSION_NUMBER").alias("accession_number"), parse_source_date("FILING_DATE").alias("filing_date"),
        cik10("ISSUERCIK").alias("issuer_cik"), F.col("ISSUERTRADINGSYMBOL").alias("issuer_symbol"),
        blank_to_null("DOCUMENT_TYPE").alias("_document"), bool_value("AFF10B5ONE").alias("is_10b5_1"),
    ).filter(accession_ok("accession_number"))
    mapped, refused = resolve_issuer(parents, master, universe)
    none = F.lit(None).cast("string")
    decided = mapped.withColumn("reject_reason", none).unionByName(refused.withColumn("security_id", none.cast(mapped.schema["security_id"].dataType)))
    joined = stage(rows.join(decided.withColumn("_found", F.lit(True)), "accession_number", "left"), "insider-rows")
    known = joined.filter(F.col("_found") & (F.col("filing_date") <= cutoff) & F.col("transaction_date").isNotNull())
    known = known.withColumn("form", F.coalesce("_document", "_form")).drop("_document", "_form", "_found")
    return (
        known.filter("security_id IS NOT NULL").drop("reject_reason"), known.filter("security_id IS NULL").drop("security_id"),
        joined.filter("_found IS NULL"),
    )


def build_insider_transactions(
    submissions: DataFrame, owners: DataFrame, nonderivative: DataFrame, derivative: DataFrame, *,
    master: DataFrame, universe: DataFrame, filings: DataFrame, cutoff: Column, retrieved_at: Column,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """PIP-10. (transactions, rejected for identity, broken rows with reasons)."""
    mapped, rejected, lost = insider_rows(submissions, nonderivative, derivative, master, universe, cutoff)
    people = owners.select(
        F.col("ACCESSION_NUMBER").alias("accession_number"), cik10("RPTOWNERCIK").alias("reporting_owner_cik"),
        blank_to_null("RPTOWNERNAME").alias("reporting_owner_name"),
        F.coalesce(F.col("RPTOWNER_RELATIONSHIP"), F.lit("")).alias("_rel"), blank_to_null("RPTOWNER_TITLE").alias("officer_title"),
    )
    times = filings.select(F.col("cik").alias("issuer_cik"), "accession_number", F.col("acceptance_datetime_utc").alias("_acceptance"))
    full = mapped.join(people, "accession_number").join(times, ["issuer_cik", "accession_number"], "left")
    has = lambda word: F.col("_rel").contains(word)
    out = full.select(
        "security_id", "issuer_cik", "reporting_owner_cik", "reporting_owner_name", has("Director").alias("is_director"),
        has("Officer").alias("is_officer"), has("TenPercentOwner").alias("is_ten_percent_owner"), "officer_title",
        "filing_date", "transaction_date", "form", "accession_number", "transaction_id", "security_title",
        "transaction_code", "acquired_disposed", "shares", "price_per_share", "ownership_nature", "shares_owned_after",
        "is_derivative", "exercise_price", "expiration_date", "is_10b5_1",
        *pit_columns(F.col("transaction_date"), F.col("filing_date"), F.col("_acceptance"),
                     available_date("filing_date", "_acceptance"), retrieved_at),
    ).distinct()
    out = stage(out, "insiders")
    key = ["accession_number", "reporting_owner_cik", "transaction_id"]
    conflicts = out.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    broken = (
        lost.select("accession_number", "transaction_id", F.lit("NO_FILING_PROVENANCE").alias("reason"))
        .unionByName(mapped.join(people, "accession_number", "left_anti").select(
            "accession_number", "transaction_id", F.lit("NO_REPORTING_OWNER").alias("reason")))
        .unionByName(conflicts.select("accession_number", "transaction_id", F.lit("CONFLICTING_TRANSACTION").alias("reason")))
    )
    return out.join(conflicts, key, "left_anti").select(*out.columns), rejected, broken


def insider_signals(
    rows: DataFrame, cutoff: Column, *, key: str = "security_id", owner: str = "reporting_owner_cik",
    code: str = "transaction_code", side: str = "acquired_disposed", date: str = "transaction_date",
    amount: Column | None = None, buy: tuple[str, str] = ("P", "A"), sell: tuple[str, str] = ("S", "D"),
) -> DataFrame:
    """AGG-13. Purchase and sale values over 30 and 90 days, distinct people, score.

    No qualifying row sums to 0.0; one NULL amount makes the total NULL. People are
    counted after grouping by (key, person), so no set of people is held per key.
    """
    value = amount if amount is not None else F.col("shares") * F.col("price_per_share")
    derivative = F.col("is_derivative") if "is_derivative" in rows.columns else F.lit(False)

    def window(pair: tuple[str, str], back: int) -> Column:
        return (
            ~derivative & (F.col(code) == pair[0]) & (F.col(side) == pair[1])
            & F.col(date).between(F.date_sub(cutoff, back), cutoff)
        )

    windows = {"b30": window(buy, 30), "b90": window(buy, 90), "s30": window(sell, 30), "s90": window(sell, 90)}
    has = lambda c: c in rows.columns
    title = F.upper(F.coalesce(F.col("officer_title"), F.lit(""))) if has("officer_title") else F.lit("")
    ceo = title.contains("CEO") | title.contains("CHIEF EXECUTIVE")
    cfo = title.contains("CFO") | title.contains("CHIEF FINANCIAL")
    director = F.col("is_director") if has("is_director") else F.lit(False)
    tested = rows.withColumns({w: F.coalesce(t, F.lit(False)) for w, t in windows.items()}).withColumn("_v", value)
    people = tested.groupBy(key, owner).agg(
        *[F.sum(F.when(F.col(w), F.col("_v"))).alias(f"{w}_sum") for w in windows],
        *[F.count(F.when(F.col(w), 1)).alias(f"{w}_n") for w in windows],
        *[F.count(F.when(F.col(w), F.col("_v"))).alias(f"{w}_known") for w in windows],
        F.bool_or(F.col("b90") & F.coalesce(director, F.lit(False))).alias("director"),
        F.bool_or(F.col("b90") & ceo).alias("ceo"), F.bool_or(F.col("b90") & cfo).alias("cfo"),
    )
    total = lambda w: F.when(F.sum(f"{w}_n") == F.sum(f"{w}_known"), F.coalesce(F.sum(f"{w}_sum"), F.lit(0.0)))
    totals = people.groupBy(key).agg(
        total("b30").alias("open_market_purchase_value_30d"), total("b90").alias("open_market_purchase_value_90d"),
        total("s30").alias("open_market_sale_value_30d"), total("s90").alias("open_market_sale_value_90d"),
        F.count_if(F.col("b90_n") > 0).alias("unique_buyers_90d"), F.count_if(F.col("s90_n") > 0).alias("unique_sellers_90d"),
        F.bool_or("director").alias("director_purchase_flag"), F.bool_or("ceo").alias("ceo_purchase_flag"),
        F.bool_or("cfo").alias("cfo_purchase_flag"),
    )
    bought, sold = F.col("open_market_purchase_value_90d"), F.col("open_market_sale_value_90d")
    score = F.least(F.lit(1.0), F.log1p(bought) / 20 + F.col("unique_buyers_90d") * 0.1) - F.least(F.lit(0.5), F.log1p(sold) / 40)
    known = bought.isNotNull() & sold.isNotNull()
    return totals.withColumns({
        "cluster_buy_flag": F.col("unique_buyers_90d") >= 3,
        "insider_signal_score": F.when(known, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score))),
        "signal_quality_status": F.when(~known, F.lit("PARTIAL_MISSING_TRANSACTION_VALUE"))
        .when((F.col("unique_buyers_90d") > 0) | (F.col("unique_sellers_90d") > 0), F.lit("READY"))
        .otherwise(F.lit("NO_OPEN_MARKET_ACTIVITY")),
    })


def build_insider_signals(transactions: DataFrame, *, cutoff: Column, retrieved_at: Column) -> DataFrame:
    """PIP-11. Signals from the transactions public at the cutoff."""
    from tidemark.contracts import INSIDER_SIGNALS

    known = transactions.filter(F.col("source_publication_date") <= cutoff)
    latest = known.groupBy("security_id").agg(
        F.max(F.struct("source_publication_date", "filing_date", "source_acceptance_datetime_utc")).alias("_l")
    )
    signals = insider_signals(known, cutoff).join(latest, "security_id").withColumn("signal_as_of_date", cutoff.cast("date"))
    names = [c for c in INSIDER_SIGNALS.columns if not c.startswith("source_")]
    return signals.select(*names, *pit_columns(
        cutoff, F.col("_l.filing_date"), F.col("_l.source_acceptance_datetime_utc"), F.col("_l.source_publication_date"), retrieved_at
    ))


def map_by_override_then_unique_name(
    rows: DataFrame, overrides: DataFrame, names: DataFrame, *, code: str = "cusip", name: str = "issuer_name",
    target: str = "security_id", methods: tuple[str, str] = ("REVIEWED_CUSIP_OVERRIDE", "UNIQUE_SEC_ISSUER_NAME"),
) -> DataFrame:
    """JOI-12. A reviewed code wins, else a normalized name owned by exactly one target.

    ``overrides`` has (code, target), ``names`` (name, target). Unmapped rows are dropped;
    a blank name never matches. Both sides join on one row per key, so nothing fans out.
    """
    unique = names.select(normalize_name(name).alias("_name"), F.col(target).alias("_id")).filter("_name <> ''").groupBy("_name").agg(
        F.min("_id").alias("_by_name"), F.max("_id").alias("_other")
    ).filter("_by_name = _other").drop("_other")
    reviewed = overrides.select(F.upper(code).alias(code), F.col(target).alias("_by_code"))
    joined = rows.withColumns({code: F.upper(code), "_name": normalize_name(name)}).join(reviewed, code, "left").join(unique, "_name", "left")
    return joined.withColumns({
        target: F.coalesce("_by_code", "_by_name"),
        "security_mapping_method": F.when(F.col("_by_code").isNotNull(), F.lit(methods[0])).when(F.col("_by_name").isNotNull(), F.lit(methods[1])),
    }).filter(F.col(target).isNotNull()).drop("_by_code", "_by_name", "_name")


def aggregate_positions(
    rows: DataFrame, keys: Sequence[str], sums: Sequence[str], poisoned: Sequence[str], first: Sequence[str], order: Sequence[str],
) -> DataFrame:
    """AGG-12. Sums, NULL-poisoned sums, and descriptive columns of the first row."""
    return rows.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], *[null_poisoned_sum(c).alias(c) for c in poisoned],
        F.min(F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *first)).alias("_first"),
    ).select(*keys, *sums, *poisoned, *[F.col(f"_first.{c}").alias(c) for c in first])


def build_holdings(
    submissions: DataFrame, covers: DataFrame, positions: DataFrame, *, master: DataFrame, overrides: DataFrame,
    cutoff: Column, retrieved_at: Column,
) -> tuple[DataFrame, DataFrame]:
    """PIP-12 / JOI-11. (holdings, broken rows with reasons).

    Rows of one filing are put in text order of their descriptive columns, which stands
    for the file order. Puts, calls and shares of a security are added together.
    """
    parents = submissions.select(
        F.col("ACCESSION_NUMBER").alias("accession_number"), parse_source_date("FILING_DATE").alias("filing_date"),
        parse_source_date("PERIODOFREPORT").alias("report_period"), cik10("CIK").alias("manager_cik"),
    ).join(
        covers.select(F.col("ACCESSION_NUMBER").alias("accession_number"), blank_to_null("FILINGMANAGER_NAME").alias("manager_name")),
        "accession_number",
    )
    info = positions.select(
        F.col("ACCESSION_NUMBER").alias("accession_number"), F.upper("CUSIP").alias("cusip"),
        blank_to_null("NAMEOFISSUER").alias("issuer_name"), blank_to_null("TITLEOFCLASS").alias("class_title"),
        finite_number("VALUE").alias("market_value_thousands"), finite_number("SSHPRNAMT").alias("shares_or_principal"),
        blank_to_null("SSHPRNAMTTYPE").alias("share_type"), blank_to_null("PUTCALL").alias("put_call"),
        blank_to_null("INVESTMENTDISCRETION").alias("investment_discretion"),
        finite_number("VOTING_AUTH_SOLE").alias("voting_authority_sole"),
        finite_number("VOTING_AUTH_SHARED").alias("voting_authority_shared"),
        finite_number("VOTING_AUTH_NONE").alias("voting_authority_none"),
    )
    joined = info.join(parents, "accession_number", "left")
    usable = joined.filter(F.col("filing_date").isNull() | (F.col("filing_date") <= cutoff))
    names = master.select(F.col("registrant_name").alias("issuer_name"), "security_id")
    good, bad = quarantine(usable, {
        "NO_FILING_PROVENANCE": F.col("manager_cik").isNull() | ~accession_ok("accession_number"),
        "FILED_BEFORE_PERIOD": F.col("filing_date") < F.col("report_period"),
    })
    mapped = map_by_override_then_unique_name(
        good.filter("filing_date is not null and report_period is not null"), overrides, names
    )
    ready, incomplete = quarantine(mapped, {
        "NO_VALUE_OR_SHARES": F.col("market_value_thousands").isNull() | F.col("shares_or_principal").isNull()
    })
    first = ["cusip", "issuer_name", "class_title", "share_type", "put_call", "investment_discretion", "security_mapping_method"]
    holdings = aggregate_positions(
        ready, ["manager_cik", "security_id", "report_period", "accession_number", "manager_name", "filing_date"],
        ["market_value_thousands", "shares_or_principal"],
        ["voting_authority_sole", "voting_authority_shared", "voting_authority_none"], first, [],
    )
    broken = bad.select("accession_number", "cusip", "reject_reasons").unionByName(
        incomplete.select("accession_number", "cusip", "reject_reasons")
    )
    return holdings.select(
        "manager_cik", "manager_name", "report_period", "filing_date", "accession_number", "cusip", "security_id",
        "security_mapping_method", "issuer_name", "class_title", "market_value_thousands", "shares_or_principal",
        "share_type", "put_call", "investment_discretion", "voting_authority_sole", "voting_authority_shared",
        "voting_authority_none",
        *pit_columns(F.col("report_period"), F.col("filing_date"), None, F.col("filing_date"), retrieved_at),
    ), broken


def period_neighbours(rows: DataFrame, key: str, period: str) -> DataFrame:
    """(key, period, next_period) over the periods present.

    Periods are made distinct first, so the window per key holds one row per period.
    """
    w = Window.partitionBy(key).orderBy(period)
    return rows.select(key, period).distinct().withColumn("next_period", F.lead(period).over(w))


def period_over_period(rows: DataFrame, key: str, period: str, member: str, value: str) -> DataFrame:
    """WIN-17 / SET-03. Each period of a key against its previous present period.

    Every row is counted once for its own period and once as "previous" for the next
    one; grouping by (key, period, member) pairs them up. Unlike a self join this
    combines before the shuffle and cannot fan out.
    """
    nearby = period_neighbours(rows, key, period)
    none = F.lit(None).cast("double")

    def side(p: Column, now: Column, n: int, before: Column, b: int) -> Column:
        return F.struct(p.alias("_p"), now.alias("_now"), F.lit(n).alias("_n"), before.alias("_before"), F.lit(b).alias("_b"))

    held = F.col(value).cast("double")
    sides = F.array(side(F.col(period), held, 1, none, 0), side(F.col("next_period"), none, 0, held, 1))
    tagged = rows.join(nearby, [key, period]).select(key, member, F.inline(sides)).filter("_p is not null")
    pairs = tagged.groupBy(key, "_p", member).agg(
        F.max("_now").alias("now"), F.max("_n").alias("n"), F.max("_before").alias("before"), F.max("_b").alias("b")
    )
    both = (F.col("n") == 1) & (F.col("b") == 1)
    return pairs.groupBy(key, F.col("_p").alias(period)).agg(
        F.sum("now").alias("known_shares"), F.sum("n").cast("bigint").alias("manager_count"),
        F.count_if((F.col("n") == 1) & (F.col("b") == 0)).alias("new_count"),
        F.count_if((F.col("n") == 0) & (F.col("b") == 1)).alias("closed_count"),
        F.count_if(both & (F.col("now") > F.col("before"))).alias("increased_count"),
        F.count_if(both & (F.col("now") < F.col("before"))).alias("decreased_count"),
        F.when(F.max("b") == 1, F.sum("now") - F.sum("before")).alias("net_share_change"),
    ).withColumn(
        "net_breadth", F.col("new_count") + F.col("increased_count") - F.col("closed_count") - F.col("decreased_count")
    )


def build_ownership_signals(holdings: DataFrame, *, retrieved_at: Column) -> DataFrame:
    """PIP-13. One holding per (security, period, manager): the newest filing of it."""
    one = stage(latest_per_key(
        holdings, ["security_id", "report_period", "manager_cik"], [F.col("filing_date").desc(), F.col("accession_number").desc()]
    ), "holdings")
    key = ["security_id", "report_period"]
    changes = period_over_period(one, "security_id", "report_period", "manager_cik", "shares_or_principal")
    described = one.groupBy(*key).agg(
        F.max("filing_date").alias("latest_filing"),
        F.bool_or(F.col("security_mapping_method") != "REVIEWED_CUSIP_OVERRIDE").alias("name_mapped"),
    )
    concentration = top_share(one, key, "market_value_thousands", ["manager_cik"])
    rows = changes.join(described, key).join(concentration, key)
    return rows.select(
        *key, F.col("known_shares").alias("known_13f_shares"), "manager_count", F.col("new_count").alias("new_position_manager_count"),
        F.col("closed_count").alias("closed_position_manager_count"), F.col("increased_count").alias("increased_position_manager_count"),
        F.col("decreased_count").alias("decreased_position_manager_count"), "net_share_change",
        F.col("net_breadth").alias("net_manager_breadth"), F.col("top_share").alias("top_10_manager_concentration"),
        F.tanh(F.col("net_breadth") / 10).alias("ownership_signal_score"),
        F.datediff("latest_filing", "report_period").cast("bigint").alias("publication_lag_days"),
        F.when(F.col("name_mapped"), F.lit("PARTIAL_NAME_MAPPED")).otherwise(F.lit("READY")).alias("signal_quality_status"),
        *pit_columns(F.col("report_period"), F.col("latest_filing"), None, F.col("latest_filing"), retrieved_at),
    )
