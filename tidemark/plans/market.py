"""Market history: alias choice, segmentation, active set, gates (PIP-02), snapshot (WIN-08)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import PRICES, SPLITS
from tidemark.functions import is_invalid_ohlcv, ohlcv_invalid_reason
from tidemark.operators import segments, stats
from tidemark.operators.keys import latest_per_key, recent_n
from tidemark.session import dropped, stage

REFRESH_LANE = "CHART_REFRESH"
BAR = ["open", "high", "low", "close", "volume"]
METRIC_COLUMNS = [*BAR, "ticker"]  # what :func:`market_metrics` reads of the prices besides key, date and segment


def best_alias(prices: DataFrame, aliases: DataFrame, date: str = "session_date", lane: str = REFRESH_LANE) -> DataFrame:
    """JOI-02. One row per (security, date): priority, symbol, refresh lane, newest, revision.

    Nearly every key has one row, so rows are dealt by key before they are ranked: a limit before
    the shuffle would sort the whole split of a scan in one task and drop next to nothing.
    """
    joined = prices.join(aliases, "source_symbol")
    order = [F.col("priority"), F.col("source_symbol")]
    if date == "session_date":
        order += [
            F.when(F.col("source_dataset") == lane, 0).otherwise(1), F.col("observed_at_utc").desc_nulls_last(),
            F.col("source_revision").asc_nulls_last(),
        ]
    else:
        order += [F.col("split_factor")]
    return latest_per_key(joined.repartition("security_id", date), ["security_id", date], order)


def history_candidates(
    prices: DataFrame, splits: DataFrame, aliases: DataFrame, *, expected: Column, n: int = 320,
    gap_days: int = 14, ratio: float = 4.0, lane: str = REFRESH_LANE, chunk_rows: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """WIN-02..05 on the alias-matched rows, stored; invalid rows take part in segmentation.

    A split explains a jump only for rows of its own source symbol, so splits carry the
    alias priority as slot. ``columns`` besides those of :data:`BAR` go through the ordered pass (default: all).
    """
    best = best_alias(prices.filter(F.col("session_date") <= expected), aliases, lane=lane)
    if columns is not None:
        best = best.select(*dict.fromkeys(["security_id", "session_date", "priority", *BAR, *columns]))
    best = stage(best, "best_alias")  # the ordered pass reads its input several times
    actions = splits.join(aliases, "source_symbol").select("security_id", "event_date", "priority")
    segmented = segments.segment_history(
        best, ["security_id"], "session_date", "close",
        gap=F.datediff("session_date", "previous_session") > gap_days, ratio=ratio,
        actions=actions, slot="priority", slots=3, chunk_rows=chunk_rows, last_only=True,
    )
    segmented = stage(segmented, "segmented")
    dropped(best)
    # at most n rows a security; read by every table of the build
    candidates = stage(segments.latest_segment(segmented, ["security_id"], "session_date", ~is_invalid_ohlcv(), n), "candidates")
    dropped(segmented)
    return candidates


def active_securities(candidates: DataFrame, oldest_active: Column) -> tuple[DataFrame, DataFrame]:
    """JOI-04. (active ids, stale ids with their latest session)."""
    latest = candidates.groupBy("security_id").agg(F.max("session_date").alias("latest_session"))
    return latest.filter(F.col("latest_session") >= oldest_active), latest.filter(F.col("latest_session") < oldest_active)


class MarketHistory:
    """Tables of one market build; each is planned when first asked for."""

    def __init__(
        self, candidates: DataFrame, splits: DataFrame, aliases: DataFrame, oldest_active: Column, min_session_rows: int, n: int = 320,
    ) -> None:
        self.candidates, self.n = candidates, n
        self._splits, self._aliases = splits, aliases
        self.oldest_active, self._min_rows = oldest_active, min_session_rows

    @cached_property
    def current(self) -> DataFrame:
        """Candidates of active securities.

        ``n`` bounds the rows per security here, and the window reuses the partitioning
        of the rank.
        """
        newest = F.max("session_date").over(Window.partitionBy("security_id"))
        return self.candidates.withColumn("_newest", newest).filter(F.col("_newest") >= self.oldest_active).drop("_newest")

    @cached_property
    def active(self) -> DataFrame:
        return active_securities(self.candidates, self.oldest_active)[0].select("security_id")

    @cached_property
    def stale(self) -> DataFrame:
        return active_securities(self.candidates, self.oldest_active)[1]

    @cached_property
    def prices(self) -> DataFrame:
        return self.current.filter(~is_invalid_ohlcv()).select(*[c for c in PRICES.columns if c in self.candidates.columns])

    @cached_property
    def splits(self) -> DataFrame:
        mine = self._aliases.join(self.active, "security_id", "left_semi")
        return best_alias(self._splits.join(mine.select("source_symbol"), "source_symbol", "left_semi"), self._aliases, "event_date").select(*SPLITS.columns)

    @cached_property
    def truncations(self) -> DataFrame:
        return segments.history_truncations(self.candidates, ["security_id"])

    @cached_property
    def invalid_rows(self) -> DataFrame:
        return self.current.filter(is_invalid_ohlcv()).select(
            "security_id", "source_symbol", "session_date", ohlcv_invalid_reason().alias("reason")
        )

    @cached_property
    def common_mode(self) -> DataFrame:
        """Sessions with affirmative common-mode corruption; their rows stay."""
        return stats.common_mode_sessions(self.prices, "session_date", BAR, min_rows=self._min_rows)

    @cached_property
    def unmatched(self) -> DataFrame:
        spelled = F.array_sort(F.collect_list(F.struct("priority", "source_symbol")))  # at most three per security
        tried = self._aliases.groupBy("security_id", "ticker").agg(
            F.array_join(F.transform(spelled, lambda s: s["source_symbol"]), ";").alias("aliases_tried")
        )
        why = F.when(
            F.col("latest_session").isNotNull(),
            F.concat(F.lit("SOURCE_HISTORY_STALE:latest_session="), F.col("latest_session").cast("string")),
        ).otherwise(F.lit("NO_SOURCE_SYMBOL_MATCH"))
        return (
            tried.join(self.prices.select("security_id").distinct(), "security_id", "left_anti")
            .join(self.stale, "security_id", "left")
            .select("security_id", "ticker", "aliases_tried", why.alias("reason"))
        )


def build_market_history(
    prices: DataFrame, splits: DataFrame, aliases: DataFrame, *, expected: Column, oldest_active: Column,
    n: int = 320, gap_days: int = 14, ratio: float = 4.0, min_session_rows: int = 100,
    lane: str = REFRESH_LANE, chunk_rows: int | None = None, columns: Sequence[str] | None = None,
) -> MarketHistory:
    """PIP-02 from scanned, conflict-free rows.

    Identical rows need no collapsing first: the alias choice keeps one row per security
    and session. A caller that reads the prices only in part names its ``columns``, and
    the others end with the alias choice.
    """
    candidates = history_candidates(
        prices, splits, aliases, expected=expected, n=n, gap_days=gap_days, ratio=ratio, lane=lane, chunk_rows=chunk_rows, columns=columns,
    )
    return MarketHistory(candidates, splits, aliases, oldest_active, min_session_rows, n)


def market_metrics(
    history: MarketHistory, aliases: DataFrame, *, expected: Column, cutoff: Column, benchmark: str,
    minimum_history: int = 252,
) -> DataFrame:
    """AGG-05, AGG-06, AGG-08 of one build in one row, input of :func:`market_gate`.

    One pass over the candidates: cells (security, session), then securities, then the
    total, so distinct counts need no row expansion.
    """
    day, ok = F.col("session_date"), F.col("n") > 0
    cells = history.candidates.groupBy("security_id", "session_date").agg(
        F.count_if(~is_invalid_ohlcv()).alias("n"), F.count_if(is_invalid_ohlcv()).alias("bad"),
        F.max("ticker").alias("ticker"), F.bool_or(F.col("previous_segment_latest_date").isNotNull()).alias("cut"),
    )
    per_id = cells.groupBy("security_id").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count_if(ok).alias("sessions"), F.max(day).alias("latest"),
        F.min(F.when(ok, day)).alias("lo"), F.max(F.when(ok, day)).alias("hi"), F.bool_or("cut").alias("cut"),
        F.bool_or(ok & (day == expected)).alias("current"), F.max("ticker").alias("ticker"),
    ).withColumn("active", F.col("latest") >= history.oldest_active)
    live = F.col("active")
    matched = live & (F.col("sessions") > 0)
    total = lambda c: F.coalesce(F.sum(F.when(live, F.col(c))), F.lit(0)).cast("bigint")
    measured = per_id.agg(
        total("n").alias("rows"), F.count_if(matched).alias("securities"), F.min(F.when(live, F.col("lo"))).alias("min_date"),
        F.max(F.when(live, F.col("hi"))).alias("max_date"),
        F.count_if(matched & (F.col("n") >= minimum_history)).alias("adequate"),
        F.count_if(live & F.col("current")).alias("valid_securities"), F.count_if(live).alias("active_securities"),
        total("bad").alias("excluded_rows"), F.count_if(~live).alias("stale_histories"), F.count_if("cut").alias("truncated_histories"),
        F.coalesce(F.bool_or((F.col("ticker") == benchmark.upper()) & F.col("current")), F.lit(False)).alias("benchmark_valid"),
    )
    admitted = aliases.select("security_id").distinct().agg(F.count(F.lit(1)).alias("admitted"))
    bad_sessions = history.common_mode.agg(F.count(F.lit(1)).alias("common_mode_sessions"))
    published = published_metrics(history.prices, history.splits, cutoff=cutoff, n=history.n).drop("published_rows")
    out = stats.side_by_side(measured, admitted, bad_sessions, published)
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return out.withColumns({
        "coverage": share("securities", "admitted"), "adequate_coverage": share("adequate", "securities"),
        "latest_session_coverage": share("valid_securities", "active_securities"),
    })


# Columns that a split row needs.
SPLIT_FIELDS = ("security_id", "ticker", "source_symbol", "event_date", "split_factor", "source_dataset", "source_revision", "observed_at_utc")


def published_metrics(prices: DataFrame, splits: DataFrame, *, cutoff: Column, n: int = 320) -> DataFrame:
    """AGG-05 of the tables as they are or will be published, whoever made them, in one row.

    Prices fold into cells (security, session), then securities, then the total.
    """
    cells = prices.groupBy("security_id", "session_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(is_invalid_ohlcv(), F.lit(True)) | F.col("session_date").isNull()).alias("bad")
    )
    per_id = cells.groupBy("security_id").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("n") - 1).alias("again"),
        F.sum(F.when(F.col("session_date") > cutoff, F.col("n")).otherwise(0)).alias("late"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    rows = per_id.agg(
        total("n").alias("published_rows"), total("bad").alias("invalid_rows"), total("again").alias("duplicate_rows"),
        total("late").alias("after_cutoff"), F.count_if(F.col("n") > n).alias("histories_over_limit"),
    )
    whole = F.col("split_factor") != ""
    for field in SPLIT_FIELDS:
        whole = whole & F.col(field).isNotNull()
    actions = splits.groupBy("security_id", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(whole, F.lit(False))).alias("bad")
    ).agg(total(F.col("n") - 1).alias("split_duplicate_rows"), total("bad").alias("split_invalid_rows"))
    return stats.side_by_side(rows, actions)


def collapsed_rows(rows: DataFrame) -> DataFrame:
    """(collapsed_rows): rows that repeat another one in every column, before they are folded."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("collapsed_rows")
    )


def market_gate(
    metrics: DataFrame, *, expected: Column, require_benchmark: bool = False, minimum_coverage: float = 0.80,
    minimum_adequate: float = 0.50,
) -> DataFrame:
    """AGG-09 over :func:`market_metrics`; ``collapsed_rows`` beside the metrics adds its warning."""
    c = F.col
    collapsed = c("collapsed_rows") if "collapsed_rows" in metrics.columns else F.lit(0)
    return stats.market_state(
        metrics, coverage="latest_session_coverage",
        errors={
            "COMMON_MODE_SESSION": c("common_mode_sessions") > 0,
            "BENCHMARK_NOT_VALID": F.lit(require_benchmark) & ~c("benchmark_valid"),
            "MATCHED_COVERAGE_BELOW_MINIMUM": F.col("coverage") < minimum_coverage,
            "HISTORY_COVERAGE_BELOW_MINIMUM": c("adequate_coverage") < minimum_adequate,
            "NO_ROWS": c("rows") == 0, "INVALID_ROWS": c("invalid_rows") > 0, "DUPLICATE_KEYS": c("duplicate_rows") > 0,
            "ROWS_AFTER_CUTOFF": c("after_cutoff") > 0, "SESSIONS_BEHIND": c("max_date").isNull() | (c("max_date") < expected),
            "SPLIT_DUPLICATE_KEYS": c("split_duplicate_rows") > 0, "SPLIT_INVALID_ROWS": c("split_invalid_rows") > 0,
            "HISTORY_OVER_SESSION_LIMIT": c("histories_over_limit") > 0,
        },
        warnings={
            "INVALID_ROWS_EXCLUDED": c("excluded_rows") > 0, "STALE_HISTORIES_EXCLUDED": c("stale_histories") > 0,
            "HISTORIES_TRUNCATED": c("truncated_histories") > 0, "IDENTICAL_ROWS_COLLAPSED": collapsed > 0,
        },
    )


# Horizon name and the rank of the reference close.
RETURN_RANKS = {"price_return_1d": 2, "price_return_5d": 6, "price_return_20d": 21, "price_return_63d": 64}


def market_snapshot(prices: DataFrame, key: str = "security_id", date: str = "session_date", extra: tuple[str, ...] = ()) -> DataFrame:
    """WIN-08. Last bar, returns over 1/5/20/63 sessions and 20-session averages.

    Only the newest 64 rows per key can matter; the limit applies before the shuffle and
    the aggregation reuses its partitioning.
    """
    newest = recent_n(prices, [key], [F.col(date).desc()], max(RETURN_RANKS.values()), rank="_rn")
    at = lambda c, k: F.max(F.when(F.col("_rn") == k, F.col(c)))
    within = F.col("_rn") <= 20
    summary = newest.groupBy(key).agg(
        *[at(c, 1).alias(c) for c in (date, *BAR, *extra)],
        *[at("close", k).alias(f"_{name}") for name, k in RETURN_RANKS.items()],
        F.avg(F.when(within, F.col("volume"))).alias("average_volume_20d"),
        F.avg(F.when(within, F.col("close") * F.col("volume"))).alias("average_dollar_volume_20d"),
    )
    return summary.select(
        key, date, *BAR,
        *[(F.try_divide(F.col("close"), F.nullif(f"_{name}", F.lit(0.0))) - 1).alias(name) for name in RETURN_RANKS],
        "average_volume_20d", "average_dollar_volume_20d", *extra,
    )
