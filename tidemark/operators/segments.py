"""Cutting a per-key history at gaps and unexplained jumps (WIN-03 .. WIN-06)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import recent_n
from tidemark.operators.skew import OrderedKeys


def segment_history(
    df: DataFrame, keys: Sequence[str], date: str, price: str, *,
    gap: Column, ratio: float, actions: DataFrame | None = None, action_date: str = "event_date",
    slot: str | None = None, slots: int = 1, chunk_rows: int | None = None, last_only: bool = False,
) -> DataFrame:
    """WIN-03. Adds previous_session, previous_close, segment_break_reason, segment_id.

    A row starts a segment when ``gap`` holds (a Column over ``date`` and
    ``previous_session``) or when its price moved by ``ratio`` or more against the
    previous row and no corporate action of the same key (and ``slot``, when rows carry
    one of ``slots`` numbers) lies in (previous_session, date]. ``date`` must be unique
    per key. Actions ride the same ordered pass as the rows, so there is one shuffle. With
    ``last_only`` the pass gives the rows of each key's last segment alone.
    """
    payload = df.columns
    source = df.withColumns({"_t": F.col(date), "_row": F.lit(1)})
    if actions is not None:
        marks = actions.select(
            *keys, F.col(action_date).alias("_t"), F.lit(0).alias("_row"),
            (F.col(slot) if slot else F.lit(0)).cast("int").alias("_slot"),
        ).distinct()
        source = source.withColumn("_slot", (F.col(slot) if slot else F.lit(0)).cast("int"))
        source = source.unionByName(marks, allowMissingColumns=True)
    else:
        slots = 0
    is_row = F.col("_row") == 1
    ordered = OrderedKeys(source, keys, ["_t", "_row"], chunk_rows).running(
        maxima_before={"_prev": F.when(is_row, F.struct(F.col(date), F.col(price)))},
        maxima={f"_a{i}": F.when(~is_row & (F.col("_slot") == i), F.col("_t")) for i in range(slots)},
    )
    last_action = F.lit(None).cast(df.schema[date].dataType)
    for i in range(slots):
        last_action = F.when(F.col("_slot") == i, F.col(f"_a{i}")).otherwise(last_action)
    before, now = F.col("previous_close"), F.col(price)
    jump = (before > 0) & (now > 0) & (
        F.greatest(F.try_divide(now, before), F.try_divide(before, now)) >= ratio
    )
    explained = F.coalesce(last_action > F.col("previous_session"), F.lit(False))
    reason = F.when(
        F.col("previous_session").isNotNull() & gap, F.lit("SESSION_GAP")
    ).when(jump & ~explained, F.lit("INVALID_PRICE_DISCONTINUITY"))
    ordered.with_columns({"previous_session": F.col(f"_prev.{date}"), "previous_close": F.col(f"_prev.{price}")})
    ordered.with_columns({"segment_break_reason": F.when(is_row, reason)})
    ordered.running(sums={"segment_id": F.when(F.col("segment_break_reason").isNotNull(), 1).otherwise(0)})
    if last_only:
        ordered.maximum("_last", F.col("segment_id"))
    out = ordered.result()
    if last_only:
        out = out.filter(F.col("segment_id") == F.col("_last"))
    if actions is not None:
        out = out.filter(is_row)
    return out.select(
        *payload, "previous_session", "previous_close", "segment_break_reason",
        F.col("segment_id").cast("bigint").alias("segment_id"),
    )


def segment_summary(segmented: DataFrame, keys: Sequence[str], date: str, valid: Column) -> DataFrame:
    """WIN-04. One row per (key, segment): first valid date, previous end, reason, rows."""
    return segmented.groupBy(*keys, "segment_id").agg(
        F.min(F.when(valid, F.col(date))).alias("valid_segment_start_date"),
        F.max(F.when(F.col("segment_break_reason").isNotNull(), F.col("previous_session"))).alias("previous_segment_latest_date"),
        F.max("segment_break_reason").alias("latest_segment_break_reason"),
        F.count(F.lit(1)).alias("segment_rows"),
    )


def annotate_latest(segmented: DataFrame, keys: Sequence[str], date: str, valid: Column) -> DataFrame:
    """Rows of each key's last segment from its first valid date on.

    The last segment is found by aggregation and joined back, where adaptive skew handling
    splits a hot key; ``segmented`` is read twice.
    """
    latest = segment_summary(segmented, keys, date, valid).groupBy(*keys).agg(
        F.max(F.struct(
            "segment_id", "valid_segment_start_date", "previous_segment_latest_date",
            "latest_segment_break_reason",
        )).alias("_s")
    ).select(*keys, "_s.*")
    return segmented.join(latest, [*keys, "segment_id"], "inner").filter(F.col(date) >= F.col("valid_segment_start_date"))


def latest_segment(segmented: DataFrame, keys: Sequence[str], date: str, valid: Column, n: int) -> DataFrame:
    """WIN-05. Newest ``n`` rows of the last segment, with ``history_rank``."""
    return recent_n(annotate_latest(segmented, keys, date, valid), keys, [F.col(date).desc()], n, rank="history_rank")


def history_truncations(latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """WIN-06. One row per key whose history was cut."""
    return latest.filter(F.col("previous_segment_latest_date").isNotNull()).groupBy(*keys).agg(
        F.max("previous_segment_latest_date").alias("previous_latest"),
        F.min("valid_segment_start_date").alias("segment_start"),
        F.max("latest_segment_break_reason").alias("reason"),
    )
