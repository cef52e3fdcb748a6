"""Session dimension: ordinals, last session of a date, lags (JOI-25)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def session_dimension(dates: DataFrame, date: str = "session_date", *, zone: str = "America/New_York",
                      open_at: str = "09:30:00", close_at: str = "16:00:00", early_closes: DataFrame | None = None) -> DataFrame:
    """(session_date, open_utc, close_utc, ordinal, next_session).

    One row per distinct date, so the single ordered window stays a few thousand rows.
    ``early_closes`` (session_date, close_at) overrides the close.
    """
    days = dates.select(F.col(date).cast("date").alias("session_date")).filter("session_date is not null").distinct()
    close = F.lit(close_at)
    if early_closes is not None:
        days = days.join(early_closes.select("session_date", F.col("close_at").alias("_early")), "session_date", "left")
        close = F.coalesce(F.col("_early"), close)
    w = Window.orderBy("session_date")
    at = lambda t: F.to_utc_timestamp(F.concat(F.col("session_date").cast("string"), F.lit(" "), t), zone)
    return days.select(
        "session_date", at(F.lit(open_at)).alias("open_utc"), at(close).alias("close_utc"),
        F.row_number().over(w).cast("bigint").alias("ordinal"), F.lead("session_date").over(w).alias("next_session"),
    )


def date_to_session(sessions: DataFrame, until: Column | None = None) -> DataFrame:
    """(calendar_date, last_session, ordinal) for every day from the first session on.

    The as-of rule turned into an equi join: each session is repeated for the days up
    to the next one.
    """
    last_day = F.coalesce(F.date_sub("next_session", 1), until if until is not None else F.col("session_date"))
    last_day = F.greatest(last_day, F.col("session_date"))
    return sessions.select(
        F.explode(F.sequence("session_date", last_day)).alias("calendar_date"),
        F.col("session_date").alias("last_session"), "ordinal",
    )


def session_lag(df: DataFrame, observed: str, expected: str, sessions: DataFrame, until: Column | None = None) -> DataFrame:
    """Adds ``lag_sessions``: sessions in (observed, expected], NULL outside the calendar."""
    days = date_to_session(sessions, until)
    a = days.select(F.col("calendar_date").alias(observed), F.col("ordinal").alias("_o"))
    b = days.select(F.col("calendar_date").alias(expected), F.col("ordinal").alias("_e"))
    return df.join(a, observed, "left").join(b, expected, "left").withColumn(
        "lag_sessions", F.greatest(F.col("_e") - F.col("_o"), F.lit(0))
    ).withColumn("lag_sessions", F.when(F.col("_e").isNotNull() & F.col("_o").isNotNull(), F.col("lag_sessions"))).drop("_o", "_e")


def session_offset(sessions: DataFrame, expected: Column, back: int) -> DataFrame:
    """One row: the session ``back`` places before the last session on or before a date."""
    ranked = sessions.filter(F.col("session_date") <= expected)
    w = Window.orderBy(F.col("session_date").desc())
    return ranked.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == back + 1).select(
        F.col("session_date").alias("offset_session")
    )
