"""Numeric checks, guarded arithmetic and dirty-value parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col", "is_finite", "is_invalid_ohlcv", "ohlcv_invalid_reason", "finite_number",
    "bool_value", "first_not_blank", "safe_divide", "growth", "null_poisoned_sum",
    "round_half_even_long",
]


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_finite(value: Column | str) -> Column:
    """Neither NaN nor infinite; NULL stays NULL."""
    value = col(value)
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def is_invalid_ohlcv(
    open_: Column | str = "open", high: Column | str = "high", low: Column | str = "low",
    close: Column | str = "close", volume: Column | str = "volume",
) -> Column:
    """EXP-01. Always TRUE or FALSE, never NULL."""
    o, h, l, c, v = map(col, (open_, high, low, close, volume))
    sound = (
        is_finite(o) & is_finite(h) & is_finite(l) & is_finite(c)
        & (o > 0) & (h > 0) & (l > 0) & (c > 0) & (v >= 0)
        & (l <= h) & (l <= F.least(o, c)) & (h >= F.greatest(o, c))
    )
    return ~F.coalesce(sound, F.lit(False))


def ohlcv_invalid_reason(
    open_: Column | str = "open", high: Column | str = "high", low: Column | str = "low",
    close: Column | str = "close", volume: Column | str = "volume",
) -> Column:
    """EXP-02. First failing rule of an invalid bar; NULL for a valid one."""
    prices = [col(p) for p in (open_, high, low, close)]
    v = col(volume)

    def any_of(tests: list[Column]) -> Column:
        out = tests[0]
        for test in tests[1:]:
            out = out | test
        return out

    invalid = is_invalid_ohlcv(open_, high, low, close, volume)
    return (
        F.when(~invalid, F.lit(None).cast("string"))
        .when(any_of([p.isNull() for p in prices]), F.lit("NULL_OHLC"))
        .when(any_of([~is_finite(p) for p in prices]), F.lit("NON_FINITE_OHLC"))
        .when(any_of([p <= 0 for p in prices]), F.lit("NON_POSITIVE_OHLC"))
        .when(v.isNull() | (v < 0), F.lit("INVALID_VOLUME"))
        .otherwise(F.lit("INVALID_OHLC_BOUNDS"))
    )


def finite_number(text: Column | str) -> Column:
    """EXP-12. Number from text; blank, unparsable and non-finite become NULL."""
    number = F.trim(col(text).cast("string")).try_cast("double")
    return F.when(is_finite(number), number)


def bool_value(text: Column | str) -> Column:
    """EXP-12. 1/true/y/yes and 0/false/n/no; other text is NULL."""
    value = F.lower(F.trim(col(text).cast("string")))
    return F.when(value.isin("1", "true", "y", "yes"), F.lit(True)).when(
        value.isin("0", "false", "n", "no"), F.lit(False)
    )


def first_not_blank(*values: Column | str) -> Column:
    """EXP-12. First value that is neither NULL nor blank text."""
    return F.coalesce(*[F.when(F.trim(col(v).cast("string")) != "", col(v)) for v in values])


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """EXP-13. NULL on NULL, zero denominator or non-finite result."""
    ratio = F.try_divide(col(numerator), col(denominator))
    return F.when(is_finite(ratio), ratio)


def growth(current: Column | str, previous: Column | str) -> Column:
    """EXP-13. current / previous - 1, NULL on NULL or zero."""
    return F.try_divide(col(current), col(previous)) - 1


def null_poisoned_sum(
    value: Column | str, where: Column | None = None, rows: int | None = None,
    empty: Column | None = None,
) -> Column:
    """EXP-13 as an aggregate: the sum, NULL when any counted value is NULL.

    ``where`` picks the counted rows, ``rows`` demands an exact number of them, and
    ``empty`` is the value for no rows (NULL unless given).
    """
    value = col(value)
    counted = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    n = F.count(F.when(counted, 1))
    known = F.count(F.when(counted, value))
    ok = n == known
    if rows is not None:
        ok = ok & (n == rows)
    total = F.when(ok & (n > 0), F.sum(F.when(counted, value)))
    return F.when(n == 0, empty).otherwise(total) if empty is not None else total


def round_half_even_long(value: Column | str) -> Column:
    """Number or numeric text to BIGINT, ties to even."""
    return F.rint(col(value).cast("string").try_cast("double")).try_cast("bigint")
