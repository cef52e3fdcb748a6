"""Latest and newest rows per key, upserts, anti joins, duplicates and orphans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import OrderedKeys, as_columns


def recent_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, rank: str | None = None) -> DataFrame:
    """WIN-07. First ``n`` rows per key under ``order``.

    The rank filter becomes a group limit that runs before the shuffle, so a hot key
    sends at most ``n`` rows per input task.
    """
    name = rank or "_rank"
    w = Window.partitionBy(*keys).orderBy(*as_columns(order))
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """WIN-01. One row per key; give NULLS and tie-breaks in ``order``."""
    return recent_n(df, keys, order, 1)


def previous_value(
    df: DataFrame, keys: Sequence[str], order: str, columns: dict[str, str], chunk_rows: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """WIN-02. Previous row's values as new columns {new: old}; ``order`` unique per key."""
    olds = [c for c in dict.fromkeys(columns.values()) if c != order]
    ordered = OrderedKeys(df, keys, [order], chunk_rows, bounded)
    ordered.running(maxima_before={"_prev": F.struct(order, *olds)})
    return ordered.with_columns(
        {new: F.col(f"_prev.{old}") for new, old in columns.items()}
    ).result().drop("_prev")


def as_of_filter(df: DataFrame, known_at: str, cutoff: Column) -> DataFrame:
    """EXP-19. Rows known at the cutoff; a missing date is not known."""
    return df.filter(F.col(known_at) <= cutoff)


def missing_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JOI-05 / SET-04. Rows of ``df`` whose key is absent from ``other``."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def present_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JOI-01 / JOI-04. Rows of ``df`` whose key occurs in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def upsert(
    base: DataFrame, delta: DataFrame, keys: Sequence[str], lane: tuple[str, str] | None = None
) -> DataFrame:
    """JOI-06. Rows of ``delta`` replace the rows of ``base`` with the same key.

    With ``lane`` = (column, value) only base rows of that lane are replaced.
    """
    replaced = delta.select(*keys).distinct()
    if lane is None:
        kept = base.join(replaced, list(keys), "left_anti")
    else:
        column, value = lane
        tagged = replaced.select(*[F.col(k).alias(f"_d_{k}") for k in keys])
        match = F.col(column) == F.lit(value)
        for k in keys:
            match = match & (F.col(k) == F.col(f"_d_{k}"))
        kept = base.join(tagged, match, "left_anti")
    return kept.unionByName(delta)


def carry_forward_absent(current: DataFrame, previous: DataFrame, key: str, lane: tuple[str, str]) -> DataFrame:
    """JOI-07. Append previous rows of one lane for keys the current table lacks."""
    column, value = lane
    kept = missing_in(previous.filter(F.col(column) == F.lit(value)), current, [key])
    return current.unionByName(kept.select(*current.columns))


def conflicting_groups(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """AGG-01. Key groups with more than one distinct non-null value in any column.

    More than one distinct value is the same as min <> max, which needs no distinct.
    """
    bounds = df.groupBy(*keys).agg(
        *[F.min(v).alias(f"_lo_{v}") for v in values], *[F.max(v).alias(f"_hi_{v}") for v in values]
    )
    differs = F.lit(False)
    for v in values:
        differs = differs | F.coalesce(F.col(f"_lo_{v}") != F.col(f"_hi_{v}"), F.lit(False))
    return bounds.filter(differs).select(*keys)


def identical_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """AGG-02. One row: how many rows repeat an equal row."""
    columns = list(columns or df.columns)
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("identical_duplicates"))


def collapse_identical(df: DataFrame) -> DataFrame:
    """AGG-03 / SET-05."""
    return df.distinct()


def orphans(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """JOI-18. Rows with a key the dimension does not have."""
    return df.filter(F.col(key).isNotNull()).join(dim.select(key).distinct(), key, "left_anti")


def drop_orphans(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return df.join(dim.select(key), key, "left_semi")


def orphan_counts(tables: dict[str, DataFrame], dim: DataFrame, key: str) -> DataFrame:
    """JOI-18. (table, orphan_rows) for the tables that carry the key."""
    out = None
    for name, table in tables.items():
        if key not in table.columns:
            continue
        row = orphans(table, dim, key).agg(F.count(F.lit(1)).alias("orphan_rows")).select(F.lit(name).alias("table"), "orphan_rows")
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError(f"no table has column {key}")
    return out


def without_event_between(
    df: DataFrame, events: DataFrame, keys: Sequence[str], low: str, high: str,
    event: str, chunk_rows: int | None = None,
) -> DataFrame:
    """JOI-03. Rows for which no event of the key has low < event <= high.

    Events and rows are merged on one timeline and the last event up to ``high`` is
    carried along, so the cost stays linear however many events a key has.
    """
    payload = df.columns
    rows = df.withColumns({"_t": F.col(high), "_row": F.lit(1), "_e": F.lit(None).cast(df.schema[high].dataType)})
    marks = events.select(*keys, F.col(event).alias("_t"), F.lit(0).alias("_row"), F.col(event).alias("_e"))
    merged = rows.unionByName(marks.distinct(), allowMissingColumns=True)
    ordered = OrderedKeys(merged, keys, ["_t", "_row"], chunk_rows).running(maxima={"_last": F.col("_e")})
    hit = F.coalesce(F.col("_last") > F.col(low), F.lit(False))
    return ordered.result().filter((F.col("_row") == 1) & ~hit).select(*payload)


def full_outer_master(left: DataFrame, right: DataFrame, key: str, left_first: Sequence[str], flag: str = "is_current") -> DataFrame:
    """JOI-17. All keys of both sides; values of ``left`` first, ``flag`` marks its keys."""
    l = left.select(F.col(key).alias("_lk"), *[F.col(c).alias(f"_l_{c}") for c in left.columns if c != key])
    r = right.select(F.col(key).alias("_rk"), *[F.col(c).alias(f"_r_{c}") for c in right.columns if c != key])
    joined = l.join(r, F.col("_lk") == F.col("_rk"), "full")
    columns = [F.coalesce("_lk", "_rk").alias(key)]
    names = list(dict.fromkeys([c for c in left.columns if c != key] + [c for c in right.columns if c != key]))
    for name in names:
        sides = []
        if name in left.columns:
            value = F.col(f"_l_{name}")
            sides.append(F.nullif(value, F.lit("")) if name in left_first else value)
        if name in right.columns:
            sides.append(F.col(f"_r_{name}"))
        columns.append(F.coalesce(*sides).alias(name))
    return joined.select(*columns, F.col("_lk").isNotNull().alias(flag))


def extend_master(master: DataFrame, admitted: DataFrame, key: str, fill: dict[str, Column]) -> DataFrame:
    """JOI-23. Keep every master row and add admitted keys it lacks.

    Columns the new rows do not have are NULL unless ``fill`` gives them.
    """
    new = missing_in(admitted, master, [key])
    shared = set(admitted.columns)
    values = [
        (fill[f.name] if f.name in fill else F.col(f.name) if f.name in shared else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in master.schema.fields
    ]
    return master.unionByName(new.select(*values))
